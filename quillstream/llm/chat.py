"""Conversations rebuilt from their event logs and written as training texts, with DataFrame functions only.

A log has one row for each event of a message: `open` (role and first text), `delta` (more text), `edit` (the text anew),
`regenerate` (the text is begun again, and what had been said after the message is dropped) and `delete`. The log is
dealt by conversation and message, put in the order of its sequence and folded into the messages that are left; these are
rendered with a template whose marks can't come from a text, and with a loss mask.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, DELTA, EDIT, REGENERATE, DELETE = "open", "delta", "edit", "regenerate", "delete"


@dataclass(frozen=True)
class Template:
    """Marks around a turn's role and text, and the strings that may not come from a text: each begins with < or [ and has neither after that, nor a backslash."""

    turn: str = "<s>"
    text: str = "[INST]"
    end: str = "[/INST]</s>"
    control: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<|im_start|>", "<|im_end|>", "<unk>", "<pad>")
    learned: tuple[str, ...] = ("assistant",)

    def pattern(self, stuffing: str) -> str:
        tails = "|".join("".join(f"\\{c}" if not c.isalnum() else c for c in t[1:]) for t in sorted(self.control, reverse=True))
        return rf"([<\[]){stuffing}(\\*)({tails})"

    def escape(self, text: Column) -> Column:
        """One more backslash after the first character of each control string, so none is left; nothing else changes."""
        return F.regexp_replace(text, self.pattern(""), r"$1\\$2$3")

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, self.pattern(r"\\"), "$1$2$3")


TEMPLATE = Template()


def messages(events: DataFrame) -> DataFrame:
    """conv_id, opened, role, text of the messages that are left, from events (conv_id, seq, message, kind, role, text).

    seq orders a conversation's events and may be of any type with an order; message names one of its messages. Events that are
    delivered again count once. Deltas after the last `open`, `edit` or `regenerate` follow that event's own text; without any
    of these a message is its deltas, opened by the first. The role is the last one given. Null texts are empty; null
    conversations are one conversation, null messages one message of it. A message is dropped if it was deleted, or if an
    earlier one was regenerated after it had been opened. Further columns play no part; an empty log has no messages.
    """
    log = F.array_sort(F.collect_set(F.struct("seq", "kind", "role", "text")))  # one message's own events, which its text is made of
    each = events.groupBy("conv_id", "message").agg(log.alias("log"))
    starts = F.filter("log", lambda e: e["kind"].isin(OPEN, EDIT, REGENERATE))
    last = lambda of: F.try_element_at(of, F.lit(-1))
    since = F.filter("log", lambda e: (e["kind"] != DELETE) & (F.col("start").isNull() | (e["seq"] >= F.col("start"))))
    folded = each.select(
        "conv_id", "log", last(starts)["seq"].alias("start"), F.col("log")[0]["seq"].alias("opened"), F.exists("log", lambda e: e["kind"] == DELETE).alias("gone"),
        last(F.filter("log", lambda e: e["kind"] == REGENERATE))["seq"].alias("again"), last(F.filter("log", lambda e: e["role"].isNotNull()))["role"].alias("role"),
    ).where(~F.col("gone"))
    told = folded.select("conv_id", "opened", "again", "role", F.array_join(F.transform(since, lambda e: F.coalesce(e["text"], F.lit(""))), "").alias("text"))
    earlier = Window.partitionBy("conv_id").orderBy("opened").rowsBetween(Window.unboundedPreceding, -1)
    kept = told.withColumn("dropped_until", F.max("again").over(earlier))
    return kept.where(F.col("dropped_until").isNull() | (F.col("dropped_until") < F.col("opened"))).select("conv_id", "opened", "role", "text")


def render(turns: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, formatted, starts, loss: a conversation's text, where each turn starts in it, and the spans under the loss mask.

    Offsets count code points; a span names its turn (from 0), start and length, and holds the escaped text of a turn whose role
    is learned, without the marks. A null role is empty. A conversation is one row, as it is one training text; its size is that
    of its texts.
    """
    role, text = template.escape(F.coalesce("role", F.lit(""))), template.escape(F.col("text"))
    head = F.concat(F.lit(template.turn), role, F.lit(template.text))
    pieces = turns.select("conv_id", "opened", F.col("role").isin(*template.learned).alias("learned"), F.length(head).alias("ahead"), F.length(text).alias("n"), F.concat(head, text, F.lit(template.end)).alias("piece"))
    whole = Window.partitionBy("conv_id").orderBy("opened")
    placed = pieces.select(
        "conv_id", "learned", "ahead", "n", "piece", (F.row_number().over(whole) - 1).alias("turn"), (F.sum(F.length("piece")).over(whole) - F.length("piece")).cast("long").alias("start"),
    )
    listed = F.array_sort(F.collect_list(F.struct("turn", "start", "learned", "ahead", "n", "piece"))).alias("turns")
    span = lambda t: F.struct(t["turn"].alias("turn"), (t["start"] + t["ahead"]).alias("start"), t["n"].alias("length"))
    return placed.groupBy("conv_id").agg(listed).select(
        "conv_id", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"), F.transform("turns", lambda t: t["start"]).alias("starts"),
        F.transform(F.filter("turns", lambda t: F.coalesce(t["learned"], F.lit(False))), span).alias("loss"),
    )


def read_back(rendered: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, formatted, turns (role, text) and learned (the texts under the loss mask), all from what `render` wrote."""
    mark = "".join(c if c.isalnum() else f"\\{c}" for c in template.turn)
    split = rendered.select("conv_id", "formatted", "starts", "loss", F.filter(F.split("formatted", f"(?={mark})"), lambda p: p != "").alias("pieces"))
    at = lambda p: F.instr(p, template.text)  # noqa: E731  the first one: roles are escaped
    ahead, behind = len(template.turn), len(template.text)
    turn = lambda p: F.struct(
        template.unescape(F.substring(p, F.lit(ahead + 1), at(p) - 1 - ahead)).alias("role"),
        template.unescape(F.substring(p, at(p) + behind, F.length(p) - at(p) - behind - len(template.end) + 1)).alias("text"),
    )
    start = lambda s: (s["start"] - F.get("starts", s["turn"]) + 1).cast("int")
    masked = lambda s: template.unescape(F.substring(F.get("pieces", s["turn"]), start(s), s["length"]))
    return split.select("conv_id", "formatted", F.transform("pieces", turn).alias("turns"), F.transform("loss", masked).alias("learned"))


def digests(read: DataFrame) -> DataFrame:
    """Counts and digests of what was read back."""
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns.cast("binary"), 256).alias("turns_sha256"), F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned.cast("binary"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def step(number: int | Column, kind: str, said: Column, of: str = "own") -> Column:
    return F.struct((F.lit(number) if isinstance(number, int) else number).cast("int").alias("step"), F.lit(of).alias("of"), F.lit(kind).alias("kind"), said.alias("said"))


def log_of(conversations: DataFrame, delta_chars: int = 64) -> DataFrame:
    """An event log that has led to a table of turns (conv_id, turn, role, text), as a chat service would have kept it.

    A user's turn is opened with a draft and edited; an assistant's is streamed in deltas of `delta_chars` code points, and every
    other one was regenerated after a first answer, to which the user had already replied; others are opened with their text.
    Every turn's first event comes twice. Turns go by number (those without one last), role and text hash; null texts are empty;
    equal rows are turns of their own.
    """
    of, nothing = ["conv_id", "turn", "role", "text"], F.lit(None).cast("string")
    copies = conversations.select(*of[:3], F.coalesce("text", F.lit("")).alias("text")).groupBy(*of).agg(F.count(F.lit(1)).cast("int").alias("n"))
    rows = copies.select(*of, F.explode(F.sequence(F.lit(1), "n")).alias("copy"))
    pieces = F.transform(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{delta_chars}}}"), 0), lambda p, i: step(i + 4, DELTA, p))
    first = step(0, OPEN, nothing)
    again = [step(1, DELTA, F.lit("A first answer.")), step(2, OPEN, F.lit("Please try again."), "reply"), step(3, REGENERATE, nothing)]
    streamed = F.concat(F.when(F.coalesce("turn", F.lit(0)) % 4 == 1, F.array(first, *again)).otherwise(F.array(first)), pieces)
    edited = F.array(step(0, OPEN, F.concat(F.lit("(draft) "), F.substring("text", 1, 40))), step(1, EDIT, F.col("text")))
    steps = F.when(F.col("role") == "assistant", streamed).when(F.col("role") == "user", edited).otherwise(F.array(step(0, OPEN, F.col("text"))))
    place = F.struct(F.col("turn").isNull().alias("undated"), "turn", "role", F.xxhash64("text").alias("hash"), "copy")
    each = rows.select("conv_id", "role", place.alias("place"), steps.alias("steps")).select("conv_id", "role", "place", F.explode(F.concat("steps", F.slice("steps", 1, 1))).alias("e"))
    role = F.when(F.col("e.of") == "own", F.col("role")).otherwise("user").alias("role")
    return each.select("conv_id", F.struct("place", "e.step").alias("seq"), F.struct("place", "e.of").alias("message"), F.col("e.kind").alias("kind"), role, F.col("e.said").alias("text"))


def round_trip(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Each conversation's counts and digests, read back from the text and mask that its event log leads to."""
    return digests(read_back(render(messages(log_of(conversations)), template), template))
