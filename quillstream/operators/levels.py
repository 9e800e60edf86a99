"""One corpus at several granularities: lines, paragraphs, sections, sentences, with offsets and inherited metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.functions.python import sentence_spans
from quillstream.functions.text import default_analyzer, heading_level, heading_text, n_tokens
from quillstream.operators.aggregates import counts_before


def before(order: Window) -> Window:
    return order.rowsBetween(Window.unboundedPreceding, -1)


def until(order: Window) -> Window:
    return order.rowsBetween(Window.unboundedPreceding, 0)


def lines(docs: DataFrame, key: str = "doc_id", text: str = "text", mark: str = "\n") -> DataFrame:
    """key, line_no (from 0), line of each text."""
    return docs.select(key, F.posexplode(F.split(text, mark)).alias("line_no", "line"))


def with_offsets(units: DataFrame, key: str, order: str, length: Column, gap: int = 1) -> DataFrame:
    """start_offset and end_offset of units that stand one after the other, `gap` characters between them."""
    start = F.coalesce(F.sum(length + gap).over(before(Window.partitionBy(key).orderBy(order))), F.lit(0))
    return units.withColumn("start_offset", start).withColumn("end_offset", F.col("start_offset") + length)


def line_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, line_no, n_chars, start_offset, end_offset: only lengths are shuffled."""
    narrow = lines(docs, key, text).select(key, "line_no", F.length("line").cast("long").alias("n_chars"))
    return with_offsets(narrow, key, "line_no", F.col("n_chars"))


def group_numbers(rows: DataFrame, key: str, order: str, begins: Column, name: str) -> DataFrame:
    """A number that grows by one at each row that begins a group."""
    return rows.withColumn(name, F.sum(F.when(begins, 1).otherwise(0)).over(until(Window.partitionBy(key).orderBy(order))))


def paragraphs(rows: DataFrame, key: str, order: str = "line_no", line: str = "line") -> DataFrame:
    """Paragraphs of lines, parted by blank lines: key, paragraph, text (each line with its feed), start_offset, end_offset, lines."""
    w = Window.partitionBy(key).orderBy(order)
    placed = with_offsets(rows, key, order, F.length(line))
    blank = F.col(line) == ""
    numbered = placed.withColumn("paragraph", F.sum(F.when(~blank & F.coalesce(F.lag(line).over(w) == "", F.lit(True)), 1).otherwise(0)).over(until(w))).where(~blank)
    return numbered.groupBy(key, "paragraph").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, line))), lambda x: F.concat(x[line], F.lit("\n"))), "").alias("text"),
        F.min("start_offset").alias("start_offset"), (F.max("end_offset") + 1).alias("end_offset"), F.count(F.lit(1)).alias("lines"), F.max(order).alias("last_line"),
    )


def heading_scopes(rows: DataFrame, key: str, order: str = "line_no", line: str = "line") -> DataFrame:
    """Rows with the sections that are open at them: section_1 to section_3 (the heading's row) and heading_1 to heading_3.

    A heading closes those of its level and deeper ones. Its own row isn't in the section that it opens.
    """
    w = Window.partitionBy(key).orderBy(order)
    out = rows.withColumn("heading_level", heading_level(F.col(line)))
    for level in (1, 2, 3):
        closed = F.last(F.when(F.col("heading_level") < level, F.col(order)), ignorenulls=True).over(before(w))
        opened = F.last(F.when(F.col("heading_level") == level, F.struct(F.col(order).alias("at"), heading_text(F.col(line)).alias("heading"))), ignorenulls=True).over(before(w))
        still = opened["at"].isNotNull() & (closed.isNull() | (opened["at"] > closed)) & (F.col("heading_level").isNull() | (F.col("heading_level") > level))
        out = out.withColumn(f"section_{level}", F.when(still, opened["at"])).withColumn(f"heading_{level}", F.when(still, opened["heading"]))
    return out


def sections(rows: DataFrame, key: str, order: str = "line_no", line: str = "line") -> DataFrame:
    """key, section (its heading's row), heading_level, heading, text: lines below the heading, parted by line feeds."""
    scoped = heading_scopes(rows, key, order, line)
    heads = scoped.where(F.col("heading_level").isNotNull()).select(key, F.col(order).alias("section"), "heading_level", heading_text(F.col(line)).alias("heading"))
    inside = scoped.select(key, order, line, F.explode(F.array_compact(F.array("section_1", "section_2", "section_3"))).alias("section"))
    text = inside.groupBy(key, "section").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, line))), lambda x: x[line]), "\n").alias("text"))
    return heads.join(text, [key, "section"], "left").withColumn("text", F.coalesce("text", F.lit("")))


def sentences(units: DataFrame, keys: list[str], text: str = "text", start: str | None = None) -> DataFrame:
    """keys, sentence (from 1), sentence_text, start_offset, end_offset: spans tile the unit."""
    base = F.col(start) if start else F.lit(0)
    spans = units.select(*keys, F.col(text).alias("_t"), base.alias("_s"), F.posexplode(sentence_spans(text)).alias("sentence", "span"))
    return spans.select(
        *keys, (F.col("sentence") + 1).alias("sentence"), F.substring("_t", F.col("span.start") + 1, F.col("span.end") - F.col("span.start")).alias("sentence_text"),
        (F.col("_s") + F.col("span.start")).alias("start_offset"), (F.col("_s") + F.col("span.end")).alias("end_offset"),
    )


def measured(units: DataFrame, text: str = "text") -> DataFrame:
    """Units with content_length and content_tokens."""
    return units.withColumn("content_length", F.length(text)).withColumn("content_tokens", n_tokens(default_analyzer(F.col(text))))


def roll_up(children: DataFrame, keys: list[str], order: str, text: str, separator: str) -> DataFrame:
    """Parents' texts: children's, in order, with a separator."""
    return children.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), separator).alias(text))


def carried(rows: DataFrame, key: str, order: str, value: Column, name: str) -> DataFrame:
    """The value of the row before."""
    return rows.withColumn(name, F.lag(value).over(Window.partitionBy(key).orderBy(order)))


def runs(rows: DataFrame, key: str, order: str, value: str, name: str = "run") -> DataFrame:
    """Numbers, from 1, of the runs of equal values."""
    w = Window.partitionBy(key).orderBy(order)
    changed = ~F.col(value).eqNullSafe(F.lag(value).over(w)) | (F.row_number().over(w) == 1)
    return rows.withColumn("_changed", changed).withColumn(name, F.sum(F.col("_changed").cast("int")).over(until(w))).drop("_changed")


def joined_until(rows: DataFrame, key: str, order: str, line: str, drop_tail: bool = False, least: int = 5) -> DataFrame:
    """key, sentence (from 1), text: lines joined by blanks until one ends in a full stop and what is gathered is longer than `least`.

    A line that is a full stop's and too short by itself goes on with the next one.
    """
    w = Window.partitionBy(key).orderBy(order)
    ends = F.endswith(line, F.lit(".")) & (F.length(line) > least)
    numbered = rows.withColumn("_ends", ends).withColumn("sentence", F.coalesce(F.sum(F.col("_ends").cast("int")).over(before(w)), F.lit(0)) + 1)
    out = numbered.groupBy(key, "sentence").agg(F.trim(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, line))), lambda x: x[line]), " ")).alias("text"), F.max(F.col("_ends").cast("int")).alias("complete"))
    return out.where("complete = 1").drop("complete") if drop_tail else out.drop("complete")


def token_offsets(tokens: DataFrame, key: str, order: list[str], word: str, gap: Column) -> DataFrame:
    """position, start_offset, end_offset of words: each begins a gap behind the last one's end, the first at gap - 1."""
    w = Window.partitionBy(key).orderBy(*order)
    step = gap + F.length(word)
    end = F.sum(step).over(until(w)) - 1
    return tokens.withColumn("position", F.row_number().over(w) - 1).withColumn("end_offset", end).withColumn("start_offset", F.col("end_offset") - F.length(word))


#: Ranges that keys are numbered in.
RANGES = 1024


def global_numbers(rows: DataFrame, key: str, name: str) -> DataFrame:
    """key, number from 0 of each distinct key in order, the keys cut into ranges that are ordered apart.

    The ranges begin at the keys whose hashes are divisible by a number that leaves about RANGES of them, so they follow
    from the data alone; their sizes are added up, and no task orders more than a range.
    """
    keys = rows.select(key).where(F.col(key).isNotNull()).distinct()
    step = max(1, keys.count() // RANGES)
    begins = [r[0] for r in keys.where(F.pmod(F.xxhash64(key), F.lit(step)) == 0).orderBy(key).collect()]  # about RANGES keys
    placed = keys.withColumn("_range", F.size(F.filter(F.array(*[F.lit(b) for b in begins]), lambda b: b <= F.col(key))) if begins else F.lit(0))
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before(Window.partitionBy(F.lit(1)).orderBy("_range"))), F.lit(0))).drop("_n")
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(key)) - 1
    return placed.withColumn("_at", inside).join(F.broadcast(starts), "_range").select(key, (F.col("_start") + F.col("_at")).alias(name))  # a row for each range


def ordinals(rows: DataFrame, keys: list[str], order: str, name: str) -> DataFrame:
    """Rows with their number, from 1, within their keys, by a number that is different in each row; no group is sorted by one task."""
    counted = counts_before(rows.select(*keys, order).withColumn("_one", F.lit(1)), keys, order, "_one", name)
    return rows.join(counted.select(*keys, order, (F.col(name) + 1).cast("int").alias(name)), [*keys, order])
