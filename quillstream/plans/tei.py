"""TEI documents as plain text with parts, pages, gaps and extracts.

A file's XML events are read once and looked up in a table of rules, which says what is written at an element's start and
end; what an element's place decides (the level of a heading, whether a label is in a list) follows from the elements around
it. That gives a table of pieces, each in a scope: the document, a part of it, or an extract. Everything else is done on that
table: texts of scopes from the innermost outwards, offsets and names from the outermost inwards, pages by their breaks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstream.functions.python import decode_entities, xml_events
from quillstream.functions.text import clean
from quillstream.sources import scratch

#: Elements of the TEI converter by what they do. Those passed through leave their text where it is.
PASSED_THROUGH = {"SUBST", "CHOICE", "SIC", "FW", "SUP", "SUB", "ABBR", "Q", "MILESTONE", "SEG", "UNCLEAR", "ABOVE", "BELOW", "DATE", "BIBL", "SALUTE", "ADD", "REF", "PTR"}
PARAGRAPHS = {
    "P", "AB", "CLOSER", "SP", "STAGE", "TABLE", "LG", "TRAILER", "OPENER", "FIGURE", "LETTER", "ARGUMENT", "DATELINE", "SIGNED", "EPIGRAPH", "GROUP", "TEXT", "BYLINE", "POSTSCRIPT",
}
LINES = {"L", "ROW", "SPEAKER", "LB"}
PARTS = {"FRONT", "BACK", "TEXT", "BODY"}
NOTES = {"NOTE", "HEADNOTE", "TAILNOTE", "DEL", "CORR"}
UNKNOWN_GAP, IMAGE = "〈?〉", ("〈 image: ", " 〉")

#: What is written at an element's start and end: a text, or as many line ends as the text before has to have; below zero,
#: only where there is a text before. {h} stands for the number signs of the level around, {l} for those of a label.
RULES: dict[str, tuple[str | int | None, str | int | None]] = (
    {t: (-2, 2) for t in PARAGRAPHS} | {t: (-1, 1) for t in LINES} | {"DIV": (None, 2), "LIST": (None, 2), "HEAD": ("{h} ", 2), "ARGUMENT": ("## ", 2)}
    | {"LABEL": ("{l} ", 2), "CELL": (" | ", " | "), "ITEM": (" * ", None), "HI": ("*", "*"), "FIGDESC": IMAGE}
)
#: The same without marks of structure.
UNMARKED = {"HEAD": ("", 2), "ARGUMENT": ("", 2), "LABEL": ("", 2), "CELL": (" ", ""), "ITEM": ("", None)}

SAY, JOIN, PART, EXTRACT, END, PAGE, GAP = "say", "join", "part", "extract", "end", "page", "gap"
#: i: place in the document; scope: the place where the piece's scope opened (0: the document); depth: of that scope.
PIECE = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("scope", T.IntegerType()), T.StructField("depth", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("said", T.StringType()), T.StructField("label", T.StringType())])
ARROW_PIECE = list(zip(PIECE.names, (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string()), strict=True))


def family(tag: str) -> str:
    return "DIV" if tag.startswith("DIV") else tag


def level(around: list[str]) -> int:
    """Of the sections around: that of the innermost with a number, and one for each without since."""
    found = 0
    for tag in around:
        if family(tag) == "DIV":
            found = int(tag[-1]) if tag[-1].isdigit() else found + 1
    return found


def pieces(content: bytes, entities: dict[str, str] | None = None, inline_notes: bool = False, emphases: bool = True, structure: bool = True, core: bool = False, rehyphenate: bool = False) -> Iterator[tuple]:
    """The document's pieces, as PIECE.

    Options: notes stay in the text (`inline_notes`), no stars (`emphases`), no marks of structure (`structure`), only what was
    transcribed (`core`: gaps are left out, and image descriptions become extracts), soft hyphens made hyphens at line ends
    (`rehyphenate`).
    """
    rules = RULES if structure else RULES | UNMARKED
    rules = rules if emphases else rules | {"HI": ("", "")}
    extracts = ({t: t.lower() for t in NOTES} if not inline_notes else {}) | ({"FIGDESC": "image"} if core else {})
    soft = "-\n" if rehyphenate else ""
    # a scope: where it opened, its kind, the elements open in it, whether it has text, line ends at its end, any words, any since a part
    scopes: list[dict] = [{"at": 0, "kind": None, "open": [], "text": False, "ends": 0, "words": False, "since": False}]
    after_break, i = False, 0

    def put(kind: str, said: str = "", label: str | None = None) -> tuple:
        nonlocal i
        i += 1
        own = scopes[-1]
        if said:
            bare = said.rstrip("\n")
            own["ends"] = len(said) - len(bare) + (own["ends"] if not bare else 0)
            own["text"] = True
            if kind != JOIN and said.strip(" \n"):
                own["words"] = own["since"] = True
        return i, own["at"], len(scopes) - 1, kind, said, label

    for e in xml_events(content):
        own, tag, said = scopes[-1], (e["name"] or "").upper(), None
        broke, after_break = after_break, False
        if e["kind"] == "text":
            said = decode_entities(e["text"], entities)
            said = said.replace("\n", "") if "TABLE" in own["open"] else said[1:] if broke and said.startswith("\n") else said
            yield put(SAY, re.sub("[|∣]", soft, said))
        elif e["kind"] == "comment":
            if unknown := re.match(r" unknown entity (\w+); $", e["text"] or ""):
                yield put(SAY, "'" if unknown[1] == "apos" else decode_entities(f"&{unknown[1]};", entities))
        elif e["kind"] == "start":
            given = {k.upper(): v for k, v in (e["attributes"] or {}).items()}
            if tag in PARTS or tag in extracts:
                if tag in PARTS and own["since"]:
                    yield put(JOIN, "\n\n")
                own["since"] = own["since"] and tag not in PARTS
                yield put(PART if tag in PARTS else EXTRACT, "", extracts.get(tag, tag.lower()))
                scopes.append({"at": i, "kind": tag, "open": [], "text": False, "ends": 0, "words": False, "since": False})
                continue
            if tag == "PB":
                after_break = True
                yield put(PAGE, "", given.get("REF", "-1"))
            elif tag == "GAP":
                text = given.get("DISP", UNKNOWN_GAP)
                yield put(GAP, "" if core else text, text)
            said = rules.get(family(tag), (None, None))[0]
            if tag == "LABEL" and "LIST" in own["open"]:
                said = ""
            if isinstance(said, str) and "{" in said:
                said = said.format(h="#" * level(own["open"]), l="#" * (level(own["open"]) + 1))
            own["open"].append(tag)
        elif own["kind"] == tag and not own["open"]:
            scopes.pop()
            if own["kind"] in PARTS and own["words"]:
                scopes[-1] |= {"text": True, "ends": 2, "words": True}  # the part's text and a blank line
            elif own["kind"] not in PARTS:
                yield put(END, "", str(own["at"]))
            continue
        else:
            own["open"].pop()
            said = rules.get(family(tag), (None, None))[1]
            said = 1 if tag == "LABEL" and "LIST" in own["open"] else said
        if e["kind"] in ("start", "end"):
            if isinstance(said, int):
                after_break = True
                need = max(0, abs(said) - own["ends"]) if own["text"] or said > 0 else 0
                said = "\n" * need
            if said:
                yield put(SAY, said)


def tidy(text: str) -> str:
    """The rule of functions.text.clean, for a string."""
    return re.sub(r"\n\n+", "\n\n", text.replace(" |  | ", " | ")).strip(" \n")


def numbered(pages: list[str]) -> list[int]:
    """For page references in order, how often each has been repeated at once."""
    out = [0]
    for before, now in zip(pages, pages[1:], strict=False):
        out.append(out[-1] + 1 if before == now else 0)
    return out


def page_rows(content: bytes) -> Iterator[tuple[str, int, str]]:
    """page, sub_page, text of one document."""
    texts, refs = [""], ["0"]
    for _, _, _, kind, said, label in pieces(content):
        if kind == PAGE:
            refs.append(label)
            texts.append("")
        elif kind != JOIN:
            texts[-1] += said
    repeats = [*numbered(refs), None]
    for k, (ref, text) in enumerate(zip(refs, map(tidy, texts), strict=True)):
        last = k + 1 == len(refs)
        if text or (ref != "0" and not last):
            yield ref, 1 + repeats[k] if last else 1 + repeats[k + 1], text


def read_pieces(files: DataFrame, entities: dict[str, str] | None = None, **options: bool) -> DataFrame:
    """files (path, content) -> path, error, pieces."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, offsets, errors = [], [0], []
            for c in batch.column("content"):
                begun = len(rows)
                try:
                    rows += pieces(bytes(c.as_py()), entities, **options)
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  a bad file doesn't end the others
                    del rows[begun:]
                    errors.append(f"{type(e).__name__}: {e}")
                offsets.append(len(rows))
            columns = zip(*rows, strict=True) if rows else [()] * len(ARROW_PIECE)
            told = pa.StructArray.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, ARROW_PIECE, strict=True)], [name for name, _ in ARROW_PIECE])
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(errors, pa.string()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), told)], ["path", "error", "pieces"])

    schema = T.StructType([files.schema["path"], T.StructField("error", T.StringType()), T.StructField("pieces", T.ArrayType(PIECE))])
    return files.select("path", "content").mapInArrow(read, schema)


def joined(rows: Column) -> Column:
    """The texts (last fields) of structs in the order of their first ones."""
    return F.array_join(F.transform(F.sort_array(F.collect_list(rows)), lambda r: r["piece"]), "")


def scope_texts(told: DataFrame, depths: int) -> tuple[DataFrame, DataFrame]:
    """(the pieces with what each adds to its scope and its place there: piece, pos; the texts of scopes: path, scope, text), innermost first."""
    placed, texts = None, None
    own = Window.partitionBy("path", "scope").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    inner = None
    for depth in range(depths, -1, -1):
        at = told.where(F.col("depth") == depth)
        at = at.withColumn("inner", F.lit("")) if inner is None else at.join(inner.select("path", F.col("scope").alias("i"), F.col("text").alias("inner")), ["path", "i"], "left").fillna({"inner": ""})
        piece = F.when((F.col("kind") == PART) & (F.col("inner") != ""), F.concat("inner", F.lit("\n\n"))).otherwise(F.when(F.col("kind") == PART, "").otherwise(F.col("said")))
        here = scratch.kept(at.withColumn("piece", piece).withColumn("pos", F.coalesce(F.sum(F.length("piece")).over(own), F.lit(0))), "placed")
        inner = scratch.kept(here.groupBy("path", "scope").agg(clean(joined(F.struct("i", "piece"))).alias("text")), "texts")
        placed, texts = (here, inner) if placed is None else (placed.unionByName(here), texts.unionByName(inner))
    return placed, texts


def scope_names(placed: DataFrame, depths: int) -> DataFrame:
    """path, scope, start, prefix of all scopes, outermost first, and for parts their own name."""
    in_scope = Window.partitionBy("path", "scope").orderBy("i")
    before = in_scope.rowsBetween(Window.unboundedPreceding, -1)
    stretch = placed.withColumn("stretch", F.coalesce(F.sum((F.col("kind") == PART).cast("int")).over(before), F.lit(0)))
    said = F.when(F.col("kind").isin(PART, JOIN), "").otherwise(F.col("piece"))
    ahead = stretch.groupBy("path", "scope", "stretch").agg(clean(joined(F.struct("i", said.alias("piece")))).alias("ahead"))
    opened = stretch.where(F.col("kind").isin(PART, EXTRACT)).join(ahead, ["path", "scope", "stretch"])
    counted = opened.withColumn("pre", F.when(F.col("kind") == PART, (F.col("ahead") != "").cast("int")).otherwise(0)).withColumn("n", F.when(F.col("kind") == PART, F.col("pre") + (F.col("inner") != "").cast("int")).otherwise(0))
    number = 1 + F.coalesce(F.sum("n").over(before), F.lit(0)) + F.col("pre")
    named = scratch.kept(counted.select("path", F.col("i").alias("scope"), F.col("scope").alias("outer"), "depth", "kind", "label", "pos", "pre", "ahead", number.alias("number")), "opened")
    out = found = placed.select("path").distinct().select("path", F.lit(0).alias("scope"), F.lit(0).cast("long").alias("start"), F.lit("").alias("prefix"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("ahead"), F.lit(None).cast("string").alias("ahead_name"))
    for depth in range(depths):
        above = out.select("path", F.col("scope").alias("outer"), F.col("start").alias("above"), F.col("prefix").alias("lead"))
        met = named.where(F.col("depth") == depth).join(above, ["path", "outer"])
        part = F.concat("lead", F.col("number").cast("string"), F.lit("_"), "label")
        prefix = F.when(F.col("kind") == PART, F.concat(part, F.lit("_"))).otherwise(F.concat("lead", "label", F.lit("_at_"), F.col("pos").cast("string"), F.lit("_")))
        pre = F.when((F.col("kind") == PART) & (F.col("pre") > 0), F.concat("lead", (F.col("number") - 1).cast("string"), F.lit("_pre"), "label"))
        out = scratch.kept(met.select("path", "scope", (F.col("above") + F.col("pos")).alias("start"), prefix.alias("prefix"), F.when(F.col("kind") == PART, part).alias("name"), "ahead", pre.alias("ahead_name")), "names")
        found = found.unionByName(out)
    return found


def page_stretches(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the pieces with page_no, the number of page breaks up to each; the pages: path, page_no, page, next, repeats, text)."""
    along = Window.partitionBy("path").orderBy("i")
    on = scratch.kept(placed.withColumn("page_no", F.coalesce(F.sum((F.col("kind") == PAGE).cast("int")).over(along.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))), "on")
    said = F.when(F.col("kind").isin(PART, JOIN), "").otherwise(F.col("said"))
    refs = on.groupBy("path", "page_no").agg(F.coalesce(F.max(F.when(F.col("kind") == PAGE, F.col("label"))), F.lit("0")).alias("page"), clean(joined(F.struct("i", said.alias("piece")))).alias("text"))
    first = placed.select("path").distinct().select("path", F.lit(0).alias("page_no"), F.lit("0").alias("page"), F.lit("").alias("text"))
    every = refs.unionByName(first.join(refs.where("page_no = 0").select("path"), "path", "left_anti"))
    by = Window.partitionBy("path").orderBy("page_no")
    changed = every.withColumn("run", F.sum(F.coalesce((F.col("page") != F.lag("page").over(by)).cast("int"), F.lit(1))).over(by))
    repeats = F.row_number().over(Window.partitionBy("path", "run").orderBy("page_no")) - 1
    counted = changed.withColumn("repeats", repeats).withColumn("next_repeats", F.lead("repeats").over(by)).withColumn("before", F.lag("page").over(by))
    return on, scratch.kept(counted.drop("run"), "pages")


def listed(rows: DataFrame, name: str, order: str, *columns: str | Column) -> DataFrame:
    return rows.groupBy("path").agg(F.transform(F.sort_array(F.collect_list(F.struct(order, F.struct(*columns).alias("row")))), lambda r: r["row"]).alias(name))


def convert_tei(files: DataFrame, entities: dict[str, str] | None = None, **options: bool) -> DataFrame:
    """files (path, content) -> path, text, parts, pages, page_texts, gaps, extracts, error (of a file that can't be read).

    Parts, gaps and extracts are in the order in which they begin. Offsets of gaps and extracts count what has been written of the
    document before them, those of pages without blanks at the ends. See `pieces` for the options. Paths name files; an empty file
    is an error, an empty table has no rows.
    """
    read = scratch.kept(read_pieces(files, entities, **options), "tei")
    told = read.select("path", F.explode("pieces").alias("p")).select("path", "p.*")
    depths = told.agg(F.coalesce(F.max("depth"), F.lit(0))).first()[0]
    placed, texts = scope_texts(told, depths)
    names = scratch.kept(scope_names(placed, depths), "scopes")
    on, pages = page_stretches(placed)
    # only the pieces that are marks meet the names and pages; those that are text are most of them
    met = on.where(F.col("kind").isin(GAP, EXTRACT, END, PAGE)).join(names.select("path", "scope", "start", "prefix"), ["path", "scope"]).join(pages.select("path", "page_no", "page", "repeats", "before"), ["path", "page_no"])
    met = scratch.kept(met, "met")

    whole = texts.join(names, ["path", "scope"])
    inner = whole.where("name is not null and text != ''").select("path", F.struct("scope", F.lit(1).alias("k")).alias("o"), F.col("name").alias("part"), "text")
    ahead = whole.where("ahead_name is not null").select("path", F.struct("scope", F.lit(0).alias("k")).alias("o"), F.col("ahead_name").alias("part"), F.col("ahead").alias("text"))
    parts = listed(inner.unionByName(ahead), "parts", "o", "part", "text")
    gap_rows = met.where(F.col("kind") == GAP)
    gaps = listed(gap_rows, "gaps", "i", "page", (F.col("repeats") + 1).cast("int").alias("sub_page"), (F.col("start") + F.col("pos")).cast("int").alias("offset"), F.col("label").alias("text"))

    # an extract is dated by the page on which it ends
    opened = met.where(F.col("kind") == EXTRACT).select("path", F.col("i").alias("opened"), F.col("label").alias("kind_of"), (F.col("start") + F.col("pos")).alias("offset"), F.regexp_replace("prefix", "_+$", "").alias("part"))
    ended = met.where(F.col("kind") == END).select("path", F.col("label").cast("int").alias("opened"), F.col("i").alias("ended"), "page", "page_no")
    on_page = on.select("path", "page_no", "i", F.when(F.col("kind").isin(PART, JOIN), "").otherwise(F.col("said")).alias("piece"))
    upto = ended.join(on_page, ["path", "page_no"]).where("i < ended").groupBy("path", "opened").agg(F.length(clean(joined(F.struct("i", "piece")))).alias("page_offset"))
    noted = opened.join(ended, ["path", "opened"]).join(upto, ["path", "opened"], "left").join(texts.withColumnRenamed("scope", "opened"), ["path", "opened"], "left")
    extracts = listed(noted, "extracts", "opened", F.col("kind_of").alias("kind"), F.col("offset").cast("int").alias("offset"), "part", "page", F.coalesce("page_offset", F.lit(0)).cast("int").alias("page_offset"), F.coalesce("text", F.lit("")).alias("text"))

    turned = met.where((F.col("kind") == PAGE) & ~F.col("label").eqNullSafe(F.col("before"))).select("path", "scope", "start", F.col("i").alias("at"), "label")
    written = turned.join(on.select("path", "scope", "i", "piece"), ["path", "scope"]).where("i <= at").groupBy("path", "scope", "at").agg(F.length(clean(joined(F.struct("i", "piece")))).alias("n"))
    places = turned.join(written, ["path", "scope", "at"]).select("path", "at", (F.col("start") + F.col("n")).cast("int").alias("offset"), F.col("label").alias("page"))
    turns = listed(places, "pages", "at", "offset", "page")
    last = F.col("next_repeats").isNull()
    shown = pages.where((F.col("text") != "") | ((F.col("page") != "0") & ~last)).withColumn("sub_page", (1 + F.when(last, F.col("repeats")).otherwise(F.col("next_repeats"))).cast("int"))
    page_texts = listed(shown, "page_texts", "page_no", "page", "sub_page", "text")

    out = read.select("path", "error").join(texts.where("scope = 0").select("path", "text"), "path", "left")
    for table, name in ((parts, "parts"), (turns, "pages"), (page_texts, "page_texts"), (gaps, "gaps"), (extracts, "extracts")):
        out = out.join(table, "path", "left").withColumn(name, F.coalesce(name, F.when(F.col("error").isNull(), F.array().cast(table.schema[name].dataType))))
    text = F.when(F.col("error").isNull(), F.coalesce("text", F.lit(""))).alias("text")
    return out.select("path", text, "parts", "pages", "page_texts", "gaps", "extracts", "error")
