"""Multi-part books at five or six granularities, with text reuse and bibliographic metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstream.functions.scalars import date_bounds, estc_id, flag_of, none_if_blank
from quillstream.operators import joins, levels

#: Kinds of the bibliographic table's columns (all others are strings), lists, and columns that are left out.
INT_COLUMNS = {
    "pagecount.orig", "document.items", "publication_year", "publication_decade", "publication_frequency_annual", "publication_interval_from", "publication_interval_till", "author_birth", "author_death", "publication_year_from",
    "publication_year_to", "publication_year_till", "volnumber", "volcount", "parts", "publication_time",
}
FLOAT_COLUMNS = {"pagecount", "latitude", "longitude", "paper", "width", "height", "area"}
LISTED = {"publication_geography", "publication_topic", "subject"}
SKIPPED = {"original_row", "paper.check"}


def part_files(files: DataFrame) -> DataFrame:
    """path, text of <prefix>_<n>_<type>.txt files -> prefix, part (a number), part_type, text."""
    pattern = r"([^/]*)_(\d+)_([A-Za-z]+)\.txt$"
    parts = files.where(F.col("path").rlike(pattern))
    return parts.select(F.regexp_extract("path", pattern, 1).alias("prefix"), F.regexp_extract("path", pattern, 2).cast("int").alias("part"), F.regexp_extract("path", pattern, 3).alias("part_type"), "text")


def page_total(files: DataFrame) -> DataFrame:
    """prefix, pages: the greatest number in <prefix>_page<n> names."""
    pattern = r"([^/]*)_page(\d+)"
    pages = files.where(F.col("path").rlike(pattern)).select(F.regexp_extract("path", pattern, 1).alias("prefix"), F.regexp_extract("path", pattern, 2).cast("int").alias("n"))
    return pages.groupBy("prefix").agg(F.max("n").alias("pages"))


def document_rows(metadata: DataFrame, legacy_dates: bool = False) -> DataFrame:
    """Metadata with date_start and date_end as numbers: a single date, or a range."""
    single, start, end = (F.coalesce(F.col(c), F.lit("")) for c in ("pub_date", "pub_date_start", "pub_date_end"))
    a, b = date_bounds(F.when(single != "", single).otherwise(start), legacy_dates)
    last = date_bounds(end, legacy_dates)[1]
    return metadata.withColumn("date_start", a).withColumn("date_end", F.when((single == "") & (end != ""), last).otherwise(b)).drop("pub_date", "pub_date_start", "pub_date_end")


def book_levels(parts: DataFrame, documents: DataFrame, reuse: DataFrame | None = None, graphics: DataFrame | None = None, part_gap: int = 0) -> dict[str, DataFrame]:
    """document, part, section, paragraph and sentence tables.

    parts: document_id, part, part_type, text. documents: document_id and what every level inherits. reuse:
    document_id, start, end, fragment_id. graphics: document_id, part, type, caption. Spans are in the document, whose
    text is its parts' one after the other, `part_gap` characters apart.
    """
    key = ["document_id", "part"]
    totals = parts.groupBy("document_id").agg(
        F.sum(F.size(F.filter(F.split("text", "\n"), lambda x: x == ""))).cast("int").alias("total_paragraphs"), F.sum(F.length(F.replace("text", F.lit("\n"), F.lit("")))).alias("document_length")
    )
    placed = levels.with_offsets(parts, "document_id", "part", F.length("text"), part_gap)
    lines = placed.select(*key, F.col("start_offset").alias("part_start"), F.posexplode(F.split("text", "\n")).alias("line_no", "line")).withColumn("unit", F.concat_ws("/", *key))
    scoped = levels.heading_scopes(lines, "unit")

    paragraphs = levels.paragraphs(lines.select("unit", "line_no", "line"), "unit")
    starts = lines.select("unit", *key, "part_start").distinct()
    # a paragraph is in the sections that are open at its last line
    open_at = scoped.select("unit", F.col("line_no").alias("last_line"), *[f"section_{i}" for i in (1, 2, 3)], *[f"heading_{i}" for i in (1, 2, 3)])
    paragraphs = paragraphs.join(open_at, ["unit", "last_line"], "left").join(starts, "unit")
    paragraphs = paragraphs.select(
        *key, "paragraph", "text", (F.col("part_start") + F.col("start_offset")).alias("start"), (F.col("part_start") + F.col("end_offset")).alias("end"),
        F.array_compact(F.array("section_1", "section_2", "section_3")).alias("sections"), F.array_compact(F.array("heading_1", "heading_2", "heading_3")).alias("headings"),
    )
    sentences = levels.sentences(paragraphs.drop("end"), [*key, "paragraph", "sections", "headings"], start="start").withColumnsRenamed({"sentence_text": "text", "start_offset": "start", "end_offset": "end"})

    sections = levels.sections(lines.select("unit", "line_no", "line"), "unit").join(starts, "unit")
    line_starts = levels.with_offsets(lines.select("unit", "line_no", "line"), "unit", "line_no", F.length("line")).select("unit", F.col("line_no").alias("section"), "end_offset")
    sections = sections.join(line_starts, ["unit", "section"]).withColumn("start", F.col("part_start") + F.col("end_offset") + 1)
    sections = sections.withColumn("end", F.col("start") + F.length("text")).select(*key, "section", "heading", "heading_level", "text", "start", "end")

    whole = levels.roll_up(placed, ["document_id"], "part", "text", "\n" * part_gap)
    out = {
        "document": whole.withColumn("start", F.lit(0)).withColumn("end", F.length("text")),
        "part": placed.withColumnsRenamed({"start_offset": "start", "end_offset": "end"}),
        "section": sections, "paragraph": paragraphs, "sentence": sentences,
    }
    units = {"document": [], "part": ["part"], "section": ["part", "section"], "paragraph": ["part", "paragraph"], "sentence": ["part", "paragraph", "sentence"]}
    if graphics is not None:
        kinds = graphics.withColumn("type", F.coalesce(F.nullif("type", F.lit("")), F.lit("unknown")))
        for name, on in (("part", key), ("document", ["document_id"])):
            seen = kinds.groupBy(*on).agg(F.array_sort(F.collect_set("type")).alias("graphic_types"), F.array_sort(F.collect_set("caption")).alias("graphic_captions"))
            out[name] = out[name].join(seen, on, "left")
    for name, rows in out.items():
        rows = levels.measured(rows)
        if reuse is not None:
            if name == "document":  # every fragment of the document, wherever it is
                ids = reuse.groupBy("document_id").agg(F.array_sort(F.collect_set("fragment_id")).alias("reuse_ids"))
                rows = joins.enrich(rows, ids, ["document_id"]).withColumn("reuses", F.coalesce(F.size("reuse_ids"), F.lit(0)))
                rows = rows.withColumn("reuses", F.when(F.col("reuse_ids").isNull(), 0).otherwise(F.col("reuses")))
            else:
                rows = joins.overlap_counts(rows, reuse, ["document_id"], units[name], "fragment_id")
        out[name] = rows.join(documents, "document_id").join(totals, "document_id")
    return out


def work_level(parts: DataFrame, documents: DataFrame) -> DataFrame:
    """The level between document and part: parts (document_id, work, part, text) joined by blank lines."""
    works = levels.measured(levels.roll_up(parts, ["document_id", "work"], "part", "text", "\n\n"))
    return levels.with_offsets(works, "document_id", "work", F.length("text"), 2).join(documents, "document_id")


def number_or_zero(value: Column, kind: str, name: str) -> Column:
    """A number; 0 for a missing one. Anything else that isn't a number is an error, never a number."""
    read = value.try_cast(kind)
    wrong = F.raise_error(F.concat(F.lit(f"{name} isn't a number: "), value)).cast(kind)
    return F.when(value.isNull(), F.lit(0).cast(kind)).when(read.isNull(), wrong).otherwise(read)


def bibliographic(level: DataFrame, metadata: DataFrame, key: str = "estc_id") -> DataFrame:
    """A level's rows with the bibliographic table's columns (points in names made underscores), on the normalised identifier.

    Kinds go by column name. An empty cell, NA and an identifier that the table hasn't are 0 in number columns, "" in
    string columns, no entries in lists. Languages are what the language column says and those whose own column is TRUE.
    """
    flags = [c for c in metadata.columns if c.startswith("language.")]
    columns: list[Column] = [estc_id(F.col(f"`{key}`")).alias("_key")]
    missing: dict[str, Column] = {}
    for c in metadata.columns:
        value, name = none_if_blank(F.col(f"`{c}`")), c.replace(".", "_")
        if c == key or c == "language" or c in SKIPPED or c in flags:
            continue
        if c in INT_COLUMNS or c in FLOAT_COLUMNS:
            kind = "int" if c in INT_COLUMNS else "float"
            columns.append(number_or_zero(value, kind, c).alias(name))
            missing[name] = F.lit(0).cast(kind)
        elif c in LISTED:
            columns.append(F.coalesce(F.transform(F.split(value, ";"), lambda x: F.trim(x)), F.array().cast("array<string>")).alias(name))
            missing[name] = F.array().cast("array<string>")
        else:
            columns.append(F.coalesce(flag_of(value) if c == "obl" else value, F.lit("")).alias(name))
            missing[name] = F.lit("")
    said = [F.when(F.col(f"`{c}`") == "TRUE", F.lit(c.removeprefix("language."))) for c in flags]
    own = [none_if_blank(F.col("language"))] if "language" in metadata.columns else []
    columns.append(F.array_sort(F.array_distinct(F.array_compact(F.array(*own, *said).cast("array<string>")))).alias("estc_language"))
    missing["estc_language"] = F.array().cast("array<string>")
    joined = level.withColumn("_key", estc_id(F.col(key))).join(metadata.select(*columns).dropDuplicates(["_key"]), "_key", "left").drop("_key")
    return joined.withColumns({c: F.coalesce(c, v) for c, v in missing.items()})


def reuse_fragments(hits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hits (cluster, path, start, end, text) -> fragment rows with their cluster's count and mean length, and document -> fragment spans."""
    from quillstream.functions.scalars import reuse_document

    number, offset = reuse_document(F.col("path"))
    rows = hits.select(F.col("cluster").alias("fragment_id"), number.alias("document_id"), (F.col("start") + offset).alias("start"), (F.col("end") + offset).alias("end"), "text")
    by = rows.groupBy("fragment_id").agg(F.count(F.lit(1)).alias("count"), F.expr("sum(length(text)) div count(1)").alias("avg_length"))
    return levels.measured(rows.join(by, "fragment_id")), rows.select("document_id", "start", "end", "fragment_id")


def offset_store(payload: DataFrame, order: str | None = None) -> DataFrame:
    """(document_id, offset) -> page and box, one row each: the last that was put, by `order`; without an order the greatest (page, x, y, w, h)."""
    box = F.struct("page", "x", "y", "w", "h")
    return payload.groupBy("document_id", "offset").agg(F.max_by(box, F.struct(order, "page", "x", "y", "w", "h") if order else box).alias("box")).select("document_id", "offset", "box.*")


def by_ordinal(store: DataFrame, documents: DataFrame) -> DataFrame:
    """The offset store under the documents' ordinals in their sorted table."""
    return store.join(levels.global_numbers(documents, "document_id", "ordinal"), "document_id").drop("document_id")
