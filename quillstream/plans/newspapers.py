"""Newspapers and news feeds: issue, article, paragraph and sentence tables; feed records to metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.functions.python import feed_items
from quillstream.functions.scalars import confidence_number, date_bounds, iso_date_number
from quillstream.operators import levels
from quillstream.sources import scratch

#: The mark between an article's paragraphs, and between an issue's articles.
PARAGRAPH_MARK = "\n\n"


def issue_dates(start: Column, end: Column) -> tuple[Column, Column]:
    """First and last number of an issue's date: the end is the start's, unless one is given."""
    a, b = date_bounds(start)
    return a, F.when(F.coalesce(end, F.lit("")) == "", b).otherwise(date_bounds(end)[1])


def newspaper_levels(paragraphs: DataFrame, articles: DataFrame, issues: DataFrame, with_sentences: bool = True) -> dict[str, DataFrame]:
    """paragraphs: issue_id, article_id, paragraph, text. articles: issue_id, article_id, place, page_ids, illustrations, language, confidences (strings). issues: issue_id and what all levels inherit.

    Counts go up from each level to the next; an article's confidence is the integer mean of what was observed, 0 if
    nothing was. Spans are in the issue's text.
    """
    order = Window.partitionBy("issue_id").orderBy("place", "paragraph")
    placed = paragraphs.join(articles.select("issue_id", "article_id", "place"), ["issue_id", "article_id"])
    start = F.coalesce(F.sum(F.length("text") + len(PARAGRAPH_MARK)).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = placed.withColumn("start_offset", start).withColumn("end_offset", F.col("start_offset") + F.length("text"))
    key = ["issue_id", "article_id"]
    out: dict[str, DataFrame] = {}
    n_sentences = rows.select(*key, "paragraph", F.lit(0).alias("sentences"))
    if with_sentences:
        sentences = levels.sentences(rows.select(*key, "paragraph", "text", "start_offset"), [*key, "paragraph"], start="start_offset").withColumnRenamed("sentence_text", "text")
        n_sentences = sentences.groupBy(*key, "paragraph").agg(F.count(F.lit(1)).alias("sentences"))
        out["sentence"] = levels.measured(sentences)
    rows = rows.join(n_sentences, [*key, "paragraph"], "left").withColumn("sentences", F.coalesce("sentences", F.lit(0)))
    out["paragraph"] = levels.measured(rows.drop("place"))
    observed = F.filter(F.transform("confidences", lambda c: confidence_number(c)), lambda c: c.isNotNull())
    facts = articles.withColumn("ocr_confidence", F.when(F.size(observed) > 0, F.expr("1") * F.floor(F.aggregate(observed, F.lit(0), lambda a, x: a + x) / F.size(observed))).otherwise(0).cast("int")).drop("confidences")
    counts = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("paragraphs"), F.sum("sentences").alias("sentences"), F.min("start_offset").alias("start_offset"), F.max("end_offset").alias("end_offset"))
    article = levels.roll_up(rows, key, "paragraph", "text", PARAGRAPH_MARK).join(counts, key).join(facts, key).withColumn("pages", F.size("page_ids"))
    out["article"] = levels.measured(article)
    up = article.groupBy("issue_id").agg(
        F.count(F.lit(1)).alias("articles"), F.sum("paragraphs").alias("paragraphs"), F.sum("sentences").alias("sentences"), F.sum("illustrations").alias("illustrations"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("page_ids")))).alias("page_ids"), F.array_sort(F.collect_set("language")).alias("languages"),
    )
    out["issue"] = levels.measured(levels.roll_up(article, ["issue_id"], "place", "text", PARAGRAPH_MARK).join(up, "issue_id").withColumn("pages", F.size("page_ids")))
    return {k: v.join(issues, "issue_id") for k, v in out.items()}


def in_years(rows: DataFrame, first: int | None, last: int | None) -> DataFrame:
    """Rows whose dates (date_start, date_end as yyyymmdd) touch the years."""
    if first is not None:
        rows = rows.where(F.col("date_end") >= first * 10000)
    if last is not None:
        rows = rows.where(F.col("date_start") <= last * 10000 + 9999)
    return rows


def feed_records(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """XML news items (id, record) -> article metadata, and (article_id, subject) rows.

    Subjects with the prefixes of departments and versions are columns; of dates that stand twice the later one that
    isn't empty counts. A record is parsed once for all of its fields and both tables.
    """
    last = lambda name: F.try_element_at(F.filter(f"r.{name}", lambda v: v != ""), F.lit(-1))
    first = lambda a: F.get(a, F.lit(0))
    of = lambda prefix: F.transform(F.filter("r.codes", lambda c: c.startswith(prefix)), lambda c: F.regexp_replace(c, "^[^:]*:", ""))
    rows = records.select(F.col("id").alias("article_id"), feed_items("record").alias("r")).select(
        "article_id", first(of("sttdepartment:")).alias("department"), first(of("sttversion:")).alias("version"), first(of("sttgenre:")).alias("genre"), last("contentCreated").alias("time_published"),
        last("contentModified").alias("time_modified"), first("r.headline").alias("headline"), first("r.creditline").alias("creditline"), first("r.by").alias("byline"), first("r.urgency").try_cast("int").alias("urgency"),
        F.filter("r.codes", lambda c: ~c.startswith("sttdepartment:") & ~c.startswith("sttversion:") & ~c.startswith("sttgenre:")).alias("_subjects"),
    )
    parsed = scratch.kept(rows, "feed")
    return parsed.drop("_subjects"), parsed.select("article_id", F.explode("_subjects").alias("subject"))


def library_articles(records: DataFrame) -> DataFrame:
    """Library records (record XML) -> identifier, title, newspaper, date as a number."""
    one = lambda p: F.nullif(F.xpath_string("record", F.lit(p)), F.lit(""))
    return records.select(one("//*[local-name()='identifier'][1]").alias("issue_id"), one("//*[local-name()='title'][1]").alias("newspaper"), iso_date_number(one("//*[local-name()='date'][1]")).alias("date"))
