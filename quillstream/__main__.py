"""Programs: `python -m quillstream PROGRAM --files PATH … --to FOLDER` writes tables as Parquet: those of a format, or what an operator finds in tables."""

from __future__ import annotations

import argparse
import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.functions import text
from quillstream.operators import aggregates, alignment, dictionary, gibbs, languages, levels, search, tagging
from quillstream.plans import articles, books, media, scans, themes
from quillstream.plans import tei as tei_plan
from quillstream.sources import readers, sinks
from quillstream.streaming import levels as stream_levels


def contents(spark: SparkSession, paths: list[str], pattern: str) -> DataFrame:
    """path, content of the files below several folders."""
    read = lambda p: spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(p).select("path", "content")
    return reduce(DataFrame.unionByName, map(read, paths))


def tei(spark: SparkSession, o: argparse.Namespace) -> dict[str, DataFrame]:
    options = {"inline_notes": o.inline_notes, "emphases": not o.omit_emphases, "structure": not o.omit_structure, "core": o.only_core, "rehyphenate": o.rehyphenate}
    rows = tei_plan.convert_tei(contents(spark, o.files, "*.xml"), **options)
    return {"documents": rows.where("error is null").drop("error"), "errors": rows.where("error is not null").select("path", "error")}


def ocr(spark: SparkSession, o: argparse.Namespace) -> dict[str, DataFrame]:
    return scans.ocr_tables(contents(spark, o.files, "*.xml"))


def alto(spark: SparkSession, o: argparse.Namespace) -> dict[str, DataFrame]:
    files = contents(spark, o.files, "*.xml")
    pages = files.where(~F.col("path").rlike("(mets|metadata)[.]xml$")).select(F.regexp_extract("path", "([^/]*)/[^/]*$", 1).alias("issue"), F.coalesce(F.regexp_extract("path", r"_(\d+)[.]xml$", 1).try_cast("int"), F.lit(0)).alias("page"), "content")
    tables = scans.alto_tables(pages)
    return scans.materiality(tables, scans.mets_tables(files.where(F.col("path").endswith("mets.xml")))) | {"errors": tables["errors"]}


def tweets(spark: SparkSession, o: argparse.Namespace) -> dict[str, DataFrame]:
    read = lambda p: readers.read_json_objects(spark, p, media.TWEET)
    return {"tweets": media.tweets(reduce(DataFrame.unionByName, map(read, o.files)), skip=tuple(o.skip))}


def forum(spark: SparkSession, o: argparse.Namespace) -> dict[str, DataFrame]:
    return media.forum_levels(readers.vrt_rows(reduce(DataFrame.unionByName, [readers.read_lines(spark, p) for p in o.files])))


def reuse(spark: SparkSession, o: argparse.Namespace) -> dict[str, DataFrame]:
    rows, spans = books.reuse_fragments(reduce(DataFrame.unionByName, [readers.read_reuse_clusters(spark, p) for p in o.files]))
    return {"fragments": rows, "spans": spans}


def rows_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A table from Parquet, CSV with a header, or JSON lines, by its name's ending."""
    kind = "csv" if paths[0].endswith(".csv") else "json" if paths[0].endswith((".json", ".jsonl")) else "parquet"
    return getattr(spark.read.option("header", "true"), kind)(*paths) if kind != "json" else spark.read.json(paths)


def words(spark: SparkSession, o: argparse.Namespace) -> dict[str, DataFrame]:
    each = rows_of(spark, o.files).select(F.explode(text.letter_tokens(F.col(o.text))).alias("word"))
    return {"words": each.groupBy("word").agg(F.count(F.lit(1)).alias("n"))}


def index(spark: SparkSession, o: argparse.Namespace) -> dict[str, DataFrame]:
    search.build(rows_of(spark, o.files), o.key, o.text, f"{o.to}/index")
    return {}


def phrases(spark: SparkSession, o: argparse.Namespace) -> dict[str, DataFrame]:
    """--files: an index; --other: a table of queries (key, text)."""
    asked = rows_of(spark, [o.other]).select(F.col(o.key).alias("query"), F.filter(text.default_analyzer(F.col(o.text)), lambda t: t != "").alias("terms"))
    found = search.load(spark, o.files[0])
    return {"hits": search.phrases(found, asked) if o.within is None else search.near(found, asked, o.within)}


def align(spark: SparkSession, o: argparse.Namespace) -> dict[str, DataFrame]:
    """--files: rows (key, text); --other: pages (key, page)."""
    return {"aligned": alignment.align_rows(rows_of(spark, o.files), rows_of(spark, [o.other]), [o.key], o.text, "page").drop("page")}


def tag(spark: SparkSession, o: argparse.Namespace) -> dict[str, DataFrame]:
    """--other: names (name, kind)."""
    return {"tokens": tagging.tag_names(rows_of(spark, o.files), rows_of(spark, [o.other]), o.key, o.text)}


def links(spark: SparkSession, o: argparse.Namespace) -> dict[str, DataFrame]:
    """--other: titles (title, url)."""
    return {"texts": dictionary.link_titles(rows_of(spark, o.files), rows_of(spark, [o.other]), o.key, o.text)}


def topics(spark: SparkSession, o: argparse.Namespace) -> dict[str, DataFrame]:
    model = gibbs.sample(gibbs.terms(rows_of(spark, o.files), o.key, o.text, [], 2), topics=o.topics, rounds=o.rounds)
    return {"words": gibbs.top_words(model), "documents": gibbs.document_topics(model)}


def language(spark: SparkSession, o: argparse.Namespace) -> dict[str, DataFrame]:
    """--other: texts with their language (lang, text)."""
    scored = languages.ensemble(rows_of(spark, o.files), rows_of(spark, [o.other]).withColumnRenamed("text", o.text), o.key, o.text)
    return {"scores": scored, "languages": aggregates.best_language(scored.select(o.key, "lang", "score"), o.key, detectors=1)}


def report(spark: SparkSession, o: argparse.Namespace) -> dict[str, DataFrame]:
    """--files: themes (theme, parent, title); --other: items (theme, line)."""
    return {"pages": themes.nested_report(rows_of(spark, o.files), rows_of(spark, [o.other]))}


def arriving(spark: SparkSession, o: argparse.Namespace) -> dict[str, DataFrame]:
    """Lines of the texts in --files, a folder of Parquet; a further run reads what is new."""
    schema = spark.read.parquet(o.files[0]).schema
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    stream_levels.build(spark, o.files[0], shape, f"{o.to}/levels", o.key, lambda units: {"lines": levels.lines(units, o.key, o.text)})
    return {"lines": stream_levels.latest(spark, f"{o.to}/levels", "lines", o.key)}


def app_articles(spark: SparkSession, o: argparse.Namespace) -> dict[str, DataFrame]:
    read = lambda p: readers.read_json_objects(spark, p, articles.APP, "" if o.arrays else None)
    return articles.app_articles(reduce(DataFrame.unionByName, map(read, o.files)), o.site)


def broadcast_articles(spark: SparkSession, o: argparse.Namespace) -> dict[str, DataFrame]:
    read = lambda p: readers.read_json_objects(spark, p, articles.BROADCAST, "" if o.arrays else None)
    return articles.broadcast_articles(reduce(DataFrame.unionByName, map(read, o.files)))


def listed_articles(spark: SparkSession, o: argparse.Namespace) -> dict[str, DataFrame]:
    """--files: CSV lists; --other: the folder of the analyses."""
    listed = [readers.read_csv(spark, p, articles.LISTED) for p in o.files]
    files = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.analysis.json").text(o.other)
    root = spark._jvm.org.apache.hadoop.fs.Path(o.other)
    root = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(root).toString()
    parts = lambda path: F.split(F.regexp_replace(path, "^[^/]*:/*", ""), "/")  # noqa: E731  without the scheme
    depth = F.size(parts(F.lit(root)))
    below = F.array_join(F.slice(parts(F.col("_metadata.file_path")), depth + 1, F.size(parts(F.col("_metadata.file_path")))), "/")
    found, missing = articles.listed_articles(reduce(DataFrame.unionByName, [good for good, _ in listed]), files.select(below.alias("path"), F.col("value").alias("content")), o.site)
    return found | {"missing": missing, "errors": reduce(DataFrame.unionByName, [bad for _, bad in listed])}


PROGRAMS = {
    "tei": tei, "ocr": ocr, "alto": alto, "tweets": tweets, "forum": forum, "reuse": reuse, "words": words, "index": index, "phrases": phrases, "align": align, "tag": tag, "links": links,
    "topics": topics, "language": language, "report": report, "arriving": arriving, "app-articles": app_articles, "broadcast-articles": broadcast_articles, "listed-articles": listed_articles,
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quillstream", description=__doc__)
    programs = p.add_subparsers(dest="program", required=True)
    for name in PROGRAMS:
        one = programs.add_parser(name)
        one.add_argument("--files", nargs="+", required=True, help="folders or files")
        one.add_argument("--to", required=True, help="a folder for the tables")
        one.add_argument("--order", default="", help="columns that tables are clustered by, where they have them")
        one.add_argument("--key", default="id", help="the column that names a row")
        one.add_argument("--text", default="text", help="the column of texts")
        one.add_argument("--other", help="a second table, where a program takes one")
        if name == "phrases":
            one.add_argument("--within", type=int, help="positions that a query's words may stand apart; without it they are a phrase")
        if name == "topics":
            one.add_argument("--topics", type=int, default=500)
            one.add_argument("--rounds", type=int, default=400, help="rounds of five sweeps")
        if name == "tei":
            for flag in ("--inline-notes", "--omit-emphases", "--omit-structure", "--only-core", "--rehyphenate"):
                one.add_argument(flag, action="store_true")
        if name.endswith("-articles"):
            one.add_argument("--site", default="", help="what an article's address begins with")
            one.add_argument("--arrays", action="store_true", help="files hold one object or array over several lines each, not an object a line")
        if name == "tweets":
            one.add_argument("--skip", nargs="*", default=[], choices=["retweet", "quoted", "reply", "tweet"])
    return p


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    o = parser().parse_args(arguments)
    spark = spark or SparkSession.builder.appName(f"quillstream {o.program}").getOrCreate()
    for name, rows in PROGRAMS[o.program](spark, o).items():
        order = [c for c in o.order.split(",") if c in rows.columns]
        if order:
            sinks.write_level(rows, f"{o.to}/{name}", order)
        else:
            rows.write.mode("overwrite").parquet(f"{o.to}/{name}")


if __name__ == "__main__":
    main(sys.argv[1:])
