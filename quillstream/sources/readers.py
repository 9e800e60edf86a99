"""Sources: files, CSV dialects, JSON, XML, annotated text. Schemas are given, never inferred."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstream.functions.python import parse_xml


def list_files(spark: SparkSession, path: str, pattern: str | None = None, contains: str | None = None, exclude: str | None = None) -> DataFrame:
    """path, name, size of every file below a folder, by path. Names are tested before anything is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        files = files.option("pathGlobFilter", pattern)
    found = files.load(path).select("path", F.regexp_extract("path", "([^/]*)$", 1).alias("name"), F.col("length").alias("size"))
    if contains:
        found = found.where(F.contains("name", F.lit(contains)))
    if exclude:
        found = found.where(~F.contains("name", F.lit(exclude)))
    return found.orderBy("path")


def total_bytes(spark: SparkSession, path: str) -> DataFrame:
    return list_files(spark, path).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("files"))


def read_collections(spark: SparkSession, arguments: list[str], read) -> DataFrame:
    """Rows of several path:collection arguments (a + after the path sets guess_paragraphs), each with its constants."""
    parts = []
    for a in arguments:
        path, _, collection = a.rpartition(":")  # a path may have a scheme
        guess = path.endswith("+")
        parts.append(read(spark, path.removesuffix("+")).withColumn("collection_id", F.lit(collection)).withColumn("guess_paragraphs", F.lit(guess)))
    return reduce(DataFrame.unionByName, parts)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """path, line_no (from 0), line of whole text files."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    return whole.select("path", F.posexplode(F.split(F.regexp_replace("value", "\n$", ""), "\n")).alias("line_no", "line"))


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = False, escape: str | None = '"', quarantine: bool = True, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """(good rows, rows that don't fit the schema with what was read of them and their raw text in _corrupt). escape None: nothing escapes."""
    fields = T.StructType.fromDDL(schema)
    full = T.StructType([*fields.fields, T.StructField("_corrupt", T.StringType())])
    rows = (
        spark.read.schema(full).option("header", header).option("sep", sep).option("escape", escape if escape else "\x00").option("multiLine", "true")
        .option("mode", "PERMISSIVE" if quarantine else "FAILFAST").option("columnNameOfCorruptRecord", "_corrupt").csv(path)
    )
    # a row is judged by all of its columns, also where only some are asked for: this reads them all and is always true
    rows = rows.where(F.length(F.concat_ws("", *[F.col(f"`{f.name}`").cast("string") for f in fields])) >= 0)
    return rows.where(F.col("_corrupt").isNull()).drop("_corrupt"), rows.where(F.col("_corrupt").isNotNull())


def read_keyed_lines(spark: SparkSession, path: str) -> DataFrame:
    """key, record of lines (gzip too): what stands before the first tab, and after it. Gzip can't be split, so rows are dealt anew."""
    lines = spark.read.text(path)
    return lines.select(F.regexp_extract("value", "^([^\t]*)", 1).alias("key"), F.regexp_replace("value", "^[^\t]*\t", "").alias("record")).repartition(spark.sparkContext.defaultParallelism)


def read_json_objects(spark: SparkSession, path: str, schema: str, within: str | None = None) -> DataFrame:
    """Objects of JSON lines; within: of the array of that name in one document, "" for a top-level array."""
    if within is None:
        return spark.read.schema(schema).json(path)
    if not within:
        return spark.read.schema(schema).option("multiLine", "true").json(path)
    wrapped = spark.read.schema(f"{within} array<struct<{as_struct(schema)}>>").option("multiLine", "true").json(path)
    return wrapped.select(F.explode(within).alias("o")).select("o.*")


def as_struct(schema: str) -> str:
    """A DDL schema's columns as a struct's fields."""
    return ",".join(f"{name}:{kind}" for name, kind in (part.strip().split(" ", 1) for part in split_outside(schema)))


def split_outside(schema: str) -> list[str]:
    parts, depth, now = [], 0, ""
    for c in schema:
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            parts.append(now)
            now = ""
        else:
            now += c
    return [*parts, now]


def reuse_hits(objects: DataFrame) -> DataFrame:
    """cluster, path, start, end, text of {"cluster_…": {"hits" or "Hits": [...]}} objects (value); either name, without a look into the texts."""
    hit = "array<struct<doc_id:string,original_indices:array<int>,encoded_indices:array<int>,text:string>>"
    entries = objects.select(F.explode(F.from_json("value", "map<string,string>")).alias("cluster", "body"))
    found = lambda name: F.from_json("body", f"struct<{name}:{hit}>")[name]
    hits = entries.select("cluster", F.explode(F.coalesce(found("hits"), found("Hits"))).alias("h"))
    return hits.select(F.regexp_replace("cluster", "^cluster_", "").alias("cluster"), F.col("h.doc_id").alias("path"), F.get("h.original_indices", F.lit(0)).alias("start"), F.get("h.original_indices", F.lit(1)).alias("end"), "h.text")


def read_reuse_clusters(spark: SparkSession, path: str) -> DataFrame:
    """Hits of files that are one object each."""
    return reuse_hits(spark.read.text(path, wholetext=True))


def read_reuse_lines(spark: SparkSession, path: str) -> DataFrame:
    """Hits of files with an object on each line, which can be split among tasks."""
    return reuse_hits(spark.read.text(path))


def read_xml_events(spark: SparkSession, path: str, pattern: str = "*.xml") -> DataFrame:
    """path, event_no, kind, name, attributes, text, error of XML files with mixed content; a file that fails is one row with its error."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    parsed = files.select("path", parse_xml("content").alias("p"))
    events = parsed.select("path", F.posexplode_outer("p.events").alias("event_no", "e"), F.col("p.error").alias("error"))
    return events.select("path", "event_no", "e.kind", "e.name", "e.attributes", "e.text", "error")


def read_entity_declarations(spark: SparkSession, path: str) -> DataFrame:
    """name, value of <!ENTITY name "value"> lines."""
    pattern = r'<!ENTITY\s+(\S+)\s+(?:CDATA\s+)?"([^"]*)"'
    return spark.read.text(path).select(F.regexp_extract("value", pattern, 1).alias("name"), F.regexp_extract("value", pattern, 2).alias("value")).where("name != ''")


def vrt_rows(lines: DataFrame) -> DataFrame:
    """Verticalised text, from (path, line_no, line): token lines with the numbers of their thread, post, paragraph and sentence, and their post's tag.

    A <text> line begins a post; it begins a thread if its tid differs from the post's before.
    """
    order = Window.partitionBy("path").orderBy("line_no")
    tag = lambda n: F.col("line").startswith(f"<{n}")
    is_text = F.col("line").rlike("^<text[ >]")
    tid = F.regexp_extract("line", 'tid="([^"]*)"', 1)
    rows = lines.withColumn("tag", F.when(is_text, F.col("line"))).withColumn("tid", F.when(is_text, tid))
    rows = rows.withColumn("tid_before", F.last("tid", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    number = lambda c: F.sum(F.when(c, 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumns({
        "thread": number(is_text & ~F.col("tid").eqNullSafe(F.col("tid_before"))), "post": number(is_text), "paragraph": number(tag("paragraph")), "sentence": number(tag("sentence")),
        "post_tag": F.last("tag", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)),
    })
    return rows.where(~F.col("line").startswith("<") & (F.col("line") != "")).select("path", "line_no", "thread", "post", "paragraph", "sentence", "post_tag", "line")


def not_yet_done(inputs: DataFrame, done: DataFrame, key: str = "path") -> DataFrame:
    """Inputs that a manifest doesn't list."""
    return inputs.join(done.select(key).distinct(), key, "left_anti")


def file_group(path: Column, pattern: str) -> Column:
    """Key that sibling files share: a pattern's first group in the file's name."""
    return F.regexp_extract(F.regexp_extract(path, "([^/]*)$", 1), pattern, 1)
