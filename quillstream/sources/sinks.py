"""Sinks: level tables, text units, CSV, JSON, triples, sharded folders."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.functions.scalars import attributes_text, escape_xml


def write_level(rows: DataFrame, path: str, order: list[str], append: bool = False, partitions: int | None = None) -> None:
    """A level's table, clustered by `order`: range partitions, sorted within."""
    dealt = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).write.mode("append" if append else "overwrite").parquet(path)


def compact(spark: SparkSession, path: str, to: str, order: list[str], files: int) -> None:
    """The level's table at `path` rewritten as few files, in order, at `to`."""
    spark.read.parquet(path).repartitionByRange(files, *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(to)


def write_bucketed(rows: DataFrame, table: str, key: str, order: str, buckets: int, path: str | None = None) -> None:
    """A key-value store: a table bucketed by key and sorted within, so that joins on the key don't shuffle it. path: where its files are, else the warehouse."""
    writer = rows.write.mode("overwrite").bucketBy(buckets, key).sortBy(key, order)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def write_text_units(rows: DataFrame, path: str, unit: str, text: str) -> None:
    """One folder of text for each unit."""
    rows.select(unit, F.col(text).alias("value")).write.mode("overwrite").partitionBy(unit).text(path)


def write_csv(rows: DataFrame, path: str, header: bool = True, escape: str = '"') -> None:
    rows.write.mode("overwrite").option("header", header).option("escape", escape).csv(path)


def write_json(rows: DataFrame, path: str, compression: str = "none") -> None:
    rows.write.mode("overwrite").json(path, compression=compression)


def write_pretty_json(rows: DataFrame, path: str, key: str) -> None:
    """One folder for each key with its rows' other columns as indented JSON objects: for analyses that people read.

    Tasks write the files themselves, through Arrow's file systems and under names that a repeated task writes again: Spark's
    writer has a file's rights set by a process of its own, and its commit moves the folders one by one on the driver.
    """
    rest = F.struct(*[F.col(c) for c in rows.columns if c != key])
    objects = rows.select(F.col(key).cast("string").alias("key"), F.to_json(rest, {"pretty": "true"}).alias("value"))
    files = objects.groupBy("key").agg(F.array_join(F.sort_array(F.collect_list("value")), "\n").alias("value"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(path)
        for batch in batches:
            for k, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                folder = f"{base}/{key}={folder_name(k)}"
                store.create_dir(folder)
                with store.open_output_stream(f"{folder}/part.txt") as out:
                    out.write(f"{v}\n".encode())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    parts = max(rows.sparkSession.sparkContext.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    files.repartition(parts).mapInArrow(write, "n long").agg(F.sum("n")).collect()


def folder_name(value: str | None) -> str:
    """A key as Spark names its folder: special characters by their numbers, nothing by a name of its own."""
    return "__HIVE_DEFAULT_PARTITION__" if not value else re.sub(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]", lambda m: f"%{ord(m[0]):02X}", value)


def triples(rows: DataFrame, subject: Column, pairs: list[tuple[str, Column]]) -> DataFrame:
    """N-Triples lines: for each row and (predicate, value) one line; null values give none."""
    quoted = lambda v: F.concat(F.lit('"'), F.replace(F.replace(v.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    lines = F.array_compact(F.array(*[F.concat(F.lit("<"), subject, F.lit(f"> <{p}> "), quoted(v), F.lit(" .")) for p, v in pairs]))
    return rows.select(F.explode(lines).alias("value"))


def shard_columns(key: str) -> tuple[Column, Column]:
    """Two digits of the key's hash, for two levels of folders."""
    h = F.pmod(F.hash(F.col(key)), F.lit(100))
    return (h % 10).alias("shard_1"), F.floor(h / 10).cast("int").alias("shard_2")


def write_sharded(rows: DataFrame, path: str, key: str) -> None:
    a, b = shard_columns(key)
    rows.select("*", a, b).write.mode("overwrite").partitionBy("shard_1", "shard_2").parquet(path)


def write_by_first_letters(rows: DataFrame, path: str, key: str) -> None:
    letters = rows.withColumn("c1", F.substring(key, 1, 1)).withColumn("c2", F.substring(key, 2, 1))
    letters.write.mode("overwrite").partitionBy("c1", "c2").parquet(path)


def html_report(rows: DataFrame, title: str, heading: str, line: str, orphans: DataFrame | None = None) -> DataFrame:
    """One HTML page for each heading: its lines as a list, in order, and escaped. orphans (heading, line): lines that no heading has claimed, on their heading's page in a list of their own."""
    items = lambda c: F.array_join(F.transform(F.array_sort(F.collect_set(c)), lambda x: F.concat(F.lit("<li>"), escape_xml(x), F.lit("</li>"))), "")
    pages = rows.groupBy(heading).agg(items(line).alias("_listed"))
    if orphans is not None:
        pages = pages.join(orphans.groupBy(heading).agg(items(line).alias("_orphans")), heading, "full")
    else:
        pages = pages.withColumn("_orphans", F.lit(None).cast("string"))
    head = escape_xml(F.col(heading))
    first = F.concat(F.lit("<html><head><title>"), escape_xml(F.lit(title)), F.lit("</title></head><body><h1>"), head, F.lit("</h1><ul>"), F.coalesce("_listed", F.lit("")), F.lit("</ul>"))
    second = F.when(F.col("_orphans").isNotNull(), F.concat(F.lit("<h2>Without a place</h2><ul>"), "_orphans", F.lit("</ul>"))).otherwise("")
    return pages.select(heading, F.concat(first, second, F.lit("</body></html>")).alias("page"))


def metadata_xml(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, value: one element a unit with its metadata as attributes, <unit k='v' …/>; empty and missing values are left out."""
    entries = F.map_from_entries(F.array_compact(F.array(*[F.when(F.coalesce(F.col(f).cast("string"), F.lit("")) != "", F.struct(F.lit(f), F.replace(escape_xml(F.col(f).cast("string")), F.lit("'"), F.lit("&#39;")))) for f in fields])))
    return rows.select(key, F.concat(F.lit("<unit"), attributes_text(entries), F.lit("/>")).alias("value"))


def tagged_tokens(rows: DataFrame, path: str, token: str, tag: str) -> None:
    rows.select(token, tag).write.mode("overwrite").option("sep", "\t").option("quote", "").csv(path)
