"""Shared helpers of the training-data operators: shared storage, table reading, crc32 hold-out."""

from __future__ import annotations

import atexit
import ctypes
import gc
import itertools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and every executor share, as the cluster names it in spark.checkpoint.dir.

    Only a single-machine session without that setting falls back to a temporary folder.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
    spark.conf.set("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="quillstream-"))
    return spark.conf.get("spark.checkpoint.dir")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; it is removed when the driver's Python ends."""
    path = f"{shared_dir(spark)}/quillstream/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def materialise(df: DataFrame, name: str, rows_per_file: int = 0) -> DataFrame:
    """Writes `df` as a Parquet table in the shared folder and reads it back: cuts lineage and survives lost executors."""
    path = work_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def right_sized(df: DataFrame, like: DataFrame, bytes_each: int = 8_000_000) -> DataFrame:
    """`df` in no more partitions than the bytes of `like` (by Catalyst's statistics, that is its files) warrant, two for each core at least.

    Small results aren't written as hundreds of files because a session deals its shuffles widely; large ones keep their partitions.
    """
    size = int(str(like._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.coalesce(min(1_000_000, max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-size // bytes_each))))  # an unknown size is a huge one


def discard(path: str, spark: SparkSession) -> None:
    """Deletes a path through Hadoop's file system."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            discard(path, spark)
        except Exception:  # noqa: BLE001  the session may have gone
            return


def trim_memory() -> None:
    """Gives a worker's freed memory back to the system: workers live on after a task, beside the executor's JVM."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


#: What operators keep in a worker from task to task; another operator's task there empties it first.
stores: dict[str, dict] = {}


def empty_stores(but: str | None) -> None:
    for name, kept in stores.items():
        if name != but:
            kept.clear()


def trimmed(run: Callable, store: str | None = None) -> Callable:
    """A map function over batches that gives its memory back when its task ends; it may keep what is in the store that it names."""

    def wrapped(batches: Iterator) -> Iterator:
        empty_stores(store)  # by its name: a copy of the dictionary would travel with this function
        try:
            yield from run(batches)
        finally:
            trim_memory()

    return wrapped


def trimmed_group(run: Callable) -> Callable:
    """The same for a function of one group's (or two cogroups') table."""

    def one(rows):
        empty_stores(None)
        try:
            return run(rows)
        finally:
            trim_memory()

    def two(left, right):
        empty_stores(None)
        try:
            return run(left, right)
        finally:
            trim_memory()

    return two if run.__code__.co_argcount == 2 else one


def pack(*columns: np.ndarray, text: bytes = b"", level: int = 1) -> bytes:
    """Integer columns of one length (byte by byte, so that equal high bytes compress), and a text."""
    import zstandard

    n = len(columns[0])
    body = b"".join(np.ascontiguousarray(c.astype("<i8")).view(np.uint8).reshape(n, 8).T.tobytes() for c in columns)
    return n.to_bytes(8, "little") + zstandard.ZstdCompressor(level=level).compress(body + text)


def unpack(part: bytes, columns: int) -> tuple[list[np.ndarray], bytes]:
    import zstandard

    n = int.from_bytes(part[:8], "little")
    body = zstandard.ZstdDecompressor().decompress(part[8:])
    out = [np.ascontiguousarray(np.frombuffer(body, np.uint8, 8 * n, 8 * n * i).reshape(8, n).T).view("<i8").ravel() for i in range(columns)]
    return out, body[8 * n * columns :]


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows one by one, for tables of few, large ones."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in batch.columns)


def grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Groups of neighbouring rows with equal first columns, read as they are asked for."""
    return itertools.groupby(rows_of(batches), key=lambda row: row[:keys])


def forget(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished steps."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; a small one, in fewer partitions than there are cores, is dealt out first."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows._jdf.queryExecution().toRdd().getNumPartitions() < cores else rows


def text_key(text: str | Column = "text") -> Column:
    """64-bit hash of a text; null and empty texts differ."""
    column = F.col(text) if isinstance(text, str) else text
    return F.xxhash64(column, column.isNull())


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id's decimal text, mod 3, is 1: such rows never train anything."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))
