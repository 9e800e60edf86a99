"""Folders for intermediate files: shared on a cluster, temporary on one machine, removed when the driver's Python ends."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_local: list[str] = []
_shared: list[tuple[SparkSession, str]] = []


def folder(spark: SparkSession, name: str) -> str:
    """A fresh path below spark.checkpoint.dir, which all executors share; only a local session without it uses a temporary folder."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        path = f"{shared.rstrip('/')}/quillstream-formats/{name}-{uuid.uuid4().hex}"
        _shared.append((spark, path))
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
    _local.append(tempfile.mkdtemp(prefix="quillstream-formats-"))
    return f"{_local[-1]}/{name}"


@atexit.register
def _clean() -> None:
    for path in _local:
        shutil.rmtree(path, ignore_errors=True)
    for spark, path in _shared:
        try:
            jvm = spark.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # noqa: BLE001  the session may have gone
            return


#: What may be broadcast, by the bytes of its files; in memory a table is some ten times as large.
BROADCAST_BYTES = 4_000_000
#: Rows that may be broadcast, of whatever size in files.
BROADCAST_ROWS = 200_000


def kept(df, name: str, by: str | None = None):
    """`df` written as a Parquet table in a scratch folder, a folder for each value of `by`, and read back: its lineage ends, and its size is known."""
    path = folder(df.sparkSession, name)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*kept_tables) -> None:
    """Removes the files of kept tables that nothing reads again."""
    for df in kept_tables:
        for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            jvm = df.sparkSession.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(file)
            where.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def file_bytes(df) -> int:
    """Bytes of the files that a table is read from."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small(df, name: str):
    """`df` kept, and with a merge hint unless its files and its rows show that it is small: equal rows are next to nothing in files, but not in memory."""
    from pyspark.sql import functions as F

    stored = kept(df, name)
    if file_bytes(stored) > BROADCAST_BYTES or stored.count() > BROADCAST_ROWS:
        return stored.hint("merge")
    return F.broadcast(stored)
