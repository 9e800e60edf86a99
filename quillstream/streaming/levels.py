"""Levels built as input files arrive: each run reads what is new, and a batch that is run again changes nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UNITS = "units"


def build(spark: SparkSession, source: str, schema: str, to: str, key: str, plan: Callable[[DataFrame], dict[str, DataFrame]], files: str = "parquet", files_each: int = 1000) -> int:
    """Builds the levels of all files in `source` that no earlier run has read, below `to`; the number of batches done so far.

    plan: from the units of a batch (rows of `schema`, named by `key`) to its levels. Each batch's levels are folders of their own
    that are written anew if the batch is repeated; what has been read is in `to`/_progress. A unit that comes again replaces
    all its rows. Rows without a key are left out.
    """

    def one(batch: DataFrame, number: int) -> None:
        units = batch.where(F.col(key).isNotNull())
        for name, rows in plan(units).items():
            rows.write.mode("overwrite").parquet(f"{to}/{name}/batch={number}")
        units.select(key).distinct().write.mode("overwrite").parquet(f"{to}/{UNITS}/batch={number}")  # last: a batch counts when it is whole

    read = spark.readStream.schema(schema).format(files).option("maxFilesPerTrigger", files_each).load(source)
    query = read.writeStream.foreachBatch(one).option("checkpointLocation", f"{to}/_progress").trigger(availableNow=True).start()
    query.awaitTermination()
    return int(query.lastProgress["batchId"]) + 1 if query.lastProgress else 0


def latest(spark: SparkSession, to: str, level: str, key: str) -> DataFrame:
    """A level's rows, for each unit those of the last batch that had it."""
    last = spark.read.parquet(f"{to}/{UNITS}").groupBy(key).agg(F.max("batch").alias("batch"))
    return spark.read.parquet(f"{to}/{level}").join(last, [key, "batch"]).drop("batch")
