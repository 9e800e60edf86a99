"""A global order over partitions: rows are dealt by ranges of a full key and sorted within each partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Input bytes for each partition, and the most partitions: what is kept for each of them is bounded by the latter.
PART_BYTES, MOST_PARTS = 8_000_000, 50_000
#: Rows with equal keys are told apart by so many numbers, so that even one key that a third of the rows have is split.
SALTS = 65_536


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many underscores before them as it takes not to clash with the columns of `df`."""
    taken, lead = {c.lower() for c in df.columns}, "_"
    while any(f"{lead}{n}".lower() in taken for n in names):
        lead += "_"
    return [f"{lead}{n}" for n in names]


def parts_of(df: DataFrame, bytes_each: int = PART_BYTES) -> int:
    """Partitions for `df` by the size of its files; two for each core at least."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return min(MOST_PARTS, max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-size // bytes_each)))


def ranged(df: DataFrame, keys: Sequence[Column], at: str, parts: int) -> DataFrame:
    """`df` in the order of `keys`: partition by partition, and sorted in each; `at` is 2**33 times the partition plus the place in it.

    Rows of equal keys are split by their place in the input, so `df` has to be a table or a plan without an exchange
    before: then a task that runs again deals its rows as it did.
    """
    (salt,) = fresh(df, "salt")
    dealt = df.withColumn(salt, (F.monotonically_increasing_id() % SALTS).cast("int")).repartitionByRange(parts, *keys, F.col(salt))
    return dealt.sortWithinPartitions(*keys, F.col(salt)).drop(salt).withColumn(at, F.monotonically_increasing_id())


def part_of(at: str) -> Column:
    return F.shiftright(F.col(at), 33).cast("int")


def place_of(at: str) -> Column:
    return F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
