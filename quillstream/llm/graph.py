"""Connected components of a distributed edge list, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.llm.common import materialise


ROWS_PER_FILE = 250_000


def _stars(pairs: DataFrame) -> DataFrame:
    """pairs (u, v): neighbours of each u -> u, v, least of u and its neighbours. Sums up before it shuffles; a hub's pairs are two longs each, which the adaptive join splits among tasks."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return pairs.join(least, "u")


def connected_components(edges: DataFrame) -> DataFrame:
    """id, component (the smallest id reachable) of every id that `edges` (a, b) connects to a smaller one.

    Each round rewrites the edges and stores them in the shared folder; the driver only sees a count and a checksum.
    Rounds grow with the logarithm of the number of ids, whatever the components' shapes. Repeated edges, loops and
    edges with a null end say nothing; without edges the result is empty.
    """
    e = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = materialise(e, "edges")
    was = (e.count(), None)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        s = _stars(large)
        small = s.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(s.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        e = materialise(small.coalesce(1 + was[0] // ROWS_PER_FILE), "edges")  # contraction doesn't add edges
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == was:
            return e.select(F.col("u").alias("id"), F.col("v").alias("component"))
        was = now
