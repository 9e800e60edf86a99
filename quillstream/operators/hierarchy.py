"""Hierarchies of any depth by pointer jumping: each round, every row learns what its furthest known ancestor knows.

A chain of n rows takes log2(n) rounds instead of n, and each round is stored, so none is computed again. Rows that no round
leads to a root are on a cycle or below one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.sources import scratch


def jumped(rows: DataFrame, keys: list[str], rounds: int, path: bool, separator: str) -> DataFrame:
    """rows (keys, node, up, root, depth[, path]) after as many rounds as it takes, `rounds` at most; `up` is null at a root."""
    state, done = scratch.kept(rows, "hierarchy"), None
    for _ in range(rounds):
        going = state.where("up is not null")
        if going.isEmpty():
            break
        still = state.where("up is null")
        done = still if done is None else done.unionByName(still)
        known = done.unionByName(going).select(*keys, F.col("node").alias("up"), F.col("up").alias("next"), F.col("root").alias("top"), F.col("depth").alias("more"), *([F.col("path").alias("ahead")] if path else []))
        met = going.join(known, [*keys, "up"])
        added = [F.concat_ws(separator, "ahead", "path").alias("path")] if path else []
        state = scratch.kept(met.select(*keys, "node", F.col("next").alias("up"), F.col("top").alias("root"), (F.col("depth") + F.col("more")).alias("depth"), *added), "hierarchy")
    return state if done is None else done.unionByName(state)


def climbed(rows: DataFrame, node: str, parent: str, keys: Sequence[str] = (), label: str | None = None, separator: str = "_") -> DataFrame:
    """keys, node, root, depth, cyclic of a hierarchy's rows, and with a label path: the labels from the root down.

    A row whose parent is null or isn't there is a root, of depth 0. Rows on a cycle or below one are cyclic, and have no root,
    depth or path. A node that is named twice within its keys is an error, as it could have two parents; null nodes are left out.
    """
    keys = list(keys)
    given = rows.where(F.col(node).isNotNull()).select(*keys, F.col(node).alias("node"), F.col(parent).alias("parent"), *([F.col(label).alias("path")] if label else []))
    once = given.groupBy(*keys, "node").agg(F.count(F.lit(1)).alias("n"), F.first("parent").alias("parent"), *([F.first("path").alias("path")] if label else []))
    once = scratch.kept(once.where(F.assert_true(F.col("n") == 1, F.concat(F.lit("named twice: "), F.col("node").cast("string"))).isNull()).drop("n"), "nodes")
    there = once.select(*keys, F.col("node").alias("parent"), F.lit(True).alias("there"))
    known = once.join(there, [*keys, "parent"], "left").withColumn("up", F.when(F.col("there"), F.col("parent")))
    start = [*keys, "node", "up", F.coalesce("up", "node").alias("root"), F.col("up").isNotNull().cast("long").alias("depth")]
    rounds = once.count().bit_length() + 1
    climbs = jumped(known.select(*start), keys, rounds, False, separator)
    cyclic = F.col("up").isNotNull()
    found = climbs.select(*keys, "node", F.when(~cyclic, F.col("root")).alias("root"), F.when(~cyclic, F.col("depth")).alias("depth"), cyclic.alias("cyclic"))
    if label:
        sound = known.join(climbs.where(~cyclic).select(*keys, "node"), [*keys, "node"], "left_semi")
        paths = jumped(sound.select(*start, "path"), keys, rounds, True, separator)
        found = found.join(paths.select(*keys, "node", "path"), [*keys, "node"], "left")
    return found.withColumnRenamed("node", node)
