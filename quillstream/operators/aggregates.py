"""Aggregates: correlations, weighted modes and medians, multimaps, frequency tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.sources import scratch


#: Pieces that a group's value range is cut into before its values are numbered.
PIECES = 64


def counts_before(counted: DataFrame, keys: list[str], value: str, n: str, name: str) -> DataFrame:
    """counted (keys, value, n) with the sum of n over smaller values of the same keys.

    A group's values are cut at approximate quantiles, summed up for each piece, and ordered within pieces only: no
    group is sorted by one task, however many different values it has.
    """
    counted = scratch.kept(counted, "counted")
    cuts = counted.groupBy(*keys).agg(F.percentile_approx(value, [i / PIECES for i in range(1, PIECES)], 10_000).alias("_cuts"))  # a row of PIECES numbers for each group
    placed = counted.join(scratch.small(cuts, "cuts"), keys).withColumn("_piece", F.size(F.filter("_cuts", lambda c: c < F.col(value)))).drop("_cuts")
    before = lambda w: F.coalesce(F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = placed.groupBy(*keys, "_piece").agg(F.sum(n).alias(n)).withColumn("_off", before(Window.partitionBy(*keys).orderBy("_piece"))).drop(n)
    inner = placed.withColumn(name, before(Window.partitionBy(*keys, "_piece").orderBy(value)))
    return inner.join(scratch.small(pieces, "pieces"), [*keys, "_piece"]).withColumn(name, F.col(name) + F.col("_off")).drop("_piece", "_off")


def average_ranks(counted: DataFrame, keys: list[str], value: str, name: str, n: str = "_n") -> DataFrame:
    """Ranks of values within keys, ties at their mean, of rows that stand for n rows each."""
    of = counts_before(counted.groupBy(*keys, value).agg(F.sum(n).alias("_m")), keys, value, "_m", "_before")
    return counted.join(of.select(*keys, value, (F.col("_before") + (F.col("_m") + 1) / 2).alias(name)), [*keys, value])


def correlations(rows: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """keys, n, pearson, spearman; null where there are fewer than two rows or no spread. Equal pairs are counted first, so only different ones meet their ranks."""
    pairs = scratch.kept(rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*keys, x, y).agg(F.count(F.lit(1)).alias("_n")), "pairs")
    both = average_ranks(average_ranks(pairs, keys, x, "_rx"), keys, y, "_ry")
    plain = lambda c: F.col(c).cast("double")
    middle = both.groupBy(*keys).agg(F.sum("_n").alias("n"), *[(F.sum(F.col("_n") * plain(c)) / F.sum("_n")).alias(f"_m{i}") for i, c in enumerate((x, y, "_rx", "_ry"))])
    off = both.join(middle, keys)
    d = [plain(c) - F.col(f"_m{i}") for i, c in enumerate((x, y, "_rx", "_ry"))]
    summed = lambda a, b: F.sum(F.col("_n") * a * b)
    of = lambda a, b: F.when(F.first("n") > 1, F.try_divide(summed(a, b), F.sqrt(summed(a, a) * summed(b, b))))
    return off.groupBy(*keys).agg(F.first("n").alias("n"), of(d[0], d[1]).alias("pearson"), of(d[2], d[3]).alias("spearman"))


def kendall_binary(rows: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """keys, n, kendall (tau-b) for an x of 0 and 1: pairs follow from counts for each y, so no pair is formed."""
    counted = rows.groupBy(*keys, y).agg(F.sum(F.when(F.col(x) == 0, 1).otherwise(0)).alias("_a"), F.sum(F.when(F.col(x) == 1, 1).otherwise(0)).alias("_b"))
    counted = counts_before(counts_before(counted, keys, y, "_a", "_a_below"), keys, y, "_b", "_b_below")
    paired = counted.withColumn("_s", F.col("_b") * F.col("_a_below") - F.col("_a") * F.col("_b_below"))
    m = F.col("_a") + F.col("_b")
    summed = paired.groupBy(*keys).agg(F.sum("_s").alias("_s"), F.sum("_a").alias("_a"), F.sum("_b").alias("_b"), F.sum(m * (m - 1) / 2).alias("_ty"))
    n = F.col("_a") + F.col("_b")
    pairs = n * (n - 1) / 2
    bottom = F.sqrt(F.col("_a") * F.col("_b") * (pairs - F.col("_ty")))
    return summed.select(*keys, n.alias("n"), F.when(bottom > 0, F.col("_s") / bottom).alias("kendall"))


def concordance(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> float:
    """Concordant less discordant pairs of points that stand for n rows each.

    Two different values of x, as ranks, first differ in one bit: there one is on the left of a block and the other on its
    right. For each bit the points are sorted by block and y, and running sums over the left ones tell how many each right one
    has below and above it. Ties in x or y count for neither.
    """
    if not len(x):
        return 0.0
    rx, ry = np.unique(x, return_inverse=True)[1].astype(np.int64), np.unique(y, return_inverse=True)[1].astype(np.int64)
    wide, score = int(ry.max()) + 1, np.longdouble(0)
    for bit in range(int(rx.max()).bit_length()):
        block = rx >> (bit + 1)
        order = np.argsort(block * wide + ry, kind="stable")
        b, side, w = block[order], (rx[order] >> bit) & 1, n[order]
        key = b * wide + ry[order]
        left = np.concatenate(([0], np.cumsum(np.where(side == 0, w, 0))))
        first = lambda k: np.concatenate(([0], np.flatnonzero(np.diff(k)) + 1))
        runs, blocks = first(key), first(b)
        length = lambda starts: np.diff(np.concatenate((starts, [len(key)])))
        spread = lambda values, starts: np.repeat(values, length(starts))
        base, end = spread(left[blocks], blocks), spread(left[np.concatenate((blocks[1:], [len(key)]))], blocks)
        below, upto = spread(left[runs], runs), spread(left[np.concatenate((runs[1:], [len(key)]))], runs)
        right = side == 1
        score += np.dot(w[right].astype(np.longdouble), ((below - base) - (end - upto))[right].astype(np.longdouble))
    return float(score)


#: Different pairs of values in a piece; the most pieces that a column is cut into.
PAIRS_EACH, MOST_PIECES = 200_000, 2_000


def kendall(rows: DataFrame, keys: list[str], x: str, y: str, pieces: int | None = None) -> DataFrame:
    """keys, n, kendall (tau-b) of any two numbers; null where there is no spread. Rows with a null are left out.

    Equal rows are counted first. Both columns are cut at approximate quantiles, a value that is a cut being a piece of its own.
    Pairs of points in one piece of x are counted there, those in different pieces of x but one of y in the latter, and
    all others by the numbers of points in the pieces: no task has more than a piece, or the table of pieces, whatever
    the sizes of the groups and of ties.
    """
    counted = scratch.kept(rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*keys, F.col(x).alias("_x"), F.col(y).alias("_y")).agg(F.count(F.lit(1)).alias("_n")), "pairs")
    n_pieces = pieces or min(MOST_PIECES, max(8, -(-counted.count() // PAIRS_EACH)))
    at = [i / n_pieces for i in range(1, n_pieces)]
    cuts = counted.groupBy(*keys).agg(*[F.array_distinct(F.percentile_approx(c, at, 100_000)).alias(f"{c}_cuts") for c in ("_x", "_y")])
    met = counted.join(scratch.small(cuts, "cuts"), keys)
    place = lambda c: 2 * F.size(F.filter(f"{c}_cuts", lambda v: v < F.col(c))) + F.array_contains(F.col(f"{c}_cuts"), F.col(c)).cast("int")
    placed = scratch.kept(met.select(*keys, "_x", "_y", "_n", place("_x").alias("_px"), place("_y").alias("_py")), "placed")
    row = lambda kind, piece, a, b: [*keys, F.lit(kind).alias("_kind"), piece.cast("int").alias("_piece"), F.col(a).cast("double").alias("_a"), F.col(b).cast("double").alias("_b")]
    within = placed.where("_px % 2 = 0").select(*row(0, F.col("_px"), "_x", "_y"), "_n")  # other pieces are one value
    beside = placed.where("_py % 2 = 0").groupBy(*row(1, F.col("_py"), "_px", "_y")).agg(F.sum("_n").alias("_n"))
    across = placed.groupBy(*row(2, F.lit(0), "_px", "_py")).agg(F.sum("_n").alias("_n"))

    def one(p: pd.DataFrame) -> pd.DataFrame:
        out = p[keys].head(1).copy()
        out["s"] = concordance(p["_a"].to_numpy(), p["_b"].to_numpy(), p["_n"].to_numpy(np.int64))
        return out

    schema = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    scores = within.unionByName(beside).unionByName(across).groupBy(*keys, "_kind", "_piece").applyInPandas(one, f"{schema}, s double")
    tied = lambda c: placed.groupBy(*keys, c).agg(F.sum("_n").cast("double").alias("m")).groupBy(*keys).agg(F.sum(F.col("m") * (F.col("m") - 1) / 2).alias(f"t{c}"))
    total = placed.groupBy(*keys).agg(F.sum("_n").alias("n")).join(scores.groupBy(*keys).agg(F.sum("s").alias("s")), keys).join(tied("_x"), keys).join(tied("_y"), keys)
    pairs = F.col("n").cast("double") * (F.col("n") - 1) / 2
    bottom = F.sqrt(pairs - F.col("t_x")) * F.sqrt(pairs - F.col("t_y"))
    return total.select(*keys, "n", F.when(bottom > 0, F.col("s") / bottom).alias("kendall"))


def weighted_mode(rows: DataFrame, keys: list[str], value: str, weight: Column) -> DataFrame:
    """The value with the greatest weight; ties go to the smallest value."""
    summed = rows.groupBy(*keys, value).agg(F.sum(weight).alias("_w"))
    return summed.groupBy(*keys).agg(F.max_by(value, F.struct("_w", -F.col(value))).alias("mode"))


def upper_median(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Element n div 2 of the sorted values."""
    counted = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return weighted_cut(counted, keys, value, F.floor(F.col("_total") / 2) + 1, "median")


def weighted_median(rows: DataFrame, keys: list[str], value: str, weight: Column) -> DataFrame:
    """The first value at which the weight so far reaches half of the whole (integer half)."""
    return weighted_cut(rows.groupBy(*keys, value).agg(F.sum(weight).alias("_n")), keys, value, F.floor(F.col("_total") / 2), "median")


def weighted_cut(counted: DataFrame, keys: list[str], value: str, reach: Column, name: str) -> DataFrame:
    whole = counted.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    placed = counts_before(counted, keys, value, "_n", "_before").join(whole, keys).where(F.col("_before") + F.col("_n") >= reach)
    return placed.groupBy(*keys).agg(F.min(value).alias(name))


def multimap(pairs: DataFrame, key: str, value: str) -> DataFrame:
    """key, values: distinct values joined by semicolons, in order."""
    return pairs.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(value)), ";").alias("values"))


def value_counts_text(m: Column) -> Column:
    """A map as value:count;value:count"""
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))), ";")


def term_frequencies(tokens: DataFrame, keys: list[str], term: str = "term") -> DataFrame:
    return tokens.groupBy(*keys, term).agg(F.count(F.lit(1)).alias("tf"))


def top(rows: DataFrame, keys: list[str], k: int, *order: Column) -> DataFrame:
    """The first k rows of each key, with their rank."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def best_language(scores: DataFrame, key: str, detectors: int = 3) -> DataFrame:
    """key, lang, score: the language with the greatest mean over all detectors; ties go to the first name."""
    mean = scores.groupBy(key, "lang").agg((F.sum("score") / detectors).alias("score"))
    ranked = Window.partitionBy(key).orderBy(F.desc("score"), "lang")
    return mean.withColumn("_r", F.row_number().over(ranked)).where("_r = 1").drop("_r")
