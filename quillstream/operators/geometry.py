"""Page geometry: words to lines, lines to paragraphs, columns of blocks, reading order, areas and styles."""

from __future__ import annotations

import bisect
import itertools
import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLACES = T.ArrayType(T.IntegerType())


def line_numbers(words: list[tuple[int, int, int, int]]) -> list[int]:
    """Line of each word box (x1, y1, x2, y2), from 0.

    A word begins a line if it lies below the nearest word of the line that is left of its middle (or the line's first
    word), or if its middle is left of the last word's.
    """
    out, middles, ends, now = [], [], [], 0
    for x1, y1, x2, y2 in words:
        middle = (x1 + x2) // 2
        if middles:
            nearest = max(0, bisect.bisect_left(middles, middle) - 1)
            if y1 > ends[nearest] or middle < middles[-1]:
                now += 1
                middles, ends = [], []
        middles.append(middle)
        ends.append(y2)
        out.append(now)
    return out


@F.pandas_udf(PLACES)
def page_lines(x1: pd.Series, y1: pd.Series, x2: pd.Series, y2: pd.Series) -> pd.Series:
    """Lines of the words of whole pages."""
    return pd.Series([line_numbers(list(zip(*(c.tolist() for c in boxes), strict=True))) for boxes in zip(x1, y1, x2, y2, strict=True)], dtype=object)


def words_to_lines(words: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Words (x1, y1, x2, y2) with `line`: depends on the line so far, so it is a function of a whole page."""

    rest = [c for c in words.columns if c != order]
    pages = words.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, *rest))).alias("_rows"))
    placed = pages.select("_rows", page_lines(*[F.col(f"_rows.{c}") for c in ("x1", "y1", "x2", "y2")]).alias("_lines"))
    return placed.select(F.explode(F.arrays_zip(F.col("_rows").alias("r"), F.col("_lines").alias("line"))).alias("z")).select(*[F.col(f"z.r.{c}") for c in words.columns], "z.line")


def line_boxes(words: DataFrame, keys: list[str], order: str, text: str = "word") -> DataFrame:
    """Lines with their box, text, and the integer means that paragraph breaks are inferred from."""
    return words.groupBy(*keys, "line").agg(
        F.min("x1").alias("xmin"), F.min("y1").alias("ymin"), F.max("x2").alias("xmax"), F.max("y2").alias("ymax"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda w: w[text]), " ").alias("text"),
        F.expr("sum(y1) div count(1)").alias("start_y"), F.expr("sum(y2) div count(1)").alias("end_y"), F.min("x1").alias("start_x"), F.max(F.col("y2") - F.col("y1")).alias("height"),
        F.expr(f"sum(x2 - x1) div greatest(sum(length({text})), 1)").alias("letter_width"),
    )


def paragraph_numbers(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Lines with `paragraph`: a break is a wide gap, an indent or an outdent against the line before."""
    w = Window.partitionBy(*keys).orderBy("line")
    was = lambda c: F.lag(c).over(w)
    width = F.least(was("letter_width"), F.col("letter_width"))
    breaks = (
        (F.col("start_y") - was("end_y") > 0.9 * F.least(was("height"), F.col("height")))
        | (F.col("start_x") > was("start_x") + 1.5 * width)
        | (was("start_x") > F.col("start_x") + 2 * width)
    )
    return lines.withColumn("_b", F.coalesce(breaks, F.lit(False)).cast("int")).withColumn("paragraph", F.sum("_b").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_b")


def column_count(spans: Column) -> Column:
    """Greedy number of groups of array<struct<start, end>>: the first unseen span, by (start, end), counts one and marks all that overlap it (closed).

    In that order a span overlaps the group's first one just if it begins before its end; one pass keeps that end.
    """
    seen = F.aggregate(
        F.array_sort(spans), F.struct(F.lit(0).alias("n"), F.lit(None).cast("double").alias("end")),
        lambda a, s: F.when(a["end"].isNull() | (s["start"] > a["end"]), F.struct((a["n"] + 1).alias("n"), s["end"].cast("double").alias("end"))).otherwise(a),
    )
    return seen["n"]


def block_columns(blocks: DataFrame, page: list[str], block: str) -> DataFrame:
    """page, block, columns, area: columns beside each block (x1, y1, x2, y2), itself among them."""
    other = blocks.select(*[F.col(c).alias(f"_o_{c}") for c in (*page, "x1", "y1", "x2", "y2")])
    same = F.lit(True)
    for c in page:
        same = (F.col(c) == F.col(f"_o_{c}")) & same
    beside = blocks.join(other, same & (F.col("y1") <= F.col("_o_y2")) & (F.col("_o_y1") <= F.col("y2")))
    spans = F.collect_list(F.struct(F.col("_o_x1").alias("start"), F.col("_o_x2").alias("end")))
    return beside.groupBy(*page, block).agg(column_count(spans).alias("columns"), F.first((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))).alias("area"))


@F.pandas_udf(PLACES)
def block_places(positions: pd.Series, logicals: pd.Series) -> pd.Series:
    """Places of the blocks of whole pages, which come by position and block; an absent position is below all others."""

    def one(ys, marks) -> list[int]:
        rows = [(math.inf if y is None or y != y else y, None if m is None or m != m else m) for y, m in zip(ys.tolist(), marks.tolist(), strict=True)]
        known = sorted((i for i, (_, m) in enumerate(rows) if m is not None), key=lambda i: rows[i][1])
        tops = list(itertools.accumulate((rows[i][0] for i in known), max))  # the first one that isn't above a place is the first that reaches it
        ahead: list[list[int]] = [[] for _ in range(len(known) + 1)]
        for i, (y, m) in enumerate(rows):
            if m is None:
                ahead[bisect.bisect_left(tops, y)].append(i)
        order = [*itertools.chain.from_iterable([*others, i] for others, i in zip(ahead, known, strict=False)), *ahead[-1]]
        place = {i: n for n, i in enumerate(order)}
        return [place[i] for i in range(len(rows))]

    return pd.Series([one(*r) for r in zip(positions, logicals, strict=True)], dtype=object)


def reading_order(blocks: DataFrame, page: list[str]) -> DataFrame:
    """Blocks (block, position, logical order or null) with `place`: referenced ones in logical order; each other one, by position, before the first of those that isn't above it. Others of one position stay in the order of their blocks."""

    place = [c for c in blocks.columns if c not in ("position", "block")]
    rows = F.array_sort(F.collect_list(F.struct(F.col("position").isNull().alias("_last"), "position", "block", *place)))
    pages = blocks.groupBy(*page).agg(rows.alias("_rows")).select("_rows", block_places(F.col("_rows.position"), F.col("_rows.logical")).alias("_places"))
    return pages.select(F.explode(F.arrays_zip(F.col("_rows").alias("r"), F.col("_places").alias("place"))).alias("z")).select(*[F.col(f"z.r.{c}") for c in blocks.columns], "z.place")


def own_areas(elements: DataFrame) -> DataFrame:
    """Elements (element, parent, style, area) with `own_area`: what children with a style of their own take is taken once."""
    children = elements.where(F.col("style").isNotNull() & F.col("parent").isNotNull()).groupBy(F.col("parent").alias("element")).agg(F.sum("area").alias("_taken"))
    return elements.join(children, "element", "left").withColumn("own_area", F.col("area") - F.coalesce("_taken", F.lit(0))).drop("_taken")


def page_runs(rows: DataFrame, key: str, order: str, ref: str) -> DataFrame:
    """Rows with sub_page: 1, 2, … within a run of equal page references."""
    w = Window.partitionBy(key).orderBy(order)
    out = rows.withColumn("_c", (~F.col(ref).eqNullSafe(F.lag(ref).over(w))).cast("int")).withColumn("_run", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return out.withColumn("sub_page", F.row_number().over(Window.partitionBy(key, "_run").orderBy(order))).drop("_c", "_run")
