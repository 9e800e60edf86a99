"""Alignment of noisy rows with the pages that they come from: seeds in common, then a check of what lies around them.

A row that is aligned at c edits has one of its pieces of `gram` letters unchanged if it has more than c of them. So pieces and
pages' grams are joined, hits are gathered by diagonal into windows, and only windows are aligned. A cost below the number
of pieces is proven to be the least; rows above it, and rows shorter than a piece, are aligned with whole pages, and so are
all rows of pages that are no longer than a window or two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.functions.python import align_near
from quillstream.sources import scratch

#: Letters of a piece; a page is cut into blocks, as a substring far into a long text would be slow; diagonals that are gathered.
GRAM, BLOCK, DIAGONALS = 5, 256, 64
#: Letters of a page with which rows are aligned as a whole at once: that takes less than the finding of a row's pieces.
SHORT = 4_096


def blocks(page: Column, overlap: int) -> Column:
    """at, body of a page's blocks, each with the first letters of the next."""
    cut = F.regexp_extract_all(page, F.lit(f"(?s)(?=(.{{1,{BLOCK + overlap}}})).{{1,{BLOCK}}}"), 1)  # the page is gone through once
    return F.transform(cut, lambda b, i: F.struct((i * BLOCK).alias("at"), b.alias("body")))


def page_grams(pages: DataFrame, keys: list[str], page: str, gram: int) -> DataFrame:
    """keys, pos, gram of every place of every page."""
    each = pages.select(*keys, F.explode(blocks(F.col(page), gram - 1)).alias("b")).where(F.length("b.body") >= gram)
    placed = each.select(*keys, "b.at", "b.body", F.explode(F.sequence(F.lit(0), F.least(F.lit(BLOCK - 1), F.length("b.body") - gram))).alias("i"))
    return placed.select(*keys, (F.col("at") + F.col("i")).alias("pos"), F.substring(F.col("body"), F.col("i") + 1, F.lit(gram)).alias("gram"))


def windows(rows: DataFrame, pages: DataFrame, keys: list[str], row: str, page: str, gram: int) -> DataFrame:
    """_id, low, high: the stretches of its page in which a row's alignments below its number of pieces lie. rows: _id, keys, row, _pieces."""
    pieces = rows.where("_pieces > 0").select("_id", *keys, "_pieces", F.length(row).alias("m"), F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)).alias("j"), F.col(row).alias("_row"))
    cut = pieces.select("_id", *keys, "_pieces", "m", (F.col("j") * gram).alias("off"), F.substring(F.col("_row"), F.col("j") * gram + 1, F.lit(gram)).alias("gram"))
    hits = page_grams(pages, keys, page, gram).join(scratch.small(cut, "pieces"), [*keys, "gram"])
    diagonal = F.col("pos") - F.col("off")
    near = hits.groupBy("_id", "_pieces", "m", F.floor(diagonal / DIAGONALS).alias("bin")).agg(F.min(diagonal).alias("low"), F.max(diagonal).alias("high"))
    wide = near.select("_id", F.greatest(F.lit(0), F.col("low") - F.col("_pieces")).alias("low"), (F.col("high") + F.col("m") + F.col("_pieces")).alias("high"))
    by = Window.partitionBy("_id").orderBy("low", "high")
    apart = F.coalesce(F.col("low") > F.max("high").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    chained = wide.withColumn("apart", apart.cast("int")).withColumn("chain", F.sum("apart").over(by))
    return chained.groupBy("_id", "chain").agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("chain")


def align_rows(rows: DataFrame, pages: DataFrame, keys: list[str], row: str, page: str, expected: str | None = None, gram: int = GRAM) -> DataFrame:
    """Each row with its cheapest substring of the page that shares its keys.

    Added: page, cost, start, length, aligned (trimmed), cut_start and cut_end (whether its ends lie within words), word_start
    and word_end (the ends, moved to the borders of the words that they cut). Of substrings of one cost the nearest to the
    `expected` start is taken, else the first, then the shortest. Null and empty rows and pages align at the cost of the other's
    letters left out; rows without a page are left out; repeated rows stay.
    """
    place = F.col(expected).cast("long") if expected else F.lit(None).cast("long")
    pieces = F.floor(F.length(F.coalesce(row, F.lit(""))) / gram).cast("int")
    numbered = scratch.kept(rows.withColumns({"_id": F.monotonically_increasing_id(), "_expected": place, "_pieces": pieces}), "rows")
    text = F.substring(F.col(page), (F.col("low") + 1).cast("int"), (F.col("high") - F.col("low")).cast("int"))
    # tables of like rows are small in files and large in memory, so none is broadcast by its file's size
    is_long = F.coalesce(F.length(page) > SHORT, F.lit(False))
    pages, spread = pages.select(*keys, page).hint("merge"), numbered.hint("merge")
    long_pages = pages.where(is_long).hint("merge")
    session = rows.sparkSession
    tasks = max(int(session.conf.get("spark.sql.shuffle.partitions")), 4 * session.sparkContext.defaultParallelism)  # some for each core, as they differ
    dealt = lambda df: df.repartition(tasks, "_id")  # noqa: E731  by work, not by bytes
    near = lambda df, text, place, below: df.withColumn("a", align_near(F.col(row), text, place, below))
    told = near(dealt(spread.join(pages.where(~is_long), keys)), F.col(page), F.col("_expected"), F.lit(None).cast("long")).select(*rows.columns, page, "a.cost", "a.start", "a.length")
    far = scratch.kept(spread.join(long_pages.select(*keys).distinct(), keys, "left_semi").select(numbered.columns), "rows-of-long-pages")
    if not far.isEmpty():
        spans = windows(far, long_pages, keys, row, page, gram)
        tried = spans.join(far.select("_id", *keys, row, "_expected", "_pieces").hint("merge"), "_id").join(long_pages, keys)
        tried = near(dealt(tried.select("_id", "_pieces", "_expected", "low", row, text.alias("_text"))), F.col("_text"), F.col("_expected") - F.col("low"), F.col("_pieces")).select("_id", "_pieces", "_expected", "low", "a")
        start = F.col("low") + F.col("a.start")
        found = tried.select("_id", "_pieces", F.struct("a.cost", F.coalesce(F.abs(start - F.col("_expected")), F.lit(0)).alias("off"), start.cast("int").alias("start"), "a.length").alias("a"))
        sure = scratch.kept(found.groupBy("_id").agg(F.min("a").alias("a"), F.first("_pieces").alias("n")).where("a.cost < n").select("_id", "a.cost", "a.start", "a.length"), "aligned")
        rest = dealt(far.hint("merge").join(sure.hint("merge"), "_id", "left_anti").join(long_pages, keys))
        whole = near(rest, F.col(page), F.col("_expected"), F.lit(None).cast("long")).select(*rows.columns, page, "a.cost", "a.start", "a.length")
        told = told.unionByName(whole).unionByName(far.hint("merge").join(sure.hint("merge"), "_id").join(long_pages, keys).select(*rows.columns, page, "cost", "start", "length"))
    end = F.col("start") + F.col("length")
    inside = lambda at: (at > 0) & (at < F.length(page)) & F.substring(F.col(page), at, F.lit(2)).rlike(r"^[\p{L}\p{N}]{2}")
    ahead = F.regexp_extract(F.substring(F.col(page), F.lit(1), F.col("start")), r"[\p{L}\p{N}]*$", 0)
    behind = F.regexp_extract(F.substring(F.col(page), end + 1, F.length(page)), r"^[\p{L}\p{N}]*", 0)
    aligned = F.trim(F.substring(F.col(page), F.col("start") + 1, F.col("length")))
    cut = told.withColumns({"aligned": aligned, "cut_start": inside(F.col("start")), "cut_end": inside(end)})
    moved = {"word_start": F.col("start") - F.when(F.col("cut_start"), F.length(ahead)).otherwise(0), "word_end": end + F.when(F.col("cut_end"), F.length(behind)).otherwise(0)}
    return cut.withColumns(moved).select(*rows.columns, page, "cost", "start", "length", "aligned", "cut_start", "cut_end", "word_start", "word_end")
