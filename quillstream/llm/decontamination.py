"""Benchmark decontamination as a prefix-filtered set join, in DataFrame expressions only.

A window is 13 consecutive words of a benchmark item (a shorter item is one window). Its shingles (three adjacent
words, fewer if the window has fewer) are ordered by rarity: by their count over all documents. A document holds a
window only if it holds all of its shingles, so the prefix that has to be joined is one shingle, the rarest. Where
the document has it, its offset in the window gives the only start that is possible there; starts before the text's
first word or lengths beyond its last one are out, and what is left is compared word for word with the window.

The documents' side never moves: words are exploded, probed, and verified within one code-generated stage, and only
one row a document and its verified windows are shuffled. Join keys are hashes of words in full lower case, a coarser
equality than the exact one, which the comparison then decides on A-Z alone.

The shingles that are counted and the windows with their items are broadcast in slices, whose bytes are summed up
beforehand: SLICE_BYTES each on average. A larger benchmark takes more passes over the documents, never a larger
broadcast. (A single window's list of items is whole: it has one entry for each item with that window.)

Texts of any length are split whole. Null and empty texts have no words; null or empty items have no windows; a null item_id counts as an empty string.
Each input row gives one result row, repeated rows too; rows of one doc_id with different texts are judged apart.
Shingles with
equal counts are ordered by their hashes. Empty tables are fine, and columns besides ids and texts aren't read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstream.llm.common import materialise, right_sized

WINDOW_WORDS = 13
SHINGLE_WORDS = 3
SLICE_BYTES = 32_000_000
#: A broadcast row's bytes beside its strings.
ROW_BYTES = 64
#: Bytes of items whose windows make a file.
ITEM_BYTES = 500_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What parts words, before lower-casing.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def split_words(text: Column) -> Column:
    """Words in their own case; an empty string may stand first and last."""
    return F.split(F.coalesce(text, F.lit("")), GAP)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def shingle_key(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.lower(F.get(words, at + i)) for i in range(size)])


def item_windows(items: DataFrame, key: str = "item_id", text: str = "text", window: int = WINDOW_WORDS) -> DataFrame:
    """Distinct windows: window_text, n_words, item_ids."""
    words = F.filter(F.split(lower_ascii(F.coalesce(F.col(text), F.lit(""))), GAP), lambda w: w != "")
    length = F.least(F.size("words"), F.lit(window))
    return (
        items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), words.alias("words"))
        .where(F.size("words") > 0)
        .select("item", "words", length.alias("n_words"), F.explode(F.sequence(F.lit(1), F.size("words") - length + 1)).alias("at"))
        .select("item", "n_words", F.array_join(F.slice("words", F.col("at"), F.col("n_words")), " ").alias("window_text"))
        .groupBy("window_text", "n_words")
        .agg(F.collect_set("item").alias("item_ids"))
    )


def window_shingles(windows: DataFrame) -> DataFrame:
    """A row for each shingle of each window: window_text, n_words, item_ids, k, key, offset (words before it)."""
    return (
        windows.withColumn("words", F.split("window_text", " "))
        .withColumn("k", F.least(F.col("n_words"), F.lit(SHINGLE_WORDS)))
        .withColumn("offset", F.explode(F.sequence(F.lit(0), F.col("n_words") - F.col("k"))))
        .withColumn("key", reduce(lambda a, k: F.when(F.col("k") == k, shingle_key(F.col("words"), F.col("offset"), k)).otherwise(a), range(1, SHINGLE_WORDS + 1), F.lit(None).cast("long")))
        .drop("words")
    )


def exploded(docs: DataFrame, size: int, key: str, text: str) -> DataFrame:
    """A row for each word, after one for the text itself (at = 0): id, digest of the text, all words, place, shingle's key."""
    words = F.concat(F.array(F.lit("")), split_words(F.col(text)))
    return (
        docs.select(F.col(key).alias("doc_id"), F.xxhash64(F.col(text), F.col(text).isNull()).alias("text_key"), words.alias("words"))
        .select("doc_id", "text_key", "words", F.posexplode_outer("words").alias("at", "word"))
        .withColumn("key", F.xxhash64(F.lower("word"), *[F.lower(F.get("words", F.col("at") + i)) for i in range(1, size)]))
    )


def rarest(docs: DataFrame, shingles: DataFrame, key: str, text: str) -> DataFrame:
    """Each window with its prefix: the shingle with the smallest count over all documents."""
    counts = []
    for r in shingles.groupBy("k").agg(F.countDistinct("key").alias("n")).collect():
        slices = max(1, -(-r.n * ROW_BYTES // SLICE_BYTES))
        for i in range(slices):
            own = shingles.where((F.col("k") == r.k) & (F.pmod("key", F.lit(slices)) == i)).select("key").distinct()
            counts.append(exploded(docs, r.k, key, text).select("key").join(F.broadcast(own), "key").groupBy("key").count().withColumn("k", F.lit(r.k)))
    if not counts:
        counts = [shingles.select("key", F.lit(0).cast("long").alias("count"), "k").limit(0)]
    counted = reduce(DataFrame.unionByName, counts)
    ranked = shingles.join(counted, ["k", "key"], "left").withColumn("count", F.coalesce("count", F.lit(0)))
    return ranked.groupBy("window_text", "n_words", "k").agg(
        F.min_by(F.struct("key", "offset"), F.struct("count", "key", "offset")).alias("prefix"), F.min("item_ids").alias("item_ids"), F.min("count").alias("n_prefix")
    ).select("window_text", "n_words", "k", "prefix.key", "prefix.offset", "item_ids", "n_prefix")


def matches(docs: DataFrame, windows: DataFrame, size: int, key: str, text: str, with_rows: bool) -> DataFrame:
    """Verified windows (doc_id, text_key, start, n_words, item_ids); with_rows: also a row for each document row, with its word count."""
    side = F.broadcast(windows.where(F.col("k") == size).select("key", "offset", F.col("n_words").alias("length"), "window_text", "item_ids"))
    start = F.col("at") - F.col("offset")
    verified = (
        F.col("window_text").isNotNull()
        & (start >= 1)
        & (start + F.col("length") <= F.size("words"))
        & (lower_ascii(F.array_join(F.slice("words", start + 1, F.col("length")), " ")) == F.col("window_text"))
    )
    verified = F.coalesce(verified, F.lit(False))
    rows = exploded(docs, size, key, text).join(side, "key", "left" if with_rows else "inner")
    blank = lambda at: F.when(F.get("words", at) == "", 1).otherwise(0)
    n_words = F.size("words") - 1 - blank(F.lit(1)) - F.when(F.size("words") > 2, blank(F.size("words") - 1)).otherwise(0)
    return rows.where((F.col("at") == 0) | verified if with_rows else verified).select(
        "doc_id", "text_key",
        F.when(F.col("at") == 0, n_words.cast("long")).alias("n_words"),
        F.when(verified, F.struct(start.alias("start"), (start + F.col("length")).alias("end"))).alias("span"),
        F.when(verified, F.col("item_ids")).alias("item_ids"),
    )


def scan(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document row: doc_id, n_words, n_hit, n_items, item_ids (sorted strings), spans (merged), contaminated."""
    windows = materialise(right_sized(window_shingles(item_windows(items)), items, ITEM_BYTES), "benchmark-shingles")
    sizes = sorted({SHINGLE_WORDS, *(r.k for r in windows.select("k").distinct().collect())})
    prefixes = materialise(right_sized(rarest(docs, windows, key, text), items, ITEM_BYTES), "benchmark-prefixes")
    size = F.octet_length("window_text") + F.aggregate("item_ids", F.lit(ROW_BYTES), lambda n, x: n + F.octet_length(x) + 16)
    slices = max(1, -(-prefixes.agg(F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()[0] // SLICE_BYTES))
    parts = []
    for i in range(slices):
        own = prefixes if slices == 1 else prefixes.where(F.pmod(F.xxhash64("window_text"), F.lit(slices)) == i)
        parts += [matches(docs, own, k, key, text, with_rows=i == 0 and k == SHINGLE_WORDS) for k in sizes]
    found = reduce(DataFrame.unionByName, parts)
    one = found.groupBy("doc_id", "text_key").agg(
        F.count("n_words").alias("copies"), F.max("n_words").alias("n_words"), F.sort_array(F.collect_set("span")).alias("found"), F.array_distinct(F.flatten(F.collect_set("item_ids"))).alias("item_ids")
    )
    # words that a window covers; a span begins after a word that isn't covered and ends before one
    covered = F.array_sort(F.array_distinct(F.flatten(F.transform("found", lambda x: F.sequence(x["start"], x["end"] - 1)))))
    after = F.transform("covered", lambda x: x + 1)
    spans = F.zip_with(F.array_except("covered", after), F.array_except(after, F.col("covered")), lambda a, b: F.struct(a.alias("start"), b.alias("end")))
    out = (
        one.withColumn("covered", covered)
        .withColumn("spans", spans)
        .withColumn("n_hit", F.size("covered").cast("long"))
        .withColumn("item_ids", F.array_sort("item_ids"))
        .withColumn("n_items", F.size("item_ids").cast("long"))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select("doc_id", "text_key", "n_words", "n_hit", "n_items", "item_ids", "spans", "contaminated")
    )
    return right_sized(out, docs)


def digests(scanned: DataFrame) -> DataFrame:
    return scanned.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")
