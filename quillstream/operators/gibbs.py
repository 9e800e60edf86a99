"""Topics by collapsed Gibbs sampling over partitions, whose counts are merged after each round.

The documents are dealt to partitions by their keys. A partition holds its tokens' topics and is given, for its own words, the
counts of all partitions; it samples its tokens anew for some sweeps against these counts and its own changes, and the next
round's counts are those of all tokens' topics. No task holds the vocabulary or the matrix, only its own words' rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstream.functions.text import topic_tokens
from quillstream.sources import scratch

#: Tokens times topics in a partition.
PART_CELLS = 4_000_000


@dataclass
class Model:
    """tokens: part, doc, words, topics; counts: word, topic, n; known: id, word, by which words stand in both, in the words' order; rounds: round, tokens, words (what each round's counts sum up to); alpha and beta: the priors."""

    tokens: DataFrame
    counts: DataFrame
    known: DataFrame
    rounds: list[tuple[int, int, int]]
    topics: int
    alpha: float
    beta: float


def terms(docs: DataFrame, key: str, text: str, stop_words: list[str], least_documents: int) -> DataFrame:
    """doc, words: single words and pairs of neighbours, without numbers, stop words and what fewer documents have; kept. A document without any is left out."""
    plain = F.filter(topic_tokens(F.col(text)), lambda t: ~t.rlike(r"^\d+$"))
    words = F.filter(plain, lambda t: ~F.lower(t).isin(*stop_words)) if stop_words else plain
    singles = docs.select(F.col(key).alias("doc"), words.alias("w"))
    pairs = F.zip_with(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))
    each = scratch.kept(singles.select("doc", F.posexplode(F.concat("w", pairs)).alias("i", "word")), "terms")
    known = each.groupBy("word").agg(F.count_distinct("doc").alias("n")).where(F.col("n") >= least_documents).select("word")
    met = each.join(known, "word").groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("i", "word"))).alias("all"))
    return scratch.kept(met.select("doc", F.col("all.word").alias("words")), "words")


def sweeps(words: np.ndarray, topics: np.ndarray, lengths: np.ndarray, table: np.ndarray, totals: np.ndarray, of: int, alpha: float, beta: float, times: int, draw: np.random.Generator) -> np.ndarray:
    """Samples every token's topic `times` times: the first tokens of all documents, then the second ones, and so on.

    A document's own counts are those of its last sample; a word's and the totals are those of the step before. words: row
    numbers in `table` (words by topics), which is changed, as are the totals; of: words in the whole vocabulary. Documents stand
    one after the other in words and topics, so memory goes with the tokens, however long one document is.
    """
    k, n = table.shape[1], len(lengths)
    rank = np.empty(n, np.int64)
    rank[np.argsort(-lengths, kind="stable")] = np.arange(n)
    row, place = np.repeat(rank, lengths), np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    by_step = np.lexsort((row, place))
    w, z, cells = words[by_step], topics[by_step], table.reshape(-1)
    mine = np.bincount(row * k + topics, minlength=n * k).reshape(n, k).astype(float)
    ends = np.cumsum(np.bincount(place))
    for _ in range(times):
        for begin, end in zip(np.append(0, ends[:-1]), ends, strict=True):
            rows = np.arange(end - begin)
            word, old = w[begin:end], z[begin:end].copy()
            mine[rows, old] -= 1
            own = table[word]
            own[rows, old] -= 1
            less = np.broadcast_to(totals, own.shape).copy()
            less[rows, old] -= 1
            chance = np.cumsum((mine[: len(rows)] + alpha) * (np.maximum(own, 0) + beta) / (np.maximum(less, 0) + of * beta), axis=1)
            new = (chance < (draw.random(len(rows)) * chance[:, -1])[:, None]).sum(axis=1)
            z[begin:end] = new
            mine[rows, new] += 1
            np.subtract.at(cells, word * k + old, 1)
            np.add.at(cells, word * k + new, 1)
            totals += np.bincount(new, minlength=k) - np.bincount(old, minlength=k)
    out = np.empty_like(topics)
    out[by_step] = z
    return out


def counted(tokens: DataFrame) -> DataFrame:
    pairs = tokens.select(F.explode(F.arrays_zip("words", "topics")).alias("t"))
    return scratch.kept(pairs.groupBy(F.col("t.words").alias("word"), F.col("t.topics").alias("topic")).agg(F.count(F.lit(1)).alias("n")), "counts")


def sample(words: DataFrame, topics: int = 500, rounds: int = 20, sweeps_each: int = 5, alpha_sum: float = 1.0, beta: float = 0.01, seed: int = 1, parts: int | None = None) -> Model:
    """A model of the documents' words (doc, words), the same for the same seed, documents and number of parts.

    Documents of one key are sampled each for itself. Without documents the model is empty.
    """
    words = scratch.kept(words.select(F.monotonically_increasing_id().alias("row"), "doc", "words"), "rows")
    size, alpha = words.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0], alpha_sum / topics
    n_parts = parts or max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size * topics // PART_CELLS))
    spread = lambda w, i: F.struct(i.alias("i"), w.alias("word"), F.pmod(F.xxhash64("doc", w, i, F.lit(seed)), F.lit(topics)).cast("int").alias("topic"))
    known = scratch.kept(words.select(F.explode("words").alias("word")).distinct().orderBy("word").select(F.monotonically_increasing_id().alias("id"), "word"), "known")
    each = words.select("row", "doc", F.explode(F.transform("words", spread)).alias("t")).select("row", "doc", "t.*").join(known, "word")
    dealt = each.groupBy("row", "doc").agg(F.sort_array(F.collect_list(F.struct("i", "id", "topic"))).alias("all"))
    tokens = scratch.kept(dealt.select(F.pmod(F.xxhash64("doc"), F.lit(n_parts)).cast("int").alias("part"), "doc", F.col("all.id").alias("words"), F.col("all.topic").alias("topics")), "tokens")
    own = scratch.kept(tokens.select("part", F.explode(F.array_distinct("words")).alias("word")).distinct(), "own")
    told, counts = [], counted(tokens)
    vocabulary = counts.agg(F.count_distinct("word")).first()[0]

    def one_round(number: int, totals: np.ndarray):
        def run(mine: pa.Table, known: pa.Table) -> pa.Table:
            if not len(mine):
                return mine
            mine, known = mine.sort_by("doc"), known.sort_by("word")
            words, old, n = (t.combine_chunks() for t in (mine["words"], mine["topics"], known["n"]))
            table = np.zeros((len(known), topics))
            table[np.repeat(np.arange(len(known)), np.diff(n.offsets.to_numpy())), known["topic"].combine_chunks().flatten().to_numpy()] = n.flatten().to_numpy()
            draw = np.random.Generator(np.random.Philox([seed, number, mine["part"][0].as_py()]))
            rows, lengths = np.searchsorted(known["word"].to_numpy(), words.flatten().to_numpy()), np.diff(words.offsets.to_numpy())
            new = sweeps(rows, old.flatten().to_numpy().astype(np.int64), lengths, table, totals.copy(), vocabulary, alpha, beta, sweeps_each, draw)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), pa.array(new, pa.int32()))
            return mine.set_column(mine.schema.get_field_index("topics"), "topics", lists)

        return run

    for number in range(rounds):
        sums = counts.groupBy("topic").agg(F.sum("n").alias("n")).collect()  # as many rows as topics
        totals = np.zeros(topics)
        for r in sums:
            totals[r.topic] = r.n
        told.append((number, int(totals.sum()), counts.agg(F.count_distinct("word")).first()[0]))
        by_word = counts.groupBy("word").agg(F.collect_list(F.struct("topic", "n")).alias("all")).select("word", F.col("all.topic").alias("topic"), F.col("all.n").alias("n"))
        mine = own.join(by_word, "word").select("part", "word", "topic", "n")
        sampled = scratch.kept(tokens.groupBy("part").cogroup(mine.groupBy("part")).applyInArrow(one_round(number, totals), tokens.schema), "tokens")
        scratch.dropped(tokens, counts)
        tokens, counts = sampled, counted(sampled)
    return Model(tokens, counts, known, told, topics, alpha, beta)


def top_words(model: Model, n: int = 5) -> DataFrame:
    """topic, rank, word, weight (the word's share of the topic's tokens) of each topic's most frequent words."""
    share = F.col("n") / F.sum("n").over(Window.partitionBy("topic"))
    ranked = model.counts.withColumn("weight", share).withColumn("rank", F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("n"), "word")))
    best = ranked.where(F.col("rank") <= n).withColumnRenamed("word", "id")  # ids are in the words' order
    return best.join(model.known, "id").select("topic", "rank", "word", "weight")


def document_topics(model: Model, least: float = 0.2, n: int = 5) -> DataFrame:
    """doc, rank, topic, weight of the topics above `least` in a document, the heaviest first."""
    each = model.tokens.select("doc", F.size("words").alias("tokens"), F.explode("topics").alias("topic")).groupBy("doc", "tokens", "topic").agg(F.count(F.lit(1)).alias("n"))
    weighed = each.withColumn("weight", (F.col("n") + model.alpha) / (F.col("tokens") + model.alpha * model.topics)).where(F.col("weight") > least)
    return weighed.withColumn("rank", F.row_number().over(Window.partitionBy("doc").orderBy(F.desc("weight"), "topic"))).where(F.col("rank") <= n).select("doc", "rank", "topic", "weight")
