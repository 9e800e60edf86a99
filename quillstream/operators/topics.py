"""Topics of token lists: unigrams and bigrams, online variational LDA, top words, topics of each document.

The topics' weights are a table, a row for each word, dealt to shards by the word. The documents are dealt to batches, and within a
batch to parts. A part meets the rows of its own words only, infers its documents' topics and sends what it adds to these rows to
their shards. The driver has sums by topic, never words or rows of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstream.functions.text import topic_tokens
from quillstream.sources import scratch

#: Weights (words or tokens times topics) in a shard or a part; batches of the documents, of which an iteration takes one.
PART_CELLS, BATCHES = 500_000, 20
#: The pace of learning, (TAU + iteration) ** -KAPPA; the mean change of a document's weights at which its inference ends.
TAU, KAPPA, SETTLED = 1024, 0.51, 1e-3
#: The id of rows that hold sums of a shard or a part.
SUMS = -1


def psi(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The digamma and trigamma functions of positive numbers."""
    x, first, second = np.array(x, float), 0.0, 0.0
    for _ in range(8):
        first, second, x = first - 1 / x, second + 1 / (x * x), x + 1
    r = 1 / (x * x)
    first = first + np.log(x) - 0.5 / x - r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r / 240)))
    return first, second + 1 / x + r / 2 + r / x * (1 / 6 - r * (1 / 30 - r * (1 / 42 - r / 30)))


def expected(weights: np.ndarray) -> np.ndarray:
    """Means of the logarithms under Dirichlet distributions, one in each row."""
    return psi(weights)[0] - psi(weights.sum(axis=-1, keepdims=True))[0]


def inferred(beta: np.ndarray, lengths: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    """Weights of the topics in documents: beta has a row for each token, lengths the documents' numbers of tokens, none 0."""
    out, alive, change = np.ones((len(lengths), len(alpha))), np.arange(len(lengths)), np.ones(len(lengths))
    gamma = out[alive]
    while len(alive):
        starts, of = np.cumsum(lengths) - lengths, np.repeat(np.arange(len(lengths)), lengths)
        while 2 * (change > SETTLED).sum() > len(alive):
            theta = np.exp(expected(gamma))
            norm = np.einsum("ij,ij->i", beta, theta[of]) + 1e-100
            new = alpha + theta * np.add.reduceat(beta / norm[:, None], starts, axis=0)
            change = np.where(change > SETTLED, np.abs(new - gamma).mean(axis=1), 0.0)
            gamma = np.where((change > 0)[:, None], new, gamma)
        out[alive] = gamma
        on = change > SETTLED
        beta, lengths, alive, gamma, change = beta[np.repeat(on, lengths)], lengths[on], alive[on], gamma[on], change[on]
    return out


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def rows_of(values: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), pa.array(values.ravel()))


def encoded(docs: DataFrame, key: str, text: str, stop_words: list[str], least_documents: int) -> tuple[DataFrame, DataFrame]:
    """(id, word) of the words and pairs of neighbours that enough documents have, and (row, key, ids) of the documents that have any; kept."""
    plain = F.filter(topic_tokens(F.col(text)), lambda t: ~t.rlike(r"^\d+$"))
    words = F.filter(plain, lambda t: ~F.lower(t).isin(*[w.lower() for w in stop_words])) if stop_words else plain
    pairs = F.zip_with(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))
    terms = scratch.kept(docs.select(F.col(key).alias("key"), words.alias("w")).select(F.monotonically_increasing_id().alias("row"), "key", F.concat("w", pairs).alias("terms")), "terms")
    met = terms.select(F.explode(F.array_distinct("terms")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_documents)
    known = scratch.kept(met.select(F.monotonically_increasing_id().alias("id"), "word"), "vocabulary")
    each = terms.select("row", F.explode("terms").alias("word")).join(known, "word").groupBy("row").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return known, each.join(terms.select("row", "key"), "row")


class Lda:
    """Online variational LDA of documents (row, key, ids) over words (id, word): `weights` has (shard, id, row), a number for each topic in `row`."""

    def __init__(self, known: DataFrame, docs: DataFrame, topics: int, iterations: int, eta: float, seed: int):
        self.topics, self.seed, self.alpha, self.eta = topics, seed, np.full(topics, 1.0 / topics), eta
        self.known, words = known, known.count()
        batch = F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(BATCHES)).cast("int")
        docs = scratch.kept(docs.select("row", "key", "ids", batch.alias("batch")), "documents")
        sizes = {r.batch: (r.docs, r.tokens) for r in docs.groupBy("batch").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.size("ids")).alias("tokens")).collect()}
        every, largest = sum(n for n, _ in sizes.values()), max((n for _, n in sizes.values()), default=0)
        part = F.pmod(F.xxhash64("row"), F.lit(-(-largest * topics // PART_CELLS) or 1)).cast("int")
        self.docs = scratch.kept(docs.select("row", "key", "ids", part.alias("part"), "batch").repartition("batch", "part"), "parts", by="batch")
        self.own = scratch.kept(self.docs.select("part", F.explode("ids").alias("id"), "batch").distinct(), "own", by="batch")
        self.weights = scratch.kept(self._begun(-(-words * topics // PART_CELLS) or 1), "weights")
        self.totals = self._sums(self.weights)[0]
        for i in range(iterations):
            if i % BATCHES in sizes:
                self._learn(i, words, sizes[i % BATCHES][0], every)

    def _begun(self, shards: int) -> DataFrame:
        topics, seed = self.topics, self.seed

        def one(mine: pa.Table) -> pa.Table:
            mine, shard = mine.sort_by("word"), mine["shard"][0].as_py()
            row = np.random.Generator(np.random.Philox([seed, shard])).gamma(100.0, 0.01, (len(mine), topics))
            return pa.table({"shard": pa.array(np.full(len(mine) + 1, shard, np.int32)), "id": pa.array(np.append(mine["id"].to_numpy(), SUMS)), "row": rows_of(np.vstack([row, row.sum(axis=0)]))})

        dealt = self.known.select(F.pmod(F.xxhash64("word"), F.lit(shards)).cast("int").alias("shard"), "id", "word")
        return dealt.groupBy("shard").applyInArrow(one, "shard int, id long, row array<double>")

    def _sums(self, rows: DataFrame) -> np.ndarray:
        """The sums that parts or shards wrote, added up: vectors of a number for each topic."""
        found = rows.where(F.col("id") == SUMS).select("shard", "row").collect()  # a row for each part or shard
        width = max((len(r.row) for r in found), default=self.topics)
        return np.sum([r.row for r in sorted(found, key=lambda r: r.shard)], axis=0).reshape(-1, self.topics) if found else np.zeros((width // self.topics, self.topics))

    def _met(self, docs: DataFrame, own: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Documents, and the weights of each part's words, as what a part's function takes."""
        return docs, own.join(self.weights, "id").select("part", "id", "shard", "row")

    def _gathered(self):
        """A function that gives a part's documents' lengths, its tokens' places among its words, and its words' exponents of the mean logarithms."""
        topics, totals = self.topics, self.totals

        def run(mine: pa.Table, known: pa.Table) -> tuple[pa.Table, pa.Table, np.ndarray, np.ndarray, np.ndarray]:
            mine, known = mine.sort_by("row"), known.sort_by("id")
            ids = mine["ids"].combine_chunks()
            place = np.searchsorted(known["id"].to_numpy(), ids.flatten().to_numpy())
            return mine, known, np.diff(ids.offsets.to_numpy()), place, np.exp(psi(matrix(known["row"], topics))[0] - psi(totals)[0])

        return run

    def _learn(self, number: int, words: int, here: int, every: int) -> None:
        pace, alpha, eta, topics, gathered = (TAU + number + 1) ** -KAPPA, self.alpha, self.eta, self.topics, self._gathered()
        mine = F.col("batch") == number % BATCHES

        def infer(docs: pa.Table, known: pa.Table) -> pa.Table:
            docs, known, lengths, place, beta = gathered(docs, known)
            gamma = inferred(beta[place], lengths, alpha)
            mean = expected(gamma)
            theta = np.repeat(np.exp(mean), lengths, axis=0)
            theta /= np.einsum("ij,ij->i", beta[place], theta)[:, None] + 1e-100
            order = np.argsort(place, kind="stable")
            stats = np.add.reduceat(theta[order], np.searchsorted(place[order], np.arange(len(beta))), axis=0) * beta
            first = {"shard": known["shard"].combine_chunks(), "id": known["id"].combine_chunks(), "row": rows_of(stats)}
            sums = {"shard": pa.array([docs["part"][0].as_py()], pa.int32()), "id": pa.array([SUMS], pa.int64()), "row": rows_of(np.concatenate([stats.sum(axis=0), mean.sum(axis=0)])[None])}
            return pa.concat_tables([pa.table(first), pa.table(sums)])

        def add(old: pa.Table, new: pa.Table) -> pa.Table:
            old, new = old.sort_by("id"), new.sort_by("id")
            row, at = matrix(old["row"], topics) * (1 - pace) + pace * eta, new["id"].to_numpy()
            if len(at):
                starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
                row[np.searchsorted(old["id"].to_numpy(), at[starts])] += pace * every / here * np.add.reduceat(matrix(new["row"], topics), starts, axis=0)
            return pa.table({"shard": old["shard"].combine_chunks(), "id": old["id"].combine_chunks(), "row": rows_of(row)})

        docs, known = self._met(self.docs.where(mine).select("part", "row", "ids"), self.own.where(mine).select("part", "id"))
        form = "shard int, id long, row array<double>"
        stats = scratch.kept(docs.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(infer, form), "stats")
        old, new = self.weights.where(F.col("id") != SUMS), stats.where(F.col("id") != SUMS)
        weights = scratch.kept(old.groupBy("shard").cogroup(new.groupBy("shard")).applyInArrow(add, form), "weights")
        sums = self._sums(stats)
        scratch.dropped(stats, self.weights)
        self.weights, self.totals = weights, (1 - pace) * self.totals + pace * (eta * words + sums[0] * every / here)
        self._fit_alpha(sums[1] / here, here, pace)

    def _fit_alpha(self, mean: np.ndarray, n: int, pace: float) -> None:
        """A Newton step for the documents' prior, left out where it would make a number negative."""
        slope, c, q = n * (mean - expected(self.alpha)), n * psi(self.alpha.sum())[1], -n * psi(self.alpha)[1]
        shift = (slope / q).sum() / (1 / c + (1 / q).sum())
        new = self.alpha - pace * (slope - shift) / q
        if (new > 0).all():
            self.alpha = new

    def top_words(self, n: int = 5) -> DataFrame:
        """topic, rank, word, weight (the word's share of the topic)."""
        each = self.weights.where(F.col("id") != SUMS).select("id", F.posexplode("row").alias("topic", "part"))
        best = each.withColumn("rank", F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("part"), "id"))).where(F.col("rank") <= n)
        share = F.col("part") / F.get(F.lit([float(t) for t in self.totals]), F.col("topic"))
        return best.join(self.known, "id").select("topic", "rank", "word", share.alias("weight"))

    def document_topics(self, least: float = 0.2, n: int = 5) -> DataFrame:
        """key, topic, weight, rank of the topics above `least` in a document."""
        alpha, gathered = self.alpha, self._gathered()

        def infer(docs: pa.Table, known: pa.Table) -> pa.Table:
            docs, _, lengths, place, beta = gathered(docs, known)
            gamma = inferred(beta[place], lengths, alpha)
            gamma /= gamma.sum(axis=1, keepdims=True)
            rank = np.argsort(np.argsort(-gamma, axis=1, kind="stable"), axis=1)
            at, topic = np.nonzero((gamma > least) & (rank < n))
            return pa.table({"key": docs["key"].take(pa.array(at)), "topic": pa.array(topic, pa.int32()), "weight": pa.array(gamma[at, topic]), "rank": pa.array(rank[at, topic] + 1, pa.int32())})

        numbered = F.col("part") * BATCHES + F.col("batch")
        docs, known = self._met(self.docs.select(numbered.alias("part"), "row", "key", "ids"), self.own.select(numbered.alias("part"), "id"))
        key = docs.schema["key"].dataType.simpleString()
        return docs.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(infer, f"key {key}, topic int, weight double, rank int")


def topic_model(docs: DataFrame, key: str, text: str, topics: int = 500, iterations: int = 20, stop_words: list[str] | None = None, least_documents: int = 2, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """(topic, rank, word, weight) of the five heaviest words, and (key, topic, weight) of topics above 0.2, five at most.

    An iteration takes one of twenty batches, into which the documents are dealt by their keys, so twenty take each document once.
    """
    model = Lda(*encoded(docs, key, text, stop_words or [], least_documents), topics, iterations, 0.01, seed)
    return model.top_words(), model.document_topics().withColumnRenamed("key", key)
