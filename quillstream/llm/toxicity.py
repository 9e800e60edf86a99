"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton over folded text.

Folding: compatibility decomposition without accents, lower case, look-alike letters of other scripts and digits or
signs that stand for letters mapped to plain letters (i, l and 1 share one), marks inside a word dropped, runs of three
or more equal letters reduced to one. The result is one string with a single space around each word.

The lexicon is learned from labelled rows outside the held-out third: at most TRAIN_ROWS labels, the first by a hash
of the id, and as many texts. Texts that are near-equal (same least shingle hash) weigh one together. Words whose presence depends on the
label more than chance would make any of the vocabulary's words depend (a likelihood ratio against the vocabulary's
size) enter with their log-odds. Exception phrases are word pairs around an entry that clean texts hold and toxic
ones don't; a match inside one counts nothing. A text's features are its weighted matches for each hundred words and
its number of different entries, both of which a logistic curve turns into the score.

Null and empty texts have no matches; texts of any length are folded and matched whole. Null labels and labels of unknown ids teach nothing; a doc_id labelled twice
counts as toxic if one label does. Without any toxic or clean label every score is the prior. Repeated rows give
repeated results and teach once, empty tables give empty results; language, source and ids are never features, and
other columns, whatever their names, aren't read. Words of equal strength are all in the lexicon: it has no cap.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.llm.common import held_out, materialise, trimmed

TRAIN_ROWS = 40_000
LEAST_DOCS = 3
THRESHOLD = 0.7
PRIOR = 0.1
#: Letters of other scripts that look like Latin ones.
LOOK_ALIKE = dict(zip("авекмнорстухіјѕԁԛԝһӏαβεικνορτυχγωɡɑ", "abekmhopctyxijsdqwhlabeiknoptuxywga", strict=True))
#: Digits and signs that stand for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "i", "+": "t", "€": "e", "l": "i"}
_fold = str.maketrans(LOOK_ALIKE | {"l": "i"})
_substitute = str.maketrans(SUBSTITUTES)
_edges = re.compile(r"^[^\w@$]+|[^\w]+$")
_inner = re.compile(r"[^\w]+|_+")
_runs = re.compile(r"([^\W\d_])\1{2,}")
_combining = re.compile("[̀-ͯ]")


def fold_word(word: str) -> str:
    """One word that holds something besides plain letters."""
    word = _edges.sub("", word)
    if any(c.isalpha() for c in word) and not word.isalpha():
        word = word.translate(_substitute)
    return _runs.sub(r"\1", _inner.sub("", word))


def fold(text: str) -> str:
    """Folded words, one space around each."""
    if not text.isascii():
        text = _combining.sub("", unicodedata.normalize("NFKD", text))
    text = text.lower().translate(_fold)
    words = [w if w.isalpha() and w.isascii() else fold_word(w) for w in text.split()]
    text = " " + " ".join([w for w in words if w]) + " "
    return _runs.sub(r"\1", text)


def near_key(folded: str) -> int:
    """Least hash of the text's five-word shingles: near copies mostly share it."""
    from xxhash import xxh64_intdigest

    words = folded.split()
    n = max(1, len(words) - 4)
    return min(xxh64_intdigest(" ".join(words[i : i + 5]), 7) for i in range(n)) - 2**63


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    curve: tuple[float, ...] = (float(np.log(PRIOR / (1 - PRIOR))), 0.0, 0.0)

    def automaton(self):
        import ahocorasick

        made = ahocorasick.Automaton()
        for w, x in self.weights.items():
            made.add_word(f" {w} ", (w, x))
        for phrase in self.exceptions:
            made.add_word(f" {phrase} ", (phrase, None))
        if len(made):
            made.make_automaton()
        return made

    def features(self, folded: str, automaton) -> tuple[float, float]:
        """Weighted matches for each hundred words, and the logarithm of one more than the number of different entries."""
        if not len(automaton):
            return 0.0, 0.0
        hits, spared = [], set()
        for end, (what, weight) in automaton.iter(folded):
            if weight is None:  # an exception phrase spares the entries in it: those at its first and its last word
                first, last = what.split(" ")
                spared |= {end, end - len(last) - 1}
            else:
                hits.append((end, what, weight))
        hits = [h for h in hits if h[0] not in spared]
        if not hits:
            return 0.0, 0.0
        n_words = folded.count(" ")
        return 100 * sum(h[2] for h in hits) / (n_words + 20), float(np.log1p(len({h[1] for h in hits})))

    def score(self, rows: np.ndarray) -> np.ndarray:
        z = self.curve[0] + np.log1p(rows[:, 0]) * self.curve[1] + rows[:, 1] * self.curve[2]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_curve(rows: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Logistic regression with a small ridge, by Newton steps."""
    x = np.column_stack([np.ones(len(rows)), np.log1p(rows[:, 0]), rows[:, 1]])
    b = np.zeros(3)
    ridge = np.diag([1e-6, 0.05, 0.05])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (y - p)) - ridge @ b)
        b = b + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in np.r_[b[0], np.maximum(b[1:], 0)])


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """folded, toxic, weight of a bounded sample of labelled documents that aren't held out; near-equal texts weigh one together."""
    own = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key)).groupBy(F.col(key).cast("long").alias("labelled")).agg(F.max(label).cast("int").alias("toxic"))
    own = own.orderBy(F.xxhash64("labelled"), "labelled").limit(rows)  # the documented bound, which makes it fit for a broadcast
    names = ["doc_id", "folded", "near", "toxic", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                folded = [fold(t or "") for t in part.column(1).to_pylist()]
                place = [xxh64_intdigest(f"{i} {t}", 9) - 2**63 for i, t in zip(part.column(0).to_pylist(), folded, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(folded, pa.string()), pa.array([near_key(t) for t in folded], pa.int64()), part.column(2), pa.array(place, pa.int64())], names=names)

    joined = docs.select(F.col(key).cast("long").alias("labelled"), F.col(text).alias("body")).join(F.broadcast(own), "labelled").select("labelled", "body", "toxic")
    found = joined.mapInArrow(trimmed(run), "doc_id long, folded string, near long, toxic int, place long").dropDuplicates(["place"])
    found = materialise(found, "toxic-training")
    if found.count() > rows:  # ids that stand at several texts
        found = found.where(F.col("place") <= found.select("place").orderBy("place").limit(rows).agg(F.max("place")).first()[0])
    alike = found.groupBy("near").agg((1.0 / F.count(F.lit(1))).alias("weight"))
    return found.join(F.broadcast(alike), "near").select("folded", "toxic", "weight")  # at most `rows` rows


def _counted(what):
    """A map function: weights of a task's texts, by label, for each of the things that what(folded) gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[dict, dict] = defaultdict(float), defaultdict(float)

        def out() -> Iterator[pa.RecordBatch]:
            for toxic in (0, 1):
                keys = list(counts[toxic])
                for at in range(0, len(keys), 50_000):
                    k = keys[at : at + 50_000]
                    n = [counts[toxic][x] for x in k]
                    zero = [0.0] * len(k)
                    yield pa.RecordBatch.from_arrays([pa.array(k, pa.string()), pa.array(n if toxic else zero), pa.array(zero if toxic else n)], names=["what", "toxic", "clean"])
                counts[toxic].clear()

        for batch in batches:
            for folded, toxic, weight in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                own = counts[int(toxic > 0)]
                for x in what(folded):
                    own[x] += weight
            if len(counts[0]) + len(counts[1]) > 1_000_000:
                yield from out()
        yield from out()

    return run


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Lexicon:
    training = materialise(training_rows(docs, labels, rows, key, text, label), "toxic-words")
    n_toxic, n_clean = training.agg(*[F.coalesce(F.sum(F.when((F.col("toxic") > 0) == t, F.col("weight"))), F.lit(0.0)) for t in (True, False)]).first()
    if not n_toxic or not n_clean:
        return Lexicon()
    share = n_toxic / (n_toxic + n_clean)
    counted = training.mapInArrow(trimmed(_counted(lambda t: set(t.split()))), "what string, toxic double, clean double").groupBy("what").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counted = materialise(counted.where(F.col("toxic") + F.col("clean") >= LEAST_DOCS - 1e-6), "toxic-counts")
    ratio = lambda a, b, s: a * F.log(F.greatest(a, F.lit(0.5)) / (a + b) / s)
    gain = 2 * (ratio(F.col("toxic"), F.col("clean"), share) + ratio(F.col("clean"), F.col("toxic"), 1 - share))
    vocabulary = max(2, counted.count())
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    chosen = counted.withColumn("gain", gain).withColumn("odds", odds).where((F.col("odds") > 1.5) & (F.col("gain") > 2 * float(np.log(vocabulary))))
    weights = {r.what: r.odds for r in chosen.orderBy("what").collect()}  # words of at most `rows` texts
    if not weights:
        return Lexicon(curve=(float(np.log(share / (1 - share))), 0.0, 0.0))

    def around(folded: str) -> set[str]:
        words = folded.split()
        return {f"{a} {b}" for a, b in zip(words, words[1:]) if a in weights or b in weights}

    pairs = training.mapInArrow(trimmed(_counted(around)), "what string, toxic double, clean double").groupBy("what").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    harmless = pairs.where((F.col("clean") >= LEAST_DOCS - 1e-6) & (F.col("clean") * share > 4 * F.col("toxic") * (1 - share)))
    exceptions = frozenset(r.what for r in harmless.select("what").collect())
    made = Lexicon(weights, exceptions)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = made.automaton()
        for batch in batches:
            found = [made.features(t, automaton) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.float64()), batch.column(1), batch.column(2)], names=["a", "b", "toxic", "weight"])

    told = training.mapInArrow(trimmed(features), "a double, b double, toxic int, weight double").toPandas()  # at most `rows` rows
    made.curve = fit_curve(told[["a", "b"]].to_numpy(), (told["toxic"] > 0).to_numpy(float), told["weight"].to_numpy())
    return made


def score(docs: DataFrame, lexicon: Lexicon, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score, weighted (matches for each hundred words) of each row: one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = np.array([lexicon.features(fold(t or ""), automaton) for t in part.column(1).to_pylist()], float).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(lexicon.score(found)), pa.array(found[:, 0])], names=["doc_id", "score", "weighted"])

    return docs.select(key, text).mapInArrow(trimmed(run), "doc_id long, score double, weighted double")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, learn(docs, labels))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"), "weighted")
