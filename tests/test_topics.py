"""Variational topics against a plain version, and what stays off the driver."""

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstream.operators import gibbs, topics


def planted(spark):
    r = random.Random(5)
    sides = [["sail", "mast", "deck", "rope"], ["seed", "soil", "plough", "barn"]]
    rows = [(i % 300, " ".join(r.choice(sides[i % 2]) for _ in range(30))) for i in range(400)] + [(999, None), (998, "12 345"), (997, "once")]
    return spark.createDataFrame(rows, "id int, t string")


def digamma(x):
    return -1 / x + digamma(x + 1) if x < 20 else np.log(x) - 0.5 / x - 1 / (12 * x * x) + 1 / (120 * x**4)


def plain_step(weights, docs, every, alpha, pace):
    """One step of online LDA over a dense matrix (words by topics), a document at a time."""
    dig = np.vectorize(digamma)
    beta = np.exp(dig(weights) - dig(weights.sum(axis=0)))
    stats = np.zeros_like(weights)
    for ids in docs:
        gamma, change = np.ones(len(alpha)), 1.0
        while change > topics.SETTLED:
            theta = np.exp(dig(gamma) - digamma(gamma.sum()))
            new = alpha + theta * sum(beta[i] / (beta[i] @ theta + 1e-100) for i in ids)
            change, gamma = np.abs(new - gamma).mean(), new
        theta = np.exp(dig(gamma) - digamma(gamma.sum()))
        for i in ids:
            stats[i] += theta * beta[i] / (beta[i] @ theta + 1e-100)
    return (1 - pace) * weights + pace * (0.01 + stats * every / len(docs))


def dense(model):
    return np.array([r.row for r in model.weights.where(F.col("id") >= 0).join(model.known, "id").orderBy("word").collect()])


@pytest.mark.parametrize("cells", [40, 500_000])
def test_a_step_equals_the_plain_one(spark, monkeypatch, cells):
    monkeypatch.setattr(topics, "PART_CELLS", cells)
    known, docs = topics.encoded(planted(spark), "id", "t", ["Rope"], 2)
    before, after = (topics.Lda(known, docs, 3, n, 0.01, 1) for n in (0, 1))
    words = {r.id: i for i, r in enumerate(known.orderBy("word").collect())}
    first = [[words[i] for i in r.ids] for r in after.docs.where("batch = 0").collect()]
    assert first and docs.count() == 400 and after.docs.count() == 400  # a key that stands twice is two documents
    want = plain_step(dense(before), first, 400, before.alpha, 1025**-0.51)
    assert np.allclose(dense(after), want) and np.allclose(after.totals, want.sum(axis=0))
    assert (after.alpha != before.alpha).all()


def test_planted_topics_without_the_vocabulary_on_the_driver(spark):
    top, of = topics.topic_model(planted(spark), "id", "t", topics=2, iterations=20)
    told = {(r["id"], r.topic): r.weight for r in of.where("rank = 1").collect()}
    assert len({i for i, _ in told}) == 300 and min(told.values()) > 0.9
    best = dict(told)
    assert {t for i, t in best if i % 2} != {t for i, t in best if not i % 2} and len(best) == 300
    assert {(r.topic, r["rank"]) for r in top.collect()} == {(t, n) for t in (0, 1) for n in range(1, 6)}
    for plan in (top, of):  # all words were a literal of the plan
        assert "sail" not in plan._jdf.queryExecution().toString()


def test_no_documents(spark):
    top, of = topics.topic_model(planted(spark).where("false"), "id", "t", topics=2)
    assert top.collect() == [] and of.collect() == []


def test_a_long_document_takes_no_more_memory_than_its_tokens():
    """Every document was padded to the longest one: 4,000 short ones beside one of 40,000 tokens took some GB."""
    lengths = np.array([10] * 4_000 + [40_000])
    r = np.random.default_rng(1)
    words, old = r.integers(0, 50, lengths.sum()), r.integers(0, 2, lengths.sum())
    table = np.bincount(words * 2 + old, minlength=100).reshape(50, 2).astype(float)
    tracemalloc.start()
    totals = table.sum(axis=0)
    new = gibbs.sweeps(words, old, lengths, table, totals, 50, 0.1, 0.01, 1, r)
    assert tracemalloc.get_traced_memory()[1] < 50_000_000
    tracemalloc.stop()
    assert (np.bincount(words * 2 + new, minlength=100).reshape(50, 2) == table).all() and (totals == table.sum(axis=0)).all()


def test_gibbs_rounds_hold_numbers_for_words(spark):
    """The words were strings in every round's tables."""
    model = gibbs.sample(gibbs.terms(planted(spark), "id", "t", [], 2), topics=2, rounds=1)
    assert dict(model.counts.dtypes)["word"] == "bigint" and dict(model.tokens.dtypes)["words"] == "array<bigint>"
    words = [r.word for r in model.known.orderBy("id").collect()]
    assert words == sorted(words) and {r.word for r in gibbs.top_words(model).collect()} <= set(words)
