"""Operators on single texts against the libraries and plain versions of their rules."""

import hashlib
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillstream.llm import bpe, licenses, quality, sharding, simhash, token_counts, toxicity

TEXTS = [
    (1, "The cat's on the mat.\n\n  And <|endoftext|> it's 123 days"), (2, None), (3, ""), (4, "é ü 漢字 \U0001f600​\t x"), (5, "a" * 3000), (6, "word " * 2000), (7, "The cat's on the mat.\n\n  And <|endoftext|> it's 123 days"), (7, "The cat"), (None, "no id"),
    (8, " \r\n\t "), (9, "Zürich, naïve façade; 'twas <|endoftext|><|endoftext|>"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and long texts, repeated ids, columns with clashing names."""
    rows = [(i, t, "x", 5, "s") for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, slot int, size string")


@pytest.fixture(scope="module")
def tokenizer():
    return token_counts.load(token_counts.default_tokenizer())


def ids_of(tokenizer, t):
    return tokenizer.encode(t or "", add_special_tokens=False).ids


def test_token_counts(docs, tokenizer):
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(docs, token_counts.default_tokenizer(), limit=100).collect())
    assert got == sorted((i or 0, len((t or "").encode()), n := len(ids_of(tokenizer, t)), n > 100) for i, t in TEXTS)
    assert token_counts.count_tokens(docs.limit(0), token_counts.default_tokenizer()).count() == 0


@given(st.lists(st.sampled_from([*"ab '1é.\n", "<|endoftext|>", "the ", "  "]), max_size=200).map("".join), st.integers(20, 90), st.integers(1, 20))
@settings(max_examples=150, deadline=None)
def test_huge_texts_are_spliced(text, chunk, overlap):
    t = token_counts.load(token_counts.default_tokenizer())
    assert token_counts.count_huge(text, t, chunk, overlap) == len(t.encode(text, add_special_tokens=False).ids)


def test_bpe(docs, tokenizer):
    got = sorted(((r.doc_id or 0), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip_digests(docs, bpe.default_vocabulary()).collect())
    want = []
    for i, t in TEXTS:
        ids = ids_of(tokenizer, t)
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        want.append((i or 0, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert got == sorted(want)
    one = bpe.encode_column(docs.where("doc_id = 1"), bpe.default_vocabulary()).first()
    assert list(one.ids) == ids_of(tokenizer, TEXTS[0][1]) and one.decoded == TEXTS[0][1]


@given(st.text(max_size=60))
@settings(max_examples=200, deadline=None)
def test_bpe_of_any_text(text):
    own, t = bpe.codec(bpe.default_vocabulary()), token_counts.load(token_counts.default_tokenizer())
    found = own.encode([text])[0]
    assert list(memoryview(found).cast("I")) == t.encode(text, add_special_tokens=False).ids
    assert own.decode(found) == text


@pytest.mark.parametrize("learn_bytes", [3, 50, 400_000])
def test_bpe_of_long_words(monkeypatch, learn_bytes):
    """Unbroken words beyond what is encoded together, or kept; stores that are always full."""
    monkeypatch.setattr(bpe, "LEARN_BYTES", learn_bytes)
    monkeypatch.setattr(bpe, "KEPT", 20)
    monkeypatch.setattr(bpe, "STORE_BYTES", 3000)
    own, t = bpe.Codec(bpe.default_vocabulary()), token_counts.load(token_counts.default_tokenizer())
    r = np.random.default_rng(1)
    texts = ["".join(r.choice(list("abcdefgh éü"[:k]), n)) for k, n in ((8, 3000), (11, 5000), (2, 900), (9, 20))] + ["<|endoftext|>" + "x" * 70, ""]
    for _ in range(3):
        assert [list(memoryview(e).cast("I")) for e in own.encode(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_sharding(docs, spark, tmp_path):
    placed, slot_map = sharding.shard(docs, shards=3, slots=64)
    rows = placed.collect()
    assert len(rows) == len(TEXTS)
    assert sorted((r.doc_id or 0, r.size, r.text_crc32) for r in rows) == sorted((i or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in TEXTS)
    for s in range(3):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    assert sharding.shard(docs.limit(0), shards=3)[0].count() == 0
    many = spark.range(20_000).selectExpr("id as doc_id", "repeat('x', cast(id % 50 as int)) as text")
    placed, slot_map = sharding.shard(many, shards=7, slots=512)
    loads = [r["sum(size)"] for r in placed.groupBy("shard").sum("size").collect()]
    assert max(loads) - min(loads) < 0.01 * sum(loads) / 7
    folder = str(tmp_path / "maps")
    digests = spark.createDataFrame(sharding.digest(many, slots=512).collect(), sharding.digest(many, slots=512).schema)
    assert sharding.save_map(slot_map, folder) == 1
    grown = sharding.grow(sharding.load_map(spark, folder), 7)
    moved = slot_map.join(grown.selectExpr("vslot", "shard as now", "version as v"), "vslot")
    assert moved.where("shard <> now and now <> 7").count() == 0 and moved.where("v <> version + 1").count() == 0
    by = {r.now: r.b for r in moved.groupBy("now").agg({"bytes": "sum"}).withColumnRenamed("sum(bytes)", "b").collect()}
    assert set(by) == set(range(8)) and max(by.values()) < 1.2 * sum(by.values()) / 8
    assert sharding.save_map(grown, folder) == 2 and sharding.versions(spark, folder) == [1, 2]
    with pytest.raises(Exception, match="already exists"):
        sharding.save_map(grown, folder)
    edited = sharding.move(sharding.load_map(spark, folder), {5: 0, 6: 7})
    assert sharding.save_map(edited, folder) == 3
    assert {r.vslot: r.shard for r in edited.where("vslot in (5, 6)").collect()} == {5: 0, 6: 7}
    assert sharding.load_map(spark, folder, 2).join(sharding.load_map(spark, folder), ["vslot", "shard"]).count() >= 510
    for version in (1, 2, 3):
        again = sharding.place(digests, sharding.load_map(spark, folder, version)).collect()
        assert all(sorted(r.slot for r in again if r.shard == s) == list(range(sum(r.shard == s for r in again))) for s in range(8))


@pytest.mark.parametrize("key", ["cast(null as long)", "7L", "if(id % 3 = 0, 7L, id)"])
def test_sharding_without_telling_ids(spark, key):
    """Rows without ids, of one id, or a third of them of one id: the law holds as long as they differ."""
    docs = spark.range(0, 20_000, 1, 4).selectExpr(f"{key} as doc_id", "repeat(cast(id as string), 3) as text", "1 as slot", "2 as vslot", "3 as part")
    placed = sharding.shard(docs, shards=8)[0].collect()
    loads = [sum(r.size for r in placed if r.shard == s) for s in range(8)]
    assert len(placed) == 20_000 and max(loads) - min(loads) < 0.02 * sum(loads) / 8
    assert all(sorted(r.slot for r in placed if r.shard == s) == list(range(sum(r.shard == s for r in placed))) for s in range(8))


def test_sharding_repeated_rows(spark):
    """A third of the rows are one id and one text: they are dealt over the slots, so the law holds."""
    docs = spark.range(0, 6_000, 1, 4).selectExpr("if(id % 3 = 0, 7L, id) as doc_id", "if(id % 3 = 0, 'the same text', repeat(cast(id as string), 3)) as text", "1 as row_key", "2 as spot")
    placed = sharding.shard(docs, shards=8)[0].collect()
    loads = [sum(r.size for r in placed if r.shard == s) for s in range(8)]
    assert len(placed) == 6_000 and max(loads) - min(loads) < 0.02 * sum(loads) / 8
    assert all(sorted(r.slot for r in placed if r.shard == s) == list(range(sum(r.shard == s for r in placed))) for s in range(8))


def brute_fingerprint(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    from xxhash import xxh64_intdigest

    h = [xxh64_intdigest(" ".join(words[k : k + 4]).encode(), seed=42) for k in range(max(1, len(words) - 3))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


@given(st.text(alphabet="aBÉ \n\xa0c", max_size=80))
@settings(max_examples=100)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_long_fingerprint():
    text = " ".join(str(i * i % 997) for i in range(1500))
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def brute_counts(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dup = set(), 0
    for x in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    c = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    rep = {k + j for k in range(len(w) - 2) if c[tuple(w[k : k + 3])] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(rep)


@given(st.text(alphabet="ab# \n\té|\xa0", max_size=80))
@settings(max_examples=200)
def test_base_counts(text):
    assert quality.base_counts(text) == brute_counts(text)


def folded(t):
    return re.sub("[0-9]", "0", re.sub("[\t\n\x0b\x0c\r\x85\xa0\u2028\u2029\u3000]", " ", t))


def brute_grams(texts):
    """n-gram -> (count, holder). Of the texts with one signature the larger count counts."""
    by = {}
    for t, k in zip(texts, quality.signatures(texts).tolist()):
        s = "\0" * 4 + folded(t)
        by[k] = by.get(k, Counter()) | Counter(s[i : i + 5] for i in range(len(s) - 4))
    n, holders = Counter(), {}
    for k, own in by.items():
        n.update(own)
        for g in own:
            holders.setdefault(g, set()).add(k & 0xFFFF)
    return {g: (n[g], h.pop() if len(h) == 1 else quality.SEVERAL) for g, h in holders.items()}


def gram(hi, lo):
    mask = 2**21 - 1
    return "".join(map(chr, (hi >> 42, hi >> 21 & mask, hi & mask, lo >> 21, lo & mask)))


@pytest.mark.parametrize("piece", [7, 50, 2_000_000])
@pytest.mark.parametrize("letters", [3, 40, 30_000])
def test_counted_n_grams(monkeypatch, piece, letters):
    monkeypatch.setattr(quality, "PIECE", piece)
    r = np.random.default_rng(letters)
    texts = ["".join(chr(0x4E00 + x) for x in r.integers(0, letters, n)) + "a1 2\n" * (n % 3) for n in (0, 1, 4, 30, 200, 900)]
    texts += ["", texts[5] + "x", texts[5][:-1], texts[4] + "y"]
    hi, lo, n, holder = (x.tolist() for x in quality.counted(texts))
    want = brute_grams(texts)
    if piece > 900:
        assert {gram(*x): y for *x, y in zip(hi, lo, zip(n, holder))} == want
    assert {gram(*x): y for *x, y in zip(hi, lo, holder)} == {g: h for g, (_, h) in want.items()}
    hashes = quality.hashed(np.array(hi), np.array(lo))
    assert (hashes[1:] > hashes[:-1]).all()
    logp = r.random(len(n)).astype(np.float32)
    of = dict(zip(map(gram, hi, lo), logp.tolist()))
    sums = []
    for t in texts:
        s = "\0" * 4 + folded(t)
        sums.append(-sum(of[s[i : i + 5]] for i in range(len(t))) / max(1, len(t)))
    assert quality.losses(texts, logp) == pytest.approx(sums)


def test_signatures(monkeypatch):
    r = np.random.default_rng(6)
    texts = ["".join(r.choice(list("abc "), n)) for n in (3000, 500, 40, 32, 31, 5, 0)]
    near = [t[:100] + "X" + t[100:] for t in texts]
    found = quality.signatures([*texts, *near])
    assert found[0] == found[7] and len(set(found[:7].tolist())) == 7
    monkeypatch.setattr(quality, "PIECE", 100)
    assert (quality.signatures([*texts, *near]) == found).all() and (quality.signatures(texts[:1]) == found[:1]).all()


def plain_kneser_ney(texts):
    """Log-probability of every 5-gram of one language's texts, by the definition."""
    grams = brute_grams(texts)
    level = {5: {g: n if h == quality.SEVERAL else 0 for g, (n, h) in grams.items()}}
    counts = {5: [n for n, _ in grams.values()]}
    for k in (4, 3, 2, 1):
        level[k] = Counter()
        for g, n in level[k + 1].items():
            level[k][g[1:]] += n > 0
        counts[k] = list(level[k].values())
    lower = {"": 1 / (len(level[1]) + 1)}
    for k in range(1, 6):
        t = [counts[k].count(r) for r in range(5)]
        y = t[1] / max(1, t[1] + 2 * t[2])
        d = [0] + [min(max(r - (r + 1) * y * t[r + 1] / max(1, t[r]), 0.05), r - 0.05) for r in (1, 2, 3)]
        whole, freed = Counter(), Counter()
        for g, n in level[k].items():
            whole[g[:-1]] += n
            freed[g[:-1]] += d[min(n, 3)]
        own = {}
        for g, n in level[k].items():
            c = g[:-1]
            own[g] = (n - d[min(n, 3)]) / whole[c] + freed[c] / whole[c] * lower[g[1:]] if whole[c] else lower[g[1:]]
        lower = own
    return {g: np.log(p) for g, p in lower.items()}


def test_kneser_ney(spark):
    r = np.random.default_rng(3)
    words = ["".join(r.choice(list("abcdé漢"), r.integers(1, 6))) for _ in range(40)]
    texts = [" ".join(r.choice(words, 30)) for _ in range(25)] + ["zq zq 17"]
    docs = spark.createDataFrame([(i, t, "EN-us") for i, t in enumerate([*texts, *texts[:5], None, ""])] + [(99, "zz zz", "deu")], "doc_id long, text string, lang string").repartition(3)
    rows = quality.kneser_ney(quality.count_n_grams(quality.unit_counts(docs, "text", "lang", {"en": 3, "deu": 1, "und": 1}))).collect()
    got = {gram(x.hi, x.lo): x.logp for x in rows if x.lang == "en"}
    assert {x.lang for x in rows} == {"en", "deu"} and got == pytest.approx(plain_kneser_ney(texts), abs=1e-9)
    judged = {x.doc_id: x for x in quality.judge(docs).collect()}
    for i, t in enumerate(texts):
        s = "\0" * 4 + folded(t)
        assert np.log(judged[i].perplexity) == pytest.approx(-sum(got[s[k : k + 5]] for k in range(len(t))) / len(t), abs=1e-4)
    assert len(judged) == docs.count() and judged[25].perplexity > judged[0].perplexity


@pytest.mark.parametrize("units", [1, 40])
def test_units_do_not_matter(spark, monkeypatch, units):
    r = np.random.default_rng(4)
    texts = [" ".join("".join(r.choice(list("abcdef"), r.integers(1, 6))) for _ in range(70)) for _ in range(40)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    monkeypatch.setattr(quality, "LEAST_SHARDS", 1 + units)
    monkeypatch.setattr(quality, "UNIT_BYTES", sum(map(len, texts)) // units)
    monkeypatch.setattr(quality, "SENT_BYTES", 3000)
    want = plain_kneser_ney(texts)
    for x in quality.judge(docs).collect():
        s = "\0" * 4 + texts[x.doc_id]
        assert np.log(x.perplexity) == pytest.approx(-sum(want[s[k : k + 5]] for k in range(len(s) - 4)) / (len(s) - 4), abs=1e-4)


@pytest.mark.parametrize("letters", ["абвгдежзиклмнопрст", "的一是不了人我在有他这中大来上国个到说们为子和你地出道也时"])
def test_quality_rejects_scrambled_scripts(spark, letters):
    """Each letter replaced by one of the same script: every character is common, their sequence isn't."""
    r = np.random.default_rng(5)
    words = ["".join(r.choice(list(letters), r.integers(2, 7))) for _ in range(150)]
    texts = [" ".join(r.choice(words, 90)) for _ in range(300)]
    scrambled = ["".join(c if c == " " else str(r.choice(list(letters))) for c in t) for t in texts[:5]]
    shifted = ["".join(c if c == " " else letters[(letters.index(c) + 4) % len(letters)] for c in t) for t in texts[5:8]]
    docs = spark.createDataFrame([(i, t, "rus") for i, t in enumerate(texts + scrambled + shifted)], "doc_id long, text string, lang string")
    kept = {x.doc_id for x in quality.judge(docs).where("kept").collect()}
    assert kept == set(range(300))


def test_quality(docs):
    got = quality.judge(docs.withColumn("lang", docs.n_tokens)).collect()
    assert len(got) == len(TEXTS)
    assert all(r.base_failed and not r.kept for r in got if (r.n_words or 0) < 50)
    assert quality.judge(docs.limit(0).withColumn("lang", docs.n_tokens)).count() == 0


def test_quality_rejects_gibberish(spark):
    r = np.random.default_rng(0)
    words = ["".join(r.choice(list("etaoin"), 4)) for _ in range(60)]
    text = lambda: " ".join(r.choice(words, 200))
    junk = " ".join("".join(chr(x) for x in r.integers(33, 122, 7)) for _ in range(120))
    docs = spark.createDataFrame([(i, text(), "en") for i in range(400)] + [(999, junk, "en")], "doc_id long, text string, lang string")
    got = {x.doc_id: x.kept for x in quality.judge(docs).collect()}
    assert not got.pop(999) and all(got.values())


@pytest.mark.parametrize("copied", [7, 900])
def test_quality_counts_each_text_once(spark, copied):
    """A third of the rows are copies of one text, clean or junk: no verdict changes."""
    r = np.random.default_rng(1)
    words = ["".join(r.choice(list("etaoinshrdlu"), r.integers(2, 8))) for _ in range(300)]
    text = lambda: " ".join(r.choice(words, r.integers(60, 300)))
    junk = lambda: " ".join("".join(chr(x) for x in r.integers(33, 122, 7)) for _ in range(120))
    rows = [(i, text(), "en") for i in range(400)] + [(900 + i, junk(), "en") for i in range(3)]
    again = next(t for i, t, _ in rows if i == copied)
    schema = "doc_id long, text string, lang string"
    alone = {x.doc_id: (x.kept, round(x.perplexity, 6), round(x.low, 6), round(x.high, 6)) for x in quality.judge(spark.createDataFrame(rows, schema)).collect()}
    assert sorted(i for i, x in alone.items() if not x[0]) == [900, 901, 902]
    docs = spark.createDataFrame([*rows, *[(1000 + i, again, "en") for i in range(202)]], schema).repartition(7)
    got = {x.doc_id: (x.kept, round(x.perplexity, 6), round(x.low, 6), round(x.high, 6)) for x in quality.judge(docs).collect()}
    assert {i: x for i, x in got.items() if i < 1000} == alone
    assert all(got[1000 + i] == alone[copied] for i in range(202))


def test_quality_pools():
    got = quality.pools({("en", 8): 5, ("en", 9): 300, ("en", 10): 300, ("en", 14): 2, ("fr", 9): 1}, 200)
    assert {(k, g): {x for n, o, x in got if (n, o) == (k, g)} for k, g, _ in got} == {("en", 8): {8, 9}, ("en", 9): {8, 9, 10}, ("en", 10): {9, 10}, ("en", 14): {10, 14}, ("fr", 9): {9}}


def test_folding():
    assert toxicity.fold("You IDIOT!") == " you idiot "
    assert toxicity.fold("1d10t іdіоt i.d.i.o.t idiooooot îdïot") == " idiot idiot idiot idiot idiot "
    assert toxicity.fold("$tupid @ll 42") == " stupid aii 42 "
    assert toxicity.fold("") == "  "


def test_toxicity(spark):
    r = np.random.default_rng(1)
    plain = [f"w{i}x" for i in range(300)]
    rows, labels = [], []
    for i in range(600):
        words = list(r.choice(plain, 60))
        toxic = i % 5 == 0
        if toxic:
            for at in r.choice(60, 4, replace=False):
                words[at] = str(r.choice(["fiend", "wretch", "villain"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    rows += [(1000, "f1end " * 4 + " ".join(plain[:50])), (1001, None), (1002, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (5000, 1, 1), (None, 0, 1), (3, 0, None)], "doc_id long, quality int, toxic int")
    got = {x.doc_id: x for x in toxicity.judge(docs, marks).collect()}
    assert len(got) == len(rows)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _ in rows)
    assert all(got[i].predicted == int(i % 5 == 0) for i in range(600))
    assert got[1000].predicted == 1 and got[1001].predicted == got[1002].predicted == 0
    assert all(0 <= x.score <= 1 for x in got.values())
    nothing = toxicity.judge(docs, marks.limit(0)).select("score").distinct().collect()
    assert [round(x.score, 6) for x in nothing] == [toxicity.PRIOR]


def plain_lexicon(rows):
    """Weights and exceptions from (text, toxic) rows, by the definition."""
    folded = {(i, toxicity.fold(t or "")): (toxicity.near_key(toxicity.fold(t or "")), y) for i, t, y in rows}
    near = Counter(k for k, _ in folded.values())
    seen = {False: Counter(), True: Counter()}
    pairs = {False: Counter(), True: Counter()}
    total = Counter()
    for (_, t), (k, y) in folded.items():
        w = 1 / near[k]
        total[y > 0] += w
        words = t.split()
        for x in set(words):
            seen[y > 0][x] += w
        for x in {f"{a} {b}" for a, b in zip(words, words[1:])}:
            pairs[y > 0][x] += w
    share = total[True] / (total[True] + total[False])
    known = [x for x in seen[True].keys() | seen[False].keys() if seen[True][x] + seen[False][x] >= toxicity.LEAST_DOCS - 1e-6]
    weights = {}
    for x in known:
        a, b = seen[True][x], seen[False][x]
        gain = 2 * (a * np.log(max(a, 0.5) / (a + b) / share) + b * np.log(max(b, 0.5) / (a + b) / (1 - share)))
        odds = np.log((a + 0.5) / (total[True] + 1)) - np.log((b + 0.5) / (total[False] + 1))
        if odds > 1.5 and gain > 2 * np.log(max(2, len(known))):
            weights[x] = odds
    spared = {x for x, n in pairs[False].items() if n >= toxicity.LEAST_DOCS - 1e-6 and n * share > 4 * pairs[True][x] * (1 - share) and set(x.split()) & weights.keys()}
    return weights, spared


def test_toxicity_against_the_definition(spark):
    """The lexicon, near copies, repeated rows, odd labels and columns."""
    r = np.random.default_rng(4)
    plain = [f"w{i}x" for i in range(200)]
    rows = []
    for i in range(500):
        words = list(r.choice(plain, 40))
        if i % 4 == 0:
            words[5:7] = [str(r.choice(["fiend", "wretch"])), str(r.choice(["now", "then"]))]
        elif i % 25 == 1:
            words[5:7] = ["dear", "fiend"]
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    rows += [(600 + i, rows[0][1] + f" end{i}", 1) for i in range(30)]
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(700, 1), (701, None)], "doc_id long, toxic int")
    docs = spark.createDataFrame([(i, t, 1.0, 1, "x") for i, t, _ in [*rows, *rows[:50], (700, None, 1), (702, "w1x", 0)]], "doc_id long, text string, score double, toxic int, folded string")
    lexicon = toxicity.learn(docs, labels)
    trained = [(i, t, y) for i, t, y in [*rows, (700, None, 1)] if zlib.crc32(str(i).encode()) % 3 != 1]
    weights, spared = plain_lexicon(trained)
    assert lexicon.weights == pytest.approx(weights) and {"fiend", "wretch"} <= weights.keys()
    assert lexicon.exceptions == spared and "dear fiend" in spared
    got = toxicity.judge(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted", "weighted"] and got.count() == docs.count()
    long = spark.createDataFrame([(1, "w1x " * 200_000 + "fiend wretch " * 50_000), (2, "w1x " * 200_000)], "doc_id long, text string")
    scores = {x.doc_id: x.score for x in toxicity.score(long, lexicon).collect()}
    assert scores[1] > scores[2]


@pytest.mark.parametrize("rows", [10, 60])
def test_training_rows_are_bounded(spark, rows):
    """Also where one id stands at many texts."""
    docs = spark.createDataFrame([(i % 20, f"text number {i} of many") for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    assert 0 < toxicity.training_rows(docs, labels, rows).count() <= rows


def test_exception_phrases():
    lexicon = toxicity.Lexicon({"fiend": 3.0}, frozenset({"dear fiend"}))
    a = lexicon.automaton()
    assert lexicon.features(" you fiend ", a)[0] > 0
    assert lexicon.features(" my dear fiend ", a) == (0.0, 0.0)
    assert lexicon.features(" dear fiend and fiend ", a)[1] == pytest.approx(np.log(2))


def full_alignment(template, words):
    """(score, equal words, first, last) of the best alignment of any part of the template, without a band or an index: three for each equal word, less the words of the span."""
    best, row = (0, 0, 0, -1), {}
    ends = {}  # (template place, text place) of the last equal word -> best alignment so far
    for i, w in enumerate(template):
        for j, x in enumerate(words):
            if x == w:
                options = [(2, 1, j, j)]
                for (a, b), (score, n, first, _) in ends.items():
                    if a < i and b < j:
                        options.append((score + 3 - (j - b), n + 1, first, j))
                ends[i, j] = max(options, key=lambda o: (o[0], o[1]))
    return max(ends.values(), key=lambda o: (o[0], o[1], -o[3]), default=best)


def brute_scan(text, templates, least=0.8):
    """Every template against the whole text, its name wherever it stands."""
    words = licenses.WORD.findall(text.lower())
    found = []
    for (k, kind), t in templates.items():
        t = licenses.Template.of(k, kind, t)
        n = len(t.words)
        if t.b > t.a:
            spots = [p for p in range(len(words)) if tuple(words[p : p + t.b - t.a]) == t.words[t.a : t.b]]
        else:
            spots = [None]
        for p in spots:
            if p is None:
                _, m, first, last = full_alignment(t.words, words)
            else:
                spare = int((1 - least) * n + 1e-9)
                sides = []
                for side, near in ((t.words[: t.a][::-1], words[max(0, p - t.a - spare) : p][::-1]), (t.words[t.b :], words[p + t.b - t.a : p - t.a + n + spare])):
                    marked = full_alignment((None, *side), [None, *near])  # the name's end has to be in it
                    sides.append((marked[1] - 1, marked[3]))
                m, first, last = sides[0][0] + sides[1][0] + t.b - t.a, p - sides[0][1], p + t.b - t.a - 1 + sides[1][1]
            if m >= least * n - 1e-9 and last - first + 1 - m <= (1 - least) * n + 1e-9:
                found.append((k, kind, first, last, n, m))
    return [(f[0], f[1], f[2], f[3], f[5]) for f in licenses.best_matches(found)]


NOTICES = {("MIT", "a"): "Released under the {MIT License}", ("MIT", "b"): "Distributed under the terms of the {MIT License}", ("GPL-3.0", "a"): "This work is licensed under the {GNU General Public License, version 3}", ("Q", "a"): "a {b c} d e f g"}


@given(st.lists(st.sampled_from(["released", "under", "the", "mit license", "mit", "gnu general public license version 3", "this work is licensed", "x", "terms of the", "distributed", "a b c", "d e", "f g", "d f g"]), max_size=12).map(" ".join))
@settings(max_examples=400, deadline=None)
def test_notices_against_every_alignment(text):
    spans = [m.span() for m in licenses.WORD.finditer(text)]
    got = [(k, kind, start, end, m) for k, kind, start, end, _, m, _, _ in licenses.scan_text(text, licenses.Index(NOTICES))]
    assert got == [(k, kind, spans[a][0], spans[b][1], m) for k, kind, a, b, m in brute_scan(text, NOTICES)]


@pytest.mark.parametrize("seed", range(12))
def test_edited_texts_against_every_alignment(seed):
    """Words replaced, left out and put in: up to the limits, and beyond."""
    r = np.random.default_rng(seed)
    name = sorted(licenses.TEXTS)[seed % len(licenses.TEXTS)]
    one = {(name, "text"): licenses.TEXTS[name]}
    words = []
    for w in licenses.WORD.findall(licenses.TEXTS[name].lower()):
        x = r.random() * 60 / (seed + 4)
        words += [] if x < 0.4 else ["foreign"] if x < 0.8 else [w, "more"] if x < 1.2 else [w]
    text = "some words before " + " ".join(words) + " and some after"
    spans = [m.span() for m in licenses.WORD.finditer(text)]
    got = [(k, kind, start, end, m) for k, kind, start, end, _, m, _, _ in licenses.scan_text(text, licenses.Index(one))]
    assert got == [(k, kind, spans[a][0], spans[b][1], m) for k, kind, a, b, m in brute_scan(text, one)]


def test_licenses(spark):
    mit = licenses.TEXTS["MIT"]
    header = licenses.TEMPLATES["LGPL-3.0-or-later", "header 3"].replace("{", "").replace("}", "")
    texts = {
        1: "Intro. " + mit + " End.", 2: "x " + mit.replace("free of charge", "at no cost").replace("sublicense", "") + " y", 3: "Released under the MIT License.", 4: "Licensed under nothing at all.", 5: None, 6: "",
        7: "Licensed under the Apache License, Version 2.0.\n" * 3, 8: mit[: len(mit) // 2], 9: "Released under MIT License", 10: header, 11: "word " * 200_000 + "Licensed under CC BY-NC 4.0.",
    }
    docs = spark.createDataFrame([(i, t, "z", 1.0) for i, t in [*texts.items(), (3, texts[3]), (None, texts[3])]], "doc_id long, text string, start string, coverage double")
    got = {}
    for r in licenses.scan(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert {k: [x.license_id for x in v] for k, v in got.items()} == {1: ["MIT"], 2: ["MIT"], 3: ["MIT"] * 2, 7: ["Apache-2.0"] * 3, 9: ["MIT"], 10: ["LGPL-3.0-or-later"], 11: ["CC-BY-NC-4.0"], None: ["MIT"]}
    assert got[1][0].coverage == 1 and texts[1][got[1][0].start : got[1][0].end] == mit[:-1]
    words = licenses.WORD.findall(texts[2].lower())
    _, m, first, last = full_alignment(licenses.Template.of("MIT", "text", mit).words, words)
    assert (got[2][0].matched_words, got[2][0].inserted_words) == (m, last - first + 1 - m)
    assert licenses.scan(docs.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("text", "license_id"),
    [
        ("This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", "CC-BY-NC-ND-4.0"),
        ("Licensed under the GNU Lesser General Public License, version 2.1", "LGPL-2.1"),
        ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
        ("licensed under CC BY-NC-ND 4.0", "CC-BY-NC-ND-4.0"),
        ("This work is licensed under a Creative Commons Attribution-Whatever 4.0 License", None),
        ("Licensed under the GNU Fancy General Public License, version 2", None),
        ("The MIT License is a text.", None),
        ("SPDX-License-Identifier: AGPL-3.0-or-later", "AGPL-3.0-or-later"),
    ],
)
def test_license_variants(text, license_id):
    assert [f[0] for f in licenses.scan_text(text, licenses.Index(licenses.TEMPLATES))] == [license_id] * (license_id is not None)


@pytest.mark.parametrize("license_id", sorted(licenses.TEXTS))
def test_license_texts(license_id):
    text = licenses.TEXTS[license_id]
    found = licenses.scan_text("begin " + text + " end", licenses.Index(licenses.TEMPLATES))
    assert [(f[0], f[-1]) for f in found] == [(license_id, 1.0)]
