"""Operators over whole corpora against plain versions of their contracts."""

import collections
import gzip
import hashlib
import random
import re

import numpy as np
import pyarrow.compute  # noqa: F401  for tables' filters
import pytest
from pyspark.sql import functions as F

from quillstream.llm import decontamination, graph, simhash, suffix_dedup, warc
from quillstream.llm.suffix_array import suffix_array


def near_texts(n, seed=4):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    out = []
    for i in range(n):
        if i % 3 and out:
            w = r.choice(out).split()
            for _ in range(r.randrange(4)):
                w[r.randrange(len(w))] = r.choice(words)
            out.append(" ".join(w))
        else:
            out.append(" ".join(r.choice(words) for _ in range(r.randrange(30, 200))))
    return out


def brute_components(prints, radius=4):
    ids = sorted(prints)
    of = {i: i for i in ids}

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = root(a), root(b)
                of[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize(("shard_points", "tree_points"), [(8192, 2**27), (16, 2**27), (16, 0), (1, 0)])
def test_simhash(spark, monkeypatch, shard_points, tree_points):
    monkeypatch.setattr(simhash, "TREE_POINTS", tree_points)
    texts = near_texts(240)
    rows = [*enumerate(texts), (900, None), (901, ""), (902, " \n"), (7, texts[7]), (None, texts[0]), (None, "quite another text than any of the others here")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string")
    got = simhash.components(docs, shard_points=shard_points).select("doc_id", simhash.hexadecimal().alias("h"), "component_id").collect()
    prints = {i: simhash.fingerprint(t) for i, t in rows if i is not None}
    want = brute_components(prints)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.h, r.component_id) == (f"{prints[r.doc_id]:016x}", want[r.doc_id])
    assert sorted(str(r.component_id) for r in got if r.doc_id is None) == ["0", "None"]
    assert simhash.components(docs.limit(0)).count() == 0


def test_masks():
    """Any two points that differ in 4 bits agree in one mask's bits; masks grow with the points."""
    r = random.Random(3)
    for n in (10, 2**28, 2**36, 2**45):
        found = [int(m) for m in simhash.masks(n, 4, 8192)]
        assert n / 2 ** min(m.bit_count() for m in found) <= 2 * 8192
        for _ in range(200):
            off = sum(1 << b for b in r.sample(range(64), 4))
            assert any(not m & off for m in found)


def test_block_radii():
    for radius in range(7):
        for blocks in range(1, 8):
            assert sum(r + 1 for r in simhash.block_radii(radius, blocks)) == radius + 1


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 102), (102, 101), (7, 7), (200, 100)]
    r = random.Random(1)
    edges = [(b, a) if r.random() < 0.5 else (a, b) for a, b in edges]
    got = dict(graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(1, 61)} | {101: 100, 102: 100, 200: 100}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 10, 257])
@pytest.mark.parametrize("letters", [1, 2, 60])
def test_suffix_array(n, letters):
    s = np.random.default_rng(n).integers(1, letters + 1, n)
    for prefix in (5, 50, n + 1):
        order = suffix_array(s, prefix)
        keys = [tuple(s[i : i + prefix]) for i in order]
        assert sorted(order) == list(range(n)) and keys == sorted(keys)


def brute_removals(rows, window=50):
    rows = [(2**63 - 1 if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in rows:
        for p in range(len(b) - window + 1):
            k = b[p : p + window]
            first[k] = min(first.get(k, i), i)
    out = []
    for i, b in rows:
        gone = bytearray(len(b))
        for p in range(len(b) - window + 1):
            if first[b[p : p + window]] < i:
                gone[p : p + window] = b"\1" * window
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, y in zip(b, gone) if not y)).hexdigest()))
    return sorted(out)


def test_suffix_dedup(spark):
    r = random.Random(2)
    passage = "".join(r.choice("abcdefgh ") for _ in range(130))
    rows = [(i, "".join(r.choice("ab") for _ in range(r.choice([0, 10, 60, 300]))) + "ab" * r.choice([0, 40]) + "é" * r.choice([0, 60])) for i in range(60)]
    rows += [(100 + i, "".join(r.choice("xyz ") for _ in range(40)) + passage[r.randrange(40) : 90 + r.randrange(40)] + "q" * r.randrange(90)) for i in range(40)]
    rows += [(None, "ab" * 60), (3, None), (3, "ab" * 100), (5, ""), (300, passage * 30), (301, passage * 30)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n_removed string").repartition(3)
    for sizes in ({}, {"block_bytes": 3000, "bucket_bytes": 2000}):
        got = sorted((2**63 - 1 if q.doc_id is None else q.doc_id, q.n_bytes, q.n_removed, q.n_spans, q.kept_sha256) for q in suffix_dedup.removals(docs, **sizes).collect())
        assert got == brute_removals(rows)
    assert suffix_dedup.deduplicate(docs, count=None).columns == ["doc_id", "text", "n_removed"]
    clashing = {c: F.lit(c) for c in ("_text", "_id", "_was_null", "body", "c0", "was_null", "block", "rest")}
    assert {tuple(r)[3:] for r in suffix_dedup.deduplicate(docs.withColumns(clashing), count="gone").select("doc_id", "text", "gone", *clashing).collect()} == {tuple(clashing)}
    cut = suffix_dedup.deduplicate(docs.drop("n_removed").withColumn("lang", F.lit("en")))
    assert cut.columns == ["doc_id", "text", "lang", "n_removed"]
    assert sorted(str(q.text) for q in cut.where("doc_id = 3").collect() if q.text is None) == ["None"]
    assert suffix_dedup.removals(docs.limit(0)).count() == 0
    most = spark.createDataFrame([(2**63 - 1, "x"), (None, "y")], "doc_id long, text string")
    assert sorted((q.doc_id or 0, q.n_bytes) for q in suffix_dedup.removals(most).collect()) == [(0, 1), (2**63 - 1, 1)]


def test_hot_anchors(spark):
    """Many near copies that differ in one place, in each of several blocks: their windows are sent apart."""
    r = random.Random(13)
    whole = "".join(r.choice("abcdefgh ") for _ in range(400))
    rows = [(i, whole[:200] + f" {r.randrange(10**9)} " + whole[200:]) for i in range(300)] + [(1000 + i, whole[150:260]) for i in range(5)]
    rows += [(2000 + i, "".join(r.choice("xyz ") for _ in range(120))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    own = suffix_dedup.Block(np.arange(300).astype("<i8").tobytes(), np.cumsum([len(t) for _, t in rows[:300]]).astype("<i8").tobytes(), __import__("zstandard").ZstdCompressor().compress("".join(t for _, t in rows[:300]).encode()))
    assert own.told()[4].any()  # there are hot ones
    for sizes in ({}, {"block_bytes": 20_000, "bucket_bytes": 5000}):
        got = sorted((q.doc_id, q.n_bytes, q.n_removed, q.n_spans, q.kept_sha256) for q in suffix_dedup.removals(docs, **sizes).collect())
        assert got == brute_removals(rows)


@pytest.mark.parametrize("different", [32, 1, 0])
def test_hashes_decide_nothing(spark, monkeypatch, different):
    """With hashes that hardly differ all results are the same: bytes and the suffix order decide."""
    plain = suffix_dedup.stretches

    def weak(*args):
        first, last, anchor, content = plain(*args)
        return first, last, anchor & ~((1 << (suffix_dedup.ANCHOR_BITS - 2)) - 1), content * 0

    monkeypatch.setattr(suffix_dedup, "stretches", weak)
    monkeypatch.setattr(suffix_dedup, "DIFFERENT", different)
    monkeypatch.setattr(suffix_dedup, "WINDOWS", 50)
    r = random.Random(12)
    passage = "".join(r.choice("abcdefgh ") for _ in range(200))
    rows = [(i, "".join(r.choice("abc ") for _ in range(r.choice([0, 60, 200]))) + passage[r.randrange(60) : 90 + r.randrange(90)] * r.choice([0, 1, 2])) for i in range(40)]
    got = []
    blocks = [rows[:15], rows[15:25], rows[25:]]
    own = []
    for b in blocks:  # blocks made here, as the weak hash isn't known to workers
        bodies = [t.encode() for _, t in b]
        own.append((np.array([i for i, _ in b], "<i8").tobytes(), np.cumsum([len(x) for x in bodies]).astype("<i8").tobytes(), __import__("zstandard").ZstdCompressor().compress(b"".join(bodies))))
    opened = [suffix_dedup.Block(*x) for x in own]
    packed = [suffix_dedup.pack(np.diff(x[0], prepend=0), *x[1:]) for x in (o.told() for o in opened)]
    told = suffix_dedup.decide(suffix_dedup.part_rows([(k, 0, 0, p) for k, p in enumerate(packed)]))
    left = [suffix_dedup.pa.table({"block": [k], "ids": [x[0]], "ends": [x[1]], "body": [x[2]]}) for k, x in enumerate(own)]
    send = suffix_dedup.senders(1)
    sent = [send(left[k], told.filter(suffix_dedup.pa.compute.equal(told["block"], k))) for k in range(3)]
    whole = suffix_dedup.pa.concat_tables(sent)
    found = suffix_dedup.pa.concat_tables([suffix_dedup.compare(whole.filter(suffix_dedup.pa.compute.equal(whole["bucket"], b))) for b in set(whole["bucket"].to_pylist())])
    for k, o in enumerate(opened):
        gone = suffix_dedup.removed_bytes(o, found.filter(suffix_dedup.pa.compute.equal(found["block"], k)))
        got += [tuple(x.values()) for x in suffix_dedup.digest_table(o, gone, None).to_pylist()]
    assert sorted(got) == brute_removals(rows) and sum(x[2] for x in got) > 1000


def test_long_text_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 700)
    r = random.Random(5)
    text = "".join(r.choice("abcd ") for _ in range(5000))
    raw, ends = np.frombuffer(text.encode(), np.uint8), np.array([2000, 2030, 5000])
    whole = suffix_dedup.stretches(raw, ends, 0, 5000)
    windows = lambda s: {(p, a) for f, l, a in zip(s[0], s[1], s[2]) for p in range(f, l + 1)}  # noqa: E731, E741
    parts = [suffix_dedup.stretches(raw, ends, a, min(5000, a + 700)) for a in range(0, 5000, 700)]
    assert set().union(*map(windows, parts)) == windows(whole)
    assert {p for p, _ in windows(whole)} == {*range(0, 1951), *range(2030, 4951)}


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute_contamination(docs, items):
    windows = collections.defaultdict(set)
    for i, t in items:
        w = WORD.findall(lower(t))
        n = min(13, len(w))
        for k in range(len(w) - n + 1) if w else ():
            windows[tuple(w[k : k + n])].add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w, hit, found = WORD.findall(lower(t)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[x]
        out.append((str(i), len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


@pytest.mark.parametrize("slice_bytes", [32_000_000, 4_000])
def test_decontamination(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(decontamination, "SLICE_BYTES", slice_bytes)
    r = random.Random(6)
    words = [*"abcde", "é", "İx", "Kelvin", "word", "x1", "99"]
    text = lambda n: "".join(r.choice(words) + r.choice([" ", ", ", "-", "\n"]) for _ in range(n))
    items = [(i, text(r.choice([0, 1, 2, 3, 8, 13, 14, 30]))) for i in range(14)] + [(50, None), (None, text(20)), (3, text(16))]
    docs = [(i, text(r.randrange(60))) for i in range(40)]
    docs += [(100 + i, text(9) + " " + (r.choice(items)[1] or "").upper().replace("É", "é") + " " + text(9)) for i in range(40)]
    docs += [(200, None), (201, ""), (202, ",,,"), (203, docs[45][1]), (203, docs[45][1]), (203, "other"), (204, (items[5][1] or "") * 40)]
    left = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, n_hit int").repartition(3)
    right = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, words string")
    got = sorted((str(q.doc_id), q.n_words, q.n_hit, q.n_items, q.items_sha256, q.contaminated) for q in decontamination.digests(decontamination.scan(left, right)).collect())
    assert got == brute_contamination(docs, items)
    assert decontamination.scan(left.limit(0), right).count() == 0
    assert decontamination.scan(left, right.limit(0)).where("contaminated or n_hit > 0").count() == 0


def test_warc(spark, tmp_path):
    big, other = "<p>é" + "x" * 1200, "<p>" + "y" * 999
    rows = [(1, "http://www.Example.com/a?b=2&a=1", big), (2, "http://example.com/a?a=1&b=2", big), (3, "https://sub.example.org:8080/", other), (4, None, other), (5, "http://b.net/x y", "small"), (6, "http://b.net/z", "small"), (7, "http://[bad", None), (2, "http://example.com/again", big)]
    pages = spark.createDataFrame([(i, u, h, "r") for i, u, h in rows], "page_id long, url string, html string, record_type string").repartition(3)
    indexed, folder = warc.archive(pages, str(tmp_path / "warc"))
    got = sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or 0) for r in warc.read(indexed, folder).collect())
    latest = {}
    for i, _, h in rows:
        latest[h] = max(i, latest.get(h, 0))
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        revisit = len(b) >= 1000 and latest[h] != i
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", latest[h] if revisit else 0))
    assert got == sorted(want)
    found = warc.lookup(indexed, folder, ["http://example.com/a?a=1&b=2", "http://b.net/x y", "http://nowhere.net/"]).collect()
    assert sorted((r.page_id, r.record_type, bytes(r.payload)) for r in found) == [(1, "revisit", big.encode()), (2, "response", big.encode()), (5, "response", b"small")]
    assert warc.round_trip(pages.limit(0)).count() == 0
    whole = gzip.decompress(next((tmp_path / "warc").glob("*.warc.gz")).read_bytes())
    assert whole.startswith(b"WARC/1.1\r\nWARC-Type: ")


def headers_of(archive):
    """The headers of each record of an archive, read from its start to its end without the index."""
    raw, out = gzip.decompress(archive.read_bytes()), []
    while raw:
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:] if ": " in x)
        raw = rest[int(fields["Content-Length"]) + 4 :]
        out.append(fields)
    return out


def test_warc_records(spark, tmp_path):
    """Ids of their own for repeated rows and null ids, an archive's first record, dates in UTC, very long payloads."""
    big, huge = "z" * 1500, "long " * 400_000
    rows = [(1, "http://a.net/", big, "2023-05-06 07:08:09")] * 3 + [(None, "http://b.net/", "n", None)] * 2 + [(2, "http://c.net/", big, "2024-02-29 00:00:00"), (3, "http://d.net/", huge, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, at string").withColumn("date", F.lit("clash")).withColumn("at", F.col("at").cast("timestamp")).repartition(3)
    folder = str(tmp_path / "warc")
    directory = warc.index(warc.write(warc.plan(pages, captured="at"), folder), folder)
    archives = [headers_of(p) for p in (tmp_path / "warc").glob("*.warc.gz")]
    assert all(a[0]["WARC-Type"] == "warcinfo" for a in archives)
    records = [f for a in archives for f in a[1:]]
    ids = [f["WARC-Record-ID"] for a in archives for f in a]
    assert len(records) == len(rows) and len(set(ids)) == len(ids)
    dated = {(f.get("X-Page-ID"), f["WARC-Date"]) for f in records if f.get("X-Page-ID") in ("1", "2")}
    assert dated == {("1", "2023-05-06T07:08:09Z"), ("2", "2024-02-29T00:00:00Z")}
    assert {f["WARC-Type"] for f in records if f.get("X-Page-ID") == "1"} == {"revisit"}
    assert max(r.payload_bytes for r in warc.read(directory, folder).collect()) == len(huge)


def test_surt():
    assert warc.safe_surt("http://www.Example.com:80/A?b=2&a=1") == "com,example)/a?a=1&b=2"


def test_lookups_in_many_blocks(spark, tmp_path):
    """Each URL by the directory against the plain captures; one URL fills many blocks."""
    rows = [(i, f"http://h{i % 7}.com/{i % 3 if i % 7 else 0}", "x" * 1500 if i % 4 == 0 else f"page {i}") for i in range(120)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder = str(tmp_path / "warc")
    directory = warc.index(warc.write(warc.plan(pages), folder), folder, block_lines=4)
    parts = directory.collect()
    assert sum(p.n_lines for p in parts) == 120 and all(p.n_lines <= 4 and p.first_key <= p.last_key for p in parts)
    for urls in (["http://h0.com/0"], ["http://h3.com/1", "http://www.h5.com/2"], sorted({u for _, u, _ in rows}), ["http://h9.com/"]):
        got = sorted((r.page_id, bytes(r.payload).decode()) for r in warc.lookup(directory, folder, urls).collect())
        keys = {warc.key_of(u) for u in urls}
        assert got == sorted((i, h) for i, u, h in rows if warc.key_of(u) in keys)


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(8)
    words = ["".join(r.choice("etaoinshr") for _ in range(r.randrange(2, 8))) for _ in range(500)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    item = text(30)
    rows = [(i, text(r.randrange(80, 200))) for i in range(60)]
    rows += [(100, rows[5][1]), (101, rows[6][1] + " more"), (102, "too short"), (103, text(60) + " " + item + " " + text(60)), (104, text(90) + " " + rows[7][1][:120] + " " + text(90))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {x.doc_id: x for x in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == {*range(60), 104} | ({101} if simhash.fingerprint(rows[61][1]) and 101 in got else set())
    tokens = __import__("tokenizers").Tokenizer.from_file(__import__("public_tokenizers").path("byte_bpe_50k.json"))
    assert got[3].n_tokens == len(tokens.encode(rows[3][1], add_special_tokens=False).ids)
    assert got[104].n_tokens < len(tokens.encode(rows[64][1], add_special_tokens=False).ids)
    at = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, str(tmp_path))
        assert at.columns == corpus_pipeline.COLUMNS


def test_stages_take_odd_tables(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(9)
    words = ["".join(r.choice("etaoinshr") for _ in range(r.randrange(2, 8))) for _ in range(300)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    same = text(120)
    rows = [(1, text(100), "en", "s", 1), (1, text(100), None, None, None), (2, same, "en", "s", 2), (2, same, "en", "s", 2), (None, text(90), "en", None, 3), (None, None, None, None, None), (3, None, "en", "s", 0), (4, "", "en", "s", 0), (5, text(30_000), "en", "s", 5), (6, same, "fr", "s", 2)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    spark.createDataFrame([(1, text(20))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    want = {
        "quality_rules": [1, 1, 2, 2, None, 5, 6], "simhash_near_dedup": [1, 1, 2, 3, 5, None], "suffix_array_dedup": [1, 1, 2, 2, 3, 4, 5, None, None], "benchmark_decontamination": [1, 1, 2, 2, 3, 4, 5, 6, None, None],
    }
    for name, stage in corpus_pipeline.STAGES:
        for given in (docs, docs.limit(0), docs.withColumns({c: F.lit(i) for i, c in enumerate(("fp", "component_id", "n_removed", "words", "_text", "_was_null", "body", "c0", "row", "key1", "model_lang", "_model_lang", "kept", "text_key", "_id", "group"))})):
            got = stage(spark, given, str(tmp_path))
            if name in want:
                assert got.columns == corpus_pipeline.COLUMNS
                found = sorted((x.doc_id for x in got.collect()), key=str)
                if given.limit(1).count():
                    assert found == sorted(want[name], key=str), name
                else:
                    assert not found
            else:
                assert got.count() == (len(rows) if given.limit(1).count() else 0)


def test_stages_judge_each_row(spark, tmp_path):
    """Unrelated texts share an id; copies and contaminated texts have none."""
    import corpus_pipeline

    r = random.Random(5)
    text = lambda n: " ".join("".join(r.choice("etaoinshr") for _ in range(r.randrange(3, 9))) for _ in range(n))
    a, b, copy, item = text(90), text(80), text(70), text(20)
    leaked = f"{text(30)} {item} {text(30)}"
    rows = [(1, a, "en", "s", 1), (1, b, "en", "s", 1), (None, copy, "en", "s", 1), (None, copy, "en", "t", 1), (4, a, "en", "s", 1), (None, b, "en", "s", 1), (None, leaked, "en", "s", 1), (5, leaked, "en", "s", 1), (5, copy + " end", "en", "s", 1)]
    docs = spark.createDataFrame([*rows, *[(7, text(60), "en", "s", i) for i in range(12)]], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    near = [(x.doc_id, x.text) for x in corpus_pipeline.near_copies(spark, docs, str(tmp_path)).collect()]
    assert sorted(t for i, t in near if i == 1) == sorted([a, b]) and sum(i == 7 for i, _ in near) == 12
    assert not {a, b, leaked} & {t for i, t in near if i is None} and sum(t == copy for _, t in near) <= 1 and (4, a) not in near
    clean = [(x.doc_id, x.text) for x in corpus_pipeline.benchmark_passages(spark, docs, str(tmp_path)).collect()]
    assert sorted(clean, key=str) == sorted(((x.doc_id, x.text) for x in docs.collect() if x.text != leaked), key=str)


def test_kept_documents_are_the_judged_ones(spark):
    from quillstream.llm import quality

    docs = spark.createDataFrame([(i, t + (" " + t if i % 7 == 0 else ""), "en") for i, t in enumerate(near_texts(120))], "doc_id long, text string, lang string")
    kept = sorted(x.doc_id for x in quality.kept_documents(docs).collect())
    assert kept == sorted(x.doc_id for x in quality.judge(docs).where("kept").collect()) and 0 < len(kept) < 120


def test_bands_against_numpy(spark):
    """Verdicts from losses by the definition: pools of neighbouring lengths, medians, widths."""
    from quillstream.llm import quality

    docs = spark.createDataFrame([(i, t, "en" if i % 3 else "deu") for i, t in enumerate(near_texts(300, 7))], "doc_id long, text string, lang string")
    rows = {x.doc_id: x for x in quality.judge(docs).collect()}
    good = {}
    for x in rows.values():
        if not x.base_failed:
            good.setdefault((x.model_lang, x.n_chars.bit_length() - 1), {})[docs_key(docs, x.doc_id)] = np.log(x.perplexity)
    sizes = {k: len(v) for k, v in good.items()}
    lower_median = lambda v: sorted(v)[(len(v) - 1) // 2]
    for x in rows.values():
        cell = (x.model_lang, x.n_chars.bit_length() - 1)
        if x.base_failed or cell not in good:
            assert not x.kept
            continue
        pool = [(loss, np.sqrt(2.0 ** (g - cell[1]))) for k, own, g in quality.pools(sizes, quality.LEAST_TEXTS) if (k, own) == cell for loss in good[k, g].values()]
        middle = lower_median([p[0] for p in pool])
        spread = 1.4826 * lower_median([abs(p[0] - middle) * p[1] for p in pool])
        wider = 1 + quality.FEW / len(pool)
        low = middle - wider * max(quality.LOW_SPREADS * spread, quality.LOW_LEAST / x.n_chars**0.5)
        high = middle + wider * max(quality.HIGH_SPREADS * spread, quality.HIGH_LEAST)
        assert (x.low, x.high) == (pytest.approx(low, abs=2e-3), pytest.approx(high, abs=4e-3)) and x.kept == (x.low <= np.log(x.perplexity) <= x.high)


def docs_key(docs, i, cache={}):  # noqa: B006
    if not cache:
        cache.update({r.doc_id: r.text for r in docs.collect()})
    return cache[i]
