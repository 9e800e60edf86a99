"""Search, alignment, dictionaries, topics, Kendall's tau, prefixes and hierarchies against plain versions."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from quillstream.functions import python as py
from quillstream.operators import aggregates, alignment, dictionary, gibbs, hierarchy, joins, prefixes, search, tagging


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(2)
    words = ["the", "of", "whale", "ship", "sea", "a"]
    return [(i, " ".join(r.choice(words) for _ in range(r.randrange(40)))) for i in range(60)]


@pytest.mark.parametrize("part_documents", [100_000, 7])
def test_phrases_and_proximity(spark, corpus, tmp_path, part_documents):
    docs = spark.createDataFrame([*corpus, (90, None), (91, ""), (None, "the whale of the sea")], "id int, t string")
    index = search.build(docs, "id", "t", str(tmp_path / "index"), part_documents=part_documents)
    assert (index.dictionary.agg(F.max("parts")).first()[0] > 1) == (part_documents == 7)
    asked = {"one": ["whale"], "two": ["the", "whale"], "again": ["the", "the"], "long": ["of", "the", "sea", "a"], "none": ["the", "kraken"], "empty": []}
    queries = spark.createDataFrame(list(asked.items()), "query string, terms array<string>")
    got = {(x["query"], x["doc"]): list(x["starts"]) for x in search.phrases(search.load(spark, str(tmp_path / "index")), queries).collect()}
    texts = [*corpus, (None, "the whale of the sea")]
    want = {}
    for name, terms in asked.items():
        for i, t in texts:
            ws = t.split()
            if terms and (at := [p for p in range(len(ws)) if ws[p : p + len(terms)] == terms]):
                want[name, i] = at
    assert got == want
    close = {(x["query"], x["doc"]): list(x["starts"]) for x in search.near(index, queries, 3).collect()}
    want = {}
    for name, terms in asked.items():
        for i, t in texts:
            ws = t.split()
            if terms and (at := [p for p in range(len(ws)) if ws[p] in terms and set(terms) <= set(ws[p : p + 4])]):
                want[name, i] = at
    assert close == want


def test_postings_of_repeated_documents(spark, monkeypatch):
    """Rows of one key or of none are one document; extra columns, empty and null texts and gaps don't matter."""
    rows = [("x", "a b a"), ("x", "b b - a"), ("y", "  ! a\na "), (None, "a c"), (None, "d c"), ("z", None), ("w", ""), ("v", "long " * 3000)]
    docs = spark.createDataFrame(rows, "doc string, text string")
    want = {}
    for key, text in rows:
        for pos, term in enumerate(w.strip("!-") for w in (text or "").split()):
            if term:
                want.setdefault((term, key), set()).add(pos)
    plain = lambda c: F.transform(F.split(F.regexp_replace(c, r"^\s+|\s+$", ""), r"\s+"), lambda t: F.regexp_replace(t, "[!-]", ""))
    for broadcast, tokens in [(0, 100), (4_000_000, 1_000_000)]:
        monkeypatch.setattr(search.scratch, "BROADCAST_BYTES", broadcast)
        monkeypatch.setattr(search, "BATCH_TOKENS", tokens)
        got = search.document_postings(docs, plain).collect()
        assert {(r["term"], r["doc"]): r["positions"] for r in got} == {k: sorted(v) for k, v in want.items()}
        assert len(got) == len(want)
    assert search.document_postings(docs.limit(0), plain).count() == 0
    # within the function itself, whatever the size of its pieces
    batch = pa.RecordBatch.from_pylist([{"doc": k, "terms": None if t is None else [w.strip("!-") for w in t.split()]} for k, t in rows[2:]])
    for n in (100, 1_000_000):
        monkeypatch.setattr(search, "BATCH_TOKENS", n)
        got = [r for b in search.grouped([batch]) for r in b.to_pylist()]
        assert sorted((r["term"], r["doc"] or "", r["positions"]) for r in got) == sorted([("a", "y", [1, 2]), ("a", "", [0]), ("c", "", [1]), ("d", "", [0]), ("c", "", [1]), ("long", "v", list(range(3000)))])


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_best_substring():
    r = random.Random(1)
    for _ in range(200):
        hay, needle = ("".join(r.choice("abc ü") for _ in range(r.randrange(n))) for n in (14, 7))
        every = {(a, n): distance(needle, hay[a : a + n]) for a in range(len(hay) + 1) for n in range(len(hay) - a + 1)}
        least = min(every.values())
        cost, start, length = py.best_substring(needle, hay)
        assert cost == least == every[start, length]
        if (found := [(d, s, k) for s, k, d in py.substring_distances(needle, hay)]) and min(found)[0] == least:
            assert (cost, start, length) <= min(found)
        cost, near, length = py.best_substring(needle, hay, expected=9)
        assert cost == least == every[near, length] and abs(near - 9) <= abs(start - 9)
        assert py.best_substring(needle, hay, below=least) == (least, 0, 0)
    assert py.end_costs("ab", "xaby", anchored=True) == [distance("ab", "xaby"[:n]) for n in range(5)]


def test_align_rows(spark):
    r = random.Random(7)
    letters = "abcdefghij klmnop"
    page = "".join(r.choice(letters) for _ in range(1_000_000))
    pages = [(1, page), (2, "short page"), (3, ""), (4, None)]
    rows, want = [], []
    for i in range(12):
        a, text = r.randrange(900_000), ""
        for c in page[a : a + 60]:
            text += {0: "", 1: "#", 2: c + "#"}.get(r.randrange(14), c)
        rows.append((i, 1, text, a))
        want.append(a)
    rows += [(20, 2, "shart", 0), (21, 2, "", 0), (22, 3, "abc", 0), (23, 4, "abc", 0), (24, 9, "no page", 0), (25, 2, None, 0), (26, 2, "pag", 0), (26, 2, "pag", 0)]
    left, right = spark.createDataFrame(rows, "row int, k int, said string, about int"), spark.createDataFrame(pages, "k int, page string")
    got = sorted(alignment.align_rows(left, right, ["k"], "said", "page", "about").collect(), key=lambda x: x["row"])
    assert [x["row"] for x in got] == [*range(12), 20, 21, 22, 23, 25, 26, 26]
    for x, a in zip(got, want, strict=False):
        assert abs(x["start"] - a) < 12 and x["cost"] == distance(x["said"], page[x["start"] : x["start"] + x["length"]]) <= distance(x["said"], page[a : a + 60])
    told = {x["row"]: (x["cost"], x["start"], x["length"], x["cut_end"], x["word_end"]) for x in got[12:]}
    assert told[20] == (1, 0, 5, False, 5) and told[21][:3] == (0, 0, 0) and told[22][:3] == (3, 0, 0) and told[23][:3] == (3, 0, 0) and told[25][:3] == (0, 0, 0)
    assert told[26] == (0, 6, 3, True, 10)


def test_tracing_back(spark, monkeypatch):
    """An alignment is traced back in its bit sets, where a whole table of numbers was made before; both tell the same."""
    r = random.Random(11)
    cases = [("", ""), ("abc", ""), ("", "abc"), ("ab", "b")]
    for k in range(800):
        letters = ("ab", "abcd", "abcdefgh \n")[k % 3]
        hay = "".join(r.choice(letters) for _ in range(r.randrange(40)))
        a = r.randrange(len(hay) + 1)
        cases.append(("".join(r.choice(letters) for _ in range(r.randrange(14))) if k % 2 else hay[a : a + r.randrange(12)].replace("a", "x"), hay))
    told = []
    for cells in (1 << 26, 300, -1):  # the whole table, that of an end's piece, none
        monkeypatch.setattr(py, "TRACED", cells)
        told.append([py.best_substring(n, h, e) for n, h in cases for e in (None, 7)])
    assert told[0] == told[1] == told[2]
    monkeypatch.setattr(py, "TRACED", 1 << 26)
    monkeypatch.setattr(py, "substring_distances", None)
    assert py.best_substring("c0lled me lshm0cl" * 20, "Call me Ishmael" * 60)[2] > 0


@pytest.mark.parametrize("short", [0, 30, 4_096])
def test_rows_of_short_pages(spark, monkeypatch, short):
    """Rows of short pages meet them at once, without their grams; the results are the same with windows."""
    monkeypatch.setattr(alignment, "SHORT", short)
    r = random.Random(3)
    pages = [(k, "".join(r.choice("abcdef ") for _ in range(n))) for k, n in enumerate((0, 8, 25, 31, 60, 400))] + [(9, None)]
    rows = [(i, k, (t or "")[(a := r.randrange(len(t or "") + 1)) : a + r.randrange(40)].translate(str.maketrans("ae", "x#")), a) for i, (k, t) in enumerate(pages * 6)]
    left, right = spark.createDataFrame(rows, "row int, k int, said string, about int"), spark.createDataFrame(pages, "k int, page string")
    for expected in (None, "about"):
        want = sorted((i, *py.best_substring(s, dict(pages)[k] or "", a if expected else None)) for i, k, s, a in rows)
        assert sorted((x["row"], x["cost"], x["start"], x["length"]) for x in alignment.align_rows(left, right, ["k"], "said", "page", expected).collect()) == want
    monkeypatch.setattr(alignment, "windows", None)
    if short == 4_096:
        assert alignment.align_rows(left, right, ["k"], "said", "page").count() == len(rows)


def test_dictionary(spark, monkeypatch):
    r = random.Random(4)
    words = ["New", "York", "the", "City", "of", "Bob,", "Ann."]
    docs = [(i, " ".join(r.choice(words) for _ in range(25))) for i in range(20)] + [(98, None), (99, "")]
    names = [(" ".join(r.choice(words[:5]) for _ in range(r.randrange(1, 9))), f"k{i % 3}") for i in range(150)] + [("New York City the City of the New", "LONG"), ("", "none"), (None, "none")]
    docs.append((50, "in New York City the City of the New, again"))
    frame, table = spark.createDataFrame(docs, "id int, t string"), spark.createDataFrame(names, "name string, value string")
    want = sorted({(i, p, n, v) for i, t in docs if t for p in range(len(t.split())) for name, v in names if name for n in [len(name.split())] if [*t.split()[p : p + n - 1], t.split()[p + n - 1].rstrip(",.") if p + n <= len(t.split()) else ""] == name.split()})
    assert any(v == "LONG" for *_, v in want)
    for size in (16_000_000, 300):
        monkeypatch.setattr(dictionary, "SHARD_BYTES", size)
        assert sorted(map(tuple, dictionary.named_words(frame, table, "id", "t").collect())) == want
    tags = tagging.tag_names(frame.where("id = 50"), table.where("value = 'LONG'").withColumnRenamed("value", "kind"), "id", "t").orderBy("position").collect()
    assert [x["tag"] for x in tags] == ["O", "<LONG>", *["LONG"] * 6, "</LONG>", "O"]
    assert dictionary.named_words(frame, table.where("false"), "id", "t").count() == 0


def test_linked_titles_of_a_table(spark, monkeypatch):
    titles = [("New York", "/ny"), ("York", "/y"), ("New York City", "/nyc"), ("a.b", "/ab"), ("aa", "/aa"), ("", "/none"), (None, "/none")]
    docs = [(1, "New York City, New York, York, a.b axb"), (2, "none"), (3, None), (4, ""), (5, "aaaaa" * 2000)]
    frame, table = spark.createDataFrame([(*d, "u") for d in docs], "id int, t string, url string"), spark.createDataFrame(titles, "title string, url string")
    want = frame.select("id", joins.link_titles(F.col("t"), [x for x in titles if x[0]]).alias("t")).collect()
    for size in (16_000_000, 20):
        monkeypatch.setattr(dictionary, "SHARD_BYTES", size)
        assert sorted((x["id"], x["t"]) for x in dictionary.link_titles(frame, table, "id", "t").collect()) == sorted(map(tuple, want))


def test_planted_topics(spark):
    """Two vocabularies that never meet are two topics, and each document is of its own."""
    r = random.Random(5)
    sides = [["sail", "mast", "rope", "deck"], ["seed", "soil", "plough", "barn"]]
    docs = spark.createDataFrame([(i, " ".join(r.choice(sides[i % 2]) for _ in range(30))) for i in range(60)] + [(99, None), (98, "12 345")], "id int, t string")
    words = gibbs.terms(docs, "id", "t", ["rope"], 2)
    model = gibbs.sample(words, topics=2, rounds=6, parts=3, alpha_sum=0.2)
    of = {x["doc"]: x["topic"] for x in gibbs.document_topics(model, least=0.9).collect()}
    assert len(of) == 60 and of[0] != of[1] and all(t == of[i % 2] for i, t in of.items())
    top = gibbs.top_words(model, 3).collect()
    assert {x["word"] for x in top if x["topic"] == of[0]} == {"sail", "mast", "deck"}
    tokens = words.agg(F.sum(F.size("words"))).first()[0]
    assert {n for _, n, _ in model.rounds} == {tokens} and model.counts.agg(F.sum("n")).first()[0] == tokens
    assert sorted(map(str, model.tokens.collect())) == sorted(map(str, gibbs.sample(words, topics=2, rounds=6, parts=3, alpha_sum=0.2).tokens.collect()))
    assert gibbs.sample(words.where("false"), topics=2, rounds=1).tokens.count() == 0


def plain_tau(points):
    score = sum(np.sign(a[0] - b[0]) * np.sign(a[1] - b[1]) for i, a in enumerate(points) for b in points[:i])
    n = len(points)
    ties = lambda k: sum(1 for i, a in enumerate(points) for b in points[:i] if a[k] == b[k])
    bottom = (n * (n - 1) / 2 - ties(0)) * (n * (n - 1) / 2 - ties(1))
    return score / bottom**0.5 if bottom > 0 else None


@pytest.mark.parametrize("pieces", [None, 2, 40])
def test_kendall(spark, pieces):
    r = random.Random(3)
    groups = {"a": [(r.randrange(30), r.randrange(30)) for _ in range(150)], "hot": [(7 if i % 2 else r.randrange(9), r.random()) for i in range(150)], "one": [(1, 1)], "flat": [(1, 2), (1, 3)], "line": [(i, -i) for i in range(90)]}
    rows = [(k, float(x), float(y)) for k, ps in groups.items() for x, y in ps] + [("a", None, 1.0), (None, 1.0, 2.0)]
    got = {x["k"]: x for x in aggregates.kendall(spark.createDataFrame(rows, "k string, x double, y double"), ["k"], "x", "y", pieces).collect()}
    for k, ps in groups.items():
        want = plain_tau(ps)
        assert got[k]["n"] == len(ps) and (got[k]["kendall"] is None if want is None else got[k]["kendall"] == pytest.approx(want))


def test_prefixes(spark, tmp_path):
    r = random.Random(6)
    strings = [("".join(r.choice("ab") for _ in range(r.randrange(7))), i) for i in range(300)] + [("é\U0010ffffx", 1), (None, 2)] + [("hot", i) for i in range(300)]
    asked = ["", "a", "ab", "abba", "ho", "hot", "hotter", "é", "é\U0010ffff", "z", None, "a"]
    spark.createDataFrame(strings, "s string, prefix int").write.parquet(str(tmp_path / "s"))
    left, right = spark.read.parquet(str(tmp_path / "s")), spark.createDataFrame([(p, i) for i, p in enumerate(asked)], "prefix string, id int")
    want = sorted((s, n, i) for s, n in strings if s is not None for i, p in enumerate(asked) if p is not None and s.startswith(p))
    for ranges in (1, 9):
        assert sorted((x["s"], x["prefix"], x["r_id"]) for x in prefixes.prefix_join(left, "s", right, "prefix", ranges).collect()) == want
    counts = {x["prefix"]: x["n"] for x in prefixes.prefix_counts(left, "s", right, "prefix", 5).collect()}
    assert counts == {p: sum(s is not None and s.startswith(p) for s, _ in strings) for p in set(asked) - {None, "z", "hotter"}}
    assert prefixes.prefix_join(left.where("false"), "s", right, "prefix").count() == 0


@pytest.mark.parametrize("block", [1, 7, 1_000])
def test_prefixes_of_many_copies(spark, tmp_path, monkeypatch, block):
    """Copies on both sides: every pair is there, but pairs pass no exchange."""
    monkeypatch.setattr(prefixes, "BLOCK", block, raising=False)
    strings = [("hot ring", i) for i in range(60)] + [("hot rod", i) for i in range(40)] + [("new bolt", i) for i in range(5)]
    asked = ["hot r"] * 50 + ["hot ro"] * 3 + ["", "hot x"]
    spark.createDataFrame(strings, "s string, n int").write.parquet(str(tmp_path / "s"))
    left, right = spark.read.parquet(str(tmp_path / "s")), spark.createDataFrame([(p, i) for i, p in enumerate(asked)], "p string, id int")
    found = prefixes.prefix_join(left, "s", right, "p", 3)
    rows = sorted((x["s"], x["n"], x["r_id"]) for x in found.collect())
    assert rows == sorted((s, n, i) for s, n in strings for i, p in enumerate(asked) if s.startswith(p))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode(_right") < plan.index("Join") and plan.index("explode(_left") < plan.index("Join")


def test_pairs_of_lists_leave_one_by_one(spark, tmp_path):
    """In one step of generated code all pairs of two lists were held, a million rows of BLOCK, before the first went on. Lists don't repeat their own string."""
    spark.createDataFrame([(i, "hot ring", None) for i in range(30)] + [(None, "hot", 1)], "n int, s string, m int").write.parquet(str(tmp_path / "s"))
    left = spark.read.parquet(str(tmp_path / "s"))
    found = prefixes.prefix_join(left, "s", spark.createDataFrame([("hot",), ("hot",), (None,)], "p string"), "p")
    assert found.columns == ["n", "s", "m", "r_p"] and [t for _, t in found.dtypes] == ["int", "string", "int", "string"]
    assert sorted(map(str, found.collect())) == sorted(str(Row(n=n, s=s, m=m, r_p="hot")) for n, s, m in map(tuple, left.collect()) for _ in range(2))
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("Generate explode(_right") < plan.index("Coalesce") < plan.index("Generate explode(_left")
    parts = found.rdd.getNumPartitions()
    assert parts == prefixes.prefix_join(left, "s", left.select("s"), "s").rdd.getNumPartitions() == 1
    with pytest.MonkeyPatch.context() as m:  # as many tasks as there are dealt
        m.setattr(prefixes, "TASK_PAIRS", 10)
        assert prefixes.prefix_join(left, "s", spark.createDataFrame([("hot",)] * 2, "p string"), "p").rdd.getNumPartitions() == 6


def test_hierarchies(spark):
    n = 10_000
    rows = [("x", i, i - 1 if i else None, f"p{i}") for i in range(n)] + [("y", 1, 2, "a"), ("y", 2, 1, "b"), ("y", 3, 2, "c"), ("y", 4, 77, "d"), ("y", 5, 4, "e"), ("y", 6, 6, "f"), ("y", None, 1, "g")]
    frame = spark.createDataFrame(rows, "k string, node int, up int, name string")
    got = {(x["k"], x["node"]): (x["root"], x["depth"], x["cyclic"]) for x in hierarchy.climbed(frame, "node", "up", ["k"]).collect()}
    assert len(got) == n + 6 and all(got["x", i] == (0, i, False) for i in range(n))
    assert [got["y", i] for i in range(1, 7)] == [(None, None, True)] * 3 + [(4, 0, False), (4, 1, False), (None, None, True)]
    paths = {(x["k"], x["node"]): x["path"] for x in hierarchy.climbed(frame.where("k = 'y' OR node < 40"), "node", "up", ["k"], "name", "/").collect()}
    assert paths["x", 39] == "/".join(f"p{i}" for i in range(40)) and paths["y", 5] == "d/e" and paths["y", 1] is None


def test_arriving_levels(spark, tmp_path):
    from quillstream.operators import levels
    from quillstream.streaming import levels as arriving

    source, to, seen = str(tmp_path / "in"), str(tmp_path / "out"), []

    def plan(units):
        seen.append(sorted(x["id"] for x in units.collect()))
        return {"lines": levels.lines(units, "id", "t")}

    def deliver(*rows):
        spark.createDataFrame(list(rows), "id int, t string").coalesce(1).write.mode("append").parquet(source)
        return arriving.build(spark, source, "id int, t string", to, "id", plan)

    told = lambda: sorted((x["id"], x["line"]) for x in arriving.latest(spark, to, "lines", "id").collect())
    assert deliver((1, "a\nb"), (2, "c"), (None, "x")) == 1 and told() == [(1, "a"), (1, "b"), (2, "c")]
    deliver((2, "d"), (3, "e\nf"))
    assert told() == [(1, "a"), (1, "b"), (2, "d"), (3, "e"), (3, "f")]  # a unit that comes again replaces its rows
    arriving.build(spark, source, "id int, t string", to, "id", plan)
    assert seen == [[1, 2], [2, 3]]  # each file once
    deliver((1, None))
    assert told() == [(2, "d"), (3, "e"), (3, "f")]


def test_theme_report(spark):
    from quillstream.plans import themes

    tree = spark.createDataFrame([("a", None, "A & B"), ("b", "a", "x"), ("c", "a", "w"), ("d", "b", "deep"), ("l", "m", "loop"), ("m", "l", "loop")], "theme string, parent string, title string")
    items = spark.createDataFrame([("a", "own"), ("b", "1<2"), ("b", "1<2"), ("d", "z"), ("nowhere", "lost")], "theme string, line string")
    got = {x["theme"]: x for x in themes.nested_report(tree, items).collect()}
    assert {k: (x["depth"], x["total"], x["orphans"]) for k, x in got.items()} == {"a": (0, 4, 1), "b": (1, 3, 2), "c": (1, 0, 0), "d": (2, 1, 0)}
    deep = "<li>deep (1)<ul><li>z</li></ul></li>"
    b = f'<li>x (3)<ul>{deep}</ul><ul class="orphans"><li>1&lt;2</li><li>1&lt;2</li></ul></li>'
    assert got["a"]["page"] == f'<li>A &amp; B (4)<ul><li>w (0)</li>{b}</ul><ul class="orphans"><li>own</li></ul></li>'
    assert themes.nested_report(tree.where("false"), items).count() == 0


def test_language_ensemble(spark):
    from quillstream.operators import languages

    known = spark.createDataFrame([("en", "the ship and the sea and the whale"), ("fi", "meri ja laiva ja valas ja ranta"), ("el", "η θάλασσα και το πλοίο"), (None, "the")], "lang string, text string")
    rows = spark.createDataFrame([(1, "the whale and"), (2, "laiva ja meri"), (3, "θάλασσα"), (4, ""), (5, None), (6, "123")], "id int, text string")
    got = {}
    for x in languages.ensemble(rows, known, "id").collect():
        got.setdefault(x["id"], {})[x["lang"]] = x
    assert set(got) == {1, 2, 3, 4, 6} and all(len(v) == 3 for v in got.values())
    assert [max(got[i], key=lambda k: got[i][k]["score"]) for i in (1, 2, 3)] == ["en", "fi", "el"]
    for v in got.values():
        assert abs(sum(x["script"] for x in v.values()) - 1) < 1e-9 and all(abs(x["score"] - (x["trigram"] + x["rank"] + x["script"]) / 3) < 1e-9 for x in v.values())


def test_programs(spark, tmp_path):
    from quillstream.__main__ import main

    docs, names = str(tmp_path / "docs.jsonl"), str(tmp_path / "names.csv")
    (tmp_path / "docs.jsonl").write_text('{"id": 1, "text": "the white whale in New York"}\n{"id": 2, "text": "a white ship"}\n')
    (tmp_path / "names.csv").write_text("name,kind,title,url\nNew York,LOC,whale,/w\n")
    (tmp_path / "asked.jsonl").write_text('{"id": "q", "text": "white whale"}\n')
    to = str(tmp_path / "out")
    main(["index", "--files", docs, "--to", to], spark)
    main(["phrases", "--files", f"{to}/index", "--other", str(tmp_path / "asked.jsonl"), "--to", to], spark)
    assert [(x["query"], x["doc"], list(x["starts"])) for x in spark.read.parquet(f"{to}/hits").collect()] == [("q", 1, [1])]
    main(["phrases", "--files", f"{to}/index", "--other", str(tmp_path / "asked.jsonl"), "--to", to, "--within", "5"], spark)
    assert spark.read.parquet(f"{to}/hits").count() == 1
    main(["tag", "--files", docs, "--other", names, "--to", to], spark)
    assert spark.read.parquet(f"{to}/tokens").where("tag = '</LOC>'").first()["token"] == "York"
    main(["links", "--files", docs, "--other", names, "--to", to], spark)
    assert '<a href="/w">whale</a>' in spark.read.parquet(f"{to}/texts").where("id = 1").first()["text"]
    main(["words", "--files", docs, "--to", to], spark)
    assert spark.read.parquet(f"{to}/words").where("word = 'white'").first()["n"] == 2


def test_postings_are_packed(spark, tmp_path, monkeypatch):
    """each term of each document was a row of its own, written, counted, shuffled and sorted; places of documents that lack a term were compared too."""
    docs = spark.createDataFrame([(i, "the whale " + "the " * (i % 3) + f"ship{i}") for i in range(40)] + [(7, "whale whale")], "id int, t string").coalesce(1)
    index = search.build(docs, "id", "t", str(tmp_path / "index"))
    rows = spark.read.parquet(str(tmp_path / "index/postings"))
    assert rows.where("term = 'whale'").count() == 2 and index.postings.where("term = 'whale'").count() == 40
    assert {tuple(r) for r in index.dictionary.where("term IN ('the', 'whale')").select("term", "documents", "occurrences").collect()} == {("the", 40, 79), ("whale", 40, 41)}
    assert index.postings.where("term = 'whale' AND doc = 7").first().positions == [0, 1]
    queries = spark.createDataFrame([("q", ["the", "ship5"]), ("one", ["ship4", "ship4"])], "query string, terms array<string>")
    found = search.near(index, queries, 3)
    assert "Window" not in found._jdf.queryExecution().toString()
    assert {(r["query"], r.doc, tuple(r.starts)) for r in found.collect()} == {("q", 5, (2, 3)), ("one", 4, (3,))}
    # whatever the batches: no rows, rows of different numbers of terms, equal places of merged rows
    batch = pa.RecordBatch.from_pylist([{"query": "a", "doc": 1, "lists": [[0, 9], [3, 9]]}, {"query": "b", "doc": 2, "lists": [[7]]}, {"query": "c", "doc": 3, "lists": [[0], [4], [1]]}], pa.schema([("query", pa.string()), ("doc", pa.int64()), ("lists", pa.list_(pa.list_(pa.int32())))]))
    assert [list(r.values()) for b in search.close([batch, batch.slice(0, 0), batch.slice(2)], 3) for r in b.to_pylist()] == [["a", 1, [0, 9]], ["b", 2, [7]]]


def test_tags_stay_in_rows(spark):
    """words were shuffled to find names, and every token joined with its tag; rows of one key, or of none, took each other's tags."""
    docs = spark.createDataFrame([(1, " in New York City."), (1, "a Bob, New  York"), (None, "New York City Hall x Hall y"), (2, None), (3, ""), (4, "aa bb cc dd")], "id int, t string")
    names = spark.createDataFrame([("New York", "LOC"), ("York City Hall", "ORG"), ("Bob", "PER"), ("aa bb", "P"), ("bb cc", "Q"), ("cc dd", "R")], "name string, kind string")
    found = tagging.tag_names(docs, names, "id", "t")
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    want = [
        (1, 0, "a", "O"), (1, 1, "Bob,", "<PER/>"), (1, 1, "in", "O"), (1, 2, "New", "<LOC>"), (1, 2, "New", "<LOC>"), (1, 3, "York", "</LOC>"), (1, 3, "York", "</LOC>"), (1, 4, "City.", "O"),
        (None, 0, "New", "O"), (None, 1, "York", "<ORG>"), (None, 2, "City", "ORG"), (None, 3, "Hall", "</ORG>"), (None, 4, "x", "O"), (None, 5, "Hall y", "O"),
        (4, 0, "aa", "<P>"), (4, 1, "bb", "</P>"), (4, 2, "cc", "O"), (4, 3, "dd", "O"),
    ]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))
