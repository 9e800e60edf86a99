"""Ranks with ties, chat texts and the Merkle manifest against plain versions, on rows with nulls, ties, copies and clashing names."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from quillstream.llm import chat, merkle, ranking
from quillstream.llm.ordered import fresh

duckdb = pytest.importorskip("duckdb")


def plain_ranks(rows, key):
    """(group, value) to rank, dense rank, ties; rows: (group, value); key: how values sort."""
    out = {}
    for g in {r[0] for r in rows}:
        values = sorted((r[1] for r in rows if r[0] == g), key=key)
        distinct = list(dict.fromkeys(values))
        for v in distinct:
            out[g, v] = (values.index(v) + 1, distinct.index(v) + 1, values.count(v))
    return out


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_ranks(spark, tmp_path, parts):
    r = random.Random(parts)
    rows = [(r.choice(["a", "b", None, "hot", "hot", "hot"]), r.choice([1, 2, 2, None, 7]), "x" * (i % 3)) for i in range(900)]
    rows += [("one", 5, "")] * 400 + [("alone", None, None)]  # one run over several partitions; a group of one row
    spark.createDataFrame(rows, "g string, v int, rank string").write.parquet(str(tmp_path / "t"))  # a column with the name of a result
    got = ranking.ranked(spark.read.parquet(str(tmp_path / "t")), [F.col("g")], [F.col("v").desc_nulls_first()], [F.col("v")], parts=parts).collect()
    want = plain_ranks([x[:2] for x in rows], lambda v: (v is not None, -(v or 0)))
    assert len(got) == len(rows)
    assert all((x["rank"], x["dense_rank"], x["ties"]) == want[x["g"], x["v"]] for x in got)
    for g in {x[0] for x in rows}:
        mine = sorted((x for x in got if x["g"] == g), key=lambda x: x["row_number"])
        assert [x["row_number"] for x in mine] == list(range(1, len(mine) + 1))
        assert [x["rank"] for x in mine] == sorted(x["rank"] for x in mine)


def test_ranks_of_odd_values(spark, tmp_path):
    nan = float("nan")
    spark.createDataFrame([(nan, 1), (nan, 2), (None, 3), (0.0, 4), (-0.0, 5)], "v double, g0 int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    got = {x["g0"]: (x["rank"], x["dense_rank"], x["ties"]) for x in ranking.ranked(df, [], [F.col("v").asc_nulls_first()], [F.col("v")], [F.col("g0")], parts=3).collect()}
    assert got == {3: (1, 1, 1), 4: (2, 2, 2), 5: (2, 2, 2), 1: (4, 3, 2), 2: (4, 3, 2)}
    assert ranking.ranked(df.where("false"), [F.col("g0")], [F.col("v")], [F.col("v")], parts=2).count() == 0


def test_carry():
    s = lambda part, first, last, **k: {"part": part, "first_g": first[0], "first_o": first[1], "last_g": last[0], "last_o": last[1]} | k
    one = {"one_group": True, "one_run": True}
    rows = [
        s(0, ("a", 1), ("a", 2), first_ties=1, last_ties=2, last_row=3, last_dense=2, last_rank=2, one_group=True, one_run=False),
        s(2, ("a", 2), ("a", 2), first_ties=4, last_ties=4, last_row=4, last_dense=1, last_rank=1, **one),
        s(5, ("a", 2), ("b", math.nan), first_ties=1, last_ties=1, last_row=1, last_dense=1, last_rank=1, one_group=False, one_run=False),
        s(6, ("b", math.nan), ("b", math.nan), first_ties=9, last_ties=9, last_row=9, last_dense=1, last_rank=1, **one),
    ]
    assert ranking.carried(rows) == [(0, 0, 0, 0, 1, 7), (2, 3, 1, 2, 7, 7), (5, 7, 1, 2, 7, 10), (6, 1, 0, 1, 10, 10)]


def test_fresh_names(spark):
    df = spark.createDataFrame([(1, 2)], "_At int, __b int")
    assert fresh(df, "at", "b") == ["___at", "___b"]


def plain_root(leaves, fanout=8):
    while len(leaves) > 1:
        leaves = [hashlib.sha256("".join(leaves[i : i + fanout]).encode()).hexdigest() for i in range(0, len(leaves), fanout)]
    return leaves[0]


def plain_proof(leaves, i, fanout=8):
    steps = []
    while len(leaves) > 1:
        run = i - i % fanout
        steps.append(("".join(leaves[run:i]), "".join(leaves[i + 1 : run + fanout])))
        leaves, i = [hashlib.sha256("".join(leaves[j : j + fanout]).encode()).hexdigest() for j in range(0, len(leaves), fanout)], i // fanout
    return steps


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 577])
@pytest.mark.parametrize("cuts", [0, 1, 5])
def test_mountains(n, cuts):
    """Whatever the partitions' borders: each node is made once, here or from peaks, and the peaks are what the other runs need."""
    leaves = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(n)]
    borders = sorted({0, n, *(random.Random(n + cuts).randrange(n + 1) for _ in range(cuts))})
    made = [x for a, b in zip(borders, borders[1:], strict=False) for x in merkle.mountains(leaves[a:b], a, n, 8)]
    have = {(level, i): d for kind, level, i, d in made if kind != merkle.NODE}
    sizes = merkle.level_sizes(n, 8)
    for level in range(len(sizes) - 1):
        runs = {}
        for (k, i), d in have.items():
            if k == level:
                runs.setdefault(i // 8, []).append((i, d))
        for run, members in runs.items():
            assert len(members) == min(8, sizes[level] - run * 8)
            have[level + 1, run] = merkle.digest([d for _, d in sorted(members)])
    assert have[len(sizes) - 1, 0] == plain_root(leaves)


@pytest.mark.parametrize("parts", [1, 7])
def test_manifest(spark, tmp_path, parts):
    r = random.Random(3)
    rows = [(i, f"Text {i} ÄÖ", r.choice(["en", "en", "en", "de", None]), "s", i % 5) for i in range(300)]
    rows += [(7, "again", "en", "s", 1)] * 30 + [(None, None, "en", None, None), (None, "", "fr", "s", 0), (900, "long " * 30_000, "lone", "s", 2)]
    df = spark.createDataFrame([(*x, "other") for x in rows], "doc_id long, text string, lang string, source string, n_chars long, key string")
    df.write.parquet(str(tmp_path / "d"))
    found = merkle.proofs(merkle.manifest(spark.read.parquet(str(tmp_path / "d")), other=F.when(F.col("doc_id") % 2 == 0, F.translate("text", merkle.UPPER, merkle.LOWER)), parts=parts)).collect()

    def plain_leaf(x, text):
        said = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
        return hashlib.sha256("".join(map(said, (x[0], x[3], x[2], x[4], text))).encode()).hexdigest()

    lower = str.maketrans(merkle.UPPER, merkle.LOWER)
    langs = {}
    for x in rows:
        second = x[1] if x[0] is None or x[0] % 2 or x[1] is None else x[1].translate(lower)
        langs.setdefault(x[2], []).append((x[0] is not None, x[0] or 0, plain_leaf(x, x[1]), x[0], plain_leaf(x, second)))
    order = sorted(langs, key=lambda v: (v is not None, v or ""))
    leaves = {v: sorted(langs[v]) for v in order}
    subroots = [plain_root([x[2] for x in leaves[v]]) for v in order]
    root, want = plain_root(subroots), []
    for j, v in enumerate(order):
        for i, x in enumerate(leaves[v]):
            steps = plain_proof([y[2] for y in leaves[v]], i) + plain_proof(subroots, j)
            folded = merkle.fold(x[4], steps)
            want.append((str(x[3]), x[2], subroots[j], root, hashlib.sha256("".join(b + a for b, a in steps).encode()).hexdigest(), folded, folded == root))
    assert sorted((str(y["key"]), *y[1:]) for y in found) == sorted(want)
    assert 0 < sum(not y["verified"] for y in found) < len(found)
    assert merkle.tampered(spark.read.parquet(str(tmp_path / "d")).where("false")).count() == 0


def plain_messages(events):
    """A conversation's log folded one event at a time."""
    order, text, role = [], {}, {}
    for _, message, kind, who, said in sorted(set(events), key=lambda e: e[0]):
        if message not in text:
            order.append(message)
            text[message] = ""
        role[message] = who or role.get(message)
        text[message] = (text[message] if kind == chat.DELTA else "") + (said or "")
        if kind == chat.REGENERATE:
            at = order.index(message)
            order = order[: at + 1]
        if kind == chat.DELETE:
            order.remove(message)
    return [(role[m], text[m]) for m in order]


def test_fold(spark):
    r = random.Random(8)
    rows, want = [], {}
    for conv in range(40):
        events, seq, names = [], 0, []
        for name in range(r.randrange(1, 7)):
            names.append(name)
            seq += 1
            events.append((seq, name, chat.OPEN, r.choice(["user", "assistant"]), r.choice([None, "a", "b"])))
            for _ in range(r.randrange(4)):
                seq += 1
                kind = r.choice([chat.DELTA, chat.DELTA, chat.EDIT, chat.REGENERATE])
                message = name if kind != chat.EDIT else r.choice(names)
                events.append((seq, message, kind, None, r.choice([None, "x", " y", "ü"])))
        want[conv] = plain_messages(events)
        events += events[::3]  # delivered again
        r.shuffle(events)
        rows += [(conv, *e, "clash") for e in events]
    log = spark.createDataFrame(rows, "conv_id long, seq long, message long, kind string, role string, text string, opened string")
    got = {}
    for x in sorted(chat.messages(log).collect(), key=lambda x: (x["conv_id"], x["opened"])):
        got.setdefault(x["conv_id"], []).append((x["role"], x["text"]))
    assert got == {k: v for k, v in want.items() if v}


def test_template(spark):
    texts = ["</s>[INST] ok [/INST]", "<\\/s> <\\\\/s> [\\INST]", "<<s>[[INST]", "<s", "", "\n<s>\n", "plain [brackets] <b>", "[/INST]</s><s>", "\\", "x" * 300_000 + "<s>"]
    rows = [(1, i, ["user", "assistant", None, "<s>[INST]"][i % 4], t) for i, t in enumerate(texts)]
    rendered = chat.render(spark.createDataFrame(rows, "conv_id long, opened long, role string, text string"))
    one = rendered.first()
    back = chat.read_back(rendered).first()
    assert [(t["role"], t["text"]) for t in back["turns"]] == [(role or "", t) for _, _, role, t in rows]
    assert list(back["learned"]) == [t for _, _, role, t in rows if role == "assistant"]
    assert one["formatted"].count("<s>") == one["formatted"].count("</s>") == len(texts)
    unmasked = "".join(one["formatted"][s["start"] : s["start"] + s["length"]] for s in one["loss"])
    stuffed = lambda t: re.sub(r"([<\[])(\\*)(/?s>|/?INST\])", r"\1\\\2\3", t)
    assert unmasked == "".join(stuffed(t) for _, _, role, t in rows if role == "assistant")


def test_conversations(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "ab" * 200), (1, 2, "user", None), (1, 3, "assistant", ""), (2, 5, "system", "s"), (2, 5, "system", "s"), (2, None, None, "late"), (None, 1, "assistant", "é😀<s>" * 50)]
    df = spark.createDataFrame([(*x, "y") for x in rows], "conv_id long, turn long, role string, text string, step string")
    got = {x["conv_id"]: x for x in chat.round_trip(df).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    told = lambda turns: sha("".join(f"{a}\n{b}\n" for a, b in turns))
    assert got[1]["turns_sha256"] == told([("user", "hi"), ("assistant", "ab" * 200), ("user", ""), ("assistant", "")])
    assert (got[1]["loss_chars"], got[1]["loss_sha256"]) == (400, sha("ab" * 200))
    assert (got[2]["n_turns"], got[2]["turns_sha256"]) == (3, told([("system", "s"), ("system", "s"), ("", "late")]))
    assert (got[None]["loss_chars"], got[None]["loss_sha256"]) == (250, sha("é😀<s>" * 50))
    assert chat.round_trip(df.where("false")).count() == 0


def test_sale_lines(spark, tmp_path):
    """Odd rows of the contract query against its SQL."""
    from tests.llm.test_sql import compared

    r = random.Random(5)
    row = lambda: (r.choice([None, 0, 3, 12, 35]), r.choice([None, 1, 2]), r.choice([None, 4, 9]), r.choice([None, 1]), r.choice([None, 3, 12, 45]), r.choice([None, 1.25, 9.0]), r.choice([0.01, 0.1]))
    rows = [row() for _ in range(500)] + [(12, 1, 4, 1, 45, 1.25, 0.1)] * 300
    df = spark.createDataFrame(rows, "sale_id long, line_no int, item_id long, vendor_id long, quantity int, amount double, discount double")
    df.withColumn("shipped_at", F.when(F.rand(1) < 0.8, F.lit("2024-02-03 10:00:00")).cast("timestamp_ntz")).withColumn("pos", F.lit("clash")).write.parquet(str(tmp_path / "sale_lines.parquet"))
    compared(spark, "op11_ranking", str(tmp_path))

