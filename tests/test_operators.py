import itertools
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstream.operators import aggregates, geometry, joins, levels, tagging
from quillstream.sources import readers, sinks
from quillstream.streaming import events as event_windows


def lines(spark, *rows):
    return spark.createDataFrame([(1, i, x) for i, x in enumerate(rows)], "doc_id long, line_no int, line string")


def test_paragraphs(spark):
    got = levels.paragraphs(lines(spark, "ab", "c", "", "", "def"), "doc_id").orderBy("paragraph").collect()
    assert [(r.text, r.start_offset, r.end_offset, r.lines) for r in got] == [("ab\nc\n", 0, 5, 2), ("def\n", 7, 11, 1)]


def test_sections(spark):
    rows = lines(spark, "# A", "x", "## B", "y", "# C", "## D", "### E", "z", "## F")
    got = levels.sections(rows, "doc_id").orderBy("section").collect()
    assert [(r.heading, r.heading_level, r.text) for r in got] == [("A", 1, "x\n## B\ny"), ("B", 2, "y"), ("C", 1, "## D\n### E\nz\n## F"), ("D", 2, "### E\nz"), ("E", 3, "z"), ("F", 2, "")]


def test_joined_until(spark):
    got = levels.joined_until(lines(spark, "One two", "three four.", "A.", "five six.", "tail"), "doc_id", "line_no", "line").orderBy("sentence").collect()
    assert [r.text for r in got] == ["One two three four.", "A. five six.", "tail"]
    assert levels.joined_until(lines(spark, "tail"), "doc_id", "line_no", "line", drop_tail=True).count() == 0


@pytest.mark.parametrize("bin_size", [None, 1, 7, 100])
@pytest.mark.parametrize("closed", [False, True])
def test_interval_join(spark, bin_size, closed):
    r = random.Random(3)
    spans = lambda n: [(r.choice("ab"), i, a := r.randrange(60), a + r.randrange(1, 25)) for i in range(n)]
    left, right = spans(40), spans(40)
    schema = "k string, id int, start int, end int"
    got = joins.interval_join(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["k"], bin_size, closed)
    over = (lambda a, b: a[2] <= b[3] and b[2] <= a[3]) if closed else (lambda a, b: a[2] < b[3] and b[2] < a[3])
    want = sorted((a[1], b[1]) for a, b in itertools.product(left, right) if a[0] == b[0] and over(a, b))
    assert sorted((x.id, x.r_id) for x in got.collect()) == want


def test_enrich(spark):
    facts, dim = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "x")], "k int, v string")
    assert sorted(joins.enrich(facts, dim, ["k"], defaults={"v": ""}).collect()) == [(1, "x"), (2, "")]
    with pytest.raises(Exception, match="no dimension row"):
        joins.enrich(facts, dim, ["k"], required=True).collect()


def test_correlations(spark):
    r = random.Random(5)
    data = [("g", r.randrange(2), r.randrange(6)) for _ in range(60)] + [("one", 1, 1)]
    rows = spark.createDataFrame(data, "k string, x int, y int")
    x, y = np.array([d[1] for d in data[:-1]]), np.array([d[2] for d in data[:-1]])
    pairs = [(np.sign(x[i] - x[j]), np.sign(y[i] - y[j])) for i in range(60) for j in range(i)]
    want = sum(a * b for a, b in pairs) / (sum(a != 0 for a, _ in pairs) * sum(b != 0 for _, b in pairs)) ** 0.5
    binary = {q.k: q for q in aggregates.kendall_binary(rows, ["k"], "x", "y").collect()}
    general = {q.k: q for q in aggregates.kendall(rows, ["k"], "x", "y").collect()}
    assert binary["g"].kendall == pytest.approx(want) == pytest.approx(general["g"].kendall)
    assert binary["one"].kendall is None and general["one"].kendall is None
    ranks = lambda v: np.array([(v < a).sum() + ((v == a).sum() + 1) / 2 for a in v])
    found = {q.k: q for q in aggregates.correlations(rows, ["k"], "x", "y").collect()}
    assert found["g"].spearman == pytest.approx(np.corrcoef(ranks(x), ranks(y))[0, 1])
    assert found["one"].pearson is None


def test_modes_and_medians(spark):
    rows = spark.createDataFrame([("a", 1, 10), ("a", 2, 3), ("a", 2, 3), ("a", 3, 10)], "k string, v int, w long")
    assert aggregates.weighted_mode(rows, ["k"], "v", F.col("w")).first().mode == 1  # a tie
    assert aggregates.weighted_mode(rows, ["k"], "v", F.lit(1)).first().mode == 2
    assert aggregates.upper_median(rows, ["k"], "v").first()["median"] == 2
    assert aggregates.weighted_median(rows, ["k"], "v", F.col("w")).first()["median"] == 2


def test_reading_order_of_equal_positions(spark):
    """Blocks of one position stay in their order, before a referenced one there; one without a position is the last, of the same name or not."""
    rows = [(1, 3, 9, 1), (1, 5, 7, None), (1, 7, 7, None), (1, 9, 9, None), (1, 8, None, None), (2, 1, 4, None), (2, 2, 4, None), (3, 1, None, 1), (3, 2, 4, None), (3, 2, 4, None)]
    got = geometry.reading_order(spark.createDataFrame(rows, "page int, block int, position int, logical int"), ["page"]).orderBy("page", "place").collect()
    assert [(r.page, r.block, r.place) for r in got] == [(1, 5, 0), (1, 7, 1), (1, 9, 2), (1, 3, 3), (1, 8, 4), (2, 1, 0), (2, 2, 1), (3, 2, 0), (3, 2, 1), (3, 1, 2)]


def test_geometry(spark):
    assert geometry.line_numbers([(0, 0, 10, 10), (12, 1, 20, 11), (0, 20, 10, 30), (15, 12, 25, 28)]) == [0, 0, 1, 1]
    words = spark.createDataFrame([(1, i, w, *b) for i, (w, b) in enumerate([("a", (0, 0, 10, 10)), ("b", (12, 0, 20, 10)), ("c", (0, 12, 10, 22)), ("d", (30, 40, 40, 50))])], "page int, n int, word string, x1 int, y1 int, x2 int, y2 int")
    boxed = geometry.paragraph_numbers(geometry.line_boxes(geometry.words_to_lines(words, ["page"], "n"), ["page"], "n"), ["page"])
    assert [(r.text, r.paragraph) for r in boxed.orderBy("line").collect()] == [("a b", 0), ("c", 0), ("d", 1)]
    spans = lambda *s: F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in s])
    assert spark.range(1).select(geometry.column_count(spans((0, 10), (5, 12), (11, 20), (30, 40)))).first()[0] == 3
    blocks = spark.createDataFrame([(1, "a", 10, 1), (1, "b", 20, 2), (1, "c", 15, None), (1, "d", 99, None)], "page int, block string, position int, logical int")
    assert [r.block for r in geometry.reading_order(blocks, ["page"]).orderBy("place").collect()] == ["a", "c", "b", "d"]
    areas = spark.createDataFrame([("b", None, "s1", 100), ("l", "b", "s2", 40), ("w", "l", "s3", 10)], "element string, parent string, style string, area int")
    assert {r.element: r.own_area for r in geometry.own_areas(areas).collect()} == {"b": 60, "l": 30, "w": 10}


def test_tagging(spark):
    docs = spark.createDataFrame([(1, "In New York City, Bob met Ann."), (2, "")], "id int, t string")
    names = spark.createDataFrame([("New York", "LOC"), ("New York City", "LOC"), ("Ann", "PER")], "name string, kind string")
    got = tagging.tag_names(docs, names, "id", "t").orderBy("position").collect()
    assert [r.tag for r in got] == ["O", "<LOC>", "LOC", "</LOC>", "O", "O", "<PER/>"]
    tagged = spark.createDataFrame([('a <normalised orig="thys" auto="true">this</normalised> <normalised orig="thys">these</normalised>',)], "line string")
    assert aggregates.multimap(tagging.normalisation_pairs(tagged, "line"), "orig", "norm").collect() == [("thys", "these;this")]


def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,"x\ny"\n2,z\nbad,w\n')
    good, bad = readers.read_csv(spark, str(tmp_path / "a.csv"), "k int, v string")
    assert sorted(good.collect()) == [(1, "x\ny"), (2, "z")] and len(bad.collect()) == 1
    (tmp_path / "k.tsv").write_text("id1\t{\"a\": 1}\tz\n")
    assert readers.read_keyed_lines(spark, str(tmp_path / "k.tsv")).collect() == [("id1", '{"a": 1}\tz')]
    (tmp_path / "d.json").write_text(json.dumps({"data": [{"a": 1}, {"a": 2}]}))
    assert sorted(readers.read_json_objects(spark, str(tmp_path / "d.json"), "a int", within="data").collect()) == [(1,), (2,)]
    (tmp_path / "c.json").write_text(json.dumps({"cluster_7": {"Hits": [{"doc_id": "/x/A1.txt__3_q", "original_indices": [1, 5], "text": "abcd"}]}, "cluster_8": {"hits": []}}))
    assert readers.read_reuse_clusters(spark, str(tmp_path / "c.json")).collect() == [("7", "/x/A1.txt__3_q", 1, 5, "abcd")]
    (tmp_path / "x").mkdir()
    (tmp_path / "x/good.xml").write_text("<a>t<b/>u</a>")
    (tmp_path / "x/bad.xml").write_text("<a>")
    got = readers.read_xml_events(spark, str(tmp_path / "x"))
    assert got.where("kind = 'text'").count() == 2 and got.where("error is not null").count() == 1
    assert [r.name for r in readers.list_files(spark, str(tmp_path / "x"), pattern="*.xml", exclude="bad").collect()] == ["good.xml"]
    (tmp_path / "e.ent").write_text('<!ENTITY eacute "é">\nother\n')
    assert readers.read_entity_declarations(spark, str(tmp_path / "e.ent")).where("name != ''").collect() == [("eacute", "é")]
    done = spark.createDataFrame([("a",)], "path string")
    assert readers.not_yet_done(spark.createDataFrame([("a",), ("b",)], "path string"), done).collect() == [("b",)]


def test_vrt(spark, tmp_path):
    (tmp_path / "f.vrt").write_text('<text tid="1" nick="x">\n<paragraph>\n<sentence>\nHei\t_\n!\t_\n</sentence>\n</paragraph>\n</text>\n<text tid="1" nick="y">\n<paragraph>\n<sentence>\nMoi\t_\n</text>\n<text tid="2">\n<paragraph>\n<sentence>\nJoo\t_\n</text>\n')
    got = readers.vrt_rows(readers.read_lines(spark, str(tmp_path / "f.vrt"))).orderBy("line_no").collect()
    assert [(r.thread, r.post, r.sentence, r.line.split("\t")[0]) for r in got] == [(1, 1, 1, "Hei"), (1, 1, 1, "!"), (1, 2, 2, "Moi"), (2, 3, 3, "Joo")]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(2, "b"), (1, "a")], "id int, t string")
    sinks.write_level(rows, str(tmp_path / "level"), ["id"])
    assert sorted(spark.read.parquet(str(tmp_path / "level")).collect()) == [(1, "a"), (2, "b")]
    sinks.write_text_units(rows, str(tmp_path / "units"), "id", "t")
    assert spark.read.text(str(tmp_path / "units/id=1")).collect() == [("a",)]
    sinks.write_sharded(rows, str(tmp_path / "shards"), "id")
    assert spark.read.parquet(str(tmp_path / "shards")).count() == 2
    assert sinks.html_report(rows, "T", "t", "t").count() == 2
    sinks.write_csv(rows, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 2


def test_streams_equal_batches(spark, tmp_path):
    events = spark.createDataFrame([(i, f"2024-01-01 0{i % 6}:00:00", i % 2, "view", 1.5) for i in range(12)], "event_id long, ts string, user_id long, event_type string, value double").withColumn("ts", F.to_timestamp("ts"))
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    for name, plan in (("t", event_windows.tumbling), ("s", event_windows.sessions)):
        q = plan(stream, late="1 hour").writeStream.outputMode("complete" if name == "t" else "append").format("memory").queryName(f"q_{name}").start()
        q.processAllAvailable()
        q.stop()
        if name == "t":
            assert sorted(spark.table("q_t").collect()) == sorted(plan(events).collect())


def test_link_titles(spark):
    titles = [("New York", "/ny"), ("York", "/y"), ("New York City", "/nyc"), ("a.b", "/ab"), ("York", "/other")]
    text = "New York City, New York, York, a.b axb"
    got = spark.createDataFrame([(text,), ("none",), ("York",)], "t string").select(joins.link_titles(F.col("t"), titles).alias("x")).collect()
    assert [r.x for r in got] == ['<a href="/nyc">New York City</a>, <a href="/ny">New York</a>, <a href="/y">York</a>, <a href="/ab">a.b</a> axb', "none", '<a href="/y">York</a>']
    assert spark.createDataFrame([("x",)], "t string").select(joins.link_titles(F.col("t"), []).alias("x")).first().x == "x"


@pytest.mark.parametrize("n", [0, 1, 5, 3000])
def test_global_numbers(spark, monkeypatch, n):
    monkeypatch.setattr(levels, "RANGES", 16)
    keys = [f"k{i:05d}" for i in range(n)]
    rows = spark.createDataFrame([(k,) for k in keys + keys[:3]] + [(None,)], "k string").repartition(5)
    assert {r.k: r.n for r in levels.global_numbers(rows, "k", "n").collect()} == {k: i for i, k in enumerate(keys)}


def test_ordinals(spark):
    rows = [("a", 5), ("a", 1), ("b", 9), ("a", 7), ("b", 2)]
    got = levels.ordinals(spark.createDataFrame(rows, "g string, v int"), ["g"], "v", "n").collect()
    assert {(r.g, r.v): r.n for r in got} == {("a", 1): 1, ("a", 5): 2, ("a", 7): 3, ("b", 2): 1, ("b", 9): 2}


def test_fallback(spark):
    facts = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    table = lambda *r: spark.createDataFrame(list(r), "k int, v string")
    found, missing = joins.with_fallback(facts, "k", table((1, "a")), table((1, "b"), (2, "c")), "v")
    assert sorted(found.collect()) == [(1, "a", 1), (2, "c", 2)] and missing.collect() == [(3,)]


def test_csv_judges_rows_by_all_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,2\n2,x\n")
    good, bad = readers.read_csv(spark, str(tmp_path / "a.csv"), "k int, v int")
    assert good.select("k").collect() == [(1,)] and bad.select("k").collect() == [(2,)] and good.count() == bad.count() == 1


def test_more_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(2, "b"), (1, "a"), (3, "a")], "id int, t string")
    sinks.write_level(rows, str(tmp_path / "level"), ["id"], partitions=3)
    sinks.compact(spark, str(tmp_path / "level"), str(tmp_path / "few"), ["id"], 1)
    assert [r.id for r in spark.read.parquet(str(tmp_path / "few")).collect()] == [1, 2, 3] and len(list((tmp_path / "few").glob("*.parquet"))) == 1
    page = sinks.html_report(rows.withColumn("line", F.lit("x < y")), "T & U", "t", "line", rows.where("id = 3").select("t", F.lit("lone").alias("line"))).orderBy("t").first().page
    assert page == "<html><head><title>T &amp; U</title></head><body><h1>a</h1><ul><li>x &lt; y</li></ul><h2>Without a place</h2><ul><li>lone</li></ul></body></html>"
    assert sinks.metadata_xml(rows.where("id = 2").withColumn("q", F.lit("it's")), "id", ["t", "q"]).first().value == "<unit q='it&#39;s' t='b'/>"
    files = readers.list_files(spark, str(tmp_path), pattern="*.parquet")
    assert readers.total_bytes(spark, str(tmp_path)).first().bytes >= files.agg(F.sum("size")).first()[0] > 0
    assert spark.createDataFrame([("/x/ab_12.xml",)], "p string").select(readers.file_group(F.col("p"), r"^([a-z]+)_").alias("g")).first().g == "ab"
