"""What larger tables and odd files showed: tables as folders, marks in names, long texts."""

import time
from collections import Counter

from pyspark.sql import functions as F

from quillstream.functions import python as functions
from quillstream.functions import text
from quillstream.operators import dictionary, geometry, languages
from quillstream.plans import format_queries, newspapers, queries, registry, scans
from quillstream.sources import scratch, sinks


def test_file_list_of_folders_and_strangers(spark, tmp_path):
    for path in ("part.parquet", "documents.parquet/a.parquet", "customer.parquet/a.parquet", "customer.parquet/b.parquet", "clicks.parquet", "stamps.parquet/a.parquet"):
        (tmp_path / path).parent.mkdir(exist_ok=True)
        (tmp_path / path).write_bytes(b"x")
    assert sorted(r.name for r in format_queries.file_list(spark, str(tmp_path)).collect()) == ["customer.parquet", "part.parquet"]


def test_names_end_with_ascii_word_characters(spark):
    docs = spark.createDataFrame([(1, "we saw a café there"), (2, "we saw a caf.")], "id long, text string")
    names = spark.createDataFrame([("a caf", "short"), ("a café", "long")], "name string, value string")
    found = dictionary.named_words(docs, names, "id", "text")
    assert sorted((r.id, r.value) for r in found.collect()) == [(1, "short"), (2, "short")]


def test_pages_are_batched(spark):
    """Pages reach Python many at once: a call for each group of rows took most of the time."""
    blocks = spark.createDataFrame([(p, f"b{b}", b * 7 % 5, b if b == 2 else None) for p in range(50) for b in range(4)], "page int, block string, position int, logical int")
    words = spark.createDataFrame([(p, n, n % 3 * 30, n // 3 * 12, n % 3 * 30 + 20, n // 3 * 12 + 10) for p in range(50) for n in range(7)], "page int, n int, x1 int, y1 int, x2 int, y2 int")
    placed, lined = geometry.reading_order(blocks, ["page"]), geometry.words_to_lines(words, ["page"], "n")
    for df in (placed, lined):
        assert "FlatMapGroups" not in df._jdf.queryExecution().toString()
    assert {tuple(r.block for r in placed.where(F.col("page") == p).orderBy("place").collect()) for p in (0, 49)} == {("b0", "b3", "b1", "b2")}
    assert {(r.n, r.line) for r in lined.collect()} == {(n, n // 3) for n in range(7)}


def test_parsed_files_leave_in_parts(spark, monkeypatch):
    monkeypatch.setattr(scans, "PARSED_BYTES", 100)
    files = spark.createDataFrame([(str(i), b"<book><page type='t'><p><wd pos='1,2,3,4'>w</wd></p></page></book>" if i else b"<book>") for i in range(9)], "path string, content binary").coalesce(1)
    parsed = scans.parsed_files(files, ["path"], scans.ocr_file, scans.OCR)
    told = {r.path: r.p for r in parsed.collect()}
    assert len(told) == 9 and told["0"].words is None and "ExpatError" in told["0"].error
    assert all(len(told[str(i)].words) == 1 and told[str(i)].error is None for i in range(1, 9))


def test_trigrams_of_a_long_text(spark):
    """Time grew with the square of a text's length."""
    text = "abcdefghij " * 60_000
    grams = languages.trigrams(spark.createDataFrame([("x", text), ("y", ""), ("z", "ab")], "k string, text string"), "k")
    begun = time.monotonic()
    found = {(r.k, r.gram): r.n for r in grams.collect()}
    assert time.monotonic() - begun < 60
    plain = {k: " ".join(f" {t} ".split(" ")) for k, t in (("x", text.strip()), ("y", ""), ("z", "ab"))}
    plain["y"] = " "
    want = Counter((k, t[i : i + 3]) for k, t in plain.items() for i in range(max(len(t) - 2, 1)))
    assert found == dict(want)


def test_many_equal_rows_are_not_broadcast(spark):
    """A million equal rows are some bytes in a file, and were broadcast."""
    large = scratch.small(spark.range(1_000_000).select(F.lit("the same words in each row").alias("k")), "large")
    small = scratch.small(spark.range(10).select(F.lit("the same words in each row").alias("k")), "small")
    plan = lambda df: spark.range(5).select(F.lit("x").alias("k")).join(df, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(small) and "strategy=broadcast" not in plan(large)


def test_offsets_of_a_long_text(spark):
    """The places were appended to an array that was copied for each token: time grew with the square of a text's length."""
    docs = spark.createDataFrame([(1, "word, " * 200_000), (2, ""), (3, None)], "id int, t string")
    begun = time.monotonic()
    found = docs.select("id", F.explode(text.offset_postings(F.col("t"))).alias("p")).agg(F.count(F.lit(1)), F.max("p.start"), F.max("p.end"), F.min("id"), F.max("id")).first()
    assert tuple(found) == (200_000, 199_999 * 6, 199_999 * 6 + 5, 1, 1)
    assert time.monotonic() - begun < 30


def test_feed_records_are_parsed_once(spark):
    """each field parsed its record anew, for both tables."""
    full = "<item><subject qcode='sttdepartment:d'/><genre qcode='sttgenre:g'/><subject qcode='s:1'/><headline>a&amp;b<b>c</b>d<!-- x -->e</headline><versionCreated>v</versionCreated><contentCreated>c</contentCreated><versionCreated/><by><![CDATA[x]]></by><urgency>3</urgency></item>"
    records = spark.createDataFrame([("1", full), ("2", "<item/>"), ("3", None), ("4", "<item><headline><i>x</i></headline><urgency>u</urgency></item>")], "id string, record string")
    facts, subjects = newspapers.feed_records(records)
    assert "xpath" not in facts._jdf.queryExecution().toString() and "Arrow" not in facts.join(subjects, "article_id")._jdf.queryExecution().toString()
    got = {r.article_id: tuple(r)[1:] for r in facts.select("article_id", "department", "genre", "time_published", "headline", "byline", "urgency").collect()}
    none = (None,) * 6
    assert got == {"1": ("d", "g", "c", "a&b", "x", 3), "2": none, "3": none, "4": none}
    assert subjects.collect() == [("1", "s:1")]


def test_pages_leave_in_parts():
    """pages of a batch, and their results, were held together as strings."""
    found = list(functions.in_parts(["ab", None, "c", "", "defg", "h"], 3, str.upper))
    assert found == [["AB", None, "C"], ["", "DEFG"], ["H"]]


def test_small_files_are_dealt_out(spark, tmp_path):
    spark.range(10_000).coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    rows = spark.read.parquet(str(tmp_path / "part.parquet"))
    assert registry.dealt(rows).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism > rows.rdd.getNumPartitions()


def test_pretty_files_are_written_by_tasks(spark, tmp_path):
    """Spark's writer took some 30 ms of eight cores for a folder."""
    rows = spark.range(3000).select(F.concat(F.lit("a/b="), F.col("id").cast("string")).alias("k"), F.col("id").alias("n"))
    path = str(tmp_path / "pretty")
    begun = time.monotonic()
    sinks.write_pretty_json(rows.unionByName(spark.sql("select cast(null as string) as k, 7L as n")), path, "k")
    assert time.monotonic() - begun < 20
    assert len(list((tmp_path / "pretty").iterdir())) == 3001 and (tmp_path / "pretty/k=__HIVE_DEFAULT_PARTITION__").is_dir()
    found = spark.read.text(f"{path}/k=a%2Fb%3D12/*.txt", wholetext=True).select(F.from_json("value", "n long").alias("o")).first()
    assert found.o.n == 12


def test_postings_of_repeated_documents(spark, tmp_path):
    """positions are grouped in a document's row; only those of repeated documents are shuffled, and all are kept."""
    docs = spark.createDataFrame([(1, "b a b"), (2, "a"), (2, "a c a"), (None, "z"), (3, None), (4, "")], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.postings(spark, str(tmp_path))
    assert {tuple(r) for r in found.collect()} == {("a", 1, 1, "1"), ("b", 1, 2, "0,2"), ("a", 2, 3, "0,0,2"), ("c", 2, 1, "1"), ("z", None, 1, "0")}
    docs.where("doc_id = 1").write.parquet(str(tmp_path / "once/documents.parquet"))
    once = queries.postings(spark, str(tmp_path / "once"))
    assert "Aggregate" not in once._jdf.queryExecution().toString()


def test_poem_tokens_are_made_once(spark, tmp_path):
    """tokens were made for each of two counts."""
    spark.createDataFrame([(1, "1 Üb, x #3")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.poem_terms(spark, str(tmp_path))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("#\\d+") == 1
    assert found.collect() == [(1, 3, 2)]


def test_top_terms_are_counted_in_rows(spark, tmp_path, monkeypatch):
    """all words were shuffled to be counted; only those of repeated documents are."""
    texts = [(1, "b a b é z é c d e f"), (2, "x y"), (2, "y - w"), (None, "z z"), (3, None), (4, ""), (5, "One one, two")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = {(1, "b", 2, 1), (1, "é", 2, 2), (1, "a", 1, 3), (1, "c", 1, 4), (1, "d", 1, 5), (2, "y", 2, 1), (2, "w", 1, 2), (2, "x", 1, 3), (None, "z", 2, 1), (5, "one", 2, 1), (5, "two", 1, 2)}
    for broadcast in (0, 4_000_000):
        monkeypatch.setattr(scratch, "BROADCAST_BYTES", broadcast)
        found = queries.term_vectors_topk(spark, str(tmp_path)).select("doc_id", "term", "tf", "rank").collect()
        assert {tuple(r) for r in found} == want and len(found) == len(want)
    spark.createDataFrame(texts[:2], "doc_id long, text string").write.parquet(str(tmp_path / "once/documents.parquet"))
    plan = queries.term_vectors_topk(spark, str(tmp_path / "once"))._jdf.queryExecution().toString()
    assert "Aggregate" not in plan and "Window" not in plan
