"""Analysed news articles: hard cases by hand, hashes against a plain version, files through the programs."""

import json
import re
import time

import pytest
from pyspark.sql import functions as F

from quillstream import __main__ as program
from quillstream.plans import article_queries, articles
from quillstream.sources import readers


def word(text, *tags):
    return {"word": text, "analysis": [{"weight": 1.0, "globalTags": [{t: ["TRUE"]} for t in tags]}]}


BODY = [word("Hi", "FIRST_IN_SENTENCE"), word(" ", "WHITESPACE"), word("you"), word(" ", "FIRST_IN_SENTENCE", "WHITESPACE"), word("Bye", "OTHER", "FIRST_IN_SENTENCE")]


def sorted_rows(rows, *columns):
    return sorted(tuple(r) for r in rows.select(*columns).collect())


def written(folder, objects):
    folder.mkdir()
    (folder / "a.json").write_text("\n".join(json.dumps(o) for o in objects))
    return str(folder)


def test_app_articles(spark, tmp_path):
    objects = [
        {"article_id": "a", "category": "c", "published_at": "t", "news_value": 3, "authors": "X,,Y,,", "analyzedTitle": [word("Big"), word(" "), word("news")], "analyzedLead": [], "analyzedBody": BODY, "text": "clash"},
        {"article_id": "b", "authors": "", "analyzedBody": [word(" ", "WHITESPACE"), {"word": None, "analysis": [{"globalTags": [{"WHITESPACE": []}]}]}]},
        {"article_id": "b"},
        {"article_id": "c", "analyzedBody": [{"word": "x"}, {"word": "y", "analysis": []}, {"word": "z", "analysis": [{"globalTags": []}]}]},
    ]
    got = articles.app_articles(readers.read_json_objects(spark, written(tmp_path / "in", objects), articles.APP), "site/")
    assert sorted_rows(got["article"], "article_id", "text", "paragraphs", "sentences", "content_tokens", "content_length") == [("a", "Hi you Bye", 1, 2, 5, 10), ("b", "", 0, 0, 0, 0), ("b", " ", 1, 0, 2, 1), ("c", "xyz", 1, 1, 3, 3)]
    a = got["article"].where("article_id = 'a'").first()
    assert (a.url, a.authors, a.headline, a.headline_tokens, a.lead, a.lead_tokens) == ("site/a", ["X", "Y"], "Big news", 3, "", 0)
    assert [w.word for w in a.headline_analysis] == ["Big", " ", "news"]
    b = got["article"].where("article_id = 'b'").first()
    assert (b.authors, b.headline, b.headline_tokens) == (None, None, None)
    assert sorted_rows(got["sentence"], "article_id", "paragraph", "sentence", "text", "content_tokens") == [("a", 0, 0, "Hi you", 3), ("a", 0, 1, "Bye", 1), ("c", 0, 0, "xyz", 3)]
    assert got["sentence"].where("text = 'Bye'").first().headline == "Big news"
    none = articles.app_articles(spark.createDataFrame([], articles.APP))
    assert {k: v.count() for k, v in none.items()} == {"article": 0, "paragraph": 0, "sentence": 0}


def test_no_shuffle(spark):
    for rows in articles.app_articles(spark.createDataFrame([], articles.APP)).values():
        assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()


def test_broadcast_articles(spark, tmp_path):
    objects = [
        {"id": "a", "url": {"full": "u"}, "publisher": {"name": "p"}, "datePublished": "2024-01-02T05:04:05+02:00", "headline": {"full": "H"}, "subjects": [{"title": {"fi": "k"}}, {"title": {"fi": "l"}}], "analyzedText": {"z": BODY, "a": [], "m": [word("Last")]}},
        {"id": "b", "datePublished": "some day", "subjects": [], "analyzedText": BODY},
        {"id": "c", "subjects": None, "analyzedText": "plain"},
        {"id": None},
    ]
    got = articles.broadcast_articles(readers.read_json_objects(spark, written(tmp_path / "in", objects), articles.BROADCAST))
    rows = {r.article_id: r for r in got["article"].collect()}
    assert (rows["a"].text, rows["a"].paragraphs, rows["a"].sentences, rows["a"].published_ms, rows["a"].first_keyword, rows["a"].headline) == ("Hi you Bye\n\nLast", 3, 3, 1704164645000, "k", "H")
    assert (rows["b"].text, rows["b"].paragraphs, rows["b"].published_ms, rows["b"].first_keyword) == ("Hi you Bye", 1, None, None)
    assert (rows["c"].text, rows["c"].paragraphs, rows[None].paragraphs) == ("", 0, 0)
    assert sorted_rows(got["paragraph"].where("article_id = 'a'"), "paragraph", "text", "sentences") == [(0, "Hi you Bye", 2), (1, "", 0), (2, "Last", 1)]


def plain_hash(text):
    h = 0
    for c in text:
        h = (h * 31 + ord(c)) % 2**32
    return h - 2**32 if h >= 2**31 else h


def test_hash(spark):
    names = ["", "0", "7", "12345", "1000003854321", "-5", "99999999999999999999", "ä1"]
    got = spark.createDataFrame([(n,) for n in names], "n string").select("n", articles.string_hash(articles.F.col("n")), articles.analysis_paths(articles.F.col("n"))[0]).collect()
    for name, h, path in got:
        a = abs(plain_hash(name))
        assert (h, path) == (plain_hash(name), f"{a % 10}/{a % 100 // 10}/{name}.analysis.json")


def test_listed_articles(spark):
    listed = lambda *ids: spark.createDataFrame([(i, None, "City", "2024-01-02 03:04", None, "T", "W", "L", None) for i in ids], articles.LISTED)
    a = abs(plain_hash("12"))
    one = lambda text: json.dumps([[word(text)]])
    files = spark.createDataFrame(
        [(f"{a % 10}/{a % 100 // 10}/12.analysis.json", one("hashed")), ("12.analysis.json", one("flat")), ("13.analysis.json", one("thirteen")), ("9/9/9/14.analysis.json", one("elsewhere")), ("-1.analysis.json", one("no")), ("x.analysis.json", one("no")), ("15.analysis.json", None), (None, one("no"))], "path string, content string"
    )
    found, missing = articles.listed_articles(listed("12", "12", "13", "14", "15", "-1", "x", "", None, " 13"), files, "s/")
    assert sorted_rows(found["article"], "article_id", "text", "url", "time_published", "writer") == [(n, t, f"s/city/art-{n}.html", "2024-01-02T03:04", "W") for n, t in ((12, "hashed"), (12, "hashed"), (13, "thirteen"), (15, ""))]
    assert missing.collect() == [(14,)]


@pytest.mark.parametrize("name", ["app-articles", "broadcast-articles"])
def test_programs(spark, tmp_path, name):
    path = written(tmp_path / "in", [{"article_id": "a", "id": "a", "analyzedBody": BODY, "analyzedText": BODY}])
    program.main([name, "--files", path, "--to", str(tmp_path / "out")], spark)
    assert spark.read.parquet(str(tmp_path / "out/sentence")).count() == 2


def test_listed_program(spark, tmp_path):
    (tmp_path / "list.csv").write_text('12,1,City,2024-01-02 03:04,,"Say ""hi""",W,L,B\nx,1,City,,,,,,\n13,1,City,,,,,,\n')
    h = abs(plain_hash("12"))
    folder = tmp_path / f"an/{h % 10}/{h % 100 // 10}"
    folder.mkdir(parents=True)
    (folder / "12.analysis.json").write_text(json.dumps([BODY]))
    program.main(["listed-articles", "--files", str(tmp_path / "list.csv"), "--other", str(tmp_path / "an"), "--to", str(tmp_path / "out")], spark)
    assert spark.read.parquet(str(tmp_path / "out/article")).select("article_id", "headline", "text").collect() == [(12, 'Say "hi"', "Hi you Bye")]
    assert spark.read.parquet(str(tmp_path / "out/missing")).collect() == [(13,)]


def test_sentences_of_a_long_paragraph(spark):
    """Each sentence copied all words of its paragraph."""
    words = [{"word": w, "analysis": [{"globalTags": [{t: None} for t in tags]}]} for _ in range(20_000) for w, tags in (("A\x01|\x01.", ["FIRST_IN_SENTENCE"]), (" ", ["WHITESPACE"]), ("b.", []), (" ", ["WHITESPACE"]))]
    rows = spark.createDataFrame([("x", json.dumps(words))], "id string, analyzedText string").select("id", F.from_json("analyzedText", articles.WORDS).alias("p")).select("id", F.array("p").alias("paragraphs"))
    tables = articles.article_tables(rows, ["id"], with_words=False)
    begun = time.monotonic()
    assert tables["sentence"].groupBy("text", "content_tokens").count().collect() == [("A\x01|\x01. b.", 4, 20_000)]
    assert tables["article"].select("sentences", "content_tokens").collect() == [(20_000, 80_000)]
    assert time.monotonic() - begun < 30


def test_trimmed_ends_with_the_text(spark):
    texts = spark.createDataFrame([(" a \u2028 ",), ("\n\t",), ("a \u2028",)], "t string")
    assert [r[0] for r in texts.select(articles.trimmed(F.col("t"))).collect()] == ["a \u2028", "", "a \u2028"]


def test_analysis_of_odd_texts(spark):
    def plain(text):
        pieces, out = re.findall("[^ \n\t]+|[ \n\t]+", text), []
        for i, p in enumerate(pieces):
            tag = "WHITESPACE" if p[0] in " \n\t" else "FIRST_IN_SENTENCE" if i == 0 or (i > 1 and pieces[i - 2].endswith(".")) else None
            out.append({"word": p, "analysis": [{"weight": 1.0, "globalTags": [{tag: ["TRUE"]} if tag else {}]}]})
        return out

    texts = ["", " ", "a", " a. b\n\nc.\td. ", 'q "x" \\n \\ \\\\ . b.\x01 c\x02 \r\n d.', "\nx. y", '["a. "]', '"]. "]', '{"word":"","analysis":[ },] a.', "é. 𝒳   ü"]
    found = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, t string").select("i", article_queries.analysis(F.col("t")).alias("j")).orderBy("i").collect()
    assert [json.loads(r.j) for r in found[:-1]] == [plain(t) for t in texts] and found[-1].j is None
