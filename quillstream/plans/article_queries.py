"""Driver queries of analysed news articles: texts of the documents are put into each feed's form, and its plan gets them back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.plans import articles
from quillstream.plans.registry import query, table
from quillstream.sources import readers, scratch

#: A piece of a text inside a JSON string, by its escapes; and a word of an analysis as JSON.
WORD, BLANK = r'(?:[^ \\"\x01]++|\\[^nt])*+', r"(?: |\\[nt])++"
ENTRY = '{"word":"%s","analysis":[{"weight":1.0,"globalTags":[{%s}]}]},'
FIRST, WHITESPACE = '"FIRST_IN_SENTENCE":["TRUE"]', '"WHITESPACE":["TRUE"]'


def analysis(text: Column) -> Column:
    """Words and blanks of a text as JSON; a sentence begins with the text, if with a word, and with each word behind one that ends in a full stop.

    Written into the text as a JSON string, two patterns for the whole text: a call for each word took most of the time.
    \\x01, which is escaped in JSON, stands before the first words until the end.
    """
    marked = F.regexp_replace(F.to_json(F.array(text)), rf'(^\["|\.{BLANK})(?![" ]|\\[nt])', "$1\x01")
    # words and the blanks, or the end, behind them; an empty word is before a blank at the begin, or at the end
    words = F.regexp_replace(marked, rf'(\x01?+)({WORD})({BLANK}|"\]$)', ENTRY % ("$2", "$1") + ENTRY % ("$3", WHITESPACE))
    for found, put in ((ENTRY % ("", ""), ""), ("," + ENTRY % ('"]', WHITESPACE), "]"), ("\x01", FIRST)):
        words = F.replace(words, F.lit(found), F.lit(put))
    return F.when(text == "", F.lit("[]")).when(text.isNotNull(), F.concat(F.lit("["), F.substr(words, F.lit(3))))


def with_analyses(fields: Column, **analyses: Column) -> Column:
    """A struct as a JSON object, with further fields that are JSON already; null ones are left out."""
    more = [F.coalesce(F.concat(F.lit(f',"{name}":'), value), F.lit("")) for name, value in analyses.items()]
    return F.concat(F.regexp_replace(F.to_json(fields), "[}]$", ""), *more, F.lit("}"))


#: Pieces of the documents' lines (or of whole texts), with the number of their sentence; rid tells repeated rows apart.
SQL_SENTENCES = """(SELECT *, sum(CAST(first AS INT)) OVER (PARTITION BY rid, paragraph ORDER BY i) AS s FROM (
  SELECT rid, doc_id, paragraph, i, ps[i] AS piece, regexp_matches(ps[i], '^[ \\n\\t]') AS blank, i = 1 OR (NOT regexp_matches(ps[i], '^[ \\n\\t]') AND i > 2 AND ends_with(ps[greatest(i - 2, 1)], '.')) AS first
  FROM (SELECT rid, doc_id, paragraph, ps, unnest(range(1, len(ps) + 1)) AS i FROM (SELECT rid, doc_id, paragraph, regexp_extract_all(part, '[^ \\n\\t]+|[ \\n\\t]+') AS ps FROM %s))))"""
SQL_WHOLE = "(SELECT row_number() OVER () AS rid, doc_id, 0 AS paragraph, text AS part FROM documents)"
SQL_PARTS = "(SELECT rid, doc_id, l.i - 1 AS paragraph, l.x AS part FROM (SELECT rid, doc_id, unnest(list_transform(string_split(text, chr(10)), lambda x, i: {'x': x, 'i': i})) AS l FROM (SELECT row_number() OVER () AS rid, * FROM documents)))"


def app_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as objects of the app's feed, written as JSON lines and read again."""
    fields = {"article_id": F.col("doc_id").cast("string"), "category": F.col("source"), "published_at": F.lit("2024-01-02T03:04:05Z"), "news_value": F.col("n_chars").cast("int"), "authors": F.concat_ws(",", "lang", "source", F.lit(""))}
    lead = F.substring_index("text", "\n", 1)
    written = with_analyses(F.struct(*[c.alias(n) for n, c in fields.items()]), analyzedTitle=analysis(F.concat_ws(" ", "lang", "source")), analyzedLead=analysis(lead), analyzedBody=analysis(F.col("text")))
    path = scratch.folder(spark, "app-articles")
    table(spark, sf_dir, "documents").select(written.alias("value")).write.text(path, compression="lz4")
    return readers.read_json_objects(spark, path, articles.APP)


@query(f"""WITH s AS (SELECT rid, count(DISTINCT s) FILTER (NOT blank) AS sentences, count(*) AS tokens FROM {SQL_SENTENCES % SQL_WHOLE} GROUP BY rid)
  SELECT CAST(doc_id AS VARCHAR) AS article_id, source AS publisher, concat_ws(';', lang, source) AS authors, concat_ws(' ', lang, source) AS headline, CAST(len(regexp_extract_all(concat_ws(' ', lang, source), '[^ \\n\\t]+|[ \\n\\t]+')) AS INT) AS headline_tokens,
  string_split(text, chr(10))[1] AS lead, CAST(len(regexp_extract_all(string_split(text, chr(10))[1], '[^ \\n\\t]+|[ \\n\\t]+')) AS INT) AS lead_tokens, md5(coalesce(text, '')) AS text_md5, CAST(text IS NOT NULL AS INT) AS paragraphs,
  CAST(coalesce(sentences, 0) AS INT) AS sentences, CAST(coalesce(tokens, 0) AS INT) AS content_tokens FROM (SELECT row_number() OVER () AS rid, * FROM documents) LEFT JOIN s USING (rid)""")
def app_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of one paragraph with an analysed headline and lead."""
    rows = articles.app_articles(app_objects(spark, sf_dir), "https://news.example/a/")["article"]
    return rows.select("article_id", "publisher", F.array_join("authors", ";").alias("authors"), "headline", "headline_tokens", "lead", "lead_tokens", F.md5("text").alias("text_md5"), "paragraphs", "sentences", "content_tokens")


@query(f"""SELECT CAST(doc_id AS VARCHAR) AS article_id, CAST(row_number() OVER (PARTITION BY rid ORDER BY s) - 1 AS INT) AS sentence, text, CAST(length(text) AS INT) AS content_length, CAST(n AS INT) AS content_tokens
  FROM (SELECT rid, doc_id, s, regexp_replace(string_agg(piece, '' ORDER BY i), '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g') AS text, count(*) AS n, bool_and(blank) AS blank FROM {SQL_SENTENCES % SQL_WHOLE} GROUP BY ALL) WHERE NOT blank""")
def app_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences of the app's articles, by the analysis's marks."""
    return articles.app_articles(app_objects(spark, sf_dir), with_words=False)["sentence"].select("article_id", "sentence", "text", "content_length", "content_tokens")


@query(f"""WITH p AS MATERIALIZED {SQL_PARTS}, s AS (SELECT rid, paragraph, count(DISTINCT s) FILTER (NOT blank) AS n, count(*) AS tokens FROM {SQL_SENTENCES % 'p'} GROUP BY ALL),
  a AS (SELECT rid, count(*) AS paragraphs, string_agg(part, chr(10) || chr(10) ORDER BY paragraph) FILTER (part <> '') AS text, sum(coalesce(n, 0)) AS n, sum(coalesce(tokens, 0)) AS tokens FROM p LEFT JOIN s USING (rid, paragraph) GROUP BY rid)
  SELECT CAST(doc_id AS VARCHAR) AS article_id, source AS publisher, lang AS first_keyword, CAST(1704164645000 AS BIGINT) AS published_ms, CAST(coalesce(a.paragraphs, 0) AS INT) AS paragraphs, CAST(coalesce(a.n, 0) AS INT) AS sentences, CAST(coalesce(tokens, 0) AS INT) AS content_tokens,
  CAST(length(coalesce(a.text, '')) AS INT) AS content_length, md5(coalesce(a.text, '')) AS text_md5 FROM (SELECT row_number() OVER () AS rid, * FROM documents) LEFT JOIN a USING (rid)""")
def broadcast_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles whose analysis is an object of paragraphs, or one array if there is one line."""
    lines = F.split("text", "\n")
    several = F.array_join(F.transform(lines, lambda x, i: F.concat(F.lit('"p'), i.cast("string"), F.lit('":'), analysis(x))), ",")
    # the analysis is an object in some rows and an array in others
    analysed = F.when(F.size(lines) > 1, F.concat(F.lit("{"), several, F.lit("}"))).otherwise(analysis(F.col("text")))
    fields = F.struct(
        F.col("doc_id").cast("string").alias("id"), F.struct(F.lit("u").alias("full")).alias("url"), F.struct(F.col("source").alias("name")).alias("publisher"), F.lit("2024-01-02T05:04:05+02:00").alias("datePublished"), F.lit(None).cast("string").alias("coverage"),
        F.struct(F.col("lang").alias("full")).alias("headline"), F.col("source").alias("lead"), F.array(F.struct(F.struct(F.col("lang").alias("fi")).alias("title"))).alias("subjects"),
    )
    path = scratch.folder(spark, "broadcast-articles")
    table(spark, sf_dir, "documents").select(with_analyses(fields, analyzedText=analysed).alias("value")).write.text(path, compression="lz4")
    rows = articles.broadcast_articles(readers.read_json_objects(spark, path, articles.BROADCAST))["article"]
    return rows.select("article_id", "publisher", "first_keyword", "published_ms", "paragraphs", "sentences", "content_tokens", "content_length", F.md5("text").alias("text_md5"))


SQL_HASH = "list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split(id, ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda a, c: (a * 31 + c) % 4294967296)"


@query(f"""WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) || '00' AS id, o_orderpriority AS title, o_orderstatus AS status FROM orders), h AS (SELECT *, abs(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) AS a FROM (SELECT *, {SQL_HASH} AS h FROM o))
  SELECT CAST(id AS BIGINT) AS article_id, CASE status WHEN 'O' THEN NULL WHEN 'F' THEN a % 10 || '/' || a % 100 // 10 || '/' || id || '.analysis.json' ELSE id || '.analysis.json' END AS analysis_path, CASE status WHEN 'F' THEN 'hashed ' || title WHEN 'P' THEN 'flat ' || title END AS text, 'https://news.example/' || lower(status) || '/art-' || CAST(id AS BIGINT) || '.html' AS url FROM h WHERE status <> 'O'
  UNION ALL SELECT CAST(id AS BIGINT), NULL, NULL, NULL FROM h WHERE status = 'O'""")
def listed_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as rows of a list of articles: finished ones have an analysis in their hash's folder and an old one at the top, pending ones at the top, open ones none."""
    orders = table(spark, sf_dir, "orders").withColumn("id", F.concat(F.col("o_orderkey").cast("string"), F.lit("00")))
    none = F.lit(None).cast("string")
    rows = orders.select(
        F.col("id").alias("article_id"), none.alias("node_id"), F.col("o_orderstatus").alias("node_title"), F.lit("2024-01-02 03:04").alias("start_date"), none.alias("modified_date"), F.col("o_orderpriority").alias("title"), none.alias("byline"), none.alias("ingress"), none.alias("body")
    )
    hashed, flat = articles.analysis_paths(F.col("id"))
    file = lambda path, mark: F.struct(path.alias("path"), F.concat(F.lit("["), analysis(F.concat_ws(" ", F.lit(mark), "o_orderpriority")), F.lit("]")).alias("content"))
    files = orders.select(F.explode(F.when(F.col("o_orderstatus") == "F", F.array(file(hashed, "hashed"), file(flat, "flat"))).when(F.col("o_orderstatus") == "P", F.array(file(flat, "flat")))).alias("f")).select("f.*")
    found, missing = articles.listed_articles(rows, scratch.kept(files, "analyses"), "https://news.example/")
    return found["article"].select("article_id", "analysis_path", "text", "url").unionByName(missing, allowMissingColumns=True)
