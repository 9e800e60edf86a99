"""Driver queries of search, alignment, dictionaries, topics, hierarchies and streams of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.functions import text
from quillstream.operators import aggregates, alignment, dictionary, gibbs, hierarchy, languages, prefixes, search
from quillstream.operators import levels as level_rows
from quillstream.plans import themes
from quillstream.plans.registry import query, table
from quillstream.plans.sql import SQL_TERMS, SQL_TOKENS, SQL_TRIGRAMS
from quillstream.sources import scratch
from quillstream.streaming import levels as arriving

SQL_ITEM_TERMS = f"(SELECT item_id, list_filter({SQL_TOKENS}, lambda t: t <> '') AS ts FROM benchmark)"


def document_index(spark: SparkSession, sf_dir: str) -> search.Index:
    return search.build(table(spark, sf_dir, "documents"), "doc_id", "text", scratch.folder(spark, "index"))


def item_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id, ts: the terms of each benchmark item that aren't empty."""
    return table(spark, sf_dir, "benchmark").select("item_id", F.filter(text.default_analyzer(F.col("text")), lambda t: t != "").alias("ts"))


@query(f"""WITH d AS MATERIALIZED {SQL_TERMS}, q AS {SQL_ITEM_TERMS}
  SELECT item_id, a.doc_id AS doc_id, count(*) AS hits, CAST(min(a.pos) AS INT) AS first FROM q JOIN d a ON a.term = ts[3] JOIN d b ON b.doc_id = a.doc_id AND b.pos = a.pos + 1 AND b.term = ts[4] JOIN d c ON c.doc_id = a.doc_id AND c.pos = a.pos + 2 AND c.term = ts[5]
  WHERE len(ts) >= 5 GROUP BY ALL""")
def phrase_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three words of each benchmark item as a phrase in all documents."""
    asked = item_terms(spark, sf_dir).where(F.size("ts") >= 5).select(F.col("item_id").alias("query"), F.slice("ts", 3, 3).alias("terms"))
    found = search.phrases(document_index(spark, sf_dir), asked)
    return found.select(F.col("query").alias("item_id"), F.col("doc").alias("doc_id"), F.size("starts").cast("long").alias("hits"), F.col("starts")[0].alias("first"))


@query(f"""WITH d AS MATERIALIZED {SQL_TERMS}, q AS (SELECT item_id, list_distinct([ts[1], ts[4], ts[6]]) AS ts FROM {SQL_ITEM_TERMS} WHERE len(ts) >= 6),
  h AS MATERIALIZED (SELECT item_id, len(ts) AS n, doc_id, pos, d.term FROM (SELECT item_id, ts, unnest(ts) AS term FROM q) JOIN d USING (term)),
  w AS (SELECT a.item_id, a.doc_id, a.pos FROM h a JOIN h b ON a.item_id = b.item_id AND a.doc_id = b.doc_id AND b.pos BETWEEN a.pos AND a.pos + 8 GROUP BY a.item_id, a.doc_id, a.pos HAVING count(DISTINCT b.term) = any_value(a.n))
  SELECT item_id, doc_id, count(*) AS hits, CAST(min(pos) AS INT) AS first FROM w GROUP BY ALL""")
def near_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three words of each benchmark item within eight words of each other, in all documents."""
    asked = item_terms(spark, sf_dir).where(F.size("ts") >= 6).select(F.col("item_id").alias("query"), F.array(F.col("ts")[0], F.col("ts")[3], F.col("ts")[5]).alias("terms"))
    found = search.near(document_index(spark, sf_dir), asked, 8)
    return found.select(F.col("query").alias("item_id"), F.col("doc").alias("doc_id"), F.size("starts").cast("long").alias("hits"), F.col("starts")[0].alias("first"))


#: Names with letters changed, put in and left out: the cheapest of all substrings of the page, by trying each.
NOISY = "substr(replace(replace(p_name, 'a', 'e'), 'l', 'll'), 3, 14)"


@query(f"""WITH t AS (SELECT p_partkey, p_name, {NOISY} AS needle FROM part), c AS (SELECT p_partkey, needle, p_name, a, unnest(range(0, length(p_name) - a + 1)) AS n FROM (SELECT *, unnest(range(0, length(p_name) + 1)) AS a FROM t))
  SELECT p_partkey, CAST(min(levenshtein(needle, substr(p_name, a + 1, n))) AS INT) AS cost, true AS attained FROM c GROUP BY p_partkey""")
def noisy_alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts' names with errors against the names themselves: the least cost, and that the substring found has it."""
    parts = table(spark, sf_dir, "part")
    rows = parts.select("p_partkey", F.expr(NOISY).alias("needle"))
    found = alignment.align_rows(rows, parts.select("p_partkey", "p_name"), ["p_partkey"], "needle", "p_name", gram=3)
    piece = F.substring(F.col("p_name"), F.col("start") + 1, F.col("length"))
    return found.select("p_partkey", F.col("cost").cast("int").alias("cost"), (F.levenshtein("needle", piece) == F.col("cost")).alias("attained"))


@query("""SELECT doc_id, regexp_replace(text, (SELECT string_agg(t, '|' ORDER BY length(t) DESC, t) FROM (SELECT DISTINCT regexp_extract(text, '[a-z]{5,}', 0) AS t FROM benchmark) WHERE t <> ''), '<a href="/\\0">\\0</a>', 'g') AS text FROM documents""")
def linked_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first long word of each benchmark item as a link wherever it stands in the documents: titles from a table."""
    titles = table(spark, sf_dir, "benchmark").select(F.regexp_extract("text", "[a-z]{5,}", 0).alias("title")).withColumn("url", F.concat(F.lit("/"), "title"))
    return dictionary.link_titles(table(spark, sf_dir, "documents").select("doc_id", "text"), titles, "doc_id", "text")


@query(r"""WITH w AS (SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda t: t <> '') AS ws FROM documents), n AS (SELECT DISTINCT array_to_string(string_split_regex(text, '\s+')[1:8], ' ') AS name, 8 AS n FROM benchmark WHERE len(string_split_regex(text, '\s+')) >= 8),
  g AS (SELECT doc_id, array_to_string(ws[i:i + 6], ' ') || ' ' || regexp_replace(ws[i + 7], '[^\w]+$', '') AS name FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w))
  SELECT doc_id, count(*) AS hits, CAST(count(*) * 8 AS BIGINT) AS words FROM g JOIN n USING (name) GROUP BY doc_id""")
def named_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of eight words: the beginnings of the benchmark's items in the documents."""
    words = F.split("text", r"\s+")
    names = table(spark, sf_dir, "benchmark").where(F.size(words) >= 8).select(F.array_join(F.slice(words, 1, 8), " ").alias("name"), F.lit("x").alias("value"))
    found = dictionary.named_words(table(spark, sf_dir, "documents"), names, "doc_id", "text")
    return found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("hits"), F.sum("n").cast("long").alias("words"))


def turn_model(spark: SparkSession, sf_dir: str) -> gibbs.Model:
    turns = table(spark, sf_dir, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("key"), "text")
    return gibbs.sample(gibbs.terms(turns, "key", "text", [], 2), topics=8, rounds=4)


@query()
def gibbs_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gibbs.top_words(turn_model(spark, sf_dir))


@query()
def gibbs_document_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gibbs.document_topics(turn_model(spark, sf_dir))


@query(r"""WITH t AS (SELECT conv_id || '-' || turn AS key, list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), lambda t: NOT regexp_matches(t, '^\d+$')) AS w FROM conversations),
  e AS (SELECT key, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS word FROM t),
  n AS (SELECT word, count(*) AS tokens FROM e GROUP BY word HAVING count(DISTINCT key) >= 2)
  SELECT r.round AS round, (SELECT CAST(sum(tokens) AS BIGINT) FROM n) AS tokens, (SELECT count(*) FROM n) AS words FROM (SELECT unnest(range(4)) AS round) r""")
def gibbs_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the merged counts of each round add up to: all tokens, and all different words."""
    return spark.createDataFrame(turn_model(spark, sf_dir).rounds, "round long, tokens long, words long")


@query("""WITH p AS MATERIALIZED (SELECT l_returnflag AS flag, l_quantity AS x, floor(l_extendedprice / 1000) AS y, count(*) AS n FROM lineitem GROUP BY ALL), t AS (SELECT flag, sum(n) AS n FROM p GROUP BY flag),
  s AS (SELECT a.flag, sum(CAST(a.n * b.n AS DOUBLE) * sign(b.y - a.y)) AS s FROM p a JOIN p b ON a.flag = b.flag AND a.x < b.x GROUP BY a.flag),
  tx AS (SELECT flag, sum(m * (m - 1) / 2) AS tx FROM (SELECT flag, x, CAST(sum(n) AS DOUBLE) AS m FROM p GROUP BY flag, x) GROUP BY flag), ty AS (SELECT flag, sum(m * (m - 1) / 2) AS ty FROM (SELECT flag, y, CAST(sum(n) AS DOUBLE) AS m FROM p GROUP BY flag, y) GROUP BY flag)
  SELECT flag, CAST(n AS BIGINT) AS n, round(s / (sqrt(CAST(n AS DOUBLE) * (n - 1) / 2 - tx) * sqrt(CAST(n AS DOUBLE) * (n - 1) / 2 - ty)), 6) AS kendall FROM t JOIN s USING (flag) JOIN tx USING (flag) JOIN ty USING (flag)""")
def kendall_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tau-b of quantity and price in thousands, by return flag."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), F.col("l_quantity").alias("x"), F.floor(F.col("l_extendedprice") / 1000).alias("y"))
    return aggregates.kendall(rows, ["flag"], "x", "y").withColumn("kendall", F.round("kendall", 6))


@query("""SELECT p.p_partkey, p.p_name, q.p_partkey AS r_p_partkey, q.prefix AS r_prefix FROM part p JOIN (SELECT p_partkey, substr(p_name, 1, 4 + p_partkey % 9) AS prefix FROM part) q ON starts_with(p.p_name, q.prefix)""")
def prefix_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names with the beginnings of other parts' names that they share."""
    parts = table(spark, sf_dir, "part")
    probes = parts.select("p_partkey", F.expr("substr(p_name, 1, 4 + p_partkey % 9)").alias("prefix"))
    return prefixes.prefix_join(parts.select("p_partkey", "p_name"), "p_name", probes, "prefix")


@query("""WITH q AS (SELECT DISTINCT unnest([substr(c_name, 1, length(c_name) - 1), substr(c_name, 1, length(c_name) - 2), substr(c_name, 1, 8)]) AS prefix FROM customer) SELECT prefix, count(*) AS n FROM customer JOIN q ON starts_with(c_name, prefix) GROUP BY prefix""")
def prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many customers' names begin with each shortened name: long prefixes of few, and one that all share."""
    names = table(spark, sf_dir, "customer").select("c_name")
    cut = [F.expr("substr(c_name, 1, length(c_name) - 1)"), F.expr("substr(c_name, 1, length(c_name) - 2)"), F.expr("substr(c_name, 1, 8)")]
    return prefixes.prefix_counts(names, "c_name", names.select(F.explode(F.array(*cut)).alias("prefix")), "prefix")


#: Each turn hangs below the turn before it; the first below another conversation's first, down to conversation 0; every seventh conversation hangs below its own last turn.
SQL_TURNS = """(SELECT conv_id * 1000 + turn AS node, conv_id, turn, CASE WHEN turn > 0 THEN conv_id * 1000 + turn - 1 WHEN conv_id % 7 = 3 THEN conv_id * 1000 + last WHEN conv_id > 0 THEN (conv_id - CASE WHEN conv_id % 7 = 4 THEN 2 ELSE 1 END) * 1000 END AS parent
  FROM (SELECT conv_id, turn, max(turn) OVER (PARTITION BY conv_id) AS last FROM conversations))"""


@query(f"""WITH t AS {SQL_TURNS}, c AS (SELECT DISTINCT conv_id FROM t), d AS (SELECT conv_id, (SELECT count(*) FROM c b WHERE b.conv_id < a.conv_id AND b.conv_id % 7 <> 3) AS above FROM c a)
  SELECT node, conv_id % 7 = 3 AS cyclic, CASE WHEN conv_id % 7 <> 3 THEN above + turn END AS depth, CASE WHEN conv_id % 7 <> 3 THEN 0 END AS root FROM t JOIN d USING (conv_id)""")
def turn_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hierarchy as deep as there are conversations, and cycles: depth and root of each turn by pointer jumping."""
    at = F.col("conv_id") * 1000
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    last = turns.groupBy("conv_id").agg(F.max("turn").alias("last"))
    first = F.when(F.col("conv_id") % 7 == 3, at + F.col("last")).when(F.col("conv_id") > 0, at - F.when(F.col("conv_id") % 7 == 4, 2000).otherwise(1000))
    rows = turns.join(last, "conv_id").select((at + F.col("turn")).alias("node"), F.when(F.col("turn") > 0, at + F.col("turn") - 1).otherwise(first).alias("parent"))
    return hierarchy.climbed(rows, "node", "parent").select("node", "cyclic", "depth", "root")


@query("""WITH n AS (SELECT n_nationkey, n_name, n_regionkey, (SELECT string_agg('<li>' || s_name || ' (0)</li>', '' ORDER BY s_name) FROM supplier WHERE s_nationkey = n_nationkey) AS parts, (SELECT count(DISTINCT c_mktsegment) FROM customer WHERE c_nationkey = n_nationkey) AS k,
    (SELECT string_agg('<li>' || m || '</li>', '' ORDER BY m) FROM (SELECT DISTINCT c_mktsegment AS m FROM customer WHERE c_nationkey = n_nationkey)) AS items FROM nation),
  np AS (SELECT *, '<li>' || n_name || ' (' || k || ')' || CASE WHEN parts IS NULL THEN coalesce('<ul>' || items || '</ul>', '') ELSE '<ul>' || parts || '</ul>' || coalesce('<ul class="orphans">' || items || '</ul>', '') END || '</li>' AS page FROM n),
  r AS (SELECT r_regionkey, r_name, CAST(sum(k) AS BIGINT) AS total, string_agg(page, '' ORDER BY n_name) AS parts FROM region JOIN np ON n_regionkey = r_regionkey GROUP BY ALL)
  SELECT 's' || s_suppkey AS theme, 2 AS depth, 0 AS total, 0 AS orphans, '<li>' || s_name || ' (0)</li>' AS page FROM supplier UNION ALL SELECT 'n' || n_nationkey, 1, k, CASE WHEN parts IS NULL THEN 0 ELSE k END, page FROM np
  UNION ALL SELECT 'r' || r_regionkey, 0, total, 0, '<li>' || r_name || ' (' || total || ')<ul>' || parts || '</ul></li>' FROM r""")
def theme_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions, nations and suppliers as a tree of themes; market segments of a nation's customers are its orphans."""
    mark = lambda m, c: F.concat(F.lit(m), F.col(c).cast("string"))
    tree = table(spark, sf_dir, "region").select(mark("r", "r_regionkey").alias("theme"), F.lit(None).cast("string").alias("parent"), F.col("r_name").alias("title"))
    tree = tree.unionByName(table(spark, sf_dir, "nation").select(mark("n", "n_nationkey").alias("theme"), mark("r", "n_regionkey").alias("parent"), F.col("n_name").alias("title")))
    tree = tree.unionByName(table(spark, sf_dir, "supplier").select(mark("s", "s_suppkey").alias("theme"), mark("n", "s_nationkey").alias("parent"), F.col("s_name").alias("title")))
    items = table(spark, sf_dir, "customer").select(mark("n", "c_nationkey").alias("theme"), F.col("c_mktsegment").alias("line")).distinct()
    return themes.nested_report(tree, items).select("theme", "depth", "total", "orphans", "page")


@query("SELECT doc_id, count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS chars FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY doc_id")
def arriving_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents that arrive in two deliveries, a part of which comes twice: built batch by batch from the new files."""
    docs, source, to = table(spark, sf_dir, "documents").select("doc_id", "text"), scratch.folder(spark, "inbox"), scratch.folder(spark, "built")
    plan = lambda units: {"lines": level_rows.lines(units)}
    for part in (docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1 OR doc_id % 10 = 0")):
        part.write.mode("append").parquet(source)
        arriving.build(spark, source, "doc_id long, text string", to, "doc_id", plan, files_each=4)
    arriving.build(spark, source, "doc_id long, text string", to, "doc_id", plan)  # nothing is new
    return arriving.latest(spark, to, "lines", "doc_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.length("line")).alias("chars"))


SQL_RANKED = "(SELECT k, gram, row_number() OVER (PARTITION BY k ORDER BY n DESC, gram) AS rank FROM %s QUALIFY rank <= 300)"


@query(f"""WITH p AS {SQL_RANKED % (SQL_TRIGRAMS % ('lang', 'documents'))}, g AS {SQL_RANKED % (SQL_TRIGRAMS % ('item_id', 'benchmark'))}, b AS (SELECT k, count(*) AS n FROM g GROUP BY k), l AS (SELECT DISTINCT k AS lang FROM p)
  SELECT b.k AS item_id, l.lang, round(coalesce(near, 0) / (n * 300.0), 6) AS score FROM b CROSS JOIN l LEFT JOIN (SELECT g.k, p.k AS lang, sum(300 - abs(g.rank - p.rank)) AS near FROM g JOIN p USING (gram) GROUP BY ALL) q ON q.k = b.k AND q.lang = l.lang""")
def rank_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items by the distance of their trigrams' ranks from the documents' languages."""
    found = languages.rank_scores(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), "item_id")
    return found.withColumn("score", F.round("score", 6))


SQL_LETTERS = ", ".join(f"CAST(len(regexp_extract_all(text, '{p}')) AS BIGINT) AS c{i}" for i, p in enumerate(["[a-zA-Z]", r"[\x{00C0}-\x{024F}]", r"[\x{0370}-\x{03FF}]", r"[\x{0400}-\x{04FF}]"]))


@query(f"""WITH d AS (SELECT lang, {SQL_LETTERS}, CAST(len(regexp_extract_all(text, '\\p{{L}}')) AS BIGINT) AS every FROM documents), i AS (SELECT item_id, {SQL_LETTERS}, CAST(len(regexp_extract_all(text, '\\p{{L}}')) AS BIGINT) AS every FROM benchmark),
  s AS (SELECT lang, sum(c0) + 1 AS s0, sum(c1) + 1 AS s1, sum(c2) + 1 AS s2, sum(c3) + 1 AS s3, sum(every - c0 - c1 - c2 - c3) + 1 AS s4 FROM d GROUP BY lang), t AS (SELECT *, CAST(s0 + s1 + s2 + s3 + s4 AS DOUBLE) AS a FROM s)
  SELECT item_id, lang, round(CASE WHEN every = 0 THEN 1 ELSE exp((c0 * ln(s0 / a) + c1 * ln(s1 / a) + c2 * ln(s2 / a) + c3 * ln(s3 / a) + (every - c0 - c1 - c2 - c3) * ln(s4 / a)) / every) END, 6) AS score FROM i CROSS JOIN t""")
def script_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items by their letters' groups."""
    found = languages.script_scores(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), "item_id")
    return found.withColumn("score", F.round("score", 6))


@query()
def ensemble_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language with the greatest mean of the three detectors for each benchmark item."""
    found = languages.ensemble(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), "item_id")
    return aggregates.best_language(found.select("item_id", "lang", "score"), "item_id", detectors=1).withColumn("score", F.round("score", 6))
