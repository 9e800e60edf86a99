"""Driver queries of the library's own operators: each takes (spark, sf_dir) and runs over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstream.functions import python as py
from quillstream.functions import scalars, text
from quillstream.operators import alignment, aggregates, geometry, joins, levels, search, tagging, topics
from quillstream.plans import media
from quillstream.plans.registry import ORACLE_SQL, QUERIES, SQL_LINES, SQL_SPANS, query, table
from quillstream.plans.sql import SQL_TERMS, SQL_TOKENS
from quillstream.streaming import events as event_windows

def tokens(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, pos, term of the tokens that aren't empty."""
    return docs.select(key, F.explode(text.postings(text.default_analyzer(F.col("text")))).alias("p")).select(key, "p.pos", "p.term")


@query(f"""SELECT doc_id, lang, CAST(len(list_filter(toks, lambda t: t <> '')) AS INT) AS n_terms,
  CAST(coalesce(list_max(list_transform(toks, lambda t, i: CASE WHEN t <> '' THEN i ELSE 0 END)), 0) AS INT) AS n_tokens
  FROM (SELECT doc_id, lang, {SQL_TOKENS} AS toks FROM documents)""")
def doc_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = text.default_analyzer(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", "lang", t.alias("t")).select("doc_id", "lang", text.n_terms(F.col("t")).alias("n_terms"), text.n_tokens(F.col("t")).alias("n_tokens"))


@query(f"SELECT doc_id, line_no, n_chars, start_offset, end_offset FROM {SQL_SPANS}")
def doc_lines_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return levels.line_spans(table(spark, sf_dir, "documents"))


@query(f"""SELECT lang, source, count(*) AS documents, CAST(sum(n_lines) AS BIGINT) AS lines, CAST(sum(n_blank) AS BIGINT) AS blank_lines, CAST(sum(n_chars) AS BIGINT) AS chars,
  CAST(max(n_lines) AS BIGINT) AS most_lines FROM (SELECT d.doc_id, any_value(lang) AS lang, any_value(source) AS source, count(*) AS n_lines, count(*) FILTER (line = '') AS n_blank, sum(length(line)) AS n_chars
  FROM documents d JOIN {SQL_LINES} l USING (doc_id) GROUP BY d.doc_id) GROUP BY lang, source""")
def level_rollup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.split("text", "\n")
    each = table(spark, sf_dir, "documents").select("lang", "source", F.size(lines).alias("n_lines"), F.size(F.filter(lines, lambda x: x == "")).alias("n_blank"), F.length(F.replace("text", F.lit("\n"), F.lit(""))).alias("n_chars"))
    return each.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("documents"), F.sum("n_lines").alias("lines"), F.sum("n_blank").alias("blank_lines"), F.sum("n_chars").alias("chars"), F.max("n_lines").cast("long").alias("most_lines"))


@query("""SELECT conv_id, count(*) AS turns, array_to_string(list_sort(list(DISTINCT role)), ',') AS roles, string_agg(text, chr(10) || chr(10) || '====' || chr(10) || chr(10) ORDER BY turn) AS text,
  CAST(count(*) FILTER (starter = 'T') AS BIGINT) AS starters FROM (SELECT *, CASE WHEN row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1 THEN 'T' ELSE 'F' END AS starter FROM conversations) GROUP BY conv_id""")
def conversation_thread_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    starter = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) == 1
    listed = F.array_sort(F.collect_list(F.struct("turn", "text")))
    return turns.withColumn("starter", F.when(starter, "T").otherwise("F")).groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("turns"), F.array_join(F.array_sort(F.collect_set("role")), ",").alias("roles"),
        F.array_join(F.transform(listed, lambda x: x["text"]), "\n\n====\n\n").alias("text"), F.sum((F.col("starter") == "T").cast("long")).alias("starters"),
    )


@query("""WITH w AS (SELECT conv_id, turn, t.i AS i, t.w AS word FROM (SELECT conv_id, turn, unnest(list_transform(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> ''), lambda x, i: {'i': i, 'w': x})) AS t FROM conversations)),
  g AS (SELECT *, row_number() OVER o AS n FROM w WINDOW o AS (PARTITION BY conv_id ORDER BY turn, i))
  SELECT conv_id, turn, word, CAST(n - 1 AS INT) AS position, CAST(e AS BIGINT) AS end_offset, CAST(e - length(word) AS BIGINT) AS start_offset FROM
  (SELECT *, sum(length(word) + CASE WHEN n = 1 THEN 1 WHEN i = 1 THEN 8 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn, i) - 1 AS e FROM g)""")
def conversation_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.filter(F.split("text", r"\s+"), lambda x: x != "")
    w = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(words).alias("i", "word"))
    first = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "i")) == 1
    gapped = w.withColumn("gap", F.when(first, 1).when(F.col("i") == 0, 8).otherwise(1))
    return levels.token_offsets(gapped, "conv_id", ["turn", "i"], "word", F.col("gap")).select("conv_id", "turn", "word", "position", "end_offset", "start_offset")


@query("""SELECT conv_id, CAST(run AS BIGINT) AS run, any_value(role) AS role, min(turn) AS first_turn, max(turn) AS last_turn, count(*) AS turns FROM (SELECT *, sum(c) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM
  (SELECT *, CASE WHEN role IS NOT DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn) THEN 0 ELSE 1 END AS c FROM conversations)) GROUP BY conv_id, run""")
def turn_run_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = levels.runs(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role")
    return runs.groupBy("conv_id", "run").agg(F.first("role").alias("role"), F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"), F.count(F.lit(1)).alias("turns"))


@query(f"""SELECT doc_id, CAST(s AS BIGINT) + 1 AS sentence, trim(string_agg(line, ' ' ORDER BY line_no)) AS text FROM (SELECT *, coalesce(sum(CASE WHEN suffix(line, '.') AND length(line) > 5 THEN 1 ELSE 0 END)
  OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM {SQL_LINES}) GROUP BY doc_id, s""")
def sentence_join_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return levels.joined_until(levels.lines(table(spark, sf_dir, "documents")), "doc_id", "line_no", "line")


@query(f"""SELECT doc_id, term, tf, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tf DESC, term) AS rank FROM (SELECT doc_id, term, count(*) AS tf FROM {SQL_TERMS} GROUP BY doc_id, term)) WHERE rank <= 5""")
def term_vectors_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), "text")
    return search.top_terms(docs, text.default_analyzer, 5).withColumnRenamed("doc", "doc_id")


@query(f"SELECT term, count(DISTINCT doc_id) AS documents, count(*) AS occurrences, min(doc_id) AS first_document, CAST(max(pos) AS INT) AS last_position FROM {SQL_TERMS} GROUP BY term")
def term_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = tokens(table(spark, sf_dir, "documents")).groupBy("term", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("pos").alias("pos"))
    return each.groupBy("term").agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("occurrences"), F.min("doc_id").alias("first_document"), F.max("pos").alias("last_position"))


@query(f"SELECT term, doc_id, count(*) AS tf, string_agg(CAST(CAST(pos AS BIGINT) AS VARCHAR), ',' ORDER BY pos) AS positions FROM {SQL_TERMS} GROUP BY term, doc_id")
def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), "text")
    found = search.document_postings(docs, text.default_analyzer, F.collect_list)
    return found.select("term", F.col("doc").alias("doc_id"), F.size("positions").cast("long").alias("tf"), F.array_join(F.col("positions").cast("array<string>"), ",").alias("positions"))


@query("SELECT DISTINCT unnest(list_filter(string_split_regex(lower(text), '[^\\p{L}]+'), lambda t: t <> '')) AS token FROM documents")
def distinct_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.explode(text.letter_tokens(F.col("text"))).alias("token")).distinct()


@query(f"""SELECT doc_id, line_no, CAST(count(DISTINCT w.t) AS INT) AS n_keywords, string_agg(w.t, ' ' ORDER BY w.i) AS keywords FROM (SELECT doc_id, line_no, unnest(list_transform(ks, lambda x, i: {{'i': i, 't': x}})) AS w FROM
  (SELECT doc_id, line_no, list_filter(all_, lambda x, i: x <> '' AND list_position(all_, x) = i) AS ks FROM (SELECT doc_id, line_no, list_transform(string_split(line, ' '), lambda t: replace(t, '#', '')) AS all_ FROM {SQL_LINES})))
  GROUP BY doc_id, line_no""")
def line_keyword_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = levels.lines(table(spark, sf_dir, "documents")).select("doc_id", "line_no", text.keyword_set(F.col("line")).alias("k")).where(F.size("k") > 0)
    return k.select("doc_id", "line_no", F.size("k").alias("n_keywords"), F.array_join("k", " ").alias("keywords"))


SQL_WORDS = "list_filter(list_transform(string_split(text, ' '), lambda t: regexp_replace(t, '[^a-zA-Z0-9_]', '', 'g')), lambda t: t <> '')"


SQL_SHARED = f"(SELECT DISTINCT doc_id, item_id FROM {SQL_LINES} l JOIN (SELECT item_id, unnest(string_split(text, chr(10))) AS line FROM benchmark) b USING (line) WHERE line <> '')"


@query(f"""WITH a AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest({SQL_WORDS}) AS word FROM documents) GROUP BY ALL), b AS (SELECT item_id, word, count(*) AS m FROM (SELECT item_id, unnest({SQL_WORDS}) AS word FROM benchmark) GROUP BY ALL)
  SELECT doc_id, item_id, CAST(sum(least(n, coalesce(m, 0))) AS BIGINT) AS matched, CAST(sum(n) AS BIGINT) AS total, CAST(100 * sum(least(n, coalesce(m, 0))) // sum(n) AS BIGINT) AS rate
  FROM {SQL_SHARED} p JOIN a USING (doc_id) LEFT JOIN b USING (item_id, word) GROUP BY doc_id, item_id""")
def overlap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and items that share a line, compared by their words."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    known = levels.lines(items, "item_id").where("line != ''").select("item_id", "line").distinct()
    pairs = levels.lines(docs).where("line != ''").join(known, "line").select("doc_id", "item_id").distinct()
    words = lambda d, k: d.select(k, F.explode(text.word_characters(F.col("text"))).alias("word"))
    return joins.bag_overlap(pairs, words(docs, "doc_id"), words(items, "item_id"), "doc_id", "item_id").withColumn("rate", F.expr("100 * matched div total"))


@query(f"""SELECT l.doc_id, l.line_no, count(*) AS items, min(b.item_id) AS first_item FROM {SQL_LINES} l JOIN (SELECT DISTINCT item_id, unnest(string_split(text, chr(10))) AS line FROM benchmark) b USING (line) WHERE l.line <> '' GROUP BY l.doc_id, l.line_no""")
def benchmark_passage_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = levels.lines(table(spark, sf_dir, "benchmark"), "item_id").select("item_id", "line").distinct()
    lines = levels.lines(table(spark, sf_dir, "documents")).where("line != ''")
    return lines.join(known, "line").groupBy("doc_id", "line_no").agg(F.count(F.lit(1)).alias("items"), F.min("item_id").alias("first_item"))


@query(r"""WITH f AS (SELECT doc_id, replace(text, chr(10), ' ') AS t FROM documents), s AS (SELECT doc_id, regexp_extract_all(t, '(?i)((?:\W|^)that(?:\W|$))', 1) AS hits, string_split_regex(t, '(?i)((?:\W|^)that(?:\W|$))') AS gaps FROM f),
  h AS (SELECT doc_id, hits, gaps, unnest(range(1, len(hits) + 1)) AS i FROM s)
  SELECT doc_id, CAST(i - 1 AS INT) AS hit, CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS INT) AS "offset", hits[i] AS word,
  CASE WHEN length(gaps[i]) > 120 THEN regexp_replace(right(gaps[i], 120), '^[^ ]* ', '') ELSE gaps[i] END AS before, CASE WHEN length(gaps[i + 1]) > 120 THEN regexp_replace(left(gaps[i + 1], 120), ' [^ ]*$', '') ELSE gaps[i + 1] END AS after FROM h""")
def kwic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(text.kwic(F.col("text"), "that")).alias("k")).select("doc_id", "k.*")


SQL_FRAGMENTS = f"(SELECT doc_id, 'f' || CAST(line_no AS VARCHAR) AS fragment, start_offset AS s, start_offset + 400 AS e FROM {SQL_SPANS})"


@query(f"""SELECT u.doc_id, u.line_no, count(f.fragment) AS reuses, coalesce(string_agg(f.fragment, ',' ORDER BY f.fragment), '') AS reuse_ids FROM {SQL_SPANS} u LEFT JOIN {SQL_FRAGMENTS} f ON u.doc_id = f.doc_id AND u.start_offset < f.e AND f.s < u.end_offset GROUP BY u.doc_id, u.line_no""")
def reuse_overlap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = levels.line_spans(table(spark, sf_dir, "documents")).select("doc_id", "line_no", F.col("start_offset").alias("start"), F.col("end_offset").alias("end"))
    fragments = units.select("doc_id", F.concat(F.lit("f"), F.col("line_no").cast("string")).alias("fragment"), "start", (F.col("start") + 400).alias("end"))
    found = joins.overlap_counts(units, fragments, ["doc_id"], ["line_no"], "fragment", bin_size=2000)
    return found.select("doc_id", "line_no", F.col("reuses").cast("long").alias("reuses"), F.array_join("reuse_ids", ",").alias("reuse_ids"))


@query("""WITH b AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INT) AS x1, CAST(l_quantity + 10 AS INT) AS x2, CAST(floor(l_extendedprice / 1000) AS INT) AS y1, CAST(floor(l_extendedprice / 1000) AS INT) + 15 AS y2 FROM lineitem)
  SELECT a.l_orderkey, a.l_linenumber, count(*) AS beside, min(b.x1) AS leftmost FROM b a JOIN b ON a.l_orderkey = b.l_orderkey AND a.y1 <= b.y2 AND b.y1 <= a.y2 GROUP BY a.l_orderkey, a.l_linenumber""")
def interval_selfjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = line_blocks(spark, sf_dir)
    return joins.interval_join(b, b, ["l_orderkey"], closed=True, names=("y1", "y2"), right_names=("y1", "y2")).groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("beside"), F.min("r_x1").alias("leftmost"))


def line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as blocks on their order's page."""
    y = F.floor(F.col("l_extendedprice") / 1000).cast("int")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("x1"), (F.col("l_quantity") + 10).cast("int").alias("x2"), y.alias("y1"), (y + 15).alias("y2"))


@query()
def block_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.block_columns(line_blocks(spark, sf_dir), ["l_orderkey"], "l_linenumber")


@query(f"""SELECT md5(line) AS cluster, count(*) AS n, CAST(sum(length(line)) // count(*) AS BIGINT) AS avg_length, min(doc_id) AS first_document, count(DISTINCT doc_id) AS documents FROM {SQL_LINES} GROUP BY line HAVING count(*) > 1""")
def fragment_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = levels.lines(table(spark, sf_dir, "documents")).groupBy(F.md5("line").alias("cluster"), "doc_id").agg(F.count(F.lit(1)).alias("k"), F.sum(F.length("line")).alias("length"))
    return each.groupBy("cluster").agg(F.sum("k").alias("n"), F.expr("sum(length) div sum(k)").alias("avg_length"), F.min("doc_id").alias("first_document"), F.count(F.lit(1)).alias("documents")).where("n > 1").select("cluster", "n", "avg_length", "first_document", "documents")


@query("""SELECT d.doc_id, d.lang, regexp_replace('D000' || CAST(d.doc_id AS VARCHAR), '^([A-Z])0*', '\\1') AS estc_id, coalesce(l.quality, 0) AS quality, coalesce(l.toxic, 0) AS toxic, l.doc_id IS NOT NULL AS labelled FROM documents d LEFT JOIN labels l USING (doc_id)""")
def metadata_enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", scalars.estc_id(F.concat(F.lit("D000"), F.col("doc_id").cast("string"))).alias("estc_id"))
    labels = table(spark, sf_dir, "labels").withColumn("labelled", F.lit(True))
    return joins.enrich(docs, labels, ["doc_id"], defaults={"quality": 0, "toxic": 0, "labelled": False})


@query("""SELECT r_name, n_name, o_orderstatus, count(*) AS lines, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS price, n_name || ', ' || r_name || ' (' || o_orderstatus || ')' AS label FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, n_name, o_orderstatus""")
def snowflake_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    places = t("nation").join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey"))  # 25 nations and 5 regions, whatever the scale
    customers = t("customer").join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name", "r_name")
    # lines are summed for each order before they meet the customers
    orders = t("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    lines = t("lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("k"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("p"))
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customers, F.col("o_custkey") == F.col("c_custkey"))
    out = joined.groupBy("r_name", "n_name", "o_orderstatus").agg(F.sum("k").alias("lines"), F.sum("p").cast("decimal(38,2)").alias("price"))
    return out.withColumn("label", scalars.function_label(F.col("n_name"), F.col("r_name"), F.col("o_orderstatus")))


@query("""SELECT o_orderkey, o_orderstatus, array_to_string(list_sort(list(DISTINCT p_type) FILTER (l_returnflag <> 'R')), ';') AS types, array_to_string(list_sort(list(DISTINCT p_type) FILTER (l_returnflag = 'R')), ';') AS weak_types
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey GROUP BY o_orderkey, o_orderstatus""")
def bridge_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    link = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"), (F.col("l_returnflag") == "R").alias("weak"))
    found = joins.bridge(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), link, table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("type")), "o_orderkey", "p_partkey", "type", "weak")
    joined = lambda c: F.nullif(F.array_join(c, ";"), F.lit(""))
    return found.where(F.col("types").isNotNull()).select("o_orderkey", "o_orderstatus", joined("types").alias("types"), joined("weak_types").alias("weak_types"))


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.matched_and_missing(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels").select("doc_id"), ["doc_id"])[1]


@query("SELECT doc_id, lang, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def semi_toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").join(table(spark, sf_dir, "labels").where("toxic = 1"), "doc_id", "left_semi")


SQL_TF = "SELECT word, count(*) AS n FROM (SELECT unnest(list_filter(string_split_regex(lower(text), '[^\\p{L}]+'), lambda t: t <> '')) AS word FROM %s) GROUP BY word"


@query(f"SELECT word, d.n AS n, coalesce(b.n, 0) AS benchmark, coalesce(c.n, 0) AS conversations FROM ({SQL_TF % 'documents'}) d LEFT JOIN ({SQL_TF % 'benchmark'}) b USING (word) LEFT JOIN ({SQL_TF % 'conversations'}) c USING (word)")
def lookup_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = lambda n: table(spark, sf_dir, n).select(F.explode(text.letter_tokens(F.col("text"))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return joins.lookups(counts("documents"), "word", {"benchmark": counts("benchmark"), "conversations": counts("conversations")}, "n")


@query("""WITH r AS (SELECT l_returnflag, l_quantity AS x, l_extendedprice AS y, avg(rx) OVER (PARTITION BY l_returnflag, l_quantity) AS rx, avg(ry) OVER (PARTITION BY l_returnflag, l_extendedprice) AS ry FROM
  (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) AS rx, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) AS ry FROM lineitem))
  SELECT l_returnflag, count(*) AS n, round(corr(x, y), 6) AS pearson, round(corr(rx, ry), 6) AS spearman FROM r GROUP BY l_returnflag""")
def corr_pearson_spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = aggregates.correlations(table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y")), ["l_returnflag"], "x", "y")
    return found.select("l_returnflag", "n", F.round("pearson", 6).alias("pearson"), F.round("spearman", 6).alias("spearman"))


@query("""WITH r AS (SELECT d.lang, l.quality AS x, CAST(d.n_chars // 100 AS BIGINT) AS y FROM labels l JOIN documents d USING (doc_id)),
  p AS (SELECT a.lang, a.x AS ax, b.x AS bx, a.y AS ay, b.y AS by_, a.n AS an, b.n AS bn FROM (SELECT lang, x, y, count(*) AS n FROM r GROUP BY ALL) a JOIN (SELECT lang, x, y, count(*) AS n FROM r GROUP BY ALL) b ON a.lang = b.lang),
  s AS (SELECT lang, sum(CASE WHEN ax > bx THEN sign(ay - by_) * an * bn ELSE 0 END) AS s, sum(CASE WHEN ax > bx THEN an * bn ELSE 0 END) AS px, sum(CASE WHEN ay > by_ THEN an * bn ELSE 0 END) AS py FROM p GROUP BY lang)
  SELECT lang, n, round(s / sqrt(CAST(px AS DOUBLE) * CAST(py AS DOUBLE)), 6) AS kendall FROM s JOIN (SELECT lang, count(*) AS n FROM r GROUP BY lang) USING (lang)""")
def corr_kendall(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang", F.expr("n_chars div 100").alias("y")), "doc_id").select("lang", F.col("quality").alias("x"), "y")
    return aggregates.kendall_binary(rows, ["lang"], "x", "y").withColumn("kendall", F.round("kendall", 6))


@query("""WITH v AS (SELECT l_returnflag, CAST(l_quantity AS INT) AS q, CAST(sum(CAST(l_extendedprice AS BIGINT)) AS BIGINT) AS w, count(*) AS k FROM lineitem GROUP BY l_returnflag, q), c AS (SELECT *, sum(w) OVER o AS cw, sum(k) OVER o AS ck, sum(w) OVER a AS tw, sum(k) OVER a AS tk FROM v
  WINDOW o AS (PARTITION BY l_returnflag ORDER BY q), a AS (PARTITION BY l_returnflag))
  SELECT l_returnflag, min(q) FILTER (cw >= tw // 2) AS weighted_median, min(q) FILTER (ck >= tk // 2 + 1) AS median, (SELECT q FROM v WHERE v.l_returnflag = c.l_returnflag ORDER BY w DESC, q LIMIT 1) AS weighted_mode,
  (SELECT q FROM v WHERE v.l_returnflag = c.l_returnflag ORDER BY k DESC, q LIMIT 1) AS mode FROM c GROUP BY l_returnflag""")
def weighted_mode_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, k = table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_quantity").cast("int").alias("q"), F.round("l_extendedprice", 0).cast("bigint").alias("w")), ["l_returnflag"]
    out = aggregates.weighted_median(rows, k, "q", F.col("w")).withColumnRenamed("median", "weighted_median").join(aggregates.upper_median(rows, k, "q"), k)
    return out.join(aggregates.weighted_mode(rows, k, "q", F.col("w")).withColumnRenamed("mode", "weighted_mode"), k).join(aggregates.weighted_mode(rows, k, "q", F.lit(1)), k)


@query("SELECT event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n, sum(CAST(value AS DECIMAL(18,4))) AS value FROM events GROUP BY GROUPING SETS ((event_type), (CAST(ts AS DATE)), ())")
def grouping_sets_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "events").select("event_type", F.to_date("ts").cast("string").alias("day"), F.col("value").cast("decimal(18,4)").alias("v")).createOrReplaceTempView("_event_days")
    return spark.sql("SELECT event_type, day, count(*) AS n, cast(sum(v) AS decimal(38,4)) AS value FROM _event_days GROUP BY GROUPING SETS ((event_type), (day), ())")


@query("""SELECT lower(w) AS orig, string_agg(DISTINCT w, ';' ORDER BY w) AS "values" FROM (SELECT unnest(regexp_extract_all(text, '[a-zA-Z]+')) AS w FROM documents) GROUP BY lower(w)""")
def multimap_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("[a-zA-Z]+"), F.lit(0))).alias("norm"))
    return aggregates.multimap(words.select(F.lower("norm").alias("orig"), "norm"), "orig", "norm")


@query("""SELECT doc_id, array_to_string(list_sort(list_filter([CASE WHEN quality = 1 THEN 'quality' END, CASE WHEN toxic = 1 THEN 'toxic' END, 'label'], lambda x: x IS NOT NULL)), ';') AS flags FROM labels""")
def boolean_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("quality"), F.col("toxic").cast("string").alias("toxic"), F.lit("1").alias("label"))
    tall = wide.unpivot("doc_id", ["quality", "toxic", "label"], "flag", "value").where("value = '1'")
    return aggregates.multimap(tall, "doc_id", "flag").withColumnRenamed("values", "flags")


@query("""SELECT p_brand, trim(w) AS word, count(*) AS n FROM (SELECT p_brand, unnest(string_split(p_name, ' ')) AS w FROM part) GROUP BY p_brand, trim(w)""")
def delimited_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_brand", F.explode(F.transform(F.split("p_name", " "), lambda x: F.trim(x))).alias("word")).groupBy("p_brand", "word").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, coalesce(json_extract_string(props, '$.sensitive'), 'unknown') AS sensitive FROM events""")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.from_json("props", "k int, sensitive string")
    return table(spark, sf_dir, "events").select("event_id", p.alias("p")).select("event_id", "p.k", scalars.yes_no_unknown(F.col("p.sensitive")).alias("sensitive"))


@query("""SELECT event_id, CASE WHEN event_type = 'error' THEN 'error' WHEN value > 50 THEN 'large' WHEN event_type = 'purchase' THEN 'purchase' ELSE 'other' END AS kind FROM events WHERE event_type NOT IN ('signup')""")
def classify_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", "error").when(F.col("value") > 50, "large").when(F.col("event_type") == "purchase", "purchase").otherwise("other")
    return table(spark, sf_dir, "events").where(~F.col("event_type").isin("signup")).select("event_id", kind.alias("kind"))


@query("""SELECT o_orderkey, CAST(y || '0000' AS INT) AS year_start, CAST(y || '9999' AS INT) AS year_end, CAST(y || m || '00' AS INT) AS month_start, CAST(y || m || '99' AS INT) AS month_end, CAST(y || m || d AS INT) AS day, y || '-' || m || '-01' AS month_date
  FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y') AS y, strftime(o_orderdate, '%m') AS m, strftime(o_orderdate, '%d') AS d FROM orders)""")
def date_ints_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = lambda p: F.date_format("o_orderdate", p)
    (a, b), (c, d) = scalars.date_bounds(f("yyyy")), scalars.date_bounds(f("yyyyMM"))
    return table(spark, sf_dir, "orders").select("o_orderkey", a.alias("year_start"), b.alias("year_end"), c.alias("month_start"), d.alias("month_end"), scalars.iso_date_number(f("yyyy-MM-dd")).alias("day"), scalars.date_by_length(f("yyyyMM")).alias("month_date"))


@query("""SELECT l_orderkey, l_linenumber, CAST(replace(CAST(CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR), '.', '') AS INT) AS confidence FROM lineitem""")
def confidence_to_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", scalars.confidence_number(F.col("l_discount").cast("decimal(4,2)").cast("string")).alias("confidence"))


@query("""SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, len(regexp_extract_all(html, '<p[ >]')) AS paragraphs, regexp_extract(url, '^https?://([^/]*)', 1) AS host FROM pages""")
def page_title_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.size(F.regexp_extract_all("html", F.lit("<p[ >]"), F.lit(0))).cast("long").alias("paragraphs"), F.regexp_extract("url", "^https?://([^/]*)", 1).alias("host"))


@query()
def html_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(py.html_paragraphs("html")).alias("paragraph", "text"))


@query()
def html_to_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", py.html_markdown("html").alias("text"))


@query("""SELECT conv_id, turn, CAST(i - 1 AS INT) AS at, word, first_value(word) OVER (PARTITION BY conv_id, turn ORDER BY i) = '-' AS in_quote FROM (SELECT conv_id, turn, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM
  (SELECT conv_id, turn, string_split(text, ' ') AS ws FROM conversations))""")
def quote_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", " ")).alias("at", "word"))
    return media.quoted_words(words, ["conv_id", "turn"])


SQL_RAW = r"'(?:[^ \t\n\x0B\f\r]*-[ \t\n\x0B\f\r]+)*[^ \t\n\x0B\f\r]+'"


@query(rf"""WITH s AS (SELECT doc_id, regexp_extract_all(text, {SQL_RAW}) AS hits, string_split_regex(text, {SQL_RAW}) AS gaps FROM documents), h AS (SELECT doc_id, hits, gaps, unnest(range(1, len(hits) + 1)) AS i FROM s),
  p AS (SELECT doc_id, CAST(i - 1 AS INT) AS pos, lower(regexp_replace(regexp_replace(hits[i], '-[ \t\n\x0B\f\r]+', '', 'g'), '^[[:punct:]]+|[[:punct:]]+$', '', 'g')) AS term, length(hits[i]) AS n,
    CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS INT) AS start FROM h)
  SELECT doc_id, pos, term, start, CAST(start + n AS INT) AS "end" FROM p WHERE term <> ''""")
def offset_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(text.offset_postings(F.col("text"))).alias("p")).select("doc_id", "p.*")


@query(f"""SELECT doc_id, page, coalesce(lag(last_line) OVER (PARTITION BY doc_id ORDER BY page), '') || chr(10) || body AS haystack FROM (SELECT doc_id, CAST(line_no // 5 AS BIGINT) AS page, string_agg(line, chr(10) ORDER BY line_no) AS body, arg_max(line, line_no) AS last_line FROM {SQL_LINES} GROUP BY ALL)""")
def carry_last_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    paged = levels.lines(table(spark, sf_dir, "documents")).withColumn("page", F.expr("line_no div 5"))
    return joins.haystacks(paged, "doc_id", "page", "line_no", "line")


@query()
def argmin_edit_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = levels.lines(table(spark, sf_dir, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("key"), "text"), "key")
    page = lines.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("page"))
    noisy = lines.where(F.length("line") > 0).withColumn("noisy", F.translate("line", "eai", "c0l"))
    found = alignment.align_rows(noisy, page, ["key"], "noisy", "page")
    return found.select("key", "line_no", "cost", "start", "length", "aligned", "cut_start", "cut_end")


@query("""WITH m(lang, word) AS (VALUES ('en','the'),('en','and'),('en','of'),('fr','le'),('fr','de'),('fr','et'),('de','der'),('de','die'),('de','und'),('es','la'),('es','el'),('es','que')),
  w AS (SELECT doc_id, unnest(list_filter(string_split_regex(lower(text), '[^\\p{L}]+'), lambda t: t <> '')) AS word FROM documents), s AS (SELECT doc_id, lang, count(*) AS hits FROM w JOIN m USING (word) GROUP BY doc_id, lang)
  SELECT doc_id, lang, round(hits / 3.0, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY hits DESC, lang) AS r FROM s) WHERE r = 1""")
def lang_score_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = {"en": ["the", "and", "of"], "fr": ["le", "de", "et"], "de": ["der", "die", "und"], "es": ["la", "el", "que"]}
    rows = spark.createDataFrame([(k, w) for k, ws in marks.items() for w in ws], "lang string, word string")
    words = table(spark, sf_dir, "documents").select("doc_id", F.explode(text.letter_tokens(F.col("text"))).alias("word"))
    scores = words.join(F.broadcast(rows), "word").groupBy("doc_id", "lang").agg(F.count(F.lit(1)).cast("double").alias("score"))  # twelve words
    return aggregates.best_language(scores, "doc_id").withColumn("score", F.round("score", 6))


def turn_topics(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return topics.topic_model(table(spark, sf_dir, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("key"), "text"), "key", "text", topics=8)


@query()
def lda_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_topics(spark, sf_dir)[0]


@query()
def lda_document_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_topics(spark, sf_dir)[1]


@query()
def sentence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.size(F.sentences("text")).alias("n_sentences"), F.size(py.sentence_spans("text")).alias("n_spans"))


@query()
def sentence_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return levels.sentences(table(spark, sf_dir, "documents"), ["doc_id"]).withColumn("content_tokens", text.n_tokens(text.default_analyzer(F.col("sentence_text")))).drop("sentence_text")


@query("""SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, count(*) AS n, sum(CAST(value AS DECIMAL(18,4))) AS value FROM events GROUP BY ALL""")
def events_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_windows.tumbling(table(spark, sf_dir, "events")).withColumn("value", F.col("value").cast("decimal(38,4)"))


@query("""SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n FROM (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS b FROM events)) GROUP BY user_id, s""")
def events_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_windows.sessions(table(spark, sf_dir, "events"))


SQL_HEADED = f"(SELECT doc_id, line_no, CASE WHEN line_no % 7 = 0 THEN '# ' || line WHEN line_no % 7 = 3 THEN '## ' || line WHEN line_no % 7 = 5 THEN '### ' || line ELSE line END AS line FROM {SQL_LINES})"


def headed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' lines, some of them made headings."""
    n = F.col("line_no") % 7
    return levels.lines(table(spark, sf_dir, "documents")).withColumn("line", F.when(n == 0, F.concat(F.lit("# "), "line")).when(n == 3, F.concat(F.lit("## "), "line")).when(n == 5, F.concat(F.lit("### "), "line")).otherwise(F.col("line")))


@query(f"""WITH l AS (SELECT *, CASE WHEN regexp_matches(line, '^#{{1,3}} ') THEN length(regexp_extract(line, '^(#{{1,3}}) ', 1)) END AS level FROM {SQL_HEADED}),
  h AS (SELECT *, coalesce(min(nx) OVER (PARTITION BY doc_id, line_no), 2147483647) AS stop FROM (SELECT a.doc_id, a.line_no, a.level, a.line, (SELECT min(b.line_no) FROM l b WHERE b.doc_id = a.doc_id AND b.line_no > a.line_no AND b.level <= a.level) AS nx FROM l a WHERE a.level IS NOT NULL))
  SELECT h.doc_id, h.line_no AS section, CAST(any_value(h.level) AS INT) AS heading_level, any_value(regexp_replace(h.line, '^#{{1,3}} ', '')) AS heading, coalesce(string_agg(l.line, chr(10) ORDER BY l.line_no), '') AS text
  FROM h LEFT JOIN l ON l.doc_id = h.doc_id AND l.line_no > h.line_no AND l.line_no < h.stop GROUP BY h.doc_id, h.line_no""")
def heading_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return levels.sections(headed(spark, sf_dir), "doc_id")


@query("""SELECT user_id, event_id, event_type, CAST(row_number() OVER (PARTITION BY user_id, run ORDER BY ts, event_id) AS INT) AS sub_page FROM (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM
  (SELECT *, CASE WHEN event_type IS NOT DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) THEN 0 ELSE 1 END AS c FROM events))""")
def page_sub_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn("at", F.struct("ts", "event_id"))
    return geometry.page_runs(rows, "user_id", "at", "event_type").select("user_id", "event_id", "event_type", "sub_page")


@query("SELECT conv_id, string_agg(text, '/' ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def roll_up_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return levels.roll_up(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", "text", "/")


@query("""SELECT DISTINCT doc_id, regexp_extract(text, '(?i)([a-z]*able)', 1) AS hit FROM documents WHERE regexp_matches(text, '(?i)[a-z]*able') AND n_chars >= 500""")
def regex_numeric_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where(F.col("text").rlike("(?i)[a-z]*able") & (F.col("n_chars") >= 500))
    return docs.select("doc_id", F.regexp_extract("text", "(?i)([a-z]*able)", 1).alias("hit")).distinct()


@query("""SELECT doc_id, coalesce(TRY_CAST(regexp_extract(text, '([0-9]+)', 1) AS BIGINT), -1) AS number FROM documents""")
def cast_with_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", scalars.long_or(F.regexp_extract("text", "([0-9]+)", 1)).alias("number"))


@query("""(SELECT s_nationkey AS nationkey, 'supplier' AS kind, count(*) AS n FROM supplier GROUP BY ALL) UNION ALL (SELECT c_nationkey, 'customer', count(*) FROM customer GROUP BY ALL)
  UNION ALL (SELECT nationkey, 'both', 0 FROM (SELECT s_nationkey AS nationkey FROM supplier INTERSECT SELECT c_nationkey FROM customer)) UNION ALL (SELECT nationkey, 'customer only', 0 FROM (SELECT c_nationkey AS nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier))""")
def set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, c = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nationkey")), table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nationkey"))
    counted = lambda d, k: d.groupBy("nationkey").agg(F.count(F.lit(1)).alias("n")).select("nationkey", F.lit(k).alias("kind"), "n")
    plain = lambda d, k: d.select("nationkey", F.lit(k).alias("kind"), F.lit(0).cast("long").alias("n"))
    return counted(s, "supplier").unionByName(counted(c, "customer")).unionByName(plain(s.intersect(c), "both")).unionByName(plain(c.subtract(s), "customer only"))


@query()
def tagged_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents tagged with the benchmark's first words and first long words."""
    first = lambda pattern, kind: table(spark, sf_dir, "benchmark").select(F.regexp_extract("text", pattern, 1).alias("name"), F.lit(kind).alias("kind"))
    names = first(r"^(\S+ \S+)", "ORG").unionByName(first(r"(\w{6,})", "LOC")).where("name != ''").groupBy("name").agg(F.min("kind").alias("kind"))
    return tagging.tag_names(table(spark, sf_dir, "documents"), names, "doc_id", "text")


@query("""SELECT doc_id, '<doc/' || CAST(doc_id AS VARCHAR) || '> <lang> "' || lang || '" .' AS value FROM documents UNION ALL SELECT doc_id, '<doc/' || CAST(doc_id AS VARCHAR) || '> <chars> "' || CAST(n_chars AS VARCHAR) || '" .' FROM documents""")
def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillstream.sources import sinks

    docs = table(spark, sf_dir, "documents")
    lines = sinks.triples(docs, F.concat(F.lit("doc/"), F.col("doc_id").cast("string")), [("lang", F.col("lang")), ("chars", F.col("n_chars"))])
    return lines.select(F.regexp_extract("value", r"^<doc/(\d+)>", 1).cast("long").alias("doc_id"), "value")


@query("SELECT doc_id, source, lang, CAST(row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS INT) AS ordinal FROM documents")
def typed_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return levels.ordinals(table(spark, sf_dir, "documents").select("doc_id", "source", "lang"), ["source", "lang"], "doc_id", "ordinal")


@query("SELECT l_returnflag, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate, CAST(sum(CAST(round(l_discount * 100) AS INT)) // count(*) AS BIGINT) AS confidence FROM lineitem GROUP BY ALL")
def integer_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", F.to_date("l_shipdate").cast("string").alias("l_shipdate"), F.round(F.col("l_discount") * 100).cast("int").alias("c"))
    return rows.groupBy("l_returnflag", "l_shipdate").agg(F.expr("coalesce(sum(c), 0) div count(1)").alias("confidence"))


@query(f"SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS documents FROM {SQL_TERMS} WHERE term LIKE 'l%' GROUP BY term")
def term_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = tokens(table(spark, sf_dir, "documents")).where(F.startswith("term", F.lit("l"))).groupBy("term", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy("term").agg(F.sum("n").alias("tf"), F.count(F.lit(1)).alias("documents"))


@query("""SELECT s_suppkey, list_aggregate(list_sort(list(DISTINCT CAST(p_size AS VARCHAR))), 'string_agg', ',') AS sizes, count(*) AS lines FROM supplier LEFT JOIN lineitem ON s_suppkey = l_suppkey LEFT JOIN part ON l_partkey = p_partkey GROUP BY s_suppkey""")
def distinct_union_of_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey").join(table(spark, sf_dir, "part").select("p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey"), "left")
    joined = table(spark, sf_dir, "supplier").select("s_suppkey").join(lines, F.col("s_suppkey") == F.col("l_suppkey"), "left")
    return joined.groupBy("s_suppkey").agg(F.array_join(F.array_sort(F.collect_set(F.col("p_size").cast("string"))), ",").alias("sizes"), F.count(F.lit(1)).alias("lines"))


@query("""SELECT o_orderkey, coalesce(max(CASE WHEN l_linenumber = 1 THEN l_returnflag END), max(CASE WHEN l_linenumber = 2 THEN l_returnflag END), o_orderstatus) AS style FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderstatus""")
def nearest_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    own = lambda n: lines.where(F.col("l_linenumber") == n).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_returnflag").alias(f"style_{n}"))
    found = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").join(own(1), "o_orderkey", "left").join(own(2), "o_orderkey", "left")
    return found.select("o_orderkey", joins.first_resolved(F.array("style_1"), F.array("style_2"), F.array("o_orderstatus")).alias("style"))


@query()
def poem_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens are made once, for both counts."""
    rows = table(spark, sf_dir, "documents").select("doc_id", text.poem_tokens(F.col("text")).alias("tokens"))
    return rows.select("doc_id", F.size(text.token_terms(F.col("tokens"))).alias("n_terms"), F.size("tokens").alias("n_tokens"))


@query("SELECT event_type, CAST(strftime(ts, '%Y%m%d') AS INT) AS day, count(*) AS n FROM events WHERE CAST(strftime(ts, '%Y%m%d') AS INT) BETWEEN 20240105 AND 20240120 GROUP BY ALL")
def date_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the range is on the column itself, so that it reaches the scan
    rows = table(spark, sf_dir, "events").where((F.col("ts") >= "2024-01-05") & (F.col("ts") < "2024-01-21"))
    return rows.groupBy("event_type", scalars.iso_date_number(F.date_format("ts", "yyyy-MM-dd")).alias("day")).agg(F.count(F.lit(1)).alias("n"))


from quillstream.plans import article_queries, format_queries, search_queries  # noqa: E402, F401  register their own
