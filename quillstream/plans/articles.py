"""News articles with an analysis of their words: article, paragraph and sentence tables of three kinds of feed.

An analysis is an array of words; each word has readings, whose first one's tags tell where sentences begin and which
words are blank. All levels are made within an article's own row by array functions and one explode, so a feed of any
size is read, split and written without a shuffle; an article's words bound what a task holds.

A null or missing analysis has no words: such an article has no paragraph or sentence, its text is empty and its counts
are 0. Words that are null are empty. Words before the first sentence's mark are a sentence too; sentences of blanks
only are left out, and so are empty paragraphs in the article's text, though they count. content_tokens are words of the
analysis, blanks included. Repeated articles stay repeated. Columns other than the named ones aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARAGRAPH_MARK = "\n\n"
WORD = "struct<word:string,analysis:array<struct<weight:float,wordParts:array<struct<lemma:string,tags:map<string,array<string>>>>,globalTags:array<map<string,array<string>>>>>>"
WORDS = f"array<{WORD}>"

#: Objects of the three feeds.
APP = f"article_id string, category string, published_at string, news_value int, authors string, analyzedTitle {WORDS}, analyzedLead {WORDS}, analyzedBody {WORDS}"
BROADCAST = "id string, url struct<full:string>, publisher struct<name:string>, datePublished string, coverage string, headline struct<full:string>, lead string, subjects array<struct<title:struct<fi:string>>>, analyzedText string"
LISTED = "article_id string, node_id string, node_title string, start_date string, modified_date string, title string, byline string, ingress string, body string"


def tagged(word: Column, tag: str) -> Column:
    """Whether the first reading of a word has a tag."""
    readings = F.coalesce(F.get(word["analysis"], F.lit(0))["globalTags"], F.array().cast("array<map<string,array<string>>>"))
    return F.exists(readings, lambda m: F.coalesce(F.map_contains_key(m, tag), F.lit(False)))


def text_of(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda w: F.coalesce(w["word"], F.lit(""))), "")


def trimmed(text: Column) -> Column:
    """Each run of blanks is tried once, at its begin."""
    return F.regexp_replace(text, r"^[\x00-\x20]++|(?<![\x00-\x20])[\x00-\x20]++\z", "")


#: Sentences in a string of kinds, and those that aren't blank: words before the first sentence's mark are one too.
SENTENCE, SPOKEN = "^.[wb]*+|[Ff][wb]*+", "F[wb]*+|(?:^|f)b*+w[wb]*+"
#: What stands before a sentence in a paragraph's marked text; its first character is followed by a full stop where it is the text's own.
MARK = "\x01"


def kinds_of(words: Column) -> Column:
    """A letter for each word: F begins a sentence, w doesn't, f and b likewise but blank."""
    def kind(w: Column) -> Column:
        first = tagged(w, "FIRST_IN_SENTENCE")
        return F.when(tagged(w, "WHITESPACE"), F.when(first, "f").otherwise("b")).otherwise(F.when(first, "F").otherwise("w"))

    return F.array_join(F.transform(words, kind), "")


def sentence_texts(words: Column) -> Column:
    """The text of each sentence, blank ones included, with MARK followed by a full stop; in one pass, however many there are."""
    said = lambda w: F.replace(F.coalesce(w["word"], F.lit("")), F.lit(MARK), F.lit(f"{MARK}."))
    marked = F.transform(words, lambda w, i: F.when((i > 0) & tagged(w, "FIRST_IN_SENTENCE"), F.concat(F.lit(f"{MARK}|"), said(w))).otherwise(said(w)))
    return F.split(F.array_join(marked, ""), f"{MARK}[|]")


def sentence_words(words: Column, kinds: Column) -> Column:
    """Arrays of the words of each sentence, blank ones included."""
    begins = F.array_compact(F.transform(F.split(kinds, ""), lambda k, i: F.when((i == 0) | k.isin("F", "f"), i)))
    spans = F.zip_with(begins, F.slice(F.concat(begins, F.array(F.size(words))), F.lit(2), F.size(begins)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.transform(spans, lambda s: F.slice(words, s["a"] + 1, s["b"] - s["a"]))


def analysed_field(words: Column, name: str) -> list[Column]:
    """name, name_tokens, name_analysis of a field that has an analysis of its own; null without one."""
    return [text_of(words).alias(name), F.when(words.isNotNull(), F.size(words)).alias(f"{name}_tokens"), words.alias(f"{name}_analysis")]


def article_tables(articles: DataFrame, facts: list[str], with_words: bool = True) -> dict[str, DataFrame]:
    """article, paragraph and sentence tables of rows with `paragraphs` (arrays of words); each level inherits the facts.

    paragraph and sentence are numbers from 0, of an article's paragraphs and of a paragraph's sentences that are kept.
    Without with_words sentences have no analysis of their own. Each word's tags are looked up once for a level: a
    paragraph's sentences are found in its kinds, a letter for each word, and their texts are cut at marks.
    """
    empty = F.array().cast(f"array<{WORDS}>")
    rows = articles.select(*facts, F.transform(F.coalesce("paragraphs", empty), lambda p: F.coalesce(p, F.array().cast(WORDS))).alias("_ps"))
    parts = F.transform("_ps", lambda p: F.struct(text_of(p).alias("text"), kinds_of(p).alias("kinds")))
    total = lambda f: F.aggregate("_parts", F.lit(0), lambda n, p: n + f(p))
    article = rows.select(*facts, parts.alias("_parts")).select(
        *facts, F.array_join(F.transform(F.filter("_parts", lambda p: p["kinds"] != ""), lambda p: p["text"]), PARAGRAPH_MARK).alias("text"), F.size("_parts").alias("paragraphs"),
        total(lambda p: F.regexp_count(p["kinds"], F.lit(SPOKEN))).alias("sentences"), total(lambda p: F.length(p["kinds"])).alias("content_tokens"),
    )
    each = rows.select(*facts, F.posexplode("_ps").alias("paragraph", "analysis")).withColumn("_kinds", kinds_of(F.col("analysis")))
    paragraph = each.select(*facts, "paragraph", text_of(F.col("analysis")).alias("text"), F.regexp_count("_kinds", F.lit(SPOKEN)).alias("sentences"), F.length("_kinds").alias("content_tokens"), "analysis")
    fields = [sentence_texts(F.col("analysis")).alias("text"), F.regexp_extract_all("_kinds", F.lit(SENTENCE), F.lit(0)).alias("kinds")]
    fields += [sentence_words(F.col("analysis"), F.col("_kinds")).alias("analysis")] if with_words else []
    spoken = F.filter(F.arrays_zip(*fields), lambda s: F.coalesce(s["kinds"].rlike("[Fw]"), F.lit(False)))
    told = [trimmed(F.replace("_s.text", F.lit(f"{MARK}."), F.lit(MARK))).alias("text"), F.length("_s.kinds").alias("content_tokens"), *(["_s.analysis"] if with_words else [])]
    sentence = each.select(*facts, "paragraph", F.posexplode(spoken).alias("sentence", "_s")).select(*facts, "paragraph", "sentence", *told)
    return {k: v.withColumn("content_length", F.length("text")) for k, v in {"article": article, "paragraph": paragraph, "sentence": sentence}.items()}


def app_articles(objects: DataFrame, site: str = "", with_words: bool = True) -> dict[str, DataFrame]:
    """Levels of APP objects: one paragraph; headline and lead have analyses of their own. The url is the site and the id."""
    names = F.split(F.regexp_replace("authors", ",+$", ""), ",")
    rows = objects.select(
        "article_id", F.concat(F.lit(site), "article_id").alias("url"), F.col("category").alias("publisher"), F.col("published_at").alias("time_published"), "news_value",
        F.when(F.col("authors") != "", F.filter(names, lambda a: a != "")).alias("authors"), *analysed_field(F.col("analyzedTitle"), "headline"), *analysed_field(F.col("analyzedLead"), "lead"),
        F.when(F.col("analyzedBody").isNotNull(), F.array("analyzedBody")).alias("paragraphs"),
    )
    return article_tables(rows, [c for c in rows.columns if c != "paragraphs"], with_words)


def paragraphs_of(analysis: Column) -> Column:
    """Paragraphs of an analysis as JSON: an object's values in their order, or an array as the only one; null for anything else."""
    kind = F.regexp_extract(analysis, r"^\s*(.)", 1)
    return F.when(kind == "{", F.map_values(F.from_json(analysis, f"map<string,{WORDS}>"))).when(kind == "[", F.array(F.from_json(analysis, WORDS)))


def broadcast_articles(objects: DataFrame) -> dict[str, DataFrame]:
    """Levels of BROADCAST objects; published_ms is null where the time isn't one."""
    rows = objects.select(
        F.col("id").alias("article_id"), F.col("url.full").alias("url"), F.col("publisher.name").alias("publisher"), F.col("datePublished").alias("time_published"), F.unix_millis(F.try_to_timestamp("datePublished")).alias("published_ms"), "coverage",
        F.col("headline.full").alias("headline"), "lead", F.get("subjects", F.lit(0))["title"]["fi"].alias("first_keyword"), paragraphs_of(F.col("analyzedText")).alias("paragraphs"),
    )
    return article_tables(rows, [c for c in rows.columns if c != "paragraphs"])


def string_hash(text: Column) -> Column:
    """The 32-bit polynomial hash, of base 31, that names a text's folder; texts of the basic plane."""
    codes = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c).cast("long"))
    h = F.aggregate(codes, F.lit(0).cast("long"), lambda a, c: (a * 31 + c) % (1 << 32))
    return F.when(h >= 1 << 31, h - (1 << 32)).otherwise(h)


def analysis_paths(name: Column) -> tuple[Column, Column]:
    """Where an article's analysis may be, best first: in a folder of two digits of its hash, or at the top."""
    h, file = F.abs(string_hash(name)), F.concat(name, F.lit(".analysis.json"))
    return F.concat_ws("/", (h % 10).cast("string"), F.floor(h % 100 / 10).cast("string"), file), file


def listed_articles(rows: DataFrame, files: DataFrame, site: str = "") -> tuple[dict[str, DataFrame], DataFrame]:
    """(levels of LISTED rows, article_id of those without an analysis). files: path below the analyses' folder, content (JSON).

    Rows whose id isn't a whole number, or is -1, aren't articles. Of two analyses the one in the hash's folder counts;
    files in other places don't. Files are matched by the name in their path, so each text is shuffled once.
    """
    known = rows.where(F.col("article_id").rlike(r"^[+-]?\d+$") & (F.col("article_id").try_cast("long") != -1))
    named = files.select(F.regexp_extract("path", r"([^/]*)\.analysis\.json$", 1).alias("_name"), "path", "content")
    hashed, flat = analysis_paths(F.col("_name"))
    placed = named.withColumn("_rank", F.when(F.col("path") == hashed, 0).when(F.col("path") == flat, 1)).where("_rank is not null")
    best = placed.groupBy("_name").agg(F.min("_rank").alias("_rank"))
    analyses = placed.select("_name", "_rank", "path", "content").join(best, ["_name", "_rank"], "left_semi")
    number = F.col("article_id").try_cast("long")
    facts = known.select(
        F.col("article_id").alias("_name"), number.alias("article_id"), F.concat(F.lit(site), F.lower("node_title"), F.lit("/art-"), number.cast("string"), F.lit(".html")).alias("url"), F.col("node_title").alias("publisher"),
        F.replace("start_date", F.lit(" "), F.lit("T")).alias("time_published"), F.col("title").alias("headline"), F.col("byline").alias("writer"), F.col("ingress").alias("lead"),
    )
    both = facts.join(analyses, "_name").withColumn("paragraphs", F.from_json("content", f"array<{WORDS}>")).withColumnRenamed("path", "analysis_path")
    kept = [c for c in facts.columns if c != "_name"]
    return article_tables(both, [*kept, "analysis_path"]), facts.join(analyses, "_name", "left_anti").select("article_id")
