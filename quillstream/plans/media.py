"""Forum threads, tweets, speeches, poems, news articles and authority records as level tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.functions import scalars
from quillstream.functions.text import base_form, poem_terms, poem_tokens, vrt_terms
from quillstream.operators import joins, levels

TWEET = (
    "id_str string, created_at string, text string, full_text string, truncated boolean, lang string, source string, in_reply_to_user_id_str string, in_reply_to_screen_name string, retweet_count int, favorite_count int, "
    "possibly_sensitive boolean, user struct<id_str:string,screen_name:string,name:string,location:string,description:string,followers_count:int,friends_count:int,listed_count:int,favourites_count:int,verified:boolean,lang:string>, "
    "entities struct<hashtags:array<struct<text:string>>,user_mentions:array<struct<id_str:string,screen_name:string>>,urls:array<struct<expanded_url:string>>>, "
    "extended_entities struct<media:array<struct<media_url:string,type:string>>>, "
    "place struct<id:string,full_name:string,country:string,place_type:string,bounding_box:struct<coordinates:array<array<array<double>>>>>, "
    "retweeted_status struct<id_str:string,text:string,full_text:string,user:struct<id_str:string,screen_name:string>,entities:struct<hashtags:array<struct<text:string>>,user_mentions:array<struct<id_str:string,screen_name:string>>,urls:array<struct<expanded_url:string>>>>, "
    "quoted_status struct<id_str:string,user:struct<id_str:string,screen_name:string>>"
)


def tweets(rows: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
    """One row for each tweet, of the kinds that aren't skipped (retweet before quoted before reply before tweet)."""
    kind = F.when(F.col("retweeted_status").isNotNull(), "retweet").when(F.col("quoted_status").isNotNull(), "quoted").when(F.col("in_reply_to_user_id_str").isNotNull(), "reply").otherwise("tweet")
    own = F.coalesce("text", "full_text")
    rt = F.col("retweeted_status")
    content = F.when(kind == "retweet", F.concat(F.lit("RT @"), rt["user"]["screen_name"], F.lit(": "), F.coalesce(rt["text"], rt["full_text"]))).otherwise(own)
    entities = F.when(rt["entities"].isNotNull(), rt["entities"]).otherwise(F.col("entities"))
    names = lambda field, of: F.coalesce(F.array_sort(F.array_distinct(F.transform(entities[field], lambda e: e[of]))), F.array().cast("array<string>"))
    media = lambda of: F.coalesce(F.array_sort(F.array_distinct(F.transform(F.col("extended_entities.media"), lambda e: e[of]))), F.array().cast("array<string>"))
    out = rows.select(
        F.col("id_str").alias("id"), scalars.tweet_time(F.col("created_at")).alias("created_at"), content.alias("text"), F.coalesce("truncated", F.lit(False)).alias("truncated"), F.col("lang").alias("language"), "source", kind.alias("type"),
        F.col("user.id_str").alias("user_id"), F.col("user.screen_name").alias("user_screen_name"), F.col("user.name").alias("user_name"), F.col("user.followers_count").alias("user_followers_count"), F.col("user.verified").alias("user_verified"),
        *[F.col(f"user.{c}").alias(f"user_{c}") for c in ("location", "description", "friends_count", "listed_count", "favourites_count")], F.col("user.lang").alias("user_language"), rt["user"]["id_str"].alias("retweet_user_id"),
        F.col("quoted_status.user.id_str").alias("quoted_user_id"), F.col("quoted_status.user.screen_name").alias("quoted_screen_name"), F.col("place.id").alias("place_id"), F.col("place.place_type").alias("place_type"), media("media_url").alias("media_urls"), media("type").alias("media_types"),
        F.col("in_reply_to_user_id_str").alias("in_reply_to_user_id"), F.col("in_reply_to_screen_name"), rt["id_str"].alias("retweet_id"), rt["user"]["screen_name"].alias("retweet_screen_name"), F.col("quoted_status.id_str").alias("quoted_id"),
        F.coalesce("retweet_count", F.lit(0)).alias("retweet_count"), F.coalesce("favorite_count", F.lit(0)).alias("favorite_count"), scalars.yes_no_unknown(F.col("possibly_sensitive")).alias("possibly_sensitive"),
        F.col("place.full_name").alias("place_full_name"), F.col("place.country").alias("country"), F.when(F.col("place.bounding_box.coordinates").isNotNull(), scalars.centroid(F.col("place.bounding_box.coordinates")[0])).alias("coordinates"),
        F.transform(names("hashtags", "text"), F.lower).alias("hashtags"), names("hashtags", "text").alias("hashtags_as_written"), names("user_mentions", "id_str").alias("user_mentions_user_id"), names("user_mentions", "screen_name").alias("user_mentions_screen_name"), names("urls", "expanded_url").alias("urls"),
    )
    return levels.measured(out.where(~F.col("type").isin(*skip)) if skip else out)


def forum_levels(token_lines: DataFrame) -> dict[str, DataFrame]:
    """thread, post, paragraph and sentence tables of verticalised posts (the rows of vrt_rows)."""
    rows = token_lines.withColumn("word", F.get(F.split("line", "\t"), F.lit(0))).withColumn("terms", vrt_terms(F.col("line")))
    tag = lambda n: scalars.attribute(F.col("post_tag"), n)
    posts = rows.select("path", "thread", "post", "post_tag").distinct().select(
        "path", "thread", "post", tag("nick").alias("nick"), tag("title").alias("heading"), tag("urlmsg").alias("url"), scalars.forum_time(tag("datefrom"), tag("time")).alias("datetime"), scalars.forum_time(tag("dateto"), tag("time")).alias("end_datetime"), tag("views").try_cast("int").alias("views"),
    )
    first = F.row_number().over(Window.partitionBy("path", "thread").orderBy("post")) == 1
    posts = posts.withColumn("is_thread_starter", F.when(first, "T").otherwise("F"))
    listed = F.array_sort(F.collect_list(F.struct("line_no", "word", "terms")))
    unit = ["path", "thread", "post", "paragraph", "sentence"]
    sentences = rows.groupBy(*unit).agg(F.array_join(F.transform(listed, lambda x: x["word"]), " ").alias("text"), F.transform(listed, lambda x: x["terms"]).alias("terms"))
    paragraphs = levels.roll_up(sentences, unit[:4], "sentence", "text", " ").join(sentences.groupBy(*unit[:4]).agg(F.count(F.lit(1)).alias("sentences")), unit[:4])
    post_text = levels.roll_up(paragraphs, unit[:3], "paragraph", "text", "\n\n").join(paragraphs.groupBy(*unit[:3]).agg(F.count(F.lit(1)).alias("paragraphs"), F.sum("sentences").alias("sentences")), unit[:3])
    post_rows = post_text.join(posts, unit[:3])
    thread = levels.roll_up(post_rows, unit[:2], "post", "text", "\n\n====\n\n").join(
        post_rows.groupBy(*unit[:2]).agg(
            F.count(F.lit(1)).alias("posts"), F.sum("paragraphs").alias("paragraphs"), F.sum("sentences").alias("sentences"), F.array_sort(F.collect_set("nick")).alias("nicks"), F.array_sort(F.collect_set("datetime")).alias("datetimes"),
            F.min_by("heading", "post").alias("heading"), F.min("datetime").alias("start_datetime"), F.max("end_datetime").alias("end_datetime"),
        ), unit[:2])
    inherit = lambda d: d.join(posts, unit[:3])
    return {"thread": levels.measured(thread), "post": levels.measured(post_rows), "paragraph": levels.measured(inherit(paragraphs)), "sentence": levels.measured(inherit(sentences))}


def speech_levels(speeches: DataFrame, metadata: DataFrame, speakers: DataFrame, agenda: DataFrame, spoken_as: DataFrame, functions: DataFrame, institutions: DataFrame) -> dict[str, DataFrame]:
    """speech and sentence tables: four joins from a speech to the institutions of its speaker's functions."""
    label = scalars.function_label(scalars.role_label(F.col("role")), F.col("institution_name"), F.col("institution_type"))
    roles = spoken_as.join(functions, F.col("function") == functions["id"]).join(institutions.select(F.col("id").alias("institution_id"), F.col("name").alias("institution_name"), F.col("type").alias("institution_type")), "institution_id", "left")
    said = roles.groupBy(F.col("speech").alias("id")).agg(F.array_sort(F.collect_set(label)).alias("speaker_functions"))
    dims = metadata.join(speakers.select(F.col("id").alias("speaker"), F.col("name").alias("speaker_name"), F.col("country").alias("speaker_country"), F.col("sex").alias("speaker_sex"), scalars.iso_date_number(F.col("birthdate")).alias("speaker_date_of_birth"), scalars.none_if_blank(F.col("birthplace")).alias("speaker_place_of_birth")), "speaker", "left")
    dims = dims.join(agenda.select(F.col("id").alias("agenda"), F.col("text").alias("agenda_item")), "agenda", "left").withColumn("date", scalars.iso_date_number(F.col("date")))
    rows = levels.measured(speeches.join(dims, "id").join(said, "id", "left"))
    sentences = levels.sentences(rows.select("id", "text"), ["id"]).withColumnRenamed("sentence_text", "text")
    counted = rows.join(sentences.groupBy("id").agg(F.count(F.lit(1)).alias("sentences")), "id", "left")
    return {"speech": counted, "sentence": levels.measured(sentences.join(rows.drop("text", "content_length", "content_tokens"), "id"))}


def poem_levels(lines: DataFrame, metadata: DataFrame, places: DataFrame, collectors: DataFrame, themes: DataFrame, theme_poems: DataFrame) -> dict[str, DataFrame]:
    """poem and line tables. lines: poem_id, line_no, kind (verse, comment, caption, other), text. Places and collectors have to be known; themes needn't be."""
    poems = joins.enrich(joins.enrich(metadata, places, ["place_id"], required=True), collectors, ["collector_id"], required=True)
    poems = joins.bridge(poems, theme_poems, themes, "poem_id", "theme_id", "theme", "weak")
    marked = lines.withColumn("text", scalars.line_wrap(F.col("kind"), F.col("text")))
    rows = marked.withColumn("terms", poem_terms(F.col("text"))).withColumn("normalized", F.array_join(F.transform(poem_tokens(F.col("text")), base_form), " "))
    whole = levels.roll_up(marked, ["poem_id"], "line_no", "text", "\n")
    count = lambda k: F.sum((F.col("kind") == k).cast("int"))
    counts = marked.groupBy("poem_id").agg(count("verse").alias("verses"), count("caption").alias("captions"), count("comment").alias("comments"), count("other").alias("non_verses"))
    return {"poem": levels.measured(whole.join(counts, "poem_id")).join(poems, "poem_id"), "line": levels.measured(rows).join(poems, "poem_id")}


ANALYSIS = "array<array<struct<word:string,analysis:array<struct<weight:float,globalTags:array<map<string,array<string>>>>>>>>"


def article_levels(articles: DataFrame, analyses: DataFrame, key: str = "article_id", subjects: DataFrame | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """(article, paragraph and sentence tables, ids without an analysis). analyses: key, analyzed (ANALYSIS as JSON)."""
    found, missing = joins.matched_and_missing(articles, analyses, [key])
    words = found.select(key, F.posexplode(F.from_json("analyzed", ANALYSIS)).alias("paragraph", "ws")).select(key, "paragraph", F.posexplode("ws").alias("at", "w"))
    tags = F.map_keys(F.coalesce(F.get(F.col("w.analysis"), F.lit(0))["globalTags"][0], F.create_map().cast("map<string,array<string>>")))
    words = words.withColumn("word", F.col("w.word")).withColumn("begins", F.array_contains(tags, "FIRST_IN_SENTENCE")).withColumn("blank", F.array_contains(tags, "WHITESPACE"))
    order = Window.partitionBy(key, "paragraph").orderBy("at")
    numbered = words.withColumn("sentence", F.sum(F.col("begins").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    sentences = numbered.groupBy(key, "paragraph", "sentence").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), "").alias("text"), F.min("blank").alias("blank")).where(~F.col("blank")).drop("blank")
    paragraphs = levels.roll_up(words, [key, "paragraph"], "at", "word", "").withColumnRenamed("word", "text")
    article = levels.roll_up(paragraphs, [key], "paragraph", "text", "\n\n")
    facts = articles
    if subjects is not None:
        facts = facts.join(subjects.groupBy(key).agg(F.array_sort(F.collect_set("subject")).alias("subjects")), key, "left").withColumn("subjects", F.coalesce("subjects", F.array().cast("array<string>")))
    counts = paragraphs.groupBy(key).agg(F.count(F.lit(1)).alias("paragraphs")).join(sentences.groupBy(key).agg(F.count(F.lit(1)).alias("sentences")), key, "left")
    inherit = lambda d: levels.measured(d).join(facts, key)
    return {"article": inherit(article.join(counts, key)), "paragraph": inherit(paragraphs), "sentence": inherit(sentences)}, missing.select(key)


def foreign_articles(rows: DataFrame, scores: DataFrame, key: str = "article_id", dropped: tuple[str, ...] = ("sv", "en")) -> DataFrame:
    """Articles whose best language isn't one of `dropped`; those without any score stay."""
    from quillstream.operators.aggregates import best_language

    best = best_language(scores, key).select(key, F.col("lang").alias("best_language"))
    return rows.join(best, key, "left").where(~F.coalesce(F.col("best_language").isin(*dropped), F.lit(False)))


def quoted_words(words: DataFrame, keys: list[str]) -> DataFrame:
    """Words of sentences (keys, at, word) with in_quote: whether their sentence begins with a dash."""
    return words.withColumn("in_quote", F.first("word").over(Window.partitionBy(*keys).orderBy("at")) == "-")


def authority_rows(records: DataFrame) -> DataFrame:
    """XML records -> id, name_type, dates, gender, value:count columns, and labels joined by semicolons."""
    one = lambda p: F.nullif(F.xpath_string("record", F.lit(p)), F.lit(""))
    many = lambda p: F.xpath("record", F.lit(p))
    labels = lambda c: F.array_join(F.transform(F.array_distinct(c), scalars.escape_label), ";")
    counted = lambda path: F.array_join(F.zip_with(many(f"{path}/data/text/text()"), many(f"{path}/data/count/text()"), lambda a, b: F.concat_ws(":", a, F.coalesce(b, F.lit("1")))), ";")
    alternate = many("//x400s/x400/datafield/subfield[@code!='e' and @code!='9']/text()")
    return records.select(
        one("//viafID").alias("id"), one("//nameType").alias("name_type"), one("//birthDate").alias("birth_date"), one("//deathDate").alias("death_date"), one("//dateType").alias("date_type"), one("//fixed/gender").alias("gender"),
        counted("//countries").alias("countries"), counted("//nationalityOfEntity").alias("nationalities"), counted("//RelatorCodes").alias("relator_codes"), labels(many("//mainHeadings/data/text/text()")).alias("pref_labels"), labels(alternate).alias("alt_labels"),
        labels(many("//x500s/x500/datafield/subfield[@code='a']/text()")).alias("rel_labels"),
    )


def kwic_rows(docs: DataFrame, words: DataFrame, key: str, text: str, pattern: str, width: int = 120) -> DataFrame:
    """Concordance of words (key, word): hits come from a join of distinct tokens, contexts from the text around them.

    Only ids and words are joined; each text meets the list of its words once, and a hit's place follows from the
    lengths before it within the row, so texts are neither copied for each word nor shuffled for each hit.
    """
    from quillstream.functions.text import letter_tokens, piece_begins

    known = words.select("word").distinct()
    found = docs.where(F.col(text).rlike(pattern))
    hits = found.select(key, F.explode(F.array_distinct(letter_tokens(F.col(text)))).alias("word")).join(known, "word").groupBy(key).agg(F.array_sort(F.collect_set("word")).alias("_words"))
    each = found.select(key, F.regexp_replace(text, "\n", " ").alias("_t")).join(hits, key)
    at = lambda word: F.concat(F.lit(r"(?i)(?<!\w)"), word, F.lit(r"(?!\w)"))
    places = F.transform("_words", lambda w: F.struct(w.alias("word"), F.slice(piece_begins(F.split("_t", at(w)), F.regexp_extract_all("_t", at(w), F.lit(0))), F.lit(1), F.size(F.regexp_extract_all("_t", at(w), F.lit(0)))).alias("begins")))
    context = lambda word, begin: F.struct(
        word.alias("word"), begin.alias("offset"), F.substring("_t", F.greatest(begin - width, F.lit(0)) + 1, F.least(begin, F.lit(width))).alias("before"), F.substring("_t", begin + F.length(word) + 1, F.lit(width)).alias("after")
    )
    listed = F.flatten(F.transform(places, lambda p: F.transform(p["begins"], lambda b: context(p["word"], b))))
    rows = each.select(key, F.explode(listed).alias("k")).select(key, "k.*")
    before, after = F.col("before"), F.col("after")
    return rows.select(key, "word", "offset", F.when(F.col("offset") > width, F.regexp_replace(before, "^[^ ]* ", "")).otherwise(before).alias("before"), F.when(F.length(after) == width, F.regexp_replace(after, " [^ ]*$", "")).otherwise(after).alias("after"))


def ocr_correlations(pages: DataFrame) -> DataFrame:
    """Word correctness against confidence, by ISSN, by year and overall: pages (page, clean, noisy, confidence)."""
    from quillstream.operators.aggregates import correlations, kendall_binary

    issn, year = scalars.issn_and_year(F.col("page"))
    rows = pages.where(F.coalesce("confidence", F.lit("")) != "").select(issn.alias("issn"), year.alias("year"), (F.col("clean") == F.col("noisy")).cast("int").alias("correct"), F.col("confidence").cast("double").alias("confidence"))
    sets = rows.select(F.explode(F.array(F.concat(F.lit("issn:"), "issn"), F.concat(F.lit("year:"), F.col("year").cast("string")), F.lit("all"))).alias("group"), "correct", "confidence")
    return correlations(sets, ["group"], "correct", "confidence").join(kendall_binary(sets, ["group"], "correct", "confidence").drop("n"), "group", "left")


def character_pairs(pages: DataFrame) -> DataFrame:
    """Character correctness against confidence, of rows whose three strings are equally long."""
    same = (F.length("clean") == F.length("noisy")) & (F.length("noisy") == F.length("character_confidence"))
    letters = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    each = F.arrays_zip(letters("clean").alias("a"), letters("noisy").alias("b"), scalars.character_confidences(F.col("character_confidence")).alias("c"))
    return pages.where(same).select("page", F.explode(each).alias("p")).select("page", (F.col("p.a") == F.col("p.b")).cast("int").alias("correct"), F.col("p.c").alias("confidence"))


def xml_words(events: DataFrame, ignored: str = "foreign") -> DataFrame:
    """path, text of the text events outside elements of a name; events in order."""
    order = Window.partitionBy("path").orderBy("event_no").rowsBetween(Window.unboundedPreceding, 0)
    step = F.when((F.col("name") == ignored) & (F.col("kind") == "start"), 1).when((F.col("name") == ignored) & (F.col("kind") == "end"), -1).otherwise(0)
    return events.withColumn("_depth", F.sum(step).over(order)).where((F.col("kind") == "text") & (F.col("_depth") == 0)).select("path", "event_no", "text")
