"""A language detector of our own: character trigram profiles, learned from texts whose language is known."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstream.operators.alignment import BLOCK, blocks
from quillstream.sources import scratch

SIZE = 3


def trigrams(rows: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key, gram, n: strings of SIZE characters of the text in lower case, runs of anything but letters made one blank."""
    plain = F.regexp_replace(F.lower(F.concat(F.lit(" "), text, F.lit(" "))), r"\PL+", " ")
    # a substring far into a long text is slow, so it is cut into blocks that reach into the next one
    cut = rows.select(key, F.posexplode(blocks(plain, SIZE - 1)).alias("_i", "_b")).select(key, "_i", F.col("_b.body").alias("_p"))
    most = F.least(F.lit(BLOCK), F.length("_p") - SIZE + 1)
    places = F.when(most > 0, F.sequence(F.lit(1), F.greatest(most, F.lit(1)))).when(F.col("_i") == 0, F.array(F.lit(1)))
    return cut.select(key, "_p", F.explode(places).alias("_at")).select(key, F.substring("_p", F.col("_at"), F.lit(SIZE)).alias("gram")).groupBy(key, "gram").agg(F.count(F.lit(1)).alias("n"))


def profiles(rows: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """lang, gram, logp, and unseen (the language's value for a trigram that it hasn't): one more than each count, over all counts and different trigrams."""
    counted = scratch.kept(trigrams(rows.where(F.col(lang).isNotNull()), lang, text).withColumnRenamed(lang, "lang"), "profiles")
    sizes = counted.groupBy("lang").agg(F.sum("n").alias("_all"), F.count(F.lit(1)).alias("_kinds"))
    whole = F.col("_all") + F.col("_kinds")
    return counted.join(F.broadcast(sizes), "lang").select("lang", "gram", F.log((F.col("n") + 1) / whole).alias("logp"), F.log(1 / whole).alias("unseen"))  # a row for each language


def scores(rows: DataFrame, known: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key, lang, score: the mean log-probability of a text's trigrams in each language, as exp: between 0 and 1."""
    grams = trigrams(rows, key, text)
    sizes = grams.groupBy(key).agg(F.sum("n").alias("_all"))
    unseen = known.groupBy("lang").agg(F.first("unseen").alias("unseen"))
    told = F.array(*[F.struct(F.lit(r.lang).alias("lang"), F.lit(r.unseen).alias("unseen")) for r in unseen.orderBy("lang").collect()])  # an entry for each language
    base = sizes.withColumn("l", F.explode(told)).select(key, "_all", "l.lang", "l.unseen")
    gained = grams.join(known, "gram").groupBy(key, "lang").agg(F.sum(F.col("n") * (F.col("logp") - F.col("unseen"))).alias("gain"))
    return base.join(gained, [key, "lang"], "left").select(key, "lang", F.exp(F.coalesce("gain", F.lit(0.0)) / F.col("_all") + F.col("unseen")).alias("score"))


#: Trigrams in a profile by rank; groups of letters that a text's script is told by.
RANKS = 300
LETTERS = {"ascii": "[a-zA-Z]", "latin": r"[À-ɏ]", "greek": r"[Ͱ-Ͽ]", "cyrillic": r"[Ѐ-ӿ]", "other": r"[\p{L}&&[^a-zA-ZÀ-ɏͰ-ϿЀ-ӿ]]"}


def ranked(grams: DataFrame, key: str) -> DataFrame:
    """The RANKS most frequent trigrams of each key with their rank, from 1; ties by the trigram."""
    return grams.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "gram"))).where(F.col("rank") <= RANKS)


def rank_scores(rows: DataFrame, known: DataFrame, key: str, text: str = "text", lang: str = "lang") -> DataFrame:
    """key, lang, score: one less the mean distance of a text's trigram ranks from each language's, over the greatest distance.

    A trigram that the language's profile lacks is RANKS away. known: texts with their language.
    """
    own = ranked(trigrams(rows, key, text), key).select(key, "gram", F.col("rank").alias("at"))
    profile = scratch.kept(ranked(trigrams(known.where(F.col(lang).isNotNull()), lang, text).withColumnRenamed(lang, "lang"), "lang"), "ranks")
    names = [r.lang for r in profile.select("lang").distinct().orderBy("lang").collect()]  # an entry for each language
    base = own.groupBy(key).agg(F.count(F.lit(1)).alias("grams")).withColumn("lang", F.explode(F.lit(names).cast("array<string>")))
    near = own.join(profile.select("lang", "gram", "rank"), "gram").groupBy(key, "lang").agg(F.sum(RANKS - F.abs(F.col("at") - F.col("rank"))).alias("near"))
    return base.join(near, [key, "lang"], "left").select(key, "lang", (F.coalesce("near", F.lit(0)) / (F.col("grams") * RANKS)).alias("score"))


def letter_counts(rows: DataFrame, text: str = "text") -> list:
    return [F.regexp_count(text, F.lit(pattern)).cast("long").alias(name) for name, pattern in LETTERS.items()]


def script_scores(rows: DataFrame, known: DataFrame, key: str, text: str = "text", lang: str = "lang") -> DataFrame:
    """key, lang, score: the mean log-probability of a text's letters by groups of letters, as exp; one for a text without letters. Each group's count is one more than seen."""
    seen = known.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), *letter_counts(known, text)).groupBy("lang").agg(*[(F.sum(n) + 1).alias(n) for n in LETTERS])
    told = seen.orderBy("lang").collect()  # a row for each language
    each = rows.select(key, *letter_counts(rows, text))
    total = sum((F.col(n) for n in LETTERS), F.lit(0))
    scored = [F.struct(F.lit(r.lang).alias("lang"), sum((F.col(n) * F.log(F.lit(r[n] / sum(r[m] for m in LETTERS))) for n in LETTERS), F.lit(0.0)).alias("sum")) for r in told]
    if not told:
        return each.where("false").select(key, F.lit("").alias("lang"), F.lit(0.0).alias("score"))
    return each.select(key, total.alias("letters"), F.explode(F.array(*scored)).alias("s")).select(key, "s.lang", F.when(F.col("letters") > 0, F.exp(F.col("s.sum") / F.col("letters"))).otherwise(1.0).alias("score"))


def ensemble(rows: DataFrame, known: DataFrame, key: str, text: str = "text", lang: str = "lang") -> DataFrame:
    """key, lang, score, trigram, rank, script: three detectors' scores, each as its share over the languages, and their mean.

    A text is spread to every language, of which there are few. Null texts have no rows; a text without trigrams that any
    language has is told by its letters alone.
    """
    there = rows.where(F.col(text).isNotNull())
    three = {"trigram": scores(there, profiles(known, lang, text), key, text), "rank": rank_scores(there, known, key, text, lang), "script": script_scores(there, known, key, text, lang)}
    out = None
    for name, found in three.items():
        own = found.select(key, "lang", F.coalesce(F.try_divide("score", F.sum("score").over(Window.partitionBy(key))), F.lit(0.0)).alias(name))
        out = own if out is None else out.join(own, [key, "lang"], "full")
    return out.fillna(0.0, list(three)).select(key, "lang", (sum((F.col(n) for n in three), F.lit(0.0)) / len(three)).alias("score"), *three)
