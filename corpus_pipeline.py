"""Cleaning pipeline: quality rules, near copies, repeated passages, benchmark passages, token ids.

Each stage is a function of (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next stage's docs. All but the last return the columns of documents; columns besides these, whatever their names,
are left out at the start. Rows are decided one by one: by their id (a missing one is like any other) and their text,
never by the id alone. Texts of any length are whole, and an empty table gives an empty table in every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstream.llm import bpe, decontamination, quality, simhash, suffix_dedup
from quillstream.llm.common import materialise, right_sized, table, text_key

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE_SQL = None


ROW = ["_id", "_no_id", "_text_key"]


def keyed(df: DataFrame, text_hash: Column) -> DataFrame:
    """With ROW, which names a row by its id, a missing one too, and its text."""
    return df.withColumns({"_id": F.coalesce("doc_id", F.lit(0)), "_no_id": F.col("doc_id").isNull(), "_text_key": text_hash})


def kept_rows(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of docs whose id and text are in `decided` (doc_id, text_key), with ROW."""
    return keyed(docs.select(COLUMNS), text_key()).join(keyed(decided, F.col("text_key")).select(ROW), ROW, "left_semi")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose perplexity is within their language's bands.

    Null and empty texts go, as they have no words; a null language is one of its own. Rows with one text and language
    stay or go together, repeated ones too; a loss on a band's border stays.
    """
    return quality.kept_documents(docs.select(COLUMNS))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the row with the smallest id (one without an id if no row has one).

    Null, empty and blank texts are one group. Ties: of rows with the smallest id, the one whose text has the least
    hash; of repeated rows, the first by language, source and length. Links join different texts of one id as well;
    texts that aren't linked both stay, whatever their ids.
    """
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("least")
    first = simhash.row_groups(docs).groupBy("group").agg(least).select("least.doc_id", "least.text_key")
    one = Window.partitionBy(ROW).orderBy("lang", "source", "n_chars")  # the join has dealt rows by these already
    kept = kept_rows(docs, first).withColumn("_row", F.row_number().over(one)).where("_row = 1").select(COLUMNS)
    return right_sized(kept, docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 50 bytes that an earlier document has; a text that loses all is gone.

    Null and empty texts stay as they are, and so do texts of blanks that lose nothing. A row without an id comes after
    all others; rows of one id, repeated ones too, are one document and don't cut each other. n_chars follows the text
    where it was cut.
    """
    left = suffix_dedup.deduplicate(docs.select(COLUMNS)).where((F.col("n_removed") == 0) | (F.length(F.trim("text")) > 0))
    return left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated: each row by its own text, with an id or without, repeated or not. Null and empty texts have no words and stay; an empty benchmark contaminates nothing."""
    scanned = decontamination.scan(docs, table(spark, sf_dir, "benchmark"))
    return right_sized(kept_rows(docs, scanned.where(~F.col("contaminated"))).select(COLUMNS), docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids, and of the text decoded from them: one row for each row. A null text is like an empty one."""
    return bpe.round_trip_digests(docs, bpe.default_vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_copies),
    ("suffix_array_dedup", repeated_passages),
    ("benchmark_decontamination", benchmark_passages),
    ("bpe_encoding", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, f"stage-{i}-{name}")
    return docs
