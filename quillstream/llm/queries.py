"""Thin contract queries of the operators, `opN_<name>(spark, sf_dir)`, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.llm import bpe, chat, decontamination, licenses, merkle, quality, ranking, sharding, simhash, suffix_dedup, token_counts, toxicity, warc
from quillstream.llm.common import table
from quillstream.llm.sql import ORACLE_SQL  # noqa: F401  offered beside the queries


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, _ = sharding.shard(table(spark, sf_dir, "documents"), shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "vslot", "version")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal().alias("fingerprint"), "component_id")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removals(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), token_counts.default_tokenizer(), limit=1024)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digests(decontamination.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), bpe.default_vocabulary())


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(quality.judge(table(spark, sf_dir, "documents")))


def op11_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranking.best_lines(spark.read.parquet(f"{sf_dir}/sale_lines.parquet"))
    return found.select(*(F.col(c).cast("long").alias(c) for c in ("vendor_id", "part", "month", "pos")), F.col("pos").cast("long").alias("place"),
                        *(F.col(c).cast("long").alias(c) for c in ("sale_id", "line_no", "quantity", "percent", "amount_cents", "tied", "rank", "dense")))


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = [F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role")]
    more = spark.range(2).select(*row, F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.round_trip(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def quality_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op10_quality SQL can express."""
    return op10_quality(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def shard_laws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op1_sharding promises: all rows and bytes, 40 shards, places without gaps, and loads that differ by the largest row and one slot's share at most."""
    placed, _ = sharding.shard(table(spark, sf_dir, "documents"), shards=40)
    each = placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("load"), F.max("size").alias("largest"), F.min("slot").alias("first"), F.max("slot").alias("last"), F.countDistinct("slot").alias("places"))
    gapless = (F.col("first") == 0) & (F.col("last") == F.col("n") - 1) & (F.col("places") == F.col("n"))
    told = each.agg(F.sum("n").alias("n_rows"), F.sum("load").alias("bytes"), F.count(F.lit(1)).alias("shards"), F.min(gapless).alias("gapless"), (F.max("load") - F.min("load")).alias("off"), F.max("largest").alias("largest"))
    return told.select("n_rows", "bytes", "shards", "gapless", (F.col("off") <= F.col("largest") + F.col("bytes") / sharding.SLOTS).alias("even"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_simhash": op2_simhash,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_decontamination": op5_decontamination,
    "op6_toxicity": op6_toxicity,
    "op7_warc": op7_warc,
    "op8_licenses": op8_licenses,
    "op9_bpe": op9_bpe,
    "op10_quality": op10_quality,
    "op11_ranking": op11_ranking,
    "op12_chat": op12_chat,
    "op13_merkle": op13_merkle,
    "quality_base_counts": quality_base_counts,
    "shard_laws": shard_laws,
}
