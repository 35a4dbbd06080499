"""The registered query of each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm import (
    bpe, chat_tools, decontaminate, hard_negatives, mil_quality, mixing, quality_rules, secrets_cnn, simhash, substring_dedup,
    url_filter, vector_codes, warc,
)
from mercato.llm.store import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.substring_dedup(table(spark, sf_dir, "documents")))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(mixing.mix(table(spark, sf_dir, "documents")))


def op3_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = chat_tools.turns_as_calls(table(spark, sf_dir, "conversations"))
    return chat_tools.link_calls(calls, results, chat_tools.REPLY)


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.simhash_groups(table(spark, sf_dir, "documents")))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.digest(url_filter.url_verdicts(table(spark, sf_dir, "pages"), out_of_fold=True))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_cnn.digest(secrets_cnn.secret_spans(table(spark, sf_dir, "documents")))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mil_quality.quality_scores(docs, mil_quality.train(docs, table(spark, sf_dir, "labels")))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(quality_rules.quality_rules(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(warc.round_trip(table(spark, sf_dir, "pages")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", label), F.col("id") % 100 == 0)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.digest(*vector_codes.vector_codes(table(spark, sf_dir, "embeddings")))


def op13_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    if vocabulary is None:
        import public_tokenizers  # installed beside the vocabulary files

        vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    tables = bpe.load(vocabulary)
    coded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), tables)
    return bpe.digest(bpe.decode(coded.drop("text"), tables))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_substring_dedup, op2_mixing, op3_tool_calls, op4_simhash_dedup, op5_url_filter, op6_secrets, op7_quality,
        op8_decontaminate, op9_quality_rules, op10_warc, op11_hard_negatives, op12_vector_codes, op13_bpe)}
