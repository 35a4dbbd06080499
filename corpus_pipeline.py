"""From raw documents to a mixed training corpus.

Stages, each one of the operators of ``mercato.llm``: drop what the quality
classifier rejects, keep one of each group of near copies, drop documents
contaminated by the benchmark, redact secrets, and mix sources to target
weights.  Every stage works on all rows that its predecessor kept; all but
the last return the columns of ``documents``, the last adds ``taken``.

Results on odd input, for every stage: an empty table gives an empty one; null
and empty texts are texts without words; long texts are read whole; null and
repeated ids are rows like any other; further columns stay, whatever their
names, but for ``taken``, which the last stage replaces (so its output can be
fed in again).  The stages say the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm import decontaminate, mil_quality, mixing, secrets_cnn, simhash
from mercato.llm.store import keep, ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least the classifier's threshold.
    Each row is judged by its own text, repeated rows alike; without labels of
    both classes the score is the share of good labels (all stay if there are
    none)."""
    return mil_quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (3-word shingles, 3 bits): the
    smallest doc_id, null last; of rows that share it the smallest text hash;
    of rows that share both the smallest columns in order.  All texts without
    words are one component."""
    ship(spark)
    return simhash.keep_first(docs, shingle=3, max_bits=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without contamination by the benchmark, each judged by its own
    text; a document without words, or an empty benchmark, is clean."""
    return decontaminate.keep_clean(docs, _table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets redacted; n_chars follows the text.  A null text
    stays null; findings that overlap become one mark."""
    ship(spark)
    clean = secrets_cnn.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes words of, with ``taken``; documents
    without words are never taken, and rows that repeat share their words
    evenly.  A null source is a source of its own."""
    ship(spark)
    return mixing.mixed_documents(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("secrets", secrets), ("mix", mix)]

#: Neither the classifiers nor XXH64 fingerprints can be told in SQL; tests
#: compare each stage with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
