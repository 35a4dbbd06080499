"""Readers for the raw document files and for curated Parquet tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.sources.schemas import RAW

# File name (or glob) of each raw document table.
RAW_FILES = {"users": "users.json", "products": "products.json",
             "categories": "categories.json", "transactions": "transactions.json",
             "sessions": "sessions_*.json"}


def read_raw(spark: SparkSession, data_dir: str, name: str, multi_line: bool = False) -> DataFrame:
    """One raw table: JSON lines (split between tasks), or files that hold one
    array on one line.  ``multi_line`` is for arrays printed over several
    lines only: Spark then reads one JSON value per file, in one task, so
    land such files as Parquet once (see sinks) and never use it for JSON
    lines, of which it would return the first row of each file."""
    return (spark.read.schema(RAW[name]).option("multiLine", multi_line)
            .json(os.path.join(data_dir, RAW_FILES[name])))


def read_raw_tables(spark: SparkSession, data_dir: str, multi_line: bool = False) -> dict[str, DataFrame]:
    return {name: read_raw(spark, data_dir, name, multi_line) for name in RAW_FILES}


def read_checked(spark: SparkSession, data_dir: str, name: str, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """One raw table and the records that are not in it.

    ``read_raw`` follows Spark's default: a broken record becomes a row of
    NULLs, or a row with one NULL more, without a trace.  Here every record is
    either a row of the first table or one of the second, ``rejected``
    (``file``, ``reason``, ``record``), with the reason

    * ``malformed``: the text is no JSON value;
    * ``type``: it is, but a value does not fit its column, or the record is
      no object;
    * ``empty``: an object without a value in any known column.

    A line that holds an array has as many records as the array, and is one
    record when it is broken; Spark's parser stops at the end of a line's first
    JSON value, so text behind it goes unnoticed.  Both tables
    read the files with the whole schema; keep the one used more than once
    (``sinks.land_raw_json``)."""
    schema = RAW[name]
    record = "_record"
    rows = (spark.read.schema(T.StructType([*schema.fields, T.StructField(record, T.StringType())]))
            .option("multiLine", multi_line).option("columnNameOfCorruptRecord", record)
            .json(os.path.join(data_dir, RAW_FILES[name])))
    columns = [f.name for f in schema.fields]
    empty = F.lit(True)
    for c in columns:
        empty = empty & F.col(c).isNull()
    broken = F.col(record).isNotNull()
    reason = (F.when(broken & F.try_parse_json(record).isNull(), "malformed").when(broken, "type").when(empty, "empty"))
    # the reason needs the columns, so that Spark reads (and checks) all of them
    checked = rows.withColumn("_reason", reason).withColumn("_file", F.col("_metadata.file_path"))
    good = checked.where(F.col("_reason").isNull()).select(*columns)
    rejected = checked.where(F.col("_reason").isNotNull()).select(
        F.col("_file").alias("file"), F.col("_reason").alias("reason"), F.col(record).alias("record"))
    return good, rejected


def read_curated(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(root, name))
