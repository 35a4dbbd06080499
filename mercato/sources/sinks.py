"""Sinks: curated Parquet tables and CSV reports (A12, A13).

Curated tables replace the document store: written once per batch
(overwrite), clustered the way they are read.  Reports are CSV folders with
a header in every file, written by as many tasks as the result has.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions.exprs import epoch_micros, month_key


def write_curated(df: DataFrame, path: str, cluster_by: Sequence[str] = (),
                  partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Write a curated table as Parquet.

    ``cluster_by`` range-partitions the rows on those keys and sorts each
    file by them, so readers filtering on the keys skip files and row groups
    by their min/max statistics (what secondary indexes did in the document
    store).  Ranges run over all keys together, so a hot first key is cut at
    values of the next one.  ``partition_by`` adds directory partitions and
    leads the range, so a task writes into few of them.
    """
    out = df
    if cluster_by:
        out = out.repartitionByRange(*partition_by, *cluster_by)
        out = out.sortWithinPartitions(*partition_by, *cluster_by)
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    with _int64_timestamps(df.sparkSession):
        w.parquet(path)


def interleaved_key(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """Clustering key over several columns: the bits of each column's bucket,
    in turn, so that rows near each other in every column get near keys.

    A number or time has ``2**bits`` buckets of about equal row counts, whose
    bounds come from one pass (``2**bits - 1`` values a column); another type
    has buckets by hash, which serve equality filters.  NULL is bucket 0."""
    ordered = [c for c in columns if isinstance(df.schema[c].dataType, (T.NumericType, T.TimestampType, T.TimestampNTZType, T.DateType))]
    shares = [i / 2 ** bits for i in range(1, 2 ** bits)]
    as_number = {c: F.col(c).cast("double") if isinstance(df.schema[c].dataType, T.NumericType) else epoch_micros(df, c)
                 for c in ordered}
    bounds = df.agg(*[F.percentile_approx(as_number[c], shares, 100_000).alias(c) for c in ordered]).first() if ordered else None
    key = F.lit(0).cast("long")
    for j, c in enumerate(columns):
        if c in ordered:
            cuts = sorted(set(bounds[c] or []))
            bucket = _bucket(as_number[c], cuts)
        else:
            bucket = F.coalesce(F.pmod(F.xxhash64(c), F.lit(2 ** bits)).cast("int"), F.lit(0))
        for i in range(bits):
            key = key + F.shiftleft(F.shiftright(bucket, i).bitwiseAND(F.lit(1)).cast("long"), i * len(columns) + j)
    return key


def _bucket(value: Column, cuts: list[float]) -> Column:
    """How many of the cuts lie below the value; 0 for NULL."""
    if not cuts:
        return F.lit(0)
    below = F.size(F.filter(F.array(*[F.lit(x) for x in cuts]), lambda cut: cut < value))
    return F.when(value.isNotNull(), below).otherwise(0)


@contextmanager
def _int64_timestamps(spark: SparkSession) -> Iterator[None]:
    """Spark's default for timestamps in Parquet, INT96, has no min/max
    statistics, so no filter on time could skip anything."""
    name = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(name)
    spark.conf.set(name, "TIMESTAMP_MICROS")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_interleaved(df: DataFrame, path: str, columns: Sequence[str], bloom: Mapping[str, int] | None = None, bits: int = 6,
                      files: int | None = None, mode: str = "overwrite") -> None:
    """Write a curated table clustered for filters on any of ``columns``
    (``write_curated`` serves its first key only): range-partitioned and
    sorted by their interleaved key, so each file covers a small box of all of
    them and readers skip the others by min/max statistics.  ``bloom`` maps
    columns that are looked up by equality outside the clustering, such as an
    id, to about how many values a file holds; those columns get Parquet bloom
    filters.  ``files`` is the number of files (Spark's choice if not given)."""
    keyed = df.withColumn("_z", interleaved_key(df, columns, bits))
    parts = [files] if files else []
    w = keyed.repartitionByRange(*parts, "_z", *columns).sortWithinPartitions("_z", *columns).drop("_z").write.mode(mode)
    for c, values in (bloom or {}).items():
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.expected.ndv#{c}", values)
    with _int64_timestamps(df.sparkSession):
        w.parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int,
                   mode: str = "overwrite") -> None:
    """Write a curated table bucketed (and sorted) by ``key`` into ``buckets``
    files per bucket id, registered as ``table`` at ``path``.  Two tables
    bucketed on the same key with the same count join without a shuffle
    (e.g. transactions and line items on transaction_id, users and their
    profiles on user_id)."""
    (df.write.mode(mode).bucketBy(buckets, key).sortBy(key)
       .option("path", path).saveAsTable(table))


def with_month(df: DataFrame, ts: str = "timestamp", name: str = "month") -> DataFrame:
    """Add a 'yyyy-MM' partition column."""
    return df.withColumn(name, month_key(F.col(ts)))


def write_report_csv(df: DataFrame, path: str) -> None:
    """A report of any size as a CSV folder (overwrite), a header in every
    file; read the folder, in which an ordered report keeps its order."""
    df.write.mode("overwrite").option("header", True).csv(path)


def land_raw_json(df: DataFrame, path: str, max_records_per_file: int = 5_000_000) -> None:
    """Land a raw JSON table as Parquet (a one-array JSON file cannot be split
    between tasks; Parquet can), in files of at most ``max_records_per_file``."""
    df.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file).parquet(path)


def export_json(df: DataFrame, path: str, max_records_per_file: int = 5_000_000) -> None:
    """JSON-lines export in chunks of at most ``max_records_per_file`` rows."""
    df.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file).json(path)
