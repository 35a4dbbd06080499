"""A curated table that batches are merged into, range by range.

Rows are dealt to ``ranges`` by a hash of the key.  Merging a batch reads and
rewrites only the ranges that its keys fall into, into a folder of its own;
then a new manifest names, for each range, the folder that holds it, and the
batches merged so far.  The manifest is the commit: until it is complete,
readers see the table as before, so a merge that fails or loses its driver
leaves nothing behind that counts, and is simply run again.  A batch that the
manifest knows is not merged twice.

One merge runs at a time.  What passes through the driver is the list of
ranges, which is bounded by ``ranges``; rows and batch names do not.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RANGES = 256


@dataclass
class Merged:
    """What a merge did; ``applied`` is False for a batch that was known."""

    version: int
    applied: bool
    ranges: list[int]


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _manifest(root: str, version: int) -> str:
    return f"{root}/manifests/{version:010d}"


def versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions, ascending.  A manifest's ranges are written last."""
    out = []
    for name in _children(spark, f"{root}/manifests"):
        fs, done = _fs(spark, f"{root}/manifests/{name}/ranges/_SUCCESS")
        if name.isdigit() and fs.exists(done):
            out.append(int(name))
    return out


def _ranges(spark: SparkSession, root: str, version: int) -> dict[int, str]:
    rows = spark.read.schema("range int, folder string").json(f"{_manifest(root, version)}/ranges").collect()
    return {r["range"]: r["folder"] for r in rows}


def _range(key: str, ranges: int):
    return F.pmod(F.xxhash64(key), F.lit(ranges)).cast("int")


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table as of a version (the latest one by default)."""
    known = versions(spark, root)
    if not known:
        raise ValueError(f"no table at {root}")
    version = known[-1] if version is None else version
    held = _ranges(spark, root, version)
    schema = spark.read.parquet(f"{_manifest(root, version)}/schema").schema
    paths = [f"{root}/data/{folder}/range_no={r}" for r, folder in sorted(held.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def merge_batch(batch: DataFrame, root: str, batch_id: str, key: str, merge: Callable[[DataFrame, DataFrame], DataFrame],
                ranges: int = RANGES) -> Merged:
    """Merge ``batch`` into the table at ``root``; ``merge(held, batch)`` gives
    the rows that take the place of the held ones, and must work within each
    value of ``key``.  The number of ranges is fixed by the first batch."""
    spark = batch.sparkSession
    known = versions(spark, root)
    version, held = (known[-1] + 1, _ranges(spark, root, known[-1])) if known else (0, {})
    names = spark.createDataFrame([(batch_id,)], "batch_id string")
    if known:
        old = _manifest(root, known[-1])
        before = spark.read.schema("batch_id string").parquet(f"{old}/batches")
        if before.where(F.col("batch_id") == batch_id).limit(1).count():
            return Merged(known[-1], False, [])
        ranges = spark.read.parquet(f"{old}/schema").schema.fields[0].metadata["ranges"]
        names = before.unionByName(names)
    new = f"{version:010d}-{uuid.uuid4().hex}"
    # written once: the batch is read twice, for its ranges and for the merge
    incoming = f"{root}/data/{new}/batch"
    dealt = batch.withColumn("range_no", _range(key, ranges))
    dealt.write.parquet(incoming)
    dealt = spark.read.schema(dealt.schema).parquet(incoming)
    touched = sorted(r["range_no"] for r in dealt.select("range_no").distinct().collect())
    rows = dealt.drop("range_no")
    old_paths = [f"{root}/data/{held[r]}/range_no={r}" for r in touched if r in held]
    empty = spark.createDataFrame([], rows.schema)
    result = merge(spark.read.schema(rows.schema).parquet(*old_paths) if old_paths else empty, rows)
    if touched:
        (result.withColumn("range_no", _range(key, ranges)).repartition("range_no")
         .write.partitionBy("range_no").parquet(f"{root}/data/{new}/rows"))
    written = {r: f"{new}/rows" for r in touched}
    _commit(spark, root, version, held | written, names, result, ranges)
    return Merged(version, True, touched)


def _commit(spark: SparkSession, root: str, version: int, held: dict[int, str], names: DataFrame, result: DataFrame,
            ranges: int) -> None:
    path = _manifest(root, version)
    fs, p = _fs(spark, path)
    if fs.exists(p):  # left by a merge that did not finish
        fs.delete(p, True)
    names.coalesce(1).write.parquet(f"{path}/batches")
    first = F.col(result.columns[0]).alias(result.columns[0], metadata={"ranges": ranges})
    result.select(first, *result.columns[1:]).limit(0).write.parquet(f"{path}/schema")
    table = spark.createDataFrame(sorted(held.items()), "range int, folder string")
    table.coalesce(1).write.json(f"{path}/ranges")


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete folders that the last ``keep`` versions do not use, and older
    manifests; returns how many data folders went."""
    known = versions(spark, root)
    used = {folder.split("/")[0] for v in known[-keep:] for folder in _ranges(spark, root, v).values()}
    gone = [f"{root}/data/{n}" for n in _children(spark, f"{root}/data") if n not in used]
    kept = {f"{v:010d}" for v in known[-keep:]}
    for path in gone + [f"{root}/manifests/{n}" for n in _children(spark, f"{root}/manifests") if n not in kept]:
        fs, p = _fs(spark, path)
        fs.delete(p, True)
    return len(gone)
