"""Per-key ordered scans that stay parallel when one key is huge.

A plain ``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to
one task; if one user or product holds a third of all rows, that task holds
a third of the data.  Here each key's time line is cut into buckets and the
window runs per (key, bucket).  What crosses a bucket edge (the last event of
the previous bucket, the first of the next one, how many sessions started
before) is read from a per-(key, bucket) summary, which is an ordinary
map-side-combined aggregate with one row per non-empty bucket.  The result is
exact: identical to an unsplit window over the whole key.

Buckets have a fixed width in time.  The ``HEAVY`` buckets of most rows (a
bot's day, a bestseller's month) are cut again into ``HEAVY`` equal pieces of
the time they span, if they have over ``LIGHT_ROWS`` rows; any other bucket
has at most one in ``HEAVY`` of all rows.  The table of heavy buckets has at
most ``HEAVY`` rows and is broadcast.

Rows without a key or a time have no place on a time line and are not
scanned; ``key_and_domain_check`` reports how many there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.exprs import epoch_micros

_US = 1_000_000
HEAVY = 1000
#: Buckets of fewer rows are never cut, however small the table.
LIGHT_ROWS = 100_000


def _bucketed(df: DataFrame, key: str, ts: str, bucket_seconds: int) -> DataFrame:
    """Rows with their time in microseconds and their bucket: a struct of the
    time bucket and the piece of it (0 unless the bucket is heavy)."""
    rows = (df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
              .withColumn("_us", epoch_micros(df, ts))
              .withColumn("_w", F.floor(F.col("_us") / F.lit(bucket_seconds * _US))))
    heavy = (rows.groupBy(F.col(key).alias("_hk"), F.col("_w").alias("_hw"))
             .agg(F.count(F.lit(1)).alias("_n"), F.min("_us").alias("_lo"), F.max("_us").alias("_hi"))
             .where(F.col("_n") > F.lit(LIGHT_ROWS)).orderBy(F.desc("_n"), "_hk", "_hw").limit(HEAVY)
             .drop("_n"))
    cut = rows.join(F.broadcast(heavy), (F.col(key) == F.col("_hk")) & (F.col("_w") == F.col("_hw")), "left")
    piece = F.coalesce(F.floor((F.col("_us") - F.col("_lo")) / (F.col("_hi") - F.col("_lo") + 1) * HEAVY),
                       F.lit(0).cast("long"))
    return (cut.withColumn("_b", F.struct(F.col("_w").alias("w"), piece.alias("p")))
               .drop("_hk", "_hw", "_lo", "_hi", "_w"))


def with_neighbours(df: DataFrame, key: str, ts: str, tiebreak: str,
                    carry: Sequence[str], bucket_seconds: int = 86400) -> DataFrame:
    """Add ``prev`` and ``next`` structs (fields ``_us`` + ``carry``) holding
    the previous / next row of the same key in (ts, tiebreak) order."""
    d = _bucketed(df, key, ts, bucket_seconds)
    payload = F.struct(F.col("_us"), *[F.col(c) for c in carry])
    order = F.struct(F.col("_us"), F.col(tiebreak))
    w = Window.partitionBy(key, "_b").orderBy("_us", tiebreak)
    d = (d.withColumn("_p_in", F.lag(payload).over(w))
          .withColumn("_n_in", F.lead(payload).over(w)))
    edges = (d.groupBy(key, "_b")
               .agg(F.min_by(payload, order).alias("_first"),
                    F.max_by(payload, order).alias("_last")))
    wb = Window.partitionBy(key).orderBy("_b")
    edges = edges.select(key, "_b",
                         F.lag("_last").over(wb).alias("_p_edge"),
                         F.lead("_first").over(wb).alias("_n_edge"))
    d = d.join(edges, [key, "_b"])
    return (d.withColumn("prev", F.coalesce("_p_in", "_p_edge"))
             .withColumn("next", F.coalesce("_n_in", "_n_edge"))
             .drop("_p_in", "_n_in", "_p_edge", "_n_edge", "_b"))


def assign_sessions(df: DataFrame, key: str, ts: str, tiebreak: str,
                    gap_seconds: int, bucket_seconds: int = 86400,
                    carry_next: Sequence[str] = (), keep_bucket: bool = False) -> DataFrame:
    """Number the sessions of each key: a session starts at the key's first
    row and wherever the gap to the previous row is >= ``gap_seconds``.

    Adds ``session_seq`` (1, 2, ... per key), ``_is_start`` (true on the row
    that opens a session) and ``_us`` (epoch micros).  With ``carry_next`` it
    also adds ``next``: the following row of the same key (struct of ``_us``
    + those columns), or NULL at the key's last row.  ``keep_bucket`` leaves
    the bucket column ``_b``, for further scans of the same pieces.
    """
    gap = F.lit(gap_seconds * _US)
    d = _bucketed(df, key, ts, bucket_seconds)
    w = Window.partitionBy(key, "_b").orderBy("_us", tiebreak)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("_prev", F.lag("_us").over(w))
    # a start inside the bucket (the bucket's first row is decided by the summary)
    d = d.withColumn("_ls", F.when(F.col("_prev").isNotNull()
                                   & (F.col("_us") - F.col("_prev") >= gap), 1).otherwise(0)
                            .cast("long"))
    d = d.withColumn("_lrun", F.sum("_ls").over(running))
    aggs = [F.min("_us").alias("_fus"), F.max("_us").alias("_lus"),
            F.sum("_ls").alias("_nls")]
    if carry_next:
        payload = F.struct(F.col("_us"), *[F.col(c) for c in carry_next])
        d = d.withColumn("_n_in", F.lead(payload).over(w))
        aggs.append(F.min_by(payload, F.struct(F.col("_us"), F.col(tiebreak))).alias("_first"))
    edges = d.groupBy(key, "_b").agg(*aggs)
    wb = Window.partitionBy(key).orderBy("_b")
    before = wb.rowsBetween(Window.unboundedPreceding, -1)
    prev_last = F.lag("_lus").over(wb)
    edges = edges.withColumn(
        "_fs", F.when(prev_last.isNull() | (F.col("_fus") - prev_last >= gap), 1).otherwise(0)
                .cast("long"))
    cols = [key, "_b", "_fs",
            F.coalesce(F.sum(F.col("_fs") + F.col("_nls")).over(before), F.lit(0)).alias("_before")]
    if carry_next:
        cols.append(F.lead("_first").over(wb).alias("_n_edge"))
    edges = edges.select(*cols)
    d = d.join(edges, [key, "_b"])
    d = d.withColumn("session_seq", F.col("_before") + F.col("_fs") + F.col("_lrun"))
    d = d.withColumn("_is_start", F.when(F.col("_prev").isNull(), F.col("_fs") == 1)
                                   .otherwise(F.col("_ls") == 1))
    drop = ["_prev", "_ls", "_lrun", "_fs", "_before"] + ([] if keep_bucket else ["_b"])
    if carry_next:
        d = d.withColumn("next", F.coalesce("_n_in", "_n_edge"))
        drop += ["_n_in", "_n_edge"]
    return d.drop(*drop)


def as_of(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, carry: Sequence[str],
          tiebreak: Sequence[str] = (), bucket_seconds: int = 30 * 86400) -> DataFrame:
    """As-of join: ``left`` plus ``as_of``, a struct (``_us`` + ``carry``) of
    the latest ``right`` row of the same key at or before the left row's time,
    NULL where there is none.  Of right rows with one time, the last by
    ``tiebreak`` counts.  No left row is lost or repeated; those without a key
    or a time have no match.

    Both sides are one time line (``_bucketed``): inside a bucket the last
    right row is carried by a window, across buckets by the summary.
    """
    t = left.schema[left_ts].dataType
    carried = [c for c in dict.fromkeys([*carry, *tiebreak])]
    row_type, point_type = left.schema, right.select(*carried).schema
    points = right.where(F.col(key).isNotNull() & F.col(right_ts).isNotNull()).select(
        F.col(key).alias("_k"), F.col(right_ts).cast(t).alias("_t"), F.lit(0).alias("_side"),
        F.lit(None).cast(row_type).alias("_row"), F.struct(*carried).alias("_pt"))
    rows = left.select(F.col(key).alias("_k"), F.col(left_ts).alias("_t"), F.lit(1).alias("_side"),
                       F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_row"),
                       F.lit(None).cast(point_type).alias("_pt"))
    placed = F.col("_k").isNotNull() & F.col("_t").isNotNull()
    d = _bucketed(rows.where(placed).unionByName(points), "_k", "_t", bucket_seconds)
    point = F.when(F.col("_side") == 0, F.struct(F.col("_us"), *[F.col(f"_pt.{c}").alias(c) for c in carried]))
    order = [F.col("_us"), F.col("_side"), *[F.col(f"_pt.{c}") for c in tiebreak]]
    d = d.withColumn("_point", point)
    w = Window.partitionBy("_k", "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("_in", F.last("_point", ignorenulls=True).over(w))
    place = F.when(F.col("_point").isNotNull(), F.struct(F.col("_us"), *[F.col(f"_pt.{c}") for c in tiebreak]))
    wb = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    edges = (d.groupBy("_k", "_b").agg(F.max_by("_point", place).alias("_end"))
             .select("_k", "_b", F.last("_end", ignorenulls=True).over(wb).alias("_edge")))
    found = (d.where(F.col("_side") == 1).join(edges, ["_k", "_b"])
             .select("_row.*", F.coalesce("_in", "_edge").alias("as_of")))
    found_type = found.schema["as_of"].dataType
    return found.unionByName(left.where(F.col(key).isNull() | F.col(left_ts).isNull())
                             .withColumn("as_of", F.lit(None).cast(found_type)))


def running_low(df: DataFrame, key: str, ts: str, tiebreak: Sequence[str], value: str,
                bucket_seconds: int = 30 * 86400, extra: Sequence[Column] = ()) -> tuple[DataFrame, DataFrame]:
    """Prefix sums of ``value`` in (ts, tiebreak) order, as a mergeable state.

    Returns the rows with ``_b`` (bucket) and ``_lp`` (the sum up to the row
    inside its bucket), and one summary row per (key, bucket): ``_sum``,
    ``_low`` (the lowest prefix inside the bucket), ``_before`` (the sum of
    all earlier buckets) and the ``extra`` aggregates.  Two adjacent pieces
    merge as (s1 + s2, min(l1, s1 + l2)), so ``_before + _low`` is the lowest
    prefix of a bucket on the whole time line, and only the bucket in which a
    bound is first crossed has to be looked at row by row.
    """
    d = _bucketed(df, key, ts, bucket_seconds)
    w = Window.partitionBy(key, "_b").orderBy("_us", *tiebreak).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("_lp", F.sum(value).over(w))
    before = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    edges = d.groupBy(key, "_b").agg(F.sum(value).alias("_sum"), F.min("_lp").alias("_low"), *extra)
    return d, edges.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
