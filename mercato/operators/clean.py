"""Cleaning of the raw tables (A2-A6).

Each cleaner parses its ISO timestamps (bad strings become NULL rather than
failing the job), fills the documented defaults, drops rows that cannot be
used, and keeps one row per key.  De-duplication is a grouped aggregate
with a fixed survivor (``mercato.functions.dedupe``), so a key with
millions of copies is combined map-side before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.exprs import as_timestamp, dedupe


def _parse(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: as_timestamp(df, n) for n in names if n in df.columns})


def clean_users(users: DataFrame) -> DataFrame:
    """Parse registration/last-active dates; drop NULL ids; one row per user."""
    d = _parse(users, "registration_date", "last_active").where(F.col("user_id").isNotNull())
    return dedupe(d, ["user_id"])


def clean_products(products: DataFrame) -> DataFrame:
    """Parse creation date; stock NULL -> 0; is_active NULL -> false;
    drop NULL ids; one row per product."""
    d = _parse(products, "creation_date").withColumns({
        "current_stock": F.coalesce(F.col("current_stock"), F.lit(0).cast("long")),
        "is_active": F.coalesce(F.col("is_active"), F.lit(False)),
    }).where(F.col("product_id").isNotNull())
    return dedupe(d, ["product_id"])


def valid_total() -> Column:
    """A total that is an amount (NULL and NaN are not) and not negative."""
    return F.col("total").isNotNull() & ~F.isnan("total") & (F.col("total") >= 0)


def clean_transactions(transactions: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Parse the timestamp; discount NULL -> 0.0; keep rows with a valid
    total; one row per transaction id (a NULL id is kept as one row, as the
    key of its own group).  ``columns`` (transaction_id among them) are the
    ones to keep: the others are neither read nor part of the choice."""
    d = _parse(transactions, "timestamp").withColumn("discount", F.coalesce(F.col("discount"), F.lit(0.0)))
    return dedupe(d.where(valid_total()).select(*(columns or d.columns)), ["transaction_id"])


def clean_transaction_ids(transactions: DataFrame) -> DataFrame:
    """The ids that survive ``clean_transactions``: which duplicate survives
    does not change the set, so this is a plain distinct on the id of the
    valid rows (hash aggregate, no row comparison)."""
    return transactions.where(valid_total()).select("transaction_id").distinct()


def clean_sessions(sessions: DataFrame) -> DataFrame:
    """Parse start/end; keep sessions with a positive duration (NULL, zero
    and negative durations are malformed); one row per session id."""
    d = _parse(sessions, "start_time", "end_time").where(F.col("duration_seconds") > 0)
    return dedupe(d, ["session_id"])


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table, as one small (table_name, row_count) frame."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
