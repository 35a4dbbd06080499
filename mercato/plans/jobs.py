"""End-to-end batch jobs over the raw document files.

1. ``curate``        raw JSON -> cleaned/enriched curated Parquet tables
2. ``batch_reports`` product affinity and cohorts (clean tables) -> CSV
3. ``sql_reports``   the four SQL reports over temp views (raw tables) -> CSV
4. ``clv_job``       CLV scores, tiers and reports -> per-user Parquet + CSV
5. ``check_raw``     raw JSON -> Parquet tables, rejected records apart
6. ``refresh_summary`` a batch of new transactions -> the curated purchase states

Each job reads what the previous one wrote (or the raw files) and writes
its outputs; reports go to CSV folders, per-user and per-item tables to
clustered Parquet.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from mercato.operators import clean, clv, enrich, reports, states
from mercato.plans.catalog import REPORT_VIEWS, register_reports, register_views, sql_report
from mercato.sources import readers, sinks, snapshots


def curate(spark: SparkSession, raw_dir: str, out_dir: str) -> dict[str, int]:
    """Enriched products, users (with purchase summary) and transactions as
    curated Parquet; returns the row count of each written table.

    Raw files that hold one array are read by one task each, so every table is
    parsed once and landed as Parquet (``out_dir/raw``, rejected records in
    ``out_dir/raw/rejected``); everything after reads that in many tasks."""
    landed = os.path.join(out_dir, "raw")
    check_raw(spark, raw_dir, landed)
    raw = {name: readers.read_curated(spark, landed, name) for name in readers.RAW_FILES}
    items = enrich.flatten_items(raw["transactions"])
    tables: dict[str, tuple[DataFrame, list[str], list[str]]] = {
        "products": (enrich.enrich_products(raw["products"], raw["categories"]),
                     ["product_id"], []),
        "users": (enrich.enrich_users(raw["users"], enrich.purchase_summary(
            raw["transactions"], items, raw["products"])), ["user_id"], []),
        "transactions": (sinks.with_month(enrich.enrich_transactions(
            raw["transactions"], items, raw["products"])), ["user_id", "timestamp"], ["month"]),
    }
    counts = {}
    for name, (df, cluster, part) in tables.items():
        path = os.path.join(out_dir, name)
        sinks.write_curated(df, path, cluster_by=cluster, partition_by=part)
        counts[name] = readers.read_curated(spark, out_dir, name).count()
    return counts


def check_raw(spark: SparkSession, raw_dir: str, out_dir: str) -> dict[str, dict[str, int]]:
    """Raw JSON -> one Parquet table of good rows and one of rejected records
    per raw table (``out_dir/<name>``, ``out_dir/rejected/<name>``).  Files
    are parsed for each of the two; what comes after reads Parquet.  Returns
    the counts."""
    counts = {}
    for name in readers.RAW_FILES:
        good, rejected = readers.read_checked(spark, raw_dir, name)
        sinks.land_raw_json(good, os.path.join(out_dir, name))
        sinks.land_raw_json(rejected, os.path.join(out_dir, "rejected", name))
        counts[name] = {"good": spark.read.parquet(os.path.join(out_dir, name)).count()} | {
            r["reason"]: r["count"] for r in spark.read.parquet(os.path.join(out_dir, "rejected", name)).groupBy("reason").count().collect()}
    return counts


def refresh_summary(transactions: DataFrame, items: DataFrame, products: DataFrame, root: str, batch_id: str,
                    ranges: int = snapshots.RANGES) -> snapshots.Merged:
    """Merge a batch of new transactions into the purchase states at ``root``.
    The same batch again changes nothing; only ranges of users that the batch
    names are rewritten.  ``read_summary`` gives the summary."""
    batch = states.purchase_states(transactions, items, products)
    return snapshots.merge_batch(batch, root, batch_id, "user_id", states.merge_states, ranges)


def read_summary(spark: SparkSession, root: str) -> DataFrame:
    return states.summary_of(snapshots.read_snapshot(spark, root))


def batch_reports(spark: SparkSession, raw_dir: str, out_dir: str,
                  top_n: int = 20) -> dict[str, DataFrame]:
    raw = readers.read_raw_tables(spark, raw_dir)
    users = clean.clean_users(raw["users"])
    tx = clean.clean_transactions(raw["transactions"])
    out = {"product_affinity": reports.product_affinity(enrich.flatten_items(tx), top_n),
           "cohort_analysis": reports.cohort_analysis(users, tx)}
    for name, df in out.items():
        sinks.write_report_csv(df, os.path.join(out_dir, name))
    return out


def sql_reports(spark: SparkSession, raw_dir: str, out_dir: str) -> dict[str, DataFrame]:
    register_views(spark, readers.read_raw_tables(spark, raw_dir))
    register_reports(spark)
    out = {f"sql_{name}": sql_report(spark, name) for name in REPORT_VIEWS}
    for name, df in out.items():
        sinks.write_report_csv(df, os.path.join(out_dir, name))
    return out


def clv_job(spark: SparkSession, raw_dir: str, curated_dir: str, out_dir: str,
            method: str = "approx") -> dict[str, DataFrame]:
    """CLV from the curated users and the raw sessions.  ``method`` is the
    tier threshold rule: ``approx`` (the source's sketch) or ``exact``."""
    users = readers.read_curated(spark, curated_dir, "users")
    sessions = readers.read_raw(spark, raw_dir, "sessions")
    # written once and read back: thresholds and reports start from a scan
    sinks.write_curated(clv.clv_scores(clv.user_financials(users), clv.session_behaviour(sessions)),
                        os.path.join(out_dir, "clv_scores"), cluster_by=["user_id"])
    tiers = clv.clv_tiers(readers.read_curated(spark, out_dir, "clv_scores"), method)
    sinks.write_curated(tiers, os.path.join(out_dir, "clv_full_results"), cluster_by=["user_id"])
    tiers = readers.read_curated(spark, out_dir, "clv_full_results")
    out = {"clv_tier_summary": clv.clv_tier_summary(tiers),
           "clv_top_customers": clv.clv_top_customers(tiers),
           "clv_by_country": clv.clv_by_country(tiers)}
    for name, df in out.items():
        sinks.write_report_csv(df, os.path.join(out_dir, name))
    return out
