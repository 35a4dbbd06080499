"""Batch reports: product affinity, cohorts, the four SQL reports and the
three document-pipeline reports (B1-B2, C1-C4, D1-D3).

Ordering is always completed with the grouping keys, so every top-k and
every printed order is deterministic.  Money is summed exactly
(``money_sum``) and rounded half-up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.domains import SEGMENT_BOUNDS, SEGMENT_DEFAULT, SEGMENT_LABELS
from mercato.functions.exprs import (
    as_timestamp, cents, from_cents, half_up, mean_exact, money_sum, month_key, top_k,
)
from mercato.operators.enrich import product_lookup


# ---------------------------------------------------------------- B1
def _pairs(baskets: DataFrame) -> DataFrame:
    a = baskets.select("transaction_id", F.col("product_id").alias("product_a"))
    b = baskets.select("transaction_id", F.col("product_id").alias("product_b"))
    return (a.join(b, "transaction_id").where(F.col("product_a") < F.col("product_b"))
             .groupBy("product_a", "product_b")
             .agg(F.count(F.lit(1)).alias("co_purchase_count")))


#: Products whose pairs give the lower bound of the answer's counts; any
#: number is right, more of them give a tighter bound.
PROBE_PRODUCTS = 200


def product_affinity(items: DataFrame, top_n: int = 20, partitions: int | None = None) -> DataFrame:
    """Product pairs bought in the same transaction, most frequent first.

    Each (transaction, product) counts once; a pair is reported once with
    product_a < product_b; ties are ordered by the pair.

    The pair explosion of big baskets is cut without changing the answer: a
    pair seen in c baskets needs both products in >= c baskets.  The pairs
    among the ``PROBE_PRODUCTS`` most frequent products (broadcast: never
    more ids than that) are counted; if there are ``top_n`` of them, the
    count s of the ``top_n``-th is a lower bound of the answer's last count,
    and only products in >= s baskets can be part of the answer.  The
    self-join runs on those only; with s = 1 nothing is cut.  The bound is a
    scalar subquery of the same plan: nothing is read on the driver.  Hot
    baskets are split by adaptive skew-join handling; pair counts are
    combined map-side.  ``partitions`` fixes in how many parts, by transaction,
    the self-join runs, for tables whose task shares would grow otherwise;
    parts that are dealt so are not split further.
    """
    baskets = (items.select("transaction_id", "product_id")
               .where(F.col("transaction_id").isNotNull() & F.col("product_id").isNotNull())
               .distinct())
    freq = baskets.groupBy("product_id").agg(F.count(F.lit(1)).alias("n_baskets"))
    probe = top_k(freq, [F.desc("n_baskets"), F.asc("product_id")], PROBE_PRODUCTS)
    probe_pairs = _pairs(baskets.join(F.broadcast(probe.select("product_id")), "product_id", "left_semi"))
    kth = (top_k(probe_pairs, [F.desc("co_purchase_count"), "product_a", "product_b"], top_n)
           .agg(F.when(F.count(F.lit(1)) >= top_n, F.min("co_purchase_count"))
                 .otherwise(F.lit(1)).alias("s")))
    frequent = freq.where(F.col("n_baskets") >= kth.scalar()).select("product_id")
    kept = baskets.join(frequent, "product_id", "left_semi")
    return top_k(_pairs(kept.repartition(partitions, "transaction_id") if partitions else kept),
                 [F.desc("co_purchase_count"), "product_a", "product_b"], top_n)


# ---------------------------------------------------------------- B2
def cohort_analysis(users: DataFrame, transactions: DataFrame) -> DataFrame:
    """Registration month x transaction month: revenue (each total in whole
    cents, then summed exactly), distinct active users and orders (all
    statuses; users joined inner).

    Transactions are first reduced to one row per (user, month) with
    map-side combine, so the join moves one row per active user-month
    instead of every order, and the distinct-user count becomes a row count.
    ``users`` must hold one row per user (``clean_users``).
    """
    t = (transactions.withColumn("timestamp", as_timestamp(transactions, "timestamp"))
         .groupBy("user_id", month_key("timestamp").alias("txn_month"))
         .agg(F.sum(cents("total")).alias("rev"),
              F.count(F.lit(1)).alias("n")))
    u = users.select("user_id", month_key(as_timestamp(users, "registration_date")).alias("cohort_month"))
    return (t.join(u, "user_id")
             .groupBy("cohort_month", "txn_month")
             .agg(from_cents(F.sum("rev")).alias("total_revenue"),
                  F.count(F.lit(1)).alias("active_users"),
                  F.sum("n").alias("order_count"))
             .orderBy("cohort_month", "txn_month"))


# ---------------------------------------------------------------- C1
def revenue_by_category(items: DataFrame, products: DataFrame, limit: int | None = 10) -> DataFrame:
    """Per category of the sold products: distinct products sold, units,
    gross revenue, mean list price weighted by line items, and revenue per
    distinct transaction; highest revenue first.  No status filter; raw
    tables (a duplicated product row counts twice, as in the SQL join)."""
    p = products.select("product_id", "category_id", "base_price")
    j = items.select("transaction_id", "product_id", "quantity", "subtotal").join(p, "product_id")
    agg = j.groupBy("category_id").agg(
        F.count_distinct("product_id").alias("product_count"),
        F.sum("quantity").alias("total_units_sold"),
        money_sum("subtotal").alias("_rev"),
        mean_exact("base_price").alias("_avg_price"),
        F.count_distinct("transaction_id").alias("_n_txn"))
    out = agg.select(
        "category_id", "product_count", "total_units_sold",
        half_up("_rev", 2).alias("total_revenue"),
        half_up("_avg_price", 2).alias("avg_product_price"),
        half_up(F.col("_rev") / F.col("_n_txn"), 2).alias("avg_order_value"))
    return top_k(out, [F.desc("total_revenue"), "category_id"], limit)


# ---------------------------------------------------------------- C2
def top_users(transactions: DataFrame, users: DataFrame, limit: int | None = 10) -> DataFrame:
    """Completed transactions per user (with country/state): distinct
    orders, spend, mean order value, first and last purchase.

    Orders are aggregated per user before the join with users; re-grouping
    after the join keeps the SQL result even when a user row is duplicated.
    """
    t = (transactions.where(F.col("status") == "completed")
         .withColumn("timestamp", as_timestamp(transactions, "timestamp"))
         .groupBy("user_id").agg(
             F.count_distinct("transaction_id").alias("order_count"),
             F.sum(cents("total")).alias("_sum"),
             F.count("total").alias("_n"),
             F.min("timestamp").alias("first_purchase"),
             F.max("timestamp").alias("last_purchase")))
    u = users.select("user_id", F.col("geo_data.country").alias("country"),
                     F.col("geo_data.state").alias("state"))
    g = (t.join(u, "user_id")
          .groupBy("user_id", "country", "state").agg(
              F.max("order_count").alias("order_count"),
              from_cents(F.sum("_sum")).alias("_sum"),
              F.sum("_n").alias("_n"),
              F.min("first_purchase").alias("first_purchase"),
              F.max("last_purchase").alias("last_purchase")))
    out = g.select("user_id", "country", "state", "order_count",
                   half_up("_sum", 2).alias("total_spent"),
                   half_up(F.col("_sum") / F.col("_n"), 2).alias("avg_order_value"),
                   "first_purchase", "last_purchase")
    return top_k(out, [F.desc("total_spent"), "user_id"], limit)


# ---------------------------------------------------------------- C3
def conversion_funnel(sessions: DataFrame) -> DataFrame:
    """Per device type x referrer: sessions, converted sessions, conversion
    rate in % (2 places) and mean duration (whole seconds); best rate first."""
    conv = F.sum(F.when(F.col("conversion_status") == "converted", 1).otherwise(0))
    g = sessions.groupBy(F.col("device_profile.type").alias("device_type"), "referrer").agg(
        F.count(F.lit(1)).alias("total_sessions"),
        conv.cast("long").alias("converted_sessions"),
        mean_exact("duration_seconds", as_money=False).alias("_dur"))
    out = g.select("device_type", "referrer", "total_sessions", "converted_sessions",
                   half_up(F.col("converted_sessions").cast("double") * F.lit(100.0)
                           / F.col("total_sessions"), 2).alias("conversion_rate_pct"),
                   half_up("_dur", 0).alias("avg_session_duration_sec"))
    return out.orderBy(F.desc("conversion_rate_pct"), "device_type", "referrer")


# ---------------------------------------------------------------- C4
def monthly_revenue(transactions: DataFrame) -> DataFrame:
    """Completed transactions per month: distinct orders, distinct buyers,
    revenue and mean order value, in month order."""
    t = (transactions.where(F.col("status") == "completed")
         .withColumn("month", month_key(as_timestamp(transactions, "timestamp"))))
    g = t.groupBy("month").agg(
        F.count_distinct("transaction_id").alias("order_count"),
        F.count_distinct("user_id").alias("unique_buyers"),
        money_sum("total").alias("_sum"), F.count("total").alias("_n"))
    return (g.select("month", "order_count", "unique_buyers",
                     half_up("_sum", 2).alias("revenue"),
                     half_up(F.col("_sum") / F.col("_n"), 2).alias("avg_order_value"))
             .orderBy("month"))


# ---------------------------------------------------------------- D1
def top_products(items: DataFrame, products: DataFrame, limit: int, *lookup: str) -> DataFrame:
    """Top ``limit`` products by gross revenue with units, line count and the
    ``lookup`` columns of the catalogue (NULL for unknown products).

    Lines are aggregated and limited first; the catalogue is looked up for
    the winners only, so line items are read once and never joined."""
    g = items.groupBy("product_id").agg(
        F.sum("quantity").alias("units_sold"),
        money_sum("subtotal").alias("_rev"),
        F.count(F.lit(1)).alias("order_count"))
    top = top_k(g, [F.desc("_rev"), "product_id"], limit)
    return top.join(product_lookup(products, *lookup), "product_id", "left")


def product_popularity(items: DataFrame, products: DataFrame, limit: int = 10) -> DataFrame:
    """Best-selling products by gross revenue, with units, line-item count
    and, looked up after the limit, name, category, current stock and active
    flag."""
    top = top_products(items, products, limit, "name", "category_id", "current_stock", "is_active")
    return (top.select("product_id", F.col("name").alias("product_name"), "category_id", "units_sold",
                       half_up("_rev", 2).alias("revenue"), "order_count",
                       "current_stock", "is_active", "_rev")
            .orderBy(F.desc("_rev"), "product_id").drop("_rev"))


# ---------------------------------------------------------------- D2
def user_segmentation(users_enriched: DataFrame) -> DataFrame:
    """Users bucketed by order count at 0, 1, 3, 6, 11 (to 100000): users per
    bucket, mean spend and mean of the per-user average order value.
    Counts outside the bounds (or missing) fall into the default bucket
    ``11+``.  Empty buckets are absent; buckets in bound order."""
    o = F.col("purchase_summary.total_orders")
    lower, label = None, None
    for lo, hi, name in zip(SEGMENT_BOUNDS[:-1], SEGMENT_BOUNDS[1:], SEGMENT_LABELS):
        cond = (o >= lo) & (o < hi)
        lower = F.when(cond, lo) if lower is None else lower.when(cond, lo)
        label = F.when(cond, name) if label is None else label.when(cond, name)
    lower = lower.otherwise(SEGMENT_BOUNDS[-1])
    label = label.otherwise(SEGMENT_DEFAULT)
    g = users_enriched.groupBy(lower.alias("_lo"), label.alias("order_count_bucket")).agg(
        F.count(F.lit(1)).alias("user_count"),
        mean_exact("purchase_summary.total_spent").alias("_spent"),
        mean_exact("purchase_summary.avg_order_value").alias("_aov"))
    return (g.orderBy("_lo")
             .select("order_count_bucket", "user_count",
                     half_up("_spent", 2).alias("avg_total_spent"),
                     half_up("_aov", 2).alias("avg_order_value")))


# ---------------------------------------------------------------- D3
def revenue_by_category_monthly(items_enriched: DataFrame) -> DataFrame:
    """Gross revenue and units per category and month (UTC), months in
    order and, within a month, highest unrounded revenue first."""
    g = items_enriched.groupBy(
        "category_id", month_key(as_timestamp(items_enriched, "timestamp")).alias("year_month")
    ).agg(money_sum("subtotal").alias("_rev"), F.sum("quantity").alias("units_sold"))
    return (g.orderBy("year_month", F.desc("_rev"), "category_id")
             .select("category_id", "year_month", half_up("_rev", 2).alias("revenue"),
                     "units_sold"))

