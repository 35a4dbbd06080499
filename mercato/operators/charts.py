"""The data behind each chart (F1, F3-F5); drawing is left to the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.domains import LABEL_ELLIPSIS, LABEL_MAX_CHARS, REFERRERS
from mercato.functions.exprs import as_timestamp, half_up, money_sum, month_key
from mercato.operators.reports import top_products


def short_label(col, width: int = LABEL_MAX_CHARS):
    c = F.col(col) if isinstance(col, str) else col
    return F.when(F.length(c) > width,
                  F.concat(F.substring(c, 1, width), F.lit(LABEL_ELLIPSIS))).otherwise(c)


def chart_product_revenue(items: DataFrame, products: DataFrame, limit: int = 10) -> DataFrame:
    """Top products by gross revenue, labels cut to 28 characters + '...',
    re-sorted ascending for a horizontal bar chart; revenue in thousands."""
    top = (top_products(items, products, limit, "name").withColumnRenamed("_rev", "revenue")
           .withColumnRenamed("name", "product_name"))
    return (top.select("product_id", "product_name", short_label("product_name").alias("short_name"),
                       "revenue", "units_sold", (F.col("revenue") / F.lit(1000.0)).alias("revenue_k"))
               .orderBy("revenue", F.desc("product_id")))


def chart_category_revenue_series(items_enriched: DataFrame) -> DataFrame:
    """Gross revenue per category and month (lines in whole cents, the sum not
    rounded further), in month order: the series behind a revenue-over-time chart per category."""
    g = items_enriched.groupBy(
        "category_id", month_key(as_timestamp(items_enriched, "timestamp")).alias("year_month")
    ).agg(money_sum("subtotal").alias("revenue"))
    return g.orderBy("year_month", "category_id")


def chart_monthly_revenue(monthly: DataFrame) -> DataFrame:
    """The monthly report with revenue in millions, for a line chart."""
    return monthly.withColumn("revenue_m", F.col("revenue") / F.lit(1_000_000.0)).orderBy("month")


def chart_tier_share(tier_summary: DataFrame) -> DataFrame:
    """Share of users per tier (%, 1 place), mean spend in thousands and mean
    conversion; the share window runs over the few tier rows only."""
    everyone = Window.partitionBy()
    return (tier_summary.select(
        "clv_tier", "user_count",
        half_up(F.col("user_count") * F.lit(100.0) / F.sum("user_count").over(everyone), 1)
         .alias("share_pct"),
        (F.col("avg_total_spent") / F.lit(1000.0)).alias("avg_spent_k"),
        "avg_conversion_rate", "avg_clv_score")
        .orderBy(F.desc("avg_clv_score"), "clv_tier").drop("avg_clv_score"))


def chart_conversion_pivot(funnel: DataFrame) -> DataFrame:
    """Device type x referrer matrix of the mean conversion rate (heatmap);
    the referrer columns are fixed, so the pivot needs no extra pass."""
    return (funnel.groupBy("device_type").pivot("referrer", sorted(REFERRERS))
            .agg(F.avg("conversion_rate_pct")).orderBy("device_type"))
