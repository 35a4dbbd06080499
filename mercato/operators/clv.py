"""Customer lifetime value: financial and behavioural profiles, score,
tiers and the three tier reports (E1-E9).

Global values (the three maxima, the tier thresholds) are computed by a
one-row aggregate that Spark runs as a scalar subquery inside the same
plan: nothing is collected to the driver, no cross join is planned, and
the subquery's shuffle stages are shared with the main query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.domains import (
    CLV_TIER_QUANTILES, CLV_TIERS, CLV_WEIGHTS, ENGAGEMENT_WEIGHTS,
)
from mercato.functions.exprs import half_up, mean_exact, money_sum, ratio, top_k

FILL_ZERO = {"total_sessions": 0, "avg_session_duration_sec": 0.0,
             "personal_conversion_rate_pct": 0.0, "converted_sessions": 0}


def user_financials(users_enriched: DataFrame) -> DataFrame:
    """Flat financial profile of users with at least one order."""
    ps = "purchase_summary"
    return (users_enriched.where(F.col(f"{ps}.total_orders") > 0)
            .select("user_id", F.col("geo_data.country").alias("country"),
                    F.col("geo_data.state").alias("state"),
                    F.coalesce(F.col(f"{ps}.total_orders"), F.lit(0).cast("long")).alias("total_orders"),
                    F.coalesce(F.col(f"{ps}.total_spent"), F.lit(0.0)).alias("total_spent"),
                    F.coalesce(F.col(f"{ps}.avg_order_value"), F.lit(0.0)).alias("avg_order_value"),
                    F.col(f"{ps}.favorite_category").alias("favorite_category")))


def session_behaviour(sessions: DataFrame) -> DataFrame:
    """Per user: sessions, mean duration (whole seconds), personal conversion
    rate (%, 2 places), device and referrer of the earliest session, and
    converted sessions.  A grouped aggregate with map-side combine."""
    conv = F.sum(F.when(F.col("conversion_status") == "converted", 1).otherwise(0)).cast("long")
    first = F.struct(F.col("start_time"), F.col("session_id"))
    g = sessions.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_sessions"),
        mean_exact("duration_seconds", as_money=False).alias("_dur"),
        conv.alias("converted_sessions"),
        F.min_by(F.col("device_profile.type"), first).alias("primary_device"),
        F.min_by(F.col("referrer"), first).alias("primary_referrer"))
    return g.select(
        "user_id", "total_sessions",
        half_up("_dur", 0).alias("avg_session_duration_sec"),
        half_up(F.col("converted_sessions").cast("double") * F.lit(100.0)
                / F.col("total_sessions"), 2).alias("personal_conversion_rate_pct"),
        "primary_device", "primary_referrer", "converted_sessions")


def engagement_score() -> Column:
    w = ENGAGEMENT_WEIGHTS
    return half_up(F.col("total_sessions") * F.lit(w["sessions"])
                   + F.col("avg_session_duration_sec") / F.lit(60) * F.lit(w["minutes"])
                   + F.col("personal_conversion_rate_pct") * F.lit(w["conversion"]), 2)


def clv_scores(financials: DataFrame, behaviour: DataFrame) -> DataFrame:
    """Left join of the two profiles (missing behaviour -> zeros, device and
    referrer stay NULL), engagement score, and the CLV score: 60 % spend,
    20 % orders, 20 % engagement, each relative to its maximum over all
    users (NULL when that maximum is 0).

    The maxima are a scalar subquery over the joined per-user table, so the
    plan stays lazy and whole; a job that derives several reports writes the
    scores once and reads them back (``plans.jobs.clv_job``).
    """
    c = financials.join(behaviour, "user_id", "left").fillna(FILL_ZERO)
    c = c.withColumn("engagement_score", engagement_score())
    # the scalar subquery is bound once as a column, so it is planned and
    # run once (each field access on the subquery itself would copy it)
    c = c.withColumn("_m", c.select(F.struct(F.max("total_spent").alias("spent"),
                                             F.max("total_orders").alias("orders"),
                                             F.max("engagement_score").alias("eng"))).scalar())
    hundred = F.lit(100.0)
    w = CLV_WEIGHTS
    score = (ratio("total_spent", F.col("_m.spent")) * hundred * F.lit(w["spent"])
             + ratio("total_orders", F.col("_m.orders")) * hundred * F.lit(w["orders"])
             + ratio("engagement_score", F.col("_m.eng")) * hundred * F.lit(w["engagement"]))
    return c.withColumn("clv_score", half_up(score, 2)).drop("_m")


def tier_thresholds(scores: DataFrame, method: str = "exact") -> DataFrame:
    """One row with p25, p50, p75 of clv_score.

    ``exact``: the smallest score whose cumulative share reaches p, Spark's
    ``percentile_disc``: every task counts its scores by value and only the
    counts are merged, no row is sorted or moved.  Scores are in cents, so
    there are at most 10,001 values from 0 to 100 (negative totals in unclean
    input add one for each different negative score).  ``approx``:
    ``percentile_approx`` with accuracy 100 (relative error 0.01), a
    mergeable sketch.
    """
    s = scores.where(F.col("clv_score").isNotNull())
    names = [f"p{int(q * 100)}" for q in CLV_TIER_QUANTILES]
    if method == "approx":
        q = F.percentile_approx("clv_score", F.array(*[F.lit(x) for x in CLV_TIER_QUANTILES]), 100)
        return s.agg(q.alias("_q")).select(*[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    return s.agg(*[F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY clv_score)").alias(n)
                   for q, n in zip(CLV_TIER_QUANTILES, names)])


def tier_rank_check(scores: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """For each threshold of the approximate method: its quantile, the users
    with a score, and whether the threshold's true rank is within
    ``tolerance`` of the quantile."""
    s = scores.where(F.col("clv_score").isNotNull())
    t = tier_thresholds(scores, "approx")
    names = [f"p{int(q * 100)}" for q in CLV_TIER_QUANTILES]
    marked = s.select("clv_score").withColumn("_t", t.select(F.struct(*names)).scalar())
    counts = marked.agg(F.count(F.lit(1)).alias("n"), *[x for n in names for x in (
        F.count_if(F.col("clv_score") < F.col(f"_t.{n}")).alias(f"below_{n}"),
        F.count_if(F.col("clv_score") <= F.col(f"_t.{n}")).alias(f"upto_{n}"))])
    rows = F.array(*[F.struct(F.lit(q).alias("quantile"), F.col("n").alias("user_count"),
                              ((F.col(f"below_{n}") <= F.lit(q + tolerance) * F.col("n"))
                               & (F.col(f"upto_{n}") >= F.lit(q - tolerance) * F.col("n"))).alias("rank_ok"))
                     for q, n in zip(CLV_TIER_QUANTILES, names)])
    return counts.where("n > 0").select(F.explode(rows).alias("r")).select("r.*")


def clv_tiers(scores: DataFrame, method: str = "exact") -> DataFrame:
    """Premium (>= p75), High Value (>= p50), Medium Value (>= p25), else
    Low Value; lower bounds inclusive."""
    t = tier_thresholds(scores, method)
    d = scores.withColumn("_t", t.select(F.struct(*t.columns)).scalar())
    premium, high, medium, low = CLV_TIERS
    tier = (F.when(F.col("clv_score") >= F.col("_t.p75"), premium)
             .when(F.col("clv_score") >= F.col("_t.p50"), high)
             .when(F.col("clv_score") >= F.col("_t.p25"), medium)
             .otherwise(low))
    return d.withColumn("clv_tier", tier).drop("_t")


def clv_tier_summary(tiers: DataFrame) -> DataFrame:
    g = tiers.groupBy("clv_tier").agg(
        F.count(F.lit(1)).alias("user_count"),
        half_up(mean_exact("clv_score"), 2).alias("avg_clv_score"),
        half_up(mean_exact("total_spent"), 2).alias("avg_total_spent"),
        half_up(mean_exact("total_orders", as_money=False), 1).alias("avg_orders"),
        half_up(mean_exact("total_sessions", as_money=False), 1).alias("avg_sessions"),
        half_up(mean_exact("personal_conversion_rate_pct"), 2).alias("avg_conversion_rate"))
    return g.orderBy(F.desc("avg_clv_score"), "clv_tier")


def clv_top_customers(tiers: DataFrame, limit: int = 15) -> DataFrame:
    cols = ["user_id", "country", "clv_tier", "clv_score", "total_spent", "total_orders",
            "total_sessions", "personal_conversion_rate_pct", "primary_device"]
    return top_k(tiers.select(*cols), [F.desc("clv_score"), "user_id"], limit)


def clv_by_country(tiers: DataFrame, limit: int = 10) -> DataFrame:
    g = tiers.groupBy("country").agg(
        F.count(F.lit(1)).alias("user_count"),
        half_up(mean_exact("clv_score"), 2).alias("avg_clv_score"),
        half_up(money_sum("total_spent"), 2)
         .alias("total_revenue"))
    return top_k(g, [F.desc("total_revenue"), "country"], limit)
