"""Distinct buyers that merge over any period (C1, C4, B2).

Distinct counts of months cannot be added.  Each month keeps a theta sketch of
its buyers instead, a few KB however many there are; sketches of any months
merge into the distinct count of the period (union) or of those who bought in
both periods (intersection), without reading the transactions again.

A sketch of ``2**lg_k`` entries is exact up to that many buyers; beyond it,
the relative standard error of a union is ``1 / sqrt(2**lg_k)``, and that of
an intersection is the same share of the union.  ``error_bound`` is four
standard errors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.exprs import as_timestamp, month_key

LG_K = 12


def error_bound(lg_k: int = LG_K) -> float:
    return 4 / (2 ** lg_k) ** 0.5


def buyers_by_month(transactions: DataFrame) -> DataFrame:
    """The distinct (month, user_id) of completed transactions."""
    t = transactions.where(F.col("status") == "completed")
    return (t.select(month_key(as_timestamp(t, "timestamp")).alias("month"), "user_id")
            .where(F.col("month").isNotNull() & F.col("user_id").isNotNull()).distinct())


def buyer_sketches(transactions: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """One sketch per month: the state to keep.  Months of a new batch are
    added to it with ``merge_sketches``."""
    t = transactions.where((F.col("status") == "completed") & F.col("user_id").isNotNull())
    return (t.withColumn("month", month_key(as_timestamp(t, "timestamp"))).where(F.col("month").isNotNull())
            .groupBy("month").agg(F.theta_sketch_agg("user_id", lg_k).alias("buyers")))


def merge_sketches(a: DataFrame, b: DataFrame, lg_k: int = LG_K) -> DataFrame:
    return a.unionByName(b).groupBy("month").agg(F.theta_union_agg("buyers", lg_k).alias("buyers"))


def period_sketch(sketches: DataFrame, first: str, last: str, lg_k: int = LG_K) -> DataFrame:
    """One row: the sketch of all months from ``first`` to ``last``."""
    return sketches.where(F.col("month").between(first, last)).agg(F.theta_union_agg("buyers", lg_k).alias("buyers"))


def unique_buyers(sketches: DataFrame, first: str, last: str, lg_k: int = LG_K) -> DataFrame:
    """One row: about how many different buyers the period has."""
    return period_sketch(sketches, first, last, lg_k).select(
        F.coalesce(F.theta_sketch_estimate("buyers"), F.lit(0).cast("long")).alias("unique_buyers"))


def _month_number(month: str) -> Column:
    return F.substring(month, 1, 4).cast("int") * 12 + F.substring(month, 6, 2).cast("int")


def _ending(df: DataFrame, lengths: tuple[int, ...]) -> DataFrame:
    """Every row once for each period (``end``, ``months``) that its month
    belongs to."""
    n = F.explode(F.array(*[F.lit(x) for x in lengths]))
    return (df.withColumn("months", n)
            .withColumn("end", F.explode(F.sequence(_month_number("month"), _month_number("month") + F.col("months") - 1))))


def rolling_buyers(sketches: DataFrame, lengths: tuple[int, ...] = (1, 3, 12), lg_k: int = LG_K) -> DataFrame:
    """Different buyers of each period of ``lengths`` months that ends with a
    month of the table, from the sketches alone."""
    ends = sketches.select(_month_number("month").alias("end"), F.col("month").alias("last_month"))
    g = _ending(sketches, lengths).groupBy("end", "months").agg(F.theta_union_agg("buyers", lg_k).alias("u"))
    return g.join(ends, "end").select("last_month", "months", F.theta_sketch_estimate("u").alias("unique_buyers"))


def rolling_buyers_exact(buyers: DataFrame, lengths: tuple[int, ...] = (1, 3, 12)) -> DataFrame:
    """The exact twin, over the distinct (month, user_id)."""
    ends = buyers.select(_month_number("month").alias("end"), F.col("month").alias("last_month")).distinct()
    g = _ending(buyers, lengths).groupBy("end", "months").agg(F.count_distinct("user_id").alias("unique_buyers"))
    return g.join(ends, "end").select("last_month", "months", "unique_buyers")


def rolling_buyers_check(transactions: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """Each period's exact count, and whether the sketches come within their
    stated error of it."""
    about = rolling_buyers(buyer_sketches(transactions, lg_k), lg_k=lg_k).withColumnRenamed("unique_buyers", "about")
    exact = rolling_buyers_exact(buyers_by_month(transactions))
    off = F.abs(F.col("about") - F.col("unique_buyers")) <= F.col("unique_buyers") * F.lit(error_bound(lg_k))
    return exact.join(about, ["last_month", "months"], "left").select(
        "last_month", "months", "unique_buyers", F.coalesce(off, F.lit(False)).alias("within_error"))


def returning_buyers(sketches: DataFrame) -> DataFrame:
    """Per month with a month before it: about how many of that month's buyers
    bought again (retention, from an intersection of sketches)."""
    now = sketches.select(_month_number("month").alias("n"), "month", F.col("buyers").alias("now"))
    prior = sketches.select((_month_number("month") + 1).alias("n"), F.col("buyers").alias("prior"))
    both = F.theta_sketch_estimate(F.theta_intersection("now", "prior"))
    every = F.theta_sketch_estimate(F.theta_union("now", "prior"))
    return now.join(prior, "n").select("month", F.theta_sketch_estimate("prior").alias("buyers_before"),
                                       both.alias("returning_buyers"), every.alias("buyers_of_both"))


def returning_buyers_check(transactions: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """Exact returning buyers per month, and whether the sketches come within
    the stated error."""
    b = buyers_by_month(transactions).withColumn("n", _month_number("month"))
    prior = b.select((F.col("n") + 1).alias("n"), "user_id", F.lit(1).alias("again"))
    exact = (b.join(prior, ["n", "user_id"], "left").groupBy("month", "n").agg(F.count("again").alias("returning_buyers")))
    has_before = b.select((F.col("n") + 1).alias("n")).distinct()
    exact = exact.join(has_before, "n", "left_semi").drop("n")
    about = returning_buyers(buyer_sketches(transactions, lg_k)).select("month", F.col("returning_buyers").alias("about"), "buyers_of_both")
    off = F.abs(F.col("about") - F.col("returning_buyers")) <= F.col("buyers_of_both") * F.lit(error_bound(lg_k))
    return exact.join(about, "month", "left").select("month", "returning_buyers", F.coalesce(off, F.lit(False)).alias("within_error"))
