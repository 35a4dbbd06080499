"""Reconciliation of two multisets of lines: what was put into carts against
what was ordered, or orders against their lines (rules of G3 and G5).

Both sides are summed into one table with signed columns, so the comparison is
a single grouped aggregate with map-side combine: a hot product or session is
combined in every task, NULL keys are a group like any other, and neither
side is joined to the other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], quantity: str = "quantity",
              names: tuple[str, str] = ("left", "right")) -> DataFrame:
    """One row per key on which the sides differ: line counts, quantities and
    the class of the difference.

    * ``only_<left>`` / ``only_<right>``: no line on the other side;
    * ``quantity``: both have lines, their quantities differ;
    * ``split``: equal quantities in different numbers of lines.

    A NULL quantity counts as 0 in the sums; equal keys agree also when NULL.
    """
    a, b = names

    def side(df: DataFrame, at: int) -> DataFrame:
        q = F.coalesce(F.col(quantity), F.lit(0)).cast("long")
        zero = F.lit(0).cast("long")
        return df.select(*keys, *[x for i in (0, 1) for x in (
            (q if i == at else zero).alias(f"_q{i}"), F.lit(1 if i == at else 0).cast("long").alias(f"_n{i}"))])

    sums = side(left, 0).unionByName(side(right, 1)).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("_n0", "_n1", "_q0", "_q1")])
    kind = (F.when(F.col("_n1") == 0, f"only_{a}").when(F.col("_n0") == 0, f"only_{b}")
            .when(F.col("_q0") != F.col("_q1"), "quantity").when(F.col("_n0") != F.col("_n1"), "split"))
    return (sums.withColumn("difference", kind).where(F.col("difference").isNotNull())
            .select(*keys, F.col("_n0").alias(f"{a}_lines"), F.col("_n1").alias(f"{b}_lines"),
                    F.col("_q0").alias(f"{a}_quantity"), F.col("_q1").alias(f"{b}_quantity"), "difference"))


def difference_counts(differences: DataFrame) -> DataFrame:
    """How many keys differ in which way."""
    return differences.groupBy("difference").agg(F.count(F.lit(1)).alias("n_keys")).orderBy("difference")


def cart_lines(sessions: DataFrame) -> DataFrame:
    """(session_id, product_id, quantity) of the carts of converted session
    documents; entries without a positive quantity are no lines."""
    return (sessions.where(F.col("conversion_status") == "converted")
            .select("session_id", F.explode("cart_contents").alias("product_id", "entry"))
            .select("session_id", "product_id", F.col("entry.quantity").alias("quantity"))
            .where(F.col("quantity") > 0))


def order_lines(transactions: DataFrame) -> DataFrame:
    """(session_id, product_id, quantity) of transaction documents that came
    from a session."""
    return (transactions.where(F.col("session_id").isNotNull())
            .select("session_id", F.explode("items").alias("item"))
            .select("session_id", F.col("item.product_id").alias("product_id"), F.col("item.quantity").alias("quantity")))


def carts_against_orders(sessions: DataFrame, transactions: DataFrame) -> DataFrame:
    """Differences between the carts of converted sessions and the orders that
    name the session, by (session, product).  Not every converted session has
    an order (the stock may not cover it): such carts are ``only_cart``."""
    return reconcile(cart_lines(sessions), order_lines(transactions), ["session_id", "product_id"], names=("cart", "order"))
