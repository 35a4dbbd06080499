"""Purchase summaries as mergeable states (A9, A10).

A summary cannot be merged with another one (its favourite category is a
choice, its average a quotient), a state can: per user the order count, the
sum of totals in cents and the latest purchase, and per user and category the
quantity.  States of disjoint batches of transactions merge by sums and maxima,
in any order, so a refresh reads the new batch and the states it touches and
not all transactions (``plans.jobs.refresh_summary``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.exprs import as_timestamp, cents, from_cents
from mercato.operators.enrich import product_lookup

#: A header row has no category; a category row has a quantity only.
STATE = ["user_id", "is_header", "category_id", "orders", "total_cents", "last_purchase_date", "quantity"]


def purchase_states(transactions: DataFrame, items: DataFrame, products: DataFrame, partitions: int | None = None) -> DataFrame:
    """States of one batch: ``transactions`` and their line ``items`` (with
    ``user_id``).  Lines of unknown products count for no category; the
    category is the one a product has when its batch is applied.  ``partitions``
    fixes in how many parts the lines meet their products, for batches that
    would give a task too much otherwise."""
    t = transactions.withColumn("timestamp", as_timestamp(transactions, "timestamp"))
    look = product_lookup(products, "category_id")
    none = F.lit(None).cast("long")
    kind = look.schema["category_id"].dataType
    head = t.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(cents("total")).alias("total_cents"), F.max("timestamp").alias("last_purchase_date"))
    head = head.select("user_id", F.lit(True).alias("is_header"), F.lit(None).cast(kind).alias("category_id"), "orders",
                       "total_cents", "last_purchase_date", none.alias("quantity"))
    lines = items.select("user_id", "product_id", F.col("quantity").cast("long").alias("quantity"))
    if partitions:
        lines = lines.repartition(partitions, "product_id")
    qty = (lines.join(look, "product_id")
           .groupBy("user_id", "category_id").agg(F.sum("quantity").alias("quantity")))
    when = head.schema["last_purchase_date"].dataType
    return head.unionByName(qty.select(
        "user_id", F.lit(False).alias("is_header"), "category_id", none.alias("orders"), none.alias("total_cents"),
        F.lit(None).cast(when).alias("last_purchase_date"), "quantity"))


def merge_states(*states: DataFrame, partitions: int | None = None) -> DataFrame:
    """One state from those of disjoint batches (associative, any order).
    ``partitions`` deals users to that many parts, which a summary keeps; a
    user has a row a batch and category there, so none is large."""
    every = reduce(DataFrame.unionByName, [s.select(*STATE) for s in states])
    if partitions:
        every = every.repartition(partitions, "user_id")
    merged = every.groupBy("user_id", "is_header", "category_id").agg(
        F.sum("orders").alias("orders"), F.sum("total_cents").alias("total_cents"),
        F.max("last_purchase_date").alias("last_purchase_date"), F.sum("quantity").alias("quantity"))
    return merged.select(*STATE)


def summary_of(states: DataFrame) -> DataFrame:
    """``enrich.purchase_summary`` from merged states; of categories with one
    quantity the smallest id is the favourite; orders without a user have
    none."""
    head = lambda c: F.max(F.when(F.col("is_header"), F.col(c)))
    place = F.when(~F.col("is_header"), F.struct((-F.col("quantity")).alias("q"), F.col("category_id")))
    return (states.groupBy("user_id").agg(
        head("orders").alias("total_orders"), from_cents(head("total_cents")).alias("total_spent"),
        head("last_purchase_date").alias("last_purchase_date"), F.when(F.col("user_id").isNotNull(), F.min_by("category_id", place)).alias("favorite_category"))
        .where(F.col("total_orders").isNotNull()))
