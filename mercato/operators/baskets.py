"""Enriched transactions as documents: baskets nested in order, in numbered
parts of bounded length (A11).

A document store holds one basket in one array.  A basket of any size in one
row would be an unbounded group in one task, so a basket comes as one row per
part of at most ``part_size`` lines; most transactions have one part.  A
transaction without lines has one part with an empty array.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.exprs import as_timestamp
from mercato.operators.enrich import enrich_items

PART_SIZE = 1000
ITEM = ["line_number", "product_id", "product_name", "category_id", "quantity", "unit_price", "subtotal"]


def nest_transactions(transactions: DataFrame, items: DataFrame, products: DataFrame, part_size: int = PART_SIZE) -> DataFrame:
    """Transactions with ``part`` (from 1), ``n_parts`` and ``items``, an array
    of enriched lines in order (line number, then the other fields); parts in
    order give the basket.

    Lines are first dealt to pieces of ``part_size`` line numbers, so where
    line numbers are distinct no window sees more than a part; pieces that
    hold more, because numbers repeat or are missing, are cut again.
    """
    t = transactions.withColumn("timestamp", as_timestamp(transactions, "timestamp"))
    lines = enrich_items(items.select("transaction_id", "line_number", "product_id", "quantity", "unit_price", "subtotal"), products)
    lines = lines.withColumn("_piece", F.floor((F.col("line_number") - 1) / part_size))
    piece = Window.partitionBy("transaction_id", "_piece").orderBy(*ITEM)
    lines = lines.withColumn("_cut", F.floor((F.row_number().over(piece) - 1) / part_size))
    parts = lines.groupBy("transaction_id", "_piece", "_cut").agg(F.sort_array(F.collect_list(F.struct(*ITEM))).alias("items"))
    whole = Window.partitionBy("transaction_id")  # one row a part
    parts = (parts.withColumn("part", F.row_number().over(whole.orderBy("_piece", "_cut")))
             .withColumn("n_parts", F.count(F.lit(1)).over(whole)).drop("_piece", "_cut"))
    basket = t.drop("items").join(parts, "transaction_id", "left")
    empty = F.array().cast(parts.schema["items"].dataType)
    return basket.select(*[c for c in t.columns if c != "items"], F.coalesce("part", F.lit(1)).alias("part"),
                         F.coalesce("n_parts", F.lit(1).cast("long")).alias("n_parts"), F.coalesce("items", empty).alias("items"))


def unnest_transactions(nested: DataFrame) -> DataFrame:
    """The flat lines of nested transactions, with ``position`` in their part;
    ordered by (part, position) they are the basket."""
    return (nested.select("transaction_id", "part", F.posexplode("items").alias("position", "item"))
            .select("transaction_id", "part", "position", "item.*"))
