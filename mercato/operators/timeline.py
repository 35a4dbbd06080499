"""Prices and stock at the time of sale (rules G3, G4 and G6 on time lines).

* ``price_at_sale``: a line is sold at the list price of its moment, the
  latest price point at or before the sale, not at today's price.
* ``stock_timeline``: a sale needs stock.  The running stock of each product,
  its lowest point, and the first movement that the stock did not cover.

Both run on per-product time lines that are cut into buckets
(``mercato.functions.ordered``), so a product with a third of all lines is
spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.exprs import cents, half_up_signed, ratio
from mercato.functions.ordered import as_of, running_low


def price_at_sale(items: DataFrame, price_list: DataFrame, sold_at: str = "timestamp",
                  bucket_seconds: int = 30 * 86400) -> DataFrame:
    """Each line with the list price valid when it was sold.

    ``price_list`` holds (product_id, date, price); of several prices with one
    date the highest counts.  Adds ``list_price`` and ``list_price_since``
    (NULL before the product's first price, and for lines without a product or
    a time), ``price_ok`` (equal to the cent; NULL without a list price) and
    ``deviation_pct`` of the unit price (2 places, half away from zero).
    """
    points = price_list.select("product_id", "date", "price").where(F.col("price").isNotNull())
    lines = items.select("transaction_id", "line_number", "product_id", F.col(sold_at).alias("sold_at"), "unit_price")
    d = as_of(lines, points, "product_id", "sold_at", "date", ["price", "date"], ["price"], bucket_seconds)
    price = F.col("as_of.price")
    return d.select(*lines.columns, price.alias("list_price"), F.col("as_of.date").alias("list_price_since"),
                    (cents("unit_price") == cents(price)).alias("price_ok"),
                    half_up_signed(ratio(F.col("unit_price") - price, price) * F.lit(100.0), 2).alias("deviation_pct"))


def stock_timeline(opening: DataFrame, movements: DataFrame, bucket_seconds: int = 30 * 86400) -> DataFrame:
    """One row per product of ``opening`` (product_id, opening_stock).

    ``movements`` are (product_id, timestamp, transaction_id, line_number,
    quantity): negative for goods that leave, positive for goods that come in,
    in (timestamp, transaction_id, line_number, quantity) order; rows without
    a product or a time have no place on a time line.  The first oversold sale
    is the first movement after which the stock would be below zero; up to it,
    running stock is what a shop that refuses such sales would have seen.
    Only the bucket in which a product runs out is looked at row by row: where
    that is, follows from the buckets' sums and lowest prefixes.
    """
    order = ["transaction_id", "line_number", "quantity"]
    q = F.col("quantity")
    rows, buckets = running_low(
        movements.where(q.isNotNull()), "product_id", "timestamp", order, "quantity", bucket_seconds,
        [F.count(F.lit(1)).alias("_n"), F.sum(F.when(q < 0, -q).otherwise(0)).alias("_out"),
         F.sum(F.when(q > 0, q).otherwise(0)).alias("_in")])
    stock = opening.select("product_id", "opening_stock")
    buckets = buckets.join(stock, "product_id")
    lowest = F.col("opening_stock") + F.col("_before") + F.col("_low")
    short = F.when(lowest < 0, F.struct(F.col("_b"), F.col("_before")))
    per = buckets.groupBy("product_id").agg(
        F.sum("_n").alias("n_movements"), F.sum("_out").alias("units_out"), F.sum("_in").alias("units_in"),
        F.min(lowest).alias("_lowest"), F.min(short).alias("_short"))
    at = per.where(F.col("_short").isNotNull()).select("product_id", F.col("_short._b").alias("_b"), F.col("_short._before").alias("_before"))
    left = F.col("opening_stock") + F.col("_before") + F.col("_lp")
    first = (rows.join(at, ["product_id", "_b"]).join(stock, "product_id").where(left < 0)
             .groupBy("product_id").agg(F.min_by(
                 F.struct(F.col("timestamp").alias("at"), "transaction_id", "line_number", (-left).alias("missing")),
                 F.struct("_us", *order)).alias("_f")))
    zero = F.lit(0).cast("long")
    n = lambda c: F.coalesce(F.col(c), zero)
    return (stock.join(per, "product_id", "left").join(first, "product_id", "left").select(
        "product_id", "opening_stock", n("n_movements").alias("n_movements"), n("units_out").alias("units_out"),
        n("units_in").alias("units_in"), (F.col("opening_stock") - n("units_out") + n("units_in")).alias("closing_stock"),
        F.least("opening_stock", F.coalesce("_lowest", "opening_stock")).alias("lowest_stock"),
        F.col("_f.at").alias("oversold_at"), F.col("_f.transaction_id").alias("oversold_transaction"),
        F.col("_f.line_number").alias("oversold_line"), F.col("_f.missing").alias("units_missing")))
