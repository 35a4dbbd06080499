"""Data-quality jobs built from the data model's own rules (G3-G6).

* ``invoice_check``: line subtotal = round(quantity * unit price, 2),
  transaction subtotal = sum of its lines, total = round(subtotal - discount, 2).
* ``stock_ledger``: exported stock is what is left after the sales, so the
  opening stock is current stock + units sold.
* ``key_and_domain_check``: dangling keys and values outside the
  vocabularies, as one report.
* ``price_changes`` / ``price_check``: the price time line of each product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.domains import (
    CONVERSION_STATUSES, DEVICE_TYPES, PAYMENT_METHODS, REFERRERS, TRANSACTION_STATUSES,
)
from mercato.functions.exprs import cents, from_cents, half_up, half_up_signed, ratio
from mercato.functions.ordered import with_neighbours


def invoice_check(transactions: DataFrame, items: DataFrame) -> DataFrame:
    """Transactions that break an invoice rule, with the failing parts.
    Lines are summed per transaction with map-side combine; comparisons are
    on whole cents."""
    line_ok = cents(half_up(F.col("quantity") * F.col("unit_price"), 2)) == cents("subtotal")
    per_txn = items.groupBy("transaction_id").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum(F.when(line_ok, 0).otherwise(1)).cast("long").alias("bad_items"),
        F.sum(cents("subtotal")).alias("_lines"))
    t = transactions.join(per_txn, "transaction_id", "left")
    lines = F.coalesce(F.col("_lines"), F.lit(0).cast("long"))
    disc = F.coalesce(F.col("discount"), F.lit(0.0))
    subtotal_ok = F.coalesce(cents("subtotal") == lines, F.lit(False))
    total_ok = F.coalesce(cents(half_up(F.col("subtotal") - disc, 2)) == cents("total"), F.lit(False))
    out = t.select(
        "transaction_id",
        F.coalesce(F.col("n_items"), F.lit(0).cast("long")).alias("n_items"),
        F.coalesce(F.col("bad_items"), F.lit(0).cast("long")).alias("bad_items"),
        from_cents(lines).alias("items_subtotal"),
        "subtotal", "discount", "total",
        subtotal_ok.alias("subtotal_ok"), total_ok.alias("total_ok"))
    return out.where((F.col("bad_items") > 0) | ~F.col("subtotal_ok") | ~F.col("total_ok"))


def stock_ledger(products: DataFrame, items: DataFrame) -> DataFrame:
    """Per product: current stock, units sold (all statuses) and the opening
    stock they imply."""
    sold = items.groupBy("product_id").agg(F.sum("quantity").alias("_sold"))
    j = products.select("product_id", "current_stock").join(sold, "product_id", "left")
    units = F.coalesce(F.col("_sold"), F.lit(0).cast("long"))
    return j.select("product_id", "current_stock", units.alias("units_sold"),
                    (F.col("current_stock") + units).alias("opening_stock"))


def _orphans(df: DataFrame, check: str, key: str) -> DataFrame:
    return (df.groupBy(F.col(key).cast("string").alias("value"))
              .agg(F.count(F.lit(1)).alias("n_rows"))
              .select(F.lit(check).alias("check_name"), "value", "n_rows"))


def _outside(col, domain):
    c = F.col(col) if isinstance(col, str) else col
    return c.isNull() | ~c.isin(*domain)


def _domain_checks(df: DataFrame, checks) -> DataFrame:
    """All vocabulary checks of one table in a single scan: each row yields
    the (check, value) pairs it fails, which are then counted."""
    fails = F.array(*[F.when(_outside(col, domain),
                             F.struct(F.lit(name).alias("check_name"),
                                      (F.col(col) if isinstance(col, str) else col)
                                      .cast("string").alias("value")))
                      for name, col, domain in checks])
    return (df.select(F.explode(F.filter(fails, lambda x: x.isNotNull())).alias("f"))
              .groupBy("f.check_name", "f.value").agg(F.count(F.lit(1)).alias("n_rows")))


def _unplaced(df: DataFrame, check: str, *needed: str) -> DataFrame:
    """How many rows miss a column without which an ordered scan skips them."""
    misses = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in needed])
    return (df.select(F.explode(F.array_compact(misses)).alias("value"))
            .groupBy("value").agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.lit(check).alias("check_name"), "value", "n_rows"))


def key_and_domain_check(transactions: DataFrame, items: DataFrame, users: DataFrame,
                         products: DataFrame, sessions: DataFrame, events: DataFrame | None = None,
                         price_points: DataFrame | None = None) -> DataFrame:
    """(check_name, value, n_rows) for: transactions of unknown users, items
    of unknown products, transactions of unknown sessions (a NULL session is
    allowed), and status / payment / outcome / referrer / device values
    outside their vocabularies.  Anti joins plus grouped counts; one scan
    per table for the vocabularies.  With ``events`` and ``price_points``
    also the rows that no session or price time line can hold
    (``unplaced_event``: user_id or ts missing, ``unplaced_price``:
    product_id or date missing)."""
    parts = [
        _orphans(transactions.join(users.select("user_id"), "user_id", "left_anti"),
                 "orphan_user", "user_id"),
        _orphans(items.join(products.select("product_id"), "product_id", "left_anti"),
                 "orphan_product", "product_id"),
        _orphans(transactions.where(F.col("session_id").isNotNull())
                 .join(sessions.select("session_id"), "session_id", "left_anti"),
                 "orphan_session", "session_id"),
        _domain_checks(transactions, [("bad_status", "status", TRANSACTION_STATUSES),
                                      ("bad_payment_method", "payment_method", PAYMENT_METHODS)]),
        _domain_checks(sessions, [("bad_conversion_status", "conversion_status", CONVERSION_STATUSES),
                                  ("bad_referrer", "referrer", REFERRERS),
                                  ("bad_device_type", F.col("device_profile.type"), DEVICE_TYPES)]),
    ]
    if events is not None:
        parts.append(_unplaced(events, "unplaced_event", "user_id", "ts"))
    if price_points is not None:
        parts.append(_unplaced(price_points, "unplaced_price", "product_id", "date"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def price_points_from_products(products: DataFrame) -> DataFrame:
    """Flat (product_id, date, price) rows of the embedded price histories."""
    return (products.select("product_id", F.explode("price_history").alias("p"))
            .select("product_id", F.col("p.date").alias("date"), F.col("p.price").alias("price")))


def price_changes(points: DataFrame, bucket_seconds: int = 30 * 86400) -> DataFrame:
    """One row per price change of each product (its first price included):
    date, price, previous price and the change in % (2 places, half away
    from zero).  Points are ordered by (date, price); those without a date
    are counted by ``key_and_domain_check``.  The per-product scan is split
    on (product, 30-day bucket), and a heavy bucket again, so a product sold
    in a third of all line items still spreads over many tasks."""
    pts = points.select("product_id", "date", "price").where(F.col("date").isNotNull())
    d = with_neighbours(pts, "product_id", "date", "price", ["price"], bucket_seconds)
    prev = F.col("prev.price")
    d = d.where(F.col("prev").isNull() | (F.col("price") != prev))
    return d.select("product_id", "date", "price", prev.alias("prev_price"),
                    half_up_signed(ratio(F.col("price") - prev, prev) * F.lit(100.0), 2)
                    .alias("change_pct"))


def price_check(products: DataFrame, points: DataFrame) -> DataFrame:
    """Per product: does the list price equal the latest price of its time
    line to the cent, and the creation date its first date?"""
    last = points.groupBy("product_id").agg(
        F.max_by("price", F.struct("date", "price")).alias("latest_price"),
        F.min("date").alias("first_price_date"),
        F.count(F.lit(1)).alias("n_points"))
    j = products.select("product_id", "base_price", "creation_date").join(last, "product_id", "left")
    return j.select("product_id", "base_price", "latest_price", "n_points",
                    (cents("base_price") == cents("latest_price")).alias("price_matches"),
                    "creation_date", "first_price_date",
                    (F.col("creation_date") == F.col("first_price_date")).alias("date_matches"))
