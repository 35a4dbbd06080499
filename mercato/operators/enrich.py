"""Enrichment: flat line items, catalogue names, per-user purchase summary
(A7-A11).

Lookups are plain joins; Spark's adaptive execution turns them into
broadcast joins only when the runtime size of the lookup side is below the
broadcast threshold, and keeps a shuffle join otherwise.  Lookup sides are
de-duplicated on their key first, so a left lookup never multiplies rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.exprs import as_timestamp, dedupe, half_up, money_sum

ITEM_HEADER = ["transaction_id", "user_id", "timestamp", "total", "payment_method", "status"]


def flatten_items(transactions: DataFrame) -> DataFrame:
    """One row per line item of nested transaction documents (inner unwind:
    transactions with an empty or NULL basket produce no row)."""
    head = [c for c in ITEM_HEADER if c in transactions.columns]
    return (transactions.select(*head, F.posexplode("items").alias("line_number", "item"))
            .select(*head, (F.col("line_number") + 1).alias("line_number"),
                    F.col("item.product_id").alias("product_id"),
                    F.col("item.quantity").alias("quantity"),
                    F.col("item.unit_price").alias("unit_price"),
                    F.col("item.subtotal").alias("subtotal")))


def product_lookup(products: DataFrame, *cols: str) -> DataFrame:
    """product_id -> cols, one row per product id (NULL ids removed)."""
    d = products.select("product_id", *cols).where(F.col("product_id").isNotNull())
    return dedupe(d, ["product_id"])


def enrich_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Add category_name and subcategory_name by left lookup.

    The subcategory is looked up by its own id across all categories (not
    inside the product's category); when an id appears under several
    categories, the entry of the greatest category_id wins.  Price-history
    dates and the creation date are parsed.
    """
    cats = dedupe(categories.select("category_id", F.col("name").alias("category_name"))
                  .where(F.col("category_id").isNotNull()), ["category_id"])
    subs = (categories.select("category_id", F.explode("subcategories").alias("s"))
            .groupBy(F.col("s.subcategory_id").alias("subcategory_id"))
            .agg(F.max_by(F.col("s.name"), F.col("category_id")).alias("subcategory_name"))
            .where(F.col("subcategory_id").isNotNull()))
    d = products.join(cats, "category_id", "left").join(subs, "subcategory_id", "left")
    if "price_history" in products.columns:
        ph_type = products.schema["price_history"].dataType.elementType["date"].dataType
        if ph_type.typeName() == "string":
            d = d.withColumn("price_history", F.transform(
                "price_history", lambda p: F.struct(p["price"].alias("price"),
                                                    F.try_to_timestamp(p["date"]).alias("date"))))
    d = d.withColumn("creation_date", as_timestamp(products, "creation_date"))
    lead = ["product_id", "name", "category_id", "category_name", "subcategory_id",
            "subcategory_name"]
    return d.select(*lead, *[c for c in products.columns if c not in lead])


def enrich_items(items: DataFrame, products: DataFrame) -> DataFrame:
    """Line items with product_name and category_id (NULL for unknown
    products); the item rows themselves are unchanged."""
    look = product_lookup(products, "name", "category_id").withColumnRenamed("name", "product_name")
    return items.join(look, "product_id", "left")


def enrich_transactions(transactions: DataFrame, items: DataFrame,
                        products: DataFrame) -> DataFrame:
    """Denormalised transactions, flat: one row per enriched line item,
    plus one row with NULL item fields for a transaction whose basket is
    empty (so no transaction is lost).  Timestamps are parsed.  ``items``
    needs no header columns: lines are moved once for the product lookup and
    once for the join with their transaction."""
    head = transactions.withColumn("timestamp", as_timestamp(transactions, "timestamp"))
    it = enrich_items(items.select("transaction_id", "line_number", "product_id", "quantity",
                                   "unit_price", "subtotal")
                           .withColumnRenamed("subtotal", "item_subtotal"), products)
    return head.join(it, "transaction_id", "left")


def purchase_summary(transactions: DataFrame, items: DataFrame,
                     products: DataFrame) -> DataFrame:
    """Per user over all transactions (any status): order count, exact sum of
    totals, latest purchase, and the favourite category (largest quantity
    bought; items of unknown products are skipped; ties -> smallest id).

    Both halves are per-user aggregates with map-side combine, so a user
    with a third of all orders is pre-combined in every task.
    """
    t = transactions.withColumn("timestamp", as_timestamp(transactions, "timestamp"))
    head = t.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        money_sum("total").alias("total_spent"),
        F.max("timestamp").alias("last_purchase_date"))
    cat = product_lookup(products, "category_id")
    qty = (items.select("user_id", "product_id", "quantity").join(cat, "product_id")
           .groupBy("user_id", "category_id").agg(F.sum("quantity").alias("qty")))
    fav = qty.groupBy("user_id").agg(
        F.min_by("category_id", F.struct((-F.col("qty")).alias("q"), F.col("category_id")))
         .alias("favorite_category"))
    return head.join(fav, "user_id", "left")


def enrich_users(users: DataFrame, summary: DataFrame) -> DataFrame:
    """Users with an embedded ``purchase_summary`` struct.  Users without
    orders get zeros, a NULL last purchase and a NULL favourite; money is
    rounded to cents, the average from the unrounded sum."""
    u = users.withColumns({c: as_timestamp(users, c) for c in ("registration_date", "last_active")
                           if c in users.columns})
    j = u.join(summary, "user_id", "left")
    has = F.coalesce(F.col("total_orders"), F.lit(0)) > 0
    ps = F.struct(
        F.when(has, F.col("total_orders")).otherwise(F.lit(0).cast("long")).alias("total_orders"),
        F.when(has, half_up("total_spent", 2)).otherwise(F.lit(0.0)).alias("total_spent"),
        F.when(has, half_up(F.col("total_spent") / F.col("total_orders"), 2))
         .otherwise(F.lit(0.0)).alias("avg_order_value"),
        F.when(has, F.col("last_purchase_date")).alias("last_purchase_date"),
        F.when(has, F.col("favorite_category")).alias("favorite_category"))
    return j.select(*u.columns, ps.alias("purchase_summary"))


def flatten_user_profile(users_enriched: DataFrame) -> DataFrame:
    """Flat columns of an enriched user (for reports and exports)."""
    return users_enriched.select(
        "user_id", F.col("geo_data.country").alias("country"),
        F.col("geo_data.state").alias("state"), "registration_date", "last_active",
        "purchase_summary.*")
