"""The driver's TPC-H-style tables seen as the e-commerce data model.

| view          | from                                                      |
|---------------|-----------------------------------------------------------|
| users         | customer + nation (country) + region (state); first/last order date as registration / last activity |
| products      | part: brand = category, type = subcategory, size = stock  |
| categories    | distinct brand with the set of its types                  |
| transactions  | orders (header only; F/O/P -> completed/processing/shipped) |
| txn_items     | lineitem joined to its order (one row per line item)      |
| price_points  | distinct (part, ship date, unit price) of line items      |
| price_list    | distinct (part, ship date, unit price) of the first line of each order |
| invoiced_lines | line items with missing, changed, cut and renamed ones by rule |
| movements     | line items leaving the stock when shipped, returned ones coming back 30 days later |
| invoices      | orders with a discount from their lines' l_discount; the subtotal is the lines' sum, and the total net of the discount, for most order numbers by rule |
| checked_*, listed_products | the tables with rows by rule that break each check, and products that keep and break the price rules |
| raw_*         | users, products and transactions with repeated and unusable rows added by rule, for the cleaners |
| page_views    | events with their session and the next event of it        |
| sessions      | sessions cut from events at 12-hour gaps                  |

Line items stay flat: the nested basket of a document is only a transport
format, and re-nesting then exploding it again would cost a shuffle of the
largest table for nothing.  Every view is lazy; nothing is read until an
operator's result is used.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.functions.domains import DEVICE_TYPES, REFERRERS
from mercato.functions.exprs import cents, from_cents, half_up, money_sum
from mercato.operators.sessions import TWELVE_HOURS, build_sessions, sessionize

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

# Order status letters of the driver tables.
STATUS_BY_LETTER = {"F": "completed", "O": "processing", "P": "shipped"}


#: Bytes of line item files that make a partition of what is joined by key;
#: tables of fewer than ``LEAST_PARTS`` such parts are left to adaptive execution.
PART_BYTES, LEAST_PARTS = 8 << 20, 8

# Explicit schemas of the driver tables used here (no footer inference).
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _status(col: str):
    expr = None
    for letter, status in STATUS_BY_LETTER.items():
        expr = (F.when(F.col(col) == letter, status) if expr is None
                else expr.when(F.col(col) == letter, status))
    return expr


def _pick(values: list[str], index):
    expr = None
    for i, v in enumerate(values):
        expr = F.when(index == i, v) if expr is None else expr.when(index == i, v)
    return expr


class DriverTables:
    """Lazily built views over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, gap_seconds: int = TWELVE_HOURS):
        self.spark, self.sf_dir, self.gap_seconds = spark, sf_dir, gap_seconds
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """The table, read once per instance (the file listing and Parquet
        footer are resolved on the driver at every read)."""
        if name not in self._raw:
            self._raw[name] = read_table(self.spark, self.sf_dir, name)
        return self._raw[name]

    def parts(self) -> int | None:
        """How many partitions the line items should have, from the size of
        their files (no job), so that a task's share does not grow with the
        table; None if the table is small."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(os.path.join(self.sf_dir, "lineitem.parquet"))
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        n = files.getContentSummary(path).getLength() // PART_BYTES
        return n if n >= LEAST_PARTS else None

    # -- users ---------------------------------------------------------
    def users(self) -> DataFrame:
        geo = (self.raw("nation").join(self.raw("region"),
                                       F.col("n_regionkey") == F.col("r_regionkey"), "left")
               .select("n_nationkey", F.col("n_name").alias("country"),
                       F.col("r_name").alias("state")))
        span = (self.raw("orders").groupBy("o_custkey")
                .agg(F.min("o_orderdate").alias("registration_date"),
                     F.max("o_orderdate").alias("last_active")))
        c = self.raw("customer").select("c_custkey", "c_nationkey")
        return (c.join(geo, c.c_nationkey == geo.n_nationkey, "left")
                 .join(span, c.c_custkey == span.o_custkey, "left")
                 .select(F.col("c_custkey").alias("user_id"),
                         F.struct(F.lit(None).cast("string").alias("city"),
                                  F.col("state"), F.col("country")).alias("geo_data"),
                         "registration_date", "last_active"))

    # -- catalogue -----------------------------------------------------
    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"),
            F.col("p_brand").alias("category_id"), F.col("p_type").alias("subcategory_id"),
            F.col("p_retailprice").alias("base_price"),
            F.col("p_size").cast("long").alias("current_stock"),
            (F.col("p_size") > 1).alias("is_active"),
            F.lit(None).cast("timestamp_ntz").alias("creation_date"))

    def categories(self) -> DataFrame:
        sub = F.struct(F.col("p_type").alias("subcategory_id"), F.col("p_type").alias("name"),
                       F.lit(None).cast("double").alias("profit_margin"))
        return (self.raw("part").groupBy(F.col("p_brand").alias("category_id"))
                .agg(F.array_sort(F.collect_set(sub)).alias("subcategories"))
                .select("category_id", F.col("category_id").alias("name"), "subcategories"))

    def price_points(self) -> DataFrame:
        li = self.raw("lineitem")
        return (li.select(F.col("l_partkey").alias("product_id"),
                          F.col("l_shipdate").alias("date"),
                          (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
                  .distinct())

    def price_list(self) -> DataFrame:
        """Prices set by the first line of an order, from its ship date on."""
        li = self.raw("lineitem").where(F.col("l_linenumber") == 1)
        return li.select(F.col("l_partkey").alias("product_id"), F.col("l_shipdate").alias("date"),
                         half_up(F.col("l_extendedprice") / F.col("l_quantity")).alias("price")).distinct()

    def shipped_lines(self) -> DataFrame:
        """Line items sold when they were shipped."""
        return self.lines(F.col("l_shipdate").alias("timestamp"))

    def invoiced_lines(self) -> DataFrame:
        """Line items as invoiced: by rule some are missing, some have another
        quantity, some are cut in two or stand for another product."""
        li, id_ = self.lines(), F.col("transaction_id")
        q = F.col("quantity")
        cut = F.when((id_ % 13 == 0) & (q > 1), F.array(q - 1, F.lit(1).cast("long"))).when(
            id_ % 11 == 0, F.array(q + 1)).otherwise(F.array(q))
        return (li.where((id_ % 17 > 0) | (F.col("line_number") > 1)).withColumn("quantity", F.explode(cut))
                .withColumn("product_id", F.when(id_ % 19 == 0, -F.col("product_id")).otherwise(F.col("product_id"))))

    def opening_stock(self) -> DataFrame:
        """Twenty times the size of a part."""
        return self.raw("part").select(F.col("p_partkey").alias("product_id"),
                                       (F.col("p_size").cast("long") * 20).alias("opening_stock"))

    def movements(self) -> DataFrame:
        """Shipped lines leave the stock; returned ones are back 30 days later."""
        li = self.raw("lineitem").select(
            F.col("l_partkey").alias("product_id"), F.col("l_shipdate").alias("timestamp"),
            F.col("l_orderkey").alias("transaction_id"), F.col("l_linenumber").alias("line_number"),
            F.col("l_quantity").cast("long").alias("quantity"), "l_returnflag")
        legs = F.when(F.col("l_returnflag") == "R", F.array(F.lit(-1), F.lit(1))).otherwise(F.array(F.lit(-1)))
        d = li.withColumn("leg", F.explode(legs))
        back = F.col("timestamp") + F.expr("INTERVAL 30 DAYS")
        return d.select("product_id", F.when(F.col("leg") == 1, back).otherwise(F.col("timestamp")).alias("timestamp"),
                        "transaction_id", "line_number", (F.col("quantity") * F.col("leg")).alias("quantity"))

    # -- orders --------------------------------------------------------
    def transactions(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("transaction_id"),
            F.lit(None).cast("string").alias("session_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderdate").alias("timestamp"),
            F.col("o_totalprice").alias("subtotal"),
            F.lit(0.0).alias("discount"),
            F.col("o_totalprice").alias("total"),
            F.col("o_orderpriority").alias("payment_method"),
            _status("o_orderstatus").alias("status"))

    def lines(self, *more) -> DataFrame:
        """Line items without their order; the unit price in whole cents."""
        return self.raw("lineitem").select(
            *more,
            F.col("l_orderkey").alias("transaction_id"), F.col("l_linenumber").alias("line_number"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("long").alias("quantity"),
            half_up(F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
            F.col("l_extendedprice").alias("subtotal"))

    def txn_items(self) -> DataFrame:
        t = self.transactions().select("transaction_id", "user_id", "timestamp", "total",
                                       "payment_method", "status")
        li, n = self.lines(), self.parts()
        if n:  # as many partitions as the input needs, which the joins and groups by transaction after it keep
            li, t = li.repartition(n, "transaction_id"), t.repartition(n, "transaction_id")
        return (li.join(t, "transaction_id")
                  .select("transaction_id", "user_id", "timestamp", "total", "payment_method",
                          "status", "line_number", "product_id", "quantity", "unit_price", "subtotal"))

    def invoices(self) -> DataFrame:
        """Orders as invoices.  The discount is the sum of the lines'
        discounts.  So that every rule holds for some orders and fails for
        others, every fourth order keeps its order price as subtotal and every
        third its order price as total."""
        per = (self.raw("lineitem").groupBy("l_orderkey")
               .agg(money_sum("l_extendedprice").alias("lines"),
                    from_cents(F.sum(cents(F.col("l_extendedprice") * F.col("l_discount")))).alias("off")))
        t = self.transactions().drop("subtotal", "discount").join(per, F.col("transaction_id") == F.col("l_orderkey"), "left")
        t = t.withColumn("discount", F.coalesce("off", F.lit(0.0))).withColumn(
            "subtotal", F.when(F.col("transaction_id") % 4 == 0, F.col("total")).otherwise(F.col("lines")))
        return t.withColumn("total", F.when(F.col("transaction_id") % 3 == 0, F.col("total")).otherwise(
            half_up(F.col("subtotal") - F.col("discount")))).drop("lines", "off", "l_orderkey")

    # -- rows that break a rule, for the checks -----------------------------
    def checked_transactions(self) -> DataFrame:
        """Some orders of unknown users and sessions, some with a bad status."""
        id_, user = F.col("transaction_id"), F.col("user_id")
        return self.transactions().withColumns({
            "user_id": F.when(id_ % 997 == 0, -user).otherwise(user),
            "session_id": F.when(id_ % 50 == 0, F.concat((user % 200).cast("string"), F.lit("-1"))),
            "status": F.when(id_ % 101 == 0, "lost").otherwise(F.col("status"))})

    def checked_items(self) -> DataFrame:
        id_, product = F.col("transaction_id"), F.col("product_id")
        return self.lines().withColumn("product_id", F.when(id_ % 997 == 0, -product).otherwise(product))

    def checked_sessions(self) -> DataFrame:
        u, device = F.col("user_id"), F.col("device_profile")
        return self.sessions().withColumns({
            "referrer": F.when(u % 37 == 0, "fax").otherwise(F.col("referrer")),
            "conversion_status": F.when(u % 43 == 0, "maybe").otherwise(F.col("conversion_status")),
            "device_profile": device.withField("type", F.when(u % 41 == 0, "fridge").otherwise(device["type"]))})

    def checked_events(self) -> DataFrame:
        id_ = F.col("event_id")
        return self.raw("events").withColumns({"user_id": F.when(id_ % 89 > 0, F.col("user_id")), "ts": F.when(id_ % 83 > 0, F.col("ts"))})

    def checked_price_points(self) -> DataFrame:
        p = F.col("product_id")
        return self.price_points().withColumns({"product_id": F.when(p % 61 > 0, p), "date": F.when(p % 59 > 0, F.col("date"))})

    def listed_products(self) -> DataFrame:
        """Every third product is listed at its latest price; every fourth was
        created at its first one, the next a day before."""
        points = self.price_points().groupBy("product_id").agg(
            F.max_by("price", F.struct("date", "price")).alias("_last"), F.min("date").alias("_first"))
        p = F.col("product_id")
        return (self.products().join(points, "product_id", "left")
                .withColumn("base_price", F.when((p % 3 == 0) & F.col("_last").isNotNull(), half_up("_last")).otherwise(F.col("base_price")))
                .withColumn("creation_date", F.when(p % 4 == 0, F.col("_first")).when(p % 4 == 1, F.col("_first") - F.expr("INTERVAL 1 DAY")))
                .drop("_last", "_first"))

    # -- rows that a cleaner must drop or merge ---------------------------
    def raw_users(self) -> DataFrame:
        u = self.users()
        return (u.unionByName(u.where("user_id % 7 = 0").withColumn("registration_date", F.col("last_active")))
                 .unionByName(u.where("user_id % 11 = 0").withColumn("user_id", F.lit(None).cast("long"))))

    def raw_products(self) -> DataFrame:
        p = self.products()
        p = p.withColumn("current_stock", F.when(F.col("product_id") % 5 > 0, F.col("current_stock"))).withColumn(
            "is_active", F.when(F.col("product_id") % 6 > 0, F.col("is_active")))
        return (p.unionByName(p.where("product_id % 7 = 0").withColumn("base_price", F.col("base_price") - 1))
                 .unionByName(p.where("product_id % 11 = 0").withColumn("product_id", F.lit(None).cast("long"))))

    def raw_transactions(self) -> DataFrame:
        t = self.transactions()
        id_ = F.col("transaction_id")
        t = t.withColumn("discount", F.when(id_ % 5 > 0, F.col("discount"))).withColumn(
            "total", F.when(id_ % 13 == 0, -F.col("total")).when(id_ % 17 == 0, F.lit("NaN").cast("double"))
            .when(id_ % 11 > 0, F.col("total")))
        return t.unionByName(t.where("transaction_id % 7 = 0").withColumn("status", F.lit("delivered")))

    # -- behaviour -----------------------------------------------------
    def _events(self) -> DataFrame:
        return self.raw("events").select(
            "event_id", "ts", "user_id", "event_type",
            F.get_json_object("props", "$.k").cast("int").alias("k"))

    def session_events(self) -> DataFrame:
        return sessionize(self.raw("events").select("event_id", "ts", "user_id", "event_type"),
                          gap_seconds=self.gap_seconds, keep_bucket=True)

    def product_events(self) -> DataFrame:
        """Events on products, by rule: the product is ``props.k`` (none for
        every ninth event), the quantity the event number modulo 4."""
        id_ = F.col("event_id")
        e = self._events().withColumns({"product_id": F.when(id_ % 9 > 0, F.col("k")), "quantity": id_ % 4}).drop("k")
        return sessionize(e, gap_seconds=self.gap_seconds)

    def page_views(self) -> DataFrame:
        d = sessionize(self._events(), gap_seconds=self.gap_seconds, next_of=["event_type"])
        return d.select("session_id", "user_id", "event_id", "ts",
                        F.col("event_type").alias("page_type"),
                        F.col("next_event_type").alias("next_page_type"))

    def sessions(self) -> DataFrame:
        d = sessionize(self._events(), gap_seconds=self.gap_seconds)
        s = build_sessions(d, first_of=["k"])
        k = F.col("first_k")
        return s.select(
            "session_id", "user_id", "start_time", "end_time", "duration_seconds", "n_events",
            F.struct(_pick(DEVICE_TYPES, k % 3).alias("type"),
                     F.lit(None).cast("string").alias("os"),
                     F.lit(None).cast("string").alias("browser")).alias("device_profile"),
            _pick(REFERRERS, k % 5).alias("referrer"),
            "conversion_status")
