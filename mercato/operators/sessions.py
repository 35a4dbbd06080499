"""Sessions from an event stream, and page-to-page transitions (G1, G2).

Sessions are cut per user where the gap between consecutive events reaches
``gap_seconds``.  The per-user ordered scan is split on (user, day) so that
a user with a third of all events still spreads over many tasks
(``mercato.functions.ordered``); the session aggregate is an ordinary
grouped aggregate with map-side combine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.exprs import half_up, ratio
from mercato.functions.ordered import assign_sessions

TWELVE_HOURS = 12 * 3600


def sessionize(events: DataFrame, user: str = "user_id", ts: str = "ts",
               tiebreak: str = "event_id", gap_seconds: int = TWELVE_HOURS,
               bucket_seconds: int = 86400, next_of: Sequence[str] = (),
               keep_bucket: bool = False) -> DataFrame:
    """Events plus ``session_seq`` / ``session_id`` (``"<user>-<seq>"``) and
    ``_us``; with ``next_of`` also ``next_<c>`` for the following event of the
    same session (NULL at a session's last event), with ``keep_bucket`` the
    bucket ``_b`` of the user's time line (for ``funnel.ordered_steps``)."""
    d = assign_sessions(events, user, ts, tiebreak, gap_seconds, bucket_seconds,
                        carry_next=next_of, keep_bucket=keep_bucket)
    d = d.withColumn("session_id", F.concat_ws("-", F.col(user).cast("string"),
                                               F.col("session_seq").cast("string")))
    if next_of:
        same = F.col("next").isNotNull() & (F.col("next._us") - F.col("_us") < F.lit(gap_seconds * 1_000_000))
        for c in next_of:
            d = d.withColumn(f"next_{c}", F.when(same, F.col(f"next.{c}")))
        d = d.drop("next")
    return d


def build_sessions(sessionized: DataFrame, user: str = "user_id", ts: str = "ts",
                   tiebreak: str = "event_id", event_type: str = "event_type",
                   convert_types: Sequence[str] = ("purchase",),
                   cart_types: Sequence[str] = ("click",),
                   first_of: Sequence[str] = ()) -> DataFrame:
    """One row per session: start/end, whole-second duration, event count,
    outcome (converted if any conversion event, else abandoned if anything
    went to the cart, else browsed) and the values of its first event.
    ``tiebreak`` is the order used by ``sessionize`` (kept for the API)."""
    et = F.col(event_type)
    aggs = [F.min(ts).alias("start_time"), F.max(ts).alias("end_time"),
            F.expr("(max(_us) - min(_us)) div 1000000").alias("duration_seconds"),
            F.count(F.lit(1)).alias("n_events"),
            F.max(et.isin(*convert_types)).alias("_conv"),
            F.max(et.isin(*cart_types)).alias("_cart")]
    # exactly one row per session opens it: take the first values there, with
    # a plain max that keeps the aggregate hash-based
    aggs += [F.max(F.when(F.col("_is_start"), F.col(c))).alias(f"first_{c}") for c in first_of]
    s = sessionized.groupBy(user, "session_seq").agg(*aggs)
    status = (F.when(F.col("_conv"), "converted")
               .when(F.col("_cart"), "abandoned").otherwise("browsed"))
    return (s.withColumn("conversion_status", status)
             .withColumn("session_id", F.concat_ws("-", F.col(user).cast("string"),
                                                   F.col("session_seq").cast("string")))
             .drop("_conv", "_cart"))


def session_products(sessionized: DataFrame, product: str = "product_id", user: str = "user_id",
                     event_type: str = "event_type", view_types: Sequence[str] = ("view",),
                     cart_types: Sequence[str] = ("click",), quantity: str | None = None) -> DataFrame:
    """Flat form of a session's viewed products and cart, for events that
    carry a product: one row per (session, product) with whether it was
    viewed and the quantity put into the cart (1 for each cart event unless
    ``quantity`` names a column).  Products neither viewed nor in the cart
    have no row."""
    et = F.col(event_type)
    qty = F.coalesce(F.col(quantity), F.lit(0)) if quantity else F.lit(1)
    g = sessionized.where(F.col(product).isNotNull()).groupBy(user, "session_id", product).agg(
        F.max(F.coalesce(et.isin(*view_types), F.lit(False))).alias("viewed"),
        F.sum(F.when(et.isin(*cart_types), qty).otherwise(0)).cast("long").alias("cart_quantity"))
    return g.where(F.col("viewed") | (F.col("cart_quantity") > 0))


def cart_outcomes(sessionized: DataFrame, product: str = "product_id", user: str = "user_id",
                  event_type: str = "event_type", view_types: Sequence[str] = ("view",),
                  cart_types: Sequence[str] = ("click",), convert_types: Sequence[str] = ("purchase",),
                  quantity: str = "quantity") -> DataFrame:
    """One row per session of events that carry a product: how many products
    were viewed, how many are in the cart and with how many units, and the
    outcome by the cart.

    A session is converted if something was ever put into its cart and a
    conversion event came; abandoned if something was put into the cart;
    else browsed.  The outcome looks at the cart before entries without a
    positive quantity are removed (a cart event of quantity 0 or NULL makes a
    session abandoned), the cart's products and units after.  Events are first
    summed per (session, product), so a session of any length is combined in
    every task; events without a product count for the conversion only."""
    et = F.col(event_type)
    is_cart = et.isin(*cart_types) & F.col(product).isNotNull()
    entry = sessionized.groupBy(user, "session_id", product).agg(
        F.max(F.coalesce(et.isin(*view_types) & F.col(product).isNotNull(), F.lit(False))).alias("_viewed"),
        F.max(F.coalesce(is_cart, F.lit(False))).alias("_in_cart"),
        F.max(F.coalesce(et.isin(*convert_types), F.lit(False))).alias("_converts"),
        F.sum(F.when(is_cart, F.coalesce(F.col(quantity), F.lit(0))).otherwise(0)).cast("long").alias("_units"))
    kept = F.col("_units") > 0
    s = entry.groupBy(user, "session_id").agg(
        F.count(F.when(F.col("_viewed"), 1)).alias("viewed_products"), F.count(F.when(kept, 1)).alias("cart_products"),
        F.sum(F.when(kept, F.col("_units")).otherwise(0)).cast("long").alias("cart_units"),
        F.max("_in_cart").alias("_cart"), F.max("_converts").alias("_conv"))
    status = F.when(F.col("_cart") & F.col("_conv"), "converted").when(F.col("_cart"), "abandoned").otherwise("browsed")
    return s.withColumn("conversion_status", status).drop("_cart", "_conv")


def page_transitions(page_views: DataFrame, page: str = "page_type",
                     next_page: str = "next_page_type") -> DataFrame:
    """Step matrix: how often each page is followed by each next page within a
    session, and that step's share of all steps leaving the page (4 places).
    The share window runs over the tiny aggregated matrix only."""
    steps = (page_views.where(F.col(next_page).isNotNull())
             .groupBy(F.col(page).alias("from_page"), F.col(next_page).alias("to_page"))
             .agg(F.count(F.lit(1)).alias("transitions")))
    out = Window.partitionBy("from_page")
    return (steps.withColumn("share", half_up(ratio(F.col("transitions"),
                                                    F.sum("transitions").over(out)), 4))
                 .orderBy("from_page", F.desc("transitions"), "to_page"))


def page_views_from_sessions(sessions: DataFrame) -> DataFrame:
    """Flat page views of nested session documents, with the next page of the
    same session.  Each session is one row, so the pairing is done with array
    functions inside that row: no shuffle and no window."""
    pv = F.col("page_views")
    nxt = F.transform(F.sequence(F.lit(1), F.size(pv)),
                      lambda i: F.struct(i.alias("pos"),
                                         F.element_at(pv, i).alias("pv"),
                                         F.try_element_at(pv, i + 1)["page_type"].alias("next_page_type")))
    return (sessions.where(F.size(pv) > 0)
            .select("session_id", "user_id", F.explode(nxt).alias("e"))
            .select("session_id", "user_id", F.col("e.pos").alias("position"),
                    F.col("e.pv.timestamp").alias("timestamp"),
                    F.col("e.pv.page_type").alias("page_type"),
                    F.col("e.pv.product_id").alias("product_id"),
                    F.col("e.next_page_type").alias("next_page_type")))


def session_check(sessions: DataFrame) -> DataFrame:
    """Nested session documents that break a rule of the session model, with
    one flag per rule (all checks are array functions inside the row: no
    shuffle, no window):

    * ``viewed_ok``: viewed_products is the set of products of its
      product-detail page views;
    * ``duration_ok``: duration_seconds equals end - start;
    * ``cart_ok``: no cart entry has a quantity <= 0 (zero-quantity entries
      are removed on export);
    * ``outcome_ok``: a converted session has something in its cart and
      reached checkout or confirmation; a browsed one has an empty cart.  An
      abandoned session may show an empty cart, because its outcome was
      decided before the zero-quantity entries were removed.
    """
    pv = F.coalesce(F.col("page_views"), F.array())
    detail = F.filter(pv, lambda p: (p["page_type"] == "product_detail") & p["product_id"].isNotNull())
    seen = F.array_sort(F.array_distinct(F.transform(detail, lambda p: p["product_id"])))
    viewed = F.array_sort(F.array_distinct(F.coalesce(F.col("viewed_products"), F.array())))
    cart = F.coalesce(F.col("cart_contents"), F.create_map())
    n_cart = F.size(F.map_keys(cart))
    bad_qty = F.exists(F.map_values(cart), lambda v: F.coalesce(v["quantity"], F.lit(0)) <= 0)
    reached = F.exists(pv, lambda p: p["page_type"].isin("checkout", "confirmation"))
    start, end = F.try_to_timestamp(F.col("start_time")), F.try_to_timestamp(F.col("end_time"))
    span = (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000)
    status = F.col("conversion_status")
    out = sessions.select(
        "session_id", "user_id", "conversion_status",
        (viewed == seen).alias("viewed_ok"),
        F.coalesce(span == F.col("duration_seconds"), F.lit(False)).alias("duration_ok"),
        (~bad_qty).alias("cart_ok"),
        F.when(status == "converted", (n_cart > 0) & reached)
         .when(status == "browsed", n_cart == 0)
         .otherwise(F.lit(True)).alias("outcome_ok"))
    return out.where(~(F.col("viewed_ok") & F.col("duration_ok") & F.col("cart_ok")
                       & F.col("outcome_ok")))
