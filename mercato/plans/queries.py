"""One query per operator of the inventory, over the driver tables.

Each entry is ``(spark, sf_dir) -> DataFrame`` and reads whole tables.
Nested outputs (struct columns) are flattened so the result can be compared
value by value with the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.functions.exprs import cents
from mercato.operators import (
    baskets, buyers, charts, clean, clv, enrich, funnel, quality, reconcile, reports, states, timeline,
)
from mercato.operators.sessions import cart_outcomes, page_transitions
from mercato.sources.driver import DriverTables

Query = Callable[[SparkSession, str], DataFrame]


def _flat_sessions(s: DataFrame) -> DataFrame:
    return s.select("session_id", "user_id", "start_time", "end_time", "duration_seconds",
                    "n_events", F.col("device_profile.type").alias("device_type"),
                    "referrer", "conversion_status")


def _flat_users(u: DataFrame) -> DataFrame:
    return u.select("user_id", F.col("geo_data.country").alias("country"),
                    F.col("geo_data.state").alias("state"), "registration_date", "last_active")


# -- pipeline pieces shared by several queries --------------------------
def users_enriched(t: DriverTables) -> DataFrame:
    summary = enrich.purchase_summary(t.transactions(), t.txn_items(), t.products())
    return enrich.enrich_users(t.users(), summary)


def items_enriched(t: DriverTables) -> DataFrame:
    return enrich.enrich_items(t.txn_items(), t.products())


def clv_scored(t: DriverTables) -> DataFrame:
    fin = clv.user_financials(users_enriched(t))
    beh = clv.session_behaviour(t.sessions())
    return clv.clv_scores(fin, beh)


def clv_tiered(t: DriverTables) -> DataFrame:
    return clv.clv_tiers(clv_scored(t))


def _q(fn: Callable[[DriverTables], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(DriverTables(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


# -- A: sources, cleaning, enrichment -----------------------------------
def q_clean_users(t):
    return _flat_users(clean.clean_users(t.raw_users()))


def q_clean_products(t):
    return clean.clean_products(t.raw_products())


def q_clean_transactions(t):
    return clean.clean_transactions(t.raw_transactions())


def q_clean_sessions(t):
    return _flat_sessions(clean.clean_sessions(t.sessions()))


def q_table_counts(t):
    return clean.table_counts({
        "users": clean.clean_users(t.users()),
        "products": clean.clean_products(t.products()),
        "categories": t.categories(),
        "transactions": clean.clean_transactions(t.transactions()),
        "sessions": clean.clean_sessions(t.sessions()),
    })


def q_txn_items(t):
    return t.txn_items()


def q_enrich_products(t):
    return enrich.enrich_products(t.products(), t.categories())


def q_purchase_summary(t):
    return enrich.purchase_summary(t.transactions(), t.txn_items(), t.products())


def q_purchase_summary_merged(t):
    """The summary from the states of three batches of orders."""
    orders, items = t.transactions(), t.txn_items()
    batch, n = F.col("transaction_id") % 3, t.parts()
    return states.summary_of(states.merge_states(*[
        states.purchase_states(orders.where(batch == i), items.where(batch == i), t.products(), n and -(-n // 3)) for i in range(3)], partitions=n))


def q_enrich_users(t):
    return enrich.flatten_user_profile(users_enriched(t))


def q_enrich_transactions(t):
    return enrich.enrich_transactions(t.transactions(), t.lines(), t.products())


def q_nested_transactions(t):
    """Baskets nested in parts of four lines; the lines as text, in order."""
    nested = baskets.nest_transactions(t.transactions(), t.lines(), t.products(), part_size=4)
    line = F.transform("items", lambda i: F.concat_ws(":", i["line_number"], i["product_id"], i["product_name"], i["category_id"],
                                                      i["quantity"], cents(i["unit_price"]), cents(i["subtotal"])))
    return nested.select("transaction_id", "user_id", "timestamp", "part", "n_parts", F.size("items").alias("n_items"),
                         F.array_join(line, "|").alias("lines"))


# -- B / C / D: reports --------------------------------------------------
def q_product_affinity(t):
    # the items carry their order's total: no second join with clean orders
    return reports.product_affinity(t.txn_items().where(clean.valid_total()), partitions=t.parts())


def q_cohort_analysis(t):
    return reports.cohort_analysis(clean.clean_users(t.users()),
                                   clean.clean_transactions(
                                       t.transactions(), ["transaction_id", "user_id", "timestamp", "total"]))


def q_revenue_by_category(t):
    return reports.revenue_by_category(t.txn_items(), t.products())


def q_top_users(t):
    return reports.top_users(t.transactions(), t.users())


def q_conversion_funnel(t):
    return reports.conversion_funnel(t.sessions())


def q_monthly_revenue(t):
    return reports.monthly_revenue(t.transactions())


def q_rolling_buyers(t):
    """With small sketches, so that their error shows at small scale too."""
    return buyers.rolling_buyers_check(t.transactions(), lg_k=8)


def q_returning_buyers(t):
    return buyers.returning_buyers_check(t.transactions(), lg_k=8)


def q_product_popularity(t):
    return reports.product_popularity(t.txn_items(), t.products())


def q_user_segmentation(t):
    return reports.user_segmentation(users_enriched(t))


def q_revenue_by_category_monthly(t):
    return reports.revenue_by_category_monthly(items_enriched(t))


# -- E: customer lifetime value -------------------------------------------
def q_user_financials(t):
    return clv.user_financials(users_enriched(t))


def q_session_behaviour(t):
    return clv.session_behaviour(t.sessions())


def q_clv_scores(t):
    return clv_scored(t)


def q_clv_tiers(t):
    return clv_tiered(t)


def q_clv_tiers_approx(t):
    return clv.tier_rank_check(clv_scored(t))


def q_clv_tier_summary(t):
    return clv.clv_tier_summary(clv_tiered(t))


def q_clv_top_customers(t):
    return clv.clv_top_customers(clv_tiered(t))


def q_clv_by_country(t):
    return clv.clv_by_country(clv_tiered(t))


# -- F: chart datasets ------------------------------------------------------
def q_chart_product_revenue(t):
    return charts.chart_product_revenue(t.txn_items(), t.products())


def q_chart_category_revenue_series(t):
    return charts.chart_category_revenue_series(items_enriched(t))


def q_chart_monthly_revenue(t):
    return charts.chart_monthly_revenue(reports.monthly_revenue(t.transactions()))


def q_chart_tier_share(t):
    return charts.chart_tier_share(clv.clv_tier_summary(clv_tiered(t)))


def q_chart_conversion_pivot(t):
    return charts.chart_conversion_pivot(reports.conversion_funnel(t.sessions()))


# -- G: rules of the data model as jobs --------------------------------------
def q_build_sessions(t):
    return _flat_sessions(t.sessions())


def q_page_transitions(t):
    return page_transitions(t.page_views())


def q_invoice_check(t):
    return quality.invoice_check(t.invoices(), t.lines())


def q_stock_ledger(t):
    return quality.stock_ledger(clean.clean_products(t.products()), t.txn_items())


def q_key_and_domain_check(t):
    return quality.key_and_domain_check(t.checked_transactions(), t.checked_items(), t.users(), t.products(),
                                        t.checked_sessions(), t.checked_events(), t.checked_price_points())


def q_price_history(t):
    return quality.price_changes(t.price_points())


def q_price_check(t):
    return quality.price_check(clean.clean_products(t.listed_products()), t.price_points())


# -- G: the same rules on time lines -------------------------------------------
def q_price_at_sale(t):
    return timeline.price_at_sale(t.shipped_lines(), t.price_list())


def q_order_line_differences(t):
    """Shipped lines against invoiced lines, with differences by rule."""
    return reconcile.reconcile(t.shipped_lines(), t.invoiced_lines(), ["transaction_id", "product_id"], names=("shipped", "invoiced"))


def q_stock_timeline(t):
    return timeline.stock_timeline(t.opening_stock(), t.movements())


def q_cart_outcomes(t):
    return cart_outcomes(t.product_events())


def q_ordered_funnel(t):
    return funnel.ordered_steps(t.session_events())


def q_funnel_steps(t):
    return funnel.funnel_steps(funnel.ordered_steps(t.session_events()))


def queries() -> dict[str, Query]:
    out = {}
    for name, fn in list(globals().items()):
        if name.startswith("q_") and callable(fn):
            out[name[2:]] = _q(fn)
    return out
