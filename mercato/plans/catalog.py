"""SQL surface: the tables and the finished SQL reports as temp views.

A report view is the operator's DataFrame under a name, so SQL users and
DataFrame users run the same plan with the same money and rounding rules.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from mercato.operators import reports
from mercato.operators.enrich import flatten_items

#: Report view -> the operator over the registered tables.
REPORT_VIEWS: dict[str, Callable[[Callable[[str], DataFrame]], DataFrame]] = {
    "revenue_by_category": lambda t: reports.revenue_by_category(t("txn_items"), t("products")),
    "top_users": lambda t: reports.top_users(t("transactions"), t("users")),
    "conversion_funnel": lambda t: reports.conversion_funnel(t("sessions")),
    "monthly_revenue": lambda t: reports.monthly_revenue(t("transactions")),
}


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame]) -> list[str]:
    """``createOrReplaceTempView`` for every table; adds ``txn_items`` when
    nested transactions are given without it."""
    tables = dict(tables)
    if "txn_items" not in tables and "transactions" in tables \
            and "items" in tables["transactions"].columns:
        tables["txn_items"] = flatten_items(tables["transactions"])
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)


def register_reports(spark: SparkSession) -> list[str]:
    """The reports over the registered tables, as views of their own."""
    for name, report in REPORT_VIEWS.items():
        report(spark.table).createOrReplaceTempView(name)
    return sorted(REPORT_VIEWS)


#: The money and date rules of ``functions.exprs`` as SQL.
SCALAR_FUNCTIONS = {
    "money_cents(x DOUBLE) RETURNS BIGINT": "CAST(round(nanvl(x, CAST(NULL AS DOUBLE)) * 100.0D) AS BIGINT)",
    "money(cents BIGINT) RETURNS DOUBLE": "cents / 100.0D",
    "half_up(x DOUBLE, places INT) RETURNS DOUBLE": "CAST(floor(x * power(10.0D, places) + 0.5D) / power(10.0D, places) AS DOUBLE)",
    "month_of(t TIMESTAMP) RETURNS STRING": "date_format(t, 'yyyy-MM')",
    "ratio(a DOUBLE, b DOUBLE) RETURNS DOUBLE": "try_divide(a, b)",
}

#: Reports with parameters: the view of all rows they read, and their body.
#: A rank filter with a parameter is planned as a top-n, like LIMIT.
_ALL: dict[str, Callable[[Callable[[str], DataFrame]], DataFrame]] = {
    "all_revenue_by_category": lambda t: reports.revenue_by_category(t("txn_items"), t("products"), None),
    "all_top_users": lambda t: reports.top_users(t("transactions"), t("users"), None),
    "all_conversion_funnel": lambda t: reports.conversion_funnel(t("sessions")),
    "all_monthly_revenue": lambda t: reports.monthly_revenue(t("transactions")),
}
_TABLE_FUNCTIONS = {
    "top_users(n INT DEFAULT 10)": ("all_top_users", "total_spent DESC, user_id", "rank <= n"),
    "top_users_in(in_country STRING, n INT DEFAULT 10)": (
        "all_top_users", "country = in_country DESC, total_spent DESC, user_id", "rank <= n AND country = in_country"),
    "revenue_by_category(n INT DEFAULT 10)": ("all_revenue_by_category", "total_revenue DESC, category_id", "rank <= n"),
    "conversion_funnel(device STRING DEFAULT NULL)": ("all_conversion_funnel", None, "device IS NULL OR device_type = device"),
    "monthly_revenue(first STRING DEFAULT '0000-01', last STRING DEFAULT '9999-12')": (
        "all_monthly_revenue", None, "month BETWEEN first AND last"),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Temporary SQL functions: the scalar rules, and the four reports with
    parameters over the registered tables, e.g. ``SELECT * FROM
    top_users(20)`` or ``monthly_revenue('2024-01', '2024-06')``.  Returns
    their names.  A table that a report needs must be registered before."""
    for head, body in SCALAR_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    for view, report in _ALL.items():
        report(spark.table).createOrReplaceTempView(view)
    for head, (view, order, where) in _TABLE_FUNCTIONS.items():
        schema = spark.table(view).schema
        columns = ", ".join(f"`{f.name}`" for f in schema.fields)
        types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        rank = f"row_number() OVER (ORDER BY {order})" if order else "1"
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS TABLE({types}) RETURN "
                  f"SELECT {columns} FROM (SELECT *, {rank} AS rank FROM {view}) WHERE {where}")
    return sorted(h.split("(")[0] for h in [*SCALAR_FUNCTIONS, *_TABLE_FUNCTIONS])


def sql_report(spark: SparkSession, name: str) -> DataFrame:
    """One of the reports over the registered tables."""
    return REPORT_VIEWS[name](spark.table)
