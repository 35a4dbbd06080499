import math

import pytest
from pyspark.sql import functions as F

from mercato.functions import exprs
from mercato.operators import enrich, reports
from mercato.plans.catalog import register_functions, register_views
from tests import fixtures as fx
from tests.conftest import SF_SMALL, rows


def test_scalar_rules_equal_the_column_rules(spark):
    register_views(spark, {"transactions": fx.transactions(spark), "products": fx.products(spark),
                           "users": fx.users(spark), "sessions": fx.sessions(spark)})
    register_functions(spark)
    values = [0.0, 0.125, 1.005, 2.675, 19.99, -0.125, -3.455, 1e9 + 0.005, math.nan, None]
    spark.createDataFrame([(v,) for v in values], "x double").createOrReplaceTempView("amounts")
    x = F.col("x")
    want = spark.table("amounts").select(exprs.cents("x"), exprs.half_up(F.nanvl(x, F.lit(None)), 2), exprs.half_up(F.nanvl(x, F.lit(None)), 0),
                                         exprs.from_cents(exprs.cents("x")), exprs.ratio(F.nanvl(x, F.lit(None)), F.lit(0.0)))
    clean = "nanvl(x, CAST(NULL AS DOUBLE))"
    got = spark.sql(f"SELECT money_cents(x), half_up({clean}, 2), half_up({clean}, 0), money(money_cents(x)), ratio({clean}, 0) FROM amounts")
    assert rows(got) == rows(want)
    assert spark.sql("SELECT month_of(TIMESTAMP'2024-03-31 23:59:59')").first()[0] == "2024-03"


@pytest.fixture
def tables(spark):
    from mercato.sources.driver import DriverTables
    t = DriverTables(spark, SF_SMALL)
    views = {"transactions": t.transactions(), "products": t.products(), "users": t.users(), "sessions": t.sessions(), "txn_items": t.txn_items()}
    register_views(spark, views)
    register_functions(spark)
    return views


def test_reports_with_parameters_equal_the_operators(spark, tables):
    t = tables
    assert rows(spark.sql("SELECT * FROM top_users()")) == rows(reports.top_users(t["transactions"], t["users"]))
    for n in (1, 25, 0):
        got = spark.sql(f"SELECT * FROM top_users({n})")
        assert rows(got) == rows(reports.top_users(t["transactions"], t["users"], n)) and got.columns[0] == "user_id"
    assert rows(spark.sql("SELECT * FROM revenue_by_category(3)")) == rows(reports.revenue_by_category(t["txn_items"], t["products"], 3))
    assert rows(spark.sql("SELECT * FROM conversion_funnel() ORDER BY conversion_rate_pct DESC, device_type, referrer")) == rows(reports.conversion_funnel(t["sessions"]))
    assert rows(spark.sql("SELECT * FROM conversion_funnel('tablet')")) == [
        r for r in rows(reports.conversion_funnel(t["sessions"])) if r[0] == "tablet"]
    every = rows(reports.monthly_revenue(t["transactions"]))
    assert rows(spark.sql("SELECT * FROM monthly_revenue() ORDER BY month")) == every
    assert rows(spark.sql("SELECT * FROM monthly_revenue('1997-01', '1997-12') ORDER BY month")) == [r for r in every if "1997-01" <= r[0] <= "1997-12"]
    users = rows(reports.top_users(t["transactions"], t["users"], None))
    land = users[0][1]
    want = sorted((r for r in users if r[1] == land), key=lambda r: (-r[4], r[0]))[:4]
    assert rows(spark.sql(f"SELECT * FROM top_users_in('{land}', 4)")) == want


def test_a_limit_parameter_is_planned_as_top_n(spark, tables):
    plan = spark.sql("SELECT * FROM top_users(10)")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=10" in plan


def test_nested_documents_too(spark):
    t = fx.transactions(spark)
    register_views(spark, {"transactions": t, "products": fx.products(spark), "users": fx.users(spark), "sessions": fx.sessions(spark)})
    register_functions(spark)
    assert rows(spark.sql("SELECT * FROM revenue_by_category(2)")) == rows(
        reports.revenue_by_category(enrich.flatten_items(t), fx.products(spark), 2))
