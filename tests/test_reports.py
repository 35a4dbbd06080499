import datetime as dt
import itertools
import random
from collections import Counter

from mercato.operators import enrich, reports
from mercato.plans.catalog import REPORT_VIEWS, register_reports, register_views, sql_report
from tests import fixtures as fx
from tests.conftest import rows


def brute_affinity(baskets, top_n):
    c = Counter()
    for t, prods in baskets.items():
        for a, b in itertools.combinations(sorted(set(prods)), 2):
            c[(a, b)] += 1
    return sorted(((a, b, n) for (a, b), n in c.items()), key=lambda x: (-x[2], x[0], x[1]))[:top_n]


def _items_df(spark, baskets):
    data = [(t, p) for t, ps in baskets.items() for p in ps]
    return spark.createDataFrame(data, "transaction_id string, product_id long")


def test_product_affinity_matches_brute_force_with_ties(spark, monkeypatch):
    rnd = random.Random(7)
    baskets = {}
    for t in range(300):
        size = rnd.choice([1, 2, 3, 4, 8])
        baskets[f"t{t}"] = [rnd.randint(0, 40) for _ in range(size)]
    baskets["big"] = list(range(60))           # one large basket
    baskets["dup"] = [1, 1, 2, 2]               # duplicated lines count once
    df = _items_df(spark, baskets)
    for top_n in (5, 20):
        exp = brute_affinity(baskets, top_n)
        for probe in (2, 10, 200):
            monkeypatch.setattr(reports, "PROBE_PRODUCTS", probe)
            assert rows(reports.product_affinity(df, top_n=top_n)) == exp, (top_n, probe)


def test_product_affinity_all_pairs_count_one(spark):
    baskets = {f"t{i}": [i * 3, i * 3 + 1, i * 3 + 2] for i in range(10)}
    df = _items_df(spark, baskets)
    assert rows(reports.product_affinity(df, top_n=7)) == brute_affinity(baskets, 7)


def test_cohort_analysis(spark):
    from mercato.operators import clean
    u, t = clean.clean_users(fx.users(spark)), clean.clean_transactions(fx.transactions(spark))
    got = rows(reports.cohort_analysis(u, t))
    assert got == [("2024-01", "2024-01", 40.0, 1, 1), ("2024-01", "2024-02", 36.0, 1, 1),
                   ("2024-01", "2024-03", 0.0, 1, 2), ("2024-02", "2024-02", 65.0, 1, 1)]


def test_revenue_by_category_and_sql_twin(spark):
    tx, pr = fx.transactions(spark), fx.products(spark)
    items = enrich.flatten_items(tx)
    got = rows(reports.revenue_by_category(items, pr))
    # cat_a: p1 (20+10), p2 (20+60) -> 110 over t1,t2,t3; avg price of 4 lines (10,20,10,20)
    assert got == [("cat_a", 2, 7, 110.0, 15.0, 36.67), ("cat_b", 1, 1, 30.0, 30.0, 30.0)]
    register_views(spark, {"transactions": tx, "products": pr, "users": fx.users(spark),
                           "sessions": fx.sessions(spark)})
    assert rows(sql_report(spark, "revenue_by_category")) == got
    assert register_reports(spark) == sorted(REPORT_VIEWS)
    assert rows(spark.sql("SELECT * FROM revenue_by_category")) == got
    assert rows(spark.sql("SELECT * FROM conversion_funnel")) == rows(reports.conversion_funnel(fx.sessions(spark)))


def test_top_users_completed_only(spark):
    got = rows(reports.top_users(fx.transactions(spark), fx.users(spark)))
    assert got == [("u2", "US", "IL", 1, 65.0, 65.0, dt.datetime(2024, 2, 15, 8), dt.datetime(2024, 2, 15, 8)),
                   ("u1", "US", "CA", 1, 40.0, 40.0, dt.datetime(2024, 1, 10, 12), dt.datetime(2024, 1, 10, 12)),
                   ("u4", "CA", "ON", 1, 0.0, 0.0, dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 1))]
    register_views(spark, {"transactions": fx.transactions(spark), "users": fx.users(spark)})
    assert rows(sql_report(spark, "top_users")) == got


def test_conversion_funnel_and_half_up_tie(spark):
    from mercato.sources.schemas import SESSIONS
    base = fx.sessions(spark).collect()[0]
    data = []
    # 1 converted of 8 -> 12.5 % ; durations 1 and 2 -> mean 1.5 -> rounds up to 2
    for i in range(8):
        d = base.asDict()
        d["session_id"] = f"x{i}"
        d["conversion_status"] = "converted" if i == 0 else "browsed"
        d["duration_seconds"] = 1 if i < 4 else 2
        data.append(tuple(d[f.name] for f in SESSIONS.fields))
    got = rows(reports.conversion_funnel(spark.createDataFrame(data, SESSIONS)))
    assert got == [("mobile", "email", 8, 1, 12.5, 2.0)]


def test_monthly_revenue(spark):
    got = rows(reports.monthly_revenue(fx.transactions(spark)))
    assert got == [("2024-01", 1, 1, 40.0, 40.0), ("2024-02", 1, 1, 65.0, 65.0),
                   ("2024-03", 1, 1, 0.0, 0.0)]
    register_views(spark, {"transactions": fx.transactions(spark)})
    assert rows(sql_report(spark, "monthly_revenue")) == got
    assert set(REPORT_VIEWS) == {"revenue_by_category", "top_users", "conversion_funnel",
                                "monthly_revenue"}


def test_product_popularity_lookup_after_limit(spark):
    tx, pr = fx.transactions(spark), fx.products(spark)
    got = rows(reports.product_popularity(enrich.flatten_items(tx), pr, limit=3))
    assert got == [("p2", "Lamp", "cat_a", 4, 80.0, 2, None, None),
                   ("p1", "Ergonomic Steel Chair With A Very Long Name", "cat_a", 3, 30.0, 2, 5, True),
                   ("p3", "Desk", "cat_b", 1, 30.0, 1, 1, False)]


def test_user_segmentation_buckets_and_default(spark):
    from pyspark.sql import functions as F
    u = spark.createDataFrame(
        [(0, 0.0, 0.0), (1, 10.0, 10.0), (2, 20.0, 10.0), (4, 40.0, 10.0), (7, 7.0, 1.0),
         (11, 11.0, 1.0), (100000, 5.0, 0.0), (None, 1.0, 1.0)],
        "total_orders long, total_spent double, avg_order_value double")
    ue = u.select(F.struct("total_orders", "total_spent", "avg_order_value").alias("purchase_summary"))
    got = rows(reports.user_segmentation(ue))
    assert got == [("0 orders (never purchased)", 1, 0.0, 0.0), ("1-2 orders", 2, 15.0, 10.0),
                   ("3-5 orders", 1, 40.0, 10.0), ("6-10 orders", 1, 7.0, 1.0),
                   ("11+ orders", 1, 11.0, 1.0), ("11+", 2, 3.0, 0.5)]


def test_revenue_by_category_monthly(spark):
    tx, pr = fx.transactions(spark), fx.products(spark)
    ie = enrich.enrich_items(enrich.flatten_items(tx), pr)
    got = rows(reports.revenue_by_category_monthly(ie))
    assert got == [("cat_a", "2024-01", 40.0, 3), ("cat_a", "2024-02", 70.0, 4),
                   ("cat_b", "2024-02", 30.0, 1), (None, "2024-02", 5.0, 5)]


def test_chart_category_revenue_series(spark):
    from mercato.operators.charts import chart_category_revenue_series
    tx, pr = fx.transactions(spark), fx.products(spark)
    ie = enrich.enrich_items(enrich.flatten_items(tx), pr)
    got = rows(chart_category_revenue_series(ie))
    assert got == [("cat_a", "2024-01", 40.0), (None, "2024-02", 5.0), ("cat_a", "2024-02", 70.0),
                   ("cat_b", "2024-02", 30.0)]


def test_money_has_one_rule(spark):
    """1.005 is the double below it, so it is 100 cents; NaN is no amount."""
    rows_ = [("t1", "u1", "2024-01-05T00:00:00", 1.005, "completed"), ("t2", "u1", "2024-01-06T00:00:00", 2.0, "completed"),
             ("t3", "u1", "2024-01-07T00:00:00", float("nan"), "completed")]
    tx = spark.createDataFrame(rows_, "transaction_id string, user_id string, timestamp string, total double, status string")
    register_views(spark, {"transactions": tx})
    want = [("2024-01", 3, 1, 3.0, 1.0)]
    assert rows(reports.monthly_revenue(tx)) == want and rows(sql_report(spark, "monthly_revenue")) == want
    from mercato.operators import clean
    full = tx.withColumn("discount", tx.total)
    assert sorted(rows(clean.clean_transactions(full), "transaction_id")) == [("t1",), ("t2",)]
