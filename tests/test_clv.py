from mercato.operators import clv
from tests import fixtures as fx
from tests.conftest import rows

FIN = "user_id string, country string, state string, total_orders long, total_spent double, " \
      "avg_order_value double, favorite_category string"


def _fin(spark, data):
    return spark.createDataFrame(data, FIN)


def test_session_behaviour_first_is_earliest_session(spark):
    got = {r.user_id: r for r in clv.session_behaviour(fx.sessions(spark)).collect()}
    assert got["u1"].primary_device == "desktop"          # s2 started first
    assert got["u1"].total_sessions == 2 and got["u1"].avg_session_duration_sec == 450.0
    assert got["u1"].personal_conversion_rate_pct == 50.0
    assert got["u2"].avg_session_duration_sec == 30.0    # (60 + 0) / 2


def test_scores_tiers_and_left_join_fill(spark):
    fin = _fin(spark, [("u1", "US", "CA", 2, 100.0, 50.0, "a"), ("u2", "US", "IL", 1, 50.0, 50.0, "a"),
                       ("u4", "CA", "ON", 4, 10.0, 2.5, None)])
    beh = clv.session_behaviour(fx.sessions(spark))
    s = clv.clv_scores(fin, beh)
    got = {r.user_id: r for r in s.collect()}
    assert got["u4"].total_sessions == 0 and got["u4"].primary_device is None
    # engagement u1: 2*0.4 + 450/60*0.3 + 50*0.3 = 18.05
    assert got["u1"].engagement_score == 18.05
    t = {r.user_id: r.clv_tier for r in clv.clv_tiers(s).collect()}
    # scores 90.0, 36.05, 26.0 -> p25 = 26.0, p50 = 36.05, p75 = 90.0
    assert {r.user_id: r.clv_score for r in s.collect()} == {"u1": 90.0, "u2": 36.05, "u4": 26.0}
    assert t == {"u1": "Premium", "u2": "High Value", "u4": "Medium Value"}


def test_exact_thresholds_match_percentile_disc(spark):
    vals = [1.0, 2.0, 2.0, 3.5, 7.25, 7.25, 9.0, 10.0, 11.5, 20.0, 21.0]
    s = spark.createDataFrame([(v,) for v in vals], "clv_score double")
    got = rows(clv.tier_thresholds(s))[0]
    n = len(vals)
    exp = tuple(min(v for v in vals if sum(x <= v for x in vals) >= q * n) for q in (0.25, 0.5, 0.75))
    assert got == exp
    sql = spark.sql("SELECT percentile_disc(0.25) WITHIN GROUP (ORDER BY clv_score), "
                    "percentile_disc(0.5) WITHIN GROUP (ORDER BY clv_score), "
                    "percentile_disc(0.75) WITHIN GROUP (ORDER BY clv_score) FROM VALUES "
                    + ", ".join(f"({v})" for v in vals) + " AS t(clv_score)")
    assert tuple(float(x) for x in rows(sql)[0]) == exp
    approx = rows(clv.tier_thresholds(s, "approx"))[0]
    assert len(approx) == 3


def test_exact_thresholds_with_negative_scores(spark):
    import random
    rnd = random.Random(2)
    vals = [round(rnd.uniform(-5_000_000, 100), 2) for _ in range(3000)] + [-1e9, 50.0, 50.0]
    s = spark.createDataFrame([(v,) for v in vals] + [(None,)], "clv_score double").repartition(5)
    srt = sorted(vals)
    exp = tuple(next(v for i, v in enumerate(srt) if i + 1 >= q * len(srt)) for q in (0.25, 0.5, 0.75))
    assert rows(clv.tier_thresholds(s))[0] == exp


def test_negative_totals_have_a_tier(spark):
    fin = _fin(spark, [("u1", "US", "CA", 2, 100.0, 50.0, "a"), ("u2", "US", "IL", 1, -5000.0, -5000.0, "a"),
                       ("u3", "US", "IL", 1, 90.0, 90.0, "a"), ("u4", "CA", "ON", 4, 10.0, 2.5, None)])
    s = clv.clv_scores(fin, clv.session_behaviour(fx.sessions(spark)))
    got = {r.user_id: (r.clv_score, r.clv_tier) for r in clv.clv_tiers(s).collect()}
    # of four scores the smallest is the 25 % threshold itself
    assert got["u2"][0] < -2900 and got["u2"][1] == "Medium Value" and got["u1"][1] == "Premium"


def test_rank_check_of_approximate_thresholds(spark):
    s = spark.range(5000).selectExpr("CAST(id % 997 AS DOUBLE) AS clv_score").repartition(6)
    assert rows(clv.tier_rank_check(s)) == [(0.25, 5000, True), (0.5, 5000, True), (0.75, 5000, True)]
    assert rows(clv.tier_rank_check(s.where("false"))) == []


def test_all_equal_scores_make_one_tier(spark):
    fin = _fin(spark, [(f"u{i}", "US", "CA", 1, 10.0, 10.0, None) for i in range(5)])
    beh = spark.createDataFrame(
        [(f"u{i}", 2, 120.0, 50.0, "mobile", "email", 1) for i in range(5)],
        "user_id string, total_sessions long, avg_session_duration_sec double, "
        "personal_conversion_rate_pct double, primary_device string, primary_referrer string, "
        "converted_sessions long")
    tiers = clv.clv_tiers(clv.clv_scores(fin, beh))
    assert set(rows(tiers, "clv_tier")) == {("Premium",)}
    assert rows(clv.clv_tier_summary(tiers)) == [("Premium", 5, 100.0, 10.0, 1.0, 2.0, 50.0)]


def test_zero_maximum_gives_null_score(spark):
    fin = _fin(spark, [("u1", "US", "CA", 1, 0.0, 0.0, None), ("u2", "US", "CA", 1, 0.0, 0.0, None)])
    beh = clv.session_behaviour(fx.sessions(spark)).limit(0)
    s = clv.clv_scores(fin, beh)
    assert rows(s, "clv_score") == [(None,), (None,)]
    assert set(rows(clv.clv_tiers(s), "clv_tier")) == {("Low Value",)}


def test_top_customers_and_country(spark):
    fin = _fin(spark, [("u1", "US", "CA", 2, 100.0, 50.0, "a"), ("u2", "US", "IL", 1, 50.0, 50.0, "a"),
                       ("u4", "CA", "ON", 4, 10.0, 2.5, None)])
    tiers = clv.clv_tiers(clv.clv_scores(fin, clv.session_behaviour(fx.sessions(spark))))
    top = rows(clv.clv_top_customers(tiers, 2), "user_id")
    assert top == [("u1",), ("u2",)]
    assert rows(clv.clv_by_country(tiers), "country", "user_count", "total_revenue") == \
        [("US", 2, 150.0), ("CA", 1, 10.0)]


def test_approx_thresholds_within_rank_error(spark):
    import random
    rnd = random.Random(5)
    vals = [round(rnd.gauss(50, 15), 2) for _ in range(20000)]
    s = spark.createDataFrame([(v,) for v in vals], "clv_score double").repartition(7)
    got = rows(clv.tier_thresholds(s, "approx"))[0]
    srt = sorted(vals)
    n = len(srt)
    for q, v in zip((0.25, 0.5, 0.75), got):
        lo = sum(x < v for x in srt) / n
        hi = sum(x <= v for x in srt) / n
        # the value's rank range must come within the sketch's 1 % error of q
        assert lo - 0.01 <= q <= hi + 0.01, (q, v, lo, hi)
