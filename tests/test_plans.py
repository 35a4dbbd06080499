"""Plan properties of every registered query (what must hold at scale).

Plans are whole: no query runs a job while it is built, so nothing is hidden
behind a checkpoint.
"""

import re

import pytest

from tests.conftest import SF_SMALL

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInArrow", "ExistingRDD"]


def _names():
    from mercato.plans.queries import queries
    return sorted(queries())


def _build(spark, name):
    from mercato.plans.queries import queries
    return queries()[name](spark, SF_SMALL)


def _texts(df):
    q = df._jdf.queryExecution()
    return q.analyzed().toString(), q.executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    """Analyzed and physical plan of every query, built once, and the jobs
    that ran meanwhile."""
    sc = spark.sparkContext
    sc.setJobGroup("building", "plans")
    try:
        out = {name: _texts(_build(spark, name)) for name in _names()}
        return out, list(sc.statusTracker().getJobIdsForGroup("building"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def _plan(spark, name):
    return _texts(_build(spark, name))[1]


def _scans(plan, *columns):
    """Parquet scans that read any of the columns."""
    reads = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    return [r for r in reads if any(re.search(rf"\b{c}#", r) for c in columns)]


@pytest.mark.parametrize("name", _names())
def test_plan_has_no_unscalable_operator(plans, name):
    plan = plans[0][name][1]
    assert "FileScan parquet" in plan
    for op in FORBIDDEN:
        assert op not in plan, (name, op)
    # ordered per-key scans over rows carry the time bucket in their
    # partitioning, so a hot user or product is spread over many tasks; a
    # window keyed by user/product alone may only scan the per-bucket
    # summary (ordered by the bucket: one row per non-empty bucket)
    for m in re.finditer(r"Window \[.*?\], \[([^\]]*)\], \[([^\]]*)\]", plan):
        keys, order = m.group(1), m.group(2)
        if re.search(r"\b(user_id|product_id)#", keys) and "_b#" not in keys:
            assert order.startswith("_b#"), (name, keys, order)
    # a window without partitioning reads the handful of tier rows only
    alone = re.findall(r"Window \[[^\n]*windowspecdefinition\((?:specifiedwindowframe|[^,]*(?:ASC|DESC))", plan)
    assert not alone or name == "chart_tier_share", (name, alone)


def test_building_a_query_runs_no_job(plans):
    assert plans[1] == []


@pytest.mark.parametrize("name", ["product_popularity", "chart_product_revenue"])
def test_top_products_read_line_items_once(plans, name):
    assert len(_scans(plans[0][name][1], "l_extendedprice", "l_orderkey")) == 1


def test_enriched_transactions_move_lines_twice(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(spark, "enrich_transactions")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(_scans(plan, "l_orderkey")) == 1 and len(_scans(plan, "o_orderkey")) == 1
    moved = [x for x in re.findall(r"Exchange hashpartitioning\(([a-z_]+)#", plan) if x in ("product_id", "transaction_id")]
    assert len(moved) <= 4  # lines twice, the catalogue and the orders once


def test_cohorts_read_only_their_columns(plans):
    scans = _scans(plans[0]["cohort_analysis"][1], "o_orderkey")
    assert any("o_totalprice" in s for s in scans)
    assert not any("o_orderpriority" in s or "o_orderstatus" in s for s in scans)


def test_lookup_join_uses_the_grouping(spark):
    """The catalogue is grouped by its key, so the join moves it once."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from mercato.operators import enrich
        from mercato.sources.driver import DriverTables
        t = DriverTables(spark, SF_SMALL)
        plan = enrich.enrich_items(t.lines(), t.products())._jdf.queryExecution().executedPlan().toString()
        unused = enrich.enrich_items(t.lines(), t.products()).select("quantity")._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Join" not in unused


def test_clv_plans_hold_the_whole_pipeline(plans):
    plan = plans[0]["clv_tier_summary"][1]
    assert _scans(plan, "l_quantity") and _scans(plan, "o_totalprice") and _scans(plan, "event_type")


@pytest.mark.parametrize("name", _names())
def test_broadcast_hints_are_bounded(plans, name):
    """A hint stands on a limit, or on the cuts of at most HEAVY limited
    buckets; every other broadcast is the planner's, from measured sizes."""
    lines = plans[0][name][0].split("\n")
    for i, line in enumerate(lines):
        if "ResolvedHint (strategy=broadcast)" in line:
            below = "\n".join(lines[i + 1:i + 5])
            assert "GlobalLimit" in below or "percentile_approx(_us" in below, (name, below)


@pytest.mark.parametrize("name", ["product_affinity", "purchase_summary_merged"])
def test_partitions_follow_the_input(spark, monkeypatch, name):
    from mercato.plans.queries import queries
    from mercato.sources import driver
    before = sorted(map(str, queries()[name](spark, SF_SMALL).collect()))
    assert driver.DriverTables(spark, SF_SMALL).parts() is None  # small tables are left as they are
    monkeypatch.setattr(driver, "PART_BYTES", 10_000)
    n = driver.DriverTables(spark, SF_SMALL).parts()
    assert n >= driver.LEAST_PARTS
    df = queries()[name](spark, SF_SMALL)
    assert len(re.findall(rf"hashpartitioning\([^)]*, {n}\), REPARTITION_BY_NUM", df._jdf.queryExecution().toString())) >= 3
    assert sorted(map(str, df.collect())) == before


def test_merged_states_are_dealt_by_user(spark):
    from mercato.operators import states
    from mercato.sources.driver import DriverTables
    t = DriverTables(spark, SF_SMALL)
    some = [states.purchase_states(t.transactions(), t.txn_items(), t.products(), n) for n in (None, 5)]
    assert sorted(map(str, some[0].collect())) == sorted(map(str, some[1].collect()))
    merged = [states.summary_of(states.merge_states(*some, partitions=n)) for n in (None, 9)]
    assert sorted(map(str, merged[0].collect())) == sorted(map(str, merged[1].collect()))
    plan = merged[1]._jdf.queryExecution().toString()
    assert re.search(r"hashpartitioning\(user_id[^)]*, 9\), REPARTITION_BY_NUM", plan)
    assert re.search(r"hashpartitioning\(product_id[^)]*, 5\), REPARTITION_BY_NUM", plan)
