import datetime as dt
import random

import pytest

from mercato.functions import ordered
from mercato.operators import funnel
from mercato.operators.sessions import sessionize

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "event_id long, ts timestamp, user_id long, event_type string"


def events(n, seed, types=("view", "click", "purchase", "signup")):
    r = random.Random(seed)
    return [(i, T0 + dt.timedelta(minutes=r.randint(0, 40000)), 0 if r.random() < 0.4 else r.randint(1, 9), r.choice(types)) for i in range(n)]


def scan(types, steps):
    state = 0
    for t in types:
        if state < len(steps) and t in steps[state][1]:
            state += 1
    return state


def brute(ev, steps, gap=12 * 3600):
    by_user, out = {}, {}
    for e in sorted(ev, key=lambda e: (e[2], e[1], e[0])):
        by_user.setdefault(e[2], []).append(e)
    for user, es in by_user.items():
        seq = 0
        for prev, e in zip([None, *es], es):
            if prev is None or (e[1] - prev[1]).total_seconds() >= gap:
                seq += 1
            out.setdefault(f"{user}-{seq}", []).append(e[3])
    return {k: (len(v), scan(v, steps)) for k, v in out.items()}


@pytest.mark.parametrize("bucket", [600, 86400, 10 ** 9])
def test_ordered_steps_against_one_scan(spark, bucket):
    ev = events(700, 1)
    got = funnel.ordered_steps(sessionize(spark.createDataFrame(ev, SCHEMA), bucket_seconds=bucket, keep_bucket=True)).collect()
    assert {r.session_id: (r.n_events, r.steps_taken) for r in got} == brute(ev, funnel.PURCHASE_STEPS)
    names = [None, "view", "cart", "checkout"]
    assert all(r.furthest_step == names[r.steps_taken] for r in got) and {r.steps_taken for r in got} >= {0, 3}


def test_a_session_in_many_pieces(spark, monkeypatch):
    """One user's single session, cut by time and again within a heavy bucket;
    steps repeat a type and share one."""
    monkeypatch.setattr(ordered, "LIGHT_ROWS", 40)
    r = random.Random(2)
    ev = [(i, T0 + dt.timedelta(seconds=30 * i), 5, r.choice("abcx")) for i in range(300)]
    steps = [("first", ("a",)), ("again", ("a",)), ("either", ("b", "c")), ("last", ("c",))]
    pieces = sessionize(spark.createDataFrame(ev, SCHEMA), bucket_seconds=1800, keep_bucket=True)
    assert pieces.select("_b").distinct().count() > 50
    row = funnel.ordered_steps(pieces, steps).collect()
    assert [(x.session_id, x.n_events, x.steps_taken) for x in row] == [("5-1", 300, scan([e[3] for e in ev], steps))]


def test_transition_functions_compose(spark):
    ev = [(1, T0, 1, "click"), (2, T0, 1, "view"), (3, T0, 1, "purchase"), (4, T0, 1, "click")]
    fns = funnel.transition_functions(sessionize(spark.createDataFrame(ev, SCHEMA), keep_bucket=True), funnel.PURCHASE_STEPS).collect()
    # from nothing: view, click; from view: click, purchase; from cart: purchase; from checkout: stays
    assert [r.fn for r in fns] == [[2, 3, 3, 3]]


def test_funnel_steps_and_empty(spark):
    ev = [(1, T0, 1, "view"), (2, T0, 2, "view"), (3, T0 + dt.timedelta(hours=1), 2, "click"), (4, T0, 3, "purchase")]
    run = lambda e: funnel.funnel_steps(funnel.ordered_steps(sessionize(spark.createDataFrame(e, SCHEMA), keep_bucket=True)))
    assert [tuple(r) for r in run(ev).collect()] == [(1, "view", 2, 66.67, 66.67), (2, "cart", 1, 33.33, 50.0), (3, "checkout", 0, 0.0, 0.0)]
    assert [tuple(r) for r in run([]).collect()] == [(i, n, 0, None, None) for i, n in ((1, "view"), (2, "cart"), (3, "checkout"))]
    lost = [(1, None, 1, "view"), (2, T0, None, "view"), (3, T0, 4, None)]
    assert [r.sessions for r in run(lost).collect()] == [0, 0, 0]
