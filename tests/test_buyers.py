import datetime as dt
import random

from mercato.operators import buyers

TX = "transaction_id long, user_id long, timestamp timestamp, status string"


def table(n, users, seed=1):
    r = random.Random(seed)
    return [(i, 0 if r.random() < 0.3 else r.randint(1, users), dt.datetime(2023 + r.randint(0, 1), r.randint(1, 12), r.randint(1, 28)),
             r.choice(["completed", "completed", "shipped"])) for i in range(n)]


def months(rows):
    out = {}
    for _, user, at, status in rows:
        if status == "completed" and user is not None and at is not None:
            out.setdefault(f"{at:%Y-%m}", set()).add(user)
    return out


def test_any_period_within_the_stated_error(spark):
    rows = table(6000, 5000) + [(1, None, dt.datetime(2023, 1, 1), "completed"), (2, 1, None, "completed")]
    of = months(rows)
    df = spark.createDataFrame(rows, TX)
    for lg_k in (6, 12):
        sketches = buyers.buyer_sketches(df, lg_k)
        for first, last in (("2023-01", "2023-01"), ("2023-03", "2024-02"), ("0000-01", "9999-12"), ("2030-01", "2030-02")):
            exact = len(set().union(*[u for m, u in of.items() if first <= m <= last]))
            got = buyers.unique_buyers(sketches, first, last, lg_k).first()[0]
            assert abs(got - exact) <= buyers.error_bound(lg_k) * exact
            if exact <= 2 ** lg_k:
                assert got == exact
    assert all(r.within_error for r in buyers.rolling_buyers_check(df, 8).collect())


def test_rolling_periods_are_exact_when_small(spark):
    rows = table(400, 60, 3)
    of = months(rows)
    number = lambda m: int(m[:4]) * 12 + int(m[5:])
    want = {(m, k): len(set().union(*[u for x, u in of.items() if number(m) - k < number(x) <= number(m)])) for m in of for k in (1, 3, 12)}
    df = spark.createDataFrame(rows, TX)
    assert {(r.last_month, r.months): r.unique_buyers for r in buyers.rolling_buyers(buyers.buyer_sketches(df)).collect()} == want
    assert {(r.last_month, r.months): r.unique_buyers for r in buyers.rolling_buyers_exact(buyers.buyers_by_month(df)).collect()} == want


def test_sketches_of_batches_merge(spark):
    rows = table(500, 80, 4)
    a, b = spark.createDataFrame(rows[:300], TX), spark.createDataFrame(rows[200:], TX)  # overlapping
    merged = buyers.merge_sketches(buyers.buyer_sketches(a), buyers.buyer_sketches(b))
    got = buyers.unique_buyers(merged, "2023-01", "2024-12").first()[0]
    assert got == len(set().union(*months(rows).values()))


def test_returning_buyers(spark):
    rows = table(900, 100, 5)
    of = months(rows)
    df = spark.createDataFrame(rows, TX)
    ordered = sorted(of)
    want = {m: len(of[m] & of[p]) for p, m in zip(ordered, ordered[1:])}
    assert {r.month: r.returning_buyers for r in buyers.returning_buyers(buyers.buyer_sketches(df)).collect()} == want
    got = buyers.returning_buyers_check(df).collect()
    assert {r.month: r.returning_buyers for r in got} == want and all(r.within_error for r in got)
    assert buyers.returning_buyers_check(df.limit(0)).collect() == []
