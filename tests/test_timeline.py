import datetime as dt
import random

import pytest

from mercato.functions import ordered
from mercato.operators import timeline

T0 = dt.datetime(2024, 1, 1)
LINE = "transaction_id long, line_number int, product_id string, timestamp timestamp, unit_price double"
MOVE = "product_id string, timestamp timestamp, transaction_id long, line_number int, quantity long"


def day(n):
    return T0 + dt.timedelta(days=n)


def sales(n, seed, hot=0.34):
    """A product with a third of all lines, many at equal times."""
    r = random.Random(seed)
    return [(i, r.randint(1, 3), "hot" if r.random() < hot else f"p{r.randint(1, 6)}", day(r.randint(0, 400)),
             r.choice([1.0, 1.5, 2.25])) for i in range(n)]


def brute_price(line, points):
    *_, product, at, price = line
    known = [(d, p) for q, d, p in points if p is not None and q == product and at is not None and d is not None and d <= at]
    if product is None or not known:
        return (None, None, None, None)
    since, listed = max(known)
    off = abs(price - listed) / listed * 100
    pct = int(off * 100 + 0.5) / 100
    return (listed, since, price == listed, -pct if price < listed else pct)


@pytest.mark.parametrize("bucket", [3600, 30 * 86400, 10 ** 9])
def test_price_at_sale_against_brute_force(spark, bucket, monkeypatch):
    monkeypatch.setattr(ordered, "LIGHT_ROWS", 50)  # cut the hot product's buckets
    lines = sales(400, 1) + [(900, 1, None, day(5), 1.0), (901, 1, "hot", None, 1.0), (902, 1, "new", day(5), 1.0)]
    r = random.Random(2)
    points = [(r.choice(["hot", "p1", "p2", "p3"]), day(r.randint(20, 380)), r.choice([1.0, 1.5, 2.25])) for _ in range(60)]
    points += points[:5] + [("hot", day(30), 9.0), ("hot", day(30), None), (None, day(1), 1.0), ("p4", None, 1.0)]
    got = timeline.price_at_sale(spark.createDataFrame(lines, LINE),
                                 spark.createDataFrame(points, "product_id string, date timestamp, price double"), bucket_seconds=bucket)
    rows = {r.transaction_id: (r.list_price, r.list_price_since, r.price_ok, r.deviation_pct) for r in got.collect()}
    assert rows == {x[0]: brute_price(x, points) for x in lines}
    assert {v[2] for v in rows.values()} == {True, False, None}


def test_a_sale_takes_the_price_of_its_own_moment(spark):
    lines = spark.createDataFrame([(1, 1, "p", day(10), 2.0), (2, 1, "p", day(9), 2.0), (3, 1, "p", day(300), 2.0)], LINE)
    points = spark.createDataFrame([("p", day(10), 2.0), ("p", day(0), 4.0)], "product_id string, date timestamp, price double")
    got = timeline.price_at_sale(lines, points).orderBy("transaction_id").collect()
    assert [(r.list_price, r.price_ok, r.deviation_pct) for r in got] == [(2.0, True, 0.0), (4.0, False, -50.0), (2.0, True, 0.0)]


def test_as_of_keeps_rows_and_clashing_names(spark):
    left = spark.createDataFrame([("a", day(1), 1, 7), ("a", day(1), 1, 7), (None, day(1), 2, 7)], "k string, t timestamp, v int, _us int")
    right = spark.createDataFrame([("a", day(0), 5)], "k string, t timestamp, v int")
    got = ordered.as_of(left, right, "k", "t", "t", ["v"]).collect()
    assert sorted((r.k or "", r.v, r["_us"], r.as_of.v if r.as_of else None) for r in got) == [("", 2, 7, None), ("a", 1, 7, 5), ("a", 1, 7, 5)]
    assert ordered.as_of(left.limit(0), right, "k", "t", "t", ["v"]).count() == 0
    assert [r.as_of for r in ordered.as_of(left, right.limit(0), "k", "t", "t", ["v"]).collect()] == [None] * 3


def brute_stock(opening, moves):
    out = []
    for product, stock in opening:
        own = sorted(((t, i, n, q) for p, t, i, n, q in moves if p == product and t is not None and q is not None))
        left, low, first = stock, stock, None
        for t, i, n, q in own:
            left += q
            low = min(low, left)
            if left < 0 and first is None:
                first = (t, i, n, -left)
        out.append((product, stock, len(own), -sum(q for *_, q in own if q < 0), sum(q for *_, q in own if q > 0), left, low,
                    *(first or (None,) * 4)))
    return sorted(out)


@pytest.mark.parametrize("bucket", [3600, 30 * 86400, 10 ** 9])
def test_stock_timeline_against_brute_force(spark, bucket, monkeypatch):
    monkeypatch.setattr(ordered, "LIGHT_ROWS", 50)
    r = random.Random(3)
    moves = [(p, t, i, n, r.choice([-5, -3, -1, 2, 6])) for i, n, p, t, _ in sales(500, 4)]
    moves += moves[:20] + [(None, day(1), 1, 1, -9), ("p1", None, 1, 1, -9), ("p1", day(3), 1, 1, None), ("gone", day(1), 1, 1, -9)]
    opening = [("hot", 20), ("p1", 0), ("p2", 5), ("p3", 1000), ("p4", 3), ("idle", 4)]
    got = timeline.stock_timeline(spark.createDataFrame(opening, "product_id string, opening_stock long"),
                                  spark.createDataFrame(moves, MOVE), bucket)
    want = brute_stock(opening, moves)
    assert sorted(tuple(x) for x in got.collect()) == want
    assert any(w[7] for w in want) and any(not w[7] for w in want)


def test_first_oversold_sale_is_the_first_that_a_shop_would_refuse(spark):
    """Up to it, refusing and counting below zero are the same."""
    r = random.Random(5)
    moves = [("p", day(i), i, 1, -r.randint(1, 4)) for i in range(30)]
    left, refused = 20, None
    for *_, i, _, q in moves:
        if left + q < 0:
            refused = i
            break
        left += q
    row = timeline.stock_timeline(spark.createDataFrame([("p", 20)], "product_id string, opening_stock long"),
                                  spark.createDataFrame(moves, MOVE)).first()
    assert row.oversold_transaction == refused


def test_empty_tables(spark):
    opening, moves = spark.createDataFrame([], "product_id string, opening_stock long"), spark.createDataFrame([], MOVE)
    assert timeline.stock_timeline(opening, moves).collect() == []
    row = timeline.stock_timeline(spark.createDataFrame([("p", 2)], opening.schema), moves).first()
    assert tuple(row) == ("p", 2, 0, 0, 0, 2, 2, None, None, None, None)


def test_hot_product_is_cut(spark, monkeypatch):
    """Its rows lie in many (product, bucket) pieces, even on one day."""
    monkeypatch.setattr(ordered, "LIGHT_ROWS", 100)
    lines = [("hot", T0 + dt.timedelta(seconds=i), i, 1, -1) for i in range(1000)]
    rows, edges = ordered.running_low(spark.createDataFrame(lines, MOVE), "product_id", "timestamp", ["transaction_id"], "quantity")
    assert edges.count() > 500
    assert edges.selectExpr("min(_before + _low)").first()[0] == -1000
