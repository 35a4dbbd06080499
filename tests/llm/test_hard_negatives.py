import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, id string, q int"


def brute(rows, n_pos=5, n_neg=10, low=30, high=90, every=10):
    best = {}
    for vec_id, v, label, *_ in rows:
        if vec_id is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(float(np.float32(x)) * 256) for x in v]
        if vec_id not in best or (label, q) < best[vec_id]:
            best[vec_id] = (label, q)
    out = []
    for a, (la, qa) in best.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(qa, q)), i) for i, (_, q) in best.items() if i != a)
        for s, p in [x for x in scored if best[x[1]][0] == la][:n_pos]:
            window = [(t, i) for t, i in scored if best[i][0] != la and low * -s <= 100 * -t <= high * -s][:n_neg]
            out += [(a, p, rank, i, -s, -t) for rank, (t, i) in enumerate(window, 1)]
    return sorted(out)


def mined(spark, rows, every=10, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = hn.hard_negatives(df, F.col("id") % every == 0, **kw)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def vectors(n, dim, seed, values=None):
    r = random.Random(seed)
    pick = (lambda: r.choice(values)) if values else (lambda: r.uniform(-1, 1))
    return [(i, [pick() for _ in range(dim)], r.randint(0, 3), "x", 1) for i in range(-n // 2, n // 2)]


def test_against_brute_force(spark):
    rows = vectors(300, 6, 1)
    assert mined(spark, rows) == brute(rows) != []


def test_ties_zero_scores_and_negative_positives(spark):
    rows = vectors(200, 2, 2, values=[0.0, 1 / 256, -1 / 256])
    want = brute(rows)
    assert mined(spark, rows) == want
    assert any(r[4] == 0 and r[3] < r[1] for r in want), "negatives of score 0 before their positive"


def test_one_vector_holds_a_third(spark):
    rows = vectors(120, 4, 3) + [(1000 + i, [0.5, 0.25, -0.5, 0.125], i % 2, "x", 1) for i in range(80)]
    assert mined(spark, rows) == brute(rows)


def test_unusable_rows_and_repeated_ids(spark):
    rows = vectors(80, 3, 4)
    rows += [(None, [1.0, 1.0, 1.0], 1, "x", 1)] * 40 + [(10, None, 1, "x", 1), (20, [1.0, None, 0.0], 1, "x", 1)]
    rows += [(7, [float("nan"), 1.0, 1.0], 1, "x", 1), (8, [float("inf"), 1.0, 1.0], 2, "x", 1), (9, [1.0, 1.0, 1.0], None, "x", 1)]
    rows += rows[:30] + [(0, [0.1, 0.2, 0.3], 0, "x", 1), (13, [], 1, "x", 1), (17, [1.0], 2, "x", 1)]
    assert mined(spark, rows) == brute(rows)


def test_empty_and_without_anchors(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(3, [1.0], 1, "x", 1), (4, [1.0], 1, "x", 1)]) == []
    assert mined(spark, [(10, [1.0], 1, "x", 1)]) == []


def test_other_windows_and_many_cells(spark, monkeypatch):
    monkeypatch.setattr(hn, "CELL_BYTES", 2000)  # a grid of several lines and columns
    monkeypatch.setattr(hn, "SORTED_PAIRS", 50)
    monkeypatch.setattr(hn, "STEP", 100)
    rows = vectors(240, 4, 5)
    assert mined(spark, rows, every=3, positives=2, negatives=3, low=10, high=60) == brute(rows, 2, 3, 10, 60, every=3)
    with pytest.raises(ValueError):
        hn.hard_negatives(spark.createDataFrame([], SCHEMA), F.col("id") % 2 == 0, high=100)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(r.randint(-(1 << 20), 1 << 20)) for _ in range(3)], i % 2, "x", 1) for r in [random.Random(6)] for i in range(60)]
    assert mined(spark, rows) == brute(rows) != []


def test_keys_sort_like_anchor_descending_score_id():
    r = np.random.default_rng(0)
    a, s, i = (np.concatenate([r.integers(-9, 9, 200), [np.iinfo(np.int64).min, np.iinfo(np.int64).max]]) for _ in range(3))
    keys = hn.pack(a, s, i).to_pylist()
    assert [hn.unpack(k) for k in sorted(keys)] == sorted(zip(a.tolist(), s.tolist(), i.tolist()), key=lambda t: (t[0], -t[1], t[2]))


def test_stream_holds_windows_only():
    """An anchor's pairs are read once, as they come."""
    def pairs():
        yield from ((hn.pack(np.array([10]), np.array([100]), np.array([1]))[0].as_py(), True),)
        for i in range(5):
            yield hn.pack(np.array([10]), np.array([80 - i]), np.array([20 + i]))[0].as_py(), False
        raise RuntimeError("read on")
    stream = hn.open_windows(pairs(), 10, 30, 90)
    assert [next(stream)[3] for _ in range(5)] == [20, 21, 22, 23, 24]
    with pytest.raises(RuntimeError):
        next(stream)
