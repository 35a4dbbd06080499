import datetime as dt
import os
import random

import pytest

from mercato.operators import enrich, states
from mercato.plans import jobs
from mercato.sources import snapshots

T0 = dt.datetime(2024, 1, 1)
TX = "transaction_id string, user_id string, timestamp timestamp, total double"
IT = "transaction_id string, user_id string, product_id string, quantity long"
PR = "product_id string, category_id string"
PRODUCTS = [(f"p{i}", f"c{i % 4}") for i in range(9)] + [("none", None), ("p1", "c1")]


def batch(seed, users, n=120):
    r = random.Random(seed)
    tx, items = [], []
    for i in range(n):
        user = "hot" if r.random() < 0.34 else r.choice(users)
        tx.append((f"t{seed}-{i}", user, r.choice([None, T0 + dt.timedelta(days=r.randint(0, 99))]),
                   r.choice([None, 0.1, 0.2, 19.99, -3.0, float("nan")])))
        items += [(f"t{seed}-{i}", user, f"p{r.randint(0, 11)}", r.randint(1, 5)) for _ in range(r.randint(0, 3))]
    return tx, items


def frames(spark, b):
    return spark.createDataFrame(b[0], TX), spark.createDataFrame(b[1], IT), spark.createDataFrame(PRODUCTS, PR)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(os.path.join(root, "data")) for f in names if f.endswith(".parquet")}


USERS = [f"u{i}" for i in range(40)] + [None]


def test_batches_once_or_twice_equal_the_full_summary(spark, tmp_path):
    root = str(tmp_path / "summary")
    batches = [batch(s, USERS) for s in range(3)]
    for i in (0, 1, 1, 2, 0):
        jobs.refresh_summary(*frames(spark, batches[i]), root, f"day-{i}", ranges=8)
    every = frames(spark, ([t for b in batches for t in b[0]], [x for b in batches for x in b[1]]))
    assert rows(jobs.read_summary(spark, root)) == rows(enrich.purchase_summary(*every))
    assert snapshots.versions(spark, root) == [0, 1, 2]


def test_only_touched_ranges_are_rewritten(spark, tmp_path):
    root = str(tmp_path / "summary")
    first, second = batch(1, USERS), ([("x", "u3", T0, 5.0)], [("x", "u3", "p2", 100)])
    done = jobs.refresh_summary(*frames(spark, first), root, "a", ranges=16)
    assert done.applied and len(done.ranges) > 8
    held, before = snapshots._ranges(spark, root, 0), files(root)
    done = jobs.refresh_summary(*frames(spark, second), root, "b", ranges=999)  # the first batch fixed the number
    assert len(done.ranges) == 1
    now = snapshots._ranges(spark, root, 1)
    assert [r for r in now if now[r] != held.get(r)] == done.ranges
    new = [f for f in files(root) - before if "/rows/" in f]
    assert new and all(f"range_no={done.ranges[0]}/" in f for f in new)
    got = {r.user_id: r for r in jobs.read_summary(spark, root).collect()}
    assert got["u3"].favorite_category == "c2"
    # the old version is still there to be read
    assert rows(states.summary_of(snapshots.read_snapshot(spark, root, 0))) == rows(enrich.purchase_summary(*frames(spark, first)))


def test_a_merge_that_fails_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "summary")
    a, b = batch(1, USERS), batch(2, USERS)
    jobs.refresh_summary(*frames(spark, a), root, "a", ranges=4)
    before = rows(jobs.read_summary(spark, root))

    def fail(*args):
        raise OSError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(snapshots, "_commit", fail)
        with pytest.raises(OSError):
            jobs.refresh_summary(*frames(spark, b), root, "b")
    # and one that dies inside the commit: a manifest without its last part
    part = tmp_path / "summary" / "manifests" / "0000000001" / "batches"
    part.mkdir(parents=True)
    assert rows(jobs.read_summary(spark, root)) == before
    assert jobs.refresh_summary(*frames(spark, b), root, "b").applied
    every = frames(spark, (a[0] + b[0], a[1] + b[1]))
    assert rows(jobs.read_summary(spark, root)) == rows(enrich.purchase_summary(*every))
    assert snapshots.vacuum(spark, root, keep=1) >= 1
    assert rows(jobs.read_summary(spark, root)) == rows(enrich.purchase_summary(*every))
    assert not jobs.refresh_summary(*frames(spark, a), root, "a").applied


def test_empty_batches(spark, tmp_path):
    root = str(tmp_path / "summary")
    with pytest.raises(ValueError):
        jobs.read_summary(spark, root)
    jobs.refresh_summary(*frames(spark, ([], [])), root, "none", ranges=4)
    assert rows(jobs.read_summary(spark, root)) == []
    b = batch(3, USERS, 10)
    jobs.refresh_summary(*frames(spark, b), root, "some")
    jobs.refresh_summary(*frames(spark, ([], [])), root, "none again")
    assert rows(jobs.read_summary(spark, root)) == rows(enrich.purchase_summary(*frames(spark, b)))


def test_states_merge_in_any_order(spark):
    parts = [states.purchase_states(*frames(spark, batch(s, USERS))) for s in range(3)]
    a, b, c = parts
    one = rows(states.merge_states(states.merge_states(a, b), c))
    assert one == rows(states.merge_states(c, states.merge_states(b, a))) == rows(states.merge_states(b, c, a))
