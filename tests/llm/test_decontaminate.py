import hashlib
import random
import re

import numpy as np

from mercato.llm import decontaminate as D
from tests.conftest import SF_SMALL

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def brute(docs, items, window=13):
    wins = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[s:s + n]), set()).add("null" if item is None else str(item))
    lengths = {len(k) for k in wins}
    out = []
    for d, text in docs:
        w = words(text)
        hit, ids = set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                if (k := tuple(w[s:s + n])) in wins:
                    hit |= set(range(s, s + n))
                    ids |= wins[k]
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(ids), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def run(spark, docs, items):
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, window string").repartition(3)
    b = spark.createDataFrame([(*r, 0) for r in items], "item_id long, text string, n int")
    return sorted((tuple(r) for r in D.digest(D.decontaminate(d, b)).collect()), key=str)


def test_driver_tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    got = sorted((tuple(r) for r in D.digest(D.decontaminate(docs, items)).collect()), key=str)
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert got == want
    clean = D.keep_clean(docs, items)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r[0] for r in want if not r[5])


def test_random_against_brute_force(spark):
    rnd = random.Random(4)
    items = [(i % 17, " ".join(rnd.choice("abcdefg") * rnd.randrange(1, 3)
                               for _ in range(rnd.choice([0, 1, 2, 3, 4, 5, 6, 12, 13, 14, 30]))))
             for i in range(20)] + [(None, "Only this"), (3, None), (4, "..."), (90, "Ünï côde x9")]
    docs = []
    for d in range(50):
        t = []
        for _ in range(rnd.randrange(6)):
            t.append(" ".join(f"{rnd.choice('abcxyz')}{rnd.randrange(9)}" for _ in range(rnd.randrange(40))))
            piece = (rnd.choice(items)[1] or "").split()
            t.append("-".join(piece[rnd.randrange(3):]).upper())
        docs.append((d, " ... ".join(t)))
    assert run(spark, docs, items) == brute(docs, items)


def test_edge_rows(spark):
    item = " ".join(f"w{i}" for i in range(20))
    long = " ".join(f"x{i}" for i in range(30_000))
    docs = [(1, None), (2, ""), (2, item), (2, item), (None, item), (3, "?!"), (4, item + " " + long),
            (5, " ".join(f"w{i}" for i in range(3, 15)))]
    items = [(1, item), (1, item), (2, item), (7, "w3 w4")]
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, []) == brute(docs, [])
    assert run(spark, [], items) == []


def test_keep_clean_with_null_and_shared_ids(spark):
    item = " ".join(f"w{i}" for i in range(20))
    docs = [(None, item, "a"), (None, "clean text", "b"), (None, None, "c"), (2, item, "d"), (2, "clean too", "e"),
            (2, "", "f"), (3, item, "g"), (3, item, "h"), (4, "clean", "i"), (4, "clean", "j")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    clean = D.keep_clean(df, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert clean.columns == df.columns
    assert sorted(r.lang for r in clean.collect()) == ["b", "c", "e", "f", "i", "j"]


def test_keep_clean_leaves_clashing_names_alone(spark):
    item = " ".join(f"w{i}" for i in range(13))
    df = spark.createDataFrame([(1, item, 7, 8, 9), (2, "fine", 7, 8, 9)], "doc_id long, text string, _llm_t int, _gone int, _T int")
    got = D.keep_clean(df, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert got.columns == df.columns and [tuple(r) for r in got.collect()] == [(2, "fine", 7, 8, 9)]


def test_filters_grow_with_what_they_hold(spark, monkeypatch):
    assert [D.filter_bits(n) for n in (0, 1, 1 << 17, (1 << 17) + 1, 1 << 22, 1 << 40)] == [1 << 23, 1 << 23, 1 << 23, 1 << 24, 1 << 28, 1 << 28]
    monkeypatch.setattr(D, "LEAST_BITS", 64)
    rnd = np.random.default_rng(4)
    held, others = rnd.integers(-1 << 63, 1 << 63, 3000), rnd.integers(-1 << 63, 1 << 63, 20_000)
    df = spark.createDataFrame([(int(h),) for h in held] * 2, "h long")
    for most in (1 << 28, 1 << 13):  # the second is too small: more passes, nothing is lost
        monkeypatch.setattr(D, "MOST_BITS", most)
        bits = D.hash_filter(df)
        assert 8 * len(bits) == min(most, 1 << 18)
        assert D._passing(held.view(np.uint64), bits).all()
        share = D._passing(others.view(np.uint64), bits).mean()
        assert share < 1 / 50 if most > 1 << 13 else .25 < share < .4
    assert not D._passing(others.view(np.uint64), D.hash_filter(df.where("false"))).any()
