import random

import numpy as np
import pytest
import xxhash

from mercato.llm import simhash
from mercato.llm.graph import components
from tests.conftest import SF_SMALL


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = low.encode().split()
    if not words:
        return 0
    sh = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(s, seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    """{id: fp} -> {id: smallest id reachable}"""
    parent = {i: i for i in fps}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    ids = sorted(fps)
    for i in ids:
        for j in ids:
            if j > i and (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i in ids}


def test_driver_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r[0]: r[1] for r in docs.select("doc_id", "text").collect()}
    fps = {d: brute_fingerprint(t) for d, t in texts.items()}
    got = simhash.digest(simhash.simhash_groups(docs)).collect()
    want = brute_components(fps)
    assert sorted(tuple(r) for r in got) == sorted((d, f"{fps[d]:016x}", want[d]) for d in texts)
    kept = simhash.keep_first(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    assert kept.columns == docs.columns


def test_xxh64_is_sparks(spark):
    texts = ["", "a", "one two three", "é" * 40]
    df = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t", "xxhash64(t) h")
    assert all(r.h % 2**64 == xxhash.xxh64_intdigest(r.t.encode(), 42) for r in df.collect())


@pytest.mark.parametrize("shard", [8, 100_000])
def test_search_against_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(simhash, "SHARD", shard)
    monkeypatch.setattr(simhash, "LEAF", 4)
    rnd = random.Random(3)
    fps = {rnd.getrandbits(64) for _ in range(150)} | {0, 1, 2**64 - 1}
    for f in list(fps)[:60]:  # chains of near neighbours, one bit pattern at a time
        for _ in range(rnd.randrange(6)):
            for _ in range(rnd.randrange(1, 5)):
                f ^= 1 << rnd.randrange(64)
            fps.add(f)
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    unique = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(3)
    got = {r.node: r.root for r in components(simhash.links(unique)).collect()}
    want = brute_components({f: f % 2**64 for f in signed})
    assert {f: got.get(f, f) for f in signed} == want


def test_lower_levels_fitted_by_tasks(spark, monkeypatch):
    """The same links with two levels fitted on the driver and four by tasks; a point lives in one shard."""
    monkeypatch.setattr(simhash, "SHARD", 8)
    monkeypatch.setattr(simhash, "TOP_DEPTH", 2)
    rnd = random.Random(5)
    fps = [rnd.getrandbits(64) for _ in range(200)]
    fps = sorted(set(fps) | {f ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64) for f in fps})
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    unique = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(3)
    trees = simhash.shard_trees(unique, len(fps))
    for half, tree in enumerate(trees):
        assert len(tree.radius) == 64 and (tree.radius[1:4] >= 0).all() and (tree.radius[4:] >= 0).sum() > 20
        points = simhash.halves(np.array(fps, dtype=np.uint64), half)
        number, at, home = simhash.route(points, tree, 1)
        assert sorted(at[home].tolist()) == list(range(len(fps)))
        needs = {(a, n) for a, n in zip(at.tolist(), number.tolist(), strict=True)}
        lives = dict(zip(at[home].tolist(), number[home].tolist(), strict=True))
        for i in range(len(fps)):
            for j in np.flatnonzero(np.bitwise_count(points ^ points[i]) <= 1).tolist():
                assert (j, lives[i]) in needs
    got = {r.node: r.root for r in components(simhash.links(unique)).collect()}
    want = brute_components({f: f % 2**64 for f in signed})
    assert {f: got.get(f, f) for f in signed} == want


@pytest.mark.parametrize("half", [0, 1])
def test_fingerprints_that_share_a_half(half):
    """3,000 points with one half: pairs by the other half, as brute force gives them, without comparing all."""
    rnd = np.random.default_rng(2)
    low = rnd.integers(0, 1 << 32, 3000, dtype=np.uint64)
    low[1500:] = low[:1500] ^ (np.uint64(1) << rnd.integers(0, 32, 1500, dtype=np.uint64)) ^ (np.uint64(1) << rnd.integers(0, 32, 1500, dtype=np.uint64))
    fps = np.unique(low << np.uint64(32 * (1 - half)) | np.uint64(77) << np.uint64(32 * half))
    pairs = [(int(a), int(b)) for x, y in simhash.near_pairs(fps, half, np.ones(len(fps), bool), 3) for a, b in zip(x, y, strict=True)]
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    want = {(int(a), int(b)) for a, b in np.argwhere(near) if a != b}
    assert set(pairs) == want and len(pairs) == len(want) > 1000


def test_edge_rows(spark):
    long = " ".join(f"w{i}" for i in range(40_000))
    rows = [(5, None), (4, ""), (6, " \n"), (7, "one"), (8, "ONE"), (9, long), (3, long), (3, long),
            (None, long), (None, "alone here")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, fp int")
    got = sorted((tuple(r) for r in simhash.digest(simhash.simhash_groups(df)).collect()),
                 key=lambda r: (r[0] is None, r))
    assert got[:2] == [(3, f"{brute_fingerprint(long):016x}", 3)] * 2
    assert [(r[0], r[2]) for r in got[2:]] == [(4, 4), (5, 4), (6, 4), (7, 7), (8, 7), (9, 3),
                                               (None, None), (None, 3)] or \
        [(r[0], r[2]) for r in got[2:]] == [(4, 4), (5, 4), (6, 4), (7, 7), (8, 7), (9, 3),
                                            (None, 3), (None, None)]
    assert simhash.simhash_groups(df.where("false")).count() == 0
    assert sorted(str(r.doc_id) for r in simhash.keep_first(df).collect()) == \
        ["3", "4", "7", "None"]


def test_components_of_a_long_path(spark):
    rows = [(i, i + 1) for i in range(60)] + [(200, 100), (100, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(rows, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 200: 100, 300: 100}


def test_the_survivor_of_equal_rows_is_fixed_and_names_may_clash(spark):
    rows = [(1, "a b c d", src, lang, 5, 6) for src in ("web", "books", None) for lang in ("fr", "en")] * 3
    rows += [(None, "x y z", "web", "en", 5, 6), (None, "x y z", "books", "en", 5, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, _llm_t int, _T int")
    for parts in (1, 2, 5):
        got = simhash.keep_first(df.repartition(parts))
        assert got.columns == df.columns
        assert sorted(map(tuple, got.collect()), key=str) == [(1, "a b c d", None, "en", 5, 6), (None, "x y z", "books", "en", 5, 6)]
