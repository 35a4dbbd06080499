import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mercato.llm import substring_dedup as S
from mercato.llm.substring_dedup import anchor_plan, digest, substring_dedup
from tests.conftest import SF_SMALL


def brute(docs, window=20):
    """docs: [(doc_id, text)], unique ids; every window against every earlier one."""
    out, first = {}, {}
    split = [(d, (t or "").encode().split()) for d, t in
             sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0))]
    for d, words in split:
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            key = tuple(words[s:s + window])
            if key in first:
                gone[s:s + window] = [True] * window
            else:
                first[key] = (d, s)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out[d] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def run(spark, docs, window=20):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    return {r[0]: tuple(r)[1:] for r in digest(substring_dedup(df, window)).collect()}


def test_cover_meets_at_every_shift():
    for window in (8, 13, 20, 50):
        period, cover, _ = anchor_plan(window)
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def random_docs(seed, n=60):
    rnd = random.Random(seed)
    passages = [[f"p{i}w{rnd.randrange(6)}" for _ in range(rnd.randrange(18, 60))] for i in range(6)]
    docs = []
    for d in range(n):
        words = []
        for _ in range(rnd.randrange(0, 5)):
            words += [f"u{rnd.randrange(10**6)}" for _ in range(rnd.randrange(0, 30))]
            p = list(rnd.choice(passages))
            if rnd.random() < .4:
                p[rnd.randrange(len(p))] = "x"
            words += p[rnd.randrange(0, 5):]
            if rnd.random() < .2:
                words += ["the", "same"] * rnd.randrange(1, 40)
        docs.append((d * 7 % n, "  ".join(words)))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    docs = random_docs(seed)
    assert run(spark, docs) == brute(docs)


def test_other_window(spark):
    docs = random_docs(5, 25)
    assert run(spark, docs, 8) == brute(docs, 8)


def test_edge_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, "é b " * 25), (5, "é b " * 25), (6, long),
            (7, "start " + long), (None, "é b " * 25)]
    assert run(spark, docs) == brute(docs)


def test_repeated_rows_ids_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, text, 0), (1, text, 0), (2, text, 0), (1, "other words", 0)],
                               "doc_id long, text string, d int")
    got = sorted(tuple(r)[:3] for r in substring_dedup(df).collect())
    assert got == [(1, 2, 0), (1, 40, 0), (1, 40, 0), (2, 40, 40)]
    assert substring_dedup(df.where("false")).count() == 0


def test_driver_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r[0]: tuple(r)[1:] for r in digest(substring_dedup(docs.withColumn("h1", F.lit(1)))).collect()}
    assert got == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_contexts_are_compared_whole(monkeypatch):
    """Contexts that agree in the upper 31 bits are different ones."""
    mix = S.W.mix
    monkeypatch.setattr(S.W, "mix", lambda x: mix(x) & np.uint64((1 << 33) - 1))
    shared = " ".join(f"s{i}" for i in range(8))
    texts = [" ".join([*(f"{d}a{i}" for i in range(13)), shared, *(f"{d}b{i}" for i in range(13))]) for d in "xyz"]
    batches = [pa.RecordBatch.from_pydict({"_d": [i], "_t": [i], "_text": [t]}) for i, t in enumerate(texts)]
    together = pa.Table.from_batches(batches).combine_chunks().to_batches()
    for chunks in ([together], [[b] for b in batches]):  # in one map chunk, and in several
        sent = [b for chunk in chunks for b in S._anchors(20, 1)(iter(chunk))]
        rows = [r for b in S._settle_buckets(iter(sent)) for r in b.to_pylist()]
        assert not any(r["settled"] for r in rows)
        assert {r["d"] for r in rows if r["compare"]} == {0, 1, 2}
