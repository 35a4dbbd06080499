import random
import re
from collections import Counter, defaultdict

import pytest

from mercato.llm import mixing as M
from tests.conftest import SF_CHECK

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_targets(size):
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None] * (None in size)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(size.values()), set(names), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if unit * weight[s] > 2 * size[s]]
        if not over:
            return out | {s: unit * weight[s] for s in open_}
        for s in over:
            out[s] = 2.0 * size[s]
            left -= out[s]
            open_.discard(s)
    return out


def check(spark, rows, block=M.BLOCK):
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int").repartition(3)
    got = M.digest(M.mix(df)).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want = brute_targets(dict(sizes))
    src = {d: s for d, _, s in rows}
    assert sorted(str((r.doc_id, r.size)) for r in got) == sorted(str((d, len(WORD.findall(t or "")))) for d, t, _ in rows)
    taken = defaultdict(int)
    for r in got:
        s = src[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s in want:
        assert abs(taken[s] - want[s]) <= max(0.01 * want[s], 2 * block), s
    assert sorted(map(str, got)) == sorted(map(str, M.digest(M.mix(df.repartition(2))).collect()))
    return got


def test_driver_table(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    check(spark, [(r.doc_id, r.text, r.source) for r in docs.collect()])


def test_uneven_sources(spark):
    rnd = random.Random(3)
    names = ["a", "b", "é", "z", None, "", "B", "𝄞"]
    rows = [(i, " ".join("w" * 3 for _ in range(rnd.randrange(0, 400))), rnd.choice(names[:1] * 8 + names))
            for i in range(500)] + [(900, None, "empty"), (901, " \n", "empty")]
    check(spark, rows)


def test_several_shards_and_full_repeats(spark, monkeypatch):
    monkeypatch.setattr(M, "SHARD_WORDS", 300)
    rnd = random.Random(5)
    rows = [(i, "x " * rnd.randrange(60), "big" if i % 3 else "small") for i in range(600)]
    check(spark, rows, block=40 * M.BLOCK)


def test_edge_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert M.mix(df).count() == 0
    blank = spark.createDataFrame([(1, None, None), (1, None, None), (None, "", "a")], df.schema)
    assert [(r.size, r.taken, r.target) for r in M.mix(blank).collect()] == [(0, 0, 0.0)] * 3
    long = spark.createDataFrame([(1, "w " * 300_000, "a"), (1, "w " * 300_000, "a"), (None, "one", None)], df.schema)
    got = M.mix(long).collect()
    assert sum(r.taken for r in got) == pytest.approx(900_000, rel=.01) and all(r.taken <= 2 * r.size for r in got)
    kept = M.mixed_documents(long)
    assert kept.columns == [*long.columns, "taken"]
    assert sorted(r.taken for r in kept.collect()) == sorted(r.taken for r in got if r.taken)


def test_output_can_be_mixed_again_and_clashing_names(spark):
    df = spark.createDataFrame([(i, "a b c " * (i % 5 + 1), "s", 7, 8, 9, 10) for i in range(30)],
                               "doc_id long, text string, source string, taken int, _d int, _T int, _n int")
    once = M.mixed_documents(df)
    assert once.columns == ["doc_id", "text", "source", "_d", "_T", "_n", "taken"]
    twice = M.mixed_documents(once)
    assert twice.columns == once.columns and twice.count() > 0
    assert {(r["_d"], r["_T"], r["_n"]) for r in twice.collect()} == {(8, 9, 10)}


def test_blocks_add_up_to_what_is_taken(spark, monkeypatch):
    monkeypatch.setattr(M, "SHARD_WORDS", 500)
    rnd = random.Random(9)
    rows = [(i, " ".join(["w"] * rnd.randrange(0, 90)), rnd.choice(["a", "a", "b", None])) for i in range(120)] + [(None, "x y z", "b")] * 4
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for block in (8, 50):
        words, of = Counter(), {}
        for r in M.mixed_blocks(df, block=block).collect():
            assert 0 <= r.first_word <= r.last_word and r.last_word - r.first_word < block and 1 <= r.times <= 2
            words[r.doc_id, r.t] += (r.last_word - r.first_word + 1) * r.times
            of.setdefault((r.doc_id, r.t), []).append((r.first_word, r.last_word))
        taken = Counter()
        for r in M.mix(df, block=block).collect():
            taken[r.doc_id, r.t] += r.taken
            if r.doc_id is not None and r.taken:
                assert max(b for _, b in of[r.doc_id, r.t]) < r.size
        assert +words == +taken


def test_repeated_rows_are_spread_over_shards(spark, monkeypatch):
    """A third of the rows has neither id nor text, a third is one row."""
    monkeypatch.setattr(M, "SHARD_WORDS", 400)
    monkeypatch.setattr(M, "RUN", 10)
    rows = [(None, None, "a")] * 300 + [(None, "one two three", "a")] * 300 + [(i, "x y " * (i % 7), "b") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = M.mix(df).collect()
    assert len(got) == 900 and all(r.taken <= 2 * r.size for r in got)
    target = {r.source_size: r.target for r in got}
    for size, goal in target.items():
        assert abs(sum(r.taken for r in got if r.source_size == size) - goal) <= 0.02 * goal  # shards of 400 words
    plan = M.mix(df)._jdf.queryExecution().executedPlan().toString()
    assert "_o#" in plan and "run#" in plan  # the stream runs over entries, not rows
    assert sorted(map(str, got)) == sorted(map(str, M.mix(df.repartition(2)).collect()))


def test_sainte_lague_against_quotients(spark):
    rnd = random.Random(8)
    rows = []
    for g in range(12):
        seats = rnd.choice([0, 1, 3, 7, 50, 1000])
        rows += [(g, f"p{i}", float(rnd.choice([0, 1, 5, 5, 100, rnd.random() * 1000])), seats)
                 for i in range(rnd.randrange(1, 9))]
        rows.append((g, "sure", 3.0, seats))
    got = M.sainte_lague(spark.createDataFrame(rows, "g int, name string, claim double, seats long"), ["g"], "name")
    quota = {(r.g, r.name): r.quota for r in got.collect()}
    for g in range(12):
        mine = [r for r in rows if r[0] == g]
        qs = sorted(((-c / (2 * k - 1), n) for _, n, c, s in mine if c for k in range(1, s + 1)))[:mine[0][3]]
        won = Counter(n for _, n in qs)
        assert {n: quota[g, n] for _, n, _, _ in mine} == {n: won[n] for _, n, _, _ in mine}
