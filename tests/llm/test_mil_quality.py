import math
import re
import zlib

import numpy as np
import pytest

from mercato.llm import mil_quality as Q
from mercato.llm import words as W
from tests.conftest import SF_CHECK, SF_SMALL


def features(texts):
    raw = [t.encode() for t in texts]
    return Q.passages(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw]))


def test_passages_cover_whole_texts():
    texts = ["", "one", " ".join(["Word"] * 130), "  a\tb\n\n" * 40, "é" * 9]
    x, per_row = features(texts)
    assert per_row.tolist() == [1, 1, 3, 2, 1]
    n = np.expm1(x[:, Q.N_CLASSES]).round().astype(int)
    assert n.tolist() == [0, 1, 64, 64, 2, 64, 16, 1]
    alone = [features([t])[0] for t in texts]
    assert np.allclose(x, np.concatenate(alone))


def test_gradients():
    rng = np.random.default_rng(0)
    x, per_row = rng.normal(size=(40, 5)), np.full(10, 4)
    y = (rng.random(10) < .5).astype(float)
    y[:2] = 0, 1
    model = Q.fit(x, per_row, y, hidden=3, gate=2, steps=0)
    for name in ("W", "V", "U", "w", "c"):  # one tiny step along -gradient lowers the loss
        p = model.weights

        def loss(q):
            s = Q.Model(q).scores(x, per_row)
            return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))
        p = p | {"c": rng.normal(size=3)}
        base = loss(p)
        moved = Q.fit(x, per_row, y, hidden=3, gate=2, steps=60)
        assert loss(moved.weights) < base, name


def test_model_round_trip_and_constants():
    x, per_row = features(["some words here", "OTHER!! TEXT!!"])
    model = Q.fit(x, per_row, np.array([1.0, 0.0]), steps=50)
    again = Q.Model.load(model.dump())
    assert np.array_equal(model.scores(x, per_row), again.scores(x, per_row))
    assert Q.fit(x, per_row, np.array([1.0, 1.0])).scores(x, per_row).tolist() == [1.0, 1.0]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    got = Q.quality_scores(docs, Q.train(docs, labels))
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= .3) for r in rows)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    good = [p for p, y in held if y == 1]
    bad = [p for p, y in held if y == 0]
    assert sum(good) / len(good) >= .95 and sum(bad) / len(bad) <= .2


def test_only_the_text_counts(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    model = Q.train(docs, labels)
    plain = {r.doc_id: r.score for r in Q.quality_scores(docs, model).collect()}
    other = docs.selectExpr("doc_id + 7 AS doc_id", "text", "'x' AS lang", "'y' AS source")
    assert {r.doc_id - 7: r.score for r in Q.quality_scores(other, model).collect()} == pytest.approx(plain)


def test_edge_rows(spark):
    long = " ".join(f"w{i}" for i in range(50_000))
    rows = [(1, None), (2, ""), (2, ""), (None, "some text"), (3, long), (4, "\n \t")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 0), (9, 0)], "doc_id long, quality int")
    got = Q.quality_scores(docs, Q.train(docs, labels)).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out for r in got if r.doc_id is None)
    kept = Q.keep_good(docs, labels.where("false"))
    assert kept.columns == docs.columns and kept.count() == 6
    assert Q.quality_scores(docs.where("false"), Q.train(docs.where("false"), labels)).count() == 0


def test_slices_are_bounded():
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"text": ["x" * 10, None, "é" * 6, "z" * 50, ""]})
    got = [(p.num_rows, d.tobytes().decode(), o.tolist()) for p, d, o in W.slices(batch, "text", 15)]
    assert got == [(2, "x" * 10, [0, 10, 10]), (1, "é" * 6, [0, 12]), (1, "z" * 50, [0, 50]), (1, "", [0, 0])]


def test_rows_of_one_id_are_one_document_of_the_sample(spark, monkeypatch):
    """A third of the rows has one id, a third has none."""
    from pyspark.sql import functions as F
    ids = [r.i for r in spark.range(200).select(F.col("id").alias("i")).where(~Q.held_out("i")).collect()]
    rows = [(ids[0], f"text {i % 7}", 1) for i in range(300)] + [(None, "x", 1)] * 300 + [(i, f"good words {i}", 1) for i in ids]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id int")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in ids] * 2, "doc_id long, quality int, y int")
    seen = []
    fit = Q.fit
    monkeypatch.setattr(Q, "fit", lambda x, size, y, *a, **k: seen.append(len(size)) or fit(x, size, y, *a, **k))
    Q.train(docs, labels, sample=4)
    Q.train(docs, labels, sample=1000)
    assert seen == [4, len(ids)]
    # the same model whatever the order and the copies of equal rows
    one = Q.train(docs.repartition(7).unionAll(docs), labels, sample=1000).dump()
    assert one == Q.train(docs, labels, sample=1000).dump()


def plain_passages(text):
    """Feature vectors of a text's passages, word by word."""
    raw = (text or "").encode()
    words = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
    starts = list(range(0, len(words), Q.PASSAGE)) or [0]
    runs, out = set(), []
    for k, first in enumerate(starts):
        mine = words[first:first + Q.PASSAGE]
        lo = words[first][0] if k else 0
        hi = words[starts[k + 1]][0] if k + 1 < len(starts) else len(raw)
        part = raw[lo:hi]
        shares = [sum(b in c.encode() for b in part) for c in Q.CLASSES]
        listed = {b for c in Q.CLASSES for b in c.encode()}
        shares += [sum(b < 0x80 and b not in listed for b in part), sum(0x80 <= b < 0xC0 for b in part), sum(b >= 0xC0 for b in part)]
        chars = max(1, sum(not 0x80 <= b < 0xC0 for b in part))
        n, some = len(mine), max(1, len(mine))
        lengths = [b - a for a, b in mine]
        mean = sum(lengths) / some
        seen, again, run_again = set(), 0, 0
        for i, (a, b) in enumerate(mine):
            again += raw[a:b] in seen
            seen.add(raw[a:b])
            run = tuple(raw[x:y] for x, y in words[first + i:first + i + 4])
            if len(run) == 4:
                run_again += run in runs
                runs.add(run)
        out.append([s / chars for s in shares] + [
            math.log1p(n), mean, math.sqrt(max(0, sum(x * x for x in lengths) / some - mean ** 2)), again / some, run_again / some,
            sum(x <= 3 for x in lengths) / some, sum(65 <= raw[a] <= 90 for a, _ in mine) / some, math.log1p(shares[8] / some)])
    return out


def plain_score(p, text):
    """The gated attention score of a text, number by number."""
    dot = lambda x, m, j: sum(v * m[i][j] for i, v in enumerate(x))
    hs, es = [], []
    for x in plain_passages(text):
        x = [min(8, max(-8, (v - m) / s)) for v, m, s in zip(x, p["mean"], p["std"])]
        h = [math.tanh(dot(x, p["W"], j) + b) for j, b in enumerate(p["b"])]
        hs.append(h)
        es.append(sum(w * math.tanh(dot(h, p["V"], j)) / (1 + math.exp(-dot(h, p["U"], j))) for j, w in enumerate(p["w"])))
    a = [math.exp(e - max(es)) for e in es]
    z = [sum(w * h[j] for w, h in zip(a, hs)) / sum(a) for j in range(len(p["b"]))]
    logit = sum(c * v for c, v in zip(p["c"], z)) + float(p["d"])
    return 1 / (1 + math.exp(-min(30, max(-30, logit))))


def test_scores_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = Q.train(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, " \n\n"), (-4, "é中 " * 200), (-5, "same words here again " * 90)], "doc_id long, text string")
    rows = docs.select("doc_id", "text").where("length(text) < 6000").unionAll(odd)
    texts = {r.doc_id: r.text for r in rows.collect()}
    got = Q.quality_scores(rows, model).collect()
    assert len(got) > 150
    for r in got:
        assert r.score == pytest.approx(plain_score(model.weights, texts[r.doc_id]), abs=1e-9)


def test_every_labelled_document_is_fitted_in_any_layout(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    whole = Q.train(docs, labels)  # one shard
    monkeypatch.setattr(Q, "SHARD", 60)
    seen = []
    shards = Q._shards
    monkeypatch.setattr(Q, "_shards", lambda rows, n: seen.append((shards(rows, n), n)) or seen[0][0])
    model = Q.train(docs, labels)
    truth = {r.doc_id: r.quality for r in labels.where(~Q.held_out()).collect()}
    rows, n = seen[0][0].collect(), seen[0][1]
    assert n == -(-len(truth) // 60) == len(rows) > 3
    assert sum(len(r.y) // 8 for r in rows) == len(truth) and sum(np.frombuffer(r.y).sum() for r in rows) == sum(truth.values())
    again = Q.train(docs.orderBy(docs.doc_id.desc()).repartition(7).unionAll(docs), labels.unionAll(labels))
    assert model.dump() == again.dump()
    assert all(np.allclose(model.weights[k], whole.weights[k]) for k in ("mean", "std"))
    got = {r.doc_id: r.predicted for r in Q.quality_scores(docs, model).where("held_out").collect()}
    held = [(got[r.doc_id], r.quality) for r in labels.collect() if r.doc_id in got]
    assert np.mean([p for p, y in held if y]) >= .95 and np.mean([p for p, y in held if not y]) <= .2


def test_no_default_sample_of_labels(spark):
    ids = [r.id for r in spark.range(6000).where(~Q.held_out("id")).collect()]
    assert len(ids) > Q.SHARD
    docs = spark.createDataFrame([(i, f"word {i}" if i % 2 else "### ### ###") for i in ids], "doc_id long, text string")
    model = Q.train(docs, spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int"))
    assert model.constant is None
    x, size = zip(*(Q.passages(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)])) for t in
                    (f"word {i}" if i % 2 else "### ### ###" for i in ids)), strict=True)
    assert np.allclose(model.weights["mean"], np.concatenate(x).mean(axis=0))
