import pytest

import corpus_pipeline as P
from mercato.llm import mil_quality as Q
from mercato.llm.store import keep
from tests.conftest import SF_SMALL
from tests.llm import test_decontaminate as bench
from tests.llm import test_secrets_cnn as secret
from tests.llm.test_mixing import WORD, brute_targets
from tests.llm.test_simhash import brute_components, brute_fingerprint


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and output rows, as the driver runs them."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = {}
    for name, stage in P.STAGES:
        after = keep(stage(spark, docs, SF_SMALL), name)
        if name != "mix":
            assert after.columns == docs.columns
        out[name] = ([r.asDict() for r in docs.collect()], [r.asDict() for r in after.collect()])
        docs = after
    return out


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_quality_stage_follows_its_scores(spark, stages):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    scores = Q.quality_scores(docs, Q.train(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet")))
    before, after = stages["quality"]
    assert ids(after) == sorted(r.doc_id for r in scores.where("predicted = 1").collect())
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    kept = set(ids(after))
    good = [d in kept for d, q in truth.items() if q == 1]
    assert sum(good) / len(good) >= .95


def test_one_of_each_near_copy_stays(stages):
    before, after = stages["near_dedup"]
    groups = brute_components({r["doc_id"]: brute_fingerprint(r["text"]) for r in before})
    assert ids(after) == sorted(set(groups.values()))


def test_contaminated_documents_go(spark, stages):
    before, after = stages["decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    judged = bench.brute([(r["doc_id"], r["text"]) for r in before], items)
    assert ids(after) == sorted(r[0] for r in judged if not r[5])


def test_secrets_are_redacted(stages):
    before, after = stages["secrets"]
    assert ids(before) == ids(after)
    texts = {r["doc_id"]: r["text"] for r in before}
    for r in after:
        found = secret.brute(texts[r["doc_id"]])
        assert not secret.brute(r["text"]) and r["n_chars"] == len(r["text"])
        if not found:
            assert r["text"] == texts[r["doc_id"]]


def test_mix_meets_its_targets(stages):
    before, after = stages["mix"]
    size, taken = {}, {}
    for r in before:
        size[r["source"]] = size.get(r["source"], 0) + len(WORD.findall(r["text"]))
    for r in after:
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        assert 0 < r["taken"] <= 2 * len(WORD.findall(r["text"]))
    for s, t in brute_targets(size).items():
        assert abs(taken[s] - t) <= max(.02 * t, 16)


EDGES = [(1, None, "en", "a", 0), (1, None, "en", "a", 0), (2, "", None, None, None), (None, "some words of text", "en", "a", 3),
         (None, None, None, None, None), (4, " ".join(f"w{i}" for i in range(30_000)), "en", "b", 1), (5, "\n \t", "en", "b", 1)]


def test_stages_take_edge_rows_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for rows in (EDGES, []):
        start = spark.createDataFrame(rows, schema).selectExpr("*", "1 AS fp", "'x' AS t", "2 AS size", "'y' AS item_id")
        for name, stage in P.STAGES:
            got = stage(spark, start, SF_SMALL)
            assert got.columns[:len(start.columns)] == start.columns, name
            n = got.count()
            assert n <= len(rows) and (n > 0 or not rows or name == "mix"), name
