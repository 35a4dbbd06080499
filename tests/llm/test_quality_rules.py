import math
import random
import re

import pytest

from mercato.llm import quality_rules as R
from tests.conftest import SF_CHECK

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    runs = {}
    for i in range(len(w) - 7):
        runs.setdefault(tuple(w[i:i + 8]), []).append(i)
    covered = {j for at in runs.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def failed(n, _c, _s, _d, r):
    return n < 20 or 100 * r > 30 * n


def base(rows):
    return sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                   for r in rows), key=str)


def want(docs):
    return sorted(((d, *brute(t), failed(*brute(t))) for d, t in docs), key=str)


def test_driver_table_and_held_out_risk(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    rows = R.digest(R.quality_rules(docs, labels)).collect()
    assert base(rows) == want([(r.doc_id, r.text) for r in docs.collect()])
    truth = {r.doc_id: r.quality for r in labels.collect()}
    kept = [(r.kept, truth[r.doc_id]) for r in rows if r.doc_id in truth and not r.base_failed]
    good = [k for k, y in kept if y == 1]
    assert 1 - sum(good) / len(good) <= R.ALPHA
    assert all(r.kept == (not r.base_failed and not r.rejected_by) for r in rows)


def test_statistics_against_brute_force(spark):
    rnd = random.Random(9)
    docs = [(i, "".join(rnd.choices(["a b c d e f g h i ", "a b\n", "x", "é", " ", "\n", "\r\n", "#*", "\t", "z! ", "\x0b"],
                                    k=rnd.randrange(60)))) for i in range(300)]
    docs += [(900, None), (901, ""), (901, ""), (None, "\n \n"), (902, "long " * 40_000), (903, " ".join(map(str, range(30_000))))]
    df = spark.createDataFrame([(*d, "en", 1) for d in docs], "doc_id long, text string, lang string, n_words int")
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 1)], "doc_id long, quality int")
    assert base(R.digest(R.quality_rules(df.repartition(4), labels)).collect()) == want(docs)
    assert R.quality_rules(df.where("false"), labels.where("false")).count() == 0


def test_binomial_tail_is_exact():
    for n, k, p in ((1, 0, .3), (20, 3, .05), (300, 2, .01), (50, 50, .2)):
        exact = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(min(k, n) + 1))
        assert R.binomial_tail(k, n, p) == pytest.approx(min(1, exact))


def test_cutoffs_keep_the_bound():
    rows = [("en", "symbols", .01, 5000, 60, 400, 390), ("en", "symbols", .02, 5000, 3, 400, 380),
            ("en", "symbols", .5, 5000, 0, 400, 10), ("en", "upper", .3, 5000, 0, 400, 0),
            ("fr", "symbols", .02, 30, 0, 10, 10)]
    got = R.choose_cutoffs(rows)
    assert got == {("en", "symbols"): .02}  # .01 rejects too many; fr has too few labels; upper is useless


def test_rules_reject_junk(spark):
    rnd = random.Random(1)

    def text(bad):
        return " ".join(("%%% " if bad else "") + "".join(rnd.choices("abcdefgh", k=5)) for _ in range(40))
    docs = [(i, text(i % 4 == 0), "en") for i in range(4000)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(4000)], "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in R.quality_rules(df, labels).collect()}
    assert all(kept[i] == (i % 4 > 0) for i in kept)
    none = R.quality_rules(df.drop("lang"), labels.where("false")).where("kept").count()
    assert none == 4000


def test_bad_documents_go_in_every_language(spark):
    rnd = random.Random(3)

    def text(bad):
        return " ".join(("%%% " if bad else "") + "".join(rnd.choices("abcdefgh", k=5)) for _ in range(40))
    docs = [(i, text(i % 10 == 0), lang) for i, lang in enumerate(["de", "en", "es", "fr"] * 340)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 10 > 0)) for i in range(len(docs))], "doc_id long, quality int")
    rows = R.quality_rules(df, labels).collect()
    assert all(r.kept == (r.doc_id % 10 > 0) for r in rows)


def test_fixed_sequence_and_power_shares():
    def row(cutoff, good_out, bad_out, good=5000, rule="symbols"):
        return ("en", rule, cutoff, good, good_out, 400, bad_out)
    # a pass below the first failure does not count
    assert R.choose_cutoffs([row(.1, 0, 100), row(.05, 400, 300), row(.02, 0, 390)]) == {("en", "symbols"): .1}
    shares = R.power_shares([row(.1, 0, 300), row(.05, 4000, 400), row(.3, 0, 100, rule="upper")])
    assert shares["en", "symbols"] == pytest.approx(.9) and shares["en", "upper"] == pytest.approx(.1)
    # one rule with all the power needs log(delta) / log(1 - alpha) = 59 good documents
    for good, want_ in ((58, {}), (59, {("en", "symbols"): .1})):
        assert R.choose_cutoffs([row(.1, 0, 300, good)], shares={("en", "symbols"): 1.0}) == want_


def _stats(spark, sql):
    zeros = ", ".join(f"CAST(coalesce({{0}}, 0) AS LONG) AS {c}".replace("{0}", "40" if c == "n_words" else "400" if c == "word_chars" else "0")
                      for c in R._COLUMNS if c != "n_symbols")
    return spark.sql(sql.replace("ZEROS", zeros)).select("doc_id", "stratum", *R._COLUMNS)


def test_a_document_repeated_is_one_trial(spark):
    """Twenty good documents, one of them 500 times, are too few to test."""
    once = _stats(spark, "SELECT id AS doc_id, 'en' AS stratum, IF(id < 20, 0L, 300L) AS n_symbols, ZEROS FROM range(40)")
    labels = spark.sql("SELECT id AS doc_id, CAST(id < 20 AS INT) AS quality FROM range(40)")
    copies = once.unionAll(once.where("doc_id = 3").crossJoin(spark.range(500)).drop("id"))
    for stats in (once, copies):
        assert R.fit_cutoffs(stats, labels).collect() == []
    counts = R.labelled_counts(copies, labels).where("rule = 'symbols'").groupBy("good").sum("count").collect()
    assert sorted(map(tuple, counts)) == [(0, 20), (1, 20)]


def test_every_one_of_many_strata_has_its_own_cutoffs(spark):
    """Good documents of stratum s have a symbol share of (s % 3) / 10."""
    n, strata = 360, 1100
    good = "id % 12 > 0"
    sql = f"SELECT id AS doc_id, CAST(id DIV {n} AS STRING) AS stratum, IF({good}, (id DIV {n}) % 3 * 40L, 200L) AS n_symbols, ZEROS FROM range({n * strata})"
    labels = spark.sql(f"SELECT id AS doc_id, CAST({good} AS INT) AS quality FROM range({n * strata})")
    got = {r.stratum: r.cutoff for r in R.fit_cutoffs(_stats(spark, sql), labels).collect() if r.rule == "symbols"}
    assert len(got) == strata
    for s, cutoff in got.items():
        assert int(s) % 3 / 10 <= cutoff < 0.5
    assert len({got[str(s)] for s in range(3)}) == 3
