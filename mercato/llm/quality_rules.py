"""Quality rules whose cutoffs carry a guarantee.

Every document has statistics (``RULES``); a rule rejects a document whose
statistic exceeds the rule's cutoff.  Cutoffs are chosen for each stratum
(language) from a fixed grid, on labelled documents: a cutoff passes if the
exact binomial test rejects "it rejects more than a of the good documents",
P(Bin(n, a) <= k) <= d, for n good labelled documents of which it rejects k.
A rule's cutoffs are tested from the loosest to the tightest up to the first
failure (fixed sequence), so they need no division of d.  delta is shared
evenly by the strata; in a stratum, its delta and alpha are shared by the
rules in proportion to the square of the power they show: the largest excess
of rejected bad over rejected good documents at a cutoff that rejects at
most alpha of the good ones.  Power is measured on a part of the good
documents (one in ``PICK``, by hash of the id) that no test uses, so the
shares do not depend on what is tested, and with probability 1 - delta all
rules together reject at most alpha of the good documents of every stratum.
Among the cutoffs that pass, the lowest one that also rejects some bad
document more often than good ones is used; without one the rule rejects
nothing in that stratum.  One rule with all the power needs
log(delta / strata) / log(1 - alpha) good documents to be tested; strata
with fewer labels keep all their documents.

Statistics come from one pass over whole texts, vectorised over slices; the
labelled counts are aggregated in Spark, cutoffs are chosen for each stratum
from its own counts and joined back, however many strata there are.

Cases: null and blank texts have no words and fail the base rule; a null
language is the stratum ``other``; null labels are ignored; repeated rows
each get a verdict, but are one labelled document (one trial of the test);
without labels the rules reject nothing.  Other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm import words as W
from mercato.llm.store import keep

RUN = 8
ALPHA, DELTA = 0.05, 0.05
#: One in this many good labelled documents measures power and is not tested.
PICK = 5
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_NOT_NEWLINE = ~W.byte_table((0x0A, 0x0A))

#: Shares between 0 and 1 (``word_chars`` is scaled), and the grid of cutoffs.
RULES: dict[str, str] = {
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "upper": "n_upper / greatest(word_chars, 1)",
    "bangs": "n_bangs / greatest(n_words, 1)",
    "long_words": "least(1, word_chars / greatest(n_words, 1) / 20)",
}
GRID = [round(0.01 * i, 2) for i in range(1, 10)] + [round(0.05 * i, 2) for i in range(2, 20)]

_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_bangs"]


def statistics_of(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """The base statistics of each row of a slice."""
    n = len(offs) - 1
    w = W.Words(data, offs)
    hashes = w.hashes()

    def by_byte(flag):
        total = np.r_[0, np.cumsum(flag)]
        return total[offs[1:]] - total[offs[:-1]]

    # a line is its bytes between newlines; equal lines have equal hashes
    lines = W.Words(data, offs, _NOT_NEWLINE)
    has_word = np.zeros(len(lines), dtype=bool)
    if len(w):
        has_word[np.searchsorted(lines.start, w.start, "right") - 1] = True
    row = lines.row[has_word]
    line_hash = W.mix(W.range_sums(W.BYTE_VALUES[data], lines.start[has_word], lines.end[has_word], 0))
    dup = ~_first_of(row, line_hash)
    # words in windows of RUN words that occur twice or more in their row
    at = np.arange(len(w))
    at = at[at + RUN <= w.first[1:][w.row]]
    run_hash = W.mix(W.range_sums(hashes, at, at + RUN, 1))
    again = _repeated(w.row[at], run_hash)
    edge = np.zeros(len(w) + 1, dtype=np.int64)
    np.add.at(edge, at[again], 1)
    np.add.at(edge, at[again] + RUN, -1)
    covered = np.cumsum(edge)[:len(w)] > 0
    return {
        "n_words": w.count,
        "word_chars": by_byte(W.PLAIN[data] & ((data & 0xC0) != 0x80)),
        "n_symbols": by_byte(_SYMBOLS[data]),
        "n_dup_lines": np.bincount(row[dup], minlength=n),
        "n_repeat_words": np.bincount(w.row[covered], minlength=n),
        "n_lines": np.bincount(row, minlength=n),
        "n_upper": by_byte((data >= 0x41) & (data <= 0x5A)),
        "n_bangs": by_byte(data == 0x21),
    }


def _groups(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (row, hash), index last; and where a new pair begins."""
    order = np.lexsort((h, row))
    r, x = row[order], h[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (r[1:] != r[:-1]) | (x[1:] != x[:-1])
    return order, new


def _first_of(row: np.ndarray, h: np.ndarray) -> np.ndarray:
    order, new = _groups(row, h)
    out = np.zeros(len(row), dtype=bool)
    out[order[new]] = True
    return out


def _repeated(row: np.ndarray, h: np.ndarray) -> np.ndarray:
    order, new = _groups(row, h)
    out = np.zeros(len(row), dtype=bool)
    if len(row):
        group = np.cumsum(new) - 1
        out[order] = np.bincount(group)[group] > 1
    return out


def statistics(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               stratum_col: str = "lang") -> DataFrame:
    """doc_id, stratum, and the base statistics of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offs in W.slices(batch, "text"):
                got = statistics_of(data, offs)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("stratum")] +
                    [pa.array(got[c], pa.int64()) for c in _COLUMNS], names=["doc_id", "stratum", *_COLUMNS])

    return documents.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.col(stratum_col).cast("string"), F.lit("other")) if stratum_col in documents.columns
         else F.lit("other")).alias("stratum"),
        F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, stratum string, " + ", ".join(f"{c} long" for c in _COLUMNS))


def base_failed() -> Column:
    return F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words")


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k), summed exactly in logarithms."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
            + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def power_shares(counts: list[tuple[str, str, float, int, int, int, int]], alpha: float = ALPHA
                 ) -> dict[tuple[str, str], float]:
    """(stratum, rule) -> its share of the stratum's alpha and delta, from rows
    as ``choose_cutoffs`` has them, of good documents that are not tested."""
    power: dict[str, dict[str, float]] = {}
    for stratum, rule, _, good, good_out, bad, bad_out in counts:
        mine = power.setdefault(stratum, dict.fromkeys(RULES, 0.0))
        if good and bad and good_out <= alpha * good:
            mine[rule] = max(mine[rule], bad_out / bad - good_out / good)
    shares = {}
    for stratum, mine in power.items():
        total = sum(x * x for x in mine.values())
        shares |= {(stratum, r): x * x / total if total else 1 / len(RULES) for r, x in mine.items()}
    return shares


def choose_cutoffs(counts: list[tuple[str, str, float, int, int, int, int]], alpha: float = ALPHA,
                   delta: float = DELTA, shares: dict[tuple[str, str], float] | None = None,
                   strata: int | None = None) -> dict[tuple[str, str], float]:
    """(stratum, rule) -> cutoff, from rows (stratum, rule, cutoff, good
    labelled, good rejected, bad labelled, bad rejected); ``shares`` as of
    ``power_shares``, even ones without it."""
    strata = strata or len({c[0] for c in counts})
    best: dict[tuple[str, str], float] = {}
    failed = set()
    for stratum, rule, cutoff, good, good_out, bad, bad_out in sorted(counts, key=lambda c: -c[2]):
        share = 1 / len(RULES) if shares is None else shares.get((stratum, rule), 0.0)
        if (stratum, rule) in failed or share == 0:
            continue
        if binomial_tail(good_out, good, alpha * share) > delta * share / strata:
            failed.add((stratum, rule))
        elif bad_out * good > good_out * bad:
            best[stratum, rule] = cutoff
    return best


def labelled_counts(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                    label_col: str = "quality") -> DataFrame:
    """For each stratum, rule and grid cell: good and bad labelled documents
    that the base rule passes; ``picked`` are the good ones that measure power.
    Rows of one id with equal statistics are one document: a copy is no
    further trial.  Copies under several ids are documents of their own, each
    with its label."""
    marks = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.min(label_col).alias("good")))
    # the grid cell of a statistic: how many cutoffs it exceeds
    cell = [sum(((F.expr(stat) > c).cast("int") for c in GRID), F.lit(0)).alias(rule)
            for rule, stat in RULES.items()]
    joined = stats.where(~base_failed()).join(marks, F.col("doc_id") == F.col("_id")).select(
        "doc_id", *_COLUMNS, "stratum", "good", ((F.col("good") == 1) & (F.pmod(F.xxhash64("doc_id"), F.lit(PICK)) == 0)).alias("picked"), *cell)
    return (joined.distinct().select("stratum", "good", "picked", F.explode(F.create_map(
        *(x for r in RULES for x in (F.lit(r), F.col(r))))).alias("rule", "cell"))
        .groupBy("stratum", "rule", "good", "picked", "cell").count())


def stratum_cutoffs(rows: list[tuple], alpha: float, delta: float, strata: int) -> dict[tuple[str, str], float]:
    """Cutoffs of one stratum from its rows of ``labelled_counts``."""
    cells: dict[tuple[str, str], list[list[int]]] = {}
    for stratum, rule, good, picked, cell, n in rows:
        kind = int(good == 1) + int(picked)  # bad, tested good, picked good
        cells.setdefault((stratum, rule), [[0] * (len(GRID) + 1) for _ in range(3)])[kind][cell] += n
    tested, power = [], []
    for (stratum, rule), (bad, *goods) in sorted(cells.items()):
        # grid values in ascending order; a document in cell c exceeds the c smallest
        for i, cutoff in enumerate(sorted(GRID)):
            for out, good in zip((tested, power), goods, strict=True):
                out.append((stratum, rule, cutoff, sum(good), sum(good[i + 1:]), sum(bad), sum(bad[i + 1:])))
    return choose_cutoffs(tested, alpha, delta, power_shares(power, alpha), strata)


def fit_cutoffs(stats: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA,
                id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """stratum, rule, cutoff.  Strata are fitted side by side, each from its
    own counts (rules x grid cells, whatever its size); only their number,
    over which delta is divided, is common."""
    counts = keep(labelled_counts(stats, labels, id_col, label_col), "counts")
    strata = counts.select("stratum").distinct().count()

    def fit(group: pa.Table) -> pa.Table:
        rows = list(zip(*(group[c].to_pylist() for c in ("stratum", "rule", "good", "picked", "cell", "count")), strict=True))
        found = [(s, r, c) for (s, r), c in sorted(stratum_cutoffs(rows, alpha, delta, strata).items())]
        return pa.table({n: [f[i] for f in found] for i, n in enumerate(("stratum", "rule", "cutoff"))},
                        schema=pa.schema([("stratum", pa.string()), ("rule", pa.string()), ("cutoff", pa.float64())]))

    return counts.groupBy("stratum").applyInArrow(fit, "stratum string, rule string, cutoff double")


def quality_rules(documents: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA,
                  id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
                  label_col: str = "quality") -> DataFrame:
    """doc_id, stratum, statistics, base_failed, rejected_by (rules), kept."""
    stats = keep(statistics(documents, id_col, text_col, stratum_col), "statistics")
    cutoffs = fit_cutoffs(stats, labels, alpha, delta, id_col, label_col)
    # one row a stratum, written first: the planner sees its size when it joins
    limits = keep(cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_limits")), "cutoffs")
    stats = stats.join(limits, "stratum", "left").select(*stats.columns, "_limits")
    over = [F.when(F.expr(stat) > F.col("_limits")[rule], F.lit(rule)) for rule, stat in RULES.items()]
    rejected = F.array_compact(F.array(*over))
    return (stats.withColumn("base_failed", base_failed()).withColumn("rejected_by", rejected)
            .withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)).drop("_limits"))


def digest(judged: DataFrame) -> DataFrame:
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "rejected_by")
