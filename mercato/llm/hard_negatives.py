"""Hard negatives of anchors by a secondary-sort shuffle.

Every anchor scores all rows by the inner product of integer vectors.  Pairs
travel as packed keys (anchor, descending score, id), are dealt by anchor and
sorted inside the partitions by the shuffle; one pass over a partition then
opens a window for each positive as it comes by and hands the negatives that
follow to the open windows, holding a few numbers an anchor.

A score is needed only if it is among an anchor's first positives or among the
first negatives of one of its windows, so pairs are cut before the shuffle,
exactly: anchors and rows are dealt to a grid of cells, a cell keeps what can
still matter (its first positives; then, once the positives are known, its
first negatives in each window), and an anchor's pairs are the remains of one
row of cells.  The grid grows with the square root of the table, so neither a
cell nor an anchor's pairs gather everything.  All rows meet all anchors, block
by block: that is the query itself.

Windows are percentages of the positive's score, ``low`` < ``high`` < 100, so
that a window lies behind its positive; the negatives of score 0 that sort
before a positive of score 0 are held (at most ``negatives`` of them).

Defined results: rows with a null id or label, a null vector, or null or
non-finite components take no part.  Of rows with one id, the smallest by
(label, vector) counts.  Vectors of different lengths are compared over the
components both have.  Equal scores go by the smaller id.  A positive of
negative score has no window.  An empty table, or one without anchors, gives
an empty result; scores beyond 64 bits are an error.  Only the columns named by
the parameters are read.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.store import keep
from mercato.llm.vectors import EXACT, integer_vectors, matrix

POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
#: Bytes of vectors that a cell takes from either side, at most about.
CELL_BYTES = 1 << 26
#: Scores of one numpy step.
STEP = 1 << 21
#: Pairs of one partition of the sorting shuffle, about.
SORTED_PAIRS = 1 << 15

OUTPUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_SIGN = np.uint64(1 << 63)
_KEY = struct.Struct(">QQQ")


# -- keys -----------------------------------------------------------------
def pack(anchor: np.ndarray, score: np.ndarray, id_: np.ndarray) -> pa.Array:
    """24-byte keys whose byte order is (anchor, descending score, id)."""
    words = np.empty((len(anchor), 3), dtype=">u8")
    words[:, 0] = anchor.astype(np.int64).view(np.uint64) ^ _SIGN
    words[:, 1] = ~(score.astype(np.int64).view(np.uint64) ^ _SIGN)
    words[:, 2] = id_.astype(np.int64).view(np.uint64) ^ _SIGN
    return pa.Array.from_buffers(pa.binary(24), len(words), [None, pa.py_buffer(words.tobytes())]).cast(pa.binary())


def unpack(key: bytes) -> tuple[int, int, int]:
    anchor, score, id_ = _KEY.unpack(key)
    return anchor - (1 << 63), (1 << 63) - 1 - score, id_ - (1 << 63)


def by_anchor(key: bytes) -> int:
    return zlib.crc32(key[:8])


# -- cells ----------------------------------------------------------------
def first_of(score: np.ndarray, k: int, none: float) -> np.ndarray:
    """Marks the k largest of each row, equal ones from the left; ``none``
    marks what does not count."""
    if score.shape[1] <= k:
        return score != none
    least = np.partition(score, score.shape[1] - k, axis=1)[:, -k][:, None]
    over = score > least
    equal = (score == least) & (least != none)
    return over | (equal & (equal.cumsum(axis=1) <= k - over.sum(axis=1)[:, None]))


class Cell:
    """Scores of a cell's anchors against its rows, rows by ascending id."""

    def __init__(self, anchors: pa.Table, rows: pa.Table):
        self.n = min(anchors.num_rows, rows.num_rows)
        if not self.n:
            return
        self.anchor = anchors["id"].to_numpy()
        self.anchor_label = anchors["label"].to_numpy()
        order = np.argsort(rows["id"].to_numpy())
        self.id, self.label = rows["id"].to_numpy()[order], rows["label"].to_numpy()[order]
        width = max(np.diff(np.asarray(t["q"].combine_chunks().offsets)).max() for t in (anchors, rows))
        a, b = matrix(anchors["q"], width), matrix(rows["q"], width)[order]
        bound = 100 * max(1, width) * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
        if bound >= 1 << 63:
            raise OverflowError("scores of these vectors pass 64 bits")
        kind = np.float64 if bound < EXACT else np.int64
        self.a, self.b = a.astype(kind), b.astype(kind).T
        self.none = -np.inf if kind is np.float64 else np.iinfo(np.int64).min

    def steps(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """Runs of anchors with their scores and whether the labels agree."""
        if self.n:
            step = max(1, STEP // len(self.id))
            for lo in range(0, len(self.anchor), step):
                at = slice(lo, lo + step)
                yield at, self.a[at] @ self.b, self.anchor_label[at, None] == self.label

    def pairs(self, at: slice, score: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, column = np.nonzero(kept)
        return self.anchor[at][row], score[row, column].astype(np.int64), self.id[column]


def _joined(parts: list[tuple[np.ndarray, ...]], n: int) -> list[np.ndarray]:
    return [np.concatenate([np.zeros(0, dtype=np.int64), *(p[i] for p in parts)]) for i in range(n)]


def _grid(rows: DataFrame, anchors: Column, dealt: DataFrame):
    """Anchors (with what ``dealt`` knows about them) and rows, grouped by cell."""
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(anchors, 1)).alias("a"), F.max(F.size("q")).alias("d")).first()
    wide = 4 * (size["d"] or 0) + 16
    down = max(1, math.ceil(math.sqrt(size["n"]) / 32), math.ceil(size["n"] * wide / CELL_BYTES))
    across = max(1, math.ceil(size["a"] * wide / CELL_BYTES))
    line, column = F.pmod(F.xxhash64("id"), F.lit(down)), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(across))
    left = dealt.withColumn("_c", column).withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(down - 1))))
    rows = rows.select(*[F.col(c).alias(c) for c in rows.columns])  # columns of their own, for both sides come from one table
    right = rows.withColumn("_r", line).withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    cell = (F.col("_c") * down + F.col("_r")).alias("cell")
    return left.drop("cell").withColumn("cell", cell).groupBy("cell").cogroup(right.withColumn("cell", cell).groupBy("cell"))


def first_positives(rows: DataFrame, anchors: Column, positives: int = POSITIVES) -> DataFrame:
    """The first rows of each anchor's own label: anchor_id, id, score."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        cell, found = Cell(left, right), []
        for at, score, same in cell.steps():
            scores = np.where(same & (cell.anchor[at, None] != cell.id), score, cell.none)
            found.append(cell.pairs(at, score, first_of(scores, positives, cell.none)))
        return pa.table(dict(zip(("anchor_id", "score", "id"), _joined(found, 3), strict=True)))

    cells = _grid(rows, anchors, rows.where(anchors)).applyInArrow(run, "anchor_id long, score long, id long")
    # at most ``positives`` from each cell of the anchor's row
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "id"))), 1, positives)
    return (cells.groupBy("anchor_id").agg(best.alias("p")).select("anchor_id", F.explode("p").alias("p"))
            .select("anchor_id", "p.id", (-F.col("p.s")).alias("score")))


def window_pairs(rows: DataFrame, anchors: Column, found: DataFrame, negatives: int, low: int, high: int) -> DataFrame:
    """Packed keys of the positives, and of the negatives that can be among
    the first of a window."""
    scores = found.where("score >= 0").groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list("score").alias("p"))
    dealt = rows.where(anchors).join(scores, "id")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        cell, out = Cell(left, right), []
        if cell.n:
            p = left["p"].to_pylist()
            most = max(map(len, p))
            p = np.array([x + [-1] * (most - len(x)) for x in p], dtype=np.int64)
        for at, score, same in cell.steps():
            kept = np.zeros(score.shape, dtype=bool)
            scores = np.where(same, cell.none, 100 * score)
            for k in range(p.shape[1]):
                bound = p[at, k, None]
                inside = (bound >= 0) & (scores >= low * bound) & (scores <= high * bound) & ~same
                kept |= first_of(np.where(inside, score, cell.none), negatives, cell.none)
            out.append(cell.pairs(at, score, kept))
        keys = pack(*_joined(out, 3))
        return pa.table({"key": keys, "positive": pa.array(np.zeros(len(keys), dtype=bool))})

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pydict({"key": pack(*(b[c].to_numpy() for c in ("anchor_id", "score", "id"))),
                                              "positive": pa.array(np.ones(b.num_rows, dtype=bool))})

    kind = "key binary, positive boolean"
    return _grid(rows, anchors, dealt).applyInArrow(run, kind).unionAll(found.select("anchor_id", "score", "id").mapInArrow(keys, kind))


# -- the sorted stream -----------------------------------------------------
def open_windows(pairs: Iterable[tuple[bytes, bool]], negatives: int, low: int, high: int
                 ) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Result rows of a partition's sorted pairs, one at a time."""
    current, windows, zeros = None, [], []
    for key, positive in pairs:
        anchor, score, id_ = unpack(key)
        if anchor != current:
            current, windows, zeros = anchor, [], []
        if positive:
            windows.append([id_, score, 0])
            for earlier in zeros if score == 0 else ():
                windows[-1][2] += 1
                yield anchor, id_, windows[-1][2], earlier, 0, 0
            continue
        for window in windows:
            if window[2] < negatives and low * window[1] <= 100 * score <= high * window[1]:
                window[2] += 1
                yield anchor, window[0], window[2], id_, window[1], score
        if score == 0 and len(zeros) < negatives:
            zeros.append(id_)


def hard_negatives(df: DataFrame, anchors: Column, id_: str = "vec_id", vector: str = "embedding", label: str = "label",
                   positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
                   scale: int = 256) -> DataFrame:
    """For each anchor (rows where ``anchors``, a condition on the column
    ``id``) and each of its first ``positives`` rows of the same label, the
    first ``negatives`` rows of other labels whose score lies between ``low``
    and ``high`` percent of the positive's."""
    if not 0 <= low < high < 100:
        raise ValueError("a window must lie behind its positive: 0 <= low < high < 100")
    plain = df.select(F.col(id_).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).alias("_v"))
    rows = integer_vectors(plain.where("id IS NOT NULL AND label IS NOT NULL"), ["id", "label"], "_v", scale)
    rows = keep(rows.groupBy("id").agg(F.min(F.struct("label", "q")).alias("r")).select("id", "r.label", "r.q"), "vectors")
    found = keep(first_positives(rows, anchors, positives), "positives")
    pairs = keep(window_pairs(rows, anchors, found, negatives, low, high), "pairs")
    spark = df.sparkSession
    parts = max(1, math.ceil(pairs.count() / SORTED_PAIRS))
    ordered = (pairs.rdd.map(lambda r: (bytes(r[0]), r[1]))
               .repartitionAndSortWithinPartitions(parts, by_anchor)
               .mapPartitions(lambda it: open_windows(it, negatives, low, high)))
    return spark.createDataFrame(ordered, OUTPUT, verifySchema=False)
