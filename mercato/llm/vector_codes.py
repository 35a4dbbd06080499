"""Vector codes by product quantisation, with active-entry Lloyd rounds.

A vector of integers is cut into equal consecutive parts; each part position
has a codebook, and a vector's code is the index of the nearest entry in each
part.  Codebooks start as the vectors of the smallest ids; a round assigns
every part to its nearest entry and moves each entry to the floored mean of
its parts.

Assignments keep the exact distance of each part.  In the next round, a part
whose entry stayed fixed compares only the entries that moved against that
distance (an unmoved entry cannot have become nearer, and its place among
equal ones has not changed); all other parts look at all entries.  Ties go to
the lower index both ways.

Rows stay where they are: every task sends one sum per entry to the update,
and the codebooks (entries x components, bounded by the parameters) are all
that passes through the driver.  Each assignment is written to the shared
folder, so a lost executor repeats its own tasks only.

Defined results: rows whose vector is null or holds null or non-finite
components are dropped, as are rows of another length than most vectors have
(of lengths equally frequent the longest).  Rows are taken one by one:
repeated rows get the same code, each adds its error, and rows of one id are
ordered by their vectors when the codebooks start; null ids come last.  Null
labels form one group.  With fewer rows than entries the codebooks are as
long as the table; an empty table gives an empty one.  A vector length that
the number of parts does not divide, or distances beyond 64 bits, are errors.
Only the columns named by the parameters are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.store import keep
from mercato.llm.vectors import EXACT, integer_vectors, matrix

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Rows of one numpy step.
STEP = 4096


def squared_distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to ``entries``."""
    dim = x.shape[1]
    top = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    if 4 * dim * int(top) ** 2 < EXACT:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    if 4 * dim * int(top) ** 2 >= 1 << 63:
        raise OverflowError("squared distances of these vectors pass 64 bits")
    return np.stack([((x - e) ** 2).sum(1) for e in entries], axis=1)


def assign(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (lowest index of equal ones) and distance of each part;
    ``x`` is rows x parts x components, ``books`` parts x entries x components."""
    n, parts = x.shape[:2]
    codes, dists = np.zeros((n, parts), dtype=np.uint8), np.zeros((n, parts), dtype=np.int64)
    for j in range(parts):
        d = squared_distances(x[:, j], books[j])
        codes[:, j] = d.argmin(1)
        dists[:, j] = d[np.arange(n), codes[:, j]]
    return codes, dists


def reassign(x: np.ndarray, codes: np.ndarray, dists: np.ndarray, books: np.ndarray, moved: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, int]:
    """The same from an earlier assignment; ``moved`` (parts x entries) marks
    the entries that changed since.  Also returns how many distances were
    computed."""
    codes, dists, work = codes.copy(), dists.copy(), 0
    for j in range(x.shape[1]):
        active = np.flatnonzero(moved[j])
        free = moved[j][codes[:, j]]
        still, rest = np.flatnonzero(~free), np.flatnonzero(free)
        if len(active) and len(still):
            d = squared_distances(x[still, j], books[j][active])
            at = d.argmin(1)
            best, entry = d[np.arange(len(still)), at], active[at]
            closer = (best < dists[still, j]) | ((best == dists[still, j]) & (entry < codes[still, j]))
            codes[still[closer], j], dists[still[closer], j] = entry[closer], best[closer]
        if len(rest):
            d = squared_distances(x[rest, j], books[j])
            codes[rest, j] = d.argmin(1)
            dists[rest, j] = d[np.arange(len(rest)), codes[rest, j]]
        work += len(still) * len(active) + len(rest) * books.shape[1]
    return codes, dists, work


def _assigned(rows: DataFrame, books: np.ndarray, moved: np.ndarray | None, last: bool) -> DataFrame:
    """Rows with ``codes`` and ``dists``; the last assignment drops the
    vectors and gives ``code`` and ``error``."""
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, STEP):
                batch = whole.slice(lo, STEP)
                x = matrix(batch["q"], parts * width).reshape(batch.num_rows, parts, width)
                if moved is None:
                    codes, dists = assign(x, books)
                else:
                    before = [np.frombuffer(b"".join(batch[c].to_pylist()), dtype=t).reshape(-1, parts)
                              for c, t in (("codes", np.uint8), ("dists", "<i8"))]
                    codes, dists, _ = reassign(x, *before, books, moved)
                if last:
                    out = {"code": pa.array([c.tobytes().hex() for c in codes], pa.string()), "error": pa.array(dists.sum(1))}
                else:
                    out = {"q": batch["q"], "codes": pa.array([c.tobytes() for c in codes], pa.binary()),
                           "dists": pa.array([d.astype("<i8").tobytes() for d in dists], pa.binary())}
                yield pa.RecordBatch.from_pydict({"id": batch["id"], "label": batch["label"]} | out)

    kinds = dict(rows.dtypes)
    rest = "code string, error long" if last else "q array<int>, codes binary, dists binary"
    return rows.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, {rest}")


def _updated(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry as the floored mean of its parts; unused entries stay."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts * entries, 1 + width), dtype=np.int64)
        for batch in batches:
            x = matrix(batch["q"], parts * width).reshape(batch.num_rows, parts, width)
            codes = np.frombuffer(b"".join(batch["codes"].to_pylist()), dtype=np.uint8).reshape(-1, parts)
            for j in range(parts):
                at = j * entries + codes[:, j].astype(np.int64)
                sums[:, 0] += np.bincount(at, minlength=parts * entries)
                for k in range(width):  # exact: a batch of 32-bit numbers sums to less than 2**53
                    sums[:, 1 + k] += np.bincount(at, weights=x[:, j, k], minlength=parts * entries).astype(np.int64)
        used = np.flatnonzero(sums[:, 0])
        place = np.tile(np.arange(1 + width), len(used))
        yield pa.RecordBatch.from_pydict({"entry": np.repeat(used, 1 + width), "place": place, "total": sums[used].ravel()})

    found = (rows.select("q", "codes").mapInArrow(run, "entry long, place long, total long")
             .groupBy("entry", "place").agg(F.sum("total").alias("total")).collect())  # at most one row a number of the codebooks
    sums = np.zeros((parts * entries, 1 + width), dtype=np.int64)
    for r in found:
        sums[r.entry, r.place] = r.total
    used = sums[:, 0] > 0
    new = books.reshape(parts * entries, width).copy()
    new[used] = sums[used, 1:] // sums[used, :1]
    return new.reshape(books.shape)


def vector_codes(df: DataFrame, id_: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
                 entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = 256) -> tuple[DataFrame, np.ndarray]:
    """One row (id, label, ``code`` in hexadecimal, ``error``) per usable row,
    and the final codebooks (parts x entries x components).  At most 256
    entries."""
    if not 1 <= entries <= 256:
        raise ValueError("a code byte names one of at most 256 entries")
    rows = keep(integer_vectors(df.select(F.col(id_).alias("id"), F.col(label).alias("label"), F.col(vector).alias("_v")),
                                ["id", "label"], "_v", scale), "vectors")
    most = rows.groupBy(F.size("q").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    width = most["size"] if most else 0
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    rows = rows.where(F.size("q") == width)
    first = rows.orderBy(F.col("id").asc_nulls_last(), "q").select("q").limit(entries).collect()
    books = np.array([r.q for r in first], dtype=np.int64).reshape(len(first), parts, width // parts).transpose(1, 0, 2)
    moved = None
    for _ in range(rounds):
        rows = keep(_assigned(rows, books, moved, last=False), "codes")
        new = _updated(rows, books)
        moved, books = (new != books).any(axis=2), new
    coded = keep(_assigned(rows, books, moved, last=True), "coded")
    return coded.select(F.col("id").alias(id_), F.col("label").alias(label), "code", "error"), books


def decode(coded: DataFrame, books: np.ndarray, code: str = "code") -> DataFrame:
    """``coded`` with ``approx``, the integer vector that its code stands for."""
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.frombuffer(bytes.fromhex("".join(batch[code].to_pylist())), dtype=np.uint8).reshape(-1, parts)
            x = books[np.arange(parts), at].reshape(len(at), parts * width)
            rest = {n: batch[n] for n in batch.schema.names if n != "approx"}
            yield pa.RecordBatch.from_pydict(rest | {"approx": pa.array(list(x), pa.list_(pa.int64()))})

    fields = ", ".join(f"`{n}` {t}" for n, t in coded.dtypes if n != "approx")
    return coded.mapInArrow(run, f"{fields}, approx array<long>")


def codebooks_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def digest(coded: DataFrame, books: np.ndarray) -> DataFrame:
    """The query's columns.  The sums of labels are written first, so that the
    planner knows their size when it chooses the join."""
    sums = keep(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    return (coded.join(sums, F.col("label").eqNullSafe(F.col("_label")))
            .select("vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256")))
