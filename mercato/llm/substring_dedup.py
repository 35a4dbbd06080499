"""Substring dedup: remove words of passages that occurred earlier.

A window is ``window`` consecutive words.  A word goes if some window over
it has a word sequence that also starts earlier (smaller doc_id, or earlier
in the same document); windows are judged on the input.

Difference-cover anchors: an anchor is a run of ``window - period + 1``
words whose position modulo ``period`` lies in the cover, a set in which
every residue is a difference of two members.  Two equal windows therefore
hold an anchor at the same offset, whatever their positions, so only anchors
(4 of 13 positions for windows of 20) are hashed and shuffled.  An anchor is
then extended by its context, the words that any window over it can reach:

* an earlier anchor with equal context settles all windows over this one;
* if the hash is repeated in other contexts, the first anchor of each
  context hands its windows to an exact comparison by 128-bit window hash;
* all other anchors are settled without looking at a window.

Why no window is lost: take a window and its earliest occurrence, and the
anchor they share.  If both contexts are equal, the later one is settled.
If not, the hash is repeated in several contexts; the earliest occurrence is
never settled, so both (or, for the later one, an equal context before it)
reach the comparison.

Hot passages: a map task settles what repeats within its own rows first, so
a group of copies reaches a reducer with one anchor for each map chunk, not
one for each row.

Cases: a null or empty text has no words; a null doc_id sorts first; rows
that share doc_id and text are one document and each gets its result; rows
that share only the doc_id are ordered by a hash of their text.  Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm import words as W
from mercato.llm.store import keep

#: Perfect difference sets, by period.
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16),
          31: (0, 1, 3, 8, 12, 18)}
#: Anchors settled together in a map task.
CHUNK = 1 << 20
NULL_ID = -(1 << 63)


def anchor_plan(window: int) -> tuple[int, tuple[int, ...], int]:
    """Period, cover and anchor length for a window length."""
    period = max((p for p in COVERS if 2 * p <= window + 8 and p < window), default=1)
    return period, COVERS.get(period, (0,)), window - period + 1


def document_key(id_col: str, text_col: str) -> list[Column]:
    """A null-free key of documents: the id, and a text hash for ids that repeat."""
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("_d"),
            F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_t"),
            F.coalesce(F.col(text_col), F.lit("")).alias("_text")]


def planes(a: np.ndarray) -> bytes:
    """Bytes by significance, so that the shuffle's codec packs them well."""
    return a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()


def unplanes(b: bytes, kind: type, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(b, np.uint8).reshape(size, n).T.copy().view(kind).reshape(n)


ANCHOR_ROWS = ("bucket int, docs binary, texts binary, counts binary, n_docs int, hash binary, "
               "context binary, known binary, place binary, n int, d long, t long, settled array<int>, "
               "compare array<int>")
MARKS = "d long, t long, settled array<int>, compare array<int>"


def _by_document(doc: np.ndarray, place: np.ndarray) -> Iterator[tuple[int, list[int]]]:
    order = np.lexsort((place, doc))
    doc, place = doc[order], place[order]
    cuts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else []
    for lo, hi in zip(cuts, np.r_[cuts[1:], len(doc)] if len(doc) else [], strict=True):
        yield int(doc[lo]), place[lo:hi].tolist()


def _mark_rows(ids: np.ndarray, texts: np.ndarray, doc: np.ndarray, place: np.ndarray,
               settled: np.ndarray, compare: np.ndarray) -> list[dict]:
    """A row for each document with marks."""
    rows: dict[int, dict] = {}
    for name, at in (("settled", settled), ("compare", compare)):
        for k, places in _by_document(doc[at], place[at]):
            rows.setdefault(k, {"d": int(ids[k]), "t": int(texts[k]), "settled": [],
                                "compare": []})[name] = places
    return list(rows.values())


def _judge(h: np.ndarray, c: np.ndarray, pos: np.ndarray, known: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order anchors by hash, context and position.  Returns that order and,
    in it: later anchors of equal context, first ones, the number of the
    hash's group, and for each group whether it has several contexts."""
    order = np.lexsort((pos, c, h))
    h, c, pos = h[order], c[order], pos[order]
    new_h = np.r_[True, h[1:] != h[:-1]]
    new_c = new_h | np.r_[True, c[1:] != c[:-1]]
    group = np.cumsum(new_h) - 1
    first_pos = pos[np.flatnonzero(new_c)][np.cumsum(new_c) - 1]
    several = np.bincount(group, new_c) > 1
    several |= np.bincount(group, known[order]) > 0
    return order, pos > first_pos, new_c, group, several


def _settle_chunk(ids, texts, doc, place, h, c, buckets: int) -> Iterator[dict]:
    """Settle what repeats within a chunk of anchors; yield marks and, for
    each bucket of hashes, the anchors that other chunks must see."""
    # position = rank of the document and place in it; equal keys rank equally
    by_key = np.lexsort((texts, ids))
    new = np.r_[True, (ids[by_key][1:] != ids[by_key][:-1]) | (texts[by_key][1:] != texts[by_key][:-1])]
    rank = np.empty(len(ids), dtype=np.int64)
    rank[by_key] = np.cumsum(new) - 1
    pos = (rank[doc] << 32) | place
    order, later, first, group, several = _judge(h, c, pos, np.zeros(len(h), dtype=bool))
    # of a hash with several contexts, the earliest first one speaks for the chunk
    firsts = np.flatnonzero(first)
    g = group[firsts]
    speak = firsts[np.lexsort((pos[order][firsts], g))]
    g = group[speak]
    lead = np.r_[True, g[1:] != g[:-1]] if len(g) else np.zeros(0, dtype=bool)
    rest = speak[~lead]
    yield from ({"bucket": -1, **row} for row in _mark_rows(
        ids, texts, doc[order], place[order], np.flatnonzero(later), rest))
    sent = speak[lead]
    known = several[group[sent]]
    at = order[sent]
    bucket = ((h[at] >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
    by = np.lexsort((place[at], doc[at], bucket))
    at, bucket, known = at[by], bucket[by], known[by]
    c = c[at]
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(at) else np.zeros(0, int)
    for lo, hi in zip(cuts, np.r_[cuts[1:], len(at)] if len(at) else [], strict=True):
        d, counts = np.unique(doc[at[lo:hi]], return_counts=True)
        yield {"bucket": int(bucket[lo]), "n": int(hi - lo), "n_docs": len(d),
               "docs": planes(ids[d]), "texts": planes(texts[d]),
               "counts": planes(counts.astype(np.uint32)),
               "hash": h[at[lo:hi]].tobytes(), "context": c[lo:hi].tobytes(),
               "known": known[lo:hi].tobytes(),
               "place": planes(place[at[lo:hi]].astype(np.uint32))}


def _to_batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {f.name: pa.array([r.get(f.name) for r in rows], f.type) for f in schema}, schema=schema)


_INTS = pa.list_(pa.int32())
_ANCHOR_SCHEMA = pa.schema([
    ("bucket", pa.int32()), ("docs", pa.binary()), ("texts", pa.binary()), ("counts", pa.binary()),
    ("n_docs", pa.int32()), ("hash", pa.binary()), ("context", pa.binary()),
    ("known", pa.binary()), ("place", pa.binary()), ("n", pa.int32()), ("d", pa.int64()), ("t", pa.int64()),
    ("settled", _INTS), ("compare", _INTS)])
_MARK_SCHEMA = pa.schema([("d", pa.int64()), ("t", pa.int64()), ("settled", _INTS),
                          ("compare", _INTS)])


def _anchors(window: int, buckets: int):
    period, cover, length = anchor_plan(window)
    in_cover = np.zeros(period, dtype=bool)
    in_cover[list(cover)] = True
    reach = period - 1

    def of_slice(part, data, offs):
        w = W.Words(data, offs)
        n = len(w)
        place = np.arange(n) - w.first[w.row] if n else np.zeros(0, dtype=np.int64)
        left = np.repeat(w.count, w.count) - place
        # an anchor serves only if a window fits around it
        at = np.flatnonzero(in_cover[place % period] & (left >= length)
                            & (np.repeat(w.count, w.count) >= window))
        if not len(at):
            return None
        hashes = w.hashes()
        before = np.minimum(place[at], reach)
        after = np.minimum(left[at] - length, reach)
        h = W.mix(W.range_sums(hashes, at, at + length, 1))
        c = W.mix(W.range_sums(hashes, at - before, at + length + after, 2)
                  + (before * 64 + after).astype(np.uint64))
        return (part.column("_d").to_numpy(), part.column("_t").to_numpy(), w.row[at], place[at],
                h, c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []

        def flush():
            if not held:
                return
            shift = np.cumsum([0] + [len(x[0]) for x in held])
            doc = np.concatenate([x[2] + s for x, s in zip(held, shift, strict=False)])
            cat = [np.concatenate([x[i] for x in held]) for i in (0, 1, 3, 4, 5)]
            held.clear()
            rows = list(_settle_chunk(cat[0], cat[1], doc, cat[2], cat[3], cat[4], buckets))
            for i in range(0, len(rows), 4096):
                yield _to_batch(rows[i:i + 4096], _ANCHOR_SCHEMA)

        for batch in batches:
            for part, data, offs in W.slices(batch, "_text"):
                if found := of_slice(part, data, offs):
                    held.append(found)
                if sum(len(x[2]) for x in held) >= CHUNK:
                    yield from flush()
        yield from flush()

    return run


def _settle_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Judge the anchors of one bucket after the other (rows come sorted by it)."""
    held: list[dict] = []

    def judge():
        if not held:
            return
        ids = np.concatenate([unplanes(r["docs"], np.int64, r["n_docs"]) for r in held])
        texts = np.concatenate([unplanes(r["texts"], np.int64, r["n_docs"]) for r in held])
        counts = np.concatenate([unplanes(r["counts"], np.uint32, r["n_docs"]) for r in held])
        doc = np.repeat(np.arange(len(ids)), counts)
        place = np.concatenate([unplanes(r["place"], np.uint32, r["n"]) for r in held]).astype(np.int64)
        h = np.concatenate([np.frombuffer(r["hash"], np.uint64) for r in held])
        c = np.concatenate([np.frombuffer(r["context"], np.uint64) for r in held])
        known = np.concatenate([np.frombuffer(r["known"], bool) for r in held])
        held.clear()
        by_key = np.lexsort((texts, ids))
        new = np.r_[True, (ids[by_key][1:] != ids[by_key][:-1])
                    | (texts[by_key][1:] != texts[by_key][:-1])]
        rank = np.empty(len(ids), dtype=np.int64)
        rank[by_key] = np.cumsum(new) - 1
        order, later, first, group, several = _judge(
            h, c, (rank[doc] << 32) | place, known)
        rows = _mark_rows(ids, texts, doc[order], place[order], np.flatnonzero(later),
                          np.flatnonzero(~later & several[group]))
        for i in range(0, len(rows), 8192):
            yield _to_batch(rows[i:i + 8192], _MARK_SCHEMA)

    current = None
    for batch in batches:
        marks = batch.filter(pc.less(batch.column("bucket"), 0))
        if marks.num_rows:
            yield pa.RecordBatch.from_arrays([marks.column(f.name) for f in _MARK_SCHEMA],
                                             schema=_MARK_SCHEMA)
        for row in batch.filter(pc.greater_equal(batch.column("bucket"), 0)).to_pylist():
            if row["bucket"] != current:
                yield from judge()
                current = row["bucket"]
            held.append(row)
    yield from judge()


def _windows(window: int):
    """128-bit hashes of the windows over anchors that must be compared."""
    period, _, _ = anchor_plan(window)
    reach = np.arange(period)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offs in W.slices(batch, "_text"):
                w = W.Words(data, offs)
                hashes = w.hashes()
                compare = part.column("compare")
                rows = np.repeat(np.arange(part.num_rows),
                                 pc.list_value_length(compare).to_numpy(zero_copy_only=False))
                anchors = compare.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                s = (anchors[:, None] - reach[None, :]).ravel()
                r = np.repeat(rows, period)
                fits = (s >= 0) & (s + window <= w.count[r])
                pairs = np.unique((r[fits].astype(np.int64) << 32) | s[fits])
                r, s = pairs >> 32, pairs & 0xFFFFFFFF
                at = w.first[r] + s
                yield pa.RecordBatch.from_arrays([
                    pa.array(W.signed(W.mix(W.range_sums(hashes, at, at + window, 1)))),
                    pa.array(W.signed(W.mix(W.range_sums(hashes, at, at + window, 2)))),
                    part.column("_d").take(pa.array(r)), part.column("_t").take(pa.array(r)),
                    pa.array(s.astype(np.int32))], names=["h1", "h2", "d", "t", "s"])

    return run


def _remove(window: int):
    period, _, _ = anchor_plan(window)

    def covered(n: int, settled: list[int], starts: list[int]) -> np.ndarray:
        edge = np.zeros(n + 1, dtype=np.int64)
        s = np.asarray(starts, dtype=np.int64)
        p = np.asarray(settled, dtype=np.int64)
        # all windows that fit and hold the anchor
        lo, hi = np.maximum(p - period + 1, 0), np.minimum(p, n - window)
        lo, hi = lo[lo <= hi], hi[lo <= hi]
        np.add.at(edge, np.r_[s, lo], 1)
        np.add.at(edge, np.r_[s, hi] + window, -1)
        return np.cumsum(edge)[:n] > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, _ in W.slices(batch, "_text"):
                out = []
                for d, text, settled, starts in zip(
                        part.column("doc_id").to_pylist(), part.column("_text").to_pylist(),
                        part.column("settled").to_pylist(), part.column("starts").to_pylist(),
                        strict=True):
                    words = text.encode().split()
                    gone = covered(len(words), settled or [], starts or [])
                    kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g) \
                        if gone.any() else b" ".join(words)
                    out.append((d, len(words), int(gone.sum()), kept.decode()))
                yield pa.RecordBatch.from_pydict(dict(zip(
                    ("doc_id", "n_words", "n_removed", "kept_text"), map(list, zip(*out, strict=True)),
                    strict=True)), schema=pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()),
                                                     ("n_removed", pa.int64()), ("kept_text", pa.string())]))

    return run


def repeated_places(docs: DataFrame, window: int) -> DataFrame:
    """For each document with repeats: anchors settled as repeated, and those
    whose windows must be compared (word positions).  Copies of one row bring
    equal lists from every chunk that holds one; each list is kept once, map
    side already, and a place once in the end."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    anchors = docs.mapInArrow(_anchors(window, 4 * parts), ANCHOR_ROWS)
    dealt = anchors.repartition(
        parts, F.when(F.col("bucket") < 0, F.hash("d")).otherwise(F.col("bucket")))
    marks = dealt.sortWithinPartitions("bucket").mapInArrow(_settle_buckets, MARKS)
    return marks.groupBy("d", "t").agg(*[F.array_distinct(F.flatten(F.collect_set(c))).alias(c) for c in ("settled", "compare")])


def substring_dedup(documents: DataFrame, window: int = 20, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by a space)."""
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"),
                            *document_key(id_col, text_col))
    marks = keep(repeated_places(docs.select("_d", "_t", "_text"), window), "anchors")
    same = (F.col("_d") == F.col("d")) & (F.col("_t") == F.col("t"))
    hashed = docs.join(marks.where(F.size("compare") > 0), same).select(
        "_d", "_t", "_text", "compare").mapInArrow(
        _windows(window), "h1 long, h2 long, d long, t long, s int")
    windows = keep(hashed, "windows")
    first = windows.groupBy("h1", "h2").agg(F.min(F.struct("d", "t", "s")).alias("first"))
    starts = (windows.join(first.select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "first"),
                           (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")))
              .where(F.struct("d", "t", "s") > F.col("first"))
              .groupBy("d", "t").agg(F.collect_set("s").alias("starts")))
    found = marks.select("d", "t", "settled").join(starts, ["d", "t"], "left")
    return docs.join(found, same, "left").select("doc_id", "_text", "settled", "starts").mapInArrow(
        _remove(window), "doc_id long, n_words long, n_removed long, kept_text string")


def digest(kept: DataFrame) -> DataFrame:
    """The contract's columns of ``substring_dedup``'s result."""
    return kept.select("doc_id", "n_words", "n_removed",
                       F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))
