"""Benchmark decontamination by a prefix-filtered set join.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased.
A benchmark item's windows are its runs of ``window`` words (an item of
fewer words, but not none, is one window).  A document word inside any
occurrence of a window is hit.

Join: a window is the set of its 5-word shingles (a shorter window is one
shingle).  Containing a window means containing all of its shingles, so one
of them is the necessary prefix, and the rarest in the corpus gives the
fewest candidates.  (1) Count, over all documents, the shingles that the
benchmark has; (2) order each window's shingles by that count; (3) join the
documents' shingles with the windows' prefix shingles; (4) drop a candidate
whose window would start before or end after the document (positional and
length bound), and compare the words exactly.

Nothing of the benchmark is broadcast but a bit set of bounded size
(``filter_bits``), which spares the shuffle most shingles that match nothing;
what passes it is joined on the shingle, so any number of items works and a
hot passage is a skewed join that adaptive execution splits.

Cases: null and blank texts have no words and are never hit; items without
words have no windows; items that repeat an id count once; a null item_id
counts as the id ``null``; each of several rows with one doc_id is judged by
its own text.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm import words as W
from mercato.llm.store import free_name, keep

SHINGLE = 5
#: Bits of a filter for each hash it holds, and its least and greatest size (32 MB).
BITS_EACH, LEAST_BITS, MOST_BITS = 64, 1 << 23, 1 << 28


def _shingles(w: W.Words, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every run of k words within a row."""
    at = np.arange(len(w))
    at = at[at + k <= w.first[1:][w.row]]
    return at, W.mix(W.range_sums(hashes, at, at + k, 1) + np.uint64(k))


def _item_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"item_id": [], "window": [], "n": [], "k": [], "shingles": []}
            for part, data, offs in W.slices(batch, "text"):
                data = W.LOWER[data]
                w = W.Words(data, offs, W.ALNUM)
                hashes = w.hashes()
                raw = data.tobytes()
                for i, item in enumerate(part.column("item_id").to_pylist()):
                    lo, hi = int(w.first[i]), int(w.first[i + 1])
                    n = min(window, hi - lo)
                    k = min(SHINGLE, n)
                    for s in range(lo, hi - n + 1 if n else lo):
                        at = np.arange(s, s + n - k + 1)
                        out["item_id"].append(item)
                        out["window"].append(b" ".join(
                            raw[a:b] for a, b in zip(w.start[s:s + n], w.end[s:s + n], strict=True)).decode())
                        out["n"].append(n)
                        out["k"].append(k)
                        out["shingles"].append(W.signed(W.mix(
                            W.range_sums(hashes, at, at + k, 1) + np.uint64(k))).tolist())
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("item_id", pa.string()), ("window", pa.string()), ("n", pa.int32()), ("k", pa.int32()),
                ("shingles", pa.list_(pa.int64()))]))

    return run


def filter_bits(hashes: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, 1 << max(0, BITS_EACH * hashes - 1).bit_length()))


def hash_filter(hashes: DataFrame) -> np.ndarray:
    """Bit set, in bytes, over the low bits of a column ``h``.  Of other hashes
    about one in ``BITS_EACH`` passes, more of them above four million hashes
    (the results stay the same)."""
    size = filter_bits(hashes.agg(F.approx_count_distinct("h")).first()[0])
    bit = F.expr(f"h & {size - 1}L")
    rows = (hashes.select((bit / 64).cast("int").alias("word"), (bit % 64).cast("int").alias("bit"))
            .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow())
    bits = np.zeros(size // 64, dtype="<i8")
    bits[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return bits.view(np.uint8)


def _passing(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = h & np.uint64(8 * len(bits) - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _count_shingles(bits: np.ndarray, lengths: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offs in W.slices(batch, "text"):
                w = W.Words(W.LOWER[data], offs, W.ALNUM)
                hashes = w.hashes()
                for k in lengths:
                    _, h = _shingles(w, hashes, k)
                    h, n = np.unique(h[_passing(h, bits)], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(W.signed(h)), pa.array(n)], names=["h", "n"])

    return run


_HIT = pa.struct([("h", pa.int64()), ("lead", pa.int32()), ("at", pa.int32()), ("near", pa.string())])
_DOC = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("hits", pa.list_(_HIT))])


def _prefix_hits(bits: np.ndarray, lengths: list[int], window: int):
    """A row for each document: its size and its shingles that may be a
    prefix, each with the words that a window over it can reach."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offs in W.slices(batch, "text"):
                data = W.LOWER[data]
                raw = data.tobytes()
                w = W.Words(data, offs, W.ALNUM)
                hashes = w.hashes()
                hits: list[list] = [[] for _ in range(part.num_rows)]
                for k in lengths:
                    at, h = _shingles(w, hashes, k)
                    found = _passing(h, bits)
                    at, h = at[found], W.signed(h[found])
                    reach = window - k if k == SHINGLE else 0
                    lo = np.maximum(at - reach, w.first[w.row[at]])
                    hi = np.minimum(at + k + reach, w.first[w.row[at] + 1])
                    for a, x, lo_, hi_ in zip(at.tolist(), h.tolist(), lo.tolist(), hi.tolist(), strict=True):
                        row = int(w.row[a])
                        near = b" ".join([raw[b:e] for b, e in zip(
                            w.start[lo_:hi_].tolist(), w.end[lo_:hi_].tolist(), strict=True)])
                        hits[row].append((x, a - lo_, a - int(w.first[row]), near.decode()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(w.count, pa.int64()),
                     pa.array([[dict(zip(("h", "lead", "at", "near"), x, strict=True)) for x in r]
                               for r in hits], pa.list_(_HIT))], schema=_DOC)

    return run


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = 13,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, items (ids as strings, sorted) of every row."""
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item_id"),
                             F.col(item_text).alias("text"))
    of_items = keep(items.mapInArrow(_item_windows(window), "item_id string, window string, n int, "
                                     "k int, shingles array<long>"), "item-windows")
    windows = of_items.select("window", "n", "k", "shingles").distinct()
    tokens = windows.select("window", "n", "k", F.posexplode("shingles").alias("place", "h"))
    lengths = sorted(r.k for r in windows.select("k").distinct().collect())  # 1 to 5 values
    # rarity of the benchmark's shingles in the corpus
    counts = (docs.select("text").mapInArrow(
        _count_shingles(hash_filter(tokens.select("h")), lengths), "h long, n long")
        .groupBy("h").agg(F.sum("n").alias("seen")))
    ranked = tokens.join(counts, "h", "left").groupBy("window", "n").agg(
        F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "h", "place")).alias("rarest"))
    prefix = keep(ranked.select("window", "n", "rarest.h", "rarest.place", "rarest.seen"), "prefixes")
    # documents' shingles that may be a prefix, then the join and its checks
    found = (docs.mapInArrow(_prefix_hits(hash_filter(prefix.select("h")), lengths, window),
                             "doc_id long, n_words long, hits "
                             "array<struct<h:long,lead:int,at:int,near:string>>")
             .withColumn("row", F.monotonically_increasing_id()))
    rows = keep(found, "prefix-hits")
    near = rows.select("row", "n_words", F.explode("hits").alias("hit")).select("row", "n_words", "hit.*")
    held = (near.join(prefix.where("seen > 0"), "h")
            .where("lead >= place and at - place + n <= n_words")
            .where(F.array_join(F.slice(F.split("near", " "), F.expr("lead - place + 1"), F.col("n")), " ")
                   == F.col("window"))
            .select("row", "window", F.expr("at - place").alias("start"), F.expr("at - place + n").alias("end")))
    places = held.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("p"))
    n_hit = places.select("row", F.expr(
        "aggregate(p, named_struct('upto', 0, 'n', 0L), (a, x) -> named_struct("
        "'upto', greatest(a.upto, x.end), 'n', a.n + greatest(0, x.end - greatest(a.upto, x.start))), "
        "a -> a.n)").alias("n_hit"))
    of_rows = (held.select("row", "window").distinct()
               .join(of_items.select("window", "item_id").distinct(), "window")
               .groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    return (rows.select("row", "doc_id", "n_words").join(n_hit, "row", "left").join(of_rows, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def is_contaminated():
    """At least one word in twenty is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def keep_clean(documents: DataFrame, benchmark: DataFrame, window: int = 13,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are not contaminated, with all their columns.  A
    verdict is one of the text alone, so rows are found again by a hash of
    their text: each goes or stays by its own, whatever its doc_id."""
    key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    own, gone = free_name(documents, "t"), free_name(documents, "gone")
    judged = decontaminate(documents.select(key.alias(own), F.col(text_col)), benchmark, window, own, text_col)
    out = judged.where(is_contaminated()).select(F.col("doc_id").alias(gone)).distinct()
    return documents.join(out, key == F.col(gone), "left_anti")


def digest(judged: DataFrame) -> DataFrame:
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"))
