"""SimHash near-dedup over vantage-point trees.

A document's fingerprint has bit j set if over half of its word shingles
(lower-cased, repeats included) have bit j in their XXH64.  Documents whose
fingerprints differ in at most ``max_bits`` bits are linked; components of
links are the groups of near copies.

Search: two fingerprints within 3 bits agree within 1 bit on one of their two
32-bit halves (pigeonhole), so each half has a vantage-point tree searched
with radius 1, and what meets there is compared exactly on all 64 bits.  (On
whole fingerprints a radius of 3 is most of the spread of distances, and a
node would send over half of the queries down both branches.)  A node splits
by Hamming distance d to its vantage point at a median radius m; by the
triangle inequality a query needs the inner branch only if d <= m + r and the
outer one only if d > m - r.  The upper levels deal fingerprints to shards:
each lives in one, and visits those whose boundary it overlaps.  Inside a
shard the same split goes on down to small leaves; fingerprints that share a
half are told apart by a tree over the other one.

Only different fingerprints enter the search, so copies cost nothing there;
a shard reports a spanning star of what it linked, not all pairs.  The upper
levels are fitted on a sample of ``PER_SHARD`` fingerprints for each shard,
about one in eight hundred (which sets balance, not results), the first
``TOP_DEPTH`` levels on the driver, those below by a task for each branch;
every fingerprint is searched.

Cases: null, empty and blank texts have fingerprint zero and link to each
other like any others; a null doc_id never names a component that has another
id; repeated rows each get a result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.exprs import dedupe
from mercato.llm.graph import components
from mercato.llm.store import free_name, keep
from mercato.llm.words import LOWER

SEED = 42
NULL_ID = -(1 << 63)
#: Fingerprints that live in a shard, about; a shard's task also sees its visitors.
SHARD = 50_000
#: Fingerprints sampled for each shard.
PER_SHARD = 64
#: Levels of shards fitted on the driver (from a million fingerprints at most),
#: and with those fitted by tasks: 52 billion different fingerprints in shards
#: of ``SHARD``, by trees of 5 MB.  Beyond, shards are larger.
TOP_DEPTH, MAX_DEPTH = 14, 20
LEAF = 256
_LOWER = LOWER.tobytes()


def fingerprint(text: bytes, shingle: int = 3) -> int:
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(length + 1) - 1
    start = end - length
    k = min(shingle, len(words))
    start, end = start[:len(words) - k + 1], end[k - 1:]
    ones = np.zeros(64, dtype=np.int64)
    hash64 = xxhash.xxh64_intdigest
    for at in range(0, len(start), 1 << 15):
        h = np.array([hash64(joined[a:b], SEED) for a, b in
                      zip(start[at:at + (1 << 15)].tolist(), end[at:at + (1 << 15)].tolist(), strict=True)],
                     dtype=np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        # eight byte-wide counters in a word; 255 rows cannot overflow one
        packed = np.add.reduceat(bits.view(np.uint64), np.arange(0, len(h), 255), axis=0)
        ones += packed.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(start), bitorder="little").view(np.uint64)[0])


def _text_hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def fingerprints(documents: DataFrame, shingle: int = 3, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, t, fp) of every row: t is a hash of the text, fp the 64 bits
    as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t or b"", shingle) for t in batch.column("text").to_pylist()),
                              dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("t"), pa.array(fps.view(np.int64))], names=["doc_id", "t", "fp"])

    return documents.select(F.col(id_col).cast("long").alias("doc_id"), _text_hash(text_col).alias("t"),
                            F.col(text_col).cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, t long, fp long")


def halves(fps: np.ndarray, half: int) -> np.ndarray:
    return (fps >> np.uint64(32 * half)).astype(np.uint32)


def _split(points: np.ndarray, seed: int) -> tuple[int, int] | None:
    """A vantage point of wide spread, out of three, and its median radius."""
    some = points[:: max(1, len(points) // 512)]
    best = None
    for i in range(3):
        v = some[(seed * 7919 + i * 104729) % len(some)]
        d = np.bitwise_count(some ^ v)
        spread = d.var()
        if best is None or spread > best[0]:
            best = (spread, v, int(np.median(d)))
    _, v, radius = best
    d = np.bitwise_count(points ^ v)
    inside = int((d <= radius).sum())
    if inside == len(points):  # the median is the largest distance
        radius -= 1
        inside = int((d <= radius).sum())
    return (int(v), radius) if 0 < inside < len(points) else None


@dataclass
class Tree:
    """Inner nodes by heap number: the root is 1, the inner branch of i is 2i,
    the outer one 2i + 1; radius -1 marks a leaf."""

    vantage: np.ndarray
    radius: np.ndarray

    @staticmethod
    def bare(depth: int) -> Tree:
        return Tree(np.zeros(1 << depth, dtype=np.uint32), np.full(1 << depth, -1, dtype=np.int8))

    @staticmethod
    def fitted(sample: np.ndarray, depth: int) -> Tree:
        tree = Tree.bare(depth)

        def grow(points: np.ndarray, number: int) -> None:
            node = _split(points, number) if number < 1 << depth and len(points) > 1 else None
            if node is not None:
                tree.vantage[number], tree.radius[number] = node
                inside = np.bitwise_count(points ^ np.uint32(node[0])) <= node[1]
                grow(points[inside], 2 * number)
                grow(points[~inside], 2 * number + 1)

        grow(sample, 1)
        return tree

    def graft(self, leaf: int, below: Tree) -> None:
        """Put the nodes of ``below`` in the place of a leaf."""
        for level in range(len(below.radius).bit_length() - 1):
            at, here = leaf << level, slice(1 << level, 2 << level)
            self.vantage[at:at + (1 << level)] = below.vantage[here]
            self.radius[at:at + (1 << level)] = below.radius[here]


def route(points: np.ndarray, tree: Tree, r: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shards (leaf numbers) that points need within ``r``, the points by
    index, and whether they live there; one level of the tree at a time."""
    number, at = np.ones(len(points), dtype=np.int64), np.arange(len(points))
    home, out = np.ones(len(points), dtype=bool), []
    while True:
        inner = number < len(tree.radius)
        inner[inner] = tree.radius[number[inner]] >= 0
        out.append((number[~inner], at[~inner], home[~inner]))
        number, at, home = number[inner], at[inner], home[inner]
        if not len(at):
            return tuple(np.concatenate(x) for x in zip(*out, strict=True))
        d = np.bitwise_count(points[at] ^ tree.vantage[number]).astype(np.int64)
        radius = tree.radius[number].astype(np.int64)
        near, far = d <= radius + r, d > radius - r
        number = np.concatenate([2 * number[near], 2 * number[far] + 1])
        home = np.concatenate([(home & (d <= radius))[near], (home & (d > radius))[far]])
        at = np.concatenate([at[near], at[far]])


def near_pairs(fps: np.ndarray, half: int, live: np.ndarray, max_bits: int
               ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (any, living) within ``max_bits`` whose halves are near."""
    part, other = halves(fps, half), halves(fps, 1 - half)

    def brute(p, q):
        step = max(1, (1 << 20) // max(1, len(p)))
        for at in range(0, len(q), step):
            rows = q[at:at + step]
            i, j = np.nonzero(np.bitwise_count(fps[rows][:, None] ^ fps[p][None, :]) <= max_bits)
            i, j = rows[i], p[j]
            if (apart := i != j).any():
                yield i[apart], j[apart]

    def down(p, q, seed, part, r):
        if not len(p) or not len(q):
            return
        node = _split(part[p], seed) if len(p) > LEAF else None
        if node is None:
            if len(p) > LEAF and part is not other and (part[p] == part[p[0]]).all():
                yield from down(p, q, 1, other, max_bits)  # one half in common: the other tells them apart
            else:
                yield from brute(p, q)
            return
        v, radius = np.uint32(node[0]), node[1]
        inside = np.bitwise_count(part[p] ^ v) <= radius
        d = np.bitwise_count(part[q] ^ v).astype(np.int64)
        yield from down(p[inside], q[d <= radius + r], 2 * seed % 1000003, part, r)
        yield from down(p[~inside], q[d > radius - r], (2 * seed + 1) % 1000003, part, r)

    yield from down(np.flatnonzero(live), np.arange(len(fps)), 1, part, max_bits // 2)


def local_roots(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest index that each of n points reaches."""
    root = np.arange(n)
    for a, b in pairs:
        a, b = root[a], root[b]
        while (apart := a != b).any():
            a, b = a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (up := root[root] != root).any():
                root[up] = root[root[up]]
            a, b = root[a], root[b]
    return root


def shard_trees(unique: DataFrame, n: int) -> list[Tree]:
    """A tree for each half, with a leaf for about ``SHARD`` of n fingerprints."""
    depth = min(max(0, math.ceil(math.log2(max(1, n) / SHARD))), MAX_DEPTH)
    top = min(depth, TOP_DEPTH)
    sample = np.array([x[0] for x in unique.orderBy(F.xxhash64("fp"), "fp").limit(PER_SHARD << top).collect()]
                      if depth else [], dtype=np.int64).view(np.uint64)
    tops = [Tree.fitted(halves(sample, half), top) for half in (0, 1)]
    if depth == top:
        return tops

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            for half, tree in enumerate(tops):
                number, at, _ = route(halves(fps, half), tree, 0)
                at, number = at[number >= 1 << top], number[number >= 1 << top]
                yield pa.RecordBatch.from_arrays([pa.array(2 * number + half), pa.array(fps[at].view(np.int64))], names=["shard", "fp"])

    def fit(part: pa.Table) -> pa.Table:
        shard, fps = part.column("shard")[0].as_py(), np.sort(part.column("fp").to_numpy()).view(np.uint64)
        tree = Tree.fitted(halves(fps, shard & 1), depth - top)
        return pa.table({"shard": [shard], "vantage": [tree.vantage.tobytes()], "radius": [tree.radius.tobytes()]})

    # below, a sample in proportion to the shards, a task for each leaf of the top
    every = max(1, n // (PER_SHARD << depth))
    lower = (unique.select("fp").where(F.pmod(F.xxhash64("fp"), F.lit(every)) == 0).mapInArrow(deal, "shard long, fp long")
             .groupBy("shard").applyInArrow(fit, "shard long, vantage binary, radius binary"))
    trees = [Tree.bare(depth) for _ in tops]
    for tree, upper in zip(trees, tops, strict=True):
        tree.vantage[:1 << top], tree.radius[:1 << top] = upper.vantage, upper.radius
    for shard, vantage, radius in lower.toLocalIterator():  # five bytes a shard in all
        trees[shard & 1].graft(shard >> 1, Tree(np.frombuffer(vantage, dtype=np.uint32), np.frombuffer(radius, dtype=np.int8)))
    return trees


def links(unique: DataFrame, max_bits: int = 3) -> DataFrame:
    """Edges (u, v) between fingerprints that connect all pairs within
    ``max_bits``; ``unique`` has one row for each different fp."""
    trees = shard_trees(unique, unique.count())

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            for half, tree in enumerate(trees):
                number, at, home = route(halves(fps, half), tree, max_bits // 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(2 * number + half), pa.array(fps[at].view(np.int64)), pa.array(home)], names=["shard", "fp", "home"])

    def search(shard: pa.Table) -> pa.Table:
        fps = np.sort(shard.column("fp").to_numpy())
        living = shard.filter(shard.column("home")).column("fp").to_numpy()
        live = np.isin(fps, living)
        half = int(shard.column("shard")[0].as_py()) & 1
        root = local_roots(len(fps), near_pairs(fps.view(np.uint64), half, live, max_bits))
        moved = root != np.arange(len(fps))
        return pa.table({"u": fps[moved], "v": fps[root[moved]]})

    return (unique.select("fp").mapInArrow(deal, "shard long, fp long, home boolean")
            .groupBy("shard").applyInArrow(search, "u long, v long"))


def simhash_groups(documents: DataFrame, shingle: int = 3, max_bits: int = 3,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, t (a hash of the text), fp, root (a fingerprint that names the
    component) and component_id (the smallest doc_id reachable) of every row."""
    of_docs = keep(fingerprints(documents, shingle, id_col, text_col), "fingerprints")
    unique = keep(of_docs.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "unique")
    roots = components(links(unique, max_bits)).withColumnRenamed("node", "fp")
    rooted = unique.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = rooted.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "root", "component_id")
    return of_docs.join(named, "fp").select("doc_id", "t", "fp", "root", "component_id")


def keep_first(documents: DataFrame, shingle: int = 3, max_bits: int = 3,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component: the one with the smallest doc_id (null
    last), of rows that share it the one with the smallest text hash, and of
    rows that share both the one whose columns, compared in order, are
    smallest.  All columns stay."""
    d, t = free_name(documents, "d"), free_name(documents, "t")
    groups = simhash_groups(documents, shingle, max_bits, id_col, text_col)
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "t")
    first = groups.groupBy("root").agg(F.min(key).alias("first")).select(
        F.coalesce("first.doc_id", F.lit(NULL_ID)).alias(d), F.col("first.t").alias(t))
    keyed = (documents.withColumn(d, F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)))
             .withColumn(t, _text_hash(text_col)))
    return dedupe(keyed.join(first.distinct(), [d, t], "left_semi"), [d, t]).drop(d, t)


def digest(groups: DataFrame) -> DataFrame:
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                         "component_id")
