"""Vectorised words and word hashes over Arrow text columns.

Texts are cut into slices of a few MB, so a task's memory does not follow
the size of its Arrow batches; a single text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        table[lo:hi + 1] = True
    return table


#: Bytes of ``[^\x20\x09-\x0D]+``; all bytes of a non-ASCII character count.
PLAIN = ~byte_table((0x20, 0x20), (0x09, 0x0D))
#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
ALNUM = byte_table((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its n+1 offsets; null is empty."""
    arr = col.cast(pa.large_string())
    if arr.null_count:
        arr = arr.fill_null("")
    offs = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1] \
        if len(arr) else np.zeros(1, dtype=np.int64)
    data = arr.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None and data.size
            else np.zeros(0, dtype=np.uint8)), offs


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES
           ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows of a batch in runs of at most ``limit`` bytes (one row at least)."""
    data, offs = text_bytes(batch.column(batch.schema.get_field_index(column)))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at), data[offs[at]:offs[to]], offs[at:to + 1] - offs[at]
        at = to


class Words:
    """Words of a slice: byte ``start``/``end``, their ``row``, and for each
    row the index of its ``first`` word (n+1 values)."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, table: np.ndarray = PLAIN):
        inside = table[data]
        edge = np.zeros(len(data), dtype=bool)
        cuts = offs[:-1][offs[:-1] < len(data)]
        edge[cuts] = True
        before = np.zeros_like(inside)
        before[1:] = inside[:-1]
        self.start = np.flatnonzero(inside & (~before | edge))
        after = np.zeros_like(inside)
        after[:-1] = inside[1:] & ~edge[1:]
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, offs)
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(len(offs) - 1), self.count)
        self.data = data

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word."""
        return mix(range_sums(BYTE_VALUES[self.data], self.start, self.end, 0))


_rng = np.random.Generator(np.random.PCG64(20240607))
BYTE_VALUES = _rng.integers(1, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Odd multipliers, so powers have inverses modulo 2**64; one for each use.
BASES = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers_of(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers.get(which, (np.ones(1, np.uint64), np.ones(1, np.uint64)))
    if len(up) < n:
        size = max(n, 1 << 16)
        base = BASES[which]
        grown = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            grown.append(np.multiply.accumulate(p))
        _powers[which] = up, down = grown[0], grown[1]
    return up[:n], down[:n]


def range_sums(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, which: int) -> np.ndarray:
    """Polynomial hash of ``values[lo:hi]`` for many ranges, independent of
    where the range lies."""
    up, down = _powers_of(which, len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return (sums[hi] - sums[lo]) * down[lo]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
