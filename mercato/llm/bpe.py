"""Byte-level BPE encoding and decoding with a segment tree over pair ranks.

A text is cut at special tokens and then into pieces by the byte-level
pattern (contractions, an optional space with letters, digits or other signs,
white space).  Inside a piece the symbols start as bytes; a segment tree holds
at leaf i the rank of the pair (symbol i, next living symbol), so that its
root yields the leftmost pair of lowest rank.  A merge changes three leaves,
each in logarithmic time, until the root holds no mergeable pair.

Equal pieces of a slice of text are encoded once.  Pieces of up to
``WIDEST`` bytes run through many trees at once (one numpy row a piece);
longer ones, such as a run of a million equal signs, through one tree each.
Nothing is shuffled: the rows are encoded where they are, and a task holds one
slice of a few MB (``words.slices``), or one text if that is longer.

Vocabularies are JSON files of the ``tokenizers`` library; the driver reads
the file and sends tables of its merges (bounded by the vocabulary) along with
the tasks.  Truncation and padding in a file are not used, nor is a
post-processor (no special tokens are added).

Defined results: a null or empty text has no ids and decodes to the empty
text; bytes that are not UTF-8 count as U+FFFD; rows are kept one by one, so
repeated rows, ties, null ids and further columns change nothing; an empty
table gives an empty one.  The columns ``ids`` and ``decoded`` replace input
columns of these names.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm.words import mix, slices

NONE = np.iinfo(np.int64).max
VACANT = -2
#: Longest piece, in bytes, that is encoded in a batch of trees.
WIDEST = 256
#: Encoded pieces of up to 16 bytes that a task keeps for its next slices.
KNOWN = 1 << 18
#: Leaves of one batch of trees.
BATCH_LEAVES = 1 << 19
SPACE, LETTER, NUMBER, OTHER = range(4)

# White space, and the letters and numbers that Unicode 16.0
# added (the version that the pattern of the vocabulary files goes by).
WHITE_SPACE = [(0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
               (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]
NEW_LETTERS = [(0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
               (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
               (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
               (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
               (0x1E5F0, 0x1E5F0)]
NEW_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
               (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """Class of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)),
                        dtype=np.uint8, count=sys.maxunicode + 1)
    for ranges, kind in ((NEW_LETTERS, LETTER), (NEW_NUMBERS, NUMBER), (WHITE_SPACE, SPACE)):
        for lo, hi in ranges:
            table[lo:hi + 1] = kind
    return table


def byte_chars() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 for itself, the others by number from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


@dataclass
class Vocabulary:
    """Tables of a byte-level BPE vocabulary; a few MB, sent to the tasks."""

    byte_ids: np.ndarray  # id of each byte
    slots: np.ndarray  # open-addressed pairs (left << 32 | right), VACANT elsewhere
    ranks: np.ndarray  # rank of the pair in each slot
    merged: np.ndarray  # id that the pair of each rank becomes
    token_data: np.ndarray  # bytes of all tokens
    token_offs: np.ndarray
    specials: list[tuple[bytes, int]] = field(default_factory=list)

    @cached_property
    def rank_of(self) -> dict[int, int]:
        return dict(zip(self.slots.tolist(), self.ranks.tolist(), strict=True))

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; NONE if it does not merge or ``right`` < 0."""
        key = (left << 32) | right
        slot = _slot(key, len(self.slots))
        held = self.slots[slot]
        rank = np.where(held == key, self.ranks[slot], NONE)
        open_ = np.flatnonzero((held != key) & (held != VACANT))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.slots) - 1)
            held = self.slots[slot[open_]]
            hit = held == key[open_]
            rank[open_[hit]] = self.ranks[slot[open_[hit]]]
            open_ = open_[~hit & (held != VACANT)]
        return rank


def _slot(key: np.ndarray, size: int) -> np.ndarray:
    return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - size.bit_length())).astype(np.int64)


def _slots(rank_of: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Open addressing at a load of at most a quarter."""
    size = 1 << (4 * len(rank_of) + 1).bit_length()
    slots, ranks = np.full(size, VACANT), np.full(size, NONE)
    for key, at in zip(rank_of, _slot(np.array(list(rank_of), dtype=np.int64), size).tolist(), strict=True):
        while slots[at] != VACANT:
            at = (at + 1) & (size - 1)
        slots[at], ranks[at] = key, rank_of[key]
    return slots, ranks


def load(path: str) -> Vocabulary:
    """Read a vocabulary file; what this module does not do is an error."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = {"normalizer": spec.get("normalizer"), "dropout": model.get("dropout"), "unk_token": model.get("unk_token"),
             "continuing_subword_prefix": model.get("continuing_subword_prefix"),
             "end_of_word_suffix": model.get("end_of_word_suffix"), "byte_fallback": model.get("byte_fallback"),
             "ignore_merges": model.get("ignore_merges"), "add_prefix_space": before.get("add_prefix_space")}
    if model.get("type") != "BPE" or before.get("type") != "ByteLevel" or not before.get("use_regex", True) \
            or (spec.get("decoder") or {}).get("type") != "ByteLevel" or any(plain.values()):
        raise ValueError(f"not a plain byte-level BPE vocabulary: {path}")
    added = spec.get("added_tokens") or []
    if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("only special tokens that match as they stand are supported")
    chars = byte_chars()
    byte_of = {c: b for b, c in enumerate(chars)}
    vocab: dict[str, int] = model["vocab"]
    rank_of, merged = {}, []
    for rank, merge in enumerate(model["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        rank_of[vocab[left] << 32 | vocab[right]] = rank
        merged.append(vocab[left + right])
    contents = {i: bytes(byte_of[c] for c in token) for token, i in vocab.items()}
    contents |= {t["id"]: t["content"].encode() for t in added}
    tokens = [contents.get(i, b"") for i in range(max(contents, default=-1) + 1)]
    slots, ranks = _slots(rank_of)
    return Vocabulary(
        byte_ids=np.array([vocab[c] for c in chars], dtype=np.int64), slots=slots, ranks=ranks,
        merged=np.array(merged, dtype=np.int64),
        token_data=np.frombuffer(b"".join(tokens), dtype=np.uint8),
        token_offs=np.concatenate([[0], np.cumsum([len(t) for t in tokens], dtype=np.int64)]),
        specials=[(t["content"].encode(), t["id"]) for t in added if t["content"]])


# -- pieces ---------------------------------------------------------------
def piece_starts(chars: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Whether a piece starts at each code point.  ``edge`` marks where a new
    text (or a part of it, after a special token) starts."""
    n = len(chars)
    if not n:
        return np.zeros(0, dtype=bool)
    kind = char_classes()[chars]
    blank = kind == SPACE
    start = edge.copy()
    start[0] = True
    start[1:] |= kind[1:] != kind[:-1]
    # inside one part: a blank before a sign, and signs after one plain space
    joins = blank[:-1] & ~blank[1:] & ~edge[1:]
    start[:-1] |= joins
    start[1:] &= ~(joins & (chars[:-1] == 0x20))
    # contractions, where a piece starts with an apostrophe
    at = np.flatnonzero((chars[:-1] == 0x27) & start[:-1] & ~edge[1:])
    one = at[np.isin(chars[at + 1], [ord(c) for c in "stmd"])]
    two = at[at + 2 < n]
    two = two[~edge[two + 2]]
    second, third = chars[two + 1], chars[two + 2]
    two = two[(np.isin(second, [ord("r"), ord("v")]) & (third == ord("e"))) | ((second == ord("l")) & (third == ord("l")))]
    for found, length in ((one, 2), (two, 3)):
        start[found + 1] = False
        after = found + length
        start[after[after < n]] = True
    return start


def _valid(data: np.ndarray, offs: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
    """The text of a slice, its UTF-8 bytes and offsets; broken bytes become
    U+FFFD text by text."""
    raw = data.tobytes()
    try:
        return raw.decode(), data, offs
    except UnicodeDecodeError:
        texts = [raw[a:b].decode(errors="replace").encode() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
        joined = b"".join(texts)
        return (joined.decode(), np.frombuffer(joined, dtype=np.uint8),
                np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]))


def _special_spans(data: np.ndarray, offs: np.ndarray, specials: list[tuple[bytes, int]]) -> list[tuple[int, int, int]]:
    """(start, end, id) of special tokens inside one text, leftmost, longest first."""
    if not specials:
        return []
    ids = dict(specials)
    found = re.compile(b"|".join(re.escape(s) for s in sorted(ids, key=len, reverse=True)))
    raw, out = data.tobytes(), []
    if not any(s in raw for s in ids):
        return []
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
        out += [(m.start(), m.end(), ids[m.group()]) for m in found.finditer(raw, a, b)]
    return out


def _pieces(text: str, data: np.ndarray, offs: np.ndarray, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Byte offsets at which pieces start."""
    chars = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    at = np.flatnonzero((data & 0xC0) != 0x80)  # byte at which each code point starts
    edge_bytes = np.zeros(len(data) + 1, dtype=bool)
    edge_bytes[offs] = True
    for a, b, _ in spans:
        edge_bytes[[a, b]] = True
    starts = np.zeros(len(data) + 1, dtype=bool)
    starts[at] = piece_starts(chars, edge_bytes[at])
    for a, b, _ in spans:
        starts[a + 1:b] = False
    return np.flatnonzero(starts)


def ragged(offs: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the elements of the lists ``which`` (list i holds
    ``offs[i]:offs[i + 1]``), one after the other, and the new offsets."""
    size = (offs[1:] - offs[:-1])[which]
    out = np.concatenate([[0], np.cumsum(size)])
    return np.repeat(offs[:-1][which] - out[:-1], size) + np.arange(out[-1]), out


@dataclass
class Pieces:
    """Different pieces of up to 16 bytes, by the hash of their bytes."""

    key: np.ndarray
    low: np.ndarray  # the bytes as two little-endian numbers, zeros behind
    high: np.ndarray
    size: np.ndarray

    @classmethod
    def at(cls, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> Pieces:
        view = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(16, dtype=np.uint8)]), 8)
        keep = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
        low = np.ascontiguousarray(view[start]).view("<u8")[:, 0] & keep[np.minimum(size, 8)]
        high = np.ascontiguousarray(view[start + 8]).view("<u8")[:, 0] & keep[np.clip(size - 8, 0, 8)]
        return cls(mix(low ^ mix(high + mix(size.astype(np.uint64)))), low, high, size)

    def take(self, at: np.ndarray) -> Pieces:
        return Pieces(self.key[at], self.low[at], self.high[at], self.size[at])

    def same(self, other: Pieces) -> np.ndarray:
        return (self.key == other.key) & (self.low == other.low) & (self.high == other.high) & (self.size == other.size)

    def join(self, other: Pieces) -> Pieces:
        return Pieces(*(np.concatenate([getattr(self, f), getattr(other, f)]) for f in ("key", "low", "high", "size")))


def _distinct(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, Pieces]:
    """Representatives of equal pieces, which of them stands for each piece,
    and the bytes of the first ones (those of up to 16 bytes)."""
    size = end - start
    short = np.flatnonzero(size <= 16)
    pieces = Pieces.at(data, start[short], size[short])
    _, first, own = np.unique(pieces.key, return_index=True, return_inverse=True)
    # two pieces of one hash: the later one stands for itself
    twin = np.flatnonzero(~pieces.same(pieces.take(first[own])))
    owner = np.zeros(len(start), dtype=np.int64)
    owner[short] = own
    n = len(first) + len(twin)
    owner[short[twin]] = len(first) + np.arange(len(twin))
    seen: dict[bytes, int] = {}
    longs = []
    for i in np.flatnonzero(size > 16).tolist():
        piece = data[start[i]:end[i]].tobytes()
        if piece not in seen:
            seen[piece] = n + len(longs)
            longs.append(i)
        owner[i] = seen[piece]
    firsts = np.concatenate([first, twin])
    return np.concatenate([short[firsts], np.array(longs, dtype=np.int64)]), owner, pieces.take(firsts)


class Encoder:
    """Encodes slices of text one after the other; a bounded number of pieces
    stays known from slice to slice."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.forget()

    def forget(self) -> None:
        none = np.zeros(0, dtype=np.uint64)
        self.known = Pieces(none, none, none, np.zeros(0, dtype=np.int64))
        self.ids, self.offs = np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)

    def lists(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different pieces (the first ones are ``pieces``), one after
        the other, and offsets."""
        if len(self.known.key):
            at = np.minimum(np.searchsorted(self.known.key, pieces.key), len(self.known.key) - 1)
            hit = pieces.same(self.known.take(at))
        else:
            at, hit = np.zeros(len(pieces.key), dtype=np.int64), np.zeros(len(pieces.key), dtype=bool)
        new = np.flatnonzero(np.concatenate([~hit, np.ones(len(start) - len(hit), dtype=bool)]))
        ids, offs = encode_pieces(data, start[new], end[new], self.vocabulary)
        # lists known before, then the new ones
        which = np.zeros(len(start), dtype=np.int64)
        which[:len(hit)][hit] = at[hit]
        which[new] = len(self.offs) - 1 + np.arange(len(new))
        all_ids, all_offs = np.concatenate([self.ids, ids]), np.concatenate([self.offs, self.offs[-1] + offs[1:]])
        place, out = ragged(all_offs, which)
        fresh = new[new < len(hit)]
        if len(self.known.key) + len(fresh) > KNOWN:
            self.forget()
        else:
            known = self.known.join(pieces.take(fresh))
            order = np.argsort(known.key, kind="stable")
            kept, kept_offs = ragged(all_offs, np.concatenate([np.arange(len(self.known.key)), which[fresh]])[order])
            self.known, self.ids, self.offs = known.take(order), all_ids[kept], kept_offs
        return all_ids[place], out

    def slice(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts of a slice, one text after the other, and offsets."""
        text, data, offs = _valid(data, offs)
        if not len(data):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(offs), dtype=np.int64)
        spans = _special_spans(data, offs, self.vocabulary.specials)
        start = _pieces(text, data, offs, spans)
        end = np.append(start[1:], len(data))
        firsts, owner, pieces = _distinct(data, start, end)
        flat, piece_offs = self.lists(data, start[firsts], end[firsts], pieces)
        if spans:  # a special token is one list of one id behind the others
            flat = np.append(flat, [i for *_, i in spans])
            piece_offs = np.append(piece_offs, piece_offs[-1] + 1 + np.arange(len(spans)))
            owner[np.searchsorted(start, [a for a, *_ in spans])] = len(firsts) + np.arange(len(spans))
        place, token_offs = ragged(piece_offs, owner)
        return flat[place].astype(np.uint32), token_offs[np.searchsorted(start, offs)]


# -- merging --------------------------------------------------------------
def merge_rows(ids: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Merge each row of symbol ids (-1 after its end; the width a power of
    two) to the end; symbols that were merged away become -1."""
    n, width = ids.shape
    bits = width.bit_length() - 1
    last = width - 1
    ids = ids.astype(np.int64)
    right = np.concatenate([ids[:, 1:], np.full((n, 1), -1)], axis=1)
    rank = vocabulary.pair_ranks(ids.ravel(), right.ravel()).reshape(n, width)
    small = len(vocabulary.merged) << bits < np.iinfo(np.int32).max
    none = np.iinfo(np.int32).max if small else NONE
    tree = np.full((n, 2 * width), none, dtype=np.int32 if small else np.int64)
    tree[:, width:] = np.where(rank == NONE, none, (rank << bits) | np.arange(width))
    for level in range(bits - 1, -1, -1):
        under = tree[:, 2 << level:4 << level]
        tree[:, 1 << level:2 << level] = np.minimum(under[:, ::2], under[:, 1::2])
    # all further access is by flat index: a row's nodes, and its symbols
    follow = np.tile(np.arange(1, width + 1), (n, 1)).ravel()  # next living symbol; width is none
    before = np.tile(np.arange(-1, width - 1), (n, 1)).ravel()
    flat, tree, rows = ids.ravel(), tree.ravel(), np.arange(n)
    while True:
        root = tree[rows * (2 * width) + 1]
        live = root != none
        rows, root = rows[live], root[live].astype(np.int64)
        if not len(rows):
            return ids
        of = rows * width
        at = root & last
        gone = follow[of + at]
        new = vocabulary.merged[root >> bits]
        flat[of + at] = new
        flat[of + gone] = -1
        after = follow[of + gone]
        follow[of + at] = after
        has_after = after < width
        before[(of + after)[has_after]] = at[has_after]
        prior = before[of + at]
        has_prior = prior >= 0
        next_id = np.where(has_after, flat[of + np.minimum(after, last)], -1)
        ranks = vocabulary.pair_ranks(np.concatenate([new, flat[(of + prior)[has_prior]]]), np.concatenate([next_id, new[has_prior]]))
        nodes = np.concatenate([2 * of, 2 * of, 2 * of[has_prior]])
        place = np.concatenate([gone, at, prior[has_prior]])
        tree[nodes[len(rows):] + width + place[len(rows):]] = np.where(ranks == NONE, none, (ranks << bits) | place[len(rows):])
        tree[nodes[:len(rows)] + width + gone] = none
        place += width
        for _ in range(bits):
            place >>= 1
            left = nodes + 2 * place
            tree[nodes + place] = np.minimum(tree[left], tree[left + 1])


def merge_long(symbols: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """The same for one long piece: compact arrays, and a point update that
    stops where a node keeps its value."""
    n = len(symbols)
    bits = max(1, (n - 1).bit_length())
    width = 1 << bits
    rank = vocabulary.pair_ranks(symbols[:-1], symbols[1:])
    levels = [np.full(width, NONE)]
    levels[0][:n - 1] = np.where(rank == NONE, NONE, (rank << bits) | np.arange(n - 1))
    while len(levels[-1]) > 1:
        levels.append(np.minimum(levels[-1][::2], levels[-1][1::2]))
    tree = array("q", np.concatenate([[NONE], *levels[::-1]]).astype(np.int64).tobytes())
    ids = array("q", symbols.astype(np.int64).tobytes())
    follow = array("q", np.arange(1, n + 1, dtype=np.int64).tobytes())
    before = array("q", np.arange(-1, n - 1, dtype=np.int64).tobytes())
    rank_of, merged, mask = vocabulary.rank_of, vocabulary.merged, width - 1

    def put(leaf: int, value: int) -> None:
        node = width + leaf
        tree[node] = value
        while node > 1:
            node >>= 1
            low = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == low:
                return
            tree[node] = low

    def rank_at(left: int, right: int) -> int:
        found = rank_of.get(ids[left] << 32 | ids[right])
        return NONE if found is None else found << bits | left

    while (root := tree[1]) != NONE:
        at = root & mask
        gone = follow[at]
        after = follow[gone]
        ids[at], ids[gone], follow[at] = int(merged[root >> bits]), -1, after
        put(gone, NONE)
        if after < n:
            before[after] = at
            put(at, rank_at(at, after))
        else:
            put(at, NONE)
        if before[at] >= 0:
            put(before[at], rank_at(before[at], at))
    out = np.frombuffer(ids, dtype=np.int64)
    return out[out >= 0]


def encode_pieces(data: np.ndarray, start: np.ndarray, end: np.ndarray, vocabulary: Vocabulary
                  ) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the pieces ``data[start:end]``, one after the other, and their offsets."""
    size = end - start
    counts = np.ones(len(start), dtype=np.int64)
    order, parts = [], []
    width = 1
    while width <= WIDEST:
        group = np.flatnonzero((size <= width) & (size > width // 2))
        step = max(1, BATCH_LEAVES // width)
        for lo in range(0, len(group), step):
            some = group[lo:lo + step]
            place = start[some][:, None] + np.arange(width)
            inside = np.arange(width) < size[some][:, None]
            ids = np.where(inside, vocabulary.byte_ids[data[np.minimum(place, len(data) - 1)]], -1)
            ids = merge_rows(ids, vocabulary) if width > 1 else ids
            counts[some] = (ids >= 0).sum(axis=1)
            order.append(some)
            parts.append(ids[ids >= 0])
        width *= 2
    for i in np.flatnonzero(size > WIDEST).tolist():
        ids = merge_long(vocabulary.byte_ids[data[start[i]:end[i]]], vocabulary)
        counts[i] = len(ids)
        order.append(np.array([i]))
        parts.append(ids)
    if not order:
        return np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)
    done = np.concatenate(order)
    offs = np.concatenate([[0], np.cumsum(counts[done])])
    back = np.empty_like(done)
    back[done] = np.arange(len(done))
    place, out = ragged(offs, back)
    return np.concatenate(parts)[place], out


# -- Spark ----------------------------------------------------------------
def _with(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([batch.column(batch.schema.names.index(n)) for n in names] + [column], [*names, name])


def _binary(data: np.ndarray, offs: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.Array.from_buffers(kind, len(offs) - 1, [None, pa.py_buffer(offs.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def _schema(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, kind)])


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``df`` with ``ids``: the ids of its texts, packed as little-endian
    unsigned 32-bit integers (``unpack`` makes lists of them)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            for part, data, offs in slices(batch, text):
                ids, at = encoder.slice(data, offs)
                yield _with(part, "ids", _binary(ids.astype("<u4").view(np.uint8), 4 * at, pa.large_binary()).cast(pa.binary()))

    return df.mapInArrow(run, _schema(df, "ids", T.BinaryType()))


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``: the text of its packed ids, special tokens
    included; bytes that do not form UTF-8 become U+FFFD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.names.index(ids))
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                texts = [_decoded(v, vocabulary) for v in column.slice(i, 512).to_pylist()]
                yield _with(part, "decoded", pa.array(texts, pa.string()))

    return df.mapInArrow(run, _schema(df, "decoded", T.StringType()))


def _decoded(packed: bytes | None, vocabulary: Vocabulary) -> str:
    ids = np.frombuffer(packed or b"", dtype="<u4").astype(np.int64)
    return vocabulary.token_data[ragged(vocabulary.token_offs, ids)[0]].tobytes().decode(errors="replace")


def unpack(df: DataFrame, ids: str = "ids") -> DataFrame:
    """``df`` with its packed ids as a list of longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.names.index(ids))
            lists = [None if v is None else np.frombuffer(v, dtype="<u4").astype(np.int64) for v in column.to_pylist()]
            yield _with(batch, ids, pa.array(lists, pa.list_(pa.int64())))

    return df.mapInArrow(run, _schema(df, ids, T.ArrayType(T.LongType())))


def digest(coded: DataFrame) -> DataFrame:
    """The query's columns from packed ids and decoded texts."""
    return coded.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
