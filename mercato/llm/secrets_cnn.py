"""Secret scans: rules, and a character convolutional network over every
other candidate in its context.

Rules (fixed patterns) find assignments to a secret-like name, access keys
and long hexadecimal runs.  A candidate is any maximal run of 12 or more
characters of ``A-Za-z0-9+/_=-`` that has a letter.  The network
reads the candidate and the characters around it: embedded characters, a
convolution of width 5, maxima over the candidate and over the context, and
a logistic layer; long candidates are read in overlapping views, none is cut.

Labels: a view is a secret if its part of the candidate holds what a rule's finding
has of the candidate, or half a view of that; any other one is not (each finding
is held so by some view).  Equal views of a label count once.  Only candidates that findings cover whole
are not scored; one that they cover in part is, and if it is found its whole
span joins theirs.  Found by rules, secrets would be told by their names
alone, and in plain prose by having a digit; so the labelled findings are
made harder (``harder``): secrets also come behind other names and behind
plain words, in other alphabets and lengths; words that are no secrets also come
as slugs, paths, identifiers, versions and dated names, and behind names that
secrets have.  All views are split by hash before that: one part is
fitted, the other calibrates scores (logistic on the raw score) and sets the
threshold: of those that keep a recall of ``RECALL`` there, the one
half way between the highest and the next view that is no secret.

Fitting reads every view of every candidate.  They are dealt by hash to shards of about
``SHARD``, whose number follows the views alone; in a round each shard
goes on from the common weights, in a task, and the mean of what the shards
reach is the next round's.  Means are sums of whole numbers, so they do not
depend on tasks or their order.  A label too rare for every shard is dealt to
several.  Raw scores are multiples of 1 / ``GRID``, so their counts by label
are all that calibration and threshold need, exact and bounded.

The text is read once; what is found, and the candidates' views, go to a
table that both fitting and scoring read.

Cases: null and empty texts have no findings; offsets are code points, end
exclusive; a null doc_id is a document as any other; repeated rows each get
a result; with fewer than ``LEAST_LABELLED`` views of a label in either
part nothing is added to the rules.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm import words as W
from mercato.llm.store import keep

# fixed values: the rules' patterns and least lengths
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KINDS = ["assign", "access", "hex", "model"]
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
_NAMES = (b"passw", b"secret", b"token", b"key")

CANDIDATE = W.byte_table((0x41, 0x5A), (0x61, 0x7A), (0x30, 0x39), (0x2B, 0x2B), (0x2F, 0x2F), (0x5F, 0x5F),
                         (0x3D, 0x3D), (0x2D, 0x2D))
HEX = W.byte_table((0x30, 0x39), (0x61, 0x66))
LEAST_CANDIDATE = LEAST_ASSIGN
#: A view: characters before, of the candidate, and after.
BEFORE, INSIDE, AFTER = 24, 64, 8
VIEW = BEFORE + INSIDE + AFTER
RECALL = 0.98
#: Views of a shard, and those of the rarer label that every shard gets.
SHARD, LEAST_SHARD = 12800, 32
#: Rounds over all shards; steps that a shard takes in all, at least.
ROUNDS, STEPS, BATCH = 4, 800, 128
#: Raw scores are rounded to this part of one and kept within +-LIMIT.
GRID, LIMIT = 1024, 64
#: Harder views made of each label, at least.
HARDER = 1000
#: Raw score from which a view without a finding is not taken for harmless.
DOUBT = 0.0
#: Views of each label that either part needs: fewer say nothing about recall.
LEAST_LABELLED = 10

FINDINGS = "array<struct<kind:string,start:int,end:int>>"


def rule_spans(raw: bytes, hex_runs: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(kind number, start, end) in bytes; failing matches are consumed and dropped."""
    out = []
    low = raw.translate(W.LOWER.tobytes())
    if any(name in low for name in _NAMES):
        out += [(0, *m.span()) for m in ASSIGN.finditer(raw) if len(m[2]) >= LEAST_ASSIGN]
    if b"AKIA" in raw:
        out += [(1, *m.span()) for m in ACCESS.finditer(raw) if len(m[0]) >= LEAST_ACCESS]
    return out + [(2, a, b) for a, b in hex_runs]


def places(start: int, end: int) -> list[tuple[int, int]]:
    """The parts of a candidate that its views hold."""
    return [(at, min(at + INSIDE, end)) for at in range(start, max(start + 1, end - INSIDE // 2), INSIDE // 2)]


def views(raw: bytes, start: int, end: int) -> bytes:
    """The candidate and its context as rows of ``VIEW`` bytes; a view that
    starts later than the candidate has the part before it as context."""
    out = []
    for at, stop in places(start, end):
        before = raw[max(0, at - BEFORE):at].rjust(BEFORE, b"\0")
        inside = raw[at:stop].ljust(INSIDE, b"\0")
        out.append(before + inside + raw[stop:stop + AFTER].ljust(AFTER, b"\0"))
    return b"".join(out)


def held(ruled: np.ndarray, begin: np.ndarray, stop: np.ndarray, start: int, end: int) -> bytes:
    """For each view whether it holds what runs of bytes in findings
    (``begin``, ``stop``; ``ruled`` of them before each byte) have of the
    candidate, or half a view of that."""
    out = []
    for p, q in places(start, end):
        n = ruled[q] - ruled[p]
        if 0 < n < INSIDE // 2:
            i = int(np.searchsorted(stop, p, "right"))
            i += bool(p > start and begin[i] < p)  # only the run's rest
            out.append(i < len(begin) and begin[i] < q and (stop[i] <= q or q == end))
        else:
            out.append(n > 0)
    return bytes(map(int, out))


_SPANS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
_CANDS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("rule", pa.bool_()),
                             ("whole", pa.bool_()), ("views", pa.binary()), ("ruled", pa.binary())]))
_FOUND = pa.schema([("doc_id", pa.int64()), ("spans", _SPANS), ("candidates", _CANDS)])


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offs in W.slices(batch, "text"):
            runs = []
            for table, least in ((HEX, LEAST_HEX), (CANDIDATE, LEAST_CANDIDATE)):
                w = W.Words(data, offs, table)
                far = w.end - w.start >= least
                runs.append((w.start[far], w.end[far], np.searchsorted(w.start[far], offs)))
            spans, cands = [], []
            for i in range(part.num_rows):
                base = int(offs[i])
                raw = data[base:offs[i + 1]].tobytes()
                (hs, he, hf), (cs, ce, cf) = runs
                found = rule_spans(raw, [(int(a) - base, int(b) - base) for a, b in
                                         zip(hs[hf[i]:hf[i + 1]], he[hf[i]:hf[i + 1]], strict=True)])
                some = [(int(a) - base, int(b) - base) for a, b in
                        zip(cs[cf[i]:cf[i + 1]], ce[cf[i]:cf[i + 1]], strict=True)]
                some = [(a, b) for a, b in some if re.search(rb"[A-Za-z]", raw[a:b])]
                if not found and not some:
                    spans.append([])
                    cands.append([])
                    continue
                chars = np.r_[0, np.cumsum((data[base:offs[i + 1]] & 0xC0) != 0x80)]
                found.sort(key=lambda x: (x[1], x[0]))
                spans.append([{"kind": k, "start": int(chars[a]), "end": int(chars[b])} for k, a, b in found])
                edge = np.zeros(len(raw) + 1, dtype=np.int64)
                for _, a, b in found:
                    edge[a] += 1
                    edge[b] -= 1
                inside = np.cumsum(edge) > 0
                ruled = np.r_[0, np.cumsum(inside)]  # bytes in findings before each byte
                turns = np.flatnonzero(np.diff(np.r_[False, inside]))
                cands.append([{"start": int(chars[a]), "end": int(chars[b]), "views": views(raw, a, b),
                               "rule": bool(ruled[b] > ruled[a]), "whole": bool(ruled[b] - ruled[a] == b - a),
                               "ruled": held(ruled, turns[::2], turns[1::2], a, b)}
                              for a, b in some])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(spans, _SPANS), pa.array(cands, _CANDS)], schema=_FOUND)


@dataclass
class Network:
    """Weights; ``scale`` and ``shift`` calibrate the raw score."""

    p: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = [_forward(self.p, x[i:i + BATCH])["logit"] for i in range(0, len(x), BATCH)]
        return np.round(np.clip(np.concatenate(out), -LIMIT, LIMIT) * GRID) / GRID if out else np.zeros(0)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.raw(x) + self.shift, -30, 30)))


WIDTH, EMBED, FILTERS = 5, 8, 16
#: Places of the convolution that lie before, in and after the candidate.
_PLACES = [(0, BEFORE - WIDTH // 2), (BEFORE - WIDTH // 2, BEFORE + INSIDE - WIDTH // 2), (BEFORE + INSIDE - WIDTH // 2, VIEW - WIDTH + 1)]


def _forward(p: dict, x: np.ndarray) -> dict:
    x, n = np.minimum(x, 127).astype(np.intp), VIEW - WIDTH + 1
    e = p["E"].astype(np.float32).take(x.ravel(), axis=0).reshape(len(x), VIEW * EMBED)
    cols = np.lib.stride_tricks.sliding_window_view(e, WIDTH * EMBED, axis=1)[:, ::EMBED]
    z = (np.ascontiguousarray(cols).reshape(-1, WIDTH * EMBED) @ p["K"].astype(np.float32)).reshape(len(x), n, FILTERS)
    before, inside, after = (a + z[:, a:b].argmax(axis=1) for a, b in _PLACES)
    rows, filters = np.arange(len(x))[:, None], np.arange(FILTERS)
    context = np.where(z[rows, after, filters] > z[rows, before, filters], after, before)
    pooled = np.maximum(np.concatenate([z[rows, at, filters] + p["k"] for at in (inside, context)], axis=1), 0)
    return {"x": x, "peaks": np.concatenate([inside, context], axis=1), "pooled": pooled, "logit": pooled @ p["c"] + p["d"]}


def _start(seed: int = 11) -> dict:
    rng = np.random.default_rng(seed)
    return {"E": rng.normal(0, .5, (128, EMBED)), "K": rng.normal(0, .2, (WIDTH * EMBED, FILTERS)),
            "k": np.zeros(FILTERS), "c": rng.normal(0, .2, 2 * FILTERS), "d": np.array(0.0)}


def _gradient(p: dict, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
    f = _forward(p, x)
    dl = weight * (1 / (1 + np.exp(-np.clip(f["logit"], -30, 30))) - y) / len(x)
    dp = dl[:, None] * p["c"] * (f["pooled"] > 0)
    # only each filter's largest place has a gradient: the sums, by place in
    # the window and character, of what came from there
    filters, rows = np.tile(np.arange(FILTERS), 2), np.arange(len(x))[:, None]
    sums = np.stack([np.bincount((f["x"][rows, f["peaks"] + k] * FILTERS + filters).ravel(), dp.ravel(), 128 * FILTERS)
                     for k in range(WIDTH)]).reshape(WIDTH, 128, FILTERS)
    kernel = p["K"].reshape(WIDTH, EMBED, FILTERS)
    return {"E": np.einsum("kbf,kef->be", sums, kernel), "K": (p["E"].T @ sums).reshape(WIDTH * EMBED, FILTERS),
            "k": dp.reshape(-1, 2, FILTERS).sum(axis=(0, 1)), "c": f["pooled"].T @ dl, "d": dl.sum()}


def _fit(x: np.ndarray, y: np.ndarray, steps: int = STEPS, rate: float = 0.01, seed: int = 11, p: dict | None = None) -> dict:
    """Adam from the weights ``p`` (else from the start), ``BATCH`` rows a step,
    each pass over all rows in a new order; at least one whole pass, unless
    ``steps`` is 0."""
    rng = np.random.default_rng(seed + 1)
    p = _start(seed) if p is None else dict(p)
    m1, m2 = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    weight = np.where(y == 1, .5 / y.mean(), .5 / (1 - y.mean()))
    order = np.zeros(0, dtype=np.int64)
    for step in range(1, (steps and max(steps, -(-len(x) // BATCH))) + 1):
        if not len(order):
            order = rng.permutation(len(x))
        at, order = order[:BATCH], order[BATCH:]
        for k, g in _gradient(p, x[at], y[at], weight[at]).items():
            gk = g + 1e-4 * p[k]
            m1[k] = .9 * m1[k] + .1 * gk
            m2[k] = .999 * m2[k] + .001 * gk * gk
            p[k] = p[k] - rate * (m1[k] / (1 - .9 ** step)) / (np.sqrt(m2[k] / (1 - .999 ** step)) + 1e-8)
    return p


def _calibrate(raw: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 0.1) -> tuple[float, float]:
    """Logistic regression of the label on the raw score, each ``n`` times, by
    short Newton steps; smoothed targets and the ridge keep it finite if a cut
    separates the labels."""
    a = start = np.array([1.0, 0.0])
    x = np.column_stack([raw, np.ones(len(raw))])
    ones = (y * n).sum()
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (n.sum() - ones + 2))
    for _ in range(60):
        q = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        step = np.linalg.solve((x.T * (n * q * (1 - q))) @ x + ridge * np.eye(2),
                               x.T @ (n * (q - target)) + ridge * (a - start))
        a = a - step * min(1.0, 0.5 / max(np.abs(step).max(), 1e-12))
    return float(a[0]), float(a[1])


# What stands before candidates in the harder examples.
_NAMES_OF_SECRETS = [b'pwd = "', b"auth: ", b"credential=", b"Bearer ", b'"key": "', b"private_key: ", b"pass ", b"login "]
_PLAIN_BEFORE = [b"see ", b"file ", b"in the ", b"id: ", b"at ", b"name = ", b"(", b"https://site.org/"]


def _view(before: bytes, inside: bytes, after: bytes) -> bytes:
    return before[-BEFORE:].rjust(BEFORE, b"\0") + inside[:INSIDE].ljust(INSIDE, b"\0") + after[:AFTER].ljust(AFTER, b"\0")


def _draw(rng: random.Random, low: int, high: int) -> int:
    return low + int(rng.random() * (high - low))


def _decoy(words: list[bytes], rng: random.Random) -> bytes:
    """Words as people join them: slugs, paths, identifiers, versions, dates."""
    words = [w[:_draw(rng, 3, 9)] for w in words]
    number, year = str(_draw(rng, 1, 10 ** _draw(rng, 1, 5))).encode(), str(_draw(rng, 1990, 2031)).encode()
    month = f"{_draw(rng, 1, 13):02d}".encode()
    kind = _draw(rng, 0, 8)
    if kind == 0:
        return b"-".join([*words, number])
    if kind == 1:
        return b"/" + b"/".join([*words, number])
    if kind == 2:
        return b"_".join([*words, b"id", number])
    if kind == 3:
        return b"".join(w.capitalize() for w in words) + number
    if kind == 4:
        return year + b"-" + month + b"-" + words[0] + b"-" + words[-1]
    if kind == 5:
        return b"v" + number[:1] + b"-" + number[-2:] + b"-" + b"-".join(words)
    if kind == 6:
        return b"_".join(words).upper() + b"=" + number
    return words[0] + b"/" + year + b"/" + month + b"/" + words[-1]


#: Alphabets that keys are written in.
_ALPHABETS = [b"0123456789abcdef", b"0123456789ABCDEF", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
              b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
              b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
              b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", b"abcdefghijklmnopqrstuvwxyz0123456789"]


def _rewritten(value: bytes, rng: random.Random) -> bytes:
    """A secret's value in another alphabet and length, now and then behind a
    short prefix; it stays as random as it was."""
    alphabet = _ALPHABETS[_draw(rng, 0, len(_ALPHABETS))]
    number, out = int.from_bytes(hashlib.sha512(value + bytes([_draw(rng, 0, 256)])).digest(), "big"), b""
    for _ in range(_draw(rng, LEAST_CANDIDATE, 49)):
        number, at = divmod(number, len(alphabet))
        out += alphabet[at:at + 1]
    if rng.random() < .2:
        out = out[:_draw(rng, 2, 5)].lower() + (b"-" if rng.random() < .5 else b"_") + out
    return out


def harder(x: np.ndarray, y: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The labelled views, and ``HARDER`` or more harder ones of either label: secrets
    without the name that gave them away, and words that look like secrets."""
    rng = random.Random(seed)
    words = [w for v in x[y == 0] for w in re.findall(rb"[a-z]{3,}", v[BEFORE:BEFORE + INSIDE].tobytes().lower())] or [b"some", b"word"]
    views_, labels = [v.tobytes() for v in x], list(y)
    # as many of each label at any size, so that a few findings show many forms
    times = {label: -(-HARDER // max(1, int((y == label).sum()))) for label in (0, 1)}
    for v, label in ((v, label) for v, label in zip(x, y, strict=True) for _ in range(times[int(label)])):
        inside = v[BEFORE:BEFORE + INSIDE].tobytes().rstrip(b"\0")
        # what comes after tells nothing: as it was, a space, or the text's end
        after = [v[BEFORE + INSIDE:].tobytes(), b" " + v[BEFORE + INSIDE:].tobytes(), b""][min(_draw(rng, 0, 5) // 2, 2)]
        if label == 1:
            value = _rewritten(inside, rng)
            while not re.search(rb"[A-Za-z]", value):
                value = _rewritten(value, rng)
            names = _NAMES_OF_SECRETS if rng.random() < .5 else _PLAIN_BEFORE
            views_.append(_view(names[_draw(rng, 0, len(names))], value, after))
        else:
            decoy = _decoy([words[_draw(rng, 0, len(words))] for _ in range(_draw(rng, 2, 5))], rng)
            while len(decoy) < LEAST_CANDIDATE:
                decoy += b"-" + words[_draw(rng, 0, len(words))]
            names = _NAMES_OF_SECRETS if rng.random() < .2 else _PLAIN_BEFORE
            views_.append(_view(names[_draw(rng, 0, len(names))], decoy, after))
        labels.append(label)
    return np.frombuffer(b"".join(views_), np.uint8).reshape(-1, VIEW), np.array(labels)


def _settled(net: Network, counts: list[tuple[float, float, bool, int]], recall: float) -> Network | None:
    """The network with scale, shift and threshold from the calibration part's
    (raw score, label, whether it is as it was found, how often)."""
    raw, labels, given, n = (np.array(c) for c in zip(*sorted(counts), strict=True))
    net.scale, net.shift = _calibrate(raw, labels, n.astype(np.float64))
    if net.scale <= 0:  # scores that do not rank the labels decide nothing
        return None
    scores = 1 / (1 + np.exp(-np.clip(net.scale * raw + net.shift, -30, 30)))
    # at most this many labelled secrets may fall below the threshold, of the
    # findings as they are and of all ...
    for some in (labels == 1, given & (labels == 1)):
        below = int(np.floor((1 - recall) * n[some].sum()))
        net.threshold = min(net.threshold, float(scores[some][np.searchsorted(np.cumsum(n[some]), below, side="right")]))
    # ... and where no other candidate lies just below, it is half way down to the next one
    under = scores[(labels == 0) & (scores < net.threshold)]
    net.threshold = (net.threshold + float(under.max(initial=0.0))) / 2
    return net


def train_network(x: np.ndarray, y: np.ndarray, fold: np.ndarray, recall: float = RECALL
                  ) -> Network | None:
    """``x``: the candidates' views; ``fold`` marks the calibration
    part.  Both parts are made harder, each from its own views.  This is what
    ``train`` does, for views of one shard that are at hand."""
    parts = [y[~fold], y[fold]]
    if any(min((q == 0).sum(), (q == 1).sum()) < LEAST_LABELLED for q in parts):
        return None
    net = Network(_fit(*harder(x[~fold], y[~fold], 1)))
    # what no rule finds need not be harmless: words that look like secrets
    # to a first network are left out, and the network is fitted again
    doubtful = (y == 0) & (net.raw(x) > DOUBT)
    left = (y == 0) & ~doubtful
    if doubtful.any() and min((left & ~fold).sum(), (left & fold).sum()) >= LEAST_LABELLED:
        x, y, fold = x[~doubtful], y[~doubtful], fold[~doubtful]
        net = Network(_fit(*harder(x[~fold], y[~fold], 1)))
    x, labels = harder(x[fold], y[fold], 2)
    given = np.arange(len(labels)) < fold.sum()
    return _settled(net, [(r, q, g, 1) for r, q, g in zip(net.raw(x), labels, given, strict=True)], recall)


# -- the same over any number of candidates, in shards ------------------------
def _arrays(shard: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(shard["views"], np.uint8).reshape(-1, VIEW), np.frombuffer(shard["labels"], np.uint8).astype(np.float64)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


_UNIT = 2 ** 32


def _labelled(found: DataFrame) -> DataFrame:
    """Every view of every candidate, different ones of a label once."""
    def of_candidate(c):
        return F.transform(F.sequence(F.lit(0), F.length(c["ruled"]) - 1), lambda i: F.struct(
            (F.substring(c["ruled"], i + 1, F.lit(1)) == F.lit(b"\1")).alias("rule"),
            F.substring(c["views"], i * VIEW + 1, F.lit(VIEW)).alias("view")))

    return (found.select(F.explode("candidates").alias("c")).select(F.explode(of_candidate(F.col("c"))).alias("v")).select("v.*")
            .distinct().withColumn("h", F.xxhash64("view")).withColumn("fold", F.pmod("h", F.lit(4)) == 0))


def _counts(cands: DataFrame) -> dict[tuple[bool, bool], int]:
    """Views by part and label."""
    got = {(r.fold, r.rule): r.n for r in cands.groupBy("fold", "rule").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {(fold, rule): got.get((fold, rule), 0) for fold in (False, True) for rule in (False, True)}


def _shards(cands: DataFrame, counts: dict[tuple[bool, bool], int]) -> tuple[DataFrame, int]:
    """The views in shards made harder (``given`` of a shard's views come
    first, as they were), and how many shards the fitting part has; there, a
    label of fewer than ``LEAST_SHARD`` a shard is dealt to several."""
    size = {fold: -(-max(counts[fold, True], counts[fold, False]) // SHARD) for fold in (False, True)}
    times = {rule: min(size[False], -(-LEAST_SHARD * size[False] // counts[False, rule])) for rule in (False, True)}
    n = F.when(F.col("fold"), F.lit(size[True])).otherwise(F.lit(size[False]))
    copies = F.when(F.col("fold"), F.lit(1)).when(F.col("rule"), F.lit(times[True])).otherwise(F.lit(times[False]))
    # copies lie evenly over the shards, so no two come to one
    place = (F.pmod(F.xxhash64("h", F.lit(7)), n) + F.floor(F.col("copy") * n / F.col("copies"))) % n

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            x = np.frombuffer(b"".join(c["view"] for c in row["cands"]), np.uint8).reshape(-1, VIEW)
            more, labels = harder(x, np.array([float(c["rule"]) for c in row["cands"]]), 2 * row["shard"] + (2 if row["fold"] else 1))
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (
                row["fold"], row["shard"], len(x), labels.astype(np.uint8).tobytes(), more.tobytes())],
                names=["fold", "shard", "given", "labels", "views"])

    dealt = (cands.withColumn("copies", copies).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
             .withColumn("shard", place.cast("long")))
    # a few shards a task, so that few of them are spread over tasks too
    total = sum(size.values())
    packs = (dealt.repartition(min(total, max(64, total // 8)), "fold", "shard").groupBy("fold", "shard")
             .agg(F.sort_array(F.collect_list(F.struct("h", "view", "rule"))).alias("cands")))
    return keep(packs.mapInArrow(pack, "fold boolean, shard long, given long, labels binary, views binary"), "shards"), size[False]


def _round(p: dict, turn: int, rounds: int):
    """One task's part of a round: the sum of its shards' weights, in whole
    ``_UNIT`` parts, and their number.  A shard of one label only, if chance
    deals one, cannot be fitted and has no say."""
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(sum(v.size for v in p.values()), dtype=np.int64), 0
        for row in _rows(batches):
            x, y = _arrays(row)
            if y.min() < y.max():
                got = _fit(x, y, STEPS // rounds, seed=11 + turn + rounds * row["shard"], p=p)
                total += np.round(np.concatenate([got[k].ravel() for k in p]) * _UNIT).astype(np.int64)
                n += 1
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total), pa.array(np.full(len(total), n))],
                                             names=["at", "total", "n"])
    return go


def _fit_shards(shards: DataFrame, n: int) -> dict:
    """The mean of the shards' weights after ``ROUNDS``, each a pass over all;
    a single shard takes all its steps at once."""
    p, rounds = _start(), ROUNDS if n > 1 else 1
    for turn in range(rounds):
        sums = (shards.where(~F.col("fold")).mapInArrow(_round(p, turn, rounds), "at long, total long, n long")
                .groupBy("at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect())
        mean = np.array([r.total / r.n / _UNIT for r in sorted(sums)])
        cuts = np.cumsum([v.size for v in p.values()])[:-1]
        p = {k: part.reshape(v.shape) for (k, v), part in zip(p.items(), np.split(mean, cuts), strict=True)}
    return p


def _doubted(net: Network):
    @F.arrow_udf("boolean")
    def doubted(view: pa.Array) -> pa.Array:
        return pa.array(net.raw(np.frombuffer(b"".join(view.to_pylist()), np.uint8).reshape(-1, VIEW)) > DOUBT)

    return doubted(F.col("view"))


def _raw_counts(shards: DataFrame, net: Network) -> list[tuple[float, float, bool, int]]:
    """How often each raw score is there in the calibration part, by label and
    by whether the view is as it was found: no more rows than the grid has."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _rows(batches):
            x, y = _arrays(shard)
            yield pa.RecordBatch.from_arrays([pa.array(net.raw(x)), pa.array(y), pa.array(np.arange(len(y)) < shard["given"])],
                                             names=["raw", "label", "given"])

    counts = (shards.where("fold").mapInArrow(score, "raw double, label double, given boolean")
              .groupBy("raw", "label", "given").agg(F.count(F.lit(1)).alias("n")).collect())
    return [(r.raw, r.label, r.given, r.n) for r in counts]


def train(found: DataFrame, recall: float = RECALL) -> Network | None:
    """``train_network`` on all views of ``findings_table``."""
    cands = keep(_labelled(found), "labelled")
    counts = _counts(cands)
    if min(counts.values()) < LEAST_LABELLED:
        return None
    shards, n = _shards(cands, counts)
    net = Network(_fit_shards(shards, n))
    surer = keep(cands.where(F.col("rule") | ~_doubted(net)), "surer")
    left = _counts(surer)
    if left != counts and min(left.values()) >= LEAST_LABELLED:
        shards, n = _shards(surer, left)
        net = Network(_fit_shards(shards, n))
    return _settled(net, _raw_counts(shards, net), recall)


def findings_table(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rules' findings and the candidates of every row, written once."""
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return keep(docs.mapInArrow(
        _find, "doc_id long, spans array<struct<kind:int,start:int,end:int>>, "
               "candidates array<struct<start:int,end:int,rule:boolean,whole:boolean,views:binary,ruled:binary>>"), "findings")


def _judged(batch: pa.RecordBatch, net: Network | None) -> list[list[tuple[int, int, int]]]:
    """(kind number, start, end) of each row, with what the network adds."""
    out, todo, blocks = [], [], []
    for i, (spans, cands) in enumerate(zip(batch.column("spans").to_pylist(),
                                           batch.column("candidates").to_pylist(), strict=True)):
        out.append([(s["kind"], s["start"], s["end"]) for s in spans])
        for c in cands:
            if net is not None and not c["whole"]:
                todo.append((i, c["start"], c["end"], len(c["views"]) // VIEW))
                blocks.append(c["views"])
    if todo:
        scores = net.scores(np.frombuffer(b"".join(blocks), np.uint8).reshape(-1, VIEW))
        best = np.maximum.reduceat(scores, np.cumsum([0] + [t[3] for t in todo[:-1]]))
        for (i, a, b, _), s in zip(todo, best.tolist(), strict=True):
            if s >= net.threshold:
                out[i].append((3, a, b))
    return [sorted(r, key=lambda x: (x[1], x[0])) for r in out]


def secret_spans(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and findings (kind, start, end) of every row, by start and kind."""
    found = findings_table(documents, id_col, text_col)
    net = train(found)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            rows = [[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in r] for r in _judged(batch, net)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(rows, pa.list_(pa.struct(
                    [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))],
                names=["doc_id", "findings"])

    return found.mapInArrow(judge, f"doc_id long, findings {FINDINGS}")


def _replace(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    out, at = [], 0
    for _, a, b in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(documents: DataFrame, mark: str = "<secret>", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with every finding replaced by ``mark`` (findings that
    overlap by one); all rows and columns stay.  Texts are searched again
    where they are, so no row is shuffled."""
    net = train(findings_table(documents, id_col, text_col))

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        rows = pa.RecordBatch.from_arrays([pa.nulls(len(texts), pa.int64()), texts], names=["doc_id", "text"])
        spans = [r for batch in _find(iter([rows])) for r in _judged(batch, net)]
        return pa.array([_replace(t, s, mark) if s else t for t, s in zip(texts.to_pylist(), spans, strict=True)],
                        pa.string())

    return documents.withColumn(text_col, clean(F.col(text_col)))


def digest(spans: DataFrame) -> DataFrame:
    def count(kind):
        return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def line(col):
        return F.array_join(F.transform(col, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    base = F.filter("findings", lambda x: x["kind"] != "model")
    return spans.select("doc_id", *(count(k) for k in KINDS[:3]), F.sha2(line(base), 256).alias("base_sha256"),
                        line("findings").alias("spans"))
