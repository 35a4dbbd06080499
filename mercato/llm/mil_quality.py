"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages (runs of ``PASSAGE`` words over its whole
text); only the bag has a label.  Each passage becomes a vector of surface
statistics, an encoder maps it to h = tanh(W x + b), gated attention weighs
it by softmax(w . (tanh(V h) * sigmoid(U h))), and the document's score is
the sigmoid of a linear layer on the weighted mean of h.  All weights are
learned together from document labels, by gradient descent.

Only the text enters a score.  The model is fitted on all labelled documents
outside the held-out fold (or on ``sample`` of them, if a caller asks for
that: the ones with the smallest hash of their id).  They are dealt by hash to
shards of about ``SHARD``, whose number follows the documents and their
passages alone; in a round each shard goes on from the common weights, in a
task, and the mean of what the shards reach, by their documents, is the next
round's.  Sums over shards are of decimals, so they do not depend on tasks or
their order.  A single shard takes all its steps at once, on the driver.
Passages of all documents are computed and scored in tasks, with vectorised
numpy over slices of bounded size.

Cases: a null, empty or blank text is one passage without words; labels that
are null are ignored, and of several labels of a document the smallest
counts; without labels of both classes every score is the share of good
labels (1 if there are none); a null doc_id is held out.  Rows that repeat
are scored each; other columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm import words as W
from mercato.llm.store import keep

PASSAGE = 64
#: Labelled documents, and passages, of a shard.
SHARD, SHARD_PASSAGES = 4000, 64_000
#: Rounds over all shards; steps that a shard takes in all.
ROUNDS, STEPS = 4, 300
THRESHOLD = 0.3
#: Byte classes whose shares are features.
CLASSES = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", "#*$%&|<>", "!", "?",
           ".", ",", "\n", " \t\r\v\f", "\"'()[]{}", "=:;/_@\\+-~^`"]
_CLASS = np.full(256, len(CLASSES), dtype=np.int64)  # the rest: control bytes
for _i, _chars in enumerate(CLASSES):
    _CLASS[list(_chars.encode())] = _i
_CLASS[0x80:0xC0] = len(CLASSES) + 1  # continuation bytes
_CLASS[0xC0:] = len(CLASSES) + 2
N_CLASSES = len(CLASSES) + 3
N_FEATURES = N_CLASSES + 8


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Whether a key occurred at a smaller index."""
    _, first = np.unique(keys, return_index=True)
    again = np.ones(len(keys), dtype=bool)
    again[first] = False
    return again


def passages(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature vectors of all passages of a slice, and how many each row has."""
    w = W.Words(data, offs)
    per_row = np.maximum(1, -(-w.count // PASSAGE))
    base = np.cumsum(per_row) - per_row
    total = int(per_row.sum())
    place = np.arange(len(w)) - w.first[w.row]
    of_word = base[w.row] + place // PASSAGE
    # a passage's bytes run from its first word to the next passage
    begins = np.zeros(total, dtype=np.int64)
    begins[base] = offs[:-1]
    later = (place % PASSAGE == 0) & (place > 0)
    begins[of_word[later]] = w.start[later]
    of_byte = np.repeat(np.arange(total), np.diff(np.r_[begins, offs[-1]]))
    by_class = np.bincount(of_byte * N_CLASSES + _CLASS[data], minlength=total * N_CLASSES)
    by_class = by_class.reshape(total, N_CLASSES).astype(np.float64)
    n = np.bincount(of_word, minlength=total).astype(np.float64)
    some = np.maximum(n, 1)

    def share(flag):
        return np.bincount(of_word, flag, minlength=total) / some

    length = w.end - w.start
    hashes = w.hashes()
    word_again = _repeats(W.mix(hashes + W.mix(of_word.astype(np.uint64))))
    at = np.arange(len(w))
    at = at[at + 4 <= w.first[1:][w.row]]
    run_again = np.zeros(len(w), dtype=bool)
    run_again[at] = _repeats(W.mix(W.range_sums(hashes, at, at + 4, 1) + W.mix(w.row[at].astype(np.uint64))))
    first = data[w.start] if len(w) else np.zeros(0, dtype=np.uint8)
    chars = np.maximum(by_class.sum(axis=1) - by_class[:, len(CLASSES) + 1], 1)[:, None]
    mean = np.bincount(of_word, length, minlength=total) / some
    spread = np.sqrt(np.maximum(np.bincount(of_word, length.astype(float) ** 2, minlength=total) / some - mean ** 2, 0))
    x = np.column_stack([by_class / chars, np.log1p(n), mean, spread, share(word_again), share(run_again),
                         share(length <= 3), share((first >= 0x41) & (first <= 0x5A)),
                         np.log1p(by_class[:, 8] / some)])
    return x, per_row


@dataclass
class Model:
    """Weights by name; ``constant`` replaces the network if nothing could be learned."""

    weights: dict[str, np.ndarray]
    constant: float | None = None

    def scores(self, x: np.ndarray, per_row: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(per_row), self.constant)
        return 1 / (1 + np.exp(-np.clip(_forward(self.weights, x, per_row)["logit"], -30, 30)))

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, constant=np.nan if self.constant is None else self.constant, **self.weights)
        return out.getvalue()

    @staticmethod
    def load(raw: bytes) -> Model:
        got = dict(np.load(io.BytesIO(raw)))
        constant = float(got.pop("constant"))
        return Model(got, None if np.isnan(constant) else constant)


def _forward(p: dict, x: np.ndarray, per_row: np.ndarray) -> dict:
    starts = np.cumsum(per_row) - per_row
    xs = np.clip((x - p["mean"]) / p["std"], -8, 8)
    h = np.tanh(xs @ p["W"] + p["b"])
    t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
    e = (t * g) @ p["w"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), per_row))
    a = e / np.repeat(np.add.reduceat(e, starts), per_row)
    z = np.add.reduceat(a[:, None] * h, starts, axis=0)
    return {"xs": xs, "h": h, "t": t, "g": g, "a": a, "z": z, "logit": z @ p["c"] + p["d"], "starts": starts}


LEARNED = ["W", "b", "V", "U", "w", "c", "d"]


def _start(rng: np.random.Generator, mean: np.ndarray, std: np.ndarray, good: float, hidden: int = 16, gate: int = 8) -> dict:
    """Weights before any step; ``good`` is the share of good labels."""
    return {"mean": mean, "std": np.where(std > 1e-6, std, 1.0),
            "W": rng.normal(0, 1 / np.sqrt(len(mean)), (len(mean), hidden)), "b": np.zeros(hidden),
            "V": rng.normal(0, .25, (hidden, gate)), "U": rng.normal(0, .25, (hidden, gate)),
            "w": rng.normal(0, .25, gate), "c": np.zeros(hidden),
            "d": np.array(np.log(good / (1 - good)))}


def fit(x: np.ndarray, per_row: np.ndarray, y: np.ndarray, hidden: int = 16, gate: int = 8, steps: int = STEPS,
        bags: int = 512, rate: float = 0.02, decay: float = 1e-4, seed: int = 7, p: dict | None = None) -> Model:
    """Adam on the log loss of ``bags`` whole documents a step, each round of
    steps over all of them in a new order; gradients by hand.  With weights
    ``p`` it goes on from them, by one whole round of steps at least."""
    rng = np.random.default_rng(seed)
    if p is not None:
        p, steps = dict(p), max(steps, -(-len(y) // bags))
    elif len(y) == 0 or y.min() == y.max():
        return Model({}, float(y.mean()) if len(y) else 1.0)
    else:
        p = _start(rng, x.mean(axis=0), x.std(axis=0), y.mean(), hidden, gate)
    learned = LEARNED
    m1, m2 = ({k: np.zeros_like(p[k]) for k in learned} for _ in range(2))
    first = np.cumsum(per_row) - per_row
    order = np.zeros(0, dtype=np.int64)
    for step in range(1, steps + 1):
        if not len(order):
            order = rng.permutation(len(y))
        some, order = np.sort(order[:bags]), order[bags:]
        size = per_row[some]
        rows = np.repeat(first[some] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        f = _forward(p, x[rows], size)
        h, t, g, a = f["h"], f["t"], f["g"], f["a"]
        dl = (1 / (1 + np.exp(-f["logit"])) - y[some]) / len(some)
        dz = np.repeat(dl[:, None] * p["c"], size, axis=0)
        da = (dz * h).sum(axis=1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, f["starts"]), size))
        dt, dg = de[:, None] * p["w"] * g * (1 - t * t), de[:, None] * p["w"] * t * g * (1 - g)
        dh = a[:, None] * dz + dt @ p["V"].T + dg @ p["U"].T
        du = dh * (1 - h * h)
        grad = {"W": f["xs"].T @ du, "b": du.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg,
                "w": (t * g).T @ de, "c": f["z"].T @ dl, "d": dl.sum()}
        for k in learned:
            gk = grad[k] + decay * p[k]
            m1[k] = .9 * m1[k] + .1 * gk
            m2[k] = .999 * m2[k] + .001 * gk * gk
            p[k] = p[k] - rate * (m1[k] / (1 - .9 ** step)) / (np.sqrt(m2[k] / (1 - .999 ** step)) + 1e-8)
    return Model(p)


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _passage_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offs in W.slices(batch, "text"):
            x, per_row = passages(data, offs)
            rows = np.split(x, np.cumsum(per_row)[:-1])
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([r.tobytes() for r in rows], pa.binary())],
                                             names=["id", "x"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            size = np.array([len(d["x"]) // (8 * N_FEATURES) for d in row["docs"]], dtype=np.int64)
            y = np.array([d["y"] for d in row["docs"]], dtype=np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([v]) for v in (row["shard"], size.tobytes(), y.tobytes(), b"".join(d["x"] for d in row["docs"]))],
                names=["shard", "size", "y", "x"])


def _shards(rows: DataFrame, n: int) -> DataFrame:
    """Documents with passages, dealt to ``n`` shards by the hash of their id."""
    # a few shards a task, so that few of them are spread over tasks too
    packs = (rows.withColumn("shard", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(n)))
             .repartition(min(n, max(64, n // 8)), "shard").groupBy("shard")
             .agg(F.sort_array(F.collect_list(F.struct("id", "y", "x"))).alias("docs")))
    return keep(packs.mapInArrow(_pack, "shard long, size binary, y binary, x binary"), "shards")


def _total(shards: DataFrame, of: Callable[[np.ndarray, np.ndarray, np.ndarray, int], np.ndarray]) -> np.ndarray:
    """The sum over all shards of the vector that ``of`` makes of a shard's
    passages, their number by document, labels and the shard's number."""
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard, size, y, x = (batch.column(c)[i].as_py() for c in ("shard", "size", "y", "x"))
                out = of(np.frombuffer(x).reshape(-1, N_FEATURES), np.frombuffer(size, np.int64), np.frombuffer(y), shard)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(out))), pa.array(out)], names=["at", "part"])

    sums = (shards.mapInArrow(parts, "at long, part double").groupBy("at")
            .agg(F.sum(F.col("part").cast("decimal(38,10)")).cast("double").alias("total")).collect())
    return np.array([r.total for r in sorted(sums)])


def _fit_shards(shards: DataFrame, n: int) -> Model:
    """``fit`` over all shards, in ``ROUNDS``."""
    sums = _total(shards, lambda x, size, y, _: np.r_[len(x), len(y), y.sum(), x.sum(axis=0)])
    n_passages, n_docs, good = sums[:3]
    if good in (0, n_docs):
        return Model({}, good / n_docs)
    mean = sums[3:] / n_passages
    std = np.sqrt(_total(shards, lambda x, *_: ((x - mean) ** 2).sum(axis=0)) / n_passages)
    p = _start(np.random.default_rng(7), mean, std, good / n_docs)
    for turn in range(ROUNDS):
        def step(x: np.ndarray, size: np.ndarray, y: np.ndarray, shard: int, p: dict = p, turn: int = turn) -> np.ndarray:
            got = fit(x, size, y, steps=STEPS // ROUNDS, seed=8 + turn * n + shard, p=p).weights
            return len(y) * np.concatenate([got[k].ravel() for k in LEARNED])

        parts = np.split(_total(shards, step) / n_docs, np.cumsum([p[k].size for k in LEARNED])[:-1])
        p = p | {k: part.reshape(p[k].shape) for k, part in zip(LEARNED, parts, strict=True)}
    return Model(p)


def train(documents: DataFrame, labels: DataFrame, sample: int | None = None, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality") -> Model:
    """Fit on all labelled documents outside the held-out fold, or on the
    ``sample`` of them whose ids hash smallest.  Rows that share an id are one
    document, of the smallest of their texts' passages; no more than one
    shard's documents reach the driver."""
    picked = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).cast("long").alias("id"))
              .agg(F.min(F.col(label_col)).cast("int").alias("y")).where(~held_out("id")))
    texts = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = texts.where(F.col("id").isNotNull() & ~held_out("id"))
    if sample is not None:
        picked = picked.orderBy(F.xxhash64("id"), "id").limit(sample)
        texts = texts.join(F.broadcast(picked), "id", "left_semi")  # the hint: ``sample`` rows
    # passages are smaller than texts, so they are what is shuffled
    rows = keep(texts.mapInArrow(_passage_rows, "id long, x binary").groupBy("id").agg(F.min("x").alias("x")).join(picked, "id"), "passages")
    n_docs, n_passages = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("x")), F.lit(0)) / (8 * N_FEATURES)).first()
    if not n_docs:
        return Model({}, 1.0)
    n = int(max(-(-n_docs // SHARD), -(-n_passages // SHARD_PASSAGES)))
    if n > 1:
        return _fit_shards(_shards(rows, n), n)
    one = sorted(rows.select("id", "y", "x").collect())
    bags = [np.frombuffer(r.x).reshape(-1, N_FEATURES) for r in one]
    return fit(np.concatenate(bags), np.array([len(b) for b in bags]), np.array([float(r.y) for r in one]))


def score(model: Model, text_col: str = "text") -> Column:
    """The score of a row's text, computed where the row is."""
    raw = model.dump()

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        of = Model.load(raw)
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        got = [of.scores(*passages(data, offs)) for _, data, offs in W.slices(batch, "text")]
        return pa.array(np.concatenate(got) if got else np.zeros(0))

    return scores(F.col(text_col))


def quality_scores(documents: DataFrame, model: Model, id_col: str = "doc_id",
                   text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    scored = documents.select(F.col(id_col).cast("long").alias("doc_id"), score(model, text_col).alias("score"))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              threshold: float = THRESHOLD) -> DataFrame:
    """The rows that the model does not reject, with all their columns; each
    row is judged by its own text, without a shuffle."""
    model = train(documents, labels, id_col=id_col, text_col=text_col)
    return documents.where(score(model, text_col) >= threshold)
