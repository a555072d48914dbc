"""Text quality by attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded; gated attention, learned from
document labels alone, weighs the passages; the weighted sum is scored. The encoding sees
characters and words only: which kinds of characters follow each other, word lengths and
repetition.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bytestext

PASSAGE_WORDS = 48
HIDDEN, GATE = 24, 12
#: Bound of the rows, and of the bytes of each text, that a model is fitted on.
SAMPLE_ROWS, SAMPLE_TEXT_BYTES = 2_000, 1 << 16

#: Kinds of bytes; unlisted ASCII is kind 0.
KINDS = [
    "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\t\r\v\f", "\n", ".", ",;:", "!?", "'\"`",
    "()[]{}", "-/\\_", "#$%&*@|~^=+<>",
]
_KIND = np.zeros(256, np.int64)
for _k, _letters in enumerate(KINDS, 1):
    _KIND[[ord(c) for c in _letters]] = _k
_KIND[0x80:0xC0], _KIND[0xC0:] = 14, 15
_UPPER = _KIND == 2
FEATURES = 256 + 6


def encode(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages, and for each text where its passages begin. A text without words has one passage of zeros."""
    starts, ends, of_row = bytestext.words(data, bounds)
    n = np.diff(of_row)
    passages = np.maximum(1, -(-n // PASSAGE_WORDS))
    begins = np.concatenate([[0], np.cumsum(passages)])
    features = np.zeros((begins[-1], FEATURES), np.float32)
    if not len(starts):
        return features, begins
    row = np.repeat(np.arange(len(n)), n)
    passage = begins[:-1][row] + (np.arange(len(starts)) - of_row[:-1][row]) // PASSAGE_WORDS
    count = np.bincount(passage, minlength=begins[-1]).astype(np.float32)
    full = np.maximum(count, 1)
    # A passage's bytes run from its first word to the next passage's, or its text's end.
    first = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
    span = np.diff(np.concatenate([starts[first], [len(data)]]))
    of_byte = np.repeat(passage[first], span)
    kinds = _KIND[data[starts[0] :]]
    pairs = of_byte[:-1] * 256 + kinds[:-1] * 16 + kinds[1:]
    pairs = np.bincount(pairs[of_byte[:-1] == of_byte[1:]], minlength=begins[-1] * 256).reshape(-1, 256)
    features[:, :256] = np.sqrt(pairs / np.maximum(pairs.sum(axis=1, keepdims=True), 1))
    hashes = bytestext.span_hashes(data, starts, ends)
    distinct = np.unique(bytestext.mix(hashes + passage.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
    same = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (passage[1:] == passage[:-1])])
    upper = np.concatenate([[0], np.cumsum(_UPPER[data])])
    capitals = (upper[ends] - upper[starts]) >= 2
    mean = lambda x: np.bincount(passage, x, minlength=begins[-1]) / full
    features[:, 256] = np.bincount(passage[distinct], minlength=begins[-1]) / full
    features[:, 257] = mean(same)
    features[:, 258] = mean(capitals)
    features[:, 259] = np.minimum(mean(ends - starts), 40) / 10
    features[:, 260] = mean((ends - starts) > 20)
    features[:, 261] = np.log1p(count) / 4
    return features, begins


def encoded(column):
    """Slices of a text column as (first row, features, begins)."""
    data, bounds = bytestext.flat(column)
    for begin, end in bytestext.slices(bounds):
        yield begin, *encode(data[bounds[begin] : bounds[end]], bounds[begin : end + 1] - bounds[begin])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """Weights: passage encoder W, attention V and U with w, and the score's c and b."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, features: np.ndarray, begins: np.ndarray):
        p, starts, sizes = self.weights, begins[:-1], np.diff(begins)
        x = (features - self.mean) * self.scale
        h = np.tanh(x @ p["W"] + p["d"])
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * s) @ p["w"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        a = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts)
        return x, h, t, s, a, z, _sigmoid(z @ p["c"] + p["b"])

    def scores(self, features: np.ndarray, begins: np.ndarray) -> np.ndarray:
        return self.forward(features, begins)[-1].astype(np.float64)

    def gradients(self, features: np.ndarray, begins: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, sizes = self.weights, np.diff(begins)
        x, h, t, s, a, z, q = self.forward(features, begins)
        d = ((q - y) / len(y)).astype(np.float32)
        of = np.repeat(np.arange(len(sizes)), sizes)
        dz = (d[:, None] * p["c"])[of]
        pull = (dz * h).sum(axis=1)
        de = a * (pull - np.add.reduceat(a * pull, begins[:-1])[of])
        dt, ds = de[:, None] * p["w"] * s * (1 - t * t), de[:, None] * p["w"] * t * s * (1 - s)
        dh = (a[:, None] * dz + dt @ p["V"].T + ds @ p["U"].T) * (1 - h * h)
        return {
            "W": x.T @ dh, "d": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de, "c": z.T @ d, "b": d.sum(keepdims=True),
        }


def fit(features: np.ndarray, begins: np.ndarray, labels: np.ndarray, steps: int = 150, rate: float = 0.02, decay: float = 1e-4, seed: int = 7) -> Model:
    """Fit on the bags of a bounded sample by Adam. Without both classes the model gives the smoothed share of label 1 to all."""
    draw = np.random.default_rng(seed)
    shape = {"W": (FEATURES, HIDDEN), "d": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,), "c": (HIDDEN,), "b": (1,)}
    weights = {k: (draw.standard_normal(s) / np.sqrt(s[0]) if len(s) == 2 else np.zeros(s) if k in "db" else draw.standard_normal(s) * 0.1).astype(np.float32) for k, s in shape.items()}
    y = labels.astype(np.float32)
    share = (y.sum() + 1) / (len(y) + 2)
    weights["b"][:] = np.log(share / (1 - share))
    if not 0 < y.sum() < len(y):
        weights["c"][:] = 0
        return Model(np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32), weights)
    model = Model(features.mean(axis=0), 1 / np.maximum(features.std(axis=0) * np.sqrt(FEATURES / 16), 1e-2), weights)
    first, second = ({k: np.zeros_like(v) for k, v in weights.items()} for _ in range(2))
    for step in range(1, steps + 1):
        for k, g in model.gradients(features, begins, y).items():
            g = g + decay * weights[k] * (len(weights[k].shape) == 2)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            weights[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def held_out(doc_id: Column) -> Column:
    """Whether a document is in the third that no label is learned from; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def train(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, text_bytes: int = SAMPLE_TEXT_BYTES) -> Model:
    """Fit on at most ``rows`` labelled documents outside the held-out third, texts of at most ``text_bytes``.

    The sample is the first by a hash of the id; its ids are broadcast, its passages' features
    come to the driver. Rows with a null id or quality are not learned from, nor are ids whose
    label rows contradict each other; repeated label rows count once. Of several documents with
    one id the text of smallest hash is learned from, a null text counting as the empty one. Empty
    tables, or labels of one kind alone, give a model that cannot tell documents apart.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("_y")).where("_id IS NOT NULL AND _y IS NOT NULL")
    known = known.where(~held_out(F.col("_id"))).groupBy("_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_top")).where("_y = _top")
    known = known.select("_id", "_y").orderBy(F.xxhash64("_id"), "_id").limit(rows)
    texts = documents.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = texts.join(F.broadcast(known), "_id").where(F.octet_length("text") <= text_bytes)
    # One text an id, told before any leaves its task: a label row may stand for any number of documents.
    texts = texts.groupBy("_id", "_y").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("_first")).select("_id", F.col("_first.text").alias("text"), "_y")

    def bags(batches):
        for batch in batches:
            out = [features[b:e].tobytes() for _, features, begins in encoded(batch.column(1)) for b, e in zip(begins[:-1], begins[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out, pa.binary())], ["id", "y", "bag"])

    sample = bytestext.small_batches(texts.select("_id", "text", "_y")).mapInArrow(bytestext.tidy(bags), "id long, y int, bag binary").toArrow()
    order = np.lexsort([sample.column(1).to_numpy(), sample.column(0).to_numpy()])
    stored = [np.frombuffer(sample.column(2)[int(k)].as_py(), np.float32).reshape(-1, FEATURES) for k in order]
    features = np.concatenate(stored) if stored else np.zeros((0, FEATURES), np.float32)
    return fit(features, np.concatenate([[0], np.cumsum([len(b) for b in stored])]).astype(np.int64), sample.column(1).to_numpy()[order])


def _scores(model: Model, column) -> np.ndarray:
    out = np.zeros(len(column))
    for first, features, begins in encoded(column):
        out[first : first + len(begins) - 1] = model.scores(features, begins)
    return out


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every whole text.

    A null or empty text, or one of blanks, is scored as one empty passage. Equal texts have
    equal scores; repeated rows repeat their result; null ids are kept; columns besides the
    id and the text are not read.
    """

    def rate(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores(model, batch.column(1)))], ["doc_id", "score"])

    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = bytestext.small_batches(narrow).mapInArrow(bytestext.tidy(rate), "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(documents: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents that score at least ``least``, with all their columns. Each row is judged by its text alone."""
    at = documents.columns.index("text")

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array(_scores(model, batch.column(at)) >= least))

    return bytestext.small_batches(documents).mapInArrow(bytestext.tidy(keep), documents.schema)
