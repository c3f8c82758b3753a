"""Document quality from random-indexing word vectors and a small neural network.

Every word and every word shape (its runs of letters, digits and signs) has a fixed sparse
index vector made from its hash. The vector of a word is the sum of the index vectors of the
words and shapes around it in the labelled sample, held in a table of hashed rows of fixed
size. A document is pooled to the mean of its words' vectors and the mean of its shapes'
index vectors, with a few shares such as how often a word repeats the one before. A
two-layer network in numpy is trained on these, and its logits are divided by a temperature
that is fitted on examples that the network has not seen.

Words, shapes and pooling cover whole texts. Scoring is one pass over the documents without
a shuffle; the vectors and the network are a few megabytes whatever the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import fold, pieces
from tributary.llm.labelled import labelled_sample
from tributary.llm.tokens import BYTE_VALUES, NOT_ALNUM, SPACE, _slices, buffers, span_hashes, word_hashes, word_spans

DIM = 32
ROWS = 1 << 15
SHAPE_ROWS = 1 << 12
EXTRAS = 6

# Letters count as one kind, also beyond ASCII; capitals, digits and every sign are kinds of their own.
KIND = np.arange(256, dtype=np.uint8)
KIND[ord("a") : ord("z") + 1] = ord("a")
KIND[128:] = ord("a")
KIND[ord("A") : ord("Z") + 1] = ord("A")
KIND[ord("0") : ord("9") + 1] = ord("0")


def _index_vectors(rows: int, seed: int) -> np.ndarray:
    """Sparse ternary vectors: four of the places are +1 or -1."""
    random = np.random.default_rng(seed)
    vectors = np.zeros((rows, DIM), np.float32)
    for _ in range(4):
        vectors[np.arange(rows), random.integers(0, DIM, rows)] = random.choice([-1.0, 1.0], rows)
    return vectors


WORD_INDEX = _index_vectors(ROWS, 6)
SHAPE_INDEX = _index_vectors(SHAPE_ROWS, 7)


def shape_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the shapes of space-separated words, and offsets by text."""
    data, offsets = buffers(column)
    parts, places = [], []
    for lo, hi in _slices(data, offsets, SPACE):
        starts, ends = word_spans(data, offsets, lo, hi)
        kinds = KIND[data[lo:hi]]
        first = np.ones(len(kinds), bool)
        first[1:] = kinds[1:] != kinds[:-1]
        first[starts] = True
        before = np.concatenate(([0], np.cumsum(first)))
        parts.append(span_hashes(BYTE_VALUES[kinds[first]], before[starts], before[ends]))
        places.append(starts + lo)
    hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    at = np.concatenate(places) if places else np.zeros(0, np.int64)
    return hashes, np.searchsorted(at, offsets, "left")


def _row(hashes: np.ndarray, rows: int) -> np.ndarray:
    return (hashes & np.uint64(rows - 1)).astype(np.int64)


def _tokens(column: pa.Array):
    words, offsets = word_hashes(column, breaks=NOT_ALNUM)
    shapes, shape_offsets = shape_hashes(column)
    return words, offsets, _row(shapes, SHAPE_ROWS), shape_offsets


def context_sums(column: pa.Array) -> np.ndarray:
    """Sums of the index vectors two words to either side, by word row."""
    words, offsets, _, _ = _tokens(column)
    rows = _row(words, ROWS)
    sums = np.zeros((ROWS, DIM), np.float32)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for at in range(0, len(rows), 200_000):
        around = np.zeros((min(200_000, len(rows) - at), DIM), np.float32)
        here = np.arange(at, at + len(around))
        for step in (-2, -1, 1, 2):
            near = here + step
            ok = (near >= 0) & (near < len(rows))
            ok[ok] &= text[near[ok]] == text[here[ok]]
            around[ok] += WORD_INDEX[rows[near[ok]]]
        order = np.argsort(rows[here], kind="stable")
        sorted_rows = rows[here][order]
        first = np.flatnonzero(np.concatenate(([True], sorted_rows[1:] != sorted_rows[:-1])))
        sums[sorted_rows[first]] += np.add.reduceat(around[order], first, axis=0)
    return sums


def _means(vectors: np.ndarray, rows: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean vector of each text's rows, zero for a text without any."""
    n = len(offsets) - 1
    out = np.zeros((n, vectors.shape[1]), np.float64)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + 200_000, "right")) - 1)
        lo, hi = offsets[at], offsets[to]
        filled = np.flatnonzero(offsets[at + 1 : to + 1] > offsets[at:to])
        if len(filled):
            sums = np.add.reduceat(vectors[rows[lo:hi]], offsets[at:to][filled] - lo, axis=0)
            out[at + filled] = sums / (offsets[at + 1 : to + 1] - offsets[at:to])[filled][:, None]
        at = to
    return out


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """One row of features per text."""
    words, offsets, shapes, shape_offsets = _tokens(column)
    n = len(offsets) - 1
    extra = np.zeros((n, EXTRAS))
    text = np.repeat(np.arange(n), np.diff(offsets))
    count = np.maximum(1, np.diff(offsets))
    same = np.zeros(len(words), bool)
    same[1:] = (words[1:] == words[:-1]) & (text[1:] == text[:-1])
    near = np.zeros(len(words), bool)
    for step in range(2, 9):
        near[step:] |= (words[step:] == words[:-step]) & (text[step:] == text[:-step])
    distinct = np.array([len(np.unique(words[offsets[i] : offsets[i + 1]])) for i in range(n)], np.float64)
    shape_count = np.diff(shape_offsets)
    extra[:, 0] = np.bincount(text[same], minlength=n) / count
    extra[:, 1] = np.bincount(text[near], minlength=n) / count
    extra[:, 2] = distinct / count
    extra[:, 3] = np.log1p(np.diff(offsets))
    extra[:, 4] = distinct / np.maximum(1, np.diff(offsets)) ** 0.75
    extra[:, 5] = np.log1p(shape_count) - np.log1p(np.diff(offsets))
    return np.concatenate(
        [_means(vectors, _row(words, ROWS), offsets), _means(SHAPE_INDEX, shapes, shape_offsets), extra], axis=1
    )


@dataclass
class Network:
    """Two layers over standardised features; probabilities are calibrated by a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh(np.clip((x - self.mean) / self.scale, -8, 8) @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, unseen: np.ndarray, hidden: int = 24, epochs: int = 150) -> Network:
    """Fit by Adam on the seen examples, and the temperature on the others."""
    random = np.random.default_rng(3)
    seen = ~unseen if unseen.any() and not unseen.all() else np.ones(len(y), bool)
    mean, scale = x[seen].mean(axis=0), x[seen].std(axis=0) + 1e-6
    z, t = np.clip((x[seen] - mean) / scale, -8, 8), y[seen].astype(float)
    params = [random.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden), random.normal(0, hidden**-0.5, hidden), np.zeros(1)]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = random.permutation(len(t))
        for at in range(0, len(order), 256):
            some = order[at : at + 256]
            h = np.tanh(z[some] @ params[0] + params[1])
            p = 1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -30, 30)))
            d = (p - t[some]) / len(some)
            back = np.outer(d, params[2]) * (1 - h * h)
            grads = [z[some].T @ back + 1e-4 * params[0], back.sum(axis=0), h.T @ d + 1e-4 * params[2], np.array([d.sum()])]
            step += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                params[i] -= 0.003 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    network = Network(mean, scale, params[0], params[1], params[2], float(params[3][0]), 1.0)
    held = unseen if unseen.any() else seen
    logits, t = network.logits(x[held]), y[held]
    loss = lambda v: np.logaddexp(0, np.where(t == 1, -logits, logits) / v).mean()
    network.temperature = min(np.geomspace(0.25, 8, 61), key=loss)
    return network


@dataclass
class Model:
    vectors: np.ndarray
    network: Network | None
    prior: float

    def scores(self, column: pa.Array) -> np.ndarray:
        if self.network is None:
            return np.full(len(column), self.prior)
        return self.network.probabilities(pooled(column, self.vectors))


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", max_examples: int = 20_000) -> Model:
    """Vectors and network from at most `max_examples` labelled documents.

    Without labels, or with one label only, every score is the share of label 1 (one half
    without labels).
    """
    sample = labelled_sample(documents, labels, label, max_examples).repartition(8, "doc_id")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((ROWS, DIM), np.float32)
        for batch in pieces(batches):
            total += context_sums(batch.column("text"))
        filled = np.flatnonzero(np.abs(total).sum(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(filled), pa.array([v.tobytes() for v in total[filled]], pa.binary())], names=["row", "sums"]
        )

    vectors = np.zeros((ROWS, DIM), np.float32)
    for row in sample.select("text").mapInArrow(sums, "row long, sums binary").toLocalIterator():
        vectors[row.row] += np.frombuffer(row.sums, np.float32)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = np.where(norms > 0, vectors / np.maximum(norms, 1e-9), WORD_INDEX / 2).astype(np.float32)
    shared = documents.sparkSession.sparkContext.broadcast(vectors)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            x = pooled(batch.column("text"), shared.value).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array([v.tobytes() for v in x], pa.binary())],
                names=["doc_id", "label", "x"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    found = sample.mapInArrow(features, f"doc_id {kind}, label int, x binary").withColumn(
        "unseen", F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(8)) == 0
    )
    rows = found.orderBy("doc_id").collect()
    if not rows:
        return Model(vectors, None, 0.5)
    y = np.array([int(r.label > 0) for r in rows])
    if y.min() == y.max():
        return Model(vectors, None, float(y[0]))
    x = np.stack([np.frombuffer(r.x, np.float32) for r in rows]).astype(np.float64)
    return Model(vectors, train(x, y, np.array([r.unseen for r in rows])), float(y.mean()))


def score(documents: DataFrame, model: Model, threshold: float) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `documents`.

    Null and empty texts are scored as texts without words. A null doc_id counts as the empty
    text for `held_out`. Repeated rows are scored alike; other columns are ignored.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = shared.value.scores(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], names=["doc_id", "score"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    scored = documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        (fold("doc_id") == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def accepted(documents: DataFrame, model: Model, threshold: float) -> DataFrame:
    """The rows of `documents` that score at least `threshold`, with all their columns."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            yield batch.filter(pa.array(shared.value.scores(batch.column("text")) >= threshold))

    return documents.mapInArrow(run, documents.schema)
