"""Quality scores: random-indexing word vectors pooled per document, then a two-layer network.

Every word stands for two terms, the word itself and its shape (runs of letters and digits as one
sign; a word that repeats its predecessor has a shape of its own). Terms hash into BUCKETS; each bucket
has a sparse random index vector, and its word vector is that plus the direction of the summed index
vectors of its neighbours over the whole corpus. A document is the mean of its words' vectors. The
network is fitted with numpy on at most TRAIN_ROWS labelled rows; a temperature that minimises the
loss on rows kept apart calibrates its probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import id_remainder, named, text_of
from tidemart.llm.text import Texts, mix, number_hash, same_as_before, shapes, slices, words

BUCKETS = 4096          # for words, and as many for shapes
DIM = 32
NONZERO = 4             # of an index vector
REACH = 2               # neighbours on either side
TRAIN_ROWS = 6000       # labelled rows fitted at most, those with the smallest hashes of their ids
HIDDEN = 32
THRESHOLD = 0.3
FOLDS = 5


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero components of each bucket's index vector."""
    seed = number_hash(np.arange(2 * BUCKETS * NONZERO)).reshape(2 * BUCKETS, NONZERO)
    return (seed % np.uint64(DIM)).astype(np.int64), np.where(seed >> np.uint64(63), 1.0, -1.0)


def _terms(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, word bucket and shape bucket of each word."""
    w = words(texts)
    shape = shapes(texts, w)
    shape[same_as_before(w)] = number_hash(12345)
    b = np.uint64(BUCKETS)
    return w.row, (w.hash % b).astype(np.int64), (mix(shape) % b).astype(np.int64) + BUCKETS


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The vectors of all buckets. Neighbour sums are whole numbers, so their order of addition is free."""
    columns = [f"v{i}" for i in range(DIM)]

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sign = index_vectors()
        total = np.zeros(2 * BUCKETS * DIM)
        for batch in batches:
            for _, _, texts in slices(batch.column(0)):
                row, *both = _terms(texts)
                for term in both:
                    for step in range(1, REACH + 1):
                        near = row[step:] == row[:-step]
                        a, b = term[:-step][near], term[step:][near]
                        for x, y in ((a, b), (b, a)):
                            for j in range(NONZERO):
                                total += np.bincount(x * DIM + place[y, j], sign[y, j], minlength=len(total))
        sums = total.reshape(-1, DIM)
        used = np.flatnonzero(np.abs(sums).any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32))] + [pa.array(c.astype(np.int64)) for c in sums[used].T],
                                         ["bucket", *columns])

    parts = docs.select(text_of(named(text_col)).alias("text")).mapInArrow(contexts, "bucket int, " + ", ".join(f"{c} long" for c in columns))
    found = parts.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in columns]).toPandas()
    near = np.zeros((2 * BUCKETS, DIM))
    near[found["bucket"].to_numpy(int)] = found[columns].to_numpy(float)
    place, sign = index_vectors()
    own = np.zeros_like(near)
    np.add.at(own, (np.arange(2 * BUCKETS)[:, None], place), sign)
    length = np.linalg.norm(near, axis=1, keepdims=True)
    return (own / NONZERO**0.5 + near / np.maximum(length, 1e-9)).astype(np.float32)


def pooled(texts: Texts, vectors: np.ndarray) -> np.ndarray:
    """Mean word vector and mean shape vector of each row; zeros without words."""
    row, word, shape = _terms(texts)
    n = len(texts)
    out = np.zeros((n, 2 * DIM), np.float32)
    for first in range(0, n, 64):   # counts of 64 rows at once are 2 MB
        some = slice(*np.searchsorted(row, [first, min(first + 64, n)]))
        rows = min(64, n - first)
        for k, term in enumerate((word, shape - BUCKETS)):
            counts = np.bincount((row[some] - first) * BUCKETS + term[some], minlength=rows * BUCKETS)
            counts = counts.reshape(rows, BUCKETS).astype(np.float32)
            out[first: first + rows, k * DIM: (k + 1) * DIM] = \
                counts @ vectors[k * BUCKETS: (k + 1) * BUCKETS] / np.maximum(counts.sum(1, keepdims=True), 1)
    return out


class Network:
    """Two layers over standardised inputs; `fit` is deterministic."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 7, steps: int = 600) -> None:
        rng = np.random.default_rng(seed)
        self.prior = float(y.mean()) if len(y) else 0.5
        self.constant = len(np.unique(y)) < 2
        self.temperature = 1.0
        if self.constant:
            return
        apart = rng.permutation(len(y)) % 5 == 0
        if len(np.unique(y[apart])) < 2 or len(np.unique(y[~apart])) < 2:
            apart[:] = False
        tx, ty = x[~apart], y[~apart]
        self.mean, self.scale = tx.mean(0), tx.std(0) + 1e-6
        self.p = [rng.normal(0, tx.shape[1] ** -0.5, (tx.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        tx = (tx - self.mean) / self.scale
        m, v = [np.zeros_like(a) for a in self.p], [np.zeros_like(a) for a in self.p]
        for t in range(1, steps + 1):
            w1, b1, w2, b2 = self.p
            h = np.tanh(tx @ w1 + b1)
            out = _sigmoid(h @ w2 + b2) - ty
            back = np.outer(out, w2) * (1 - h**2)
            grads = [tx.T @ back / len(ty) + 1e-4 * w1, back.mean(0), h.T @ out / len(ty) + 1e-4 * w2, np.array([out.mean()])]
            for i, g in enumerate(grads):
                m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
                self.p[i] = self.p[i] - 0.01 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
        if apart.any():
            logits, labels = self._logits(x[apart]), y[apart]
            self.temperature = min(np.geomspace(0.25, 8, 61), key=lambda t: _loss(logits / t, labels))

    def _logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.p
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.prior) if self.constant else _sigmoid(self._logits(x) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))


class Model:
    def __init__(self, vectors: np.ndarray, network: Network) -> None:
        self.vectors, self.network = vectors, network

    def scores(self, column: pa.Array) -> np.ndarray:
        return np.concatenate([np.zeros(0)] + [self.network.score(pooled(t, self.vectors)) for _, _, t in slices(column)])

    def column(self, text: Column) -> Column:
        """The score of a text, as a column."""
        model = self

        @F.arrow_udf("double")
        def score(batch: pa.Array) -> pa.Array:
            return pa.array(model.scores(batch), pa.float64())

        return score(text_of(text))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        rows: int = TRAIN_ROWS) -> Model:
    """Word vectors from all documents; the network from labelled ones whose crc32(id) mod 5 is not 0.

    Labels other than 0 and 1, or without an id, are left out; the smallest of several for one id
    counts. Without labels, or with one class only, the score is the share of label 1 (0.5 without).
    """
    vectors = word_vectors(docs, text_col)
    known = (labels.where(named(label_col).isin(0, 1) & named(id_col).isNotNull() & (id_remainder(named(id_col), FOLDS) != 0))
             .groupBy(named(id_col).alias("_id")).agg(F.min(named(label_col)).cast("double").alias("label"))
             .orderBy(F.xxhash64("_id"), "_id").limit(rows))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in slices(batch.column(1)):
                x = pooled(texts, vectors).astype(np.float64)
                yield pa.RecordBatch.from_arrays([batch.column(0)[first:last], pa.array(list(x), pa.list_(pa.float64())),
                                                  batch.column(2)[first:last]], ["id", "x", "label"])

    chosen = (docs.select(named(id_col).alias("id"), text_of(named(text_col)).alias("text"))
              .join(F.broadcast(known), F.col("id") == F.col("_id")).select("id", "text", "label"))
    kind = docs.select(named(id_col)).schema[0].dataType.simpleString()
    found: pd.DataFrame = chosen.mapInArrow(features, f"id {kind}, x array<double>, label double").toPandas().sort_values("id", kind="stable")
    x = np.array(found["x"].tolist(), float).reshape(-1, 2 * DIM)
    return Model(vectors, Network(x, found["label"].to_numpy(float)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; empty and null texts have a score too."""
    return (docs.select(named(id_col).alias("doc_id"), model.column(named(text_col)).alias("score"))
            .select("doc_id", (id_remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows the classifier does not reject, with the columns of `docs`."""
    packed = docs.select(F.struct(*[named(c) for c in docs.columns]).alias("_row"), model.column(named(text_col)).alias("_score"))
    return packed.where(F.col("_score") >= THRESHOLD).select("_row.*")
