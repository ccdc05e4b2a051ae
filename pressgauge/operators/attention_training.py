"""Training of the attention pooling and its output layer over sentence vectors.

A document is an array of sentence vectors; its logit is ``pooled . o + c`` with ``pooled`` as in
:mod:`pressgauge.operators.pooling`. In each round every task adds up the gradient of its documents for
the current parameters, the sums are added in two levels, and the driver makes one Adam step. What comes to
the driver is one vector as long as the parameters. Documents are read as one matrix of sentence vectors per slice of
an Arrow batch, and the softmax over each document is done by runs of its rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from pressgauge.operators.pooling import Attention

#: Sentence vectors that a task holds as one matrix, unless one document has more.
SLICE_VECTORS = 1 << 15


@dataclass(frozen=True)
class Model:
    """Attention parameters with the output layer."""

    w: np.ndarray
    b: np.ndarray
    u: np.ndarray
    o: np.ndarray
    c: float

    @property
    def attention(self) -> Attention:
        """The pooling part, as the pooling operators take it."""
        return Attention(tuple(map(tuple, self.w.tolist())), tuple(self.b.tolist()), tuple(self.u.tolist()))

    def flat(self) -> np.ndarray:
        return np.concatenate((self.w.ravel(), self.b, self.u, self.o, [self.c]))

    @staticmethod
    def of(flat: np.ndarray, width: int, units: int) -> Model:
        w, b, u, o, c = np.split(flat, np.cumsum([width * units, units, units, width]))
        return Model(w.reshape(width, units), b, u, o, float(c[0]))

    def logit(self, x: np.ndarray) -> float:
        """The logit of one document's sentence vectors; of none, the bias."""
        return self.gradient(x, 0)[2]

    def gradient(self, x: np.ndarray, y: float) -> tuple[np.ndarray, float, float]:
        """Gradient of the cross-entropy, the loss and the logit of one document."""
        if not len(x):
            z, pooled = self.c, np.zeros_like(self.o)
        else:
            v = np.tanh(x @ self.w + self.b)
            s = v @ self.u
            a = np.exp(s - s.max())
            a /= a.sum()
            pooled = a @ x
            z = float(pooled @ self.o + self.c)
        p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        loss = float(np.logaddexp(0, z) - y * z)
        error = p - y
        parts = [np.zeros_like(self.w), np.zeros_like(self.b), np.zeros_like(self.u), error * pooled, np.array([error])]
        if len(x):
            # Through the softmax: each score moves the pooled vector by its distance from it.
            ds = error * a * (x @ self.o - pooled @ self.o)
            dv = ds[:, None] * self.u * (1 - v * v)
            parts[:3] = [x.T @ dv, dv.sum(axis=0), v.T @ ds]
        return np.concatenate([p.ravel() for p in parts]), loss, z


    def pooled(self, x: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Units, softmax weights, document of each sentence vector, and pooled vector of each document of ``sizes`` rows of ``x``."""
        owner = np.repeat(np.arange(len(sizes)), sizes)
        v = np.tanh(x @ self.w + self.b)
        s = v @ self.u
        out = np.zeros((len(sizes), len(self.o)))
        some = np.flatnonzero(sizes)
        if not len(some):
            return v, s, owner, out
        first = (np.cumsum(sizes) - sizes)[some]
        a = np.exp(s - np.repeat(np.maximum.reduceat(s, first), sizes[some]))
        a /= np.repeat(np.add.reduceat(a, first), sizes[some])
        out[some] = np.add.reduceat(a[:, None] * x, first)
        return v, a, owner, out

    def logits(self, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The logits of documents that hold ``sizes`` rows of ``x`` each."""
        return self.pooled(x, sizes)[3] @ self.o + self.c

    def gradients(self, x: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
        """Summed gradient and loss of documents, as :meth:`gradient` gives them one by one."""
        v, a, owner, pooled = self.pooled(x, sizes)
        z = pooled @ self.o + self.c
        error = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - y
        loss = float((np.logaddexp(0, z) - y * z).sum())
        ds = error[owner] * a * (x @ self.o - (pooled @ self.o)[owner])
        dv = ds[:, None] * self.u * (1 - v * v)
        parts = (x.T @ dv, dv.sum(axis=0), v.T @ ds, error @ pooled, [error.sum()])
        return np.concatenate([np.ravel(p) for p in parts]), loss


def initial(width: int, units: int, seed: int = 7) -> Model:
    """Small repeatable parameters."""
    rng = np.random.default_rng(seed)
    return Model(rng.normal(0, 0.1, (width, units)), rng.normal(0, 0.1, units), rng.normal(0, 0.1, units), rng.normal(0, 0.1, width), 0.0)


def _documents(batch: pa.RecordBatch, vectors: str, width: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Slices of the rows with the matrix of their sentence vectors and its rows per document; null lists are empty, null vectors left out."""
    column = batch.column(batch.schema.get_field_index(vectors))
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    start = 0
    while start < len(column):
        # At least one document, else as many as fit.
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + SLICE_VECTORS, "right")))
        own = lengths[start:stop]
        found = column.slice(start, stop - start).flatten()
        owner = np.repeat(np.arange(stop - start), own)[found.is_valid().to_numpy(zero_copy_only=False)]
        x = found.drop_null().flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, width)
        yield slice(start, stop), x, np.bincount(owner, minlength=stop - start)
        start = stop


def gradient(docs: DataFrame, model: Model, vectors: str = "vectors", label: str = "label") -> tuple[np.ndarray, float, int]:
    """Summed gradient, summed loss and count of all documents, added up in two levels."""
    size, width = len(model.flat()), len(model.o)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(size + 2), 0
        for batch in batches:
            labels = batch.column(batch.schema.get_field_index(label)).to_numpy(zero_copy_only=False).astype(np.float64)
            for part, x, sizes in _documents(batch, vectors, width):
                own, loss = model.gradients(x, sizes, labels[part])
                total[:size] += own
                total[size:] += loss, len(sizes)
                rows += len(sizes)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["sums"])

    parts = docs.select(vectors, label).mapInArrow(run, "sums array<double>")
    slots = F.floor(F.sqrt(F.lit(max(1, docs.sparkSession.sparkContext.defaultParallelism))))
    level = parts.groupBy(F.pmod(F.spark_partition_id(), slots).alias("slot")).agg(Summarizer.sum(array_to_vector("sums")).alias("sums"))
    # Grouped by a constant, as the sum of no vectors is an error.
    row = level.withColumn("all", F.lit(0)).groupBy("all").agg(vector_to_array(Summarizer.sum(F.col("sums"))).alias("sums")).first()
    if row is None:
        return np.zeros(size), 0.0, 0
    sums = np.array(row.sums)
    return sums[:size], float(sums[size]), int(sums[size + 1])


def train(
    docs: DataFrame, width: int, *, units: int = 4, rounds: int = 20, rate: float = 0.05, vectors: str = "vectors", label: str = "label",
    start: Model | None = None,
) -> tuple[Model, list[float]]:
    """The fitted model and the mean loss before each round; ``docs`` is read once per round and should be stored."""
    model = start or initial(width, units)
    units = len(model.b)
    flat, first, second, losses = model.flat(), 0.0, 0.0, []
    for step in range(1, rounds + 1):
        total, loss, n = gradient(docs, model, vectors, label)
        if not n:
            break
        losses.append(loss / n)
        mean = total / n
        first, second = 0.9 * first + 0.1 * mean, 0.999 * second + 0.001 * mean * mean
        flat = flat - rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
        model = Model.of(flat, width, units)
    return model, losses


def predict(docs: DataFrame, model: Model, keep: list[str], vectors: str = "vectors") -> DataFrame:
    """The kept columns and ``probability`` of label 1."""
    picked = docs.select(*keep, vectors)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields if f.name in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = np.concatenate([np.zeros(0), *(model.logits(x, sizes) for _, x, sizes in _documents(batch, vectors, len(model.o)))])
            kept = [batch.column(batch.schema.get_field_index(k)) for k in keep]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(1 / (1 + np.exp(-np.clip(z, -50, 50))))], [*keep, "probability"])

    return picked.mapInArrow(run, f"{fields}, probability double")


def sentence_arrays(sentences: DataFrame, ids: list[str], vector: str = "vector", order: Column | str = "sent_pos") -> DataFrame:
    """One row per document: ids and ``vectors``, its sentence vectors in order; a group is one document."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order) if isinstance(order, str) else order, F.col(vector).alias("v"))))
    return sentences.groupBy(*ids).agg(F.transform(rows, lambda x: x.v).alias("vectors"))
