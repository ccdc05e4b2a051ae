"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the hashed n-grams of 3 to 5 code points of the lower-cased text, white space collapsed,
each counted once per document. The classifier is fitted on at most ``max_rows`` labelled rows, chosen
by the hash of their id, so that set is broadcast and no text is shuffled. Document frequencies per
class give the log-count ratio of each feature; those whose frequencies differ most between the
classes are kept, scaled by their ratio, and weighted by logistic regression. Every whole text is then
scored in the task that reads it.

Edge cases: null and empty texts have no features and get the score of the intercept; a document
labelled twice is toxic if either label says so; null labels are ignored; without rows of both classes
every score is the smoothed share of toxic rows (0.5 without any labels); repeated rows are scored
alike; an empty table gives an empty result; other columns are neither read nor touched.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pressgauge.llm.common import byte_slices, free_name, longs

ORDERS = (3, 4, 5)
BITS = 20
RANGES = 64
MAX_ROWS = 40_000
MAX_FEATURES = 4096
BLOCK = 1 << 18
_STEP = 0x9E3779B97F4A7C15


class Model(NamedTuple):
    """Feature buckets, their weights (the ratio included) and the intercept."""

    buckets: np.ndarray
    weights: np.ndarray
    intercept: float


def grams(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text index, feature bucket) of all n-grams, order by order."""
    tidy = [(" " + " ".join(t.decode("utf-8", "replace").lower().split()) + " ") for t in texts]
    sizes = np.array([len(t) for t in tidy], np.int64)
    points = np.frombuffer("".join(tidy).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    doc = np.repeat(np.arange(len(tidy), dtype=np.int32), sizes)
    h = np.zeros(len(points), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        n = len(points) - order + 1
        if n <= 0:
            return
        h = (h[:n] + points[order - 1:]) * np.uint64(_STEP)
        h ^= h >> np.uint64(29)
        if order in ORDERS:
            inside = doc[:n] == doc[order - 1:]
            yield doc[:n][inside], (h[inside] * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - BITS)).astype(np.int32)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document frequencies of each feature by class, and the rows of each class, as packed ranges."""
    seen = np.zeros((2, 1 << BITS), np.int32)
    rows = np.zeros(2, np.int64)
    for part, texts in byte_slices(batches, "text"):
        label = longs(part, "label")[0]
        rows += np.bincount(label, minlength=2)
        found = [np.unique(doc.astype(np.int64) << BITS | bucket) for doc, bucket in grams(texts)]
        # Grams of different orders may share a bucket.
        once = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        positive = label[once >> BITS] == 1
        once &= (1 << BITS) - 1
        seen[0] += np.bincount(once[~positive], minlength=1 << BITS).astype(np.int32)
        seen[1] += np.bincount(once[positive], minlength=1 << BITS).astype(np.int32)
    if rows.sum():
        packed = [zlib.compress(np.ascontiguousarray(x).tobytes(), 1) for x in np.split(seen, RANGES, axis=1)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(RANGES), pa.int32()), pa.array(packed, pa.binary()), pa.array([rows.tolist()] * RANGES, pa.list_(pa.int64()))],
            ["range", "counts", "rows"],
        )


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up the packed counts of each range."""
    total: dict[int, np.ndarray] = {}
    rows: dict[int, np.ndarray] = {}
    for batch in batches:
        for r, counts, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
            x = np.frombuffer(zlib.decompress(counts), np.int32).reshape(2, -1)
            total[r] = total.get(r, 0) + x.astype(np.int64)
            rows[r] = rows.get(r, 0) + np.array(n)
    if total:
        packed = [zlib.compress(x.tobytes(), 1) for x in total.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array(packed, pa.binary()), pa.array([x.tolist() for x in rows.values()], pa.list_(pa.int64()))],
            ["range", "counts", "rows"],
        )


_PACKED = "range int, counts binary, rows array<long>"


def _present(table: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The different (text index, feature) pairs of the features that ``table`` numbers from 1."""
    docs, features = [], []
    for doc, bucket in grams(texts):
        feature = table[bucket]
        some = np.flatnonzero(feature)
        docs.append(doc[some])
        features.append(feature[some])
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    once = np.unique(np.concatenate(docs).astype(np.int64) << 32 | np.concatenate(features))
    return once >> 32, (once & 0xFFFFFFFF) - 1


def _table(buckets: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << BITS, np.int32)
    table[buckets] = np.arange(1, len(buckets) + 1)
    return table


def sample(labels: DataFrame, train: Column, max_rows: int) -> DataFrame:
    """(doc_id, label) of at most ``max_rows`` labelled rows, chosen by hash of the id."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & train)
    one = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)


def fit(docs: DataFrame, labels: DataFrame, train: Column, max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES) -> Model:
    """Fit on at most ``max_rows`` of the labelled rows for which ``train`` (over doc_id) holds.

    At most ``max_features`` features, those that part the classes best, get a weight. Their numbers have 16
    bits, so there can be 65,536. Rows of ``docs`` that repeat a labelled id count once each.
    """
    chosen = sample(labels, train, max_rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", F.col("label").cast("long").alias("label"))
    parts = texts.mapInArrow(_counted, _PACKED).repartition(RANGES, "range").mapInArrow(_summed, _PACKED).collect()
    if not parts:
        return Model(np.zeros(0, np.int64), np.zeros(0), 0.0)
    negatives, positives = parts[0].rows
    base = float(np.log((positives + 1) / (negatives + 1)))
    if not negatives or not positives:
        return Model(np.zeros(0, np.int64), np.zeros(0), base)
    count = np.concatenate([np.frombuffer(zlib.decompress(p.counts), np.int64).reshape(2, -1) for p in sorted(parts, key=lambda p: p.range)], axis=1)
    p, q = (count[1] + 1) / (positives + 2), (count[0] + 1) / (negatives + 2)
    both = count.sum(0) / (positives + negatives)
    spread = np.sqrt(np.maximum(both * (1 - both), 1e-9) * (1 / positives + 1 / negatives))
    score = np.where(count.sum(0) >= 3, np.abs(count[1] / positives - count[0] / negatives) / spread, 0)
    buckets = np.sort(np.argsort(-score, kind="stable")[:max_features])
    buckets = buckets[score[buckets] > 4]
    ratio = np.log(p / q)[buckets]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(buckets)
        for part, some in byte_slices(batches, "text"):
            doc, feature = _present(table, some)
            cuts = np.searchsorted(doc, np.arange(len(some) + 1))
            packed = [feature[a:b].astype(np.uint16).tobytes() for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("label")), pa.array(packed, pa.binary())], ["label", "features"])

    counted = texts.mapInArrow(rows, "label long, features binary").groupBy("label", "features").agg(F.count(F.lit(1)).alias("n"))
    seen = counted.toArrow()
    seen = seen.take(pc.sort_indices(seen, [("label", "ascending"), ("features", "ascending")]))
    weights, intercept = regression(Rows.of(seen), ratio, base)
    return Model(buckets, weights, intercept)


class Rows(NamedTuple):
    """Labelled rows packed: the features of all rows one after another, where each row begins, labels, and how often it occurs."""

    features: np.ndarray
    starts: np.ndarray
    labels: np.ndarray
    counts: np.ndarray

    @staticmethod
    def of(seen: pa.Table) -> Rows:
        """From (label, features, n)."""
        packed = seen.column("features").cast(pa.large_binary()).combine_chunks()
        sizes = np.asarray(pc.binary_length(packed)).astype(np.int64) // 2
        return Rows(
            np.frombuffer(b"".join(x.as_buffer() for x in packed), np.uint16), np.concatenate(([0], np.cumsum(sizes))),
            np.asarray(seen.column("label").combine_chunks()), np.asarray(seen.column("n").combine_chunks()),
        )


def regression(rows: Rows, ratio: np.ndarray, base: float, penalty: float = 1.0, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on features scaled by ``ratio``; accelerated gradient steps.

    Rows are taken in blocks, so that beside the packed features only a block's numbers are held.
    """
    starts, y, n = rows.starts, rows.labels, rows.counts
    total, count = n.sum(), len(y)
    cuts = np.searchsorted(starts, np.arange(0, starts[-1], BLOCK)) if starts[-1] else np.zeros(0, np.int64)
    blocks = [(int(a), int(b)) for a, b in zip(cuts, [*cuts[1:], count]) if a < b] or [(0, count)]

    def block(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(row inside the block, feature) of all entries of rows a to b."""
        return np.repeat(np.arange(b - a), np.diff(starts[a: b + 1])), rows.features[starts[a]: starts[b]]

    length = np.ones(count)
    for a, b in blocks:
        row, feature = block(a, b)
        length[a:b] += np.bincount(row, (ratio * ratio)[feature], b - a)
    step = 4 / (np.average(length, weights=n) * 4 + penalty / total)
    w, b0 = np.zeros(len(ratio)), base
    vw, vb, momentum = w.copy(), b0, 1.0
    for _ in range(rounds):
        scaled, slope, bias = vw * ratio, np.zeros(len(ratio)), 0.0
        for a, b in blocks:
            row, feature = block(a, b)
            z = np.bincount(row, scaled[feature], b - a) + vb
            error = n[a:b] * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y[a:b]) / total
            slope += np.bincount(feature, error[row], len(ratio))
            bias += error.sum()
        new_w = vw - step * (slope * ratio + penalty / total * vw)
        new_b = vb - step * bias
        later = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        vw, vb = new_w + (momentum - 1) / later * (new_w - w), new_b + (momentum - 1) / later * (new_b - b0)
        w, b0, momentum = new_w, new_b, later
    return w * ratio, float(b0)


def scores(docs: DataFrame, model: Model, text_col: str = "text", name: str = "toxicity") -> DataFrame:
    """All rows and columns of ``docs`` plus ``name``, the probability of the toxic label.

    A column of that name in the input is replaced.
    """
    buckets, weights, intercept = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(buckets)
        for part, texts in byte_slices(batches, text_col):
            doc, feature = _present(table, texts)
            z = np.bincount(doc, weights[feature], len(texts)) + intercept
            p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p)], [*part.schema.names, name])

    frame = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != name.lower()])
    return frame.mapInArrow(run, T.StructType([*frame.schema.fields, T.StructField(name, T.DoubleType())]))


def fold(id_col: str = "doc_id") -> Column:
    """CRC-32 of the id as text, modulo 3 (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


def kept_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, max_rows: int = MAX_ROWS) -> DataFrame:
    """The documents scored below ``threshold``, all columns unchanged; learns from all labels of ``docs``."""
    name = free_name(docs, "toxicity")
    return scores(docs, fit(docs, labels, F.lit(True), max_rows), name=name).where(F.col(name) < threshold).drop(name)
