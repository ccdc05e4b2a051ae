"""Attention pooling: softmax-weighted means of vectors.

With v = tanh(xW + b) and s = v . u, a group pools to sum(exp(s) x) / sum(exp(s)). As |s| cannot
exceed the sum of |u|, that constant takes the place of the group maximum in the exponent, so one
aggregation with map-side combine does it and a group of any size is never gathered. It adds up one number per
dimension, which Spark keeps in fixed-width rows: one row per group in memory, and no input row is sorted or spilled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pressgauge.operators.joins import lookup
from pressgauge.sinks.files import stored

SAFE_BOUND = 300.0


@dataclass(frozen=True)
class Attention:
    """Pooling parameters: w has one row per input dimension, b and u one entry per unit."""

    w: tuple[tuple[float, ...], ...]
    b: tuple[float, ...]
    u: tuple[float, ...]

    @property
    def bound(self) -> float:
        """Largest possible absolute score."""
        return float(sum(abs(x) for x in self.u))

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Score of every row of ``x``."""
        return np.tanh(x @ np.asarray(self.w) + np.asarray(self.b)) @ np.asarray(self.u)


def score(vector: Column, attention: Attention) -> Column:
    """Attention score of an array column; the matrix product runs on whole Arrow batches."""

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(attention.scores(np.stack(batch.to_numpy())) if len(batch) else [], dtype="float64")

    return scores(vector)


def _scored(df: DataFrame, vector: str, attention: Attention) -> DataFrame:
    return df.where(F.col(vector).isNotNull()).withColumn("_s", score(F.col(vector).cast("array<double>"), attention))


def _powers(scored: DataFrame, group: Sequence[str], attention: Attention) -> DataFrame:
    """Rows with ``_e``, the exponential of their score, kept in range."""
    if attention.bound <= SAFE_BOUND:
        return scored.withColumn("_e", F.exp(F.col("_s") - F.lit(attention.bound)))
    tops = scored.groupBy(*group).agg(F.max("_s").alias("_top"))
    return scored.join(tops, list(group)).withColumn("_e", F.exp(F.col("_s") - F.col("_top"))).drop("_top")


def _means(weighted: DataFrame, group: Sequence[str], vector: str, attention: Attention, out: str) -> DataFrame:
    x = F.col(vector).cast("array<double>")
    sums = [F.sum(F.col("_e") * F.get(x, F.lit(k))).alias(f"_{k}") for k in range(len(attention.w))]
    totals = weighted.groupBy(*group).agg(F.sum("_e").alias("_total"), *sums)
    return totals.select(*group, F.array(*[F.col(f"_{k}") / F.col("_total") for k in range(len(sums))]).alias(out))


def pool(df: DataFrame, group: Sequence[str], vector: str, attention: Attention, out: str = "pooled") -> DataFrame:
    """One pooled vector per group."""
    return _means(_powers(_scored(df, vector, attention), group, attention), group, vector, attention, out)


def weights(df: DataFrame, group: Sequence[str], vector: str, attention: Attention, out: str = "alpha") -> DataFrame:
    """Rows with their softmax weight within the group.

    The group sums are joined back rather than windowed: Spark broadcasts them if they turn out
    small and splits a hot group if not, while a window would hold the group in one task. The scored rows are
    stored, as both sides of that join read them.
    """
    rows = stored(_powers(_scored(df, vector, attention), group, attention).drop("_s"), "scored")
    sums = rows.groupBy(*group).agg(F.sum("_e").alias("_total"))
    return rows.join(sums, list(group)).withColumn(out, F.col("_e") / F.col("_total")).drop("_e", "_total")


def join_directions(forward: Column, backward: Column) -> Column:
    """Forward and backward vector as one."""
    return F.concat(forward, backward)


def sentence_vectors(
    index: DataFrame, table: DataFrame, ids: Sequence[str], words: Attention, *, small: bool | None = None
) -> DataFrame:
    """(ids, sent_pos, vector): the words of each sentence pooled.

    Words are scored once in the vector table, not once per occurrence. The table is broadcast if
    measured small, else joined by shuffle; the rows are the same. An index without a vector is left out.
    """
    scored = _scored(table.select(F.col("idx").cast("int").alias("idx"), "vector"), "vector", words)
    found = lookup(index, scored, "idx", small=small)
    group = [*ids, "sent_pos"]
    return _means(_powers(found, group, words), group, "vector", words, "vector")


def document_vectors(
    index: DataFrame, table: DataFrame, ids: Sequence[str], words: Attention, sentences: Attention, out: str = "pooled",
    *, small: bool | None = None,
) -> DataFrame:
    """Two-level document vectors: words pool to sentences, sentences to documents."""
    return pool(sentence_vectors(index, table, ids, words, small=small), ids, "vector", sentences, out)
