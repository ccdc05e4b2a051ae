"""Integer vectors, and the grid of cells in which a set of queries meets all rows.

A cell holds one shard of the rows and one part of the queries, both bounded in bytes, so that a task
needs the memory of one cell however long the tables are. Shards and parts are dealt by hash of the id.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pressgauge.sinks.files import stored

SCALE = 256
SIDE_BYTES = 16 << 20
LOWEST = -(1 << 62)


def usable(df: DataFrame, id_col: str, vector_col: str, *carried: Column) -> DataFrame:
    """(vec_id, v, carried columns): one row per id with a vector of finite components.

    Null ids, null vectors and vectors with a null or non-finite component are left out; of several rows
    with one id the least vector stays.
    """
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"), *carried)
    names = [c for c in rows.columns if c != "vec_id"]
    good = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite)
    return good.groupBy("vec_id").agg(F.min(F.struct(*names)).alias("row")).select("vec_id", "row.*")


class Grid:
    """How many shards and parts there are, from the counted rows and the widest vector."""

    def __init__(self, rows: DataFrame, queries: DataFrame) -> None:
        found = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width")).first()
        self.width = max(found.width or 0, 1)
        most = max(1, SIDE_BYTES // (8 * self.width))
        cores = rows.sparkSession.sparkContext.defaultParallelism
        self.shards = max(1, -(-found.n // most), min(2 * cores, found.n // 1024))
        self.parts = max(1, -(-queries.count() // most))

    def shard(self, id_col: str = "vec_id") -> Column:
        return F.pmod(F.xxhash64(id_col), F.lit(self.shards)).cast("int")

    def part(self, id_col: str = "vec_id") -> Column:
        return F.pmod(F.xxhash64(id_col, F.lit(1)), F.lit(self.parts)).cast("int")

    def cells(
        self, rows: DataFrame, queries: DataFrame, search: Callable[[pa.Table, pa.Table], pa.Table], schema: str,
        chosen: Column | None = None,
    ) -> DataFrame:
        """``search`` over every cell, or over those for which ``chosen`` (of shard and part) holds."""
        def every(count: int) -> Column:
            return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

        left = rows.withColumn("shard", self.shard()).withColumn("part", every(self.parts))
        right = queries.withColumn("part", self.part()).withColumn("shard", every(self.shards))
        if chosen is not None:
            left, right = left.where(chosen), right.where(chosen)
        # Both sides may stem from one table: new names for the columns keep them apart.
        left, right = left.toDF(*left.columns), right.toDF(*right.columns)
        return left.groupBy("shard", "part").cogroup(right.groupBy("shard", "part")).applyInArrow(search, schema)


def ids(table: pa.Table, name: str = "vec_id") -> np.ndarray:
    """A long column as numpy."""
    return np.asarray(table.column(name).combine_chunks().cast(pa.int64()))


def matrix(table: pa.Table, width: int) -> np.ndarray:
    """The vectors' components times 256, rounded down; shorter vectors are filled up with zeros."""
    column = table.column("v").combine_chunks()
    sizes = np.asarray(column.value_lengths())
    values = np.floor(np.asarray(column.flatten()).astype(np.float64) * SCALE)
    if len(sizes) and (sizes == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as numbers whose inner products are exact: doubles below 2**53, else longs.

    Products that could pass 62 bits are an error, like any overflow in ANSI arithmetic.
    """
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 1 << 53:
        return a, b
    if most >= 1 << 62 or max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) >= 1 << 62:
        raise OverflowError("integer inner products of these vectors can pass 62 bits")
    return a.astype(np.int64), b.astype(np.int64)


def prepared(df: DataFrame) -> DataFrame:
    """The rows written once, as every round reads them."""
    return stored(df, "vectors")
