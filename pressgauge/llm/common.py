"""Helpers shared by the operators: tables, skew-safe joins, word spans in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pressgauge.session import ship_package

SPACES = r"[\x20\x09-\x0D]+"
HOT_SHARES = 1024
SLICE_BYTES = 2 << 20
LONG_WORD = 64
_M = 0x9E3779B97F4A7C15 | 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables; the workers get the package as well."""
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(column: str | Column) -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def join_unique(facts: DataFrame, table: DataFrame, key: str, size: str, rows: int) -> DataFrame:
    """Left join to a table with one row per key whose column ``size`` counts the key's facts.

    Keys holding at least 1/1024 of the ``rows`` facts are at most 1024, so their table rows are
    broadcast; all others are shuffled. No key puts more than that share into one task. ``facts`` is
    read twice and should be a stored table.
    """
    is_hot = F.col(size) * HOT_SHARES >= F.lit(rows)
    hot = table.where(is_hot & (F.col(size) > 1))
    cold = table.where(~(is_hot & (F.col(size) > 1)))
    found = facts.join(F.broadcast(hot.select(key)), key, "left_semi").join(F.broadcast(hot), key, "left")
    rest = facts.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key, "left")
    return found.unionByName(rest)


def byte_slices(
    batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut Arrow batches into runs of rows of about ``limit`` text bytes (one row at least)."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
        sizes = np.cumsum(np.diff(np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4))) if len(column) else []
        start = 0
        while start < len(column):
            before = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, before + limit, side="right")))
            yield batch.slice(start, end - start), [t or b"" for t in column.slice(start, end - start).to_pylist()]
            start = end


def longs(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """A long column as numpy, 0 for null, and which are null."""
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.int64())
    return np.asarray(column.fill_null(0)), np.asarray(column.is_null())


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of several texts, laid out in one buffer with single spaces.

    ``starts`` and ``ends`` are byte offsets of the words, ``doc`` the index of each word's text.
    ``span(i, n)`` hashes the n words from each of ``i``: equal word sequences get equal hashes wherever they
    stand. Words are hashed one by one, those over ``LONG_WORD`` bytes by XXH64, as a polynomial modulo 2**64
    has known collisions between long strings; a few mixed word hashes are then joined by one.
    """

    def __init__(self, texts: list[bytes], lower: bool = False) -> None:
        self.texts = [b" ".join((t.lower() if lower else t).split()) for t in texts]
        self.counts = np.array([t.count(b" ") + 1 if t else 0 for t in self.texts], np.int64)
        self.doc = np.repeat(np.arange(len(texts)), self.counts)
        self.buffer = b" ".join(t for t in self.texts if t)
        raw = np.frombuffer(self.buffer, np.uint8)
        gaps = np.flatnonzero(raw == 32)
        some = len(raw) > 0
        self.starts = np.concatenate(([0], gaps + 1)) if some else np.zeros(0, np.int64)
        self.ends = np.concatenate((gaps, [len(raw)])) if some else np.zeros(0, np.int64)
        self._prefix: np.ndarray | None = None

    def _word_hashes(self) -> np.ndarray:
        raw = np.frombuffer(self.buffer, np.uint8)
        letters = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_M))
        powers, inverse = _powers(len(raw))
        prefix = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(letters[raw] * powers[:-1], out=prefix[1:])
        sizes = self.ends - self.starts
        out = mix((prefix[self.ends] - prefix[self.starts]) * inverse[self.starts] + sizes.astype(np.uint64))
        for i in np.flatnonzero(sizes > LONG_WORD).tolist():
            out[i] = xxhash.xxh64_intdigest(self.buffer[self.starts[i]: self.ends[i]])
        return out

    def _hashed(self) -> None:
        words = self._word_hashes()
        powers, self._inverse = _powers(len(words))
        self._prefix = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * powers[:-1], out=self._prefix[1:])

    def valid(self, n: int) -> np.ndarray:
        """Word indexes from which n words lie in one text."""
        last = len(self.doc) - n + 1
        return np.flatnonzero(self.doc[:last] == self.doc[n - 1:]) if last > 0 else np.zeros(0, np.int64)

    def span(self, first: np.ndarray, n: int) -> np.ndarray:
        """Hashes of the n words from each of ``first``."""
        if self._prefix is None:
            self._hashed()
        return mix((self._prefix[first + n] - self._prefix[first]) * self._inverse[first] + np.uint64(n))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier from 0 to n modulo 2**64, and of its inverse."""
    out = []
    for base in (_M, pow(_M, -1, 1 << 64)):
        powers = np.full(n + 1, np.uint64(base))
        powers[0] = 1
        out.append(np.cumprod(powers, out=powers))
    return out[0], out[1]


def pair_key(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """One 64-bit key for (hash, index of the text)."""
    return mix(h + (doc.astype(np.uint64) + np.uint64(1)) * np.uint64(_M))
