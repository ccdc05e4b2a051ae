"""Packing documents into sequences by cutting-stock column generation.

Documents are cut only where they exceed a sequence: full pieces and one rest. Piece lengths are
rounded up to classes of ``UNIT`` tokens, and their histogram is all that reaches the driver (at most
capacity / UNIT numbers). A linear program over patterns of classes is solved by column generation: a
knapsack dynamic program over the dual prices finds the next pattern. The solution is rounded down;
what is left over is bounded by one pattern per class and packed best fit first. Each class's pieces are
ranked over all tasks (rank inside a hashed bucket plus the buckets before it), and rank decides the
sequence, so a length that a third of all documents share is dealt over all tasks as well.

Edge cases: a null or empty text is one piece that holds only the end id; repeated rows are packed one
by one; equal lengths are ranked by id, start and checksum; an empty table gives an empty result; only the
id and text columns are read.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from pressgauge.llm.common import byte_slices, longs
from pressgauge.sinks.files import stored

CAPACITY = 4096
UNIT = 8
END_ID = 2
CACHE_WORDS = 600_000


class _Known(dict):
    """Ids by word; a word asked for the first time is learnt."""

    def __init__(self, learn) -> None:
        self.learn = learn

    def __missing__(self, word: bytes) -> bytes:
        found = self[word] = self.learn(word)
        return found


class WordEncoder:
    """Ids of texts by a tokenizer that drops white space, with a bounded cache of words.

    A word is what lies between ASCII white space. The tokenizer merges neither across white space nor
    across the border of a letter or digit and a mark, and it ignores case, so the ids of a text are
    those of its words, and those of a word are those of its lower-cased stem and its last marks.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known = _Known(self._learn)

        self.model = self.tokenizer.model
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in the vocabulary
        hidden = [b for b in range(256) if b not in shown]
        self.letters = {b: chr(256 + i) for i, b in enumerate(hidden)}

    def _ids(self, word: bytes) -> bytes:
        found = self.known.get(word)
        if found is None:
            text = word.decode("utf-8", "replace")
            low = text.lower()
            if text.isalpha() and low.isalpha() and max(text) < "\u0180":  # composed letters: nothing to normalise or split
                units = low.encode().decode("latin-1").translate(self.letters)
                ids = [t.id for t in self.model.tokenize(units)]
            else:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            self.known[word] = found = array("I", ids).tobytes()
        return found

    def _learn(self, word: bytes) -> bytes:
        stem = word.rstrip(b".,")
        if len(stem) == len(word) or not stem[-1:].isalnum():
            stem = word
        marks = word[len(stem):]
        if stem.isascii() and b"<" not in stem:  # a special token is known by its case
            stem = stem.lower()
        return self._ids(stem) + (self._ids(marks) if marks else b"")

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        return [b"".join(map(self.known.__getitem__, t.split())) for t in texts]


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """The worker's encoder; its cache serves all tasks of the worker."""
    return WordEncoder(path)


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: every document cut at multiples of ``capacity``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        for part, texts in byte_slices(batches, "text"):
            out: list[tuple] = []
            which = []
            for i, ids in enumerate(encoder.encode(texts)):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    cut = ids[4 * start: 4 * (start + capacity)]
                    out.append((start, len(cut) // 4, zlib.crc32(cut), total))
                    which.append(i)
            table = np.array(out, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(which, pa.int64())), *(pa.array(table[:, i]) for i in range(4))],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def price(duals: np.ndarray) -> tuple[float, np.ndarray]:
    """The most valuable pattern: unbounded knapsack over sizes 1..n with the given values, capacity n."""
    n = len(duals)
    best, pick = np.zeros(n + 1), np.zeros(n + 1, np.int64)
    for room in range(1, n + 1):
        value = best[room - 1:: -1][:room] + duals[:room]
        at = int(np.argmax(value))
        if value[at] > best[room - 1] + 1e-12:
            best[room], pick[room] = value[at], at + 1
        else:
            best[room] = best[room - 1]
    pattern, room = np.zeros(n, np.int64), n
    while room > 0:
        if pick[room]:
            pattern[pick[room] - 1] += 1
            room -= pick[room]
        else:
            room -= 1
    return float(best[n]), pattern


def solve(demand: np.ndarray, rounds: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """(patterns, times): the linear program's basis for the demand of sizes 1..n in bins of n.

    Revised simplex with generated columns. It stops when no pattern improves the bins by half a bin,
    which rounding would lose anyway.
    """
    n = len(demand)
    used = np.flatnonzero(demand)
    m = len(used)
    basis = np.diag(n // (used + 1)).astype(float)
    inverse = np.diag(1 / np.diag(basis)) if m else np.zeros((0, 0))
    x = inverse @ demand[used].astype(float)
    duals = np.zeros(n)
    for _ in range(rounds if m else 0):
        y = inverse.sum(0)
        duals[used] = np.maximum(y, 0)
        value, pattern = price(duals)
        if value <= 1 + 1e-9 or x.sum() * (1 - 1 / value) < 0.5:
            break
        column = pattern[used].astype(float)
        step = inverse @ column
        able = step > 1e-9
        ratio = np.where(able, x / np.where(able, step, 1), np.inf)
        leave = int(np.argmin(ratio))
        gain = ratio[leave]
        x -= gain * step
        x[leave] = gain
        np.maximum(x, 0, out=x)
        row = inverse[leave] / step[leave]
        inverse -= np.outer(step, row)
        inverse[leave] = row
        basis[:, leave] = column
    patterns = np.zeros((m, n), np.int64)
    patterns[:, used] = basis.T.astype(np.int64)
    return patterns, x


def best_fit(counts: np.ndarray) -> list[np.ndarray]:
    """Bins for the items left over, largest first, each into the fullest bin that takes it."""
    n = len(counts)
    rooms: dict[int, list[np.ndarray]] = {}
    open_rooms = 0
    bins = []
    for size in range(n, 0, -1):
        for _ in range(int(counts[size - 1])):
            fits = open_rooms >> size
            if fits:
                room = size + (fits & -fits).bit_length() - 1
                target = rooms[room].pop()
                if not rooms[room]:
                    open_rooms &= ~(1 << room)
            else:
                room, target = n, np.zeros(n, np.int64)
                bins.append(target)
            target[size - 1] += 1
            if room > size:
                rooms.setdefault(room - size, []).append(target)
                open_rooms |= 1 << (room - size)
    return bins


def plan(demand: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(patterns, times) in whole numbers that hold exactly the demand."""
    patterns, x = solve(demand)
    times = np.floor(x + 1e-9).astype(np.int64)
    while (over := (patterns * times[:, None]).sum(0) > demand).any():
        times[np.flatnonzero((patterns[:, over].sum(1) > 0) & (times > 0))] -= 1
    rest = best_fit(demand - (patterns * times[:, None]).sum(0))
    some = times > 0
    return np.array([*patterns[some], *rest], np.int64).reshape(-1, len(demand)), np.concatenate((times[some], np.ones(len(rest), np.int64)))


def slots(patterns: np.ndarray, times: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each class: first rank, pieces a sequence, and first sequence of each pattern that uses it."""
    base = np.concatenate(([0], np.cumsum(times)[:-1])) if len(times) else times
    out = {}
    for c in np.flatnonzero(patterns.sum(0)):
        some = np.flatnonzero(patterns[:, c])
        each = patterns[some, c]
        out[int(c) + 1] = (np.concatenate(([0], np.cumsum(each * times[some])[:-1])), each, base[some])
    return out


def pack(cut: DataFrame, capacity: int = CAPACITY, unit: int = UNIT) -> DataFrame:
    """Add sequence_id and offset to pieces; ``cut`` must be a stored table."""
    size = F.ceil(F.col("length") / unit).cast("int")
    sized = cut.withColumn("size", size)
    demand = np.zeros(capacity // unit, np.int64)
    for row in sized.groupBy("size").count().collect():
        demand[row["size"] - 1] = row["count"]
    ranges = slots(*plan(demand))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, rank = longs(batch, "size")[0], longs(batch, "rank")[0]
            sequence = np.zeros(len(rank), np.int64)
            for c in np.unique(sizes):
                first, each, base = ranges[int(c)]
                mine = np.flatnonzero(sizes == c)
                at = np.searchsorted(first, rank[mine], side="right") - 1
                sequence[mine] = base[at] + (rank[mine] - first[at]) // each[at]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence)], [*names, "sequence_id"])

    names = cut.columns
    buckets = int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc_id", "start", "ids_crc32", "length"]
    dealt = sized.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    inside = dealt.withColumn("place", F.row_number().over(Window.partitionBy("size", "bucket").orderBy(*order)) - 1)
    before = Window.partitionBy("size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("size", "bucket").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("skip", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    ranked = inside.join(counts, ["size", "bucket"]).withColumn("rank", F.col("skip") + F.col("place"))
    schema = cut.schema.simpleString()[len("struct<"):-1] + ", sequence_id: long"
    placed = ranked.select(*names, F.col("size").cast("long").alias("size"), "rank").mapInArrow(assign, schema)
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), *order).rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)))


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return pack(stored(pieces(docs, tokenizer, id_col, text_col, capacity, end_id), "pieces"), capacity)
