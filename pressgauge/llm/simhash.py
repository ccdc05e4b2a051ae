"""SimHash near-duplicates by deletion variants of fingerprint segments.

For distance d the 64 bits are cut into d // 2 + 1 segments, so two linked fingerprints agree in one
of them up to one bit. Each distinct fingerprint is indexed under every segment with one bit blanked
(64 keys); two segments that differ in at most one bit share such a key. Keys are joined by equality,
and every pair that meets is verified on all bits. A key's members go through numpy in one task, which
passes on a spanning forest of the verified pairs instead of the pairs; keys with more than ``BLOCK``
members are dealt over tasks by pairs of blocks. Copies are one fingerprint, so they cost nothing.

Edge cases: null and blank texts get fingerprint zero, linked like any other; repeated rows share
their fingerprint; a null id is never a component's id unless there is no other; an empty table gives
an empty result; only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from pressgauge.llm.common import byte_slices, join_unique, longs, text_or_empty
from pressgauge.llm.components import components, forest
from pressgauge.sinks.files import stored

SEED = 42
BLOCK = 4096


def fingerprint(text: bytes, shingle: int) -> int:
    """The SimHash of a text: majority bits of the XXH64 of its word shingles."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_digest
    hashed = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist())])
    bits = np.zeros(64, np.int64)
    raw = np.frombuffer(hashed, np.uint8).reshape(-1, 8)
    for at in range(0, len(raw), 1 << 16):
        bits += np.unpackbits(raw[at: at + (1 << 16)], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(bits * 2 > len(raw)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(doc_id, fp): the fingerprint of each whole text as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in byte_slices(batches, "text"):
            marks = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(marks)], ["doc_id", "fp"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return picked.mapInArrow(run, "doc_id long, fp long")


def segments(distance: int) -> list[tuple[int, int]]:
    """(offset, width) of the segments: so many that one differs by at most one bit."""
    count = distance // 2 + 1
    cuts = [64 * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def variants(distance: int) -> F.Column:
    """All one-wildcard variants of the fingerprint's segments, as one array of keys."""
    keys = []
    for offset, width in segments(distance):
        part = F.shiftrightunsigned("fp", offset)
        for bit in range(width):
            mask = ((1 << width) - 1) ^ (1 << bit)
            blanked = part.bitwiseAND(F.lit(mask - (mask >> 63 << 64)))
            keys.append(F.struct(F.lit(offset + bit).alias("slot"), blanked.alias("value")))
    return F.array(*keys)


def _verified(key: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs within ``distance`` inside runs of equal keys."""
    a, b, held = [], [], 0
    at, lag = np.arange(len(key)), 1
    while len(at := at[at + lag < len(key)]) and len(at := at[key[at] == key[at + lag]]):
        x, y = fp[at], fp[at + lag]
        near = np.bitwise_count((x ^ y).view(np.uint64)) <= distance
        a.append(x[near])
        b.append(y[near])
        held += int(near.sum())
        if held > 1 << 20:
            node, root = forest(np.concatenate(a), np.concatenate(b))
            a, b, held = [node], [root], len(node)
        lag += 1
    if not held:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return forest(np.concatenate(a), np.concatenate(b))


def links(heads: DataFrame, distance: int) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints ``fp`` linked at ``distance``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            key = np.concatenate((key, longs(batch, "run")[0]))
            fp = np.concatenate((fp, longs(batch, "fp")[0]))
            whole = int(np.searchsorted(-(key[::-1] == key[-1]).astype(np.int8), 0)) if len(key) else 0
            cut = len(key) - whole
            node, root = _verified(key[:cut], fp[:cut], distance)
            key, fp = key[cut:], fp[cut:]
            if len(node):
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["a", "b"])
        node, root = _verified(key, fp, distance)
        if len(node):
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["a", "b"])

    keyed = heads.select("fp", F.explode(variants(distance)).alias("k")).select("fp", "k.slot", "k.value")
    crowded = keyed.groupBy("slot", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
    crowded = stored(crowded, "crowded")
    none = F.lit(0)
    if crowded.isEmpty():
        dealt = keyed.withColumn("i", none).withColumn("j", none)
    else:
        blocks = F.ceil(F.col("n") / BLOCK).cast("int")
        mine = F.pmod(F.xxhash64("fp"), blocks).cast("int")
        every = F.transform(F.sequence(none, blocks - 1), lambda x: F.struct(F.least(x, mine).alias("i"), F.greatest(x, mine).alias("j")))
        single = F.array(F.struct(none.alias("i"), none.alias("j")))
        joined = keyed.join(crowded, ["slot", "value"], "left")
        dealt = joined.select("fp", "slot", "value", F.explode(F.when(F.col("n").isNull(), single).otherwise(every)).alias("p")).select("fp", "slot", "value", "p.i", "p.j")
    runs = dealt.select("fp", F.xxhash64("slot", "value", "i", "j").alias("run"))
    count = int(heads.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return runs.repartition(count, "run").sortWithinPartitions("run").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, distance: int = 4
) -> DataFrame:
    """doc_id, fp, component_id (the smallest id reachable over links) for every document."""
    marked = stored(fingerprints(docs, id_col, text_col, shingle), "marks")
    heads = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "heads")
    member = components(links(heads.select("fp"), distance)).withColumnRenamed("node", "fp")
    grouped = stored(heads.join(member, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "grouped")
    whole = grouped.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("size"))
    named = stored(join_unique(grouped, whole, "root", "size", grouped.count()).select("fp", "n", "component_id"), "named")
    return join_unique(marked, named, "fp", "n", marked.count()).select("doc_id", "fp", "component_id")


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, distance: int = 4) -> DataFrame:
    """One document of each near-duplicate group (the smallest id), all columns unchanged.

    A row without id stays only if no document with an id is in its group.
    """
    found = stored(near_duplicates(docs, id_col, text_col, shingle, distance), "linked")
    dropped = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(id_col)).distinct()
    named = docs.join(dropped, id_col, "left_anti")
    if not found.where(F.col("doc_id").isNull()).limit(1).count():
        return named
    # Rows without id are known by their text.
    text = F.sha2(text_or_empty(text_col), 256)
    loose = docs.where(F.col(id_col).isNull())
    keyed = fingerprints(loose.select(F.xxhash64(text).alias("mark"), text_or_empty(text_col).alias("text")), "mark", "text", shingle)
    gone = found.where(F.col("doc_id").isNull() & F.col("component_id").isNotNull()).select("fp").distinct()
    marks = keyed.join(gone, "fp", "left_semi").select(F.col("doc_id").alias("gone_mark")).distinct()
    return named.where(F.col(id_col).isNotNull()).unionByName(loose.join(marks, F.xxhash64(text) == F.col("gone_mark"), "left_anti"))
