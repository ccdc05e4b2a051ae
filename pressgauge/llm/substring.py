"""Repeated passages: seed on winnowed anchors, extend both ways, remove maximal repeats.

Seed: of each window of ``min_words`` words the smallest ``SEED_WORDS``-gram by hash is its anchor, so
a passage shared by two documents has the same anchors in both. Anchors are joined by hash, and only
those found in more than one document are seeds. Extend: the windows around a seed are compared
with all documents that share them, so a match grows to the left and right as long as some smaller id
agrees; adjoining windows form the maximal repeats, all at least ``min_words`` long.

A task reports an anchor or window that it sees in several documents once, so a passage in a third of
all documents adds one row per few megabytes of text to the shuffle, and no group of copies is
expanded into pairs. A document's own seeds and windows come back as lists bounded by its length.

Edge cases: null text has no words; documents under ``min_words`` words lose nothing; a null id
neither loses words nor is a source; repeated rows with one id never remove each other's words; an
empty table gives an empty result; only the id and text columns are read by ``repeats``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window, functions as F

from pressgauge.llm.common import Words, byte_slices, longs, pair_key

MIN_WORDS = 13
SEED_WORDS = 4
_HITS = "h long, doc_id long, known boolean"


def anchors(words: Words, windows: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, word index) of the anchor of each window: its last smallest seed gram."""
    grams = words.valid(SEED_WORDS)
    hashed = np.zeros(len(words.doc), np.uint64)
    hashed[grams] = words.span(grams, SEED_WORDS)
    best, at = hashed[windows], windows.copy()
    for step in range(1, min_words - SEED_WORDS + 1):
        h = hashed[windows + step]
        lower = h <= best
        best = np.where(lower, h, best)
        at[lower] = windows[lower] + step
    return best, at


def _distinct(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different (hash, document) pairs, sorted by both."""
    order = np.lexsort((doc, h))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], doc[new]


def _hits(h: np.ndarray, doc: np.ndarray, known: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(doc), pa.array(known)], ["h", "doc_id", "known"])


def _firsts(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted hashes: which are the first of their run, and which have company."""
    first = np.ones(len(h), bool)
    first[1:] = h[1:] != h[:-1]
    return first, ~first | ~np.append(first[1:], True)


def _seed_rows(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in byte_slices(batches, "text"):
            ids, _ = longs(part, "doc_id")
            words = Words(texts)
            h, at = anchors(words, words.valid(min_words), min_words)
            h, doc = _distinct(h, ids[words.doc[at]])
            first, shared = _firsts(h)
            known = np.concatenate((np.ones(int(shared.sum()), bool), np.zeros(int(first.sum()), bool)))
            yield _hits(np.concatenate((h[shared], h[first])), np.concatenate((doc[shared], doc[first])), known)

    return run


def _window_rows(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in byte_slices(batches, "text"):
            ids, _ = longs(part, "doc_id")
            listed = _listed(part, "seeds")
            words = Words(texts if len(listed) else [])
            windows = words.valid(min_words)
            h, _ = anchors(words, windows, min_words)
            windows = windows[np.isin(pair_key(h, words.doc[windows]), listed)]
            h, doc = _distinct(words.span(windows, min_words), ids[words.doc[windows]])
            first, _ = _firsts(h)
            known = ~first
            yield _hits(h, doc, known)

    return run


def _listed(part: pa.RecordBatch, name: str) -> np.ndarray:
    """The hashes listed for each row, as (hash, row) keys."""
    column = part.column(part.schema.get_field_index(name))
    sizes = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(column), 0), np.int64)
    values = np.asarray(column.flatten()).astype(np.int64).view(np.uint64)
    return pair_key(values, np.repeat(np.arange(len(sizes)), sizes))


def _spans(words: Words, starts: np.ndarray, min_words: int) -> np.ndarray:
    """Which words are covered by the windows that begin at ``starts``."""
    edge = np.zeros(len(words.doc) + 1, np.int64)
    edge[starts] += 1
    edge[starts + min_words] -= 1
    return np.cumsum(edge)[:-1] > 0


def _cut(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in byte_slices(batches, "text"):
            words = Words(texts)
            windows = words.valid(min_words)
            listed = _listed(part, "repeats")
            if len(listed):
                windows = windows[np.isin(pair_key(words.span(windows, min_words), words.doc[windows]), listed)]
            else:
                windows = windows[:0]
            covered = _spans(words, windows, min_words)
            bounds = np.concatenate(([0], np.cumsum(words.counts)))
            removed = np.diff(np.concatenate(([0], np.cumsum(covered)))[bounds])
            kept, spans = [], []
            for i, text in enumerate(words.texts):
                if not removed[i]:
                    kept.append(text)
                    spans.append([])
                    continue
                mask = covered[bounds[i]: bounds[i + 1]]
                kept.append(b" ".join([w for w, gone in zip(text.split(b" "), mask.tolist()) if not gone]))
                edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))).reshape(-1, 2)
                spans.append([{"start": int(a), "words": int(b - a)} for a, b in edges])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(part.schema.get_field_index("row")), part.column(part.schema.get_field_index("text")),
                    pa.array(words.counts), pa.array(removed.astype(np.int64)),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64())]))),
                ],
                ["row", "text", "n_words", "n_removed", "kept_text", "spans"],
            )

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, doc_id, text): the other columns as one struct, and the id where there are no others."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)]
    key = F.col(f"`{id_col}`").cast("long")
    row = F.struct(key.alias("id"), *[c.alias(f"c{i}") for i, c in enumerate(others)])
    return docs.select(row.alias("row"), key.alias("doc_id"), F.col(f"`{text_col}`").alias("text"))


def _marked(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """row, text, n_words, n_removed, kept_text, spans of every document.

    The whole texts are shuffled by id once: both joins below read the same exchange.
    """
    keyed = _keyed(docs, id_col, text_col)
    group = Window.partitionBy("run", "known")
    run = F.when(F.col("known"), F.xxhash64("h", "doc_id")).otherwise(F.col("h"))
    found = keyed.select("doc_id", "text").where("doc_id is not null").mapInArrow(_seed_rows(min_words), _HITS)
    found = found.withColumn("run", run).select("*", F.min("doc_id").over(group).alias("low"), F.max("doc_id").over(group).alias("high"))
    seeds = found.where("known or low < high").groupBy("doc_id").agg(F.collect_list("h").alias("seeds"))
    met = keyed.join(seeds, "doc_id", "left").mapInArrow(_window_rows(min_words), _HITS)
    met = met.withColumn("run", run).withColumn("low", F.min("doc_id").over(group)).where("known or low < doc_id")
    lists = met.groupBy("doc_id").agg(F.collect_list("h").alias("repeats"))
    kind = keyed.schema["row"].dataType.simpleString()
    spans = "array<struct<start: long, words: long>>"
    schema = f"row {kind}, text string, n_words long, n_removed long, kept_text string, spans {spans}"
    return keyed.join(lists, "doc_id", "left").mapInArrow(_cut(min_words), schema)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text, spans (start, words) of every document.

    Removed is each word in a run of ``min_words`` words that also starts in a smaller id. The words
    that stay are joined by one space.
    """
    done = _marked(docs.select(id_col, text_col), id_col, text_col, min_words)
    return done.select(F.col("row.id").alias("doc_id"), "n_words", "n_removed", "kept_text", "spans")


def cleaned_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """All documents and columns; texts that hold repeats are replaced by the words that stay.

    Texts without repeats stay as they are, white space and null included.
    """
    done = _marked(docs, id_col, text_col, min_words)
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    columns = {c: F.col(f"row.c{i}") for i, c in enumerate(others)}
    columns[id_col] = F.col("row.id").cast(docs.schema[id_col].dataType)
    columns[text_col] = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return done.select(*[columns[c].alias(c) for c in docs.columns])
