"""Byte-level BPE encoding of texts of any length, and decoding.

Texts of up to ``LONG`` characters are encoded in the task that reads them. Longer ones are cut into
overlapping chunks that are pre-tokenised in parallel. A chunk may begin inside a pre-token, but from
the first boundary that it shares with its predecessor on both agree, so the texts are stitched there
into pieces that begin and end at true boundaries; chunks that share none are joined and pre-tokenised
again. The pieces are encoded in parallel and their ids put in a row. Decoding concatenates the
bytes of the ids.

Pre-tokens follow the letters and digits that the encoder's own library knows, whatever the Unicode version of the
pattern library here. Ids of pre-tokens are cached, up to ``CACHE`` of them a task.

Edge cases: null and empty texts have no ids; repeated rows are encoded one by one; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F

from pressgauge.llm.common import byte_slices
from pressgauge.sinks.files import stored

LONG = 1 << 16
OVERLAP = 1 << 10
CACHE = 600_000


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a .tiktoken file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _members(code: str) -> set[str]:
    """The characters of a class as the encoder's own pattern engine sees it."""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = tiktoken.Encoding("class", pat_str=code, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
    return set(single.decode(single.encode_ordinary(every)))


def _ranges(characters: set[str]) -> str:
    out, codes = [], sorted(map(ord, characters))
    for c in codes:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


def patterns(pattern: str) -> tuple[str, str, str]:
    """(plain, careful, rare): ``careful`` is right for texts with ``rare`` characters, ``plain`` for all others."""
    careful, rare = pattern, set()
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for code in (r"\p{L}", r"\p{N}"):
        theirs, ours = _members(code), set(regex.findall(code, every))
        rare |= theirs ^ ours
        exact = f"{code}||[{_ranges(theirs - ours)}]" if theirs - ours else code
        exact = f"[[{exact}]--[{_ranges(ours - theirs)}]]" if ours - theirs else f"[{exact}]"
        careful = careful.replace(code, exact)
    return pattern, careful, f"[{_ranges(rare)}]" if rare else ""


class Encoder:
    """Pre-tokens and their ids, with a bounded cache."""

    def __init__(self, ranks: dict[bytes, int], rules: tuple[str, str, str]) -> None:
        plain, careful, rare = rules
        self.encoding = tiktoken.Encoding("ranks", pat_str=plain, mergeable_ranks=ranks, special_tokens={})
        self.plain = regex.compile(plain).findall
        self.careful = regex.compile(careful, regex.V1).findall if rare else self.plain
        self.rare = regex.compile(rare).search if rare else None
        self.known: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        """The matches of the pattern, which cover the text."""
        if self.rare and not text.isascii() and self.rare(text):
            return self.careful(text)
        return self.plain(text)

    def ids(self, lists: list[list[str]]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each list of pre-tokens."""
        if len(self.known) > CACHE:
            self.known.clear()
        encode = self.encoding.encode_ordinary
        for token in set().union(*lists) - self.known.keys():
            self.known[token] = array("I", encode(token)).tobytes()
        return [b"".join(map(self.known.__getitem__, tokens)) for tokens in lists]


def _ends(tokens: list[str]) -> np.ndarray:
    return np.fromiter(accumulate(map(len, tokens)), np.int64, len(tokens))


def stitch(chunks: Iterator[tuple[int, bool, str, np.ndarray]], split) -> Iterator[tuple[str, np.ndarray]]:
    """(text, ends of its pre-tokens) of pieces that begin and end at true boundaries.

    ``chunks`` are (offset, whether it is the last, text, ends in it) of one text in order, the first at
    a true boundary. A boundary counts only if the chunk goes on behind it.
    """
    at, text, ends = 0, "", np.zeros(0, np.int64)  # ``text`` begins at the true boundary ``at``
    started = False
    for offset, last, more, more_ends in chunks:
        if not started:
            at, text, ends, started = offset, more, more_ends, True
            continue
        mine = np.concatenate(([0], ends[ends < len(text)])) + at
        theirs = np.concatenate(([0], more_ends[more_ends < len(more)] if not last else more_ends)) + offset
        common = np.intersect1d(mine[mine >= offset], theirs)
        if len(common):
            meet = int(common[0])
            if meet > at:
                yield text[: meet - at], ends[ends <= meet - at]
            text, ends, at = more[meet - offset:], more_ends[more_ends > meet - offset] - (meet - offset), meet
        else:
            text += more[at + len(text) - offset:]
            ends = _ends(split(text))
    if text:
        yield text, ends


def _short(ranks, rules, schema_names):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(load_ranks(ranks), rules)
        for part, texts in byte_slices(batches, "text"):
            ids = encoder.ids([encoder.split(t.decode("utf-8", "replace")) for t in texts])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], schema_names)

    return run


def _encode_long(texts: DataFrame, ranks: str, rules: tuple[str, str, str], size: int, overlap: int) -> DataFrame:
    """(doc_id, ids) of long texts through stitched chunks."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, some in byte_slices(batches, "text"):
            for i, raw in enumerate(some):
                text = raw.decode("utf-8", "replace")
                count = max(1, -(-(len(text) - overlap) // size))
                for no in range(count):
                    piece = text[no * size: (no + 1) * size + overlap]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).slice(i, 1), part.column(1).slice(i, 1), pa.array([no], pa.int64()), pa.array([no == count - 1]), pa.array([piece])],
                        ["key", "doc_id", "no", "last", "text"],
                    )

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(load_ranks(ranks), rules)
        for part, some in byte_slices(batches, "text"):
            ends = [_ends(encoder.split(t.decode("utf-8", "replace"))).tobytes() for t in some]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ends, pa.binary())], [*part.schema.names, "ends"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(load_ranks(ranks), rules)
        for key, doc_id, chunks in _by_key(batches):
            found = stitch(((no * size, last, text, np.frombuffer(ends, np.int64)) for no, last, text, ends in chunks), encoder.split)
            for no, (text, ends) in enumerate(found):
                yield pa.RecordBatch.from_pylist([{"key": key, "doc_id": doc_id, "no": no, "text": text, "ends": ends.tobytes()}], pieces)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(load_ranks(ranks), rules)
        for part, some in byte_slices(batches, "text"):
            lists = []
            for raw, ends in zip(some, part.column(part.schema.get_field_index("ends")).to_pylist()):
                text, ends = raw.decode("utf-8", "replace"), np.frombuffer(ends, np.int64).tolist()
                lists.append([text[a:b] for a, b in zip([0, *ends], ends)])
            columns = [part.column(part.schema.get_field_index(c)) for c in ("key", "doc_id", "no")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(encoder.ids(lists), pa.binary())], ["key", "doc_id", "no", "ids"])

    def line_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, doc_id, found in _by_key(batches):
            yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), pa.array([b"".join(x[-1] for x in found)], pa.binary())], ["doc_id", "ids"])

    pieces = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("no", pa.int64()), ("text", pa.string()), ("ends", pa.binary())])
    count = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = texts.select(F.monotonically_increasing_id().alias("key"), "doc_id", "text")
    chunks = stored(keyed.mapInArrow(cut, "key long, doc_id long, no long, last boolean, text string"), "chunks")
    marked = chunks.repartition(count, "key", "no").mapInArrow(mark, "key long, doc_id long, no long, last boolean, text string, ends binary")
    ordered = marked.repartition(count, "key").sortWithinPartitions("key", "no")
    pieced = ordered.mapInArrow(join, "key long, doc_id long, no long, text string, ends binary")
    coded = pieced.repartition(count, "key", "no").mapInArrow(encode, "key long, doc_id long, no long, ids binary")
    return coded.repartition(count, "key").sortWithinPartitions("key", "no").mapInArrow(line_up, "doc_id long, ids binary")


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, Iterator[tuple]]]:
    """(key, doc_id, the other columns of its rows one by one) of batches sorted by key."""
    from itertools import groupby

    rows = (r for batch in batches for r in zip(*(column.to_pylist() for column in batch.columns)))
    for key, group in groupby(rows, key=lambda r: r[0]):
        first = next(group)
        yield key, first[1], (r[2:] for r in _chain(first, group))


def _chain(first: tuple, rest: Iterator[tuple]) -> Iterator[tuple]:
    yield first
    yield from rest


def encode(
    docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", long: int = LONG, overlap: int = OVERLAP
) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit) of every whole text."""
    rules = patterns(pattern)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = F.coalesce(F.length("text"), F.lit(0))
    short = texts.where(size <= long).mapInArrow(_short(ranks, rules, ["doc_id", "ids"]), "doc_id long, ids binary")
    return short.unionByName(_encode_long(texts.where(size > long), ranks, rules, long, overlap))


def decode(coded: DataFrame, ranks: str) -> DataFrame:
    """All columns and ``decoded``: the bytes of the ids in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = load_ranks(ranks)
        table = [b""] * (max(tokens.values()) + 1)
        for token, rank in tokens.items():
            table[rank] = token
        for part, ids in byte_slices(batches, "ids"):
            raw = [b"".join(map(table.__getitem__, np.frombuffer(x, "<u4").tolist())) for x in ids]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(raw, pa.binary())], [*part.schema.names, "decoded"])

    return coded.mapInArrow(run, coded.schema.simpleString()[len("struct<"):-1] + ", decoded: binary")
