"""Phrase collocations by top-order marginalisation.

Every word position opens one window of the longest order: the word and those leading after it, padded
where its piece ends. Only these windows are counted; ``ROLLUP`` over the window columns then sums the
counts of all shorter prefixes, and a phrase's count is that of the windows it opens.

Two exact reductions keep the windows small. A window ends before a word that is rarer than the least
count, as no phrase with such a word can reach it; words are numbered by a dictionary of the frequent
ones while those are at most ``dictionary`` (a bound on the broadcast), else they are spelled out. And
windows are dealt by ranges of their columns, so that a prefix lies in one range or across the border
of neighbours: inside a range each window is cut to its longest prefix that is frequent there or touches
the border. Ranges also split a common word pair over tasks. Their borders come from a sample of the
windows, which steers the balance only, as in Spark's own range partitioning.

Edge cases: null and empty texts have no words; a null language is ``und``; repeated rows count each
time; an empty table, or one without frequent phrases, gives an empty result; other columns are not
read; a long text is cut at the ends of pieces, so only a piece must fit into a task.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from pressgauge.llm.common import byte_slices, text_or_empty
from pressgauge.sinks.files import stored

LONGEST = 5
BITS, PACKED = 21, 3
DICTIONARY = 1 << 20
CHUNK_BYTES = 2 << 20
FLUSH_WORDS = 1 << 18
SAMPLE_BYTES = 16 << 20
KEYS_PER_RANGE = 64
ROWS_AT_ONCE = 1 << 18
# Pieces end at these marks and line ends; upper-case ASCII is lowered, a tab separates words like a space.
_FOLD = bytes.maketrans(
    b".,;:!?\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\n" * 9 + b" abcdefghijklmnopqrstuvwxyz"
)


def _chunks(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The tokens of several texts, a line feed at the end of each piece, in chunks of whole pieces."""
    run = b"\n".join(texts).translate(_FOLD)
    start = 0
    while start < len(run):
        end = len(run) if start + CHUNK_BYTES >= len(run) else run.rfind(b"\n", start, start + CHUNK_BYTES) + 1
        if end <= start:
            end = run.find(b"\n", start + CHUNK_BYTES) + 1 or len(run)
        yield [t for t in run[start:end].replace(b"\n", b" \n ").split(b" ") if t]
        start = end


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """(language, tokens) of every chunk of the rows (lang, text)."""
    for part, texts in byte_slices(batches, "text"):
        groups: dict[str, list[bytes]] = {}
        for lang, text in zip(part.column(part.schema.get_field_index("lang")).to_pylist(), texts):
            groups.setdefault(lang, []).append(text)
        for lang, own in groups.items():
            for tokens in _chunks(own):
                yield lang, tokens


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) of all words of (lang, text)."""

    def rows(found: dict[str, Counter]) -> pa.RecordBatch:
        langs = [lang for lang, own in found.items() for _ in range(len(own))]
        words = [w for own in found.values() for w in own]
        counts = [n for own in found.values() for n in own.values()]
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())],
            ["lang", "word", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}
        for lang, tokens in _by_language(batches):
            own = found.setdefault(lang, Counter())
            own.update(tokens)
            own.pop(b"\n", None)
            if sum(map(len, found.values())) > FLUSH_WORDS:
                yield rows(found)
                found = {}
        yield rows(found)

    return docs.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _frequent(words: DataFrame, least: int, dictionary: int) -> list[tuple[str, bytes]] | None:
    """(lang, word) of all frequent words by language and word; None if they are more than ``dictionary``."""
    some = words.where(F.col("n") >= least).select("lang", F.col("word").cast("binary"))
    if some.count() > min(dictionary, (1 << BITS) - 1):
        return None
    return sorted((r.lang, bytes(r.word)) for r in some.collect())


def windows(
    docs: DataFrame, known: list[tuple[str, bytes]] | None, longest: int = LONGEST, borders: list[tuple] = []
) -> DataFrame:
    """(range, columns, c): the windows of two words and more, counted within each chunk.

    Words are their numbers in ``known``, from 1, the first one standing for its language as well; the
    columns ``p1``, ... hold ``PACKED`` of them each, 0 where the window is padded. Without ``known`` the words are
    spelled out in ``w1``, ..., the first one after its language and a space, and null pads. A window's
    range is the number of ``borders`` at or below it.
    """
    shared = None if known is None else docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, dict[bytes, int]] = {}
        for number, (lang, word) in enumerate(shared.value if shared else (), 1):
            tables.setdefault(lang, {})[word] = number
        for lang, tokens in _by_language(batches):
            spelled = None
            if shared is None:
                spelled = sorted(set(tokens) - {b"\n"})
                table = {w: i for i, w in enumerate(spelled, 1)}
            else:
                table = tables.get(lang, {})
            codes = np.fromiter(map(table.get, tokens, repeat(0)), np.int64, len(tokens))
            columns = lead(codes, longest)
            if not len(columns[0]):
                continue
            columns, counts = combined(columns, np.ones(len(columns[0]), np.int64))
            if spelled is None:
                def window(i: int) -> tuple:
                    return tuple(int(c[i]) for c in columns)

                out = [pa.array(c) for c in packed(columns)]
            else:
                head = f"{lang} ".encode()

                def window(i: int) -> tuple:
                    first, *rest = (spelled[c[i] - 1] if c[i] else b"" for c in columns)
                    return (head + first, *rest)

                texts = pa.array([None, *[w.decode() for w in spelled]], pa.string())
                first = pa.array([None, *[f"{lang} {w.decode()}" for w in spelled]], pa.string())
                out = [(texts if i else first).take(pa.array(c)) for i, c in enumerate(columns)]
            # The chunk is in order, so each border is found by bisection.
            cuts = [bisect_left(range(len(counts)), border, key=window) for border in borders]
            place = np.searchsorted(cuts, np.arange(len(counts)), side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(place), *out, pa.array(counts)], ["range", *window_columns(known, longest), "c"])

    kind = "string" if known is None else "long"
    return docs.mapInArrow(run, "range int, " + ", ".join(f"{w} {kind}" for w in window_columns(known, longest)) + ", c long")


def window_columns(known: list | None, longest: int) -> list[str]:
    """The columns that hold a window on its way."""
    return names(longest) if known is None else [f"p{i}" for i in range(1, -(-longest // PACKED) + 1)]


def packed(columns: list[np.ndarray]) -> list[np.ndarray]:
    """``PACKED`` numbers of 21 bits in each long, in the same order."""
    padded = [*columns, *[np.zeros_like(columns[0])] * (-len(columns) % PACKED)]
    return [sum(c << (BITS * (PACKED - 1 - i)) for i, c in enumerate(padded[at: at + PACKED])) for at in range(0, len(padded), PACKED)]


def unpacked(table: pa.Table, longest: int) -> pa.Table:
    """The word columns, null for padding, in place of the packed ones."""
    if "p1" not in table.column_names:
        return table
    words = []
    for i in range(longest):
        code = table.column(f"p{i // PACKED + 1}").to_numpy() >> (BITS * (PACKED - 1 - i % PACKED)) & ((1 << BITS) - 1)
        words.append(pa.array(code, pa.int64(), mask=code == 0))
    return pa.table([table.column("range"), *words, table.column("c")], names=["range", *names(longest), "c"])


def names(longest: int) -> list[str]:
    """The window columns."""
    return [f"w{i}" for i in range(1, longest + 1)]


def lead(codes: np.ndarray, longest: int) -> list[np.ndarray]:
    """Each code with those leading after it, up to the next 0; positions without a second one are left out."""
    padded = np.concatenate((codes, np.zeros(longest, np.int64)))
    start = np.flatnonzero((codes > 0) & (padded[1: len(codes) + 1] > 0))
    columns = [padded[start]]
    for i in range(1, longest):
        columns.append(np.where(columns[-1] > 0, padded[start + i], 0))
    return columns


def combined(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The different windows in order, with summed counts."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    at = np.flatnonzero(new)
    return [c[at] for c in columns], np.add.reduceat(counts[order], at)


def _borders(docs: DataFrame, known: list[tuple[str, bytes]] | None, longest: int, ranges: int) -> list[tuple]:
    """Windows at the borders of ``ranges`` ranges of about equal size, from a sample of the documents."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    step = max(1, size // SAMPLE_BYTES)
    few = windows(docs.where(F.pmod(F.xxhash64("text"), F.lit(step)) == 0), known, longest)
    share = max(1, min(size, SAMPLE_BYTES) // 8 // (ranges * KEYS_PER_RANGE))
    columns = window_columns(known, longest)
    keys = few.where(F.pmod(F.xxhash64(*columns), F.lit(share)) == 0).select(*columns).collect()
    if known is None:
        found = sorted(tuple(b"" if x is None else x.encode() for x in k) for k in keys)
    else:
        shifts = [(i // PACKED, BITS * (PACKED - 1 - i % PACKED)) for i in range(longest)]
        found = sorted(tuple(k[at] >> shift & ((1 << BITS) - 1) for at, shift in shifts) for k in keys)
    return sorted({found[len(found) * i // ranges] for i in range(1, ranges)}) if found else []


class _Cutter:
    """Cuts the windows of a sorted stream to their longest prefix that may be frequent.

    A prefix may be if it reaches the least count inside its range, or if it touches the range's first or
    last window, as it then may go on in the next range. Only the open run of equal first two words is
    held, itself cut as far as its closed runs allow, so memory does not grow with a run.
    """

    def __init__(self, longest: int, least: int) -> None:
        self.longest, self.least = longest, least
        self.rest: pa.Table | None = None
        self.range, self.first = -1, ()

    def feed(self, table: pa.Table, last: bool = False) -> pa.Table:
        """The finished rows (w1, ..., c) after some more of the stream."""
        if self.rest is not None:
            table = pa.concat_tables([self.rest, table])
        if not table.num_rows:
            return table.drop_columns(["range"])
        place = table.column("range").to_numpy()
        words = [_codes(table.column(w)) for w in names(self.longest)]
        counts = table.column("c").to_numpy()
        n = len(place)
        changed = np.ones(n, bool)
        changed[1:] = place[1:] != place[:-1]
        touches = [np.zeros(n, bool) for _ in words]
        for at in np.flatnonzero(changed):
            end = int(np.searchsorted(place, place[at], side="right"))
            if place[at] != self.range:
                self.range = int(place[at])
                self.first = tuple(table.column(w)[int(at)].as_py() for w in names(self.longest))
            same = np.ones(end - at, bool)
            for level, (w, value) in enumerate(zip(names(self.longest), self.first)):
                if value is None:
                    break
                same &= np.asarray(pc.fill_null(pc.equal(table.column(w).slice(int(at), int(end - at)), value), False))
                touches[level][at:end] = same
        keep = np.zeros(n, np.int8)
        new = changed.copy()
        open_run = 0
        for level, code in enumerate(words):
            new[1:] |= code[1:] != code[:-1]
            starts = np.flatnonzero(new)
            total = np.add.reduceat(counts, starts)
            ends_range = np.append(changed[starts[1:]], True)
            may = np.repeat((total >= self.least) | ends_range, np.diff(np.append(starts, n))) | touches[level]
            if level:
                keep[may & (code > 0)] = level + 1
            if level == 1:
                open_run = int(starts[-1])
        words = [np.where(keep > level, code, 0) for level, code in enumerate(words)]
        some = np.flatnonzero(keep)
        fresh = np.zeros(len(some), bool)
        fresh[:1] = True
        for code in (place, *words):
            fresh[1:] |= code[some][1:] != code[some][:-1]
        at = some[fresh]
        summed = np.add.reduceat(counts[some], np.flatnonzero(fresh)) if len(at) else counts[:0]
        taken = table.take(pa.array(at))
        columns = [pc.if_else(pa.array(keep[at] > level), taken.column(w), None) for level, w in enumerate(names(self.longest))]
        done = pa.table([taken.column("range"), *columns, pa.array(summed)], schema=table.schema)
        split = len(at) if last else int(np.searchsorted(at, open_run))
        self.rest = done.slice(split)
        return done.slice(0, split).drop_columns(["range"])


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    """Numbers that are equal for equal values, 0 for null."""
    if pa.types.is_integer(column.type):
        return np.asarray(column.fill_null(0))
    return np.asarray(column.combine_chunks().dictionary_encode().indices.fill_null(-1)).astype(np.int64) + 1


def cut_windows(dealt: DataFrame, longest: int, least: int) -> DataFrame:
    """(w1, ..., c) of the windows as far as they may be frequent, from rows dealt and sorted by range and window."""
    kind = "string" if "w1" in dealt.columns else "long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, held, rows = _Cutter(longest, least), [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= ROWS_AT_ONCE:
                yield from cutter.feed(unpacked(pa.Table.from_batches(held), longest)).to_batches()
                held, rows = [], 0
        if held or cutter.rest is not None:
            tail = unpacked(pa.Table.from_batches(held), longest) if held else cutter.rest.slice(0, 0)
            yield from cutter.feed(tail, last=True).to_batches()

    return dealt.mapInArrow(run, ", ".join(f"{w} {kind}" for w in names(longest)) + ", c long")


def marginal_counts(cut: DataFrame, longest: int, least: int) -> DataFrame:
    """(w1, ..., k, a) of every prefix of at least two words with a count of ``least`` and more."""
    columns = names(longest)
    rolled = cut.rollup(*columns).agg(F.sum("c").alias("a"), F.grouping_id().alias("level"))
    # grouping_id has one bit for each column that is rolled up.
    k = F.coalesce(*[F.when((F.col("level") == (1 << (longest - i)) - 1) & F.col(columns[i - 1]).isNotNull(), i) for i in range(2, longest + 1)])
    return rolled.withColumn("k", k).where(F.col("k").isNotNull() & (F.col("a") >= least)).drop("level")


def _spell(rows: DataFrame, known: list[tuple[str, bytes]] | None, longest: int) -> DataFrame:
    """(lang, phrase, k, a): prefixes as text."""
    shared = None if known is None else rows.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, phrases = [], []
            for first, *rest in zip(*(batch.column(batch.schema.get_field_index(w)).to_pylist() for w in names(longest))):
                if shared is None:
                    lang, _, word = first.rpartition(" ")
                    words = [word, *[w for w in rest if w is not None]]
                else:
                    lang = shared.value[first - 1][0]
                    words = [shared.value[w - 1][1].decode() for w in (first, *rest) if w is not None]
                langs.append(lang)
                phrases.append(" ".join(words))
            own = [batch.column(batch.schema.get_field_index(c)) for c in ("k", "a")]
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(phrases, pa.string()), *own], ["lang", "phrase", "k", "a"])

    return rows.mapInArrow(run, "lang string, phrase string, k int, a long")


def scored(phrases: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, k, a, l, r, n, score: each phrase with its lowest-scoring cut, ties to the shortest first part.

    ``words`` (lang, word, n) has the counts of the single words, ``totals`` (lang, n) those of all words.
    """
    parts = phrases.select("lang", "phrase", "a").unionByName(words.select("lang", F.col("word").alias("phrase"), F.col("n").alias("a")))
    cut = F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    cuts = phrases.select("lang", "phrase", "k", "a", cut).select(
        "*", F.expr("substring_index(phrase, ' ', cut)").alias("head"), F.expr("substring_index(phrase, ' ', cut - k)").alias("tail")
    )
    found = cuts.join(parts.toDF("lang", "head", "l"), ["lang", "head"]).join(parts.toDF("lang", "tail", "r"), ["lang", "tail"]) \
        .join(F.broadcast(totals), "lang")
    # Decimals hold the products exactly, and div cuts the quotient without rounding it before.
    score = F.expr("(1000 * cast(a as decimal(16,0)) * cast(n as decimal(16,0))) div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))")
    best = found.groupBy("lang", "phrase", "k", "a", "n").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("b"))
    return best.select("lang", "phrase", "k", "a", "b.l", "b.r", "n", F.col("b.score").cast("long").alias("score"))


def maximal(candidates: DataFrame, share: int = 100) -> DataFrame:
    """The candidates that no longer candidate holds at ``share`` percent of their count and more."""
    words, k = F.split("phrase", " "), F.col("k")
    spans = F.flatten(F.transform(
        F.sequence(F.lit(2), k - 1),
        lambda size: F.transform(F.sequence(F.lit(1), k - size + 1), lambda at: F.array_join(F.slice(words, at, size), " ")),
    ))
    inner = candidates.where(k > 2).select("lang", F.explode(spans).alias("phrase"), F.col("a").alias("longer"))
    most = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    held = F.coalesce(F.lit(100) * F.col("longer") >= F.lit(share) * F.col("a"), F.lit(False))
    return candidates.join(most, ["lang", "phrase"], "left").where(~held).drop("longer")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST, least: int = 100, top: int = 2000,
    share: int = 100, dictionary: int = DICTIONARY,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language.

    A phrase has 2 to ``longest`` words and occurs at least ``least`` times within pieces.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), text_or_empty(text_col).alias("text"))
    words = stored(word_counts(rows), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    known = _frequent(words, least, dictionary)
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    borders = _borders(rows, known, longest, ranges)
    dealt = windows(rows, known, longest, borders).repartition(ranges // 4, "range")
    dealt = dealt.sortWithinPartitions("range", *window_columns(known, longest))
    cut = stored(cut_windows(dealt, longest, least), "windows")
    phrases = stored(_spell(marginal_counts(cut, longest, least), known, longest), "phrases")
    ranked = maximal(scored(phrases, words.where(F.col("n") >= least), totals), share)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
