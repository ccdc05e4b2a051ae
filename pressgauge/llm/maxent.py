"""Language-model scores by a hashed maximum-entropy model with class-factored softmax.

Tokens of all training texts are counted exactly. Outcomes are slots, dealt by frequency into classes of
``WIDTH``: the most frequent tokens have a slot each, all others share slots by their last byte and hash, and the
end of a text is a class of its own. The number of classes, and with it all tables of weights, grows with the
counted vocabulary. The probability of a slot is that of its class times that within the class, each a softmax
over weights of the history's features: the last three tokens (two of them skips) and the hashed bigram of the
last two, where rarer tokens of the history go by their last byte.

Below each shared slot a tree of two-way choices goes on down to the single token, so that every token of the
vocabulary is an outcome that the history moves. A choice starts from the exact counts of its two sides and adds a
hashed weight of its node with the last token, whichever it is (skips and bigrams there made held-out texts less
likely). Near tokens are found by their octave of frequency and their number in it, all others by the bits of their
hash: down to a bucket by counts that every task has, in the bucket by counts that meet the occurrences in a sort by
hash. Tokens of one leaf, which only equal bits bring together, have their shares of its counts. So the model is normalised over all tokens, one
unknown token per bucket included. Training knows no counts inside a bucket and starts from even sides there.

Training passes once over every text, in ``ROUNDS`` rounds of disjoint parts: the tasks of a round start from
the same weights, run gradient steps over their shards, and the results are averaged row by row, weighted by how
often a shard saw the row. Parts and shards follow from the hash of text and id, so scores do not
depend on how the table is stored. Counts of tokens rarer than the ``NEAR`` most frequent meet their occurrences by hash.

Edge cases: null and empty texts hold the end alone; repeated rows are counted and scored one by one; a null id is
never held out; without training texts all counts are 0; an empty table gives an empty result; a text is one
task's work, by slices of tokens; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain
from math import isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from pressgauge.llm.common import byte_slices, mix
from pressgauge.sinks.files import stored

WIDTH = 32
LEAST_CLASSES = 17
WORDS_PER_CLASS = 128
END = 0
NEAR = 1 << 17
SHAPES = 64
INSIDE = (0, 1, 3)
BUCKETS = 1 << 19
HASH_BITS = 32
FINE = 16
LEVELS = 4
ROUNDS = 3
SHARD_TOKENS = 2_000_000
STEP_TOKENS = 1 << 12
BLOCK = 64
RATE = 0.3
REACH = 60.0
FLUSH = 4_000_000
CACHED = 400_000
RANGES = 64
ALPHA = 0.1
LEAST = float(np.log(1e-30))
_NODE = np.uint64(0x9E3779B97F4A7C15)
_TREE = np.uint64(0xC2B2AE3D27D4EB4F)


class Vocabulary(NamedTuple):
    """Exact counts: of the near (most frequent) tokens, of ends, of all tokens, of different ones; totals and different tokens of each shared slot.

    ``least`` is the least count of a near token, ``far`` the totals and different tokens of the buckets of all others, ``bits`` and ``tail`` how many
    bits of the hash tell the bucket, and then the leaf, in each shared slot.
    """

    words: list[bytes]
    counts: list[int]
    ends: int
    total: int
    distinct: int
    classes: int
    shared: np.ndarray
    least: int = 1
    far: np.ndarray | None = None
    bits: np.ndarray | None = None
    tail: np.ndarray | None = None

    @property
    def slots(self) -> int:
        return (self.classes - 1) * WIDTH

    @property
    def hashes(self) -> int:
        """How many shared slots there are for each last byte."""
        return max(1, self.slots // (8 * SHAPES))

    @property
    def own(self) -> int:
        """How many slots hold one token only."""
        return self.slots - SHAPES * self.hashes

    @property
    def seen(self) -> int:
        """History numbers: the end (or nothing) and the slots."""
        return self.slots + 1

    @property
    def class_rows(self) -> int:
        return 1 << (4 * 3 * self.seen - 1).bit_length()

    @property
    def word_rows(self) -> int:
        return 2 * self.class_rows

    @property
    def deep_rows(self) -> int:
        return 4 * self.word_rows


class Weights(NamedTuple):
    """Class weights by history feature, word weights by (history feature, class), their biases, and weights of two-way choices by (node, history feature)."""

    classes: np.ndarray
    words: np.ndarray
    class_bias: np.ndarray
    word_bias: np.ndarray
    deep: np.ndarray


def fold(id_col: str = "doc_id") -> Column:
    """CRC-32 of the id as text, modulo 10 (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 10


def class_count(distinct: int) -> int:
    """Classes for a vocabulary: their number grows with its root."""
    return LEAST_CLASSES + isqrt(distinct) // WORDS_PER_CLASS


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of all texts, and their number in each."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words, sizes = parts.flatten().cast(pa.binary()), np.asarray(pc.list_value_length(parts)).astype(np.int64)
    some = np.asarray(pc.binary_length(words)) > 0
    if not some.all():
        sizes -= np.bincount(np.repeat(np.arange(len(sizes)), sizes)[~some], minlength=len(sizes))
        words = words.filter(pa.array(some))
    return words, sizes


def hashed(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 and last byte of each word."""
    _, ends, data = words.buffers()
    ends = np.frombuffer(ends, np.int32)[words.offset: words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int32)
    data = data.to_pybytes() if len(words) else b""
    places = ends.tolist()
    crc = np.fromiter((zlib.crc32(data[a:b]) for a, b in zip(places, places[1:])), np.int64, len(words))
    return crc, np.frombuffer(data, np.uint8)[ends[1:] - 1].astype(np.int64)


def count_tokens(texts: DataFrame) -> DataFrame:
    """(token, n) of a column ``text``: lower-cased words of all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0

        def rows() -> pa.RecordBatch:
            found = pc.value_counts(pa.chunked_array(kept, pa.binary()))
            return pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["token", "n"])

        for part, _ in byte_slices(batches, "text"):
            words = split(part.column(0))[0]
            kept.append(words)
            size += len(words)
            if size > FLUSH:
                yield rows()
                kept, size = [], 0
        yield rows()

    return texts.select("text").mapInArrow(run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, ends: int, near: int = NEAR) -> Vocabulary:
    """What the tasks need to know of the counts, a stored table.

    A histogram of the counts tells from which count on at most ``near`` tokens are left; these alone come to
    the driver, whatever the number of partitions.
    """
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # One row for each different count: at most the root of twice the total.
    tall = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    least = tall.select("n", F.sum("words").over(Window.orderBy(F.desc("n"))).alias("words")).where(F.col("words") <= near).agg(F.min("n")).first()[0]
    least = least if least is not None else total + 1
    top = counts.where(F.col("n") >= F.lit(least)).collect()
    top.sort(key=lambda r: (-r.n, bytes(r.token)))
    classes = class_count(distinct)
    empty = Vocabulary([bytes(r.token) for r in top], [r.n for r in top], ends, total + ends, distinct + (ends > 0), classes, np.zeros((0, 2)), least)
    shared, far = np.zeros((2, empty.slots - empty.own, 2), np.int64)
    rest = counts.where(F.col("n") < F.lit(least))
    for r in rest.groupBy(slot_of("token", empty.hashes).alias("slot")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect():
        far[r.slot] = r.n, r.words
    shared += far
    for word, n in list(zip(empty.words, empty.counts))[empty.own:]:
        shared[shared_slot(word, empty.hashes)] += n, 1
    bits, tail = depths(far[:, 1])
    vocab = empty._replace(shared=shared, bits=bits, tail=tail)
    found = rest.groupBy(bucket_of("token", vocab).alias("bucket")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).toArrow()
    table = np.zeros(((1 << bits).sum(), 2), np.int64)
    table[np.asarray(found.column("bucket"))] = np.stack((np.asarray(found.column("n")), np.asarray(found.column("words"))), axis=1)
    return vocab._replace(far=table)


def depths(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits of the hash that tell the bucket, ``BUCKETS`` at most in all, and more that tell the leaf, from the tokens of each shared slot.

    There are two leaves a token or more, however many tokens there are.
    """
    buckets = np.maximum(1, words * min(1.0, BUCKETS / max(1, words.sum())))
    bits = np.floor(np.log2(buckets)).astype(np.int64)
    leaves = np.ceil(np.log2(2 * np.maximum(1, words))).astype(np.int64)
    return bits, np.where(words > 1, np.minimum(leaves, HASH_BITS - 1) - bits, 0)


def slot_of(token: str, hashes: int) -> Column:
    """``shared_slot`` of a column."""
    # The first byte of its CRC-32 tells each byte from all others.
    shapes = dict((zlib.crc32(bytes([b])) >> 24, b % SHAPES) for b in range(256))
    last = F.shiftright(F.crc32(F.expr(f"substring({token}, -1, 1)")), 24).cast("int")
    shape = F.element_at(F.array(*(F.lit(shapes[i]) for i in range(256))), last + 1)
    return (shape * hashes + F.crc32(token) % hashes).cast("int")


def bucket_of(token: str, vocab: Vocabulary) -> Column:
    """The bucket of a token that is not near, counted over all shared slots."""
    of_slot = [F.element_at(F.array(*(F.lit(int(x)) for x in numbers)), slot_of(token, vocab.hashes) + 1) for numbers in (1 << vocab.bits, first_buckets(vocab))]
    # The first bits of a hash, as a product that every width of the bits has.
    return (F.floor(F.crc32(token) * of_slot[0] / F.lit(1 << HASH_BITS)) + of_slot[1]).cast("int")


def first_buckets(vocab: Vocabulary) -> np.ndarray:
    """The first bucket of each shared slot."""
    return np.cumsum(1 << vocab.bits) - (1 << vocab.bits)


def shared_slot(word: bytes, hashes: int) -> int:
    """Which of the shared slots holds a token: slots of one last byte lie side by side."""
    return word[-1] % SHAPES * hashes + zlib.crc32(word) % hashes


def biases(vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Log counts of the classes, and of the slots within each class, smoothed as the tokens are."""
    top = vocab.counts[: vocab.own]
    mass = np.zeros(vocab.slots)
    mass[: len(top)] = np.array(top, float) + ALPHA
    mass[vocab.own:] = shared_mass(vocab)
    whole = np.concatenate(([vocab.ends + ALPHA], mass.reshape(-1, WIDTH).sum(1)))
    inside = np.where(mass > 0, np.log(np.maximum(mass, 1e-9)), -30.0).reshape(-1, WIDTH)
    return np.log(np.maximum(whole, 1e-9)).astype(np.float32), inside.astype(np.float32)


def shared_mass(vocab: Vocabulary) -> np.ndarray:
    """Smoothed counts of the shared slots, one unknown token in each of their buckets."""
    return vocab.shared[:, 0] + ALPHA * (vocab.shared[:, 1] + (1 if vocab.bits is None else 1 << vocab.bits))


class Slots(dict):
    """The outcome of each token: its own slot, or the shared one, which is kept for the next time."""

    def __init__(self, vocab: Vocabulary) -> None:
        super().__init__({w: i for i, w in enumerate(vocab.words[: vocab.own], 1)})
        self.first, self.hashes = vocab.own + 1, vocab.hashes
        self.own = len(self)

    def of(self, words: list[bytes]) -> np.ndarray:
        """The outcomes of words in the order of the vocabulary, nothing kept."""
        rest = (self.first + shared_slot(w, self.hashes) for w in words[self.own:])
        return np.fromiter(chain(range(1, self.own + 1), rest), np.int64, len(words))

    def __missing__(self, word: bytes) -> int:
        slot = self.first + shared_slot(word, self.hashes)
        if len(self) < self.own + CACHED:
            self[word] = slot
        return slot


class Ways(NamedTuple):
    """What leads from the shared slots to single tokens.

    A way is a descent through one or two trees. In a tree nodes are numbered from 1, the children of i being 2i and 2i + 1; ``odds`` has the logarithm of
    the right side's counts over the left side's, at the tree's place and the node's number. In the first tree of a slot the leaves are 0 for
    tokens that are not near, and i + 1 for near ones in octave i. Near tokens of an octave, and buckets, are the leaves of a second one.
    """

    odds: np.ndarray
    first_bits: np.ndarray
    outcome: np.ndarray
    octave: np.ndarray
    number: np.ndarray
    near_place: np.ndarray
    far_place: np.ndarray
    bits: np.ndarray
    tail: np.ndarray
    mass: np.ndarray


def _heap(mass: np.ndarray) -> np.ndarray:
    """Log odds of the inner nodes of a tree whose leaves have these counts."""
    odds = np.zeros(len(mass))
    while len(mass) > 1:
        left, right = mass[::2], mass[1::2]
        with np.errstate(divide="ignore", invalid="ignore"):
            both = np.log(right) - np.log(left)
        odds[len(left): 2 * len(left)] = np.clip(np.nan_to_num(both, nan=0.0, posinf=REACH, neginf=-REACH), -REACH, REACH)
        mass = left + right
    return odds


def ways(vocab: Vocabulary) -> Ways:
    """Trees of all shared slots, from counts."""
    own, some = vocab.own, vocab.slots - vocab.own
    outcome = Slots(vocab).of(vocab.words)
    slot = outcome[own:] - own - 1
    bits = np.zeros(some, np.int64) if vocab.bits is None else vocab.bits
    tail = np.zeros(some, np.int64) if vocab.tail is None else vocab.tail
    far = np.zeros(((1 << bits).sum(), 2), np.int64) if vocab.far is None else vocab.far
    mass = far[:, 0] + ALPHA * (far[:, 1] + 1)
    counts = np.array(vocab.counts[own:], float) + ALPHA
    order = np.argsort(slot, kind="stable")
    sizes = np.bincount(slot, minlength=some)
    ends = np.cumsum(sizes)
    # In its slot the near token of number i + 1 = 2 ** octave + number, in the order of the counts.
    place = np.empty(len(slot), np.int64)
    place[order] = np.arange(len(slot)) - (ends - sizes)[slot[order]] + 1
    octave = np.floor(np.log2(np.maximum(place, 1))).astype(np.int64)
    tops = np.array([int(n).bit_length() for n in sizes], np.int64)
    first_bits = np.array([int(n).bit_length() for n in tops], np.int64)
    parts, at = [], 0
    near_place, far_place = np.zeros((2, some), np.int64)
    firsts = np.zeros((some, 32))
    start = np.cumsum(1 << bits) - (1 << bits)
    for s in range(some):
        mine = counts[order[ends[s] - sizes[s]: ends[s]]]
        leaves = np.zeros(1 << int(first_bits[s]))
        buckets = mass[start[s]: start[s] + (1 << int(bits[s]))]
        leaves[0] = buckets.sum()
        near_place[s] = 32 * some + at
        for o in range(int(tops[s])):
            tree = np.zeros(1 << o)
            tokens = mine[(1 << o) - 1: (2 << o) - 1]
            tree[: len(tokens)] = tokens
            leaves[o + 1] = tokens.sum()
            parts.append(_heap(tree))
        far_place[s] = near_place[s] + (1 << int(tops[s])) - 1
        parts.append(_heap(buckets))
        at = far_place[s] - 32 * some + len(buckets)
        firsts[s, : len(leaves)] = _heap(leaves)
    odds = np.concatenate([firsts.ravel(), *parts]).astype(np.float32)
    return Ways(odds, first_bits, outcome, octave, place - (1 << octave), near_place, far_place, bits, tail, mass)


class Rare(NamedTuple):
    """Tokens in shared slots: where they stand, their slots, their leaves and depths in the first and second tree, its place and how many levels have counts."""

    at: np.ndarray
    slot: np.ndarray
    first: np.ndarray
    second: np.ndarray
    depth: np.ndarray
    tree: np.ndarray
    known: np.ndarray

    def part(self, start: int, end: int) -> Rare:
        return Rare(*(x[start:end] for x in self))


class Choices(NamedTuple):
    """Two-way choices: the token of each descent by falling depth, how many reach each level, and for all levels in turn the side taken (1 for right, -1),
    log odds of the counts, places of the weights, and the level below the bucket (less than 0 above, None if there is none).
    """

    token: np.ndarray
    reach: list[int]
    sign: np.ndarray
    base: np.ndarray
    place: np.ndarray
    tail: np.ndarray | None


class Read(NamedTuple):
    """Token streams: outcome, text, place among the near tokens, number in full histories, and where the far tokens stand, these and their buckets."""

    outcome: np.ndarray
    doc: np.ndarray
    place: np.ndarray
    whole: np.ndarray
    far: np.ndarray
    words: pa.Array
    bucket: np.ndarray
    rare: Rare


class Reader:
    """Outcomes and features of token streams."""

    def __init__(self, vocab: Vocabulary, trees: Ways | None = None) -> None:
        self.seen, self.own, self.hashes = vocab.seen, vocab.own, vocab.hashes
        self.trees = ways(vocab) if trees is None else trees
        self.near = pa.array(vocab.words, pa.binary())
        self.outcome_of = np.append(self.trees.outcome, END)
        # In a full history near tokens are told by their place, others by slot and hash.
        self.whole_of = np.append(np.arange(1, len(vocab.words) + 1), END)
        self.first_bucket = np.cumsum(1 << self.trees.bits) - (1 << self.trees.bits)
        self.pairs = vocab.class_rows - 3 * vocab.seen
        self.kind = np.uint16 if vocab.word_rows <= 1 << 16 else np.int64
        self.word_rows = vocab.word_rows
        self.shift = np.uint64(64 - (vocab.deep_rows - 1).bit_length())
        # In a history the shared slots of one last byte are one.
        self.history = np.arange(vocab.seen)
        self.history[vocab.own + 1:] -= np.arange(vocab.slots - vocab.own) % vocab.hashes

    def tokens(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """(outcome, text index) of all tokens, each text closed by its end."""
        return self.read(pa.array(chain.from_iterable(texts), pa.binary()), np.array([len(t) for t in texts], np.int64))[:2]

    def read(self, words: pa.Array, sizes: np.ndarray) -> Read:
        """All tokens of ``split``, each text closed by its end: a word is looked up once, and its place tells the rest."""
        doc, inside = self.places(sizes)
        none = len(self.near)
        found = np.asarray(pc.index_in(words, value_set=self.near).fill_null(none))
        place = np.full(len(doc), none)
        place[inside] = found
        outcome, whole = self.outcome_of[place], self.whole_of[place]
        far_words = words.filter(pa.array(found == none))
        far = np.flatnonzero(inside & (place == none))
        crc, end = hashed(far_words)
        slot = end % SHAPES * self.hashes + crc % self.hashes
        outcome[far] = self.own + 1 + slot
        whole[far] = (slot + 1 << HASH_BITS) + crc
        bucket = self.first_bucket[slot] + (crc >> HASH_BITS - self.trees.bits[slot])
        return Read(outcome, doc, place, whole, far, far_words, bucket, self._rare(outcome, place, crc))

    @staticmethod
    def places(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The text index of all tokens, and which of them are words and not ends."""
        inside = np.ones(sizes.sum() + len(sizes), bool)
        inside[np.cumsum(sizes + 1) - 1] = False
        return np.repeat(np.arange(len(sizes)), sizes + 1), inside

    def _rare(self, outcome: np.ndarray, place: np.ndarray, crc: np.ndarray) -> Rare:
        """All tokens in shared slots; ``crc`` holds the hashes of those not near."""
        t = self.trees
        at = np.flatnonzero(outcome > self.own)
        slot = outcome[at] - self.own - 1
        near = place[at] < len(self.near)
        word = place[at[near]] - self.own
        first = 1 << t.first_bits[slot]
        depth = t.bits[slot] + t.tail[slot]
        second = 1 << depth
        tree, known = t.far_place[slot], t.bits[slot]
        octave = t.octave[word]
        first[near] += octave + 1
        depth[near], known[near] = octave, octave
        second[near] = (1 << octave) + t.number[word]
        tree[near] = t.near_place[slot[near]] + (1 << octave) - 1
        far = ~near
        second[far] += crc >> HASH_BITS - depth[far]
        return Rare(at, slot, first, second, depth, tree, known)

    def features(self, outcome: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Rows of the class weights for each token: last, two skips, and the hashed bigram of the history."""
        last, past = np.zeros((3, len(outcome)), np.int64), self.history.take(outcome)
        for back in (1, 2, 3):
            last[back - 1, back:] = np.where(doc[back:] == doc[:-back], past[:-back], END)
        pair = (last[0] * 40_503 + last[1] * 2_654_435_761 + 12_345) % 2_147_483_647 % self.pairs
        return np.stack((last[0], self.seen + last[1], 2 * self.seen + last[2], 3 * self.seen + pair)).astype(self.kind)

    def full_history(self, read: Read) -> np.ndarray:
        """A hash of the last token, in full, before each rare one."""
        at = read.rare.at
        past = np.maximum(at - 1, 0)
        return mix(np.where((at > 0) & (read.doc[past] == read.doc[at]), read.whole[past], END).astype(np.uint64) * _NODE)

    def choices(self, rare: Rare, history: np.ndarray) -> Choices:
        """All two-way choices on the ways to rare tokens, level by level.

        ``LEVELS`` levels below a node share the row of this node and the history, so that they lie side by side.
        """
        n = len(rare.at)
        depth = np.concatenate((self.trees.first_bits[rare.slot], rare.depth))
        order = np.argsort((255 - depth).astype(np.uint8), kind="stable")
        left, token = depth[order], order % n
        # The two descents of each token by falling depth: those that reach a level are the first.
        reach = (len(left) - np.cumsum(np.bincount(left))[:-1]).tolist()
        leaf, tree = np.concatenate((rare.first, rare.second))[order], np.concatenate((32 * rare.slot, rare.tree))[order]
        known = np.concatenate((self.trees.first_bits[rare.slot], rare.known))[order]
        deepest = int(known[left > known].min(initial=len(reach)))
        key = tree.astype(np.uint64) * _TREE + history[token]
        total, at = sum(reach), 0
        sign, base, place = np.empty(total, np.float32), np.empty(total, np.float32), np.empty(total, np.int64)
        tail = np.full(total, -1, np.int8) if deepest < len(reach) else None
        node = np.ones(len(order), np.int64)
        for level, m in enumerate(reach):
            to, node = slice(at, at + m), node[:m]
            left[:m] -= 1
            side = leaf[:m] >> left[:m]
            sign[to] = side & 1
            self.trees.odds.take(tree[:m] + node, out=base[to], mode="clip")
            inside = level % LEVELS
            if not inside:
                row = key[:m] + node.view(np.uint64) * _NODE
                row >>= self.shift
                row <<= np.uint64(LEVELS)
                row = row.view(np.int64)
                np.add(row, 1, out=place[to])
            else:
                node &= (1 << inside) - 1
                node += row[:m]
                np.add(node, 1 << inside, out=place[to])
            if level >= deepest:
                below = np.flatnonzero(known[:m] <= level)
                base[at + below] = 0
                tail[at + below] = level - known[below]
            at, node = at + m, side
        sign *= 2
        sign -= 1
        return Choices(token, reach, sign, base, place, tail)

    def inner(self, features: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Rows of the word weights for (feature, class)."""
        return ((features[list(INSIDE)].astype(np.int64) * 65_537 + group) * 2_654_435_761 % 4_294_967_291 & (self.word_rows - 1)).astype(self.kind)


def groups(outcome: np.ndarray) -> np.ndarray:
    """The class of each outcome."""
    return np.where(outcome == END, 0, (outcome - 1) // WIDTH + 1)


def _logits(rows: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """For each column of ``rows`` the sum of its weight rows and the bias, kept in range."""
    z = weights.take(rows[0], axis=0)
    z += bias
    more = np.empty_like(z)
    for r in rows[1:]:
        # Rows are in range: the other modes need no copy of their own.
        z += weights.take(r, axis=0, out=more, mode="clip")
    return np.clip(z, -REACH, REACH, out=z)


def softmax(rows: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Probabilities for each column of ``rows``: the sum of its weight rows and the bias, through a softmax."""
    z = _logits(rows, weights, bias)
    np.exp(z, out=z)
    z /= (z @ np.ones(z.shape[1], z.dtype))[:, None]
    return z


def log_chance(rows: np.ndarray, aim: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """The logarithm of the softmax at the outcomes ``aim`` alone."""
    z = _logits(rows, weights, bias)
    own = z[np.arange(len(aim)), aim].astype(float)
    np.exp(z, out=z)
    return own - np.log(z @ np.ones(z.shape[1], z.dtype))


def run_sums(values: np.ndarray, order: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` in ``order``, in runs that end at ``last``: differences of running sums, as many runs are short.

    Rows are laid out by their place in a block of ``BLOCK``, so that the running sums of all blocks grow together, whole rows at a time.
    """
    blocks = -(-len(order) // BLOCK)
    padded = np.zeros(blocks * BLOCK, order.dtype)
    padded[: len(order)] = order
    laid = values.take(padded.reshape(blocks, BLOCK).T.ravel(), axis=0)
    places = laid.reshape(BLOCK, -1)
    for k in range(1, BLOCK):
        places[k] += places[k - 1]
    before = np.zeros((blocks, values.shape[1]), values.dtype)
    np.cumsum(laid[-blocks:-1], axis=0, out=before[1:])
    block, place = np.divmod(last, BLOCK)
    sums = laid.take(place * blocks + block, axis=0)
    sums += before.take(block, axis=0)
    sums[1:] -= sums[:-1].copy()
    return sums


def learn(rows: np.ndarray, aim: np.ndarray, weights: np.ndarray, bias: np.ndarray, past: np.ndarray, seen: np.ndarray) -> None:
    """One gradient step (summed by row, scaled by the row's past gradients) towards the outcomes ``aim``."""
    error = softmax(rows, weights, bias)
    error[np.arange(len(aim)), aim] -= 1
    for r in rows:
        order = np.argsort(r, kind="stable")
        ordered = r.take(order)
        last = np.flatnonzero(np.append(ordered[1:] != ordered[:-1], True))
        used = ordered[last].astype(np.intp)
        slope = run_sums(error, order, last)
        grown = past.take(used, axis=0)
        grown += slope * slope
        past[used] = grown
        grown += 1
        slope *= RATE
        slope /= np.sqrt(grown, out=grown)
        weights[used] = np.subtract(weights.take(used, axis=0), slope, out=slope)
        times = last + 1
        times[1:] -= last[:-1] + 1
        times += seen.take(used)
        seen[used] = times


def learn_choices(found: Choices, weights: np.ndarray, past: np.ndarray, seen: np.ndarray, spare: np.ndarray) -> None:
    """One gradient step of two-way choices, scaled as in ``learn``; ``spare`` is 0 for each weight and stays so."""
    place, flat = found.place, weights.reshape(-1)
    now = flat.take(place)
    error = now + found.base
    error *= found.sign
    np.exp(np.minimum(error, REACH, out=error), out=error)
    error += 1
    np.divide(found.sign, error, out=error)
    np.negative(error, out=error)
    spare, past = spare.reshape(-1), past.reshape(-1)
    np.add.at(spare, place, error)
    slope = spare.take(place)
    spare[place] = 0
    # A weight that comes several times is given the same values each time.
    grown = past.take(place)
    grown += slope * slope
    past[place] = grown
    grown += 1
    slope *= RATE
    slope /= np.sqrt(grown, out=grown)
    now -= slope
    flat[place] = now
    rows = place[place & (1 << LEVELS) - 1 == 1] >> LEVELS
    np.add.at(seen, rows, 1)


def _steps(outcome: np.ndarray, features: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for at in range(0, len(outcome), STEP_TOKENS):
        yield outcome[at: at + STEP_TOKENS], features[:, at: at + STEP_TOKENS]


def _rare_steps(reader: Reader, read: Read) -> Iterator[tuple[Rare, Choices]]:
    """The rare tokens of each step and their choices."""
    full = reader.full_history(read)
    for at in range(0, len(read.outcome), STEP_TOKENS):
        a, b = np.searchsorted(read.rare.at, (at, at + STEP_TOKENS))
        if a < b:
            part = read.rare.part(a, b)
            yield part, reader.choices(part, full[a:b])


class Trainer:
    """Gradient steps from given weights, over one shard."""

    def __init__(self, reader: Reader, start: Weights) -> None:
        self.reader, self.start = reader, start
        self.tables = self.classes, self.words, self.deep = start.classes.copy(), start.words.copy(), start.deep.copy()
        self.past = tuple(np.zeros_like(t) for t in self.tables)
        self.seen = tuple(np.zeros(len(t), np.int64) for t in self.tables)
        self.spare = np.zeros_like(self.deep)

    def feed(self, words: pa.Array, sizes: np.ndarray) -> None:
        read = self.reader.read(words, sizes)
        outcome, doc = read[:2]
        for aim, rows in _steps(outcome, self.reader.features(outcome, doc)):
            group = groups(aim)
            learn(rows, group, self.classes, self.start.class_bias, self.past[0], self.seen[0])
            plain = np.flatnonzero(aim != END)
            if len(plain):
                inner = self.reader.inner(rows[:, plain], group[plain])
                learn(inner, (aim[plain] - 1) % WIDTH, self.words, self.start.word_bias[group[plain] - 1], self.past[1], self.seen[1])
        for _, found in _rare_steps(self.reader, read):
            learn_choices(found, self.deep, self.past[2], self.seen[2], self.spare)


def initial(vocab: Vocabulary) -> Weights:
    """No history yet: the counts alone."""
    class_bias, word_bias = biases(vocab)
    sizes = (vocab.class_rows, vocab.classes), (vocab.word_rows, WIDTH), (vocab.deep_rows, 1 << LEVELS)
    classes, words, deep = (np.zeros(size, np.float32) for size in sizes)
    return Weights(classes, words, class_bias, word_bias, deep)


_PART = "range int, shard int, weights binary, seen binary"


def _round(texts: DataFrame, shards: int, vocab: Broadcast, weights: Weights) -> Weights:
    """One round over (text, shard, mark): every shard trained from ``weights``, the results averaged by row."""
    shared = texts.sparkSession.sparkContext.broadcast(weights)
    names = ("classes", "words", "deep")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, trainer, now = None, None, None

        def done() -> Iterator[pa.RecordBatch]:
            for number, (table, seen) in enumerate(zip(trainer.tables, trainer.seen)):
                # The weights of choices are many and seldom 0: they go as half floats, not compressed.
                kind, level = (np.float16, 0) if names[number] == "deep" else (np.float32, 1)
                parts = [zlib.compress(x.astype(kind).tobytes(), level) for x in np.array_split(table, RANGES)]
                counts = [zlib.compress(x.tobytes(), 1) for x in np.array_split(seen, RANGES)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(number * RANGES, (number + 1) * RANGES), pa.int32()), pa.array([now] * RANGES, pa.int32()), pa.array(parts, pa.binary()), pa.array(counts, pa.binary())],
                    ["range", "shard", "weights", "seen"],
                )

        for part, _ in byte_slices(batches, "text"):
            if reader is None:
                reader = Reader(*vocab.value)
            numbers = np.asarray(part.column(part.schema.get_field_index("shard")))
            for shard in np.unique(numbers).tolist():
                if shard != now:
                    if trainer is not None:
                        yield from done()
                    trainer, now = Trainer(reader, shared.value), shard
                trainer.feed(*split(part.column(part.schema.get_field_index("text")).filter(pa.array(numbers == shard))))
        if trainer is not None:
            yield from done()

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        often: dict[int, np.ndarray] = {}
        for batch in batches:
            for r, _, packed, counts in zip(*(c.to_pylist() for c in batch.columns)):
                seen = np.frombuffer(zlib.decompress(counts), np.int64).astype(float)
                kind = np.float16 if names[r // RANGES] == "deep" else np.float32
                moved = np.frombuffer(zlib.decompress(packed), kind).reshape(len(seen), -1) * seen[:, None]
                total[r], often[r] = total.get(r, 0) + moved, often.get(r, 0) + seen
        for r in total:
            base = np.array_split(getattr(shared.value, names[r // RANGES]), RANGES)[r % RANGES]
            mean = np.where(often[r][:, None] > 0, total[r] / np.maximum(often[r], 1)[:, None], base).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([zlib.compress(mean.tobytes(), 1)], pa.binary())], ["range", "weights"])

    dealt = texts.repartition(shards, "shard").sortWithinPartitions("shard", "mark").select("text", "shard")
    parts = dealt.mapInArrow(train, _PART).repartition(2 * RANGES, "range").sortWithinPartitions("range", "shard")
    found = {r.range: r.weights for r in parts.mapInArrow(average, "range int, weights binary").collect()}
    out = {}
    for number, name in enumerate(names):
        blocks = np.array_split(getattr(weights, name), RANGES)
        for k, block in enumerate(blocks):
            if (r := number * RANGES + k) in found:
                blocks[k] = np.frombuffer(zlib.decompress(found[r]), np.float32).reshape(block.shape)
        out[name] = np.concatenate(blocks)
    return weights._replace(**out)


def train(texts: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS, shard_tokens: int = SHARD_TOKENS, trees: Ways | None = None) -> Weights:
    """Weights from one pass over (doc_id, text), each round over its own part of the texts."""
    weights = initial(vocab)
    if not vocab.total:
        return weights
    trees = ways(vocab) if trees is None else trees
    known = texts.sparkSession.sparkContext.broadcast((vocab._replace(counts=[], far=None), trees))
    shards = max(1, -(-vocab.total // (rounds * shard_tokens)))
    mark = F.xxhash64("text", "doc_id")
    marked = texts.select("text", mark.alias("mark"))
    for number in range(rounds):
        part = marked.where(F.pmod("mark", F.lit(rounds)) == number)
        part = part.withColumn("shard", F.pmod(F.shiftrightunsigned("mark", 20), F.lit(shards)).cast("int"))
        weights = _round(part, shards, known, weights)
    return weights


def log_outcomes(reader: Reader, weights: Weights, outcome: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Natural log probability of each slot, given the features of its history."""
    out = np.zeros(len(outcome))
    for at, (aim, rows) in enumerate(_steps(outcome, features)):
        group = groups(aim)
        p = log_chance(rows, group, weights.classes, weights.class_bias)
        plain = np.flatnonzero(aim != END)
        if len(plain):
            inner = reader.inner(rows[:, plain], group[plain])
            p[plain] += log_chance(inner, (aim[plain] - 1) % WIDTH, weights.words, weights.word_bias[group[plain] - 1])
        out[at * STEP_TOKENS: at * STEP_TOKENS + len(aim)] = np.maximum(p, LEAST)
    return out


def log_ways(reader: Reader, weights: Weights, read: Read) -> tuple[np.ndarray, np.ndarray]:
    """Natural log probability of the way from the slot to the token (0 in own slots) or its bucket, and the weights of all levels below it for each far token.

    The latter, in ``FINE`` parts of one, fit a byte.
    """
    out, tilts = np.zeros(len(read.outcome)), np.zeros((len(read.outcome), int(reader.trees.tail.max(initial=0))), np.int8)
    for part, found in _rare_steps(reader, read):
        tilt = weights.deep.take(found.place)
        z = found.base + tilt
        z *= found.sign
        np.negative(z, out=z)
        np.exp(np.minimum(z, REACH, out=z), out=z)
        z += 1
        if found.tail is not None:
            below = np.flatnonzero(found.tail >= 0)
            z[below] = 1
            owner = part.at[np.concatenate([found.token[:m] for m in found.reach])[below]]
            tilts[owner, found.tail[below]] = np.clip(np.rint(tilt[below] * FINE), -127, 127)
        # The product of a few levels is in range: one logarithm for all of them.
        p, at = np.zeros(len(found.token)), 0
        for level, m in enumerate(found.reach):
            if level % LEVELS == 0:
                product = np.ones(m)
            product[:m] *= z[at: at + m]
            at += m
            if level % LEVELS == LEVELS - 1 or level == len(found.reach) - 1:
                p[: len(product)] -= np.log(product)
        out[part.at] = np.bincount(found.token, p, len(part.at))
    return out, tilts[read.far]


_ROWS = "rid long, doc_id long, n_tokens long, n_known long, counted double, model double, token binary, tilts binary"


def _scored(texts: DataFrame, vocab: Vocabulary, trees: Ways, weights: Weights) -> DataFrame:
    """One row a text with what its task can tell, and one for each token whose count is not at hand."""
    shared = texts.sparkSession.sparkContext.broadcast((vocab._replace(far=None), trees, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, trees, model = shared.value
        reader = Reader(known, trees)
        logs = np.log10(np.append(np.array(known.counts, float), 0.0) + ALPHA)  # the last one for tokens not at hand
        logs[-1] = 0.0
        whole = len(known.words) + (known.ends > 0) == known.distinct
        rid = TaskContext.get().partitionId() << 33
        end = float(np.log10(known.ends + ALPHA))
        for part, _ in byte_slices(batches, "text"):
            read = reader.read(*split(part.column(1)))
            doc, n = read.doc, part.num_rows
            count, near = logs[read.place], read.place < len(logs) - 1
            steps, tilts = log_ways(reader, model, read)
            gain = (log_outcomes(reader, model, read.outcome, reader.features(read.outcome, doc)) + steps) / np.log(10)
            # Far tokens count as the unknown one of their bucket until they have met their counts.
            gain[read.far] -= np.log10(trees.mass[read.bucket])
            docs = np.arange(rid, rid + n)
            rid += n
            columns = [
                pa.array(docs), part.column(0), pa.array(np.bincount(doc, minlength=n)),
                pa.array(np.bincount(doc, near, n).astype(np.int64) + (known.ends > 0)),
                pa.array(np.bincount(doc, count, n) + end), pa.array(np.bincount(doc, gain, n)), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)
            far = len(read.words)
            if not whole and far:
                more = {"rid": pa.array(docs[doc[read.far]]), "token": read.words, "tilts": _packed(tilts)}
                yield pa.RecordBatch.from_arrays([more.get(c, pa.nulls(far, t)) for c, t in zip(names, kinds)], names)

    names = [c.split()[0] for c in _ROWS.split(", ")]
    kinds = [{"long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}[c.split()[1]] for c in _ROWS.split(", ")]
    return texts.select("doc_id", "text").mapInArrow(run, _ROWS)


def _packed(tilts: np.ndarray) -> pa.Array:
    """A binary of each row."""
    ends = np.arange(len(tilts) + 1, dtype=np.int32) * tilts.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(tilts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(tilts))])


def _unpacked(tilts: pa.Array, tails: int) -> np.ndarray:
    """The rows of ``_packed``, one for each binary that is not null."""
    some = tilts.cast(pa.binary()).drop_null()
    start = some.slice(0, 1).buffers()[1] if len(some) else None
    if start is None or not tails:
        return np.zeros((len(some), tails), np.int8)
    first = np.frombuffer(start, np.int32)[some.offset]
    return np.frombuffer(some.buffers()[2], np.int8)[first: first + len(some) * tails].reshape(len(some), tails)


def inside_buckets(code: np.ndarray, first: np.ndarray, n: np.ndarray, bits: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What leads from the buckets to their tokens, in the order of (code, token), from their counts (0 if unknown).

    ``code`` holds the bucket and the hash, ``bits`` and ``tail`` are those of the slot. The results are the natural log probability of the known
    tokens over that of the unknown one times the token's share of its leaf, and for each level the counts of the other side over the taken one's.
    """
    mass, crc = np.where(n > 0, n + ALPHA, 0.0), code & (1 << HASH_BITS) - 1

    def sums(depth: np.ndarray) -> np.ndarray:
        node = crc >> HASH_BITS - bits - depth
        starts = np.flatnonzero(np.append(True, first[1:] | (node[1:] != node[:-1])))
        return np.repeat(np.add.reduceat(mass, starts), np.diff(np.append(starts, len(mass))))

    above = sums(np.zeros_like(tail))
    with np.errstate(divide="ignore"):
        lead = np.log(above / ALPHA)
    others = np.zeros((len(code), int(tail.max(initial=0))))
    for level in range(others.shape[1]):
        here = sums(np.minimum(level + 1, tail))
        # The last one is a sum of tenths: what is left of an empty side is no count.
        rest = np.where(above - here < ALPHA / 2, 0.0, above - here)
        others[:, level] = rest / np.maximum(here, ALPHA)
        above = here
    return lead + np.log(np.maximum(mass, ALPHA) / np.maximum(above, ALPHA)), others


def _met(rows: DataFrame, counts: DataFrame, vocab: Vocabulary) -> DataFrame:
    """(rid, gain, more, tilt) of texts: what the tokens that are counted, but not near, add to both scores.

    Counts and occurrences are dealt and sorted by bucket and hash, the counts (as negative numbers) first.
    """
    bits, tail, start = vocab.bits, vocab.tail, first_buckets(vocab)
    tails = int(tail.max(initial=0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []

        def found(part: pa.Table) -> pa.RecordBatch:
            code, value = np.asarray(part.column("code")), np.asarray(part.column("value"))
            token = part.column("token").combine_chunks()
            new = np.append(True, code[1:] != code[:-1])
            alike = np.flatnonzero(~new)
            new[alike] |= ~np.asarray(pc.equal(token.take(pa.array(alike)), token.take(pa.array(alike - 1))))
            starts, group = np.flatnonzero(new), np.cumsum(new) - 1
            n, bucket = np.maximum(-value[starts], 0), code[starts] >> HASH_BITS
            slot = np.searchsorted(start, bucket, side="right") - 1
            lead, others = inside_buckets(code[starts], np.append(True, bucket[1:] != bucket[:-1])[: len(starts)], n, bits[slot], tail[slot])
            of = value >= 0
            tilts = _unpacked(part.column("tilts").combine_chunks(), tails)
            mine = group[of]
            known = n[mine] > 0
            mine, tilts, rid = mine[known], tilts[known].astype(float) / FINE, value[of][known]
            crc, depth = code[starts][mine] & (1 << HASH_BITS) - 1, bits[slot][mine]
            tilt = lead[mine]
            for level in range(others.shape[1]):
                right = crc >> np.maximum(HASH_BITS - 1 - depth - level, 0) & 1
                tilt -= np.log1p(others[mine, level] * np.exp(np.where(right, -tilts[:, level], tilts[:, level])))
            gain = np.log10(n[mine] + ALPHA) - np.log10(ALPHA)
            return pa.RecordBatch.from_arrays([pa.array(rid), pa.array(gain), pa.array(tilt / np.log(10))], ["rid", "gain", "tilt"])

        for batch in batches:
            kept.append(batch)
            bucket = np.asarray(batch.column(0)) >> HASH_BITS
            if len(bucket) and (cut := int(np.searchsorted(bucket, bucket[-1]))):
                yield found(pa.Table.from_batches([*kept[:-1], batch.slice(0, cut)]))
                kept = [batch.slice(cut)]
        if sum(len(b) for b in kept):
            yield found(pa.Table.from_batches(kept))

    counted = counts.where(F.col("n") < F.lit(vocab.least)).select("token", (-F.col("n")).alias("value"), F.lit(None).cast("binary").alias("tilts"))
    both = counted.unionByName(rows.where("token is not null").select("token", F.col("rid").alias("value"), "tilts"))
    bucket = bucket_of("token", vocab)
    dealt = both.repartition(bucket).withColumn("code", bucket.cast("long") * F.lit(1 << HASH_BITS) + F.crc32("token"))
    steps = dealt.sortWithinPartitions("code", "token", "value").select("code", "token", "value", "tilts").mapInArrow(run, "rid long, gain double, tilt double")
    return steps.groupBy("rid").agg(F.sum("gain").alias("gain"), F.count(F.lit(1)).alias("more"), F.sum("tilt").alias("tilt"))


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every whole text.

    ``held_out`` (over doc_id) says which rows the model may not learn from. Scores are log10.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    learnt = texts.where(~F.coalesce(held_out, F.lit(False)))
    counts = stored(count_tokens(learnt), "counts")
    vocab = vocabulary(counts, learnt.count(), NEAR)
    trees = ways(vocab)
    rows = stored(_scored(texts, vocab, trees, train(learnt, vocab, trees=trees)), "scored")
    joined = rows.where("token is null").drop("token", "tilts").join(_met(rows, counts, vocab), "rid", "left")
    gain, more, tilt = F.coalesce("gain", F.lit(0.0)), F.coalesce("more", F.lit(0)), F.coalesce("tilt", F.lit(0.0))
    ends = int(vocab.ends > 0)
    unseen = (F.col("n_tokens") - F.lit(1) - (F.col("n_known") - F.lit(ends))) * float(np.log10(ALPHA))  # tokens not at hand, as if unknown
    floor = float(np.log10(vocab.total + ALPHA * (vocab.distinct + 1)))
    return joined.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "n_tokens", (F.col("n_known") + more).cast("long").alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("counted") + unseen + gain - F.col("n_tokens") * floor).alias("base_score"),
        (F.col("model") + unseen + tilt).alias("score"),
    )
