import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pressgauge.llm import maxent


def corpus(count=300):
    """Sentences in which each word fixes the next, so that history tells."""
    rng, rows = random.Random(1), []
    for i in range(count):
        words = []
        for _ in range(rng.randint(0, 30)):
            a = rng.randrange(40)
            words += [f"first{a}", f"second{a}", "and" if a % 2 else "OR"]
        if rng.random() < 0.3:
            words.append(f"once{i}")
        rows.append((i, " ".join(words)))
    return [*rows, (1000, None), (1001, " "), (4, rows[4][1]), (None, "first1 unheard")]


def brute(rows):
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows}
    tokens = [(d, [*(t or "").lower().split(), None]) for d, t in rows]
    count = Counter(w for d, words in tokens if not held[d] for w in words)
    total = sum(count.values())
    floor = math.log10(total + 0.1 * (len(count) + 1))
    return [
        (d, held[d], len(words), sum(count[w] > 0 for w in words), total, sum(math.log10(count[w] + 0.1) - floor for w in words))
        for d, words in tokens
    ]


@pytest.mark.parametrize("near", [maxent.NEAR, 1100, 5])
def test_base_scores_against_brute_force(spark, monkeypatch, near):
    monkeypatch.setattr(maxent, "NEAR", near)
    rows = corpus()
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, score int").repartition(3)
    got = sorted((r for r in maxent.score(docs, maxent.fold() == 0).collect()), key=lambda r: (str(r.doc_id), r.n_tokens))
    expected = sorted(brute(rows), key=lambda r: (str(r[0]), r[2]))
    assert [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got] == [e[:5] for e in expected]
    assert np.allclose([r.base_score for r in got], [e[5] for e in expected], atol=1e-6)
    assert all(r.score < 0 for r in got)


def test_history_helps_on_held_out_texts(spark):
    docs = spark.createDataFrame([*corpus(900), (2000, "first1 second1 and " * 20000)], "doc_id long, text string").repartition(2)
    held = [r for r in maxent.score(docs, maxent.fold() == 0).collect() if r.held_out]
    assert len(held) > 50 and sum(r.score for r in held) > 0.8 * sum(r.base_score for r in held)


def vocabulary(words):
    counts = sorted(Counter(words).items(), key=lambda c: (-c[1], c[0]))
    vocab = maxent.Vocabulary([w for w, _ in counts], [n for _, n in counts], 50, sum(n for _, n in counts) + 50, len(counts) + 1, maxent.class_count(len(counts)), np.zeros((0, 2)))
    shared = np.zeros((vocab.slots - vocab.own, 2), np.int64)
    for w, n in counts[vocab.own:]:
        shared[maxent.shared_slot(w, vocab.hashes)] += n, 1
    return vocab._replace(shared=shared)


def drawn(vocab, seed=3):
    rng = np.random.default_rng(seed)
    start = maxent.initial(vocab)
    return start._replace(classes=rng.normal(size=start.classes.shape).astype("f4"), words=rng.normal(size=start.words.shape).astype("f4"))


def test_the_model_is_normalised_over_all_tokens():
    rng = random.Random(2)
    vocab = vocabulary([f"w{int(rng.paretovariate(0.5))}".encode() for _ in range(20000)])
    assert len(vocab.words) > vocab.own + 100
    weights, reader = drawn(vocab), maxent.Reader(vocab)
    history = np.array([1, 5, vocab.own + 3, vocab.slots, maxent.END])
    features = reader.features(np.append(history, 0), np.zeros(6, np.int64))
    every = np.arange(vocab.slots + 1)
    for i in range(6):
        p = np.exp(maxent.log_outcomes(reader, weights, every, np.repeat(features[:, i: i + 1], len(every), axis=1)))
        assert abs(p.sum() - 1) < 1e-4
    # The tokens of a shared slot, and one unknown token, have all of its mass.
    mass = maxent.shared_mass(vocab)
    for slot in (ord("1") % 64, ord("7") % 64):
        own = [n for w, n in zip(vocab.words[vocab.own:], vocab.counts[vocab.own:]) if maxent.shared_slot(w, vocab.hashes) == slot]
        assert np.isclose(sum(n + 0.1 for n in own) + 0.1, mass[slot])


def plain_softmax(z):
    z = np.exp(z - z.max())
    return z / z.sum()


def test_one_score_by_hand():
    vocab = vocabulary([b"a"] * 9 + [b"b"] * 5 + [b"c"] * 3)
    weights, reader = drawn(vocab), maxent.Reader(vocab)
    outcome, doc = reader.tokens([[b"a", b"b", b"zz"], [b"c"]])
    assert outcome.tolist()[:2] == [1, 2] and outcome[2] == vocab.own + 1 + ord("z") % 64 and vocab.hashes == 1 and outcome[3:].tolist() == [0, 3, 0]
    found = maxent.log_outcomes(reader, weights, outcome, reader.features(outcome, doc))
    for i in range(len(outcome)):
        last = [int(outcome[i - k]) if i >= k and doc[i - k] == doc[i] else 0 for k in (1, 2, 3)]
        pair = (last[0] * 40_503 + last[1] * 2_654_435_761 + 12_345) % 2_147_483_647 % (vocab.class_rows - 3 * vocab.seen)
        rows = [last[0], vocab.seen + last[1], 2 * vocab.seen + last[2], 3 * vocab.seen + pair]
        group = 0 if outcome[i] == 0 else 1 + (outcome[i] - 1) // 32
        p = plain_softmax(weights.class_bias + sum(weights.classes[r] for r in rows))[group]
        if group:
            inner = [(r * 65_537 + int(group)) * 2_654_435_761 % 4_294_967_291 % vocab.word_rows for r in (rows[0], rows[1], rows[3])]
            p *= plain_softmax(weights.word_bias[group - 1] + sum(weights.words[r] for r in inner))[(outcome[i] - 1) % 32]
        assert abs(found[i] - np.log(p)) < 1e-4


def test_one_update_by_hand():
    rng = np.random.default_rng(1)
    weights, bias = rng.normal(size=(9, 4)).astype("f4"), rng.normal(size=4).astype("f4")
    rows, aim = rng.integers(0, 9, (2, 30)).astype(np.uint16), rng.integers(0, 4, 30)
    past, seen, expected = np.zeros_like(weights), np.zeros(9, np.int64), weights.astype(float)
    error = np.array([plain_softmax(bias + weights[a] + weights[b]) for a, b in rows.T]) - np.eye(4)[aim]
    squares = np.zeros((9, 4))
    for r in rows:
        slope = np.array([error[r == k].sum(axis=0) for k in range(9)])
        squares += slope ** 2
        expected -= maxent.RATE * slope / np.sqrt(squares + 1)
    maxent.learn(rows, aim, weights, bias, past, seen)
    assert np.allclose(weights, expected, atol=1e-5) and seen.tolist() == np.bincount(rows.ravel(), minlength=9).tolist()


@pytest.mark.parametrize("count", [1, 63, 64, 65, 1000])
def test_run_sums_of_any_number_of_rows(count):
    rng = np.random.default_rng(count)
    values, keys = rng.normal(size=(count, 5)).astype("f4"), np.minimum(rng.zipf(1.5, count), 50)
    order = np.argsort(keys, kind="stable")
    last = np.flatnonzero(np.append(np.diff(keys[order]) != 0, True))
    assert np.allclose(maxent.run_sums(values, order, last), [values[keys == k].sum(axis=0) for k in np.unique(keys)], atol=1e-4)


def test_log_chances_and_outcomes_in_one_pass():
    vocab = vocabulary([b"a"] * 9 + [b"b"] * 5 + [f"w{i}".encode() for i in range(900)])
    slots = maxent.Slots(vocab)
    assert len(vocab.words) > vocab.own and slots.of(vocab.words).tolist() == [slots[w] for w in vocab.words]
    rng = np.random.default_rng(4)
    rows, weights, bias, aim = rng.integers(0, 9, (3, 30)), rng.normal(size=(9, 4)).astype("f4"), rng.normal(size=4).astype("f4"), rng.integers(0, 4, 30)
    assert np.allclose(maxent.log_chance(rows, aim, weights, bias), np.log(maxent.softmax(rows, weights, bias)[np.arange(30), aim]), atol=1e-5)


def test_scores_do_not_depend_on_the_layout(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    runs = [
        sorted((str(r.doc_id), r.n_tokens, r.score) for r in maxent.score(docs.repartition(n).sortWithinPartitions(F.rand(n)), maxent.fold() == 0).collect())
        for n in (1, 6)
    ]
    assert [r[:2] for r in runs[0]] == [r[:2] for r in runs[1]] and np.allclose([r[2] for r in runs[0]], [r[2] for r in runs[1]], atol=1e-9)


def test_more_rounds_and_shards_still_learn(spark, monkeypatch):
    monkeypatch.setattr(maxent, "STEP_TOKENS", 200)
    docs = spark.createDataFrame(corpus(900), "doc_id long, text string")
    counts = maxent.count_tokens(docs).persist()
    vocab = maxent.vocabulary(counts, docs.count())
    for rounds, shard in ((1, 10**6), (3, 3000)):
        weights = maxent.train(docs, vocab, rounds, shard)
        reader = maxent.Reader(vocab)
        outcome, doc = reader.tokens([(r.text or "").lower().encode().split() for r in docs.limit(200).collect()])
        features = reader.features(outcome, doc)
        before, after = (maxent.log_outcomes(reader, w, outcome, features).sum() for w in (maxent.initial(vocab), weights))
        assert after > 0.9 * before


def test_the_model_grows_with_the_vocabulary():
    sizes = [maxent.Vocabulary([], [], 0, 0, n, maxent.class_count(n), np.zeros((0, 2))) for n in (10**4, 10**6, 10**9)]
    assert sizes[0].slots < sizes[1].slots < sizes[2].slots and sizes[2].word_rows > sizes[0].word_rows


def test_empty_table_and_no_training(spark, no_documents):
    assert maxent.score(no_documents, maxent.fold() == 0).count() == 0
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    row = maxent.score(docs, maxent.fold() >= 0).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 3, 0, 0) and abs(row.base_score) < 1e-9


def spread(vocab, near):
    """A vocabulary whose words beyond the first ``near`` are not at hand, and the (token, count) of these."""
    rest = list(zip(vocab.words, vocab.counts))[near:]
    slots = np.array([maxent.shared_slot(w, vocab.hashes) for w, _ in rest])
    bits, tail = maxent.depths(np.bincount(slots, minlength=vocab.slots - vocab.own))
    vocab = vocab._replace(words=vocab.words[:near], counts=vocab.counts[:near], bits=bits, tail=tail)
    far = np.zeros(((1 << bits).sum(), 2), np.int64)
    for (w, n), s in zip(rest, slots):
        far[maxent.first_buckets(vocab)[s] + (zlib.crc32(w) >> 32 - int(bits[s]))] += n, 1
    return vocab._replace(far=far), rest


def test_every_token_of_a_shared_slot_is_an_outcome_and_all_add_up_to_one(monkeypatch):
    monkeypatch.setattr(maxent, "BUCKETS", 200)
    rng = random.Random(5)
    vocab, rest = spread(vocabulary([f"w{int(rng.paretovariate(0.4)) % 9000}".encode() for _ in range(30000)]), 900)
    assert len(rest) > 1000 and vocab.tail.max() > 1
    weights, reader = drawn(vocab), maxent.Reader(vocab)
    weights = weights._replace(deep=np.random.default_rng(6).normal(size=weights.deep.shape).astype("f4"))
    near = vocab.words[vocab.own:]
    codes = []
    for w, n in rest:
        s = maxent.shared_slot(w, vocab.hashes)
        codes.append(((int(maxent.first_buckets(vocab)[s]) + (zlib.crc32(w) >> 32 - int(vocab.bits[s])) << 32) + zlib.crc32(w), w, n, s))
    codes.sort()
    code, slot = np.array([c[0] for c in codes]), np.array([c[3] for c in codes])
    bucket = code >> 32
    lead, others = maxent.inside_buckets(code, np.append(True, bucket[1:] != bucket[:-1]), np.array([c[2] for c in codes]), vocab.bits[slot], vocab.tail[slot])
    shares = []
    for history in (b"w1", b"w2", codes[0][1], b"unheard"):
        read = reader.read(pa.array([w for t in near + [c[1] for c in codes] for w in (history, t)], pa.binary()), np.full(len(near) + len(codes), 2))
        way, tilts = maxent.log_ways(reader, weights, read)
        way = way[1::3]
        tilts = tilts[-len(codes):] if history in vocab.words[:900] else tilts[-2 * len(codes):][1::2]
        p = np.zeros(vocab.slots - vocab.own)
        np.add.at(p, reader.trees.outcome[vocab.own:] - vocab.own - 1, np.exp(way[: len(near)]))
        # A far token: its bucket as the unknown one, then what the counts of the bucket tell.
        unknown = np.exp(way[len(near):]) * 0.1 / reader.trees.mass[bucket]
        depth, rise = vocab.bits[slot], lead.copy()
        for level in range(others.shape[1]):
            right = (code & 0xFFFFFFFF) >> np.maximum(31 - depth - level, 0) & 1
            rise -= np.log1p(others[:, level] * np.exp(np.where(right, -1, 1) * tilts[:, level] / maxent.FINE))
        share = unknown * np.exp(rise)
        np.add.at(p, slot, share)
        first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        np.add.at(p, slot[first], unknown[first])
        # Only slots whose buckets all hold a counted token are whole here.
        whole = [s for s in set(slot.tolist()) if len(set(bucket[slot == s].tolist())) == 1 << vocab.bits[s]]
        assert len(whole) > 3 and np.allclose(p[whole], 1, atol=1e-3)
        shares.append(share)
    assert np.abs(np.log(shares[0] / shares[1])).mean() > 0.1


@pytest.mark.parametrize("near", [maxent.NEAR, 700])
def test_the_history_moves_rare_tokens_of_one_slot(spark, monkeypatch, near):
    monkeypatch.setattr(maxent, "NEAR", near)
    rows, words = [], [f"x{i}e" for i in range(40)]
    for i in range(600):
        rows.append((1000 + i, " ".join(f"filler{(i * 7 + k) % 700}s" for k in range(40))))
    for i in range(240):
        rows.append((5000 + i, " ".join(f"filler{i % 40}s {words[i % 40]}" for _ in range(4))))
    # All of the words end alike and share a slot; after filler k comes word k and no other.
    rows += [(1, "filler3s x3e"), (2, "filler3s x9e"), (3, "filler9s x9e"), (4, "filler9s x3e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    score = {r.doc_id: r.score for r in maxent.score(docs, F.col("doc_id") < 10).collect() if r.doc_id and r.doc_id < 10}
    assert score[1] - score[2] + score[3] - score[4] > 0.2
