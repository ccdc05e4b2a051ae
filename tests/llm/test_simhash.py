import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from pressgauge.llm import simhash
from pressgauge.llm.components import components, forest


def brute_fingerprint(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i: i + k]) for i in range(max(1, len(words) - k + 1))]
    hashed = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashed) * 2 > len(hashed))


def brute_components(marks, distance):
    marks = list(marks)
    root = {d: d for d, _ in marks}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(marks):
        for b, y in marks[i + 1:]:
            if (x ^ y).bit_count() <= distance:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {d: find(d) for d, _ in marks}


def near_texts(make_words):
    rows, base = [], make_words(1, 300)
    rng = random.Random(3)
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = "zzz" + str(rng.randrange(40))
        rows.append((100 - i, " ".join(words)))
    rows += [(200 + i, " ".join(make_words(50 + i, 40))) for i in range(30)]
    return [*rows, (300, None), (301, " \n"), (302, "One two"), (303, "one TWO"), (300, None)]


def test_against_brute_force(spark, make_words):
    rows = near_texts(make_words)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for distance in (1, 3, 4, 6):
        got = simhash.near_duplicates(docs, shingle=4, distance=distance).collect()
        assert len(got) == len(rows)
        marks = {d: brute_fingerprint(t, 4) for d, t in rows}
        assert {r.doc_id: r.fp & (1 << 64) - 1 for r in got} == marks
        assert {r.doc_id: r.component_id for r in got} == brute_components(marks.items(), distance)


def test_links_of_crowded_keys(spark, monkeypatch):
    rng = random.Random(5)
    center = rng.getrandbits(63)
    marks = {center ^ sum(1 << b for b in rng.sample(range(63), rng.randint(0, 4))) for _ in range(300)}
    heads = spark.createDataFrame([(m,) for m in marks], "fp long")
    expected = brute_components([(m, m) for m in marks], 4)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    edges = simhash.links(heads, 4)
    assert edges.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > 64).count() == 0
    got = {r.node: r.root for r in components(edges).collect()}
    groups = {}
    for m in marks:
        groups.setdefault(expected[m], set()).add(got.get(m, m))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_segments_differ_by_at_most_one_bit():
    for distance in range(1, 8):
        parts = simhash.segments(distance)
        assert sum(w for _, w in parts) == 64 and distance // len(parts) <= 1


def test_forest_and_components(spark):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 400, 250), rng.integers(0, 400, 250)
    expected = brute_like(a, b)
    node, root = forest(a, b)
    assert {**{x: x for x in set(a) | set(b)}, **dict(zip(node.tolist(), root.tolist()))} == expected
    frame = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b)], "a long, b long")
    loops = {x for x in expected if expected[x] == x and list(expected.values()).count(x) == 1}
    assert {r.node: r.root for r in components(frame).collect()} == {k: v for k, v in expected.items() if k not in loops}


def brute_like(a, b):
    root = {int(x): int(x) for x in [*a, *b]}
    for _ in range(len(root)):
        for x, y in zip(a.tolist(), b.tolist()):
            root[x] = root[y] = min(root[x], root[y])
    return root


def test_empty_and_extra_columns(spark, no_documents, odd_documents):
    assert simhash.near_duplicates(no_documents).count() == 0
    kept = simhash.kept_documents(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "7", "None"]


def test_copies_without_id_follow_a_document_with_one(spark):
    same = " ".join(f"w{i}" for i in range(40))
    rows = [(5, same, 0), (None, same, 1), (7, same, 2), (None, "a lone text without id", 3), (None, "a lone text without id", 4), (1, "other words entirely here", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp long")
    kept = simhash.kept_documents(docs)
    assert kept.columns == docs.columns and sorted(r.fp for r in kept.collect()) == [0, 3, 4, 5]
