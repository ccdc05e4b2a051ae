import random

import numpy as np
from pyspark.sql import functions as F

from pressgauge.llm import substring
from pressgauge.llm.common import Words


def brute(rows, n):
    first = {}
    for doc_id, text in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - n + 1):
            key = tuple(words[i: i + n])
            first[key] = min(first.get(key, doc_id), doc_id)
    out = {}
    for doc_id, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - n + 1):
            if first[tuple(words[i: i + n])] < doc_id:
                gone.update(range(i, i + n))
        out[doc_id] = (len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode())
    return out


def passages(make_words, count=80):
    rng, shared = random.Random(2), [make_words(900 + i, 30) for i in range(4)]
    rows = []
    for i in range(count):
        words = make_words(i, rng.randint(0, 80), 12)
        for _ in range(rng.randint(0, 3)):
            at, cut = rng.randint(0, len(words)), rng.choice(shared)
            words[at:at] = cut[rng.randint(0, 10):]
        rows.append((count - i, rng.choice([" ", "\n", " \t"]).join(words)))
    return [*rows, (500, rows[0][1]), (501, rows[0][1]), (502, None), (503, ""), (504, "a " * 40)]


def test_against_brute_force(spark, make_words):
    rows = passages(make_words)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for n in (13, 7):
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring.repeats(docs, min_words=n).collect()}
        assert got == brute(rows, n)


def test_spans_are_maximal(spark, make_words):
    rows = passages(make_words)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for row in substring.repeats(docs).collect():
        assert sum(s.words for s in row.spans) == row.n_removed and all(s.words >= 13 for s in row.spans)
        assert all(a.start + a.words < b.start for a, b in zip(row.spans, row.spans[1:]))


def test_same_rows_in_one_task_and_in_many(spark, make_words):
    docs = spark.createDataFrame(passages(make_words), "doc_id long, text string")
    one, many = (substring.repeats(docs.repartition(n, F.lit(n) if n == 1 else "doc_id")) for n in (1, 40))
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_span_hash_depends_on_words_only():
    words = Words([b"x a b c", b"", b"long-prefix a b c a b"])
    at = words.valid(2)
    by = {}
    for i, h in zip(at.tolist(), words.span(at, 2).tolist()):
        by.setdefault(words.buffer[words.starts[i]: words.ends[i + 1]], set()).add(h)
    assert len(by) == 5 and all(len(h) == 1 for h in by.values()) and len({*map(tuple, by.values())}) == 5
    assert words.counts.tolist() == [4, 0, 6] and np.all(words.doc[at] == words.doc[at + 1])


def test_repeated_rows_nulls_and_columns(spark, no_documents):
    assert substring.repeats(no_documents).count() == 0
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(2, text, "r"), (2, text, "s"), (None, text, "t"), (3, f"own {text}", None), (4, "  a  b ", "u"), (5, None, "v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    got = sorted(map(tuple, substring.cleaned_documents(docs).collect()), key=str)
    assert got == sorted([(2, text, "r"), (2, text, "s"), (None, text, "t"), (3, "own", None), (4, "  a  b ", "u"), (5, None, "v")], key=str)


def test_long_words_that_collide_as_polynomials_stay_apart(spark):
    """A Thue-Morse word and its complement have one hash as polynomials modulo 2**64, whatever the base."""
    word = "a"
    while len(word) < 4096:
        word += "".join("b" if c == "a" else "a" for c in word)
    other = "".join("b" if c == "a" else "a" for c in word)
    shared = " ".join(f"w{i}" for i in range(12))
    rows = [(1, f"{shared} {word}"), (2, f"{shared} {other}"), (3, f"{shared} {word}")]
    found = {r.doc_id: r.n_removed for r in substring.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: 0, 2: 0, 3: 13}


def test_very_long_text(spark, make_words):
    words = make_words(3, 300_000, 500)
    rows = [(1, " ".join(words)), (2, " ".join(["new", *words[1000:1040], "end"]))]
    found = {r.doc_id: r.n_removed for r in substring.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[2] == 40
