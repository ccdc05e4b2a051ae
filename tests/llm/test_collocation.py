"""Collocations against brute force, in both spellings of the windows."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pressgauge.llm import collocation


def brute(rows, longest, least, top, share):
    words, counts = Counter(), {}
    for text, lang in rows:
        own = counts.setdefault(lang if lang is not None else "und", Counter())
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            tokens = [t for t in re.split("[ \t]+", piece) if t]
            words[lang if lang is not None else "und"] += len(tokens)
            for k in range(1, longest + 1):
                own.update(tuple(tokens[i:i + k]) for i in range(len(tokens) - k + 1))
    out = []
    for lang, f in counts.items():
        n, found = words[lang], []
        some = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in some.items():
            score, cut = min(((1000 * a * n) // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            held = any(
                len(q) > len(p) and 100 * b >= share * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in some.items()
            )
            if not held:
                found.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


@pytest.fixture()
def texts(make_words):
    rows = [(" ".join(make_words(i, 40, 25)), ["a", "b", None][i % 3]) for i in range(60)]
    rows += [("one two three four five six seven. " * 6, "a"), ("ONE Two\tthree!four five", "a"), (None, "a"), ("", None), ("  \t ", "b")]
    rows += [("ab ab ab ab ab ab ab", "b"), ("Ünïcödé  Ünïcödé ß ß, Ünïcödé Ünïcödé ß ß", "und"), ("x,y;z:u!v?w\nx\x0by\x0cz\rx", "b c")]
    rows += [("\x01 \x02 \x01 \x02 ab\x01 ab", "b c"), ("ba ke li mo. " * 30, "a"), ("ba ke li mo. " * 30, "a")]
    return rows


@pytest.mark.parametrize("dictionary", [1 << 20, 0])
def test_equal_brute_force(spark, monkeypatch, texts, dictionary):
    monkeypatch.setattr(collocation, "CHUNK_BYTES", 300)
    monkeypatch.setattr(collocation, "FLUSH_WORDS", 20)
    df = spark.createDataFrame([(i, t, lang, "x", 1) for i, (t, lang) in enumerate(texts)], "doc_id long, text string, lang string, phrase string, n int")
    for least, top, share in ((4, 2000, 100), (3, 7, 70)):
        found = collocation.collocations(df, least=least, top=top, share=share, dictionary=dictionary)
        assert sorted(tuple(r) for r in found.collect()) == brute(texts, 5, least, top, share)


def test_empty_table(spark):
    df = spark.createDataFrame([], "text string, lang string")
    assert collocation.collocations(df).collect() == []
    df = spark.createDataFrame([("rare words only", "a")], "text string, lang string")
    assert collocation.collocations(df).collect() == []


def test_long_text_is_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(collocation, "CHUNK_BYTES", 50)
    text = b"one two three. four five, " * 40 + b"tail" * 40 + b" end"
    chunks = list(collocation._chunks([text, b"", b"next"]))
    assert len(chunks) > 10 and sum(chunks, []) == list(collocation._chunks([text, b"", b"next"]))[0] + sum(chunks[1:], [])
    joined = " ".join(t.decode() for c in chunks for t in c)
    assert joined.count("one two three \n four five \n") == 40 and joined.endswith("end \n \n next")


@pytest.mark.parametrize("step", [1, 3, 1000])
def test_prefixes_that_may_be_frequent_survive_any_cut_of_the_stream(step):
    """Whatever the ranges and batches, every frequent prefix keeps its whole count."""
    rng = np.random.default_rng(step)
    columns = [rng.integers(1, 4, 400)]
    for _ in range(4):
        columns.append(np.where((columns[-1] > 0) & (rng.random(400) < 0.8), rng.integers(1, 4, 400), 0))
    keep = columns[1] > 0
    columns, counts = collocation.combined([c[keep] for c in columns], np.ones(keep.sum(), np.int64))
    place = np.searchsorted([30, 31, 60], np.arange(len(counts)), side="right")
    table = pa.table(
        [pa.array(place, pa.int32()), *[pa.array(c, pa.int64(), mask=c == 0) for c in columns], pa.array(counts)],
        names=["range", *collocation.names(5), "c"],
    )
    cutter, out = collocation._Cutter(5, 6), []
    for at in range(0, len(counts), step):
        out += cutter.feed(table.slice(at, step)).to_pylist()
    out += cutter.feed(table.slice(0, 0), last=True).to_pylist()
    full, cut = Counter(), Counter()
    for found, rows in ((full, table.to_pylist()), (cut, out)):
        for row in rows:
            words = [row[w] for w in collocation.names(5) if row[w] is not None]
            for k in range(2, len(words) + 1):
                found[tuple(words[:k])] += row["c"]
    frequent = {p: n for p, n in full.items() if n >= 6}
    assert {p: n for p, n in cut.items() if n >= 6} == frequent and sum(cut.values()) < sum(full.values())


def test_plan_rolls_up_the_window_columns(spark):
    rows = spark.createDataFrame([(1, 2, None, None, None, 3)], "w1 long, w2 long, w3 long, w4 long, w5 long, c long")
    text = collocation.marginal_counts(rows, 5, 1)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" in text and "spark_grouping_id" in text
