import hashlib
import random
import re

from pyspark.sql import functions as F

from pressgauge.llm import spotsigs


def brute_chains(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    out = set()
    for i, word in enumerate(words):
        content = [w for w in words[i + 1:] if w not in spotsigs.STOPS][: spotsigs.CHAIN]
        if word in spotsigs.ANCHORS and len(content) == spotsigs.CHAIN:
            out.add(" ".join([word, *content]))
    return out


def sample(make_words, count=120):
    rng = random.Random(1)
    rows = []
    for i in range(count):
        words = make_words(i % 60, rng.randint(0, 60), 40)
        for _ in range(len(words) // 3):
            words.insert(rng.randrange(len(words)), rng.choice(["the", "The,", "of", "und", "was", "für", "is."]))
        rows.append((rng.randint(0, 5000) * 7, rng.choice([" ", "\n", ", "]).join(words)))
    return list(dict(rows).items()) + [(40_000, None), (40_001, ""), (40_002, "..."), (40_003, "lone")]


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def signs(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return brute_chains(text) or ({" ".join(words)} if words else set())


def test_against_brute_force(spark, make_words):
    rows = sample(make_words)
    got = {r.doc_id: r for r in spotsigs.edited_likeness(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    ordered = sorted(rows, reverse=True)
    seen = {}
    for (doc_id, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = got[doc_id]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert len(row.fingerprint) == 8 * len(signs(text)) and len(row.edited_fingerprint) == 8 * len(signs(edited))
        assert abs(row.near_edited - jaccard(signs(text), signs(edited))) < 1e-9
        assert abs(row.near_next - jaccard(signs(text), signs(after))) < 1e-9
        assert seen.setdefault(frozenset(signs(text)), row.fingerprint) == row.fingerprint
    assert len(set(seen.values())) == len(seen)


def test_pruning_by_length_keeps_what_counts(spark):
    rng = random.Random(2)
    rows = [(rng.sample(range(30), rng.randint(1, 25)), rng.sample(range(30), rng.randint(1, 25))) for _ in range(300)]
    frame = spark.createDataFrame([(sorted(a), sorted(b)) for a, b in rows], "a array<long>, b array<long>")
    near = spotsigs.length_class("a", 0.8) - spotsigs.length_class("b", 0.8)
    got = frame.select(spotsigs.likeness("a", "b").alias("whole"), spotsigs.likeness("a", "b", 0.8).alias("pruned"), F.abs(near).alias("gap")).collect()
    for (a, b), r in zip(rows, got):
        assert abs(r.whole - jaccard(set(a), set(b))) < 1e-9
        assert r.pruned == r.whole if r.whole >= 0.8 else r.pruned in (0.0, r.whole)
        assert r.whole < 0.8 or r.gap <= 1


def test_next_row_over_blocks(spark):
    ids = random.Random(3).sample(range(-500, 100_000), 300)
    rows = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    got = {r.doc_id: r.next_text for r in spotsigs.with_next(rows, "doc_id", [], ["text"], block_ids=64).collect()}
    ordered = sorted(ids, reverse=True)
    assert got == {a: f"t{b}" for a, b in zip(ordered, ordered[1:] + ordered[:1])}


def test_no_python_on_the_main_path(spark, make_words):
    docs = spark.createDataFrame(sample(make_words)[:5], "doc_id long, text string")
    plan = spotsigs.edited_likeness(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan.split("== Physical Plan ==")[1])


def test_long_runs_of_stop_words(spark):
    text = "the of is " * 50_000 + "hant ering the lone"
    row = spotsigs.fingerprints(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert len(row.signs) == len(brute_chains("the of is hant ering the lone")) == 3


def test_odd_rows(spark, odd_documents, no_documents):
    got = spotsigs.edited_likeness(odd_documents).collect()
    assert len(got) == odd_documents.count()
    assert spotsigs.edited_likeness(odd_documents.limit(1)).first().near_next == 1.0
    assert spotsigs.edited_likeness(no_documents).count() == 0
