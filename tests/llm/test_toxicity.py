import random

import numpy as np
from pyspark.sql import functions as F

from pressgauge.llm import toxicity


def corpus(spark, make_words, count=400):
    rng, rows, labels = random.Random(3), [], []
    for i in range(count):
        words = make_words(i, rng.randint(5, 60), 300)
        toxic = int(i % 5 == 0)
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["grumpf", "wretchling", "qwolx"]))
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    rows += [(count, None), (count + 1, ""), (3, rows[3][1]), (None, "grumpf grumpf wretchling qwolx")]
    labels += [(5, 1), (6, None), (None, 1), (10**6, 1)]
    return (
        spark.createDataFrame([(d, t, 0.5) for d, t in rows], "doc_id long, text string, toxicity double"),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
    )


def test_held_out_accuracy(spark, make_words):
    docs, labels = corpus(spark, make_words)
    model = toxicity.fit(docs, labels, toxicity.fold() != 1)
    got = toxicity.scores(docs, model).withColumn("held", toxicity.fold() == 1).collect()
    assert len(got) == docs.count()
    known = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}
    held = [(r.toxicity >= 0.7, known[r.doc_id] == 1) for r in got if r.held and r.doc_id in known]
    assert len(held) > 100 and np.mean([a == b for a, b in held]) > 0.97
    assert all(0 <= r.toxicity <= 1 for r in got)
    empty = [r.toxicity for r in got if not r.text]
    assert len(set(empty)) == 1 and empty[0] < 0.7
    kept = toxicity.kept_documents(docs, labels)
    assert kept.columns == docs.columns and {r.toxicity for r in kept.collect()} == {0.5}


def test_labels_of_the_held_out_fold_are_not_used(spark, make_words):
    docs, labels = corpus(spark, make_words)
    flipped = labels.withColumn("toxic", F.when(toxicity.fold() == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.fit(docs, x, toxicity.fold() != 1) for x in (labels, flipped))
    assert all(np.array_equal(a, b) for a, b in zip(one, two))


def test_frequencies_against_brute_force(spark):
    texts = ["AbC  abc", "xyz", "", "ab\nc"]
    pairs = {}
    for doc, bucket in toxicity.grams([t.encode() for t in texts]):
        for d, b in zip(doc.tolist(), bucket.tolist()):
            pairs.setdefault(d, []).append(b)
    tidy = [" " + " ".join(t.lower().split()) + " " for t in texts]
    assert {d: len(v) for d, v in pairs.items()} == {i: n for i, t in enumerate(tidy) if (n := sum(max(0, len(t) - k + 1) for k in (3, 4, 5)))}
    assert len(set(pairs[3])) == len({t[i: i + k] for t in [tidy[3]] for k in (3, 4, 5) for i in range(len(t) - k + 1)})


def test_without_labels_or_documents(spark, no_documents):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert {r.toxicity for r in toxicity.scores(docs, toxicity.fit(docs, none, F.lit(True))).collect()} == {0.5}
    assert len({r.toxicity for r in toxicity.scores(docs, toxicity.fit(docs, one, F.lit(True))).collect()}) == 1
    assert toxicity.scores(no_documents, toxicity.fit(no_documents, one, F.lit(True))).count() == 0


def features(texts):
    """The different feature buckets of each text."""
    out = [set() for _ in texts]
    for doc, bucket in toxicity.grams([t.encode() for t in texts]):
        for d, b in zip(doc.tolist(), bucket.tolist()):
            out[d].add(b)
    return out


def test_ratios_and_weights_against_brute_force(spark, make_words, monkeypatch):
    """Kept features, their log-count ratios and the fitted weights, from dense sums over all rows."""
    monkeypatch.setattr(toxicity, "BLOCK", 50)
    docs, labels = corpus(spark, make_words, 120)
    known = {}
    for r in labels.collect():
        if r.toxic is not None and r.doc_id is not None:
            known[r.doc_id] = max(known.get(r.doc_id, 0), r.toxic)
    rows = [(known[r.doc_id], r.text or "") for r in docs.collect() if r.doc_id in known]
    y, found = np.array([label for label, _ in rows]), features([t for _, t in rows])
    positives, negatives = int(y.sum()), int((1 - y).sum())
    ratios = {}
    for b in set().union(*found):
        has = np.array([b in f for f in found])
        one, zero = int(has[y == 1].sum()), int(has[y == 0].sum())
        both = (one + zero) / len(y)
        spread = np.sqrt(max(both * (1 - both), 1e-9) * (1 / positives + 1 / negatives))
        if one + zero >= 3 and abs(one / positives - zero / negatives) / spread > 4:
            ratios[b] = np.log((one + 1) / (positives + 2) / ((zero + 1) / (negatives + 2)))
    model = toxicity.fit(docs, labels, F.lit(True))
    assert model.buckets.tolist() == sorted(ratios) and len(ratios) > 5
    x = np.array([[ratios[b] if b in f else 0.0 for b in sorted(ratios)] for f in found])
    w, b0 = np.zeros(x.shape[1]), np.log((positives + 1) / (negatives + 1))
    vw, vb, momentum = w, b0, 1.0
    step = 4 / (np.mean((x * x).sum(1) + 1) * 4 + 1 / len(y))
    for _ in range(300):
        error = (1 / (1 + np.exp(-(x @ vw + vb))) - y) / len(y)
        new_w, new_b = vw - step * (x.T @ error + vw / len(y)), vb - step * error.sum()
        later = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        vw, vb = new_w + (momentum - 1) / later * (new_w - w), new_b + (momentum - 1) / later * (new_b - b0)
        w, b0, momentum = new_w, new_b, later
    assert np.allclose(model.weights, w * [ratios[b] for b in sorted(ratios)], atol=1e-8) and np.isclose(model.intercept, b0)


def test_ties_at_the_feature_cut_keep_the_smaller_buckets(spark):
    rows = [(i, "qqq zzz xxx" if i % 2 else "nothing") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    every = toxicity.fit(docs, labels, F.lit(True))
    assert toxicity.fit(docs, labels, F.lit(True), max_features=5).buckets.tolist() == every.buckets[:5].tolist()


def test_very_long_text(spark, make_words):
    docs, labels = corpus(spark, make_words, 100)
    long = spark.createDataFrame([(999, "plain words " * 400_000 + "grumpf wretchling qwolx " * 3)], "doc_id long, text string")
    found = toxicity.scores(long, toxicity.fit(docs, labels, F.lit(True))).first()
    assert 0 <= found.toxicity <= 1
