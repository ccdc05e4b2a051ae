import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressgauge.functions import text as text_fn
from pressgauge.operators import credibility, features, pooling


@pytest.fixture(scope="module")
def vocab(spark):
    return spark.createDataFrame([("a", 1), ("b", 2)], "token string, idx int")


def index(spark, vocab, docs, max_sentences=None, **how):
    df = spark.createDataFrame(docs, "id int, s array<string>")
    return features.index_rows(features.word_rows(df, ["id"], F.col("s"), max_sentences), vocab, ["id"], **how)


def test_matrix_hand_case(spark, vocab):
    rows = index(spark, vocab, [(1, ["a x b", "x"])])
    full = features.matrix_lengths(features.matrix(rows, ["id"], max_sentences=2, max_words=4)).first()
    assert full.matrix == [[1, 2, 0, 0], [0, 0, 0, 0]]
    assert full.sentence_lengths == [2, 0] and full.doc_length == 1
    assert features.lengths(rows, ["id"]).first().asDict() == {"id": 1, "doc_length": 1, "n_words": 2, "longest_sentence": 2}


@pytest.mark.parametrize("small", [True, False])
def test_limits_count_known_words_only(spark, vocab, small):
    rows = index(spark, vocab, [(1, ["x " * 150 + "a " * 120] + ["b"] * 150)], max_sentences=100, max_words=100, small=small)
    assert rows.where("sent_pos = 0").count() == 100
    assert rows.agg(F.max("sent_pos")).first()[0] == 99
    assert rows.where("sent_pos = 0").agg(F.min("word_pos"), F.max("word_pos")).first()[:] == (0, 99)


def test_vector_table(spark, vocab):
    known = spark.createDataFrame([("a", [1.0, 2.0])], "token string, vector array<float>")
    full = {r.token: r for r in features.vector_table(vocab, known, 2).collect()}
    assert full["a"].vector == [1.0, 2.0] and full["a"].found
    assert len(full["b"].vector) == 2 and not full["b"].found
    assert features.vector_table(vocab, known, 2).where("token = 'b'").first().vector == full["b"].vector


def test_labels(spark, rows):
    docs = spark.createDataFrame([("u",), ("v",)], "url string")
    labels = spark.createDataFrame([("u", True)], "url string, label boolean")
    assert rows(features.join_labels(docs, labels, "url", "label")) == [("u", 1, [1, 0])]
    assert rows(features.unlabelled(docs, labels, "url")) == [("v",)]


def test_folds_split_everything_once(spark):
    docs = features.with_folds(spark.range(1000), "id")
    assert docs.select("fold").distinct().count() == 5
    sizes = [tuple(part.count() for part in features.split_fold(docs, k)) for k in range(5)]
    assert all(a + b == 1000 for a, b in sizes) and sum(b for _, b in sizes) == 1000


def attention(width, units=3, scale=1.0, seed=1):
    r = random.Random(seed)
    return pooling.Attention(
        tuple(tuple(r.uniform(-1, 1) for _ in range(units)) for _ in range(width)),
        tuple(r.uniform(-1, 1) for _ in range(units)), tuple(scale * r.uniform(-1, 1) for _ in range(units)),
    )


def expected_pool(x, a):
    s = a.scores(x)
    e = np.exp(s - s.max())
    return e @ x / e.sum()


@pytest.mark.parametrize("scale", [1.0, 1000.0])
def test_pool_and_weights(spark, scale):
    a = attention(4, scale=scale)
    assert (a.bound > pooling.SAFE_BOUND) == (scale > 1)
    x = np.random.default_rng(0).normal(size=(300, 4))
    df = spark.createDataFrame([(i, i % 3 if i % 2 else 0, [float(v) for v in row]) for i, row in enumerate(x)], "id int, g int, v array<double>")
    groups = np.array([i % 3 if i % 2 else 0 for i in range(300)])
    for row in pooling.pool(df, ["g"], "v", a).collect():
        assert row.pooled == pytest.approx(expected_pool(x[groups == row.g], a), abs=1e-9)
    sums = pooling.weights(df, ["g"], "v", a).groupBy("g").agg(F.sum("alpha").alias("s"), F.count("*").alias("n")).collect()
    assert all(r.s == pytest.approx(1.0) for r in sums) and sum(r.n for r in sums) == 300


def test_pool_hand_case(spark):
    # Scores 0 and 1: tanh(x0 * 0 + ...) is steered by a large weight on the second component.
    a = pooling.Attention(((0.0,), (50.0,)), (0.0,), (1.0,))
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0])], "g int, v array<double>")
    assert pooling.pool(df, ["g"], "v", a).first().pooled == pytest.approx([0.268941, 0.731059], abs=1e-6)


def test_whole_texts_by_default(spark, vocab):
    rows = index(spark, vocab, [(1, ["a " * 150] + ["b"] * 150)])
    assert rows.count() == 300
    full = features.matrix(rows, ["id"]).first().matrix
    assert len(full) == 151 and {len(line) for line in full} == {150} and full[150] == [2] + [0] * 149


def test_repeated_vocabulary_rows_count_once(spark):
    twice = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "token string, idx int")
    rows = index(spark, twice, [(1, ["a b"])])
    assert sorted(r.idx for r in rows.collect()) == [2, 3]


def test_lowest_scores_and_unknown_indexes(spark, vocab):
    rows = index(spark, vocab, [(1, ["a b"]), (2, ["b"])])
    flat = pooling.Attention(((0.0,), (0.0,)), (-50.0,), (1000.0,))
    assert flat.bound > pooling.SAFE_BOUND
    table = spark.createDataFrame([(1, [1.0, 0.0])], "idx int, vector array<double>")
    found = {r.id: r.pooled for r in pooling.document_vectors(rows, table, ["id"], flat, flat).collect()}
    assert found == {1: pytest.approx([1.0, 0.0])}
    assert pooling.document_vectors(rows, table.limit(0), ["id"], flat, flat).count() == 0


def test_two_level_vectors_agree(spark, vocab):
    rows = index(spark, vocab, [(1, ["a b a", "b"]), (2, ["a"]), (3, ["x", "b a"])])
    full = spark.createDataFrame([(1, [1.0, 0.0, 2.0]), (2, [0.5, -1.0, 0.0])], "idx int, vector array<double>")
    words, sents = attention(3, seed=2), attention(3, seed=3)
    fast = {r.id: r.pooled for r in pooling.document_vectors(rows, full, ["id"], words, sents, small=True).collect()}
    slow = {r.id: r.pooled for r in pooling.document_vectors(rows, full, ["id"], words, sents, small=False).collect()}
    assert fast.keys() == slow.keys() == {1, 2, 3}
    for key in fast:
        assert fast[key] == pytest.approx(slow[key], abs=1e-9)
    assert fast[2] == pytest.approx([1.0, 0.0, 2.0])


def test_directions(spark):
    df = spark.createDataFrame([([1.0], [2.0])], "f array<double>, b array<double>")
    assert df.select(pooling.join_directions(F.col("f"), F.col("b")).alias("v")).first().v == [1.0, 2.0]


def test_train_predict_evaluate(spark):
    docs = spark.createDataFrame([(i, ["fake", "lies"] if i % 2 else ["true", "facts"], i % 2, [float(i % 2), 1.0]) for i in range(60)],
                                 "id int, tokens array<string>, label int, vec array<double>")
    for vector in (None, "vec"):
        model = credibility.train(docs, vector=vector)
        scored = credibility.predict(model, docs, ["id", "label"], vector)
        assert {(r.label, r.label_text) for r in scored.collect()} == {(1, "Fake"), (0, "True")}
        assert credibility.evaluate(scored) == 1.0
        report = credibility.accuracy_and_loss(scored, "label", F.col("prediction"), F.col("probability")).first()
        assert (report.n_docs, report.n_correct, report.accuracy) == (60, 60, 1.0) and report.loss < 0.2


def test_loss_is_clamped(spark):
    df = spark.createDataFrame([(1, 1, 0.0)], "label int, prediction int, p double")
    assert credibility.accuracy_and_loss(df, "label", F.col("prediction"), F.col("p")).first().loss == pytest.approx(34.5, abs=0.1)


def test_external_model_gets_batches(spark):
    df = spark.range(100).select("id", F.array(F.col("id").cast("double")).alias("x")).coalesce(1)

    def load():
        def run(block):
            assert len(block) <= 20
            return (block[:, 0] > 50).astype(int)

        return run

    assert credibility.predict_external(df, load, "x").where("prediction = 1").count() == 49


def test_word_sequence_feeds_the_matrix(spark, vocab):
    df = spark.createDataFrame([(1, "A, b. b's! a")], "id int, text string")
    words = features.word_rows(df, ["id"], text_fn.sentences(F.col("text")))
    assert [r.token for r in words.orderBy("sent_pos", "pos").collect()] == ["a", "b", "b's", "a"]


def test_pooling_keeps_one_fixed_width_row_per_group(spark):
    a = attention(4)
    x = np.random.default_rng(5).normal(size=(900, 4))
    df = spark.createDataFrame([(i % 300, [float(v) for v in row]) for i, row in enumerate(x)], "g int, v array<double>")
    pooled = pooling.pool(df, ["g"], "v", a)
    # More than 128 groups, from which on an object aggregation sorts its input rows.
    plan = pooled._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    assert {r.g: r.pooled for r in pooled.collect()} == {g: pytest.approx(expected_pool(x[g::300], a), abs=1e-9) for g in range(300)}
