"""Folded document tables, whole vocabularies, stop words in place, linear verdicts and the day jobs."""

import random
from collections import Counter

import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

import __spark_entry__ as driver
from conftest import SMALL
from pressgauge.functions import text as text_fn, vectors
from pressgauge.operators import credibility, joins, tokens
from pressgauge.plans import daily
from pressgauge.sinks import documents, files as sink
from pressgauge.sources import folder_topic

ROW = "news_id string, likes long, title string, at timestamp"


def batch(spark, rows, *fields):
    frame = spark.createDataFrame([(*r[:-1], r[-1]) for r in rows], "news_id string, likes long, title string, at long")
    return frame.select("news_id", *fields, F.timestamp_seconds("at").alias("at"))


def read(spark, path):
    return sorted(map(tuple, documents.read_documents(spark, path, order=["at"]).select("news_id", "likes", "title", "at", "lastModified").collect()), key=repr)


def test_folding_changes_no_document_and_bounds_the_folders(spark, tmp_path):
    path, rng = f"{tmp_path}/docs", random.Random(6)
    for number in range(9):
        rows = [(f"n{rng.randint(0, 12)}", rng.randint(0, 99), rng.choice(["a", "b", None]), rng.randint(0, 5)) for _ in range(6)]
        rows = list({r[0]: r for r in rows}.values())
        documents.upsert(batch(spark, rows, "likes"), path, number, modified=F.col("at"), writer="social")
        documents.upsert(batch(spark, rows, "title"), path, number, modified=F.col("at"), writer="articles")
        if number % 3 == 2:
            before = read(spark, path)
            assert documents.fold(spark, path, 2, order=["at"]) and read(spark, path) == before
    for writer in ("social", "articles"):
        assert len(list((tmp_path / "docs" / f"writer={writer}").glob("batch_id=*"))) == 2
    # The last batch is still there, so sending it again changes nothing.
    before = read(spark, path)
    documents.upsert(batch(spark, [("zz", 1, "z", 9)], "likes"), path, 8, modified=F.col("at"), writer="social")
    assert read(spark, path) == before and not documents.fold(spark, path, 2, order=["at"])


def test_ranks_of_a_whole_vocabulary(spark):
    rng = random.Random(1)
    counts = {f"w{i}": rng.choice([1, 1, 1, 2, 3, 50]) for i in range(500)}
    df = spark.createDataFrame(list(counts.items()), "token string, n long").repartition(7)
    found = {r.token: r.idx for r in tokens.rank_all(df).collect()}
    assert found == {w: i for i, w in enumerate(sorted(counts, key=lambda w: (-counts[w], w)), 1)}
    assert tokens.rank_all(df.where("false")).collect() == []


def test_stop_words_go_without_a_shuffle(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a", "c"]), (2, []), (3, None)], "id long, tokens array<string>")
    stop = spark.createDataFrame([("a",), ("c",), ("a",), (None,)], "token string")
    kept = tokens.drop_stop_words(df, "tokens", stop)
    assert {r.id: r.tokens for r in kept.collect()} == {1: ["b"], 2: [], 3: None}
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
    assert tokens.drop_stop_words(df, "tokens", stop.where("false")).collect() == df.collect()
    with pytest.raises(ValueError):
        tokens.drop_stop_words(df, "tokens", stop, most=1)


def test_default_stop_list_query(spark):
    found = {r.doc_id: r.tokens for r in driver.queries()["default_stop_filter"](spark, SMALL).collect()}
    stop = set(StopWordsRemover.loadDefaultStopWords("english"))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", text_fn.letter_tokens(F.col("text")).alias("t")).collect()
    assert found == {r.doc_id: " ".join(w for w in r.t or [] if w not in stop) for r in docs}


@pytest.mark.parametrize("small", [True, False])
def test_linear_verdicts_by_hand(spark, small):
    terms = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "x", 5), (3, "b", 3)], "id long, token string, n long")
    weights = spark.createDataFrame([("a", 1.5), ("b", -1.0)], "token string, weight double")
    docs = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id long")
    found = {r.id: (round(r.probability, 6), r.prediction, r.label_text) for r in credibility.predict_linear(terms, weights, ["id"], intercept=0.5, docs=docs, small=small).collect()}
    assert found == {1: (0.924142, 1, "Fake"), 2: (0.622459, 1, "Fake"), 3: (0.075858, 0, "True"), 4: (0.622459, 1, "Fake")}


def test_random_vectors_repeat_and_spread(spark):
    rows = spark.range(400).select(vectors.pseudo_random_vector(F.col("id").cast("string"), 5).alias("v"), vectors.pseudo_random_vector(F.col("id").cast("string"), 5, 1).alias("other"))
    found = [r for r in rows.collect()]
    values = [x for r in found for x in r.v]
    assert found == rows.collect() and all(0 <= x < 1 for x in values) and len(set(values)) == 2000
    assert 0.45 < sum(values) / 2000 < 0.55 and all(r.v != r.other for r in found)


def test_a_day_is_published_once(spark, tmp_path):
    seeds = spark.createDataFrame([("a", "k", "u1", "t1", 1, 2), ("b", "k", "u2", "t2", 3, 4)], "news_id string, news_keyword string, news_url string, tweet_url string, retweet_count long, favorite_count long")
    for day in ("2024-01-01", "2024-01-02"):
        sink.write_day(seeds, f"{tmp_path}/seeds", day)
        for _ in range(2):
            daily.publish_seeds(spark, f"{tmp_path}/seeds", f"{tmp_path}/s", f"{tmp_path}/n", day)
    assert Counter(r.key for r in folder_topic.read(spark, f"{tmp_path}/s").collect()) == {"a": 2, "b": 2}
    assert {r.value for r in folder_topic.read(spark, f"{tmp_path}/n").collect()} == {'{"news_id":"a","news_url":"u1"}', '{"news_id":"b","news_url":"u2"}'}


def test_texts_are_dealt_by_their_measured_size(spark, monkeypatch):
    monkeypatch.setattr(tokens, "PART_BYTES", 200)
    docs = spark.createDataFrame([(i % 400, "a b a") for i in range(800)] + [(1, None)], "doc_id int, text string")
    rows = tokens.token_rows(docs, ["doc_id"], by_id=True)
    assert rows.rdd.getNumPartitions() == 20
    counted = tokens.term_counts(rows, ["doc_id"])
    assert {(r.doc_id, r.token): r.n for r in counted.collect()} == {(i, t): n for i in range(400) for t, n in (("a", 4), ("b", 2))}
    assert tokens.token_rows(docs.where("false"), ["doc_id"], by_id=True).collect() == []


def test_whole_counts_shuffle_texts_and_compute_them_once(spark, monkeypatch):
    query = driver.queries()["term_counts_all"]
    expected = sorted(map(tuple, query(spark, SMALL).collect()))
    monkeypatch.setattr(joins, "is_small", lambda table: False)
    monkeypatch.setattr(joins, "hot_keys", lambda *a: pytest.fail("the counts are computed once more"))
    found = query(spark, SMALL)
    assert not [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning(doc_id" in line and "token" in line]
    assert sorted(map(tuple, found.collect())) == expected
