import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pressgauge.operators import engagement, joins, sentiment


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame([("good", 2.0), ("great", 3.0), ("bad", -2.5)], "token string, valence double")


def compound(total):
    return round(total / math.sqrt(total * total + 15), 4)


def test_scores(spark, lexicon, rows):
    df = spark.createDataFrame([(1, "Good, GREAT day"), (2, "nothing"), (3, ""), (4, "bad bad")], "id int, t string")
    scored = sentiment.score_texts(df, ["id"], "t", lexicon)
    assert rows(scored, "id") == [(1, compound(5.0)), (2, 0.0), (3, 0.0), (4, compound(-5.0))]


def test_sentence_scores_keep_empty_sentences(spark, lexicon, rows):
    df = spark.createDataFrame([(1, "good. x. bad.")], "id int, t string")
    scored = sentiment.collect_scores(sentiment.score_sentences(df, ["id"], "t", lexicon), ["id"])
    assert rows(scored) == [(1, [compound(2.0), 0.0, compound(-2.5), 0.0])]


def test_emphasis(spark, lexicon, rows):
    modifiers = spark.createDataFrame([("very", 0.293, False), ("not", 0.0, True)], "token string, boost double, negates boolean")
    texts = [
        (1, "good"), (2, "very good"), (3, "very big good"), (4, "not good"), (5, "GOOD day"), (6, "GOOD"),
        (7, "good!!!!!!"), (8, "bad??"), (9, "bad????"), (10, "not a very good"), (11, "meh!"),
    ]
    df = spark.createDataFrame(texts, "id int, t string")
    scored = dict(rows(sentiment.score_texts_with_emphasis(df, ["id"], "t", lexicon, modifiers)))
    assert scored == {
        1: compound(2.0), 2: compound(2.293), 3: compound(2 + 0.293 * 0.95), 4: compound(2 * -0.74),
        5: compound(2.733), 6: compound(2.0), 7: compound(2 + 4 * 0.292), 8: compound(-2.5 - 0.36),
        9: compound(-2.5 - 0.96), 10: compound(2.293 * -0.74), 11: 0.0,
    }


def test_weighted_mean(spark):
    df = spark.createDataFrame([(0.5, 3), (-0.5, 1)], "score double, like_count long")
    assert engagement.weighted_sentiment(df, []).first()[0] == 0.25


def test_weighted_mean_without_weight(spark):
    df = spark.createDataFrame([(0.5, 0)], "score double, like_count long")
    assert engagement.weighted_sentiment(df, []).first()[0] is None


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(-10000, 10000), st.integers(1, 3 * 10**9)), min_size=1, max_size=40))
def test_weighted_mean_stays_in_range(spark, pairs):
    df = spark.createDataFrame([(s / 10000, w) for s, w in pairs], "score double, like_count long")
    mean = engagement.weighted_sentiment(df, []).first()[0]
    assert min(s for s, _ in pairs) / 10000 - 1e-9 <= mean <= max(s for s, _ in pairs) / 10000 + 1e-9


def test_parts_are_bounded_aligned_and_whole(spark):
    df = spark.range(2500).select(F.lit("n").alias("news_id"), F.col("id").alias("position"),
                                  F.when(F.col("id") % 2 == 0, F.col("id")).alias("a"), F.col("id").alias("b"))
    parts = engagement.thread_parts(df.repartition(7), ["news_id"], ["a", "b"], part_size=1000).orderBy("part").collect()
    assert [len(p.b) for p in parts] == [1000, 1000, 500]
    assert [v for p in parts for v in p.b] == list(range(2500))
    assert all(a is None or a == b for p in parts for a, b in zip(p.a, p.b))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_gives_the_same_rows_salted(spark, how):
    facts = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 400).alias("k"))
    # The key types differ on purpose.
    table = spark.range(200).select(F.col("id").cast("int").alias("k"), (F.col("id") * 10).alias("v"))
    assert joins.hot_keys(facts, ["k"])
    columns = ["id", "k"] if how.startswith("left_") else ["id", "k", "v"]
    expected = sorted(map(tuple, facts.join(table, "k", how).select(columns).collect()), key=repr)
    for small in (True, False):
        found = joins.lookup(facts, table, "k", how, small=small).select(columns).collect()
        assert sorted(map(tuple, found), key=repr) == expected


def test_salted_lookup_spreads_the_hot_key(spark):
    facts = spark.range(4000).select("id", F.lit(7).alias("k"))
    table = spark.createDataFrame([(7, "x")], "k int, v string")
    plan = joins.lookup(facts, table, "k", small=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_size_check(spark):
    assert joins.is_small(spark.range(10)) and not joins.is_small(spark.range(10), max_rows=9)
    assert not joins.is_small(spark.range(10), max_bytes=20)


def test_attach_comments(spark, rows):
    seeds = spark.createDataFrame([("n1", "t1"), ("n2", "t1"), ("n3", "t3")], "news_id string, tweet_url string")
    comments = spark.createDataFrame([("t1", 0, "a"), ("t1", 1, ""), ("t1", 2, None), ("t9", 0, "z")], "tweet_url string, position long, comment string")
    for small in (True, False):
        assert rows(engagement.attach_comments(seeds, comments, small=small), "news_id") == [("n1", "t1", 0, "a"), ("n2", "t1", 0, "a")]
    kept = engagement.attach_comments(seeds, comments, keep_unmatched=True)
    assert rows(kept, "news_id") == [("n1", "t1", 0, "a"), ("n2", "t1", 0, "a"), ("n3", "t3", None, None)]


def test_thread_comments(spark, rows):
    from pressgauge import schemas

    df = spark.createDataFrame([("t", [("", "x", "a"), ("1.2K", "y", "b"), ("1,2", "z", "c")]), ("u", None)], schemas.THREAD)
    assert rows(engagement.thread_comments(df).select("tweet_url", "position", "like_count", "comment"), "position") == [
        ("t", 0, 1, "a"), ("t", 1, 1201, "b"), ("t", 2, 1, "c")]


def test_latest_counts_and_sets(spark, rows):
    seeds = spark.createDataFrame([("n", 1, 5), ("n", 2, 3)], "news_id string, seen int, favorite_count int")
    assert engagement.latest_counts(seeds, "seen").first().asDict() == {"news_id": "n", "seen": 2, "favorite_count": 3}
    hits = spark.createDataFrame([("u", "t", "b", 1), ("u", "t", "a", 4), ("u", "t", "b", 2)], "news_url string, tweet_url string, news_keyword string, favorite_count int")
    assert rows(engagement.keyword_sets(hits)) == [("u", "t", ["a", "b"])]
    assert rows(engagement.group_max_favourites(hits, ["news_url"])) == [("u", 4)]
