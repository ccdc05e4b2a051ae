import json

import pytest
from pyspark.sql import functions as F

from pressgauge import schemas
from pressgauge.operators import tweets

STAMP = "Wed Mar 27 18:05:09 +0000 2019"


def tweet(number, links=(), retweet=None, **more):
    body = {
        "id": number, "id_str": str(number), "created_at": STAMP, "text": f"text {number}", "lang": "en",
        "retweet_count": number, "favorite_count": number * 10, "user": {"screen_name": f"u{number}"},
        "entities": {"urls": [{"url": u, "expanded_url": e} for u, e in links]},
    }
    if retweet:
        body["retweeted_status"] = retweet
    return {**body, **more}


@pytest.fixture()
def flat(spark, tmp_path):
    def build(*tweets_):
        (tmp_path / "t.json").write_text("\n".join(json.dumps(t) for t in tweets_))
        raw = spark.read.schema(schemas.TWEET).json(str(tmp_path / "t.json"))
        return tweets.flatten_tweets(raw)

    return build


def test_plain_tweet_takes_first_link(flat):
    row = flat(tweet(1, [("https://a", "A"), ("https://b", "B")])).first()
    assert (row.day, row.hour, row.news_url, row.tweet_url) == ("2019-03-27", 18, "A", "https://twitter.com/u1/status/1")
    assert (row.retweet_count, row.favorite_count, row.has_link) == (1, 10, True)


def test_own_zone_is_kept(flat):
    row = flat(tweet(1, created_at="Wed Mar 27 23:05:09 -0500 2019")).first()
    assert (row.day, row.hour) == ("2019-03-27", 23)


@pytest.mark.parametrize("inner, expected", [
    ([("https://b", "B")], "B"), ([("http://b", "B")], "A"), ([], "A"),
])
def test_retweet_overrides(flat, inner, expected):
    row = flat(tweet(1, [("https://a", "A")], retweet=tweet(2, inner))).first()
    assert row.news_url == expected
    assert (row.tweet_id, row.text, row.favorite_count, row.tweet_url) == (1, "text 2", 20, "https://twitter.com/u2/status/2")


def test_no_link(flat):
    row = flat(tweet(1)).first()
    assert row.news_url is None and row.has_link is False


def test_excluded_links(spark):
    urls = [None, "https://youtu.be/x", "https://cnn.com/x", "https://x.tv/a", "https://TWITTER.com"]
    df = spark.createDataFrame([(u,) for u in urls], "news_url string")
    assert [r.news_url for r in tweets.keep_article_links(df).collect()] == ["https://cnn.com/x", "https://TWITTER.com"]


def test_threshold(spark):
    df = spark.createDataFrame([(999,), (1000,)], "favorite_count long")
    assert [r[0] for r in tweets.keep_popular(df).collect()] == [1000]


def hits(spark, *rows):
    return spark.createDataFrame(
        [(n, "k", 0, f, t, u) for n, (u, t, f) in enumerate(rows)],
        "tweet_id long, news_keyword string, retweet_count long, favorite_count long, tweet_url string, news_url string",
    )


def test_first_of_ties_wins(spark):
    best = tweets.seeds(hits(spark, ("u", "t1", 5), ("u", "t2", 5), ("u", "t3", 3), ("u", "t1", 5)), F.col("tweet_id"))
    row = best.first()
    assert best.count() == 1 and (row.tweet_url, row.favorite_count) == ("t1", 5)


def test_ids_are_stable_or_random(spark):
    df = hits(spark, ("u", "t", 1))
    assert tweets.with_news_id(df).first().news_id == tweets.with_news_id(df).first().news_id
    assert tweets.with_news_id(df, random=True).first().news_id != tweets.with_news_id(df, random=True).first().news_id


def test_hot_key_is_limited_before_the_shuffle(spark):
    plan = tweets.top_per_article(hits(spark, ("u", "t", 1)), F.col("tweet_id"))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_phrases_match_as_words(spark, rows):
    posts = spark.createDataFrame([(1, "In New York, today"), (2, "new yorkers"), (3, "york new"), (4, "NEW  york new york")], "tweet_id int, text string")
    words = spark.createDataFrame([("New York",), ("york",), ("...",)], "keyword string")
    found = tweets.search_keywords(posts, words, ["tweet_id"])
    assert rows(found, "tweet_id", "news_keyword") == [(1, "New York"), (1, "york"), (3, "york"), (4, "New York"), (4, "york")]


def test_search_is_no_nested_loop(spark):
    posts = spark.createDataFrame([(1, "a b")], "tweet_id int, text string")
    words = spark.createDataFrame([("a b",)], "keyword string")
    plan = tweets.search_keywords(posts, words, ["tweet_id"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_find_hits(flat, spark):
    posts = flat(
        tweet(200, [("https://a", "https://cnn.com/a")], text="big storm"),
        tweet(200, [("https://a", "https://youtu.be/a")], text="big storm"),
        tweet(50, [("https://a", "https://cnn.com/b")], text="big storm"),
        tweet(300, [("https://a", "https://cnn.com/c")], text="big storm", lang="fr"),
        tweet(400, text="big storm"),
    )
    found = tweets.find_hits(posts, spark.createDataFrame([("storm",), ("calm",)], "keyword string"))
    assert [(r.tweet_id, r.news_keyword, r.news_url) for r in found.collect()] == [(200, "storm", "https://cnn.com/a")]
