import pytest
from pyspark.sql import functions as F

from pressgauge import schemas
from pressgauge.operators import credibility, engagement, records
from pressgauge.plans import daily
from pressgauge.sinks import files as sink
from pressgauge.sources import files as source

DAY = "2024-01-01"


@pytest.fixture()
def tables(spark):
    return {
        "lexicon": spark.createDataFrame([("good", 2.0), ("bad", -2.0)], "token string, valence double"),
        "stop": spark.createDataFrame([("the",)], "token string"),
        "lemmas": spark.createDataFrame([("good", "good"), ("storm", "storm")], "token string, lemma string"),
    }


def seeds_of_the_day(spark, base):
    heads = spark.createDataFrame([("Big Storm nears - Daily", "en"), ("Sturm naht - Blatt", "de")], "title string, lang string")
    sink.write_day(heads, f"{base}/headlines", DAY)
    gazetteer = spark.createDataFrame([("Storm", "EVENT"), ("Sturm", "EVENT"), ("Daily", "ORG")], "phrase string, ent_type string")
    daily.collect_keywords(spark, f"{base}/headlines", gazetteer, f"{base}/keywords", DAY)
    assert [r.keyword for r in source.read_day(spark, f"{base}/keywords", DAY).collect()] == ["Storm"]

    lines = [
        f'{{"id":{n},"id_str":"{n}","created_at":"Wed Mar 27 18:05:09 +0000 2019","text":"the storm","lang":"en",'
        f'"retweet_count":1,"favorite_count":{1000 + n},"user":{{"screen_name":"u"}},'
        f'"entities":{{"urls":[{{"url":"https://t","expanded_url":"http://cnn.com/{n % 2}"}}]}}}}'
        for n in range(4)
    ]
    raw = spark.createDataFrame([(line,) for line in lines], "v string").select(F.from_json("v", schemas.TWEET).alias("t")).select("t.*")
    sink.write_day(raw, f"{base}/tweets", DAY)
    daily.collect_seeds(spark, f"{base}/tweets", f"{base}/keywords", f"{base}/seeds", DAY)
    return source.read_day(spark, f"{base}/seeds", DAY)


def test_whole_day(spark, tmp_path, tables):
    seeds = seeds_of_the_day(spark, str(tmp_path))
    found = {r.news_url: (r.favorite_count, r.tweet_url) for r in seeds.collect()}
    assert found == {
        "http://cnn.com/0": (1002, "https://twitter.com/u/status/2"), "http://cnn.com/1": (1003, "https://twitter.com/u/status/3"),
    }
    decoded, bad = records.decode_records(records.encode_messages(seeds).select("value"))
    assert decoded.count() == 2 and bad.count() == 0

    threads = spark.createDataFrame(
        [("https://twitter.com/u/status/2", [("1K", "x", "good storm"), ("", "y", "the bad")])], schemas.THREAD)
    speech = spark.createDataFrame([("good", "a")], "token string, pos string")
    social = daily.social_results(decoded, engagement.thread_comments(threads), {**tables, "speech": speech})
    pages = spark.createDataFrame([("http://cnn.com/0", "<title>T</title><article>Good storm. Bad</article>")], "url string, html string")
    articles = daily.article_results(decoded, pages, tables)
    docs = daily.news_documents(social, articles).collect()
    assert len(docs) == 1
    doc = docs[0]
    assert (doc.news_title, doc.news_tokens, doc.news_sentiment_scores) == ("T", "good storm", [0.4588, -0.4588])
    # The second comment has no lemma and does not count.
    assert (doc.tweets_comment, doc.like_counts, doc.tweets_tokens) == (["good storm"], [1001], "good")
    assert doc.weighted_sentiment_score == pytest.approx(0.4588)

    train = spark.createDataFrame([(["good", "storm"], 1), (["bad"], 0)] * 5, "tokens array<string>, label int")
    assert daily.judge(credibility.train(train), articles).first().label_text == "Fake"


def test_rerun_of_a_day_gives_the_same_ids(spark, tmp_path):
    first = {r.news_id for r in seeds_of_the_day(spark, str(tmp_path / "a")).collect()}
    assert first == {r.news_id for r in seeds_of_the_day(spark, str(tmp_path / "b")).collect()}
