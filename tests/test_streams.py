import datetime

import pytest
from pyspark.sql import functions as F

from pressgauge.operators import credibility, engagement, records, sentiment
from pressgauge.sinks import documents, topics as topic_sink
from pressgauge.sources.topics import read_files_as_topic
from pressgauge.streaming import jobs, state

COMMENT = "news_id string, position long, comment string, like_count long, event_time timestamp"


def at(minutes):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minutes)


def comments(spark, *rows):
    return spark.createDataFrame([(n, p, c, w, at(m)) for n, p, c, w, m in rows], COMMENT)


@pytest.fixture()
def lexicon(spark):
    return spark.createDataFrame([("good", 2.0), ("bad", -2.0)], "token string, valence double")


FIRST = [("a", 0, "good", 3, 0), ("a", 1, "bad", 1, 1), ("b", 0, "x", 2, 2)]
SECOND = [("a", 2, "good good", 5, 3), ("a", 1, "bad", 1, 1)]


def feed(spark, folder, number, rows):
    comments(spark, *rows).coalesce(1).write.parquet(f"{folder}/f{number}")


def run_pipeline(spark, base):
    stream = read_files_as_topic(spark, f"{base}/in/*", comments(spark, *FIRST).schema, files_per_trigger=1)
    lex = spark.createDataFrame([("good", 2.0), ("bad", -2.0)], "token string, valence double")
    jobs.run_to_end(jobs.score_comment_stream(
        stream, ["news_id", "position"], ["like_count"], "event_time", lex, f"{base}/scores", f"{base}/c1", available_now=True))
    scored = read_files_as_topic(spark, f"{base}/scores", spark.read.parquet(f"{base}/scores").schema)
    jobs.run_to_end(jobs.sentiment_stream(
        scored, ["news_id"], ["news_id", "position"], "event_time", f"{base}/sums", f"{base}/c2", available_now=True))
    sums = documents.read_documents(spark, f"{base}/sums", ["news_id", "period"])
    return {tuple(r) for r in state.sentiment_totals(sums, ["news_id"]).collect()}


def batch_result(spark, lexicon, rows):
    df = comments(spark, *rows).dropDuplicates(["news_id", "position"])
    scored = sentiment.score_texts(df, ["news_id", "position", "like_count"], "comment", lexicon)
    return {tuple(r) for r in engagement.weighted_sentiment(scored, ["news_id"]).collect()}


def test_stream_equals_batch_and_survives_restart(spark, lexicon, tmp_path):
    base = str(tmp_path)
    feed(spark, f"{base}/in", 0, FIRST)
    feed(spark, f"{base}/in", 1, FIRST)
    assert run_pipeline(spark, base) == batch_result(spark, lexicon, FIRST)
    feed(spark, f"{base}/in", 2, SECOND)
    assert run_pipeline(spark, base) == batch_result(spark, lexicon, FIRST + SECOND)
    assert run_pipeline(spark, base) == batch_result(spark, lexicon, FIRST + SECOND)


def test_late_rows_are_dropped_by_the_watermark(spark, tmp_path):
    base = str(tmp_path)
    day = 24 * 60
    for number, rows in enumerate([[("a", 0, "x", 1, 0)], [("a", 1, "x", 1, 10 * day)], [("a", 2, "x", 1, 1)]]):
        feed(spark, f"{base}/in", number, rows)
        stream = read_files_as_topic(spark, f"{base}/in/*", comments(spark, *FIRST).schema, files_per_trigger=1)
        once = state.without_replays(stream, ["news_id", "position"], "event_time", "1 day")
        jobs.run_to_end(topic_sink.stream_to_files(once, f"{base}/out", f"{base}/check", available_now=True))
    kept = spark.read.schema("position long").json(f"{base}/out")
    assert sorted(r.position for r in kept.collect()) == [0, 1]


def test_latest_counts_by_stream(spark, tmp_path):
    base = str(tmp_path)
    feed(spark, f"{base}/in", 0, [("a", 0, "x", 1, 0), ("a", 0, "x", 7, 30), ("b", 0, "x", 2, 5)])
    feed(spark, f"{base}/in", 1, [("a", 0, "x", 4, 20), ("b", 0, "x", 9, 50)])
    stream = read_files_as_topic(spark, f"{base}/in/*", comments(spark, *FIRST).schema, files_per_trigger=1)
    newest = state.latest(stream, ["news_id"], "event_time", ["like_count"], "1 day")
    jobs.run_to_end(jobs.upsert_stream(newest, f"{base}/t", f"{base}/c", available_now=True))
    found = documents.read_documents(spark, f"{base}/t", ["news_id", "period"])
    assert {(r.news_id, r.like_count) for r in found.collect()} == {("a", 7), ("b", 9)}


def test_short_records_are_quarantined(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "m.txt").write_text("n1,k,u1,t1,3,2000;n2,k\nn3,k,u3,t3,1,5\n")
    stream = spark.readStream.text(str(tmp_path / "in"))
    good, bad = records.decode_records(stream)
    for name, part in (("good", good), ("bad", bad)):
        jobs.run_to_end(topic_sink.stream_to_files(part, str(tmp_path / name), str(tmp_path / f"c_{name}"), available_now=True))
    assert spark.read.json(str(tmp_path / "good")).count() == 2
    assert [r.record for r in spark.read.json(str(tmp_path / "bad")).collect()] == ["n2,k"]


def seed_stream(spark, base):
    schema = "news_id string, news_keyword string, news_url string, tweet_url string, retweet_count long, favorite_count long, timestamp timestamp"
    rows = [("1", "k", "http://p", "t", 1, 2000, at(0)), ("2", "k", "http://none", "t2", 1, 3000, at(1))]
    for number in range(2):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{base}/seeds/f{number}")
    return read_files_as_topic(spark, f"{base}/seeds/*", spark.createDataFrame(rows, schema).schema, files_per_trigger=1)


def tables(spark):
    return {
        "lexicon": spark.createDataFrame([("good", 2.0), ("bad", -2.0)], "token string, valence double"),
        "stop": spark.createDataFrame([("the",)], "token string"),
        "lemmas": spark.createDataFrame([("good", "good"), ("cats", "cat")], "token string, lemma string"),
    }


def test_article_stream(spark, tmp_path):
    base = str(tmp_path)
    pages = spark.createDataFrame([("http://p", "<title>T</title><article><p>Good cats.</p></article>")], "url string, html string")
    train = spark.createDataFrame([(["good", "cat"], 1), (["bad"], 0)] * 5, "tokens array<string>, label int")
    jobs.run_to_end(jobs.article_stream(
        seed_stream(spark, base), pages, tables(spark), f"{base}/docs", f"{base}/c", model=credibility.train(train), available_now=True))
    docs = documents.read_documents(spark, f"{base}/docs").collect()
    assert [(d.news_id, d.news_title, d.news_tokens, d.prediction) for d in docs] == [("1", "T", "good cat", "Fake")]
    assert docs[0].news_sentiment_scores == [0.4588, 0.0] and docs[0].date is not None and docs[0].lastModified is not None


def test_social_stream(spark, tmp_path):
    base = str(tmp_path)
    threads = spark.createDataFrame([("t", 0, "good cats", 3, "x"), ("t", 1, "zzz", 9, "y")],
                                    "tweet_url string, position long, comment string, like_count long, comment_time string")
    speech = spark.createDataFrame([("good", "a")], "token string, pos string")
    jobs.run_to_end(jobs.social_stream(
        seed_stream(spark, base), threads, {**tables(spark), "speech": speech}, f"{base}/scored", f"{base}/c", available_now=True))
    found = documents.read_documents(spark, f"{base}/scored", ["news_id", "position"]).collect()
    assert [(r.news_id, r.position, r.score, r.adjectives) for r in found] == [("1", 0, 0.4588, "good")]


def test_complete_mode_is_available(spark, tmp_path):
    base = str(tmp_path)
    feed(spark, f"{base}/in", 0, FIRST)
    stream = read_files_as_topic(spark, f"{base}/in/*", comments(spark, *FIRST).schema)
    sums = state.sentiment_sums(stream.withColumn("score", F.lit(0.5)), ["news_id"], "event_time")
    writer = topic_sink.stream_writer(sums, f"{base}/c", "complete", name="complete_sums", available_now=True)
    jobs.run_to_end(writer.format("memory").start())
    assert spark.table("complete_sums").count() == 2


def test_interval_and_console(spark, tmp_path):
    base = str(tmp_path)
    feed(spark, f"{base}/in", 0, FIRST)
    stream = read_files_as_topic(spark, f"{base}/in/*", comments(spark, *FIRST).schema)
    query = topic_sink.stream_to_console(stream, f"{base}/c", "append", available_now=True)
    jobs.run_to_end(query)
    assert query.exception() is None
    writer = topic_sink.stream_writer(stream, f"{base}/c2", "append", name="paced", interval="1 second")
    paced = writer.format("memory").start()
    paced.processAllAvailable()
    paced.stop()
    assert spark.table("paced").count() == 3


def test_social_tables_take_up_new_comments_changed_counts_and_late_rows(spark, tmp_path):
    base = str(tmp_path)
    seed = "news_id string, news_keyword string, retweet_count long, favorite_count long, news_url string, tweet_url string, timestamp timestamp"
    comment = "tweet_url string, position long, comment string, like_count long, comment_time string, event_time timestamp"
    batches = [
        ([("n", "k", 1, 1000, "u", "t", at(0))], [("t", 0, "good", 3, "x", at(0)), ("t", 1, "bad", 1, "y", at(1))]),
        # Days later a new count, and a comment that was on its way for all that time.
        ([("n", "k", 2, 2000, "u", "t", at(9000))], [("t", 0, "good", 7, "x", at(9000)), ("t", 2, "bad bad", 2, "z", at(2))]),
        # Older states that arrive last change nothing.
        ([("n", "k", 1, 1500, "u", "t", at(5))], [("t", 0, "good", 4, "x", at(5))]),
    ]
    words = {**tables(spark), "speech": spark.createDataFrame([("good", "a")], "token string, pos string"), "lemmas": spark.createDataFrame([("good", "good"), ("bad", "bad")], "token string, lemma string")}
    for number, (seeds, said) in enumerate(batches):
        spark.createDataFrame(seeds, seed).coalesce(1).write.parquet(f"{base}/s/f{number}")
        spark.createDataFrame(said, comment).coalesce(1).write.parquet(f"{base}/c/f{number}")
        jobs.run_to_end(jobs.seed_table_stream(
            read_files_as_topic(spark, f"{base}/s/*", spark.read.parquet(f"{base}/s/*").schema), f"{base}/seeds", f"{base}/k1", available_now=True))
        jobs.run_to_end(jobs.comment_table_stream(
            read_files_as_topic(spark, f"{base}/c/*", spark.read.parquet(f"{base}/c/*").schema), words, f"{base}/said", f"{base}/k2", available_now=True))
        row = jobs.current_social(spark, f"{base}/seeds", f"{base}/said").collect()
        assert len(row) == 1
        if number == 0:
            assert (row[0].favorite_count, row[0].like_counts) == (1000, [3, 1])
        else:
            assert (row[0].favorite_count, row[0].retweet_count, row[0].like_counts) == (2000, 2, [7, 1, 2])
            assert row[0].tweets_comment == ["good", "bad", "bad bad"]
