"""Outer joins of streams, late rows, folder topics, JSON consumers and pruned page lookups."""

import datetime

import pytest
from pyspark.sql import functions as F

from pressgauge import schemas
from pressgauge.operators import articles, engagement, records
from pressgauge.sinks import documents
from pressgauge.sources import folder_topic
from pressgauge.sources.page_store import PageStore
from pressgauge.sources.topics import read_files_as_topic
from pressgauge.streaming import jobs, late


def at(minutes):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minutes)


@pytest.fixture()
def session(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", "2")
    own.conf.set("spark.sql.session.timeZone", "UTC")
    return own


SOCIAL = "news_id string, likes long, title string, seen_at timestamp"
ARTICLE = "news_id string, chars long, title string, seen_at timestamp"


def outer(session, base, social, pages):
    def feed(rows, schema, name):
        for number, part in enumerate(rows):
            frame = session.createDataFrame([(*r[:-1], at(r[-1])) for r in part], schema)
            frame.coalesce(1).write.mode("ignore").parquet(f"{base}/{name}/f{number}")
        return read_files_as_topic(session, f"{base}/{name}/*", frame.schema, files_per_trigger=1)

    jobs.run_to_end(jobs.outer_document_stream(
        feed(social, SOCIAL, "social"), feed(pages, ARTICLE, "pages"), f"{base}/out", f"{base}/check", delay="2 hours", within="1 hour",
        available_now=True,
    ))
    rows = session.read.parquet(f"{base}/out").select("news_id", "likes", "chars", "title", "seen_at")
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def test_stream_outer_join_equals_batch_merge(session, tmp_path):
    social = [[("a", 1, "s", 0), ("b", 2, "s", 5), ("c", 3, "s", 10)], [("d", 4, "s", 61)], [(None, None, None, 9000)]]
    pages = [[("b", 20, "p", 3), ("x", 50, "p", 1)], [("a", 10, "p", 30), ("d", 40, "p", 61)], [(None, None, None, 9000)]]
    found = outer(session, str(tmp_path), social, pages)
    left = session.createDataFrame([(*r[:-1], at(r[-1])) for part in social[:2] for r in part], SOCIAL)
    right = session.createDataFrame([(*r[:-1], at(r[-1])) for part in pages[:2] for r in part], ARTICLE)
    batch = documents.merge(left, right, time="seen_at").select("news_id", "likes", "chars", "title", "seen_at")
    assert found == sorted((tuple(r) for r in batch.collect()), key=repr)
    assert ("a", 1, 10, "p", at(30)) in found and ("b", 2, 20, "s", at(5)) in found
    # A restart repeats nothing.
    assert outer(session, str(tmp_path), social, pages) == found


def test_stream_outer_join_releases_rows_out_of_reach_alone(session, tmp_path):
    found = outer(session, str(tmp_path), [[("a", 1, "s", 0)], [(None, None, None, 9000)]], [[("a", 10, "p", 90)], [(None, None, None, 9000)]])
    assert found == [("a", 1, None, "s", at(0)), ("a", None, 10, "p", at(90))]


SCORED = "news_id string, position long, like_count long, score double, event_time timestamp"
BATCHES = [
    [("a", 0, 2, 0.5, 100), ("b", 0, 1, 0.1, 100)],
    [("a", 0, 2, 0.5, 100), ("a", 1, 3, -0.5, 10), ("b", 1, 1, 0.3, 95)],
    [("a", 1, 3, -0.5, 10), ("a", 2, 1, 0.2, 5), ("c", 0, 1, 1.0, 1)],
]


def sums(session, base, upto):
    for number, rows in enumerate(BATCHES[:upto]):
        frame = session.createDataFrame([(*r[:-1], at(r[-1])) for r in rows], SCORED)
        frame.coalesce(1).write.mode("ignore").parquet(f"{base}/in/f{number}")
    stream = read_files_as_topic(session, f"{base}/in/*", frame.schema, files_per_trigger=1)
    jobs.run_to_end(late.sentiment_stream(
        stream, ["news_id"], ["news_id", "position"], "event_time", f"{base}/sums", f"{base}/late", f"{base}/check", delay="10 minutes",
        horizon=3_600_000, available_now=True,
    ))
    return {r.news_id: (round(r.weighted_sentiment_score, 6), r.n_comments, r.n_late) for r in late.current_sentiment(session, f"{base}/sums", f"{base}/late", ["news_id"]).collect()}


def test_late_rows_are_counted_and_added_also_after_a_restart(session, tmp_path):
    late.use_state_variables(session)
    base = str(tmp_path)
    assert sums(session, base, 2) == {"a": (-0.1, 2, 1), "b": (0.2, 2, 0)}
    found = sums(session, base, 3)
    assert found == {"a": (-0.05, 3, 2), "b": (0.2, 2, 0), "c": (1.0, 1, 1)}
    rows = session.createDataFrame([(*r[:-1], at(r[-1])) for part in BATCHES for r in part], SCORED).dropDuplicates(["news_id", "position"])
    batch = {r.news_id: round(r.weighted_sentiment_score, 6) for r in engagement.weighted_sentiment(rows, ["news_id"]).collect()}
    assert {k: v[0] for k, v in found.items()} == batch
    assert sums(session, base, 3) == found


def test_marks_are_forgotten_once_the_watermark_has_passed_the_horizon(session, tmp_path):
    late.use_state_variables(session)
    frame = "k string, event_time timestamp"
    for number, rows in enumerate([[("a", 0)], [("b", 500)], [("c", 501), ("b", 500)], [("a", 0)]]):
        session.createDataFrame([(k, at(m)) for k, m in rows], frame).coalesce(1).write.parquet(f"{tmp_path}/in/f{number}")
    stream = read_files_as_topic(session, f"{tmp_path}/in/*", session.createDataFrame([], frame).schema, files_per_trigger=1)
    first = late.first_rows(stream, ["k"], "event_time", delay="1 minute", horizon=60_000)
    out = f"{tmp_path}/out"
    query = first.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").option("path", out).trigger(availableNow=True).start()
    jobs.run_to_end(query)
    assert sorted(tuple(r) for r in session.read.parquet(out).select("k", "is_late").collect()) == [("a", False), ("a", True), ("b", False), ("c", False)]


def messages(session, low, high):
    return session.range(low, high).select(F.col("id").cast("string").alias("key"), F.concat(F.lit("v"), "id").alias("value"))


def per_segment(session, path):
    return [tuple(r) for r in folder_topic.read(session, path).groupBy("segment").count().orderBy("segment").collect()]


def test_topic_restarts_at_the_committed_offset(session, tmp_path):
    source, target = f"{tmp_path}/a", f"{tmp_path}/b"

    def run():
        jobs.run_to_end(jobs.topic_stream(
            source, target, lambda m: m.select("key", F.upper("value").alias("value")), session, f"{tmp_path}/c", available_now=True
        ))
        return per_segment(session, target)

    folder_topic.publish(messages(session, 0, 10), source, "x")
    folder_topic.publish(messages(session, 0, 10), source, "x")
    assert run() == [(0, 10)]
    folder_topic.publish(messages(session, 10, 25), source)
    folder_topic.publish(messages(session, 0, 0), source)
    assert run() == [(0, 10), (1, 15)] == run()
    values = folder_topic.read(session, target).select("value").collect()
    assert sorted(r.value for r in values) == sorted(f"V{n}" for n in range(25))
    # A batch that was committed but not recorded by its stream is not published again.
    folder_topic.Log(target).commit(["again.parquet"], "main.1", 1)
    assert len(folder_topic.Log(target).manifests()) == 2


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_topic_takes_keyed_totals(session, tmp_path, mode):
    folder_topic.publish(messages(session, 0, 30), f"{tmp_path}/a")
    totals = folder_topic.read_stream(session, f"{tmp_path}/a").groupBy(F.left("key", F.lit(1)).alias("key")).agg(F.count("*").cast("string").alias("value"))
    jobs.run_to_end(folder_topic.publish_stream(totals, f"{tmp_path}/b", f"{tmp_path}/c", mode, available_now=True))
    found = {r.key: r.value for r in folder_topic.read(session, f"{tmp_path}/b").collect()}
    assert found == {"1": "11", "2": "11", **{str(d): "1" for d in (0, 3, 4, 5, 6, 7, 8, 9)}}


def test_topic_from_the_latest_offset(session, tmp_path):
    path = f"{tmp_path}/a"
    folder_topic.publish(messages(session, 0, 5), path)
    assert folder_topic.StreamReader(path, "latest").initialOffset() == {"segment": 1}
    log = folder_topic.Log(path)
    name = log.write(iter(messages(session, 5, 7).toArrow().to_batches()))
    log.discard([name])
    assert per_segment(session, path) == [(0, 5)]


KINDS = {
    "social": records.Kind("tweet_url", schemas._struct(("news_id", schemas.STRING), ("likes", schemas.LONG))),
    "articles": records.Kind("news_title", schemas._struct(("news_id", schemas.STRING), ("news_title", schemas.STRING))),
}


def test_messages_are_routed_by_kind(spark):
    texts = [
        '{"news_id": "a", "tweet_url": "t", "likes": 3}', '{"news_id": "b", "news_title": "n"}', '{"news_id": "c", "tweet_url": null, "likes": "x"}',
        '{"news_id": "d"}', '{"tweet_url": "t"}', "{broken", "[1]", "", None, '{"news_id": "e", "tweet_url": "t", "news_title": "n", "likes": "many"}',
    ]
    routed = records.route_messages(spark.createDataFrame([(t, at(0)) for t in texts], "value string, timestamp timestamp"), KINDS)
    kinds = {r.value: r.kind for r in routed.collect()}
    assert [kinds[t] for t in texts] == ["social", "articles", "social", None, None, None, None, None, None, "social"]
    social = records.of_kind(routed, "social", KINDS["social"])
    assert sorted((r.news_id, r.likes) for r in social.collect()) == [("a", 3), ("c", None), ("e", None)]


def test_consumer_keeps_the_newest_and_quarantines_the_rest(session, tmp_path):
    topic = f"{tmp_path}/topic"

    def send(*rows):
        folder_topic.publish(session.createDataFrame([("k", r) for r in rows], "key string, value string"), topic)

    def run():
        stream = folder_topic.read_stream(session, topic)
        jobs.run_to_end(jobs.consumer_stream(stream, KINDS, f"{tmp_path}/docs", f"{tmp_path}/bad", f"{tmp_path}/check", available_now=True))
        docs = documents.read_documents(session, f"{tmp_path}/docs").select("news_id", "likes", "news_title")
        return {tuple(r) for r in docs.collect()}, sorted(r.value for r in session.read.parquet(f"{tmp_path}/bad").collect())

    send('{"news_id": "a", "tweet_url": "t", "likes": 1}', "{broken")
    send('{"news_id": "b", "news_title": "n"}')
    assert run() == ({("a", 1, None), ("b", None, "n")}, ["{broken"])
    send('{"news_id": "a", "tweet_url": "t", "likes": 2}', '{"news_id": "a", "news_title": "m"}', '{"x": 1}')
    assert run() == ({("a", 2, "m"), ("b", None, "n")}, ['{"x": 1}', "{broken"]) == run()


def test_lookup_reads_only_the_buckets_it_needs(session, tmp_path):
    store = PageStore(session, f"{tmp_path}/pages", 32)
    html = F.concat(F.lit("<title>t</title><body><p>page "), "id", F.lit("</p></body>"))
    pages = session.range(400).select(F.concat(F.lit("http://x/"), "id").alias("url"), html.alias("html"))
    store.add(pages.where("id < 200"))
    store.add(pages.where("id >= 200"))
    asked = session.createDataFrame([("a", "http://x/7"), ("b", "http://x/399"), ("c", "http://none/"), ("d", None)], "news_id string, news_url string")
    wanted = store.wanted(asked, "news_url")
    everything = len(session.read.parquet(f"{tmp_path}/pages").inputFiles())
    scan = wanted._jdf.queryExecution().executedPlan().toString()
    # Three addresses, so three buckets at most beside that of null, with a file for each time pages were added.
    read = wanted.select(F.input_file_name().alias("f")).distinct().count()
    assert "PartitionFilters: [url_bucket" in scan and everything == 64 and read <= 8
    found = {(r.news_id, r.news_text) for r in articles.fetch(asked, wanted).collect()}
    assert found == {("a", "page 7"), ("b", "page 399"), ("c", ""), ("d", "")}
