import datetime
import json

import pytest
from pyspark.sql import functions as F

from pressgauge import schemas, session
from pressgauge.functions import text as text_fn
from pressgauge.operators import features
from pressgauge.session import fresh_dir, shared_dir, work_dir
from pressgauge.sinks import documents, files as sink, topics as topic_sink
from pressgauge.sources import files as source, topics


def test_headline_arrays(spark, tmp_path):
    heads = [{"title": "A\nB - C", "content": None, "extra": 1}, {"title": "D", "lang": "en"}]
    (tmp_path / "h.json").write_text(json.dumps(heads, indent=1))
    found = source.read_headlines(spark, str(tmp_path / "h.json"))
    assert [r.title for r in found.collect()] == ["A\nB - C", "D"]
    assert found.columns == ["title", "description", "content", "url", "lang"]


def test_lines(spark, tmp_path, rows):
    df = spark.createDataFrame([("a b",), ("c",)], "t string")
    sink.write_lines(df, str(tmp_path / "l"), "t")
    assert rows(source.read_lines(spark, str(tmp_path / "l")), "line") == [("a b",), ("c",)]


def test_csv_with_delimiters_in_fields(spark, tmp_path, rows):
    seed = ("n", 'k "q", x', "u\nv", "t", 1, 2)
    sink.write_csv(spark.createDataFrame([seed], schemas.SEED), str(tmp_path / "c"))
    assert rows(source.read_csv(spark, str(tmp_path / "c"), schemas.SEED)) == [seed]


def test_claims(spark, tmp_path, rows):
    (tmp_path / "c.csv").write_text("snopes_page,claim_label\nhttp://a,True\nhttp://b,False\n")
    assert rows(source.read_claims(spark, str(tmp_path / "c.csv")), "snopes_page") == [("http://a", True), ("http://b", False)]


def test_corpus(spark, tmp_path, rows):
    (tmp_path / "1.txt").write_text("http://a\nfirst. x\n\nthird\n")
    (tmp_path / "2.txt").write_text("http://b")
    (tmp_path / "3.log").write_text("http://c\nno")
    assert rows(source.read_corpus(spark, str(tmp_path)), "url") == [("http://a", ["first. x", "", "third"]), ("http://b", [])]


def test_ranked_words(spark, tmp_path, rows):
    (tmp_path / "w.txt").write_text("9 the 1\n8 cat 2\n7 the 3\n")
    ranked = source.read_ranked_lines(spark, str(tmp_path / "w.txt"))
    assert rows(features.vocabulary_from_lines(ranked), "token") == [("cat", 2), ("the", 3)]


def test_vectors(spark, tmp_path):
    spark.createDataFrame([("a", [1.0])], schemas.VECTOR).write.parquet(str(tmp_path / "v"))
    assert source.read_vectors(spark, str(tmp_path / "v")).first().vector == [1.0]


def test_days_are_pruned_and_replaced(spark, tmp_path):
    path = str(tmp_path / "d")
    sink.write_day(spark.range(3), path, "2024-01-01")
    sink.write_day(spark.range(5), path, "2024-01-02")
    sink.write_day(spark.range(4), path, "2024-01-02")
    day = source.read_day(spark, path, "2024-01-02")
    assert day.count() == 4 and source.read_day(spark, path, "2024-01-01").count() == 3
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_json_lines_keep_nulls(spark, tmp_path):
    sink.write_json(spark.createDataFrame([("a", None)], "x string, y string"), str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).first()[0] == '{"x":"a","y":null}'


def test_append(spark, tmp_path):
    for _ in range(2):
        sink.append(spark.range(2), str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 4


def test_stored_and_shared_folder(spark):
    assert work_dir(spark).startswith(shared_dir(spark))
    assert fresh_dir(spark, "x").startswith(work_dir(spark)) and fresh_dir(spark, "x") != fresh_dir(spark, "x")
    assert sorted(r.id for r in sink.stored(spark.range(3), "t").collect()) == [0, 1, 2]


def test_topic_wiring(spark):
    options = topics.topic_options("h:1", "nlp", starting_offsets="latest", maxOffsetsPerTrigger="5")
    assert options == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "nlp", "startingOffsets": "latest", "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "5",
    }
    messages = spark.createDataFrame([(bytearray("kä".encode()), bytearray("vö".encode()), datetime.datetime(2024, 1, 1))],
                                     "key binary, value binary, timestamp timestamp")
    assert topics.message_text(messages).first()[:2] == ("kä", "vö")
    with pytest.raises(Exception, match="(?i)kafka"):
        topics.read_topic(spark, "h:1", "nlp")
    with pytest.raises(Exception, match="(?i)kafka"):
        topic_sink.publish_seeds(spark.createDataFrame([("n", "k", "u", "t", 1, 2)], schemas.SEED), "h:1", "a", "b")


def doc(spark, *pairs):
    return spark.createDataFrame(list(pairs), "news_id string, v int")


def current(spark, path):
    return {r.news_id: r.v for r in documents.read_documents(spark, path).collect()}


def test_upsert_replaces_inserts_and_replays(spark, tmp_path):
    path = str(tmp_path / "docs")
    stamp = F.lit("2024-01-01").cast("timestamp")
    documents.upsert(doc(spark, ("a", 1), ("b", 1)), path, 0, stamp)
    documents.upsert(doc(spark, ("b", 2), ("c", 2)), path, 1, stamp)
    once = current(spark, path)
    assert once == {"a": 1, "b": 2, "c": 2}
    documents.upsert(doc(spark, ("b", 2), ("c", 2)), path, 1, stamp)
    assert current(spark, path) == once and documents.read_documents(spark, path).count() == 3


def test_later_null_overwrites(spark, tmp_path):
    path = str(tmp_path / "docs")
    documents.upsert(doc(spark, ("a", 1)), path, 0)
    documents.upsert(doc(spark, ("a", None)), path, 1)
    assert current(spark, path) == {"a": None}


def test_compact_keeps_documents(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    for batch in range(4):
        documents.upsert(doc(spark, ("a", batch), (f"x{batch}", batch)), old, batch)
    documents.compact(spark, old, new)
    assert current(spark, new) == current(spark, old)
    documents.upsert(doc(spark, ("a", 9)), new, 4)
    assert current(spark, new)["a"] == 9


def test_order_column_beats_arrival(spark, tmp_path):
    path = str(tmp_path / "docs")
    documents.upsert(doc(spark, ("a", 5)), path, 0)
    documents.upsert(doc(spark, ("a", 3)), path, 1)
    assert documents.read_documents(spark, path, order=["v"]).first().v == 5


def test_two_writers_keep_both_field_sets(spark, tmp_path):
    path = str(tmp_path / "docs")
    at = lambda day: F.lit(f"2024-01-0{day}").cast("timestamp")
    documents.upsert(spark.createDataFrame([("a", 0.5, "social")], "news_id string, score double, by string"), path, 0, at(1), "social")
    documents.upsert(spark.createDataFrame([("a", "T", "article")], "news_id string, title string, by string"), path, 0, at(2), "articles")
    documents.upsert(spark.createDataFrame([("a", None, "late")], "news_id string, score double, by string"), path, 1, at(3), "social")
    row = documents.read_documents(spark, path).first()
    assert (row.score, row.title, row.by) == (None, "T", "late")
    documents.compact(spark, path, f"{path}-new")
    assert documents.read_documents(spark, f"{path}-new").first().title == "T"


def test_merge_takes_shared_fields_from_the_later_side(spark):
    one = spark.createDataFrame([("a", "zeta", "2024-01-01")], "news_id string, by string, date string")
    two = spark.createDataFrame([("a", "alpha", "2024-01-02")], "news_id string, by string, date string")
    assert documents.merge(one, two).first().by == documents.merge(two, one).first().by == "alpha"


def test_merge_is_full_outer(spark, rows):
    social = spark.createDataFrame([("a", 0, 1.0, "2024-01-02"), ("a", 1, 1.0, "2024-01-02"), ("b", 0, 2.0, "2024-01-01")],
                                   "news_id string, part long, score double, date string")
    article = spark.createDataFrame([("a", "T", "2024-01-01"), ("c", "U", "2024-01-03")], "news_id string, title string, date string")
    merged = documents.merge(social, article)
    assert rows(merged.select("news_id", "part", "score", "title", "date"), "news_id", "part") == [
        ("a", 0, 1.0, "T", "2024-01-02"), ("a", 1, 1.0, None, "2024-01-02"), ("b", 0, 2.0, None, "2024-01-01"),
        ("c", 0, None, "U", "2024-01-03"),
    ]
    assert documents.known_ids(article, social).count() == 1
    assert documents.with_date(article, F.lit("x")).first().date == "x"


def test_strip_newline(spark):
    df = spark.createDataFrame([("a\n",)], "t string")
    assert df.select(text_fn.strip_newline(F.col("t"))).first()[0] == "a"


def test_clear_work_removes_only_the_own_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    (tmp_path / "other").mkdir()
    assert sink.stored(spark.range(3), "x").count() == 3
    assert len(list(tmp_path.iterdir())) == 2
    session.clear_work(spark)
    session.clear_work(spark)
    assert [p.name for p in tmp_path.iterdir()] == ["other"]
