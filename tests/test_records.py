from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pressgauge import schemas
from pressgauge.operators import records


def test_decode_reads_favourites_from_their_own_field(spark, rows):
    df = spark.createDataFrame([("n1,k,u,t,3,2000;n2,k,u2,t2,4,9",)], "value string")
    good, bad = records.decode_records(df)
    assert rows(good, "news_id") == [("n1", "k", "u", "t", 3, 2000), ("n2", "k", "u2", "t2", 4, 9)]
    assert bad.count() == 0


def test_decode_quarantines(spark, rows):
    df = spark.createDataFrame([("a,b;n,k,u,t,x,1;n,k,u,t,1,2,3;n,k,u,t,1,2",)], "value string")
    good, bad = records.decode_records(df)
    assert good.count() == 1
    assert rows(bad, "record") == [("a,b",), ("n,k,u,t,1,2,3",), ("n,k,u,t,x,1",)]


def test_news_records(spark, rows):
    df = spark.createDataFrame([(bytearray(b"n1,u1;n2,u2"),)], "value binary")
    assert rows(records.decode_records(df, records.NEWS_FIELDS)[0], "news_id") == [("n1", "u1"), ("n2", "u2")]


field = st.text(st.characters(blacklist_characters=",;", codec="utf-8", blacklist_categories=("Cs",)), max_size=8)


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(field, st.tuples(field, field, field, st.integers(0, 10**12), st.integers(0, 10**12)), min_size=1, max_size=8))
def test_decode_inverts_encode(spark, table):
    df = spark.createDataFrame([(k, *v) for k, v in table.items()], schemas.SEED)
    keyed = df.withColumn("hash", F.sha2("news_id", 256))
    messages = records.encode_messages(keyed, key="hash", key_length=1).select("value")
    back, bad = records.decode_records(messages)
    assert {r[0]: tuple(r[1:]) for r in back.collect()} == table and bad.count() == 0


def test_message_key_length():
    assert [records.message_key_length(n) for n in (0, 1000, 1001, 16_000, 16_001, 10**9)] == [0, 0, 1, 1, 2, 5]


def test_payload_keeps_nulls(spark):
    df = spark.createDataFrame([("n", None)], "news_id string, news_image string")
    message = records.json_payload(df).first()
    assert message.key == "n" and message.value == '{"news_id":"n","news_image":null}'


def test_payload_parse_checked(spark):
    schema = schemas._struct(("news_id", schemas.STRING), ("n", schemas.LONG))
    df = spark.createDataFrame([('{"news_id":"a","n":1}',), ("junk",), ('{"n":2}',)], "value string")
    good, bad = records.parse_payload_checked(df, schema, ["news_id"])
    assert [tuple(r) for r in good.collect()] == [("a", 1)]
    assert sorted(r.value for r in bad.collect()) == ["junk", '{"n":2}']


def test_seed_schema_is_applied(spark):
    names = "news_id string, news_keyword string, news_url string, tweet_url string, retweet_count string, favorite_count string"
    df = spark.createDataFrame([("n", "k", "u", "t", "1", "2"), ("n", None, "u", "t", "1", "2"), ("n", "k", "u", "t", "x", "2")], names)
    good, bad = records.seed_records(df)
    assert good.count() == 1 and bad.count() == 2


def test_renames(spark):
    df = spark.createDataFrame([(1,)], "sentiment_scores int")
    assert records.social_document(df).columns == ["comments_sentiment_scores"]
    assert records.article_document(df).columns == ["news_sentiment_scores"]
