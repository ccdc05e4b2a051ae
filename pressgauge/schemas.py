"""Declared schemas of every record the jobs read or write."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


STRING, LONG, DOUBLE, INT = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType()

HEADLINE = _struct(
    ("title", STRING), ("description", STRING), ("content", STRING), ("url", STRING),
    ("lang", STRING),
)

_URL = _struct(("url", STRING), ("expanded_url", STRING))
_TWEET_FIELDS = (
    ("id", LONG), ("id_str", STRING), ("created_at", STRING), ("text", STRING), ("lang", STRING),
    ("retweet_count", LONG), ("favorite_count", LONG),
    ("user", _struct(("screen_name", STRING))),
    ("entities", _struct(("urls", T.ArrayType(_URL)))),
)
TWEET = _struct(*_TWEET_FIELDS, ("retweeted_status", _struct(*_TWEET_FIELDS)))

SEED = T.StructType([
    T.StructField("news_id", STRING, False),
    T.StructField("news_keyword", STRING, False),
    T.StructField("news_url", STRING, False),
    T.StructField("tweet_url", STRING, False),
    T.StructField("retweet_count", LONG, False),
    T.StructField("favorite_count", LONG, False),
])

THREAD = _struct(
    ("tweet_url", STRING),
    ("nodes", T.ArrayType(_struct(("like_str", STRING), ("comment_time", STRING), ("comment", STRING)))),
)

CLAIM = _struct(("snopes_page", STRING), ("claim_label", T.BooleanType()))

VECTOR = _struct(("token", STRING), ("vector", T.ArrayType(T.FloatType())))
