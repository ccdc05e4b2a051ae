"""Delimited and JSON message records."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pressgauge import schemas

ROW_SEPARATOR, FIELD_SEPARATOR = ";", ","
SOCIAL_FIELDS = ("news_id", "news_keyword", "news_url", "tweet_url", "retweet_count", "favorite_count")
NEWS_FIELDS = ("news_id", "news_url")
COUNT_FIELDS = ("retweet_count", "favorite_count")


def split_records(messages: DataFrame, value: str = "value") -> DataFrame:
    """One row per delimited record: other columns, ``record`` text and ``fields`` array."""
    others = [c for c in messages.columns if c != value]
    records = messages.select(*others, F.explode(F.split(F.col(value).cast("string"), ROW_SEPARATOR)).alias("record"))
    return records.withColumn("fields", F.split("record", FIELD_SEPARATOR))


def decode_records(
    messages: DataFrame, names: Sequence[str] = SOCIAL_FIELDS, value: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """Typed records and, apart, the records with a wrong field count or an unreadable number."""
    split = split_records(messages, value)
    others = [c for c in split.columns if c not in ("record", "fields")]
    columns = [
        F.get("fields", F.lit(i)).try_cast("bigint").alias(name) if name in COUNT_FIELDS
        else F.get("fields", F.lit(i)).alias(name)
        for i, name in enumerate(names)
    ]
    parsed = split.select(*others, "record", F.size("fields").alias("_n"), *columns)
    sound = F.col("_n") == len(names)
    for name in names:
        if name in COUNT_FIELDS:
            sound = sound & F.col(name).isNotNull()
    return parsed.where(sound).select(*others, *names), parsed.where(~sound).select(*others, "record")


def record_text(names: Sequence[str]) -> Column:
    """One delimited record; nulls become empty fields."""
    return F.concat_ws(FIELD_SEPARATOR, *[F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names])


def message_key_length(rows: int, rows_per_message: int = 1000) -> int:
    """How many leading hex digits of a hashed id give messages of about the wanted size."""
    return max(0, math.ceil(math.log(max(rows, 1) / rows_per_message, 16)))


def encode_messages(
    seeds: DataFrame, names: Sequence[str] = SOCIAL_FIELDS, *, key_length: int | None = None, key: str = "news_id",
    rows_per_message: int = 1000,
) -> DataFrame:
    """Delimited messages (key, value) for consumers that read many records per message.

    Records are grouped by the first digits of the hashed id. The digits are uniform, so messages
    are even in size. Unless ``key_length`` is given the seeds are counted, and as many digits are taken
    as keep messages at about ``rows_per_message`` records.
    """
    if key_length is None:
        key_length = message_key_length(seeds.count(), rows_per_message)
    records = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), record_text(names).alias("r"))))
    grouped = seeds.groupBy(F.left(F.col(key), F.lit(key_length)).alias("key")).agg(records.alias("_r"))
    return grouped.select("key", F.array_join(F.transform("_r", lambda x: x.r), ROW_SEPARATOR).alias("value"))


def json_payload(df: DataFrame, key: str = "news_id") -> DataFrame:
    """(key, value) rows: the whole row as one JSON text, null fields included."""
    payload = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.select(F.col(key).cast("string").alias("key"), payload.alias("value"))


def parse_payload(messages: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Columns of a JSON payload by key; unreadable payloads give nulls."""
    others = [c for c in messages.columns if c != value]
    parsed = F.from_json(F.col(value).cast("string"), schema, {"mode": "PERMISSIVE"})
    return messages.select(*others, parsed.alias("_p")).select(*others, "_p.*")


def parse_payload_checked(
    messages: DataFrame, schema: T.StructType, required: Sequence[str], value: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """Parsed payloads and, apart, the raw values that lack a required field."""
    parsed = messages.withColumn("_p", F.from_json(F.col(value).cast("string"), schema, {"mode": "PERMISSIVE"}))
    missing = F.col("_p").isNull()
    for name in required:
        missing = missing | F.col(f"_p.{name}").isNull()
    others = [c for c in messages.columns if c != value]
    return parsed.where(~missing).select(*others, "_p.*"), parsed.where(missing).select(value)


class Kind(NamedTuple):
    """A message kind: the key by which it is known, and its fields."""

    mark: str
    schema: T.StructType


def route_messages(messages: DataFrame, kinds: dict[str, Kind], value: str = "value") -> DataFrame:
    """Messages with ``message``, their JSON as VARIANT, and ``kind``: the first whose mark they carry.

    The text is parsed once, whatever the kinds. ``kind`` is null for text that is no JSON object, has no
    ``news_id`` or carries no mark.
    """
    parsed = messages.withColumn("message", F.try_parse_json(F.col(value).cast("string")))
    has_id = F.try_variant_get("message", "$.news_id", "string").isNotNull()
    kind = F.coalesce(*[F.when(F.try_variant_get("message", f"$.{k.mark}", "variant").isNotNull(), F.lit(name)) for name, k in kinds.items()])
    return parsed.withColumn("kind", F.when(has_id, kind))


def of_kind(routed: DataFrame, name: str, kind: Kind, keep: Sequence[str] = ("timestamp",)) -> DataFrame:
    """The messages of one kind by field; a field that is missing or of another type is null."""
    fields = [F.try_variant_get("message", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in kind.schema.fields]
    return routed.where(F.col("kind") == name).select(*fields, *keep)


def social_document(scores: DataFrame) -> DataFrame:
    """Social result under the field names of the document table."""
    return scores.withColumnRenamed("sentiment_scores", "comments_sentiment_scores")


def article_document(articles: DataFrame) -> DataFrame:
    """Article result under the field names of the document table."""
    return articles.withColumnRenamed("sentiment_scores", "news_sentiment_scores")


def seed_records(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy the declared seed schema, cast to it, and the rows that do not."""
    names = [f.name for f in schemas.SEED.fields]
    typed = df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schemas.SEED.fields])
    whole = F.lit(True)
    for name in names:
        whole = whole & F.col(name).isNotNull()
    return typed.where(whole), typed.where(~whole)
