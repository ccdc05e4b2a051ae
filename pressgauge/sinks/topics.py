"""Message sinks. The broker sink needs Spark's Kafka connector on the classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from pressgauge.operators.records import NEWS_FIELDS, SOCIAL_FIELDS, encode_messages, json_payload


def write_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Batch write of (key, value) rows."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def publish_seeds(
    seeds: DataFrame, servers: str, social_topic: str, news_topic: str, *, delimited: bool = False, key_length: int | None = None
) -> None:
    """Publish seeds: all fields to the social topic, id and address to the news topic.

    One JSON record per message; ``delimited`` sends many records per message instead.
    """
    for topic, names in ((social_topic, SOCIAL_FIELDS), (news_topic, NEWS_FIELDS)):
        part = seeds.select(*names)
        messages = encode_messages(part, names, key_length=key_length) if delimited else json_payload(part)
        write_topic(messages, servers, topic)


def stream_writer(
    messages: DataFrame, checkpoint: str, mode: str = "update", name: str | None = None, interval: str | None = None,
    available_now: bool = False,
) -> DataStreamWriter:
    """Writer with its own checkpoint folder; two queries must never share one."""
    writer = messages.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval) if interval else writer


def stream_to_topic(messages: DataFrame, servers: str, topic: str, checkpoint: str, mode: str = "update", **how) -> StreamingQuery:
    """Start a keyed stream to a topic: update by default, complete for full results, append without state."""
    return (
        stream_writer(messages, checkpoint, mode, **how).format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic).start()
    )


def stream_to_console(messages: DataFrame, checkpoint: str, mode: str = "update", **how) -> StreamingQuery:
    """Start a stream to the console."""
    return stream_writer(messages, checkpoint, mode, **how).format("console").start()


def stream_to_files(rows: DataFrame, path: str, checkpoint: str, file_format: str = "json", **how) -> StreamingQuery:
    """Start an append stream to files; aggregates arrive once their watermark has passed."""
    return stream_writer(rows, checkpoint, "append", **how).format(file_format).option("path", path).start()
