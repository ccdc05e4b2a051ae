"""Sentiment sums that lose no late row.

``transformWithState`` keeps one mark per comment until a timer clears it, so replays count once and state is
bounded. It sees the watermark but drops nothing: rows behind it are marked late, go to a side table and
are added when the totals are read, so they are both counted and reported.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from pressgauge.sinks import documents
from pressgauge.sinks.topics import stream_writer
from pressgauge.streaming import state

# The process that sets the processor up on the driver has no files that were sent to the workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_variables(session: SparkSession) -> None:
    """Choose the state store that ``transformWithState`` needs; a running stream keeps its own."""
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


class FirstOnly(StatefulProcessor):
    """The first row per key, with ``is_late``; the key is forgotten ``horizon`` ms after row and watermark."""

    def __init__(self, time: str, columns: Sequence[str], horizon: int) -> None:
        self.time, self.columns, self.horizon = time, list(columns), horizon

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "at long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        newest, clock = None, timerValues.getCurrentWatermarkInMs()
        known = self.seen.exists()
        for row in rows:
            at = row[self.time]
            if not known:
                known = True
                yield Row(**{c: row[c] for c in self.columns}, is_late=at < clock)
            newest = at if newest is None else max(newest, at)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.seen.update((newest,))
        self.handle.registerTimer(max(newest, clock) + self.horizon)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def first_rows(stream: DataFrame, ids: Sequence[str], event_time: str, *, delay: str, horizon: int) -> DataFrame:
    """One row per ``ids`` with ``is_late``: whether it came behind the watermark; none is dropped.

    A row sent again within ``horizon`` milliseconds changes nothing. Rows without time are left out.
    """
    marked = stream.where(F.col(event_time).isNotNull()).withWatermark(event_time, delay)
    # A plain number, as rows behind the watermark of a watched column would be dropped.
    columns = stream.columns
    rows = marked.withColumn("_at", F.unix_millis(event_time)).withColumn(event_time, F.timestamp_millis("_at"))
    schema = T.StructType([*stream.schema.fields, T.StructField("is_late", T.BooleanType())])
    return rows.groupBy(*ids).transformWithState(
        statefulProcessor=FirstOnly("_at", columns, horizon), outputStructType=schema, outputMode="Append", timeMode="EventTime"
    )


def sentiment_stream(
    scored: DataFrame, keys: Sequence[str], comment_ids: Sequence[str], event_time: str, path: str, late_path: str, checkpoint: str,
    *, delay: str, horizon: int, **how,
) -> StreamingQuery:
    """Add each micro-batch's like-weighted sums to ``path``, those of its late rows to ``late_path``."""
    rows = first_rows(scored, comment_ids, event_time, delay=delay, horizon=horizon)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for late, target in ((False, path), (True, late_path)):
                own = batch.where(F.col("is_late") == late)
                documents.upsert(state.sentiment_sums(own, keys, event_time), target, batch_id)
        finally:
            batch.unpersist()

    return stream_writer(rows, checkpoint, "append", **how).foreachBatch(write).start()


def current_sentiment(spark: SparkSession, path: str, late_path: str, keys: Sequence[str]) -> DataFrame:
    """Weighted sentiment per key from the sums on time and the late ones, with both counts."""
    sums = spark.read.parquet(path).withColumn("n_late", F.lit(0).cast("bigint"))
    late = spark.read.parquet(late_path).withColumn("n_late", F.col("n_comments"))
    columns = [*keys, "weighted_sum", "weight_sum", "n_comments", "n_late"]
    both = sums.select(*columns).unionByName(late.select(*columns))
    totals = state.sentiment_totals(both, keys)
    return totals.join(both.groupBy(*keys).agg(F.sum("n_late").alias("n_late")), list(keys))
