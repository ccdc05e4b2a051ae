"""Stateful stream operators; every one has a watermark, so its state is bounded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from pressgauge.sinks.documents import merged_fields


def without_replays(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """First row per key within the watermark; a message sent again changes nothing."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def sentiment_sums(scored: DataFrame, keys: Sequence[str], event_time: str, period: str = "1 day") -> DataFrame:
    """Per key and period: score-weight sum, weight sum and comment count.

    Sums can be added up across periods, so a period's state is dropped once its watermark passes.
    """
    weight = F.col("like_count").cast("decimal(20,0)")
    units = F.round(F.col("score") * 10000).cast("decimal(9,0)")
    return scored.groupBy(*keys, F.window(event_time, period).alias("_w")).agg(
        F.sum(units * weight).alias("weighted_sum"),
        F.sum(weight).alias("weight_sum"),
        F.count(F.lit(1)).alias("n_comments"),
    ).select(*keys, F.col("_w.start").alias("period"), "weighted_sum", "weight_sum", "n_comments")


def sentiment_totals(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Weighted sentiment per key from the stored period sums."""
    total = F.sum("weighted_sum").cast("double")
    return sums.groupBy(*keys).agg(
        (F.try_divide(total, F.sum("weight_sum").cast("double")) / 10000).alias("weighted_sentiment_score"),
        F.sum("n_comments").alias("n_comments"),
    )


def latest(stream: DataFrame, keys: Sequence[str], event_time: str, fields: Sequence[str], delay: str, period: str = "1 day") -> DataFrame:
    """Newest values per key and period."""
    rows = stream.withWatermark(event_time, delay)
    newest = F.max(F.struct(F.col(event_time).alias("seen_at"), *fields))
    return rows.groupBy(*keys, F.window(event_time, period).alias("_w")).agg(newest.alias("_r")) \
        .select(*keys, F.col("_w.start").alias("period"), "_r.*")


def outer_join(
    social: DataFrame, articles: DataFrame, key: str, event_time: str, *, delay: str, within: str, article_delay: str | None = None
) -> DataFrame:
    """Two streams as one record per ``key``: full outer join, the fields merged as in a batch merge.

    Rows match if their times lie at most ``within`` apart, so state is dropped once the watermarks
    (``delay``, and ``article_delay`` of the second side) have passed that span; a row that found no match
    by then is released alone. Null keys match nothing.
    """
    left = social.withColumn("_s", F.lit(True)).withWatermark(event_time, delay).alias("s")
    right = articles.withColumn("_a", F.lit(True)).withWatermark(event_time, article_delay or delay).alias("a")
    mine, theirs, span = F.col(f"s.{event_time}"), F.col(f"a.{event_time}"), F.expr(f"interval {within}")
    near = (F.col(f"s.{key}") == F.col(f"a.{key}")) & (theirs >= mine - span) & (theirs <= mine + span)
    joined = left.join(right, near, "full_outer")
    fields = merged_fields(social.columns, articles.columns, (key,), event_time)
    return joined.select(F.coalesce(f"s.{key}", f"a.{key}").alias(key), *fields)
