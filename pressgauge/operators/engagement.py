"""Comment threads: weights, weighted sentiment and bounded list roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pressgauge.functions import counts
from pressgauge.functions.text import is_present
from pressgauge.operators.joins import lookup

PART_SIZE = 1000


def thread_comments(threads: DataFrame) -> DataFrame:
    """Stored threads (tweet_url, nodes) as one row per comment with its position and weight."""
    rows = threads.select("tweet_url", F.posexplode("nodes").alias("position", "node"))
    return rows.select("tweet_url", F.col("position").cast("bigint").alias("position"), "node.*") \
        .withColumn("like_count", counts.like_weight(F.col("like_str")))


def attach_comments(
    seeds: DataFrame, comments: DataFrame, *, keep_unmatched: bool = False, small: bool | None = None
) -> DataFrame:
    """Seeds with each non-empty comment on their tweet; seeds without comments vanish unless kept.

    The seeds are the lookup side: a tweet holding a large share of the comments is joined without
    a hot task. Several seeds may share a tweet; the comments then go to each of them.
    """
    useful = comments.where(is_present(F.col("comment")))
    matched = lookup(useful, seeds, "tweet_url", "inner", small=small, salt=F.xxhash64("position"))
    columns = [*seeds.columns, *[c for c in comments.columns if c not in seeds.columns]]
    matched = matched.select(*columns)
    if not keep_unmatched:
        return matched
    silent = seeds.join(useful.select("tweet_url").distinct(), "tweet_url", "left_anti")
    return matched.unionByName(silent, allowMissingColumns=True).select(*columns)


def weighted_mean(score: Column, weight: Column) -> Column:
    """Weighted mean of four-place scores, null where the weights sum to 0.

    Summed as decimals, so the result does not depend on the order of the rows.
    """
    units = F.round(score * 10000).cast("decimal(9,0)")
    counted = F.when(score.isNotNull(), weight).cast("decimal(20,0)")
    total = F.sum(units * weight.cast("decimal(20,0)")).cast("double")
    return F.try_divide(total, F.sum(counted).cast("double")) / 10000


def weighted_sentiment(comments: DataFrame, keys: Sequence[str], score: str = "score", weight: str = "like_count") -> DataFrame:
    """Like-weighted mean sentiment and comment count per key."""
    return comments.groupBy(*keys).agg(
        weighted_mean(F.col(score), F.col(weight)).alias("weighted_sentiment_score"),
        F.count(F.lit(1)).alias("n_comments"),
    )


def thread_parts(
    comments: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    *,
    position: str = "position",
    part_size: int = PART_SIZE,
) -> DataFrame:
    """Aligned lists of comment fields per key and part, in thread order.

    Positions are unique within a thread, so a part holds at most ``part_size`` comments and a
    thread of any length is kept whole without one unbounded group. Short threads have part 0 only.
    """
    part = F.floor(F.col(position) / part_size).cast("bigint")
    rows = F.array_sort(F.collect_list(F.struct(position, *fields)))
    grouped = comments.groupBy(*keys, part.alias("part")).agg(rows.alias("_rows"))
    # A field of an array of structs is the array of that field.
    return grouped.select(*keys, "part", *[F.col(f"_rows.{f}").alias(f) for f in fields])


def latest_counts(seeds: DataFrame, order: str, key: str = "news_id") -> DataFrame:
    """Per key, the row with the newest engagement counts."""
    fields = [c for c in seeds.columns if c not in (key, order)]
    return seeds.groupBy(key).agg(F.max_by(F.struct(order, *fields), order).alias("_row")).select(key, "_row.*")


def keyword_sets(hits: DataFrame) -> DataFrame:
    """Distinct (news_url, tweet_url) pairs, each with its sorted keywords.

    Keywords are de-duplicated before they are collected: a set holds at most the keyword list.
    """
    distinct = hits.select("news_url", "tweet_url", "news_keyword").distinct()
    return distinct.groupBy("news_url", "tweet_url").agg(
        F.array_sort(F.collect_list("news_keyword")).alias("news_keywords")
    )


def group_max_favourites(hits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Largest favourite count per key."""
    return hits.groupBy(*keys).agg(F.max("favorite_count").alias("favorite_count"))
