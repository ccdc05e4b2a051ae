"""The social side: comments of each seed's tweet, scored, lemmatized and rolled up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from pressgauge.functions import text as text_fn
from pressgauge.operators import engagement
from pressgauge.operators.joins import lookup, unique
from pressgauge.operators.sentiment import compound

SEED_FIELDS = ("news_id", "news_keyword", "retweet_count", "favorite_count", "news_url", "tweet_url")


def annotate(
    comments: DataFrame,
    ids: Sequence[str],
    *,
    lexicon: DataFrame,
    stop: DataFrame,
    lemmas: DataFrame,
    speech: DataFrame,
    tags: Sequence[str] = ("a", "s", "JJ", "JJS"),
    small: bool | None = None,
) -> DataFrame:
    """Score, lemma count and adjectives per comment, in one pass over its tokens.

    The score counts every token of the raw text; lemmas are looked up after stop words are taken
    out, and adjectives among the lemmas keep their order and repeats.
    """
    rows = comments.select(*ids, F.posexplode_outer(text_fn.letter_tokens(F.col("comment"))).alias("pos", "token"))
    rows = lookup(rows, unique(lexicon.select("token", "valence"), "token", small), "token", "left", small=small)
    rows = lookup(rows, stop.select("token").distinct().withColumn("is_stop", F.lit(True)), "token", "left", small=small)
    rows = lookup(rows, unique(lemmas.select("token", "lemma"), "token", small), "token", "left", small=small)
    adjectives = speech.where(F.col("pos").isin(*tags)).select(F.col("token").alias("lemma"), F.lit(True).alias("is_tagged")).distinct()
    rows = lookup(rows, adjectives, "lemma", "left", small=small)
    kept = F.col("is_stop").isNull() & F.col("lemma").isNotNull()
    picked = F.when(kept & F.col("is_tagged"), F.struct("pos", "lemma"))
    return rows.groupBy(*ids).agg(
        compound(F.sum(F.coalesce("valence", F.lit(0.0)))).alias("score"),
        F.count_if(kept).alias("n_lemmas"),
        F.array_join(F.transform(F.array_sort(F.collect_list(picked)), lambda x: x.lemma), " ").alias("adjectives"),
    )


def score_comments(seeds: DataFrame, comments: DataFrame, **tables: DataFrame) -> DataFrame:
    """Comment rows of all seeds with score and adjectives; comments without lemmas are dropped.

    A comment is known by article, tweet and position, as an article may have had several tweets.
    """
    joined = engagement.attach_comments(seeds.select(*SEED_FIELDS), comments)
    ids = ["news_id", "tweet_url", "position"]
    notes = annotate(joined.select(*ids, "comment"), ids, **tables)
    return joined.join(notes.where(F.col("n_lemmas") > 0).drop("n_lemmas"), ids)


def roll_up(scored: DataFrame, *, part_size: int = engagement.PART_SIZE) -> DataFrame:
    """Social results per (news_id, tweet_url, part): lists in thread order, and the thread's weighted score.

    The score covers the whole thread and stands in every part; most threads have one part.
    """
    parts = engagement.thread_parts(
        scored, list(SEED_FIELDS), ["comment", "adjectives", "score", "like_count", "comment_time"], part_size=part_size
    )
    means = engagement.weighted_sentiment(scored, ["news_id", "tweet_url"])
    return parts.join(means, ["news_id", "tweet_url"]).select(
        *SEED_FIELDS, "part",
        F.col("comment").alias("tweets_comment"),
        F.array_join(F.filter("adjectives", lambda a: a != ""), " ").alias("tweets_tokens"),
        F.col("score").alias("sentiment_scores"),
        F.col("like_count").alias("like_counts"),
        F.array_join("comment_time", ",").alias("comment_time"),
        "weighted_sentiment_score",
    )
