"""From raw tweets to one most-favourited tweet per article."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pressgauge.functions import text as text_fn
from pressgauge.operators.joins import lookup

# Link texts that mark shops, players and social pages instead of articles.
EXCLUDED_HOSTS = (
    "twitter", "youtube.", "youtu.be", "goo.gl", ".tv", "tv.", "itunes.", "itun.es", "apple.co",
    "open.spotify", "hyperurl.co", "amazon.", "amzn.", "smarturl.",
)
MIN_FAVOURITES = 1000


def created_day_hour(created_at: Column) -> tuple[Column, Column]:
    """Day string and hour of a ``Wed Mar 27 18:05:09 +0000 2019`` stamp, in the stamp's own zone."""
    local = F.concat_ws(" ", F.substring(created_at, 5, 15), F.substring(created_at, 27, 4))
    stamp = F.try_to_timestamp(local, F.lit("MMM dd HH:mm:ss yyyy"))
    return F.date_format(stamp, "yyyy-MM-dd"), F.hour(stamp)


def status_url(screen_name: Column, id_str: Column) -> Column:
    """Address of a tweet."""
    return F.concat(F.lit("https://twitter.com/"), screen_name, F.lit("/status/"), id_str)


def flatten_tweets(tweets: DataFrame) -> DataFrame:
    """One flat row per tweet; a retweet shows the counts, text and address of its original.

    The link is the tweet's first one; that of the original takes its place only if the original's
    first link starts with ``https``.
    """
    original = F.col("retweeted_status")
    is_retweet = original.isNotNull()

    def own(field: str) -> Column:
        return F.when(is_retweet, F.col(f"retweeted_status.{field}")).otherwise(F.col(field))

    first = F.get("entities.urls", F.lit(0))
    inner = F.get("retweeted_status.entities.urls", F.lit(0))
    day, hour = created_day_hour(F.col("created_at"))
    return tweets.select(
        F.col("id").alias("tweet_id"),
        "created_at", day.alias("day"), hour.alias("hour"), "lang",
        own("retweet_count").cast("bigint").alias("retweet_count"),
        own("favorite_count").cast("bigint").alias("favorite_count"),
        own("text").alias("text"),
        status_url(own("user.screen_name"), own("id_str")).alias("tweet_url"),
        F.when(is_retweet & F.startswith(inner["url"], F.lit("https")), inner["expanded_url"])
        .otherwise(first["expanded_url"]).alias("news_url"),
        (F.size("entities.urls") > 0).alias("has_link"),
    )


def is_article_link(url: Column, excluded: Sequence[str] = EXCLUDED_HOSTS) -> Column:
    """True for a non-null link that contains none of the excluded texts."""
    hit = F.lit(False)
    for part in excluded:
        hit = hit | F.contains(url, F.lit(part))
    return url.isNotNull() & ~hit


def keep_article_links(tweets: DataFrame, url: str = "news_url", excluded: Sequence[str] = EXCLUDED_HOSTS) -> DataFrame:
    """Rows whose link may be an article."""
    return tweets.where(is_article_link(F.col(url), excluded))


def keep_popular(tweets: DataFrame, minimum: int = MIN_FAVOURITES) -> DataFrame:
    """Rows with at least ``minimum`` favourites."""
    return tweets.where(F.col("favorite_count") >= F.lit(minimum))


def phrase_rows(df: DataFrame, ids: Sequence[str], tokens: Column, lengths: Sequence[int]) -> DataFrame:
    """Runs of as many words as ``lengths`` says per row: id columns and ``phrase``."""
    words = df.select(*ids, tokens.alias("_w"))

    def runs_of(n: int) -> Column:
        starts = F.slice(F.sequence(F.lit(0), F.size("_w")), F.lit(1), F.greatest(F.size("_w") - (n - 1), F.lit(0)))
        return F.transform(starts, lambda i: F.concat_ws(" ", *[F.get("_w", i + k) for k in range(n)]))

    runs = [F.col("_w") if n == 1 else runs_of(n) for n in lengths or [1]]
    return words.select(*ids, F.explode(F.concat(*runs) if len(runs) > 1 else runs[0]).alias("phrase"))


def phrase_lengths(phrases: DataFrame, phrase: str = "phrase") -> list[int]:
    """The word counts that occur among a dictionary's phrases, so that only such runs are built."""
    words = F.size(text_fn.letter_tokens(F.col(phrase)))
    found = phrases.agg(F.collect_set(words).alias("n")).first().n
    return sorted(n for n in found if n > 0)


def search_keywords(
    tweets: DataFrame,
    keywords: DataFrame,
    ids: Sequence[str],
    *,
    text: str = "text",
    small: bool | None = None,
) -> DataFrame:
    """Distinct (ids, ``news_keyword``) for keywords whose words occur in a row in the text.

    Keywords and texts are compared as lower-cased words, by an equi-join on word runs: no keyword
    is tested against a text it shares no run with. The keyword table is read once for the lengths of its
    keywords and once for the join; store it if it is dear to make.
    """
    normal = F.array_join(text_fn.letter_tokens(F.col("keyword")), " ")
    table = keywords.select(normal.alias("phrase"), F.col("keyword").alias("news_keyword")) \
        .where(F.col("phrase") != "").distinct()
    runs = phrase_rows(tweets, ids, text_fn.letter_tokens(F.col(text)), phrase_lengths(table))
    return lookup(runs, table, "phrase", small=small, salt=F.xxhash64(*ids)).select(*ids, "news_keyword").distinct()


def searchable(tweets: DataFrame, language: str = "en") -> DataFrame:
    """Tweets in the language that carry a link."""
    return tweets.where((F.col("lang") == language) & F.col("has_link"))


def find_hits(
    tweets: DataFrame, keywords: DataFrame, *, minimum: int = MIN_FAVOURITES, small: bool | None = None,
) -> DataFrame:
    """Hits (tweet_id, news_keyword, counts, urls) of keywords in flattened tweets.

    The cheap filters run before the texts are searched.
    """
    pool = keep_article_links(keep_popular(searchable(tweets), minimum))
    columns = ["tweet_id", "retweet_count", "favorite_count", "tweet_url", "news_url"]
    found = search_keywords(pool, keywords, columns, small=small)
    return found.select("tweet_id", "news_keyword", "retweet_count", "favorite_count", "tweet_url", "news_url")


def first_per_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row per key in the given total order.

    Spark limits each key to one row per task before the shuffle, so a hot key stays cheap.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def drop_repeated_pairs(hits: DataFrame, *order: Column) -> DataFrame:
    """One hit per (news_url, tweet_url), the first in the given order."""
    return first_per_key(hits, ["news_url", "tweet_url"], *order)


def top_per_article(hits: DataFrame, *tie_break: Column) -> DataFrame:
    """The most-favourited hit per article; ties go to the first in ``tie_break`` order."""
    return first_per_key(hits, ["news_url"], F.desc("favorite_count"), *tie_break)


def with_news_id(df: DataFrame, random: bool = False) -> DataFrame:
    """Add ``news_id``: a hash of the article's address, so a rerun gives the same id.

    ``random`` gives fresh ids; write such a result once before using it twice.
    """
    return df.withColumn("news_id", F.uuid() if random else F.sha2("news_url", 256))


def seeds(hits: DataFrame, *tie_break: Column) -> DataFrame:
    """One seed row per article."""
    order = tie_break or (F.col("tweet_id"), F.col("news_keyword"))
    best = top_per_article(drop_repeated_pairs(hits, *order), *order)
    return with_news_id(best).select(
        "news_id", "news_keyword", "news_url", "tweet_url", "retweet_count", "favorite_count"
    )
