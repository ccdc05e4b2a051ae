"""The daily batch jobs, one function per stage, each over one day's tables.

Stages meet only in tables partitioned by ``day``, so any of them can be run again for a day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pressgauge.functions.text import whitespace_tokens
from pressgauge.operators import articles, credibility, keywords, records, social, tweets
from pressgauge.sinks import documents, files as sink
from pressgauge.sources import files as source, folder_topic


def collect_keywords(spark: SparkSession, headlines: str, gazetteer: DataFrame, out: str, day: str) -> None:
    """Headlines of the day to the day's keywords."""
    titles = keywords.headline_titles(source.read_day(spark, headlines, day))
    sink.write_day(keywords.mine_keywords(titles, gazetteer), out, day)


def collect_seeds(spark: SparkSession, raw_tweets: str, keyword_table: str, out: str, day: str) -> None:
    """Tweets and keywords of the day to one seed per article."""
    flat = tweets.flatten_tweets(source.read_day(spark, raw_tweets, day))
    words = source.read_day(spark, keyword_table, day)
    sink.write_day(tweets.seeds(tweets.find_hits(flat, words)), out, day)


def publish_seeds(spark: SparkSession, seed_table: str, social_topic: str, news_topic: str, day: str) -> None:
    """The day's seeds to the social topic, their ids and addresses to the news topic; a day is published once."""
    seeds = source.read_day(spark, seed_table, day)
    for topic, fields in ((social_topic, records.SOCIAL_FIELDS), (news_topic, records.NEWS_FIELDS)):
        folder_topic.publish(records.json_payload(seeds.select(*fields)), topic, mark=day)


def score_day(spark: SparkSession, seed_table: str, comments: DataFrame, tables: dict[str, DataFrame], out: str, day: str) -> None:
    """The day's seeds to the day's social results."""
    sink.write_day(social_results(source.read_day(spark, seed_table, day), comments, tables), out, day)


def article_day(
    spark: SparkSession, seed_table: str, pages: DataFrame, tables: dict[str, DataFrame], out: str, day: str, model=None
) -> None:
    """The day's seeds to the day's article results, judged by the model if given."""
    found = article_results(source.read_day(spark, seed_table, day), pages, tables)
    sink.write_day(found if model is None else judge(model, found), out, day)


def merge_day(spark: SparkSession, social_table: str, article_table: str, path: str, day: str, batch_id: int) -> None:
    """The day's results as documents into the document table; a later day's news of an article wins."""
    merged = news_documents(source.read_day(spark, social_table, day), source.read_day(spark, article_table, day))
    dated = documents.with_date(merged, F.lit(day).cast("date"))
    documents.upsert(dated, path, batch_id, modified=F.lit(day).cast("timestamp"), writer="daily")


def social_results(seeds: DataFrame, comments: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Social results of the seeds, per thread part."""
    scored = sink.stored(social.score_comments(seeds, comments, **tables), "scored")
    return social.roll_up(scored)


def article_results(seeds: DataFrame, pages: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Article results of the seeds."""
    extracted = sink.stored(articles.fetch(seeds, pages), "articles")
    return articles.enrich(extracted, **tables)


def news_documents(social_rows: DataFrame, article_rows: DataFrame) -> DataFrame:
    """One record per article from both result sets."""
    return documents.merge(records.social_document(social_rows), records.article_document(article_rows))


def judge(model, article_rows: DataFrame) -> DataFrame:
    """Article results with the classifier's verdict."""
    ready = article_rows.withColumn("tokens", whitespace_tokens(article_rows.news_tokens))
    return credibility.predict(model, ready, article_rows.columns)
