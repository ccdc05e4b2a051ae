"""The streaming jobs: score comments, keep sentiment current, enrich articles, upsert documents."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from pressgauge.functions import text as text_fn
from pressgauge.operators import articles, credibility, engagement, records, sentiment, social, tweets
from pressgauge.sinks import documents
from pressgauge.sinks.files import stored
from pressgauge.sinks.topics import stream_writer
from pressgauge.sources import folder_topic
from pressgauge.sources.page_store import PageStore
from pressgauge.streaming import state

DAY = "1 day"


def upsert_stream(
    rows: DataFrame, path: str, checkpoint: str, *, mode: str = "update",
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None, modified: Column | None = None, writer: str = "main",
    fold_at: int | None = None, fold_keys: Sequence[str] = ("news_id",), fold_order: Sequence[str] = (), **how,
) -> StreamingQuery:
    """Upsert every micro-batch into a document table, after an optional batch transformation.

    ``transform`` may read its input several times: the batch, or what ``prepare`` makes of it, is
    computed once and kept until the batch is written. Streams that share a table need a ``writer`` name each.
    With ``fold_at`` the batches are folded once there are more of them; a table that several streams write should
    be folded by one of them only.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        put(batch, batch_id)
        if fold_at is not None:
            documents.fold(batch.sparkSession, path, fold_at, fold_keys, fold_order)

    def put(batch: DataFrame, batch_id: int) -> None:
        if transform is None:
            documents.upsert(batch, path, batch_id, modified, writer)
            return
        batch.persist()
        frame = prepare(batch).persist() if prepare else batch
        try:
            if batch_id == 0 or not batch.isEmpty():
                documents.upsert(transform(frame), path, batch_id, modified, writer)
        finally:
            frame.unpersist()
            batch.unpersist()

    return stream_writer(rows, checkpoint, mode, **how).foreachBatch(write).start()


def score_comment_stream(
    comments: DataFrame, comment_ids: Sequence[str], carried: Sequence[str], event_time: str, lexicon: DataFrame,
    path: str, checkpoint: str, *, delay: str = DAY, **how,
) -> StreamingQuery:
    """Score each comment once, by micro-batch, and store the scores with the carried columns."""
    once = state.without_replays(comments, comment_ids, event_time, delay)
    return upsert_stream(
        once, path, checkpoint, mode="append",
        transform=lambda batch: sentiment.score_texts(batch, [*comment_ids, *carried, event_time], "comment", lexicon), **how,
    )


def sentiment_stream(
    scored: DataFrame, keys: Sequence[str], comment_ids: Sequence[str], event_time: str, path: str, checkpoint: str,
    *, delay: str = DAY, mode: str = "update", **how,
) -> StreamingQuery:
    """Keep the like-weighted sums per key current; replayed comments count once."""
    once = state.without_replays(scored, comment_ids, event_time, delay)
    return upsert_stream(state.sentiment_sums(once, keys, event_time), path, checkpoint, mode=mode, **how)


def social_stream(
    seeds: DataFrame, comments: DataFrame, tables: dict[str, DataFrame], path: str, checkpoint: str,
    *, event_time: str = "timestamp", delay: str = DAY, **how,
) -> StreamingQuery:
    """Comments of each newly seen seed, scored and stored one row per (news_id, tweet_url, position)."""
    once = state.without_replays(seeds, ["news_id", "tweet_url"], event_time, delay)
    return upsert_stream(
        once, path, checkpoint, mode="append",
        transform=lambda batch: social.score_comments(batch, comments, **tables), **how,
    )


def seed_table_stream(seeds: DataFrame, path: str, checkpoint: str, *, event_time: str = "timestamp", **how) -> StreamingQuery:
    """Keep the newest state of every seed per (news_id, tweet_url)."""
    keys = ["news_id", "tweet_url"]
    columns = [*social.SEED_FIELDS, event_time]
    return upsert_stream(
        seeds.select(*columns), path, checkpoint, mode="append", modified=F.col(event_time),
        transform=lambda batch: _newest(batch, keys, event_time), **how,
    )


def comment_table_stream(
    comments: DataFrame, tables: dict[str, DataFrame], path: str, checkpoint: str, *, event_time: str = "event_time", **how
) -> StreamingQuery:
    """Keep the newest state of every comment, scored, per (tweet_url, position).

    There is no watermark and no state: a resent comment replaces its former counts, and a late one
    takes its place by its own time, so that none is lost.
    """
    keys = ["tweet_url", "position"]

    def scored(batch: DataFrame) -> DataFrame:
        newest = _newest(batch, keys, event_time)
        return newest.join(social.annotate(newest.select(*keys, "comment"), keys, **tables), keys)

    return upsert_stream(comments, path, checkpoint, mode="append", modified=F.col(event_time), transform=scored, **how)


def _newest(batch: DataFrame, keys: Sequence[str], event_time: str) -> DataFrame:
    others = [F.desc(c) for c in batch.columns if c not in (*keys, event_time)]
    return tweets.first_per_key(batch, keys, F.desc(event_time), *others)


def current_social(spark: SparkSession, seeds: str, comments: str) -> DataFrame:
    """Social results from the tables of the two streams above, as they stand now."""
    asked = documents.read_documents(spark, seeds, ["news_id", "tweet_url"]).select(*social.SEED_FIELDS)
    said = documents.read_documents(spark, comments, ["tweet_url", "position"]).where("n_lemmas > 0")
    return social.roll_up(stored(engagement.attach_comments(asked, said), "current"))


def _pages(pages: DataFrame | PageStore, batch: DataFrame) -> DataFrame:
    """The stored pages a batch may need: all of them, or the buckets of its addresses."""
    return pages.wanted(batch, "news_url") if isinstance(pages, PageStore) else pages


def article_stream(
    seeds: DataFrame, pages: DataFrame | PageStore, tables: dict[str, DataFrame], path: str, checkpoint: str,
    *, model: PipelineModel | None = None, event_time: str = "timestamp", delay: str = DAY, **how,
) -> StreamingQuery:
    """Articles of each newly seen seed: extracted, scored, judged by the model if given, stored.

    From a ``PageStore`` each micro-batch reads only the buckets of its addresses.
    """
    once = state.without_replays(seeds, ["news_id", "news_url"], event_time, delay)

    def enrich(extracted: DataFrame) -> DataFrame:
        found = articles.enrich(extracted, **tables)
        if model is not None:
            ready = found.withColumn("tokens", text_fn.whitespace_tokens(found.news_tokens))
            judged = credibility.predict(model, ready, found.columns)
            found = judged.withColumn("prediction", judged.label_text).drop("label_text", "probability")
        return documents.with_date(records.article_document(found))

    return upsert_stream(
        once, path, checkpoint, mode="append", prepare=lambda batch: articles.fetch(batch, _pages(pages, batch)), transform=enrich, **how
    )


def message_stream(
    messages: DataFrame, pages: DataFrame | PageStore, publish: Callable[[DataFrame, int], None], quarantine: str, checkpoint: str,
    *, small: bool | None = None, **how,
) -> StreamingQuery:
    """Delimited seed messages to article messages: decoded, their pages fetched, sent on as JSON by key.

    ``publish`` gets the (key, value) rows and the batch id, and may see a batch again after a failure.
    Unreadable records are kept in the table ``quarantine``.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        good, bad = records.decode_records(batch.select("value"))
        try:
            documents.upsert(bad, quarantine, batch_id)
            publish(records.json_payload(articles.fetch(good, _pages(pages, good), small=small)), batch_id)
        finally:
            batch.unpersist()

    return stream_writer(messages, checkpoint, "append", **how).foreachBatch(write).start()


def outer_document_stream(
    social_docs: DataFrame, article_docs: DataFrame, path: str, checkpoint: str, *, event_time: str = "seen_at", delay: str = DAY,
    within: str = DAY, article_delay: str | None = None, **how,
) -> StreamingQuery:
    """Social and article documents joined as one stream and stored, one row per pair or unmatched side.

    A document waits for its other side until the watermarks have passed ``within``; an end-of-input mark
    (a row with a null id and a late time) on both sides lets the last ones go.
    """
    joined = state.outer_join(social_docs, article_docs, "news_id", event_time, delay=delay, within=within, article_delay=article_delay)
    return upsert_stream(joined.where(F.col("news_id").isNotNull()), path, checkpoint, mode="append", **how)


def consumer_stream(
    messages: DataFrame, kinds: dict[str, records.Kind], path: str, quarantine: str, checkpoint: str, **how
) -> StreamingQuery:
    """JSON messages of several kinds to the document table, one writer per kind; unreadable ones to ``quarantine``.

    ``messages`` has ``value`` and ``timestamp``; of one batch's messages about a document the newest counts.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        routed = records.route_messages(batch, kinds).persist()
        try:
            for name, kind in kinds.items():
                own = records.of_kind(routed, name, kind)
                newest = _newest(own, ["news_id"], "timestamp")
                documents.upsert(newest.drop("timestamp"), path, batch_id, writer=name)
            documents.upsert(routed.where(F.col("kind").isNull()).select("value"), quarantine, batch_id)
        finally:
            routed.unpersist()

    return stream_writer(messages, checkpoint, "append", **how).foreachBatch(write).start()


def topic_stream(
    source: str, target: str, transform: Callable[[DataFrame], DataFrame], session: SparkSession, checkpoint: str, *,
    mode: str = "append", writer: str = "main", **how,
) -> StreamingQuery:
    """From one folder topic to another: ``transform`` maps the message stream to (key, value) rows."""
    return folder_topic.publish_stream(transform(folder_topic.read_stream(session, source)), target, checkpoint, mode, writer, **how)


def run_to_end(query: StreamingQuery) -> None:
    """Wait for a query started with ``available_now``; its failure is raised here."""
    query.awaitTermination()
