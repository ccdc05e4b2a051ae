"""Further registered queries, each beside its SQL counterpart."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pressgauge import schemas
from pressgauge.functions import text as text_fn
from pressgauge.operators import (
    articles, attention_training, credibility, features, joins, phrases, pooling, quality, records, sentiment, substrings, tokens, tweets,
)
from pressgauge.plans import daily
from pressgauge.plans.fixtures import EPOCH, SENTENCES, VOCABULARY, WIDTH, WORDS, Inputs
from pressgauge.plans.oracles import BODIES as ORACLE_BODIES, _attention
from pressgauge.plans.queries import _index, _sentences, _streaming_session, register
from pressgauge.session import fresh_dir
from pressgauge.sinks import documents, files as sink
from pressgauge.sources import files as source, folder_topic
from pressgauge.sources.page_store import PageStore
from pressgauge.sources.topics import read_files_as_topic
from pressgauge.streaming import jobs, late

BODIES: dict[str, str] = {}
#: Queries without SQL: an iterative fit, and a word list that only Spark has at hand.
ROWS_ONLY = ("attention_train", "default_stop_filter")

# --- Streams ------------------------------------------------------------------------------------


def _minute(n: Column) -> Column:
    return F.timestamp_seconds(F.lit(EPOCH) + n * 60)


def _feed(session: SparkSession, parts: list[DataFrame], label: str, files: int = 2) -> DataFrame:
    """A stream that delivers the parts one micro-batch each, in this order."""
    path = fresh_dir(session, label)
    for part in parts:
        part.repartition(files).write.mode("append").parquet(path)
    # Empty files would shift the batches, so they are counted as written.
    written = len(session.read.parquet(path).inputFiles())
    return read_files_as_topic(session, path, parts[0].schema, files_per_trigger=math.ceil(written / len(parts)))


@register
def stream_outer(i: Inputs) -> DataFrame:
    """Social and article documents joined as one stream: late articles, articles out of reach, lone rows of either side."""
    session = _streaming_session(i.spark)
    inputs = Inputs(session, i.folder)
    n = F.col("page_id")
    asked = inputs.seeds().join(inputs.table("pages").select("page_id", F.col("url").alias("news_url")), "news_url")
    social = asked.where(n % 5 != 0).select("news_id", "favorite_count", _minute(n % 600).alias("seen_at"))
    # Every fourth article comes 30 hours after its seed, every seventh a minute before it.
    shift = F.when(n % 4 == 0, F.lit(1800)).when(n % 7 == 0, F.lit(-1)).otherwise(F.lit(5))
    pages = inputs.table("pages").where(n % 3 != 0).select(
        F.sha2("url", 256).alias("news_id"), F.length("html").cast("bigint").alias("n_chars"), _minute(n % 600 + shift).alias("seen_at")
    )
    end = session.range(1).select(_minute(F.lit(60000)).alias("seen_at"))
    half = F.pmod(F.xxhash64("news_id"), F.lit(2)) == 0
    left = _feed(session, [social.where(half), social.where(~half), end.select(*_nulls(social))], "outer-social", 1)
    right = _feed(session, [pages.where(~half), pages.where(half), end.select(*_nulls(pages))], "outer-articles", 1)
    path = fresh_dir(i.spark, "outer")
    jobs.run_to_end(jobs.outer_document_stream(left, right, path, f"{path}-check", delay="3 days", within="1 day", available_now=True))
    return i.spark.read.parquet(path).select(
        "news_id", "favorite_count", "n_chars", F.date_format("seen_at", "yyyy-MM-dd HH:mm").alias("seen_at")
    )


def _nulls(like: DataFrame) -> list[Column]:
    """The columns of a table, null but for the time."""
    return [F.col(f.name) if f.name == "seen_at" else F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema.fields]


BODIES["stream_outer"] = f"""
    with social as (
        select s.news_id, s.favorite_count, {EPOCH} + (page_id % 600) * 60 as seen
        from v_seeds s join pages on url = news_url where page_id % 5 <> 0
    ), articles as (
        select sha256(url) as news_id, length(html) as n_chars,
               {EPOCH} + (page_id % 600 + case when page_id % 4 = 0 then 1800 when page_id % 7 = 0 then -1 else 5 end) * 60 as seen
        from pages where page_id % 3 <> 0
    )
    select coalesce(s.news_id, a.news_id) as news_id, favorite_count, n_chars,
           strftime(make_timestamp(cast(case when s.seen is null or a.seen >= s.seen then a.seen else s.seen end as bigint) * 1000000), '%Y-%m-%d %H:%M') as seen_at
    from social s full join articles a on s.news_id = a.news_id and abs(a.seen - s.seen) <= 86400"""


@register
def stream_late(i: Inputs) -> DataFrame:
    """Sentiment of comments half of which come behind the watermark, some of them sent twice."""
    session = _streaming_session(i.spark)
    late.use_state_variables(session)
    inputs = Inputs(session, i.folder)
    comments = inputs.comments()
    scores = sentiment.score_texts(comments, ["tweet_id", "turn", "like_count", "event_time"], "comment", inputs.lexicon(), small=True)
    scored = sink.stored(scores, "scored")
    first = F.col("tweet_id") % 2 == 1
    again = F.col("tweet_id") % 10 == 0
    parts = [scored.where(first), scored.where(~first).unionByName(scored.where(again)), scored.where(again)]
    stream = _feed(session, parts, "late-feed")
    sums, behind = fresh_dir(i.spark, "sums-on-time"), fresh_dir(i.spark, "sums-late")
    jobs.run_to_end(late.sentiment_stream(
        stream, ["tweet_id"], ["tweet_id", "turn"], "event_time", sums, behind, f"{sums}-check", delay="10 minutes", horizon=7 * 86_400_000,
        available_now=True,
    ))
    found = late.current_sentiment(i.spark, sums, behind, ["tweet_id"])
    return found.withColumn("weighted_sentiment_score", F.round("weighted_sentiment_score", 6))


BODIES["stream_late"] = """
    with clock as (select max(event_time) - interval 10 minutes as mark from v_comments where tweet_id % 2 = 1)
    select w.*, (select count(*) from v_comments c, clock where c.tweet_id = w.tweet_id and c.tweet_id % 2 = 0 and c.event_time < mark) as n_late
    from v_weighted w"""


@register
def stream_topic(i: Inputs) -> DataFrame:
    """Seeds sent to a topic in two parts; a job turns them into messages of another one and is restarted between."""
    session = _streaming_session(i.spark)
    sent, out = fresh_dir(i.spark, "topic-in"), fresh_dir(i.spark, "topic-out")
    seeds = Inputs(session, i.folder).seeds()
    half = F.pmod(F.xxhash64("news_id"), F.lit(2)) == 0

    def transform(messages: DataFrame) -> DataFrame:
        seen = records.parse_payload(messages.select("value"), schemas.SEED)
        return records.json_payload(seen.where("favorite_count >= 1000").select("news_id", "favorite_count"))

    for number, part in enumerate((seeds.where(half), seeds.where(~half))):
        for _ in range(2):  # sent again, under the same mark, and read again from the same checkpoint
            folder_topic.publish(records.json_payload(part), sent, f"part{number}")
            jobs.run_to_end(jobs.topic_stream(sent, out, transform, session, f"{out}-check", available_now=True))
    schema = schemas._struct(("news_id", schemas.STRING), ("favorite_count", schemas.LONG))
    found = records.parse_payload(folder_topic.read(i.spark, out).select("value"), schema)
    return found.groupBy("news_id", "favorite_count").agg(F.count(F.lit(1)).alias("n_messages"))


BODIES["stream_topic"] = "select news_id, favorite_count, 1 as n_messages from v_seeds where favorite_count >= 1000"

KINDS = {
    "social": records.Kind("tweet_url", schemas._struct(("news_id", schemas.STRING), ("tweet_url", schemas.STRING), ("favorite_count", schemas.LONG))),
    "articles": records.Kind("news_title", schemas._struct(("news_id", schemas.STRING), ("news_title", schemas.STRING), ("lengths", schemas.T.ArrayType(schemas.LONG)))),
}


@register
def stream_consumer(i: Inputs) -> DataFrame:
    """One topic with social and article messages, outdated ones and unreadable ones, to documents and a quarantine."""
    session = _streaming_session(i.spark)
    inputs = Inputs(session, i.folder)
    topic, path, broken = fresh_dir(i.spark, "mixed"), fresh_dir(i.spark, "consumed"), fresh_dir(i.spark, "unreadable")
    seeds = inputs.seeds().select("news_id", "tweet_url", "favorite_count")
    found = articles.extract(inputs.table("pages").select("page_id", F.sha2("url", 256).alias("news_id"), "html"))
    pages = found.select("page_id", "news_id", "news_title", F.array(F.length("news_title").cast("bigint"), F.length("news_text").cast("bigint")).alias("lengths"))
    odd = pages.where("page_id % 10 = 0").select(
        F.col("news_id").alias("key"),
        F.when(F.col("page_id") % 20 == 0, F.concat(F.lit("{broken "), "news_id")).otherwise(F.concat(F.lit('{"other": "'), "news_id", F.lit('"}'))).alias("value"),
    )
    folder_topic.publish(records.json_payload(seeds.withColumn("favorite_count", F.col("favorite_count") + 1)).unionByName(odd), topic, "first")
    folder_topic.publish(records.json_payload(seeds).unionByName(records.json_payload(pages.drop("page_id"))), topic, "second")
    messages = folder_topic.read_stream(session, topic)
    jobs.run_to_end(jobs.consumer_stream(messages, KINDS, path, broken, f"{path}-check", available_now=True))
    current = documents.read_documents(i.spark, path)
    rows = current.select("news_id", "tweet_url", "favorite_count", "news_title", F.array_join(F.col("lengths").cast("array<string>"), ",").alias("lengths"))
    bad = i.spark.read.parquet(broken).select(F.col("value").alias("news_id"))
    return rows.unionByName(bad, allowMissingColumns=True)


BODIES["stream_consumer"] = """
    select coalesce(s.news_id, sha256(b.url)) as news_id, s.tweet_url, s.favorite_count, b.news_title,
           length(b.news_title) || ',' || length(b.news_text) as lengths
    from v_seeds s full join v_body b on s.news_url = b.url
    union all
    select case when page_id % 20 = 0 then '{broken ' || sha256(url) else '{"other": "' || sha256(url) || '"}' end, null, null, null, null
    from pages where page_id % 10 = 0"""


@register
def stream_pruned_pages(i: Inputs) -> DataFrame:
    """Pages of popular seeds fetched by a stream from a store bucketed by address."""
    session = _streaming_session(i.spark)
    inputs = Inputs(session, i.folder)
    store = PageStore(session, fresh_dir(i.spark, "page-store"), 64)
    store.add(inputs.table("pages").select("url", "html"))
    seeds = inputs.seeds().where("favorite_count >= 2500").withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    path = fresh_dir(i.spark, "pruned")
    stream = _feed(session, [seeds.where("retweet_count < 350"), seeds.where("retweet_count >= 350")], "pruned-seeds", 1)
    jobs.run_to_end(jobs.article_stream(stream, store, inputs.article_tables(), path, f"{path}-check", delay="7 days", available_now=True))
    scores = F.transform("news_sentiment_scores", lambda s: F.format_number(s, 4))
    return documents.read_documents(i.spark, path).select("news_id", "news_title", "news_tokens", F.array_join(scores, ",").alias("scores"))


BODIES["stream_pruned_pages"] = "select r.* from v_article_results r join v_seeds s using (news_id) where favorite_count >= 2500"



@register
def stream_folded(i: Inputs) -> DataFrame:
    """Events upserted in many small micro-batches into a table that is folded on the way."""
    session = _streaming_session(i.spark)
    path = fresh_dir(i.spark, "folded")
    events = session.read.parquet(f"{i.folder}/events.parquet")
    parts = [events.where(F.pmod(F.xxhash64("event_id"), F.lit(6)) == k) for k in range(6)]
    jobs.run_to_end(jobs.upsert_stream(
        _feed(session, parts, "fold-feed", 1), path, f"{path}-check", mode="append", available_now=True,
        transform=lambda batch: tweets.first_per_key(batch, ["user_id"], F.desc("ts"), F.desc("event_id")),
        fold_at=3, fold_keys=["user_id"], fold_order=["ts", "event_id"],
    ))
    current = documents.read_documents(i.spark, path, ["user_id"], order=["ts", "event_id"])
    return current.select("user_id", "event_id", "event_type", "value")


BODIES["stream_folded"] = "select * from v_latest"


@register
def daily_chain(i: Inputs) -> DataFrame:
    """Two days from seeds to documents: published, scored, extracted and merged; an article of both days keeps the later one."""
    base, spark = fresh_dir(i.spark, "daily"), i.spark
    n = F.length("tweet_url") + F.col("favorite_count") / 100
    for number, day in enumerate(("2024-01-01", "2024-01-02"), 1):
        seeds = i.seeds().where((n % 2 == 0) if number == 1 else (n % 3 == 0))
        sink.write_day(seeds.withColumn("retweet_count", F.lit(number)), f"{base}/seeds", day)
        for _ in range(2):  # a job may be run again for its day
            daily.publish_seeds(spark, f"{base}/seeds", f"{base}/social-topic", f"{base}/news-topic", day)
        daily.score_day(spark, f"{base}/seeds", i.thread_comments(), i.social_tables(), f"{base}/social", day)
        daily.article_day(spark, f"{base}/seeds", i.table("pages"), i.article_tables(), f"{base}/articles", day)
        daily.merge_day(spark, f"{base}/social", f"{base}/articles", f"{base}/documents", day, number)
    current = documents.read_documents(spark, f"{base}/documents", ["news_id", "part"])
    sent = records.parse_payload(folder_topic.read(spark, f"{base}/news-topic").select("key", "value"), schemas._struct(("news_url", schemas.STRING)))
    times = sent.groupBy(F.col("key").alias("news_id")).agg(F.count(F.lit(1)).alias("n_sent"))
    return current.join(times, "news_id", "left").select(
        "news_id", "part", "favorite_count", "weighted_sentiment_score", "news_title", "news_tokens", F.date_format("date", "yyyy-MM-dd").alias("date"), "n_sent"
    ).withColumn("weighted_sentiment_score", F.round("weighted_sentiment_score", 6))


BODIES["daily_chain"] = f"""
    with social as ({ORACLE_BODIES['social_results']}),
    art as (select * from v_article_results),
    n as (select news_id, length(tweet_url) + favorite_count / 100 as n from v_seeds),
    days as (
        select news_id, max(day) as day, count(*) as n_sent from (
            select news_id, 1 as day from n where n % 2 = 0 union all select news_id, 2 from n where n % 3 = 0)
        group by news_id)
    select coalesce(s.news_id, a.news_id) as news_id, coalesce(s.part, 0) as part, favorite_count, weighted_sentiment_score, news_title,
           a.news_tokens, '2024-01-0' || day as date, n_sent
    from (select * from social where news_id in (select news_id from days)) s
    full join (select * from art where news_id in (select news_id from days)) a on s.news_id = a.news_id and s.part = 0
    join days d on d.news_id = coalesce(s.news_id, a.news_id)"""

# --- Text ---------------------------------------------------------------------------------------


@register
def substring_search(i: Inputs) -> DataFrame:
    """Keywords of one to six letters, cut out of words, wherever they stand in a post."""
    length = F.col("idx") % 6 + 1
    parts = F.when(F.col("idx") % 2 == 0, F.upper(F.substring("token", F.lit(2), length))).otherwise(F.concat(F.right("token", F.lit(2)), F.lit(" "), F.left("token", length)))
    words = sink.stored(i.vocab().where("idx between 300 and 420").select(parts.alias("keyword")), "parts")
    return substrings.search_substrings(i.posts(), words, ["tweet_id"], small=True)


BODIES["substring_search"] = """
    with k as (
        select distinct case when idx % 2 = 0 then upper(substr(token, 2, idx % 6 + 1)) else right(token, 2) || ' ' || left(token, idx % 6 + 1) end as keyword
        from v_vocab where idx between 300 and 420
    )
    select c.conv_id as tweet_id, keyword as news_keyword from conversations c join k on keyword <> '' and contains(lower(c.text), lower(keyword))
    where c.turn = 0"""


@register
def entity_spans(i: Inputs) -> DataFrame:
    """Nested and overlapping phrases in titles: the first, then the longest one counts."""
    words = i.vocab().where("idx between 1 and 80").select(F.col("token").alias("phrase"))
    pairs = i.phrases().select("phrase")
    chained = pairs.select(F.substring_index("phrase", " ", -1).alias("w"), "phrase").join(
        pairs.select(F.substring_index("phrase", " ", 1).alias("w"), F.col("phrase").alias("after")), "w"
    ).select(F.concat(F.substring_index("phrase", " ", 1), F.lit(" "), "after").alias("phrase"))
    gazetteer = sink.stored(words.unionByName(pairs).unionByName(chained), "gazetteer")
    return phrases.entity_spans(i.table("documents").select("doc_id", "text"), gazetteer, ["doc_id"], text="text", small=True)


BODIES["entity_spans"] = """
    with recursive g as (
        select token as phrase from v_vocab where idx between 1 and 80
        union select phrase from v_phrases
        union select a.phrase || ' ' || split_part(b.phrase, ' ', 2) from v_phrases a join v_phrases b on split_part(a.phrase, ' ', 2) = split_part(b.phrase, ' ', 1)
    ), w as (
        select doc_id, regexp_extract_all(lower(text), '[a-z]+') as t from documents
    ), runs as (
        select doc_id, n, p as pos, array_to_string(t[p + 1:p + n], ' ') as phrase
        from (select doc_id, t, n, unnest(range(0, len(t) - n + 1)) as p from w, (select unnest([1, 2, 3]) as n))
    ), longest as (
        select doc_id, pos, max(n) as n from runs join g using (phrase) group by all
    ), ordered as (
        select *, row_number() over (partition by doc_id order by pos) as k from longest
    ), chosen as (
        select doc_id, pos,  n, k, pos + n as next, true as taken from ordered where k = 1
        union all
        select o.doc_id, o.pos, o.n, o.k, case when o.pos >= c.next then o.pos + o.n else c.next end, o.pos >= c.next
        from chosen c join ordered o on o.doc_id = c.doc_id and o.k = c.k + 1
    )
    select c.doc_id, cast(c.pos as integer) as pos, cast(c.n as integer) as length, array_to_string(t[c.pos + 1:c.pos + c.n], ' ') as phrase
    from chosen c join w using (doc_id) where taken"""


@register
def line_ranks(i: Inputs) -> DataFrame:
    """The words of several ranked files, read in splits, with their ranks over all files."""
    session = i.spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    session.conf.set("spark.sql.files.openCostInBytes", "1024")
    path = fresh_dir(i.spark, "ranked-files")
    ranked = Inputs(session, i.folder).vocab()
    # The files are sorted by range, so their names are in the order of the ranks.
    rows = ranked.repartitionByRange(3, "idx").sortWithinPartitions("idx")
    sink.write_lines(rows.select(F.concat_ws(" ", F.lit("w"), "token", "n").alias("line")), path, "line")
    return features.vocabulary_from_lines(source.read_ranked_lines(session, path))


BODIES["line_ranks"] = "select token, idx from v_vocab"

def _word_counts(i: Inputs) -> DataFrame:
    return tokens.token_rows(i.table("documents"), ["doc_id"]).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@register
def vocabulary_all(i: Inputs) -> DataFrame:
    """Every word of every language with its rank."""
    return tokens.rank_all(_word_counts(i))


BODIES["vocabulary_all"] = "select token, n, row_number() over (order by n desc, token) as idx from (select token, count(*) as n from v_dtok group by token)"


@register
def term_counts_all(i: Inputs) -> DataFrame:
    """Count vectors over the whole vocabulary, by word number; no word goes through the driver."""
    ranked = tokens.rank_all(_word_counts(i))
    # Texts are shuffled by id, not their words.
    counted = tokens.term_counts(tokens.token_rows(i.table("documents"), ["doc_id"], by_id=True), ["doc_id"])
    # The counts tell the frequent words: at most one in each share of all occurrences.
    total = ranked.agg(F.sum("n")).first()[0] or 0
    frequent = ranked.where(F.col("n") >= F.lit(max(1.0, joins.hot_share(counted) * total))).select(F.xxhash64("token").alias("key"))
    hot = [r.key for r in frequent.collect()]
    return joins.lookup(counted, ranked.select("token", "idx"), "token", salt=F.xxhash64("doc_id"), hot=hot).select("doc_id", "idx", "n")


BODIES["term_counts_all"] = """
    with ranks as (select token, row_number() over (order by n desc, token) as idx from (select token, count(*) as n from v_dtok group by token))
    select doc_id, idx, count(*) as n from v_dtok join ranks using (token) group by all"""


@register
def default_stop_filter(i: Inputs) -> DataFrame:
    """Texts without the English stop words that ship with Spark."""
    found = i.table("documents").select("doc_id", text_fn.letter_tokens(F.col("text")).alias("tokens"))
    kept = tokens.drop_stop_words(found, "tokens", tokens.default_stop_words(i.spark))
    return kept.select("doc_id", F.array_join("tokens", " ").alias("tokens"))


# --- Quality and learning -----------------------------------------------------------------------


@register
def observed_report(i: Inputs) -> DataFrame:
    """The data report gathered while the tables are written."""
    base = fresh_dir(i.spark, "observed")
    labels = quality.write_observed(i.table("labels"), f"{base}/labels", {
        "label_rows": F.count(F.lit(1)), "label_not_binary": quality.violations(F.col("quality").isin(0, 1)),
    }, {"label_keys": "doc_id"})
    vocab = quality.write_observed(i.vocab(), f"{base}/vocabulary", {
        "vocabulary_rows": F.count(F.lit(1)), "vocabulary_max_idx": F.max("idx"),
        "vocabulary_idx_out_of_range": quality.violations(F.col("idx").between(1, VOCABULARY)),
    })
    links = quality.write_observed(i.table("pages"), f"{base}/pages", {
        "link_rows": F.count(F.lit(1)), "link_without_http": quality.violations(F.contains("url", F.lit("http"))),
    })
    return quality.union_reports(labels, vocab, links)


def _fixed_model() -> attention_training.Model:
    """The parameters of the pooling queries with an output layer."""
    o = np.array([((d * 5) % 13 - 6) / 4 for d in range(WIDTH)])
    return attention_training.Model(np.array(SENTENCES.w), np.array(SENTENCES.b), np.array(SENTENCES.u), o, 0.25)


@register
def attention_score(i: Inputs) -> DataFrame:
    """Groups of ten vectors scored by fixed attention and output weights."""
    rows = i.table("embeddings").select(F.floor(F.col("vec_id") / 10).alias("doc_id"), F.col("vec_id").alias("sent_pos"), F.col("embedding").cast("array<double>").alias("vector"))
    docs = attention_training.sentence_arrays(rows, ["doc_id"])
    return attention_training.predict(docs, _fixed_model(), ["doc_id"]).withColumn("probability", F.round("probability", 8))


BODIES["observed_report"] = ORACLE_BODIES["quality_report"]
BODIES["attention_score"] = f"""
    with s as (
        select vec_id // 10 as doc_id, exp({_attention('embedding::double[]', SENTENCES)}) as e, embedding::double[] as v from embeddings
    ), p as (
        select doc_id, sum(e * list_dot_product(v, {[((d * 5) % 13 - 6) / 4 for d in range(WIDTH)]}::double[])) / sum(e) + 0.25 as z from s group by doc_id
    )
    select doc_id, round(1 / (1 + exp(-z)), 8) as probability from p"""


@register
def credibility_linear(i: Inputs) -> DataFrame:
    """Verdicts on all documents by a linear model with fixed weights for the ranked words."""
    weights = i.vocab().select("token", ((F.col("idx") * 7 % 19 - 9) / 16).alias("weight"))
    terms = tokens.term_counts(tokens.token_rows(i.table("documents"), ["doc_id"]), ["doc_id"])
    found = credibility.predict_linear(terms, weights, ["doc_id"], intercept=-0.5, docs=i.table("documents"), small=True)
    return found.withColumn("probability", F.round("probability", 9))


BODIES["credibility_linear"] = """
    with z as (
        select doc_id, sum(cast((idx * 7 % 19 - 9) / 16.0 as decimal(18,9))) as z from v_dtok join v_vocab using (token) group by doc_id
    ), p as (
        select doc_id, 1 / (1 + exp(-(coalesce(cast(z as double), 0) - 0.5))) as p from documents left join z using (doc_id)
    )
    select doc_id, cast(p > 0.5 as integer) as prediction, round(p, 9) as probability, case when p > 0.5 then 'Fake' else 'True' end as label_text from p"""


@register
def vector_random(i: Inputs) -> DataFrame:
    """Vectors of all ranked words: pretrained, or else repeatable random numbers."""
    full = features.vector_table(i.vocab(), i.vectors().where(F.length("token") % 2 == 0), 8)
    return full.select("idx", "token", "found", F.posexplode(F.slice("vector", 1, 8)).alias("dim", "v")).withColumn("v", F.round("v", 6))


BODIES["vector_random"] = """
    select idx, token, found, cast(unnest(range(8)) as integer) as dim, round(unnest(vector), 6) as v from (
        select idx, token, embedding is not null as found, coalesce(embedding[1:8]::double[], list_transform(range(1, 9),
            lambda i: cast(('0x' || left(md5(token || ':' || i || ':0'), 8)) as bigint) / 4294967296.0)) as vector
        from v_vocab left join embeddings on vec_id = idx - 1 and length(token) % 2 = 0)"""


def _double_width() -> pooling.Attention:
    return pooling.Attention(w=WORDS.w + SENTENCES.w, b=WORDS.b, u=WORDS.u)


@register
def direction_pool(i: Inputs) -> DataFrame:
    """Vectors of both directions (here: of a row and of its mirror image in the table) as one, pooled by label."""
    rows = i.table("embeddings").where("label is not null")
    last = rows.agg(F.max("vec_id")).first()[0]
    mirror = rows.select(F.col("vec_id").alias("other"), F.col("embedding").alias("backward"))
    pairs = rows.withColumn("other", F.lit(last) - F.col("vec_id")).join(mirror, "other")
    joined = pairs.select("label", pooling.join_directions(F.col("embedding"), F.col("backward")).alias("vector"))
    pooled = pooling.pool(joined, ["label"], "vector", _double_width())
    return pooled.select("label", F.posexplode("pooled").alias("dim", "v")).withColumn("v", F.round("v", 6))


BODIES["direction_pool"] = f"""
    with last as (select max(vec_id) as last from embeddings where label is not null), b as (
        select a.label, list_concat(a.embedding::double[], o.embedding::double[]) as v
        from embeddings a, last join embeddings o on o.vec_id = last - a.vec_id where a.label is not null and o.label is not null
    )
    select label, cast(dim as integer) as dim, round(sum(e * x) / sum(e), 6) as v
    from (select label, exp({_attention('v', pooling.Attention(w=WORDS.w + SENTENCES.w, b=WORDS.b, u=WORDS.u))}) as e, unnest(v) as x, unnest(range({2 * WIDTH})) as dim from b)
    group by all"""


@register
def attention_train(i: Inputs) -> DataFrame:
    """Attention and output layer fitted on the sentence vectors of labelled documents, with the loss on each side of the split."""
    table = features.vector_table(i.vocab(), i.vectors(), WIDTH)
    labels = i.table("labels").where(F.col("quality").isNotNull()).select("doc_id", (1 - F.col("quality")).alias("label"))
    # Only labelled documents are fitted on or reported: the others need no vectors.
    wanted = i.table("documents").join(labels, "doc_id", "left_semi")
    index = features.index_rows(features.word_rows(wanted, ["doc_id"], _sentences()), i.vocab(), ["doc_id"], small=True)
    sentences = pooling.sentence_vectors(index, table, ["doc_id"], WORDS)
    docs = attention_training.sentence_arrays(sentences, ["doc_id"])
    labelled = docs.join(labels, "doc_id")
    rows = sink.stored(features.with_folds(labelled, "doc_id"), "sentence-arrays")
    training, test = features.split_fold(rows, 0)
    start = attention_training.initial(WIDTH, 4)
    model, losses = attention_training.train(training, WIDTH, rounds=12, start=start)
    report = []
    for name, part, fitted in (("before", test, start), ("after", test, model)):
        _, loss, n = attention_training.gradient(part, fitted)
        report.append((f"held_out_{name}", n, loss / max(n, 1)))
    report += [(f"round_{k:02d}", 0, loss) for k, loss in enumerate(losses, 1)]
    return i.spark.createDataFrame(report, "step string, n_docs long, loss double")
