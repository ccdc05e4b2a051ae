"""Token tables: one row per token with its position, and the joins that filter or map them.

The long form is id columns, ``pos``, ``token``. Dictionary joins broadcast the dictionary; tokens
that are wanted back as one list per text are regrouped by id, in position order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import CountVectorizerModel, SQLTransformer, StopWordsRemover
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from pressgauge.functions import text as text_fn
from pressgauge.operators.joins import BROADCAST_ROWS, lookup, unique
from pressgauge.sinks.files import stored


#: Text that one task takes apart: its tokens, counted by id, fill some hundred MB.
PART_BYTES = 16 << 20


def dealt_by_id(df: DataFrame, ids: Sequence[str], text: Column | str) -> DataFrame:
    """The rows dealt by id to as many tasks as their measured text needs, so that a task's share does not grow with the input.

    A stream cannot be measured, and keeps the session's number of partitions.
    """
    if df.isStreaming:
        return df.repartition(*ids)
    size = df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    session = df.sparkSession
    least = min(session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(max(1, least, -(-size // PART_BYTES)), *ids)


def token_rows(
    df: DataFrame,
    ids: Sequence[str],
    text: str = "text",
    tokenizer: Callable[[Column], Column] = text_fn.letter_tokens,
    *,
    by_id: bool = False,
) -> DataFrame:
    """One row per token: id columns, ``pos``, ``token``.

    ``by_id`` shuffles the texts by id first. Do so when the tokens are regrouped by id later: that
    step then needs no shuffle, and a text is far smaller than its token rows.
    """
    source = dealt_by_id(df.select(*ids, text), ids, text) if by_id else df
    return source.select(*ids, F.posexplode(tokenizer(F.col(text))).alias("pos", "token"))


def collect_tokens(rows: DataFrame, ids: Sequence[str], token: str = "token", out: str = "tokens") -> DataFrame:
    """Arrays of tokens in position order, one row per id; an id is one text, so a group is bounded."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", F.col(token).alias("token"))))
    return rows.groupBy(*ids).agg(F.transform(ordered, lambda x: x.token).alias(out))


def without_stop_words(rows: DataFrame, stop: DataFrame, small: bool | None = None) -> DataFrame:
    """Token rows whose token is not in ``stop(token)``."""
    return lookup(rows, stop, "token", "left_anti", small=small, salt=_row_salt(rows))


def drop_stop_words(df: DataFrame, tokens: str, stop: DataFrame, most: int = 10_000) -> DataFrame:
    """The token arrays without the words of ``stop(token)``, in place: no text is taken apart or shuffled.

    For a word list proven to have at most ``most`` members; a longer one is an error, and needs the long form.
    """
    words = [r.token for r in stop.select("token").where(F.col("token").isNotNull()).distinct().limit(most + 1).collect()]
    if len(words) > most:
        raise ValueError(f"more than {most} stop words: use without_stop_words")
    return df.withColumn(tokens, F.filter(tokens, lambda x: ~x.isin(words)) if words else F.col(tokens))


def union_stop_words(*tables: DataFrame) -> DataFrame:
    """The members of any of several one-column word tables, each once."""
    merged = tables[0]
    for table in tables[1:]:
        merged = merged.unionByName(table)
    return merged.distinct()


def default_stop_words(spark: SparkSession, language: str = "english") -> DataFrame:
    """The stop words that ship with Spark ML, as a table."""
    words = [(w,) for w in StopWordsRemover.loadDefaultStopWords(language)]
    return spark.createDataFrame(words, T.StructType([T.StructField("token", T.StringType(), False)]))


def lemmatize(rows: DataFrame, lemmas: DataFrame, small: bool | None = None) -> DataFrame:
    """Replace tokens by ``lemmas(token, lemma)``; tokens without a lemma are dropped."""
    joined = lookup(rows, unique(lemmas.select("token", "lemma"), "token", small), "token", "inner", small=small, salt=_row_salt(rows))
    return joined.withColumn("token", F.col("lemma")).drop("lemma")


def lemmatize_with_suffixes(
    rows: DataFrame, words: DataFrame, rules: Sequence[tuple[str, str]], small: bool | None = None
) -> DataFrame:
    """Lemmatize by detachment rules: the first candidate found in ``words(token)`` wins.

    ``rules`` are (ending, replacement) pairs. The word itself is the first candidate.
    """
    word = F.col("token")
    candidates = [F.struct(F.lit(0).alias("rank"), word.alias("lemma"))]
    for rank, (ending, replacement) in enumerate(rules, start=1):
        stem = F.concat(F.left(word, F.length(word) - len(ending)), F.lit(replacement))
        candidates.append(F.when(word.endswith(ending), F.struct(F.lit(rank).alias("rank"), stem.alias("lemma"))))
    tokens = rows.select("token").distinct()
    found = lookup(
        tokens.select("token", F.inline(F.array_compact(F.array(*candidates)))),
        words.select(F.col("token").alias("lemma")).distinct(),
        "lemma", "left_semi", small=small,
    )
    best = found.groupBy("token").agg(F.min(F.struct("rank", "lemma")).alias("best"))
    # Not known to be small: Spark picks the join by the size it finds, and splits hot tokens.
    joined = rows.join(best.select("token", F.col("best.lemma").alias("lemma")), "token")
    return joined.withColumn("token", F.col("lemma")).drop("lemma")


def of_speech(rows: DataFrame, speech: DataFrame, tags: Sequence[str] = ("a", "s", "JJ", "JJS"), small: bool | None = None) -> DataFrame:
    """Token rows tagged as one of ``tags`` in ``speech(token, pos)``; the default keeps adjectives."""
    wanted = speech.where(F.col("pos").isin(*tags)).select("token").distinct()
    return lookup(rows, wanted, "token", "left_semi", small=small, salt=_row_salt(rows))


def vocabulary(rows: DataFrame, size: int = 16_000, min_length: int = 1) -> DataFrame:
    """The ``size`` most frequent tokens as (token, n, idx); idx starts at 1, ties go by token."""
    counts = (
        rows.where(F.length("token") >= min_length)
        .groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    )
    return with_rank(counts.orderBy(F.desc("n"), "token").limit(size), F.desc("n"), F.col("token"))


def rank_all(counts: DataFrame, out: str = "idx") -> DataFrame:
    """All of ``counts(token, n)`` ranked from 1 by falling count, then by word, without one task that holds them.

    Rows are sorted by range and stored; a row's rank is its place in its range after all rows of the ranges before.
    """
    ordered = counts.repartitionByRange(F.desc("n"), F.asc("token")).sortWithinPartitions(F.desc("n"), F.asc("token"))
    placed = stored(ordered.select("*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_at")), "ranked")
    sizes = placed.groupBy("_p").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row per range.
    starts = sizes.select("_p", "_first", before.alias("_before"))
    rank = (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias(out)
    return placed.join(F.broadcast(starts), "_p").select(*counts.columns, rank)


def with_rank(ranked: DataFrame, *order: Column, out: str = "idx") -> DataFrame:
    """Number rows from 1 in the given order. One task: only for tables bounded by a limit."""
    return ranked.withColumn(out, F.row_number().over(Window.orderBy(*order)))


def last_value_per_key(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One value per key: that of the row latest in ``order``."""
    return rows.groupBy(key).agg(F.max_by(value, order).alias(value))


def term_counts(rows: DataFrame, ids: Sequence[str]) -> DataFrame:
    """How often each token occurs per id."""
    return rows.groupBy(*ids, "token").agg(F.count(F.lit(1)).alias("n"))


def token_stages(text: str, tokens: str, stop_words: Sequence[str] | None = None) -> Pipeline:
    """Spark ML tokenizer and stop-word remover; nothing is learned, so the model also runs on a stream.

    The tokenizer is a SQL stage, which stays in generated code, unlike a regex transformer.
    """
    words = f"{tokens}_raw"
    stop = list(stop_words) if stop_words is not None else StopWordsRemover.loadDefaultStopWords("english")
    split = f"select *, regexp_extract_all(lower(`{text}`), '[a-z]+', 0) as `{words}` from __THIS__"
    return Pipeline(stages=[
        SQLTransformer(statement=split),
        StopWordsRemover(inputCol=words, outputCol=tokens, stopWords=stop, caseSensitive=True),
    ])


def apply_token_stages(df: DataFrame, text: str, tokens: str, stop_words: Sequence[str] | None = None) -> DataFrame:
    """Fit and apply :func:`token_stages`."""
    # An empty frame of the same schema is enough to fit, also when ``df`` is a stream.
    sample = df.sparkSession.createDataFrame([], df.schema)
    model: PipelineModel = token_stages(text, tokens, stop_words).fit(sample)
    return model.transform(df).drop(f"{tokens}_raw")


def fit_count_vectors(df: DataFrame, tokens: str, out: str = "counts", size: int = 16_000) -> CountVectorizerModel:
    """Term-count vectors over the ``size`` most frequent words of an array column.

    Ties go by word, so the model is the same in every run; it can be reused on a stream.
    """
    ranked = vocabulary(df.select(F.explode(tokens).alias("token")), size).orderBy("idx")
    words = [row.token for row in ranked.select("token").collect()]
    return CountVectorizerModel.from_vocabulary(words, inputCol=tokens, outputCol=out)


def count_vector_rows(model: CountVectorizerModel, counted: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Count vectors as rows (ids, ``token``, ``n``); the model's word list is bounded by its size."""
    words = counted.sparkSession.createDataFrame(list(enumerate(model.vocabulary)), "word int, token string")
    entries = F.unwrap_udt(model.getOutputCol())
    pairs = F.arrays_zip(entries["indices"].alias("word"), entries["values"].alias("n"))
    rows = counted.select(*ids, F.inline(pairs).alias("word", "n"))
    small = len(model.vocabulary) <= BROADCAST_ROWS
    return lookup(rows, words, "word", small=small).select(*ids, "token", F.col("n").cast("bigint").alias("n"))


def _row_salt(rows: DataFrame) -> Column:
    return F.xxhash64(*[F.col(c) for c in rows.columns if c != "token"])
