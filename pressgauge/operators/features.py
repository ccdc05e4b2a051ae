"""Classifier inputs: vocabulary indexes, word positions, padded matrices, labels and folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pressgauge.functions import text as text_fn, vectors
from pressgauge.operators.joins import lookup, unique
from pressgauge.operators.tokens import dealt_by_id


def vocabulary_from_lines(lines: DataFrame, line: str = "line", rank: str = "rank") -> DataFrame:
    """(token, idx) of a ranked word file: the middle of three fields; a repeated word keeps its last rank."""
    fields = text_fn.whitespace_tokens(F.col(line))
    return lines.groupBy(F.get(fields, F.lit(1)).alias("token")).agg(F.max(rank).cast("bigint").alias("idx"))


def join_labels(docs: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """Documents with their 0/1 label and the pair (label, 1 - label)."""
    value = F.col(label).cast("int")
    return lookup(docs, labels.select(key, label), key, "inner").withColumn(label, value) \
        .withColumn("label_pair", F.array(F.col(label), 1 - F.col(label)))


def unlabelled(docs: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Documents without label."""
    return lookup(docs, labels.select(key).distinct(), key, "left_anti")


def word_rows(docs: DataFrame, ids: Sequence[str], sentences: Column, max_sentences: int | None = None) -> DataFrame:
    """Words of each document, or of its first ``max_sentences``: ids, ``sent_pos``, ``pos``, ``token``.

    Documents are shuffled by id before they are taken apart: numbering words and regrouping them
    by sentence and document then needs no further shuffle.
    """
    lists = docs.select(*ids, (sentences if max_sentences is None else F.slice(sentences, 1, max_sentences)).alias("_s"))
    parts = dealt_by_id(lists, ids, F.array_join("_s", " "))
    kept = parts.select(*ids, F.posexplode_outer("_s").alias("sent_pos", "sentence"))
    return kept.select(*ids, "sent_pos", F.posexplode(text_fn.word_sequence(F.col("sentence"))).alias("pos", "token"))


def index_rows(
    words: DataFrame,
    vocab: DataFrame,
    ids: Sequence[str],
    *,
    max_words: int | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Known words by index: ids, ``sent_pos``, ``word_pos``, ``idx``.

    Unknown words take no position; a sentence keeps all known words, or the first ``max_words``.
    """
    known = lookup(words, unique(vocab.select("token", "idx"), "token", small), "token", small=small, salt=F.xxhash64(*ids, "sent_pos", "pos"))
    order = Window.partitionBy(*ids, "sent_pos").orderBy("pos")
    placed = known.withColumn("_rank", F.row_number().over(order))
    if max_words is not None:
        placed = placed.where(F.col("_rank") <= max_words)
    return placed.select(*ids, "sent_pos", (F.col("_rank") - 1).alias("word_pos"), F.col("idx").cast("int").alias("idx"))


def sentence_ids(index: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Index arrays per sentence, in word order; a group is one sentence."""
    ordered = F.array_sort(F.collect_list(F.struct("word_pos", "idx")))
    return index.groupBy(*ids, "sent_pos").agg(F.transform(ordered, lambda x: x.idx).alias("ids"))


def matrix(
    index: DataFrame, ids: Sequence[str], max_sentences: int | None = None, max_words: int | None = None
) -> DataFrame:
    """Zero-padded index matrix per document.

    Without limits it has a line up to the last sentence with a known word, and each line is as wide
    as the document's longest; a given limit is the shape, cutting what is beyond it.
    """
    rows = sentence_ids(index, ids)
    grouped = rows.groupBy(*ids).agg(
        F.map_from_entries(F.collect_list(F.struct("sent_pos", "ids"))).alias("_rows"),
        F.max(F.size("ids")).alias("_width"), F.max("sent_pos").alias("_last"),
    )
    width = F.col("_width") if max_words is None else F.lit(max_words)
    last = F.col("_last") if max_sentences is None else F.lit(max_sentences - 1)
    blank = F.array().cast("array<int>")

    def line(i: Column) -> Column:
        return vectors.pad(F.coalesce(F.try_element_at("_rows", i), blank), width)

    return grouped.select(*ids, F.transform(F.sequence(F.lit(0), last), line).alias("matrix"))


def matrix_lengths(df: DataFrame, matrix_column: str = "matrix") -> DataFrame:
    """Lengths read off a padded matrix: per sentence, and the count of non-empty sentences."""
    per_sentence = F.transform(matrix_column, lambda row: F.size(F.array_remove(row, 0)))
    with_lengths = df.withColumn("sentence_lengths", per_sentence)
    return with_lengths.withColumn("doc_length", F.size(F.array_remove("sentence_lengths", 0)))


def lengths(index: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Sentence count and word count per document, from the long form."""
    per_sentence = index.groupBy(*ids, "sent_pos").agg(F.count(F.lit(1)).alias("n"))
    return per_sentence.groupBy(*ids).agg(
        F.count(F.lit(1)).alias("doc_length"),
        F.sum("n").alias("n_words"),
        F.max("n").alias("longest_sentence"),
    )


def vector_table(vocab: DataFrame, vectors_table: DataFrame, width: int, default: float | None = None) -> DataFrame:
    """(idx, token, vector, found): a vector for every vocabulary word.

    A word without pretrained vector gets a constant vector, or by default a repeatable
    pseudo-random one. Index 0 stays free for padding.
    """
    missing = (
        F.array_repeat(F.lit(float(default)), width) if default is not None
        else vectors.pseudo_random_vector(F.col("token"), width)
    )
    joined = vocab.select("token", "idx").join(vectors_table.select("token", "vector"), "token", "left")
    return joined.select(
        "idx", "token",
        F.coalesce(F.col("vector").cast("array<double>"), missing).alias("vector"),
        F.col("vector").isNotNull().alias("found"),
    )


def embed(index: DataFrame, table: DataFrame, small: bool | None = None) -> DataFrame:
    """Index rows with the vector of each word."""
    return lookup(index, table.select(F.col("idx").cast("int").alias("idx"), "vector"), "idx", small=small)


def fold(key: Column, folds: int = 5, hashed: bool = True) -> Column:
    """Repeatable fold number of a key; evenly numbered keys need no hash."""
    return F.pmod(F.xxhash64(key) if hashed else key, F.lit(folds)).cast("int")


def with_folds(docs: DataFrame, key: str, folds: int = 5, hashed: bool = True) -> DataFrame:
    """Documents with a ``fold`` column."""
    return docs.withColumn("fold", fold(F.col(key), folds, hashed))


def split_fold(docs: DataFrame, test_fold: int) -> tuple[DataFrame, DataFrame]:
    """Training and test part for one fold."""
    return docs.where(F.col("fold") != test_fold), docs.where(F.col("fold") == test_fold)
