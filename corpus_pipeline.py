"""A training corpus from the ``documents`` table, stage by stage.

Each stage reads what its predecessor kept, whole, and passes on the columns of ``documents``; the last
one returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pressgauge.llm import exact_dedup, packing, simhash, substring, toxicity
from pressgauge.llm.common import table
from pressgauge.sinks.files import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.7 by a classifier fitted on the labelled ones."""
    return toxicity.kept_documents(docs, table(spark, sf_dir, "labels"), threshold=0.7)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of equal texts."""
    return exact_dedup.kept_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group whose fingerprints of four-word shingles link at four differing bits."""
    return simhash.kept_documents(docs, shingle=4, distance=4)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 13 words and more that a smaller id holds."""
    return substring.cleaned_documents(docs, min_words=13)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("packing", pack),
]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
