"""Keyword mining over headlines."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from pressgauge.functions import text as text_fn
from pressgauge.operators.joins import is_small, lookup
from pressgauge.operators.tweets import phrase_lengths, phrase_rows

# Entity types that may serve as keywords.
KEYWORD_TYPES = ("PERSON", "NORP", "FAC", "ORG", "GPE", "PRODUCT", "EVENT")


def headline_titles(headlines: DataFrame, language: str | None = "en", strict: bool = False) -> DataFrame:
    """Trimmed titles of the headlines in one language."""
    kept = headlines if language is None else headlines.where(F.col("lang") == language)
    return kept.withColumn("title", text_fn.trim_headline(F.col("title"), strict))


def headline_texts(headlines: DataFrame, fields: Sequence[str] = ("title", "description", "content")) -> DataFrame:
    """Title, description and content as lines of one column."""
    others = [c for c in headlines.columns if c not in fields]
    lines = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("line")) for f in fields])
    return headlines.select(*others, F.inline(lines))


def mine_keywords(
    titles: DataFrame,
    gazetteer: DataFrame,
    *,
    title: str = "title",
    types: Sequence[str] = KEYWORD_TYPES,
    small: bool | None = None,
) -> DataFrame:
    """Distinct ``keyword`` for gazetteer phrases of the wanted types found in a title."""
    wanted = gazetteer.where(F.col("ent_type").isin(*types))
    normal = F.array_join(text_fn.letter_tokens(F.col("phrase")), " ")
    table = wanted.select(normal.alias("phrase"), F.col("phrase").alias("keyword")).where(F.col("phrase") != "").distinct()
    runs = phrase_rows(titles, [], text_fn.letter_tokens(F.col(title)), phrase_lengths(table))
    if small is None:
        small = is_small(table)
    # A large gazetteer is joined by shuffle: repeated runs are then combined first.
    return lookup(runs if small else runs.distinct(), table, "phrase", small=small).select("keyword").distinct()


def capitalised_runs(titles: DataFrame, *, title: str = "title", min_titles: int = 2) -> DataFrame:
    """Keywords without a gazetteer: runs of capitalised words by the number of titles they are in."""
    run = r"(?:^|[^\p{L}\p{N}])(\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*)"
    runs = F.regexp_extract_all(title, F.lit(run), F.lit(1))
    rows = titles.select(F.explode(F.array_distinct(runs)).alias("keyword"))
    counted = rows.groupBy("keyword").agg(F.count(F.lit(1)).alias("n_titles"))
    return counted.where(F.col("n_titles") >= min_titles)


def model_keywords(
    titles: DataFrame,
    load_model: Callable[[], Callable[[str], Sequence[tuple[str, str]]]],
    *,
    title: str = "title",
    types: Sequence[str] = KEYWORD_TYPES,
) -> DataFrame:
    """Keywords from a user's entity model, loaded once per worker; it maps a text to (phrase, type)."""

    @F.pandas_udf("array<struct<phrase:string,ent_type:string>>")
    def entities(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_model()
        for batch in batches:
            yield batch.map(lambda t: [{"phrase": p, "ent_type": e} for p, e in model(t or "")])

    found = titles.select(F.inline(entities(F.col(title))))
    return found.where(F.col("ent_type").isin(*types)).select(F.col("phrase").alias("keyword")).distinct()
