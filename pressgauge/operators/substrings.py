"""Keyword search by substring through an index of character q-grams.

A keyword can only be in a text that holds all its q-grams, so it is looked up under the one that the fewest
texts hold, and verified there. Keywords shorter than q are their own gram. No keyword is tested against a
text without that gram, and no cross join is made.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pressgauge.operators.joins import is_small, lookup


def grams(text: Column, sizes: Sequence[int]) -> Column:
    """The different runs of ``sizes`` characters of a text."""
    letters = F.split(text, "")

    def runs(size: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(0)))
        found = F.transform(starts, lambda i: F.array_join(F.slice(letters, i, size), ""))
        return F.when(F.length(text) >= size, found).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*[runs(s) for s in sizes]))


def gram_index(texts: DataFrame, keywords: DataFrame, *, text: str, size: int = 3, small: bool | None = None) -> DataFrame:
    """(gram, needle, news_keyword): each keyword under its rarest gram; those with a gram no text has are left out."""
    folded = F.lower("keyword")
    table = keywords.select(folded.alias("needle"), F.col("keyword").alias("news_keyword")).where(F.length("needle") > 0).distinct()
    own = F.when(F.length("needle") < size, F.array("needle")).otherwise(grams(F.col("needle"), [size]))
    rows = table.select("needle", "news_keyword", F.explode(own).alias("gram"))
    asked = rows.select("gram").distinct()
    found = texts.select(F.explode(grams(F.lower(text), _sizes(table, size))).alias("gram"))
    held = lookup(found, asked, "gram", "left_semi", small=small).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    counted = rows.join(held, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = counted.groupBy("needle", "news_keyword").agg(F.min(F.struct("n", "gram")).alias("g"))
    return rarest.where("g.n > 0").select("g.gram", "needle", "news_keyword")


def _sizes(table: DataFrame, size: int) -> list[int]:
    """The gram sizes that the keywords need."""
    found = table.agg(F.collect_set(F.least(F.length("needle"), F.lit(size))).alias("s")).first().s
    return sorted(found) or [size]


def search_substrings(
    texts: DataFrame, keywords: DataFrame, ids: Sequence[str], *, text: str = "text", size: int = 3, small: bool | None = None
) -> DataFrame:
    """Distinct (ids, ``news_keyword``) for every keyword that a text contains, in any case.

    A keyword table measured small is broadcast, and the texts are searched where they are read. Beyond
    that only ids and grams are shuffled for the lookup, and the texts once for the check. Null and empty
    keywords and null texts match nothing.
    """
    small = is_small(keywords) if small is None else small
    folded = texts.select(*ids, F.lower(text).alias("_text")).where(F.col("_text").isNotNull())
    index = gram_index(texts, keywords, text=text, size=size, small=small)
    sizes = _sizes(index, size)
    if small:
        # The table is small, so is its index.
        rows = folded.select(*ids, "_text", F.explode(grams(F.col("_text"), sizes)).alias("gram"))
        found = rows.join(F.broadcast(index), "gram")
    else:
        rows = folded.select(*ids, F.explode(grams(F.col("_text"), sizes)).alias("gram"))
        found = lookup(rows, index, "gram", small=False, salt=F.xxhash64(*ids)).drop("gram").join(folded, list(ids))
    return found.where(F.contains("_text", F.col("needle"))).select(*ids, "news_keyword").distinct()
