"""Longest phrase matches: leftmost-longest, not overlapping.

The dictionary is a trie kept as a table of prefixes. From every word of a text the match is extended by one
joined word at a time, as long as a prefix goes on; a text's matches are then chosen from left to right.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pressgauge.functions import text as text_fn
from pressgauge.operators.joins import is_small, lookup


def prefix_table(phrases: DataFrame, phrase: str = "phrase") -> DataFrame:
    """(prefix, length, is_end): all word prefixes of the phrases; ``is_end`` marks whole phrases."""
    words = text_fn.letter_tokens(F.col(phrase))
    rows = phrases.select(words.alias("_w")).where(F.size("_w") > 0)
    lengths = F.explode(F.sequence(F.lit(1), F.size("_w"))).alias("length")
    cut = rows.select("_w", lengths).select(
        F.array_join(F.slice("_w", F.lit(1), F.col("length")), " ").alias("prefix"), "length", (F.col("length") == F.size("_w")).alias("_end")
    )
    return cut.groupBy("prefix", "length").agg(F.max("_end").alias("is_end"))


def longest_at_each_word(
    texts: DataFrame, prefixes: DataFrame, ids: Sequence[str], tokens: Column, *, small: bool | None = None
) -> DataFrame:
    """(ids, pos, length, phrase): the longest phrase that begins at each word."""
    small = is_small(prefixes) if small is None else small
    longest = prefixes.agg(F.max("length")).first()[0] or 0
    words = texts.select(*ids, tokens.alias("_w"))
    rows = words.select(*ids, F.posexplode("_w").alias("pos", "_word"), "_w") \
        .withColumn("_w", F.slice("_w", F.col("pos") + 1, F.lit(max(longest, 1)))).withColumn("length", F.lit(None).cast("int"))
    rows = rows.withColumn("_prefix", F.lit(""))
    for k in range(1, longest + 1):
        level = prefixes.where(F.col("length") == k).select(F.col("prefix").alias("_next"), F.col("is_end").alias("_end"))
        longer = F.get("_w", F.lit(k - 1))
        # A null next prefix matches nothing, so a match that ended is not extended again.
        rows = rows.withColumn("_next", F.when(longer.isNotNull() & F.col("_prefix").isNotNull(), F.concat_ws(" ", F.nullif("_prefix", F.lit("")), longer)))
        joined = lookup(rows, level, "_next", "left", small=small, salt=F.xxhash64(*ids, "pos"))
        if k == 1:
            joined = joined.where(F.col("_end").isNotNull())
        rows = joined.select(
            *ids, "pos", "_w", F.when(F.col("_end"), F.lit(k)).otherwise(F.col("length")).alias("length"),
            F.when(F.col("_end").isNotNull(), F.col("_next")).alias("_prefix"),
        )
    found = rows.where(F.col("length").isNotNull())
    return found.select(*ids, "pos", "length", F.array_join(F.slice("_w", F.lit(1), F.col("length")), " ").alias("phrase"))


def choose(matches: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Of the matches of each text, from left to right, those that begin behind the last one chosen."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "length", "phrase")))
    kind = "struct<next:int,taken:array<struct<pos:int,length:int,phrase:string>>>"
    start = F.struct(F.lit(0).alias("next"), F.array().alias("taken")).cast(kind)

    def step(done: Column, match: Column) -> Column:
        taken = F.struct((match.pos + match.length).alias("next"), F.concat(done.taken, F.array(match)).alias("taken")).cast(kind)
        return F.when(match.pos >= done.next, taken).otherwise(done)

    grouped = matches.groupBy(*ids).agg(F.aggregate(ordered, start, step, lambda done: done.taken).alias("_m"))
    return grouped.select(*ids, F.inline("_m"))


def entity_spans(
    texts: DataFrame, gazetteer: DataFrame, ids: Sequence[str], *, text: str = "title", types: Sequence[str] | None = None,
    small: bool | None = None,
) -> DataFrame:
    """(ids, pos, length, phrase) of the gazetteer phrases in each text; of overlapping ones the first, then the longest.

    ``ids`` must name one text. A group is one text's matches.
    """
    wanted = gazetteer if types is None else gazetteer.where(F.col("ent_type").isin(*types))
    prefixes = prefix_table(wanted)
    found = longest_at_each_word(texts, prefixes, ids, text_fn.letter_tokens(F.col(text)), small=small)
    return choose(found, ids)
