"""Lexicon sentiment as a join and a sum.

A text's valence is the sum over its tokens of ``lexicon(token, valence)``; the compound score is
that sum S mapped to (-1, 1) by S / sqrt(S^2 + 15), the normalisation of Hutto and Gilbert (2014).
The sum is combined on the map side, so one small row per text is shuffled, never its tokens.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pressgauge.functions import text as text_fn
from pressgauge.operators.joins import lookup, unique

# Normalisation constant and the weights of the emphasis rules.
ALPHA = 15
CAPS_BOOST = 0.733
EXCLAMATION, MAX_EXCLAMATIONS = 0.292, 4
QUESTION, MANY_QUESTIONS = 0.18, 0.96
NEGATION = -0.74
DISTANCE_DAMPING = (1.0, 0.95, 0.9)


def compound(total: Column) -> Column:
    """Compound score of a valence sum, rounded to four places."""
    return F.round(total / F.sqrt(total * total + ALPHA), 4)


def score_texts(
    df: DataFrame,
    ids: Sequence[str],
    text: str,
    lexicon: DataFrame,
    *,
    tokenizer: Callable[[Column], Column] = text_fn.letter_tokens,
    small: bool | None = None,
    out: str = "score",
) -> DataFrame:
    """One compound score per row of ``df``; texts without known words score 0.

    ``ids`` must identify the text; further columns that depend on it may be listed to carry them.
    """
    tokens = df.select(*ids, F.explode_outer(tokenizer(F.col(text))).alias("token"))
    valued = lookup(tokens, unique(lexicon.select("token", "valence"), "token", small), "token", "left", small=small)
    total = F.sum(F.coalesce("valence", F.lit(0.0)))
    return valued.groupBy(*ids).agg(compound(total).alias(out))


def score_sentences(
    df: DataFrame,
    ids: Sequence[str],
    text: str,
    lexicon: DataFrame,
    *,
    small: bool | None = None,
) -> DataFrame:
    """One compound score per sentence as rows (ids, ``sent_pos``, ``score``)."""
    # The outer form, as Spark would split once more to filter empty lists beforehand.
    present = df.where(F.col(text).isNotNull())
    rows = present.select(*ids, F.posexplode_outer(text_fn.sentences(F.col(text))).alias("sent_pos", "sentence"))
    return score_texts(rows, [*ids, "sent_pos"], "sentence", lexicon, small=small)


def collect_scores(rows: DataFrame, ids: Sequence[str], out: str = "sentiment_scores") -> DataFrame:
    """Sentence scores as one array per text, in sentence order."""
    ordered = F.array_sort(F.collect_list(F.struct("sent_pos", "score")))
    return rows.groupBy(*ids).agg(F.transform(ordered, lambda x: x.score).alias(out))


def score_texts_with_emphasis(
    df: DataFrame,
    ids: Sequence[str],
    text: str,
    lexicon: DataFrame,
    modifiers: DataFrame,
    *,
    small: bool | None = None,
    out: str = "score",
) -> DataFrame:
    """Compound scores with booster words, negation, capitals and punctuation.

    ``modifiers(token, boost, negates)`` holds intensifiers (signed boost) and negation words. Each
    token carries its three predecessors, so no window over the token rows is needed. Rules: a
    predecessor adds its boost in the direction of the valence, damped by distance; a negation
    among the predecessors multiplies by -0.74; an all-capitals word in a mixed-case text gains
    0.733; up to four exclamation marks add 0.292 each, two or three question marks 0.18 each and
    more of them 0.96, all in the direction of the sum.
    """
    words = text_fn.cased_letter_tokens(F.col(text))
    marked = df.select(
        *ids,
        words.alias("_words"),
        F.least(F.length(F.regexp_replace(text, "[^!]", "")), F.lit(MAX_EXCLAMATIONS)).alias("_excl"),
        F.length(F.regexp_replace(text, "[^?]", "")).alias("_ques"),
        F.exists(words, lambda w: w != F.upper(w)).alias("_mixed"),
    )

    def with_context(word: Column, i: Column) -> Column:
        previous = [F.lower(F.get("_words", i - k)).alias(f"prev{k}") for k in (1, 2, 3)]
        capitals = F.col("_mixed") & (word == F.upper(word)) & (F.length(word) > 1)
        return F.struct(F.lower(word).alias("token"), capitals.alias("caps"), *previous)

    rows = marked.select(*ids, "_excl", "_ques", F.inline_outer(F.transform("_words", with_context)))
    valued = lookup(rows, unique(lexicon.select("token", "valence"), "token", small), "token", "left", small=small)
    modifiers = unique(modifiers.select("token", "boost", "negates"), "token", small)
    for k in (1, 2, 3):
        table = modifiers.select(
            F.col("token").alias(f"prev{k}"),
            (F.coalesce("boost", F.lit(0.0)) * DISTANCE_DAMPING[k - 1]).alias(f"boost{k}"),
            F.when(F.col("negates"), F.lit(NEGATION)).otherwise(F.lit(1.0)).alias(f"factor{k}"),
        )
        valued = lookup(valued, table, f"prev{k}", "left", small=small)
    valence = F.coalesce("valence", F.lit(0.0))
    direction = F.signum(valence)
    boosts = sum((F.coalesce(f"boost{k}", F.lit(0.0)) for k in (1, 2, 3)), F.lit(0.0))
    factors = F.coalesce("factor1", F.lit(1.0)) * F.coalesce("factor2", F.lit(1.0)) * F.coalesce("factor3", F.lit(1.0))
    caps = F.when(F.col("caps"), F.lit(CAPS_BOOST)).otherwise(F.lit(0.0))
    amount = F.when(valence == 0, F.lit(0.0)).otherwise((valence + direction * (caps + boosts)) * factors)

    sums = valued.groupBy(*ids, "_excl", "_ques").agg(F.sum(amount).alias("_sum"))
    questions = (
        F.when(F.col("_ques") > 3, F.lit(MANY_QUESTIONS))
        .when(F.col("_ques") > 1, F.col("_ques") * QUESTION)
        .otherwise(F.lit(0.0))
    )
    total = F.col("_sum") + F.signum("_sum") * (F.col("_excl") * EXCLAMATION + questions)
    return sums.select(*ids, compound(total).alias(out))
