"""Engagement counters as shown on a page: ``7``, ``1.2K``, ``3m``, ``2.5B``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Suffixes in the order they are looked for, with their factors.
SUFFIXES = (("K", 1e3), ("k", 1e3), ("M", 1e6), ("m", 1e6), ("B", 1e9), ("b", 1e9))

_DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_INTEGER = r"^\s*[+-]?\d+\s*$"


def parse_count(text: Column, strip_commas: bool = False) -> Column:
    """Counter text as a long: blank is 0, fractions are cut, junk is null."""
    text = F.replace(text, F.lit(","), F.lit("")) if strip_commas else text
    parsed = F.when(text == "", F.lit(0).cast("bigint"))
    for suffix, factor in SUFFIXES:
        number = F.replace(text, F.lit(suffix), F.lit(""))
        scaled = F.when(number.rlike(_DECIMAL), number.try_cast("double")) * F.lit(factor)
        parsed = parsed.when(F.contains(text, F.lit(suffix)), scaled.try_cast("bigint"))
    return parsed.otherwise(F.when(text.rlike(_INTEGER), F.trim(text).try_cast("bigint")))


def like_weight(text: Column, strip_commas: bool = False) -> Column:
    """Weight of a comment: one for the comment itself plus its likes."""
    return F.lit(1).cast("bigint") + F.coalesce(parse_count(text, strip_commas), F.lit(0).cast("bigint"))
