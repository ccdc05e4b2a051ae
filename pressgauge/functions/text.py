"""Tokenizers and string rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# White space and ASCII punctuation, as members of a character class. Single members
# are listed one by one, as the regex engine tests those of Latin-1 with one table look-up.
_SPACE = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PUNCTUATION = r"""!"#$%&'()*+,\-./:;<=>?@\[\\\]\^_`{|}~"""
# What separates words for the classifier (the apostrophe does not).
_WORD_FILTERS = r"""!"#$%&()*+,\-./:;<=>?@\[\\\]\^_`{|}~\t\n """


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def letter_tokens(text: Column) -> Column:
    """Lower-cased runs of the letters a to z."""
    return _matches(F.lower(text), "[a-z]+")


def cased_letter_tokens(text: Column) -> Column:
    """Runs of ASCII letters in their written case."""
    return _matches(text, "[A-Za-z]+")


def punct_tokens(text: Column) -> Column:
    """Lower-cased pieces between punctuation and white space; empty end pieces are kept."""
    return F.split(F.lower(text), f"[{_PUNCTUATION}{_SPACE}]+")


def word_sequence(text: Column) -> Column:
    """Lower-cased words as fed to the classifier."""
    return _matches(F.lower(text), f"[^{_WORD_FILTERS}]+")


def whitespace_tokens(text: Column) -> Column:
    """Pieces between runs of white space, without empty pieces."""
    return _matches(text, f"[^{_SPACE}]+")


def sentences(text: Column) -> Column:
    """Pieces between full stops; the piece after the last stop is kept, also when empty."""
    return F.split(text, r"\.")


def drop_empty_tokens(tokens: Column) -> Column:
    """Array without null and empty tokens."""
    return F.filter(tokens, lambda t: t.isNotNull() & (t != ""))


def flatten_lists(lists: Column) -> Column:
    """One list out of a list of lists; null inner lists are skipped, a null input stays null."""
    return F.flatten(F.filter(lists, lambda inner: inner.isNotNull()))


def trim_headline(title: Column, strict: bool = False) -> Column:
    """Headline text before its last hyphen.

    A headline without hyphen is kept whole; ``strict`` drops its last character instead.
    """
    without = F.left(title, F.length(title) - 1) if strict else title
    before = F.regexp_extract(title, r"(?s)^(.*)-", 1)
    return F.when(F.contains(title, F.lit("-")), before).otherwise(without)


def strip_newline(line: Column) -> Column:
    """Line without line feeds."""
    return F.replace(line, F.lit("\n"), F.lit(""))


def is_present(text: Column) -> Column:
    """True for a non-null, non-empty string."""
    return text.isNotNull() & (F.length(text) > 0)
