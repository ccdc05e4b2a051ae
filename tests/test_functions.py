import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pressgauge.functions import counts, html, text, vectors


def one(spark, value, build, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(build(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize("shown, expected", [
    ("", 0), ("7", 7), ("1.2K", 1200), ("1.2k", 1200), ("3m", 3_000_000), ("3M", 3_000_000), ("2.5B", 2_500_000_000),
    ("2b", 2_000_000_000), ("1.001K", 1000), (" 12 ", 12), ("-3", -3), ("1,234", None), ("abc", None), ("12.7", None),
    ("K", None), ("NaNK", None), ("1dK", None), (None, None),
])
def test_parse_count(spark, shown, expected):
    assert one(spark, shown, counts.parse_count) == expected


def test_parse_count_commas(spark):
    assert one(spark, "1,234", lambda c: counts.parse_count(c, strip_commas=True)) == 1234


@pytest.mark.parametrize("shown, expected", [("", 1), ("7", 8), ("1,234", 1), (None, 1)])
def test_like_weight(spark, shown, expected):
    assert one(spark, shown, counts.like_weight) == expected


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 9999), min_size=1, max_size=50))
def test_parse_count_grows_with_suffix(spark, numbers):
    df = spark.createDataFrame([(str(n),) for n in numbers], "n string")
    parsed = [counts.parse_count(F.concat("n", F.lit(s))).alias(s or "none") for s in ("", "K", "M", "B")]
    for number, row in zip(numbers, df.select(*parsed).collect()):
        assert tuple(row) == (number, number * 10**3, number * 10**6, number * 10**9)


def test_letter_tokens(spark):
    assert one(spark, "Don't STOP the Café-men's 3", text.letter_tokens) == ["don", "t", "stop", "the", "caf", "men", "s"]
    assert one(spark, "", text.letter_tokens) == []


def test_punct_tokens_keep_ends(spark):
    assert one(spark, "Hi, (you) there!", text.punct_tokens) == ["hi", "you", "there", ""]
    assert one(spark, "-a", lambda c: text.drop_empty_tokens(text.punct_tokens(c))) == ["a"]
    assert one(spark, None, text.punct_tokens) is None


def test_word_sequence_keeps_apostrophe(spark):
    assert one(spark, "It's A-b, c_d\te.", text.word_sequence) == ["it's", "a", "b", "c", "d", "e"]


def test_whitespace_tokens(spark):
    assert one(spark, "  a b \n c ", text.whitespace_tokens) == ["a", "b", "c"]


def test_sentences(spark):
    assert one(spark, "A b. C.", text.sentences) == ["A b", " C", ""]


@pytest.mark.parametrize("title, plain, strict", [
    ("Foo bar - CNN", "Foo bar ", "Foo bar "), ("A-b - BBC - x", "A-b - BBC ", "A-b - BBC "), ("-x", "", ""),
    ("nohyphen", "nohyphen", "nohyphe"), ("", "", ""), ("a\nb-c", "a\nb", "a\nb"),
])
def test_trim_headline(spark, title, plain, strict):
    assert one(spark, title, text.trim_headline) == plain
    assert one(spark, title, lambda c: text.trim_headline(c, strict=True)) == strict


def test_flatten_lists(spark):
    kind = "v array<array<string>>"
    assert one(spark, [["a"], None, ["b", "c"]], text.flatten_lists, kind) == ["a", "b", "c"]
    assert one(spark, None, text.flatten_lists, kind) is None


def test_strip_newline(spark):
    assert one(spark, "a\n", text.strip_newline) == "a"


@pytest.mark.parametrize("raw, expected", [
    ("a &amp;lt; b", "a &lt; b"), ("&lt;&gt;&quot;&apos;", "<>\"'"), ("&#233;t&#233;", "été"), ("&#128512;!", "😀!"),
    ("&#55296;", "&#55296;"), ("&#x;", "&#x;"), ("plain", "plain"),
])
def test_unescape(spark, raw, expected):
    assert one(spark, raw, html.unescape) == expected


def test_array_functions(spark):
    kind = "v array<double>"
    assert one(spark, [1.0, 3.0, 3.0], vectors.arg_max, kind) == 1
    assert one(spark, [0.0, 1.0], vectors.softmax, kind) == pytest.approx([0.268941, 0.731059], abs=1e-6)
    assert one(spark, [1.0, 2.0], lambda c: vectors.dot(c, c), kind) == 5.0
    assert one(spark, [1, 2], lambda c: vectors.pad(c, 4), "v array<int>") == [1, 2, 0, 0]
    assert one(spark, [1, 2, 3], lambda c: vectors.pad(c, 2), "v array<int>") == [1, 2]


def test_pseudo_random_vector_is_repeatable(spark):
    first = one(spark, "w", lambda c: vectors.pseudo_random_vector(c, 5))
    assert first == one(spark, "w", lambda c: vectors.pseudo_random_vector(c, 5))
    assert len(set(first)) == 5 and all(0 <= x < 1 for x in first)
