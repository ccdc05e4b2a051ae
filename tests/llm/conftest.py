import random

import pytest

SYLLABLES = ["ba", "ke", "li", "mo", "nu", "ra", "se", "ti", "vo", "zu"]


@pytest.fixture()
def make_words():
    """A deterministic source of invented words."""

    def build(seed, count, size=60):
        rng = random.Random(seed)
        vocabulary = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(size)]
        return [rng.choice(vocabulary) for _ in range(count)]

    return build


@pytest.fixture()
def odd_documents(spark):
    """Nulls, empty and blank texts, repeated rows, ties and a clashing extra column."""
    rows = [
        (1, "same text here", "x", 0), (2, "same \t text\nhere", None, 1), (3, None, "y", 2), (4, "", "y", 3),
        (5, " ", "z", 4), (6, "same text here", "x", 5), (6, "same text here", "x", 5), (None, "lone", None, None),
        (7, "Ünïcödé  ß wörds", "x", 7),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, digest string, n long")


@pytest.fixture()
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string")
