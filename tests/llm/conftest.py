import pytest

LONG = "word " * 30_000 + "end."


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns whose names clash with inner ones."""
    copy = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu."
    rows = [
        (1, copy, "en", "a"), (1, copy, "en", "a"), (2, copy, "en", "b"), (3, None, None, None), (4, "", "en", "a"),
        (None, "Only one here", None, "b"), (5, LONG, "en", "a"), (6, "\n\n", "de", None), (7, "Été naïve\nAlpha beta\nAlpha beta", "fr", "b"),
        (None, None, None, None), (8, copy.upper(), "en", "c"),
    ]
    rows = [(*r, 1, "x", 2, 3) for r in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, fp int, h string, score int, component_id int")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("1 = 0")
