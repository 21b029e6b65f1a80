import pytest

ODD_SCHEMA = "doc_id long, text string, score double, ids string, `a b` int, found string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing column names."""
    long_text = " ".join(f"word{i % 977} of line{i}" for i in range(20_000))
    rows = [
        (1, None, None, None, None, None),
        (2, "", 0.5, "x", 1, "y"),
        (3, "   \n\t ", 0.5, "x", 1, "y"),
        (4, "short text", 0.5, None, 1, "y"),
        (None, "short text", 0.5, "x", None, "y"),
        (5, long_text, 0.5, "x", 1, "y"),
        (6, long_text, 0.5, "x", 1, None),
        (7, "same row", None, "x", 1, "y"),
        (7, "same row", None, "x", 1, "y"),
        (7, "other text of the same id", 0.1, "x", 1, "y"),
        (8, "é𝐀ﷺ token: abcdef123", 0.1, "x", 1, "y"),
        (None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, ODD_SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
