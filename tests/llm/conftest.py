import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, rank long, size string, fp string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, columns whose names clash."""
    long = "lorem ipsum dolor sit amet " * 8000
    rows = [
        (1, "the cat sat on the mat and the dog ran", "en", "a", 38, 1, "x", "y"),
        (2, None, "en", "a", None, None, None, None),
        (3, "", None, None, 0, 1, "", ""),
        (4, long, "en", "b", len(long), 1, "x", "y"),
        (5, long, "en", "b", len(long), 1, "x", "y"),
        (5, long, "en", "b", len(long), 1, "x", "y"),
        (6, " \t\n ", "de", "a", 4, 1, "x", "y"),
        (None, "der Hund und die Katze sind im Haus", "de", None, 35, 1, "x", "y"),
        (None, None, None, None, None, None, None, None),
        (7, "12345 67 89 !!", "de", "c", 14, 1, "x", "y"),
        (8, "x" * 300_000, "fr", "c", 300_000, 1, "x", "y"),
        (9, "Der Hund und die Katze sind im Haus", "de", "a", 35, 1, "x", "y"),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
