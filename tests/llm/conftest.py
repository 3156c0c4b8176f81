import pytest

#: id, text, lang, source and two columns whose names clash with inner ones
SCHEMA = "doc_id long, text string, lang string, source string, row int, size string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    long_text = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    rows = [(1, "a b c d e f g h i j k l", "en", "s1", 1, "x"), (1, "a b c d e f g h i j k l", "en", "s1", 1, "x"),
            (2, "a b c d e f g h i j k l", None, None, None, None), (None, "A b c d e f g h i j k l", "en", "s2", 2, "y"),
            (None, None, None, None, None, None), (3, "", "de", "s1", 3, "z"), (4, " \t\n", "de", "s1", 3, "z"),
            (5, long_text, "en", "s1", 4, ""), (6, long_text + " tail", "en", "s2", 4, ""), (7, "😀 é́ ▁ ß", "fr", "s2", 5, "é"),
            (8, "x" * 50_000, "en", "s1", 6, "q"), (9, "1" * 30_000, "en", "s1", 6, "q")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
