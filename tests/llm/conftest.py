import pytest

LONG = "Alpha beta gamma delta. " * 20_000


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with nulls in every column, empty, blank and very long texts, repeated rows and
    extra columns, some of them named like results."""
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen " * 3
    rows = [
        (1, text, "en", "a", 3, True, "x"),
        (1, text, "en", "a", 3, True, "x"),
        (2, None, None, None, None, None, None),
        (3, "", "en", "a", 0, False, ""),
        (4, " \t\n ", "en", "b", 4, False, ""),
        (None, "word", None, "b", None, None, "y"),
        (None, None, None, None, None, None, None),
        (5, LONG, "en", None, 1, True, "z"),
        (6, "x" * 200_000, "en", "c", 1, True, "z"),
        (7, text, "fr", "a", 3, True, "w"),
        (8, "naïve Ünïcode 中文 😀 \x00 ends\x1c here", "de", "c", 3, True, "w"),
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score string"
    )


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (2, None, None), (None, 1, 1), (3, 0, 1), (3, 1, 0), (4, 1, 0), (5, 0, 1), (7, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
