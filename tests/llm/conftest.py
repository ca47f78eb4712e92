import pytest

SF_DIR = "/root/testdata/sf0.001"

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = " ".join(f"word{i % 37} and{i % 11} then{i}" for i in range(60))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and blank texts, ties, repeated rows, a long text, near copies."""
    rows = [
        (1, PROSE, "en", "a", 1),
        (2, PROSE, "en", "a", 1),
        (3, PROSE.replace("then7 ", "THEN7 "), "en", "b", 1),
        (4, PROSE.replace("then30 ", "other "), "en", "b", 1),
        (5, None, "en", "a", None),
        (6, "", None, None, 0),
        (7, " \t\n", "en", "c", 3),
        (8, "1234 ... 99999", "en", "c", 3),
        (None, "no number here", "en", "a", 4),
        (None, None, None, None, None),
        (9, "twice the same row", "de", "c", 5),
        (9, "twice the same row", "de", "c", 5),
        (10, "x" * 70_000, "de", "d", 6),
        (11, "straße und größe " * 3_000, "de", "d", 7),
        (12, "日本語のテキスト", "ja", "d", 8),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
