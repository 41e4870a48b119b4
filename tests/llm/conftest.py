import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns with clashing names."""
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau"
    long = " ".join(f"{w}{i}" for i in range(300) for w in base.split())
    rows = [
        (1, None, "en", "a", None), (2, "", None, "a", 0), (3, base, "en", None, 5), (4, base.upper(), "en", "b", 5),
        (4, base.upper(), "en", "b", 5), (None, base, None, None, None), (None, None, None, None, None),
        (5, long, "de", "a", 9), (6, long + " end", "de", "a", 9), (7, "x" * 70_000, "en", "c", 1), (8, " \t\n ", "en", "c", 1),
        (9, long, "de", "b", 9), (10, "one two", "en", "b", 1), (11, "ONE two", "en", "b", 1),
    ]
    docs = spark.createDataFrame(rows, COLUMNS)
    return docs.selectExpr("*", "1 as size", "2 as copies", "'k' as `key`", "3 as shard", "4 as `set`", "5 as root")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)
