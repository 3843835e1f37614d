import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) or whole rows."""

    def docs(rows):
        full = [tuple(row) + ("en", "s", None)[len(row) - 2 :] if len(row) < 5 else tuple(row) for row in rows]
        return spark.createDataFrame(full, SCHEMA)

    return docs


@pytest.fixture(scope="session")
def odd(make):
    """Nulls in each column, empty and long texts, ties and repeated rows."""
    long = "word " * 30_000 + "x" * 20_000 + " é" * 500
    rows = [
        (1, None, None, None, None),
        (None, "no id but some text here that is long enough", "en", None, 3),
        (None, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, "   \n\t ", "fr", "a", 0),
        (4, long, "en", "b", len(long)),
        (5, long, "en", "b", len(long)),
        (6, "same row\nsame row", "de", "c", 17),
        (6, "same row\nsame row", "de", "c", 17),
        (7, "12 34 !!", None, "a", 8),
    ]
    return make(rows)


@pytest.fixture(scope="session")
def clashing(odd):
    """The same with columns whose names the operators use."""
    from pyspark.sql import functions as F

    names = ["digest", "size", "score", "shard", "kind", "rows", "node", "class", "blob", "spans", "words", "start", "end"]
    return odd.withColumns({name: F.lit("x") for name in names})
