import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row long, key string, id string, columns string, _bucket int, best string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) pairs with columns whose names operators use inside."""

    def make(pairs):
        rows = [(i, t, "en", "s", None if t is None else len(t), 7, "k", "i", "c", 1, "b") for i, t in pairs]
        return spark.createDataFrame(rows, COLUMNS)

    return make


LONG = " ".join(f"word{i % 977}" for i in range(60_000))


@pytest.fixture(scope="session")
def edge_pairs():
    """Nulls, empty and blank texts, ties, repeated rows, a very long text."""
    return [
        (3, "same text here"), (1, "same  text\there"), (1, "same  text\there"), (2, None), (4, ""), (5, " "),
        (None, "same text here"), (None, None), (6, LONG), (7, LONG), (8, "É"), (9, "one two"), (10, "ONE two"),
    ]
