import pytest

from tradewatch.llm.scratch import ship_package

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def package(spark):
    ship_package(spark)


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) pairs."""

    def build(*rows):
        full = [(i, t, "en", "src0", len(t) if t is not None else None) for i, t in rows]
        return spark.createDataFrame(full, DOCS)

    return build


LONG = " ".join(f"word{i % 977} and{i % 131}" for i in range(40_000))


@pytest.fixture
def awkward(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and clashing extra columns."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog near the old river bank. " * 4),
        (2, "The quick brown fox jumps over the lazy dog near the old river bank. " * 4),
        (2, "The quick brown fox jumps over the lazy dog near the old river bank. " * 4),
        (None, "The quick brown fox jumps over the lazy dog near the old river bank. " * 4),
        (3, None),
        (4, ""),
        (4, ""),
        (5, " \t\n  "),
        (6, LONG),
        (7, "é ü 漢字 🙂 mail me@example.org now \x00 end"),
        (8, "one"),
    ]
    extra = "fp long, score double, key string, row long, hash long, doc long, bundle int, base string"
    full = [(i, t, None, None, None, 1, 0.5, "k", 2, 3, 4, 5, "b") for i, t in rows]
    return spark.createDataFrame(full, f"{DOCS}, {extra}")


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCS)
