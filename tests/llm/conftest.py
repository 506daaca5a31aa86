import pytest

LONG = "word " * 30_000 + "x" * 5_000
CASES = [
    (1, "The quick brown fox jumps over the lazy dog while seven small birds watch from an old oak tree nearby."),
    (2, "The quick brown fox jumps over the lazy dog while seven small birds watch from an old oak tree nearby."),
    (3, "The quick brown fox jumps over the lazy dog while seven small birds watch from an old oak tree nearby today."),
    (4, ""),
    (5, None),
    (6, " \t\n "),
    (7, "one two"),
    (8, LONG),
    (9, "café 日本語 \U0001f642 naïve   nbsp"),
    (None, "a row without an id but with enough words to be kept by every rule there is here"),
    (7, "one two"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows, and extra columns named like those of the operators."""
    rows = [(i, t, "en", "s", len(t or ""), "k", 1.5, True) for i, t in CASES]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, score double, kept boolean"
    ).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
