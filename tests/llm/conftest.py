"""Rows that every operator must take: nulls, empty and very long texts, ties, repeated rows, columns with odd names."""

import pytest

LONG = " ".join(f"word{i % 997}x{i % 31}" for i in range(60_000))

TEXTS = [
    (1, "the quick brown fox jumps over the lazy dog and runs far away from the old grey house on the hill"),
    (2, "The quick  brown fox jumps over the lazy dog and runs far away from the old grey house on the hill"),
    (3, "the quick brown fox jumps over the lazy dog and runs far away from the old grey house on the mountain"),
    (4, None), (5, ""), (6, " \t\n"), (7, "one"), (8, "one"), (9, "One two"), (10, LONG), (11, LONG + " end"),
    (12, "ünï cödé wörds ΑΒΓ 日本語 <|endoftext|> don't"), (13, "one"), (13, "one"), (None, "one"), (None, None),
]


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from periodix.llm.work import ship_package

    ship_package(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """TEXTS among columns whose names the operators use themselves."""
    rows = [(i, t, "x", 0, "y", 1.0, "z", 3) for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, body string, n int, key string, rank double, label string, part int")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
