"""Rows that every operator here must survive: nulls anywhere, empty and very long texts, ties, repeated rows, extra columns."""

import pytest

ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids long, start long, length long, offset long, shard int, kept boolean"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Extra columns carry names that operators use themselves."""
    long_text = " ".join(f"w{i % 977} " for i in range(60_000))
    texts = [
        (1, "one two three four five six seven"),
        (2, "one two three four five six seven"),
        (2, "one two three four five six seven"),
        (3, None),
        (4, ""),
        (5, " \t\n "),
        (None, "a text without an id, which stays"),
        (6, long_text),
        (7, long_text + " end"),
        (8, "<|endoftext|> special \x1c\x1d strings  and   runs\n\n of  space ends "),
        (9, "Ünïcödé \U0001f600 words’ Σ ΑΣ end́"),
    ]
    rows = [(d, t, None, None, None, 7, 7, 7, 7, 7, True) for d, t in texts]
    return spark.createDataFrame(rows, ODD_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def tiny(spark):
    """The smallest given tables."""
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")


FOLDER = "/root/testdata/sf0.001"
