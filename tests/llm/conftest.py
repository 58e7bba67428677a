import os

import pytest

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_schema():
    return "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def given(spark):
    """A given table, whole."""
    return lambda name, folder=DATA: spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


@pytest.fixture(scope="session")
def odd_docs(spark, docs_schema):
    """Nulls in every column, empty and very long texts, repeated rows, and columns with clashing names."""
    long = " ".join(f"w{i % 5000}" for i in range(120_000))
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, "   \n\t ", "en", "a", 3),
        (4, long, "en", "a", len(long)),
        (5, long, None, "b", len(long)),
        (None, "a text without an id " * 5, "en", "a", 100),
        (None, "a text without an id " * 5, "en", "a", 100),
        (7, "one", "de", None, 3),
        (7, "one", "de", None, 3),
        (8, "Ein kurzer Text über die Welt und noch ein paar Wörter mehr dazu", "de", "c", None),
    ]
    df = spark.createDataFrame(rows, docs_schema)
    clash = {c: df["source"] for c in ("row", "rest", "kind", "range", "n", "shard", "bucket", "rep", "lead", "mark", "words", "label", "score", "group", "word", "host")}
    return df.withColumns(clash)


@pytest.fixture(scope="session")
def no_docs(spark, docs_schema):
    return spark.createDataFrame([], docs_schema)
