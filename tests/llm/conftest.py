from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"

#: Columns that operators use inside, as a user's table may have them.
CLASHES = ("size", "taken", "target", "lines", "fp", "row", "ids", "votes", "score", "component_id", "edited", "h", "t", "n", "key")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty, blank and very long texts, repeated rows and clashing names."""
    rows = [
        (1, "one two three four five six seven", "en", "a", 5),
        (1, "one two three four five six seven", "en", "a", 5),
        (1, "another text with the same id", "en", None, 5),
        (2, None, None, "b", None),
        (3, "", "en", None, 0),
        (4, " \t\n ", "en", "b", 4),
        (None, "a row without id", "en", "a", 7),
        (None, None, None, None, None),
        (5, "word " * 60_000, "en", "b", 1),
        (6, "é" * 5_000 + "\n" + "x y z\n" * 3_000, "fr", "c", 1),
        (7, "one two three four five six seven", "en", "c", 5),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for i, name in enumerate(CLASHES):
        df = df.selectExpr("*", f"{i} AS {name}")
    return df.cache()


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")
