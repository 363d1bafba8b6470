from __future__ import annotations

import pytest

#: Nulls, empty texts, white space only, repeated rows, equal texts, and columns with names that operators use.
ODD = [
    (1, "", "x"), (2, None, None), (3, " \n\t", "x"), (4, "same text here", "y"), (4, "same text here", "y"),
    (5, "same text here", None), (None, "no id, but words", "z"), (None, None, None), (6, "ünïcödé 字漢😀 \x85 x", "x"),
]
CLASHING = "_k1 string, _row string, _text string, _id string, kept string, n_words string, node string, `a.b` string"


@pytest.fixture(scope="session")
def odd(spark):
    """Rows that are odd in every way, with clashing columns."""
    names = [c.split()[0] for c in CLASHING.split(", ")]
    rows = [(i, t, lang, *[f"{n}-{k}" for n in names]) for k, (i, t, lang) in enumerate(ODD)]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, {CLASHING}").repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


@pytest.fixture(scope="session")
def documents(spark, tables):
    return spark.read.parquet(f"{tables}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
