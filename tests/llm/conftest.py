from __future__ import annotations

import pytest
from pyspark.sql import types as T

FOLDER = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor sit amet " * 4000


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (id, text) rows, with extra columns named like the operators' own."""
    names = (
        "key hash score fp root word words label base marks leaky chosen_id chosen_key _marks _marks_key _new id merged new check "
        "row_key text_key first ids n_tokens decoded copied ranges"
    ).split()
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), *(T.StructField(c, T.StringType()) for c in names),
    ])
    return lambda rows: spark.createDataFrame([(i, t, *["x"] * len(names)) for i, t in rows], schema)


@pytest.fixture(scope="session")
def odd(make):
    """Nulls, empty and blank texts, repeated rows, a null id, one very long text."""
    return make([(1, None), (2, ""), (3, " \n\t "), (4, "one word"), (4, "one word"), (None, "one word"), (5, LONG), (6, None)])
