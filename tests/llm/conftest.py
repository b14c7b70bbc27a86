from __future__ import annotations

import pytest
from pyspark.sql import types as T

#: Null id, null and empty texts, repeated rows, equal texts, a long text without spaces.
ODD = [
    (1, "one two three four five six seven", "a"),
    (1, "one two three four five six seven", "a"),
    (2, "one two three four five six seven", None),
    (3, None, "b"),
    (4, "", "b"),
    (5, " \t\n ", "b"),
    (None, "null id here", None),
    (6, "x" * 5000, "a"),
    (7, "ünï çödé 日本語 😀 " * 40, "c"),
    (8, "a\nb\n\na\nB  c\r\n", "c"),
]
#: Names that some operator uses for itself.
INNER = ["_id", "_cut", "_tag", "_bytes", "_runs", "_of", "_tokens", "_labelled", "bad", "tokens", "_hit"]


@pytest.fixture
def odd(spark):
    """Rows with odd values, and columns whose names the operators might use themselves."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("source", T.StringType()),
            T.StructField("key", T.StringType()),
            T.StructField("token", T.IntegerType()),
            T.StructField("label", T.StringType()),
            T.StructField("ids", T.StringType()),
            T.StructField("score", T.StringType()),
            T.StructField("id", T.LongType()),
            *(T.StructField(name, T.StringType()) for name in INNER),
        ]
    )
    rows = [(i, t, s, "k", 1, "l", "i", "s", 9, *INNER) for i, t, s in ODD]
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def none(odd):
    return odd.filter("false")
