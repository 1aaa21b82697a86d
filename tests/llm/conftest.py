"""Small documents with every odd case: null, empty, blank, very long, repeated rows, ties, clashing columns."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    *[T.StructField(c, T.StringType()) for c in ("line", "id", "key", "fp", "n_words", "kept", "mix_source", "copies", "chunk", "word", "c", "q_text", "at", "pos", "place", "score")],
])
BODY = "the quick brown fox jumps over the lazy dog while twelve grey herons watch from a distant frozen pond near town"
TEXTS = [
    (1, BODY), (2, BODY), (2, BODY), (3, BODY.replace("lazy", "crazy")), (4, None), (5, ""), (6, "   \n\t "), (None, "orphan row with ten words or so in it for the test"), (7, "é" * 30 + " 日本語 👍 " + BODY),
    (8, "word " * 60000), (9, "x" * 120000), (10, "Hello World\nHello World\nhello worle\nunique line here"), (11, "mail me at jo.bloggs@example.com or 10.1.2.3 or 4111 1111 1111 1111 or +1 (555) 010-9999"), (12, "a\x1cb \x00 <|endoftext|> Σ"),
]


@pytest.fixture(scope="session")
def odd(spark):
    data = [(i, t, None if k % 4 == 0 else "en", None if k % 5 == 0 else f"s{k % 3}", None if t is None else len(t), *["clash"] * 16) for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(data, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
