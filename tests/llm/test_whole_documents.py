"""Whole documents go through the mixing query."""

from __future__ import annotations

import os

from compared import DATA
from pyspark.sql import functions as F

from geoloom.llm import queries


def test_mixing_carries_texts(spark):
    got = queries.op8_mixing(spark, DATA)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    mixed = spark.read.parquet(os.path.dirname(got.inputFiles()[0]))
    assert set(docs.columns) <= set(mixed.columns)
    digest = F.md5(F.concat_ws("\x1f", *docs.columns).cast("binary")).alias("digest")
    copies = got.join(docs.select("doc_id", digest), "doc_id").groupBy("digest").count()
    assert sorted(map(tuple, mixed.groupBy(digest).count().collect())) == sorted(map(tuple, copies.collect()))
