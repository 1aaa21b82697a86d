"""Corpus pipeline: quality rules, line de-duplication, SimHash near-duplicates, mixing, BPE encoding.

Each stage takes (spark, docs, sf_dir) and returns a table that is written as
Parquet and read again as the next stage's documents.

Edge cases, in every stage: a table without rows goes through as one; further
columns of any name are carried along (the last stage returns its own columns
only); texts of any length are read whole.  Rows with a null text or fewer than
ten words fail the quality rules.  A null language or source is a group of its
own, in the rules and in the mixture.  A null doc_id comes first among the lines,
last among near duplicates, and is encoded like any other.  Of equal rows with
one id the first by its place in the files keeps its lines and stays.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from geoloom.llm import bpe, lines, mixing, quality, simhash
from geoloom.llm.common import discard, made, shared_dir
from geoloom.llm.queries import WORD_BPE


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line, to one edit, go from the texts."""
    return lines.dedup_lines(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return simhash.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources get equal weight by Poisson replication; the copies are shuffled."""
    return mixing.mixture(docs)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each copy, with their digest and that of the decoded text."""
    return bpe.encoded(docs, WORD_BPE, ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", simhash_dedup),
    ("mixing", mix_sources),
    ("bpe encoding", bpe_encode),
]

#: The models, sketches and encodings of the stages can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written to the shared folder and read again; what a stage has left behind is deleted when the next one is written."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (_, stage) in enumerate(STAGES):
        out, before = f"{shared_dir(spark).rstrip('/')}/stage-{k}-{uuid.uuid4().hex}", made()
        got = stage(spark, docs, sf_dir)
        got.write.parquet(out)
        docs = spark.read.schema(got.schema).parquet(out)
        discard(spark, [f for f in made() if f not in before] + ([last] if last else []))
        last = out
    return docs
