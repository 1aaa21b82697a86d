"""Repeated and null ids, hot groups and rare sources."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from geoloom.llm import common, lines, mixing, simhash


def test_row_numbers_are_those_of_any_scan(spark, tmp_path):
    spark.range(0, 4000, 1, 7).selectExpr("id", "id % 3 AS k").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert common.numberable(df.filter("k = 1").select("id")) is not None
    first = {r.id: r.n for r in df.select("id", common.row_number(df).alias("n")).collect()}
    some = df.filter("k = 1")
    again = {r.id: r.n for r in some.select("id", common.row_number(some).alias("n")).repartition(3).collect()}
    assert len(set(first.values())) == 4000 and all(first[i] == n for i, n in again.items())
    # joins and explosions repeat a file's rows, so they are written first
    for many in (df.join(df.select(F.col("id").alias("b")), F.col("id") == F.col("b")), df.select("id", F.explode(F.array(F.lit(1), F.lit(2))).alias("e")), df.filter(F.rand() < 0.9)):
        got = common.numberable(many)
        numbers = [r.n for r in got.select(common.row_number(got).alias("n")).collect()]
        assert len(numbers) == len(set(numbers)) > 0


def test_discard(spark):
    before = common.made()
    t = common.written(spark.range(3), "gone")
    mine = [f for f in common.made() if f not in before]
    assert t.count() == 3 and len(mine) == 1
    common.discard(spark, mine)
    assert common.made() == before


def test_lines_of_null_and_repeated_ids(spark):
    """Of 5000 rows without id whose lines are one edit apart, and of equal rows with one id, the first keeps its line."""
    rows = [(None, f"a common footer numbered {i % 10}")  for i in range(5000)] + [(1, "one line\nand another") for _ in range(50)] + [(2, "lone")]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    kept = Counter((r.doc_id, r.text) for r in got)
    assert len(got) == len(rows)
    assert sum(n for (i, t), n in kept.items() if i is None and t) == 1
    assert kept[1, "one line\nand another"] == 1 and kept[1, ""] == 49 and kept[2, "lone"] == 1


def test_near_lines_of_a_hot_half(spark):
    """3000 distinct lines that share a half: near ones go, and lines two edits apart stay."""
    rows = [(i, "the page that everyone shares, number " + f"{i:04d}" * 3) for i in range(3000)] + [(9000, "the page that everyone shares, number 000000000001"), (9001, "the page that everyone shares, number 00000000000")]
    got = {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] for i in range(3000)) and got[9000] == "" and got[9001] == ""


def test_keep_first_of_null_and_repeated_ids(spark):
    body = "one document that many rows hold word for word and that goes on for a while"
    rows = [(None, body)] * 400 + [(7, body)] * 3 + [(5, body), (5, body), (9, "something else entirely that no other row of this table says")] + [(None, "a text that only rows without an id hold, twice or more")] * 20
    got = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted((str(r.doc_id), r.text[:3]) for r in got) == [("5", "one"), ("9", "som"), ("None", "a t")]


def test_distribution_of_large_means():
    for mean in (0.3, 5.0, 1000.0, 1e6, 1e9):
        low, cdf = mixing.distribution(mean)
        assert len(cdf) <= 24 * math.sqrt(mean) + 83 and np.all(np.diff(cdf) >= 0) and abs(cdf[-1] - 1) < 1e-5
        median = low + int((cdf <= 0.5).sum())
        assert abs(median - mean) <= 1
    low, cdf = mixing.distribution(2.0)
    assert low == 0 and np.allclose(cdf[:4], np.exp(-2) * np.array([1, 3, 5, 5 + 8 / 6]))
    assert mixing.distribution(0.0)[1].tolist() == [1.0]


def test_a_rare_source_with_a_million_copies(spark):
    n = 1_000_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("much").alias("source")).union(spark.range(1).select((F.col("id") + n).alias("doc_id"), F.lit("rare").alias("source")))
    got = mixing.drawn(docs, {"much": 0.0, "rare": 1.0})
    seen = got.agg(F.count("*").alias("n"), F.max("mix_copies").alias("copies"), F.min("mix_copy").alias("low"), F.max("mix_copy").alias("high"), F.count_distinct("mix_copy").alias("distinct")).first()
    assert seen.n == seen.copies == seen.high == seen.distinct and seen.low == 1 and abs(seen.n - (n + 1)) < 6000


def test_mixing_counts_of_null_sources(spark, odd):
    d = odd.select("doc_id", "source")
    want = Counter()
    n, sources = d.count(), Counter(r.source for r in d.collect())
    for r in d.collect():
        import hashlib

        u = int(hashlib.md5(f"7:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:13], 16) / 2**52
        low, cdf = mixing.distribution(n / (len(sources) * sources[r.source]))
        if copies := low + int((cdf <= u).sum()):
            want[r.doc_id, r.source, copies] += copies
    assert Counter((r.doc_id, r.source, r.mix_copies) for r in mixing.drawn(d).collect()) == want
