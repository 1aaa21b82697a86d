"""Mixing sources to target weights by Poisson replication.

A source with weight w of W, n of N rows, repeats each row w * N / (W * n) times
on average.  Each row's number of copies is the quantile of the Poisson
distribution with that mean at a uniform number hashed from seed and doc_id; rows
are exploded by it and shuffled globally: dealt by the hash of seed, doc_id and
copy number to partitions, and ordered by it inside.  The hash is MD5, so that
other engines draw the same numbers.

A source's distribution function is listed from twelve standard deviations below
its mean to twelve above (about 24 * sqrt(mean) numbers, all the probability that
a double can tell), so a mean of a million takes 24 000 numbers.  Rows with more
than ``SPLIT`` copies are first dealt out as ranges of copies, so that no task
writes all copies of a row.

The rates (one row for each source) are written to a file, whose size is known
when the join is planned: if it is small enough for Spark's own size check they
are broadcast and no text is moved by its source, else adaptive execution splits
a source with a third of all rows.

Edge cases: a null source is a source of its own, named by a null key in
``weights``; sources without a weight get none and vanish if weights are given;
null ids hash like the empty text; repeated rows draw alike; texts play no
part; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh, written

SEED = 7
#: Copies of a row that one task makes.
SPLIT = 4096


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of the MD5 of the parts, joined by colons."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def distribution(mean: float) -> tuple[int, np.ndarray]:
    """(low, cdf): Poisson probabilities of at most low, low + 1, ... copies; what lies outside is less than a double holds."""
    if not mean > 0:
        return 0, np.ones(1)
    reach = 12 * math.sqrt(mean) + 40
    k = np.arange(max(0, math.floor(mean - reach)), math.ceil(mean + reach) + 1, dtype=np.float64)
    # log k! from the first one by sums of logarithms
    log_factorial = math.lgamma(k[0] + 1) + np.concatenate([[0.0], np.cumsum(np.log(k[1:]))])
    return int(k[0]), np.cumsum(np.exp(k * math.log(mean) - mean - log_factorial))


def _distributions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for r in range(b.num_rows):  # one source at a time: an array may be long
            low, cdf = distribution(b.column("mean")[r].as_py())
            one = b.slice(r, 1)
            yield pa.RecordBatch.from_arrays([*one.columns, pa.array([low], pa.int64()), pa.array([cdf], pa.list_(pa.float64()))], ["mix_source", "mean", "low", "cdf"])


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None) -> DataFrame:
    """mix_source (a null source: empty, others marked), mean, low, cdf (Poisson probabilities of at most low, low + 1, ... copies)."""
    mark = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    counts = docs.groupBy(mark.alias("mix_source")).agg(F.count("*").alias("n"))
    if weights is None:
        weighted = counts.withColumn("w", F.lit(1.0))
    else:
        given = docs.sparkSession.createDataFrame([("" if k is None else "=" + k, float(v)) for k, v in weights.items()], "mix_source string, w double")
        weighted = counts.join(given, "mix_source", "left").na.fill(0.0, ["w"])
    weighted = cut(weighted)
    total = weighted.agg(F.struct(F.sum("n").alias("n"), F.sum("w").alias("w"))).scalar()  # one row: a scalar subquery
    mean = weighted.select("mix_source", F.when(total["w"] > 0, F.col("w") * total["n"] / (total["w"] * F.col("n"))).otherwise(0.0).alias("mean"))
    return written(mean.mapInArrow(_distributions, "mix_source string, mean double, low bigint, cdf array<double>"), "rates")


def drawn(docs: DataFrame, weights: dict[str | None, float] | None = None, seed: int = SEED) -> DataFrame:
    """The rows once for each copy, with ``mix_copies``, ``mix_copy`` (from 1) and ``mix_order`` (the shuffle key) added (other names if taken)."""
    names = {k: fresh(k, docs.columns) for k in ("mix_source", "mix_u", "mix_low", "mix_cdf", "mix_copies", "mix_copy", "mix_order", "mix_from")}
    table = rates(docs, weights)
    at = table.select(F.col("mix_source").alias(names["mix_source"]), F.col("low").alias(names["mix_low"]), F.col("cdf").alias(names["mix_cdf"]))
    mark = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    both = docs.withColumn(names["mix_u"], uniform(F.lit(seed), F.col("doc_id"))).join(at, mark == F.col(names["mix_source"]))
    # copies: the first number at which the distribution function passes u
    copies = (F.col(names["mix_low"]) + F.size(F.filter(names["mix_cdf"], lambda c: c <= F.col(names["mix_u"])))).cast("int")
    counted = both.withColumn(names["mix_copies"], copies).filter(F.col(names["mix_copies"]) > 0).select(*docs.columns, names["mix_copies"])
    n, copy, begin = F.col(names["mix_copies"]), F.col(names["mix_copy"]), F.col(names["mix_from"])

    def exploded(rows: DataFrame, first: Column, last: Column) -> DataFrame:
        return rows.select(*docs.columns, names["mix_copies"], F.explode(F.sequence(first, last)).alias(names["mix_copy"]))

    most = table.agg(F.max("mean")).first()[0]  # one number
    if most is None or most + 12 * math.sqrt(most) + 40 <= SPLIT:
        out = exploded(counted, F.lit(1), n)
    else:
        ranges = counted.filter(n > SPLIT).select("*", F.explode(F.sequence(F.lit(1), n, F.lit(SPLIT))).alias(names["mix_from"]))
        spread = ranges.repartition(F.xxhash64(F.col("doc_id"), begin))
        out = exploded(counted.filter(n <= SPLIT), F.lit(1), n).union(exploded(spread, begin, F.least(n, begin + SPLIT - 1)))
    key = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), copy.cast("string"))
    return out.withColumn(names["mix_order"], F.substring(F.md5(key.cast("binary")), 1, 16))


def mixed(docs: DataFrame, weights: dict[str | None, float] | None = None, seed: int = SEED) -> DataFrame:
    """The copies in a global random order, with the columns that drawn() adds."""
    got = drawn(docs, weights, seed)
    order = got.columns[-1]
    return got.repartition(F.col(order)).sortWithinPartitions(order)


def mixture(docs: DataFrame, weights: dict[str | None, float] | None = None, seed: int = SEED) -> DataFrame:
    """The copies in a global random order; columns as given."""
    return mixed(docs, weights, seed).select(*docs.columns)
