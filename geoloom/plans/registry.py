"""The table of registered queries and their SQL, and the stand-in tables they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            SQL[key] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as points, in hundredths of a degree."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(k.alias("id"), (F.lit(-7900) + (k * 37) % 2000).alias("x"), (F.lit(4500) + (k * 53) % 1700).alias("y"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("value"), F.col("c_mktsegment").alias("segment"))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as rectangles of a grid."""
    n = F.col("n_nationkey")
    box = table(spark, sf_dir, "nation").select(n.alias("pos"), F.col("n_name").alias("code"), (F.lit(-7900) + 400 * (n % 5)).alias("x0"), (F.lit(4500) + 340 * F.floor(n / 5).cast("int")).alias("y0"))
    from geoloom.functions.geometry import box_ring

    sides = box.withColumns({"x1": F.col("x0") + 400, "y1": F.col("y0") + 340})
    return sides.withColumn("multi", F.array(F.array(box_ring("x0", "y0", "x1", "y1"))))


POINTS = "SELECT c_custkey AS id, -7900 + (c_custkey * 37) % 2000 AS x, 4500 + (c_custkey * 53) % 1700 AS y, c_name AS name, c_nationkey AS nation, c_acctbal AS value, c_mktsegment AS segment FROM customer"
ZONES = "SELECT n_nationkey AS pos, n_name AS code, -7900 + 400 * (n_nationkey % 5) AS x0, 4500 + 340 * (n_nationkey // 5) AS y0, -7500 + 400 * (n_nationkey % 5) AS x1, 4840 + 340 * (n_nationkey // 5) AS y1 FROM nation"
FOLD = "lower(strip_accents({}))"
ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
ROUND1 = "floor(({}) * 10 + 0.5) / 10"
