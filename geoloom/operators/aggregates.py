"""Aggregates: extents, coverage roll-ups, best rows, map classes and densities."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions.quantities import pct1


def extent_of(df: DataFrame, *by: str, minx="minx", miny="miny", maxx="maxx", maxy="maxy") -> DataFrame:
    """Count and box of each group; rows without a box only count."""
    return df.groupBy(*by).agg(F.count("*").alias("n_features"), F.min(minx).alias("minx"), F.min(miny).alias("miny"), F.max(maxx).alias("maxx"), F.max(maxy).alias("maxy"))


STATUSES = ("done", "candidate", "absent")


def coverage_rollup(cells: DataFrame, total: int | Column) -> DataFrame:
    """Counts of each status by layer, and the share done, of cells (layer, status)."""
    counts = [F.count_if(F.col("status") == s).alias(f"n_{s}") for s in STATUSES]
    whole = F.lit(total) if isinstance(total, int) else total
    return cells.groupBy("layer").agg(*counts).withColumn("pct_done", pct1("n_done", whole))


def track_counts(cells: DataFrame) -> DataFrame:
    """Done cells by layer and track ((?) where it is not told), planned ones by leading track ((none) where there is none)."""
    done = cells.filter("status = 'done'").groupBy("layer", F.coalesce("track", F.lit("(?)")).alias("track")).agg(F.count("*").alias("n")).withColumn("kind", F.lit("done"))
    plan = cells.filter("status = 'candidate'").groupBy("layer", F.coalesce(F.get("tracks", 0), F.lit("(none)")).alias("track")).agg(F.count("*").alias("n")).withColumn("kind", F.lit("plan"))
    return done.unionByName(plan)


def published_count(*fields: str) -> Column:
    return sum((F.col(c).isNotNull().cast("int") for c in fields), F.lit(0))


def published_pct(df: DataFrame, fields: list[str], *by: str) -> DataFrame:
    """Percent of cells that hold a value, over all fields and rows of a group."""
    held = F.sum(published_count(*fields))
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"), held.alias("n_published"), pct1(held, F.count("*") * len(fields)).alias("published_pct"))


def best_row(df: DataFrame, key: Column, fields: list[str], *order: str) -> DataFrame:
    """Of each key, the row with the most values; the earlier one of equals."""
    rank = F.struct((-published_count(*fields)).alias("n"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    return df.groupBy(key.alias("best_key")).agg(F.min_by(F.struct(*df.columns), rank).alias("r")).select("best_key", "r.*")


def unit_row(df: DataFrame, key: str, area: str, *order: str) -> DataFrame:
    """The first row of each key, or the first with an area if the first has none."""
    rank = F.struct(F.col(area).isNull().alias("none"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    return df.groupBy(F.col(key).alias("unit_key")).agg(F.min_by(F.struct(*df.columns), rank).alias("r")).select("r.*")


def numeric(c: str) -> Column:
    """Finite numbers only; blank text is missing."""
    x = F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def quantile_edges(df: DataFrame, value: str, classes: int) -> DataFrame:
    """edges: quantile borders by linear interpolation, repeated ones once; missing where all values are equal."""
    shares = [i / classes for i in range(classes + 1)]
    got = df.agg(F.percentile(numeric(value), F.array(*map(F.lit, shares))).alias("e"))
    edges = F.array_distinct(F.col("e"))
    return got.select(F.when(F.size(edges) > 1, edges).alias("edges"))


def equal_edges(df: DataFrame, value: str, classes: int) -> DataFrame:
    """edges: borders of classes of equal width."""
    got = df.agg(F.min(numeric(value)).alias("lo"), F.max(numeric(value)).alias("hi"))
    edges = F.transform(F.sequence(F.lit(0), F.lit(classes)), lambda i: F.when(i == classes, F.col("hi")).otherwise(F.col("lo") + (F.col("hi") - F.col("lo")) * i / classes))
    return got.select(F.when(F.col("hi") > F.col("lo"), F.array_distinct(edges)).alias("edges"))


def classes_of(edges: DataFrame, ramp: int) -> DataFrame:
    """bin, low, high, colour: half-open classes (the last one closed) with colours spread over a ramp."""
    n = F.size("edges") - 1
    rows = edges.filter("edges IS NOT NULL").select("edges", n.alias("n"), F.explode(F.sequence(F.lit(0), n - 1)).alias("bin"))
    colour = F.when(F.col("n") > 1, F.floor(F.col("bin") * (ramp - 1) / (F.col("n") - 1) + 0.5)).otherwise(0).cast("int")
    return rows.select("bin", F.get("edges", F.col("bin")).alias("low"), F.get("edges", F.col("bin") + 1).alias("high"), colour.alias("colour"))


#: Named aggregations of map models.
AGGREGATIONS = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count}


def by_region(df: DataFrame, region: str, value: str, how: str = "sum") -> DataFrame:
    return df.groupBy(region).agg(AGGREGATIONS[how](numeric(value)).alias(value))


def grid_density(points: DataFrame, x: str, y: str, value: str, cell: float) -> DataFrame:
    """Square cells: count, summed value, density, centre."""
    gx, gy = F.floor(F.col(x) / cell).cast("long"), F.floor(F.col(y) / cell).cast("long")
    got = points.groupBy(gx.alias("gx"), gy.alias("gy")).agg(F.count("*").alias("n"), F.sum(value).alias("value"))
    return got.select("gx", "gy", "n", "value", (F.col("n") / (cell * cell)).alias("density"), ((F.col("gx") + 0.5) * cell).alias("cx"), ((F.col("gy") + 0.5) * cell).alias("cy"))


def hex_bins(points: DataFrame, x: str, y: str, value: str, size: float) -> DataFrame:
    """Pointy-top hexagons in axial coordinates: each point goes to the nearest centre by cube rounding."""
    q = (F.col(x) * (math.sqrt(3) / 3) - F.col(y) / 3) / size
    r = F.col(y) * (2 / 3) / size
    placed = points.select(value, q.alias("fq"), r.alias("fr")).select(value, "fq", "fr", (-F.col("fq") - F.col("fr")).alias("fs"))
    near = {k: F.floor(F.col(f"f{k}") + 0.5) for k in "qrs"}
    off = {k: F.abs(near[k] - F.col(f"f{k}")) for k in "qrs"}
    q_worst = (off["q"] > off["r"]) & (off["q"] > off["s"])
    hq = F.when(q_worst, -near["r"] - near["s"]).otherwise(near["q"])
    hr = F.when(~q_worst & (off["r"] > off["s"]), -near["q"] - near["s"]).otherwise(near["r"])
    return placed.groupBy(hq.cast("long").alias("q"), hr.cast("long").alias("r")).agg(F.count("*").alias("n"), F.sum(value).alias("value"))


def clusters(points: DataFrame, x: str, y: str, value: str, radius: float) -> DataFrame:
    """Groups of points that share a square of twice the radius: count, value, centroid. A point is in one group only."""
    gx, gy = (F.floor(F.col(c) / (2 * radius)).cast("long") for c in (x, y))
    return points.groupBy(gx.alias("gx"), gy.alias("gy")).agg(F.count("*").alias("n"), F.sum(value).alias("value"), F.avg(x).alias("cx"), F.avg(y).alias("cy"))


def dominant(df: DataFrame, key: str, least: int, share: float) -> DataFrame:
    """The rows of the one key that has at least ``least`` rows and that share of all rows; all rows where none has."""
    total = df.agg(F.count("*")).scalar()
    n = df.groupBy(key).agg(F.count("*").alias("n")).select("*", total.alias("t"))
    best = n.filter((F.col("n") >= least) & (F.col("n") >= share * F.col("t"))).agg(F.min(key)).scalar()  # one value, missing where none has
    return df.filter(best.isNull() | (F.col(key) == best))
