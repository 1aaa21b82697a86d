"""Joins of the lot index and the registries.

Every lookup side is reduced to one row for each key before it is joined, so a
join never multiplies rows; sides are broadcast only where Spark's own size
estimate allows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.functions import geometry as G
from geoloom.functions.quantities import pct1
from geoloom.functions.text import norm_name, split_slug
from geoloom.lineage import cut


def first_wins(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key in the given order; an aggregation with partial results, not a window."""
    place = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    row = F.struct(*df.columns)
    return df.groupBy(F.col(key).alias("fw_key")).agg(F.min_by(row, place).alias("fw_row")).select("fw_row.*")


def first_value(df: DataFrame, key: str, value: str, *order: str) -> DataFrame:
    """key, value: the first non-empty value of each key; keys without one keep a missing value."""
    place = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    fine = F.nullif(F.col(value).cast("string"), F.lit("")).isNotNull()
    return df.groupBy(key).agg(F.min_by(F.when(fine, F.col(value)), F.when(fine, place)).alias(value))


def left_lookup(left: DataFrame, right: DataFrame, left_key: Column, right_key: str, columns: list[str]) -> DataFrame:
    """LEFT join with a table that is unique on its key; unmatched rows get missing values, and ``matched`` tells."""
    side = right.select(F.col(right_key).alias("lk_key"), *columns, F.lit(True).alias("matched"))
    return left.join(side, left_key == F.col("lk_key"), "left").drop("lk_key").withColumn("matched", F.coalesce("matched", F.lit(False)))


def join_stats(joined: DataFrame, *by: str) -> DataFrame:
    """Rows, matched, unmatched and coverage (percent, one decimal) of a left_lookup."""
    hit = F.count_if("matched")
    return joined.groupBy(*by).agg(F.count("*").alias("n_rows"), hit.alias("n_matched"), (F.count("*") - hit).alias("n_unmatched"), pct1(hit, F.count("*")).alias("coverage_pct"))


def pip_join(points: DataFrame, polygons: DataFrame, point_id: str, x: str, y: str, geom: str, code: str, pos: str, cell: float) -> DataFrame:
    """point_id, code: of the polygons that hold a point strictly, the first by position.

    Both sides meet on grid cells by an equi-join (no nested loop): a polygon is
    listed under each cell that its box touches, a point under its own.  The box
    is compared first, the rings after.  Points without a polygon have no row.
    """
    at = lambda c: F.floor(F.col(c) / cell).cast("long")
    boxed = polygons.withColumn("pj_box", G.extent(F.col(geom))).filter("pj_box.minx IS NOT NULL")
    low = lambda k: F.floor(F.col(f"pj_box.{k}") / cell).cast("long")
    listed = boxed.withColumn("pj_cx", F.explode(F.sequence(low("minx"), low("maxx")))).withColumn("pj_cy", F.explode(F.sequence(low("miny"), low("maxy"))))
    listed = listed.select("pj_cx", "pj_cy", "pj_box", F.col(geom).alias("pj_geom"), F.col(code).alias("pj_code"), F.col(pos).alias("pj_pos"))
    placed = points.select(F.col(point_id).alias("pj_id"), F.col(x).alias("pj_x"), F.col(y).alias("pj_y"), at(x).alias("pj_px"), at(y).alias("pj_py"))
    near = placed.join(listed, (F.col("pj_px") == F.col("pj_cx")) & (F.col("pj_py") == F.col("pj_cy")))
    near = near.filter((F.col("pj_x") > F.col("pj_box.minx")) & (F.col("pj_x") < F.col("pj_box.maxx")) & (F.col("pj_y") > F.col("pj_box.miny")) & (F.col("pj_y") < F.col("pj_box.maxy")))
    hits = near.filter(G.inside("pj_geom", "pj_x", "pj_y"))
    return hits.groupBy(F.col("pj_id").alias(point_id)).agg(F.min_by("pj_code", "pj_pos").alias(code))


def pip_semi(points: DataFrame, polygons: DataFrame, point_id: str, x: str, y: str, geom: str, cell: float) -> DataFrame:
    """The points strictly inside any of the polygons."""
    hits = pip_join(points, polygons.withColumn("ps_pos", F.lit(0)), point_id, x, y, geom, "ps_pos", "ps_pos", cell)
    return points.join(hits.select(point_id), point_id, "left_semi")


def single_label(polygons: DataFrame, points: DataFrame, polygon_id: str, label: str, x: str, y: str, geom: str, cell: float, inner: bool = False) -> DataFrame:
    """polygon_id, label: the label if exactly one distinct label lies inside, else missing (or no row if inner)."""
    pts = points.withColumn("sl_id", F.monotonically_increasing_id())
    at = lambda c: F.floor(F.col(c) / cell).cast("long")
    boxed = polygons.withColumn("sl_box", G.extent(F.col(geom)))
    low = lambda k: F.floor(F.col(f"sl_box.{k}") / cell).cast("long")
    listed = boxed.withColumn("sl_cx", F.explode(F.sequence(low("minx"), low("maxx")))).withColumn("sl_cy", F.explode(F.sequence(low("miny"), low("maxy"))))
    placed = pts.select(F.col(label).alias("sl_label"), F.col(x).alias("sl_x"), F.col(y).alias("sl_y"), at(x).alias("sl_px"), at(y).alias("sl_py"))
    hits = listed.join(placed, (F.col("sl_px") == F.col("sl_cx")) & (F.col("sl_py") == F.col("sl_cy"))).filter(G.inside(geom, "sl_x", "sl_y"))
    # two distinct labels are enough to know: smallest and largest, in partial results of fixed size
    own = hits.groupBy(polygon_id).agg(F.min("sl_label").alias("sl_a"), F.max("sl_label").alias("sl_b"))
    one = own.select(polygon_id, F.when(F.col("sl_a") == F.col("sl_b"), F.col("sl_a")).alias(label))
    return one.filter(F.col(label).isNotNull()) if inner else polygons.select(polygon_id).join(one, polygon_id, "left")


def ranked_lookup(left: DataFrame, left_id: str, candidates: list[tuple[str, DataFrame]], payload: list[str]) -> DataFrame:
    """The payload of the first candidate table (each: left_id, payload; unique on left_id) that has the row, and its name in ``method``."""
    out = left
    for i, (_, side) in enumerate(candidates):
        out = out.join(side.select(left_id, F.struct(*payload).alias(f"rl_{i}")), left_id, "left")
    hit = [F.col(f"rl_{i}").isNotNull() for i in range(len(candidates))]
    method, best = F.lit("no-match"), None
    for i in range(len(candidates) - 1, -1, -1):
        method = F.when(hit[i], candidates[i][0]).otherwise(method)
        best = F.col(f"rl_{i}") if best is None else F.coalesce(F.col(f"rl_{i}"), best)
    return out.select(*left.columns, *[best[c].alias(c) for c in payload], method.alias("method"))


def prefix_candidates(left: DataFrame, slug: str) -> DataFrame:
    """Each row with its slug's shorter and shorter beginnings (by double dashes), longest first in ``rank``."""
    parts = split_slug(slug)
    sizes = F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "-"))
    return left.select("*", F.posexplode(F.concat(F.array(norm_name(slug)), sizes)).alias("rank", "prefix"))


def by_prefix(left: DataFrame, left_id: str, slug: str, registry: DataFrame, name_key: str, payload: str) -> DataFrame:
    """left_id, payload: of the registry's entry with the longest beginning of the slug as its name."""
    tried = prefix_candidates(left.select(left_id, slug), slug)
    hits = tried.join(registry.select(F.col(name_key).alias("bp_key"), payload), F.col("prefix") == F.col("bp_key"))
    return hits.groupBy(left_id).agg(F.min_by(payload, "rank").alias(payload))


def closest(left: DataFrame, right: DataFrame, key: str, left_id: str, at: str, to: str, payload: list[str], tie: str) -> DataFrame:
    """left_id, payload: for each left row, of the right row of the same key whose number ``to`` is nearest to its ``at`` (ties: smaller ``tie``).

    Both sides are sorted together by key and number and dealt to tasks as ranges, however many rows a key or a number has.
    The nearest right rows are the last one at or before it and the first one after, in the row's own range or, by the
    ends of the ranges (one row for each range and key), in another.  Rows without a key or a number, and those whose key has
    no right row, get none.
    """
    number = lambda c: F.col(c).cast("double").alias("cl_at")
    asked = left.select(F.col(key).alias("cl_key"), number(at), F.col(left_id).alias("cl_id"))
    spots = right.select(F.col(key).alias("cl_key"), number(to), F.struct(F.col(to).cast("double").alias("at"), F.col(tie).alias("tie"), F.struct(*payload).alias("row")).alias("cl_spot"))
    firsts = spots.groupBy("cl_key", "cl_at").agg(F.min_by("cl_spot", "cl_spot.tie").alias("cl_spot"))
    both = asked.unionByName(firsts, allowMissingColumns=True).filter("cl_key IS NOT NULL AND cl_at IS NOT NULL")
    # the ranges are drawn from a sample: read twice, they must be the same
    dealt = cut(both.repartitionByRange("cl_key", "cl_at", "cl_id").withColumn("cl_part", F.spark_partition_id()))

    def last(what: str, by: list[str], *order: Column, to: int = Window.currentRow) -> Column:
        return F.last(what, ignorenulls=True).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, to))

    spot_at = F.col("cl_spot.at")
    ends = dealt.groupBy("cl_key", "cl_part").agg(F.min_by("cl_spot", spot_at).alias("low"), F.max_by("cl_spot", spot_at).alias("high"))
    ends = ends.withColumns({"cl_c": last("high", ["cl_key"], F.col("cl_part"), to=-1), "cl_d": last("low", ["cl_key"], F.desc("cl_part"), to=-1)}).drop("low", "high")
    own = ["cl_part", "cl_key"]
    near = dealt.withColumns({"cl_a": last("cl_spot", own, F.col("cl_at"), F.col("cl_spot").isNull()), "cl_b": last("cl_spot", own, F.desc("cl_at"))}).filter("cl_spot IS NULL")
    spots = F.filter(F.array("cl_a", "cl_b", "cl_c", "cl_d"), lambda s: s.isNotNull())
    best = F.array_min(F.transform(spots, lambda s: F.struct(F.abs(F.col("cl_at") - s["at"]).alias("d"), s["tie"].alias("tie"), s["row"].alias("row"))))
    return near.join(ends, own).select(F.col("cl_id").alias(left_id), best["row"].alias("c")).filter("c IS NOT NULL").select(left_id, "c.*")


def set_overlap(left: DataFrame, right: DataFrame, by: str, code: str) -> DataFrame:
    """Sizes of two code sets for each group, their overlap, and both shares of it. One pass over both sets."""
    sides = left.select(by, code, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select(by, code, F.lit(0).alias("l"), F.lit(1).alias("r")))
    codes = sides.groupBy(by, code).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    a, b, ab = F.sum("l"), F.sum("r"), F.sum(F.col("l") * F.col("r"))
    share = lambda n: F.when(n > 0, ab / n).otherwise(0.0)
    return codes.groupBy(by).agg(a.alias("n_left"), b.alias("n_right"), ab.alias("n_both"), share(a).alias("share_left"), share(b).alias("share_right"))


def merge_absent(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """All old rows, and those new ones whose key is absent."""
    return old.unionByName(new.join(old.select(key), key, "left_anti"))


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows replace old ones of the same key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def in_scope(rows: DataFrame, names: DataFrame, name: str, prefix: str) -> DataFrame:
    """Rows whose name begins with any of the given prefixes, each as often as it is there.

    Each row lists the beginnings of its name, up to the longest prefix, and meets the prefixes by an equi-join, not by a
    comparison of every pair.
    """
    keys = names.select(F.col(prefix).alias("is_key")).distinct()
    longest = keys.agg(F.coalesce(F.max(F.length("is_key")), F.lit(0))).scalar()  # one row: a scalar subquery
    # equal rows are told apart by their number
    boxed = rows.filter(F.col(name).isNotNull()).select(F.struct(*rows.columns).alias("is_row"), F.monotonically_increasing_id().alias("is_number"), F.col(name).alias("is_name"))
    sizes = boxed.select("*", F.explode(F.sequence(F.lit(0), F.least(F.length("is_name"), longest))).alias("is_size"))
    tried = sizes.select("is_row", "is_number", F.col("is_name").substr(F.lit(1), F.col("is_size")).alias("is_prefix"))
    hits = tried.join(keys, F.col("is_prefix") == F.col("is_key"), "left_semi").groupBy("is_number").agg(F.first("is_row").alias("is_row"))
    return hits.select("is_row.*")


def numbered(df: DataFrame, name: str, *order: str, by: list[str] | None = None) -> DataFrame:
    """Positions from 0 within a group."""
    w = Window.partitionBy(*(by or [])).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w) - 1)

