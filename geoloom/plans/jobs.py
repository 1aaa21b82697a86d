"""Batch jobs over whole provinces: clip, roll, index, documents to norms, reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.functions import geometry as G
from geoloom.functions.quantities import pct1
from geoloom.functions.text import canon_zone
from geoloom.operators import extract as X
from geoloom.operators import gates as GA
from geoloom.operators import joins as J
from geoloom.sources import files as S

CELL = 0.01


def clip(lots: DataFrame, boundaries: DataFrame, roll_keys: DataFrame | None = None, cell: float = CELL) -> DataFrame:
    """lots (slug, lot_id, no_lot, multi) inside their municipality's boundary (slug, multi).

    Each slug's figures decide whether its clip is committed; all slugs are one
    job, so a small town does not wait for a large one.
    """
    placed = lots.withColumn("rp", G.representative_point("multi")).withColumns({"rx": F.get("rp", 0), "ry": F.get("rp", 1)})
    hits = J.pip_join(placed, boundaries.withColumn("c_pos", F.monotonically_increasing_id()).withColumnRenamed("slug", "in_slug"), "lot_id", "rx", "ry", "multi", "in_slug", "c_pos", cell)
    both = placed.join(hits, "lot_id", "left").withColumn("inside", F.coalesce(F.col("in_slug") == F.col("slug"), F.lit(False)))
    if roll_keys is not None:
        both = J.left_lookup(both, roll_keys, F.regexp_replace("no_lot", r"\s+", ""), roll_keys.columns[0], [])
    else:
        both = both.withColumn("matched", F.lit(None).cast("boolean"))
    stats = both.groupBy("slug").agg(pct1(F.count_if("inside"), F.count("*")).alias("retained_pct"), pct1(F.count_if(F.col("inside") & F.col("matched")), F.count_if("inside")).alias("join_after"), F.bool_or(F.col("matched").isNotNull()).alias("has_role"))
    known = boundaries.select("slug").distinct().withColumn("boundary", F.lit(True))
    gated = stats.join(known, "slug", "left").withColumn("commit", GA.clip_gate(F.coalesce("boundary", F.lit(False)), "retained_pct", "join_after", F.coalesce("has_role", F.lit(False))))
    return both.filter("inside").join(gated.filter("commit").select("slug"), "slug", "left_semi").drop("rp", "rx", "ry", "in_slug", "inside", "matched")


def roll_rows(units: DataFrame) -> DataFrame:
    """A row for each lot of a unit; of a lot's units the first with a building area, else the first."""
    from geoloom.operators.aggregates import unit_row

    each = units.withColumn("u_pos", F.monotonically_increasing_id()).select("*", F.explode("lots").alias("lot_key"))
    return unit_row(each, "lot_key", "building_area_m2", "u_pos").drop("u_pos")


def lot_index(lots: DataFrame, zones: DataFrame, roll: DataFrame, source: str, snapshot: str, cell: float = CELL) -> DataFrame:
    """The served index: lots (feature_id, no_lot, multi) with the zone (zone_code, multi, pos) at their point and the roll row of their number."""
    placed = lots.withColumn("rp", G.representative_point("multi")).withColumns({"rx": F.get("rp", 0), "ry": F.get("rp", 1)})
    coded = zones.filter(F.coalesce(F.trim("zone_code"), F.lit("")) != "")
    zone = J.pip_join(placed, coded, "feature_id", "rx", "ry", "multi", "zone_code", "pos", cell).withColumnRenamed("zone_code", "code_zone")
    fields = {"use_code": "role_usage_cubf", "land_cad": "role_valeur_terrain", "building_cad": "role_valeur_batiment", "total_cad": "role_valeur_totale"}
    side = roll.select("lot_key", *[F.col(k).alias(v) for k, v in fields.items()])
    key = F.when(F.col("no_lot").isNotNull(), F.regexp_replace("no_lot", r"\s+", ""))
    joined = J.left_lookup(placed.join(zone, "feature_id", "left"), side, key, "lot_key", list(fields.values()))
    return S.conform(joined.withColumns({"_source": F.lit(source), "_snapshot": F.lit(snapshot)}), S.LOT_INDEX)


def index_manifest(index: DataFrame, slug: str = "slug") -> DataFrame:
    """Figures of each city's index, and of all (slug missing)."""
    got = index.rollup(slug).agg(F.count("*").alias("n_lots"), F.count("code_zone").alias("n_zoned"), F.count("role_valeur_totale").alias("n_rolled"))
    return got.withColumns({"zone_pct": pct1("n_zoned", "n_lots"), "roll_pct": pct1("n_rolled", "n_lots")})


def document_route(pages: DataFrame, key: str, text: str) -> DataFrame:
    """native, ocr or vision for each document, by what its pages hold."""
    t = F.lower(F.col(text))
    rows = F.size(F.filter(F.split(t, "\n"), lambda x: x.rlike("marge|hauteur|superficie|frontage|densit") & x.rlike(r"\d")))
    title = t.rlike(r"grille\s+des?\s+(?:specifications?|spécifications?|normes|usages)")
    got = pages.groupBy(key).agg(F.count("*").alias("n_pages"), F.count_if(title & (rows >= 3)).alias("n_native"), F.count_if(title).alias("n_titled"), F.avg(F.length(F.regexp_replace(F.col(text), r"\s", ""))).alias("density"))
    return got.withColumn("route", F.when(F.col("n_native") > 0, "native").when((F.col("n_titled") > 0) & (F.col("density") >= 100), "ocr").otherwise("vision"))


def zone_norms(pages: DataFrame, key: str, text: str, grid: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Norms of all zones of markdown pages, in long form, and how their codes agree with the grid's (slug, zone_code)."""
    norms = X.markdown_zones(pages, key, text, "m")
    mine = norms.select(F.col(key).alias("slug"), canon_zone("zone_code").alias("code"))
    return norms, J.set_overlap(mine, grid.select("slug", canon_zone("zone_code").alias("code")), "slug", "code")


def norms_table(long: DataFrame, key: str) -> DataFrame:
    """Long norms to one row for each zone, with value, unit and raw text of every field."""
    from geoloom.functions.quantities import FIELDS

    cells = [F.max(F.when(F.col("field") == f, F.col(c))).alias(f"{f}_{c}") for f in FIELDS for c in ("value", "unit", "raw")]
    return long.groupBy(key, "zone_code").agg(*cells)


def reconcile(matrix: DataFrame, products: DataFrame) -> DataFrame:
    """Coverage cells (slug, layer, status, track) after products (slug, layer, track): done where a product is, never the other way."""
    p = products.select("slug", "layer", F.col("track").alias("p_track"), F.lit(True).alias("hit")).dropDuplicates(["slug", "layer"])
    both = matrix.join(p, ["slug", "layer"], "full")
    return both.select("slug", "layer", F.when(F.col("hit"), "done").otherwise(F.col("status")).alias("status"), F.coalesce("p_track", "track").alias("track"), (F.coalesce("hit", F.lit(False)) & ~F.col("status").eqNullSafe(F.lit("done"))).alias("changed"))


def publish(candidates: DataFrame, served: DataFrame) -> DataFrame:
    """Collections (id, attribution, expected, confidence, n_geometries) that may be published: attribution right, confidence high, geometry there, id not served yet."""
    fine = (F.col("attribution") == F.col("expected")) & (F.col("confidence") == "HAUTE") & (F.col("n_geometries") > 0)
    return candidates.filter(fine).join(served.select("id"), "id", "left_anti")
