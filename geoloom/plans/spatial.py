"""Feature queries, spatial joins, and map aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions import geometry as G
from geoloom.functions.quantities import pct1, round_half_up
from geoloom.operators import aggregates as A
from geoloom.operators import features as FE
from geoloom.operators import joins as J

from .registry import ORDER, POINTS, ROUND1, ZONES, points, query, table, zones

BBOX = (-7700, 4700, -6800, 5600)
CELL = 100.0


def _boxed(spark, sf_dir):
    p = points(spark, sf_dir)
    return p.withColumns({"minx": F.col("x"), "miny": F.col("y"), "maxx": F.col("x"), "maxy": F.col("y")})


INSIDE = "x BETWEEN -7700 AND -6800 AND y BETWEEN 4700 AND 5600"


@query(f"WITH p AS ({POINTS}) SELECT id, x, y, name FROM p WHERE {INSIDE} ORDER BY id LIMIT 50 OFFSET 20")
def items_bbox_page(spark, sf_dir):
    return FE.page(_boxed(spark, sf_dir), "id", BBOX, 50, 20).select("id", "x", "y", "name")


@query(f"WITH p AS ({POINTS}) SELECT count(*) AS number_matched FROM p WHERE {INSIDE}")
def items_number_matched(spark, sf_dir):
    return FE.number_matched(_boxed(spark, sf_dir), BBOX)


@query(f"WITH p AS ({POINTS}) SELECT nation, count(*) AS n_features, min(x) AS minx, min(y) AS miny, max(x) AS maxx, max(y) AS maxy FROM p GROUP BY nation")
def collection_extent(spark, sf_dir):
    return A.extent_of(_boxed(spark, sf_dir), "nation")


@query(f"WITH p AS ({POINTS}) SELECT (min(x) + max(x)) / 2.0::DOUBLE AS cx, (min(y) + max(y)) / 2.0::DOUBLE AS cy, avg(x) AS mean_x, avg(y) AS mean_y FROM p")
def extent_centre(spark, sf_dir):
    p = points(spark, sf_dir)
    return p.agg(((F.min("x") + F.max("x")) / 2).alias("cx"), ((F.min("y") + F.max("y")) / 2).alias("cy"), F.avg("x").alias("mean_x"), F.avg("y").alias("mean_y"))


@query("SELECT o_orderkey, o_custkey, coalesce(nullif(o_orderpriority, '1-URGENT'), o_orderstatus, o_orderkey::VARCHAR) AS feature_key FROM orders")
def item_lookup(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    key = F.coalesce(F.nullif("o_orderpriority", F.lit("1-URGENT")), "o_orderstatus", F.col("o_orderkey").cast("string"))
    return o.select("o_orderkey", "o_custkey", key.alias("feature_key"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey = 77")
def item_by_id(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return FE.item(o, F.col("o_orderkey").cast("string"), "77", "o_orderkey").select("o_orderkey", "o_custkey", "o_orderstatus")


@query("SELECT c_custkey, c_name FROM customer WHERE contains(lower(strip_accents(c_name)), '00012') ORDER BY c_custkey LIMIT 8")
def fold_search_topk(spark, sf_dir):
    return FE.search(table(spark, sf_dir, "customer"), ["c_name"], " 00012", "c_custkey", 8).select("c_custkey", "c_name")


PIP = f"WITH p AS ({POINTS}), z AS ({ZONES}), hit AS (SELECT p.id, arg_min(z.code, z.pos) AS code_zone FROM p JOIN z ON p.x > z.x0 AND p.x < z.x1 AND p.y > z.y0 AND p.y < z.y1 GROUP BY p.id)"


@query(PIP + " SELECT p.id, code_zone FROM p LEFT JOIN hit USING (id)")
def pip_code_zone(spark, sf_dir):
    p = points(spark, sf_dir)
    hits = J.pip_join(p, zones(spark, sf_dir), "id", "x", "y", "multi", "code", "pos", CELL).withColumnRenamed("code", "code_zone")
    return p.select("id").join(hits, "id", "left")


@query(f"WITH p AS ({POINTS}), z AS ({ZONES}) SELECT p.id, p.x, p.y FROM p JOIN z ON z.pos = 7 AND p.x > z.x0 AND p.x < z.x1 AND p.y > z.y0 AND p.y < z.y1")
def clip_semi_join(spark, sf_dir):
    return J.pip_semi(points(spark, sf_dir), zones(spark, sf_dir).filter("pos = 7"), "id", "x", "y", "multi", CELL).select("id", "x", "y")


@query(f"""WITH p AS ({POINTS}), z AS ({ZONES}), k AS (SELECT z.pos, p.segment, p.id, p.value FROM p JOIN z ON p.x > z.x0 AND p.x < z.x1 AND p.y > z.y0 AND p.y < z.y1)
SELECT pos, count(*) AS n_kept, count(*) FILTER (id % 3 <> 0) AS n_joined, {ROUND1.format("100.0::DOUBLE * count(*) FILTER (id % 3 <> 0) / count(*)")} AS join_pct FROM k GROUP BY pos""")
def clip_set_stats(spark, sf_dir):
    hits = J.pip_join(points(spark, sf_dir), zones(spark, sf_dir), "id", "x", "y", "multi", "pos", "pos", CELL)
    return hits.groupBy("pos").agg(F.count("*").alias("n_kept"), F.count_if(F.col("id") % 3 != 0).alias("n_joined"), pct1(F.count_if(F.col("id") % 3 != 0), F.count("*")).alias("join_pct"))


# every second column of zones holds points of one label only
LABELS = f"WITH p AS ({POINTS}), l AS (SELECT x, y, CASE WHEN ((x + 7900) // 400) % 2 = 0 THEN 'plain' ELSE segment END AS label FROM p), z AS ({ZONES}), hit AS (SELECT z.pos, min(l.label) AS a, max(l.label) AS b FROM z JOIN l ON l.x > z.x0 AND l.x < z.x1 AND l.y > z.y0 AND l.y < z.y1 GROUP BY z.pos)"


def _labelled(spark, sf_dir):
    return points(spark, sf_dir).withColumn("label", F.when(F.floor((F.col("x") + 7900) / 400) % 2 == 0, "plain").otherwise(F.col("segment")))


@query(LABELS + " SELECT z.pos, CASE WHEN a = b THEN a END AS label FROM z LEFT JOIN hit USING (pos)")
def single_label_or_null(spark, sf_dir):
    return J.single_label(zones(spark, sf_dir), _labelled(spark, sf_dir), "pos", "label", "x", "y", "multi", CELL)


@query(LABELS + " SELECT pos, a AS label FROM hit WHERE a = b")
def single_label_inner(spark, sf_dir):
    return J.single_label(zones(spark, sf_dir), _labelled(spark, sf_dir), "pos", "label", "x", "y", "multi", CELL, inner=True)


@query(PIP + """, role AS (SELECT o_custkey, arg_min(o_totalprice, o_orderkey) AS role_value, arg_min(o_orderpriority, o_orderkey) AS role_use FROM orders WHERE o_custkey % 7 <> 0 GROUP BY o_custkey)
SELECT p.id::VARCHAR AS feature_id, 'C' || p.id AS no_lot, hit.code_zone, role.role_use AS role_usage_cubf, role.role_value AS role_valeur_totale, role.o_custkey IS NOT NULL AS matched FROM p LEFT JOIN hit USING (id) LEFT JOIN role ON role.o_custkey = p.id""")
def lot_index(spark, sf_dir):
    """Flagship: lots with their zone by position and their roll row by key."""
    p = points(spark, sf_dir)
    zone = J.pip_join(p, zones(spark, sf_dir), "id", "x", "y", "multi", "code", "pos", CELL)
    roll = J.first_wins(table(spark, sf_dir, "orders").filter("o_custkey % 7 <> 0").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority"), "o_custkey", "o_orderkey")
    roll = roll.select("o_custkey", F.col("o_totalprice").alias("role_valeur_totale"), F.col("o_orderpriority").alias("role_usage_cubf"))
    lots = p.select("id").join(zone, "id", "left")
    out = J.left_lookup(lots, roll, F.col("id"), "o_custkey", ["role_valeur_totale", "role_usage_cubf"])
    return out.select(F.col("id").cast("string").alias("feature_id"), F.concat(F.lit("C"), "id").alias("no_lot"), F.col("code").alias("code_zone"), "role_usage_cubf", "role_valeur_totale", "matched")


@query(PIP + f""", f AS (SELECT p.id, hit.code_zone, p.id % 7 <> 0 AS rolled FROM p LEFT JOIN hit USING (id))
SELECT count(*) AS n_lots, count(code_zone) AS n_zoned, count(*) FILTER (rolled) AS n_rolled, {ROUND1.format("100.0::DOUBLE * count(code_zone) / count(*)")} AS zone_pct FROM f""")
def lot_index_stats(spark, sf_dir):
    p = points(spark, sf_dir)
    zone = J.pip_join(p, zones(spark, sf_dir), "id", "x", "y", "multi", "code", "pos", CELL)
    lots = p.select("id").join(zone, "id", "left")
    return lots.agg(F.count("*").alias("n_lots"), F.count("code").alias("n_zoned"), F.count_if(F.col("id") % 7 != 0).alias("n_rolled"), pct1(F.count("code"), F.count("*")).alias("zone_pct"))


@query(f"WITH z AS ({ZONES}) SELECT pos, ((x1 - x0) * (y1 - y0))::DOUBLE AS area, (2 * (x1 - x0 + y1 - y0))::DOUBLE AS perimeter, x0::DOUBLE AS minx, y1::DOUBLE AS maxy FROM z")
def polygon_measures(spark, sf_dir):
    z = zones(spark, sf_dir)
    return z.select("pos", G.area("multi").alias("area"), G.perimeter("multi").alias("perimeter"), G.extent("multi")["minx"].alias("minx"), G.extent("multi")["maxy"].alias("maxy"))


@query(f"WITH z AS ({ZONES}) SELECT pos, (x0 + x1) / 2.0::DOUBLE AS px, (y0 + y1) / 2.0::DOUBLE AS py FROM z")
def representative_point(spark, sf_dir):
    z = zones(spark, sf_dir).withColumn("p", G.representative_point("multi"))
    return z.select("pos", F.get("p", 0).alias("px"), F.get("p", 1).alias("py"))


@query(f"WITH z AS ({ZONES}) SELECT pos, CASE WHEN m < -82.5 THEN 32617 WHEN m < -79.5 THEN 32190 WHEN m < -76.5 THEN 32189 WHEN m < -73.5 THEN 32188 WHEN m < -70.5 THEN 32187 ELSE 32619 END AS epsg FROM (SELECT pos, (x0 + x1) / 200.0::DOUBLE AS m FROM z)")
def choose_epsg(spark, sf_dir):
    return zones(spark, sf_dir).select("pos", G.choose_epsg((F.col("x0") + F.col("x1")) / 200).alias("epsg"))


@query()
def lot_attrs(spark, sf_dir):
    """Measures of every customer's lot, a square of a thousandth of a degree, in its projection."""
    p = points(spark, sf_dir).select("id", (F.col("x") / 100).alias("lon"), (F.col("y") / 100).alias("lat"))
    ring = G.box_ring(F.col("lon"), F.col("lat"), F.col("lon") + 0.001, F.col("lat") + 0.001)
    lots = p.select("id", F.array(F.array(ring)).alias("multi"), G.choose_epsg("lon").alias("epsg"))
    return lots.withColumn("m", G.lot_measures("multi", "epsg")).select("id", "epsg", *[round_half_up(F.col(f"m.{c}"), 2).alias(c) for c in ("area_m2", "perimeter_m", "frontage_m", "depth_m")])


@query(f"""WITH p AS ({POINTS}), z AS ({ZONES}), d AS (SELECT p.id, z.pos, radians((z.y0 + z.y1) / 200.0::DOUBLE) AS la, radians(p.y / 100.0::DOUBLE) AS lb, radians((p.x / 100.0::DOUBLE) - (z.x0 + z.x1) / 200.0::DOUBLE) AS dl FROM p JOIN z ON p.nation = z.pos),
k AS (SELECT id, pos, 2 * 6371.0 * asin(least(1.0, sqrt(pow(sin((lb - la) / 2), 2) + cos(la) * cos(lb) * pow(sin(dl / 2), 2)))) AS km FROM d)
SELECT id, pos, floor(km * 1000 + 0.5) / 1000 AS km, km <= 250 AS near FROM k""")
def haversine_gate(spark, sf_dir):
    p, z = points(spark, sf_dir), zones(spark, sf_dir)
    both = p.join(z.select("pos", ((F.col("x0") + F.col("x1")) / 200).alias("zx"), ((F.col("y0") + F.col("y1")) / 200).alias("zy")), F.col("nation") == F.col("pos"))
    km = G.haversine_km("zx", "zy", F.col("x") / 100, F.col("y") / 100)
    return both.select("id", "pos", round_half_up(km, 3).alias("km"), (km <= 250).alias("near"))


@query(f"WITH z AS ({ZONES}), q AS (SELECT pos, x0, y0, x1, y1, unnest([0, 1]) AS qx FROM z), r AS (SELECT *, unnest([0, 1]) AS qy FROM q) SELECT pos, (CASE WHEN qx = 0 THEN x0 ELSE (x0 + x1) / 2.0 END)::DOUBLE AS w, (CASE WHEN qy = 0 THEN y0 ELSE (y0 + y1) / 2.0 END)::DOUBLE AS s, (CASE WHEN qx = 0 THEN (x0 + x1) / 2.0 ELSE x1 END)::DOUBLE AS e, (CASE WHEN qy = 0 THEN (y0 + y1) / 2.0 ELSE y1 END)::DOUBLE AS n FROM r")
def quadrant_split(spark, sf_dir):
    z = zones(spark, sf_dir).select("pos", *[F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")])
    return z.select("pos", F.explode(G.quadrants("x0", "y0", "x1", "y1")).alias("q")).select("pos", "q.*")


@query(f"WITH p AS ({POINTS}) SELECT id, floor((y / 100.0::DOUBLE - 10 / 111.32) * 1e6 + 0.5) / 1e6 AS s, floor((x / 100.0::DOUBLE - 10 / 111.32 / cos(radians(y / 100.0::DOUBLE))) * 1e6 + 0.5) / 1e6 AS w FROM p")
def city_box(spark, sf_dir):
    b = G.city_box(F.col("y") / 100, F.col("x") / 100, F.lit(10.0))
    return points(spark, sf_dir).select("id", round_half_up(b["s"], 6).alias("s"), round_half_up(b["w"], 6).alias("w"))


def _classes(edges: str) -> str:
    return f"""WITH e AS ({edges}), n AS (SELECT edges, len(edges) - 1 AS n FROM e WHERE len(edges) > 1), b AS (SELECT edges, n, unnest(range(0, n)) AS bin FROM n)
SELECT bin::INT AS bin, edges[bin + 1] AS low, edges[bin + 2] AS high, (CASE WHEN n > 1 THEN floor(bin * 6.0 / (n - 1) + 0.5) ELSE 0 END)::INT AS colour FROM b"""


DISTINCT_SORTED = "list_sort(list_distinct({}))"


@query(_classes("SELECT list_sort(list_distinct(quantile_cont(s_acctbal, [0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS edges FROM supplier"))
def choropleth_quantile(spark, sf_dir):
    return A.classes_of(A.quantile_edges(table(spark, sf_dir, "supplier"), "s_acctbal", 5), 7)


@query(_classes("SELECT list_sort(list_distinct([CASE WHEN i = 5 THEN hi ELSE lo + (hi - lo) * i / 5 END FOR i IN range(0, 6)])) AS edges FROM (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer)"))
def choropleth_equal(spark, sf_dir):
    return A.classes_of(A.equal_edges(table(spark, sf_dir, "customer"), "c_acctbal", 5), 7)


@query(_classes("SELECT list_sort(list_distinct(quantile_cont(v, [0, 0.25, 0.5, 0.75, 1.0]))) AS edges FROM (SELECT c_nationkey, sum(c_acctbal::DECIMAL(18, 2))::DOUBLE AS v FROM customer GROUP BY 1)").replace("high, (", "high, ("))
def choropleth_by_region(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)"))
    per = c.groupBy("c_nationkey").agg(F.sum("c_acctbal").cast("double").alias("v"))
    return A.classes_of(A.quantile_edges(per, "v", 4), 7)


@query(f"WITH p AS ({POINTS}) SELECT (x // 100)::BIGINT - (CASE WHEN x % 100 < 0 THEN 1 ELSE 0 END) AS gx, (y // 100)::BIGINT AS gy, count(*) AS n, sum(nation)::BIGINT AS value, count(*) / 10000.0::DOUBLE AS density FROM p GROUP BY ALL".replace("(x // 100)::BIGINT - (CASE WHEN x % 100 < 0 THEN 1 ELSE 0 END)", "floor(x / 100.0)::BIGINT"))
def grid_density(spark, sf_dir):
    return A.grid_density(points(spark, sf_dir), "x", "y", "nation", 100.0).select("gx", "gy", "n", "value", "density")


HEX = f"""WITH p AS ({POINTS}), a AS (SELECT nation, (x * (sqrt(3.0::DOUBLE) / 3) - y / 3.0::DOUBLE) / 75.0 AS fq, y * (2.0::DOUBLE / 3) / 75.0 AS fr FROM p),
b AS (SELECT *, -fq - fr AS fs FROM a), c AS (SELECT *, floor(fq + 0.5) AS nq, floor(fr + 0.5) AS nr, floor(fs + 0.5) AS ns FROM b),
d AS (SELECT *, abs(nq - fq) AS dq, abs(nr - fr) AS dr, abs(ns - fs) AS ds FROM c)
SELECT (CASE WHEN dq > dr AND dq > ds THEN -nr - ns ELSE nq END)::BIGINT AS q, (CASE WHEN NOT (dq > dr AND dq > ds) AND dr > ds THEN -nq - ns ELSE nr END)::BIGINT AS r, count(*) AS n, sum(nation)::BIGINT AS value FROM d GROUP BY ALL"""


@query(HEX)
def hexbin(spark, sf_dir):
    return A.hex_bins(points(spark, sf_dir), "x", "y", "nation", 75.0)


@query(f"WITH p AS ({POINTS}) SELECT floor(x / 160.0)::BIGINT AS gx, floor(y / 160.0)::BIGINT AS gy, count(*) AS n, sum(nation)::BIGINT AS value, avg(x) AS cx, avg(y) AS cy FROM p GROUP BY ALL")
def cluster_grid(spark, sf_dir):
    return A.clusters(points(spark, sf_dir), "x", "y", "nation", 80.0)


@query(f"""WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY {', '.join(ORDER)}) AS rn FROM lineitem), role AS (SELECT * FROM l WHERE rn = 1 AND l_partkey % 5 <> 0)
SELECT p_partkey, p_name, l_quantity AS role_quantity, l_extendedprice AS role_price, l_orderkey IS NOT NULL AS matched FROM part LEFT JOIN role ON l_partkey = p_partkey""")
def role_left_join_first_wins(spark, sf_dir):
    roll = J.first_wins(table(spark, sf_dir, "lineitem").filter("l_partkey % 5 <> 0").select(*ORDER, "l_quantity", "l_extendedprice"), "l_partkey", *ORDER)
    roll = roll.select("l_partkey", F.col("l_quantity").alias("role_quantity"), F.col("l_extendedprice").alias("role_price"))
    return J.left_lookup(table(spark, sf_dir, "part").select("p_partkey", "p_name"), roll, F.col("p_partkey"), "l_partkey", ["role_quantity", "role_price"])


def entry(spark: SparkSession) -> DataFrame:
    return items_bbox_page(spark, "/root/testdata/sf0.001")
