"""Catalog, recipes, query facade, jobs and streams."""

from __future__ import annotations

import json

import pytest
from compared import DATA
from pyspark.sql import functions as F

from geoloom.plans import api, catalog, jobs
from geoloom.streaming import windows


def raw(**more):
    return {"id": "s", "title": "T", "country": "CA", "kind": "admin", "provider": "P", "licence": "cc-by", "datasets": [{"id": "d", "title": "D", "format": "geojson", "url": "x"}]} | more


def test_manifest_problems():
    assert catalog.problems(raw()) == []
    assert len(catalog.problems(raw(title=" ", kind="?", country="ca"))) == 3 and catalog.problems(raw(datasets=[])) == ["datasets: at least one"]
    assert catalog.parsed(raw()).attribution() == "© P — T"


def test_licence_gate_comes_first(spark):
    shut = catalog.Registry([catalog.parsed(raw(licence="proprietary"))])
    with pytest.raises(catalog.LicenceError):
        catalog.acquire(spark, shut, "s#d")
    catalog.assert_open(catalog.parsed(raw(licence="?", rights="demo-unverified")))


def write_collection(root, name, features):
    (root / f"{name}.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    (root / f"{name}.meta.json").write_text(json.dumps({"datasetId": name, "title": name.title(), "count": len(features)}))


def box(i, **props):
    x, y = i % 5, i // 5
    return {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[x, y], [x + 1, y], [x + 1, y + 1], [x, y + 1], [x, y]]]}, "properties": props}


def test_acquire_and_recipes(spark, tmp_path):
    write_collection(tmp_path, "regions", [box(i, RES_CO_REG=f"0{i}", RES_NM_REG=f"Région {i}") for i in range(3)])
    write_collection(tmp_path, "lots", [box(0, NO_LOT="1 234"), box(1, NO_LOT="1234"), box(2)])
    sets = [{"id": n, "title": n, "format": "geojson", "url": str(tmp_path / f"{n}.geojson"), "recipe": n} for n in ("regions", "lots")]
    reg = catalog.Registry([catalog.parsed(raw(datasets=sets))], catalog.RECIPES)
    rows, prov = catalog.acquire(spark, reg, "s#regions")
    assert [(r.geo_id, r.name, r.iso) for r in rows.orderBy("pos").collect()][1] == ("ca/regions/region/01", "Région 1", "CA-QC") and prov["rights"] == "open"
    lots, _ = catalog.acquire(spark, reg, "s#lots")
    assert sorted((r.pos, r.lot_key) for r in lots.collect()) == [(0, "1234"), (2, "#2")]
    a, b = catalog.meta(rows, prov, "now").first(), catalog.meta(rows.repartition(5), prov, "now").first()
    assert a["count"] == 3 and a["checksum"] == b["checksum"]
    assert reg.inventory(spark).count() == 2 and len(reg.select("ca", "admin", True)) == 1


def test_refresh(spark):
    ledger = spark.createDataFrame([("a", "2026-01-01", "P1M", "x"), ("b", None, "P1M", None), ("c", "2026-02-20", "P1M", "y"), ("d", "2026-01-01", "never", "z")], "manifest_ref string, last_fetched_at string, cadence string, checksum string")
    assert {r.manifest_ref for r in catalog.due(ledger, F.lit("2026-03-01")).collect()} == {"a", "b", "d"}
    after = {r.manifest_ref: r.outcome for r in catalog.refreshed(ledger, spark.createDataFrame([("a", "x"), ("b", "n")], "manifest_ref string, checksum string"), "2026-03-01").collect()}
    assert after == {"a": "unchanged", "b": "updated", "c": "skipped", "d": "skipped"}


def test_unique_ids(spark):
    df = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3), ("x", 4)], "b string, p int")
    assert [r.unique_id for r in catalog.unique_ids(df, "b", "p").orderBy("p").collect()] == ["x", "x-2", "y", "x-3"]


def test_api(spark, tmp_path):
    write_collection(tmp_path, "zones", [box(i, geoId=f"z{i}") for i in range(12)])
    (tmp_path / "broken.meta.json").write_text("{")
    a = api.Api(api.make_provider(spark, str(tmp_path)), "http://h")
    assert a.collections()[1]["collections"][0]["count"] == 12 and a.collection("no")[0] == 404
    status, body = a.items("zones", "0,0,1.5,0.5", "1", "1")
    assert (status, body["numberMatched"], body["numberReturned"], body["features"][0]["id"]) == (200, 2, 1, "z1") and len(body["links"]) == 1
    assert a.items("zones", limit=5)[1]["links"][1]["rel"] == "next"
    assert a.items("zones", "1,2")[0] == 400 and a.item("zones", "z7")[1]["properties"] == {"geoId": "z7"} and a.item("zones", "q")[0] == 404
    assert api.make_provider(spark, str(tmp_path / "none")).collections() == []


RING = lambda x, y, s: f"array(array(array(array({x}D,{y}D),array({x + s}D,{y}D),array({x + s}D,{y + s}D),array({x}D,{y + s}D),array({x}D,{y}D))))"


def test_clip_and_index(spark):
    town = spark.sql(f"SELECT 'a' AS slug, {RING(0.0, 0.0, 1.0)} AS multi")
    lots = spark.sql(" UNION ALL ".join(f"SELECT 'a' AS slug, {i} AS lot_id, '1 {i}' AS no_lot, 'f{i}' AS feature_id, {RING(0.1 * i, 0.1, 0.05)} AS multi" for i in range(12)))
    kept = jobs.clip(lots, town, cell=0.25)
    assert sorted(r.lot_id for r in kept.collect()) == list(range(10))
    zones = spark.sql(f"SELECT 'H-1' AS zone_code, 0 AS pos, {RING(0.0, 0.0, 0.5)} AS multi UNION ALL SELECT ' ', 1, {RING(0.0, 0.0, 2.0)}")
    roll = spark.createDataFrame([("12", "1000", 5, 6, 11)], "lot_key string, use_code string, land_cad long, building_cad long, total_cad long")
    got = {r.feature_id: r for r in jobs.lot_index(lots, zones, roll, "s", "2026", 0.25).collect()}
    assert got["f2"].code_zone == "H-1" and got["f2"].role_valeur_totale == 11 and got["f7"].code_zone is None and got["f7"].role_valeur_totale is None and len(got) == 12
    m = jobs.index_manifest(jobs.lot_index(lots, zones, roll, "s", "2026", 0.25).withColumn("slug", F.lit("a"))).filter("slug IS NULL").first()
    assert (m.n_lots, m.n_rolled) == (12, 1)


def test_norms(spark):
    pages = spark.createDataFrame([("a", "| Norme | H-1 | C-2 |\n|---|---|---|\n| Marge avant min. | 5 | Note 5 |\n| Marge avant min. | 9 | 9 |\n")], "slug string, page string")
    long, overlap = jobs.zone_norms(pages, "slug", "page", spark.createDataFrame([("a", "H01"), ("a", "X-9")], "slug string, zone_code string"))
    rows = {r.zone_code: r for r in jobs.norms_table(long, "slug").collect()}
    assert rows["H-1"].marge_avant_min_value == 5 and rows["C-2"].marge_avant_min_value is None and rows["C-2"].marge_avant_min_raw == "Note 5"
    o = overlap.first()
    assert (o.n_left, o.n_right, o.n_both) == (2, 2, 1)


def test_reconcile_and_publish(spark):
    m = spark.createDataFrame([("a", "z", "candidate", None), ("b", "z", "done", "t")], "slug string, layer string, status string, track string")
    got = {r.slug: (r.status, r.track, r.changed) for r in jobs.reconcile(m, spark.createDataFrame([("a", "z", "w"), ("c", "z", "v")], "slug string, layer string, track string")).collect()}
    assert got == {"a": ("done", "w", True), "b": ("done", "t", False), "c": ("done", "v", True)}
    c = spark.createDataFrame([("x", "p", "p", "HAUTE", 1), ("y", "p", "p", "HAUTE", 1), ("z", "p", "q", "HAUTE", 1)], "id string, attribution string, expected string, confidence string, n_geometries int")
    assert [r.id for r in jobs.publish(c, spark.createDataFrame([("y",)], "id string")).collect()] == ["x"]


def test_streams(spark, tmp_path):
    events = spark.read.parquet(f"{DATA}/events.parquet").select("event_id", "ts", "event_type")
    events.repartition(3).write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "e"))
    q = windows.coverage_stream(stream.select(F.col("event_type").alias("layer"), F.lit("done").alias("status"))).writeStream.outputMode("complete").format("memory").queryName("cov").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("SELECT sum(n) FROM cov").first()[0] == events.count()
    seen = windows.first_seen(stream.withColumn("sha", F.col("event_type")), "ts", "sha", "60 days").writeStream.outputMode("append").format("memory").queryName("seen").start()
    seen.processAllAvailable()
    seen.stop()
    assert spark.sql("SELECT count(*) FROM seen").first()[0] == events.select("event_type").distinct().count()
    recent = windows.recent_signals(stream, "ts", "event_type", "10 days", "5 days").writeStream.outputMode("update").format("memory").queryName("rec").start()
    recent.processAllAvailable()
    recent.stop()
    assert spark.sql("SELECT count(*) FROM rec").first()[0] > 0
