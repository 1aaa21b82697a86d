"""Layout grids, portals and signals."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from geoloom.operators import layout, signals
from geoloom.sources import portals

PHRASES = ["de chambres", "de bâtiments", "lot (m)", "min. lot (m)", "min. lot (m²)", "sol max.", "max. étage", "avant min.", "latérale min.", "marges", "arrière min.", "libre min."]
START = [18 * k + 14 for k in range(12)]


def line(parts: dict[int, str], lead: str = "") -> str:
    out = list(lead.ljust(260))
    for at, text in parts.items():
        out[at : at + len(text)] = text
    return "".join(out).rstrip()


def page(rows, shift=0):
    head = line({s: p for s, p in zip(START, PHRASES)})
    body = [" " * shift + head, *(" " * shift + line({START[k] + len(PHRASES[k]) // 2 - len(v) // 2: v for k, v in r[1].items()}, f"  {r[0]}") for r in rows)]
    return "GRILLE DES USAGES ET DES NORMES   No zone H0001\nUsage  Lotissement  Largeur  Superficie  Hauteur  Marge  Implantation\n" + "\n".join(body)


def read(text):
    why, zone, zones = layout.parse_page(text)
    return why, zone, {z: {c[0]: c[1:] for c in own} for z, own in zones}


def test_layout_grid():
    why, zone, z = read(page([("H-1", {2: "15", 4: "415", 5: "35", 7: "6"}), ("H-3", {2: "Note 5", 4: "Note 6", 5: "40"}), ("C-306", {6: "99", 8: "voir"})], shift=9))
    assert why is None and zone == "H0001"
    assert (z["H-1"]["frontage_min"][0], z["H-1"]["superficie_min"][0], z["H-1"]["densite"][0], z["H-1"]["marge_avant_min"][0]) == (15, 415, 35, 6)
    assert z["H-1"]["hauteur_max_etage"][4] == "absent" and z["H-3"]["frontage_min"][:2] == (None, "Note 5") and z["H-3"]["densite"][0] == 40
    assert z["C-306"]["hauteur_max_etage"][4] == "a-verifier" and z["C-306"]["marge_laterale_min"][4] == "a-verifier"


def test_layout_refuses():
    text = page([("H-1", {2: "15"})])
    assert read(text.replace("libre min.", "          "))[0] == "columns missing" and read("Titre")[0] == "no grid page" and read(None)[0] == "no grid page"
    stray = page([("H-1", {2: "15"})]) + "   777"
    assert read(stray)[2]["H-1"]["frontage_min"][4] == "decalage-suspecte" and read(stray)[2]["H-1"]["frontage_min"][0] is None


def test_layout_rows(spark):
    df = spark.createDataFrame([(1, page([("H-1", {2: "15"})])), (2, "x")], "k int, t string")
    got = layout.grids(df, "k", "t").filter("value IS NOT NULL").collect()
    assert [(r.k, r.zone_code, r.field, r.value) for r in got] == [(1, "H-1", "frontage_min", 15.0)] and layout.rejected(df, "k", "t").first().why == "no grid page"


def test_ckan(spark):
    body = json.dumps({"result": {"results": [{"name": "p", "organization": {"name": "org"}, "resources": [{"id": "1", "format": " GeoJSON ", "url": "u"}, {"id": "2", "format": "Shapefile", "url": "v"}, {"id": "3", "format": "CSV", "url": "w"}, {"id": "4", "format": "kml"}]}]}})
    pk = portals.packages(spark.createDataFrame([("a", body), ("b", "{}"), ("c", "no")], "slug string, body string"), "body", "slug")
    assert [(r.slug, r.package_id, r.title, r.organization) for r in pk.collect()] == [("a", "p", "p", "org")]
    res = portals.geo_resources(pk, "slug")
    assert {(r.resource_id, r.format, r.needs_converter) for r in res.collect()} == {("1", "geojson", False), ("2", "shp", True)}
    got = {r.slug: (r.n_resources, r.quality, r.url) for r in portals.census(spark.createDataFrame([("a",), ("z",)], "slug string"), res).collect()}
    assert got == {"a": (2, "geojson", "u"), "z": (0, "none", None)}


def test_feature_service_addresses(spark):
    assert "cql_filter=nom%3D%27L%27%27Assomption%27" in portals.feature_url("https://h/wfs", "a:b", field="nom", code="L'Assomption")
    caps = "<wfs:FeatureType><wfs:Name>m:zonage_x</wfs:Name><wfs:Title>Plan</wfs:Title></wfs:FeatureType><FeatureType><Name>routes</Name></FeatureType>"
    got = portals.feature_types(spark.createDataFrame([(caps,)], "c string"), "c").collect()
    assert [(r.name, r.title, r.zoneish) for r in got] == [("m:zonage_x", "Plan", True), ("routes", None, False)]
    one = lambda c: spark.range(1).select(c.alias("v")).first().v
    assert tuple(one(portals.layer_parts(F.lit("https://h/A/FeatureServer/3/")))) == ("https://h/A/FeatureServer", 3) and one(portals.layer_parts(F.lit("https://h/A/MapServer")))["layer"] == 0
    assert one(portals.esri_extent(F.lit('{"xmin":1,"ymin":2,"xmax":1,"ymax":3}'))) is None
    c = one(portals.extent_centre(portals.esri_extent(F.lit('{"xmin":-8200000,"ymin":5690000,"xmax":-8180000,"ymax":5710000}')), F.lit(3857)))
    assert c["lon"] == pytest.approx(-73.57, abs=0.02) and c["lat"] == pytest.approx(45.5, abs=0.1)
    assert portals.converter_args("a.zip", "o")[-2:] == ["o", "a.zip"] and "-simplify" not in portals.converter_args("a", "o", tolerance=0)
    layers = portals.listed_layers(spark.createDataFrame([("INFO\n1: lots (Multi Polygon)\n2: x\n",)], "t string"), "t").collect()
    assert [tuple(r) for r in layers] == [("lots", "Multi Polygon"), ("x", None)]


@pytest.mark.parametrize(("f", "given", "want"), [
    (signals.looks_like_zone, "H-12", True), (signals.looks_like_zone, "RUE PRINCIPALE", False), (signals.zone_label, "nord", False), (signals.zone_label, "12345", False), (signals.zone_label, "12.5m", False), (signals.zone_label, "Ra-3", True),
    (signals.zone_shape, "123-Ab", "num-alpha"), (signals.zone_shape, "Ab123", "alpha-num"), (signals.zone_tokens, "H-1 h-1 C2 xx 33", 2), (signals.code_header, "Zones H-1 H-2 C-3", True), (signals.code_header, "la zone H-1 est une zone qui", False),
    (signals.session_only, "Séance ordinaire 3 mars 2025.pdf", True), (signals.session_only, "Budget 2025.pdf", False), (signals.needs_browser, '<div id="root"></div>', "application"), (signals.needs_browser, "<p>x</p>", None),
])
def test_signals(spark, f, given, want):
    assert spark.range(1).select(f(F.lit(given)).alias("v")).first().v == want


def test_dominant_shape(spark):
    rows = [("a", f"H-{i}") for i in range(7)] + [("a", "12-Ab"), ("a", "zz zz")] + [("b", "12-Ab"), ("b", "H-1")]
    got = signals.dominant_shape(spark.createDataFrame(rows, "d string, t string"), "d", "t").groupBy("d").count().collect()
    assert {tuple(r) for r in got} == {("a", 7), ("b", 2)}


def test_answers(spark):
    a = '```json\n{"zones":[{"zone_code":"H-1","fields":{"x":"5 m"}},{"zone_code":"C-2","fields":{"x":"1"}}]}\n```'
    b = 'text {"zones":[{"zone_code":"Zone H 1","fields":{"x":"6 m"}}]} end'
    df = spark.createDataFrame([(1, a, b, "nothing")], "k int, a string, b string, c string")
    left, right = signals.zone_answers(df, "k", "a"), signals.zone_answers(df, "k", "b")
    assert [(r.zone_code, r.raw_a, r.raw_b) for r in signals.both_passes(left, right, "k").collect()] == [("H-1", "5 m", "6 m")] and signals.zone_answers(df, "k", "c").count() == 0


def test_registry(spark):
    rows = [(0, "a", "A", 45.0, -73.0, 5, False, False, 10.0), (1, "a", "", 95.0, -73.0, -1, False, True, 10.0), (2, "b", "B", 45.0, -73.0, None, True, False, 1.0)]
    df = spark.createDataFrame(rows, "pos int, slug string, name string, lat double, lon double, population int, excluded boolean, deprioritized boolean, distance_km double")
    assert [len(r.problems) for r in signals.checked_registry(df).orderBy("pos").collect()] == [0, 4, 0]
    assert signals.prioritised(df).count() == 1 and signals.prioritised(df, 5).count() == 0 and signals.prioritised(df, large=True).count() == 2
    assert signals.zone_property([("OBJECTID", "oid"), ("Affectation", "String"), ("NO_ZONE", "Integer")]) == "NO_ZONE" and signals.zone_property([("desc_zone", "String")]) == "desc_zone" and signals.zone_property([("x", "String")]) is None
