"""Lines to polygons, drawing paths, small readings, reports, command line."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from geoloom import cli
from geoloom.functions import linework as L
from geoloom.functions import quantities as Q
from geoloom.operators import signals as SG
from geoloom.plans import api, reports


def size(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:])) / 2


def test_four_segments_make_one_polygon():
    square = [[(0, 0), (4, 0)], [(4, 0), (4, 4)], [(4, 4), (0, 4)], [(0, 4), (0, 0)]]
    assert [size(r) for r in L.polygonize(square)] == [16]
    crossed = square + [[(-1, 2), (5, 2)], [(2, -1), (2, 2)], [(2, 2), (3, 3)]]  # through, into the middle, and a dangling end
    assert sorted(size(r) for r in L.polygonize(crossed)) == [4, 4, 8]
    assert L.polygonize([[(0, 0), (1, 1)]]) == [] and L.polygonize([]) == []


def test_polygons_by_drawing(spark):
    lines = [("a", [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]), ("b", [[0.0, 0.0], [1.0, 0.0]])]
    got = L.polygons(L.usable_lines(spark.createDataFrame(lines, "k string, line array<array<double>>"), "line"), "k", "line").collect()
    assert [(r.k, len(r.ring)) for r in got] == [("a", 4)]


@pytest.mark.parametrize(("path", "want"), [("M0 0 L2 0 2 2 Z", [(0, 0), (2, 0), (2, 2), (0, 0)]), ("m1 1 h2 v2 z", [(1, 1), (3, 1), (3, 3), (1, 1)]), ("M0,0 L1,1", None), ("M0 0 L1 0 L1 1 L0 0", [(0, 0), (1, 0), (1, 1), (0, 0)])])
def test_drawing_path(path, want):
    assert L.path_ring(path) == want


def test_curves_and_files():
    assert len(L.path_ring("M0 0 C0 1 1 1 1 0 Z")) == 10 and len(L.drawn_rings('<svg><path d="M0 0 L1 0 L1 1 Z"/><path fill="x" d="M0 0"/></svg>')) == 1
    assert L.plan_point(10, 90, 100, 2, [1, 0, 5, 0, -1, 7]) == (25, -13)


def test_readings(spark):
    one = lambda c: spark.range(1).select(c.alias("v")).first().v
    assert [tuple(r) for r in one(SG.pairs(F.lit("a=1234, b = 12 ,c=70022,=5555")))] == [("a", "1234"), ("c", "70022")]
    assert one(SG.viewer_code(F.lit("https://h/v?m=7002&x=1"))) == "07002" and one(SG.viewer_code(F.lit("https://h/70022/"))) == "70022" and one(SG.viewer_code(F.lit("https://h/x"))) is None
    assert one(SG.channel_id(F.lit("https://y/channel/UC" + "a" * 22))) == "UC" + "a" * 22
    assert one(SG.candidate_pages(F.lit("https://h/a/b"), ["/pv/"])) == ["https://h/a/b", "https://h/", "https://h/pv"]
    assert one(SG.polygon_layers(F.array(*map(F.lit, ("ZONAGE_LIM", "zone_texte", "routes"))))) == ["ZONAGE_LIM"]
    assert one(SG.boosted(F.array(*map(F.lit, "abcd")), ["c", "b"])) == ["b", "c", "a", "d"]
    assert sorted(SG.seeded_sample(list(range(9)), 9, 3)) == list(range(9)) and SG.seeded_sample(list(range(9)), 4, 3) == SG.seeded_sample(list(range(9)), 4, 3)
    assert one(Q.french_long(F.lit("2026-03-01"))) == "1er mars 2026" and one(Q.range_label(F.lit(1200.4), F.lit(3400.5))) == "1 200 – 3 401"
    dealt = [{r.id: r.account for r in SG.spread(spark.range(100).repartition(n), "id", 3).collect()} for n in (1, 7)]
    assert dealt[0] == dealt[1] and set(dealt[0].values()) == {0, 1, 2}


def test_reports_and_description(spark):
    df = spark.createDataFrame([("b|c", 1), ("a", None)], "k string, n int")
    assert reports.markdown(df, ["k"]).split("\n") == ["| k | n |", "|---|---|", "| a |  |", "| b\\|c | 1 |"]
    assert "/collections/{collectionId}/items" in api.Api(None).openapi()[1]["paths"]


def test_command_line(tmp_path, capsys):
    m = {"id": "s", "title": "T", "country": "CA", "kind": "admin", "provider": "P", "licence": "cc-by", "datasets": [{"id": "d", "title": "D", "format": "geojson", "url": "x"}]}
    (tmp_path / "m.json").write_text(json.dumps(m))
    assert cli.main(["sources", str(tmp_path / "m.json"), "--country", "ca"]) == 0 and "© P — T" in capsys.readouterr().out
