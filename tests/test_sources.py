"""Readers, crawlers, sinks and the query facade."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from geoloom.operators import features as FE
from geoloom.sources import arcgis, files


def square(i: int) -> dict:
    x, y = i % 10, i // 10
    return {"type": "Feature", "id": f"f{i}", "geometry": {"type": "Polygon", "coordinates": [[[x, y], [x + 1, y], [x + 1, y + 1], [x, y + 1], [x, y]]]}, "properties": {"NOM": f"Lot {i}", "geoId": f"g{i}"}}


@pytest.fixture
def folder(tmp_path):
    doc = {"type": "FeatureCollection", "features": [square(i) for i in range(30)] + [{"type": "Feature", "geometry": None, "properties": {"name": "nowhere"}}]}
    (tmp_path / "features.geojson").write_text(json.dumps(doc))
    (tmp_path / "bad.geojson").write_text("{not json")
    (tmp_path / "other.geojson").write_text('{"type": "Point"}')
    return tmp_path


def test_geojson(spark, folder):
    df = FE.read_collection(spark, str(folder)).cache()
    assert df.count() == 31
    assert FE.number_matched(df, (0, 0, 0.5, 0.5)).first()[0] == 1 and FE.number_matched(df, (1, 0, 1, 0)).first()[0] == 2
    assert [r.feature_id for r in FE.page(df, "pos", (0, 0, 3, 0.5), 2, 1).collect()] == ["f1", "f2"]
    last = FE.item(df, F.col("feature_id"), "30", "pos").first()
    assert last.minx is None and last.multi is None
    adm = FE.admin(df, "CA", "Lots").orderBy("pos").collect()
    assert (adm[3].geo_id, adm[3].name, adm[30].name, adm[30].geo_id) == ("g3", "Lot 3", "nowhere", "ca/lots/locality/nowhere")


def test_service_by_offset_and_box(spark, folder):
    arcgis.register(spark)
    pages = spark.read.format("feature_service").option("root", str(folder)).option("pagesize", 8).load()
    assert pages.count() == 31 and pages.select("part").distinct().count() == 4
    boxes = spark.read.format("feature_service").option("root", str(folder)).option("pagesize", 9).option("strategy", "bbox").option("bbox", "0,0,10,3").load()
    assert boxes.select("id").distinct().count() == 30 and boxes.count() >= 30


def test_backoff():
    waits, answers = [], iter([(429, {"Retry-After": "3"}, ""), (503, {}, ""), (200, {}, "ok")])
    assert arcgis.backoff(lambda u: next(answers), "u", sleep=waits.append) == "ok" and waits[0] == 3
    with pytest.raises(OSError):
        arcgis.backoff(lambda u: (404, {}, ""), "u", sleep=waits.append)
    assert arcgis.query_url("https://h/S/FeatureServer/", 2, f="json") == "https://h/S/FeatureServer/2/query?where=1%3D1&outFields=%2A&outSR=4326&f=json"


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a;b\n"x ""y""\nz";1\nshort\n')
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "a.csv"), ";").collect()] == [('x "y"\nz', "1"), ("short", "")]


def test_roll(spark, tmp_path):
    (tmp_path / "r.xml").write_text("<RL><RLM01A>1</RLM01A><RLUEx><RL0103><RL0103x><RL0103Ax>4 1</RL0103Ax></RL0103x><RL0103x><RL0103Ax>4 1</RL0103Ax></RL0103x></RL0103><RL0104A>1</RL0104A><RL0404A>2 748 500</RL0404A></RLUEx><RLUEx><RL0104A>1</RL0104A><RL0104B>2</RL0104B><RL0104C>3</RL0104C></RLUEx></RL>")
    a, b = files.read_roll(spark, str(tmp_path / "r.xml")).collect()
    assert (a.lots, a.matricule, a.total_cad) == (["4 1"], None, 2748500) and (b.lots, b.matricule, b.total_cad) == ([], "1-2-3", None)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "slug string, n int")
    files.write_by_slug(df, str(tmp_path / "o"))
    files.write_by_slug(df.filter("slug = 'a'").withColumn("n", F.lit(9)), str(tmp_path / "o"))
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "o")).select("slug", "n").collect()} == {("a", 9), ("b", 2)}
    assert files.conform(df, files.LOT_INDEX).columns == files.LOT_INDEX.names
    assert files.parse_store_uri("s3://b/x/y/")["spark"] == "s3a://b/x/y"
