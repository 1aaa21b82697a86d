"""Scalar functions on literal cases."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from geoloom.functions import geometry as G
from geoloom.functions import quantities as Q
from geoloom.functions import text as TX
from geoloom.operators import extract as X
from geoloom.operators import features as FE
from geoloom.operators import gates as GA


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(("f", "given", "want"), [
    (TX.norm_name, "L'Île-d'Orléans  (Nord)", "lile-dorleans-nord"), (TX.norm_name, None, ""), (TX.ascii_slug, "Montréal d’Est", "montral-dest"), (TX.slug_segment, " Été--2024! ", "ete-2024"),
    (TX.canon_zone, "h 0012", "H-12"), (TX.canon_zone, "Ra-003", "RA-3"), (TX.canon_zone_code, "Zone H – 4 (plan général)", "H-4"), (TX.canon_zone_code, "  ", None), (TX.canon_raw, " A  —B ", "a -b"), (TX.canon_raw, None, "∅"),
    (TX.decode_entities, "L&rsquo;&eacute;t&eacute;&nbsp; &amp;  &laquo;x&raquo;", "L'été & «x»"), (TX.strip_tags, "<p>a<br>b</p>", "a b"), (TX.site_of, "https://user@WWW.Ville.QC.ca:80/x", "ville.qc.ca:80"), (TX.site_of, "nope", None),
    (TX.crs_code, "epsg:04326", "EPSG:4326"), (TX.crs_code, "CRS84", "EPSG:4326"), (TX.crs_code, "local", None), (TX.source_slug, "!!", "source"), (TX.to_https, "http://WWW.Ex.ca/A/", "https://www.ex.ca/A"), (TX.to_https, " ", None),
    (Q.french_date, "20 mai 2026", "2026-05-20"), (Q.french_date, "20 mey 2026", "non-disponible"), (Q.label_date, "Séance du 1er octobre 2025", "2025-10-01"), (Q.label_date, "PV 2025/03/10", "2025-03-10"), (Q.label_date, "mars 2025", "2025-03"), (Q.label_date, "x", "non-disponible"),
    (Q.file_date, "pv 3-4-25.pdf", "2025-04-03"), (Q.file_date, "2024_12_31", "2024-12-31"), (Q.file_date, "99-99-2024", None), (Q.duration_ms, "P1M", 2592000000), (Q.duration_ms, "P", None), (Q.duration_ms, "P1W", None),
    (Q.leading_int, "2 748 500 $", 2748500), (Q.leading_int, "-3", None), (Q.field_of_label, "Marge latérale maximale", None), (Q.field_of_label, "Superficie min. (m²)", "superficie_min"),
    (GA.notice_type, "AEV_REG_2026-11", "entree-en-vigueur"), (GA.notice_type, "Projet de règlement", "projet-reglement"), (GA.licence_id, " ODbL ", "odbl-1.0"), (GA.licence_id, "?", "unknown"), (GA.platform, "https://a/FeatureServer/0", "arcgis"),
    (X.bylaw_number, "RÈGLEMENT NUMÉRO 12-34 relatif", "12-34"), (X.zone_kind, "H-12", "habitation"), (X.zone_kind, "", "autre"),
])
def test_text_to_value(spark, f, given, want):
    assert one(spark, f(F.lit(given).cast("string"))) == want


@pytest.mark.parametrize(("raw", "value", "unit", "absent"), [("1 200 m²", 1200.0, "m2", False), ("7,5 m", 7.5, "m", False), ("Note 5", None, "m", False), ("s.o.", None, None, True), ("35 %", 35.0, "pct", False), ("2 étages", 2.0, "etages", False), ("", None, None, True)])
def test_measure(spark, raw, value, unit, absent):
    got = one(spark, Q.measure(F.lit(raw), "m"))
    assert (got["value"], got["unit"], got["absent"]) == (value, unit, absent)


@pytest.mark.parametrize(("a", "b", "flag", "value"), [("5 m", "5,0 m", None, 5.0), ("5 m", "6 m", "divergence-2-passes", None), ("—", "s.o.", "absent", None), ("voir art. 3", "voir art. 3", "non-numerique", None), ("5 %", "5 %", "unite-incoherente", None), ("500 m", "500 m", "hors-plage", None)])
def test_two_readings(spark, a, b, flag, value):
    got = one(spark, Q.two_readings(F.lit(a), F.lit(b), F.lit("length"), F.lit(0), F.lit(100), "m"))
    assert (got["flag"], got["value"]) == (flag, value)


def test_half_up_rounding(spark):
    assert one(spark, Q.round_half_up(F.lit(-2.5))) == -2 and one(spark, Q.round_half_up(F.lit(2.5))) == 3 and one(spark, Q.pct(F.lit(1), F.lit(0))) == 0 and one(spark, Q.pct(F.lit(5), F.lit(4))) == 100


def square():
    return F.expr("array(array(array(array(0D,0D),array(10D,0D),array(10D,10D),array(0D,10D),array(0D,0D)), array(array(4D,4D),array(6D,4D),array(6D,6D),array(4D,6D),array(4D,4D))))")


@pytest.mark.parametrize(("x", "y", "want"), [(5, 5, False), (1, 1, True), (0, 5, False), (10, 10, False), (4, 5, False), (11, 5, False), (3.999, 5, True)])
def test_strict_inside_with_a_hole(spark, x, y, want):
    assert one(spark, G.inside(square(), F.lit(float(x)), F.lit(float(y)))) is want


def test_measures(spark):
    assert one(spark, G.area(square())) == 96 and one(spark, G.perimeter(square())) == 48
    assert one(spark, G.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0))) == pytest.approx(111.19, abs=0.01)
    lot = F.expr("array(array(array(array(-73.6D,45.5D),array(-73.5987D,45.5D),array(-73.5987D,45.5009D),array(-73.6D,45.5009D),array(-73.6D,45.5D))))")
    got = one(spark, G.lot_measures(lot, G.choose_epsg(F.lit(-73.6))))
    assert 5000 < got["area_m2"] < 12000 and got["frontage_m"] <= got["depth_m"] and math.isclose(got["area_m2"], got["frontage_m"] * got["depth_m"], rel_tol=0.01)
    p = one(spark, G.representative_point(square()))
    assert p[1] == 5 and (0 < p[0] < 4 or 6 < p[0] < 10)


def test_request_parameters():
    assert FE.parse_bbox("1,2,3,4") == (1, 2, 3, 4) and FE.parse_bbox("1,2,3") is None and FE.parse_bbox("a,2,3,4") is None and FE.parse_bbox("1,2,3,inf") is None
    assert FE.parse_limit("12a") == 12 and FE.parse_limit("0") == 100 and FE.parse_limit("99999") == 10000 and FE.parse_limit(None) == 100 and FE.parse_offset("-4") == 0 and FE.parse_offset("7") == 7


ROBOTS = "User-agent: *\nDisallow: /a/\nAllow: /a/b\nCrawl-delay: 4\n\nUser-agent: crawler\nUser-agent: crawler-bot\nDisallow: /*.pdf$\n"


@pytest.mark.parametrize(("agent", "path", "want"), [("x/1.0", "/a/c", False), ("x", "/a/b/c", True), ("x", "/z", True), ("Crawler-Bot/2", "/q.pdf", False), ("Crawler-Bot/2", "/q.pdf?x", True), ("crawler", "/a/c", True)])
def test_robots(agent, path, want):
    assert GA.robots_may(ROBOTS, agent, path) is want
    assert GA.robots_group(GA.robots_groups(ROBOTS), "none")["delay"] == 4


def test_zoning_change():
    found, new, changed, zones, density, excerpt = X.detect_zoning_change("Intro.\n\nAvis de motion est donné pour le règlement numéro 123-45 modifiant le règlement de zonage numéro 77-12, zone H-4, densité.\n\nRèglement 9-9.")
    assert found and new == ["123-45"] and changed == ["77-12"] and zones == ["H-4"] and density and "9-9" not in excerpt
    assert X.detect_zoning_change("Avis de motion pour un emprunt.")[0] is False and X.detect_zoning_change(None)[0] is False


def test_captions(spark):
    text = "WEBVTT\nKind: captions\n\n1\n00:00:01.000 --> 00:00:02.000\n<c>Bonjour</c>\n\nBonjour\nà tous"
    assert one(spark, X.caption_text(F.lit(text))) == "Bonjour à tous"
