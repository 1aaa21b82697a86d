"""Readings that rest on fixed values."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoloom.operators import signals as SG


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def test_systems_and_layouts(spark):
    for html, name in (("a/wp-json/", "WordPress"), ("/storage/app/media/x", "October"), ("gestionweblex", "GestionWeblex"), ("<input __VIEWSTATE>", "ASP.NET"), ("goazimut", "GoNet/GoAzimut"), ("", "unknown")):
        assert one(spark, SG.cms(F.lit("https://x.ca"), F.lit(html))) == name
    assert one(spark, SG.cms(F.lit("https://x.ca"), F.lit("<link href='/wp-content/uploads/x'>"))) == "WordPress" and one(spark, SG.cms(F.lit("https://x.ca"), F.lit("<link href='/WP-content/x'>"))) == "unknown"
    assert one(spark, SG.cms(F.lit("https://www.municipalites-du-quebec.com/a"), F.lit("wp-json"))) == "municipalites-du-quebec.com"
    assert one(spark, SG.structural_family(F.lit("<table class=x> youtu.be"))) == "static-table" and one(spark, SG.structural_family(F.lit("<ul>"))) == "flat-html-list"


def test_zoning_notices_and_labels(spark):
    for title, yes in (("Projet de règlement 12", True), ("Changement de zone", True), ("Plan d'urbanisme", False), ("Dérogation mineure", False)):
        assert one(spark, SG.zoning_notice(F.lit("autre"), F.lit(title))) == yes
    assert one(spark, SG.zoning_notice(F.lit("ppcmoi"), F.lit("x")))
    assert not one(spark, SG.zone_label(F.lit("Ha"))) and one(spark, SG.zone_label(F.lit("H-12")))


def test_document_kinds(spark):
    rows = [(1, 0, 0, 59.9), (2, 1, 0, 10.0), (3, 0, 1, 60.0), (4, 0, 0, 60.0)]
    got = {r.i: r.kind for r in SG.pdf_class(spark.createDataFrame(rows, "i int, n_grid int, n_amendment int, density double")).collect()}
    assert got == {1: "plan-image", 2: "grille", 3: "reglement", 4: "unknown"}


def test_map_addresses(spark):
    assert one(spark, SG.guessed_hosts(F.lit("Laval")))[:2] == ["https://cartes.laval.ca", "https://sig.laval.ca"]
    assert one(spark, SG.guessed_services(F.lit("laval"), F.lit("https://www.laval.ca/x"))) == ["https://sig.laval.ca", "https://gis.laval.ca", "https://cartes.laval.ca", "https://www.laval.ca"]
    assert one(spark, SG.guessed_services(F.lit("a"), F.lit("https://gis.b.ca"))) == ["https://gis.b.ca", "https://sig.a.ca", "https://gis.a.ca"]
    assert one(spark, SG.guessed_services(F.lit("a"), F.lit(None).cast("string"))) == ["https://sig.a.ca", "https://gis.a.ca"]


def test_work_plan_without_second_accounts(spark):
    cases = spark.range(20).select("id", F.lit("codex").alias("hint"))
    got = SG.work_plan(cases, "id", "id", "hint", ["a", "b"], []).collect()
    assert {r.tier for r in got} == {"sonnet"} and [r.account for r in sorted(got)] == ["a", "b"] * 10
    assert {r.account for r in SG.work_plan(cases, "id", "id", "hint", [], []).collect()} == {None}
