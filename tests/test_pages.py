"""Signals of pages and the kinds of documents, on cases written by hand."""

from __future__ import annotations

import pytest

from geoloom.operators import pages as PG

TABLE = "Grille des spécifications\nMarge avant minimale (m) 6\nHauteur max. 2 étages\nLargeur minimale (m) 12"


def read(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def of(spark, text, read_):
    return spark.createDataFrame([(text,)], "t string").select(read_("t").alias("x")).first().x


def signals(spark, page):
    s = of(spark, page, PG.page_signals)
    return {k for k, v in s.asDict().items() if v is True}


@pytest.mark.parametrize(
    "page, want",
    [
        (TABLE, {"title_table", "title_gated"}),
        (TABLE + "\nZone : H-12", {"title_table", "title_gated", "own_zone"}),
        (TABLE.replace("\nLargeur minimale (m) 12", ""), set()),
        ("G r i l l e s  d e  spécification\n" + TABLE.split("\n", 1)[1], {"title_table"}),
        ("Zones H-1 H-2 C-3", {"zone_header"}),
        ("H-1 H-2 C-3", set()),
        ("H-1 H-2 C-3\nA1 A2 A3b", {"zone_header"}),
        ("zones H-1, H-2, C-3.", set()),
        ("zones H-1 H-1 H-2", set()),
        ("zones H-1 H-2 H-1000", set()),
        ("Numéros  de zones 101 103 104", {"zone_header"}),
        ("Numéros de zones 101 103", set()),
        ("Grilles des usages\n Zone A1", {"title_gated"}),
        ("dans la grille des spécifications H-14", set()),
        ("USAGE lotissement largeur superficie hauteur marge", {"native"}),
        ("usage lotissement largeur superficie hauteur marges", set()),
        ("Avis  de\nmotion", {"legal"}),
        ("Entrée en vigueur", {"legal"}),
        ("", set()),
        (None, set()),
    ],
)
def test_signals_of_a_page(spark, page, want):
    assert signals(spark, page) == want


@pytest.mark.parametrize(
    "line, yes",
    [("Marge avant minimale (m) 6", True), ("a) Marge avant minimale (m) 6;", False), ("a) Marge avant minimale (m) 6", True), ("Marge minimale 6, hauteur 2.", False), ("Marge minimale 6.", True), ("Marge minimale", False), ("Hauteur 2", False)],
)
def test_rows_of_norms(spark, line, yes):
    assert of(spark, line, PG.norm_rows) == int(yes)


def test_kinds_of_documents(spark):
    kind = lambda t: of(spark, t, PG.document_class)
    whole = kind("x" * 90 + "\f" + TABLE + "\f\fZones H-1 H-2 C-3\f")
    assert (whole.kind, whole.n_pages, whole.n_grid, whole.first_grid, whole.last_grid, whole.first_header, whole.last_header) == ("grille", 4, 2, 2, 4, 4, 4)
    for text, want in (("avis de motion " + "x" * 45, "reglement"), ("avis de motion", "plan-image"), ("x" * 60, "unknown"), ("x" * 59, "plan-image"), ("", "plan-image"), (None, "plan-image"), ("\f\f", "plan-image")):
        assert kind(text).kind == want
    assert kind(None).n_pages == 0 and kind("\f\f").n_pages == 2 and kind("x" * 100 + "\f" + "y").density == 50.5


def test_spans_of_tables(spark):
    span = lambda t: of(spark, t, PG.grid_span)
    got = span("a\f" + TABLE + "\f\f" + TABLE + "\nZone: H-1")
    assert (got.first_page, got.last_page, got.n_pages, got.layout, got.confidence) == (2, 4, 2, "one-zone-per-page", 0.667)
    assert span("\f".join([TABLE] * 3 + [TABLE + "\nZone: H-1"])).layout == "multi-zone-per-page"
    assert span("a\fb") is None and span(None) is None and span("") is None


def test_pages_with_legal_text(spark):
    pages = spark.createDataFrame([(1, "Attendu que"), (1, "x"), (2, None)], "d int, t string")
    assert {tuple(r) for r in PG.amendment_pages(pages, "d", "t").collect()} == {(1, 2, 1), (2, 1, 0)}
