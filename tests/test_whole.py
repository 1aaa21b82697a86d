"""Nothing of the input is left out on the way to an operator."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from compared import same
from geoloom import plans
from geoloom.operators import extract, gates, joins, signals

QUERIES = plans.queries()


def test_detector_reads_whole_documents(spark, tmp_path):
    late = "word " * 200 + "\n\nAvis de motion est donné pour le règlement numéro 555-12 modifiant le règlement de zonage numéro 66-1, zone C-77.\n\n" + "word " * 200
    spark.createDataFrame([(2, late), (3, late)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.bylaws, r.zones) for r in QUERIES["context_window_detector"](spark, str(tmp_path)).collect()}
    assert got == {2: (["102-12", "555-12"], ["H-3", "C-77"]), 3: (["555-12"], ["C-77"])}


MOTION = "Avis de motion est donné par le conseiller. "


@pytest.mark.parametrize(("text", "bylaws", "zones"), [
    (MOTION + "Règlement nº 1767 modifiant le Règlement de zonage (Règl. n°1733)", ["1767"], []),
    (MOTION + "Règlement de zonage Z-3001, en vue d'agrandir dans le secteur du centre les zones C-754, C-810 et H-812", ["Z-3001"], ["C-754", "C-810", "H-812"]),
    (MOTION + "Règlement URB-03-17 modifiant le « Règlement URB-03 sur le zonage »", ["URB-03-17"], []),
    (MOTION + "Règlement numéro V654-2026-33 amendant le règlement de zonage numéro V654-2017-00, zone MxtV-2", ["V654-2026-33"], ["MxtV-2"]),
    (MOTION + "Règlement numéro 1998 visant à remplacer le règlement numéro 1675, zonage", ["1998"], []),
    # the next paragraph counts if this one names a bylaw and no zoning
    (MOTION + "Règlement 1200-93.\n\nIl modifie le règlement de zonage, zone C-254.\n\nZone C-999.", ["1200-93"], ["C-254"]),
    (MOTION + "Rien.\n\nRèglement 1200-93 de zonage.\n\nFin", [], []),
    # a motion of the past looks forward only
    ("Règlement 2026-509 de zonage. Avis de motion a été donné pour le règlement 2026-510 de zonage", ["2026-510"], []),
])
def test_detector_families_and_contexts(text, bylaws, zones):
    got = extract.detect_zoning_change(text)
    assert (got[0], got[1], got[3]) == (bool(bylaws), bylaws, zones)


def test_detector_excerpt_of_each_motion():
    part = "Avis de motion pour le règlement 12-34 de zonage.\n\n" + "x" * 300 + "\n\n"
    got = extract.detect_zoning_change(part + part)[5]
    assert len(got) == 2 and got[0].startswith("Avis de motion") and got[1].startswith("…x") and got[1].endswith("…") and "x Avis de motion pour" in got[1]


HTML = """<base href='/b/'><a class="k" href='grille.pdf'>Grille des spécifications</a><a href="grille.pdf#p2">Annexe</a><a href="/pv.pdf">Procès-verbal</a><a href="https://cdn.ca/z.pdf">Règlement de zonage</a><a href="https://cdn.ca/m.pdf">Règlement modifiant le règlement de zonage</a>
<a href="u">Urbanisme</a><a href="/z#x">Plan de <b>zonage</b></a><a href="https://www.v.ca/">Zonage</a><a href="https://autre.ca/zonage">Zonage</a><a href="/login?zonage">x</a><a href="#zonage">zonage</a><a href="/loisirs">Loisirs</a><a href="/r">Règlements</a>"""


def test_links_to_grids_and_subpages(spark):
    found = extract.links(spark.createDataFrame([(1, "https://v.ca/", HTML)], "page_id int, url string, html string"), "page_id", "html", "url")
    grids = signals.grid_links(found, "page_id", "href", "label", "pos").orderBy("rank").collect()
    assert [(r.href, r.label) for r in grids] == [("https://v.ca/b/grille.pdf", "Grille des spécifications"), ("https://cdn.ca/z.pdf", "Règlement de zonage"), ("https://cdn.ca/m.pdf", "Règlement modifiant le règlement de zonage")]
    pages = signals.subpages(found, "page_id", "page_url", "href", "label", "pos").orderBy("rank").collect()
    assert [(r.href, r.score) for r in pages] == [("https://v.ca/z", 4), ("https://www.v.ca/", 4), ("https://v.ca/b/u", 3), ("https://v.ca/r", 2)]


def test_scope_of_long_prefixes_and_equal_rows(spark):
    long = "x" * 70
    rows = spark.createDataFrame([(long,), (long + "-nord",), ("ab",), ("ab",), ("b",), ("",), (None,)], "name string")
    names = spark.createDataFrame([(long,), ("a",), ("a",), ("abc",), (None,)], "w string")
    assert sorted(r.name for r in joins.in_scope(rows, names, "name", "w").collect()) == ["ab", "ab", long, long + "-nord"]
    assert joins.in_scope(rows, names.limit(0), "name", "w").count() == 0 and joins.in_scope(rows, spark.createDataFrame([("",)], "w string"), "name", "w").count() == 6


def test_closest_in_a_hot_key(spark):
    import random

    draw = random.Random(3)
    # key 1 holds most rows of both sides and number 50 many of them; key 2 has no right rows, key 3 no left ones
    left = [(1, i, float(draw.choice([50, draw.randrange(1000)]))) for i in range(900)] + [(2, 900, 1.0), (4, 901, 5.0), (None, 902, 1.0), (4, 903, None)]
    right = [(1, i, float(draw.randrange(0, 1000, 7)), f"r{i}") for i in range(300)] + [(3, 300, 1.0, "x"), (4, 302, 9.0, "up"), (4, 301, 1.0, "down"), (4, 303, None, "none"), (None, 304, 1.0, "null")]
    want = {}
    for k, i, a in left:
        hits = [(abs(a - b), t, p) for q, t, b, p in right if k is not None and q == k and a is not None and b is not None]
        if hits:
            want[i] = min(hits)[2]
    l, r = spark.createDataFrame(left, "k int, id int, a double").repartition(5), spark.createDataFrame(right, "k int, t int, b double, p string").repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = joins.closest(l, r, "k", "id", "a", "b", ["p"], "t").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == len(want) and {x.id: x.p for x in got} == want
    assert joins.closest(l, r.limit(0), "k", "id", "a", "b", ["p"], "t").count() == 0 and joins.closest(l.limit(0), r, "k", "id", "a", "b", ["p"], "t").count() == 0


def _sql_of(path, name):
    """DuckDB with one table of the folder."""
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/{name}.parquet/*.parquet'")
    return con


def test_two_passes_are_neither_broadcast_nor_lost(spark, tmp_path):
    # equal keys, a missing part of a key, a missing and a broken quantity
    rows = [(1, 1, 10, 5, 3.0), (1, 1, 10, 5, 4.0), (1, 1, 10, 5, 4.0), (1, None, 10, 5, 3.0), (None, 1, 10, 5, 3.0), (2, 1, 9, 5, None), (3, 7, 8, 5, 2.6), (4, 1, 7, 5, 2.5)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))
    df = QUERIES["answers_of_two_passes"](spark, str(tmp_path))
    assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    same(df, _sql_of(tmp_path, "lineitem"), plans.oracle_sql()["answers_of_two_passes"])


def test_cells_of_both_passes(spark):
    a = [(1, "H-1", "x", "5"), (1, "H-1", "x", "6"), (1, "H-1", "y", None), (1, "C-2", "x", "1"), (2, "H-1", "x", "1"), (None, "H-1", "x", "1"), (1, "Zone", "x", "1")]
    b = [(1, "zone H 1", "x", "7"), (1, "H-1", "x", None), (1, "H – 1", "z", "8"), (1, "H-1", "z", "8"), (3, "H-1", "x", "1"), (None, "H-1", "x", "1"), (1, "Zone", "x", "1")]
    left, right = (spark.createDataFrame(x, "k int, zone_code string, field string, raw string") for x in (a, b))
    got = [tuple(r) for r in signals.both_passes(left, right, "k").collect()]
    want = [("x", "5", "7"), ("x", "5", None), ("x", "6", "7"), ("x", "6", None), ("y", None, None), ("z", None, "8"), ("z", None, "8")]
    assert sorted(got, key=repr) == sorted([(1, "H-1", *w) for w in want], key=repr)
    assert signals.both_passes(left, right.limit(0), "k").count() == 0 and signals.both_passes(left.limit(0), right, "k").count() == 0


def test_keywords_beside_letters_outside_ascii(spark, tmp_path):
    words = ("the", "de", "des", "und", "of the", "of\u000bthe", "of\u00a0the", "of \f\n\r\tthe", "u\u20ddnd", "t\u0483h\ufe0fe", "DÉS", "ｕｎｄ")
    marks = ("", "ß", "é", "ñ", "œ", "я", "中", "\u0301", "\u0903", "_", "1", " ", "-", "\u00a0", "\u200b", "\u000b", "𝒜")
    texts = [x + w + y for w in words for x in marks for y in marks] + ["", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    same(QUERIES["keyword_score"](spark, str(tmp_path)), _sql_of(tmp_path, "documents"), plans.oracle_sql()["keyword_score"])


def test_link_weights_beside_letters_outside_ascii(spark):
    import duckdb

    titles = [x + w + y for w in ("grille", "zonage", "urbanisme", "modifiant", "a jour au", "normes", "grille \u000bde zonage", "amendement") for x in ("", "ß", "я", " ", "_") for y in ("", "ß", "я", "s", "-")]
    said = spark.createDataFrame(list(enumerate(titles)), "i int, said string")
    con, score = duckdb.connect(), " + ".join("regexp_matches(said, '" + p.replace("'", "''") + f"')::INT * {w}" for p, w in gates.GRID_WEIGHTS)
    want = [con.execute(f"SELECT {score} FROM (SELECT ? AS said)", [t]).fetchone()[0] for t in titles]
    assert [r.v for r in said.select("i", gates.weighed(gates.GRID_WEIGHTS, F.col("said")).alias("v")).orderBy("i").collect()] == want
