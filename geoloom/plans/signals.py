"""Labels, links, portals, registries and workflow steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoloom.functions import text as TX
from geoloom.operators import layout as LA
from geoloom.operators import signals as SG
from geoloom.plans import catalog, jobs
from geoloom.sources import portals as PO

from .registry import ORDER, query, table


def _cycle(values, by):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (by % len(values) + 1).cast("int"))


def sql_list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else "'" + str(v).replace("'", "''") + "'" for v in values) + "]"


RAW_LABELS = ("H-12", "nord", "12345", "12.5m", "Ra-3", "RUE PRINCIPALE DU VILLAGE", "77", "123-Ab", "", "C 204")


@query(f"SELECT p_partkey, {sql_list(RAW_LABELS)}[p_partkey % 10 + 1] AS label FROM part WHERE p_partkey % 10 IN (0, 4, 9)")
def zone_label_filter(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", _cycle(RAW_LABELS, F.col("p_partkey")).alias("label"))
    return p.filter(SG.zone_label("label"))


SHAPES = """WITH l AS (SELECT p_size AS doc, p_partkey, CASE WHEN p_partkey % (2 + p_size % 4) = 0 THEN p_partkey % 900 || '-A' ELSE 'H-' || p_partkey % 900 END AS label FROM part),
s AS (SELECT *, CASE WHEN regexp_full_match(label, '[0-9]{1,4}-[A-Za-z]{1,5}') THEN 'n' ELSE 'a' END AS shape FROM l), c AS (SELECT doc, shape, count(*) AS n FROM s GROUP BY ALL), t AS (SELECT doc, sum(n) AS t, arg_max(shape, n) AS top, max(n) AS m FROM c GROUP BY doc)
SELECT s.doc, p_partkey, label FROM s JOIN t USING (doc) WHERE NOT (t >= 8 AND m >= 5 AND m >= 0.7 * t) OR shape = top"""


@query(SHAPES)
def dominant_label_shape(spark, sf_dir):
    k, d = F.col("p_partkey"), F.col("p_size")
    label = F.when(k % (2 + d % 4) == 0, F.concat(k % 900, F.lit("-A"))).otherwise(F.concat(F.lit("H-"), k % 900))
    return SG.dominant_shape(table(spark, sf_dir, "part").select(d.alias("doc"), "p_partkey", label.alias("label")), "doc", "label")


LINES = ("Zones H-1 H-2 C-3", "la zone H-1 est une zone", "H-1 C-2 C-2", "A1 B22 C333 D4", "Superficie minimale du terrain")


@query(f"SELECT p_partkey, [3, 1, 2, 4, 0][p_partkey % 5 + 1]::BIGINT AS n_tokens, [true, false, false, true, false][p_partkey % 5 + 1] AS heads FROM part")
def zone_header_lines(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", _cycle(LINES, F.col("p_partkey")).alias("x"))
    return p.select("p_partkey", SG.zone_tokens("x").alias("n_tokens"), SG.code_header("x").alias("heads"))


@query("""SELECT o_custkey, arg_min(o_orderkey, (-(o_orderkey % 3), -(o_orderkey % 7), -o_totalprice, o_orderkey::VARCHAR)) AS o_orderkey FROM orders GROUP BY o_custkey""")
def best_candidate(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 3).alias("priority"), (F.col("o_orderkey") % 7).alias("pages"), F.col("o_totalprice").alias("score"), F.col("o_orderkey").cast("string").alias("url"))
    return SG.better_first(o, "o_custkey").select("o_custkey", "o_orderkey")


@query("""SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN 'grille' WHEN doc_id % 150 < 60 THEN 'plan-image' WHEN doc_id % 5 >= 1 THEN 'reglement' ELSE 'unknown' END AS kind,
CASE WHEN doc_id % 4 <> 3 AND (doc_id % 150 < 60 OR doc_id % 5 >= 1) THEN NULL ELSE (doc_id % 2) * 2 + (doc_id % 4 = 3)::INT END::INT AS priority FROM documents""")
def document_gate(spark, sf_dir):
    k = F.col("doc_id")
    d = table(spark, sf_dir, "documents").select("doc_id", F.lit(6).alias("n_pages"), (k % 4 == 3).cast("int").alias("n_grid"), (k % 5).alias("n_amendment"), (k % 150).alias("density"))
    return SG.pdf_class(d).select("doc_id", "kind", SG.gate("kind", k % 2 == 1).alias("priority"))


@query("""SELECT s_suppkey AS pos, CASE WHEN row_number() OVER (PARTITION BY s_suppkey % 40 ORDER BY s_suppkey) > 1 THEN 1 ELSE 0 END + (s_suppkey % 9 = 0)::INT + (s_suppkey % 100 > 90)::INT AS n_problems FROM supplier""")
def registry_check(spark, sf_dir):
    k = F.col("s_suppkey")
    c = table(spark, sf_dir, "supplier").select(k.alias("pos"), F.concat(F.lit("s"), k % 40).alias("slug"), F.when(k % 9 == 0, " ").otherwise(F.col("s_name")).alias("name"), (k % 100).alias("lat"), F.lit(-73.0).alias("lon"), F.lit(None).cast("int").alias("population"))
    return SG.checked_registry(c).select("pos", F.size("problems").alias("n_problems"))


@query("SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 3 AND c_custkey % 7 <> 2 AND c_custkey % 120 <= 80")
def prioritised_cities(spark, sf_dir):
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", (k % 10 == 3).alias("excluded"), (k % 7 == 2).alias("deprioritized"), (k % 120).alias("distance_km"))
    return SG.prioritised(c, 80).select("c_custkey")


@query("""SELECT p_partkey, p_type || '-' || p_size AS base, CASE WHEN row_number() OVER w > 1 THEN p_type || '-' || p_size || '-' || row_number() OVER w ELSE p_type || '-' || p_size END AS unique_id FROM part WINDOW w AS (PARTITION BY p_type, p_size ORDER BY p_partkey)""")
def unique_manifest_ids(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws("-", "p_type", F.col("p_size").cast("string")).alias("base"))
    return catalog.unique_ids(p, "base", "p_partkey")


@query("""WITH l AS (SELECT event_id AS ref, CASE WHEN event_id % 5 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS last, 'c' || event_id % 3 AS sum FROM events), f AS (SELECT ref, 'c' || ref % 2 AS sum FROM l WHERE ref % 4 = 0)
SELECT l.ref::VARCHAR AS manifest_ref, CASE WHEN f.ref IS NOT NULL THEN '2024-02-01' ELSE last END AS last_fetched_at, coalesce(f.sum, l.sum) AS checksum, CASE WHEN f.ref IS NULL THEN 'skipped' WHEN f.sum <> l.sum THEN 'updated' ELSE 'unchanged' END AS outcome FROM l LEFT JOIN f ON l.ref = f.ref""")
def ledger_refresh(spark, sf_dir):
    k = F.col("event_id")
    led = table(spark, sf_dir, "events").select(k.cast("string").alias("manifest_ref"), F.when(k % 5 != 0, F.date_format("ts", "yyyy-MM-dd")).alias("last_fetched_at"), F.lit("P1M").alias("cadence"), F.concat(F.lit("c"), k % 3).alias("checksum"))
    got = table(spark, sf_dir, "events").filter("event_id % 4 = 0").select(k.cast("string").alias("manifest_ref"), F.concat(F.lit("c"), k % 2).alias("checksum"))
    return catalog.refreshed(led, got, "2024-02-01").drop("cadence")


@query("""WITH m AS (SELECT user_id, event_type AS layer, min(event_id) AS e FROM events GROUP BY ALL), p AS (SELECT user_id, event_type AS layer FROM events WHERE event_id % 6 = 0 GROUP BY ALL)
SELECT m.user_id::VARCHAR AS slug, m.layer, CASE WHEN p.user_id IS NOT NULL OR e % 3 = 0 THEN 'done' ELSE 'candidate' END AS status, p.user_id IS NOT NULL AND e % 3 <> 0 AS changed FROM m LEFT JOIN p USING (user_id, layer)""")
def coverage_reconcile(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    m = e.groupBy(F.col("user_id").cast("string").alias("slug"), F.col("event_type").alias("layer")).agg(F.min("event_id").alias("e"))
    m = m.select("slug", "layer", F.when(F.col("e") % 3 == 0, "done").otherwise("candidate").alias("status"), F.lit(None).cast("string").alias("track"))
    p = e.filter("event_id % 6 = 0").select(F.col("user_id").cast("string").alias("slug"), F.col("event_type").alias("layer"), F.lit("t").alias("track")).distinct()
    return jobs.reconcile(m, p).drop("track")


@query("""SELECT p_partkey::VARCHAR AS package_id, f AS format, 'u' || p_partkey || f AS url, f <> 'geojson' AS needs_converter FROM part, (VALUES ('geojson'), ('shp')) v(f) WHERE p_partkey % 3 <> 0 OR f = 'shp'""")
def portal_resources(spark, sf_dir):
    k = F.col("p_partkey").cast("string")
    res = lambda i, f, u: F.concat(F.lit(f'{{"id":"{i}","format":"{f}","url":"'), u, F.lit('"}'))
    geo = F.when(F.col("p_partkey") % 3 == 0, F.lit("")).otherwise(F.concat_ws("", k, F.lit("geojson")))
    u = lambda s: F.concat(F.lit("u"), k, F.lit(s))
    body = F.concat(F.lit('{"result":{"results":[{"id":"'), k, F.lit('","resources":['), res(1, " GeoJSON", F.when(geo == "", F.lit("")).otherwise(u("geojson"))), F.lit(","), res(2, "Shapefile", u("shp")), F.lit(","), res(3, "CSV", u("csv")), F.lit("]}]}}"))
    pk = PO.packages(table(spark, sf_dir, "part").select(body.alias("body")), "body")
    return PO.geo_resources(pk).select("package_id", "format", "url", "needs_converter")


@query("""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'https://h/A/FeatureServer' WHEN page_id % 3 = 1 THEN 'https://h/B/MapServer' ELSE 'https://h/C' END AS service, CASE WHEN page_id % 3 = 0 THEN page_id % 20 ELSE 0 END::INT AS layer, page_id % 3 = 1 AS zoning FROM pages""")
def layer_addresses(spark, sf_dir):
    k = F.col("page_id")
    url = F.when(k % 3 == 0, F.concat(F.lit("https://h/A/FeatureServer/"), k % 20)).when(k % 3 == 1, F.lit("https://h/B/MapServer/")).otherwise(F.lit("https://h/C"))
    name = F.when(k % 3 == 1, "Urb/Plan_Zonage_2024").otherwise("Urb/Routes")
    return table(spark, sf_dir, "pages").select("page_id", PO.layer_parts(url).alias("p"), PO.zoning_service(name).alias("zoning")).select("page_id", "p.*", "zoning")


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity::INT AS q FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'H-' || l_partkey % 9 AS zone_code, a.q || ' m' AS raw_a, l_linenumber || ' m' AS raw_b FROM l a JOIN l b USING (l_orderkey, l_linenumber, l_partkey, l_suppkey)""")
def answers_of_two_passes(spark, sf_dir):
    zone = F.concat(F.lit("H-"), F.col("l_partkey") % 9)
    metres = lambda v: F.coalesce(F.concat(F.lit('"'), v.cast("int").cast("string"), F.lit(' m"')), F.lit("null"))
    ans = lambda z, v: F.concat(F.lit('```json\n{"zones":[{"zone_code":"'), z, F.lit('","fields":{"x":'), v, F.lit('}}]}\n```'))
    df = table(spark, sf_dir, "lineitem").select(*ORDER, ans(zone, metres(F.rint("l_quantity"))).alias("a"), ans(F.concat(F.lit("zone H "), F.col("l_partkey") % 9), metres(F.col("l_linenumber"))).alias("b"))
    return SG.both_passes(SG.zone_answers(df, ORDER, "a"), SG.zone_answers(df, ORDER, "b"), ORDER).drop("field")


PHRASES = ("de chambres", "de bâtiments", "lot (m)", "min. lot (m)", "min. lot (m²)", "sol max.", "max. étage", "avant min.", "latérale min.", "marges", "arrière min.", "libre min.")


@query("""SELECT p_partkey, 'Z' AS kind, 'H-' || (p_partkey % 50 + 1) AS zone_code, field, CASE WHEN field = 'frontage_min' AND p_size BETWEEN 3 AND 200 THEN p_size::DOUBLE WHEN field = 'densite' THEN 35.0 END AS value FROM part, (VALUES ('frontage_min'), ('superficie_min'), ('densite'), ('hauteur_max_etage'), ('marge_avant_min'), ('marge_laterale_min'), ('marge_arriere_min')) v(field)""")
def layout_grids(spark, sf_dir):
    width, starts = 18, [18 * k + 14 for k in range(12)]
    head = " " * 14 + "".join(p.ljust(width) for p in PHRASES)
    mid = lambda k: starts[k] + len(PHRASES[k]) // 2
    row = F.concat(F.rpad(F.concat(F.lit("  H-"), F.col("p_partkey") % 50 + 1), mid(2), " "), F.rpad(F.col("p_size").cast("string"), mid(5) - mid(2), " "), F.lit("35"))
    text = F.concat(F.lit("GRILLE DES USAGES ET DES NORMES No zone H0001\nUsage Lotissement Largeur Superficie Hauteur Marge Implantation\n" + head + "\n"), row)
    p = table(spark, sf_dir, "part").select("p_partkey", text.alias("t"))
    return LA.grids(p, "p_partkey", "t").select("p_partkey", F.lit("Z").alias("kind"), "zone_code", "field", "value")


NAMES = ("Séance ordinaire 3 mars 2025.pdf", "Budget 2025.pdf", "pv-2024-05-06.pdf", "Règlement de zonage")


@query("SELECT p_partkey, p_partkey % 4 IN (0, 2) AS session, p_partkey % 4 = 3 AS zoning FROM part")
def session_names(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", _cycle(NAMES, F.col("p_partkey")).alias("x"))
    return p.select("p_partkey", SG.session_only("x").alias("session"), SG.has_keyword("x", SG.ZONING_WORDS).alias("zoning"))


SLUG = "regexp_replace(lower(n_name), '[^a-z]', '', 'g')"


@query(f"SELECT n_nationkey, unnest(['https://cartes.' || s || '.ca', 'https://sig.' || s || '.ca', 'https://gis.' || s || '.ca', 'https://geomatique.' || s || '.ca', 'https://www.ville.' || s || '.qc.ca', 'https://ville.' || s || '.qc.ca']) AS host FROM (SELECT n_nationkey, {SLUG} AS s FROM nation)")
def host_guesses(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.regexp_replace(TX.fold("n_name"), "[^a-z]", "").alias("s"))
    return n.select("n_nationkey", F.explode(SG.guessed_hosts("s")).alias("host"))


@query(r"""WITH h AS (SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)) AS host FROM pages), b AS (SELECT page_id, nullif(host, '') AS host, regexp_replace(host, '^www\.', '') AS bare FROM h)
SELECT page_id, unnest(CASE WHEN host IS NULL THEN [] WHEN starts_with(host, 'sig.') OR starts_with(host, 'gis.') THEN ['https://' || host] ELSE list_distinct(['https://sig.' || bare, 'https://gis.' || bare, 'https://cartes.' || bare, 'https://' || host]) END || ['https://sig.p' || page_id || '.ca', 'https://gis.p' || page_id || '.ca']) AS address FROM b""")
def service_guesses(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", F.explode(SG.guessed_services(F.concat(F.lit("P"), "page_id"), "url")).alias("address"))
    return p


MARKS = ("", "/wp-json/", "gestionweblex", "__VIEWSTATE", "/storage/app/media", "Drupal", "goazimut", "elementor-tab-title", "panel panel-default", "<table", "youtu.be", "pv-list")
SYSTEMS = ("unknown", "WordPress", "GestionWeblex", "ASP.NET", "October", "Drupal", "GoNet/GoAzimut", "unknown", "unknown", "unknown", "unknown", "unknown")
LAYOUTS = ("flat-html-list",) * 7 + ("wordpress-elementor-accordion", "bootstrap-panel", "static-table", "youtube-paired", "custom-session-list")
OWN = " OR ".join(f"contains(html, '{m}')" for _, marks in (*SG.CMS, *SG.FAMILIES) for m in marks)


@query(f"SELECT page_id, {sql_list(SYSTEMS)}[page_id % 12 + 1] AS system, {sql_list(LAYOUTS)}[page_id % 12 + 1] AS layout FROM pages WHERE NOT ({OWN})")
def site_systems(spark, sf_dir):
    """Whole pages that hold no mark of their own, each with one mark at its end."""
    p = table(spark, sf_dir, "pages")
    plain = p.filter((SG.first_marked("html", SG.CMS, "") == "") & (SG.first_marked("html", SG.FAMILIES, "") == ""))
    marked = plain.select("page_id", "url", F.concat("html", _cycle(MARKS, F.col("page_id"))).alias("html"))
    return marked.select("page_id", SG.cms("url", "html").alias("system"), SG.structural_family("html").alias("layout"))


@query("""WITH c AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS i, s_nationkey = 3 AS hinted FROM supplier), t AS (SELECT *, hinted OR i % 10 >= 7 AS second FROM c), n AS (SELECT *, row_number() OVER (PARTITION BY second ORDER BY s_suppkey) - 1 AS turn FROM t)
SELECT s_suppkey, CASE WHEN second THEN 'codex' ELSE 'sonnet' END AS tier, CASE WHEN second THEN ['x1', 'x2'][turn % 2 + 1] ELSE ['a1', 'a2', 'a3'][turn % 3 + 1] END AS account FROM n""")
def hard_case_plan(spark, sf_dir):
    c = table(spark, sf_dir, "supplier").select("s_suppkey", F.when(F.col("s_nationkey") == 3, "codex").alias("hint"), F.col("s_suppkey").alias("at"))
    return SG.work_plan(c, "s_suppkey", "at", "hint", ["a1", "a2", "a3"], ["x1", "x2"])


@query("""SELECT p_partkey, array_to_string(list_transform(string_split(p_brand || '.' || replace(p_name, ' ', '"'), '.'), lambda x: '"' || replace(x, '"', '""') || '"'), '.') AS name FROM part""")
def quoted_names(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", SG.quoted_name(F.concat("p_brand", F.lit("."), F.translate("p_name", " ", '"'))).alias("name"))
