"""Pages, documents, notices and minutes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from geoloom.functions import quantities as Q
from geoloom.functions import text as TX
from geoloom.operators import extract as X
from geoloom.operators import gates as GA
from geoloom.operators import pages as PG
from geoloom.operators import signals as SG

from .registry import FOLD, query, table

SITE = r"nullif(regexp_replace(lower(regexp_extract({}, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)', 1)), '^www\.', ''), '')"
ANCHORS = """regexp_extract_all(html, '(?i)<a\\s[^>]*href=["'']([^"'']*)["''][^>]*>', 1)"""


@query(f"WITH a AS (SELECT page_id, unnest({ANCHORS}) AS href, generate_subscripts({ANCHORS}, 1) - 1 AS pos FROM pages) SELECT page_id, href, min(pos)::INT AS pos FROM a WHERE href <> '' GROUP BY page_id, href")
def html_anchors(spark, sf_dir):
    return X.anchors(table(spark, sf_dir, "pages"), "page_id", "html")


@query(f"""SELECT page_id, {SITE.format('url')} AS site, regexp_matches(url, '(?i)\\.(?:pdf|docx?|odt)(?:[?#].*)?$') OR regexp_matches(url, '(?i)[?&](?:download|telechargement|getfile|fichier|file|attachment)=') OR regexp_matches(url, '(?i)/(?:download|telecharger|getfile|fichier)[/?]') AS is_document FROM pages""")
def site_of_url(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", TX.site_of("url").alias("site"), TX.is_document_href("url").alias("is_document"))


@query("SELECT page_id, len(list_distinct(regexp_extract_all(html, 'https?://[^\\s\"''<>)]+'))) AS n_urls FROM pages")
def page_urls(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.size(TX.urls_in("html")).cast("long").alias("n_urls"))


def _decode(expr: str) -> str:
    for p, by in TX.ENTITIES:
        expr = f"regexp_replace({expr}, '{p}', '{by.replace(chr(39), chr(39) * 2)}', 'g')"
    return f"trim(regexp_replace({expr}, '[\\s ﻿]+', ' ', 'g'))"


STRIPPED = _decode("regexp_replace(html, '<[^>]+>', ' ', 'g')")


@query(f"SELECT page_id, {STRIPPED} AS text FROM pages")
def strip_tags_decode(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", TX.strip_tags("html").alias("text"))


def _weights(expr: str) -> str:
    return " + ".join(f"CASE WHEN regexp_matches({expr}, '{p}') THEN {w} ELSE 0 END" for p, w in WEIGHTS)


# words that the stand-in documents hold
WEIGHTS = ((r"\bthe\b", 6), (r"\bdes?\b", 5), (r"\bund\b", 3), ("tion", 1), ("ing", -3), (r"\bof\s+the", -2))


@query(f"SELECT doc_id, ({_weights(FOLD.format('text'))})::INT AS score FROM documents")
def keyword_score(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", GA.weighed(WEIGHTS, TX.fold(F.regexp_replace("text", r"\p{M}", ""))).alias("score"))


@query("SELECT page_id, (page_id % 3 = 0)::INT * 19 + (page_id % 3 = 1)::INT * 5 + (page_id % 3 = 2)::INT * -4 AS score FROM pages")
def grid_link_score(spark, sf_dir):
    k = F.col("page_id") % 3
    title = F.when(k == 0, "Grilles des spécifications — règlement de zonage").when(k == 1, "Plan d'urbanisme, annexe : zonage").otherwise("Procès-verbal")
    return table(spark, sf_dir, "pages").select("page_id", GA.grid_score(title, F.lit("")).alias("score"))


TITLES = ("Dérogation mineure, 12 rue A", "Projet PPCMOI no 4", "Avis de registre", "AEV_REG_2026-11", "Assemblée publique de consultation", "Projet de règlement 12-3", "Aliénation de terrain", "Vente pour défaut de paiement", "Avis", "ProjetReg 5")
KINDS = ("derogation-mineure", "ppcmoi", "registre-referendaire", "entree-en-vigueur", "consultation", "projet-reglement", "alienation", "vente-pour-taxes", "autre", "projet-reglement")


@query(f"SELECT p_partkey, {list(KINDS)}[p_partkey % 10 + 1] AS kind FROM part")
def ordered_keyword_case(spark, sf_dir):
    title = F.element_at(F.array(*map(F.lit, TITLES)), (F.col("p_partkey") % 10 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", GA.notice_type(title).alias("kind"))


@query("""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'ordre-du-jour' WHEN page_id % 3 = 1 THEN 'proces-verbal' ELSE 'document' END AS doc_type, CASE WHEN page_id % 4 = 0 THEN 'arcgis' WHEN page_id % 4 = 1 THEN 'gonet' WHEN page_id % 4 = 2 THEN 'ckan' ELSE 'unknown' END AS platform FROM pages""")
def document_and_platform(spark, sf_dir):
    k, m = F.col("page_id") % 3, F.col("page_id") % 4
    label = F.when(k == 0, "Ordre du jour de la séance").when(k == 1, "Séance du conseil").otherwise("Plan")
    link = F.when(m == 0, "https://x.org/arcgis/rest/services/a").when(m == 1, "https://goazimut.com/m").when(m == 2, "https://x.org/api/3/action/package_search").otherwise("https://x.org/")
    return table(spark, sf_dir, "pages").select("page_id", GA.doc_type(label, F.lit("a.pdf")).alias("doc_type"), GA.platform(link).alias("platform"))


LABELS = ("Séance du 1er octobre 2025", "PV 2025-03-10", "Procès-verbal de mars 2025", "pv-2025_03.pdf", "Sans date", "10 août 2024 (suite)")
DATES = ("2025-10-01", "2025-03-10", "2025-03", "2025-03", "non-disponible", "2024-08-10")


@query(f"SELECT o_orderkey, {list(DATES)}[o_orderkey % 6 + 1] AS date, strftime(o_orderdate, '%Y-%m-%d') AS french, strftime(o_orderdate, '%Y-%m-%d') AS file_date FROM orders")
def date_cascade(spark, sf_dir):
    label = F.element_at(F.array(*map(F.lit, LABELS)), (F.col("o_orderkey") % 6 + 1).cast("int"))
    months = F.array(*map(F.lit, ("janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre")))
    d = F.col("o_orderdate")
    long = F.concat_ws(" ", F.dayofmonth(d).cast("string"), F.element_at(months, F.month(d)), F.year(d).cast("string"))
    name = F.when(F.year(d) >= 2000, F.concat(F.lit("x "), F.dayofmonth(d).cast("string"), F.lit("-"), F.month(d).cast("string"), F.lit("-"), F.date_format(d, "yyyy"))).otherwise(F.date_format(d, "yyyy-MM-dd"))
    file = F.coalesce(Q.file_date(name), F.date_format(d, "yyyy-MM-dd"))
    return table(spark, sf_dir, "orders").select("o_orderkey", Q.label_date(label).alias("date"), Q.french_date(long).alias("french"), file.alias("file_date"))


RULES = (("a", "/en/", False), ("a", "/en/1", True), ("b", "/", False), ("b", "/*/2", True), ("b", "/fr/*.html$", True))


@query(r"""WITH p AS (SELECT page_id, regexp_extract(url, '://[^/]*([^?#]*)', 1) AS path FROM pages)
SELECT page_id, path, CASE WHEN page_id % 2 = 0 THEN CASE WHEN starts_with(path, '/en/1') THEN true WHEN starts_with(path, '/en/') THEN false ELSE true END ELSE regexp_matches(path, '^/.*/2') OR regexp_matches(path, '^/fr/.*\.html$') END AS allowed FROM p""")
def robots_longest_match(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", r"://[^/]*([^?#]*)", 1).alias("path"), F.when(F.col("page_id") % 2 == 0, "a").otherwise("b").alias("grp"))
    return GA.robots_allowed(p, RULES).select("page_id", "path", "allowed")


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS page FROM documents), f AS (SELECT doc_id, page, regexp_matches(line, 'tion') AS hit FROM l)
SELECT doc_id, count(*) AS n_pages, count(*) FILTER (hit) AS n_hits, min(page) FILTER (hit)::BIGINT AS first_page, max(page) FILTER (hit)::BIGINT AS last_page, CASE WHEN count(*) FILTER (hit) > 0 THEN floor(count(*) FILTER (hit) * 1000.0::DOUBLE / (max(page) FILTER (hit) - min(page) FILTER (hit) + 1) + 0.5) / 1000 ELSE 0 END AS confidence FROM f GROUP BY doc_id""")
def page_signal_aggregate(spark, sf_dir):
    return X.located_pages(table(spark, sf_dir, "documents"), "doc_id", "text", "\n", "tion")


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents), f AS (SELECT doc_id, trim(line) AS line, min(pos) AS pos FROM l WHERE trim(line) <> '' AND NOT regexp_matches(trim(line), '^[0-9]+$') GROUP BY doc_id, trim(line))
SELECT doc_id, md5(string_agg(line, ' ' ORDER BY pos)) AS plain_md5 FROM f GROUP BY doc_id""")
def line_dedupe(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", X.caption_text("text").alias("plain"))
    return d.filter("plain <> ''").select("doc_id", F.md5(F.col("plain").cast("binary")).alias("plain_md5"))


@query(r"""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN ['12-345', '98-7'] WHEN 1 THEN ['2020-11'] ELSE [] END AS bylaws FROM part""".replace("AS bylaws", "::VARCHAR[] AS bylaws").replace("END ::", "END::"))
def bylaw_numbers(spark, sf_dir):
    k = F.col("p_partkey") % 3
    text = F.when(k == 0, "Le règlement numéro 12-345 de zonage modifie le règlement no 98-7 et le règlement 12-345").when(k == 1, "RÈGLEMENT 2020-11 relatif au zonage").otherwise("Aucun numéro")
    return table(spark, sf_dir, "part").select("p_partkey", X.bylaws(text).alias("bylaws"))


@query()
def context_window_detector(spark, sf_dir):
    """Minutes stand-ins: a notice of motion about zoning is put into every second document, between its first 300 characters and the rest."""
    k = F.col("doc_id")
    text = F.concat(F.substring("text", 1, 300), F.lit("\n\nAvis de motion est donné par le conseiller pour le règlement numéro "), (k % 900 + 100).cast("string"), F.lit("-"), (k % 90 + 10).cast("string"), F.lit(" modifiant le règlement de zonage numéro 77-12 afin de créer la zone H-"), (k % 50 + 1).cast("string"), F.lit(".\n\n"), F.col("text").substr(F.lit(301), F.length("text")))
    return table(spark, sf_dir, "documents").select("doc_id", X.zoning_change(F.when(k % 2 == 0, text).otherwise(F.col("text"))).alias("z")).select("doc_id", "z.*")


@query("""WITH r AS (SELECT p_partkey, p_size AS s, unnest(['H-1', 'C-2']) AS zone_code FROM part WHERE p_size > 0), f AS (SELECT *, unnest(['marge_avant_min', 'hauteur_etages']) AS field FROM r),
c AS (SELECT *, CASE WHEN field = 'hauteur_etages' THEN CASE WHEN zone_code = 'H-1' THEN '2' ELSE (s % 9)::VARCHAR END WHEN zone_code = 'H-1' THEN s || ' m' ELSE 'Note 5' END AS raw FROM f)
SELECT p_partkey, zone_code, field, raw, CASE WHEN raw = 'Note 5' THEN NULL WHEN field = 'hauteur_etages' THEN raw::DOUBLE ELSE s::DOUBLE END AS value, CASE WHEN field = 'marge_avant_min' AND zone_code = 'H-1' THEN 'm' END AS unit FROM c""")
def grid_pages(spark, sf_dir):
    """Markdown grids built from parts: zones in columns, one row a field; to one row for each zone and field."""
    p = table(spark, sf_dir, "part").filter("p_size > 0").select("p_partkey", F.concat(F.lit("| Norme | H-1 | C-2 |\n|---|---|---|\n| Marge avant min. | "), F.col("p_size").cast("string"), F.lit(" m | Note 5 |\n| Hauteur max. en étages | 2 | "), (F.col("p_size") % 9).cast("string"), F.lit(" |\n")).alias("page"))
    return X.markdown_zones(p, "p_partkey", "page")


@query("SELECT page_id, href, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, pos) AS rank FROM (SELECT page_id, href, min(pos) AS pos, length(href) AS score FROM (SELECT page_id, unnest(" + ANCHORS + ") AS href, generate_subscripts(" + ANCHORS + ", 1) - 1 AS pos FROM pages) WHERE href <> '' GROUP BY page_id, href) QUALIFY rank <= 5")
def ranked_subpages(spark, sf_dir):
    a = X.anchors(table(spark, sf_dir, "pages"), "page_id", "html").withColumn("score", F.length("href"))
    rank = F.row_number().over(Window.partitionBy("page_id").orderBy(F.desc("score"), "pos"))
    return a.withColumn("rank", rank.cast("long")).filter("rank <= 5").select("page_id", "href", "rank")


LINK_LABELS = ("Grille des spécifications", "Plan de zonage", "Service d'urbanisme", "Règlements", "Loisirs", "Nous joindre", "Règlement de zonage", "Règlement modifiant le zonage")


def _site_links(spark, sf_dir):
    """Every link of every page, named by its place as on a town's site; every second one is a PDF file, every fifth is on another site."""
    rows = table(spark, sf_dir, "pages").select("page_id", "url", F.posexplode(TX.anchors("html")).alias("pos", "href")).filter("href <> ''")
    turn = F.col("page_id") + F.col("pos")
    site = F.when(turn % 5 == 0, "https://autre.example.org").otherwise(F.regexp_extract("url", "^[a-z]+://[^/?#]+", 0))
    address = F.concat(site, F.col("href"), F.when(F.col("pos") % 2 == 0, ".pdf").otherwise(""))
    return rows.select("page_id", "url", address.alias("address"), F.element_at(F.array(*map(F.lit, LINK_LABELS)), (turn % len(LINK_LABELS) + 1).cast("int")).alias("label"), "pos")


LINKS = f"""a AS (SELECT page_id, url, unnest({ANCHORS}) AS href, generate_subscripts({ANCHORS}, 1) - 1 AS pos FROM pages),
l AS (SELECT page_id, url, CASE WHEN (page_id + pos) % 5 = 0 THEN 'https://autre.example.org' ELSE regexp_extract(url, '^[a-z]+://[^/?#]+') END || href || CASE WHEN pos % 2 = 0 THEN '.pdf' ELSE '' END AS address,
  list_extract([{", ".join("'" + x.replace("'", "''") + "'" for x in LINK_LABELS)}], (page_id + pos) % {len(LINK_LABELS)} + 1) AS label, pos FROM a WHERE href <> ''),
f AS (SELECT *, {FOLD.format("concat_ws(' ', label, address)")} AS said FROM l)"""


def _sum_of(spec) -> str:
    return " + ".join("regexp_matches(said, '" + p.replace("'", "''") + f"')::INT * {w}" for p, w in spec)


@query(rf"""WITH {LINKS}, s AS (SELECT page_id, address, label, pos, {_sum_of(GA.GRID_WEIGHTS)} AS score FROM f WHERE regexp_matches(address, '(?i)\.pdf(?:[?#].*)?$')),
b AS (SELECT page_id, address, arg_min(label, (-score, pos)) AS label, max(score)::INT AS score, arg_min(pos, (-score, pos)) AS pos FROM s WHERE score >= 4 GROUP BY page_id, address)
SELECT page_id, address, label, score, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, pos) AS rank FROM b""")
def grid_files(spark, sf_dir):
    return SG.grid_links(_site_links(spark, sf_dir), "page_id", "address", "label", "pos").withColumn("rank", F.col("rank").cast("long"))


@query(rf"""WITH {LINKS}, s AS (SELECT page_id, address, label, pos, 1 + regexp_matches(said, 'grille|specification')::INT * 4 + regexp_matches(said, 'zonage')::INT * 3 + regexp_matches(said, 'urbanism')::INT * 2 + regexp_matches(said, 'reglement')::INT AS score FROM f
  WHERE (page_id + pos) % 5 <> 0 AND address <> url AND NOT regexp_matches(address, '(?i)\.(pdf|docx?|odt)([?#].*)?$') AND regexp_matches(said, 'urbanism|zonage|reglement|amenagement|grille|specification|permis')
  AND NOT regexp_matches(said, 'facebook|twitter|instagram|linkedin|youtube|mailto:|tel:|/(en|es)/|login|connexion|panier|cart')),
b AS (SELECT page_id, address, arg_min(label, pos) AS label, arg_min(score, pos)::INT AS score, min(pos) AS pos FROM s GROUP BY page_id, address)
SELECT page_id, address, label, score, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, pos) AS rank FROM b QUALIFY rank <= 5""")
def followed_pages(spark, sf_dir):
    return SG.subpages(_site_links(spark, sf_dir), "page_id", "url", "address", "label", "pos").withColumn("rank", F.col("rank").cast("long"))


def _grid_file() -> str:
    """Each document's whole text and, on pages of their own, lines made from its id: tables, heads, banners, legal text, prose, blank pages."""
    n, b = "doc_id % {}", "chr({})".format
    made = (
        ("'Grille des spécifications'", b(10), "'Marge avant minimale (m) '", n.format(9), b(10), "'a) Hauteur max. 2 étages'", f"CASE WHEN {n.format(3)} = 1 THEN ';' ELSE '' END", b(10), "'Zone : H-'", n.format(70), b(10), "'Largeur minimale (m) 12'"),
        ("'Zones H-'", "doc_id * 37 % 2000", "' H-'", n.format(77), "', AG-'", n.format(55)),
        ("'Numéros  de zones 101 '", "doc_id * 37 % 20000", "' 104'"),
        (f"CASE WHEN {n.format(3)} = 0 THEN 'USAGES' ELSE 'GRILLES DES USAGES' END", b(10), "'No zone R-'", n.format(50), "' 102'"),
        ("'Avis de motion : règlement '", n.format(90)),
        ("'Les zones H-1, H-2, H-'", n.format(90), "' sont.'", b(12), b(12), "'Séance du conseil'"),
        ("'Usage Lotissement LARGEUR Superficie Hauteur'", f"CASE WHEN {n.format(3)} = 0 THEN ' marges' ELSE ' Marge' END"),
        ("'Grilles d e s  spécification'", b(10), "'Marge max. 1'", b(10), "'Densité max. 1'", b(10), "'Emprise max. '", f"CASE WHEN {n.format(3)} = 0 THEN 'x' ELSE '4' END"),
    )
    page = " ".join(f"WHEN {n.format(len(made) + 2)} = {i} THEN concat({', '.join(parts)})" for i, parts in enumerate(made))
    blank = f"repeat({b(12)}, CASE WHEN {n.format(3)} = 0 THEN 60 ELSE 0 END)"
    return f"concat(coalesce(text, ''), {b(12)}, CASE {page} ELSE '' END, {blank})"


GRID_FILE = _grid_file()


LOW = FOLD.format("x")
PROSE_LINE = r"regexp_matches(x, '[;.]\s*$') AND contains(x, ',')"
CODE_WORDS = r"list_distinct(list_filter(list_transform(string_split_regex(trim(x), '\s+'), lambda w: regexp_replace(w, '[,;]+$', '')), lambda w: regexp_matches(w, '^[A-Z]{1,3}-?[0-9]{1,3}[a-z]?$')))"
PAGE_SIGNALS = rf"""f AS (SELECT doc_id, string_split({GRID_FILE}, chr(12)) AS l FROM documents),
g AS (SELECT doc_id, CASE WHEN l[-1] = '' THEN l[1:len(l) - 1] ELSE l END AS l FROM f),
p AS (SELECT doc_id, unnest(l) AS page, generate_subscripts(l, 1) AS n FROM g),
r AS (SELECT doc_id, n, page, regexp_replace({FOLD.format('page')}, '\s+', ' ', 'g') AS plain, string_split(page, chr(10)) AS lines FROM p),
c AS (SELECT *, len(list_filter(lines, lambda x: regexp_matches({LOW}, '{PG.NORM}') AND regexp_matches({LOW}, '{PG.QUALIFIER}') AND regexp_matches(x, '{PG.CELL}') AND NOT ({PROSE_LINE}) AND NOT (regexp_matches(x, '[;.]\s*$') AND regexp_matches(x, '{PG.POINT}')))) AS n_rows,
 len(list_filter(lines, lambda x: len({CODE_WORDS}) >= 3 AND 2 * len({CODE_WORDS}) >= len(string_split_regex(trim(x), '\s+')) AND NOT ({PROSE_LINE}))) AS heads FROM r),
s AS (SELECT doc_id, n, length(page) AS chars, n_rows >= 3 AND regexp_matches(replace(plain, ' ', ''), '{PG.TITLE}') AS title_table,
 {' + '.join(f"regexp_matches(page, '(?i){h}')::INT" for h in PG.HEADINGS)} >= 6 AS native,
 len(list_filter(lines, lambda x: regexp_matches(regexp_replace({LOW}, '\s+', ' ', 'g'), '{PG.NUMBERED}'))) > 0 OR heads >= 2 OR (heads = 1 AND (n_rows > 0 OR regexp_matches(plain, '{PG.CONTEXT}'))) AS zone_header,
 regexp_matches(plain, '{PG.WIDE_TITLE}') AND (heads > 0 OR n_rows >= 3 OR len(list_filter(lines, lambda x: regexp_matches(x, '{PG.BANNER}'))) > 0) AS title_gated,
 len(list_filter(lines, lambda x: regexp_matches({LOW}, '{PG.OWN_ZONE}'))) > 0 AS own_zone, regexp_matches(plain, '{PG.LEGAL}') AS legal FROM c)"""


@query(f"""WITH {PAGE_SIGNALS}, t AS (SELECT doc_id, count(*) AS n_pages, sum(chars) AS n_chars, count(*) FILTER (title_table) AS n_title_table, count(*) FILTER (native) AS n_native, count(*) FILTER (zone_header) AS n_zone_header, count(*) FILTER (legal) AS n_legal,
 count(*) FILTER (title_table OR native OR zone_header OR title_gated) AS n_grid, coalesce(min(n) FILTER (title_table OR native OR zone_header OR title_gated), 0) AS first_grid, coalesce(max(n) FILTER (title_table OR native OR zone_header OR title_gated), 0) AS last_grid,
 coalesce(min(n) FILTER (zone_header), 0) AS first_header, coalesce(max(n) FILTER (zone_header), 0) AS last_header FROM s GROUP BY doc_id)
SELECT doc_id, CASE WHEN coalesce(n_grid, 0) > 0 THEN 'grille' WHEN coalesce(n_chars / n_pages, 0) < 60 THEN 'plan-image' WHEN n_legal > 0 THEN 'reglement' ELSE 'unknown' END AS kind, coalesce(n_pages, 0)::INT AS n_pages, coalesce(n_chars, 0)::BIGINT AS n_chars,
 coalesce(floor(n_chars / n_pages * 10 + 0.5) / 10, 0)::DOUBLE AS density, {', '.join(f'coalesce({k}, 0)::INT AS {k}' for k in ('n_title_table', 'n_native', 'n_zone_header', 'n_grid', 'first_grid', 'last_grid', 'first_header', 'last_header', 'n_legal'))} FROM (SELECT doc_id FROM documents) LEFT JOIN t USING (doc_id)""")
def document_classes(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", PG.document_class(F.expr(GRID_FILE)).alias("c")).select("doc_id", "c.*")


@query(f"""WITH {PAGE_SIGNALS} SELECT doc_id, min(n)::INT AS first_page, max(n)::INT AS last_page, count(*)::INT AS n_pages, CASE WHEN 2 * count(*) FILTER (own_zone) >= count(*) THEN 'one-zone-per-page' ELSE 'multi-zone-per-page' END AS layout,
 floor(count(*)::DOUBLE / (max(n) - min(n) + 1) * 1000 + 0.5) / 1000 AS confidence FROM s WHERE title_table GROUP BY doc_id""")
def grid_spans(spark, sf_dir):
    spans = table(spark, sf_dir, "documents").select("doc_id", PG.grid_span(F.expr(GRID_FILE)).alias("g"))
    return spans.filter("g IS NOT NULL").select("doc_id", "g.*")
