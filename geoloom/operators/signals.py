"""Predicates and readings of labels, links, pages and logs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.functions.text import col, fold, is_document_href, same_site, site_of
from geoloom.operators.gates import grid_score, weighed


# ---------------------------------------------------------------- zone labels


def looks_like_zone(c) -> Column:
    s = F.trim(col(c))
    return F.length(s).between(1, 12) & (s.rlike(r"^[A-Za-z]{0,4}[ .-]?\d{1,4}(?:[ .-]?\d{1,3})?$") | s.rlike("^[A-Za-z]-?[A-Za-z0-9]{1,3}$"))


def zone_shape(c) -> Column:
    s = F.trim(col(c))
    return F.when(s.rlike(r"^\d{1,4}-[A-Za-z]{1,5}$"), "num-alpha").when(s.rlike(r"^[A-Za-z]{1,4}[-.]?\d{1,4}[A-Za-z]?$"), "alpha-num").otherwise("other")


# Words on plans that are no zones (streets, legends, notes).
STOPWORDS = (
    "rue", "rte", "route", "chemin", "boulevard", "ave", "avenue", "ch", "blvd", "rang", "montee", "montée", "côte", "cote", "nord", "sud", "est", "ouest", "n", "s", "e", "o", "km", "m", "ha", "ft",
    "plan", "de", "du", "des", "le", "la", "les", "zonage", "zone", "zones", "affectation", "règlement", "reglement", "echelle", "légende", "legende", "annexe", "titre", "date", "source", "projection",
    "datum", "note", "page",
)


def zone_label(c) -> Column:
    """Whether a label of a plan may be a zone: short, no common word, no long number, no measure, and of a zone's form."""
    s = F.trim(col(c))
    return F.length(s).between(1, 24) & ~F.lower(s).isin(*STOPWORDS) & ~s.rlike(r"^\d{5,}$") & ~s.rlike(r"(?i)^\d+\.?\d*m$") & ~s.rlike(r"^\d+$") & looks_like_zone(s)


def dominant_shape(labels: DataFrame, doc: str, text: str) -> DataFrame:
    """Of documents with 8 labels or more, one shape of which has 5 and 70 %, only that shape's labels; others whole."""
    shaped = labels.withColumn("ds_shape", zone_shape(text))
    n = shaped.groupBy(doc, "ds_shape").agg(F.count("*").alias("n"))
    tot = n.groupBy(doc).agg(F.sum("n").alias("t"), F.max_by("ds_shape", F.when(F.col("ds_shape") != "other", F.col("n"))).alias("top"), F.max(F.when(F.col("ds_shape") != "other", F.col("n"))).alias("m"))
    keep = tot.select(F.col(doc).alias("ds_doc"), F.when((F.col("t") >= 8) & (F.col("m") >= 5) & (F.col("m") >= 0.7 * F.col("t")), F.col("top")).alias("ds_only"))
    return shaped.join(keep, F.col(doc) == F.col("ds_doc")).filter(F.col("ds_only").isNull() | (F.col("ds_only") == F.col("ds_shape"))).select(*labels.columns)


def zone_tokens(c) -> Column:
    """Number of distinct tokens with a letter and a digit."""
    return F.size(F.array_distinct(F.filter(F.split(F.upper(col(c)), r"[^A-Z0-9-]+"), lambda t: t.rlike("[A-Z]") & t.rlike("[0-9]")))).cast("long")


def code_header(c) -> Column:
    """Whether a line heads zone columns: three distinct codes, half of the tokens at least, no prose."""
    words = F.filter(F.split(F.trim(col(c)), r"\s+"), lambda t: t != "")
    codes = F.filter(words, lambda t: t.rlike(r"^[A-Za-z]{1,4}-?\d{1,4}(?:-\d{1,3})?$"))
    prose = F.filter(words, lambda t: t.rlike("^[a-zà-ÿ]{3,}$"))
    return (F.size(F.array_distinct(codes)) >= 3) & (F.size(codes) * 2 >= F.size(words)) & (F.size(prose) <= 2)


# ---------------------------------------------------------------- links


def has_keyword(c, words: list[str]) -> Column:
    """Any of the words stands in the text; no words: true."""
    if not words:
        return F.lit(True)
    s, out = F.lower(col(c)), F.lit(False)
    for w in words:
        out = out | F.contains(s, F.lit(w.lower()))
    return out


# What a notice's title says when it is about zoning.
ZONING_WORDS = ["ppcmoi", "règlement de zonage", "reglement de zonage", "changement de zonage", "changement de zone", "projet de règlement", "projet de reglement"]


def zoning_notice(kind, title) -> Column:
    return (col(kind) == "ppcmoi") | has_keyword(title, ZONING_WORDS)


def plan_link(label, url) -> Column:
    hay = fold(F.concat_ws(" ", col(label), col(url)))
    return F.lower(col(url)).rlike(r"\.pdf(?:[?#]|$)") & hay.rlike("plan.{0,20}zon|zon.{0,20}plan|carte") & ~hay.rlike("urgence|strategique|triennal|evacuation")


def minutes_links(anchors: DataFrame, page: str, base: str, url: str, label: str, order: str) -> DataFrame:
    """Anchors that lead to minutes: documents, or pages of the same site whose label says so; no agenda; the first anchor of an address."""
    said = fold(F.concat_ws(" ", label, url))
    doc = is_document_href(url)
    minutes = said.rlike(r"proces[-\s_]?verba|\bpv\b|seance|procesverba")
    kept = anchors.filter(minutes & ~said.rlike(r"ordre[\s_-]+du[\s_-]+jour|\bodj\b|agenda") & (doc | same_site(url, base)))
    return kept.groupBy(page, F.col(url).alias("minutes_url")).agg(F.min_by(label, order).alias("label"), F.min(order).alias("pos"))


def grid_links(links: DataFrame, page: str, url: str, label: str, order: str, least: int = 4) -> DataFrame:
    """page, url, label, score, rank: PDF files whose label and address score ``least`` or more as a zoning grid, best first; an address once, with its best label."""
    scored = links.filter(F.col(url).rlike(r"(?i)\.pdf(?:[?#].*)?$")).withColumn("gl_score", grid_score(label, url)).filter(F.col("gl_score") >= least)
    place = F.struct((-F.col("gl_score")).alias("s"), F.col(order).alias("o"))
    best = scored.groupBy(page, url).agg(F.min_by(label, place).alias(label), F.max("gl_score").alias("score"), F.min(place)["o"].alias("gl_pos"))
    return best.withColumn("rank", F.row_number().over(Window.partitionBy(page).orderBy(F.desc("score"), "gl_pos"))).drop("gl_pos")


# Words of links worth following from a page, and of those that are not; hints and their scores. All on folded text.
FOLLOWED = "urbanism|zonage|reglement|amenagement|grille|specification|permis"
SKIPPED = r"facebook|twitter|instagram|linkedin|youtube|mailto:|tel:|/(?:en|es)/|login|connexion|panier|cart"
HINTS = (("grille|specification", 4), ("zonage", 3), ("urbanism", 2), ("reglement", 1))


def subpages(links: DataFrame, page: str, base: str, url: str, label: str, order: str, most: int = 5) -> DataFrame:
    """page, url, label, score, rank: up to ``most`` pages of the same site (but the page itself and documents) that may lead to a zoning grid, best hints first."""
    said = fold(F.concat_ws(" ", label, url))
    fine = (site_of(url) == site_of(base)) & (F.col(url) != F.col(base)) & ~F.col(url).rlike(r"(?i)\.(?:pdf|docx?|odt)(?:[?#].*)?$")
    kept = links.filter(fine & ~said.rlike(SKIPPED) & said.rlike(FOLLOWED))
    # the first link of an address stands for it
    place = F.struct(F.col(order).alias("o"))
    first = kept.groupBy(page, url).agg(F.min_by(F.struct(F.col(label).alias("label"), (weighed(HINTS, said) + 1).alias("score")), place).alias("sp"), F.min(order).alias("sp_pos"))
    named = first.select(page, url, F.coalesce(F.nullif("sp.label", F.lit("")), F.col(url)).alias(label), F.col("sp.score").alias("score"), "sp_pos")
    rank = F.row_number().over(Window.partitionBy(page).orderBy(F.desc("score"), "sp_pos"))
    return named.withColumn("rank", rank).filter(F.col("rank") <= most).drop("sp_pos")


def session_only(c) -> Column:
    """Whether a name is but a date and session words: at most two letters are left without them."""
    s = fold(col(c))
    for p in (r"\.pdf$", r"\d", "janvier|fevrier|mars|avril|mai|juin|juillet|aout|septembre|octobre|novembre|decembre", "seance|ordinaire|extraordinaire|proces|verbal|verbaux|conseil|pv"):
        s = F.regexp_replace(s, p, "")
    return F.length(F.regexp_replace(s, "[^a-z]", "")) <= 2


# Where a town may serve its maps.
MAP_HOSTS = ("https://cartes.{}.ca", "https://sig.{}.ca", "https://gis.{}.ca", "https://geomatique.{}.ca", "https://www.ville.{}.qc.ca", "https://ville.{}.qc.ca")


def _filled(pattern: str, by: Column) -> Column:
    before, after = pattern.split("{}")
    return F.concat(F.lit(before), by, F.lit(after))


def guessed_hosts(slug) -> Column:
    """Addresses at which a town's map server may be, by its slug."""
    return F.array(*[_filled(p, F.lower(col(slug))) for p in MAP_HOSTS])


def guessed_services(slug, website) -> Column:
    """Addresses of map services: those beside the town's own site (none if it is one itself), the site, and those by the slug; each once."""
    host = F.nullif(F.regexp_extract(F.lower(col(website)), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1), F.lit(""))
    bare, none = F.regexp_replace(host, r"^www\.", ""), F.array().cast("array<string>")
    beside = F.when(host.rlike(r"^(?:sig|gis)\."), none).otherwise(F.array(*[_filled(p, bare) for p in ("https://sig.{}", "https://gis.{}", "https://cartes.{}")]))
    own = F.when(host.isNotNull(), F.concat(beside, F.array(F.concat(F.lit("https://"), host)))).otherwise(none)
    return F.array_distinct(F.concat(own, F.array(*[_filled(p, F.lower(col(slug))) for p in ("https://sig.{}.ca", "https://gis.{}.ca")])))


# Systems behind sites and the marks of each in a page, in order.
CMS = (
    ("October", ("/storage/app/media",)), ("WordPress", ("/wp-content/uploads", "wp-json")), ("GestionWeblex", ("gestionweblex", "GestionWeblex")), ("GoNet/GoAzimut", ("goazimut", "gonet", "GoAzimut")),
    ("iDesign", ("idesign", "i-design")), ("Statamic", ("/statamic/", "Statamic")), ("October", ("October", "october-")), ("Drupal", ("/drupal", "Drupal")), ("ASP.NET", ("ASP.NET", "__VIEWSTATE")),
)
# Layouts of index pages and the marks of each, most specific first.
FAMILIES = (
    ("wordpress-elementor-accordion", ("elementor-accordion", "elementor-tab-title")), ("wordpress-fusion-accordion", ("fusion-panel", "fusion-accordian", "panel-collapse collapse")),
    ("wordpress-visual-composer", ("vc_tta-accordion", "vc_tta-panel", "sc_button")), ("wp-block-collapsible", ("act-collapsible", "wp-block-file")),
    ("october-cms-document-card", ("c-small-document-card", "c-document-card", "c-documents__item")), ("bootstrap-panel", ("panel panel-default", "pull-right rotate-plus")),
    ("drupal-files-table", ("/sites/default/files/", "bloc_de_texte")), ("custom-accordion", ("accordeon__content", "accordion__sub-rows", "seances-conseil-list")),
    ("custom-session-list", ("session-item", "seances-list", "pv-list", "avis_public_item")), ("static-table", ("<table",)), ("youtube-paired", ("youtu.be", "youtube.com/watch")),
)


def first_marked(c, table: tuple, otherwise: str) -> Column:
    """The name of the first entry one of whose marks stands in the text."""
    out = F.lit(otherwise)
    for name, marks in reversed(table):
        found = F.lit(False)
        for mark in marks:
            found = found | F.contains(col(c), F.lit(mark))
        out = F.when(found, name).otherwise(out)
    return out


def cms(url, html) -> Column:
    """The system behind a site, by its address and page."""
    return F.when(F.contains(col(url), F.lit("municipalites-du-quebec")), "municipalites-du-quebec.com").otherwise(first_marked(html, CMS, "unknown"))


def structural_family(html) -> Column:
    """The layout of an index page."""
    return first_marked(html, FAMILIES, "flat-html-list")


def needs_browser(html) -> Column:
    """Why a page can't be read as it comes: a challenge, or an empty root of an application."""
    s = F.lower(col(html))
    anchors = F.regexp_count(s, F.lit(r"<a\s"))
    return F.when(s.rlike("cf-challenge|just a moment|captcha"), "challenge").when(s.rlike("""<div id=["'](?:root|app|__next)["']>\\s*</div>""") & (anchors < 3) & (F.length(s) < 60_000), "application")


# Fixed value: fewer letters a page are a scan.
IMAGE_ONLY = 60


def pdf_class(docs: DataFrame) -> DataFrame:
    """kind of documents with n_grid, n_amendment, density (letters a page): grille, plan-image, reglement, unknown."""
    kind = F.when(F.col("n_grid") > 0, "grille").when(F.col("density") < IMAGE_ONLY, "plan-image").when(F.col("n_amendment") > 0, "reglement").otherwise("unknown")
    return docs.withColumn("kind", kind)


def gate(kind, bounded) -> Column:
    """Priority of a candidate document; plans and bylaws are out (missing)."""
    return F.when(~col(kind).isin("plan-image", "reglement"), F.when(col(bounded), 2).otherwise(0) + F.when(col(kind) == "grille", 1).otherwise(0))


def better_first(df: DataFrame, key: str) -> DataFrame:
    """Of a key's candidates, the one with the highest priority, then most pages, then score (ties: the first url)."""
    rank = F.struct((-F.col("priority")).alias("a"), (-F.col("pages")).alias("b"), (-F.col("score")).alias("c"), F.col("url"))
    return df.groupBy(F.col(key).alias("bf_key")).agg(F.min_by(F.struct(*df.columns), rank).alias("r")).select("r.*")


# ---------------------------------------------------------------- registry


def prioritised(cities: DataFrame, most_km: float | None = None, large: bool = False) -> DataFrame:
    out = cities.filter(~F.col("excluded") & (F.lit(large) | ~F.col("deprioritized")))
    return out if most_km is None else out.filter(F.col("distance_km") <= most_km)


def checked_registry(cities: DataFrame) -> DataFrame:
    """problems of each row: repeated slug (after its first row), empty slug or name, place off the globe, negative population."""
    again = F.count("*").over(Window.partitionBy("slug").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)) > 1
    tests = {"slug repeated": again, "slug empty": F.coalesce(F.trim("slug"), F.lit("")) == "", "name empty": F.coalesce(F.trim("name"), F.lit("")) == "", "lat off": ~F.col("lat").between(-90, 90), "lon off": ~F.col("lon").between(-180, 180), "population negative": F.col("population") < 0}
    return cities.withColumn("problems", F.array_compact(F.array(*[F.when(t, m) for m, t in tests.items()])))


def zone_property(fields: list[tuple[str, str]]) -> str | None:
    """Of (name, type), the field that holds zone codes: by its name, else a text field that says zone; land-use fields never."""
    import re

    plain = [(n, t) for n, t in fields if not re.search("affectation|grande.?aff", n, re.I)]
    for n, _ in plain:
        if re.search(r"^(?:no|num|code|cod|id)?_?zone(?:_?(?:code|no|num|id))?$|^zonage$|^etiquette$", n, re.I):
            return n
    return next((n for n, t in plain if "string" in t.lower() and re.search("zone", n, re.I)), None)


def log_fields(c) -> Column:
    """zones, published and cost of a run's last log line."""
    num = lambda p: F.nullif(F.regexp_extract(col(c), p, 1), F.lit("")).try_cast("double")
    return F.struct(num(r"zones[=: ]+(\d+)").cast("long").alias("zones"), num(r"published[=: ]+(\d+)").cast("long").alias("published"), num(r"cost[=: ]+\$?([\d.]+)").alias("cost"))


# ---------------------------------------------------------------- model answers


def model_json(c) -> Column:
    """The JSON of an answer, out of a fence if it has one; missing if it is none."""
    body = F.regexp_extract(col(c), r"(?s)```(?:json)?\s*(.*?)```", 1)
    return F.try_parse_json(F.when(body != "", body).otherwise(F.regexp_extract(col(c), r"(?s)(\{.*\}|\[.*\])", 1)))


def zone_answers(df: DataFrame, key: str | Sequence[str], answer: str) -> DataFrame:
    """zone_code, field, raw of {"zones": [{"zone_code", "fields": {...}}]} answers, after the key's columns."""
    keys = [key] if isinstance(key, str) else [*key]
    # outer, as Spark would read an answer once more to pass over those that hold nothing
    zones = df.select(*keys, F.explode_outer(F.try_variant_get(model_json(answer), "$.zones", "array<variant>")).alias("z"))
    named = zones.select(*keys, F.try_variant_get("z", "$.zone_code", "string").alias("zone_code"), F.try_variant_get("z", "$.fields", "map<string,string>").alias("f")).filter("zone_code IS NOT NULL")
    return named.select(*keys, "zone_code", F.explode_outer("f").alias("field", "raw")).filter("field IS NOT NULL")


def both_passes(a: DataFrame, b: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Cells of zones that both readings hold (zones seen once go), with the text of each.

    One shuffle by key and zone and no join: neither reading is bounded, and Spark's estimate of their size would have them broadcast. Only the second reading's texts of one cell are held at a time.
    """
    from geoloom.functions.text import canon_zone_code

    keys = [key] if isinstance(key, str) else [*key]
    side = lambda d, first: d.select(*keys, canon_zone_code("zone_code").alias("zone_code"), "field", "raw", F.lit(first).alias("bp_first"))
    first, text = F.col("bp_first"), F.struct("raw")
    named = reduce(and_, [F.col(k).isNotNull() for k in (*keys, "zone_code")])
    zone = Window.partitionBy(*keys, "zone_code").orderBy("field").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cell = Window.partitionBy(*keys, "zone_code", "field")
    seen = side(a, True).unionByName(side(b, False)).withColumns({"bp_a": F.max(F.when(named, first)).over(zone), "bp_b": F.max(F.when(named, ~first)).over(zone)}).filter("bp_a AND bp_b")
    paired = seen.withColumns({"bp_firsts": F.count(F.when(first, 1)).over(cell), "bp_seconds": F.collect_list(F.when(~first, text)).over(cell)}).filter("bp_first OR bp_firsts = 0")
    texts = paired.select(*keys, "zone_code", "field", F.when(first, F.col("raw")).alias("raw_a"), F.explode_outer(F.when(first, F.col("bp_seconds")).otherwise(F.array(text))).alias("bp_text"))
    return texts.select(*keys, "zone_code", "field", "raw_a", F.col("bp_text.raw").alias("raw_b"))


# ---------------------------------------------------------------- small readings


def pairs(c) -> Column:
    """slug=code lists, codes of four or five digits; others drop out."""
    rows = F.transform(F.split(col(c), ","), lambda x: F.struct(F.trim(F.substring_index(x, "=", 1)).alias("slug"), F.regexp_extract(x, r"=\s*(\d{4,5})\s*$", 1).alias("code")))
    return F.filter(rows, lambda r: (r["slug"] != "") & (r["code"] != ""))


def viewer_code(url) -> Column:
    """The municipality's code in a viewer's address, padded to five digits."""
    code = F.coalesce(F.nullif(F.regexp_extract(col(url), r"[?&]m=(\d{4,5})(?:&|$)", 1), F.lit("")), F.nullif(F.regexp_extract(col(url), r"[?/](\d{4,5})(?:[/?#]|$)", 1), F.lit("")))
    return F.lpad(code, 5, "0")


def channel_id(c) -> Column:
    return F.nullif(F.regexp_extract(col(c), r"(?:^|/channel/)(UC[A-Za-z0-9_-]{22})(?:$|[/?])", 1), F.lit(""))


def candidate_pages(index, hints: list[str]) -> Column:
    """Addresses to look at: the index page, its site's root, and the root with each hint; each once, in order."""
    root = F.regexp_extract(col(index), r"^(https?://[^/?#]+)", 1)
    return F.array_distinct(F.array(col(index), F.concat(root, F.lit("/")), *[F.concat(root, F.lit("/" + h.strip("/"))) for h in hints]))


def polygon_layers(names) -> Column:
    """Of layer names, those that may hold zone lines: no labels, no base map."""
    return F.filter(col(names), lambda n: fold(n).rlike("zon|limite") & ~fold(n).rlike("text|etiquet|label|cadas|rue|hydro|cote"))


def boosted(tracks, first: list[str]) -> Column:
    """Boosted tracks in front, both parts in their order."""
    t = col(tracks)
    return F.concat(F.filter(t, lambda x: x.isin(*first)), F.filter(t, lambda x: ~x.isin(*first)))


def spread(df: DataFrame, order: str, accounts: int) -> DataFrame:
    """Rows dealt to accounts by a hash of their key, whatever partition they are in."""
    return df.withColumn("account", F.pmod(F.xxhash64(order), F.lit(accounts)).cast("int"))


def work_plan(cases: DataFrame, key: str, order: str, hint: str, accounts: list[str], others: list[str]) -> DataFrame:
    """key, tier, account of each hard case: those hinted at ``codex`` and the last three of every ten go to the ``others`` in turn (if there are any), the rest to the accounts in turn.

    A case is a town at hand, so their number is bounded and the order is one small task's.
    """
    at = Window.orderBy(order)
    placed = cases.select(key, hint, order).withColumn("wp_at", F.row_number().over(at) - 1)
    second = (F.coalesce(F.col(hint) == "codex", F.lit(False)) | (F.col("wp_at") % 10 >= 7)) & F.lit(bool(others))
    turned = placed.withColumn("wp_second", second).withColumn("wp_turn", F.row_number().over(Window.partitionBy("wp_second").orderBy(order)) - 1)

    def of(names: list[str]) -> Column:
        return F.get(F.array(*map(F.lit, names)), (F.col("wp_turn") % len(names)).cast("int")) if names else F.lit(None).cast("string")

    return turned.select(key, F.when(F.col("wp_second"), "codex").otherwise("sonnet").alias("tier"), F.when(F.col("wp_second"), of(others)).otherwise(of(accounts)).alias("account"))


def quoted_name(c) -> Column:
    """A possibly schema-qualified name as an SQL identifier, each part in double quotes."""
    return F.array_join(F.transform(F.split(col(c), r"\."), lambda x: F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))), ".")


def seeded_sample(rows: list, n: int, seed: int) -> list:
    """A sample in a shuffled order that a seed repeats, by a linear congruential generator."""
    out, state = list(rows), seed & 0xFFFFFFFF
    for i in range(len(out) - 1, 0, -1):
        state = (state * 1664525 + 1013904223) & 0xFFFFFFFF
        j = state * (i + 1) >> 32
        out[i], out[j] = out[j], out[i]
    return out[:n]
