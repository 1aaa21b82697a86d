"""Extraction from pages, minutes, captions and grids."""

from __future__ import annotations

import re
from urllib.parse import quote, urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from geoloom.functions.quantities import field_of_label, measure, round_half_up
from geoloom.functions.text import col
from geoloom.functions import text as TX
from geoloom.operators.signals import needs_browser


def anchors(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, href, pos: each address of a page once, where it comes first."""
    rows = pages.select(key, F.posexplode(TX.anchors(html)).alias("pos", "href")).filter("href <> ''")
    return rows.groupBy(key, "href").agg(F.min("pos").alias("pos"))


_KEPT = "%/:=&?~+!$,;'@()*[]^|\\"


@pandas_udf(T.StringType())
def joined_url(base: pd.Series, href: pd.Series) -> pd.Series:
    """The address that a link leads to from a page, without its fragment; missing unless it is of the web."""

    def one(b: str | None, h: str | None) -> str | None:
        try:
            u = urlsplit(urljoin(b or "", (h or "").strip()))
        except ValueError:
            return None
        if u.scheme not in ("http", "https") or not u.netloc:
            return None
        return f"{u.scheme}://{u.netloc.lower()}{quote(u.path, safe=_KEPT) or '/'}" + (f"?{quote(u.query, safe=_KEPT)}" if u.query else "")

    return pd.Series([one(b, h) for b, h in zip(base, href)], dtype=object)


def links(pages: DataFrame, key: str, html: str, url: str) -> DataFrame:
    """key, page_url, href, label, pos: every link of a page with a text, its address joined to the page's base; none of pages that need a browser."""
    read = pages.filter(needs_browser(html).isNull())
    tags = F.regexp_extract_all(col(html), F.lit(r"(?is)<a\b[^>]*>.*?</a>"), F.lit(0))
    rows = read.select(key, F.col(url).alias("page_url"), F.regexp_extract(html, r"""(?i)<base\b[^>]*href=["']([^"']+)["']""", 1).alias("base"), F.posexplode(tags).alias("pos", "tag"))
    href = F.regexp_extract("tag", r"""(?i)^<a\b[^>]*?\shref=["']([^"'>]+)["']""", 1)
    label = TX.squish(F.regexp_replace(F.regexp_replace("tag", "(?i)^<a[^>]*>|</a>$", ""), "<[^>]+>", " "))
    rows = rows.select(key, "page_url", "base", href.alias("raw"), label.alias("label"), "pos").filter(~F.trim("raw").rlike("(?i)^(?:$|#|javascript:|mailto:|tel:|data:)"))
    base = F.when(F.col("base") == "", F.col("page_url")).otherwise(joined_url("page_url", "base"))
    return rows.select(key, "page_url", joined_url(F.coalesce(base, F.col("page_url")), F.col("raw")).alias("href"), "label", "pos").filter("href IS NOT NULL")


def located_pages(docs: DataFrame, key: str, text: str, breaker: str, pattern: str) -> DataFrame:
    """Pages of each document, those with a pattern, the first and last of these, and how densely they lie between."""
    rows = docs.select(key, F.posexplode(F.split(text, breaker)).alias("p", "page"))
    hit = F.when(F.col("page").rlike(pattern), F.col("p") + 1)
    got = rows.groupBy(key).agg(F.count("*").alias("n_pages"), F.count(hit).alias("n_hits"), F.min(hit).cast("long").alias("first_page"), F.max(hit).cast("long").alias("last_page"))
    share = F.when(F.col("n_hits") > 0, round_half_up(F.col("n_hits") / (F.col("last_page") - F.col("first_page") + 1), 3)).otherwise(0.0)
    return got.withColumn("confidence", share)


def caption_text(c) -> Column:
    """Captions to text: headers, cue times, counters and tags go; each line once."""
    lines = F.transform(F.split(F.regexp_replace(col(c), "<[^>]+>", ""), r"\r?\n"), lambda x: F.trim(x))
    keep = F.filter(lines, lambda x: (x != "") & ~x.rlike(r"^\d+$|-->|^WEBVTT|^NOTE\b|^(?:Kind|Language):"))
    return F.array_join(F.array_distinct(keep), " ")


_BYLAW = r"(?iu)r[èe]glement\s+(?:(?:de|d'|du|sur|relatif)\s+\w+\s+)?(?:n(?:um[ée]ro|[o°º])\.?\s*)?(\d{1,4}(?:-\d{1,5})+)"


def bylaws(c) -> Column:
    """Bylaw numbers, each once, in order."""
    return F.array_distinct(F.regexp_extract_all(col(c), F.lit(_BYLAW), F.lit(1)))


def bylaw_number(c) -> Column:
    return F.nullif(F.regexp_extract(col(c), r"(?iu)r[èe]glement\s+(?:n[o°º]\.?\s*|num[ée]ro\s+)?(\d{1,4}(?:-\d{1,5})?)", 1), F.lit(""))


def bylaw_title(c) -> Column:
    """From the number to the recitals or the first article."""
    got = F.regexp_extract(col(c), r"(?isu)r[èe]glement\s+[^\n]*?\d\s+(.*?)(?:ATTENDU|LE CONSEIL|Article)", 1)
    return F.nullif(TX.squish(got), F.lit(""))


def zone_kind(c) -> Column:
    # First letter of a zone code → kind.
    kinds = {"H": "habitation", "R": "habitation", "C": "commerce", "I": "industrie", "A": "agricole", "P": "public"}
    head = F.regexp_extract(F.upper(col(c)), "^([A-Z])[^A-Z]", 1)
    out = F.lit("autre")
    for k, v in kinds.items():
        out = F.when(head == k, v).otherwise(out)
    return out


def _wide(pattern: str, flags: int = re.I) -> re.Pattern:
    """The pattern with digits and word limits of ASCII, and with all white space of Unicode."""
    limit = "(?:(?<![A-Za-z0-9_])(?=[A-Za-z0-9_])|(?<=[A-Za-z0-9_])(?![A-Za-z0-9_]))"
    blank = "[\t-\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]"
    return re.compile(pattern.replace(r"\b", limit).replace(r"\d", "[0-9]").replace(r"\s", blank), flags)


# What a notice of motion says, and what makes it one about zoning.
_MOTION = _wide(r"avis\s+de\s+motion(?:\s+a\s+[eé]t[eé]\s+donn[eé])?|(?:donne|doit\s+donner|lui\s+donne)\s+avis\s+de\s+motion")
_PAST = _wide(r"avis\s+de\s+motion\s+a\s+[eé]t[eé]\s+donn[eé]")
_ZONING = _wide(r"\b(?:zonage|r[eè]glement\s+de\s+zonage|r[eè]glement\s+d'urbanisme)\b")
# Numbers of bylaws: 1926-26; Z-3001.  Where zoning is named also: V654-2026-33; 1767; URB-03-17.
_NUMBER = _wide(r"r[eè]glement\s+(?:n(?:[o°º]|um[eé]ro)?\s*\.?\s*)?(\d{2,4}-\d{1,4})\b")
_LETTER = _wide(r"r[eè]glement\s+de\s+zonage\s+(?:n(?:[o°º]|um[eé]ro)?\s*[.°º]?\s*)?([A-Z]-\d{3,4})\b")
_IN_ZONING = (
    _wide(r"r[eè]glement\s+(?:n(?:[o°]|um[eé]ro)?\s*\.?\s*)?([A-Z]\d{2,4}-\d{4}-\d{1,3})\b"),
    _wide(r"r[eè]gl(?:ement)?\s*[.]?\s+(?:(?:de\s+)?(?:zonage|lotissement|construction)\s+|d'urbanisme\s+)?n(?:[o°º]|um[eé]ro)?\s*[.°º]?\s*(\d{3,4})\b(?!-\d)"),
    _wide(r"r[eè]glement\s+(?:de\s+(?:zonage|l'urbanisme)\s+)?(?:n(?:[o°º]|um[eé]ro)?\s*[.°º]?\s*)?([A-Z]{2,4}-\d{2,4}(?:-\d{1,3})?)\b"),
)
_CHANGED = (
    _wide(r"(?:modifiant|amendant)\s+le\s+r[eè]glement\s+(?:de\s+zonage|d'urbanisme)\s+(?:n(?:[o°]|um[eé]ro)?\s*\.?\s*)?(\d{2,4}-\d{1,4})\b"),
    _wide(r"(?:modifiant|amendant)\s+le\s+r[eè]glement\s+(?:de\s+zonage|d'urbanisme)\s+(?:n(?:[o°]|um[eé]ro)?\s*\.?\s*)?([A-Z]\d{2,4}-\d{4}-\d{1,3})\b"),
    _wide(r"(?:modifiant|amendant)\s+le\s+r[eè]gl(?:ement)?\.?\s+(?:de\s+zonage|d'urbanisme)\s+\(?r[eè]gl\.\s+n[°º]\s*(\d{3,4})\)?"),
    _wide(r"(?:remplacer|remplaçant|abroger|abrog[eé])\s+(?:le\s+)?r[eè]gl(?:ement)?\.?\s*(?:n[o°º]|num[eé]ro)\s*[.°º]?\s*(\d{3,4})\b(?!-\d)"),
    _wide(r"(?:modifiant|amendant)\s+le\s+[^A-Za-z0-9_]*r[eè]glement\s+([A-Z]{2,4}-\d{2,4}(?:-\d{1,3})?)\b"),
)
_ZONE = _wide(r"\b([A-Z]{1,4}-\d{2,4}(?:-\d{1,3})?)\b", 0)
_NAMED_ZONE = _wide(r"\bzone\s+([A-Z]{1,4}-\d{1,4}(?:-\d{1,3})?)\b")
_BLANKS = _wide(r"\s+")
_BYLAW_WORD = _wide(r"r[eè]glement\b")
_DENSITY = _wide(
    r"habitation\s+multifamiliale|bifamiliale|trifamiliale|maison\s+de\s+chambres|logements?\s+multiples?|logements?\s+locatifs?|multi\s*[-–]\s*logements?|maison\s+de\s+rapport|plex\b|immeuble\s+(?:r[eé]sidentiel|locatif)"
    r"|appartements?\s+(?:ou\s+)?logements?|r[eé]sidentiel\s+(?:multi|densif)|densit|densification|logements?\s+(?:par|à l'hectare)|cos\b"
)
_RESULT = T.StructType([T.StructField("found", T.BooleanType()), T.StructField("bylaws", T.ArrayType(T.StringType())), T.StructField("changed", T.ArrayType(T.StringType())), T.StructField("zones", T.ArrayType(T.StringType())), T.StructField("density", T.BooleanType()), T.StructField("excerpts", T.ArrayType(T.StringType()))])
REACH, EXCERPT = 400, 200


def _context(text: str, m: re.Match) -> str:
    """The text around a motion, cut at the nearest blank lines within reach.

    A motion of the past looks forward only.  One whose paragraph goes on with a
    bylaw's number but does not speak of zoning takes in the next paragraph, within twice the reach.
    """
    at, end = m.span()
    first = text.find("\n\n", end)
    stop = min(end + REACH, first if first >= 0 else len(text))
    if _PAST.search(m[0]):
        return text[at:stop]
    second = text.find("\n\n", first + 2) if first >= 0 else -1
    if second >= 0 and _NUMBER.search(rest := text[end:first]) and not _ZONING.search(rest):
        stop = min(end + 2 * REACH, second)
    a = max(0, at - REACH)
    before = text.rfind("\n\n", max(0, a - 2), at)
    return text[max(a, before + 2) if before >= 0 else a : stop]


def _bylaws_in(around: str, zoning: bool) -> list[str]:
    """Bylaw numbers, each once, family by family."""
    return list(dict.fromkeys(n for p in (_NUMBER, _LETTER, *(_IN_ZONING if zoning else ())) for n in p.findall(around)))


def _zones_in(around: str, bylaws: list[str]) -> list[str]:
    """Zone codes that are no bylaw's number: in capitals and not up to 40 characters after the word bylaw, or right after the word zone."""
    known = {n.upper() for n in bylaws}
    codes = [m[1] for m in _ZONE.finditer(around) if m[1].upper() not in known and not _BYLAW_WORD.search(around[max(0, m.start() - 40) : m.start()])]
    known |= {c.upper() for c in codes}
    return list(dict.fromkeys(codes + [c for c in _NAMED_ZONE.findall(around) if c.upper() not in known]))


def _excerpt(text: str, at: int) -> str:
    """The text around a place, on one line, with dots where it is cut."""
    a, b = max(0, at - EXCERPT // 2), min(len(text), at + EXCERPT // 2)
    return "…" * (a > 0) + _BLANKS.sub(" ", text[a:b]).strip(" ") + "…" * (b < len(text))


def detect_zoning_change(text: str | None) -> tuple:
    text = text or ""
    numbers: dict[str, None] = {}
    changed: dict[str, None] = {}
    codes: dict[str, None] = {}
    found, density, excerpts = False, False, []
    for m in _MOTION.finditer(text):
        around = _context(text, m)
        zoning = _ZONING.search(around) is not None
        own = _bylaws_in(around, zoning)
        if not own:
            continue
        excerpts.append(_excerpt(text, m.start()))
        if not zoning:
            continue
        found = True
        old = dict.fromkeys(n for p in _CHANGED for n in p.findall(around))
        # the new bylaws are those that no other one replaces; if none is left, all
        numbers |= dict.fromkeys([n for n in own if n not in old] or own)
        changed |= old
        codes |= dict.fromkeys(_zones_in(around, own))
        density |= _DENSITY.search(around) is not None
    return found, list(numbers), list(changed), list(codes), density, excerpts


@pandas_udf(_RESULT)
def zoning_change(text: pd.Series) -> pd.DataFrame:
    """Notices of motion: whether one is about zoning, its new bylaws, changed ones, zones, density; an excerpt of each that names a bylaw."""
    return pd.DataFrame([detect_zoning_change(t) for t in text], columns=_RESULT.names)


def markdown_rows(pages: DataFrame, key: str, text: str) -> DataFrame:
    """key, table line number, cells of every line of a pipe table (rules between lines left out)."""
    lines = pages.select(key, F.posexplode(F.split(text, r"\r?\n")).alias("line", "raw")).filter(F.col("raw").rlike(r"^\s*\|.*\|\s*$") & ~F.col("raw").rlike(r"^[\s|:-]+$"))
    cells = F.transform(F.split(F.regexp_replace(F.trim("raw"), r"^\||\|$", ""), r"\|"), lambda x: F.trim(x))
    return lines.select(key, "line", cells.alias("cells"))


ZONE_CODE = r"(?i)^[a-z]{1,4}[- ]?\d{1,4}(?:-\d{1,3})?$"


def markdown_zones(pages: DataFrame, key: str, text: str, fallback: str | None = None) -> DataFrame:
    """Grids with zones in columns → key, zone_code, field, raw, value, unit: one row for each zone and known field; the first label of a field wins.

    The header is a page's first row with two zone codes at least; pages without one yield nothing.
    """
    rows = markdown_rows(pages, key, text)
    codes = F.filter("cells", lambda c: c.rlike(ZONE_CODE))
    heads = rows.filter(F.size(codes) >= 2).groupBy(key).agg(F.min_by(F.struct("line", "cells"), "line").alias("head"))
    body = rows.join(heads, key).filter("line > head.line")
    named = body.select(key, "line", field_of_label(F.get("cells", 0)).alias("field"), "cells", F.col("head.cells").alias("head")).filter("field IS NOT NULL")
    first = named.groupBy(key, "field").agg(F.min_by(F.struct("cells", "head"), "line").alias("r")).select(key, "field", "r.*")
    # cells are aligned at the right: a missing label cell does not shift the values
    each = first.select(key, "field", F.posexplode("head").alias("i", "zone"), "cells", (F.size("cells") - F.size("head")).alias("shift")).filter(F.col("zone").rlike(ZONE_CODE))
    raw = F.get("cells", F.col("i") + F.col("shift"))
    return each.select(key, TX.canon_zone_code("zone").alias("zone_code"), "field", raw.alias("raw"), measure(raw, fallback).alias("m")).select(key, "zone_code", "field", "raw", "m.value", "m.unit")


def layout_pages(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Pages of a layout text, split at form feeds; an empty last one goes."""
    pages = F.split(text, "\f")
    kept = F.when(F.trim(F.element_at(pages, -1)) == "", F.slice(pages, F.lit(1), F.greatest(F.size(pages) - 1, F.lit(0)))).otherwise(pages)
    return docs.select(key, F.posexplode(kept).alias("page", "page_text"))


def is_scanned(text, pages) -> Column:
    return F.length(F.regexp_replace(col(text), r"\s", "")) / F.greatest(col(pages), F.lit(1)) < 100
