"""Names, slugs, codes, URLs and markup as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _fold_table() -> tuple[str, str]:
    """Letters of the Latin blocks that decompose to one ASCII letter and marks, with that letter."""
    pairs = []
    for point in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base = "".join(c for c in unicodedata.normalize("NFD", chr(point)) if not unicodedata.combining(c))
        if len(base) == 1 and base.isascii():
            pairs.append((chr(point), base))
    return "".join(p[0] for p in pairs), "".join(p[1] for p in pairs)


FOLD_FROM, FOLD_TO = _fold_table()
SPACES = r"[\s ﻿]+"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once for a row however often the body names it."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), 0)


def squish(c) -> Column:
    """White space, no-break space included, to single blanks; ends trimmed."""
    return F.trim(F.regexp_replace(col(c), SPACES, " "))


def strip_accents(c) -> Column:
    return F.regexp_replace(F.translate(col(c), FOLD_FROM, FOLD_TO), r"[̀-ͯ]", "")


def fold(c) -> Column:
    """Without accents, lower case."""
    return F.lower(strip_accents(c))


def fold_text(c) -> Column:
    return F.trim(fold(c))


def slug_segment(c) -> Column:
    return F.regexp_replace(F.regexp_replace(fold(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def slug_one_dash(c) -> Column:
    """A slug that loses one dash at either end only."""
    return F.regexp_replace(F.regexp_replace(fold(c), "[^a-z0-9]+", "-"), "^-|-$", "")


def norm_name(c) -> Column:
    """A name as a join key: folded, apostrophes dropped, the rest dashed; a missing name is empty."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(fold(F.coalesce(col(c), F.lit(""))), "['’`]", ""), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def ascii_slug(c) -> Column:
    """The destructive slug: every letter outside ASCII is lost."""
    return F.regexp_replace(F.lower(F.regexp_replace(col(c), r"[^\x00-\x7F]", "")), "[ '’]", "-")


def geo_id(*parts) -> Column:
    """Slug segments joined by slashes; empty ones drop out."""
    return F.concat_ws("/", *[F.nullif(slug_segment(p), F.lit("")) for p in parts])


def parse_geo_id(c) -> Column:
    return F.filter(F.split(col(c), "/"), lambda x: x != "")


def split_slug(c) -> Column:
    """Segments between double dashes, each a normal name."""
    return F.transform(F.split(col(c), "-{2,}"), norm_name)


_ADMIN = r"(?i)^(municipalit[ée]\s+(?:du\s+canton\s+de\s+|du\s+|de\s+|des\s+|d')?|ville\s+(?:de\s+)?|paroisse\s+(?:de\s+)?|canton\s+(?:de\s+)?|village\s+(?:de\s+)?)"


def strip_admin_prefix(c) -> Column:
    return F.trim(F.regexp_replace(col(c), _ADMIN, ""))


def canon_zone(c) -> Column:
    """A zone code as a key: upper case, no blanks, letters-dash-digits without leading zeros."""
    return F.regexp_replace(F.regexp_replace(F.upper(col(c)), r"\s+", ""), r"^([A-Z]+)-?0*(\d)", "$1-$2")


def canon_zone_code(c) -> Column:
    """A zone code read from a page: the word ZONE and plan notes go, dashes are one kind; empty is missing."""
    out = F.upper(col(c))
    for pattern, by in ((r"\bZONE\b", " "), (r"\(\s*PLAN\s+G[ÉE]N[ÉE]RAL\s*\)", " "), ("[–—]", "-"), (r"\s*-\s*", "-"), (r"([A-Z])\s+(\d)", "$1-$2"), (r"\s+", "")):
        out = F.regexp_replace(out, pattern, by)
    return F.nullif(out, F.lit(""))


def canon_zone_key(c) -> Column:
    return F.regexp_replace(F.upper(col(c)), r"\s+", "")


def canon_raw(c) -> Column:
    """A cell's text for comparison; a missing one is ∅."""
    out = F.regexp_replace(F.regexp_replace(F.lower(F.trim(col(c))), r"\s+", " "), "[—–]", "-")
    return F.coalesce(out, F.lit("∅"))


# The entities that notices and minutes hold, in order of replacement.
ENTITIES = (
    ("&#0?39;", "'"), ("(?i)&#x27;", "'"), ("&rsquo;", "'"), ("&amp;", "&"), ("&laquo;", "«"), ("&raquo;", "»"),
    ("&nbsp;", " "), ("&quot;", '"'), ("&eacute;", "é"), ("&egrave;", "è"), ("&agrave;", "à"),
)


def decode_entities(c) -> Column:
    out = col(c)
    for pattern, by in ENTITIES:
        out = F.regexp_replace(out, pattern, by)
    return squish(out)


def strip_tags(c) -> Column:
    return decode_entities(F.regexp_replace(col(c), "<[^>]+>", " "))


def first_tag(c, tag: str) -> Column:
    return F.nullif(F.trim(F.regexp_extract(col(c), f"(?is)<{tag}[^>]*>(.*?)</{tag}>", 1)), F.lit(""))


def all_tags(c, tag: str) -> Column:
    return F.filter(F.transform(F.regexp_extract_all(col(c), F.lit(f"(?is)<{tag}[^>]*>(.*?)</{tag}>"), F.lit(1)), lambda x: F.trim(x)), lambda x: x != "")


def site_of(url) -> Column:
    """Host in lower case without a leading www.; missing where the address has none."""
    host = F.regexp_extract(col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1)
    return F.nullif(F.regexp_replace(F.lower(host), r"^www\.", ""), F.lit(""))


def same_site(a, b) -> Column:
    """Equal hosts, or one a subdomain of the other."""
    a, b = site_of(a), site_of(b)
    return (a == b) | F.endswith(a, F.concat(F.lit("."), b)) | F.endswith(b, F.concat(F.lit("."), a))


def urls_in(c) -> Column:
    return F.array_distinct(F.regexp_extract_all(col(c), F.lit(r"""https?://[^\s"'<>)]+"""), F.lit(0)))


def anchors(c) -> Column:
    """Address of every anchor, in document order."""
    return F.regexp_extract_all(col(c), F.lit(r"""(?i)<a\s[^>]*href=["']([^"']*)["'][^>]*>"""), F.lit(1))


def to_https(c) -> Column:
    """https, host in lower case, no slash at the end; blank is missing."""
    s = F.nullif(F.trim(col(c)), F.lit(""))
    bare = F.regexp_replace(s, "(?i)^https?://", "")
    host = F.lower(F.regexp_extract(bare, "^([^/?#]*)", 1))
    return F.regexp_replace(F.concat(F.lit("https://"), host, F.substr(bare, F.length(host) + 1)), "/+$", "")


def source_slug(c) -> Column:
    out = F.regexp_replace(F.regexp_replace(F.lower(col(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.coalesce(F.nullif(out, F.lit("")), F.lit("source"))


def crs_code(c) -> Column:
    """EPSG:n from the usual spellings, leading zeros dropped; else missing."""
    s = F.trim(col(c))
    shapes = (r"^0*(\d+)$", r"(?i)(?:^|urn:ogc:def:crs:)epsg:?:?0*(\d+)$", r"(?i)/crs/epsg/\d+/0*(\d+)$")
    got = F.coalesce(*[F.nullif(F.regexp_extract(s, p, 1), F.lit("")) for p in shapes])
    return F.when(s.rlike("(?i)^(?:ogc:)?crs84$"), "EPSG:4326").otherwise(F.concat(F.lit("EPSG:"), got))


_DOC_EXT = r"(?i)\.(?:pdf|docx?|odt)(?:[?#].*)?$"
_DOC_QUERY = r"(?i)[?&](?:download|telechargement|getfile|fichier|file|attachment)="
_DOC_PATH = r"(?i)/(?:download|telecharger|getfile|fichier)[/?]"


def is_document_href(url) -> Column:
    return col(url).rlike(_DOC_EXT) | col(url).rlike(_DOC_QUERY) | col(url).rlike(_DOC_PATH)


def first_string(*candidates) -> Column:
    """The first that is not blank, trimmed."""
    return F.coalesce(*[F.nullif(F.trim(col(c).cast("string")), F.lit("")) for c in candidates])


def js_number(c) -> Column:
    """A number's shortest text: no decimals where it is whole."""
    x = col(c).cast("double")
    return F.when((x == F.floor(x)) & (F.abs(x) < 1e15), x.cast("bigint").cast("string")).otherwise(x.cast("string"))


def lowered(c) -> Column:
    return F.translate(col(c), _UPPER, _UPPER.lower())
