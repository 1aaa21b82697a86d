"""What the pages of a document say of zoning grids: signals of each page, and the document's kind.

A document is one text whose pages are parted by form feeds (the last one may close its page), or
by another breaker.  All of it is array functions within the row: no shuffle, and repeated or null
keys do not matter.  A missing or empty text has no pages; it is a plan image, as it has no letters.
Lengths are in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions.quantities import round_half_up
from geoloom.functions.text import SPACES, col, fold, let
from geoloom.operators.signals import IMAGE_ONLY

# Titles of grids, without spaces and (more widely) with single ones.
TITLE = "grilles?des?specifications?|grilles?desusageset(?:des)?normes"
WIDE_TITLE = r"grilles?\s+des?\s+(?:specification|norme|usage)"
# What a row of norms holds: a norm, a qualifier and a cell.
NORM = "marge|hauteur|largeur|superficie|profondeur|frontage|implantation|rapport|occupation|densit|coefficient|emprise|dominance"
QUALIFIER = r"\bmin\.?\b|\bmax\.?\b|minimale|maximale|\(m\)|\(m2\)|\(m²\)|\(%\)|etage"
CELL = r"[0-9]|\(m\)|\(m2\)|\(m²\)|\(%\)"
# Prose, which ends a sentence or is a point of a list.
SENTENCE = r"[;.]\s*$"
POINT = r"(?i)^\s*(?:[a-z]\)|\d+[°.)]|[•–-])\s"
# Headings of a grid with a zone to a row, of which a page has six.
HEADINGS = ("grille des usages et (?:des )?normes", r"\busage\b", r"\blotissement\b", r"\blargeur\b", r"\bsuperficie\b", r"\bhauteur\b", r"\bmarge\b", r"\bimplantation\b")
LEAST_HEADINGS, LEAST_ROWS, LEAST_CODES = 6, 3, 3
# Heads of zone columns, and words that stand beside them.
CODE = "^[A-Z]{1,3}-?[0-9]{1,3}[a-z]?$"
NUMBERED = r"numeros?\s+de\s+zones?\s+(?:\d{1,4}\s+){2,}\d{1,4}"
CONTEXT = r"grille|\bzones?\b|\busages?\b|\bnormes?\b|specification|implantation|dimension"
# A line that names the one zone of its page.
BANNER = r"(?i)^\s*(?:no\s+)?zone\s*[:°]?\s*[a-z]{1,3}-?\s?\d"
OWN_ZONE = r"^\s*zone\s*[:°]\s*[a-z]{1,3}\s?-?\s?\d|grilles?\s+des?\s+specifications?\b.*\bzone\s+\d{1,3}\s*-\s*[a-z]"
# Legal text.
LEGAL = (
    r"(?:modifiant|amendant|amender|amendement)\s+(?:le\s+)?reglement|\bavis\s+de\s+motion\b|\battendu\s+que\b|\bconsiderant\s+que\b|il\s+est\s+resolu|projet\s+de\s+reglement|entree\s+en\s+vigueur"
    r"|certificat\s+de\s+conformite|assemblee\s+publique\s+de\s+consultation|seance\s+(?:ordinaire|extraordinaire|du\s+conseil)"
)


# What a page must hold for one of its lines to be of a kind: read first, as it spares most pages the lines.
MAY_HOLD_CODES, MAY_NAME_ZONE = "[A-Z]-?[0-9]", "zone"


def _wide(pattern: str) -> str:
    """The pattern, whose blanks may be hard spaces too."""
    return pattern.replace(r"\s", r"[\s\x{A0}\x{FEFF}]")


def _low(page) -> Column:
    """fold, with the table of accents only for texts that are not ASCII."""
    return let(col(page), lambda p: F.when(p.rlike(r"[^\x00-\x7F]"), fold(p)).otherwise(F.lower(p)))


def _lines(page) -> Column:
    return F.split(page, "\n")


def pages_of(text, breaker: str = "\f") -> Column:
    """The pages of a text; an empty one after the last breaker is none."""
    parts = F.split(F.coalesce(col(text), F.lit("")), breaker)
    return let(parts, lambda p: F.when(F.element_at(p, -1) == "", F.slice(p, F.lit(1), F.size(p) - 1)).otherwise(p))


def has_title(page) -> Column:
    return F.regexp_replace(_low(page), SPACES, "").rlike(TITLE)


def norm_line(line) -> Column:
    """Whether a line is a row of norms and no prose."""
    prose = line.rlike(SENTENCE) & (line.rlike(POINT) | F.contains(line, F.lit(",")))
    return line.rlike(CELL) & let(_low(line), lambda s: s.rlike(NORM) & s.rlike(QUALIFIER)) & ~prose


def _rows(page: Column, low: Column) -> Column:
    return F.when(low.rlike(NORM), F.size(F.filter(_lines(page), norm_line))).otherwise(0)


def norm_rows(page) -> Column:
    return _rows(col(page), _low(page))


def codes_of(line) -> Column:
    """The distinct zone codes among a line's words, in order."""
    words = F.transform(F.split(col(line), r"\s+"), lambda w: F.regexp_replace(w, "[,;]+$", ""))
    return F.array_distinct(F.filter(words, lambda w: w.rlike(CODE)))


def heads_codes(line) -> Column:
    """Whether a line heads columns of zones: three codes that are half of its words, and no sentence with commas."""
    words = F.size(F.filter(F.split(col(line), r"\s+"), lambda w: w != ""))
    counted = let(F.size(codes_of(line)), lambda n: (n >= LEAST_CODES) & (n * 2 >= words))
    return col(line).rlike(MAY_HOLD_CODES) & counted & ~(col(line).rlike(SENTENCE) & F.contains(col(line), F.lit(",")))


def heads_numbers(line) -> Column:
    """Whether a line says that the numbers after it are zones."""
    return _low(line).rlike(_wide(NUMBERED))


def _own_zone(low: Column) -> Column:
    return low.rlike(MAY_NAME_ZONE) & F.exists(_lines(low), lambda x: x.rlike(_wide(OWN_ZONE)))


def table_signals(page) -> Column:
    """title_table, own_zone of a page's text (missing: empty)."""

    def read(p: Column) -> Column:
        return let(_low(p), lambda low: F.struct(((_rows(p, low) >= LEAST_ROWS) & has_title(p)).alias("title_table"), _own_zone(low).alias("own_zone")))

    return let(F.coalesce(col(page), F.lit("")), read)


def page_signals(page) -> Column:
    """chars, title_table, native, zone_header, title_gated, own_zone, legal of a page's text (missing: empty).

    A test of lines is put only to pages that can pass it, by a wider test of the whole page.
    """

    def read(p: Column) -> Column:
        return let(_low(p), lambda low: let(F.struct(low.alias("low"), _rows(p, low).alias("rows"), heads(p).alias("heads")), lambda c: judged(p, c["low"], c["rows"], c["heads"])))

    def heads(p: Column) -> Column:
        return F.when(p.rlike(MAY_HOLD_CODES), F.size(F.filter(_lines(p), heads_codes))).otherwise(0)

    def judged(p: Column, low: Column, rows: Column, heads: Column) -> Column:
        # six of eight headings: of any three, one at least
        headings = let(F.lower(p), lambda s: F.when(s.rlike("|".join(HEADINGS[-3:])), sum((s.rlike(h).cast("int") for h in HEADINGS), F.lit(0))).otherwise(0))
        numbered = low.rlike(_wide(NUMBERED)) & F.exists(_lines(low), lambda x: x.rlike(_wide(NUMBERED)))
        return F.struct(
            F.length(p).alias("chars"),
            ((rows >= LEAST_ROWS) & has_title(p)).alias("title_table"),
            (headings >= LEAST_HEADINGS).alias("native"),
            ((heads >= 2) | ((heads == 1) & ((rows >= 1) | low.rlike(CONTEXT))) | numbered).alias("zone_header"),
            (low.rlike(_wide(WIDE_TITLE)) & ((heads >= 1) | (rows >= LEAST_ROWS) | F.exists(_lines(p), lambda x: x.rlike(_wide(BANNER))))).alias("title_gated"),
            _own_zone(low).alias("own_zone"),
            low.rlike(_wide(LEGAL)).alias("legal"),
        )

    return let(F.coalesce(col(page), F.lit("")), read)


def amendment_pages(pages: DataFrame, doc: str, text: str) -> DataFrame:
    """Of a table with a page to a row: each document's pages, and those with legal text."""
    return pages.groupBy(doc).agg(F.count("*").alias("n_pages"), F.count_if(_low(text).rlike(_wide(LEGAL))).alias("n_amendment"))


def _places(signals: Column, test) -> Column:
    """The 1-based numbers of the pages that pass a test."""
    at = F.transform(signals, lambda s, i: F.when(test(s), i + 1))
    return F.array_compact(at)


def _first(places: Column) -> Column:
    return F.coalesce(F.get(places, 0), F.lit(0)).cast("int")


def _last(places: Column) -> Column:
    return F.coalesce(F.array_max(places), F.lit(0)).cast("int")


def grid_span(text, breaker: str = "\f") -> Column:
    """first_page, last_page, n_pages, layout and confidence of the pages with titled tables; missing if there are none."""

    def located(signals: Column) -> Column:
        def span(at: Column) -> Column:
            own = F.size(F.filter(signals, lambda s: s["title_table"] & s["own_zone"]))
            n, length = F.size(at), _last(at) - _first(at) + 1
            return F.when(
                n > 0,
                F.struct(
                    _first(at).alias("first_page"), _last(at).alias("last_page"), n.alias("n_pages"),
                    F.when(own * 2 >= n, "one-zone-per-page").otherwise("multi-zone-per-page").alias("layout"), round_half_up(n / length, 3).alias("confidence"),
                ),
            )

        return let(_places(signals, lambda s: s["title_table"]), span)

    return let(F.transform(pages_of(text, breaker), table_signals), located)


def document_class(text, breaker: str = "\f") -> Column:
    """kind of a document by its pages, with the counts that it rests on.

    A grid has a page with any signal of one; else few letters a page are a plan image, a page of
    legal text makes it a bylaw, and what is left is unknown.
    """

    def counted(signals: Column) -> Column:
        n = F.size(signals)
        chars = F.aggregate(F.transform(signals, lambda s: s["chars"].cast("long")), F.lit(0).cast("long"), lambda a, b: a + b)
        count = lambda f: F.size(F.filter(signals, lambda s: s[f]))
        seen = F.struct(
            n.alias("n_pages"), chars.alias("n_chars"), F.when(n > 0, chars / n).otherwise(0.0).alias("density"), count("title_table").alias("n_title_table"), count("native").alias("n_native"), count("legal").alias("n_legal"),
            _places(signals, lambda s: s["zone_header"]).alias("headers"),
            _places(signals, lambda s: s["title_table"] | s["native"] | s["zone_header"] | s["title_gated"]).alias("grids"),
        )
        return let(seen, judged)

    def judged(c: Column) -> Column:
        kind = F.when(F.size(c["grids"]) > 0, "grille").when(c["density"] < IMAGE_ONLY, "plan-image").when(c["n_legal"] > 0, "reglement").otherwise("unknown")
        return F.struct(
            kind.alias("kind"), c["n_pages"].alias("n_pages"), c["n_chars"].alias("n_chars"), round_half_up(c["density"], 1).alias("density"), c["n_title_table"].alias("n_title_table"), c["n_native"].alias("n_native"),
            F.size(c["headers"]).alias("n_zone_header"), F.size(c["grids"]).alias("n_grid"), _first(c["grids"]).alias("first_grid"), _last(c["grids"]).alias("last_grid"),
            _first(c["headers"]).alias("first_header"), _last(c["headers"]).alias("last_header"), c["n_legal"].alias("n_legal"),
        )

    return let(F.transform(pages_of(text, breaker), page_signals), counted)
