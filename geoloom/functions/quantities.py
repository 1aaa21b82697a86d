"""Dates, durations, numbers, units and confidence gates as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import canon_raw, col, fold, js_number, let

MISSING = "non-disponible"
# French month names, and their folded spellings.
MONTHS = {
    "janvier": "01", "février": "02", "fevrier": "02", "mars": "03", "avril": "04", "mai": "05", "juin": "06", "juillet": "07",
    "août": "08", "aout": "08", "septembre": "09", "octobre": "10", "novembre": "11", "décembre": "12", "decembre": "12",
}
_LETTERS = "a-zàâçéèêëîïôûù"


def _month(name: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv])[name]


def _part(c: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(c, pattern, group)


def french_date(c) -> Column:
    """'20 mai 2026' → '2026-05-20'; anything else is the sentinel."""
    s, p = F.lower(F.trim(col(c))), rf"^(\d{{1,2}})\s+([{_LETTERS}]+)\s+(\d{{4}})$"
    month = _month(_part(s, p, 2))
    return F.coalesce(F.concat(_part(s, p, 3), F.lit("-"), month, F.lit("-"), F.lpad(_part(s, p, 1), 2, "0")), F.lit(MISSING))


def label_date(c) -> Column:
    """The best date in a label: long date, ISO date, month and year, year and month of a file name, else the sentinel."""
    s = F.lower(col(c))
    long = rf"(\d{{1,2}})(?:er|re|e|ère|ème|ᵉʳ|ᵉ)?\s+([{_LETTERS}]+)\s+(\d{{4}})"
    iso, short, ym = r"\b(\d{4})[-/](\d{2})[-/](\d{2})\b", rf"(?U)\b([{_LETTERS}]+)\s+(\d{{4}})\b", r"\b(20\d{2})[-_](0[1-9]|1[0-2])\b"
    full = F.concat(_part(s, long, 3), F.lit("-"), _month(_part(s, long, 2)), F.lit("-"), F.lpad(_part(s, long, 1), 2, "0"))
    day = F.when(_part(s, iso, 1) != "", F.concat_ws("-", *[_part(s, iso, k) for k in (1, 2, 3)]))
    month = F.concat(_part(s, short, 2), F.lit("-"), _month(_part(s, short, 1)))
    file = F.when(_part(s, ym, 1) != "", F.concat_ws("-", _part(s, ym, 1), _part(s, ym, 2)))
    return F.coalesce(full, day, month, file, F.lit(MISSING))


def file_date(c) -> Column:
    """A date in a file name, year first or day first (two-digit years are of this century); else missing."""
    s = col(c)
    a, b = r"(20\d{2})[-_.](\d{2})[-_.](\d{2})", r"\b(\d{1,2})[-_.](\d{1,2})[-_.](20\d{2}|\d{2})\b"
    first = F.when(_part(s, a, 1) != "", F.concat_ws("-", *[_part(s, a, k) for k in (1, 2, 3)]))
    d, m, y = _part(s, b, 1), _part(s, b, 2), _part(s, b, 3)
    fine = (d != "") & m.try_cast("int").between(1, 12) & d.try_cast("int").between(1, 31)
    second = F.when(fine, F.concat_ws("-", F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y), F.lpad(m, 2, "0"), F.lpad(d, 2, "0")))
    return F.coalesce(first, second)


def duration_ms(c) -> Column:
    """Milliseconds of an ISO duration, with years of 365 and months of 30 days; invalid is missing."""
    s = F.trim(col(c))
    p = r"^P(?:(\d+)Y)?(?:(\d+)M)?(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?)?$"
    n = [F.coalesce(F.nullif(_part(s, p, k), F.lit("")).cast("bigint"), F.lit(0)) for k in range(1, 7)]
    total = (n[0] * 365 + n[1] * 30 + n[2]) * 86_400_000 + (n[3] * 3600 + n[4] * 60 + n[5]) * 1000
    return F.when(s.rlike(p) & (s != "P"), total)


def is_stale(fetched, cadence, now) -> Column:
    """Due: never fetched, a date or cadence that can't be read, or older than the cadence."""
    at, ms = F.try_to_timestamp(col(fetched).cast("string")), duration_ms(cadence)
    age = F.unix_millis(col(now).cast("timestamp")) - F.unix_millis(at)
    return F.when(at.isNull() | ms.isNull(), True).otherwise(age > ms)


def in_window(date, start, end) -> Column:
    """Dates as text in [start, end]; undated rows stay; a month counts with all its days."""
    d = col(date)
    undated = d.isNull() | (d == MISSING) | (d == "")
    month = d.rlike(r"^\d{4}-\d{2}$")
    inside = F.when(month, (F.concat(d, F.lit("-31")) >= start) & (F.concat(d, F.lit("-01")) <= end)).otherwise((d >= start) & (d <= end))
    return undated | inside


def round_half_up(c, digits: int = 0) -> Column:
    """floor(x * 10^d + 0.5) / 10^d: halves go up, negative ones too."""
    k = 10.0**digits
    return F.floor(col(c) * k + 0.5) / k


def pct(part, whole) -> Column:
    """Whole percents, at most 100; 0 where there is no whole."""
    p, w = col(part).cast("double"), col(whole).cast("double")
    return F.when(w > 0, F.least(F.lit(100), F.floor(p * 100 / w + 0.5).cast("int"))).otherwise(0).cast("int")


def pct1(part, whole) -> Column:
    """Percents with one decimal; 0 where there is no whole."""
    p, w = col(part).cast("double"), col(whole).cast("double")
    return F.when(w > 0, round_half_up(p * 100 / w, 1)).otherwise(0.0)


def safe_float(c) -> Column:
    return F.nullif(F.trim(col(c).cast("string")), F.lit("")).try_cast("double")


def safe_int(c) -> Column:
    return safe_float(c).cast("bigint")


def leading_int(c) -> Column:
    """The whole number at the start of a text, blanks inside dropped; negative is missing."""
    n = F.nullif(F.regexp_extract(F.regexp_replace(col(c).cast("string"), r"[\s ]", ""), r"^([+-]?\d+)", 1), F.lit("")).cast("bigint")
    return F.when(n >= 0, n)


def clamp_unit(c) -> Column:
    return F.least(F.greatest(col(c), F.lit(0.0)), F.lit(1.0))


# Cells that say that there is no value.
ABSENT = ("s.o.", "s/o", "so", "n/a", "na", "—", "–", "-", "", ".", "...")


def measure(c, fallback=None) -> Column:
    """A cell as value, unit, absent: unit by its sign or the fallback; a number only where no other words stand in the cell."""
    raw = col(c)
    s = F.lower(F.trim(raw))
    unit = (
        F.when(s.rlike("m²|m2"), "m2").when(s.rlike(r"(?:^|\s)[ée]tages?(?:\s|$)"), "etages").when(s.contains("%"), "pct")
        .when(s.rlike(r"\bm\b"), "m").otherwise(col(fallback) if isinstance(fallback, Column) else F.lit(fallback))
    )
    rest = F.regexp_replace(F.regexp_replace(s, r"m²|m2|[ée]tages?|\bm\b|%", " "), r"[\d.,/()-]", " ")
    joined = F.regexp_replace(s, r"(\d)\s+(\d{3}\b)", "$1$2")
    number = F.regexp_replace(F.regexp_extract(joined, r"(-?\d+(?:[.,]\d+)?)", 1), ",", ".").try_cast("double")
    absent = s.isin(*ABSENT)
    value = F.when(absent | rest.rlike("[a-zà-ÿ]"), F.lit(None).cast("double")).otherwise(number)
    return F.struct(value.alias("value"), F.when(~absent, unit).alias("unit"), absent.alias("absent"))


# Folded row labels of zoning grids → field, most special first.
FIELD_RULES = (
    ("marge.*avant", "min", None, "marge_avant_min"), ("marge.*lateral", "min", None, "marge_laterale_min"), ("marge.*arriere", "min", None, "marge_arriere_min"),
    ("marge.*avant", None, "max", "marge_avant_min"), ("marge.*lateral", None, "max", "marge_laterale_min"), ("marge.*arriere", None, "max", "marge_arriere_min"),
    ("hauteur.*etage", "max", None, "hauteur_etages"), ("hauteur.*metr", "max", None, "hauteur_metres"), ("hauteur.*metr", None, None, "hauteur_metres"),
    ("hauteur.*etage", None, None, "hauteur_etages"), ("(?:facade|frontale|largeur).*min", None, None, "frontage_min"), ("(?:superficie|aire).*min", None, None, "superficie_min"),
    ("(?:indice|coefficient).*(?:occupation|emprise|sol)", None, None, "densite"),
)
FIELDS = ("densite", "frontage_min", "hauteur_etages", "hauteur_metres", "marge_arriere_min", "marge_avant_min", "marge_laterale_min", "superficie_min")


def field_of_label(c) -> Column:
    s, out = fold(c), F.lit(None).cast("string")
    for pattern, needs, forbids, name in reversed(FIELD_RULES):
        test = s.rlike(pattern)
        if needs:
            test = test & s.contains(needs)
        if forbids:
            test = test & ~s.contains(forbids)
        out = F.when(test, name).otherwise(out)
    return out


# The units that go with what a column means.
UNITS_OF = {"length": ("m",), "area": ("m2",), "count": ("etages",), "pct": ("pct",)}
PUBLISH, VISION = 0.85, 0.92


def unit_fits(meaning, unit) -> Column:
    m, u = col(meaning), col(unit)
    out = F.lit(True)
    for name, units in UNITS_OF.items():
        out = F.when(m == name, u.isin(*units)).otherwise(out)
    return u.isNull() | out


def gated(value, structural, low, high, fits) -> Column:
    """confidence = min(0.97, structure, plausibility, meaning); the value is published from 0.85 on."""
    v = col(value)
    plausible = F.when(v.between(col(low), col(high)), 1.0).otherwise(0.1)
    confidence = F.when(v.isNull(), 0.0).otherwise(F.least(F.lit(0.97), col(structural).cast("double"), plausible, F.when(col(fits), 1.0).otherwise(0.0)))
    publish = confidence >= PUBLISH
    return F.struct(F.when(publish, v).alias("value"), confidence.alias("confidence"), F.when(~publish, F.when(v.isNull(), "absent").otherwise("a-verifier")).alias("flag"))


def _meaning(raw: Column, m: Column) -> Column:
    text = F.when(m["value"].isNull(), F.concat(F.lit("txt:"), canon_raw(raw))).otherwise(F.concat(js_number(m["value"]), F.lit(":"), F.coalesce(m["unit"], F.lit("?"))))
    return F.when(raw.isNull() | (F.trim(raw) == "") | m["absent"], F.lit("∅")).otherwise(text)


def concord_key(c, fallback=None) -> Column:
    """What a cell means, for comparing two readings: value and unit, else its text; ∅ where there is none."""
    return let(measure(c, fallback), lambda m: _meaning(col(c), m))


def two_readings(a, b, meaning, low, high, fallback=None) -> Column:
    """Two independent readings of a cell → value, confidence, flag: they must mean the same, hold a number, fit the column and its range."""
    left, right = col(a), col(b)

    def judged(both: Column) -> Column:
        ma, mb = both["a"], both["b"]
        own = lambda k: F.when(left.isNotNull(), ma[k]).otherwise(mb[k])
        return (
            F.when(_meaning(left, ma) != _meaning(right, mb), "divergence-2-passes").when(F.coalesce(own("absent"), F.lit(True)), "absent").when(own("value").isNull(), "non-numerique")
            .when(~unit_fits(meaning, own("unit")), "unite-incoherente").when(~own("value").between(col(low), col(high)), "hors-plage")
        )

    def result(both: Column) -> Column:
        value = F.when(left.isNotNull(), both["a"]["value"]).otherwise(both["b"]["value"])
        shape = lambda flag: F.struct(F.when(flag.isNull(), value).alias("value"), F.when(flag.isNull() | (flag == "absent"), VISION).otherwise(0.0).alias("confidence"), flag.alias("flag"))
        return let(judged(both), shape)

    return let(F.struct(measure(left, fallback).alias("a"), measure(right, fallback).alias("b")), result)


def value_in_raw(value, raw) -> Column:
    """A published value must stand in its cell."""
    return F.contains(F.regexp_replace(F.regexp_replace(col(raw), r"[\s ]", ""), ",", "."), js_number(value))


def french_long(date) -> Column:
    """'1er mars 2026' style long date of a day."""
    names = F.array(*[F.lit(m) for m in ("janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre")])
    d = col(date).cast("date")
    day = F.when(F.dayofmonth(d) == 1, "1er").otherwise(F.dayofmonth(d).cast("string"))
    return F.concat_ws(" ", day, F.element_at(names, F.month(d)), F.year(d).cast("string"))


def range_label(low, high) -> Column:
    """'1 200 – 3 400': whole numbers with blanks between thousands."""
    show = lambda c: F.regexp_replace(F.format_number(F.floor(col(c) + 0.5), 0), ",", " ")
    return F.concat(show(low), F.lit(" – "), show(high))
