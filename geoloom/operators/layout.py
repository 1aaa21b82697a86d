"""Zoning grids in fixed-width page texts: columns are found by their header phrases, cells by where they stand.

A page counts as a grid only with most of its known headings; all columns must
be found, else the page is refused.  A number that stands under no column makes
the whole row suspect: none of its values is published.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf


@dataclass(frozen=True)
class Spec:
    field: str
    served: bool
    phrase: str
    unit: str | None
    low: float
    high: float
    meaning: str


# The grid's columns, the phrase that heads each, its unit, plausible range and meaning.
COLUMNS = (
    Spec("nombre_max_chambres", False, "de chambres", None, 0, 100, "count"), Spec("nombre_max_batiments", False, "de bâtiments", None, 0, 100, "count"),
    Spec("frontage_min", True, r"(?<!min\. )lot \(m\)(?!²)", "m", 3, 200, "length"), Spec("profondeur_min", False, r"min\. lot \(m\)(?!²)", "m", 3, 500, "length"),
    Spec("superficie_min", True, r"min\. lot \(m²\)", "m2", 100, 1_000_000, "area"), Spec("densite", True, r"sol max\.", "pct", 0, 100, "pct"),
    Spec("hauteur_max_etage", True, r"max\. étage", "etages", 1, 60, "count"), Spec("marge_avant_min", True, r"avant min\.", "m", 0, 30, "length"),
    Spec("marge_laterale_min", True, r"latérale min\.", "m", 0, 30, "length"), Spec("total_marges_laterales", False, r"\bmarges\b", "m", 0, 60, "length"),
    Spec("marge_arriere_min", True, r"arrière min\.", "m", 0, 30, "length"), Spec("espace_libre_min", False, r"libre min\.", "pct", 0, 100, "pct"),
)
HEADINGS = ("grille des usages et (?:des )?normes", r"\busage\b", r"\blotissement\b", r"\blargeur\b", r"\bsuperficie\b", r"\bhauteur\b", r"\bmarge\b", r"\bimplantation\b")
LEAST_HEADINGS, TOLERANCE, PUBLISH = 6, 8, 0.85
ROW = re.compile(r"^\s*([A-Z]{1,3}-\d{1,4}(?:-\d{1,3})?)\b")
NOTE = re.compile(r"^note\b|^\(\d+\)$|^art\.?\s*\d+", re.I)
_UNIT_OK = {"length": "m", "area": "m2", "count": "etages", "pct": "pct"}


def headings(text: str) -> int:
    return sum(bool(re.search(h, text, re.I)) for h in HEADINGS)


def middle(line: str, phrase: str) -> int | None:
    m = re.search(phrase, line, re.I)
    return None if m is None else round((m.start() + m.end()) / 2)


def columns(lines: list[str]) -> list[int] | None:
    """The middle of each column: on the line with most phrases (four at least), else on one of its neighbours; None if one is nowhere."""
    hits = [sum(bool(re.search(c.phrase, x, re.I)) for c in COLUMNS) for x in lines]
    if not hits or max(hits) < 4:
        return None
    at = hits.index(max(hits))
    near = [lines[k] for k in (at, at + 1, at + 2, at - 1) if 0 <= k < len(lines)]
    out = []
    for c in COLUMNS:
        found = next((m for m in (middle(x, c.phrase) for x in near) if m is not None), None)
        if found is None:
            return None
        out.append(found)
    return out


def cells(line: str) -> list[tuple[int, str]]:
    """(middle, text) of each cell of a row; a note and its number are one cell."""
    out: list[tuple[int, int, str]] = []
    for m in re.finditer(r"\S+", line):
        if out and re.fullmatch("note", out[-1][2], re.I) and re.fullmatch(r"\d{1,3}", m[0]) and m.start() - out[-1][1] <= 2:
            s, _, t = out.pop()
            out.append((s, m.end(), f"{t} {m[0]}"))
        else:
            out.append((m.start(), m.end(), m[0]))
    return [(round((s + e) / 2), t) for s, e, t in out]


def placed(row: list[tuple[int, str]], middles: list[int]) -> tuple[dict[int, tuple[int, str]], list[str]]:
    """Cell of each column by the nearest middle, and the texts that are left: too far away, or farther than another one."""
    near = sorted((min((abs(at - m), k) for k, m in enumerate(middles)), i) for i, (at, _) in enumerate(row))
    taken: dict[int, tuple[int, str]] = {}
    left = []
    for (far, k), i in near:
        if far <= TOLERANCE and k not in taken:
            taken[k] = (far, row[i][1])
        else:
            left.append(row[i][1])
    return taken, left


def judged(cell: tuple[int, str] | None, spec: Spec, clean: bool) -> tuple:
    """(value, raw, unit, confidence, flag) of a cell."""
    from_text = None if cell is None else cell[1]
    if cell is None:
        return None, "", None, 0.0, "absent"
    if NOTE.match(from_text):
        return None, from_text, None, 0.2, "a-verifier"
    low = from_text.lower()
    if low in ("s.o.", "s/o", "so", "n/a", "na", "—", "–", "-", ".", "..."):
        return None, from_text, None, 0.0, "absent"
    m = re.search(r"-?\d+(?:[.,]\d+)?", low)
    if m is None or re.search("[a-zà-ÿ]", re.sub(r"m²|m2|[ée]tages?|\bm\b|%", " ", low)):
        return None, from_text, spec.unit, 0.2, "a-verifier"
    value = float(m[0].replace(",", "."))
    unit = "pct" if "%" in low else "m2" if re.search("m²|m2", low) else spec.unit
    half = TOLERANCE / 2
    place = 1.0 if cell[0] <= half else max(0.0, 1 - (cell[0] - half) / (half + 1))
    sure = min(0.97, place, 1.0 if spec.low <= value <= spec.high else 0.1, 1.0 if unit in (None, _UNIT_OK[spec.meaning]) else 0.0)
    if not clean:
        return None, from_text, unit, round(min(sure, 0.4), 3), "decalage-suspecte"
    return (value if sure >= PUBLISH else None), from_text, unit, round(sure, 3), None if sure >= PUBLISH else "a-verifier"


_CELL = T.StructType([T.StructField("field", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("raw", T.StringType()), T.StructField("unit", T.StringType()), T.StructField("confidence", T.DoubleType()), T.StructField("flag", T.StringType())])
_PAGE = T.StructType([T.StructField("rejected", T.StringType()), T.StructField("zone_page", T.StringType()), T.StructField("zones", T.ArrayType(T.StructType([T.StructField("zone_code", T.StringType()), T.StructField("cells", T.ArrayType(_CELL))])))])


def parse_page(text: str | None) -> tuple:
    """(why it is refused or None, page's zone, [(zone_code, cells)])."""
    text = text or ""
    label = re.search(r"No zone\s+([A-Za-z]?\d{2,6})\b", text)
    page = label[1] if label else "non-disponible"
    if headings(text) < LEAST_HEADINGS:
        return "no grid page", page, []
    lines = text.split("\n")
    middles = columns(lines)
    if middles is None:
        return "columns missing", page, []
    zones = []
    for line in lines:
        m = ROW.match(line)
        if not m:
            continue
        taken, left = placed([c for c in cells(line) if c[1] != m[1]], middles)
        clean = not any(re.search(r"\d", t) and not NOTE.match(t) for t in left)
        zones.append((m[1], [(c.field, *judged(taken.get(k), c, clean)) for k, c in enumerate(COLUMNS) if c.served]))
    return None, page, zones


@pandas_udf(_PAGE)
def grid_page(text: pd.Series) -> pd.DataFrame:
    rows = []
    for t in text:
        why, page, zones = parse_page(t)
        rows.append({"rejected": why, "zone_page": page, "zones": [{"zone_code": z, "cells": [dict(zip(_CELL.names, c)) for c in own]} for z, own in zones]})
    return pd.DataFrame(rows, columns=_PAGE.names)


def grids(pages: DataFrame, key: str, text: str) -> DataFrame:
    """key, zone_page, zone_code, field, value, raw, unit, confidence, flag of the grid pages; refused pages yield nothing."""
    got = pages.select(key, grid_page(text).alias("g")).filter("g.rejected IS NULL")
    rows = got.select(key, F.col("g.zone_page").alias("zone_page"), F.explode("g.zones").alias("z"))
    return rows.select(key, "zone_page", F.col("z.zone_code").alias("zone_code"), F.explode("z.cells").alias("c")).select(key, "zone_page", "zone_code", "c.*")


def rejected(pages: DataFrame, key: str, text: str) -> DataFrame:
    return pages.select(key, grid_page(text)["rejected"].alias("why")).filter("why IS NOT NULL")
