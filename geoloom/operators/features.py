"""Feature collections: GeoJSON to rows, box filter, pages, single items, normalisers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions import geometry as G
from geoloom.functions.text import first_string, fold_text, geo_id

FEATURE = "type string, id string, bbox array<double>, geometry string, properties string"


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    """Features of GeoJSON collections (files or folders): file, pos, feature_id, geometry (JSON), props (variant), extent.

    A file that is no collection yields nothing.
    """
    raw = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    return features(raw.withColumn("value", F.col("value")), "value", "file")


def features(raw: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row for each feature of a JSON text column."""
    doc = F.try_parse_json(text)
    kind = F.try_variant_get(doc, "$.type", "string")
    items = F.try_variant_get(doc, "$.features", "array<variant>")
    rows = raw.filter(kind == "FeatureCollection").select(*keep, F.posexplode(items).alias("pos", "feature"))
    get = lambda p, t: F.try_variant_get("feature", p, t)
    out = rows.select(*keep, "pos", get("$.id", "string").alias("id"), get("$.geometry.type", "string").alias("geom_type"), get("$.geometry", "variant").alias("geometry"), get("$.properties", "variant").alias("props"))
    key = F.coalesce("id", F.try_variant_get("props", "$.geoId", "string"), F.col("pos").cast("string"))
    out = out.withColumn("feature_id", key).withColumn("multi", as_multi(F.col("geometry"), F.col("geom_type")))
    flat = positions(F.col("geometry"), F.col("geom_type"))
    x, y = F.transform(flat, lambda p: p[0]), F.transform(flat, lambda p: p[1])
    return out.withColumns({"minx": F.array_min(x), "miny": F.array_min(y), "maxx": F.array_max(x), "maxy": F.array_max(y)})


def as_multi(geometry: Column, kind: Column) -> Column:
    """Polygons and multipolygons as nested arrays; else missing."""
    one = F.try_variant_get(geometry, "$.coordinates", "array<array<array<double>>>")
    many = F.try_variant_get(geometry, "$.coordinates", G.MULTI)
    return F.when(kind == "Polygon", F.array(one)).when(kind == "MultiPolygon", many)


def positions(geometry: Column, kind: Column) -> Column:
    """All positions of a geometry of any simple type."""
    at = lambda depth: F.try_variant_get(geometry, "$.coordinates", "array<" * depth + "double" + ">" * depth)
    return (
        F.when(kind == "Point", F.array(at(1))).when(kind.isin("MultiPoint", "LineString"), at(2)).when(kind.isin("Polygon", "MultiLineString"), F.flatten(at(3)))
        .when(kind == "MultiPolygon", F.flatten(F.flatten(at(4))))
    )


def parse_bbox(text: str | None) -> tuple[float, float, float, float] | None:
    """Four finite numbers, or nothing."""
    try:
        got = tuple(float(x) for x in (text or "").split(","))
    except ValueError:
        return None
    return got if len(got) == 4 and all(abs(x) < float("inf") for x in got) else None


def _leading(text: object) -> int | None:
    import re

    m = re.match(r"\s*([+-]?\d+)", str(text if text is not None else ""))
    return int(m[1]) if m else None


def parse_limit(text: object, default: int = 100, most: int = 10_000) -> int:
    n = _leading(text)
    return default if n is None or n <= 0 else min(n, most)


def parse_offset(text: object) -> int:
    return max(0, _leading(text) or 0)


def filtered(df: DataFrame, bbox: tuple[float, float, float, float] | None) -> DataFrame:
    """Rows whose box meets the query box; plain comparisons that reach the scan."""
    return df if bbox is None else df.filter(G.boxes_meet("minx", "miny", "maxx", "maxy", bbox))


def page(df: DataFrame, order: str, bbox=None, limit: int = 100, offset: int = 0) -> DataFrame:
    """A page of the matching features, in file order."""
    return filtered(df, bbox).orderBy(order).offset(offset).limit(limit)


def number_matched(df: DataFrame, bbox=None) -> DataFrame:
    return filtered(df, bbox).agg(F.count("*").alias("number_matched"))


def item(df: DataFrame, key: Column, wanted: str, order: str) -> DataFrame:
    """The feature with a key; the last of repeated ones."""
    return df.filter(key == wanted).orderBy(F.desc(order)).limit(1)


def search(df: DataFrame, keys: list[str], needle: str, order: str, limit: int = 8) -> DataFrame:
    """The first rows, in order, one of whose keys holds the needle without regard to accents and case."""
    n = fold_text(F.lit(needle))
    hit = F.lit(False)
    for k in keys:
        hit = hit | F.contains(fold_text(k), n)
    return df.filter(hit).orderBy(order).limit(limit)


#: Property names that normalisers try, in order.
NAMES = ("name", "nom", "NAME", "NOM", "title", "label", "libelle")
CODES = ("code", "CODE", "id", "ID", "gid", "GID")
LEVELS = ("country", "region", "province", "territory", "state", "department", "county", "mrc", "municipality", "commune", "borough", "locality", "postal")


def admin(df: DataFrame, country: str, dataset: str, level: str = "locality") -> DataFrame:
    """Features with geo_id, name, level, code, iso, country laid over the given properties (variant ``props``)."""
    prop = lambda *names: first_string(*[F.try_variant_get("props", f"$.{n}", "string") for n in names])
    code = prop(*CODES)
    name = F.coalesce(prop(*NAMES), F.concat(F.lit("feature-"), F.col("pos").cast("string")))
    lvl = F.coalesce(prop("level"), F.lit(level))
    own = F.coalesce(prop("geoId"), geo_id(F.lit(country), F.lit(dataset), lvl, F.coalesce(code, name)))
    return df.select("*", own.alias("geo_id"), name.alias("name"), lvl.alias("level"), code.alias("code"), prop("iso").alias("iso"), F.lit(country).alias("country"))


def mapped(df: DataFrame, mapping: dict[str, str | list[str]], country: str, level: str) -> DataFrame:
    """A normaliser from a declaration: standard column → property name or names."""
    out = {}
    for target, names in mapping.items():
        out[target] = first_string(*[F.try_variant_get("props", f"$.{n}", "string") for n in ([names] if isinstance(names, str) else names)])
    return df.select("*", *[c.alias(k) for k, c in out.items()], F.lit(country).alias("country"), F.lit(level).alias("level"))


def renamed(df: DataFrame, columns: dict[str, str], id_from: str | None = None, keep: bool = False, country: str | None = None) -> DataFrame:
    """CSV rows under standard names; geometry is missing; the id column gives geo_id."""
    cols = [F.col(a).alias(b) for a, b in columns.items()]
    more = [F.col(c) for c in df.columns if c not in columns] if keep else []
    ids = [F.nullif(F.trim(F.col(id_from)), F.lit("")).alias("geo_id")] if id_from else []
    return df.select(*cols, *more, *ids, F.lit(None).cast("string").alias("geometry"), F.lit(country).alias("country"))


def zone_features(df: DataFrame, zone: str, kind: str, source: str, confidence: str, trim: bool = True) -> DataFrame:
    """The served shape of zones: zone_code, kind, source, confidence; a blank code is missing."""
    code = F.nullif(F.trim(F.col(zone)) if trim else F.col(zone), F.lit(""))
    return df.select("*", code.alias("zone_code"), F.lit(kind).alias("kind"), F.lit(source).alias("source_tag"), F.lit(confidence).alias("confidence"))


def first_property(*names: str, props: str = "props") -> Column:
    return first_string(*[F.try_variant_get(props, f"$.{n}", "string") for n in names])
