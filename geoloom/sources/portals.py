"""Open-data portals, web feature services and map catalogues, from their recorded or fetched answers."""

from __future__ import annotations

from urllib.parse import quote, urlencode

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions.text import col, first_string, fold

# ---------------------------------------------------------------- CKAN

CKAN = "struct<result:struct<results:array<struct<id:string,name:string,title:string,organization:struct<title:string,name:string>,resources:array<struct<id:string,name:string,format:string,url:string,description:string>>>>>>"
# Format spellings → format; other converter formats count as shp.
RESOURCE_FORMATS = {"geojson": "geojson", "geo+json": "geojson", "application/geo+json": "geojson", "shp": "shp", "shapefile": "shp", "kml": "kml", "gpkg": "gpkg", "geopackage": "gpkg", "fgdb": "fgdb", "filegdb": "fgdb", "esri geodatabase": "fgdb", "mapinfo": "shp", "tab": "shp", "gml": "shp", "dxf": "shp"}
GEO = ("geojson", "shp", "kml", "gpkg", "fgdb")


def search_url(base: str, query: str, rows: int = 10, start: int = 0) -> str:
    return f"{base.rstrip('/')}/api/3/action/package_search?{urlencode({'q': query, 'rows': rows, 'start': start})}"


def resource_format(c) -> Column:
    s, out = F.lower(F.trim(col(c))), F.lit("other")
    for k, v in RESOURCE_FORMATS.items():
        out = F.when(s == k, v).otherwise(out)
    return out


def packages(answers: DataFrame, body: str, *keep: str) -> DataFrame:
    """A row for each package of search answers; a body that is no answer yields none."""
    rows = answers.select(*keep, F.explode(F.from_json(body, CKAN)["result"]["results"]).alias("p"))
    return rows.select(*keep, first_string("p.id", "p.name").alias("package_id"), first_string("p.title", "p.name").alias("title"), first_string("p.organization.title", "p.organization.name").alias("organization"), F.col("p.resources").alias("resources"))


def geo_resources(pkgs: DataFrame, *keep: str) -> DataFrame:
    """Geographic resources with an address, their format, and whether a converter is needed."""
    rows = pkgs.select(*keep, "package_id", F.explode("resources").alias("r")).select(*keep, "package_id", F.col("r.id").alias("resource_id"), F.col("r.name").alias("name"), F.col("r.url").alias("url"), resource_format("r.format").alias("format"))
    return rows.filter(F.col("format").isin(*GEO) & (F.coalesce(F.trim("url"), F.lit("")) != "")).withColumn("needs_converter", F.col("format") != "geojson")


def census(cities: DataFrame, resources: DataFrame, slug: str = "slug") -> DataFrame:
    """Each city's best resource: geojson before other formats, none where there is nothing."""
    rank = F.when(F.col("format") == "geojson", 0).otherwise(1)
    best = resources.groupBy(slug).agg(F.min_by(F.struct("format", "url"), F.struct(rank, "url")).alias("b"), F.count("*").alias("n"))
    both = cities.join(best, slug, "left")
    return both.select(slug, F.coalesce("n", F.lit(0)).alias("n_resources"), F.when(F.col("b").isNull(), "unknown").otherwise("available").alias("availability"), F.when(F.col("b").isNull(), "none").when(F.col("b.format") == "geojson", "geojson").otherwise("convertible").alias("quality"), F.col("b.url").alias("url"))


# ---------------------------------------------------------------- feature services


def feature_url(base: str, kind: str, start: int = 0, count: int = 1000, field: str | None = None, code: str | None = None) -> str:
    """A GetFeature address; a code is pushed to the server as a filter, with quotes doubled."""
    params = {"service": "WFS", "version": "2.0.0", "request": "GetFeature", "typeNames": kind, "outputFormat": "application/json", "srsName": "EPSG:4326", "startIndex": start, "count": count}
    if field and code is not None:
        params["cql_filter"] = f"{field}='{code.replace(chr(39), chr(39) * 2)}'"
    return f"{base}?{urlencode(params, quote_via=quote)}"


def feature_types(caps: DataFrame, body: str, *keep: str) -> DataFrame:
    """name, title, zoneish of the types in GetCapabilities answers."""
    rows = caps.select(*keep, F.explode(F.regexp_extract_all(body, F.lit(r"(?s)<(?:\w+:)?FeatureType[ >].*?</(?:\w+:)?FeatureType>"), F.lit(0))).alias("t"))
    tag = lambda n: F.nullif(F.trim(F.regexp_extract("t", rf"(?s)<(?:\w+:)?{n}[^>]*>(.*?)<", 1)), F.lit(""))
    named = rows.select(*keep, tag("Name").alias("name"), tag("Title").alias("title"))
    return named.withColumn("zoneish", fold(F.concat_ws(" ", "name", "title")).rlike("zonage|zones?(?:[^a-z]|$)"))


def zoning_service(name) -> Column:
    """Whether a service's last name says zoning."""
    return F.element_at(F.split(col(name), "/"), -1).rlike(r"(?i)zonage|zoning|^zones?(?:[_-]|$)|[_-]zones?(?:[_-]|$)|reglement.*urb|urbanisme")


def affectation_only(name) -> Column:
    return col(name).rlike("(?i)affectation|grande.?affect") & ~col(name).rlike("(?i)zonage|zoning")


def layer_parts(url) -> Column:
    """service and layer of an address; layer 0 if it names none."""
    u = F.regexp_replace(col(url), "/+$", "")
    n = F.regexp_extract(u, r"^(.*/(?:Feature|Map)Server)/(\d+)$", 2)
    return F.struct(F.when(n != "", F.regexp_extract(u, r"^(.*/(?:Feature|Map)Server)/(\d+)$", 1)).otherwise(u).alias("service"), F.coalesce(F.nullif(n, F.lit("")).cast("int"), F.lit(0)).alias("layer"))


def esri_extent(c) -> Column:
    """A box of finite numbers with an inside; else missing."""
    e = F.from_json(col(c), "xmin double, ymin double, xmax double, ymax double")
    fine = (e["xmax"] > e["xmin"]) & (e["ymax"] > e["ymin"]) & ~F.isnan(e["xmin"]) & (F.abs(e["xmax"]) < float("inf"))
    return F.when(fine, e)


def extent_centre(e, wkid) -> Column:
    """Longitude and latitude of a box's middle: degrees as they are, web Mercator turned back, other metres only if they look like degrees."""
    x, y, k = (col(e)["xmin"] + col(e)["xmax"]) / 2, (col(e)["ymin"] + col(e)["ymax"]) / 2, 20037508.342
    mercator = F.struct((x / k * 180).alias("lon"), F.degrees(2 * F.atan(F.exp(F.radians(y / k * 180))) - F.pi() / 2).alias("lat"))
    plain = F.struct(x.alias("lon"), y.alias("lat"))
    degrees = (F.abs(x) <= 180) & (F.abs(y) <= 90)
    got = F.when(col(wkid).isin(3857, 102100), mercator).when(degrees, plain)
    return F.when(got["lat"].between(44, 62) & got["lon"].between(-80, -56), got)


def catalogue_candidates(items: DataFrame) -> DataFrame:
    """Items (type, url, title, owner, west, south, east, north) that may be zoning layers of the area: secure address of a server, name that says so, no denied owner, middle in the box."""
    lon, lat = (F.col("west") + F.col("east")) / 2, (F.col("south") + F.col("north")) / 2
    named = F.col("title").rlike("(?i)zonage|zoning") & ~F.col("title").rlike("(?i)inond|flood|sismi|agricole|affectation")
    server = F.col("url").rlike(r"^https://.*/(?:Feature|Map)Server/?(?:\d+)?$")
    return items.filter(server & named & F.col("type").isin("Feature Service", "Map Service") & ~F.lower("owner").rlike("ontario|ottawa|toronto|newyork") & lon.between(-79.8, -57) & lat.between(44.9, 62.6))


# ---------------------------------------------------------------- external converter


def converter_args(src: str, dst: str, layer: str | None = None, tolerance: float = 0.0008) -> list[str]:
    """Arguments that turn any vector file into plain GeoJSON in degrees."""
    return ["-f", "GeoJSON", "-t_srs", "EPSG:4326", "-lco", "RFC7946=YES", "-lco", "COORDINATE_PRECISION=6", *(["-simplify", str(tolerance)] if tolerance > 0 else []), dst, src, *([layer] if layer else [])]


def listed_layers(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """name and geometry type of the layers a converter lists."""
    rows = df.select(*keep, F.explode(F.split(text, r"\r?\n")).alias("x")).filter(F.col("x").rlike(r"^\s*\d+:\s+\S"))
    return rows.select(*keep, F.regexp_extract("x", r"^\s*\d+:\s+(\S+)", 1).alias("name"), F.nullif(F.regexp_extract("x", r"\(([^)]*)\)\s*$", 1), F.lit("")).alias("geometry_type"))


def archive_kind(path) -> Column:
    return F.when(F.lower(col(path)).endswith(".7z"), "7z").otherwise("zip")
