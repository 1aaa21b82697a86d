"""Sources, their manifests and licences, the inventory, freshness, and the recipes that normalise them."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions.quantities import duration_ms, is_stale
from geoloom.operators import features as FE
from geoloom.operators import gates as GA

FORMATS = ("geojson", "arcgis-rest", "csv", "gpkg", "shp", "fgdb", "kml", "xml", "parquet")
KINDS = ("admin", "cadastre", "zoning", "roll", "postal", "address", "constraint", "document")


@dataclass
class Dataset:
    id: str
    title: str
    format: str
    url: str
    cadence: str | None = None
    recipe: str | None = None
    level: str | None = None
    query: dict[str, str] = field(default_factory=dict)


@dataclass
class Manifest:
    id: str
    title: str
    country: str
    kind: str
    provider: str
    licence: str
    datasets: list[Dataset]
    rights: str | None = None

    def attribution(self) -> str:
        return f"© {self.provider} — {self.title}" if self.title else self.provider


def problems(m: dict) -> list[str]:
    """All that is wrong with a raw manifest; none: an empty list."""
    out = [f"{k}: must be a non-empty text" for k in ("id", "title", "country", "provider", "licence") if not (isinstance(m.get(k), str) and m[k].strip())]
    if isinstance(m.get("country"), str) and not re.match(GA.COUNTRY, m["country"]):
        out.append("country: two capital letters")
    if m.get("kind") not in KINDS:
        out.append(f"kind: one of {', '.join(KINDS)}")
    sets = m.get("datasets")
    if not isinstance(sets, list) or not sets:
        return [*out, "datasets: at least one"]
    for i, d in enumerate(sets):
        out += [f"datasets[{i}].{k}: must be a non-empty text" for k in ("id", "title", "url") if not (isinstance(d.get(k), str) and d[k].strip())]
        if d.get("format") not in FORMATS:
            out.append(f"datasets[{i}].format: one of {', '.join(FORMATS)}")
        if d.get("cadence") and not re.match(r"^P(?=.)", d["cadence"]):
            out.append(f"datasets[{i}].cadence: an ISO duration")
    return out


def parsed(m: dict) -> Manifest:
    if wrong := problems(m):
        raise ValueError("; ".join(wrong))
    return Manifest(m["id"], m["title"], m["country"], m["kind"], m["provider"], m["licence"], [Dataset(**d) for d in m["datasets"]], m.get("rights"))


class LicenceError(ValueError):
    """A source may not be redistributed."""


def redistributable(m: Manifest) -> bool:
    name = GA.ALIASES.get(m.licence.strip().lower(), m.licence.strip().lower())
    return next((r for k, r, *_ in GA.LICENCES if k == name), False)


def rights(m: Manifest) -> str:
    return m.rights or ("open" if redistributable(m) else "blocked")


def assert_open(m: Manifest) -> None:
    """Before any read: the licence allows redistribution, or the profile is that of an unverified demonstration."""
    if not redistributable(m) and rights(m) != "demo-unverified":
        raise LicenceError(f"{m.id}: {m.licence}")


Recipe = Callable[[DataFrame, Manifest, Dataset], DataFrame]


class Registry:
    """Manifests by id and recipes by name."""

    def __init__(self, manifests: list[Manifest] | None = None, recipes: dict[str, Recipe] | None = None):
        self.manifests, self.recipes = list(manifests or []), dict(recipes or {})

    def get(self, ref: str) -> tuple[Manifest, Dataset | None]:
        """``source`` or ``source#dataset``."""
        source, _, dataset = ref.partition("#")
        m = next((m for m in self.manifests if m.id == source), None)
        if m is None:
            raise KeyError(source)
        if not dataset:
            return m, None
        return m, next(d for d in m.datasets if d.id == dataset)

    def select(self, country: str | None = None, kind: str | None = None, open_only: bool = False) -> list[Manifest]:
        return [m for m in self.manifests if (not country or m.country.upper() == country.upper()) and (not kind or m.kind == kind) and (not open_only or redistributable(m))]

    def inventory(self, spark: SparkSession) -> DataFrame:
        """A row for each dataset, by source id; repeated ids get -2, -3, ..."""
        rows = [(m.id, d.id, m.country, m.kind, d.format, m.licence, rights(m), m.attribution(), d.cadence, d.url) for m in self.manifests for d in m.datasets]
        got = spark.createDataFrame(rows, "source_id string, dataset_id string, country string, kind string, format string, licence string, rights string, attribution string, cadence string, url string")
        return got.withColumn("licence", GA.licence_id("licence")).orderBy("source_id", "dataset_id")


def unique_ids(df: DataFrame, base: str, order: str, out: str = "unique_id") -> DataFrame:
    """The base id, with -2, -3, ... for its later rows."""
    from geoloom.operators.joins import numbered

    n = numbered(df, "ui_n", order, by=[base])
    return n.withColumn(out, F.when(F.col("ui_n") > 0, F.concat_ws("-", F.col(base), (F.col("ui_n") + 1).cast("string"))).otherwise(F.col(base))).drop("ui_n")


def due(ledger: DataFrame, now) -> DataFrame:
    """Ledger rows (manifest_ref, last_fetched_at, cadence) that are to be fetched again, never fetched ones included."""
    return ledger.withColumn("cadence_ms", duration_ms("cadence")).filter(is_stale("last_fetched_at", "cadence", now))


def refreshed(ledger: DataFrame, fetched: DataFrame, now) -> DataFrame:
    """The ledger after a run: fetched refs (manifest_ref, checksum) get the run's time and checksum."""
    f = fetched.select("manifest_ref", F.col("checksum").alias("new_sum"), F.lit(True).alias("hit"))
    both = ledger.join(f, "manifest_ref", "left")
    changed = F.col("hit") & ~F.col("checksum").eqNullSafe(F.col("new_sum"))
    return both.select("manifest_ref", F.when(F.col("hit"), F.lit(now)).otherwise(F.col("last_fetched_at")).alias("last_fetched_at"), "cadence", F.coalesce("new_sum", "checksum").alias("checksum"), F.when(F.col("hit"), F.when(changed, "updated").otherwise("unchanged")).otherwise("skipped").alias("outcome"))


def acquire(spark: SparkSession, registry: Registry, ref: str) -> tuple[DataFrame, dict]:
    """Rows of a dataset, normalised by its recipe, and its provenance. The licence is checked before anything is read."""
    from geoloom.sources import arcgis, files

    m, d = registry.get(ref)
    assert_open(m)
    if d is None:
        raise KeyError(f"{ref}: name a dataset")
    if d.format == "csv":
        raw = files.read_csv(spark, d.url, d.query.get("delimiter", ","))
        if not d.recipe:
            raise ValueError("a CSV dataset needs a recipe")
    elif d.format == "arcgis-rest":
        arcgis.register(spark)
        raw = spark.read.format("feature_service").options(root=d.url, **d.query).load()
    elif d.format == "xml":
        raw = files.read_roll(spark, d.url)
    elif d.format == "parquet":
        raw = spark.read.parquet(d.url)
    elif d.format == "geojson":
        raw = FE.read_collection(spark, d.url)
    else:
        raise ValueError(f"{d.format}: convert with an external tool first")
    rows = registry.recipes[d.recipe](raw, m, d) if d.recipe else (FE.admin(raw, m.country, d.id, d.level or "locality") if d.format == "geojson" else raw)
    return rows, {"source_id": m.id, "dataset_id": d.id, "licence": m.licence, "rights": rights(m), "attribution": m.attribution(), "crs": "EPSG:4326"}


def meta(rows: DataFrame, provenance: dict, fetched_at: str) -> DataFrame:
    """One row: the provenance, number of rows and an order-free checksum, from one pass in partial sums."""
    h = F.xxhash64(*[c for c, t in rows.dtypes if not t.startswith(("map", "variant"))])
    got = rows.agg(F.count("*").alias("count"), F.concat_ws("-", F.hex(F.coalesce(F.bit_xor(h), F.lit(0))), F.hex(F.coalesce(F.sum(F.pmod(h, F.lit(1 << 31))), F.lit(0)))).alias("checksum"))
    return got.select(*[F.lit(v).alias(k) for k, v in provenance.items()], F.lit(fetched_at).alias("fetched_at"), "count", "checksum")


# ---------------------------------------------------------------- recipes

#: Two-digit province code → postal abbreviation; the last three are territories.
PROVINCES = {"10": "NL", "11": "PE", "12": "NS", "13": "NB", "24": "QC", "35": "ON", "46": "MB", "47": "SK", "48": "AB", "59": "BC", "60": "YT", "61": "NT", "62": "NU"}
TERRITORIES = ("60", "61", "62")


def _map(c, table: dict[str, str]):
    out = F.lit(None).cast("string")
    for k, v in table.items():
        out = F.when(c == k, v).otherwise(out)
    return out


def units_recipe(code: str, name: str, level: str, parent: str | None = None, parent_level: str | None = None, iso: str | None = None) -> Recipe:
    """Administrative units: code and name fields, and the parent's id from its code."""

    def run(df: DataFrame, m: Manifest, d: Dataset) -> DataFrame:
        from geoloom.functions.text import geo_id

        own, label = FE.first_property(code), FE.first_property(name)
        up = geo_id(F.lit(m.country), F.lit(d.id), F.lit(parent_level), FE.first_property(parent)) if parent else F.lit(None).cast("string")
        return df.select("*", geo_id(F.lit(m.country), F.lit(d.id), F.lit(level), own).alias("geo_id"), label.alias("name"), own.alias("code"), F.lit(level).alias("level"), up.alias("parent_geo_id"), F.lit(iso).alias("iso"), F.lit(m.country).alias("country"))

    return run


def provinces(df: DataFrame, m: Manifest, d: Dataset) -> DataFrame:
    code = FE.first_property("PRUID")
    out = units_recipe("PRUID", "PRNAME", "province")(df, m, d).drop("level", "iso")
    return out.select("*", F.when(code.isin(*TERRITORIES), "territory").otherwise("province").alias("level"), F.concat(F.lit("CA-"), _map(code, PROVINCES)).alias("iso"))


def postal_areas(df: DataFrame, m: Manifest, d: Dataset) -> DataFrame:
    out = units_recipe("CFSAUID", "CFSAUID", "postal")(df, m, d).drop("iso")
    return out.select("*", F.concat(F.lit("CA-"), _map(FE.first_property("PRUID"), PROVINCES)).alias("iso"))


def lots(df: DataFrame, m: Manifest, d: Dataset) -> DataFrame:
    """Parcels: the number as it is, and as a key without blanks; the first feature of a number stays."""
    from geoloom.functions.text import geo_id
    from geoloom.operators.joins import first_wins

    number = FE.first_property("NO_LOT", "noLot")
    keyed = df.select("*", number.alias("no_lot"), F.coalesce(F.regexp_replace(number, r"\s+", ""), F.concat(F.lit("#"), F.col("pos").cast("string"))).alias("lot_key"))
    one = first_wins(keyed.drop("geometry", "props"), "lot_key", "pos")
    return one.select("*", geo_id(F.lit("ca"), F.lit("qc"), F.lit("lot"), "lot_key").alias("geo_id"))


def communes(df: DataFrame, m: Manifest, d: Dataset) -> DataFrame:
    """Communes of a referential: other types and rows without a code go."""
    from geoloom.functions.text import first_string, geo_id

    kept = df.filter((F.col("TYPECOM") == "COM") & (F.trim("COM") != ""))
    return kept.select(geo_id(F.lit("fr"), F.lit("commune"), "COM").alias("geo_id"), first_string("LIBELLE", "NCCENR", "COM").alias("name"), F.col("COM").alias("code"), geo_id(F.lit("fr"), F.lit("department"), "DEP").alias("parent_geo_id"), F.lit("FR").alias("country"), F.lit("commune").alias("level"))


def postal_codes(df: DataFrame, m: Manifest, d: Dataset) -> DataFrame:
    """Postal codes by commune: rows with neither code go."""
    from geoloom.functions.text import geo_id

    kept = df.filter((F.trim("postal") != "") | (F.trim("insee") != ""))
    return kept.select(geo_id(F.lit("fr"), F.lit("cp"), "postal", "insee").alias("geo_id"), F.col("commune").alias("name"), F.col("postal").alias("code"), F.lit("FR").alias("country"), F.lit("postal").alias("level"))


RECIPES: dict[str, Recipe] = {
    "regions": units_recipe("RES_CO_REG", "RES_NM_REG", "region", iso="CA-QC"), "mrc": units_recipe("MRS_CO_MRC", "MRS_NM_MRC", "mrc", "MRS_CO_REG", "region"), "municipalities": units_recipe("MUS_CO_GEO", "MUS_NM_MUN", "municipality", "MUS_CO_MRC", "mrc"),
    "census-divisions": units_recipe("CDUID", "CDNAME", "county", "PRUID", "province"), "census-subdivisions": units_recipe("CSDUID", "CSDNAME", "municipality", "CDUID", "county"), "provinces": provinces, "postal-areas": postal_areas, "lots": lots, "communes": communes, "postal-codes": postal_codes,
    "flood-zones": units_recipe("OBJECTID", "Description", "constraint"), "agricultural": units_recipe("OBJECTID", "NOM", "constraint"), "hydrography": units_recipe("OBJECTID", "TOPONYME", "constraint"),
}
