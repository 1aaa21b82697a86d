"""Files: CSV, Parquet, roll XML, stores, and the sinks with fixed or inferred schemas."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf


def read_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """All columns as text; short rows and empty cells give empty text."""
    if len(sep) != 1:
        raise ValueError("the separator is one character")
    return spark.read.csv(path, header=True, sep=sep, quote='"', escape='"', multiLine=True, inferSchema=False).na.fill("")


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def list_keys(spark: SparkSession, root: str, suffix: str = "") -> DataFrame:
    """key, bytes of the files below a root, without reading them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    return files.filter(F.col("path").endswith(suffix)).select(F.col("path").alias("key"), F.col("length").alias("bytes"))


def slugs(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """Distinct slugs of the keys, by a pattern's first group."""
    return list_keys(spark, root).select(F.nullif(F.regexp_extract("key", pattern, 1), F.lit("")).alias("slug")).filter("slug IS NOT NULL").distinct()


def parse_store_uri(uri: str) -> dict:
    if uri.startswith("s3://"):
        bucket, _, prefix = uri[5:].partition("/")
        return {"kind": "s3", "bucket": bucket, "prefix": prefix.strip("/"), "spark": f"s3a://{bucket}/{prefix.strip('/')}".rstrip("/")}
    return {"kind": "fs", "path": uri.removeprefix("file://"), "spark": uri}


ROLL_UNIT = T.StructType([
    T.StructField("RL0103", T.StructType([T.StructField("RL0103x", T.ArrayType(T.StructType([T.StructField("RL0103Ax", T.StringType())])))])),
    *[T.StructField(t, T.StringType()) for t in ("RL0104A", "RL0104B", "RL0104C", "RL0105A", "RL0302A", "RL0306A", "RL0307A", "RL0308A", "RL0311A", "RL0402A", "RL0403A", "RL0404A")],
])


def read_roll(spark: SparkSession, path: str) -> DataFrame:
    """A row for each unit of an assessment roll; the reader splits files at unit tags."""
    return units(spark.read.format("xml").option("rowTag", "RLUEx").schema(ROLL_UNIT).load(path))


def units_of_text(df: DataFrame, xml: str) -> DataFrame:
    """The same from a text column that holds one unit's XML."""
    return units(df.select(*[c for c in df.columns if c != xml], F.from_xml(xml, ROLL_UNIT).alias("u")).select("*", "u.*").drop("u"))


def units(raw: DataFrame) -> DataFrame:
    from geoloom.functions.quantities import leading_int, safe_float

    keep = [c for c in raw.columns if not c.startswith("RL")]
    lots = F.array_distinct(F.filter(F.transform(F.coalesce(F.col("RL0103.RL0103x"), F.array().cast("array<struct<RL0103Ax:string>>")), lambda x: F.trim(x["RL0103Ax"])), lambda x: x != ""))
    id3 = [F.nullif(F.trim(F.col(f"RL0104{k}")), F.lit("")) for k in "ABC"]
    full = F.when(id3[0].isNotNull() & id3[1].isNotNull() & id3[2].isNotNull(), F.concat_ws("-", *id3))
    return raw.select(*keep, lots.alias("lots"), full.alias("matricule"), F.col("RL0105A").alias("use_code"), safe_float("RL0302A").alias("land_area_m2"), leading_int("RL0306A").alias("floors"), leading_int("RL0307A").alias("year_built"), safe_float("RL0308A").alias("building_area_m2"), leading_int("RL0311A").alias("dwellings"), leading_int("RL0402A").alias("land_cad"), leading_int("RL0403A").alias("building_cad"), leading_int("RL0404A").alias("total_cad"))


@pandas_udf(T.StringType())
def canonical_json(s: pd.Series) -> pd.Series:
    """JSON with object keys sorted at every depth and no blanks; whole numbers without decimals."""

    def plain(x):
        if isinstance(x, dict):
            return {k: plain(v) for k, v in x.items()}
        if isinstance(x, list):
            return [plain(v) for v in x]
        return int(x) if isinstance(x, float) and x.is_integer() and abs(x) < 1e21 else x

    return s.map(lambda t: None if t is None else json.dumps(plain(json.loads(t)), sort_keys=True, separators=(",", ":"), ensure_ascii=False))


# Content type → file extension.
EXTENSIONS = {"text/html": "html", "application/xhtml+xml": "html", "application/pdf": "pdf", "application/json": "json", "application/geo+json": "json", "application/xml": "xml", "text/xml": "xml", "text/plain": "txt", "text/csv": "csv"}


def extension(content_type) -> Column:
    c = F.lower(F.trim(F.substring_index(F.col(content_type) if isinstance(content_type, str) else content_type, ";", 1)))
    out = F.lit("bin")
    for k, v in EXTENSIONS.items():
        out = F.when(c == k, v).otherwise(out)
    return out


def raw_documents(df: DataFrame, source: str, body: str, content_type: str) -> DataFrame:
    """Content-addressed records: doc_key, storage_key, ext, n_bytes, sha256."""
    sha = F.sha2(F.col(body).cast("binary"), 256)
    return df.select("*", sha.alias("sha256"), F.concat(F.lit(f"raw:{source}:"), sha).alias("doc_key"), F.concat(F.lit(f"raw/{source}/cas/"), sha, F.lit("."), extension(content_type)).alias("storage_key"), F.octet_length(body).cast("long").alias("n_bytes"))


def inferred_types(rows: DataFrame, entries: str) -> DataFrame:
    """key, type of scalar cells (map of JSON text values): text if any is text, else boolean if all are, else double if any is fractional or missing, else long."""
    total = rows.agg(F.count("*")).scalar()
    cells = rows.select(F.explode(entries).alias("key", "value"))
    null = F.col("value").isNull() | (F.col("value") == "null")
    number, logic = F.col("value").rlike(r"^-?\d+(\.\d+)?([eE][+-]?\d+)?$"), F.col("value").isin("true", "false")
    got = cells.groupBy("key").agg(F.count_if(~null).alias("held"), F.count_if(~null & ~number & ~logic).alias("texts"), F.count_if(~null & logic).alias("logics"), F.count_if(~null & number & F.col("value").rlike(r"[.eE]")).alias("fractions"))
    kind = (
        F.when((F.col("held") == 0) | (F.col("texts") > 0), "STRING").when(F.col("logics") == F.col("held"), "BOOLEAN").when(F.col("logics") > 0, "STRING")
        .when((F.col("fractions") > 0) | (F.col("held") < total), "DOUBLE").otherwise("BIGINT")
    )
    return got.select("key", kind.alias("type"))


LOT_INDEX = T.StructType([*[T.StructField(c, T.StringType()) for c in ("feature_id", "no_lot", "code_zone", "role_usage_cubf")], *[T.StructField(c, T.DoubleType()) for c in ("role_valeur_terrain", "role_valeur_batiment", "role_valeur_totale", "superficie_m2", "frontage_m")], *[T.StructField(c, T.StringType()) for c in ("_source", "_snapshot")]])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns, in its order and types; absent ones missing."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def write_by_slug(df: DataFrame, path: str, slug: str = "slug") -> None:
    """One partition for each slug; only the slugs at hand are overwritten. Rows of a slug meet in one file where they fit, a large slug is split by size."""
    df.hint("rebalance", slug).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(slug).parquet(path)
