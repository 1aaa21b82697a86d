"""The query surface: collections, items, one item, as plain dictionaries for a web layer."""

from __future__ import annotations

import json
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.operators import features as FE


class Provider(Protocol):
    def collections(self) -> list[dict]: ...
    def collection(self, name: str) -> dict | None: ...
    def frame(self, name: str) -> DataFrame | None: ...


class FileProvider:
    """GeoJSON files below a folder; a sibling .meta.json names each. Metadata is read at once, bodies on demand."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.metas: dict[str, dict] = {}
        try:
            found = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.meta.json").text(self.root, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
            rows = found.orderBy("file").collect()  # a row for each collection
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            rows = []
        for r in rows:
            try:
                m = json.loads(r["value"])
            except ValueError:
                continue
            if isinstance(m, dict) and isinstance(m.get("datasetId"), str):
                self.metas[m["datasetId"]] = m | {"file": r["file"][: -len(".meta.json")] + ".geojson"}  # the last of repeated ids wins

    def collections(self) -> list[dict]:
        return [self.collection(k) for k in sorted(self.metas)]

    def collection(self, name: str) -> dict | None:
        m = self.metas.get(name)
        return m and {"id": name, "title": m.get("title", name), "count": m.get("count", 0), "licence": m.get("license"), "attribution": m.get("attribution"), "crs": "EPSG:4326"}

    def frame(self, name: str) -> DataFrame | None:
        m = self.metas.get(name)
        return FE.read_collection(self.spark, m["file"]) if m else None


class TableProvider:
    """Registered tables or views; each needs pos, feature_id, minx, miny, maxx, maxy, props and geometry."""

    def __init__(self, spark: SparkSession, tables: dict[str, str]):
        self.spark, self.tables = spark, tables

    def collections(self) -> list[dict]:
        return [self.collection(k) for k in sorted(self.tables)]

    def collection(self, name: str) -> dict | None:
        if name not in self.tables:
            return None
        r = self.frame(name).agg(F.count("*"), F.min("minx"), F.min("miny"), F.max("maxx"), F.max("maxy")).first()
        return {"id": name, "title": name, "count": r[0], "extent": None if r[1] is None else list(r[1:]), "crs": "EPSG:4326"}

    def frame(self, name: str) -> DataFrame | None:
        return self.spark.table(self.tables[name]) if name in self.tables else None


def make_provider(spark: SparkSession, uri: str | dict) -> Provider:
    from geoloom.sources.files import parse_store_uri

    return TableProvider(spark, uri) if isinstance(uri, dict) else FileProvider(spark, parse_store_uri(uri)["spark"])


class Api:
    """GET answers as (status, body)."""

    def __init__(self, provider: Provider, base: str = ""):
        self.provider, self.base = provider, base.rstrip("/")

    def landing(self) -> tuple[int, dict]:
        return 200, {"title": "features", "links": [{"rel": r, "href": f"{self.base}/{r}"} for r in ("conformance", "collections", "api")]}

    def conformance(self) -> tuple[int, dict]:
        return 200, {"conformsTo": [f"http://www.opengis.net/spec/ogcapi-features-1/1.0/conf/{x}" for x in ("core", "geojson")]}

    def openapi(self) -> tuple[int, dict]:
        """The description of these paths and their parameters."""
        text = lambda where, name: {"name": name, "in": where, "required": where == "path", "schema": {"type": "string"}}
        number = lambda name, least: {"name": name, "in": "query", "schema": {"type": "integer", "minimum": least}}
        get = lambda *params: {"get": {"parameters": list(params), "responses": {"200": {"description": "ok"}, "404": {"description": "not found"}}}}
        name = text("path", "collectionId")
        paths = {"/": get(), "/conformance": get(), "/collections": get(), "/collections/{collectionId}": get(name), "/collections/{collectionId}/items": get(name, text("query", "bbox"), number("limit", 1), number("offset", 0)), "/collections/{collectionId}/items/{featureId}": get(name, text("path", "featureId"))}
        return 200, {"openapi": "3.0.3", "info": {"title": "features", "version": "1.0.0"}, "paths": paths}

    def collections(self) -> tuple[int, dict]:
        return 200, {"collections": self.provider.collections()}

    def collection(self, name: str) -> tuple[int, dict]:
        got = self.provider.collection(name)
        return (200, got) if got else (404, {"error": f"no collection {name}"})

    @staticmethod
    def _feature(r) -> dict:
        return {"type": "Feature", "id": r["feature_id"], "geometry": json.loads(r["g"]) if r["g"] else None, "properties": json.loads(r["p"]) if r["p"] else {}}

    @staticmethod
    def _shape(df: DataFrame) -> DataFrame:
        return df.select("feature_id", F.to_json("geometry").alias("g"), F.to_json("props").alias("p"))

    def items(self, name: str, bbox: str | None = None, limit: object = None, offset: object = None) -> tuple[int, dict]:
        df = self.provider.frame(name)
        if df is None:
            return 404, {"error": f"no collection {name}"}
        box = None if bbox is None else FE.parse_bbox(bbox)
        if bbox is not None and box is None:
            return 400, {"error": "bbox: four numbers"}
        n, at = FE.parse_limit(limit), FE.parse_offset(offset)
        matched = FE.number_matched(df, box).first()[0]
        rows = [self._feature(r) for r in self._shape(FE.page(df, "pos", box, n, at)).collect()]  # a page
        links = [{"rel": "self", "href": f"{self.base}/collections/{name}/items?limit={n}&offset={at}"}]
        if at + n < matched:
            links.append({"rel": "next", "href": f"{self.base}/collections/{name}/items?limit={n}&offset={at + n}" + (f"&bbox={bbox}" if bbox else "")})
        return 200, {"type": "FeatureCollection", "numberMatched": matched, "numberReturned": len(rows), "features": rows, "links": links}

    def item(self, name: str, key: str) -> tuple[int, dict]:
        df = self.provider.frame(name)
        got = None if df is None else self._shape(FE.item(df, F.col("feature_id"), key, "pos")).first()
        return (200, self._feature(got)) if got else (404, {"error": f"no item {key}"})
