"""python -m geoloom.cli sources|items|item|licences: a small command line over the catalog and the query facade."""

from __future__ import annotations

import argparse
import json
import sys


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="geoloom")
    sub = p.add_subparsers(dest="what", required=True)
    s = sub.add_parser("sources", help="list sources of manifest files")
    s.add_argument("manifests", nargs="+")
    s.add_argument("--country")
    s.add_argument("--kind")
    s.add_argument("--open", action="store_true")
    i = sub.add_parser("items", help="a page of a collection")
    i.add_argument("root")
    i.add_argument("collection")
    for o in ("bbox", "limit", "offset"):
        i.add_argument(f"--{o}")
    one = sub.add_parser("item", help="one feature")
    for o in ("root", "collection", "key"):
        one.add_argument(o)
    f = sub.add_parser("fetch", help="acquire source#dataset of a manifest into a folder")
    for o in ("manifest", "ref", "out"):
        f.add_argument(o)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    from geoloom.plans import api, catalog

    def manifests(paths):
        out = []
        for path in paths:
            with open(path, encoding="utf-8") as f:
                out.append(catalog.parsed(json.load(f)))
        return out

    if a.what == "sources":
        for m in catalog.Registry(manifests(a.manifests)).select(a.country, a.kind, a.open):
            print(f"{m.id}\t{m.country}\t{m.kind}\t{m.licence}\t{catalog.rights(m)}\t{m.attribution()}")
        return 0
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("geoloom").getOrCreate()
    if a.what == "fetch":
        rows, provenance = catalog.acquire(spark, catalog.Registry(manifests([a.manifest]), catalog.RECIPES), a.ref)
        rows.select(*[c for c, t in rows.dtypes if t != "variant"]).write.mode("overwrite").parquet(a.out)
        print(json.dumps(provenance))
        return 0
    service = api.Api(api.make_provider(spark, a.root))
    status, body = service.items(a.collection, a.bbox, a.limit, a.offset) if a.what == "items" else service.item(a.collection, a.key)
    print(json.dumps(body, ensure_ascii=False))
    return 0 if status == 200 else 1


if __name__ == "__main__":
    sys.exit(main())
