"""A paged feature service as a Spark data source.

``spark.read.format("feature_service")`` with option ``root``: a folder of
recorded answers (or a base address, where a fetcher is given).  With strategy
``offset`` every page is a partition when the number of features is known; with
``bbox`` the driver splits full tiles in four until they hold less than a page,
and every kept tile is a partition.  A tile's overlap is kept: features on a seam
come twice, as the service gives them.
"""

from __future__ import annotations

import json
import os
import random
import time
from collections.abc import Callable, Iterator
from urllib.parse import urlencode

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PAGE, DEPTH, RETRIES, PAGES = 1000, 8, 4, 10_000


def query_url(service: str, layer: int | str, **params: object) -> str:
    """The query address of a layer; given parameters override the defaults."""
    base = {"where": "1=1", "outFields": "*", "outSR": "4326", "f": "geojson"}
    return f"{service.rstrip('/')}/{layer}/query?{urlencode(base | params)}"


def quarters(box: tuple[float, float, float, float]) -> list[tuple[float, float, float, float]]:
    w, s, e, n = box
    x, y = (w + e) / 2, (s + n) / 2
    return [(w, s, x, y), (x, s, e, y), (w, y, x, n), (x, y, e, n)]


def backoff(fetch: Callable[[str], tuple[int, dict, str]], url: str, retries: int = RETRIES, base: float = 0.5, sleep: Callable[[float], None] = time.sleep) -> str:
    """The body of a good answer; 429, 5xx and network errors are tried again, after Retry-After or a random growing wait."""
    for attempt in range(retries + 1):
        try:
            status, headers, body = fetch(url)
        except OSError:
            status, headers, body = 599, {}, ""
        if status < 400:
            return body
        if (status != 429 and status < 500) or attempt == retries:
            raise OSError(f"status {status} from {url}")
        after = headers.get("Retry-After")
        sleep(float(after) if after else random.uniform(0, base * 2**attempt))
    raise AssertionError


def tiles(count: Callable[[tuple], int], box: tuple, page: int = PAGE, depth: int = DEPTH) -> list[tuple]:
    """Boxes that hold less than a page each, by splitting full ones, breadth first; the deepest stay as they are."""
    out, front = [], [(box, 0)]
    while front:
        later = []
        for b, d in front:
            if count(b) >= page and d < depth:
                later += [(q, d + 1) for q in quarters(b)]
            else:
                out.append(b)
        front = later
    return out


class Recorded:
    """Answers kept in a folder: features.geojson holds all features of the service."""

    def __init__(self, root: str):
        with open(os.path.join(root, "features.geojson"), encoding="utf-8") as f:
            self.features = json.load(f)["features"]

    @staticmethod
    def _box(feature: dict) -> tuple[float, float, float, float] | None:
        flat: list[tuple[float, float]] = []

        def walk(c):
            if c and isinstance(c[0], (int, float)):
                flat.append((c[0], c[1]))
            else:
                for x in c:
                    walk(x)

        geometry = feature.get("geometry")
        if not geometry:
            return None
        walk(geometry["coordinates"])
        xs, ys = [p[0] for p in flat], [p[1] for p in flat]
        return min(xs), min(ys), max(xs), max(ys)

    def page(self, offset: int, size: int) -> list[dict]:
        return self.features[offset : offset + size]

    def within(self, box: tuple, size: int | None = None) -> list[dict]:
        w, s, e, n = box
        got = [f for f in self.features if (b := self._box(f)) and b[0] <= e and b[2] >= w and b[1] <= n and b[3] >= s]
        return got if size is None else got[:size]


class _Part(InputPartition):
    def __init__(self, what: tuple):
        super().__init__(what)
        self.what = what


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.size = options["root"], int(options.get("pagesize", PAGE))
        self.strategy = options.get("strategy", "offset")
        self.box = tuple(float(x) for x in options.get("bbox", "-180,-90,180,90").split(","))
        self.depth = int(options.get("maxdepth", DEPTH))

    def partitions(self) -> list[InputPartition]:
        source = Recorded(self.root)
        if self.strategy == "bbox":
            return [_Part(("box", b)) for b in tiles(lambda b: len(source.within(b, self.size)), self.box, self.size, self.depth)]
        n = len(source.features)
        return [_Part(("page", at)) for at in range(0, n, self.size)][:PAGES]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        source = Recorded(self.root)
        kind, at = partition.what
        for i, f in enumerate(source.page(at, self.size) if kind == "page" else source.within(at)):
            yield (str(partition.what), i, None if f.get("id") is None else str(f["id"]), json.dumps(f.get("geometry")), json.dumps(f.get("properties") or {}))


class FeatureService(DataSource):
    @classmethod
    def name(cls) -> str:
        return "feature_service"

    def schema(self) -> str:
        return "part string, pos int, id string, geometry string, properties string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def register(spark) -> None:
    spark.dataSource.register(FeatureService)
