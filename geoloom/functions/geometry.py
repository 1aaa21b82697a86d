"""Geometry on nested arrays: a ring is an array of [x, y], a polygon an array of rings, a multipolygon an array of polygons."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from .text import col

MULTI = "array<array<array<array<double>>>>"
EARTH_KM = 6371.0


def box_ring(x0, y0, x1, y1) -> Column:
    """The closed ring of a rectangle."""
    x0, y0, x1, y1 = (col(c).cast("double") for c in (x0, y0, x1, y1))
    return F.array(F.array(x0, y0), F.array(x1, y0), F.array(x1, y1), F.array(x0, y1), F.array(x0, y0))


def rings(multi) -> Column:
    return F.flatten(col(multi))


def extent(multi) -> Column:
    """minx, miny, maxx, maxy of all positions; missing where there is none."""
    points = F.flatten(rings(multi))
    x, y = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    return F.struct(F.array_min(x).alias("minx"), F.array_min(y).alias("miny"), F.array_max(x).alias("maxx"), F.array_max(y).alias("maxy"))


def boxes_meet(minx, miny, maxx, maxy, box: tuple[float, float, float, float]) -> Column:
    """Closed boxes overlap (edge contact counts). A missing box gives a missing answer, which filters drop: the bare comparisons reach the scan."""
    w, s, e, n = box
    return (col(minx) <= e) & (col(maxx) >= w) & (col(miny) <= n) & (col(maxy) >= s)


def box_2d(b) -> Column:
    """w, s, e, n of a box of 4 or 6 numbers; else missing."""
    b = col(b)
    return F.when(F.size(b) == 4, b).when(F.size(b) == 6, F.array(b[0], b[1], b[3], b[4]))


def quadrants(w, s, e, n) -> Column:
    """The four boxes about the middle."""
    w, s, e, n = map(col, (w, s, e, n))
    x, y = (w + e) / 2, (s + n) / 2
    box = lambda a, b, c, d: F.struct(a.alias("w"), b.alias("s"), c.alias("e"), d.alias("n"))
    return F.array(box(w, s, x, y), box(x, s, e, y), box(w, y, x, n), box(x, y, e, n))


def _edges(ring: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size(ring) - 2), lambda i: F.struct(F.get(ring, i).alias("a"), F.get(ring, i + 1).alias("b")))


def signed_area(ring) -> Column:
    r = col(ring)
    cross = F.transform(_edges(r), lambda e: e["a"][0] * e["b"][1] - e["b"][0] * e["a"][1])
    return F.when(F.size(r) >= 4, F.aggregate(cross, F.lit(0.0), lambda t, x: t + x) / 2).otherwise(0.0)


def ring_length(ring) -> Column:
    r = col(ring)
    steps = F.transform(_edges(r), lambda e: F.hypot(e["b"][0] - e["a"][0], e["b"][1] - e["a"][1]))
    return F.when(F.size(r) >= 2, F.aggregate(steps, F.lit(0.0), lambda t, x: t + x)).otherwise(0.0)


def area(multi) -> Column:
    """Shells less holes, summed over the parts."""
    def part(p):
        sizes = F.transform(p, lambda r, i: F.when(i == 0, F.abs(signed_area(r))).otherwise(-F.abs(signed_area(r))))
        return F.aggregate(sizes, F.lit(0.0), lambda t, x: t + x)

    return F.aggregate(F.transform(col(multi), part), F.lit(0.0), lambda t, x: t + x)


def perimeter(multi) -> Column:
    return F.aggregate(F.transform(rings(multi), ring_length), F.lit(0.0), lambda t, x: t + x)


def inside(multi, x, y) -> Column:
    """Strictly inside by the even-odd rule over all rings of all parts; points on an edge are outside."""
    x, y = col(x).cast("double"), col(y).cast("double")

    def edge(e):
        ax, ay, bx, by = e["a"][0], e["a"][1], e["b"][0], e["b"][1]
        side = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
        on = (side == 0) & x.between(F.least(ax, bx), F.greatest(ax, bx)) & y.between(F.least(ay, by), F.greatest(ay, by))
        # crosses the ray to the right: one end above, the other not, and the point left of the edge
        up = by > ay
        hit = ((ay > y) != (by > y)) & F.when(up, side > 0).otherwise(side < 0)
        return F.when(on, F.lit(-1)).when(hit, F.lit(1)).otherwise(0)

    marks = F.flatten(F.transform(rings(multi), lambda r: F.transform(_edges(r), edge)))
    odd = F.aggregate(marks, F.lit(0), lambda t, m: t + F.when(m == 1, 1).otherwise(0)) % 2 == 1
    return F.coalesce(~F.array_contains(marks, -1) & odd, F.lit(False))


def in_box(x, y, minx, miny, maxx, maxy) -> Column:
    return F.coalesce(col(x).between(col(minx), col(maxx)) & col(y).between(col(miny), col(maxy)), F.lit(False))


def haversine_km(lon1, lat1, lon2, lat2) -> Column:
    p1, p2 = F.radians(col(lat1)), F.radians(col(lat2))
    a = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(col(lon2) - col(lon1)) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def city_box(lat, lon, km) -> Column:
    """A box of ±km about a place."""
    lat, lon, d = col(lat), col(lon), col(km) / 111.32
    e = d / F.cos(F.radians(lat))
    return F.struct((lon - e).alias("w"), (lat - d).alias("s"), (lon + e).alias("e"), (lat + d).alias("n"))


def choose_epsg(lon) -> Column:
    """The zone's projection by longitude."""
    x = col(lon)
    return (
        F.when(x < -82.5, 32617).when(x < -79.5, 32190).when(x < -76.5, 32189).when(x < -73.5, 32188).when(x < -70.5, 32187).otherwise(32619)
    )


def affine(t, x, y) -> Column:
    """[a, b, c, d, e, f]: (a x + b y + c, d x + e y + f)."""
    t, x, y = col(t), col(x), col(y)
    return F.struct((t[0] * x + t[1] * y + t[2]).alias("x"), (t[3] * x + t[4] * y + t[5]).alias("y"))


def clean_line(line) -> Column:
    """Positions without non-finite ones and without repeats of the one before."""
    fine = F.filter(col(line), lambda p: (F.size(p) >= 2) & ~F.isnan(p[0]) & ~F.isnan(p[1]) & (F.abs(p[0]) < float("inf")) & (F.abs(p[1]) < float("inf")))
    start = F.array().cast("array<array<double>>")
    return F.aggregate(fine, start, lambda out, p: F.when((F.size(out) > 0) & (F.element_at(out, -1)[0] == p[0]) & (F.element_at(out, -1)[1] == p[1]), out).otherwise(F.concat(out, F.array(p))))


def close_ring(ring) -> Column:
    r = col(ring)
    return F.when((F.size(r) > 0) & (F.element_at(r, 1) != F.element_at(r, -1)), F.concat(r, F.array(F.element_at(r, 1)))).otherwise(r)


def wkt_ring(c) -> Column:
    """Positions of a POLYGON text's outer ring, four at least."""
    inner = F.regexp_extract(col(c), r"(?i)POLYGON\s*\(\(([^)]*)\)", 1)
    ring = F.transform(F.split(inner, ","), lambda p: F.transform(F.split(F.trim(p), r"\s+"), lambda v: v.try_cast("double")))
    return F.when(F.size(ring) >= 4, ring)


# ---------------------------------------------------------------- Arrow functions


def _scan_point(parts: list) -> list[float] | None:
    """The middle of the widest inner span on the horizontal line through the middle of the box; a few other heights if there is none."""
    flat = [np.asarray([np.asarray(p, float) for p in ring], float) for part in parts for ring in part if len(ring) >= 4]
    if not flat:
        return None
    ys = np.concatenate([r[:, 1] for r in flat])
    low, high = ys.min(), ys.max()
    for share in (0.5, 0.45, 0.55, 0.4, 0.6, 0.25, 0.75):
        y = low + (high - low) * share
        cuts = []
        for r in flat:
            a, b = r[:-1], r[1:]
            over = (a[:, 1] > y) != (b[:, 1] > y)
            cuts += (a[over, 0] + (y - a[over, 1]) * (b[over, 0] - a[over, 0]) / (b[over, 1] - a[over, 1])).tolist()
        cuts.sort()
        spans = [(cuts[i + 1] - cuts[i], (cuts[i] + cuts[i + 1]) / 2) for i in range(0, len(cuts) - 1, 2)]
        if spans and max(spans)[0] > 0:
            return [max(spans, key=lambda s: s[0])[1], float(y)]
    return None


@pandas_udf(T.ArrayType(T.DoubleType()))
def representative_point(multi: pd.Series) -> pd.Series:
    return multi.map(lambda m: None if m is None else _scan_point(m))


def hull(points: np.ndarray) -> np.ndarray:
    """Convex hull, counter-clockwise, by sorted sweeps."""
    p = np.unique(points, axis=0)
    if len(p) < 3:
        return p

    def sweep(rows):
        out = []
        for q in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]):
                out.pop()
            out.append(q)
        return out[:-1]

    return np.array(sweep(p) + sweep(p[::-1]))


def oriented_sides(points: np.ndarray) -> tuple[float, float] | None:
    """Short and long side of the smallest rectangle about the points."""
    h = hull(points)
    if len(h) < 3:
        return None
    edge = np.roll(h, -1, axis=0) - h
    angle = np.arctan2(edge[:, 1], edge[:, 0])
    c, s = np.cos(angle)[:, None], np.sin(angle)[:, None]
    along, across = h[:, 0] * c + h[:, 1] * s, -h[:, 0] * s + h[:, 1] * c
    w, d = np.ptp(along, axis=1), np.ptp(across, axis=1)
    k = (w * d).argmin()
    return tuple(sorted((math.floor(w[k] * 100 + 0.5) / 100, math.floor(d[k] * 100 + 0.5) / 100)))


def transverse_mercator(lon: np.ndarray, lat: np.ndarray, centre: float, k0: float, east: float) -> tuple[np.ndarray, np.ndarray]:
    """Projected metres on the GRS80 ellipsoid, by the sixth-order series in the third flattening."""
    a, f = 6378137.0, 1 / 298.257222101
    n, e = f / (2 - f), math.sqrt(f * (2 - f))
    A = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    phi, lam = np.radians(lat), np.radians(lon - centre)
    t = np.sinh(np.arctanh(np.sin(phi)) - e * np.arctanh(e * np.sin(phi)))
    xi, eta = np.arctan2(t, np.cos(lam)), np.arctanh(np.sin(lam) / np.sqrt(1 + t * t))
    x, y = eta.copy(), xi.copy()
    for j, c in enumerate(alpha, 1):
        x = x + c * np.cos(2 * j * xi) * np.sinh(2 * j * eta)
        y = y + c * np.sin(2 * j * xi) * np.cosh(2 * j * eta)
    return east + k0 * A * x, k0 * A * y


#: EPSG → central meridian, scale, false easting.
PROJECTIONS = {32187: (-70.5, 0.9999, 304800.0), 32188: (-73.5, 0.9999, 304800.0), 32189: (-76.5, 0.9999, 304800.0), 32190: (-79.5, 0.9999, 304800.0), 32617: (-81.0, 0.9996, 500000.0), 32619: (-69.0, 0.9996, 500000.0)}


@pandas_udf(T.StructType([T.StructField(c, T.DoubleType()) for c in ("area_m2", "perimeter_m", "frontage_m", "depth_m")]))
def lot_measures(multi: pd.Series, epsg: pd.Series) -> pd.DataFrame:
    """Area, perimeter and the sides of the smallest rectangle, in the projection's metres."""
    rows = []
    for m, code in zip(multi, epsg):
        if m is None or int(code) not in PROJECTIONS:
            rows.append((None,) * 4)
            continue
        size = length = 0.0
        every = []
        for part in m:
            for i, ring in enumerate(part):
                r = np.asarray([np.asarray(p, float)[:2] for p in ring], float)
                x, y = transverse_mercator(r[:, 0], r[:, 1], *PROJECTIONS[int(code)])
                own = abs(float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum())) / 2
                size += own if i == 0 else -own
                length += float(np.hypot(np.diff(x), np.diff(y)).sum())
                every.append(np.stack([x, y], axis=1))
        sides = oriented_sides(np.concatenate(every)) if every else None
        rows.append((size, length, *(sides or (None, None))))
    return pd.DataFrame(rows, columns=["area_m2", "perimeter_m", "frontage_m", "depth_m"])
