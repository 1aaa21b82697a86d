"""Lines to polygons, drawing paths to rings, plan coordinates to places."""

from __future__ import annotations

import math
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Point = tuple[float, float]


def _cut(segments: list[tuple[Point, Point]]) -> set[tuple[Point, Point]]:
    """Segments split where they cross or touch each other; places are rounded to nine digits."""
    snap = lambda p: (round(p[0], 9), round(p[1], 9))
    segments = [(snap(a), snap(b)) for a, b in segments if snap(a) != snap(b)]
    marks: list[set[Point]] = [{a, b} for a, b in segments]
    order = sorted(range(len(segments)), key=lambda i: min(segments[i][0][0], segments[i][1][0]))
    for n, i in enumerate(order):
        (ax, ay), (bx, by) = segments[i]
        right = max(ax, bx)
        for j in order[n + 1 :]:
            (cx, cy), (dx, dy) = segments[j]
            if min(cx, dx) > right:
                break
            if max(cy, dy) < min(ay, by) or min(cy, dy) > max(ay, by):
                continue
            cross = (bx - ax) * (dy - cy) - (by - ay) * (dx - cx)
            if cross:
                t = ((cx - ax) * (dy - cy) - (cy - ay) * (dx - cx)) / cross
                u = ((cx - ax) * (by - ay) - (cy - ay) * (bx - ax)) / cross
                if -1e-9 <= t <= 1 + 1e-9 and -1e-9 <= u <= 1 + 1e-9:
                    p = snap((ax + t * (bx - ax), ay + t * (by - ay)))
                    marks[i].add(p)
                    marks[j].add(p)
            else:  # parallel: ends that lie on the other one
                for p, (sx, sy), (ex, ey), k in (((cx, cy), (ax, ay), (bx, by), i), ((dx, dy), (ax, ay), (bx, by), i), ((ax, ay), (cx, cy), (dx, dy), j), ((bx, by), (cx, cy), (dx, dy), j)):
                    if abs((ex - sx) * (p[1] - sy) - (ey - sy) * (p[0] - sx)) < 1e-12 and min(sx, ex) <= p[0] <= max(sx, ex) and min(sy, ey) <= p[1] <= max(sy, ey):
                        marks[k].add(p)
    edges = set()
    for (a, _), own in zip(segments, marks):
        line = sorted(own, key=lambda p: (p[0] - a[0]) ** 2 + (p[1] - a[1]) ** 2)
        edges |= {tuple(sorted(e)) for e in zip(line, line[1:]) if e[0] != e[1]}
    return edges


def polygonize(lines: list[list[Point]]) -> list[list[Point]]:
    """Closed rings of the faces that the lines enclose, counter-clockwise; dangling ends bound nothing."""
    edges = _cut([(tuple(a), tuple(b)) for line in lines for a, b in zip(line, line[1:])])
    around: dict[Point, list[Point]] = defaultdict(list)
    for a, b in edges:
        around[a].append(b)
        around[b].append(a)
    loose = [p for p, n in around.items() if len(n) == 1]
    while loose:
        p = loose.pop()
        if len(around[p]) == 1:
            q = around[p].pop()
            around[q].remove(p)
            if len(around[q]) == 1:
                loose.append(q)
    turn = {p: sorted(n, key=lambda q: math.atan2(q[1] - p[1], q[0] - p[0])) for p, n in around.items() if n}
    seen, faces = set(), []
    for p, n in turn.items():
        for q in n:
            if (p, q) in seen:
                continue
            ring, a, b = [p], p, q
            while (a, b) not in seen:
                seen.add((a, b))
                ring.append(b)
                # the next edge clockwise from the way back
                a, b = b, turn[b][turn[b].index(a) - 1]
            size = sum(x0 * y1 - x1 * y0 for (x0, y0), (x1, y1) in zip(ring, ring[1:]))
            if size > 1e-12:
                faces.append(ring)
    return faces


def polygons(lines: DataFrame, by: str, line: str) -> DataFrame:
    """by, pos, ring: faces of each group's lines. A group is one drawing, which is read whole."""
    kind = lines.schema[by].dataType.simpleString()

    def faces(tab: pa.Table) -> pa.Table:
        found = polygonize([[(p[0], p[1]) for p in x] for x in tab[line].to_pylist()])
        n = len(found)
        return pa.table({by: tab[by].slice(0, 1).take(pa.array([0] * n, pa.int32())), "pos": pa.array(range(n), pa.int32()), "ring": pa.array([[list(p) for p in r] for r in found], pa.list_(pa.list_(pa.float64())))})

    return lines.select(by, line).groupBy(by).applyInArrow(faces, f"{by} {kind}, pos int, ring array<array<double>>")


_STEP = re.compile(r"([MmLlHhVvCcZz])|(-?\d*\.?\d+(?:[eE][+-]?\d+)?)")
_NEEDS = {"M": 2, "L": 2, "H": 1, "V": 1, "C": 6}


def path_ring(path: str, curve: int = 8) -> list[Point] | None:
    """The ring of a closed drawing path (moves, lines, cubic curves as chords); None if it does not close or has fewer than three corners."""
    ring: list[Point] = []
    here, op, held, closed = (0.0, 0.0), "", [], False
    for letter, number in _STEP.findall(path):
        if letter:
            op, held = letter, []
            if letter in "Zz":
                closed = True
                break
            continue
        held.append(float(number))
        if len(held) < _NEEDS.get(op.upper(), 99):
            continue
        x, y = here if op.islower() else (0.0, 0.0)
        if op.upper() == "C":
            (p1, p2, p3) = [(x + held[i], y + held[i + 1]) for i in (0, 2, 4)]
            for k in range(1, curve + 1):
                t = k / curve
                w = ((1 - t) ** 3, 3 * t * (1 - t) ** 2, 3 * t * t * (1 - t), t**3)
                ring.append(tuple(sum(a * q[d] for a, q in zip(w, (here, p1, p2, p3))) for d in (0, 1)))
            here = p3
        else:
            here = (x + held[0], y + held[1]) if op.upper() in "ML" else (x + held[0], here[1]) if op.upper() == "H" else (here[0], y + held[0])
            ring.append(here)
            if op.upper() == "M":
                op = "l" if op == "m" else "L"
        held = []
    if ring and ring[0] == ring[-1] and len(ring) > 1:
        closed, ring = True, ring[:-1]
    return [*ring, ring[0]] if closed and len(ring) >= 3 else None


def drawn_rings(svg: str) -> list[list[Point]]:
    """Rings of all closed paths of a drawing."""
    return [r for p in re.findall(r"<path\b[^>]*\sd=[\"']([^\"']+)[\"']", svg) if (r := path_ring(p))]


def plan_point(x: float, y: float, page_height: float, scale: float, transform: list[float]) -> Point:
    """A point of a page (in points, upward) through pixels (downward) and an affine transform to the ground."""
    px, py = x * scale, (page_height - y) * scale
    a, b, c, d, e, f = transform
    return a * px + b * py + c, d * px + e * py + f


def usable_lines(df: DataFrame, line: str) -> DataFrame:
    """Lines of two places at least, without repeats and non-finite ones."""
    from .geometry import clean_line

    return df.withColumn(line, clean_line(line)).filter(F.size(line) >= 2)
