"""Polygons: scan conversion, clipping to rectangles, and label text; arrays of (x, y) in pixels."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

POINTS = ArrayType(StructType([StructField("x", DoubleType()), StructField("y", DoubleType())]))


def edges(points: Column) -> Column:
    """Pairs (ax, ay, bx, by) of neighbouring points, the last one with the first."""
    n = F.size(points)
    at = lambda i, c: F.get(points, i)[c]
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.named_struct(F.lit("ax"), at(i, "x"), F.lit("ay"), at(i, "y"), F.lit("bx"), at((i + 1) % n, "x"), F.lit("by"), at((i + 1) % n, "y")))


def rasterize(polygons: DataFrame, size: int) -> DataFrame:
    """(obj, y, x): pixels of a square canvas whose centre lies inside a polygon, by the parity of crossings to the right.

    Rows are exploded first, each with the crossings of its centre line, so the work follows the rows and pixels set.
    """
    rows = polygons.select("obj", edges(F.col("points")).alias("e"), F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("y"))
    cy = F.col("y") + 0.5
    crossing = lambda e: e["ax"] + (cy - e["ay"]) * (e["bx"] - e["ax"]) / (e["by"] - e["ay"])
    cuts = F.transform(F.filter("e", lambda e: (e["ay"] > cy) != (e["by"] > cy)), crossing)
    rows = rows.select("obj", "y", F.array_sort(cuts).alias("cuts")).where(F.size("cuts") > 0)
    pixels = rows.select("obj", "y", "cuts", F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("x"))
    right = F.size(F.filter("cuts", lambda c: c > F.col("x") + 0.5))
    return pixels.where(right % 2 == 1).select("obj", F.col("y").cast("bigint").alias("y"), F.col("x").cast("bigint").alias("x"))


def clip(points: list, x0: float, y0: float, x1: float, y1: float) -> list[tuple[float, float]]:
    """What ``clipped`` does, for one polygon on the driver."""
    out = [(p["x"], p["y"]) for p in points]
    for axis, bound, keep in ((0, x0, 1), (0, x1, -1), (1, y0, 1), (1, y1, -1)):
        ring, out = out, []
        for a, b in zip(ring, ring[1:] + ring[:1]):
            ia, ib = (keep * (p[axis] - bound) >= 0 for p in (a, b))
            if ia:
                out.append(a)
            if ia != ib:
                t = (bound - a[axis]) / (b[axis] - a[axis])
                cut = [a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])]
                cut[axis] = bound
                out.append((cut[0], cut[1]))
    return out


def clipped(points: Column, x0: float, y0: float, x1: float, y1: float) -> Column:
    """A polygon cut to a rectangle, side by side: every edge gives its first point if that is inside, and where it crosses."""
    sides = F.array(*(F.struct(F.lit(axis).alias("axis"), F.lit(float(bound)).alias("bound"), F.lit(keep).alias("keep")) for axis, bound, keep in (("x", x0, 1), ("x", x1, -1), ("y", y0, 1), ("y", y1, -1))))
    none = F.array().cast(POINTS)

    def cut(ring: Column, side: Column) -> Column:
        at = lambda p: F.when(side["axis"] == "x", p["x"]).otherwise(p["y"])
        inside = lambda p: side["keep"] * (at(p) - side["bound"]) >= 0

        def edge(a: Column, b: Column) -> Column:
            t = (side["bound"] - at(a)) / (at(b) - at(a))
            place = lambda c: F.when(side["axis"] == c, side["bound"]).otherwise(a[c] + t * (b[c] - a[c])).alias(c)
            return F.concat(F.when(inside(a), F.array(F.struct(a["x"].alias("x"), a["y"].alias("y")))).otherwise(none), F.when(inside(a) != inside(b), F.array(F.struct(place("x"), place("y")))).otherwise(none))

        turned = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
        return F.flatten(F.zip_with(ring, turned, edge))

    return F.aggregate(sides, points.cast(POINTS), cut)


def box(points: Column) -> Column:
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def label_line(class_id: Column, points: Column, width: float, height: float, digits: int = 6) -> Column:
    """``class x1 y1 x2 y2 ...`` with coordinates as shares of the canvas."""
    pair = lambda p: F.concat_ws(" ", F.format_string(f"%.{digits}f", p["x"] / width), F.format_string(f"%.{digits}f", p["y"] / height))
    return F.concat_ws(" ", class_id.cast("string"), F.concat_ws(" ", F.transform(points, pair)))


#: Steps (dy, dx) to the eight neighbours, clockwise from the left one.
AROUND = ((0, -1), (-1, -1), (-1, 0), (-1, 1), (0, 1), (1, 1), (1, 0), (1, -1))


def border(pixels: set[tuple[int, int]]) -> list[tuple[int, int]]:
    """The outer border of an 8-connected set of pixels (y, x), clockwise from its first one; thin parts are passed twice."""
    start = min(pixels)
    at, back, out, first = start, 0, [start], None
    while True:
        for k in range(1, 9):
            turn = (back + k) % 8
            to = (at[0] + AROUND[turn][0], at[1] + AROUND[turn][1])
            if to in pixels:
                break
        else:
            return out
        if at == start:
            if first == turn:
                return out[:-1]
            first = turn if first is None else first
        # seen from the new pixel, the neighbour looked at just before is where the search goes on
        seen = (back + k - 1) % 8
        gap = (at[0] + AROUND[seen][0] - to[0], at[1] + AROUND[seen][1] - to[1])
        at, back = to, AROUND.index(gap)
        out.append(at)


def _far(points: list, a: int, b: int) -> tuple[float, int]:
    """(greatest distance of the points strictly between a and b from the segment, its place)."""
    (y0, x0), (y1, x1) = points[a], points[b]
    dy, dx = y1 - y0, x1 - x0
    best = (-1.0, a)
    for k in range(a + 1, b):
        y, x = points[k][0] - y0, points[k][1] - x0
        along = (y * dy + x * dx) / (dy * dy + dx * dx) if dy or dx else 0.0
        along = min(1.0, max(0.0, along))
        d = math.hypot(y - along * dy, x - along * dx)
        if d > best[0]:
            best = (d, k)
    return best


def simplified(ring: list[tuple[int, int]], epsilon: float) -> list[tuple[int, int]]:
    """A closed ring with points left out that lie within ``epsilon`` of what stays; it is split at the point farthest from its first."""
    if len(ring) < 3:
        return ring
    far = max(range(len(ring)), key=lambda k: (math.dist(ring[0], ring[k]), -k))
    points = [*ring, ring[0]]
    keep, todo = {0, far}, [(0, far), (far, len(ring))]
    while todo:
        a, b = todo.pop()
        d, k = _far(points, a, b)
        if d > epsilon:
            keep.add(k)
            todo += [(a, k), (k, b)]
    return [ring[k] for k in sorted(keep)]


#: Slices whose components are outlined by one task.
SLICES = 8


def outlines(labelled: DataFrame, epsilon: float = 1.0) -> DataFrame:
    """(t, root, points): the outer outline of every component (t, y, x, root) that has three points at least; a group is a few slices.

    Points are pixel centres, clockwise from the first pixel; holes are not told.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for (t, root), own in pdf.groupby(["t", "root"]):
            ring = simplified(border(set(zip(own["y"].tolist(), own["x"].tolist()))), epsilon)
            if len(ring) >= 3:
                rows.append((t, root, [{"x": float(x), "y": float(y)} for y, x in ring]))
        t, root, points = zip(*rows) if rows else ((), (), ())
        return pd.DataFrame({"t": pd.Series(t, dtype="int64"), "root": pd.Series(root, dtype="int64"), "points": pd.Series(list(points), dtype=object)})

    schema = StructType([StructField("t", LongType()), StructField("root", LongType()), StructField("points", POINTS)])
    return labelled.select("t", "y", "x", "root").groupBy(F.floor(F.col("t") / SLICES).alias("g")).applyInPandas(run, schema)
