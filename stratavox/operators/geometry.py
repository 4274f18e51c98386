"""Views, tiles, projections and resampling as column expressions and equi-joins on computed indices."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavox.functions import numbers

AT = ["t", "y", "x"]

#: Normal, right and up axes of the six cube faces (front, right, back, left, top, bottom).
FACES = (
    ((1, 0, 0), (0, 1, 0), (0, 0, 1)),
    ((0, 1, 0), (-1, 0, 0), (0, 0, 1)),
    ((-1, 0, 0), (0, -1, 0), (0, 0, 1)),
    ((0, -1, 0), (1, 0, 0), (0, 0, 1)),
    ((0, 0, 1), (0, 1, 0), (-1, 0, 0)),
    ((0, 0, -1), (0, 1, 0), (1, 0, 0)),
)


def axis_starts(extent: Column, size: int, stride: int) -> Column:
    """Starts of tiles along an axis, the last one pinned to the end; one tile where the axis is no longer than a tile."""
    last = F.greatest(extent - size, F.lit(0))
    return F.array_sort(F.array_distinct(F.concat(F.sequence(F.lit(0).cast("bigint"), last, F.lit(stride).cast("bigint")), F.array(last))))


def tile_grid(canvases: DataFrame, size: int = 1008, stride: int = 756) -> DataFrame:
    """Row-major tiles (tile, row, col, left, top) of every canvas (canvas, width, height)."""
    rows = canvases.select("canvas", "width", F.posexplode(axis_starts(F.col("height"), size, stride)).alias("row", "top"))
    cols = rows.select("canvas", "row", "top", F.size(axis_starts(F.col("width"), size, stride)).alias("n"), F.posexplode(axis_starts(F.col("width"), size, stride)).alias("col", "left"))
    tile = (F.col("row") * F.col("n") + F.col("col")).cast("bigint")
    return cols.select("canvas", tile.alias("tile"), F.col("row").cast("bigint").alias("row"), F.col("col").cast("bigint").alias("col"), "left", "top")


def tile_neighbours(tiles: DataFrame, size: int = 1008) -> DataFrame:
    """Pairs of tiles one row or column apart at most, with the rectangle that they share; an equi-join on shifted places."""
    near = F.explode(F.array(*(F.struct(F.lit(r).alias("dr"), F.lit(c).alias("dc")) for r in (-1, 0, 1) for c in (-1, 0, 1) if r or c)))
    a = tiles.select("canvas", F.col("tile").alias("source"), F.col("left").alias("l0"), F.col("top").alias("t0"), "row", "col", near.alias("d"))
    a = a.select("canvas", "source", "l0", "t0", (F.col("row") + F.col("d.dr")).alias("row"), (F.col("col") + F.col("d.dc")).alias("col"))
    b = tiles.select("canvas", "row", "col", F.col("tile").alias("destination"), F.col("left").alias("l1"), F.col("top").alias("t1"))
    out = a.join(b, ["canvas", "row", "col"])
    edge = lambda f, x, y, d: f(F.col(x) + d, F.col(y) + d)
    return out.select("canvas", "source", "destination", edge(F.greatest, "l0", "l1", 0).alias("x0"), edge(F.greatest, "t0", "t1", 0).alias("y0"), edge(F.least, "l0", "l1", size).alias("x1"), edge(F.least, "t0", "t1", size).alias("y1"))


def rebase(pixels: DataFrame, size: int) -> DataFrame:
    """Pixels (x, y) of a source tile in the coordinates of a neighbour (l0, t0 -> l1, t1); those outside go."""
    moved = pixels.withColumn("x", F.col("x") + F.col("l0") - F.col("l1")).withColumn("y", F.col("y") + F.col("t0") - F.col("t1"))
    return moved.where(F.col("x").between(0, size - 1) & F.col("y").between(0, size - 1))


def resize_nearest(mask: DataFrame, axis: str, n_in: int, n_out: int) -> DataFrame:
    """Endpoint-aligned nearest resampling of one axis of a mask, by a join with the table of source indices."""
    table = mask.sparkSession.range(n_out).select(F.col("id").alias("__out"), numbers.nearest_index(F.col("id"), F.lit(n_out), F.lit(n_in)).alias(axis))
    return mask.join(table, axis).withColumn(axis, F.col("__out")).drop("__out")


def restore(mask: DataFrame, axis: str, n_in: int, n_out: int) -> DataFrame:
    """A mask back on an axis of ``n_out`` places: shrinking takes the OR of all covered places, growing the nearest."""
    if n_in < n_out:
        return resize_nearest(mask, axis, n_in, n_out)
    first = F.floor(F.col(axis) * n_out / n_in).cast("bigint")
    last = F.least(F.lit(n_out - 1), (F.ceil((F.col(axis) + 1) * n_out / F.lit(n_in)) - 1).cast("bigint"))
    return mask.withColumn(axis, F.explode(F.sequence(first, last))).distinct()


#: Axes of a view's stack, rows and columns in the native volume.
VIEW_AXES = {"transverse": ("t", "y", "x"), "coronal": ("y", "t", "x"), "sagittal": ("x", "t", "y")}


def assemble_views(mask: DataFrame, grid: int, native: dict[str, int]) -> DataFrame:
    """(volume, t, y, x): views (volume, view, stack, row, col) on cubes of ``grid`` places, united on the native axes.

    A view's axes are renamed, then each is brought to the native length: OR over all covered places where it shrinks, the
    nearest place where it grows.
    """
    named = lambda c, axis: F.element_at(F.create_map(*(F.lit(x) for view, axes in VIEW_AXES.items() for x in (view, "stack row col".split()[axes.index(axis)]))), F.col(c))
    place = lambda axis: F.when(named("view", axis) == "stack", F.col("stack")).when(named("view", axis) == "row", F.col("row")).otherwise(F.col("col"))
    out = mask.where(F.col("view").isin(*VIEW_AXES)).select("volume", *(place(axis).alias(axis) for axis in ("t", "y", "x"))).distinct()
    for axis, n in native.items():
        if n != grid:
            out = restore(out, axis, grid, n)
    return out.select("volume", "t", "y", "x")


def downbin(mask: DataFrame, by: int) -> DataFrame:
    """OR over square blocks of a slice, with how much of each block was set."""
    block = lambda c: F.floor(F.col(c) / by).cast("bigint").alias(c)
    return mask.groupBy("t", block("y"), block("x")).agg((F.count("*") / (by * by)).alias("share"))


def affine(width: int, height: int, out: int, angle: float) -> tuple[float, ...]:
    """Source-to-output matrix (m00..m12): a turn by ``angle`` about the centre, then the centre-preserving scale."""
    a = math.radians(angle)
    c, s = math.cos(a), math.sin(a)
    cx, cy, sx, sy, o = (width - 1) / 2, (height - 1) / 2, out / width, out / height, (out - 1) / 2
    turn = ((c, s, (1 - c) * cx - s * cy), (-s, c, s * cx + (1 - c) * cy))
    return (sx * turn[0][0], sx * turn[0][1], sx * turn[0][2] + o - sx * cx, sy * turn[1][0], sy * turn[1][1], sy * turn[1][2] + o - sy * cy)


def invert(m: tuple[float, ...]) -> tuple[float, ...]:
    a, b, c, d, e, f = m
    det = a * e - b * d
    return (e / det, -b / det, (b * f - c * e) / det, -d / det, a / det, (c * d - a * f) / det)


def warp_nearest(mask: DataFrame, matrix: tuple[float, ...], out: int) -> DataFrame:
    """Each output pixel takes the source pixel that the inverse of ``matrix`` leads to; an equi-join on that place."""
    a, b, c, d, e, f = (F.lit(v) for v in invert(matrix))
    spark = mask.sparkSession
    grid = spark.range(out * out).select((F.col("id") % out).alias("ox"), F.floor(F.col("id") / out).alias("oy"))
    at = lambda p, q, r: F.rint(F.round(p * F.col("ox") + q * F.col("oy") + r, 9)).cast("bigint")
    table = grid.select("oy", "ox", at(d, e, f).alias("y"), at(a, b, c).alias("x"))
    return mask.join(table, ["y", "x"]).select("t", F.col("oy").alias("y"), F.col("ox").alias("x"))


def azimuthal_index(y: Column, x: Column, cy: float, cx: float, radius: float, n_angles: int, width: int) -> tuple[Column, Column, Column]:
    """(inside, angle index, diameter index) of plane pixels in a fan of ``n_angles`` frames over half a turn."""
    dx, dy, step = x - cx, y - cy, 180.0 / n_angles
    theta = F.pmod(F.degrees(F.atan2(dy, dx)), F.lit(180.0))
    k = F.pmod(F.rint(F.round(theta / step, 9)).cast("bigint"), F.lit(n_angles))
    a = F.radians(k * step)
    u = (dx * F.cos(a) + dy * F.sin(a) + radius) / (2 * radius) * (width - 1)
    return F.sqrt(dx * dx + dy * dy) <= radius + 0.5, k, F.greatest(F.lit(0), F.least(F.lit(width - 1), F.rint(F.round(u, 9)).cast("bigint")))


def radial_shells(minimum: float, maximum: float, gap: float = 1.0) -> list[float]:
    """Radii from ``minimum`` to ``maximum``, both included, evenly and at most ``gap`` apart."""
    n = max(1, math.ceil((maximum - minimum) / gap - 1e-12))
    return [minimum + (maximum - minimum) * k / n for k in range(n + 1)]


def shell_index(y: Column, x: Column, cy: float, cx: float, minimum: float, step: float, n: int) -> Column:
    """Nearest shell of a pixel; half-way goes to the inner one, outside the shells is null."""
    r = (F.sqrt((x - cx) ** 2 + (y - cy) ** 2) - minimum) / step
    k = F.ceil(F.round(r, 9) - 0.5).cast("bigint")
    return F.when(k.between(0, n - 1), k)


def shell_arc(y: Column, x: Column, cy: float, cx: float, radius: Column) -> Column:
    """Arc position of a pixel on its shell, from angle zero, in pixels."""
    turn = F.atan2(y - cy, x - cx)
    return F.floor(F.round(F.pmod(turn, F.lit(2 * math.pi)) * radius, 9) + 0.5).cast("bigint")


def cube_face(x: Column, y: Column, z: Column) -> Column:
    """Face whose normal a direction points along most; the lowest one on ties."""
    dots = [n[0] * x + n[1] * y + n[2] * z for n, _, _ in FACES]
    return F.array_position(F.array(*dots), F.greatest(*dots)) - 1


def cube_uv(rows: DataFrame, x: str, y: str, z: str, face: str) -> DataFrame:
    """Adds u and v, the equal-area coordinates in [-1, 1] of a direction on its face of the quadrilateralised cube.

    Every step is a column of its own, so that no expression is repeated inside another.
    """
    norm = F.sqrt(F.col(x) ** 2 + F.col(y) ** 2 + F.col(z) ** 2)
    along = lambda axis: F.element_at(F.array(*(f[axis][0] * F.col(x) + f[axis][1] * F.col(y) + f[axis][2] * F.col(z) for f in FACES)), (F.col(face) + 1).cast("int")) / norm
    right, up, major, minor, theta, p = (F.col(f"__{c}") for c in ("right", "up", "major", "minor", "theta", "p"))
    area = F.when(F.abs(right) >= F.abs(up), F.when(right >= 0, 0).otherwise(2)).otherwise(F.when(up >= 0, 1).otherwise(3))
    turn = lambda *by: F.when(F.col("__area") == 0, by[0]).when(F.col("__area") == 1, by[1]).when(F.col("__area") == 2, by[2]).otherwise(by[3])
    ratio = (12 / math.pi) * (theta - F.asin(F.sin(theta) * (1 / math.sqrt(2))))
    cosine = F.cos(theta)
    steps = [
        {"__normal": along(0), "__right": along(1), "__up": along(2)},
        {"__area": area, "__major": F.greatest(F.abs(right), F.abs(up))},
        {"__minor": turn(up, -right, -up, right)},
        {"__theta": F.atan2(minor, major)},
        {"__p": F.when(major == F.col("__normal"), F.lit(1.0)).otherwise(F.hypot(right, up) / F.sqrt((1 + F.col("__normal")) * (1 - cosine / F.sqrt(1 + cosine * cosine)))), "__ratio": F.when(F.abs(minor) == major, F.signum(minor)).otherwise(ratio)},
        {"__small": p * F.col("__ratio")},
    ]
    for step in steps:
        rows = rows.withColumns(step)
    clip = lambda c: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c))
    small = F.col("__small")
    rows = rows.withColumns({"u": clip(turn(p, -small, -p, small)), "v": clip(turn(small, p, -small, -p))})
    return rows.drop("__normal", "__right", "__up", "__area", "__major", "__minor", "__theta", "__p", "__ratio", "__small")


def gaussian_taps(sigma: float, truncate: float = 4.0) -> list[float]:
    """Weights of a sampled Gaussian that add up to one, from the centre to its end on both sides."""
    r = int(truncate * sigma + 0.5)
    w = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-r, r + 1)]
    return [v / math.fsum(w) for v in w]


def smooth(mask: DataFrame, sigma: float, size: int, depth: int | None = None, threshold: float = 0.5) -> DataFrame:
    """A mask after a separable Gaussian with zero padding and a threshold; one pass of taps for each axis.

    With a ``depth`` the pass runs over t as well, the same in all three axes; without, slices are smoothed on their own.
    """
    taps = gaussian_taps(sigma)
    r = len(taps) // 2
    table = F.explode(F.array(*(F.struct(F.lit(k - r).alias("d"), F.lit(w).alias("w")) for k, w in enumerate(taps))))
    rows = mask.select(*AT).distinct().withColumn("v", F.lit(1.0))
    for axis, n in (("y", size), ("x", size), ("t", depth)):
        if n is None:
            continue
        rows = rows.withColumn("tap", table).withColumn(axis, F.col(axis) + F.col("tap.d")).where(F.col(axis).between(0, n - 1))
        rows = rows.groupBy(*AT).agg(F.sum(F.col("v") * F.col("tap.w")).alias("v"))
    return rows.where(F.round("v", 9) >= threshold).select(*AT)


def context_stack(frames: DataFrame, offsets: list[int], n: int, circular: bool = False) -> DataFrame:
    """(frame, channel, source, mirrored): source frames of every channel; off the axis clamps, or wraps and mirrors.

    A centre whose source is inside the axis but not among the frames is left out with all its channels.
    """
    rows = frames.select("frame").distinct().select("frame", F.posexplode(F.array(*map(F.lit, offsets))).alias("channel", "o"))
    if circular:
        source, mirrored = numbers.context_index(F.col("frame"), F.col("o"), F.lit(n))
    else:
        source, mirrored = numbers.clamped_index(F.col("frame"), F.col("o"), F.lit(n)), F.lit(False)
    rows = rows.select("frame", "channel", source.cast("bigint").alias("source"), mirrored.alias("mirrored"))
    there = frames.select(F.col("frame").alias("source")).distinct()
    lost = rows.join(there, "source", "left_anti").select("frame").distinct()
    return rows.join(lost, "frame", "left_anti")


def polygon_area(points: Column) -> Column:
    """Shoelace area of an array of (x, y)."""
    n = F.size(points)
    pairs = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get(points, i).alias("a"), F.get(points, (i + 1) % n).alias("b")))
    cross = F.aggregate(pairs, F.lit(0.0), lambda acc, p: acc + p["a"]["x"] * p["b"]["y"] - p["b"]["x"] * p["a"]["y"])
    return F.abs(cross) / 2
