"""Views of a volume: axes, affine placements, sampling plans, and frames rendered from voxels and projected back.

Placements and plans are column expressions over tables of views. Rendering computes, for each pixel of a frame, where it
lies in the volume, and joins the voxels there; projecting back computes, for each voxel, which pixel shows it. Both are
equi-joins on computed places.
"""

from __future__ import annotations

import functools
import math
import operator

import numpy as np

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavox.operators.geometry import FACES, cube_uv

#: Largest certified squared sampling error in a plane and on spheres, and the roundoff by which a direction
#: may miss a closed face.
BUDGET, SPHERE_BUDGET, TOLERANCE = 0.99, 281 / 324, 8 * 2.0**-52
AXES = ("m00", "m01", "m02", "m10", "m11", "m12")


def axis_specs(volumes: DataFrame) -> DataFrame:
    """(volume, view, num_slices, src_h, src_w, stack_axis, vertical_axis, horizontal_axis) of the three base views of (volume, n_t, n_h, n_w)."""
    t, h, w = (F.col(f"n_{c}") for c in "thw")
    spec = lambda view, n, sh, sw, axes: F.struct(F.lit(view).alias("view"), n.alias("num_slices"), sh.alias("src_h"), sw.alias("src_w"), *(F.lit(a).alias(f"{k}_axis") for k, a in zip(("stack", "vertical", "horizontal"), axes)))
    views = F.array(spec("transverse", t, h, w, "tyx"), spec("sagittal", h, t, w, "ytx"), spec("coronal", w, t, h, "xty"))
    return volumes.select("volume", F.explode(views).alias("v")).select("volume", "v.*")


def placed(rows: DataFrame, padded: bool) -> DataFrame:
    """Adds the source-to-output matrix m00 .. m12 of (src_w, src_h, out, angle): padding, a turn, centre-preserving scale.

    A padded canvas is the square that holds the turned source.
    """
    w, h, out = (F.col(c).cast("double") for c in ("src_w", "src_h", "out"))
    rows = rows.withColumns({"__c": F.cos(F.radians("angle")), "__s": F.sin(F.radians("angle"))})
    across, along = F.abs("__c"), F.abs("__s")
    side = F.greatest(F.ceil(F.round(F.greatest(w * across + h * along, w * along + h * across), 9)).cast("double"), w, h)
    rows = rows.withColumns({"__cw": side if padded else w, "__ch": side if padded else h})
    cw, ch, c, s = (F.col(f"__{k}") for k in ("cw", "ch", "c", "s"))
    cx, cy, sx, sy, ox, oy = (cw - 1) / 2, (ch - 1) / 2, out / cw, out / ch, (cw - w) / 2, (ch - h) / 2
    mx, my = (1 - c) * cx - s * cy + c * ox + s * oy, s * cx + (1 - c) * cy - s * ox + c * oy
    entries = (sx * c, sx * s, sx * mx + (out - 1) / 2 - sx * cx, -sy * s, sy * c, sy * my + (out - 1) / 2 - sy * cy)
    return rows.withColumns(dict(zip(AXES, entries))).drop("__cw", "__ch", "__c", "__s")


def inverse(rows: DataFrame) -> DataFrame:
    """The matrix replaced by its inverse."""
    a, b, c, d, e, f = map(F.col, AXES)
    det = a * e - b * d
    return rows.withColumns(dict(zip(AXES, (e / det, -b / det, (b * f - c * e) / det, -d / det, a / det, (c * d - a * f) / det))))


def composed(rows: DataFrame, outer: list[Column]) -> DataFrame:
    """The matrix ``outer`` after the row's own; what is the identity within 2e-5 becomes exactly that."""
    a, b, c, d, e, f = map(F.col, AXES)
    g, h, i, j, k, l = outer  # noqa: E741
    entries = (g * a + h * d, g * b + h * e, g * c + h * f + i, j * a + k * d, j * b + k * e, j * c + k * f + l)
    rows = rows.withColumns(dict(zip(AXES, entries)))
    same = identity()
    return rows.withColumns({m: F.when(same, F.lit(v)).otherwise(F.col(m)) for m, v in zip(AXES, (1.0, 0.0, 0.0, 0.0, 1.0, 0.0))})


def identity(tolerance: float = 2e-5) -> Column:
    """Whether the matrix is the identity within a tolerance."""
    return F.greatest(*(F.abs(F.col(m) - v) for m, v in zip(AXES, (1.0, 0.0, 0.0, 0.0, 1.0, 0.0)))) <= tolerance


def mirrored(rows: DataFrame, width: Column) -> DataFrame:
    """Output-to-source matrices with the source's horizontal axis reversed."""
    return rows.withColumns({"m00": -F.col("m00"), "m01": -F.col("m01"), "m02": F.greatest(width - 1, F.lit(0)) - F.col("m02")})


def crop_windows(rows: DataFrame, border: int = 2) -> DataFrame:
    """Adds py0, py1, px0, px1: the window of the parent plane (plane_h, plane_w) that an output of ``out`` pixels can touch.

    The hull of the output's corners with a border, slid into the plane without shrinking below what the plane holds; the
    matrix becomes that from the output to the window.
    """
    n = F.col("out") - 0.5
    corners = [(F.lit(-0.5), F.lit(-0.5)), (n, F.lit(-0.5)), (F.lit(-0.5), n), (n, n)]
    for axis, m, plane in (("x", AXES[:3], "plane_w"), ("y", AXES[3:], "plane_h")):
        at = [F.round(F.col(m[0]) * x + F.col(m[1]) * y + F.col(m[2]), 9) for x, y in corners]
        rows = rows.withColumns({"__lo": F.floor(F.least(*at)) - border, "__hi": F.ceil(F.greatest(*at)) + 1 + border})
        size = F.greatest(F.lit(1), F.least(F.col(plane), F.col("__hi") - F.col("__lo")))
        rows = rows.withColumn("__n", size).withColumn(f"p{axis}0", F.greatest(F.lit(0), F.least(F.col("__lo"), F.col(plane) - F.col("__n"))))
        rows = rows.withColumn(f"p{axis}1", F.col(f"p{axis}0") + F.col("__n")).withColumn(m[2], F.col(m[2]) - F.col(f"p{axis}0")).drop("__lo", "__hi", "__n")
    return rows


def raster_scale(plane_h: Column, plane_w: Column, src_h: Column, src_w: Column) -> Column:
    """Smaller of the two scales from a source to the raster it is processed on."""
    return F.least(plane_h / F.greatest(src_h, F.lit(1)), plane_w / F.greatest(src_w, F.lit(1)))


def raster_angle(angle: Column, scale: Column) -> Column:
    """Angle of a search cone on that raster."""
    return F.when((angle == 0) | (scale == 1), angle).otherwise(F.degrees(F.atan(F.tan(F.radians(angle)) * scale)))


def azimuths(spacing: Column) -> Column:
    """Angles from 0 up to 180 by repeated addition of ``spacing``; none without a positive one."""
    n = F.ceil(180.0 / spacing).cast("int") + 2
    added = F.aggregate(F.sequence(F.lit(1), n), F.array(F.lit(0.0)), lambda acc, _: F.concat(acc, F.array(F.element_at(acc, -1) + spacing)))
    return F.when(spacing > 0, F.filter(added, lambda a: a < 180.0 - 1e-9)).otherwise(F.array().cast("array<double>"))


def full_coverage_spacing(diameter: Column) -> Column:
    return 360.0 / (math.pi * F.greatest(diameter, F.lit(1)))


def azimuthal_plan(views: DataFrame) -> DataFrame:
    """Adds spacing, frames and optimised to (diameter, src_w, src_h, stack, num_slices): the coarsest certified sweep.

    Along a diameter a sample is half a voxel away at most, across it D / 2 times half the angle between frames; the two
    squares may reach BUDGET. Views whose raster is coarser than the plane, or that gain nothing, keep their frames.
    """
    spacing = full_coverage_spacing(F.col("diameter")) * math.sqrt(4 * BUDGET - 1)
    views = views.withColumn("spacing", spacing).withColumn("__n", F.size(azimuths(F.col("spacing"))))
    able = (F.col("diameter") > 0) & (F.col("src_w") >= F.col("diameter")) & (F.col("src_h") >= F.col("stack")) & (F.col("__n") < F.col("num_slices"))
    return views.withColumns({"optimised": able, "frames": F.when(able, F.col("__n")).otherwise(F.col("num_slices"))}).drop("__n")


def certified_radial_gap(minimum: Column) -> Column:
    """Largest gap of shells from radius ``minimum`` on whose squared planar error stays within BUDGET.

    The error is (gap / 2)^2 + 1/4 + gap / (8 minimum); this is the positive root without cancellation.
    """
    spare, slope = 4 * BUDGET - 1, 0.25 / minimum
    return spare / (F.sqrt(spare + slope * slope) + slope)


def radial_error(gap: Column, minimum: Column) -> Column:
    return gap * gap / 4 + 0.25 + gap / (8 * minimum)


def face_intervals(radius: Column) -> Column:
    """Even number of intervals of a cube face's grid that samples a sphere densely."""
    return 2 * F.greatest(F.lit(1), F.ceil(1.5 * F.sqrt(radius) * F.sqrt(radius + 0.5))).cast("bigint")


def spherical_plan(rows: DataFrame) -> DataFrame:
    """Adds the plan of fewest frames to (minimum, maximum, patch): intervals, patches, shells, frames, dense_frames, optimised.

    A face is covered by k x k patches, which hold an even number of intervals n; n fixes the angular error
    2 (maximum / n)^2, the rest of SPHERE_BUDGET the gap of shells. All k up to the dense plan's are compared by (frames, k); one
    not better than the dense plan is not taken.
    """
    span = F.col("maximum") - F.col("minimum")
    shells = F.greatest(F.lit(1), F.ceil(span) + 1).cast("bigint")
    rows = rows.withColumns({"__n": face_intervals(F.col("maximum")), "__shells": shells, "__id": F.monotonically_increasing_id()})
    rows = rows.withColumn("__k", F.floor((F.col("__n") + F.col("patch")) / F.col("patch")))
    rows = rows.withColumn("dense_frames", 6 * F.col("__k") * F.col("__k") * F.col("__shells"))
    tries = F.sequence(F.lit(1).cast("bigint"), F.col("__k"))
    n = lambda k: 2 * F.floor((k * F.col("patch") - 1) / 2)
    left = lambda k: SPHERE_BUDGET - 2 * (F.col("maximum") / n(k)) * (F.col("maximum") / n(k))
    # the tiny factors round outwards
    count = lambda k: F.greatest(F.when(span > 0, 2).otherwise(1), F.ceil(span / (2 * F.sqrt(left(k)) * (1 - 1e-13))) + 1).cast("bigint")
    plans = F.transform(F.filter(tries, lambda k: (n(k) > 0) & (left(k) > 1e-12)), lambda k: F.struct((6 * k * k * count(k)).alias("frames"), k.alias("patches"), count(k).alias("shells"), n(k).alias("intervals")))
    rows = rows.withColumn("__best", F.array_min(plans))
    better = F.coalesce(F.col("__best.frames") < F.col("dense_frames"), F.lit(False))
    pick = {"frames": "dense_frames", "patches": "__k", "shells": "__shells", "intervals": "__n"}
    return rows.withColumn("optimised", better).withColumns({c: F.when(F.col("optimised"), F.col(f"__best.{c}")).otherwise(F.col(d)) for c, d in pick.items()}).drop("__n", "__shells", "__k", "__best", "__id")


def face_members(rows: DataFrame, x: str, y: str, z: str) -> DataFrame:
    """One row for each closed face that holds a direction, with its u and v: edges have two, corners three."""
    return on_face(rows.withColumn("face", F.explode(F.array(*(F.lit(f) for f in range(6))))), x, y, z)


def on_face(rows: DataFrame, x: str, y: str, z: str) -> DataFrame:
    """The rows whose closed ``face`` holds their direction, with its u and v."""
    largest = F.greatest(F.abs(F.col(x)), F.abs(F.col(y)), F.abs(F.col(z)))
    rows = rows.where(largest > 0)
    along = lambda axis: F.element_at(F.array(*(f[axis][0] * F.col(x) + f[axis][1] * F.col(y) + f[axis][2] * F.col(z) for f in FACES)), (F.col("face") + 1).cast("int")) / largest
    inside = (along(0) > 0) & (along(0) + TOLERANCE >= F.greatest(F.abs(along(1)), F.abs(along(2))))
    return cube_uv(_settled(rows.where(inside)), x, y, z, "face")


def _settled(rows: DataFrame) -> DataFrame:
    """``rows``, each through an array of itself: later expressions then read the columns instead of repeating their terms."""
    return rows.select(F.explode(F.array(F.struct("*"))).alias("__s")).select("__s.*")


def cube_direction(rows: DataFrame, face: str, u: str, v: str) -> DataFrame:
    """Adds dx, dy, dz: the unit direction of equal-area coordinates on a face, the inverse of ``cube_uv``."""
    cu, cv = F.col(u), F.col(v)
    area = F.when(F.abs(cu) >= F.abs(cv), F.when(cu >= 0, 0).otherwise(2)).otherwise(F.when(cv >= 0, 1).otherwise(3))
    turn = lambda *by: F.when(F.col("__area") == 0, by[0]).when(F.col("__area") == 1, by[1]).when(F.col("__area") == 2, by[2]).otherwise(by[3])
    col = lambda name: F.col(f"__{name}")
    root = 1 / math.sqrt(2)
    steps = [
        {"__area": area, "__p": F.greatest(F.abs(cu), F.abs(cv))},
        {"__ratio": F.when(col("p") == 0, F.lit(0.0)).otherwise(turn(cv, -cu, -cv, cu) / col("p"))},
        {"__up": F.sin(col("ratio") * (math.pi / 12)), "__on": F.cos(col("ratio") * (math.pi / 12)) - root},
        {"__len": F.sqrt(col("up") * col("up") + col("on") * col("on"))},
        {"__cos": F.when(F.abs(col("ratio")) == 1, F.lit(root)).otherwise(col("on") / col("len")), "__sin": F.when(F.abs(col("ratio")) == 1, F.signum(col("ratio")) * root).otherwise(col("up") / col("len"))},
        {"__d": 1 - col("cos") / F.sqrt(1 + col("cos") * col("cos"))},
        {"__normal": 1 - col("p") * col("p") * col("d"), "__far": col("p") * F.sqrt(col("d") * (2 - col("p") * col("p") * col("d")))},
        {"__major": F.when(col("p") == 1, col("normal")).otherwise(col("far") * col("cos")), "__minor": F.when((col("p") == 1) & (F.abs(col("ratio")) == 1), F.signum(col("ratio")) * col("normal")).otherwise(col("far") * col("sin"))},
        {"__right": turn(col("major"), -col("minor"), -col("major"), col("minor")), "__rise": turn(col("minor"), col("major"), -col("minor"), -col("major"))},
    ]
    for k, step in enumerate(steps):
        rows = rows.withColumns(step)
        if k in (3, 6):
            rows = _settled(rows)
    basis = lambda axis, k: F.element_at(F.array(*(F.lit(float(f[axis][k])) for f in FACES)), (F.col(face) + 1).cast("int"))
    rows = rows.withColumns({f"d{c}": col("normal") * basis(0, k) + col("right") * basis(1, k) + col("rise") * basis(2, k) for k, c in enumerate("xyz")})
    return rows.drop("__area", "__p", "__ratio", "__up", "__on", "__len", "__cos", "__sin", "__d", "__normal", "__far", "__major", "__minor", "__right", "__rise")


def cube_rotation(direction: str, angle: float) -> tuple[tuple[float, ...], ...]:
    """Turn of the cube: vertical about +x (y towards z), horizontal about -y (x towards z), none without a direction."""
    c, s = math.cos(math.radians(angle)), math.sin(math.radians(angle))
    return {"": ((1.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, 0.0, 1.0)), "vertical": ((1.0, 0.0, 0.0), (0.0, c, -s), (0.0, s, c)), "horizontal": ((c, 0.0, -s), (0.0, 1.0, 0.0), (s, 0.0, c))}[direction]


def _pixels(spark: SparkSession, **sizes: int) -> DataFrame:
    """Every combination of the named indices."""
    total = math.prod(sizes.values())
    rows, left = spark.range(total), F.col("id")
    out = []
    for name, n in reversed(sizes.items()):
        out.append((left % n).alias(name))
        left = F.floor(left / n)
    return rows.select(*reversed(out))


def spherical_samples(spark: SparkSession, size: tuple[int, int, int], radii: list[float], intervals: int, rotation) -> DataFrame:
    """(face, shell, row, col, t, y, x): where each pixel of each face and shell lies, for those inside the volume."""
    grid = _pixels(spark, face=6, shell=len(radii), row=intervals + 1, col=intervals + 1)
    grid = grid.withColumns({"u": 2.0 * F.col("col") / intervals - 1, "v": 1 - 2.0 * F.col("row") / intervals})
    rows = _settled(cube_direction(grid, "face", "u", "v"))
    r = F.element_at(F.array(*map(F.lit, radii)), (F.col("shell") + 1).cast("int"))
    at = [F.round((n - 1) / 2 + r * sum(rotation[k][j] * F.col(f"d{c}") for j, c in enumerate("xyz")), 9) for k, n in enumerate((size[2], size[1], size[0]))]
    # filtered inside an array: a condition on the coordinates themselves would be written out in terms of all steps before
    place = F.array(F.struct(at[2].alias("t"), at[1].alias("y"), at[0].alias("x")))
    inside = lambda s: functools.reduce(operator.and_, ((s[c] > -1) & (s[c] < n) for c, n in zip("tyx", size)))
    return rows.select("face", "shell", "row", "col", F.explode(F.filter(place, inside)).alias("s")).select("face", "shell", "row", "col", "s.*")


def nearest_frames(mask: DataFrame, samples: DataFrame, *frame: str) -> DataFrame:
    """The mask (volume, t, y, x) as seen by ``samples``, each at the voxel nearest to it (halves up)."""
    at = samples.select(*frame, *(F.floor(F.col(c) + 0.5).cast("bigint").alias(c) for c in ("t", "y", "x")))
    return mask.select("volume", "t", "y", "x").join(at, ["t", "y", "x"]).select("volume", *frame)


def linear_frames(grays: DataFrame, samples: DataFrame, *frame: str) -> DataFrame:
    """Gray values (volume, t, y, x, g) at ``samples``: linear in the axes between voxels, zero outside, rounded."""
    taps = samples
    for c in ("t", "y", "x"):
        low = F.floor(F.col(c))
        taps = taps.withColumn("__tap", F.explode(F.array(F.struct(low.alias("i"), (1 - (F.col(c) - low)).alias("w")), F.struct((low + 1).alias("i"), (F.col(c) - low).alias("w")))))
        taps = taps.withColumn(f"__w{c}", F.col("__tap.w")).withColumn(c, F.col("__tap.i").cast("bigint")).drop("__tap")
    taps = taps.withColumn("__w", F.col("__wt") * F.col("__wy") * F.col("__wx")).where("__w > 0").select(*frame, "t", "y", "x", "__w")
    out = grays.join(taps, ["t", "y", "x"]).groupBy("volume", *frame).agg(F.round(F.sum(F.col("g") * F.col("__w")), 6).alias("g"))
    return out.withColumn("g", F.least(F.lit(255), F.rint("g")).cast("bigint"))


#: How far a direction moves at most for a step of one in (u, v): the mapping's greatest is 0.90.
STRETCH = 1.25


def face_bounds(rotation, face: int, low: float, high: float) -> list[tuple[float, float]]:
    """[(least, greatest)] offset from the centre along x, y and z of any point of a turned closed face with radius in [low, high].

    A coordinate on the face's part of the unit sphere is extreme in its inside (at the axis), on an edge (at the axis'
    projection onto the edge's plane), or at a corner (where two planes meet); candidates that the face doesn't hold are left
    out, with a margin, so the bounds may only be too wide.
    """
    turn = np.asarray(rotation, float)
    normal, right, up = (turn @ np.asarray(axis, float) for axis in FACES[face])
    planes = np.array([normal - right, normal + right, normal - up, normal + up]) / math.sqrt(2)
    tries = [sign * axis - (0 if p is None else (sign * axis) @ p * p) for axis in np.eye(3) for sign in (1, -1) for p in (None, *planes)]
    tries += [sign * np.cross(p, q) for k, p in enumerate(planes) for q in planes[k + 1 :] for sign in (1, -1)]
    found = [v / np.linalg.norm(v) for v in tries if np.linalg.norm(v) > 1e-9]
    found = np.array([v for v in found if (planes @ v >= -1e-9).all()])
    least, most = np.clip(found.min(0) - 1e-9, -1, 1), np.clip(found.max(0) + 1e-9, -1, 1)
    return [(min(low * a, high * a), max(low * b, high * b)) for a, b in zip(least, most)]


def output_bounds(frames: DataFrame, size: tuple[int, int, int], radii: list[float], rotation) -> DataFrame:
    """(face, t0, t1, y0, y1, x0, x1): half-open boxes of the voxels that the set pixels of each face can reach.

    Only the first and last shell in use of a face are looked at, so blocks outside a box need not be visited at all.
    """
    half = lambda k, d: abs(radii[k] - radii[k + d]) / 2 if 0 <= k + d < len(radii) else 0.0
    used = frames.groupBy("face").agg(F.min("shell").alias("a"), F.max("shell").alias("b")).collect()  # six rows
    rows = []
    for r in used:
        bounds = face_bounds(rotation, r.face, radii[r.a] - half(r.a, -1) - 1e-6, radii[r.b] + half(r.b, 1) + 1e-6)
        at = [(max(0, math.ceil(lo + (n - 1) / 2 - 1e-6)), min(n, math.floor(hi + (n - 1) / 2 + 1e-6) + 1)) for (lo, hi), n in zip(bounds, (size[2], size[1], size[0]))]
        rows.append((r.face, *at[2], *at[1], *at[0]))
    return frames.sparkSession.createDataFrame(rows, "face long, t0 long, t1 long, y0 long, y1 long, x0 long, x1 long")


def _beside(radii: list[float]) -> tuple[Column, Column, Column]:
    """The radius of a row's shell, and those of the shells inside and outside of it (null at the ends)."""
    table = F.array(*map(F.lit, radii))
    shell = F.col("shell").cast("int")
    return F.get(table, shell), F.when(shell > 0, F.get(table, shell - 1)), F.get(table, shell + 1)


def _own_shell(r: Column, own: Column, inner: Column, outer: Column) -> Column:
    """Whether no other shell is nearer to a radius; half-way between two it is the inner one's."""
    far = lambda other: F.round(F.abs(r - other), 9)
    return F.coalesce(far(own) < far(inner), F.lit(True)) & F.coalesce(far(own) <= far(outer), F.lit(True))


def spherical_project(frames: DataFrame, size: tuple[int, int, int], radii: list[float], intervals: int, rotation) -> DataFrame:
    """(volume, t, y, x): voxels whose nearest shell and pixel, on any closed face that holds them, is set in ``frames``.

    ``frames`` are (volume, face, shell, row, col). A radius half-way between shells belongs to the inner one. Work follows the
    set pixels: each gives the few voxels of a box that surely holds all of its own, cut to the bounds of its face, and these
    are tested exactly.
    """
    pixels = frames.select("face", "shell", "row", "col").distinct()
    own, inner, outer = _beside(radii)
    gap = F.greatest(F.coalesce(own - inner, F.lit(0.0)), F.coalesce(outer - own, F.lit(0.0))) / 2
    rows = pixels.withColumns({"u": 2.0 * F.col("col") / intervals - 1, "v": 1 - 2.0 * F.col("row") / intervals, "__own": own, "__inner": inner, "__outer": outer, "__gap": gap})
    rows = _settled(cube_direction(rows, "face", "u", "v"))
    reach = F.col("__gap") + (F.col("__own") + F.col("__gap")) * (STRETCH * math.sqrt(2) / intervals) + 1e-6
    box = output_bounds(frames, size, radii, rotation)  # six rows
    rows = rows.withColumn("__reach", reach).join(F.broadcast(box), "face")
    for k, (c, n) in enumerate(zip("xyt", (size[2], size[1], size[0]))):
        middle = (n - 1) / 2 + F.col("__own") * sum(rotation[k][j] * F.col(f"d{d}") for j, d in enumerate("xyz"))
        rows = rows.withColumns({f"__a{c}": F.greatest(F.col(f"{c}0"), F.ceil(middle - F.col("__reach"))), f"__b{c}": F.least(F.col(f"{c}1") - 1, F.floor(middle + F.col("__reach")))})
    rows = rows.select("face", "shell", "row", "col", "__own", "__inner", "__outer", *(f"__{e}{c}" for c in "xyt" for e in "ab"))
    for c in "tyx":
        rows = rows.where(F.col(f"__a{c}") <= F.col(f"__b{c}")).withColumn(c, F.explode(F.sequence(F.col(f"__a{c}"), F.col(f"__b{c}"))))
    off = {c: F.col(c) - (n - 1) / 2 for c, n in zip("tyx", size)}
    world = (off["x"], off["y"], off["t"])
    rows = rows.withColumn("r", F.sqrt(sum(w * w for w in world))).where(F.col("r").between(radii[0] - 1e-9, radii[-1] + 1e-9) & _own_shell(F.col("r"), F.col("__own"), F.col("__inner"), F.col("__outer")))
    rows = rows.withColumns({f"__{c}": F.round(sum(rotation[k][j] * world[k] for k in range(3)), 12) for j, c in enumerate("xyz")})
    rows = _settled(on_face(_settled(rows.select("face", "shell", "row", "col", *"tyx", "__x", "__y", "__z")), "__x", "__y", "__z"))
    place = lambda c: F.rint(F.round((c + 1) * intervals / 2, 9)).cast("bigint")
    rows = rows.where((place(-F.col("v")) == F.col("row")) & (place(F.col("u")) == F.col("col"))).select("face", "shell", "row", "col", *(F.col(c).cast("bigint").alias(c) for c in "tyx"))
    return frames.join(rows, ["face", "shell", "row", "col"]).select("volume", "t", "y", "x").distinct()


def radial_samples(spark: SparkSession, size: tuple[int, int, int], radii: list[float]) -> DataFrame:
    """(shell, height, arc, t, y, x): shells about the volume's t axis, unrolled; arcs are whole pixels from angle zero.

    The last pixel of an arc may lie less than a pixel before the first one again.
    """
    shells = spark.createDataFrame([(k, float(r), max(1, math.ceil(round(2 * math.pi * r, 9)))) for k, r in enumerate(radii)], "shell long, r double, n long")
    arcs = shells.select("shell", "r", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("arc"))
    rows = arcs.withColumn("height", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(size[0] - 1).cast("bigint"))))
    a = F.col("arc") / F.col("r")
    at = rows.select("shell", "height", "arc", F.col("height").cast("double").alias("t"), F.round((size[1] - 1) / 2 + F.col("r") * F.sin(a), 9).alias("y"), F.round((size[2] - 1) / 2 + F.col("r") * F.cos(a), 9).alias("x"))
    return at.where((F.col("y") > -1) & (F.col("y") < size[1]) & (F.col("x") > -1) & (F.col("x") < size[2]))


def radial_project(frames: DataFrame, size: tuple[int, int, int], radii: list[float]) -> DataFrame:
    """(volume, t, y, x): voxels whose nearest shell shows them set, at the arc nearest to their angle or to a whole turn more.

    ``frames`` are (volume, shell, height, arc). Work follows the set arcs, each of which gives the few pixels around its place.
    """
    own, inner, outer = _beside(radii)
    gap = F.greatest(F.coalesce(own - inner, F.lit(0.0)), F.coalesce(outer - own, F.lit(0.0))) / 2
    rows = frames.select("shell", "arc").distinct().withColumns({"__own": own, "__inner": inner, "__outer": outer, "__gap": gap})
    # an arc's pixel is a unit long on its shell; the voxels that it owns lie in this square about it
    rows = rows.withColumn("__reach", F.col("__gap") + (F.col("__own") + F.col("__gap")) / F.col("__own") * 0.5 + 1e-6)
    for c, n, way in (("y", size[1], F.sin), ("x", size[2], F.cos)):
        middle = (n - 1) / 2 + F.col("__own") * way(F.col("arc") / F.col("__own"))
        rows = rows.withColumns({f"__a{c}": F.greatest(F.lit(0), F.ceil(middle - F.col("__reach"))), f"__b{c}": F.least(F.lit(n - 1), F.floor(middle + F.col("__reach")))})
        rows = rows.where(F.col(f"__a{c}") <= F.col(f"__b{c}")).withColumn(c, F.explode(F.sequence(f"__a{c}", f"__b{c}")))
    dy, dx = F.col("y") - (size[1] - 1) / 2, F.col("x") - (size[2] - 1) / 2
    rows = rows.withColumns({"r": F.sqrt(dy * dy + dx * dx), "a": F.pmod(F.atan2(dy, dx), F.lit(2 * math.pi))})
    rows = rows.where(F.col("r").between(radii[0] - 1e-9, radii[-1] + 1e-9) & _own_shell(F.col("r"), F.col("__own"), F.col("__inner"), F.col("__outer")))
    shown = functools.reduce(operator.or_, (F.rint(F.round((F.col("a") + turn * (2 * math.pi)) * F.col("__own"), 9)).cast("bigint") == F.col("arc") for turn in (0, 1, -1)))
    rows = rows.where(shown).select("shell", "arc", F.col("y").cast("bigint").alias("y"), F.col("x").cast("bigint").alias("x"))
    return frames.join(rows, ["shell", "arc"]).select("volume", F.col("height").alias("t"), "y", "x").distinct()


def tilted_frames(grays: DataFrame, size: tuple[int, int, int], angle: float) -> DataFrame:
    """(volume, frame, y, x, g): frames sheared along t by the height in a slice, linear between the two slices they cross.

    A frame's pixel counts where both slices that it needs are in the volume.
    """
    offset = F.round((F.col("y") - (size[1] - 1) / 2) * math.tan(math.radians(angle)), 9)
    rows = grays.withColumn("b", offset).withColumns({"low": F.floor("b"), "w": F.col("b") - F.floor("b")})
    # a voxel of slice t is the lower slice of frame t - floor(b), and the upper one of the frame before
    rows = rows.withColumn("tap", F.explode(F.array(F.struct((F.col("t") - F.col("low")).alias("frame"), (1 - F.col("w")).alias("k")), F.struct((F.col("t") - F.col("low") - 1).alias("frame"), F.col("w").alias("k")))))
    rows = rows.where(F.col("tap.k") > 0).select("volume", F.col("tap.frame").alias("frame"), "y", "x", (F.col("g") * F.col("tap.k")).alias("v"), "low", "w")
    out = rows.groupBy("volume", "frame", "y", "x", "low", "w").agg(F.round(F.sum("v"), 6).alias("g"))
    last = size[0] - 1
    reach = (F.col("frame") + F.col("low") >= 0) & (F.col("frame") + F.col("low") + F.when(F.col("w") > 0, 1).otherwise(0) <= last) & F.col("frame").between(0, last)
    return out.where(reach).select("volume", "frame", "y", "x", F.least(F.lit(255), F.rint("g")).cast("bigint").alias("g"))


def tilted_project(frames: DataFrame, size: tuple[int, int, int], angle: float) -> DataFrame:
    """(volume, t, y, x): set pixels of sheared frames (volume, frame, y, x) at the slice nearest to where they lie."""
    t = F.rint(F.round(F.col("frame") + (F.col("y") - (size[1] - 1) / 2) * math.tan(math.radians(angle)), 9)).cast("bigint")
    return frames.select("volume", t.alias("t"), "y", "x").where(F.col("t").between(0, size[0] - 1)).distinct()


def azimuthal_frames(grays: DataFrame, size: tuple[int, int, int], angles: list[float], width: int, radius: float) -> DataFrame:
    """(volume, frame, row, u, g): diameters of the (y, x) plane at ``angles``, linear between pixels.

    Taps beyond the plane are left out and the rest of that axis takes their weight.
    """
    lines = grays.sparkSession.createDataFrame([(k, float(a)) for k, a in enumerate(angles)], "frame long, angle double")
    lines = lines.withColumn("u", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(width - 1).cast("bigint"))))
    d = F.col("u") * (2 * radius / (width - 1)) - radius
    taps = lines.select("frame", "u", F.round((size[1] - 1) / 2 + d * F.sin(F.radians("angle")), 9).alias("py"), F.round((size[2] - 1) / 2 + d * F.cos(F.radians("angle")), 9).alias("px"))
    for c, n in (("y", size[1]), ("x", size[2])):
        low = F.floor(F.col(f"p{c}"))
        pair = F.array(F.struct(low.alias("i"), (1 - (F.col(f"p{c}") - low)).alias("w")), F.struct((low + 1).alias("i"), (F.col(f"p{c}") - low).alias("w")))
        pair = F.filter(pair, lambda s: (s["i"] >= 0) & (s["i"] < n) & (s["w"] > 0))
        taps = taps.withColumn("__p", pair).withColumn("__s", F.aggregate("__p", F.lit(0.0), lambda acc, s: acc + s["w"])).where("__s > 1e-6")
        taps = taps.withColumn("__t", F.explode("__p")).withColumns({c: F.col("__t.i").cast("bigint"), f"w{c}": F.col("__t.w") / F.col("__s")}).drop("__p", "__s", "__t")
    out = grays.join(taps, ["y", "x"]).groupBy("volume", "frame", F.col("t").alias("row"), "u").agg(F.round(F.sum(F.col("g") * F.col("wy") * F.col("wx")), 6).alias("g"))
    return out.withColumn("g", F.least(F.lit(255), F.rint("g")).cast("bigint"))


def _axis_taps(spark: SparkSession, n_in: int, n_out: int, aligned: bool) -> DataFrame:
    """(out, i, w): linear taps of each output place; ends meet ends if ``aligned``, else pixel centres keep their place."""
    at = F.col("id") * ((n_in - 1) / max(1, n_out - 1)) if aligned else (F.col("id") + 0.5) * (n_in / n_out) - 0.5
    rows = spark.range(n_out).select(F.col("id").alias("out"), F.greatest(F.lit(0.0), F.least(F.lit(float(n_in - 1)), F.round(at, 9))).alias("p"))
    low = F.floor("p")
    return rows.select("out", F.explode(F.array(F.struct(low.alias("i"), (1 - (F.col("p") - low)).alias("w")), F.struct(F.least(low + 1, F.lit(n_in - 1)).alias("i"), (F.col("p") - low).alias("w")))).alias("s")).select("out", "s.i", "s.w").where("w > 0")


def resize_gray(grays: DataFrame, size: tuple[int, int, int], out: tuple[int, int, int]) -> DataFrame:
    """Gray volumes on another grid: slices by pixel centres, bilinear and rounded, then linear between slices, ends aligned."""
    spark, rows = grays.sparkSession, grays.select("volume", "t", "y", "x", F.col("g").cast("double").alias("g"))

    def along(rows: DataFrame, *axes: str) -> DataFrame:
        for c in axes:
            k = "tyx".index(c)
            taps = _axis_taps(spark, size[k], out[k], c == "t").select(F.col("i").alias(c), F.col("out").alias("__o"), F.col("w").alias("__w"))
            rows = rows.join(F.broadcast(taps), c).withColumn(c, F.col("__o")).withColumn("g", F.col("g") * F.col("__w")).drop("__o", "__w")  # two rows a place of an axis
        return rows.groupBy("volume", "t", "y", "x").agg(F.rint(F.round(F.sum("g"), 6)).alias("g"))

    return along(along(rows, "y", "x"), "t").withColumn("g", F.col("g").cast("bigint"))


def warp_gray(grays: DataFrame, matrix: tuple[float, ...], out: int) -> DataFrame:
    """Slices through the output-to-source ``matrix``, bilinear, zero outside."""
    a, b, c, d, e, f = matrix
    grid = _pixels(grays.sparkSession, oy=out, ox=out)
    taps = grid.select("oy", "ox", F.round(d * F.col("ox") + e * F.col("oy") + f, 9).alias("y"), F.round(a * F.col("ox") + b * F.col("oy") + c, 9).alias("x"))
    for axis in ("y", "x"):
        low = F.floor(F.col(axis))
        taps = taps.withColumn("__t", F.explode(F.array(F.struct(low.alias("i"), (1 - (F.col(axis) - low)).alias("w")), F.struct((low + 1).alias("i"), (F.col(axis) - low).alias("w")))))
        taps = taps.withColumns({f"w{axis}": F.col("__t.w"), axis: F.col("__t.i").cast("bigint")}).drop("__t")
    rows = grays.join(taps.where("wy > 0 AND wx > 0"), ["y", "x"])
    rows = rows.groupBy("volume", "t", "oy", "ox").agg(F.round(F.sum(F.col("g") * F.col("wy") * F.col("wx")), 6).alias("g"))
    return rows.select("volume", "t", F.col("oy").alias("y"), F.col("ox").alias("x"), F.rint("g").cast("bigint").alias("g"))


def downbin_gray(grays: DataFrame, size: tuple[int, int], by: int) -> DataFrame:
    """Mean over square blocks of each slice, rounded; blocks at the end are smaller where the size is no multiple."""
    block = lambda c: F.floor(F.col(c) / by).cast("bigint").alias(c)
    rows = grays.groupBy("volume", "t", block("y"), block("x")).agg(F.sum("g").alias("s"))
    side = lambda c, n: F.least(F.lit(by), n - F.col(c) * by)
    return rows.select("volume", "t", "y", "x", F.rint(F.round(F.col("s") / (side("y", size[0]) * side("x", size[1])), 9)).cast("bigint").alias("g"))


def low_quality_specs(requests: DataFrame) -> DataFrame:
    """(volume, out_t, out_h, out_w, token): reduced shapes asked for by a fraction or by a size of the longest axis.

    Sizes are multiples of four, four at least; of requests that give one shape the first, by ``nth``, stands.
    """
    four = lambda v: F.greatest(F.lit(4), (F.floor(v / 4 + 0.5) * 4)).cast("bigint")
    longest = F.greatest("n_t", "n_h", "n_w")
    value = F.col("token").cast("double")
    scale = F.when(F.col("token").rlike(r"[.eE]"), value).otherwise(four(value) / longest)
    rows = requests.withColumn("__s", scale).where((F.col("__s") > 0) & (~F.col("token").rlike(r"[.eE]") | (F.col("__s") < 1)))
    rows = rows.withColumns({f"out_{c}": four(F.round(F.col(f"n_{c}") * F.col("__s"), 9)) for c in "thw"})
    return rows.groupBy("volume", "out_t", "out_h", "out_w").agg(F.min_by("token", "nth").alias("token"))
