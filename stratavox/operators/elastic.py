"""Spatial policies: elastic displacement fields from seeds, warps by them, and their inverse with a mask of what can be trusted.

A policy samples pixel y of its output at x = inv(A) y + d(y): an affine map and a displacement that is given at whole pixels and
bilinear between them. The inverse asks for the y of a given x; what folds, leaves the raster or does not converge has none.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavox.functions import hashing

#: Newton steps, largest step and residual in pixels, least determinant, and how far a place may miss the raster.
STEPS, LARGEST, RESIDUAL, LEAST, EDGE = 16, 32.0, 0.05, 1e-7, 1e-4
#: Side of the tiles that are inverted together.
TILE = 64
MATRIX = ["m00", "m01", "m02", "m10", "m11", "m12"]
DOMAIN = "elastic-field"


def lattice(policies: DataFrame, height: int, width: int, step: int) -> DataFrame:
    """(policy, ly, lx, dy, dx): displacements of (policy, seed, magnitude) at every ``step``-th pixel, from digests, within ±magnitude."""
    rows, cols = -(-(height - 1) // step), -(-(width - 1) // step)
    at = policies.withColumn("ly", F.explode(F.sequence(F.lit(0), F.lit(rows)))).withColumn("lx", F.explode(F.sequence(F.lit(0), F.lit(cols))))
    unit = lambda axis: (hashing.leading_u32(hashing.joined_digest(F.lit(DOMAIN), F.col("seed"), F.col("ly"), F.col("lx"), F.lit(axis))) / F.lit(2.0**31) - 1) * F.col("magnitude")
    return at.select("policy", "ly", "lx", unit("y").alias("dy"), unit("x").alias("dx"))


def field(points: DataFrame, height: int, width: int, step: int) -> DataFrame:
    """(policy, y, x, dy, dx): a lattice made bilinear between its points; each cell takes its four corners and gives its pixels."""
    corner = lambda i, j: points.select("policy", (F.col("ly") - i).alias("ly"), (F.col("lx") - j).alias("lx"), F.col("dy").alias(f"dy{i}{j}"), F.col("dx").alias(f"dx{i}{j}"))
    cells = corner(0, 0)
    for i, j in ((0, 1), (1, 0), (1, 1)):
        cells = cells.join(corner(i, j), ["policy", "ly", "lx"], "left")
    inside = F.sequence(F.lit(0), F.lit(step - 1))
    rows = cells.withColumn("i", F.explode(inside)).withColumn("j", F.explode(inside)).withColumns({"y": F.col("ly") * step + F.col("i"), "x": F.col("lx") * step + F.col("j"), "v": F.col("i") / step, "u": F.col("j") / step})
    rows = rows.where((F.col("y") < height) & (F.col("x") < width))
    own = lambda c, i, j: F.coalesce(F.col(f"{c}{i}{j}"), F.lit(0.0))  # noqa: E731  # beyond the last point nothing is asked for
    value = lambda c: (own(c, 0, 0) * (1 - F.col("u")) + own(c, 0, 1) * F.col("u")) * (1 - F.col("v")) + (own(c, 1, 0) * (1 - F.col("u")) + own(c, 1, 1) * F.col("u")) * F.col("v")
    return rows.select("policy", F.col("y").cast("bigint").alias("y"), F.col("x").cast("bigint").alias("x"), value("dy").alias("dy"), value("dx").alias("dx"))


def _inverse_affine() -> list[Column]:
    m = {c: F.col(c) for c in MATRIX}
    det = m["m00"] * m["m11"] - m["m01"] * m["m10"]
    return [m["m11"] / det, -m["m01"] / det, (m["m01"] * m["m12"] - m["m11"] * m["m02"]) / det, -m["m10"] / det, m["m00"] / det, (m["m10"] * m["m02"] - m["m00"] * m["m12"]) / det]


def sources(policies: DataFrame, moved: DataFrame) -> DataFrame:
    """(policy, y, x, sy, sx): where the output pixels of policies (policy, m00..m12) with displacements ``moved`` are sampled."""
    inv = policies.select("policy", *(c.alias(f"i{k}") for k, c in enumerate(_inverse_affine())))
    rows = moved.join(inv, "policy")
    return rows.select("policy", "y", "x", (F.col("i3") * F.col("x") + F.col("i4") * F.col("y") + F.col("i5") + F.col("dy")).alias("sy"), (F.col("i0") * F.col("x") + F.col("i1") * F.col("y") + F.col("i2") + F.col("dx")).alias("sx"))


def bilinear(d: np.ndarray, x: np.ndarray, y: np.ndarray, y0: int, x0: int, height: int, width: int) -> tuple[np.ndarray, ...]:
    """(values (n, 2), slopes along x, slopes along y) of displacements d (rows, columns, 2) that begin at (y0, x0) of the raster.

    Places beyond the raster have the values of its edge and no slope across it.
    """
    cx, cy = np.clip(x, 0, width - 1), np.clip(y, 0, height - 1)
    ix, iy = np.floor(cx).astype(int), np.floor(cy).astype(int)
    jx, jy = np.minimum(ix + 1, width - 1), np.minimum(iy + 1, height - 1)
    u, v = (cx - ix)[:, None], (cy - iy)[:, None]
    at = lambda b, a: d[b - y0, a - x0]
    a, b, c, e = at(iy, ix), at(iy, jx), at(jy, ix), at(jy, jx)
    value = (a * (1 - u) + b * u) * (1 - v) + (c * (1 - u) + e * u) * v
    dx, dy = (b - a) * (1 - v) + (e - c) * v, (c - a) * (1 - u) + (e - b) * u
    return value, np.where(((x >= 0) & (x <= width - 1))[:, None], dx, 0.0), np.where(((y >= 0) & (y <= height - 1))[:, None], dy, 0.0)


def invert(target: np.ndarray, matrix: np.ndarray, d: np.ndarray, y0: int, x0: int, height: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(places (n, 2) as x, y; whether each can be trusted) of the output that shows the source places ``target``.

    ``d`` holds the raster's displacements from (y0, x0) on; what leaves that part on the way is not trusted. The Jacobian is that
    of the bilinear field, the number of steps is fixed.
    """
    inverse = np.linalg.inv(matrix[:, :2])
    back = -inverse @ matrix[:, 2]
    base = np.linalg.det(inverse)
    now = target @ matrix[:, :2].T + matrix[:, 2]
    known = np.ones(len(target), bool)

    def look(p):
        inside = (np.clip(p[:, 0], 0, width - 1) >= x0) & (np.clip(p[:, 1], 0, height - 1) >= y0)
        inside &= (np.minimum(np.floor(np.clip(p[:, 0], 0, width - 1)) + 1, width - 1) < x0 + d.shape[1]) & (np.minimum(np.floor(np.clip(p[:, 1], 0, height - 1)) + 1, height - 1) < y0 + d.shape[0])
        q = np.where(inside[:, None], p, [x0, y0])
        value, dx, dy = bilinear(d, q[:, 0], q[:, 1], y0, x0, height, width)
        a, b, c, e = inverse[0, 0] + dx[:, 0], inverse[0, 1] + dy[:, 0], inverse[1, 0] + dx[:, 1], inverse[1, 1] + dy[:, 1]
        return inside, p @ inverse.T + back + value - target, a, b, c, e, a * e - b * c

    for _ in range(STEPS):
        inside, rest, a, b, c, e, det = look(now)
        known &= inside
        det = np.where(np.abs(det) > LEAST, det, 1.0)
        step = np.stack([(e * rest[:, 0] - b * rest[:, 1]) / det, (-c * rest[:, 0] + a * rest[:, 1]) / det], axis=1)
        now = np.where(known[:, None], now - np.clip(step, -LARGEST, LARGEST), now)
    inside, rest, *_, det = look(now)
    fine = known & inside & (det * base > 0) & (np.abs(det) > LEAST) & (np.abs(rest).max(1, initial=0) <= RESIDUAL)
    fine &= (now >= -EDGE).all(1) & (now[:, 0] <= width - 1 + EDGE) & (now[:, 1] <= height - 1 + EDGE)
    return np.clip(now, 0, [width - 1, height - 1]), fine


def inverse(policies: DataFrame, moved: DataFrame, height: int, width: int) -> DataFrame:
    """(policy, y, x, oy, ox): for every source pixel the place of the output that shows it; null where none can be trusted.

    A solution lies within the matrix' norm times the largest displacement of where the affine map alone puts it, so a tile of
    source pixels fetches the displacements of that neighbourhood (and a few pixels more), by blocks, and is solved by itself.
    """
    rise = moved.groupBy("policy").agg(F.sqrt(F.max(F.col("dy") ** 2 + F.col("dx") ** 2)).alias("most"))
    norm = F.sqrt(sum(F.col(c) ** 2 for c in ("m00", "m01", "m10", "m11")))
    rows = policies.select("policy", *MATRIX).join(rise, "policy").withColumn("reach", F.ceil(2 * norm * F.col("most")) + 3)
    side = lambda n: F.explode(F.sequence(F.lit(0), F.lit((n - 1) // TILE)))
    rows = rows.withColumn("ty", side(height)).withColumn("tx", side(width))
    ends = lambda t, n: (F.col(t) * TILE, F.least(F.col(t) * TILE + TILE, F.lit(n)) - 1)
    (ya, yb), (xa, xb) = ends("ty", height), ends("tx", width)
    corners = lambda r: [F.col(f"m{r}0") * x + F.col(f"m{r}1") * y + F.col(f"m{r}2") for x in (xa, xb) for y in (ya, yb)]
    block = lambda v, n: F.floor(F.least(F.greatest(v, F.lit(0)), F.lit(n - 1)) / TILE)
    near = rows
    for c, r, n in (("by", 1, height), ("bx", 0, width)):
        near = near.withColumn(c, F.explode(F.sequence(block(F.least(*corners(r)) - F.col("reach"), n), block(F.greatest(*corners(r)) + F.col("reach") + 1, n))))
    blocks = moved.groupBy("policy", F.floor(F.col("y") / TILE).alias("by"), F.floor(F.col("x") / TILE).alias("bx")).agg(F.collect_list(F.struct("y", "x", "dy", "dx")).alias("cells"))
    met = near.join(blocks, ["policy", "by", "bx"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        cells = np.array([(c["y"], c["x"], c["dy"], c["dx"]) for part in pdf["cells"] for c in part])
        y0, x0 = cells[:, :2].min(0).astype(int)
        d = np.zeros((*(cells[:, :2].max(0).astype(int) - (y0, x0) + 1), 2))
        d[cells[:, 0].astype(int) - y0, cells[:, 1].astype(int) - x0] = cells[:, [3, 2]]
        y, x = np.mgrid[first["ty"] * TILE : min(height, first["ty"] * TILE + TILE), first["tx"] * TILE : min(width, first["tx"] * TILE + TILE)]
        target = np.stack([x.ravel(), y.ravel()], axis=1).astype(float)
        place, fine = invert(target, first[MATRIX].to_numpy(float).reshape(2, 3), d, y0, x0, height, width)
        out = pd.DataFrame({"policy": first["policy"], "y": y.ravel(), "x": x.ravel()})
        out["oy"], out["ox"] = (np.where(fine, place[:, k], np.nan) for k in (1, 0))  # no number becomes null
        return out

    return met.groupBy("policy", "ty", "tx").applyInPandas(run, "policy long, y long, x long, oy double, ox double")


def restored(mask: DataFrame, back: DataFrame) -> DataFrame:
    """(policy, y, x, known, set): the mask (policy, y, x) of an output brought back by the inverse, nearest pixel; unknown where it has none."""
    at = back.select("policy", "y", "x", F.col("oy").isNotNull().alias("known"), F.rint("oy").cast("bigint").alias("__y"), F.rint("ox").cast("bigint").alias("__x"))
    own = mask.select("policy", F.col("y").alias("__y"), F.col("x").alias("__x")).distinct().withColumn("set", F.lit(True))
    return at.join(own, ["policy", "__y", "__x"], "left").select("policy", "y", "x", "known", F.when(F.col("known"), F.coalesce("set", F.lit(False))).alias("set"))
