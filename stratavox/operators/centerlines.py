"""Centre lines of masks: radii, medial ridges, tracks from plane to plane, normal sections, and a filter that removes what they expose.

Masks are (volume, t, y, x) inside a box ``shape``; beyond the box nothing is known, so it is no background. Distances are
exact and integer until they become radii. Neighbourhoods and searches are windows and equi-joins on cells; a Python group is
a block of lines, a plane's ridge, a connected set of links, a section, or a component of a slice.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratavox.operators import graph, groups, kernels, masks
from stratavox.session import checkpointed, shuffle_partitions

AXES = ("t", "y", "x")
AT = ["volume", "t", "y", "x"]
#: Least radius of a ridge (and where a volume has fewer than three such voxels), planes that a track may leave
#: out, what a step may be in places and in radii, largest ratio of radii, and least points of a track.
RIDGE, RELAXED, GAP, STEP, RADII, RATIO, LEAST = 1.25, 0.5, 2, 2.5, 0.85, 5.0, 3
#: Voxels of the lines along t that one group holds together.
LINES = 1 << 17
#: Voxels of a row of the mask that are packed together for lookups.
WORD = 64
#: Planes whose links one task joins into sets before the graph.
SLAB = 64


# --- radii and ridges


def _of_lines(flat: DataFrame, shape: tuple[int, int, int], around: int, run: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], dict]) -> DataFrame:
    """(volume, t, y, x, d2) of what ``run`` chooses in every square of lines along t, about ``LINES`` voxels of slices (volume, t, y, x, f).

    It gets the places, d2 and whether a line is the square's own: the lines of ``around`` places beside it come with it.
    """
    side = max(8, math.isqrt(LINES // shape[0]))
    for c, size in zip(("y", "x"), shape[1:]):
        last = (size - 1) // side
        cells = F.floor(F.col(c) / side) if not around or not last else F.explode(F.sequence(F.greatest(F.lit(0), F.floor((F.col(c) - around) / side)), F.least(F.lit(last), F.floor((F.col(c) + around) / side))))
        flat = flat.withColumn(f"g{c}", cells)

    def lines(table: pa.Table) -> pa.Table:
        t, y, x, f = (table[c].to_numpy() for c in ("t", "y", "x", "f"))
        first, last = max(int(t.min()) - 1, 0), min(int(t.max()) + 2, shape[0])
        y0, x0 = int(y.min()), int(x.min())
        line, at = np.unique((y - y0) * (int(x.max()) - x0 + 1) + x - x0, return_inverse=True)
        background = np.zeros((last - first, len(line)), np.int64)
        background[t - first, at] = f
        d2 = kernels._along(background)[t - first, at]
        own = (y // side == table["gy"][0].as_py()) & (x // side == table["gx"][0].as_py())
        out = {"t": t, "y": y, "x": x, "d2": d2}
        chosen = run(t, y, x, d2, own)
        return pa.table({"volume": table["volume"].take(pa.array(chosen)), **{c: pa.array(v[chosen], pa.int64()) for c, v in out.items()}})

    return groups.spread(flat, "volume", "gy", "gx").groupBy("volume", "gy", "gx").applyInArrow(lines, "volume long, t long, y long, x long, d2 long")


def radii(mask: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """The mask with d2, the squared distance of each voxel to the nearest background inside the box.

    Slices first, then lines along t: a line's background voxels count as 0, so only the part that the mask spans is built.
    """
    return _of_lines(slice_radii(mask, shape), shape, 0, lambda t, y, x, d2, own: np.arange(len(t)))


def slice_radii(mask: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """The mask with f, the squared distance of each voxel to the nearest background of its slice; a large number without any.

    A group of slices has about ``LINES`` pixels; voxels that come twice leave it once.
    """
    size = max(shape[1:])

    def slices(table: pa.Table) -> pa.Table:
        y, x = table["y"].to_numpy(), table["x"].to_numpy()
        t, k = np.unique(table["t"].to_numpy(), return_inverse=True)
        m = np.zeros((len(t), *shape[1:]), bool)
        m[k, y, x] = True
        at = np.nonzero(m)
        volume = np.full(len(at[0]), table["volume"][0].as_py(), np.int64)
        return pa.table({"volume": volume, "t": t[at[0]], "y": at[1], "x": at[2], "f": kernels.squared_distance(~m)[at]})

    rows = mask.select(*(F.col(c).cast("bigint").alias(c) for c in AT)).withColumn("g", F.floor(F.col("t") / max(1, LINES // (size * size))))
    return groups.spread(rows, "volume", "g").groupBy("volume", "g").applyInArrow(slices, "volume long, t long, y long, x long, f long")


def ridges(solid: DataFrame) -> DataFrame:
    """(volume, t, y, x, r): voxels whose distance is greatest in their 3 x 3 neighbourhood of each of the three planes.

    The two-dimensional maxima are made of running maxima along lines. A radius is the distance less half a voxel. Thin
    volumes, with under three voxels of radius ``RIDGE``, keep those of ``RELAXED``.
    """
    def around(value: str, axis: str) -> Column:
        others = [c for c in AXES if c != axis]
        return F.max(value).over(Window.partitionBy("volume", *others).orderBy(axis).rangeBetween(-1, 1))

    rows = solid.withColumn("mx", around("d2", "x")).withColumn("mt", around("d2", "t"))
    rows = rows.withColumn("yx", around("mx", "y")).withColumn("ty", around("mt", "y")).withColumn("tx", around("mx", "t"))
    return _thick(rows.where(F.col("d2") >= F.greatest("yx", "ty", "tx")))


def _thick(best: DataFrame) -> DataFrame:
    r = F.greatest(F.lit(0.5), F.sqrt("d2") - 0.5)
    best = best.select(*AT, r.alias("r")).withColumn("thick", F.count_if(F.col("r") >= RIDGE).over(Window.partitionBy("volume")))
    return best.where(F.col("r") >= F.when(F.col("thick") >= LEAST, RIDGE).otherwise(RELAXED)).drop("thick")


def medial(mask: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """``ridges`` of the mask's ``radii``: a square of lines comes with the lines beside it, so that only maxima leave its task."""
    def maxima(t: np.ndarray, y: np.ndarray, x: np.ndarray, d2: np.ndarray, own: np.ndarray) -> np.ndarray:
        at = tuple(v - v.min() + 1 for v in (t, y, x))
        box = np.zeros([int(v.max()) + 2 for v in at], np.int64)  # an empty place around it all
        box[at] = d2

        def wide(a: np.ndarray, axis: int) -> np.ndarray:
            a, out = np.moveaxis(a, axis, 0), np.zeros_like(a)
            to = np.moveaxis(out, axis, 0)
            to[1:-1] = np.maximum(np.maximum(a[:-2], a[1:-1]), a[2:])
            return out

        mx, my = wide(box, 2), wide(box, 1)
        top = np.maximum(np.maximum(wide(mx, 1), wide(my, 0)), wide(mx, 0))
        return np.flatnonzero(own & (d2 >= top[at]))

    return _thick(_of_lines(slice_radii(mask, shape), shape, 1, maxima))


def plane_peaks(ridge: DataFrame) -> DataFrame:
    """(volume, axis, plane, row, col, r): ridge voxels of every plane across each axis, thinned in order of falling radius.

    A peak takes away those within 0.4 of its radius (0.75 at least); ties go to the lower row, then column.
    """
    views = F.explode(F.array(*(F.struct(F.lit(a).alias("axis"), F.col(c).alias("plane"), *(F.col(o).alias(n) for o, n in zip([d for d in AXES if d != c], ("row", "col")))) for a, c in enumerate(AXES)))).alias("v")
    rows = ridge.select("volume", "r", views).select("volume", "v.*", "r")

    def run(plane: dict[str, list]) -> list[tuple]:
        taken: set[tuple[int, int]] = set()
        keep = []
        for volume, axis, at, row, col, r in zip(*(plane[c] for c in ("volume", "axis", "plane", "row", "col", "r"))):
            if (row, col) not in taken:
                keep.append((volume, axis, at, row, col, r))
                taken.update((row + i, col + j) for i, j in _within(max(0.75, 0.4 * r)))
        return keep

    return groups.streamed(rows, ["volume", "axis", "plane"], [F.col("r").desc(), F.col("row"), F.col("col")], run, "volume long, axis int, plane long, row long, col long, r double")


@functools.lru_cache(1024)
def _within(reach: float) -> list[tuple[int, int]]:
    """Steps (rows, columns) no longer than ``reach``."""
    n = math.ceil(reach)
    return [(i, j) for i in range(-n, n + 1) for j in range(-n, n + 1) if i * i + j * j <= reach * reach]


# --- tracks


def words(mask: DataFrame) -> DataFrame:
    """(volume, t, y, word, bits): the mask, ``WORD`` voxels of a row in one number."""
    return mask.select("volume", "t", "y", "x").groupBy("volume", "t", "y", F.floor(F.col("x") / WORD).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("x", F.lit(WORD)).cast("int"))).alias("bits"))


def _bit(bits: str, x: str) -> Column:
    return F.call_function("getbit", F.col(bits), F.pmod(x, F.lit(WORD)).cast("int"))


def links(peaks: DataFrame, mask: DataFrame) -> DataFrame:
    """Pairs of peaks that may follow each other: (volume, axis, p_*, n_*, score), the step over the largest allowed.

    A step of ``gap`` planes may be the greater of STEP * gap and RADII * (r + r') * sqrt(gap); the segment between, sampled
    every half voxel, must stay in the mask. Peaks meet by cells as wide as the step that their radius allows, one table
    for each power of two.
    """
    most = lambda r: F.greatest(F.lit(STEP * GAP), RADII * (1 + RATIO) * math.sqrt(GAP) * r)
    level = lambda r: F.ceil(F.log2(most(r))).cast("bigint")
    cell = lambda c: F.floor(F.col(c) / F.pow(F.lit(2.0), F.col("level")))
    near = F.array(F.lit(-1), F.lit(0), F.lit(1))
    at = ["plane", "row", "col", "r"]
    new = peaks.select("volume", "axis", *(F.col(c).alias(f"n_{c}") for c in at)).withColumn("level", level(F.col("n_r")))
    new = new.withColumn("dy", F.explode(near)).withColumn("dx", F.explode(near)).withColumn("gap", F.explode(F.sequence(F.lit(1), F.lit(GAP))))
    new = new.select("volume", "axis", *(f"n_{c}" for c in at), "level", "gap", (cell("n_row") + F.col("dy")).alias("cy"), (cell("n_col") + F.col("dx")).alias("cx"), (F.col("n_plane") - F.col("gap")).alias("p_plane"))
    old = peaks.select("volume", "axis", *(F.col(c).alias(f"p_{c}") for c in at)).withColumn("level", F.explode(F.sequence(level(F.col("p_r") / RATIO), level(F.col("p_r") * RATIO))))
    old = old.withColumn("cy", cell("p_row")).withColumn("cx", cell("p_col"))
    pairs = new.join(old, ["volume", "axis", "level", "cy", "cx", "p_plane"])
    away = F.sqrt((F.col("n_row") - F.col("p_row")) ** 2 + (F.col("n_col") - F.col("p_col")) ** 2)
    allowed = F.greatest(STEP * F.col("gap"), RADII * (F.col("n_r") + F.col("p_r")) * F.sqrt("gap"))
    pairs = pairs.withColumn("score", away / allowed).where((F.col("score") <= 1) & (F.greatest("n_r", "p_r") / F.least("n_r", "p_r") <= RATIO))
    pairs = checkpointed(pairs.select("volume", "axis", *(f"p_{c}" for c in at), *(f"n_{c}" for c in at), "score").withColumn("link", F.monotonically_increasing_id()))
    # the voxels on the way, ends included
    delta = [F.col("n_plane") - F.col("p_plane"), F.col("n_row") - F.col("p_row"), F.col("n_col") - F.col("p_col")]
    steps = F.greatest(F.lit(2), F.ceil(F.sqrt(sum(d * d for d in delta)) / 0.5).cast("int") + 1)
    way = pairs.select("link", "volume", "axis", *(f"{e}_{c}" for e in "pn" for c in ("plane", "row", "col")), steps.alias("steps")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("steps") - 1)))
    place = [F.rint(F.col(f"p_{c}") + F.col("i") / (F.col("steps") - 1) * d).cast("bigint") for c, d in zip(("plane", "row", "col"), delta)]
    pick = lambda k: F.element_at(F.array(*place), F.element_at(F.array(*(F.lit(n) for n in k)), F.col("axis") + 1))
    # plane, row and col of axis 0 are t, y, x; of axis 1 y, t, x; of axis 2 x, t, y
    voxels = way.select("link", "volume", pick((1, 2, 2)).alias("t"), pick((2, 1, 3)).alias("y"), pick((3, 3, 1)).alias("x"))
    outside = voxels.withColumn("word", F.floor(F.col("x") / WORD)).join(words(mask), ["volume", "t", "y", "word"], "left").where(~F.coalesce(_bit("bits", "x") == 1, F.lit(False))).select("link").distinct()
    return pairs.join(outside, "link", "left_anti").drop("link")


def tracks(good: DataFrame) -> DataFrame:
    """(volume, axis, plane0, row0, col0, arc, plane, row, col, r): one-to-one tracks of at least ``LEAST`` peaks, named by their first.

    Planes are taken in order; of a plane's peaks those with greater radius first (ties: lower row, column), each joins the
    open track of the least score (ties: the track begun first). Only linked peaks can compete, so each connected set of links
    is tracked on its own.
    """
    node = lambda p: F.xxhash64("volume", "axis", f"{p}_plane", f"{p}_row", f"{p}_col")
    slab = F.floor(F.col("p_plane") / SLAB)
    sets = graph.grouped(good.withColumn("a", node("p")).withColumn("b", node("n")).withColumn("slab", slab), "volume", "axis", "slab").withColumnRenamed("root", "set")

    cols = ["p_plane", "p_row", "p_col", "p_r", "n_plane", "n_row", "n_col", "n_r", "score"]

    def run(pairs: dict[str, list]) -> list[tuple]:
        order = lambda p: (p[0], -p[3], p[1], p[2])
        into: dict[tuple, list] = {}
        every = set()
        for row in zip(*(pairs[c] for c in cols)):
            old, new = row[:4], row[4:8]
            every |= {old, new}
            into.setdefault(new, []).append((row[8], old))
        track: dict[tuple, tuple] = {}  # the first peak of each peak's track
        arc: dict[tuple, int] = {}
        taken = set()
        for p in sorted(every, key=order):
            free = [(score, order(track[o]), o) for score, o in into.get(p, ()) if o not in taken]
            if free:
                _, _, last = min(free)
                taken.add(last)
                track[p], arc[p] = track[last], arc[last] + 1
            else:
                track[p], arc[p] = p, 0
        n: dict[tuple, int] = {}
        for p in every:
            n[track[p]] = n.get(track[p], 0) + 1
        volume, axis = pairs["volume"][0], pairs["axis"][0]
        return [(volume, axis, *track[p][:3], arc[p], *p) for p in every if n[track[p]] >= LEAST]

    rows = sets.select("set", "volume", "axis", *cols)
    return groups.streamed(rows, ["set"], [], run, "volume long, axis int, plane0 long, row0 long, col0 long, arc long, plane long, row long, col long, r double")


def branches(found: DataFrame) -> DataFrame:
    """(volume, branch, arc, t, y, x, r, dt, dy, dx): tracks that are longer than wide, one of those that run side by side, with tangents.

    A track's path must be 2 voxels and 3 median radii long. Of tracks in order of path over radius, path, greatest radius and
    first point, one goes if less than half of its voxels are more than a voxel away from those already taken; only tracks that
    come that close to each other are compared.
    """
    axis = F.col("axis")
    place = {"t": F.when(axis == 0, F.col("plane")).otherwise(F.col("row")), "y": F.when(axis == 0, F.col("row")).when(axis == 1, F.col("plane")).otherwise(F.col("col")), "x": F.when(axis == 2, F.col("plane")).otherwise(F.col("col"))}
    rows = found.select("volume", F.xxhash64("volume", "axis", "plane0", "row0", "col0").alias("branch"), "arc", *(c.alias(n) for n, c in place.items()), "r")
    along = Window.partitionBy("branch").orderBy("arc")
    step = F.sqrt(sum((F.col(c) - F.lag(c).over(along)) ** 2 for c in AXES))
    whole = rows.withColumn("step", step).groupBy("volume", "branch").agg(F.sum("step").alias("path"), F.percentile("r", F.lit(0.5)).alias("mid"), F.max("r").alias("top"), F.min(F.struct("arc", *AXES)).alias("first"))
    whole = whole.where(F.col("path") >= F.greatest(F.lit(2.0), 3 * F.col("mid")))
    rank = F.struct((-F.round(F.col("path") / F.col("mid"), 9)).alias("a"), (-F.round("path", 9)).alias("b"), (-F.col("top")).alias("c"), "first.t", "first.y", "first.x", "branch")
    rows = checkpointed(rows.join(whole.select("branch", rank.alias("rank")), "branch"))
    here = rows.select("volume", *AXES, "branch").distinct()
    around = F.explode(F.sequence(F.lit(-1), F.lit(1)))
    wide = here.withColumn("i", around).withColumn("j", around).withColumn("k", around)
    wide = wide.select("volume", (F.col("t") + F.col("i")).alias("t"), (F.col("y") + F.col("j")).alias("y"), (F.col("x") + F.col("k")).alias("x"), F.col("branch").alias("by")).distinct()
    close = checkpointed(here.join(wide, AT).where("branch <> by").select("branch", "by", F.xxhash64(*AXES).alias("voxel")))
    sets = graph.components(close.select(F.col("branch").alias("a"), F.col("by").alias("b"))).select(F.col("node").alias("branch"), F.col("root").alias("set"))
    count = here.groupBy("branch").agg(F.count("*").alias("n"))
    ranks = rows.groupBy("branch").agg(F.first("rank").alias("rank"))
    todo = close.groupBy("branch", "voxel").agg(F.collect_set("by").alias("by")).join(count, "branch").join(sets, "branch").join(ranks, "branch").select("set", "branch", "by", "n", F.struct("rank.*").alias("rank"))

    def run(near: dict[str, list]) -> list[tuple]:
        kept, out = set(), []
        order = {b: tuple(r.values()) for b, r in zip(near["branch"], near["rank"])}
        voxels: dict[int, list] = {}
        for b, by in zip(near["branch"], near["by"]):
            voxels.setdefault(b, []).append(by)
        n = dict(zip(near["branch"], near["n"]))
        for b in sorted(order, key=order.get):
            covered = sum(1 for by in voxels[b] if not kept.isdisjoint(by))
            if n[b] - covered >= 0.5 * n[b]:
                kept.add(b)
            else:
                out.append((b,))
        return out

    gone = groups.streamed(todo, ["set"], [], run, "branch long")
    rows = rows.join(gone, "branch", "left_anti")
    tangent = [(F.coalesce(F.lead(c).over(along), F.col(c)) - F.coalesce(F.lag(c).over(along), F.col(c))).alias(f"d{c}") for c in AXES]
    return rows.select("volume", "branch", "arc", *AXES, "r", *tangent)


def center_lines(mask: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """Centre lines of a mask: ``branches`` of the ``tracks`` over its medial ridges, along all three axes."""
    mask = mask.select(*(F.col(c).cast("bigint").alias(c) for c in AT))
    peaks = checkpointed(plane_peaks(medial(mask, shape)))
    return branches(tracks(links(peaks, mask)))


# --- normal sections

#: Straight ways tried from the centre, step along them, widest half side of a section, voxels told of one.
WAYS, WAY_STEP, HALF, EVIDENCE = 24, 0.75, 256, 2048
#: Side of the cells by which voxels are fetched, and samples of a line that fetch together.
CELL, BLOCK = 16, 32
#: Places of the box around a section up to which it is held as an array.
DENSE = 1 << 22


def bounded(voxels: np.ndarray, most: int) -> np.ndarray:
    """At most so many rows, evenly spaced, the first and last among them."""
    return voxels if len(voxels) <= most else voxels[np.linspace(0, len(voxels) - 1, most, dtype=np.int64)]


class Near:
    """The voxels around a section, looked up by rounded place."""

    def __init__(self, voxels: np.ndarray, shape: tuple[int, int, int]):
        self.shape, self.voxels, self.box = shape, voxels, None
        if len(voxels):
            self.low = voxels.min(0)
            size = voxels.max(0) - self.low + 1
            if math.prod(size.tolist()) <= DENSE:
                self.box = np.zeros(size, bool)
                self.box[tuple((voxels - self.low).T)] = True
        self.codes = np.sort(self._code(voxels)) if self.box is None else None

    def _code(self, v: np.ndarray) -> np.ndarray:
        return (v[..., 0] * self.shape[1] + v[..., 1]) * self.shape[2] + v[..., 2]

    def sample(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rounded, inside the box, set) of places (..., 3)."""
        at = np.rint(places).astype(np.int64)
        inside = ((at >= 0) & (at < np.array(self.shape))).all(-1)
        if self.box is not None:
            from_low = at - self.low
            known = inside & ((from_low >= 0) & (from_low < self.box.shape)).all(-1)
            hit = np.zeros(inside.shape, bool)
            hit[known] = self.box[tuple(from_low[known].T)]
            return at, inside, hit
        code = np.where(inside, self._code(at), -1)
        if not len(self.codes):
            return at, inside, np.zeros(inside.shape, bool)
        found = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return at, inside, inside & (self.codes[found] == code)

    def snapped(self, place: np.ndarray, r: float) -> np.ndarray | None:
        """The rounded place if it is set, else the nearest set voxel of the cube around it; ties go to the first in t, y, x."""
        at, _, hit = self.sample(place)
        if hit:
            return at.astype(np.float64)
        reach = max(1, min(16, math.ceil(max(0.5, r) + 1)))
        close = self.voxels[(np.abs(self.voxels - at) <= reach).all(1)]
        if not len(close):
            return None
        d = ((close - place) ** 2).sum(1)
        return min(close[d == d.min()].tolist())


def _axes(tangent: np.ndarray, r: float, wide: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Two unit vectors that span the plane across a tangent; None where there is no section."""
    length = math.sqrt(tangent.dot(tangent))
    if not (math.isfinite(r) and r >= 0.5 and math.isfinite(length) and length > 1e-8 and math.isfinite(wide) and wide > r):
        return None
    cross = lambda a, b: np.array([a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]])
    normal = tangent / length
    unit = [0.0, 0.0, 0.0]
    unit[int(np.abs(normal).argmin())] = 1.0
    first = cross(normal.tolist(), unit)
    first /= math.sqrt(first.dot(first))
    return first, cross(normal.tolist(), first.tolist())


@functools.lru_cache(1024)
def _circle(n: int) -> tuple[np.ndarray, np.ndarray]:
    angles = np.linspace(0, 2 * math.pi, n, endpoint=False)
    return np.cos(angles)[:, None], np.sin(angles)[:, None]


def section(place: np.ndarray, tangent: np.ndarray, r: float, factor: float, near: Near, half_cap: int = HALF) -> tuple[str, np.ndarray]:
    """(clean, anomaly or unknown; voxels that show the anomaly) of the plane across a centre line.

    A section is an anomaly if the mask leads, in its plane, from the centre out to a circle of ``factor`` radii: along a
    straight way, or through the centre's 8-connected component. It is clean only if all that was asked for lies in the box;
    a centre without mask, a tangent of no length or a section too wide is unknown, which is no evidence of anything.
    """
    return block_of_sections(place[None], tangent[None], np.array([r], np.float64), factor, near, half_cap)[0]


def block_of_sections(places: np.ndarray, tangents: np.ndarray, radii: np.ndarray, factor: float, near: Near, half_cap: int = HALF) -> list[tuple[str, np.ndarray]]:
    """The ``section`` of each of several samples: their circles are looked up together, and only those that meet the mask go on."""
    none = np.zeros((0, 3), np.int64)
    out: list[tuple[str, np.ndarray]] = [("unknown", none)] * len(places)
    at, _, hit = near.sample(np.where(np.isfinite(places), places, -1))
    circles: dict[int, list[tuple]] = {}
    for k, r in enumerate(radii.tolist()):
        wide = factor * r
        axes = _axes(tangents[k], r, wide)
        centre = None if axes is None else at[k] if hit[k] else near.snapped(places[k], r)
        if centre is not None:
            circles.setdefault(max(32, min(2048, math.ceil(2 * math.pi * wide))), []).append((k, wide, np.asarray(centre, np.float64), *axes))
    for n, group in circles.items():
        cos, sin = _circle(n)
        # as many circles at once as have some 2^16 places
        for begin in range(0, len(group), max(1, (1 << 16) // n)):
            part = group[begin : begin + max(1, (1 << 16) // n)]
            wide, centre, first, second = (np.array([g[c] for g in part]) for c in range(1, 5))
            rings = centre[:, None] + wide[:, None, None] * (cos * first[:, None] + sin * second[:, None])
            _, inside, met = near.sample(rings)
            for j, k in enumerate(g[0] for g in part):
                if met[j].any():
                    out[k] = _led_out(centre[j], first[j], second[j], float(radii[k]), float(wide[j]), rings[j][met[j]], near, half_cap)
                else:
                    out[k] = ("clean" if inside[j].all() else "unknown", none)
    return out


def _led_out(centre: np.ndarray, first: np.ndarray, second: np.ndarray, r: float, wide: float, ends: np.ndarray, near: Near, half_cap: int) -> tuple[str, np.ndarray]:
    """The section of a centre whose circle meets the mask at ``ends``."""
    none = np.zeros((0, 3), np.int64)
    outer = max(r + 0.75, 1.1 * r)

    def told(places: np.ndarray) -> np.ndarray:
        at, _, hit = near.sample(places)
        code = np.unique(near._code(at[hit]))
        rest, x = np.divmod(code, near.shape[2])
        return np.stack([rest // near.shape[1], rest % near.shape[1], x], 1)

    alpha = np.linspace(0, 1, max(2, math.ceil(wide / WAY_STEP) + 1))
    ways = centre + alpha[:, None] * (bounded(ends, WAYS)[:, None] - centre)
    through = near.sample(ways)[2].all(1)
    if through.any() and (alpha * wide >= outer).any():
        voxels = told(ways[through][:, alpha * wide >= outer].reshape(-1, 3))
        if len(voxels):
            return "anomaly", voxels
    half = math.ceil(wide + 1.5)
    if half > half_cap:
        return "unknown", none
    v, u = np.meshgrid(np.arange(-half, half + 1.0), np.arange(-half, half + 1.0), indexing="ij")
    plane = centre + u[..., None] * first + v[..., None] * second
    _, inside, hit = near.sample(plane)
    rest = "clean" if inside.all() else "unknown"
    at = (half, half)
    if not hit[at]:
        set_ = np.argwhere(hit)
        d = ((set_ - half) ** 2).sum(1)
        if not len(set_) or d.min() > 9:
            return "unknown", none
        at = tuple(set_[d.argmin()])
    label = kernels.slice_labels(hit)
    own, away = label == label[at], np.hypot(u, v)
    if not (own & (np.abs(away - wide) <= 1.25)).any():
        return rest, none
    voxels = told(plane[own & (away >= outer)])
    return ("anomaly", voxels) if len(voxels) else ("unknown", none)


def cells_of(mask: DataFrame) -> DataFrame:
    """(volume, ct, cy, cx, voxels): the mask's voxels gathered by cell, at most CELL^3 in one, as their numbers within it."""
    t, y, x = (F.pmod(c, F.lit(CELL)) for c in AXES)
    return mask.groupBy("volume", *(F.floor(F.col(c) / CELL).alias(f"c{c}") for c in AXES)).agg(F.collect_list(((t * CELL + y) * CELL + x).cast("int")).alias("voxels"))


def sections(samples: DataFrame, mask: DataFrame, shape: tuple[int, int, int], factor: float, most: int = EVIDENCE, half_cap: int = HALF) -> DataFrame:
    """(volume, branch, arc, state, evidence array<struct<t,y,x>>) of every sample of centre lines.

    A sample fetches the cells that its plane can reach; a group is ``BLOCK`` neighbouring samples of a line, which share cells.
    """
    reach = F.least(F.lit(16), F.ceil(F.greatest(F.lit(0.5), F.col("r")) + 1))
    far = F.ceil((F.least(F.lit(half_cap), F.ceil(factor * F.col("r") + 1.5)) + 1) * math.sqrt(2)) + reach + 1
    rows = samples.select("volume", "branch", "arc", *AXES, "r", "dt", "dy", "dx").withColumn("block", F.floor(F.col("arc") / BLOCK)).withColumn("far", far)
    wanted = rows
    for c in AXES:
        wanted = wanted.withColumn(f"c{c}", F.explode(F.sequence(F.floor((F.col(c) - F.col("far")) / CELL), F.floor((F.col(c) + F.col("far")) / CELL))))
    norm = F.sqrt(F.col("dt") ** 2 + F.col("dy") ** 2 + F.col("dx") ** 2)
    off = F.abs(sum(((F.col(f"c{c}") + 0.5) * CELL - F.col(c)) * F.col(f"d{c}") for c in AXES))
    wanted = wanted.where(off <= norm * (CELL * math.sqrt(3) / 2 + reach + 2))
    key = ["volume", "branch", "block"]
    near = wanted.select(*key, "ct", "cy", "cx").distinct().join(cells_of(mask), ["volume", "ct", "cy", "cx"]).select(*key, "ct", "cy", "cx", "voxels")
    both = rows.drop("far").unionByName(near, allowMissingColumns=True)

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        own = table.filter(table["r"].is_valid())
        cells = table.filter(table["voxels"].is_valid()).combine_chunks()
        voxels = cells["voxels"].combine_chunks()
        numbers = voxels.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        cell = np.stack([cells[f"c{c}"].to_numpy() for c in AXES], 1).astype(np.int64)
        places = np.stack([numbers // (CELL * CELL), numbers // CELL % CELL, numbers % CELL], 1) + np.repeat(cell * CELL, voxels.value_lengths().to_numpy(zero_copy_only=False), axis=0)
        column = lambda *names: np.stack([own[c].cast(pa.float64()).to_numpy() for c in names], 1)
        found = block_of_sections(column(*AXES), column("dt", "dy", "dx"), column("r")[:, 0], factor, Near(places, shape), half_cap)
        told = [bounded(v, most) for _, v in found]
        ends = np.cumsum([0, *map(len, told)])
        every = np.concatenate(told).astype(np.int64)
        evidence = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(every[:, k]) for k in range(3)], list(AXES)))
        return pa.table({**{c: own[c] for c in ("volume", "branch", "arc")}, "state": pa.array([state for state, _ in found], pa.string()), "evidence": evidence})

    return groups.spread(both, *key).groupBy(*key).applyInArrow(run, "volume long, branch long, arc long, state string, evidence array<struct<t:long,y:long,x:long>>")


def anomaly_events(found: DataFrame, least: int = 3, gap: int = 2, flank: int = 3) -> DataFrame:
    """(volume, branch, event, arc0, arc1, n, clean_left, clean_right): runs of anomalies along a branch.

    Gaps up to ``gap`` samples are closed if all in them are clean; a run needs ``least`` anomalies. A side is clean if the
    ``flank`` samples beside the run are there and clean; unknown ones are not.
    """
    along = Window.partitionBy("volume", "branch").orderBy("arc")
    clean = F.sum((F.col("state") == "clean").cast("int"))
    rows = found.select("volume", "branch", "arc", "state").withColumns(
        {
            "pos": F.row_number().over(along),
            "unknown": F.sum((F.col("state") == "unknown").cast("int")).over(along.rowsBetween(Window.unboundedPreceding, 0)),
            "left": F.coalesce(clean.over(along.rowsBetween(-flank, -1)), F.lit(0)) == flank,
            "right": F.coalesce(clean.over(along.rowsBetween(1, flank)), F.lit(0)) == flank,
        }
    )
    bad = rows.where("state = 'anomaly'")
    new = F.coalesce((F.col("pos") - F.lag("pos").over(along) - 1 > gap) | (F.col("unknown") > F.lag("unknown").over(along)), F.lit(True))
    bad = bad.withColumn("event", F.sum(new.cast("int")).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    out = bad.groupBy("volume", "branch", "event").agg(
        F.min("arc").alias("arc0"), F.max("arc").alias("arc1"), F.count("*").alias("n"), F.min_by("left", "arc").alias("clean_left"), F.max_by("right", "arc").alias("clean_right")
    )
    return out.where(F.col("n") >= least)


# --- what is protected


def _nearest(points: DataFrame, mask: DataFrame, axes: tuple[str, ...], reach: Column) -> DataFrame:
    """(p, at struct): the voxel nearest to each point (p, volume, the axes, and t if it is not among them) within ``reach`` along each axis.

    Points on the mask are their own; others look through the cells around them; ties go to the first voxel.
    """
    fixed = ["volume", *(c for c in AXES if c not in axes)]
    rows = points.withColumns({f"i{c}": F.rint(c).cast("bigint") for c in axes}).withColumn("reach", reach)
    here = rows.join(mask.select(*fixed, *(F.col(c).alias(f"i{c}") for c in axes)), [*fixed, *(f"i{c}" for c in axes)], "left_semi").select("p", F.struct(*(F.col(f"i{c}").alias(c) for c in axes)).alias("at"), F.lit(0.0).alias("d2"))
    away = rows.join(here.select("p"), "p", "left_anti")
    for c in axes:
        away = away.withColumn(f"c{c}", F.explode(F.sequence(F.floor((F.col(f"i{c}") - F.col("reach")) / CELL), F.floor((F.col(f"i{c}") + F.col("reach")) / CELL))))
    cells = mask.select(*fixed, *(F.col(c).alias(f"m{c}") for c in axes), *(F.floor(F.col(c) / CELL).alias(f"c{c}") for c in axes))
    met = away.join(cells, [*fixed, *(f"c{c}" for c in axes)])
    for c in axes:
        met = met.where(F.abs(F.col(f"m{c}") - F.col(f"i{c}")) <= F.col("reach"))
    d2 = sum((F.col(f"m{c}") - F.col(c)) ** 2 for c in axes)
    best = met.groupBy("p").agg(F.min(F.struct(d2.alias("d2"), F.struct(*(F.col(f"m{c}").alias(c) for c in axes)).alias("at"))).alias("b"))
    return here.unionByName(best.select("p", "b.at", "b.d2"))


def protected_seeds(samples: DataFrame, mask: DataFrame) -> DataFrame:
    """(volume, t, y, x, r): pixels that the swept tube around the centre lines marks as not to be deleted.

    Between neighbouring samples points are put every half voxel (only at the ends where they lie far apart), moved onto the
    mask, and marked in the slices within their radius (8 at most): the pixel of the centre, or the nearest of the mask
    within the tube's width in that slice.
    """
    along = Window.partitionBy("volume", "branch").orderBy("arc")
    nxt = {c: F.coalesce(F.lead(c).over(along), F.col(c)) for c in (*AXES, "r")}
    rows = samples.select("volume", "branch", "arc", *AXES, "r", *(v.alias(f"n{c}") for c, v in nxt.items()))
    length = F.sqrt(sum((F.col(f"n{c}") - F.col(c)) ** 2 for c in AXES))
    steps = F.when(length > F.greatest(F.lit(32.0), 10 * F.greatest("r", "nr", F.lit(1.0))), 1).otherwise(F.greatest(F.lit(1), F.ceil(length / 0.5).cast("int")))
    rows = rows.withColumn("steps", steps).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("steps")))).withColumn("a", F.col("i") / F.col("steps"))
    between = lambda c: (F.col(c) + F.col("a") * (F.col(f"n{c}") - F.col(c))).alias(c)
    points = checkpointed(rows.select("volume", *map(between, (*AXES, "r"))).distinct().withColumn("p", F.monotonically_increasing_id()))
    reach = F.greatest(F.lit(1), F.least(F.lit(16), F.ceil(F.greatest(F.lit(0.5), F.col("r")) + 1)))
    on = points.join(_nearest(points, mask, AXES, reach).select("p", "at"), "p").select("volume", "at.*", F.greatest(F.lit(1.0), F.col("r")).alias("w"), "r").distinct()
    span = F.least(F.lit(8), F.ceil("w")).cast("bigint")
    slices = on.withColumn("dt", F.explode(F.sequence(-span, span))).withColumn("inplane", F.sqrt(F.greatest(F.lit(0.0), F.col("w") ** 2 - F.col("dt") ** 2))).where("inplane >= 0.5")
    slices = checkpointed(slices.select("volume", (F.col("t") + F.col("dt")).alias("t"), "y", "x", "inplane", "r").distinct().withColumn("p", F.monotonically_increasing_id()))
    found = _nearest(slices, mask, ("y", "x"), F.least(F.lit(12), F.greatest(F.lit(1), F.ceil("inplane"))))
    hit = slices.select("p", "volume", "t", "inplane", "r").join(found, "p").where(F.col("d2") <= F.col("inplane") ** 2)
    return hit.groupBy("volume", "t", F.col("at.y").alias("y"), F.col("at.x").alias("x")).agg(F.max("r").alias("r"))


# --- watershed


#: Side of the tiles that a flood is settled in at once, and pixels of neighbouring slices' tiles that are settled together.
TILE, TOGETHER = 128, 1 << 17


def _flood(value: np.ndarray, beside: np.ndarray, spread) -> np.ndarray:
    """Values (columns compared in order, ``FAR`` for none) after spreading to neighbours: ``beside`` (8, n) has their numbers, n for none.

    ``spread`` gives the values that places would get from others; a round moves only what the round before changed.
    """
    value = np.vstack([value, np.full((1, value.shape[1]), FAR)])  # the place that is beside those at the edge
    moved = np.flatnonzero(value[:-1, 0] < FAR)
    while len(moved):
        p = np.tile(moved, len(beside))
        q = beside[:, moved].ravel()
        p, q = p[q < len(value) - 1], q[q < len(value) - 1]
        new = spread(value[p], p, q)
        less = _less(new, value[q])
        q, new = q[less], new[less]
        first = np.lexsort((*new.T[::-1], q))  # of several, the least
        q, new = q[first], new[first]
        one = np.append(True, q[1:] != q[:-1]) if len(q) else np.zeros(0, bool)
        moved = q[one]
        value[moved] = new[one]
    return value[:-1]


#: Above all levels and steps.
FAR = np.iinfo(np.int64).max


def _less(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = a[:, -1] < b[:, -1]
    for c in range(a.shape[1] - 2, -1, -1):
        out = (a[:, c] < b[:, c]) | (a[:, c] == b[:, c]) & out
    return out


def _beside(key: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """(8, n): numbers of the places next to each of n places of slices numbered by ``key``; n for none."""
    n = len(key)
    high, wide = int(y.max() - y.min()) + 3, int(x.max() - x.min()) + 3  # an empty row and column keep slices apart
    code = (key * high + (y - y.min() + 1)) * wide + (x - x.min() + 1)
    order = np.argsort(code)
    rank = code[order]
    out = []
    for step in (-wide - 1, -wide, -wide + 1, -1, 1, wide - 1, wide, wide + 1):
        at = np.minimum(np.searchsorted(rank, code + step), n - 1)
        out.append(np.where(rank[at] == code + step, order[at], n))
    return np.array(out)


def _settle(pixels: DataFrame, start: DataFrame, spread, values: list[str], most_rounds: int) -> DataFrame:
    """The least ``values`` (compared in order) of every pixel (slice, y, x, level), spread from ``start`` (slice, y, x, values).

    A tile settles its own pixels from what it has and what its neighbours' border pixels had the round before; the rounds
    end when no tile gets anything new from another, so their number is that of the tiles that a basin winds through. The
    driver reads the number of all pixels, by which tiles at the same place of different slices are put together.
    """
    extra = [c for c in pixels.columns if c == "flat"]
    tiled = pixels.select("slice", "y", "x", "level", *extra, F.floor(F.col("y") / TILE).alias("ty"), F.floor(F.col("x") / TILE).alias("tx"))
    now = checkpointed(tiled.join(start.select("slice", "y", "x", *values), ["slice", "y", "x"], "left").withColumn("changed", F.col(values[0]).isNotNull()))
    tiles = now.select("slice", "ty", "tx").distinct()
    many = max(2 * shuffle_partitions(now.sparkSession), 2 * now.count() // TOGETHER)

    def run(table: pa.Table) -> pa.Table:
        own = ~table["halo"].to_numpy()
        numbers = lambda cols, none: np.stack([table[c].cast(pa.int64()).fill_null(none).to_numpy() for c in cols], 1)
        _, key = np.unique(table["slice"].to_numpy(), return_inverse=True)
        before, level = numbers(values, FAR), numbers(["level", *extra], -FAR)
        after = _flood(before, _beside(key, table["y"].to_numpy(), table["x"].to_numpy()), lambda v, p, q: spread(v, level[p], level[q]))
        out = table.filter(pa.array(own)).drop_columns(["halo"])
        new = {c: pa.array(v, mask=v == FAR) for c, v in zip(values, after[own].T)} | {"changed": pa.array((after != before)[own].any(1))}
        return pa.table([new.get(c, out[c]) for c in out.column_names], out.column_names)

    side = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))).alias("o")
    awake = now.where("changed").select("slice", "ty", "tx")
    for _ in range(most_rounds):
        ghost = now.where(F.pmod("y", F.lit(TILE)).isin(0, TILE - 1) | F.pmod("x", F.lit(TILE)).isin(0, TILE - 1)).select("*", side)
        ghost = ghost.withColumn("gy", F.floor((F.col("y") + F.col("o.i")) / TILE)).withColumn("gx", F.floor((F.col("x") + F.col("o.j")) / TILE)).where("gy <> ty OR gx <> tx")
        ghost = ghost.select("slice", "y", "x", "level", *extra, F.col("gy").alias("ty"), F.col("gx").alias("tx"), *values, "changed").distinct()
        ghost = checkpointed(ghost.join(tiles, ["slice", "ty", "tx"], "left_semi"))
        # a tile that has run is settled for itself: only what is new beside it wakes it
        news = ghost.where("changed").select("slice", "ty", "tx")
        awake = (news if awake is None else awake.unionByName(news)).distinct()
        if awake.isEmpty():
            return now.drop("changed", "ty", "tx")
        both = now.withColumn("halo", F.lit(False)).unionByName(ghost.withColumn("halo", F.lit(True)))
        both = both.join(awake, ["slice", "ty", "tx"], "left_semi").select(*now.columns, "halo").withColumn("g", F.pmod(F.xxhash64("slice"), F.lit(many)))
        moved = groups.spread(both, "g", "ty", "tx").groupBy("g", "ty", "tx").applyInArrow(run, both.drop("halo").schema).drop("g")
        now = checkpointed(moved.unionByName(now.join(awake, ["slice", "ty", "tx"], "left_anti").withColumn("changed", F.lit(False))))
        awake = None
    raise RuntimeError(f"a flood did not settle in {most_rounds} rounds")


def basins(pixels: DataFrame, markers: DataFrame, most_rounds: int = 200) -> DataFrame:
    """(slice, y, x, level, flat, label): pixels (slice, y, x, level) flooded from ``markers`` (slice, y, x, label) through 8 neighbours.

    A pixel's flood level is the least, over all ways from any marker, of the greatest level on the way. It takes the label of
    the marker that is fewest steps away among ways on which the flood rises no faster than it must; ties go to the lower
    label. Pixels that no marker reaches have no label.
    """
    start = pixels.join(markers, ["slice", "y", "x"]).groupBy("slice", "y", "x").agg(F.min("label").alias("label"), F.first("level").alias("level"))
    first = start.select("slice", "y", "x", F.col("level").cast("long").alias("rise"))
    risen = _settle(pixels, first, lambda v, p, q: np.maximum(v, q[:, :1]), ["rise"], most_rounds)
    flat = risen.withColumnRenamed("rise", "flat")
    origin = start.select("slice", "y", "x", F.lit(0).cast("long").alias("steps"), F.col("label").cast("long").alias("label"))
    step = lambda v, p, q: np.where((q[:, 1] == np.maximum(p[:, 1], q[:, 0]))[:, None], v + (1, 0), FAR)
    out = _settle(flat.where("flat IS NOT NULL"), origin, step, ["steps", "label"], most_rounds)
    none = flat.where("flat IS NULL").withColumn("label", F.lit(None).cast("long"))
    return out.drop("steps").unionByName(none)


# --- the filter

#: Least pixels of a component that may go, and share of it that evidence must cover; largest share of sections
#: that may be anomalies, and share of a component that a clean slice beside an event may hold.
AREA, COVERED, ANOMALIES, FLANK = 32, 0.25, 0.35, 0.01


def _disk(radius: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(-radius, radius + 1) for j in range(-radius, radius + 1) if i * i + j * j <= radius * radius]


def _grown(pixels: DataFrame, steps: list[tuple[int, int]]) -> DataFrame:
    """Every pixel (with y and x) moved by every step."""
    o = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in steps))).alias("o")
    return pixels.select("*", o).withColumns({"y": F.col("y") + F.col("o.i"), "x": F.col("x") + F.col("o.j")}).drop("o")


def judged_components(mask: DataFrame, evidence: DataFrame, seeds: DataFrame, shape: tuple[int, int, int], context: int) -> tuple[DataFrame, DataFrame]:
    """(components, pixels) of the slice components that evidence (volume, event, t, y, x) touches.

    components: (root, volume, t, area, protected, covered, flanks_clear, removable); pixels: (root, volume, t, y, x). One is
    removable if it is large enough, well covered by evidence within two pixels, holds no protected seed, and nothing of it
    (moved by a few pixels) goes on in any of the ``context`` slices before or after each of its events, all in the box.
    """
    number = lambda df: df.withColumn("slice", F.col("volume") * shape[0] + F.col("t"))
    mask = number(mask.select(*AT))
    evidence = number(evidence)
    touched = mask.join(evidence.select("slice").distinct(), "slice", "left_semi")
    labelled = masks.components(touched.select(F.col("slice").alias("t"), "y", "x"), 8, max(shape[1:])).withColumnRenamed("t", "slice")
    hits = checkpointed(labelled.join(evidence.select("slice", "y", "x", "volume", "event"), ["slice", "y", "x"]))
    pixels = checkpointed(labelled.join(hits.select("root").distinct(), "root", "left_semi"))
    area = pixels.groupBy("root", "slice").agg(F.count("*").alias("area"))
    near = _grown(hits.select("root", "slice", "y", "x").distinct(), [(i, j) for i in range(-2, 3) for j in range(-2, 3)]).distinct()
    covered = pixels.join(near, ["root", "slice", "y", "x"], "left_semi").groupBy("root").agg(F.count("*").alias("covered"))
    guarded = number(seeds).join(pixels, ["slice", "y", "x"]).select("root").distinct().withColumn("protected", F.lit(True))
    ends = evidence.groupBy("volume", "event").agg(F.min("t").alias("t0"), F.max("t").alias("t1"))
    events = hits.select("root", "volume", "event").distinct().join(ends, ["volume", "event"])
    motion = max(2, min(8, math.ceil(math.sqrt(context))))
    support = _grown(pixels.select("root", "y", "x"), _disk(motion)).distinct()
    beside = events.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(max(context, 1))))).where(F.lit(context > 0)).withColumn("t", F.explode(F.array(F.col("t0") - F.col("k"), F.col("t1") + F.col("k"))))
    within = beside.select("root", "volume", "t").distinct().join(support, "root").join(mask.select(*AT), AT).groupBy("root", "t").agg(F.count("*").alias("n"))
    going = within.join(area, "root").where(F.col("n") > FLANK * F.col("area")).select("root")
    outside = events.where((F.col("t0") - context < 0) | (F.col("t1") + context >= shape[0])).select("root")
    unclear = going.unionByName(outside).distinct().withColumn("unclear", F.lit(True))
    out = area.join(covered, "root", "left").join(guarded, "root", "left").join(unclear, "root", "left")
    out = out.select(
        "root", F.floor(F.col("slice") / shape[0]).alias("volume"), (F.col("slice") % shape[0]).alias("t"), "area", F.coalesce("protected", F.lit(False)).alias("protected"), F.coalesce("covered", F.lit(0)).cast("bigint").alias("covered"), F.col("unclear").isNull().alias("flanks_clear")
    )
    fit = (F.col("area") >= AREA) & (F.col("covered") >= COVERED * F.col("area")) & ~F.col("protected") & F.col("flanks_clear")
    split = pixels.select("root", F.floor(F.col("slice") / shape[0]).alias("volume"), (F.col("slice") % shape[0]).alias("t"), "y", "x")
    return checkpointed(out.withColumn("removable", fit)), split


def candidate_basins(pixels: DataFrame, mask: DataFrame, evidence: DataFrame, seeds: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """(volume, t, y, x): of components (root, volume, t, y, x), what a flood from evidence takes against one from the seeds.

    The deeper a pixel lies in its component the earlier it is flooded. Seeds mark a disk of a quarter of their radius,
    evidence its 3 x 3 neighbourhood outside of these. A component without seeds is taken whole, one of which the flood leaves
    nothing by its evidence marks.
    """
    depth = slice_radii(mask.join(pixels.select("volume", "t").distinct(), ["volume", "t"], "left_semi"), shape)
    rows = pixels.join(depth, AT).withColumn("d", F.sqrt("f"))
    level = F.greatest(F.lit(0), F.least(F.lit(255), F.floor(255 - 254 * F.col("d") / F.max("d").over(Window.partitionBy("root"))))).cast("bigint")
    rows = checkpointed(rows.select("root", *AT, level.alias("level")))
    radius = F.greatest(F.lit(1), F.least(F.lit(8), F.rint(0.25 * F.greatest(F.lit(1.0), F.col("r"))))).cast("bigint")
    good = _grown(seeds.select(*AT, radius.alias("w"), F.col("y").alias("y0"), F.col("x").alias("x0")), _disk(8)).where("(y - y0) * (y - y0) + (x - x0) * (x - x0) <= w * w")
    # a seed marks its own component only
    home = rows.select("root", "volume", "t", F.col("y").alias("y0"), F.col("x").alias("x0"))
    good = good.join(home, ["volume", "t", "y0", "x0"]).join(rows.select("root", *AT), ["root", *AT]).select("root", *AT).distinct()
    own = evidence.select(*AT).distinct().join(rows.select("root", *AT), AT)
    bad = _grown(own, [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]).join(rows.select("root", *AT), ["root", *AT]).select("root", *AT).distinct().join(good, ["root", *AT], "left_anti")
    good, bad = checkpointed(good), checkpointed(bad)
    both = good.select("root").distinct().join(bad.select("root").distinct(), "root")
    alone = rows.join(bad.select("root").distinct(), "root", "left_semi").join(good.select("root").distinct(), "root", "left_anti").select(*AT)
    slices = lambda df: df.select(F.col("root").alias("slice"), "y", "x", *(c for c in df.columns if c in ("level", "label")))
    # components are told apart by their root, so that fronts cannot leave them
    marks = good.withColumn("label", F.lit(1)).unionByName(bad.withColumn("label", F.lit(2)))
    flooded = basins(slices(rows.join(both, "root", "left_semi")), slices(marks.join(both, "root", "left_semi"))).where("label = 2").select(F.col("slice").alias("root"), "y", "x")
    taken = flooded.join(rows.select("root", "volume", "t").distinct(), "root").select("root", *AT)
    lost = bad.join(both, "root", "left_semi").join(taken.select("root").distinct(), "root", "left_anti")
    return alone.unionByName(taken.select(*AT)).unionByName(lost.select(*AT))


def filter_center_lines(mask: DataFrame, shape: tuple[int, int, int], factor: float = 2.0, context: int = 2, passes: int = 3) -> tuple[DataFrame, DataFrame]:
    """(mask, audit): the mask without the slice components that normal sections expose, pass after pass until none goes.

    audit: (pass, kind, volume, t, y, x) with kind removed, or candidate for what stays but a flood marks as doubtful. Only
    events with clean sections on both sides count. Volumes of which more than ``ANOMALIES`` of the tested sections are
    anomalies lose nothing. A pass is written to the shared folder; the driver reads one count of it.
    """
    now = checkpointed(mask.select(*(F.col(c).cast("bigint").alias(c) for c in AT)).distinct())
    audits = []
    for k in range(1, passes + 1):
        samples = checkpointed(center_lines(now, shape))
        found = checkpointed(sections(samples, now, shape, factor))
        events = anomaly_events(found).where("clean_left AND clean_right").select("volume", "branch", F.xxhash64("volume", "branch", "event").alias("event"), "arc0", "arc1")
        shown = found.where("state = 'anomaly'").join(events, ["volume", "branch"]).where(F.col("arc").between(F.col("arc0"), F.col("arc1")))
        evidence = checkpointed(shown.select("volume", "event", F.explode("evidence").alias("v")).select("volume", "event", "v.*").distinct())
        seeds = checkpointed(protected_seeds(samples, now))
        components, pixels = judged_components(now, evidence, seeds, shape, context)
        share = found.where("state <> 'unknown'").groupBy("volume").agg(F.avg((F.col("state") == "anomaly").cast("double")).alias("share"))
        trusted = share.where(F.col("share") <= ANOMALIES).select("volume")
        going = components.where("removable").join(trusted, "volume", "left_semi").select("root")
        removed = checkpointed(pixels.join(going, "root", "left_semi").select(*AT))
        doubtful = candidate_basins(pixels.join(going, "root", "left_anti"), now, evidence, seeds, shape)
        audits += [removed.select(F.lit(k).alias("pass"), F.lit("removed").alias("kind"), *AT), checkpointed(doubtful.select(F.lit(k).alias("pass"), F.lit("candidate").alias("kind"), *AT))]
        if removed.isEmpty():
            break
        now = checkpointed(now.join(removed, AT, "left_anti"))
    audit = audits[0]
    for a in audits[1:]:
        audit = audit.unionByName(a)
    return now, audit
