"""Masks as sets of foreground voxels (t, y, x): algebra, slice metadata, topology, morphology and overlap.

Absence is background: OR is a distinct union, AND a join, NOT an anti-join. Neighbourhoods are equi-joins on shifted
coordinates, never comparisons of pairs.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratavox.operators import graph, kernels
from stratavox.session import checkpointed

AT = ["t", "y", "x"]


def offsets(connectivity: int) -> list[tuple[int, int, int]]:
    """Neighbour offsets (dt, dy, dx) of 4- or 8-connected slices and of 6-, 18- or 26-connected volumes."""
    flat, reach = (True, {4: 1, 8: 2}[connectivity]) if connectivity in (4, 8) else (False, {6: 1, 18: 2, 26: 3}[connectivity])
    cube = itertools.product((0,) if flat else (-1, 0, 1), (-1, 0, 1), (-1, 0, 1))
    return [o for o in cube if 0 < sum(map(abs, o)) <= reach]


def _shifted(mask: DataFrame, shifts: list[tuple[int, int, int]]) -> DataFrame:
    """One row for each voxel and offset, at the place that the offset leads to; the voxel's own place as t0, y0, x0."""
    table = F.array(*(F.struct(F.lit(a).alias("dt"), F.lit(b).alias("dy"), F.lit(c).alias("dx")) for a, b, c in shifts))
    rows = mask.withColumn("o", F.explode(table))
    moved = {c: F.col(c) + F.col(f"o.d{c}") for c in AT}
    return rows.select(*(F.col(c).alias(f"{c}0") for c in AT), *(v.cast("bigint").alias(c) for c, v in moved.items()), *(c for c in mask.columns if c not in AT))


def union(*masks: DataFrame) -> DataFrame:
    out = masks[0].select(*AT)
    for m in masks[1:]:
        out = out.unionByName(m.select(*AT))
    return out.distinct()


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select(*AT).distinct().join(b.select(*AT), AT, "left_semi")


def subtract(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select(*AT).distinct().join(b.select(*AT), AT, "left_anti")


def compose(layers: DataFrame) -> DataFrame:
    """Folds layers (ord, op, t, y, x) in order: union adds, subtract removes, select starts anew with its own voxels.

    Layers before the last select have no say; of the rest the last one that touches a voxel decides.
    """
    last = layers.where(F.col("op") == "select").agg(F.coalesce(F.max("ord"), F.lit(-1)).alias("__from"))  # one row
    rows = layers.crossJoin(F.broadcast(last)).where((F.col("ord") >= F.col("__from")) & (F.col("op") != "none"))
    final = rows.groupBy(*AT).agg(F.max_by("op", "ord").alias("op"))
    return final.where(F.col("op") != "subtract").select(*AT)


def slice_boxes(mask: DataFrame, *keys: str) -> DataFrame:
    """Half-open bounding box and size of every non-empty slice."""
    return mask.groupBy(*keys, "t").agg(F.min("y").alias("y0"), (F.max("y") + 1).alias("y1"), F.min("x").alias("x0"), (F.max("x") + 1).alias("x1"), F.count("*").alias("area"))


def transpose(mask: DataFrame, order: tuple[str, str, str]) -> DataFrame:
    """Axes renamed: the first of ``order`` becomes t, and so on."""
    return mask.select(*(F.col(old).alias(new) for old, new in zip(order, AT)))


def code(size: int, t: Column, y: Column, x: Column) -> Column:
    """One number for a voxel of slices of ``size`` columns and rows."""
    return (t * size + y) * size + x


#: Slices labelled together by one task.
SLAB = 16


def _touching(connectivity: int) -> list[tuple[int, int, int]]:
    """(dt, dy, reach) of the rows after a row in which its runs have neighbours; ``reach`` columns may lie between."""
    ahead = {(dt, dy) for dt, dy, _ in offsets(connectivity) if (dt, dy) > (0, 0)}
    return sorted((dt, dy, int((dt, dy, 1) in offsets(connectivity))) for dt, dy in ahead)


def _label_slab(connectivity: int, size: int):
    """Adds root, the least code of the run's component within the slab, to the runs of a slab."""
    rules = _touching(connectivity)

    def run(table: pa.Table) -> pa.Table:
        t, y, x0, x1 = (table.column(c).to_numpy() for c in ("t", "y", "x0", "x1"))
        order = np.lexsort((x0, y, t))
        t, y, x0, x1 = (v[order] for v in (t, y, x0, x1))
        wide, high = size + 4, size + 2  # rows and slices never touch by their keys
        row = (t - t[0]) * high + y
        first, last = row * wide + x0, row * wide + x1
        a, b = [], []
        for dt, dy, reach in rules:
            there = (row + dt * high + dy) * wide
            lo = np.searchsorted(last, there + x0 - reach, "right")
            hi = np.searchsorted(first, there + x1 + reach, "left")
            n = np.maximum(hi - lo, 0)
            a.append(np.repeat(np.arange(len(t)), n))
            b.append(np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n))
        code = (t * size + y) * size + x0
        root = code[graph.merged(len(t), np.concatenate(a), np.concatenate(b))]
        return pa.table([pa.array(v) for v in (t, y, x0, x1, root)], ["t", "y", "x0", "x1", "root"])

    return run


def label_runs(runs: DataFrame, connectivity: int, size: int, slab: int = SLAB) -> DataFrame:
    """Runs (t, y, x0, x1) with root, the least voxel code of their component.

    A task labels the runs of ``slab`` slices; only runs on both sides of a slab's border make edges, between the slabs'
    components, and these go through the graph. Components of slices end with them and need no second step.
    """
    runs = runs.select(*(F.col(c).cast("bigint").alias(c) for c in ("t", "y", "x0", "x1")))
    local = runs.groupBy(F.floor(F.col("t") / slab).alias("__slab")).applyInArrow(_label_slab(connectivity, size), "t long, y long, x0 long, x1 long, root long")
    if connectivity in (4, 8):
        return local
    local = checkpointed(local)
    above = local.where(F.pmod("t", F.lit(slab)) == 0).select("t", "y", F.col("x0").alias("b0"), F.col("x1").alias("b1"), F.col("root").alias("b"))
    rules = F.array(*(F.struct(F.lit(dy).alias("dy"), F.lit(r).alias("r")) for dt, dy, r in _touching(connectivity) if dt))
    below = local.where(F.pmod("t", F.lit(slab)) == slab - 1).withColumn("o", F.explode(rules))
    below = below.select((F.col("t") + 1).alias("t"), (F.col("y") + F.col("o.dy")).alias("y"), "x0", "x1", F.col("o.r").alias("r"), F.col("root").alias("a"))
    edges = below.join(above, ["t", "y"]).where((F.col("b1") > F.col("x0") - F.col("r")) & (F.col("b0") < F.col("x1") + F.col("r"))).select("a", "b").distinct()
    found = graph.components(edges).select(F.col("node").alias("__node"), F.col("root").alias("__root"))
    joined = local.join(found, F.col("root") == F.col("__node"), "left")
    return joined.select("t", "y", "x0", "x1", F.coalesce("__root", "root").alias("root"))


def _cells_of(runs: DataFrame) -> DataFrame:
    return runs.select("t", "y", F.explode(F.sequence(F.col("x0"), F.col("x1") - 1)).alias("x"), *(c for c in runs.columns if c not in ("t", "y", "x0", "x1")))


def components(mask: DataFrame, connectivity: int, size: int) -> DataFrame:
    """The mask with root, the least voxel code of the voxel's component."""
    return _cells_of(label_runs(row_runs(mask), connectivity, size))


def component_totals(mask: DataFrame, connectivity: int, size: int) -> DataFrame:
    """(root, voxels, t0, t1, y0, y1, x0, x1): size and half-open extent of each component, from its runs."""
    runs = label_runs(row_runs(mask), connectivity, size)
    ends = [f(c).alias(n) for c, n, f in (("t", "t0", F.min), ("y", "y0", F.min), ("x0", "x0", F.min), ("x1", "x1", F.max))]
    return runs.groupBy("root").agg(F.sum(F.col("x1") - F.col("x0")).alias("voxels"), *ends, (F.max("t") + 1).alias("t1"), (F.max("y") + 1).alias("y1"))


def _background_runs(mask: DataFrame, flat: bool) -> DataFrame:
    """Runs of background in the box of each slice, or of the whole mask, with ``edge``: whether they lie at its border."""
    runs = row_runs(mask).select(*(F.col(c).cast("bigint").alias(c) for c in ("t", "y", "x0", "x1")))
    box = [F.min("y").alias("by0"), F.max("y").alias("by1"), F.min("x0").alias("bx0"), F.max("x1").alias("bx1")]
    if flat:
        boxes = runs.groupBy("t").agg(*box)
        rows = boxes.withColumn("y", F.explode(F.sequence("by0", "by1")))
        face = (F.col("y") == F.col("by0")) | (F.col("y") == F.col("by1"))
    else:
        boxes = runs.agg(F.min("t").alias("bt0"), F.max("t").alias("bt1"), *box).where("bt0 IS NOT NULL")
        rows = boxes.withColumn("t", F.explode(F.sequence("bt0", "bt1"))).withColumn("y", F.explode(F.sequence("by0", "by1")))
        face = F.col("t").isin(F.col("bt0"), F.col("bt1")) | (F.col("y") == F.col("by0")) | (F.col("y") == F.col("by1"))
    rows = rows.withColumn("face", face).select("t", "y", "bx0", "bx1", "face")
    # a row's runs between two empty ones at the ends of its box: what is between them is background
    ends = rows.select("t", "y", F.explode(F.array(F.col("bx0"), F.col("bx1"))).alias("x0")).withColumn("x1", F.col("x0"))
    order = Window.partitionBy("t", "y").orderBy("x0", "x1")
    gaps = runs.unionByName(ends).withColumn("from", F.lag("x1").over(order)).where("from < x0").select("t", "y", F.col("from").alias("x0"), F.col("x0").alias("x1"))
    out = gaps.join(rows, ["t", "y"])
    return out.select("t", "y", "x0", "x1", (F.col("face") | (F.col("x0") == F.col("bx0")) | (F.col("x1") == F.col("bx1"))).alias("edge"))


def _enclosed(mask: DataFrame, connectivity: int, size: int) -> DataFrame:
    back = checkpointed(_background_runs(mask, connectivity in (4, 8)))
    labelled = label_runs(back, connectivity, size).join(back, ["t", "y", "x0", "x1"])
    open_ = labelled.where("edge").select("root").distinct()
    return _cells_of(labelled.join(open_, "root", "left_anti").select("t", "y", "x0", "x1"))


def voids(mask: DataFrame, connectivity: int, size: int) -> DataFrame:
    """Background of the volume that no way through neighbours (6, 18 or 26) leads out of.

    Outside the box of the mask all background is open, so only the rows of that box are labelled, as runs.
    """
    return _enclosed(mask, connectivity, size)


def drop_thin(mask: DataFrame, radius: float, size: int) -> DataFrame:
    """Voxels of the 8-connected slice components whose greatest distance to the background is ``radius`` or more.

    The distance of a pixel is that to the nearest background of its slice; a slice without any keeps all.
    """
    return kernels.thick_pixels(mask, radius, size)


def component_stats(labelled: DataFrame) -> DataFrame:
    """Size, box, centroid and the pixel nearest to it (ties to the first in y, x) of each component."""
    center = labelled.groupBy("root").agg(F.count("*").alias("area"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.avg("y").alias("cy"), F.avg("x").alias("cx"))
    d2 = (F.col("y") - F.col("cy")) ** 2 + (F.col("x") - F.col("cx")) ** 2
    near = labelled.join(center.select("root", "cy", "cx"), "root").groupBy("root").agg(F.min(F.struct(F.round(d2, 9).alias("d2"), "y", "x")).alias("a"))
    return center.join(near.select("root", F.col("a.y").alias("anchor_y"), F.col("a.x").alias("anchor_x")), "root")


def keep_largest(labelled: DataFrame, n: int) -> DataFrame:
    """Voxels of the ``n`` largest components; of equal ones the later root wins."""
    size = labelled.groupBy("root").agg(F.count("*").alias("area"))
    best = size.orderBy(F.col("area").desc(), F.col("root").desc()).limit(n)
    return labelled.join(best.select("root"), "root", "left_semi")


def drop_faint(labelled: DataFrame, value: str, least: float) -> DataFrame:
    """Voxels of components whose greatest value reaches ``least``."""
    strong = labelled.groupBy("root").agg(F.max(value).alias("__top")).where(F.col("__top") >= least)
    return labelled.join(strong.select("root"), "root", "left_semi")


def holes(mask: DataFrame, size: int) -> DataFrame:
    """Background of slices that no 4-connected way leads to the border, found among the runs of each slice's box."""
    return _enclosed(mask, 4, size)


def clean_slices(rows: DataFrame, value: str, least: float, radius: float, size: int) -> DataFrame:
    """Slice cleanup in its fixed order: faint components go, then thin ones, then holes are filled."""
    strong = drop_faint(components(rows, 8, size).join(rows.select(*AT, value), AT), value, least)
    thick = checkpointed(drop_thin(strong, radius, size))
    return thick.unionByName(holes(thick, size))


def keep_centre(mask: DataFrame, connectivity: int, size: int) -> DataFrame:
    """Of each slice the component that holds its centre pixel, else the one nearest to it (ties to the lower root)."""
    labelled = components(mask, connectivity, size)
    c = size // 2
    near = labelled.groupBy("t", "root").agg(F.min((F.col("y") - c) ** 2 + (F.col("x") - c) ** 2).alias("d2"))
    best = near.groupBy("t").agg(F.min(F.struct("d2", "root")).alias("b")).select(F.col("b.root").alias("root"))
    return labelled.join(best, "root", "left_semi")


def gate(labelled: DataFrame, support: DataFrame, accepted: bool = True) -> DataFrame:
    """Whole components that touch the support, or those that do not."""
    hit = labelled.join(support.select(*AT), AT, "left_semi").select("root").distinct()
    return labelled.join(hit, "root", "left_semi" if accepted else "left_anti")


def dilate(mask: DataFrame, connectivity: int, size: int) -> DataFrame:
    grown = _shifted(mask.select(*AT), [(0, 0, 0), *offsets(connectivity)]).select(*AT).distinct()
    return grown.where((F.col("t") >= 0) & F.col("y").between(0, size - 1) & F.col("x").between(0, size - 1))


def adjacent_labels(labelled: DataFrame, label: str) -> DataFrame:
    """(t, a, b): labels of slice t that touch labels of slice t + 1, within a pixel."""
    reach = [(1, dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]
    here = _shifted(labelled.select(*AT, F.col(label).alias("a")), reach)
    return here.join(labelled.select(*AT, F.col(label).alias("b")), AT).select(F.col("t0").alias("t"), "a", "b").distinct()


def endpoints(labelled: DataFrame, step: int) -> DataFrame:
    """(t, root) of slice components that no voxel touches in slice t + ``step``."""
    reach = [(step, dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]
    going = _shifted(labelled.select(*AT, "root"), reach).join(labelled.select(*AT), AT, "left_semi").select("root").distinct()
    return labelled.select("t", "root").distinct().join(going, "root", "left_anti")


def projections(tips: DataFrame, targets: DataFrame, distance: int, slope: float, most: int) -> DataFrame:
    """(root, step, d2, target): for each tip (root, t, y, x) the nearest voxels of other components ahead of it.

    A voxel counts up to ``distance`` slices ahead within a cone that widens by ``slope`` a slice; each target counts by its
    nearest step, and ``most`` targets are kept by (step, d2, target). Slices ahead and the cells around the cone, as wide as it
    gets, are exploded: the join is an equi-join on slice and cell.
    """
    wide = max(1, math.ceil(slope * distance))
    cell = lambda c: F.floor(F.col(c) / wide)
    side = F.array(F.lit(-1), F.lit(0), F.lit(1))
    ahead = tips.select("root", F.col("y").alias("y0"), F.col("x").alias("x0"), "t", F.explode(F.sequence(F.lit(1), F.lit(distance))).alias("step"))
    ahead = ahead.withColumn("t", F.col("t") + F.col("step"))
    ahead = ahead.withColumn("i", F.explode(side)).withColumn("j", F.explode(side)).withColumns({"cy": cell("y0") + F.col("i"), "cx": cell("x0") + F.col("j")})
    pairs = ahead.join(targets.select("t", "y", "x", F.col("root").alias("target"), cell("y").alias("cy"), cell("x").alias("cx")), ["t", "cy", "cx"])
    d2 = (F.col("y") - F.col("y0")) ** 2 + (F.col("x") - F.col("x0")) ** 2
    pairs = pairs.withColumn("d2", d2.cast("bigint")).where((F.col("d2") <= (slope * F.col("step")) ** 2) & (F.col("target") != F.col("root")))
    best = pairs.groupBy("root", "target").agg(F.min(F.struct("step", "d2")).alias("b")).select("root", "target", "b.step", "b.d2")
    order = Window.partitionBy("root").orderBy("step", "d2", "target")
    return best.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most).drop("nth")


def row_runs(mask: DataFrame) -> DataFrame:
    """(t, y, x0, x1): maximal runs of each row, half-open."""
    order = Window.partitionBy("t", "y").orderBy("x")
    rows = mask.select(*AT).distinct().withColumn("g", F.col("x") - F.row_number().over(order))
    return rows.groupBy("t", "y", "g").agg(F.min("x").alias("x0"), (F.max("x") + 1).alias("x1")).drop("g")


def run_adjacency(runs: DataFrame, reach: int = 1) -> DataFrame:
    """Pairs of runs in neighbouring rows of a slice that overlap or touch within ``reach`` columns."""
    below = runs.select("t", (F.col("y") - 1).alias("y"), F.col("x0").alias("b0"), F.col("x1").alias("b1"))
    return runs.join(below, ["t", "y"]).where((F.col("x0") < F.col("b1") + reach) & (F.col("b0") < F.col("x1") + reach))


def overlap(left: DataFrame, right: DataFrame, apart: bool = False) -> DataFrame:
    """Overlap of the pairs of tracks (obj, frame, y, x) that meet somewhere, over their shared frames.

    Areas are counted by frame first and intersections by an equi-join on the pixel; only frames that both tracks have are
    compared. Percentiles are exact and interpolated. With ``apart`` pairs that share frames but no pixel are listed too.
    """
    area = lambda df, s: df.groupBy(F.col("obj").alias(f"obj_{s}"), "frame").agg(F.count("*").alias(f"area_{s}"))
    both = left.select(F.col("obj").alias("obj_l"), "frame", "y", "x").join(right.select(F.col("obj").alias("obj_r"), "frame", "y", "x"), ["frame", "y", "x"])
    inter = both.groupBy("obj_l", "obj_r", "frame").agg(F.count("*").alias("inter"))
    areas = [area(left, "l"), area(right, "r")]
    met = areas[0].join(areas[1], "frame") if apart else inter.select("obj_l", "obj_r").distinct().join(areas[0], "obj_l").join(areas[1], ["obj_r", "frame"])
    rows = met.join(inter, ["obj_l", "obj_r", "frame"], "left")
    rows = rows.withColumn("inter", F.coalesce("inter", F.lit(0))).withColumn("union", F.col("area_l") + F.col("area_r") - F.col("inter"))
    rows = rows.withColumn("iou", F.col("inter") / F.col("union")).withColumn("drift", F.abs(F.log(F.col("area_l") / F.col("area_r"))))
    out = rows.groupBy("obj_l", "obj_r").agg(
        F.count("*").alias("n_frames"),
        F.sum("inter").alias("voxel_intersection"),
        F.sum("union").alias("voxel_union"),
        F.sum(F.col("area_l") + F.col("area_r")).alias("__areas"),
        F.avg("iou").alias("frame_iou_mean"),
        *(F.percentile("iou", F.lit(p)).alias(n) for p, n in ((0.5, "frame_iou_median"), (0.1, "frame_iou_p10"))),
        F.min("iou").alias("frame_iou_min"),
        F.max("iou").alias("frame_iou_max"),
        F.percentile("drift", F.lit(0.95)).alias("area_log_drift_p95"),
    )
    return out.withColumn("iou_3d", F.col("voxel_intersection") / F.col("voxel_union")).withColumn("dice_3d", 2 * F.col("voxel_intersection") / F.col("__areas")).drop("__areas")


def margins(pairs: DataFrame, value: str) -> DataFrame:
    """Adds margin: the value less the best other one of the same left or right track (null without any)."""
    def others(key: str) -> Column:
        w = Window.partitionBy(key).orderBy(F.col(value).desc(), "obj_l", "obj_r")
        all_ = Window.partitionBy(key)
        nth = F.row_number().over(w)
        top = F.max(value).over(all_)
        second = F.nth_value(value, 2).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        return F.when(nth == 1, second).otherwise(top)

    return pairs.withColumn("margin", F.col(value) - F.greatest(others("obj_l"), others("obj_r")))


def confusion(prediction: DataFrame, truth: DataFrame, *keys: str) -> DataFrame:
    """Voxel counts and scores of a prediction against the truth; scores of empty slices are 1."""
    on = [*keys, *[c for c in AT if c not in keys]]
    p, g = prediction.select(*on).distinct().withColumn("p", F.lit(1)), truth.select(*on).distinct().withColumn("g", F.lit(1))
    both = p.join(g, on, "full_outer")
    out = both.groupBy(*keys).agg(F.count_if(F.col("p").isNotNull() & F.col("g").isNotNull()).alias("tp"), F.count_if(F.col("g").isNull()).alias("fp"), F.count_if(F.col("p").isNull()).alias("fn"))
    share = lambda a, b: F.when(b == 0, F.lit(1.0)).otherwise(a / b)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return out.select(*keys, "tp", "fp", "fn", share(tp, tp + fp + fn).alias("iou"), share(2 * tp, 2 * tp + fp + fn).alias("dice"), share(tp, tp + fp).alias("precision"), share(tp, tp + fn).alias("recall"))
