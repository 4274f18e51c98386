"""Interpolation between the ends of objects: endpoint seeds, targets in a cone, walk-back, bridges with a least radius, and one pass.

Masks are (volume, t, y, x). Volumes are worked on together: their slices get numbers that leave a gap between volumes, so that
nothing touches across it. Objects are 26-connected, their pieces in a slice 8-connected; both go by their least voxel code.
Searches fetch cells of pixels by equi-joins; a Python group is one seed's cone or one bridge.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratavox.operators import groups, kernels, masks
from stratavox.session import checkpointed

AT = ["volume", "t", "y", "x"]
#: Side of the cells by which a cone fetches pixels, and empty places around the shapes of a bridge.
CELL, PAD = 32, 4
#: Slices that one task compares with each other.
SLAB = 32


def pieces(mask: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """(s, y, x, label, piece): the slice number, object and piece of every voxel."""
    s = F.col("volume") * (shape[0] + 2) + F.col("t")
    flat = checkpointed(mask.select(s.cast("bigint").alias("t"), F.col("y").cast("bigint").alias("y"), F.col("x").cast("bigint").alias("x")).distinct())
    size = max(shape[1:])
    whole = masks.components(flat, 26, size).withColumnRenamed("root", "label")
    part = masks.components(flat, 8, size).withColumnRenamed("root", "piece")
    return whole.join(part, ["t", "y", "x"]).withColumnRenamed("t", "s")


def anchors(rows: DataFrame) -> DataFrame:
    """(s, label, piece, area, y, x): the pixel of each piece nearest to its centroid, the first of equals."""
    middle = rows.groupBy("piece").agg(F.avg("y").alias("cy"), F.avg("x").alias("cx"), F.count("*").alias("area"))
    d2 = F.round((F.col("y") - F.col("cy")) ** 2 + (F.col("x") - F.col("cx")) ** 2, 9)
    best = rows.join(middle, "piece").groupBy("s", "label", "piece", "area").agg(F.min(F.struct(d2.alias("d2"), "y", "x")).alias("a"))
    return best.select("s", "label", "piece", "area", "a.y", "a.x")


def touching(rows: DataFrame) -> DataFrame:
    """(a, b, step, overlap): pieces of an object in slices next to each other (b's is a's + step) that touch, and b's pixels that do.

    A task compares the slices of a slab, and one to either side of it, with each other.
    """
    def run(table: pa.Table) -> pa.Table:
        s, y, x, label, piece = (table[c].to_numpy() for c in ("s", "y", "x", "label", "piece"))
        high, wide = int(y.max() - y.min()) + 3, int(x.max() - x.min()) + 3  # an empty row and column around it all
        code = ((s - s.min()) * high + (y - y.min() + 1)) * wide + (x - x.min() + 1)
        order = np.argsort(code)
        rank = code[order]
        names, number = np.unique(piece, return_inverse=True)
        own = np.flatnonzero(s // SLAB == table["g"][0].as_py())
        out = []
        for step in (1, -1):
            met = []
            for move in (i * wide + j for i in (-1, 0, 1) for j in (-1, 0, 1)):
                there = code[own] - step * high * wide + move
                at = np.minimum(np.searchsorted(rank, there), len(rank) - 1)
                other = order[at]
                hit = (rank[at] == there) & (label[other] == label[own])
                met.append(own[hit] * len(names) + number[other[hit]])
            pixel, a = np.divmod(np.unique(np.concatenate(met)), len(names))
            pairs, n = np.unique(a * len(names) + number[pixel], return_counts=True)
            out.append((names[pairs // len(names)], names[pairs % len(names)], np.full(len(pairs), step), n))
        return pa.table([pa.array(np.concatenate(v), pa.int64()) for v in zip(*out)], ["a", "b", "step", "overlap"])

    slabs = F.explode(F.sequence(F.floor((F.col("s") - 1) / SLAB), F.floor((F.col("s") + 1) / SLAB)))
    rows = rows.select("s", "y", "x", "label", "piece", slabs.alias("g"))
    return groups.spread(rows, "g").groupBy("g").applyInArrow(run, "a long, b long, step long, overlap long")


def seeds(rows: DataFrame, found: DataFrame, met: DataFrame | None = None) -> DataFrame:
    """(piece, direction, s, label, y, x): pieces that no voxel of the next slice in that direction (1 or -1) touches.

    ``met`` is what ``touching`` found; voxels that touch are of one object.
    """
    met = touching(rows) if met is None else met
    ends = found.withColumn("direction", F.explode(F.array(F.lit(1).cast("bigint"), F.lit(-1).cast("bigint"))))
    going = met.select(F.col("a").alias("piece"), F.col("step").alias("direction")).distinct()
    return ends.join(going, ["piece", "direction"], "left_anti").select("piece", "direction", "s", "label", "y", "x")


def candidates(rows: DataFrame, starts: DataFrame, shape: tuple[int, int, int], distance: int, angle: float, most: int) -> DataFrame:
    """(piece, direction, nth, step, target, ts, ty, tx): up to ``most`` objects that a seed's piece meets when it is projected ahead.

    At each step the piece widens by tan(angle) pixels (narrows, if the angle is negative). An object counts at the first step
    at which the projection holds any of it, with its pixel nearest to the seed (the first of equals); objects are ranked by
    (step, squared distance, label). A seed fetches the cells that its cone can meet, slice by slice, and none beyond its volume.
    """
    slope = math.tan(math.radians(angle))
    wide = max(0, math.ceil(slope * distance))
    box = rows.groupBy("piece").agg(F.min("y").alias("y0"), F.max("y").alias("y1"), F.min("x").alias("x0"), F.max("x").alias("x1"))
    deep = shape[0] + 2
    ahead = starts.join(box, "piece").withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(distance))))
    ahead = ahead.withColumn("ts", F.col("s") + F.col("direction") * F.col("step")).where((F.floor(F.col("ts") / deep) == F.floor(F.col("s") / deep)) & F.pmod("ts", F.lit(deep)).between(0, shape[0] - 1))
    for c in ("y", "x"):
        grow = F.when(F.col("step") == 0, 0).otherwise(wide)
        ahead = ahead.withColumn(f"c{c}", F.explode(F.sequence(F.floor((F.col(f"{c}0") - grow) / CELL), F.floor((F.col(f"{c}1") + grow) / CELL))))
    cells = rows.groupBy(F.col("s").alias("ts"), F.floor(F.col("y") / CELL).alias("cy"), F.floor(F.col("x") / CELL).alias("cx")).agg(F.collect_list(F.struct("y", "x", "label", "piece")).alias("pixels"))
    met = ahead.select("piece", "direction", "step", "ts", "cy", "cx", F.col("label").alias("own"), F.col("y").alias("ay"), F.col("x").alias("ax")).join(cells, ["ts", "cy", "cx"])

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        piece, own, ay, ax = (table[c][0].as_py() for c in ("piece", "own", "ay", "ax"))
        pixels = table["pixels"].combine_chunks()
        many = pixels.value_lengths().to_numpy(zero_copy_only=False)
        every = np.stack([*(np.repeat(table[c].to_numpy(), many) for c in ("step", "ts")), *_fields(pixels, "y", "x", "label", "piece")], 1).astype(np.int64)
        source = every[(every[:, 0] == 0) & (every[:, 5] == piece)]
        there = every[(every[:, 0] > 0) & (every[:, 4] != own)]
        y0, x0 = source[:, 2].min() - wide - 1, source[:, 3].min() - wide - 1
        mask = np.zeros((source[:, 2].max() + wide + 2 - y0, source[:, 3].max() + wide + 2 - x0), bool)
        mask[source[:, 2] - y0, source[:, 3] - x0] = True
        there = there[((there[:, 2:4] >= (y0, x0)) & (there[:, 2:4] < np.add((y0, x0), mask.shape))).all(1)]
        if len(there):
            sdf = kernels.signed_distance(mask)[there[:, 2] - y0, there[:, 3] - x0]
            there = there[sdf >= -slope * there[:, 0] - 1e-9]
        step, ts, y, x, label, _ = there.T
        d2 = (y - ay) ** 2 + (x - ax) ** 2
        best = there[np.lexsort((ts, x, y, d2, step, label))]  # of an object's pixels, the first
        best = best[np.append(True, best[1:, 4] != best[:-1, 4])[: len(best)]]
        step, ts, y, x, label, _ = best.T
        ranked = np.lexsort((label, (y - ay) ** 2 + (x - ax) ** 2, step))[:most]
        same = lambda v: pa.array(np.full(len(ranked), v, np.int64))
        nth = pa.array(np.arange(1, len(ranked) + 1), pa.int32())
        return pa.table([same(piece), same(table["direction"][0].as_py()), nth, *(pa.array(v[ranked]) for v in (step, label, ts, y, x))], ["piece", "direction", "nth", "step", "target", "ts", "ty", "tx"])

    return groups.spread(met, "piece", "direction").groupBy("piece", "direction").applyInArrow(run, "piece long, direction long, nth int, step long, target long, ts long, ty long, tx long")


def _fields(pixels: pa.ListArray, *names: str) -> list[np.ndarray]:
    """Columns of all structs of a list column, in order."""
    flat = pixels.flatten()
    return [flat.field(n).to_numpy(zero_copy_only=False) for n in names]


def walk_back(rows: DataFrame, found: DataFrame, starts: DataFrame, steps: int, met: DataFrame | None = None) -> DataFrame:
    """(piece, direction, back, from_piece, s, y, x): a seed and up to ``steps`` places behind it, one a slice, along its object.

    Of the object's pieces in the slice behind, the one that overlaps the last piece (widened by a pixel) most is followed,
    then the one nearest to the last place, then the largest, then the first; the place is its pixel nearest to the last one.
    """
    overlap = checkpointed((touching(rows) if met is None else met).select("a", "b", "overlap"))
    area = found.select("piece", "area")
    now = starts.select("piece", "direction", F.lit(0).alias("back"), F.col("piece").alias("from_piece"), "label", "s", "y", "x")
    out = now
    for k in range(1, steps + 1):
        ahead = now.select("piece", "direction", "label", "from_piece", F.col("y").alias("py"), F.col("x").alias("px"), (F.col("s") - F.col("direction")).alias("s"))
        pixels = ahead.join(rows.select("s", "label", "y", "x", F.col("piece").alias("to")), ["s", "label"])
        d2 = (F.col("y") - F.col("py")) ** 2 + (F.col("x") - F.col("px")) ** 2
        close = pixels.groupBy("piece", "direction", "label", "from_piece", "s", "to").agg(F.min(F.struct(d2.cast("bigint").alias("d2"), "y", "x")).alias("p"))
        close = close.join(overlap.select(F.col("a").alias("from_piece"), F.col("b").alias("to"), "overlap"), ["from_piece", "to"], "left").join(area.withColumnRenamed("piece", "to"), "to")
        best = F.max(F.struct(F.coalesce("overlap", F.lit(0)).alias("o"), (-F.col("p.d2")).alias("d"), "area", (-F.col("to")).alias("first"), F.col("p.y").alias("y"), F.col("p.x").alias("x"))).alias("b")
        now = close.groupBy("piece", "direction", "label", "s").agg(best).select("piece", "direction", F.lit(k).alias("back"), (-F.col("b.first")).alias("from_piece"), "label", "s", "b.y", "b.x")
        now = checkpointed(now)
        out = out.unionByName(now)
    return out.drop("label")


# --- bridges


def centred(mask: np.ndarray) -> np.ndarray:
    """The 8-connected component at the centre of a shape, or the one nearest to it, with its holes filled."""
    label = kernels.slice_labels(mask)
    c = (mask.shape[0] // 2, mask.shape[1] // 2)
    at = np.argwhere(mask)
    keep = label[c] if mask[c] else label[tuple(at[((at - c) ** 2).sum(1).argmin()])]
    own = label == keep
    back = np.pad(~own, 1, constant_values=True)
    outside = kernels.slice_labels(back, 0)
    return ~(outside == outside[0, 0])[1:-1, 1:-1]


def bridge_shapes(source: np.ndarray, a: tuple[int, int], target: np.ndarray, b: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Signed distances of two pieces (pixels y, x) on one canvas whose centre is the anchor of each."""
    half = np.maximum(np.abs(source - a).max(0), np.abs(target - b).max(0)) + PAD
    out = []
    for pixels, at in ((source, a), (target, b)):
        m = np.zeros(2 * half + 1, bool)
        m[tuple((pixels - at + half).T)] = True
        out.append(kernels.signed_distance(m))
    return out[0], out[1]


def sections_of(d0: np.ndarray, d1: np.ndarray, steps: int) -> list[np.ndarray]:
    """The shapes between two ends: where the distances, mixed by the step, are not negative; their centre components."""
    out = []
    for k in range(1, steps):
        m = d0 * (steps - k) + d1 * k >= -1e-9
        out.append(centred(m) if m.any() else m)
    return out


def least_radius(d0: np.ndarray, d1: np.ndarray, steps: int, threshold: float = 0.0) -> tuple[float, list[np.ndarray] | None]:
    """(least radius of a bridge from end to end, or one that settles the comparison with a positive threshold; its shapes).

    The disk that both ends have about their anchors stays in every shape between, so if its radius is over the threshold no
    shape need be measured; they are not even made here, and None stands for them.
    """
    c = (d0.shape[0] // 2, d0.shape[1] // 2)
    sure = float(min(d0[c], d1[c]))
    if threshold > 0 and sure > threshold + max(1e-6, 4 * np.finfo(np.float32).eps * max(abs(sure), threshold, 1.0)):
        return sure, None
    least = float(min(d0.max(), d1.max()))
    if threshold > 0 and least <= threshold:
        return least, None
    shapes = sections_of(d0, d1, steps)
    for m in shapes:
        least = min(least, math.sqrt(int(kernels.squared_distance(~m).max(where=m, initial=0)))) if m.any() else 0.0
        if threshold > 0 and least <= threshold:
            break
    return least, shapes


def bridges(rows: DataFrame, plans: DataFrame, shape: tuple[int, int, int], threshold: float) -> DataFrame:
    """(piece, direction, nth, back, accepted, radius, pixels array<struct<s,y,x>>) of every planned bridge.

    ``plans`` has (piece, direction, nth, back, from_piece, s, y, x, to_piece, ts, ty, tx). One is accepted if its least radius
    is over the threshold (any, if that is 0). A shape is put with its centre at the rounded place between the anchors and cut
    at the slice's border.
    """
    key = ["piece", "direction", "nth", "back"]
    ends = plans.select(*key, "s", "y", "x", "ts", "ty", "tx", F.explode(F.array(F.struct(F.lit(0).alias("end"), F.col("from_piece").alias("p")), F.struct(F.lit(1).alias("end"), F.col("to_piece").alias("p")))).alias("e"))
    shapes = rows.groupBy("piece").agg(F.collect_list(F.struct("y", "x")).alias("pixels")).withColumnRenamed("piece", "p")
    both = ends.select(*key, "s", "y", "x", "ts", "ty", "tx", "e.end", F.col("e.p").alias("p")).join(shapes, "p").drop("p")

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        s, y, x, ts, ty, tx = (table[c][0].as_py() for c in ("s", "y", "x", "ts", "ty", "tx"))
        pixels = table["pixels"].combine_chunks()
        cuts = np.cumsum(pixels.value_lengths().to_numpy(zero_copy_only=False))[:-1]
        ends = dict(zip(table["end"].to_pylist(), np.split(np.stack(_fields(pixels, "y", "x"), 1), cuts)))
        steps, sign = abs(ts - s), 1 if ts > s else -1
        a, b = (y, x), (ty, tx)
        d0, d1 = bridge_shapes(ends[0], a, ends[1], b)
        radius, shapes = least_radius(d0, d1, steps, threshold)
        ok = threshold <= 0 or radius > threshold
        painted = [np.zeros((0, 3), np.int64)]
        for k, m in enumerate((shapes if shapes is not None else sections_of(d0, d1, steps)) if ok else [], 1):
            at = np.argwhere(m) - np.array(m.shape) // 2 + [round(p + k / steps * (q - p)) for p, q in zip(a, b)]
            at = at[((at >= 0) & (at < shape[1:])).all(1)]
            painted.append(np.column_stack([np.full(len(at), s + sign * k), at]))
        every = np.concatenate(painted).astype(np.int64)
        voxels = pa.ListArray.from_arrays(pa.array([0, len(every)], pa.int32()), pa.StructArray.from_arrays([pa.array(every[:, c]) for c in range(3)], ["s", "y", "x"]))
        one = table.slice(0, 1)
        return pa.table([*(one[c] for c in key), pa.array([bool(ok)]), pa.array([float(radius)]), voxels], [*key, "accepted", "radius", "pixels"])

    return groups.spread(both, *key).groupBy(*key).applyInArrow(run, "piece long, direction long, nth int, back int, accepted boolean, radius double, pixels array<struct<s:long,y:long,x:long>>")


def planned(rows: DataFrame, found: DataFrame, starts: DataFrame, shape: tuple[int, int, int], distance: int, angle: float, most: int, back: int, met: DataFrame | None = None) -> DataFrame:
    """All bridges to try: each seed and place behind it, to each of the seed's candidates (ranked ``nth``)."""
    ahead = candidates(rows, starts, shape, distance, angle, most)
    behind = walk_back(rows, found, starts, back, met)
    target = rows.select(F.col("s").alias("ts"), F.col("y").alias("ty"), F.col("x").alias("tx"), F.col("piece").alias("to_piece"))
    return behind.join(ahead, ["piece", "direction"]).join(target, ["ts", "ty", "tx"])


def layers(painted: DataFrame, back: int) -> DataFrame:
    """(walk_back, candidate) added to bridges: layer 1 holds those from the seed and the first place behind it; 0 without walk-back."""
    return painted.withColumn("walk_back", F.greatest(F.lit(1), F.col("back")) if back else F.lit(0)).withColumnRenamed("nth", "candidate")


def interpolate(mask: DataFrame, shape: tuple[int, int, int], distance: int = 8, angle: float = 15.0, most: int = 2, back: int = 1, threshold: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """One pass: (delta, bridges). delta is (volume, t, y, x, walk_back, candidate), the voxels that each layer of bridges adds to the mask."""
    rows = checkpointed(pieces(mask, shape))
    found = checkpointed(anchors(rows))
    met = checkpointed(touching(rows))
    starts = checkpointed(seeds(rows, found, met))
    plans = checkpointed(planned(rows, found, starts, shape, distance, angle, most, back, met))
    made = checkpointed(layers(bridges(rows, plans, shape, threshold), back))
    deep = shape[0] + 2
    new = made.where("accepted").select("walk_back", "candidate", F.explode("pixels").alias("v")).select(F.floor(F.col("v.s") / deep).alias("volume"), F.pmod("v.s", F.lit(deep)).alias("t"), "v.y", "v.x", "walk_back", "candidate").distinct()
    delta = new.join(mask.select(*(F.col(c).cast("bigint").alias(c) for c in AT)), AT, "left_anti")
    return delta, made.drop("pixels")


def interpolate_passes(mask: DataFrame, shape: tuple[int, int, int], passes: int = 2, **how) -> DataFrame:
    """(volume, t, y, x, pass): the mask (pass 0) and what each pass adds; each starts from all before, and one that adds nothing ends it."""
    now = checkpointed(mask.select(*(F.col(c).cast("bigint").alias(c) for c in AT)).distinct().withColumn("pass", F.lit(0)))
    for k in range(1, passes + 1):
        delta = checkpointed(interpolate(now.select(*AT), shape, **how)[0].select(*AT).distinct().withColumn("pass", F.lit(k)))
        if delta.isEmpty():
            break
        now = checkpointed(now.unionByName(delta))
    return now
