"""Numerical kernels on slices and small matrices that have no relational form; one group is one slice or one matrix."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavox.operators import graph
from stratavox.session import checkpointed


#: Pixels of the slices that one group holds together.
GROUP_PIXELS = 1 << 15
#: Pairs of places of all lines that are compared at once, and places to either side that are compared one after the other.
SMALL, BESIDE = 1 << 17, 32


def _along(f: np.ndarray) -> np.ndarray:
    """min over q of f[q] + (p - q)^2 along the first axis of (n, lines), exactly: the lower envelope of parabolas.

    A stack for each line keeps the places whose parabolas are lowest somewhere, with the place from which each is; every
    place is put on once and taken off once at most, so time is linear in the array. Small arrays compare all pairs at once;
    where no value is over ``BESIDE`` squared, none from farther away than that can be less than a place's own.
    """
    n, m = f.shape
    if 0 < n * n * m <= SMALL:
        place = np.arange(n)
        return (((place[:, None] - place) ** 2)[:, :, None] + f).min(1)
    top = int(f.max(initial=0))
    if top <= BESIDE * BESIDE:
        out = f.copy()
        for k in range(1, min(math.isqrt(top), n - 1) + 1):
            if k * k >= top:
                break
            np.minimum(out[k:], f[:-k] + k * k, out=out[k:])
            np.minimum(out[:-k], f[k:] + k * k, out=out[:-k])
            top = int(out.max())
        return out
    site, start = np.zeros((n, m), np.int64), np.zeros((n, m), np.int64)
    top = np.zeros(m, np.int64)
    lines = np.arange(m)
    value = lambda p, q, line: (p - q) ** 2 + f[q, line]
    for q in range(1, n):
        left = lines
        while len(left):
            k = top[left]
            at = start[k, left]
            over = value(at, site[k, left], left) > value(at, q, left)
            left = left[over]
            top[left] -= 1
            left = left[top[left] >= 0]
        fresh = top < 0
        u = site[np.maximum(top, 0), lines]
        begin = np.where(fresh, 0, 1 + (q * q - u * u + f[q] - f[u, lines]) // np.maximum(2 * (q - u), 1))
        put = lines[fresh | (begin < n)]
        top[put] += 1
        site[top[put], put], start[top[put], put] = q, begin[put]
    out = np.empty_like(f)
    for p in range(n - 1, -1, -1):
        out[p] = value(p, site[top, lines], lines)
        top -= start[top, lines] == p
        np.maximum(top, 0, out=top)
    return out


def squared_distance(mask: np.ndarray) -> np.ndarray:
    """Squared distance of each pixel of a slice, or of each of several (k, rows, columns), to its nearest set one; a large number without any."""
    m = mask if mask.ndim == 3 else mask[None]
    k, h, w = m.shape
    far = 4 * (h + w) ** 2
    place = np.arange(w)
    before = np.maximum.accumulate(np.where(m, place, -2 * w), axis=2)
    after = np.minimum.accumulate(np.where(m, place, 3 * w)[..., ::-1], axis=2)[..., ::-1]
    near = np.minimum(place - before, after - place)
    rows = np.where(near < w, near * near, far)
    out = _along(rows.transpose(1, 0, 2).reshape(h, k * w)).reshape(h, k, w).transpose(1, 0, 2)
    return np.minimum(out, far).reshape(mask.shape)


def signed_distance(mask: np.ndarray) -> np.ndarray:
    """Distance to the background inside the mask, less the distance to the mask outside."""
    return np.sqrt(squared_distance(~mask)) * mask - np.sqrt(squared_distance(mask)) * ~mask


def _stack(pdf: pd.DataFrame, size: int | None = None, canvas: int | None = None) -> tuple[np.ndarray, np.ndarray, int, int]:
    """(slice numbers, masks, y0, x0) of the slices of a group: whole, or in their common box with one place around it inside the canvas."""
    t, at = np.unique(pdf["t"].to_numpy(), return_inverse=True)
    y, x = pdf["y"].to_numpy(), pdf["x"].to_numpy()
    if size is not None:
        y0, x0, y1, x1 = 0, 0, size, size
    else:
        y0, x0 = max(int(y.min()) - 1, 0), max(int(x.min()) - 1, 0)
        y1, x1 = min(int(y.max()) + 2, canvas), min(int(x.max()) + 2, canvas)
    out = np.zeros((len(t), y1 - y0, x1 - x0), bool)
    out[at, y - y0, x - x0] = True
    return t, out, y0, x0


def _batch(size: int):
    """Number of the group of a slice, so that a group's slices have about ``GROUP_PIXELS`` pixels."""
    return F.floor(F.col("t") / max(1, GROUP_PIXELS // (size * size)))


def distances(mask: DataFrame, size: int) -> DataFrame:
    """(t, y, x, d2): squared distance of the background pixels of each non-empty slice to the mask."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        t, m, _, _ = _stack(pdf, size)
        d = squared_distance(m)
        k, y, x = np.nonzero(~m)
        return pd.DataFrame({"t": t[k], "y": y, "x": x, "d2": d[k, y, x]})

    return mask.select("t", "y", "x").groupBy(_batch(size).alias("g")).applyInPandas(run, "t long, y long, x long, d2 long")


def slice_labels(mask: np.ndarray, reach: int = 1) -> np.ndarray:
    """Label of each set pixel, the index of the first of its component; ``reach`` 1 counts diagonals, 0 doesn't."""
    n, w = mask.size, mask.shape[1]
    label = np.where(mask, np.arange(n).reshape(mask.shape), n)
    steps = [(0, 1), (1, 0)] + ([(1, 1), (1, -1)] if reach else [])
    root = np.append(np.arange(n), n)
    pairs = []
    for dy, dx in steps:
        a = label[: mask.shape[0] - dy, max(0, -dx) : w - max(0, dx)]
        b = label[dy:, max(0, dx) : w - max(0, -dx)]
        ok = (a < n) & (b < n)
        pairs.append((a[ok], b[ok]))
    a, b = (np.concatenate(x) for x in zip(*pairs))
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (root[root] != root).any():
            root = root[root]
    return root[label]


def thick_pixels(mask: DataFrame, radius: float, size: int) -> DataFrame:
    """(t, y, x): pixels of the slices' components that reach ``radius`` pixels from the background somewhere."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        t, m, y0, x0 = _stack(pdf, canvas=size)
        d2 = squared_distance(~m)
        apart = np.zeros((len(t), m.shape[1] + 1, m.shape[2]), bool)  # an empty row between slices keeps their components apart
        apart[:, :-1] = m
        label = slice_labels(apart.reshape(-1, m.shape[2])).reshape(apart.shape)[:, :-1]
        top = np.zeros(apart.size + 1, np.int64)
        np.maximum.at(top, label[m], d2[m])
        k, y, x = np.nonzero(m & (top[label] >= radius * radius - 1e-9))
        return pd.DataFrame({"t": t[k], "y": y + y0, "x": x + x0})

    return mask.select("t", "y", "x").distinct().groupBy(_batch(size).alias("g")).applyInPandas(run, "t long, y long, x long")


def bridge(mask: DataFrame, size: int, gap: int) -> DataFrame:
    """(t, y, x): masks between slices ``gap`` apart, by signed distances that are mixed by place; slices at multiples of it.

    Each slice is sent to the pair it opens and the pair it closes, so a group holds two slices, in their common box: outside
    it both distances are negative.
    """
    ends = mask.where(F.col("t") % gap == 0).select("t", "y", "x", F.explode(F.array(F.col("t"), F.col("t") - gap)).alias("pair"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        first, out = int(pdf["pair"].iloc[0]), []
        t, m, y0, x0 = _stack(pdf, canvas=size)
        if len(t) == 2:
            da, db = signed_distance(m[0]), signed_distance(m[1])
            for k in range(1, gap):
                y, x = np.nonzero(da * (gap - k) + db * k >= 0)
                out.append(pd.DataFrame({"t": np.full(len(y), first + k, np.int64), "y": y + y0, "x": x + x0}))
        return pd.concat(out) if out else pd.DataFrame({c: np.zeros(0, np.int64) for c in ("t", "y", "x")})

    return ends.groupBy("pair").applyInPandas(run, "t long, y long, x long")


def assign(weights: np.ndarray) -> np.ndarray:
    """Column of each row in an assignment of greatest weight (rows not more than columns); ties go to lower columns."""
    cost = -np.asarray(weights, np.float64)
    n, m = cost.shape
    u, v, match = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        low, used, way = np.full(m + 1, np.inf), np.zeros(m + 1, bool), np.zeros(m + 1, int)
        while True:
            used[j0] = True
            slack = cost[match[j0] - 1] - u[match[j0]] - v[1:]
            better = ~used[1:] & (slack < low[1:])
            low[1:][better], way[1:][better] = slack[better], j0
            free = np.where(used[1:], np.inf, low[1:])
            j1 = int(free.argmin()) + 1
            step = free[j1 - 1]
            u[match[used]] += step
            v[used] -= step
            low[~used] -= step
            j0 = j1
            if match[j0] == 0:
                break
        while j0:
            match[j0] = match[way[j0]]
            j0 = way[j0]
    out = np.zeros(n, int)
    for j in range(1, m + 1):
        if match[j]:
            out[match[j] - 1] = j - 1
    return out


def match_tracks(pairs: DataFrame, value: str, least: float) -> DataFrame:
    """One-to-one pairs (obj_l, obj_r, value) of greatest total value; pairs below ``least`` don't count.

    The pairs that count fall into connected blocks of tracks, and the best assignment of all is the best of each block, so
    a group is a block.
    """
    good = checkpointed(pairs.where(F.col(value) >= least).select(F.col("obj_l").cast("bigint").alias("obj_l"), F.col("obj_r").cast("bigint").alias("obj_r"), F.col(value).cast("double").alias("value")))
    left = F.col("obj_l") * 2  # even nodes are tracks of the left side
    found = graph.components(good.select(left.alias("a"), (F.col("obj_r") * 2 + 1).alias("b")))
    blocks = good.withColumn("node", left).join(found, "node").select(F.col("root").alias("block"), "obj_l", "obj_r", "value")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = np.unique(pdf["obj_l"]), np.unique(pdf["obj_r"])
        w = np.zeros((len(left), len(right) + len(left)))  # a track may stay alone
        w[:, : len(right)] = -1e9
        w[np.searchsorted(left, pdf["obj_l"]), np.searchsorted(right, pdf["obj_r"])] = pdf["value"]
        j = assign(w)
        ok = np.flatnonzero(j < len(right))
        return pd.DataFrame({"obj_l": left[ok], "obj_r": right[j[ok]], "value": w[ok, j[ok]]})

    return blocks.groupBy("block").applyInPandas(run, "obj_l long, obj_r long, value double")
