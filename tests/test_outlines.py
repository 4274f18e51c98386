"""Outlines of components against filled masks."""

import math
import random

import numpy as np

from stratavox.operators import masks, polygons


def inside(ring, y, x):
    odd = False
    for (ay, ax), (by, bx) in zip(ring, ring[1:] + ring[:1]):
        if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
            odd = not odd
    return odd


def filled(m):
    """A component with its holes: all that 4-connected background does not reach from outside."""
    big = np.pad(m, 1)
    out, todo = {(0, 0)}, [(0, 0)]
    while todo:
        y, x = todo.pop()
        for q in ((y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)):
            if 0 <= q[0] < big.shape[0] and 0 <= q[1] < big.shape[1] and not big[q] and q not in out:
                out.add(q)
                todo.append(q)
    return {(y, x) for y, x in np.ndindex(m.shape) if (y + 1, x + 1) not in out}


def parts(m):
    left = set(map(tuple, np.argwhere(m).tolist()))
    while left:
        todo, own = [min(left)], {min(left)}
        left -= own
        while todo:
            y, x = todo.pop()
            near = {(y + i, x + j) for i in (-1, 0, 1) for j in (-1, 0, 1)} & left
            left -= near
            own |= near
            todo += near
        yield own


def test_borders_enclose_their_components():
    rng = np.random.default_rng(1)
    n = 0
    for _ in range(150):
        m = rng.random((rng.integers(1, 9), rng.integers(1, 9))) < rng.choice([0.3, 0.6, 0.85])
        for own in parts(m):
            ring = polygons.border(own)
            one = np.zeros(m.shape, bool)
            one[tuple(np.array(sorted(own)).T)] = True
            assert set(ring) <= own and ring[0] == min(own)
            assert all(max(abs(a - c), abs(b - d)) <= 1 for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1]))
            assert set(ring) | {c for c in np.ndindex(m.shape) if inside(ring, *c)} == filled(one)
            straight = polygons.simplified(ring, 0.0)
            assert set(straight) | {c for c in np.ndindex(m.shape) if inside(straight, *c)} <= filled(one)
            kept = polygons.simplified(ring, 1.0)
            segment = lambda p, a, b: polygons._far([a, p, b], 0, 2)[0]
            assert all(min(segment(p, a, b) for a, b in zip(kept, kept[1:] + kept[:1])) <= 1 + 1e-9 for p in ring)
            n += len(kept) < len(ring)
    assert n > 60


def test_outlines_of_all_slices(spark):
    rng = random.Random(4)
    rows = [(t, y, x) for t in range(6) for y in range(9) for x in range(9) if rng.random() < 0.55]
    mask = spark.createDataFrame(rows, "t long, y long, x long")
    got = {(r.t, min((int(p.y), int(p.x)) for p in r.points)): [(p.y, p.x) for p in r.points] for r in polygons.outlines(masks.components(mask, 8, 9), 1.0).collect()}
    want = {}
    for t in range(6):
        m = np.zeros((9, 9), bool)
        for s, y, x in rows:
            m[y, x] |= s == t
        for own in parts(m):
            ring = polygons.simplified(polygons.border(own), 1.0)
            if len(ring) >= 3:
                want[t, min(ring)] = ring
    assert got == want and want
    assert math.isclose(polygons._far([(0, 0), (3, 4), (0, 8)], 0, 2)[0], 3.0)
