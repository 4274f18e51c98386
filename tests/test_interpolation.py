"""The interpolation pass against a plain one on arrays: pieces, seeds, candidates, walk-back, bridges, layers and delta."""

import math
from collections import deque

import numpy as np
import pytest

from stratavox.operators import interpolation as ops
from stratavox.operators import kernels

MASK = "volume long, t long, y long, x long"
SHAPE = (16, 18, 20)
HOW = {"distance": 5, "angle": 25.0, "most": 2, "back": 2, "threshold": 1.2}


def flood(cells, reach):
    """Groups of cells that hang together, each named by its first."""
    left, out = set(cells), {}
    for c in sorted(cells):
        if c in left:
            todo = deque([c])
            left.discard(c)
            while todo:
                p = todo.popleft()
                out[p] = c
                for o in reach:
                    q = tuple(np.add(p, o))
                    if q in left:
                        left.discard(q)
                        todo.append(q)
    return out


AROUND = [tuple(np.subtract(o, 1)) for o in np.ndindex(3, 3, 3) if o != (1, 1, 1)]
FLAT = [o for o in AROUND if o[0] == 0]


def dist_to(cells, at):
    return math.sqrt(min((y - at[0]) ** 2 + (x - at[1]) ** 2 for y, x in cells))


def plain(cells):
    """Bridges (seed, direction, nth, back) -> (accepted, painted) and the delta with layers of one volume."""
    label, piece = flood(cells, AROUND), flood(cells, FLAT)
    of = {}
    for c, p in piece.items():
        of.setdefault(p, []).append(c)
    anchor = {}
    for p, mine in of.items():
        cy, cx = np.mean([c[1] for c in mine]), np.mean([c[2] for c in mine])
        anchor[p] = min((round((y - cy) ** 2 + (x - cx) ** 2, 9), y, x) for _, y, x in mine)[1:]
    bridges, slope = {}, math.tan(math.radians(HOW["angle"]))
    for p, mine in of.items():
        for way in (1, -1):
            if any((t + way, y + i, x + j) in cells for t, y, x in mine for i in (-1, 0, 1) for j in (-1, 0, 1)):
                continue
            flat = {(y, x) for _, y, x in mine}
            outline = {c for c in flat if any((c[0] + i, c[1] + j) not in flat for i, j in ((0, 1), (1, 0), (0, -1), (-1, 0)))}
            best = {}
            for step in range(1, HOW["distance"] + 1):
                for q in cells:
                    if q[0] == p[0] + way * step and label[q] != label[p] and (q[1:] in flat or dist_to(outline, q[1:]) <= slope * step + 1e-9):
                        d2 = (q[1] - anchor[p][0]) ** 2 + (q[2] - anchor[p][1]) ** 2
                        best[label[q]] = min(best.get(label[q], (99,)), (step, d2, q[1], q[2]))
            targets = sorted((v[0], v[1], lab, v[2], v[3]) for lab, v in best.items())[: HOW["most"]]
            behind, at, now = [(p, anchor[p])], anchor[p], p
            for _ in range(HOW["back"]):
                ahead = sorted({piece[c] for c in cells if c[0] == now[0] - way and label[c] == label[p]})
                if not ahead:
                    break
                wide = {(y + i, x + j) for _, y, x in of[now] for i in (-1, 0, 1) for j in (-1, 0, 1)}
                near = {q: min(((y - at[0]) ** 2 + (x - at[1]) ** 2, y, x) for _, y, x in of[q]) for q in ahead}
                now = max(ahead, key=lambda q: (sum(c[1:] in wide for c in of[q]), -near[q][0], len(of[q]), [-v for v in q]))
                at = near[now][1:]
                behind.append((now, at))
            for nth, (step, _, _, ty, tx) in enumerate(targets, 1):
                end = (p[0] + way * step, ty, tx)
                for back, (source, a) in enumerate(behind):
                    steps = abs(end[0] - source[0])
                    bridges[p, way, nth, back] = plain_bridge([c[1:] for c in of[source]], a, [c[1:] for c in of[piece[end]]], end[1:], source[0], way, steps)
    delta = {(*c, max(1, back), nth) for (_, _, nth, back), (ok, painted) in bridges.items() if ok for c in painted if c not in cells}
    return bridges, delta


def plain_bridge(source, a, target, b, s, way, steps):
    half = [max(max(abs(c[k] - a[k]) for c in source), max(abs(c[k] - b[k]) for c in target)) + 4 for k in (0, 1)]
    canvas = [(y, x) for y in range(-half[0], half[0] + 1) for x in range(-half[1], half[1] + 1)]

    def signed(cells, at):
        own = {(y - at[0], x - at[1]) for y, x in cells}
        rest = [c for c in canvas if c not in own]
        return {c: dist_to(rest, c) if c in own else -dist_to(own, c) for c in canvas}

    d0, d1 = signed(source, a), signed(target, b)
    radii, painted = [max(d0.values()), max(d1.values())], set()
    for k in range(1, steps):
        m = {(0, *c) for c in canvas if d0[c] * (steps - k) + d1[c] * k >= -1e-9}
        if not m:
            radii.append(0)
            continue
        name = flood(m, FLAT)
        centre = name[min(m, key=lambda c: (c[1] ** 2 + c[2] ** 2, c))]
        own = {c[1:] for c in m if name[c] == centre}
        back = flood({(0, y, x) for y in range(-half[0] - 1, half[0] + 2) for x in range(-half[1] - 1, half[1] + 2) if (y, x) not in own}, [(0, 0, 1), (0, 1, 0), (0, 0, -1), (0, -1, 0)])
        outside = back[0, -half[0] - 1, -half[1] - 1]
        own = [c for c in canvas if back.get((0, *c)) != outside]
        radii.append(max(dist_to([c for c in canvas if c not in set(own)], c) for c in own))
        off = [round(a[i] + k / steps * (b[i] - a[i])) for i in (0, 1)]
        painted |= {(s + way * k, y + off[0], x + off[1]) for y, x in own if 0 <= y + off[0] < SHAPE[1] and 0 <= x + off[1] < SHAPE[2]}
    return min(radii) > HOW["threshold"], painted


def volumes(seed):
    rng = np.random.default_rng(seed)
    t, y, x = np.indices(SHAPE)
    out = []
    for v in range(3):
        m = np.zeros(SHAPE, bool)
        for cy, cx, r in [(5, 6, 2.2), (12, 13, 3.1), (4, 15, 1.1)]:
            m |= (y - cy - np.sin(t / 3) * 1.5) ** 2 + (x - cx + v * t / 8) ** 2 <= r * r
        gap = rng.integers(4, 9)
        m[gap : gap + 3, :10] = False
        m[9:11, 9:] = False
        m &= rng.random(SHAPE) < 0.97
        out.append(m)
    return out


@pytest.mark.parametrize("seed", range(2))
def test_pass_equals_plain_pass(spark, seed):
    masks = volumes(seed)
    rows = [(v, *map(int, c)) for v, m in enumerate(masks) for c in np.argwhere(m)]
    delta, made = ops.interpolate(spark.createDataFrame(rows + rows[:4], MASK).repartition(5), SHAPE, **HOW)
    got = {tuple(r) for r in delta.collect()}
    deep, size = SHAPE[0] + 2, max(SHAPE[1:])
    code = lambda v, p: ((v * deep + p[0]) * size + p[1]) * size + p[2]
    want, accepted = set(), {}
    for v, m in enumerate(masks):
        bridges, new = plain({tuple(map(int, c)) for c in np.argwhere(m)})
        want |= {(v, *c) for c in new}
        accepted |= {(code(v, p), way, nth, back): ok for (p, way, nth, back), (ok, _) in bridges.items()}
    assert {(r.piece, r.direction, r.candidate, r.back): r.accepted for r in made.collect()} == accepted
    assert got == want and {True, False} == set(accepted.values())


def test_certificate_agrees_with_the_scan():
    rng = np.random.default_rng(0)
    disk = lambda r: np.argwhere(np.hypot(*np.indices((21, 21)) - 10) <= r)
    sure = 0
    for _ in range(60):
        a, b = disk(rng.uniform(1, 6)), disk(rng.uniform(1, 6))
        d0, d1 = ops.bridge_shapes(a, tuple(a[rng.integers(len(a))]), b, tuple(b[rng.integers(len(b))]))
        exact, _ = ops.least_radius(d0, d1, 5)
        for threshold in (0.5, 1.5, 2.5):
            bound, shapes = ops.least_radius(d0, d1, 5, threshold)
            assert (bound > threshold) == (exact > threshold) and (bound <= threshold or bound <= exact + 1e-9)
            sure += shapes is None and bound > threshold
    assert sure > 20


def test_passes_end_and_empty(spark):
    m = volumes(0)[0]
    frame = spark.createDataFrame([(0, *map(int, c)) for c in np.argwhere(m)], MASK)
    out = ops.interpolate_passes(frame, SHAPE, passes=3, **HOW)
    first = {tuple(r)[:4] for r in ops.interpolate(frame, SHAPE, **HOW)[0].collect()}
    by = {}
    for r in out.collect():
        by.setdefault(r["pass"], set()).add(tuple(r)[:4])
    assert by[1] == first and len(set().union(*by.values())) == sum(map(len, by.values()))
    assert ops.interpolate(frame.limit(0), SHAPE, **HOW)[0].collect() == []
    assert kernels.signed_distance(np.ones((1, 1), bool)).shape == (1, 1)


def test_touching_pieces_equal_plain_comparison(spark, monkeypatch):
    # slabs of three slices, so that pieces touch across their borders; seeds take the same pairs
    monkeypatch.setattr(ops, "SLAB", 3)
    rng = np.random.default_rng(8)
    m = rng.random((10, 9, 9)) < 0.25
    rows = ops.checkpointed(ops.pieces(spark.createDataFrame([(v, *map(int, c)) for v in range(2) for c in np.argwhere(m)], MASK), m.shape))
    cells = {(r.s, r.y, r.x): r.piece for r in rows.collect()}
    want = {}
    for (s, y, x), b in cells.items():
        for step in (1, -1):
            for a in {cells[p] for p in ((s - step, y + i, x + j) for i in (-1, 0, 1) for j in (-1, 0, 1)) if p in cells}:
                want[a, b, step] = want.get((a, b, step), 0) + 1
    assert {(r.a, r.b, r.step): r.overlap for r in ops.touching(rows).collect()} == want
    found = ops.anchors(rows)
    got = {(r.piece, r.direction) for r in ops.seeds(rows, found).collect()}
    assert got == {(p, d) for p in cells.values() for d in (1, -1)} - {(a, step) for a, _, step in want}
    assert ops.touching(rows.limit(0)).count() == 0
