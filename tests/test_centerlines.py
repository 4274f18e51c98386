"""Centre lines against plain versions: radii, tracks, branches, sections, events, protected pixels, floods and the filter."""

import heapq
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratavox.operators import centerlines as ops
from stratavox.operators import kernels

MASK = "volume long, t long, y long, x long"


def solid(seed, shape=(14, 12, 13)):
    """A blob of balls strung along a line, in an array."""
    rng = np.random.default_rng(seed)
    grid = np.indices(shape).transpose(1, 2, 3, 0)
    out = np.zeros(shape, bool)
    a, b = rng.uniform(2, 9, (2, 3))
    for s in np.linspace(0, 1, 12):
        out |= ((grid - (a + s * (b - a) + rng.normal(0, 0.4, 3))) ** 2).sum(-1) <= rng.uniform(1.5, 4) ** 2
    return out


def rows_of(masks):
    return [(v, *map(int, c)) for v, m in enumerate(masks) for c in np.argwhere(m)]


def plain_d2(m):
    back = np.argwhere(~m)
    return {tuple(map(int, c)): int(((back - c) ** 2).sum(1).min()) for c in np.argwhere(m)}


def plain_ridge(m):
    d2 = plain_d2(m)
    best = {}
    for c, d in d2.items():
        around = [tuple(np.add(c, o)) for o in np.ndindex(3, 3, 3) for o in [np.subtract(o, 1)] if (o == 0).any()]
        if all(d2.get(q, 0) <= d for q in around):
            best[c] = max(0.5, math.sqrt(d) - 0.5)
    thick = {c: r for c, r in best.items() if r >= 1.25}
    return thick if len(thick) >= 3 else best


def plain_peaks(ridge):
    out = defaultdict(list)
    for axis in range(3):
        others = [d for d in range(3) if d != axis]
        for plane in sorted({c[axis] for c in ridge}):
            kept = []
            for row, col, r in sorted(((c[others[0]], c[others[1]], r) for c, r in ridge.items() if c[axis] == plane), key=lambda p: (-p[2], p[0], p[1])):
                if all((row - a) ** 2 + (col - b) ** 2 > max(0.75, 0.4 * w) ** 2 for a, b, w in kept):
                    kept.append((row, col, r))
            out[axis, plane] = kept
    return out


def plain_tracks(m, peaks, axis):
    put = lambda plane, row, col: [(plane, row, col), (row, plane, col), (row, col, plane)][axis]
    tracks, last = [], []
    for plane in range(m.shape[axis]):
        used = set()
        open_ = [k for k, p in enumerate(last) if 0 < plane - p <= 2]
        for row, col, r in sorted(peaks.get((axis, plane), []), key=lambda p: (-p[2], p[0], p[1])):
            best, score_of_best = None, math.inf
            for k in open_:
                if k in used:
                    continue
                p0, row0, col0, r0 = tracks[k][-1]
                gap = plane - p0
                score = math.hypot(row - row0, col - col0) / max(2.5 * gap, 0.85 * (r + r0) * math.sqrt(gap))
                if score > 1 or max(r, r0) / min(r, r0) > 5 or score >= score_of_best:
                    continue
                a, b = np.array(put(p0, row0, col0), float), np.array(put(plane, row, col), float)
                way = a + np.linspace(0, 1, max(2, math.ceil(np.linalg.norm(b - a) / 0.5) + 1))[:, None] * (b - a)
                if all(m[tuple(c)] for c in np.rint(way).astype(int)):
                    best, score_of_best = k, score
            if best is None:
                tracks.append([(plane, row, col, r)])
                last.append(plane)
                used.add(len(tracks) - 1)
            else:
                tracks[best].append((plane, row, col, r))
                last[best] = plane
                used.add(best)
    return [t for t in tracks if len(t) >= 3]


@pytest.fixture(scope="module")
def case(spark):
    masks = [solid(s) for s in range(4)]
    masks[3][:, :, 6:] = False
    rows = rows_of(masks)
    frame = ops.checkpointed(spark.createDataFrame(rows + rows[:5], MASK).repartition(4))
    return masks, frame


def test_radii_ridges_and_peaks(case):
    masks, frame = case
    shape = masks[0].shape
    deep = ops.checkpointed(ops.radii(frame, shape))
    assert {tuple(r) for r in deep.collect()} == {(v, *c, d) for v, m in enumerate(masks) for c, d in plain_d2(m).items()}
    ridge = ops.checkpointed(ops.ridges(deep))
    assert {(r.volume, r.t, r.y, r.x, round(r.r, 9)) for r in ridge.collect()} == {(v, *c, round(r, 9)) for v, m in enumerate(masks) for c, r in plain_ridge(m).items()}
    got = {(r.volume, r.axis, r.plane, r.row, r.col) for r in ops.plane_peaks(ridge).collect()}
    assert got == {(v, axis, plane, row, col) for v, m in enumerate(masks) for (axis, plane), kept in plain_peaks(plain_ridge(m)).items() for row, col, _ in kept}


def test_tracks_equal_plain_linking(spark):
    # every voxel of a noisy mask is a peak of some radius, so that tracks compete, cross and leave out planes
    rng = np.random.default_rng(5)
    masks = [np.ones((9, 8, 7), bool) for _ in range(3)]
    for m in masks:
        m[tuple(rng.integers(0, n, 60) for n in m.shape)] = False
    peaks, rows = {}, []
    for v, m in enumerate(masks):
        here = defaultdict(list)
        for axis in range(3):
            others = [d for d in range(3) if d != axis]
            for c in np.argwhere(m):
                if rng.random() < 0.12:
                    p = (int(c[others[0]]), int(c[others[1]]), float(rng.choice([0.5, 1.0, 2.5, 6.0])))
                    here[axis, int(c[axis])].append(p)
                    rows.append((v, axis, int(c[axis]), *p))
        peaks[v] = here
    frame = spark.createDataFrame(rows, "volume long, axis int, plane long, row long, col long, r double").repartition(5)
    mask = spark.createDataFrame(rows_of(masks), MASK)
    got = defaultdict(list)
    for r in ops.tracks(ops.links(frame, mask)).collect():
        got[r.volume, r.axis, r.plane0, r.row0, r.col0].append((r.arc, r.plane, r.row, r.col, r.r))
    want = {(v, axis, *t[0][:3]): [(k, *p) for k, p in enumerate(t)] for v, m in enumerate(masks) for axis in range(3) for t in plain_tracks(m, peaks[v], axis)}
    assert {k: sorted(t) for k, t in got.items()} == want and len(want) > 40


def test_branches_equal_plain_choice(spark, case):
    masks, frame = case
    peaks = ops.checkpointed(ops.plane_peaks(ops.ridges(ops.radii(frame, masks[0].shape))))
    found = ops.checkpointed(ops.tracks(ops.links(peaks, frame)))
    want = set()
    for v, m in enumerate(masks):
        plain = plain_peaks(plain_ridge(m))
        long = []
        for axis in range(3):
            for t in plain_tracks(m, plain, axis):
                at = [[(p, a, b), (a, p, b), (a, b, p)][axis] for p, a, b, _ in t]
                path = sum(math.dist(a, b) for a, b in zip(at, at[1:]))
                mid = float(np.median([p[3] for p in t]))
                if path >= max(2, 3 * mid):
                    long.append((-round(path / mid, 9), -round(path, 9), -max(p[3] for p in t), at[0], at, [p[3] for p in t]))
        covered = set()
        for *_, at, r in sorted(long, key=lambda x: x[:4]):
            if sum(c not in covered for c in set(at)) >= 0.5 * len(set(at)):
                covered |= {tuple(np.add(c, np.subtract(o, 1))) for c in at for o in np.ndindex(3, 3, 3)}
                for k, c in enumerate(at):
                    tangent = np.subtract(at[min(k + 1, len(at) - 1)], at[max(k - 1, 0)])
                    want.add((v, k, *c, *map(int, tangent)))
    got = {(r.volume, r.arc, r.t, r.y, r.x, r.dt, r.dy, r.dx) for r in ops.branches(found).collect()}
    assert got == want and want


def tube(arm=(), bit=(), shape=(40, 24, 30)):
    m = np.zeros(shape, bool)
    t, y, x = np.indices(shape)
    m |= (y - 11) ** 2 + (x - 7) ** 2 <= 9
    for t0, t1, y0, y1, x0, x1 in [*arm, *bit]:
        m[t0:t1, y0:y1, x0:x1] = True
    return m


def near_of(m):
    return ops.Near(np.argwhere(m), m.shape)


def test_states_of_sections():
    m = tube(arm=[(18, 22, 10, 13, 10, 17)])
    at = lambda t, tangent=(1, 0, 0), r=3.0, mask=m, cap=ops.HALF: ops.section(np.array([t, 11.0, 7.0]), np.array(tangent, float), r, 2.0, near_of(mask), cap)
    assert at(5)[0] == "clean" and len(at(5)[1]) == 0
    state, voxels = at(20)
    assert state == "anomaly" and all(m[tuple(v)] and v[0] == 20 and math.hypot(v[1] - 11, v[2] - 7) >= 3.2 for v in voxels)
    assert at(20, tangent=(0, 0, 0))[0] == "unknown" and at(5, r=0.4)[0] == "unknown"
    assert at(5, r=6.0)[0] == "unknown"  # the circle leaves the box
    # a way round a corner: no straight line, but the component reaches the circle
    bent = tube(arm=[(18, 22, 11, 12, 10, 12), (18, 22, 5, 12, 11, 12)])
    bent[18:22, 12:15, 9:13] = False
    state, voxels = at(20, mask=bent)
    assert state == "anomaly" and len(voxels)
    assert at(20, mask=bent, cap=5)[0] == "unknown"  # too wide to be looked at, and no straight way
    # something on the circle that does not hang together with the centre
    apart = tube(bit=[(18, 22, 10, 13, 12, 15)])
    assert at(20, r=2.6, mask=apart)[0] == "clean" and at(20, mask=apart)[0] == "unknown"  # the wider plane leaves the box
    # a centre beside the mask moves onto it; far away there is none
    assert ops.section(np.array([5.0, 11.0, 11.6]), np.array([1.0, 0, 0]), 3.0, 2.0, near_of(m))[0] != "unknown"
    assert ops.section(np.array([5.0, 20.0, 27.0]), np.array([1.0, 0, 0]), 3.0, 2.0, near_of(m))[0] == "unknown"
    assert ops.bounded(np.arange(10), 3).tolist() == [0, 4, 9] and ops.bounded(np.arange(2), 3).tolist() == [0, 1]


def test_sections_fetch_all_they_need(spark):
    rng = np.random.default_rng(2)
    masks = [tube(arm=[(18, 22, 10, 13, 10, 17)]), rng.random((40, 24, 30)) < 0.6]
    samples = [(v, b, k, float(rng.uniform(0, 39)), float(rng.uniform(0, 23)), float(rng.uniform(0, 29)), float(rng.choice([0.3, 1.0, 3.0, 7.0])), *rng.normal(0, 1, 3).tolist()) for v in (0, 1) for b in (0, 1) for k in range(25)]
    frame = spark.createDataFrame(samples, "volume long, branch long, arc long, t double, y double, x double, r double, dt double, dy double, dx double")
    got = {(r.volume, r.branch, r.arc): (r.state, [tuple(e) for e in r.evidence]) for r in ops.sections(frame, spark.createDataFrame(rows_of(masks), MASK), masks[0].shape, 1.7, most=40).collect()}
    near = [near_of(m) for m in masks]
    for v, b, k, t, y, x, r, *tangent in samples:
        state, voxels = ops.section(np.array([t, y, x]), np.array(tangent), r, 1.7, near[v])
        assert got[v, b, k] == (state, [tuple(map(int, e)) for e in ops.bounded(voxels, 40)])
    assert {s for s, _ in got.values()} == {"clean", "anomaly", "unknown"}


def test_events_equal_plain_scan(spark):
    rng = random.Random(8)
    rows = [(v, b, 3 * k + 1, rng.choices(["clean", "anomaly", "unknown"], [5, 6, 1])[0]) for v in range(3) for b in range(20) for k in range(rng.randint(1, 60))]
    got = {(r.volume, r.branch, r.arc0, r.arc1, r.n, r.clean_left, r.clean_right) for r in ops.anomaly_events(spark.createDataFrame(rows, "volume long, branch long, arc long, state string").repartition(4)).collect()}
    want = set()
    for v in range(3):
        for b in range(20):
            mine = sorted((a, s) for w, c, a, s in rows if (w, c) == (v, b))
            states = [s for _, s in mine]
            closed = [s == "anomaly" for s in states]
            k = 0
            while k < len(states):
                if closed[k]:
                    k += 1
                    continue
                e = k
                while e < len(states) and not closed[e]:
                    e += 1
                if 0 < k and e < len(states) and e - k <= 2 and all(s == "clean" for s in states[k:e]):
                    closed[k:e] = [True] * (e - k)
                k = e
            k = 0
            while k < len(states):
                e = k
                while e < len(states) and closed[e]:
                    e += 1
                n = states[k:e].count("anomaly")
                if n >= 3:
                    left = k >= 3 and all(s == "clean" for s in states[k - 3 : k])
                    right = e + 3 <= len(states) and all(s == "clean" for s in states[e : e + 3])
                    want.add((v, b, mine[k][0], mine[e - 1][0], n, left, right))
                k = max(e, k + 1)
    assert got == want and {w[5] for w in want} == {True, False}


def test_protected_pixels_equal_plain_search(spark):
    m = tube(arm=[(18, 22, 10, 13, 10, 17)])
    m[:, 11, 5:8] = False
    m[30:34] = False
    rng = random.Random(3)
    samples = [(0, b, k, t + rng.random(), 11 + rng.random() * 3, 7 + rng.random() * 2, rng.choice([0.6, 2.0, 3.4])) for b in range(3) for k, t in enumerate(sorted(rng.sample(range(38), 9)))]
    got = {(r.t, r.y, r.x): r.r for r in ops.protected_seeds(spark.createDataFrame(samples, "volume long, branch long, arc long, t double, y double, x double, r double"), spark.createDataFrame(rows_of([m]), MASK)).collect()}
    want = {}
    near = near_of(m)
    for b in range(3):
        line = [s[3:] for s in samples if s[1] == b]
        for p, q in zip(line, line[1:] + line[-1:]):
            p, q = np.array(p), np.array(q)
            gap = math.sqrt(((q - p)[:3] ** 2).sum())
            n = 1 if gap > max(32, 10 * max(p[3], q[3], 1)) else max(1, math.ceil(gap / 0.5))
            for i in range(n + 1):
                s = p + i / n * (q - p)
                on = near.snapped(s[:3], s[3])
                if on is None:
                    continue
                w = max(1.0, s[3])
                t0, y0, x0 = map(int, on)
                for t in range(t0 - min(8, math.ceil(w)), t0 + min(8, math.ceil(w)) + 1):
                    flat = math.sqrt(max(0.0, w * w - (t - t0) ** 2))
                    if not 0 <= t < m.shape[0] or flat < 0.5:
                        continue
                    reach = 0 if m[t, y0, x0] else min(12, max(1, math.ceil(flat)))
                    near_by = [((y - y0) ** 2 + (x - x0) ** 2, y, x) for y, x in np.argwhere(m[t]).tolist() if abs(y - y0) <= reach and abs(x - x0) <= reach]
                    if near_by and min(near_by)[0] <= flat * flat:
                        c = (t, *min(near_by)[1:])
                        want[c] = max(want.get(c, 0), s[3])
    assert got.keys() == want.keys() and all(abs(got[c] - want[c]) < 1e-9 for c in want) and len(want) > 50


@pytest.mark.parametrize("tile", [128, 4])
def test_basins_equal_a_flood_from_a_heap(spark, monkeypatch, tile):
    monkeypatch.setattr(ops, "TILE", tile)
    rng = np.random.default_rng(tile)
    rows, marks, want = [], [], set()
    for s in range(6):
        m = rng.random((13, 15)) < 0.75
        level = rng.integers(0, 6, m.shape)
        at = [tuple(map(int, c)) for c in np.argwhere(m)]
        rows += [(s, *c, int(level[c])) for c in at]
        seeds = {c: int(rng.integers(1, 3)) for c in (at[k] for k in rng.choice(len(at), 5, replace=False))} if s else {}
        marks += [(s, *c, v) for c, v in seeds.items()] + [(s, 99, 99, 1)]
        beside = lambda c: [q for i in (-1, 0, 1) for j in (-1, 0, 1) if (q := (c[0] + i, c[1] + j)) != c and 0 <= q[0] < 13 and 0 <= q[1] < 15 and m[q]]  # noqa: E731, B023
        flat, heap = {}, [(int(level[c]), c) for c in seeds]
        while heap:
            v, c = heapq.heappop(heap)
            if c not in flat:
                flat[c] = v
                for q in beside(c):
                    heapq.heappush(heap, (max(v, int(level[q])), q))
        label, heap = {}, [(0, v, c) for c, v in seeds.items()]
        heapq.heapify(heap)
        while heap:
            n, v, c = heapq.heappop(heap)
            if c not in label:
                label[c] = v
                for q in beside(c):
                    if flat[q] == max(flat[c], int(level[q])):
                        heapq.heappush(heap, (n + 1, v, q))
        want |= {(s, *c, int(level[c]), flat.get(c), label.get(c)) for c in at}
    got = {(r.slice, r.y, r.x, r.level, r.flat, r.label) for r in ops.basins(spark.createDataFrame(rows, "slice long, y long, x long, level long").repartition(3), spark.createDataFrame(marks, "slice long, y long, x long, label int")).collect()}
    assert got == want and {None, 1, 2} == {w[5] for w in want}


def test_filter_removes_what_hangs_on_and_keeps_the_tube(spark):
    # an arm over four slices joins a plate to the tube; where the arm is not, the plate is a component of its own
    plate = [(16, 24, 8, 15, 14, 22)]
    m = tube(arm=[(18, 22, 9, 14, 10, 15)], bit=plate)
    clean = tube()
    frame = spark.createDataFrame(rows_of([m, clean]), MASK)
    kept, audit = ops.filter_center_lines(frame, m.shape, factor=2.0, context=1, passes=2)
    kept = {tuple(r) for r in kept.collect()}
    audit = [tuple(r) for r in audit.collect()]
    removed = {r[2:] for r in audit if r[1] == "removed"}
    whole = set(rows_of([m, clean]))
    assert kept == whole - removed and kept.isdisjoint(removed)
    assert all(v == 0 for v, *_ in removed)  # the clean tube loses nothing
    assert {(0, *map(int, c)) for c in np.argwhere(clean)} <= kept  # nor does the tube itself
    doubtful = {r[2:] for r in audit if r[1] == "candidate"}
    assert doubtful and all(v == 0 and 16 <= t < 24 for v, t, _, _ in doubtful) and not doubtful & {(0, *map(int, c)) for c in np.argwhere(clean) if abs(c[1] - 11) + abs(c[2] - 7) <= 1}


def test_components_are_judged_by_every_guard(spark):
    m = np.zeros((20, 40, 40), bool)
    m[8:12, 4:12, 4:12] = True  # goes: large, covered, alone
    m[8:12, 4:12, 20:28] = True  # stays: a seed lies in it
    m[7:12, 20:28, 4:12] = True  # stays: goes on beside its event
    m[8:12, 30:34, 30:34] = True  # stays: too small
    m[8:12, 20:36, 18:24] = True  # stays: hardly covered
    ev = [(0, e, t, y, x) for e, (y0, y1, x0, x1) in enumerate([(4, 12, 4, 12), (4, 12, 20, 28), (20, 28, 4, 12), (30, 34, 30, 34), (20, 22, 18, 20)]) for t in range(8, 12) for y in range(y0, y1, 2) for x in range(x0, x1, 2)]
    seeds = spark.createDataFrame([(0, t, 8, 24, 2.0) for t in range(8, 12)], "volume long, t long, y long, x long, r double")
    found, pixels = ops.judged_components(spark.createDataFrame(rows_of([m]), MASK), spark.createDataFrame(ev, "volume long, event long, t long, y long, x long"), seeds, m.shape, 1)
    place = {r.root: (r.y, r.x) for r in pixels.groupBy("root").agg(F.min("y").alias("y"), F.min("x").alias("x")).collect()}
    judged = {(place[r.root], r.t): (r.protected, r.flanks_clear, r.removable) for r in found.collect()}
    for t in range(8, 12):
        assert judged[(4, 4), t] == (False, True, True)
        assert judged[(4, 20), t] == (True, True, False)
        assert judged[(20, 4), t] == (False, False, False)
        assert judged[(30, 30), t] == (False, True, False) and judged[(20, 18), t] == (False, True, False)
    edge = ops.judged_components(spark.createDataFrame(rows_of([m]), MASK), spark.createDataFrame(ev, "volume long, event long, t long, y long, x long"), seeds, m.shape, 9)[0]
    assert not edge.where("removable").count()  # slices that the box does not have prove nothing


def test_empty_masks(spark):
    none = spark.createDataFrame([], MASK)
    kept, audit = ops.filter_center_lines(none, (5, 6, 7))
    assert kept.collect() == audit.collect() == []
    full = spark.createDataFrame(rows_of([np.ones((3, 4, 5), bool)]), MASK)
    assert ops.center_lines(full, (3, 4, 5)).count() >= 0  # no background at all: every radius is the same large number
    assert kernels.squared_distance(np.zeros((2, 2), bool)).min() > 8


def test_medial_equals_ridges_over_squares_of_lines(case, monkeypatch):
    masks, frame = case
    monkeypatch.setattr(ops, "LINES", 100)  # squares of eight lines, slices in groups of one
    got = {tuple(r) for r in ops.medial(frame, masks[0].shape).collect()}
    assert {(v, t, y, x, round(r, 9)) for v, t, y, x, r in got} == {(v, *c, round(r, 9)) for v, m in enumerate(masks) for c, r in plain_ridge(m).items()}
    assert ops.medial(frame.limit(0), masks[0].shape).count() == 0


def test_links_of_a_slab_need_no_graph(spark, monkeypatch):
    from stratavox.operators import graph

    given = []
    whole = graph.components
    monkeypatch.setattr(graph, "components", lambda edges, *a: (given.append(edges.count()), whole(edges, *a))[1])
    deep = 150
    mask = spark.createDataFrame([(0, t, 5, x) for t in range(deep) for x in (5, 6, 130)], MASK)
    peaks = spark.createDataFrame([(0, 0, t, 5, x, 1.0) for t in range(deep) for x in (5, 130) if (t, x) != (70, 130)], "volume long, axis int, plane long, row long, col long, r double")
    found = ops.tracks(ops.links(peaks, mask))
    assert {(r.plane0, r.col0): r.n for r in found.groupBy("plane0", "col0").agg(F.count("*").alias("n")).collect()} == {(0, 5): deep, (0, 130): deep - 1}
    # two lines, each over three slabs of planes
    assert sum(given) <= 2 * 2 * 6
