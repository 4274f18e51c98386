"""Sampling plans with their known figures, projections as round trips, and run-based topology against brute force."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratavox.operators import geometry, kernels, ledgers, masks, views


def test_spherical_plan_of_the_reference_workload(spark):
    rows = spark.createDataFrame([(3072 / (4 * math.pi), 1535.5, 3072), (5.0, 5.0, 64), (1.0, 3.0, 1)], "minimum double, maximum double, patch long")
    big, flat, small = views.spherical_plan(rows).collect()
    assert (big.dense_frames, big.frames, big.intervals, big.patches, big.shells, big.optimised) == (31032, 6402, 3070, 1, 1067, True)
    gap = (1535.5 - 3072 / (4 * math.pi)) / 1066
    assert gap > 1 and (gap / 2) ** 2 + 2 * (1535.5 / 3070) ** 2 <= views.SPHERE_BUDGET
    assert flat.frames <= flat.dense_frames and small.frames <= small.dense_frames


def test_radial_gap_spends_the_budget(spark):
    rows = spark.createDataFrame([(float(r),) for r in (0.5, 1, 10, 1e6)], "r double")
    for r in rows.select(views.radial_error(views.certified_radial_gap(F.col("r")), F.col("r")).alias("e")).collect():
        assert abs(r.e - views.BUDGET) < 1e-9


def test_cube_coordinates_round_trip(spark):
    grid = spark.range(6 * 21 * 21).select(F.floor(F.col("id") / 441).alias("face"), ((F.floor(F.col("id") / 21) % 21) / 10.0 - 1).alias("u0"), ((F.col("id") % 21) / 10.0 - 1).alias("v0"))
    rows = views.cube_direction(grid, "face", "u0", "v0").withColumnRenamed("face", "f0")
    got = views.face_members(rows, "dx", "dy", "dz").where("face = f0").collect()
    assert len(got) == 6 * 441  # closed faces hold their edges and corners
    assert max(max(abs(r.u - r.u0), abs(r.v - r.v0), abs(math.hypot(r.dx, r.dy, r.dz) - 1)) for r in got) < 1e-7


def test_tilted_frames_without_a_tilt_are_slices(spark):
    grays = spark.range(4 * 9).select(F.lit(0).cast("long").alias("volume"), F.floor(F.col("id") / 9).alias("t"), F.floor(F.col("id") % 9 / 3).alias("y"), (F.col("id") % 3).alias("x"), (F.col("id") * 7 % 256).alias("g"))
    got = views.tilted_frames(grays, (4, 3, 3), 0.0).withColumnRenamed("frame", "t")
    assert sorted(map(tuple, got.select("t", "y", "x", "g").collect())) == sorted(map(tuple, grays.select("t", "y", "x", "g").collect()))


def brute_components(cells, connectivity):
    near = masks.offsets(connectivity)
    near += [tuple(-v for v in o) for o in near]
    root, left = {}, set(cells)
    while left:
        start = min(left)
        todo, seen = [start], {start}
        while todo:
            c = todo.pop()
            for o in near:
                n = tuple(a + b for a, b in zip(c, o))
                if n in left and n not in seen:
                    seen.add(n)
                    todo.append(n)
        left -= seen
        root |= {c: start for c in seen}
    return root


@pytest.mark.parametrize("connectivity", [4, 8, 6, 18, 26])
def test_run_components_across_slabs(spark, connectivity):
    rng = np.random.default_rng(connectivity)
    cells = [tuple(map(int, c)) for c in np.argwhere(rng.random((9, 7, 6)) < 0.35)]
    mask = spark.createDataFrame(cells + cells[:5], "t long, y long, x long")
    expected = brute_components(cells, connectivity)
    for slab in (1, 2, 16):
        runs = masks.label_runs(masks.row_runs(mask), connectivity, 7, slab)
        got = {(r.t, r.y, x): r.root for r in runs.collect() for x in range(r.x0, r.x1)}
        assert got == {c: (s[0] * 7 + s[1]) * 7 + s[2] for c, s in expected.items()}
    assert masks.components(mask.limit(0), connectivity, 7).count() == 0


def test_voids_against_flood(spark):
    rng = np.random.default_rng(3)
    solid = rng.random((6, 7, 7)) < 0.62
    mask = spark.createDataFrame([tuple(map(int, c)) for c in np.argwhere(solid)], "t long, y long, x long")
    for connectivity in (6, 18, 26):
        back = [tuple(map(int, c)) for c in np.argwhere(~solid)]
        root = brute_components(back, connectivity)
        open_ = {root[c] for c in back if c[0] in (0, 5) or c[1] in (0, 6) or c[2] in (0, 6)}
        assert {tuple(r) for r in masks.voids(mask, connectivity, 7).collect()} == {c for c in back if root[c] not in open_}
    assert masks.voids(mask.limit(0), 6, 7).count() == masks.holes(mask.limit(0), 7).count() == 0


def test_squared_distance_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(100):
        m = rng.random((rng.integers(1, 12), rng.integers(1, 15))) < rng.choice([0, 0.05, 0.3, 1])
        y, x = np.nonzero(m)
        yy, xx = np.mgrid[: m.shape[0], : m.shape[1]]
        far = 4 * sum(m.shape) ** 2
        assert np.array_equal(kernels.squared_distance(m), ((yy[..., None] - y) ** 2 + (xx[..., None] - x) ** 2).min(-1, initial=far))


def test_gaussian_in_three_axes(spark):
    rng = np.random.default_rng(1)
    solid = rng.random((5, 6, 6)) < 0.6
    mask = spark.createDataFrame([tuple(map(int, c)) for c in np.argwhere(solid)], "t long, y long, x long")
    taps = geometry.gaussian_taps(0.8)
    r = len(taps) // 2
    value = np.zeros(solid.shape)
    for t, y, x in itertools.product(*map(range, solid.shape)):
        for (i, a), (j, b), (k, c) in itertools.product(enumerate(taps), repeat=3):
            p = (t + i - r, y + j - r, x + k - r)
            if all(0 <= v < n for v, n in zip(p, solid.shape)):
                value[t, y, x] += a * b * c * solid[p]
    got = {tuple(row) for row in geometry.smooth(mask, 0.8, 6, 5).collect()}
    assert got == {tuple(map(int, c)) for c in np.argwhere(np.round(value, 9) >= 0.5)}


def test_dihedral_gives_eight_views(spark):
    rows = [(k, y, x) for k in range(8) for y, x in ((0, 1), (2, 2), (0, 0))]
    got = ledgers.dihedral(spark.createDataFrame(rows, "k long, y long, x long"), 3, F.col("k")).collect()
    assert len({frozenset((r.y, r.x) for r in got if r.k == k) for k in range(8)}) == 8
    assert all(0 <= r.y < 3 and 0 <= r.x < 3 for r in got) and {(r.y, r.x) for r in got if r.k == 0} == {(0, 1), (2, 2), (0, 0)}


def dense_sphere(frames, size, radii, intervals, rotation):
    """Every voxel of the volume, each on all faces that hold it."""
    grid = views._pixels(frames.sparkSession, t=size[0], y=size[1], x=size[2])
    off = {c: F.col(c) - (n - 1) / 2 for c, n in zip("tyx", size)}
    world = (off["x"], off["y"], off["t"])
    rows = grid.withColumn("r", F.sqrt(sum(w * w for w in world))).where(F.col("r").between(radii[0] - 1e-9, radii[-1] + 1e-9))
    rows = rows.withColumns({f"__{c}": F.round(sum(rotation[k][j] * world[k] for k in range(3)), 12) for j, c in enumerate("xyz")})
    rows = views._settled(views.face_members(views._settled(rows), "__x", "__y", "__z"))
    far = F.array(*(F.struct(F.round(F.abs(F.col("r") - v), 9).alias("d"), F.lit(k).alias("k")) for k, v in enumerate(radii)))
    place = lambda c: F.rint(F.round((c + 1) * intervals / 2, 9)).cast("bigint")
    rows = rows.select("t", "y", "x", F.col("face").cast("bigint").alias("face"), F.array_min(far)["k"].cast("bigint").alias("shell"), place(-F.col("v")).alias("row"), place(F.col("u")).alias("col"))
    return frames.join(rows, ["face", "shell", "row", "col"]).select("volume", "t", "y", "x").distinct()


def test_spherical_projection_follows_set_pixels(spark):
    rng = np.random.default_rng(3)
    size = (14, 17, 15)
    for k in range(4):
        q, _ = np.linalg.qr(rng.normal(size=(3, 3)))
        rotation = (q * np.sign(np.linalg.det(q))).tolist() if k else np.eye(3).tolist()
        radii = sorted(rng.uniform(0.8, 8.5, 5).tolist()) if k % 2 else [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
        n = int(rng.choice([6, 10, 24]))
        share = 1.0 if k == 0 else 0.2
        rows = [(int(rng.integers(2)), f, s, r, c) for f in range(6) for s in range(len(radii)) for r in range(n + 1) for c in range(n + 1) if rng.random() < share]
        frames = spark.createDataFrame(rows, "volume long, face long, shell long, row long, col long")
        got = {tuple(r) for r in views.spherical_project(frames, size, radii, n, rotation).collect()}
        want = {tuple(r) for r in dense_sphere(frames, size, radii, n, rotation).collect()}
        assert got == want and want
        # no voxel that a face shows lies outside its box, and the boxes are no larger than the volume asks for
        box = {r.face: r for r in views.output_bounds(frames, size, radii, rotation).collect()}
        for face in range(6):
            b = box[face]
            own = dense_sphere(frames.where(F.col("face") == face), size, radii, n, rotation).collect()
            assert all(b.t0 <= r.t < b.t1 and b.y0 <= r.y < b.y1 and b.x0 <= r.x < b.x1 for r in own)
            assert (b.t1 - b.t0) * (b.y1 - b.y0) * (b.x1 - b.x0) < 0.9 * math.prod(size)
    assert views.spherical_project(frames.limit(0), size, radii, n, rotation).collect() == []


def test_radial_projection_follows_set_arcs(spark):
    rng = np.random.default_rng(5)
    size = (5, 21, 19)
    for radii in ([1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0], [0.7, 2.9, 3.1, 6.5, 9.2]):
        rows = [(int(rng.integers(2)), s, int(rng.integers(5)), a) for s, r in enumerate(radii) for a in range(math.ceil(2 * math.pi * r)) for _ in range(2) if rng.random() < 0.5]
        frames = spark.createDataFrame(rows, "volume long, shell long, height long, arc long")
        got = {tuple(r) for r in views.radial_project(frames, size, radii).collect()}
        have, want = {}, set()
        for v, s, h, a in rows:
            have.setdefault((s, a), set()).add((v, h))
        for y in range(size[1]):
            for x in range(size[2]):
                dy, dx = y - 10.0, x - 9.0
                r = math.hypot(dy, dx)
                if radii[0] - 1e-9 <= r <= radii[-1] + 1e-9:
                    s = min(range(len(radii)), key=lambda k: (round(abs(r - radii[k]), 9), k))
                    for turn in (0, 1, -1):
                        a = round(round((math.atan2(dy, dx) % (2 * math.pi) + turn * 2 * math.pi) * radii[s], 9))
                        want |= {(v, h, y, x) for v, h in have.get((s, a), ())}
        assert got == want and want
