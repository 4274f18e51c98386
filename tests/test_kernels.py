"""Kernels, files and sequential operators against brute force."""

import itertools
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stratavox.functions import hashing, parsing
from stratavox.operators import graph, kernels, masks, tracks
from stratavox.session import shared_path
from stratavox.sources import labels, nrrd


def test_squared_distance_and_sign():
    rng = np.random.default_rng(0)
    for _ in range(20):
        m = rng.random((rng.integers(1, 9), rng.integers(1, 11))) < 0.2
        if not m.any():
            continue
        y, x = np.nonzero(m)
        d = kernels.squared_distance(m)
        for (a, b), v in np.ndenumerate(d):
            assert v == ((y - a) ** 2 + (x - b) ** 2).min()
        assert (kernels.signed_distance(m)[m] > 0).all()


def test_assignment_is_best():
    rng = np.random.default_rng(1)
    for _ in range(60):
        n = int(rng.integers(1, 6))
        m = n + int(rng.integers(0, 3))
        w = rng.integers(0, 20, (n, m)).astype(float)
        got = kernels.assign(w)
        assert len(set(got)) == n
        assert w[np.arange(n), got].sum() == max(sum(w[i, j] for i, j in enumerate(p)) for p in itertools.permutations(range(m), n))


def test_base62_tag(spark):
    h = "ff38aa91f4382ff9b16f1b0b8c249a8dc50ef897a3762738e3393e9465595771"
    got = spark.createDataFrame([(h,), (None,)], "h string").select(parsing.base62("h").alias("t")).collect()
    value, out = int(h, 16), ""
    for _ in range(16):
        out = parsing.TAG_ALPHABET[value % 62] + out
        value //= 62
    assert got[0].t == out and got[1].t is None


def test_fnv(spark):
    def fnv(b):
        x = 2166136261
        for c in b:
            x = (x ^ c) * 16777619 % (1 << 32)
        return x

    texts = ["", "a", "Brand#12", "é𝒳"]
    got = spark.createDataFrame([(t,) for t in texts], "s string").select("s", hashing.fnv1a32(F.col("s")).alias("h")).collect()
    assert {r.s: r.h for r in got} == {t: fnv(t.encode()) for t in texts}


def test_nrrd_volumes_and_manifest(spark):
    volume = np.random.default_rng(2).integers(0, 2, (3, 4, 5)).astype(np.uint8)
    assert (nrrd.decode(nrrd.encode(volume, "v")) == volume).all()
    with pytest.raises(ValueError):
        nrrd.decode(b"TIFF....")
    folder = shared_path(spark, "nrrd-test")
    rows = [(1, 0, 1, 2), (1, 2, 3, 4), (7, 1, 1, 1)]
    done = nrrd.write(spark.createDataFrame(rows, "layer long, t long, y long, x long"), folder, (3, 4, 5))
    assert sorted((r.layer, r.voxels) for r in done.collect()) == [(1, 2), (7, 1)]
    assert sorted(tuple(r) for r in nrrd.read(spark, folder).collect()) == rows
    path = folder.removeprefix("file://")
    entries = json.load(open(f"{path}/manifest.json"))
    entries["layers"][0]["sha256"] = "0" * 64
    json.dump(entries, open(f"{path}/manifest.json", "w"))
    with pytest.raises(Exception, match="not the file of the manifest"):
        nrrd.read(spark, folder).collect()


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5)], "a long, b long").repartition(5)
    got = {r.node: r.root for r in graph.components(edges).collect()}
    assert {got[i] for i in range(301)} == {0} and got[1001] == got[1000] == 1000
    assert graph.components(edges.limit(0)).count() == 0


def test_compose_select_starts_anew(spark):
    layers = [(0, "union", 0, 0, 0), (1, "select", 0, 0, 1), (1, "select", 0, 0, 2), (2, "subtract", 0, 0, 2), (3, "union", 0, 0, 3), (4, "none", 0, 0, 4)]
    got = masks.compose(spark.createDataFrame(layers, "ord int, op string, t long, y long, x long")).collect()
    assert sorted(r.x for r in got) == [1, 3]


def test_packing_and_peaks(spark):
    objects = [(0, 0, [1, 2, 3, 4]), (0, 1, [4, 5, 6, 7]), (0, 2, [1, 2, 9, 10]), (0, 3, [50])]
    got = tracks.pack_sessions(spark.createDataFrame(objects, "key long, obj long, pixels array<long>"), most=2, exclusive=0.75).collect()
    assert {r.obj: r.session for r in got} == {0: 0, 1: 0, 2: 1, 3: 1}
    points = [(0, 0, 0, 1.0), (0, 0, 1, 2.0), (0, 0, 4, 0.5)]
    kept = tracks.peaks(spark.createDataFrame(points, "t long, y long, x long, r double"), 2).collect()
    assert sorted(r.x for r in kept) == [1, 4]


def test_strict_polygons_stop(spark):
    good, bad = "0 0.1 0.1 0.9 0.1 0.5 0.9", "0 0.1 0.1 0.9 0.1"
    df = spark.createDataFrame([(good,)], "value string")
    assert labels.parse_polygons(df, strict=True).first().class_id == 0
    with pytest.raises(Exception, match="bad polygon line"):
        labels.parse_polygons(spark.createDataFrame([(bad,)], "value string"), strict=True).collect()
    assert labels.parse_polygons(spark.createDataFrame([(bad,), ("x",), ("",)], "value string")).count() == 0


def test_bridge_between_equal_slices(spark):
    m = [(0, y, x) for y in (2, 3) for x in (2, 3)] + [(3, y, x) for y in (2, 3) for x in (2, 3)]
    got = kernels.bridge(spark.createDataFrame(m, "t long, y long, x long"), 8, 3).toPandas()
    assert isinstance(got, pd.DataFrame) and sorted(set(zip(got.t, got.y, got.x))) == [(t, y, x) for t in (1, 2) for y in (2, 3) for x in (2, 3)]


def test_clip_against_pixels():
    from stratavox.operators import polygons

    square = [{"x": 0.0, "y": 0.0}, {"x": 10.0, "y": 0.0}, {"x": 10.0, "y": 10.0}, {"x": 0.0, "y": 10.0}]
    assert sorted(polygons.clip(square, 2, 3, 20, 5)) == [(2, 3), (2, 5), (10.0, 3), (10.0, 5)]
    assert polygons.clip(square, 11, 0, 12, 1) == []
    assert polygons.clip(square, -1, -1, 11, 11) == [(p["x"], p["y"]) for p in square]


def test_distances_of_many_lines_and_batches(spark):
    rng = np.random.default_rng(4)
    for shape in [(1, 9), (9, 1), (40, 31)]:
        m = rng.random((5, *shape)) < 0.03
        m[0], m[1] = False, True
        assert all(np.array_equal(kernels.squared_distance(m)[k], kernels.squared_distance(m[k])) for k in range(5))
        y, x = np.nonzero(m[3])
        yy, xx = np.mgrid[: shape[0], : shape[1]]
        if len(y):
            assert np.array_equal(kernels.squared_distance(m[3]), ((yy[..., None] - y) ** 2 + (xx[..., None] - x) ** 2).min(-1))
    # slices of one group, with components at the border of the canvas, against each slice on its own
    m = rng.random((30, 8, 8)) < 0.7
    rows = [tuple(map(int, c)) for c in np.argwhere(m)]
    got = {tuple(r) for r in masks.drop_thin(spark.createDataFrame(rows, "t long, y long, x long"), 1.5, 8).collect()}
    want = set()
    for t in range(30):
        d2, label = kernels.squared_distance(~m[t]), kernels.slice_labels(m[t])
        thick = {label[c] for c in np.ndindex(8, 8) if m[t][c] and d2[c] >= 2.25}
        want |= {(t, y, x) for y, x in np.ndindex(8, 8) if m[t, y, x] and label[y, x] in thick}
    assert got == want and 0 < len(want) < len(rows)


def test_distances_along_lines_with_near_background(monkeypatch):
    def slow(*_):
        raise AssertionError("the envelope was built")

    rng = np.random.default_rng(3)
    f = rng.integers(0, 40, (90, 70))
    f[20:60, 5] = 1000
    place = np.arange(len(f))
    want = (((place[:, None] - place) ** 2)[:, :, None] + f).min(1)
    assert (kernels._along(f) == want).all()
    far = f.copy()
    far[3, 4] = 1 << 20
    assert (kernels._along(far) == (((place[:, None] - place) ** 2)[:, :, None] + far).min(1)).all()
    monkeypatch.setattr(np, "empty_like", slow)
    kernels._along(f)
