"""Elastic policies: the field, its warp, and the inverse against a search on the whole raster."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratavox.operators import elastic as ops

H, W, STEP = 40, 50, 10


def policies():
    rows = []
    for k, (angle, scale, magnitude) in enumerate([(0.0, 1.0, 0.0), (0.2, 1.1, 2.0), (-0.4, 0.9, 3.5), (3.0, 1.0, 1.5), (0.1, 1.0, 14.0)]):
        c, s = np.cos(angle) * scale, np.sin(angle) * scale
        rows.append((k, float(c), float(-s), float((W - 1) / 2 * (1 - c) + (H - 1) / 2 * s), float(s), float(c), float((H - 1) / 2 * (1 - c) - (W - 1) / 2 * s), 77 * k, magnitude))
    return rows


@pytest.mark.parametrize("tile", [64, 16])
def test_inverse_of_warps(spark, monkeypatch, tile):
    monkeypatch.setattr(ops, "TILE", tile)
    table = spark.createDataFrame(policies(), "policy long, m00 double, m01 double, m02 double, m10 double, m11 double, m12 double, seed long, magnitude double")
    moved = ops.field(ops.lattice(table, H, W, STEP), H, W, STEP).cache()
    d = np.full((5, H, W, 2), np.nan)
    for r in moved.collect():
        d[r.policy, r.y, r.x] = (r.dx, r.dy)
    assert np.isfinite(d).all() and all(np.abs(d[k]).max() <= policies()[k][8] for k in range(5))
    src = {(r.policy, r.y, r.x): (r.sx, r.sy) for r in ops.sources(table, moved).collect()}
    back = {(r.policy, r.y, r.x): (r.ox, r.oy) for r in ops.inverse(table, moved, H, W).collect()}
    assert len(back) == 5 * H * W
    shares = []
    for k, row in enumerate(policies()):
        m = np.array(row[1:7]).reshape(2, 3)
        inv = np.linalg.inv(m[:, :2])
        shift = -inv @ m[:, 2]
        assert np.allclose(src[k, 7, 9], inv @ [9, 7] + shift + d[k, 7, 9])
        y, x = np.mgrid[:H, :W]
        target = np.stack([x.ravel(), y.ravel()], 1).astype(float)
        place, fine = ops.invert(target, m, d[k], 0, 0, H, W)  # with the whole raster at hand
        known = 0
        for (tx, ty), p, ok in zip(target.astype(int).tolist(), place, fine):
            ox, oy = back[k, ty, tx]
            if ox is None:
                continue
            known += 1
            # what is told is what the whole raster gives, and the warp leads back to the pixel
            assert ok and np.allclose((ox, oy), p, atol=1e-6)
            value, *_ = ops.bilinear(d[k], np.array([ox]), np.array([oy]), 0, 0, H, W)
            assert np.abs(inv @ [ox, oy] + shift + value[0] - [tx, ty]).max() <= ops.RESIDUAL + 1e-6
            assert 0 <= ox <= W - 1 and 0 <= oy <= H - 1
        shares.append((known, int(fine.sum())))
    assert shares[0] == (H * W, H * W) and all(k >= 0.97 * f > 0 for k, f in shares[:4])
    assert shares[4][1] < 0.9 * H * W  # a field that folds leaves places unknown


def test_masks_come_back(spark):
    table = spark.createDataFrame(policies()[:1], "policy long, m00 double, m01 double, m02 double, m10 double, m11 double, m12 double, seed long, magnitude double")
    moved = ops.field(ops.lattice(table, H, W, STEP), H, W, STEP)
    mask = spark.createDataFrame([(0, 3, 4), (0, 3, 4), (0, 39, 49)], "policy long, y long, x long")
    out = ops.restored(mask, ops.inverse(table, moved, H, W))
    assert {(r.y, r.x) for r in out.where("set").collect()} == {(3, 4), (39, 49)} and out.where("known").count() == H * W
    assert ops.inverse(table.limit(0), moved, H, W).count() == 0 and out.select(F.count_if(F.col("set").isNull())).first()[0] == 0
