"""Native unions, the content-addressed store and streamed fusion."""

import itertools
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratavox.operators import finalization, geometry, masks
from stratavox.sources import unions
from stratavox.streaming import frontier, fusion

LAYERS = "ord long, op string, t long, y long, x long"


def layers():
    rng = np.random.default_rng(6)
    shape = (7, 9, 9)
    solid = rng.random((4, *shape)) < np.array([0.5, 0.6, 0.1, 0.3])[:, None, None, None]
    ops = ["union", "select", "subtract", "union"]
    rows = [(k, ops[k], *map(int, c)) for k in range(4) for c in np.argwhere(solid[k])]
    return rows, (solid[1] & ~solid[2]) | solid[3]


def test_native_union(spark):
    rows, union = layers()
    stages = {}
    frame = spark.createDataFrame(rows, LAYERS)
    guard = spark.createDataFrame([(0, 0, 0), (6, 8, 8)], "t long, y long, x long")
    out = finalization.finalize(frame, 9, 7, finalization.Filters(voids=6, sigma=0.7, keep=1), guard, lambda name, m: stages.update({name: {tuple(r) for r in m.select(*masks.AT).collect()}}))
    assert list(stages) == ["union", "void_fill", "gaussian", "keep_objects"]
    assert stages["union"] == {tuple(map(int, c)) for c in np.argwhere(union)}
    # voids: background that cannot walk out of the volume's box
    back = {c for c in np.ndindex(*union.shape) if not union[c]}
    open_ = {c for c in back if any(v in (0, n - 1) for v, n in zip(c, union.shape))}
    while True:
        more = {q for c in open_ for a in range(3) for s in (1, -1) if (q := tuple(v + s * (a == k) for k, v in enumerate(c))) in back} - open_
        if not more:
            break
        open_ |= more
    filled = union.copy()
    for c in back - open_:
        filled[c] = True
    assert stages["void_fill"] == {tuple(map(int, c)) for c in np.argwhere(filled)}
    v, taps = filled.astype(float), geometry.gaussian_taps(0.7)
    for axis in range(3):
        v = np.apply_along_axis(lambda line: np.convolve(line, taps, "same"), axis, v)
    assert stages["gaussian"] == {tuple(map(int, c)) for c in np.argwhere(v >= 0.5 - 1e-9)}
    assert {tuple(r) for r in out.collect()} == stages["keep_objects"] | {(0, 0, 0), (6, 8, 8)}
    # without filters the union stands
    assert {tuple(r) for r in finalization.finalize(frame, 9, 7, finalization.Filters()).collect()} == stages["union"]
    for bad, message in [([(0, "subtract", 0, 0, 0)], "cannot subtract"), ([(0, "none", 0, 0, 0)], "composable"), ([(0, "union", 0, 0, 0), (0, "select", 0, 0, 0)], "more than one")]:
        with pytest.raises(ValueError, match=message):
            finalization.finalize(spark.createDataFrame(bad, LAYERS), 9, 7, finalization.Filters())


def test_union_store(spark, tmp_path):
    rng = random.Random(2)
    folder = f"file://{tmp_path}/store"
    rows = sorted({(a, rng.randint(0, 95), rng.randint(3, 40), rng.randint(0, 20)) for a in ("p", "q") for _ in range(1500)})
    schema = "artifact string, frame long, y long, x long"
    early, late = [r for r in rows if r[1] < 60], [r for r in rows if r[1] >= 60]
    assert unions.scan(spark, folder).collect() == []
    assert unions.append(spark.createDataFrame(early + early[:9], schema), folder, "one")
    files = sorted(os.listdir(f"{tmp_path}/store/chunks"))
    assert not unions.append(spark.createDataFrame(early, schema), folder, "one")  # the same append again
    with pytest.raises(ValueError, match="already"):
        unions.append(spark.createDataFrame(late + early[:1], schema), folder, "two")
    # an append that was cut off is not seen, and can be done again
    assert {tuple(r) for r in unions.scan(spark, folder).collect()} == set(early)
    assert unions.append(spark.createDataFrame(late, schema), folder, "two")
    assert sorted(tuple(r) for r in unions.scan(spark, folder).collect()) == rows
    assert {tuple(r) for r in unions.scan(spark, folder, "q", 25, 31).collect()} == {r for r in rows if r[0] == "q" and 25 <= r[1] < 31}
    assert files
    # a changed byte stops scans of its chunk and of no other
    hit = unions.frames(spark, folder).where("artifact = 'p' AND frame < 30").first()
    path = f"{tmp_path}/store/chunks/{hit.sha256[:2]}/{hit.sha256}"
    data = bytearray(open(path, "rb").read())
    data[len(data) // 2] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(Exception, match="is not what its name says"):
        unions.scan(spark, folder, "p").collect()
    assert {tuple(r) for r in unions.scan(spark, folder, "p", 30, 60).collect()} == {r for r in rows if r[0] == "p" and 30 <= r[1] < 60}


def test_views_come_out_complete_and_once(spark, tmp_path):
    rng = random.Random(9)
    want, packets = {}, []
    for view, slices, variants in [("a", 3, 2), ("b", 2, 3), ("c", 4, 1), ("late", 2, 2)]:
        for t, v in itertools.product(range(slices), range(variants)):
            px = sorted(rng.sample(range(50), rng.choice([0, 3, 9])))
            if (view, t, v) != ("late", 1, 1):
                packets.append((view, slices, variants, v, t, px))
            want.setdefault((view, t), set()).update(px)
            last = (view, slices, variants, v, t, px)
    rng.shuffle(packets)
    packets = packets + packets[:5]  # sent again
    schema = "view string, n_slices long, n_variants long, variant long, t long, pixels array<long>"
    out = f"file://{tmp_path}/out"
    put = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/packets.parquet")
    got = lambda: sorted((r.view, r.t, tuple(r.pixels)) for r in fusion.views(spark, out).collect())
    go = lambda: fusion.run(frontier.stream_of(spark, str(tmp_path), "packets"), out)
    for k in range(0, 12, 4):
        put(packets[k : k + 4])
    assert fusion.views(spark, out).collect() == []
    go()
    for row in got():  # nothing comes out in part
        assert sum(r[0] == row[0] for r in got()) == {"a": 3, "b": 2, "c": 4}[row[0]]
    put(packets[12:])
    go()  # a new start goes on where the last one ended
    full = sorted((v, t, tuple(sorted(px))) for (v, t), px in want.items())
    assert got() == [r for r in full if r[0] != "late"]
    put([last])
    put([last, packets[0]])
    go()
    assert got() == full
    go()
    assert got() == full
