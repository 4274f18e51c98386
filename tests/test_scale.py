"""Work that is dear in Python but short in bytes is dealt over tasks, and groups of any length are streamed."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratavox.operators import centerlines, groups, interpolation, kernels
from stratavox.streaming import frontier


def tasks_of(df):
    return df.select(F.spark_partition_id()).distinct().count()


@pytest.fixture
def short_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_groups_go_on_from_batch_to_batch(spark, short_batches):
    rng = random.Random(4)
    rows = [(k, rng.randint(0, 99), [k]) for k in range(9) for _ in range(rng.choice([1, 2, 3, 17]))] + [(None, v, None) for v in range(5)]
    frame = spark.createDataFrame(rows, "k long, v long, a array<long>").repartition(5)
    run = lambda g: [(g["k"][0], len(g["v"]), ",".join(map(str, g["v"])))]
    got = {tuple(r) for r in groups.streamed(frame, ["k"], [F.col("v").desc()], run, "k long, n long, vs string").collect()}
    assert got == {(k, len(v), ",".join(map(str, sorted(v, reverse=True)))) for k in {r[0] for r in rows} for v in [[r[1] for r in rows if r[0] == k]]}
    assert groups.streamed(frame.where("false"), ["k"], [], run, "k long, n long, vs string").collect() == []


def test_peaks_tracks_and_radii_are_dealt_over_tasks(spark):
    grid = np.indices((12, 12, 12))
    tube = ((grid[1:] - 6) ** 2).sum(0) <= 9
    mask = spark.createDataFrame([(v, *map(int, c)) for v in range(12) for c in np.argwhere(tube)], "volume long, t long, y long, x long")
    radii = centerlines.radii(mask, tube.shape)
    peaks = centerlines.plane_peaks(centerlines.ridges(radii))
    found = centerlines.tracks(centerlines.links(peaks, mask))
    assert min(map(tasks_of, (radii, peaks, found))) > 1


def test_floods_of_small_slices_settle_in_one_round(spark, monkeypatch):
    # all slices have one tile, so nothing comes from beside it, and slices share groups
    rng = np.random.default_rng(3)
    rows = [(s, y, x, int(rng.integers(0, 5))) for s in range(0, 4000, 40) for y in range(8) for x in range(8)]
    pixels = spark.createDataFrame(rows, "slice long, y long, x long, level long")
    marks = spark.createDataFrame([(s, y, y, k + 1) for s in range(0, 4000, 40) for k, y in enumerate((0, 7))], "slice long, y long, x long, label int")
    got = centerlines.basins(pixels, marks, most_rounds=2)  # the second finds nothing awake
    assert got.where("flat IS NOT NULL AND label IS NOT NULL").count() == len(rows) and tasks_of(got) > 1


def test_ledger_of_very_many_frames_needs_no_python(spark, tmp_path):
    rows = [(k % 7, k // 7, p) for k in range(3000) for p in (k % 5 - 2, 63 + k % 2, 4096)] + [(0, 0, None), (9, 9, None)]
    schema = "lineage long, frame long, px long"
    for part in (rows[: len(rows) // 2], rows[len(rows) // 3 :]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/relays.parquet")
    ledger = frontier.relay_ledger(frontier.stream_of(spark, str(tmp_path), "relays"))
    assert "Python" not in ledger._jdf.queryExecution().analyzed().toString() and "InPandas" not in ledger._jdf.queryExecution().analyzed().toString()
    got = {(r.lineage, r.frame): (r.n_pixels, r.revisions) for r in frontier.ledger_totals(frontier.drain(ledger, "update", ["lineage", "frame", "chunk"])).collect()}
    want = {}
    for lineage, frame, p in rows:
        want.setdefault((lineage, frame), set()).update(() if p is None else (p,))
    assert {k: n for k, (n, _) in got.items()} == {k: len(v) for k, v in want.items()}
    assert sum(r for _, r in got.values()) <= 4 * 3000 + 2  # rows that came twice count once


def test_cones_and_bridges_are_dealt_over_tasks(spark):
    mask = spark.createDataFrame([(v, t, y, x) for v in range(16) for t in (0, 1, 4, 5) for y in range(4, 8) for x in range(4, 8)], "volume long, t long, y long, x long")
    rows = interpolation.pieces(mask, (6, 12, 12))
    found = interpolation.anchors(rows)
    starts = interpolation.seeds(rows, found)
    plans = interpolation.planned(rows, found, starts, (6, 12, 12), 4, 10.0, 1, 0)
    assert tasks_of(interpolation.candidates(rows, starts, (6, 12, 12), 4, 10.0, 1)) > 1
    assert tasks_of(interpolation.bridges(rows, plans, (6, 12, 12), 0.0)) > 1


def test_small_distances_equal_the_envelope(monkeypatch):
    rng = np.random.default_rng(6)
    f = [rng.integers(0, 400, (n, m)) for n, m in ((1, 1), (2, 5), (9, 30), (31, 7))]
    small = [kernels._along(v) for v in f]
    monkeypatch.setattr(kernels, "SMALL", 0)
    assert all((a == kernels._along(v)).all() for a, v in zip(small, f))


def test_sections_are_dealt_over_tasks_and_fetch_numbers(spark):
    mask = spark.createDataFrame([(v, t, y, x) for v in range(12) for t in range(20) for y in range(4, 9) for x in range(14, 19)], "volume long, t long, y long, x long")
    assert dict(centerlines.cells_of(mask).dtypes)["voxels"] == "array<int>"
    samples = spark.createDataFrame([(v, 1, t, t, 6, 16, 2.0, 1, 0, 0) for v in range(12) for t in range(20)], "volume long, branch long, arc long, t long, y long, x long, r double, dt long, dy long, dx long")
    assert tasks_of(centerlines.sections(samples, mask, (20, 32, 32), 2.0)) > 1
