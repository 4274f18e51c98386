"""Streams over several batches, folders, late rows and restarts; merges with tied rows; matching by blocks."""

import itertools
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from stratavox.operators import kernels, temporal
from stratavox.plans.temporal import ISLANDS
from stratavox.streaming import frontier


def parts(spark, folder, batches, schema):
    """One file a batch, written one after the other."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def test_table_stored_as_folder_and_restart(spark, tmp_path):
    rng = random.Random(1)
    schema = "lineage long, frame long, px long"
    rows = [(rng.randint(0, 4), rng.randint(0, 3), rng.randint(0, 5000)) for _ in range(900)]
    parts(spark, f"{tmp_path}/relays.parquet", [rows[:200], rows[200:400]], schema)
    totals = lambda: {(r.lineage, r.frame): (r.n_pixels, r.revisions) for r in frontier.ledger_totals(frontier.drain(frontier.relay_ledger(frontier.stream_of(spark, str(tmp_path), "relays")), "update", ["lineage", "frame", "chunk"], out)).collect()}
    out = f"file://{tmp_path}/run"
    first = totals()
    assert {k: n for k, (n, _) in first.items()} == {k: len({p for a, b, p in rows[:400] if (a, b) == k}) for k in {r[:2] for r in rows[:400]}}
    assert totals() == first  # a restart without new files changes nothing
    parts(spark, f"{tmp_path}/relays.parquet", [rows[400:], rows[:100]], schema)  # new pixels, then only known ones
    last = totals()
    assert {k: n for k, (n, _) in last.items()} == {k: len({p for a, b, p in rows if (a, b) == k}) for k in {r[:2] for r in rows}}
    chunks = {(a, b, p // frontier.CHUNK) for a, b, p in rows}
    assert sum(r for _, r in last.values()) <= 3 * len(chunks)  # the batch of known pixels made no revision


def test_late_rows_are_left_out(spark, tmp_path):
    schema = "event_id long, ts timestamp_ntz, event_type string"
    at = lambda h, m=0: __import__("datetime").datetime(2024, 1, 1, h, m)
    batches = [[(1, at(1), "a"), (2, at(1, 30), "a")], [(3, at(9), "a")], [(4, at(8, 10), "a")], [(5, at(1, 45), "a"), (6, at(9, 30), "b")]]
    parts(spark, f"{tmp_path}/events.parquet", batches, schema)
    stream = frontier.stream_of(spark, str(tmp_path), "events").withColumn("ts", F.col("ts").cast("timestamp"))
    got = {(r.start.hour, r.event_type): (r.n, r.ids) for r in frontier.drain(frontier.windowed_counts(stream), "update", ["start", "event_type"]).collect()}
    # row 4 is within two hours of the latest time seen, row 5 comes after its window was let go
    assert got == {(1, "a"): (2, 3), (9, "a"): (1, 3), (8, "a"): (1, 4), (9, "b"): (1, 6)}


def test_stream_without_batches(spark, tmp_path):
    spark.createDataFrame([], "lineage long, frame long, px long").write.parquet(f"{tmp_path}/relays.parquet")
    stream = frontier.relay_ledger(frontier.stream_of(spark, str(tmp_path), "relays"))
    assert frontier.ledger_totals(frontier.drain(stream, "update", ["lineage", "frame", "chunk"])).collect() == []


@pytest.mark.parametrize("gap", [0, 1])
def test_tied_intervals(spark, gap):
    rng = random.Random(gap)
    rows = [(k, True, s, s + rng.randint(1, 4)) for k in range(300) for s in [rng.randint(0, 60) for _ in range(8)] for _ in range(rng.choice([1, 1, 5]))]
    frame = spark.createDataFrame(rows, "lineage long, forward boolean, start long, stop long").repartition(7)
    got = sorted((r.lineage, r.start, r.stop, r.n) for r in temporal.merge_intervals(frame, ["lineage", "forward"], gap).collect())
    want = []
    for k, mine in itertools.groupby(sorted((r[0], r[2], r[3]) for r in rows), lambda r: r[0]):
        islands = []
        for _, a, b in mine:
            if islands and a <= islands[-1][1] + gap:
                islands[-1][1:] = [max(islands[-1][1], b), islands[-1][2] + 1]
            else:
                islands.append([a, b, 1])
        want += [(k, *i) for i in islands]
    assert got == want
    con = duckdb.connect(config={"threads": 8})
    con.execute("CREATE TABLE edges (lineage BIGINT, forward BOOLEAN, start BIGINT, stop BIGINT)")
    con.executemany("INSERT INTO edges VALUES (?, ?, ?, ?)", rows)
    for _ in range(3):
        assert sorted(con.execute(f"WITH {ISLANDS.format(src='edges', gap=gap)} SELECT lineage, start, stop, n FROM islands").fetchall()) == want


@pytest.mark.parametrize("seed", range(3))
def test_matching_in_blocks_is_the_best_of_all(spark, seed):
    rng = random.Random(seed)
    pairs = [(a, b, round(rng.random(), 3)) for block in range(5) for a in range(block * 10, block * 10 + 4) for b in range(block * 10 + 1, block * 10 + 4) if rng.random() < 0.6]
    got = kernels.match_tracks(spark.createDataFrame(pairs, "obj_l long, obj_r long, iou double"), "iou", 0.2).collect()
    assert len({r.obj_l for r in got}) == len({r.obj_r for r in got}) == len(got)
    best = 0.0
    for block in range(5):
        w = {(a, b): v for a, b, v in pairs if a // 10 == block and v >= 0.2}
        left, right = sorted({a for a, _ in w}), sorted({b for _, b in w}) + [None] * 4
        best += max((sum(w.get((a, b), 0) for a, b in zip(left, p)) for p in itertools.permutations(right, len(left))), default=0)
    assert sum(r.value for r in got) == pytest.approx(best)
