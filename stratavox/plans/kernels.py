"""Kernels, files and streams over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratavox.operators import kernels as ops
from stratavox.operators import masks
from stratavox.plans.masks import V, _cells, _tracks
from stratavox.plans.temporal import OFFERS
from stratavox.session import shared_path
from stratavox.sources import nrrd
from stratavox.sources.tables import seconds_of, sql
from stratavox.streaming import frontier


def edt_squared(spark, sf):
    return ops.distances(_cells(spark, sf, 0.1), 8)


def bridge_slices(spark, sf):
    return ops.bridge(_cells(spark, sf, 0.05), 8, 3)


def track_matching(spark, sf):
    return ops.match_tracks(masks.overlap(_tracks(spark, sf, 0.0, 0), _tracks(spark, sf, 0.05, 0)), "iou_3d", 0.1).withColumn("value", F.round("value", 9))


def nrrd_round_trip(spark, sf):
    rows = _cells(spark, sf, 0.1).select((F.col("t") % 5).alias("layer"), F.floor(F.col("t") / 5).alias("t"), "y", "x")
    folder = shared_path(spark, "nrrd")
    depth = rows.agg(F.max("t")).first()[0]
    nrrd.write(rows, folder, (int(depth) + 1, 8, 8))
    return nrrd.read(spark, folder)


def _offers(events):
    minutes = F.floor(seconds_of("ts", "2024-01-01") / 600)
    score = (F.floor(F.col("value") * 100) % 100).cast("bigint")
    return events.select(
        F.col("user_id").alias("lineage"), (score % 3).alias("tile"), F.floor(minutes / 40).alias("frame"), F.col("event_type").isin("view", "click").alias("forward"), score.alias("score"),
        (F.col("event_id") % 5).alias("generation"), F.expr("shiftleft(1L, cast(floor(value * 100) % 4 AS int))").alias("provenance"), (F.col("event_id") % 64).alias("px"),
    )


def stream_frontier(spark, sf):
    return frontier.drain(frontier.merge_offers(_offers(frontier.stream_of(spark, sf, "events"))), "update", frontier.KEYS)


def stream_windows(spark, sf):
    events = frontier.stream_of(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return frontier.drain(frontier.windowed_counts(events), "update", ["start", "event_type"]).withColumn("start", seconds_of("start"))


def stream_ledger(spark, sf):
    relays = _offers(frontier.stream_of(spark, sf, "events")).select("lineage", "frame", "px")
    return frontier.ledger_totals(frontier.drain(frontier.relay_ledger(relays), "update", ["lineage", "frame", "chunk"])).drop("revisions")


QUERIES = {f.__name__: f for f in (edt_squared, bridge_slices, track_matching, nrrd_round_trip, stream_frontier, stream_windows, stream_ledger)}

GRID = "grid AS (SELECT s.t, y, x FROM (SELECT DISTINCT t FROM voxels) s, (SELECT unnest(range(8)) AS y), (SELECT unnest(range(8)) AS x))"
ORACLES = {
    "edt_squared": f"""{V(0.1)}, {GRID}, back AS (SELECT * FROM grid ANTI JOIN voxels USING (t, y, x))
SELECT b.t, b.y, b.x, min((b.y - v.y) * (b.y - v.y) + (b.x - v.x) * (b.x - v.x))::BIGINT AS d2 FROM back b JOIN voxels v ON b.t = v.t GROUP BY b.t, b.y, b.x""",
    "bridge_slices": f"""{V(0.05)}, {GRID}, cells AS (SELECT g.*, v.t IS NOT NULL AS fg FROM grid g LEFT JOIN voxels v USING (t, y, x) WHERE g.t % 3 = 0),
d AS (SELECT a.t, a.y, a.x, CASE WHEN any_value(a.fg) THEN 1 ELSE -1 END * sqrt(min((a.y - b.y) * (a.y - b.y) + (a.x - b.x) * (a.x - b.x))::DOUBLE) AS s FROM cells a JOIN cells b ON a.t = b.t AND a.fg <> b.fg GROUP BY a.t, a.y, a.x)
SELECT (a.t + k)::BIGINT AS t, a.y, a.x FROM d a JOIN d b ON b.t = a.t + 3 AND a.y = b.y AND a.x = b.x, (SELECT unnest([1, 2]) AS k) WHERE a.s * (3 - k) + b.s * k >= 0""",
    "nrrd_round_trip": f"{V(0.1)} SELECT t % 5 AS layer, t // 5 AS t, y::BIGINT AS y, x::BIGINT AS x FROM voxels",
    "stream_frontier": f"{sql('frames')}, {OFFERS} SELECT lineage, tile, frame, forward, max(score) AS score, max(generation) AS generation, bit_or(provenance) AS provenance, count(*) AS n_offers FROM offers GROUP BY ALL",
    "stream_windows": "SELECT (epoch(ts)::BIGINT - (epoch(ts)::BIGINT % 3600)) AS start, event_type, count(*) AS n, sum(event_id)::BIGINT AS ids FROM (SELECT date_trunc('second', ts) AS ts, event_type, event_id FROM events) GROUP BY ALL",
    "stream_ledger": f"{sql('frames')}, {OFFERS} SELECT lineage, frame, count(DISTINCT px) AS n_pixels FROM offers GROUP BY ALL",
}
