"""Temporal operators over the frames view: anchors are purchases, coverage is made of views and clicks."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratavox.operators import relays
from stratavox.operators import temporal as ops
from stratavox.sources.tables import frames, sql, table

N_FRAMES = 4320


def _anchors(spark, sf):
    kinds = table(spark, sf, "events").select(F.col("event_id").alias("__e"), "event_type")
    return frames(spark, sf).join(kinds, F.col("event_id") == F.col("__e")).where(F.col("event_type") == "purchase")


def _edges(spark, sf):
    return frames(spark, sf).select("lineage", "forward", F.col("frame").alias("start"), (F.col("frame") + F.col("score") % 20 + 1).alias("stop"))


def _pixels(spark, sf, seeds: bool):
    rows = frames(spark, sf).where(F.col("event_id") % 3 == 0 if seeds else F.col("event_id") % 3 != 0)
    return rows.select((F.col("lineage") % 10).alias("lineage"), F.floor(F.col("frame") / 20).alias("frame"), "forward", (F.col("score") % 4).alias("px"))


def _offers(spark, sf):
    return frames(spark, sf).select(
        "lineage", (F.col("score") % 3).alias("tile"), F.floor(F.col("frame") / 40).alias("frame"), "forward", "score",
        (F.col("event_id") % 5).alias("generation"), F.expr("shiftleft(1L, cast(score % 4 AS int))").alias("provenance"), (F.col("event_id") % 64).alias("px"),
    )


def anchor_domains(spark, sf):
    return ops.anchor_domains(_anchors(spark, sf), 0, N_FRAMES)


def session_windows(spark, sf):
    return ops.domain_windows(anchor_domains(spark, sf))


def nearest_anchor(spark, sf):
    return ops.nearest_anchor(frames(spark, sf), _anchors(spark, sf))


def interval_merge(spark, sf):
    return ops.merge_intervals(_edges(spark, sf), ["lineage", "forward"])


def relay_episodes(spark, sf):
    rows = _edges(spark, sf).select("lineage", "forward", "start", (F.col("stop") - 1).alias("stop"))
    return ops.merge_intervals(rows, ["lineage", "forward"], gap=1)


def coverage_handoff(spark, sf):
    edges = ops.merge_intervals(_pixels(spark, sf, False).select("lineage", "forward", F.col("frame").alias("start"), (F.col("frame") + 2).alias("stop")), ["lineage", "forward"])
    return ops.handoffs(_pixels(spark, sf, True), _pixels(spark, sf, False), edges, N_FRAMES // 20 - 1)


def prompt_support(spark, sf):
    return ops.prompt_support(_pixels(spark, sf, True), _pixels(spark, sf, False)).groupBy("lineage", "frame").agg(F.count("*").alias("n_pixels"), F.sum("px").alias("sum_px"))


def frontier_mailboxes(spark, sf):
    return ops.merge_offers(_offers(spark, sf), N_FRAMES // 40).withColumn("n_pixels", F.size("pixels").cast("bigint")).drop("pixels")


def frontier_wave(spark, sf):
    return ops.take_wave(ops.merge_offers(_offers(spark, sf), N_FRAMES // 40)).select("lineage", "tile", "frame", "forward", "sweep", "score")


def frontier_merge(spark, sf):
    parts = [ops.merge_offers(_offers(spark, sf).where(F.col("px") % 2 == k), N_FRAMES // 40) for k in (0, 1)]
    return ops.merge_mailboxes(*parts).select("lineage", "tile", "frame", "forward", "score", "generation", F.size("pixels").cast("bigint").alias("n_pixels"), "dirty")


def monotonic_cut(spark, sf):
    rows = frames(spark, sf).groupBy("lineage", "frame").agg(F.sum(F.when(F.col("forward"), F.col("score")).otherwise(0)).alias("left"), F.sum(F.when(F.col("forward"), 0).otherwise(F.col("score"))).alias("right"))
    return ops.monotonic_cut(rows)


#: Frames of the relay view, tiles in a row of it, and columns of a tile; the last column of a tile is the first of the next.
RELAY_FRAMES, RELAY_TILES, RELAY_COLUMNS = 216, 4, 4


def _observations(spark, sf):
    return frames(spark, sf).select(
        (F.col("lineage") % 40).alias("lineage"), (F.col("score") % RELAY_TILES).alias("tile"), F.floor(F.col("frame") / 20).alias("frame"), "forward", (F.col("event_id") % (RELAY_COLUMNS * 4)).alias("px"), "event_id"
    )


def relay_frontier(spark, sf):
    """Every eleventh observation is an offer; tracks go on in time and over to the tiles beside, until nothing is new."""
    seen = _observations(spark, sf)
    cells = spark.range(RELAY_TILES).withColumnRenamed("id", "tile").crossJoin(spark.range(RELAY_COLUMNS * 4).withColumnRenamed("id", "px"))  # the layout of one row of tiles
    column = F.col("px") % RELAY_COLUMNS
    right = cells.where((column == RELAY_COLUMNS - 1) & (F.col("tile") < RELAY_TILES - 1)).select("tile", "px", (F.col("tile") + 1).alias("to_tile"), (F.col("px") - RELAY_COLUMNS + 1).alias("to_px"))
    left = right.select(F.col("to_tile").alias("tile"), F.col("to_px").alias("px"), F.col("tile").alias("to_tile"), F.col("px").alias("to_px"))
    found = relays.drive(seen.where("event_id % 11 = 0"), seen, right.unionByName(left), RELAY_FRAMES, empty=12)
    return found.select("lineage", "tile", "frame", "forward", "px")


QUERIES = {f.__name__: f for f in (relay_frontier, anchor_domains, session_windows, nearest_anchor, interval_merge, relay_episodes, coverage_handoff, prompt_support, frontier_mailboxes, frontier_wave, frontier_merge, monotonic_cut)}

V = sql("frames")
ANCHORS = "anchors AS (SELECT DISTINCT f.lineage, f.frame AS anchor FROM frames f JOIN events e USING (event_id) WHERE e.event_type = 'purchase')"
DOMAINS = f"""{ANCHORS}, domains AS (SELECT lineage, anchor,
  coalesce((lag(anchor) OVER w + anchor) // 2 + 1, 0) AS frame_start, coalesce((lead(anchor) OVER w + anchor) // 2 + 1, {N_FRAMES}) AS frame_stop
  FROM anchors WINDOW w AS (PARTITION BY lineage ORDER BY anchor))"""
EDGES = "edges AS (SELECT lineage, forward, frame AS start, frame + score % 20 + 1 AS stop FROM frames)"
# rows with the same ends belong to one island: the sum takes them together, in whatever order they stand
ISLANDS = """marked AS (SELECT *, max(stop) OVER (PARTITION BY lineage, forward ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {src}),
numbered AS (SELECT *, sum(CASE WHEN reach IS NULL OR start > reach + {gap} THEN 1 ELSE 0 END) OVER (PARTITION BY lineage, forward ORDER BY start, stop) AS island FROM marked),
islands AS (SELECT lineage, forward, min(start) AS start, max(stop) AS stop, count(*) AS n FROM numbered GROUP BY lineage, forward, island)"""
PIX = """px AS (SELECT lineage % 10 AS lineage, frame // 20 AS frame, forward, score % 4 AS px, event_id % 3 = 0 AS seed FROM frames)"""
OFFERS = "offers AS (SELECT lineage, score % 3 AS tile, frame // 40 AS frame, forward, score, event_id % 5 AS generation, 1::BIGINT << (score % 4)::INT AS provenance, event_id % 64 AS px FROM frames)"
N40 = N_FRAMES // 40
SWEEP = f"""CASE WHEN forward THEN CASE WHEN frame = {N40 - 1} THEN ceil({N40 - 1} / 29.0)::BIGINT ELSE frame // 29 END
  ELSE CASE WHEN frame = 0 THEN 1 ELSE -((frame - 1) // 29) END END::BIGINT"""
BOXES = f"""boxes AS (SELECT lineage, tile, frame, forward, max(score) AS score, max(generation) AS generation, bit_or(provenance) AS provenance, count(DISTINCT px) AS n_pixels, count(*) AS n_offers FROM offers GROUP BY ALL),
swept AS (SELECT *, {SWEEP} AS sweep FROM boxes)"""
ORACLES = {
    "relay_frontier": f"""WITH RECURSIVE {V[5:]}, seen AS (SELECT lineage % 40 AS lineage, score % {RELAY_TILES} AS tile, frame // 20 AS frame, forward, event_id % {RELAY_COLUMNS * 4} AS px, event_id FROM frames),
marked AS (SELECT *, lag(frame) OVER w AS before FROM (SELECT DISTINCT lineage, tile, px, frame FROM seen) WINDOW w AS (PARTITION BY lineage, tile, px ORDER BY frame)),
numbered AS (SELECT *, sum(CASE WHEN before IS NULL OR frame > before + 13 THEN 1 ELSE 0 END) OVER (PARTITION BY lineage, tile, px ORDER BY frame) AS island FROM marked),
runs AS MATERIALIZED (SELECT lineage, tile, px, min(frame) AS start, max(frame) AS stop FROM numbered GROUP BY lineage, tile, px, island),
mail AS (
  SELECT DISTINCT lineage, tile, frame, forward, px FROM seen WHERE event_id % 11 = 0
  UNION
  SELECT lineage, CASE rule WHEN 0 THEN tile ELSE tile + side END, CASE rule WHEN 0 THEN bound WHEN 1 THEN least(frame, upto) ELSE greatest(frame, upto) END,
         CASE rule WHEN 0 THEN forward ELSE rule = 1 END, CASE rule WHEN 0 THEN px ELSE px - side * {RELAY_COLUMNS - 1} END
  FROM (SELECT *, CASE WHEN forward THEN least(stop, bound) ELSE greatest(start, bound) END AS upto,
               CASE WHEN px % {RELAY_COLUMNS} = {RELAY_COLUMNS - 1} AND tile < {RELAY_TILES - 1} THEN 1 WHEN px % {RELAY_COLUMNS} = 0 AND tile > 0 THEN -1 ELSE 0 END AS side
        FROM (SELECT m.*, r.start, r.stop, CASE WHEN m.forward THEN least({RELAY_FRAMES - 1}, (m.frame // 29 + 1) * 29) WHEN m.frame = 0 THEN 0 ELSE greatest(0, (m.frame - 1) // 29 * 29) END AS bound
              FROM mail m JOIN runs r ON m.lineage = r.lineage AND m.tile = r.tile AND m.px = r.px AND m.frame BETWEEN r.start AND r.stop)), (SELECT unnest([0, 1, 2]) AS rule)
  WHERE CASE rule WHEN 0 THEN upto = bound AND bound <> frame AND bound <> CASE WHEN forward THEN {RELAY_FRAMES - 1} ELSE 0 END ELSE side <> 0 END
) SELECT lineage, tile, frame, forward, px FROM mail""",
    "anchor_domains": f"{V}, {DOMAINS} SELECT * FROM domains",
    "session_windows": f"""{V}, {DOMAINS}, c AS (SELECT *, frame_stop - frame_start AS size, greatest(frame_start, anchor - 14) AS l FROM domains),
c2 AS (SELECT *, CASE WHEN size <= 30 THEN frame_stop ELSE least(frame_stop, l + 30) END AS c1 FROM c),
c3 AS (SELECT *, CASE WHEN size <= 30 THEN frame_start ELSE greatest(frame_start, least(l, c1 - 30)) END AS c0 FROM c2),
back AS (SELECT lineage, anchor, 'backward' AS branch, unnest(range(1, ceil((c0 - frame_start) / 29.0)::BIGINT + 1)) AS ordinal, c0, frame_start FROM c3),
front AS (SELECT lineage, anchor, 'forward' AS branch, unnest(range(1, ceil((frame_stop - c1) / 29.0)::BIGINT + 1)) AS ordinal, c1, frame_stop FROM c3)
SELECT lineage, anchor, 'center' AS branch, 0::BIGINT AS ordinal, c0 AS window_start, c1 AS window_stop, anchor AS prompt_frame, 'authoritative' AS seed_kind FROM c3
UNION ALL SELECT lineage, anchor, branch, ordinal, greatest(frame_start, c0 - 29 * ordinal), c0 - 29 * (ordinal - 1) + 1, c0 - 29 * (ordinal - 1), 'dogfood' FROM back
UNION ALL SELECT lineage, anchor, branch, ordinal, c1 - 1 + 29 * (ordinal - 1), least(frame_stop, c1 - 1 + 29 * (ordinal - 1) + 30), c1 - 1 + 29 * (ordinal - 1), 'dogfood' FROM front""",
    "nearest_anchor": f"""{V}, {ANCHORS}, f AS (SELECT DISTINCT lineage, frame FROM frames),
r AS (SELECT f.lineage, f.frame, a.anchor, row_number() OVER (PARTITION BY f.lineage, f.frame ORDER BY abs(f.frame - a.anchor), a.anchor) AS nth FROM f JOIN anchors a USING (lineage))
SELECT lineage, frame, anchor FROM r WHERE nth = 1""",
    "interval_merge": f"{V}, {EDGES}, {ISLANDS.format(src='edges', gap=0)} SELECT * FROM islands",
    "relay_episodes": f"{V}, {EDGES}, inclusive AS (SELECT lineage, forward, start, stop - 1 AS stop FROM edges), {ISLANDS.format(src='inclusive', gap=1)} SELECT * FROM islands",
    "coverage_handoff": f"""{V}, {PIX}, cov AS (SELECT DISTINCT lineage, frame, px FROM px WHERE NOT seed), obs AS (SELECT lineage, forward, frame AS e FROM px WHERE NOT seed UNION SELECT lineage, forward, frame + 1 FROM px WHERE NOT seed),
cand AS (SELECT DISTINCT lineage, frame, forward, px FROM px WHERE seed),
seeds AS (SELECT DISTINCT lineage, frame, forward FROM cand)
SELECT s.lineage, s.frame, s.forward,
  NOT EXISTS (SELECT 1 FROM cand c WHERE c.lineage = s.lineage AND c.frame = s.frame AND c.forward = s.forward AND NOT EXISTS (SELECT 1 FROM cov v WHERE v.lineage = c.lineage AND v.frame = c.frame AND v.px = c.px))
  AND (s.frame = CASE WHEN s.forward THEN {N_FRAMES // 20 - 1} ELSE 0 END
    OR EXISTS (SELECT 1 FROM obs o WHERE o.lineage = s.lineage AND o.forward = s.forward AND o.e = CASE WHEN s.forward THEN s.frame ELSE s.frame - 1 END)) AS handed FROM seeds s""",
    "prompt_support": f"""{V}, {PIX}, k AS (SELECT DISTINCT lineage, frame FROM px WHERE seed), u AS (SELECT DISTINCT lineage, frame, px FROM px JOIN k USING (lineage, frame))
SELECT lineage, frame, count(*) AS n_pixels, sum(px)::BIGINT AS sum_px FROM u GROUP BY lineage, frame""",
    "frontier_mailboxes": f"{V}, {OFFERS}, {BOXES} SELECT * FROM swept",
    "frontier_wave": f"""{V}, {OFFERS}, {BOXES}, g AS (SELECT *, CASE WHEN forward THEN 0 ELSE 1 END AS d FROM swept), f AS (SELECT d, sweep FROM g ORDER BY d, sweep LIMIT 1)
SELECT lineage, tile, frame, forward, g.sweep, score FROM g JOIN f ON g.d = f.d AND g.sweep = f.sweep ORDER BY lineage, tile, frame LIMIT 32""",
    "frontier_merge": f"""{V}, {OFFERS} SELECT lineage, tile, frame, forward, max(score) AS score, max(generation) AS generation, count(DISTINCT px) AS n_pixels,
  count(DISTINCT px) > count(DISTINCT CASE WHEN px % 2 = 0 THEN px END) AS dirty FROM offers GROUP BY ALL""",
    "monotonic_cut": f"""{V}, r AS (SELECT lineage, frame, sum(CASE WHEN forward THEN score ELSE 0 END)::BIGINT AS l, sum(CASE WHEN forward THEN 0 ELSE score END)::BIGINT AS r FROM frames GROUP BY lineage, frame),
x AS (SELECT lineage, frame, row_number() OVER o AS k, count(*) OVER p AS n, min(frame) OVER p AS lo, max(frame) OVER p AS hi, lead(frame) OVER o AS nx,
  sum(l) OVER (o ROWS UNBOUNDED PRECEDING) AS pre, sum(r) OVER p - sum(r) OVER (o ROWS UNBOUNDED PRECEDING) AS suf, sum(r) OVER p AS tr FROM r WINDOW o AS (PARTITION BY lineage ORDER BY frame), p AS (PARTITION BY lineage)),
c AS (SELECT lineage, k, n, lo, hi, (pre + suf)::DOUBLE AS value, coalesce((frame + nx) / 2.0::DOUBLE, frame + 0.5::DOUBLE) AS cut FROM x
  UNION ALL SELECT lineage, 0, n, lo, hi, tr::DOUBLE, lo - 0.5::DOUBLE FROM x WHERE k = 1),
o AS (SELECT *, abs(cut - (lo + hi) / 2.0::DOUBLE) AS off FROM c),
b AS (SELECT *, row_number() OVER (PARTITION BY lineage ORDER BY value - 1.0::DOUBLE * off / greatest(1, hi - lo + 1) DESC, off, k) AS nth FROM o)
SELECT lineage, k AS n_left, n AS n_shared FROM b WHERE nth = 1""",
}
