"""Centre lines over volumes of a hundred slices: vectors as slices of 8 by 8, or as slices of a tube with arms on 32 by 32."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratavox.operators import centerlines as ops
from stratavox.operators import groups
from stratavox.plans.masks import V, _cells
from stratavox.sources.tables import table

DEPTH = 100
SHAPE = (DEPTH, 8, 8)


def _solid(spark, sf, threshold=-0.08):
    return _cells(spark, sf, threshold).select(F.floor(F.col("t") / DEPTH).alias("volume"), (F.col("t") % DEPTH).alias("t"), "y", "x")


def mask_radii(spark, sf):
    return ops.radii(_solid(spark, sf), SHAPE)


def medial_ridges(spark, sf):
    return ops.medial(_solid(spark, sf), SHAPE).withColumn("r", F.round("r", 6))


def _tubes(spark, sf):
    """One disk a vector that goes to and fro in y with the slice; some slices have an arm, and a bit beyond it.

    The arm's length follows from the vector's first component.
    """
    rows = table(spark, sf, "embeddings").select(F.floor(F.col("vec_id") / DEPTH).alias("volume"), (F.col("vec_id") % DEPTH).alias("t"), F.floor(F.abs(F.get("embedding", F.lit(0)).cast("double")) * 6).alias("more"))
    # of a slice's vectors the farthest arm holds the others; the parts are kept apart, so that no voxel comes twice
    rows = groups.spread(rows, "volume", "t").groupBy("volume", "t").agg(F.max("more").alias("more"))
    rows = rows.withColumn("cy", 10 + F.floor(F.least(F.col("t") % 60, 60 - F.col("t") % 60) * 2 / 5)).withColumn("cx", 9 + F.col("volume") % 3)
    reach = lambda lo, hi: F.explode(F.sequence(F.lit(lo), hi if isinstance(hi, Column) else F.lit(hi)))
    disk = rows.withColumn("i", reach(-4, 4)).withColumn("j", reach(-4, 4)).where("i * i + j * j <= 16")
    arm = rows.where("t % 50 BETWEEN 22 AND 25").withColumn("i", reach(-2, 2)).withColumn("j", reach(4, F.col("more") + 15)).where("i * i + j * j > 16")
    bit = rows.where("t % 50 BETWEEN 19 AND 28").withColumn("i", reach(-3, 3)).withColumn("j", reach(10, 16)).where("NOT (t % 50 BETWEEN 22 AND 25 AND abs(i) <= 2 AND coalesce(j <= more + 15, false))")
    parts = [p.select("volume", "t", (F.col("cy") + F.col("i")).alias("y"), (F.col("cx") + F.col("j")).alias("x")) for p in (disk, arm, bit)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).where("y BETWEEN 0 AND 31 AND x BETWEEN 0 AND 31")


TUBE = (DEPTH, 32, 32)


def ridge_tracks(spark, sf):
    """Tracks over the ridges of all tubes along three axes."""
    mask = ops.checkpointed(_tubes(spark, sf))
    peaks = ops.checkpointed(ops.plane_peaks(ops.medial(mask, TUBE)))
    return ops.tracks(ops.links(peaks, mask)).withColumn("r", F.round("r", 6))


def center_lines(spark, sf):
    return ops.center_lines(ops.checkpointed(_tubes(spark, sf)), TUBE).drop("branch").withColumn("r", F.round("r", 6))


def normal_sections(spark, sf):
    """The state of the section across every sample, and how many voxels show an anomaly."""
    mask = ops.checkpointed(_tubes(spark, sf))
    samples = ops.checkpointed(ops.center_lines(mask, TUBE))
    found = ops.sections(samples, mask, TUBE, FACTOR).withColumn("n", F.size("evidence"))
    return found.join(samples.select("volume", "branch", "arc", "t", "y", "x"), ["volume", "branch", "arc"]).select("volume", "t", "y", "x", "state", "n")


def section_events(spark, sf):
    """Runs of anomalies along the centre lines of all tubes."""
    mask = ops.checkpointed(_tubes(spark, sf))
    return ops.anomaly_events(ops.sections(ops.center_lines(mask, TUBE), mask, TUBE, FACTOR)).drop("branch")


def filtered_center_lines(spark, sf):
    """What the filter removes of all tubes, and what it marks, pass by pass."""
    return ops.filter_center_lines(_tubes(spark, sf), TUBE, FACTOR, context=1)[1].groupBy("pass", "kind", "volume", "t").agg(F.count("*").alias("n"))


def basins(spark, sf):
    """Every slice flooded from its least and its greatest component (levels are hundredths, 100 for none)."""
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("slice"), F.posexplode("embedding").alias("pos", "v"))
    rows = rows.select("slice", F.floor(F.col("pos") / 8).alias("y"), (F.col("pos") % 8).cast("bigint").alias("x"), F.floor(F.col("v").cast("double") * 20).alias("level"))
    marks = rows.groupBy("slice").agg(F.min(F.struct("level", "y", "x")).alias("a"), F.max(F.struct("level", "y", "x")).alias("b")).select("slice", F.explode(F.array(F.struct("a.y", "a.x", F.lit(1).alias("label")), F.struct("b.y", "b.x", F.lit(2).alias("label")))).alias("m"))
    return ops.basins(rows, marks.select("slice", "m.*"))


def anomaly_runs(spark, sf):
    """Runs of flagged samples along twenty branches of orders, with unknown samples among them."""
    state = F.when(F.col("o_orderkey") % 17 == 0, "unknown").when(F.floor(F.col("o_totalprice") / 700) % 3 == 0, "anomaly").otherwise("clean")
    rows = table(spark, sf, "orders").select(F.lit(0).cast("bigint").alias("volume"), (F.col("o_orderkey") % 20).alias("branch"), F.floor(F.col("o_orderkey") / 20).alias("arc"), state.alias("state"))
    return ops.anomaly_events(rows)


FACTOR = 2.0
QUERIES = {f.__name__: f for f in (mask_radii, medial_ridges, ridge_tracks, center_lines, normal_sections, section_events, filtered_center_lines, anomaly_runs, basins)}

SOLID = f"""{V(-0.08)}, solid AS (SELECT t // {DEPTH} AS volume, t % {DEPTH} AS t, y::BIGINT AS y, x::BIGINT AS x FROM voxels),
grid AS (SELECT volume, t, y, x FROM (SELECT DISTINCT volume FROM solid), (SELECT unnest(range({DEPTH})) AS t), (SELECT unnest(range(8)) AS y), (SELECT unnest(range(8)) AS x)),
back AS (SELECT * FROM grid ANTI JOIN solid USING (volume, t, y, x)),
radii AS (SELECT s.volume, s.t, s.y, s.x, min((s.t - b.t) * (s.t - b.t) + (s.y - b.y) * (s.y - b.y) + (s.x - b.x) * (s.x - b.x))::BIGINT AS d2
  FROM solid s JOIN back b ON s.volume = b.volume AND b.t BETWEEN s.t - 4 AND s.t + 4 GROUP BY ALL)"""
ORACLES = {
    "mask_radii": f"{SOLID} SELECT * FROM radii",
    "medial_ridges": f"""{SOLID}, m AS (SELECT a.volume, a.t, a.y, a.x, a.d2, max(b.d2) AS top FROM radii a JOIN radii b ON a.volume = b.volume AND abs(a.t - b.t) <= 1 AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1
  AND (a.t = b.t OR a.y = b.y OR a.x = b.x) GROUP BY ALL), r AS (SELECT volume, t, y, x, greatest(0.5::DOUBLE, sqrt(d2) - 0.5) AS r FROM m WHERE d2 >= top),
k AS (SELECT *, count(*) FILTER (WHERE r >= 1.25) OVER (PARTITION BY volume) AS n FROM r)
SELECT volume, t, y, x, round(r, 6) AS r FROM k WHERE r >= CASE WHEN n >= 3 THEN 1.25 ELSE 0.5 END""",
    "anomaly_runs": """WITH s AS (SELECT o_orderkey % 20 AS branch, o_orderkey // 20 AS arc, CASE WHEN o_orderkey % 17 = 0 THEN 'unknown' WHEN floor(o_totalprice / 700)::BIGINT % 3 = 0 THEN 'anomaly' ELSE 'clean' END AS state FROM orders),
p AS (SELECT *, row_number() OVER w AS pos, count(*) FILTER (WHERE state = 'unknown') OVER w AS unknown, count(*) FILTER (WHERE state = 'clean') OVER (PARTITION BY branch ORDER BY arc ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) = 3 AS before,
  count(*) FILTER (WHERE state = 'clean') OVER (PARTITION BY branch ORDER BY arc ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) = 3 AS after FROM s WINDOW w AS (PARTITION BY branch ORDER BY arc)),
b AS (SELECT *, CASE WHEN pos - lag(pos) OVER w <= 3 AND unknown = lag(unknown) OVER w THEN 0 ELSE 1 END AS fresh FROM p WHERE state = 'anomaly' WINDOW w AS (PARTITION BY branch ORDER BY arc)),
e AS (SELECT *, sum(fresh) OVER (PARTITION BY branch ORDER BY arc) AS event FROM b)
SELECT 0::BIGINT AS volume, branch, event::BIGINT AS event, min(arc) AS arc0, max(arc) AS arc1, count(*) AS n, arg_min(before, arc) AS clean_left, arg_max(after, arc) AS clean_right FROM e GROUP BY branch, event HAVING count(*) >= 3""",
    "basins": """WITH RECURSIVE cells AS MATERIALIZED (
  SELECT vec_id AS slice, pos // 8 AS y, pos % 8 AS x, floor(v::DOUBLE * 20)::BIGINT AS level FROM (SELECT vec_id, unnest(range(0, len(embedding)::BIGINT)) AS pos, unnest(embedding) AS v FROM embeddings)
), marks AS MATERIALIZED (
  SELECT slice, y, x, 1 AS label FROM (SELECT *, row_number() OVER (PARTITION BY slice ORDER BY level, y, x) AS k FROM cells) WHERE k = 1
  UNION ALL SELECT slice, y, x, 2 FROM (SELECT *, row_number() OVER (PARTITION BY slice ORDER BY level DESC, y DESC, x DESC) AS k FROM cells) WHERE k = 1
), rise(slice, y, x, flat) USING KEY (slice, y, x) AS (
  SELECT slice, y, x, min(level) FROM cells JOIN marks USING (slice, y, x) GROUP BY ALL
  UNION
  SELECT c.slice, c.y, c.x, min(greatest(r.flat, c.level)) AS f
  FROM rise r JOIN cells c ON c.slice = r.slice AND abs(c.y - r.y) <= 1 AND abs(c.x - r.x) <= 1 LEFT JOIN recurring.rise o ON o.slice = c.slice AND o.y = c.y AND o.x = c.x
  GROUP BY c.slice, c.y, c.x, o.flat HAVING o.flat IS NULL OR min(greatest(r.flat, c.level)) < o.flat
), pixels AS MATERIALIZED (SELECT slice, y, x, level, flat FROM cells JOIN rise USING (slice, y, x)
), way(slice, y, x, hops, label) USING KEY (slice, y, x) AS (
  SELECT slice, y, x, 0, min(label) FROM marks GROUP BY slice, y, x
  UNION
  SELECT q.slice, q.y, q.x, min(w.hops) + 1, min(w.label)
  FROM way w JOIN pixels p ON p.slice = w.slice AND p.y = w.y AND p.x = w.x JOIN pixels q ON q.slice = w.slice AND abs(q.y - w.y) <= 1 AND abs(q.x - w.x) <= 1 AND q.flat = greatest(p.flat, q.level)
       LEFT JOIN recurring.way o ON o.slice = q.slice AND o.y = q.y AND o.x = q.x
  WHERE o.slice IS NULL GROUP BY q.slice, q.y, q.x
) SELECT slice, y, x, level, flat, label::BIGINT AS label FROM pixels JOIN way USING (slice, y, x)""",
}
