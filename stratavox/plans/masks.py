"""Mask operators over the voxels view: one slice of 8 by 8 a vector."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratavox.operators import masks as ops
from stratavox.sources.tables import sql, voxels

SIZE = 8


def _cells(spark, sf, threshold=0.0):
    return voxels(spark, sf, threshold).select(F.col("t").cast("bigint").alias("t"), F.col("y").cast("bigint").alias("y"), F.col("x").cast("bigint").alias("x"), "label", "v")


def _layers(spark, sf):
    rows = _cells(spark, sf)
    op = F.element_at(F.array(*map(F.lit, ("union", "select", "subtract", "union", "union", "select", "union", "subtract", "none", "union"))), (F.col("label") % 10 + 1).cast("int"))
    return rows.select((F.col("t") % 50).alias("t"), "y", "x", (F.col("label") % 10).alias("ord"), op.alias("op")).distinct()


def _tracks(spark, sf, threshold, shift):
    rows = _cells(spark, sf, threshold)
    return rows.select((F.col("t") % 5).alias("obj"), F.floor(F.col("t") / 5).alias("frame"), "y", ((F.col("x") + shift) % SIZE).alias("x"))


def mask_union(spark, sf):
    a = _layers(spark, sf)
    return ops.union(a.where("ord = 0"), a.where("ord = 3"), a.where("ord = 4"))


def mask_intersect(spark, sf):
    a = _layers(spark, sf)
    return ops.intersect(a.where("ord = 0"), a.where("ord = 3"))


def mask_subtract(spark, sf):
    a = _layers(spark, sf)
    return ops.subtract(a.where("ord = 0"), a.where("ord = 3"))


def mask_compose(spark, sf):
    return ops.compose(_layers(spark, sf))


def slice_boxes(spark, sf):
    return ops.slice_boxes(_cells(spark, sf, 0.1))


def mask_transpose(spark, sf):
    return ops.slice_boxes(ops.transpose(_cells(spark, sf, 0.2), ("y", "x", "t")))


def components_2d(spark, sf):
    return ops.components(_cells(spark, sf, 0.05), 8, SIZE)


def components_3d(spark, sf):
    return ops.components(_cells(spark, sf, 0.2), 26, SIZE)


def component_stats(spark, sf):
    out = ops.component_stats(ops.components(_cells(spark, sf, 0.1), 4, SIZE))
    return out.withColumn("cy", F.round("cy", 6)).withColumn("cx", F.round("cx", 6))


def keep_largest(spark, sf):
    return ops.keep_largest(ops.components(_cells(spark, sf, 0.2), 26, SIZE), 5).select("t", "y", "x", "root")


def confidence_filter(spark, sf):
    rows = _cells(spark, sf, 0.1)
    labelled = ops.components(rows, 8, SIZE).join(rows.select("t", "y", "x", "v"), ["t", "y", "x"])
    return ops.drop_faint(labelled, "v", 0.25).select("t", "y", "x")


def fill_holes(spark, sf):
    return ops.holes(_cells(spark, sf, 0.0), SIZE)


def void_fill_3d(spark, sf):
    return ops.voids(_cells(spark, sf, -0.03), 6, SIZE)


def radius_filter(spark, sf):
    return ops.drop_thin(_cells(spark, sf, 0.0), 1.5, SIZE)


def slice_cleanup(spark, sf):
    return ops.clean_slices(_cells(spark, sf, 0.0), "v", 0.3, 1.4, SIZE)


def component_totals(spark, sf):
    return ops.component_totals(_cells(spark, sf, 0.2), 18, SIZE)


def keep_centre(spark, sf):
    return ops.keep_centre(_cells(spark, sf, 0.15), 8, SIZE).select("t", "y", "x")


def gate_accepted(spark, sf):
    return ops.gate(ops.components(_cells(spark, sf, 0.1), 8, SIZE), _cells(spark, sf, 0.25)).select("t", "y", "x")


def gate_rejected(spark, sf):
    return ops.gate(ops.components(_cells(spark, sf, 0.1), 8, SIZE), _cells(spark, sf, 0.25), False).select("t", "y", "x")


def mask_dilate(spark, sf):
    return ops.slice_boxes(ops.dilate(_cells(spark, sf, 0.2), 26, SIZE))


def adjacency_pairs(spark, sf):
    return ops.adjacent_labels(_cells(spark, sf, 0.05), "label")


def endpoint_detect(spark, sf):
    labelled = ops.components(_cells(spark, sf, 0.15), 8, SIZE)
    return ops.endpoints(labelled, 1).withColumn("side", F.lit(1)).unionByName(ops.endpoints(labelled, -1).withColumn("side", F.lit(-1)))


def projection_candidates(spark, sf):
    labelled = ops.components(_cells(spark, sf, 0.2), 26, SIZE)
    last = labelled.groupBy("root").agg(F.max("t").alias("t"))
    tips = labelled.join(last, ["root", "t"]).groupBy("root", "t").agg(F.min(F.struct("y", "x")).alias("p")).select("root", "t", "p.y", "p.x")
    return ops.projections(tips, labelled, 4, 1.5, 3)


def row_runs(spark, sf):
    return ops.row_runs(_cells(spark, sf, 0.0))


def run_adjacency(spark, sf):
    return ops.run_adjacency(ops.row_runs(_cells(spark, sf, 0.0)))


def overlap_metrics(spark, sf):
    out = ops.overlap(_tracks(spark, sf, 0.0, 0), _tracks(spark, sf, 0.05, 1))
    return out.select(*(F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes))


def runner_up_margin(spark, sf):
    out = ops.margins(ops.overlap(_tracks(spark, sf, 0.0, 0), _tracks(spark, sf, 0.05, 0)), "iou_3d")
    return out.select("obj_l", "obj_r", F.round("iou_3d", 9).alias("iou_3d"), F.round("margin", 9).alias("margin"))


def mask_metrics(spark, sf):
    return ops.confusion(_cells(spark, sf, 0.05), _cells(spark, sf, 0.0), "t")


QUERIES = {
    f.__name__: f
    for f in (
        mask_union, mask_intersect, mask_subtract, mask_compose, slice_boxes, mask_transpose, components_2d, components_3d, component_stats, keep_largest, confidence_filter,
        fill_holes, void_fill_3d, radius_filter, slice_cleanup, component_totals, keep_centre, gate_accepted, gate_rejected, mask_dilate, adjacency_pairs, endpoint_detect, projection_candidates, row_runs, run_adjacency, overlap_metrics, runner_up_margin, mask_metrics,
    )
}


def V(threshold: float) -> str:
    return sql("voxels", threshold=threshold).replace("WITH ", "WITH RECURSIVE ", 1)


LAYERS = """layers AS (SELECT DISTINCT t % 50 AS t, y, x, label % 10 AS ord, ['union','select','subtract','union','union','select','union','subtract','none','union'][(label % 10 + 1)::INT] AS op FROM voxels)"""
#: Reachability within a slice or volume; ``near`` says which cells touch.
CODE = "(({a}.t * 8 + {a}.y) * 8 + {a}.x)"


def COMP(near: str, src: str = "voxels") -> str:
    return f"""reach AS (SELECT t, y, x, {CODE.format(a='v')} AS root FROM {src} v
  UNION SELECT n.t, n.y, n.x, r.root FROM reach r JOIN {src} n ON {near}),
comp AS (SELECT t, y, x, min(root)::BIGINT AS root FROM reach GROUP BY t, y, x)"""


N8 = "n.t = r.t AND n.y BETWEEN r.y - 1 AND r.y + 1 AND n.x BETWEEN r.x - 1 AND r.x + 1"
N4 = "n.t = r.t AND abs(n.y - r.y) + abs(n.x - r.x) = 1"
N6 = "abs(n.t - r.t) + abs(n.y - r.y) + abs(n.x - r.x) = 1"
N18 = "greatest(abs(n.t - r.t), abs(n.y - r.y), abs(n.x - r.x)) = 1 AND abs(n.t - r.t) + abs(n.y - r.y) + abs(n.x - r.x) <= 2 AND n.t BETWEEN r.t - 1 AND r.t + 1"
N26 = "n.t BETWEEN r.t - 1 AND r.t + 1 AND n.y BETWEEN r.y - 1 AND r.y + 1 AND n.x BETWEEN r.x - 1 AND r.x + 1"
ALL_BACK = "grid AS (SELECT t, y, x FROM (SELECT DISTINCT t FROM voxels), (SELECT unnest(range(8)) AS y), (SELECT unnest(range(8)) AS x)), back AS (SELECT g.* FROM grid g ANTI JOIN voxels USING (t, y, x))"
BOX = "min(y)::BIGINT AS y0, max(y)::BIGINT + 1 AS y1, min(x)::BIGINT AS x0, max(x)::BIGINT + 1 AS x1, count(*) AS area"
RUNS = "runs AS (SELECT t, y, min(x)::BIGINT AS x0, max(x)::BIGINT + 1 AS x1 FROM (SELECT t, y, x, x - row_number() OVER (PARTITION BY t, y ORDER BY x) AS g FROM voxels) GROUP BY t, y, g)"


def OVERLAP(shift: int) -> str:
    return f"""l AS (SELECT t % 5 AS obj, t // 5 AS frame, y, x FROM voxels), r AS (SELECT t % 5 AS obj, t // 5 AS frame, y, (x + {shift}) % 8 AS x FROM voxels WHERE v > 0.05),
al AS (SELECT obj AS obj_l, frame, count(*) AS area_l FROM l GROUP BY ALL), ar AS (SELECT obj AS obj_r, frame, count(*) AS area_r FROM r GROUP BY ALL),
i AS (SELECT l.obj AS obj_l, r.obj AS obj_r, frame, count(*) AS inter FROM l JOIN r USING (frame, y, x) GROUP BY ALL),
f AS (SELECT obj_l, obj_r, frame, area_l, area_r, coalesce(inter, 0) AS inter, area_l + area_r - coalesce(inter, 0) AS uni FROM al JOIN ar USING (frame) LEFT JOIN i USING (obj_l, obj_r, frame)),
o AS (SELECT obj_l, obj_r, count(*) AS n_frames, sum(inter)::BIGINT AS voxel_intersection, sum(uni)::BIGINT AS voxel_union, avg(inter / uni) AS frame_iou_mean, quantile_cont(inter / uni, 0.5) AS frame_iou_median,
  quantile_cont(inter / uni, 0.1) AS frame_iou_p10, min(inter / uni) AS frame_iou_min, max(inter / uni) AS frame_iou_max, quantile_cont(abs(ln(area_l / area_r)), 0.95) AS area_log_drift_p95,
  sum(inter) / sum(uni) AS iou_3d, 2 * sum(inter) / sum(area_l + area_r) AS dice_3d FROM f GROUP BY obj_l, obj_r)"""


def LAYER_SQL(body: str) -> str:
    return f"{V(0.0)}, {LAYERS}, u0 AS (SELECT DISTINCT t, y::BIGINT AS y, x::BIGINT AS x, ord, op FROM layers) {body}"


ORACLES = {
    "mask_union": LAYER_SQL("SELECT DISTINCT t, y, x FROM u0 WHERE ord IN (0, 3, 4)"),
    "mask_intersect": LAYER_SQL("SELECT t, y, x FROM u0 WHERE ord = 0 INTERSECT SELECT t, y, x FROM u0 WHERE ord = 3"),
    "mask_subtract": LAYER_SQL("SELECT t, y, x FROM u0 WHERE ord = 0 EXCEPT SELECT t, y, x FROM u0 WHERE ord = 3"),
    "mask_compose": LAYER_SQL("SELECT t, y, x FROM u0 WHERE op <> 'none' AND ord >= coalesce((SELECT max(ord) FROM u0 WHERE op = 'select'), -1) GROUP BY t, y, x HAVING arg_max(op, ord) <> 'subtract'"),
    "slice_boxes": f"{V(0.1)} SELECT t, {BOX} FROM voxels GROUP BY t",
    "mask_transpose": f"{V(0.2)}, m AS (SELECT y::BIGINT AS t, x::BIGINT AS y, t AS x FROM voxels) SELECT t, {BOX} FROM m GROUP BY t",
    "components_2d": f"{V(0.05)}, {COMP(N8)} SELECT t, y::BIGINT AS y, x::BIGINT AS x, root FROM comp",
    "components_3d": f"{V(0.2)}, {COMP(N26)} SELECT t, y::BIGINT AS y, x::BIGINT AS x, root FROM comp",
    "component_stats": f"""{V(0.1)}, {COMP(N4)}, s AS (SELECT root, count(*) AS area, min(y)::BIGINT AS y0, max(y)::BIGINT AS y1, min(x)::BIGINT AS x0, max(x)::BIGINT AS x1, avg(y) AS cy, avg(x) AS cx FROM comp GROUP BY root),
a AS (SELECT c.root, c.y, c.x, row_number() OVER (PARTITION BY c.root ORDER BY round(pow(c.y - s.cy, 2) + pow(c.x - s.cx, 2), 9), c.y, c.x) AS nth FROM comp c JOIN s USING (root))
SELECT s.root, area, y0, y1, x0, x1, round(cy, 6) AS cy, round(cx, 6) AS cx, a.y::BIGINT AS anchor_y, a.x::BIGINT AS anchor_x FROM s JOIN a ON s.root = a.root AND nth = 1""",
    "keep_largest": f"{V(0.2)}, {COMP(N26)}, s AS (SELECT root, count(*) AS n FROM comp GROUP BY root ORDER BY n DESC, root DESC LIMIT 5) SELECT t, y::BIGINT AS y, x::BIGINT AS x, root FROM comp SEMI JOIN s USING (root)",
    "confidence_filter": f"{V(0.1)}, {COMP(N8)}, j AS (SELECT c.*, v.v FROM comp c JOIN voxels v USING (t, y, x)) SELECT t, y::BIGINT AS y, x::BIGINT AS x FROM j WHERE root IN (SELECT root FROM j GROUP BY root HAVING max(v) >= 0.25)",
    "fill_holes": f"""{V(0.0)}, grid AS (SELECT t, y, x FROM (SELECT DISTINCT t FROM voxels), (SELECT unnest(range(8)) AS y), (SELECT unnest(range(8)) AS x)),
back AS (SELECT g.* FROM grid g ANTI JOIN voxels v USING (t, y, x)),
out_ AS (SELECT t, y, x FROM back WHERE y IN (0, 7) OR x IN (0, 7) UNION SELECT n.t, n.y, n.x FROM out_ r JOIN back n ON {N4})
SELECT b.t, b.y, b.x FROM back b ANTI JOIN out_ o USING (t, y, x)""",
    "void_fill_3d": f"""{V(-0.03)}, span AS (SELECT min(t) AS a, max(t) AS b FROM voxels), grid AS (SELECT t, y, x FROM (SELECT unnest(range(a, b + 1)) AS t FROM span), (SELECT unnest(range(8)) AS y), (SELECT unnest(range(8)) AS x)),
back AS (SELECT g.* FROM grid g ANTI JOIN voxels v USING (t, y, x)), steps AS (SELECT * FROM (VALUES (1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1)) AS s(dt, dy, dx)),
out_ AS (SELECT t, y, x FROM back, span WHERE y IN (0, 7) OR x IN (0, 7) OR t IN (a, b) UNION SELECT n.t, n.y, n.x FROM (SELECT t + dt AS t, y + dy AS y, x + dx AS x FROM out_, steps) r JOIN back n ON n.t = r.t AND n.y = r.y AND n.x = r.x)
SELECT b.t, b.y, b.x FROM back b ANTI JOIN out_ o USING (t, y, x)""",
    "radius_filter": f"""{V(0.0)}, {COMP(N8)}, {ALL_BACK}, far AS (SELECT c.t, c.y, c.x, c.root, min(pow(c.y - b.y, 2) + pow(c.x - b.x, 2)) AS d2 FROM comp c LEFT JOIN back b ON b.t = c.t GROUP BY ALL)
SELECT t, y::BIGINT AS y, x::BIGINT AS x FROM comp WHERE root IN (SELECT root FROM far GROUP BY root HAVING coalesce(max(d2), 1e9) >= 2.25)""",
    "slice_cleanup": f"""{V(0.0)}, {COMP(N8)}, strong AS (SELECT * FROM comp WHERE root IN (SELECT c.root FROM comp c JOIN voxels v USING (t, y, x) GROUP BY c.root HAVING max(v.v) >= 0.3)),
grid AS (SELECT t, y, x FROM (SELECT DISTINCT t FROM voxels), (SELECT unnest(range(8)) AS y), (SELECT unnest(range(8)) AS x)), back AS (SELECT g.* FROM grid g ANTI JOIN strong USING (t, y, x)),
far AS (SELECT c.t, c.y, c.x, c.root, min(pow(c.y - b.y, 2) + pow(c.x - b.x, 2)) AS d2 FROM strong c LEFT JOIN back b ON b.t = c.t GROUP BY ALL),
thick AS (SELECT t, y, x FROM strong WHERE root IN (SELECT root FROM far GROUP BY root HAVING coalesce(max(d2), 1e9) >= 1.96)),
empty_ AS (SELECT g.* FROM grid g ANTI JOIN thick USING (t, y, x)), out_ AS (SELECT t, y, x FROM empty_ WHERE y IN (0, 7) OR x IN (0, 7) UNION SELECT n.t, n.y, n.x FROM out_ r JOIN empty_ n ON {N4})
SELECT t, y::BIGINT AS y, x::BIGINT AS x FROM thick UNION ALL SELECT e.t, e.y, e.x FROM empty_ e ANTI JOIN out_ o USING (t, y, x)""",
    "component_totals": f"{V(0.2)}, {COMP(N18)} SELECT root, count(*) AS voxels, min(t)::BIGINT AS t0, max(t)::BIGINT + 1 AS t1, min(y)::BIGINT AS y0, max(y)::BIGINT + 1 AS y1, min(x)::BIGINT AS x0, max(x)::BIGINT + 1 AS x1 FROM comp GROUP BY root",
    "keep_centre": f"""{V(0.15)}, {COMP(N8)}, near AS (SELECT t, root, min(pow(y - 4, 2) + pow(x - 4, 2)) AS d2 FROM comp GROUP BY t, root), best AS (SELECT root, row_number() OVER (PARTITION BY t ORDER BY d2, root) AS nth FROM near)
SELECT t, y::BIGINT AS y, x::BIGINT AS x FROM comp WHERE root IN (SELECT root FROM best WHERE nth = 1)""",
    "gate_accepted": f"{V(0.1)}, {COMP(N8)} SELECT t, y::BIGINT AS y, x::BIGINT AS x FROM comp WHERE root IN (SELECT c.root FROM comp c JOIN voxels v USING (t, y, x) WHERE v.v > 0.25)",
    "gate_rejected": f"{V(0.1)}, {COMP(N8)} SELECT t, y::BIGINT AS y, x::BIGINT AS x FROM comp WHERE root NOT IN (SELECT c.root FROM comp c JOIN voxels v USING (t, y, x) WHERE v.v > 0.25)",
    "mask_dilate": f"""{V(0.2)}, d AS (SELECT unnest([-1, 0, 1]) AS d), m AS (SELECT DISTINCT t + a.d AS t, y + b.d AS y, x + c.d AS x FROM voxels, d a, d b, d c)
SELECT t, {BOX} FROM m WHERE t >= 0 AND y BETWEEN 0 AND 7 AND x BETWEEN 0 AND 7 GROUP BY t""",
    "adjacency_pairs": f"{V(0.05)} SELECT DISTINCT a.t, a.label AS a, b.label AS b FROM voxels a JOIN voxels b ON b.t = a.t + 1 AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1",
    "endpoint_detect": f"""{V(0.15)}, {COMP(N8)}, s AS (SELECT unnest([1, -1]) AS side), k AS (SELECT DISTINCT t, root FROM comp)
SELECT k.t, k.root, side FROM k, s WHERE NOT EXISTS (SELECT 1 FROM comp a JOIN comp b ON b.t = a.t + side AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 WHERE a.root = k.root)""",
    "projection_candidates": f"""{V(0.2)}, {COMP(N26)}, l AS (SELECT root, max(t) AS t FROM comp GROUP BY root),
tips AS (SELECT root, t, y, x FROM (SELECT c.*, row_number() OVER (PARTITION BY c.root ORDER BY c.y, c.x) AS nth FROM comp c JOIN l USING (root, t)) WHERE nth = 1),
p AS (SELECT a.root, b.root AS target, b.t - a.t AS step, (pow(a.y - b.y, 2) + pow(a.x - b.x, 2))::BIGINT AS d2 FROM tips a JOIN comp b ON b.t BETWEEN a.t + 1 AND a.t + 4 AND a.root <> b.root),
q AS (SELECT *, row_number() OVER (PARTITION BY root, target ORDER BY step, d2) AS k FROM p WHERE d2 <= pow(1.5 * step, 2)),
w AS (SELECT *, row_number() OVER (PARTITION BY root ORDER BY step, d2, target) AS nth FROM q WHERE k = 1) SELECT root, target, step::INT AS step, d2 FROM w WHERE nth <= 3""",
    "row_runs": f"{V(0.0)}, {RUNS} SELECT t, y::BIGINT AS y, x0, x1 FROM runs",
    "run_adjacency": f"{V(0.0)}, {RUNS} SELECT a.t, a.y::BIGINT AS y, a.x0, a.x1, b.x0 AS b0, b.x1 AS b1 FROM runs a JOIN runs b ON a.t = b.t AND b.y = a.y + 1 WHERE a.x0 < b.x1 + 1 AND b.x0 < a.x1 + 1",
    "overlap_metrics": f"""{V(0.0)}, {OVERLAP(1)} SELECT obj_l, obj_r, n_frames, voxel_intersection, voxel_union, round(frame_iou_mean, 9) AS frame_iou_mean, round(frame_iou_median, 9) AS frame_iou_median,
  round(frame_iou_p10, 9) AS frame_iou_p10, round(frame_iou_min, 9) AS frame_iou_min, round(frame_iou_max, 9) AS frame_iou_max, round(area_log_drift_p95, 9) AS area_log_drift_p95, round(iou_3d, 9) AS iou_3d, round(dice_3d, 9) AS dice_3d FROM o""",
    "runner_up_margin": f"""{V(0.0)}, {OVERLAP(0)} SELECT a.obj_l, a.obj_r, round(a.iou_3d, 9) AS iou_3d, round(a.iou_3d - max(b.iou_3d), 9) AS margin
FROM o a LEFT JOIN o b ON (a.obj_l = b.obj_l) <> (a.obj_r = b.obj_r) GROUP BY a.obj_l, a.obj_r, a.iou_3d""",
    "mask_metrics": f"""{V(0.0)}, j AS (SELECT t, count(*) FILTER (WHERE v > 0.05) AS tp, 0::BIGINT AS fp, count(*) FILTER (WHERE v <= 0.05) AS fn FROM voxels GROUP BY t)
SELECT t, tp, fp, fn, CASE WHEN tp + fp + fn = 0 THEN 1.0 ELSE tp / (tp + fp + fn) END::DOUBLE AS iou, CASE WHEN 2 * tp + fp + fn = 0 THEN 1.0 ELSE 2 * tp / (2 * tp + fp + fn) END::DOUBLE AS dice,
  CASE WHEN tp + fp = 0 THEN 1.0 ELSE tp / (tp + fp) END::DOUBLE AS precision, CASE WHEN tp + fn = 0 THEN 1.0 ELSE tp / (tp + fn) END::DOUBLE AS recall FROM j""",
}
