"""Parsing, tracks and ledgers over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratavox.functions import hashing, parsing
from stratavox.operators import masks
from stratavox.operators import tracks as ops
from stratavox.operators.geometry import tile_grid
from stratavox.plans.geometry import GRID, _canvases
from stratavox.plans.masks import OVERLAP, V, _cells, _tracks
from stratavox.sources.tables import table

SIZE = 1008


def parse_parameters(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("int").alias("s"), "p_name")
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    s = F.col("s")
    return rows.select(
        "p_partkey",
        F.array_join(F.transform(parsing.angles(text(s * 20, ", ", s * 20 + 360, "  ", -s)), lambda a: a.cast("long").cast("string")), ",").alias("angles"),
        F.array_join(parsing.index_ranges(text(s, "-", s + 3, ",", s + 2, ",1")), ",").alias("indices"),
        F.array_join(parsing.channel_format(text("C", s, "S2")), ",").alias("offsets"),
        F.array_join(parsing.tokens(text("a,", F.col("p_name"), ",a")), "|").alias("tokens"),
        parsing.natural_key(text("Vol", s, "_", F.col("p_partkey"))).alias("natural"),
    )


def augmentation_tags(spark, sf):
    digest = hashing.joined_digest(F.lit("PTA-v4"), F.lit("tag"), F.lit("cafe"), F.col("p_partkey"), F.lit(1), F.lit(0))
    return table(spark, sf, "part").select("p_partkey", digest.alias("digest")).select("p_partkey", "digest", parsing.base62("digest").alias("tag"))


def tile_owners(spark, sf):
    k = F.col("p_partkey")
    boxes = table(spark, sf, "part").select(F.col("p_size").cast("bigint").alias("canvas"), k.alias("obj"), (k * 37 % 600).alias("x0"), (k * 53 % 600).alias("y0"))
    boxes = boxes.select("canvas", "obj", "x0", "y0", (F.col("x0") + 20 + F.col("obj") * 11 % 900).alias("x1"), (F.col("y0") + 20 + F.col("obj") * 7 % 700).alias("y1"))
    return ops.tile_owners(boxes, tile_grid(_canvases(spark, sf)), SIZE)


def geometry_gates(spark, sf):
    pairs = masks.overlap(_tracks(spark, sf, 0.0, 0), _tracks(spark, sf, 0.05, 1))
    gates = {"iou_3d_below_minimum": F.col("iou_3d") >= 0.27, "frame_iou_below_minimum": F.col("frame_iou_median") >= 0.28, "area_drift_above_maximum": F.col("area_log_drift_p95") <= 0.9}
    score = ops.similarity({"iou_3d": 2.0, "dice_3d": 1.0, "frame_iou_median": 1.0})
    return pairs.select("obj_l", "obj_r", F.array_join(ops.gate_failures(gates), ",").alias("failures"), F.round(score, 9).alias("similarity"))


def union_hypotheses(spark, sf):
    return ops.union_hypotheses(_tracks(spark, sf, 0.05, 0), _tracks(spark, sf, 0.1, 0))


def residual_hypotheses(spark, sf):
    """Splits and merges of twelve tracks on one side and twenty on the other."""
    rows = _cells(spark, sf, 0.05)
    side = lambda n, shift: rows.select((F.col("t") % n).alias("obj"), F.floor(F.col("t") / 60).alias("frame"), "y", ((F.col("x") + shift) % 8).alias("x")).distinct()
    found = ops.residual_hypotheses(side(12, 0), side(20, 1))
    return found.select("kind", "obj", F.array_join("members", ",").alias("members"), F.round("iou", 9).alias("iou"), F.round("gain", 9).alias("gain"))


def centerline_events(spark, sf):
    rows = table(spark, sf, "orders").select((F.col("o_orderkey") % 20).alias("branch"), F.floor(F.col("o_orderkey") / 20).alias("arc"), (F.floor(F.col("o_totalprice") / 700) % 4 == 0).alias("bad"))
    return ops.flagged_runs(rows, least=3, gap=2, flank=3)


def ridge_peaks(spark, sf):
    return ops.peaks(_cells(spark, sf, 0.1).withColumnRenamed("v", "r"), 2).select("t", "y", "x")


def session_packing(spark, sf):
    rows = table(spark, sf, "lineitem").select((F.col("l_orderkey") % 200).alias("key"), F.col("l_linenumber").cast("bigint").alias("obj"), (F.col("l_partkey") % 64).alias("px"))
    return ops.pack_sessions(rows.groupBy("key", "obj").agg(F.array_sort(F.collect_set("px")).alias("pixels")), most=3, exclusive=0.5)


def packet_ledger(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("work_id"), F.sha2(F.concat_ws(":", "l_partkey", "l_linenumber"), 256).alias("sha256"))
    done = table(spark, sf, "orders").where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("work_id"))
    return ops.new_packets(rows, done)


QUERIES = {f.__name__: f for f in (parse_parameters, augmentation_tags, tile_owners, geometry_gates, union_hypotheses, residual_hypotheses, centerline_events, ridge_peaks, session_packing, packet_ledger)}

ORACLES = {
    "parse_parameters": """WITH p AS (SELECT p_partkey, p_size::INT AS s, p_name FROM part)
SELECT p_partkey,
  CASE WHEN (s * 20) % 360 = (360 - s) % 360 THEN ((s * 20) % 360)::VARCHAR ELSE ((s * 20) % 360)::VARCHAR || ',' || ((360 - s) % 360)::VARCHAR END AS angles,
  array_to_string(list_sort(list_distinct([s, s + 1, s + 2, s + 3, 1])), ',') AS indices,
  CASE WHEN s % 2 = 1 THEN array_to_string([x * 2 for x in range(-(s // 2), s // 2 + 1)], ',') END AS offsets,
  'a|' || array_to_string(list_filter(string_split(p_name, ' '), lambda w: w <> 'a'), '|') AS tokens,
  'vol' || lpad(s::VARCHAR, 20, '0') || '_' || lpad(p_partkey::VARCHAR, 20, '0') AS natural FROM p""",
    "tile_owners": f"""WITH {GRID}, b0 AS (SELECT p_size::BIGINT AS canvas, p_partkey AS obj, p_partkey * 37 % 600 AS x0, p_partkey * 53 % 600 AS y0 FROM part),
b AS (SELECT *, x0 + 20 + obj * 11 % 900 AS x1, y0 + 20 + obj * 7 % 700 AS y1 FROM b0),
j AS (SELECT b.canvas, obj, tile, least(x0 - "left", y0 - "top", "left" + 1008 - x1, "top" + 1008 - y1) AS margin FROM b JOIN tiles t ON b.canvas = t.canvas AND x0 < "left" + 1008 AND x1 > "left" AND y0 < "top" + 1008 AND y1 > "top"),
k AS (SELECT *, max(margin) OVER (PARTITION BY canvas, obj) AS best, row_number() OVER (PARTITION BY canvas, obj ORDER BY margin DESC, tile) AS nth FROM j)
SELECT canvas, obj, tile FROM k WHERE best < 0 OR nth = 1""",
    "geometry_gates": f"""{V(0.0)}, {OVERLAP(1)} SELECT obj_l, obj_r, array_to_string(list_filter([CASE WHEN iou_3d < 0.27 THEN 'iou_3d_below_minimum' END, CASE WHEN frame_iou_median < 0.28 THEN 'frame_iou_below_minimum' END,
  CASE WHEN area_log_drift_p95 > 0.9 THEN 'area_drift_above_maximum' END], lambda x: x IS NOT NULL), ',') AS failures, round((2 * iou_3d + dice_3d + frame_iou_median) / 4, 9) AS similarity FROM o""",
    "union_hypotheses": f"""{V(0.05)}, l AS (SELECT t % 5 AS obj, t // 5 AS frame, y, x FROM voxels), r AS (SELECT t % 5 AS obj, t // 5 AS frame, y, x FROM voxels WHERE v > 0.1),
one AS (SELECT a.obj AS obj_l, b.obj AS obj_r, count(*) AS inter FROM l a JOIN r b USING (frame, y, x) GROUP BY ALL),
iou AS (SELECT obj_l, obj_r, inter / ((SELECT count(*) FROM l WHERE obj = obj_l) + (SELECT count(*) FROM r WHERE obj = obj_r) - inter) AS iou FROM one),
best AS (SELECT *, row_number() OVER (PARTITION BY obj_l ORDER BY iou DESC, obj_r) AS nth FROM iou QUALIFY nth <= 4),
pairs AS (SELECT a.obj_l, a.obj_r AS a, b.obj_r AS b, greatest(a.iou, b.iou) AS top FROM best a JOIN best b ON a.obj_l = b.obj_l AND a.obj_r < b.obj_r),
un AS (SELECT DISTINCT obj_l, a, b, top, frame, y, x FROM pairs JOIN r ON r.obj IN (a, b)),
s AS (SELECT u.obj_l, a, b, top, count(*) AS n_u, count(l.obj) AS inter FROM un u LEFT JOIN l ON l.obj = u.obj_l AND l.frame = u.frame AND l.y = u.y AND l.x = u.x GROUP BY ALL),
g AS (SELECT obj_l, a, b, round(inter / ((SELECT count(*) FROM l WHERE obj = obj_l) + n_u - inter) - top, 9) AS gain FROM s)
SELECT obj_l, a, b, gain FROM g QUALIFY row_number() OVER (PARTITION BY obj_l ORDER BY gain DESC, a, b) = 1""",
    "centerline_events": """WITH s AS (SELECT o_orderkey % 20 AS branch, o_orderkey // 20 AS arc, floor(o_totalprice / 700)::BIGINT % 4 = 0 AS bad FROM orders),
b AS (SELECT branch, arc, CASE WHEN arc - lag(arc) OVER w > 3 OR lag(arc) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM s WHERE bad WINDOW w AS (PARTITION BY branch ORDER BY arc)),
n AS (SELECT *, sum(new) OVER (PARTITION BY branch ORDER BY arc ROWS UNBOUNDED PRECEDING) AS run FROM b),
r AS (SELECT branch, run, min(arc) AS start, max(arc) AS stop, count(*) AS n FROM n GROUP BY branch, run)
SELECT branch, start, stop, n FROM r WHERE stop - start + 1 >= 3 AND start - 3 >= (SELECT min(arc) FROM s WHERE s.branch = r.branch) AND stop + 3 <= (SELECT max(arc) FROM s WHERE s.branch = r.branch)
  AND NOT EXISTS (SELECT 1 FROM s WHERE s.branch = r.branch AND bad AND (arc BETWEEN r.start - 3 AND r.start - 1 OR arc BETWEEN r.stop + 1 AND r.stop + 3))""",
    "augmentation_tags": f"""WITH d AS (SELECT p_partkey, sha256(concat_ws(chr(0), 'PTA-v4', 'tag', 'cafe', p_partkey::VARCHAR, '1', '0')) AS digest FROM part),
v AS (SELECT *, list_reduce(list_concat([0::HUGEINT], list_transform(string_split(digest, ''), lambda c: (strpos('0123456789abcdef', c) - 1)::HUGEINT)), lambda a, d: (a * 16 + d) % {len(parsing.TAG_ALPHABET) ** parsing.TAG_LENGTH}::HUGEINT) AS value FROM d)
SELECT p_partkey, digest, {" || ".join(f"substr('{parsing.TAG_ALPHABET}', (value // {len(parsing.TAG_ALPHABET) ** k}::HUGEINT % {len(parsing.TAG_ALPHABET)})::INT + 1, 1)" for k in reversed(range(parsing.TAG_LENGTH)))} AS tag FROM v""",
    "ridge_peaks": f"""{V(0.1)}, p AS (SELECT t, y, x, row_number() OVER (PARTITION BY t ORDER BY v DESC, y, x) AS k FROM voxels),
walk AS (SELECT DISTINCT t, 0::BIGINT AS k, []::STRUCT(y INT, x INT)[] AS kept FROM p
  UNION ALL SELECT w.t, p.k, CASE WHEN len(list_filter(w.kept, lambda q: (q.y - p.y) * (q.y - p.y) + (q.x - p.x) * (q.x - p.x) <= 4)) = 0 THEN list_append(w.kept, {{'y': p.y, 'x': p.x}}) ELSE w.kept END FROM walk w JOIN p ON p.t = w.t AND p.k = w.k + 1),
last AS (SELECT t, unnest(arg_max(kept, k)) AS q FROM walk GROUP BY t)
SELECT t, q.y::BIGINT AS y, q.x::BIGINT AS x FROM last""",
    "session_packing": """WITH RECURSIVE o AS (SELECT l_orderkey % 200 AS key, l_linenumber::BIGINT AS obj, list_distinct(list(l_partkey % 64)) AS px FROM lineitem GROUP BY ALL),
p AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY obj) AS k FROM o),
walk AS (SELECT DISTINCT key, 0::BIGINT AS k, NULL::BIGINT AS obj, NULL::BIGINT AS session, []::STRUCT(px BIGINT[], n INT)[] AS all_ FROM p
  UNION ALL SELECT key, k, obj, coalesce(slot, len(all_) + 1) - 1, CASE WHEN slot IS NULL THEN list_append(all_, {'px': px, 'n': 1}) ELSE list_transform(all_, lambda s, i: CASE WHEN i = slot THEN {'px': list_distinct(list_concat(s.px, px)), 'n': s.n + 1} ELSE s END) END
  FROM (SELECT w.key, p.k, p.obj, p.px, w.all_, nullif(coalesce(list_position(list_transform(w.all_, lambda s: s.n < 3 AND len(list_filter(p.px, lambda v: NOT list_contains(s.px, v))) >= 0.5 * len(p.px)), true), 0), 0) AS slot FROM walk w JOIN p ON p.key = w.key AND p.k = w.k + 1))
SELECT key, obj, session::BIGINT AS session FROM walk WHERE k > 0""",
    "residual_hypotheses": f"""{V(0.05)}, sides AS (SELECT 'split' AS kind, 'one' AS part, t % 12 AS obj, t // 60 AS frame, y, x FROM voxels UNION SELECT 'split', 'many', t % 20, t // 60, y, (x + 1) % 8 FROM voxels
  UNION SELECT 'merge', 'many', t % 12, t // 60, y, x FROM voxels UNION SELECT 'merge', 'one', t % 20, t // 60, y, (x + 1) % 8 FROM voxels),
sizes AS (SELECT kind, part, obj, count(*) AS n FROM sides GROUP BY ALL),
i AS (SELECT a.kind, a.obj, b.obj AS other, count(*) AS inter FROM sides a JOIN sides b ON a.kind = b.kind AND a.part = 'one' AND b.part = 'many' AND a.frame = b.frame AND a.y = b.y AND a.x = b.x GROUP BY ALL),
r AS (SELECT i.kind, i.obj, other, inter / (s.n + m.n - inter) AS iou, s.n, row_number() OVER (PARTITION BY i.kind, i.obj ORDER BY inter / (s.n + m.n - inter) DESC, other) - 1 AS bit
  FROM i JOIN sizes s ON s.kind = i.kind AND s.part = 'one' AND s.obj = i.obj JOIN sizes m ON m.kind = i.kind AND m.part = 'many' AND m.obj = other),
s AS (SELECT kind, obj, other, iou, n, bit, m AS pick FROM r, (SELECT unnest(range(16)) AS m) WHERE bit < 4 AND bit_count(m::INT) BETWEEN 2 AND 3 AND m & (1 << bit) <> 0),
k AS (SELECT kind, obj, pick, any_value(n) AS n, count(*) AS size, max(iou) AS single, string_agg(other::VARCHAR, ',' ORDER BY other) AS members FROM s GROUP BY ALL HAVING count(*) = bit_count(pick::INT)),
u AS (SELECT DISTINCT s.kind, s.obj, s.pick, b.frame, b.y, b.x FROM s JOIN sides b ON b.kind = s.kind AND b.part = 'many' AND b.obj = s.other),
c AS (SELECT u.kind, u.obj, u.pick, count(*) AS whole, count(a.obj) AS inter FROM u LEFT JOIN sides a ON a.kind = u.kind AND a.part = 'one' AND a.obj = u.obj AND a.frame = u.frame AND a.y = u.y AND a.x = u.x GROUP BY ALL),
b AS (SELECT k.*, c.inter / (k.n + whole - c.inter) AS iou, row_number() OVER (PARTITION BY k.kind, k.obj ORDER BY round(c.inter / (k.n + whole - c.inter), 12) DESC, size, k.pick) AS nth FROM k JOIN c ON c.kind = k.kind AND c.obj = k.obj AND c.pick = k.pick)
SELECT kind, obj, members, round(iou, 9) AS iou, round(iou - single, 9) AS gain FROM b WHERE nth = 1 AND iou > single""",
    "packet_ledger": """WITH p AS (SELECT l_orderkey AS work_id, sha256(l_partkey::VARCHAR || ':' || l_linenumber::VARCHAR) AS sha256 FROM lineitem)
SELECT work_id, min(sha256) AS sha256 FROM p WHERE work_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY work_id""",
}
