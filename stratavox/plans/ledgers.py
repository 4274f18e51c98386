"""Ledgers and selections over offers from events, packets from lineitem, candidates from documents and masks from embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratavox.operators import ledgers as ops
from stratavox.operators import geometry, masks, planning, temporal
from stratavox.plans.masks import COMP, N8, V, _cells
from stratavox.plans.planning import AUG, BGA, C, CONTENT, SPLIT_SQL
from stratavox.plans.temporal import EDGES, OFFERS, _edges, _offers, session_windows
from stratavox.plans.temporal import ORACLES as TEMPORAL
from stratavox.plans.views import GRAYS, MASK, SHAPES, _grays, _masks, _shapes
from stratavox.sources.tables import candidates, frames, sql, table

KEYS = ["lineage", "tile", "frame", "forward"]


def _mailboxes(spark, sf, condition="true"):
    rows = _offers(spark, sf).where(condition).groupBy(*KEYS).agg(F.collect_set("px").alias("px"), F.count_distinct("px").alias("n_pixels"))
    return rows.select(*KEYS, "n_pixels", ops.revision(F.col("px")).alias("revision"), (F.col("n_pixels") > 1).alias("dirty"))


def frontier_acknowledge(spark, sf):
    leased = _mailboxes(spark, sf, "px % 2 = 0").where("frame % 3 = 0")
    return ops.acknowledge(_mailboxes(spark, sf), leased, KEYS).select(*KEYS, "dirty")


def frontier_stats(spark, sf):
    return ops.frontier_stats(_mailboxes(spark, sf))


def _packets(spark, sf):
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("work_id"), F.when(F.col("l_orderkey") % 7 == 0, F.col("l_linenumber")).otherwise(0).cast("string").alias("sha256"), (F.col("l_partkey") % 20).alias("lineage"), (F.col("l_suppkey") % 50).alias("frame"), (F.col("l_quantity").cast("bigint") % 8).alias("px"))


def _known(spark, sf):
    rows = _packets(spark, sf).where("work_id % 3 = 0").select("work_id").distinct()
    return rows.select("work_id", F.when(F.col("work_id") % 2 == 0, "0").otherwise("9").alias("sha256"))


def packet_status(spark, sf):
    return ops.packet_status(_packets(spark, sf), _known(spark, sf))


def coverage_masks(spark, sf):
    packets = _packets(spark, sf)
    held = packets.where("work_id % 3 = 0 AND px < 2")
    return ops.ingest_masks(held, packets, packet_status(spark, sf), ["lineage", "frame"]).groupBy("lineage", "frame").agg(F.count("*").alias("n_pixels"), F.sum("px").alias("sum_px"))


def coverage_stats(spark, sf):
    rows = frames(spark, sf)
    edges = temporal.merge_intervals(_edges(spark, sf), ["lineage", "forward"])
    return ops.coverage_stats(rows.select("lineage", "frame", (F.col("score") % 4).alias("px")).distinct(), edges)


def union_frames(spark, sf):
    rows = frames(spark, sf).select((F.col("lineage") % 50).alias("lineage"), F.floor(F.col("frame") / 20).alias("frame"), (F.col("event_id") % 16).alias("px"), F.col("score").alias("prob"), (F.col("score") > 90).alias("authoritative"))
    return ops.union_frames(rows, "lineage")


def composed_sources(spark, sf):
    rows = frames(spark, sf).select((F.col("lineage") % 40).alias("lineage"), F.floor(F.col("frame") / 40).alias("frame"), "forward", "score")
    rows = rows.groupBy("lineage", "frame", "forward").agg((F.max("score") > 90).alias("authoritative"), (F.max("score") % 3).cast("string").alias("revision"))
    cut = rows.groupBy("lineage").agg(F.floor((F.min("frame") + F.max("frame")) / 2).alias("cut"))
    return ops.composed_sources(rows.where("forward"), rows.where("NOT forward"), cut)


def withheld_overage(spark, sf):
    rows = planning.augment(planning.split(candidates(spark, sf)), 2.3, CONTENT, F.col("split_subset") == "train")
    rows = rows.withColumn("keep", F.lit(True))
    flips = spark.createDataFrame([("train", 120), ("val", 0)], "split_subset string, flips long")
    return ops.withhold_overage(rows, flips, 0.4).select("doc_id", "augmentation_index", "split_subset", "keep")


def row_offsets(spark, sf):
    counts = _cells(spark, sf, 0.0).groupBy("t", "y").agg(F.count("*").alias("n"))
    return ops.offsets_of(counts, "y", "t")


def round_robin(spark, sf):
    plans = _shapes(spark, sf).select(F.col("volume").alias("plan"), F.col("n_t").alias("num_slices"))
    eligible = _shapes(spark, sf).where("volume % 3 = 0").select(F.col("volume").alias("plan"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_t") * 2, F.col("volume") + 1)).alias("frame"))
    return ops.round_robin(plans, eligible)


def annotation_class(spark, sf):
    rows = candidates(spark, sf)
    return ops.annotation_class(rows.select(F.concat("volume_name", F.lit("/"), (F.col("doc_id") % 97).cast("string")).alias("volume"), F.col("annotation_state").alias("state")))


def aligned_labels(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("volume"), F.col("o_orderkey").alias("number"))
    images = orders.select("volume", "number", (F.row_number().over(masks.Window.partitionBy("volume").orderBy("number")) - 1).cast("bigint").alias("frame"))
    labels = orders.where("number % 3 = 0").select("volume", "number", F.concat("volume", F.lit("_"), F.col("number").cast("string"), F.lit(".txt")).alias("label_file"))
    return ops.aligned_labels(images, labels)


def window_tasks(spark, sf):
    return ops.window_tasks(session_windows(spark, sf))


def relay_ends(spark, sf):
    return ops.relay_ends(temporal.merge_intervals(_edges(spark, sf), ["lineage", "forward"]).select("lineage", "start", "stop"))


def proto_mask(spark, sf):
    rows = table(spark, sf, "embeddings")
    coefficients = rows.select(F.col("vec_id").alias("instance"), F.posexplode("embedding").alias("k", "v")).select("instance", F.col("k").cast("bigint").alias("k"), F.rint(F.col("v").cast("double") * 64).alias("c"))
    grid = spark.range(64 * 36).select(F.floor(F.col("id") / 36).alias("k"), F.floor(F.col("id") % 36 / 6).alias("y"), (F.col("id") % 6).alias("x"))
    prototypes = grid.withColumn("p", ((F.col("k") * 7 + F.col("y") * 3 + F.col("x") * 5) % 11 - 5).cast("double"))
    return ops.proto_mask(rows.select(F.col("vec_id").alias("instance"), (F.col("vec_id") % 10).alias("image")), prototypes, coefficients)


def tracker_scores(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") % 9 == 0, -1024.0).otherwise((F.col("p_partkey") % 41 - 20) / 4.0).alias("logit"))
    return ops.tracker_scores(rows).select("p_partkey", F.round("prob", 9).alias("prob"))


def component_match(spark, sf):
    label = lambda threshold: masks.components(_cells(spark, sf, threshold), 8, 8)
    return ops.component_match(label(0.15), label(0.05), masks.AT)


def clear_flanks(spark, sf):
    return ops.clear_flanks(masks.components(_cells(spark, sf, 0.15), 8, 8), _cells(spark, sf, 0.15), 2, 0.15)


def slab_ranges(spark, sf):
    return ops.slab_ranges(_shapes(spark, sf), 64)


def tile_overlap(spark, sf):
    rows = _cells(spark, sf, 0.1).select((F.col("t") % 4).alias("tile"), (F.col("t") % 20).alias("obj"), F.floor(F.col("t") / 20).alias("frame"), "y", "x")
    tiles = spark.createDataFrame([(0, 0, 0), (1, 5, 0), (2, 0, 5), (3, 5, 5)], "tile long, left long, top long")
    return ops.tile_overlap(rows, tiles).withColumn("iou", F.round("iou", 9))


def dihedral(spark, sf):
    return ops.dihedral(_masks(spark, sf, 0.1), 8, F.col("volume") % 8)


def overlay(spark, sf):
    return ops.overlay(_grays(spark, sf), _masks(spark, sf, 0.1), ["volume", "t", "y", "x"])


def voxel_report(spark, sf):
    return ops.voxel_report(_cells(spark, sf, 0.05).select((F.col("label") % 10).alias("layer")), (0.5, 0.25, 0.25))


def physical_views(spark, sf):
    rows = _masks(spark, sf, 0.05)
    return ops.physical_views(rows.select((F.col("volume") % 5).alias("view"), F.col("volume").alias("variant"), "t", "y", "x"))


def foreground_delta(spark, sf):
    return masks.subtract(masks.dilate(_cells(spark, sf, 0.3), 6, 8), _cells(spark, sf, 0.0))


def protected_foreground(spark, sf):
    """What a filter took from the mask, restored where it was protected."""
    mask = _cells(spark, sf, 0.1)
    kept = masks.drop_faint(masks.components(mask, 8, 8).join(mask.select(*masks.AT, "v"), masks.AT), "v", 0.25)
    return masks.union(kept, masks.intersect(mask, mask.where("x < 3")))


def assembled_views(spark, sf):
    """Three neighbouring volumes as three views of one, on a native grid of 6 by 8 by 11."""
    view = F.element_at(F.array(*map(F.lit, geometry.VIEW_AXES)), (F.col("volume") % 3 + 1).cast("int"))
    rows = _masks(spark, sf, 0.2).select(F.floor(F.col("volume") / 3).alias("volume"), view.alias("view"), F.col("t").alias("stack"), F.col("y").alias("row"), F.col("x").alias("col"))
    return geometry.assemble_views(rows, 8, {"t": 6, "y": 8, "x": 11})


QUERIES = {
    f.__name__: f
    for f in (
        frontier_acknowledge, frontier_stats, packet_status, coverage_masks, coverage_stats, union_frames, composed_sources, withheld_overage, row_offsets, round_robin, annotation_class, aligned_labels, window_tasks, relay_ends,
        proto_mask, tracker_scores, component_match, clear_flanks, slab_ranges, tile_overlap, dihedral, overlay, voxel_report, physical_views, foreground_delta, protected_foreground, assembled_views,
    )
}

BOXES = "SELECT lineage, tile, frame, forward, count(DISTINCT px) AS n_pixels, list_sort(list(DISTINCT px)) AS revision FROM offers"
PACKETS = """packets AS (SELECT l_orderkey AS work_id, CASE WHEN l_orderkey % 7 = 0 THEN l_linenumber ELSE 0 END::VARCHAR AS sha256, l_partkey % 20 AS lineage, l_suppkey % 50 AS frame, l_quantity::BIGINT % 8 AS px FROM lineitem),
known AS (SELECT DISTINCT work_id, CASE WHEN work_id % 2 = 0 THEN '0' ELSE '9' END AS known FROM packets WHERE work_id % 3 = 0),
status AS (SELECT DISTINCT p.work_id, p.sha256, CASE WHEN n > 1 OR known <> sha256 THEN 'changed' WHEN known IS NOT NULL THEN 'duplicate' ELSE 'new' END AS status
  FROM packets p JOIN (SELECT work_id, count(DISTINCT sha256) AS n FROM packets GROUP BY work_id) USING (work_id) LEFT JOIN known USING (work_id))"""
MERGED = """marked AS (SELECT *, max(stop) OVER (PARTITION BY lineage, forward ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM edges),
islands AS (SELECT *, sum(CASE WHEN reach IS NULL OR start > reach THEN 1 ELSE 0 END) OVER (PARTITION BY lineage, forward ORDER BY start, stop) AS g FROM marked),
merged AS (SELECT lineage, forward, min(start) AS start, max(stop) AS stop FROM islands GROUP BY lineage, forward, g)"""

ORACLES = {
    "frontier_acknowledge": f"""{sql('frames')}, {OFFERS}, now_ AS ({BOXES} GROUP BY ALL), taken AS ({BOXES} WHERE px % 2 = 0 AND frame % 3 = 0 GROUP BY ALL)
SELECT n.lineage, n.tile, n.frame, n.forward, CASE WHEN t.revision IS NULL THEN n.n_pixels > 1 ELSE n.revision <> t.revision END AS dirty FROM now_ n LEFT JOIN taken t ON n.lineage = t.lineage AND n.tile = t.tile AND n.frame = t.frame AND n.forward = t.forward""",
    "frontier_stats": f"{sql('frames')}, {OFFERS}, b AS ({BOXES} GROUP BY ALL) SELECT count(*) AS mailboxes, count(*) FILTER (WHERE n_pixels > 1) AS dirty, count(DISTINCT lineage) AS lineages, coalesce(sum(n_pixels), 0)::BIGINT AS pixels FROM b",
    "packet_status": f"WITH {PACKETS} SELECT work_id, sha256, status FROM status",
    "coverage_masks": f"""WITH {PACKETS}, u AS (SELECT lineage, frame, px FROM packets WHERE work_id % 3 = 0 AND px < 2 UNION SELECT lineage, frame, px FROM packets WHERE work_id IN (SELECT work_id FROM status WHERE status = 'new'))
SELECT lineage, frame, count(*) AS n_pixels, sum(px)::BIGINT AS sum_px FROM u GROUP BY lineage, frame""",
    "coverage_stats": f"""{sql('frames')}, {EDGES}, {MERGED}, m AS (SELECT DISTINCT lineage, frame, score % 4 AS px FROM frames)
SELECT (SELECT count(*) FROM (SELECT DISTINCT lineage, frame FROM m)) AS masked_frames, (SELECT count(*) FROM m) AS foreground_pixels, count(*) AS ranges, sum(stop - start)::BIGINT AS transitions FROM merged""",
    "union_frames": f"{sql('frames')} SELECT lineage % 50 AS lineage, frame // 20 AS frame, count(DISTINCT event_id % 16) AS n_pixels, max(score) AS prob, max(score) > 90 AS authoritative FROM frames GROUP BY lineage % 50, frame // 20",
    "composed_sources": f"""{sql('frames')}, r AS (SELECT lineage % 40 AS lineage, frame // 40 AS frame, forward, max(score) > 90 AS auth, (max(score) % 3)::VARCHAR AS rev FROM frames GROUP BY lineage % 40, frame // 40, forward),
c AS (SELECT lineage, (min(frame) + max(frame)) // 2 AS cut FROM r GROUP BY lineage),
j AS (SELECT lineage, frame, max(rev) FILTER (WHERE forward) AS rl, max(rev) FILTER (WHERE NOT forward) AS rr, coalesce(bool_or(auth) FILTER (WHERE forward), false) AS al, coalesce(bool_or(auth) FILTER (WHERE NOT forward), false) AS ar FROM r GROUP BY lineage, frame),
k AS (SELECT j.*, frame < cut AS pref, rl IS NOT NULL AND rr IS NOT NULL AS two FROM j JOIN c USING (lineage)),
l AS (SELECT *, CASE WHEN NOT two THEN rl IS NOT NULL WHEN al <> ar THEN al ELSE pref END AS lft FROM k)
SELECT lineage, frame, CASE WHEN lft THEN 'left' ELSE 'right' END AS source, CASE WHEN two AND al AND ar THEN CASE WHEN rl = rr THEN 'coincident_authoritative_equal' ELSE 'conflict' END
 WHEN two AND (al OR ar) THEN CASE WHEN lft = pref THEN 'authoritative_cut' ELSE 'authoritative_override' END WHEN lft = pref THEN 'monotonic_cut' ELSE 'sparse_fallback' END AS reason FROM l""",
    "withheld_overage": f"""{C}, {SPLIT_SQL}, {AUG}, hashed AS (SELECT *, {BGA} AS h, augmentation_index > 0 AS is_copy, count(*) FILTER (WHERE foreground) OVER (PARTITION BY split_subset) - CASE split_subset WHEN 'train' THEN 120 ELSE 0 END AS fg FROM versions),
deep AS (SELECT *, CASE WHEN is_copy THEN row_number() OVER (PARTITION BY split_subset, ident, is_copy, foreground ORDER BY h, source_order, augmentation_index) ELSE 0 END AS depth FROM hashed),
nth AS (SELECT *, row_number() OVER (PARTITION BY split_subset, foreground ORDER BY is_copy, depth, h, source_order, augmentation_index) AS pos FROM deep)
SELECT doc_id, augmentation_index, split_subset, foreground OR split_subset <> 'train' OR pos <= floor(0.4::DOUBLE / (1 - 0.4::DOUBLE) * greatest(0, fg)) AS keep FROM nth""",
    "row_offsets": f"{V(0.0)}, c AS (SELECT t, y, count(*) AS n FROM voxels GROUP BY t, y) SELECT t, y::BIGINT AS y, n, (sum(n) OVER w)::BIGINT AS last, (sum(n) OVER w - n)::BIGINT AS first FROM c WINDOW w AS (PARTITION BY t ORDER BY y)",
    "round_robin": f"""WITH {SHAPES}, f AS (SELECT volume AS plan, unnest(range(n_t)) AS frame FROM shapes), k AS (SELECT * FROM f WHERE plan % 3 <> 0 OR frame % (plan + 1) = 0) SELECT row_number() OVER (ORDER BY frame, plan) - 1 AS nth, plan, frame FROM k""",
    "annotation_class": f"""{sql('candidates')} SELECT volume_name || '/' || (doc_id % 97)::VARCHAR AS volume, CASE WHEN max(annotation_state) = 0 THEN 'unlabelled' WHEN min(annotation_state) = 0 THEN 'partial' ELSE 'labelled' END AS class FROM candidates GROUP BY 1""",
    "aligned_labels": "SELECT o_orderpriority AS volume, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS frame, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority || '_' || o_orderkey::VARCHAR || '.txt' END AS label_file FROM orders",
    "window_tasks": f"""SELECT lineage, anchor, branch, ordinal, CASE WHEN ordinal = 1 THEN 'center' WHEN ordinal > 1 THEN branch END AS parent_branch, CASE WHEN ordinal > 0 THEN ordinal - 1 END AS parent FROM ({TEMPORAL['session_windows']})""",
    "relay_ends": f"{sql('frames')}, {EDGES}, {MERGED} SELECT lineage, start AS frame, true AS forward FROM merged UNION SELECT lineage, stop - 1, false FROM merged",
    "proto_mask": """WITH e AS (SELECT vec_id AS instance, unnest(range(64)) AS k, unnest(embedding)::DOUBLE AS v FROM embeddings),
p AS (SELECT k, y, x, ((k * 7 + y * 3 + x * 5) % 11 - 5)::DOUBLE AS p FROM (SELECT unnest(range(64)) AS k), (SELECT unnest(range(6)) AS y), (SELECT unnest(range(6)) AS x)),
l AS (SELECT instance, y, x, sum(round_even(v * 64, 0) * p) AS logit FROM e JOIN p USING (k) GROUP BY ALL) SELECT instance % 10 AS image, y, x, max(logit) AS logit FROM l GROUP BY instance % 10, y, x HAVING max(logit) > 0""",
    "tracker_scores": "SELECT p_partkey, round(1 / (1 + exp(-(p_partkey % 41 - 20) / 4.0::DOUBLE)), 9) AS prob FROM part WHERE p_partkey % 9 <> 0",
    "component_match": f"""{V(0.05)}, strong AS (SELECT * FROM voxels WHERE v > 0.15), {COMP(N8)}, reach2 AS (SELECT t, y, x, (t * 8 + y) * 8 + x AS root FROM strong UNION SELECT n.t, n.y, n.x, r.root FROM reach2 r JOIN strong n ON {N8}),
pred AS (SELECT t, y, x, min(root) AS root FROM reach2 GROUP BY t, y, x), h AS (SELECT DISTINCT p.root AS p, g.root AS g FROM pred p JOIN comp g USING (t, y, x)), hg AS (SELECT g, count(*) AS n FROM h GROUP BY g), hp AS (SELECT p, count(*) AS n FROM h GROUP BY p)
SELECT (SELECT count(DISTINCT root) FROM comp) AS truth, (SELECT count(DISTINCT root) FROM pred) AS predicted, (SELECT count(*) FROM hg WHERE n > 1) AS split, (SELECT count(*) FROM hp WHERE n > 1) AS merged,
 (SELECT count(DISTINCT root) FROM comp) - (SELECT count(*) FROM hg) AS missed, (SELECT count(DISTINCT root) FROM pred) - (SELECT count(*) FROM hp) AS "false\"""",
    "clear_flanks": f"""{V(0.15)}, {COMP(N8)}, a AS (SELECT root, count(*) AS n FROM comp GROUP BY root), h AS (SELECT c.root, count(*) AS hits FROM comp c JOIN voxels v ON v.y = c.y AND v.x = c.x AND v.t BETWEEN c.t - 2 AND c.t + 2 AND v.t <> c.t GROUP BY c.root)
SELECT root FROM a LEFT JOIN h USING (root) WHERE coalesce(hits, 0) <= 0.15::DOUBLE * n * 4""",
    "slab_ranges": f"WITH {SHAPES}, n AS (SELECT volume, n_t, ceil(n_t / 64.0::DOUBLE)::BIGINT AS n FROM shapes), s AS (SELECT *, unnest(range(n)) AS slab FROM n) SELECT volume, slab, slab * n_t // n AS start, (slab + 1) * n_t // n AS stop FROM s",
    "tile_overlap": f"""{V(0.1)}, p AS (SELECT t % 4 AS tile, t % 20 AS obj, t // 20 AS frame, y + CASE WHEN t % 4 >= 2 THEN 5 ELSE 0 END AS gy, x + CASE WHEN t % 2 = 1 THEN 5 ELSE 0 END AS gx FROM voxels), a AS (SELECT obj, frame, count(*) AS n FROM p GROUP BY ALL),
i AS (SELECT l.obj AS obj_l, r.obj AS obj_r, l.frame, count(*) AS inter FROM p l JOIN p r ON l.frame = r.frame AND l.gy = r.gy AND l.gx = r.gx AND l.tile < r.tile GROUP BY ALL)
SELECT obj_l, obj_r, i.frame, inter, round(inter / (a.n + b.n - inter), 9) AS iou FROM i JOIN a ON a.obj = obj_l AND a.frame = i.frame JOIN a b ON b.obj = obj_r AND b.frame = i.frame""",
    "dihedral": f"""{V(0.1)}, {MASK}, m AS (SELECT volume, t, CASE WHEN volume % 8 & 2 = 2 THEN 7 - y ELSE y END::BIGINT AS yy, CASE WHEN volume % 8 & 1 = 1 THEN 7 - x ELSE x END::BIGINT AS xx FROM masks)
SELECT volume, t, CASE WHEN volume % 8 >= 4 THEN xx ELSE yy END AS y, CASE WHEN volume % 8 >= 4 THEN yy ELSE xx END AS x FROM m""",
    "overlay": f"WITH {GRAYS} SELECT volume, t, y, x, CASE WHEN v > 0.1 THEN round_even(g / 2, 0) ELSE g END::BIGINT AS r, CASE WHEN v > 0.1 THEN round_even(g / 2, 0) ELSE g END::BIGINT AS g, CASE WHEN v > 0.1 THEN round_even((g + 255) / 2, 0) ELSE g END::BIGINT AS b FROM (SELECT vec_id // 8 AS volume, vec_id % 8 AS t, pos // 8 AS y, pos % 8 AS x, floor(abs(v) * 1000)::BIGINT % 256 AS g, v FROM cells)",
    "voxel_report": f"{V(0.05)} SELECT label % 10 AS layer, count(*) AS voxels, round(count(*) * 0.03125::DOUBLE, 6) AS volume FROM voxels GROUP BY label % 10",
    "physical_views": f"{V(0.05)}, {MASK} SELECT DISTINCT volume % 5 AS view, t, y::BIGINT AS y, x::BIGINT AS x FROM masks",
    "foreground_delta": f"""{V(0.0)}, d AS (SELECT unnest([0, 1, -1, 0, 0, 0, 0]) AS dt, unnest([0, 0, 0, 1, -1, 0, 0]) AS dy, unnest([0, 0, 0, 0, 0, 1, -1]) AS dx), g AS (SELECT DISTINCT t + dt AS t, y + dy AS y, x + dx AS x FROM voxels, d WHERE v > 0.3)
SELECT t, y, x FROM g WHERE t >= 0 AND y BETWEEN 0 AND 7 AND x BETWEEN 0 AND 7 EXCEPT SELECT t, y, x FROM voxels""",
    "protected_foreground": f"""{V(0.1)}, {COMP(N8)}, j AS (SELECT c.*, v.v FROM comp c JOIN voxels v USING (t, y, x)) SELECT t, y::BIGINT AS y, x::BIGINT AS x FROM j WHERE x < 3 OR root IN (SELECT root FROM j GROUP BY root HAVING max(v) >= 0.25)""",
    "assembled_views": f"""{V(0.2)}, {MASK}, n AS (SELECT volume // 3 AS volume, CASE volume % 3 WHEN 0 THEN t ELSE y END AS t, CASE volume % 3 WHEN 0 THEN y WHEN 1 THEN t ELSE x END AS y, CASE volume % 3 WHEN 2 THEN t ELSE x END AS x FROM masks),
st AS (SELECT o AS ot FROM (SELECT unnest(range(6)) AS o)), sx AS (SELECT o AS ox, round_even(o * 7 / 10.0::DOUBLE, 0)::BIGINT AS src FROM (SELECT unnest(range(11)) AS o))
SELECT DISTINCT volume, ot AS t, y::BIGINT AS y, ox AS x FROM n JOIN st ON n.t >= floor(ot * 8 / 6.0) AND n.t < ceil((ot + 1) * 8 / 6.0) JOIN sx ON sx.src = n.x""",
}
