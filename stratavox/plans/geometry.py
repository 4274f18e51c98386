"""Geometry operators over canvases from part, voxels from embeddings, and points from customer."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from stratavox.functions import hashing, numbers
from stratavox.operators import geometry as ops
from stratavox.plans.masks import V, _cells
from stratavox.sources.labels import parse_polygons, volume_files
from stratavox.sources.tables import frames, sql, table


def _canvases(spark, sf):
    return table(spark, sf, "part").select(F.col("p_size").cast("bigint").alias("canvas"), (700 + F.col("p_size") * 61).cast("bigint").alias("width"), (650 + F.col("p_size") * 47).cast("bigint").alias("height")).distinct()


def tile_grid(spark, sf):
    return ops.tile_grid(_canvases(spark, sf))


def tile_neighbours(spark, sf):
    return ops.tile_neighbours(ops.tile_grid(_canvases(spark, sf)))


def resize_nearest(spark, sf):
    return ops.resize_nearest(_cells(spark, sf, 0.1).select("t", "y", "x"), "x", 8, 21)


def restore_or(spark, sf):
    rows = _cells(spark, sf, 0.1).select("t", "y", "x")
    return ops.restore(ops.restore(rows, "x", 8, 5), "y", 8, 19)


def mask_downbin(spark, sf):
    return ops.downbin(_cells(spark, sf, 0.0), 2)


def affine_warp(spark, sf):
    return ops.warp_nearest(_cells(spark, sf, 0.1), ops.affine(8, 8, 12, 30.0), 12)


def azimuthal_map(spark, sf):
    rows = _cells(spark, sf, 0.1)
    inside, k, u = ops.azimuthal_index(F.col("y"), F.col("x"), 3.5, 3.5, 3.5, 7, 8)
    return rows.where(inside).select(k.alias("frame"), F.col("t").alias("row"), u.alias("u")).distinct()


def radial_map(spark, sf):
    rows = _cells(spark, sf, 0.1).withColumn("shell", ops.shell_index(F.col("y"), F.col("x"), 3.5, 3.5, 0.5, 0.75, 6))
    rows = rows.where(F.col("shell").isNotNull())
    return rows.select("shell", F.col("t").alias("row"), ops.shell_arc(F.col("y"), F.col("x"), 3.5, 3.5, 0.5 + 0.75 * F.col("shell")).alias("arc")).distinct()


def _directions(spark, sf):
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select("c_custkey", (key % 41 - 20).cast("double").alias("a"), (F.floor(key / 41) % 37 - 18).cast("double").alias("b"), (F.col("c_nationkey") - 12).cast("double").alias("c")).where("a != 0 OR b != 0 OR c != 0")


def qsc_forward(spark, sf):
    rows = _directions(spark, sf).withColumn("face", ops.cube_face(F.col("a"), F.col("b"), F.col("c")))
    rows = ops.cube_uv(rows, "a", "b", "c", "face")
    return rows.select("c_custkey", "face", F.floor((F.col("u") + 1) * 512 + 1e-6).cast("bigint").alias("ku"), F.floor((F.col("v") + 1) * 512 + 1e-6).cast("bigint").alias("kv"))


def gaussian_binary(spark, sf):
    return ops.smooth(_cells(spark, sf, 0.0), 0.9, 8)


def gaussian_3d(spark, sf):
    return ops.smooth(_cells(spark, sf, -0.02), 0.7, 8, 500)


def context_channels(spark, sf):
    rows = frames(spark, sf).select((F.floor(F.col("frame") / 10)).alias("frame")).distinct()
    return ops.context_stack(rows, numbers.channel_offsets(5, 3), 432)


def context_wrapped(spark, sf):
    rows = frames(spark, sf).select((F.floor(F.col("frame") / 10)).alias("frame")).distinct()
    return ops.context_stack(rows, numbers.channel_offsets(3, 200), 432, circular=True)


def scalar_grid(spark, sf):
    rows = table(spark, sf, "part").select(F.col("p_partkey"), F.col("p_size").cast("bigint").alias("s"), (F.col("p_partkey") % 101 / 100.0).alias("c"))
    return rows.select(
        "p_partkey",
        numbers.nearest_index(F.col("s"), F.lit(51), F.lit(23)).alias("nearest"),
        numbers.containing_pixel(F.lit(51), F.lit(23), F.col("s")).alias("containing"),
        numbers.cube_side(F.col("s"), F.lit(50)).alias("cube"),
        numbers.multiple_of_four(F.col("s")).alias("four"),
        numbers.quantize_confidence(F.col("c")).alias("byte"),
        numbers.confidence_threshold(F.col("c")).alias("least_byte"),
        numbers.background_limit(F.col("s"), F.col("c")).alias("bg_limit"),
    )


def layer_colours(spark, sf):
    return table(spark, sf, "part").select("p_brand").distinct().select("p_brand", hashing.fnv1a32(F.col("p_brand")).alias("colour"))


def polygon_labels(spark, sf):
    k = F.col("c_custkey")
    at = lambda m: (k % m / float(m)).cast("string")
    line = F.concat_ws(" ", (k % 3).cast("string"), F.lit("0.1"), at(7), at(11), F.lit("0.9"), F.when(k % 5 == 0, "x").otherwise(at(13)), F.when(k % 4 == 0, "1.5").otherwise("0.25"))
    lines = table(spark, sf, "customer").select("c_custkey", line.alias("value"))
    return parse_polygons(lines).select("c_custkey", "class_id", F.size("points").alias("n_points"), F.round(ops.polygon_area(F.col("points")), 9).alias("area"))


def volume_discovery(spark, sf):
    name = F.concat(F.lit("/data/"), F.col("o_orderpriority"), F.lit("_"), F.lpad(F.col("o_orderkey").cast("string"), 7, "0"), F.lit(".tif"))
    return volume_files(table(spark, sf, "orders").select(name.alias("path")))


QUERIES = {
    f.__name__: f
    for f in (tile_grid, tile_neighbours, resize_nearest, restore_or, mask_downbin, affine_warp, azimuthal_map, radial_map, qsc_forward, gaussian_binary, gaussian_3d, context_channels, context_wrapped, scalar_grid, layer_colours, polygon_labels, volume_discovery)
}

GRID = """canvases AS (SELECT DISTINCT p_size::BIGINT AS canvas, 700 + p_size::BIGINT * 61 AS width, 650 + p_size::BIGINT * 47 AS height FROM part),
xs AS (SELECT canvas, left_, row_number() OVER (PARTITION BY canvas ORDER BY left_) - 1 AS col FROM (SELECT canvas, unnest(list_distinct(list_append(range(0, greatest(width - 1008, 0) + 1, 756), greatest(width - 1008, 0)))) AS left_ FROM canvases)),
ys AS (SELECT canvas, top_, row_number() OVER (PARTITION BY canvas ORDER BY top_) - 1 AS row FROM (SELECT canvas, unnest(list_distinct(list_append(range(0, greatest(height - 1008, 0) + 1, 756), greatest(height - 1008, 0)))) AS top_ FROM canvases)),
tiles AS (SELECT canvas, row * (SELECT count(*) FROM xs b WHERE b.canvas = xs.canvas) + col AS tile, row, col, left_ AS "left", top_ AS "top" FROM xs JOIN ys USING (canvas))"""
M = ops.invert(ops.affine(8, 8, 12, 30.0))
TAPS = ops.gaussian_taps(0.9)
TAPS3 = ops.gaussian_taps(0.7)
FRAMES = "fr AS (SELECT DISTINCT frame // 10 AS frame FROM frames)"


def _qsc_sql() -> str:
    dot = lambda n: f"({n[0]} * a + {n[1]} * b + {n[2]} * c)"
    pick = lambda axis: "CASE face " + " ".join(f"WHEN {i} THEN {dot(f[axis])} / norm" for i, f in enumerate(ops.FACES)) + " END"
    dots = "[" + ", ".join(dot(f[0]) for f in ops.FACES) + "]"
    return f"""WITH p AS (SELECT c_custkey, (c_custkey % 41 - 20)::DOUBLE AS a, (c_custkey // 41 % 37 - 18)::DOUBLE AS b, (c_nationkey - 12)::DOUBLE AS c FROM customer),
f AS (SELECT *, list_position({dots}, list_max({dots})) - 1 AS face, sqrt(a * a + b * b + c * c) AS norm FROM p WHERE a <> 0 OR b <> 0 OR c <> 0),
l AS (SELECT c_custkey, face, {pick(0)} AS n, {pick(1)} AS r, {pick(2)} AS u FROM f),
s AS (SELECT *, CASE WHEN abs(r) >= abs(u) THEN CASE WHEN r >= 0 THEN 0 ELSE 2 END ELSE CASE WHEN u >= 0 THEN 1 ELSE 3 END END AS area, greatest(abs(r), abs(u)) AS major FROM l),
m AS (SELECT *, CASE area WHEN 0 THEN u WHEN 1 THEN -r WHEN 2 THEN -u ELSE r END AS minor FROM s),
t AS (SELECT *, atan2(minor, major) AS theta FROM m),
q AS (SELECT *, CASE WHEN abs(minor) = major THEN sign(minor)::DOUBLE ELSE {12 / math.pi!r}::DOUBLE * (theta - asin(sin(theta) * {1 / math.sqrt(2)!r}::DOUBLE)) END AS ratio,
  CASE WHEN major = n THEN 1.0::DOUBLE ELSE sqrt(r * r + u * u) / sqrt((1 + n) * (1 - cos(theta) / sqrt(1 + cos(theta) * cos(theta)))) END AS pp FROM t),
w AS (SELECT c_custkey, face, CASE area WHEN 0 THEN pp WHEN 1 THEN -pp * ratio WHEN 2 THEN -pp ELSE pp * ratio END AS uu, CASE area WHEN 0 THEN pp * ratio WHEN 1 THEN pp WHEN 2 THEN -pp * ratio ELSE -pp END AS vv FROM q)
SELECT c_custkey, face::BIGINT AS face, floor((greatest(-1, least(1, uu)) + 1) * 512 + 1e-6)::BIGINT AS ku, floor((greatest(-1, least(1, vv)) + 1) * 512 + 1e-6)::BIGINT AS kv FROM w"""


def _context_sql(offsets: list[int], source: str, mirrored: str) -> str:
    return f"""{sql('frames')}, {FRAMES}, o AS (SELECT unnest(range({len(offsets)}))::INT AS channel, unnest({offsets}) AS o),
s AS (SELECT frame, channel, ({source})::BIGINT AS source, {mirrored} AS mirrored FROM fr, o), lost AS (SELECT DISTINCT frame FROM s WHERE source NOT IN (SELECT frame FROM fr))
SELECT * FROM s WHERE frame NOT IN (SELECT frame FROM lost)"""


ORACLES = {
    "tile_grid": f'WITH {GRID} SELECT canvas, tile, row, col, "left", "top" FROM tiles',
    "tile_neighbours": f"""WITH {GRID} SELECT a.canvas, a.tile AS source, b.tile AS destination, greatest(a."left", b."left") AS x0, greatest(a."top", b."top") AS y0, least(a."left", b."left") + 1008 AS x1, least(a."top", b."top") + 1008 AS y1
FROM tiles a JOIN tiles b ON a.canvas = b.canvas AND abs(a.row - b.row) <= 1 AND abs(a.col - b.col) <= 1 AND a.tile <> b.tile""",
    "resize_nearest": f"{V(0.1)}, m AS (SELECT o AS x, round_even(o * 7 / 20.0::DOUBLE, 0)::INT AS src FROM (SELECT unnest(range(21)) AS o)) SELECT v.t, v.y::BIGINT AS y, m.x FROM voxels v JOIN m ON m.src = v.x",
    "restore_or": f"""{V(0.1)}, a AS (SELECT DISTINCT t, y, o AS x FROM voxels, (SELECT unnest(range(5)) AS o) WHERE x >= floor(o * 8 / 5.0) AND x < ceil((o + 1) * 8 / 5.0)),
m AS (SELECT o AS y, round_even(o * 7 / 18.0::DOUBLE, 0)::INT AS src FROM (SELECT unnest(range(19)) AS o)) SELECT a.t, m.y, a.x FROM a JOIN m ON m.src = a.y""",
    "mask_downbin": f"{V(0.0)} SELECT t, (y // 2)::BIGINT AS y, (x // 2)::BIGINT AS x, count(*) / 4.0::DOUBLE AS share FROM voxels GROUP BY t, y // 2, x // 2",
    "affine_warp": f"""{V(0.1)}, g AS (SELECT oy, ox, round_even(round({M[3]!r}::DOUBLE * ox + {M[4]!r}::DOUBLE * oy + {M[5]!r}::DOUBLE, 9), 0)::BIGINT AS y, round_even(round({M[0]!r}::DOUBLE * ox + {M[1]!r}::DOUBLE * oy + {M[2]!r}::DOUBLE, 9), 0)::BIGINT AS x
FROM (SELECT unnest(range(12)) AS oy), (SELECT unnest(range(12)) AS ox)) SELECT v.t, g.oy AS y, g.ox AS x FROM voxels v JOIN g ON v.y = g.y AND v.x = g.x""",
    "azimuthal_map": f"""{V(0.1)}, a AS (SELECT t, x - 3.5::DOUBLE AS dx, y - 3.5::DOUBLE AS dy FROM voxels),
b AS (SELECT *, degrees(atan2(dy, dx)) AS th FROM a WHERE sqrt(dx * dx + dy * dy) <= 4.0),
k AS (SELECT *, round_even(round(CASE WHEN th < 0 THEN CASE WHEN th + 180 >= 180 THEN 0 ELSE th + 180 END WHEN th >= 180 THEN th - 180 ELSE th END / {180.0 / 7!r}::DOUBLE, 9), 0)::BIGINT % 7 AS frame FROM b)
SELECT DISTINCT frame, t AS row, greatest(0, least(7, round_even(round((dx * cos(radians(frame * {180.0 / 7!r}::DOUBLE)) + dy * sin(radians(frame * {180.0 / 7!r}::DOUBLE)) + 3.5) / 7.0 * 7, 9), 0)))::BIGINT AS u FROM k""",
    "radial_map": f"""{V(0.1)}, a AS (SELECT t, x - 3.5::DOUBLE AS dx, y - 3.5::DOUBLE AS dy FROM voxels),
s AS (SELECT *, ceil(round((sqrt(dx * dx + dy * dy) - 0.5) / 0.75, 9) - 0.5)::BIGINT AS shell FROM a)
SELECT DISTINCT shell, t AS row, floor(round(CASE WHEN atan2(dy, dx) < 0 THEN atan2(dy, dx) + {2 * math.pi!r}::DOUBLE ELSE atan2(dy, dx) END * (0.5 + 0.75 * shell), 9) + 0.5)::BIGINT AS arc FROM s WHERE shell BETWEEN 0 AND 5""",
    "qsc_forward": _qsc_sql(),
    "gaussian_binary": f"""{V(0.0)}, taps AS (SELECT unnest(range({len(TAPS)})) - {len(TAPS) // 2} AS d, unnest({TAPS!r})::DOUBLE AS w),
a AS (SELECT t, y + d AS y, x, sum(w) AS v FROM voxels, taps WHERE y + d BETWEEN 0 AND 7 GROUP BY t, y + d, x), b AS (SELECT t, y, x + d AS x, sum(v * w) AS v FROM a, taps WHERE x + d BETWEEN 0 AND 7 GROUP BY t, y, x + d)
SELECT t, y, x FROM b WHERE round(v, 9) >= 0.5""",
    "gaussian_3d": f"""{V(-0.02)}, taps AS (SELECT unnest(range({len(TAPS3)})) - {len(TAPS3) // 2} AS d, unnest({TAPS3!r})::DOUBLE AS w),
a AS (SELECT t, y + d AS y, x, sum(w) AS v FROM voxels, taps WHERE y + d BETWEEN 0 AND 7 GROUP BY t, y + d, x), b AS (SELECT t, y, x + d AS x, sum(v * w) AS v FROM a, taps WHERE x + d BETWEEN 0 AND 7 GROUP BY t, y, x + d),
c AS (SELECT t + d AS t, y, x, sum(v * w) AS v FROM b, taps WHERE t + d BETWEEN 0 AND 499 GROUP BY t + d, y, x) SELECT t, y, x FROM c WHERE round(v, 9) >= 0.5""",
    "context_channels": _context_sql(numbers.channel_offsets(5, 3), "greatest(0, least(431, frame + o))", "false"),
    "context_wrapped": _context_sql(numbers.channel_offsets(3, 200), "((frame + o) % 432 + 432) % 432", "(frame + o < 0 OR frame + o >= 432)"),
    "scalar_grid": """WITH p AS (SELECT p_partkey, p_size::BIGINT AS s, (p_partkey % 101)::DOUBLE / 100.0::DOUBLE AS c FROM part)
SELECT p_partkey, greatest(0, least(22, round_even(s * 22 / 50.0::DOUBLE, 0)))::BIGINT AS nearest, least(22, floor((s + 0.5::DOUBLE) * 23 / 51.0::DOUBLE))::BIGINT AS containing,
  greatest(s, ceil(50 * 0.95::DOUBLE))::BIGINT AS cube, (greatest(4, floor(s / 4.0::DOUBLE + 0.5) * 4))::BIGINT AS four, round_even(c * 255, 0)::INT AS byte, greatest(0, ceil(c * 255 - 1e-9::DOUBLE))::INT AS least_byte,
  CASE WHEN c <= 0 THEN 0 WHEN c < 1 THEN floor(c / (1 - c) * s) END::BIGINT AS bg_limit FROM p""",
    "layer_colours": """WITH RECURSIVE b AS (SELECT DISTINCT p_brand FROM part), h AS (SELECT p_brand, 1 AS i, 2166136261::BIGINT AS h FROM b
  UNION ALL SELECT p_brand, i + 1, (xor(h, ascii(p_brand[i])::BIGINT)::HUGEINT * 16777619 % 4294967296)::BIGINT FROM h WHERE i <= length(p_brand))
SELECT p_brand, h AS colour FROM h WHERE i = length(p_brand) + 1""",
    "polygon_labels": """WITH c AS (SELECT c_custkey, (c_custkey % 3)::INT AS class_id, 0.1::DOUBLE AS x1, (c_custkey % 7) / 7.0::DOUBLE AS y1, (c_custkey % 11) / 11.0::DOUBLE AS x2, 0.9::DOUBLE AS y2, (c_custkey % 13) / 13.0::DOUBLE AS x3,
  CASE WHEN c_custkey % 4 = 0 THEN 1.0 ELSE 0.25 END::DOUBLE AS y3 FROM customer WHERE c_custkey % 5 <> 0)
SELECT c_custkey, class_id, 3::INT AS n_points, round(abs((x1 * y2 - x2 * y1) + (x2 * y3 - x3 * y2) + (x3 * y1 - x1 * y3)) / 2, 9) AS area FROM c""",
    "volume_discovery": """SELECT o_orderpriority AS volume, count(*) AS n, min(o_orderkey) AS first, max(o_orderkey) AS last, min(o_orderkey) IN (0, 1) AND max(o_orderkey) - min(o_orderkey) + 1 = count(*) AS contiguous FROM orders GROUP BY 1""",
}
