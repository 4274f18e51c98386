"""Polygons from customers and packed slices of the voxels view."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratavox.operators import masks
from stratavox.operators import polygons as ops
from stratavox.operators.geometry import polygon_area
from stratavox.plans.masks import V, _cells
from stratavox.session import shared_path
from stratavox.sources import packed
from stratavox.sources.tables import table

SIZE = 16


def _triangles(spark, sf):
    k = F.col("c_custkey")
    point = lambda a, b: F.struct((k * a % 17 + 0.25).cast("double").alias("x"), (k * b % 17 + 0.25).cast("double").alias("y"))
    return table(spark, sf, "customer").select(k.alias("obj"), F.array(point(3, 5), point(7, 2), point(11, 13)).alias("points"))


def rasterize_polygons(spark, sf):
    return ops.rasterize(_triangles(spark, sf), SIZE).groupBy("obj").agg(F.count("*").alias("n"), F.sum("y").alias("sum_y"), F.sum("x").alias("sum_x"))


def polygon_boxes(spark, sf):
    return _triangles(spark, sf).select("obj", ops.box(F.col("points")).alias("b"), polygon_area(F.col("points")).alias("area")).select("obj", "b.*", "area")


def clip_polygons(spark, sf):
    cut = ops.clipped(F.col("points"), 4.0, 4.0, 12.0, 12.0)
    rows = _triangles(spark, sf).select("obj", cut.alias("points"))
    return rows.select("obj", F.size("points").alias("n"), F.when(F.size("points") >= 3, F.round(polygon_area(F.col("points")), 6)).otherwise(0.0).alias("area"))


def mask_polygons(spark, sf):
    """The outlines of all slice components, simplified by a pixel, as label text of unit coordinates."""
    rows = ops.outlines(masks.components(_cells(spark, sf, 0.0), 8, 8))
    return rows.select("t", "root", ops.label_line(F.lit(0), F.col("points"), 8.0, 8.0).alias("line"))


def label_lines(spark, sf):
    return _triangles(spark, sf).select("obj", ops.label_line(F.col("obj") % 4, F.col("points"), 30.0, 60.0).alias("line"))


def packed_slices(spark, sf):
    rows = _cells(spark, sf, 0.1).select((F.col("t") % 5).alias("layer"), F.floor(F.col("t") / 5).alias("t"), "y", "x")
    path = shared_path(spark, "packed")
    packed.pack(rows).write.partitionBy("layer").parquet(path)
    stored = spark.read.schema(packed.SCHEMA).parquet(path)
    return packed.unpack(stored.select(*(c.split()[0] for c in packed.SCHEMA.split(", "))))


QUERIES = {f.__name__: f for f in (rasterize_polygons, polygon_boxes, clip_polygons, label_lines, mask_polygons, packed_slices)}

P = """p AS (SELECT c_custkey AS obj, (c_custkey * 3 % 17 + 0.25)::DOUBLE AS x1, (c_custkey * 5 % 17 + 0.25)::DOUBLE AS y1, (c_custkey * 7 % 17 + 0.25)::DOUBLE AS x2, (c_custkey * 2 % 17 + 0.25)::DOUBLE AS y2,
  (c_custkey * 11 % 17 + 0.25)::DOUBLE AS x3, (c_custkey * 13 % 17 + 0.25)::DOUBLE AS y3 FROM customer)"""
HIT = "((a{i} > cy) <> (b{i} > cy) AND cx < px{i} + (cy - a{i}) * (qx{i} - px{i}) / (b{i} - a{i}))::INT"


def _clip_sql() -> str:
    """The four sides of the square from 4 to 12, one after the other."""
    steps = ["s0 AS (SELECT obj, [{'x': x1, 'y': y1}, {'x': x2, 'y': y2}, {'x': x3, 'y': y3}] AS p FROM p)"]
    for k, (axis, bound, keep) in enumerate((("x", 4.0, 1), ("x", 12.0, -1), ("y", 4.0, 1), ("y", 12.0, -1))):
        inside = lambda p: f"{keep} * ({p}.{axis} - {bound}::DOUBLE) >= 0"  # noqa: E731, B023
        a, b = "p[i]", "p[i % len(p) + 1]"
        place = lambda c: f"{bound}::DOUBLE" if c == axis else f"{a}.{c} + ({bound}::DOUBLE - {a}.{axis}) / ({b}.{axis} - {a}.{axis}) * ({b}.{c} - {a}.{c})"  # noqa: E731, B023
        steps.append(f"s{k + 1} AS (SELECT obj, flatten(list_transform(range(1, len(p) + 1), lambda i: list_concat(CASE WHEN {inside(a)} THEN [{a}] ELSE [] END, CASE WHEN ({inside(a)}) <> ({inside(b)}) THEN [{{'x': {place('x')}, 'y': {place('y')}}}] ELSE [] END))) AS p FROM s{k})")
    return ", ".join(steps)


ORACLES = {
    "clip_polygons": f"""WITH {P}, {_clip_sql()}
SELECT obj, len(p) AS n, CASE WHEN len(p) >= 3 THEN round(abs(list_sum(list_transform(range(1, len(p) + 1), lambda i: p[i].x * p[i % len(p) + 1].y - p[i].y * p[i % len(p) + 1].x))) / 2, 6) ELSE 0.0::DOUBLE END AS area FROM s4""",
    "rasterize_polygons": f"""WITH {P}, e AS (SELECT obj, x1 AS px1, y1 AS a1, x2 AS qx1, y2 AS b1, x2 AS px2, y2 AS a2, x3 AS qx2, y3 AS b2, x3 AS px3, y3 AS a3, x1 AS qx3, y1 AS b3 FROM p),
g AS (SELECT *, y + 0.5::DOUBLE AS cy, x + 0.5::DOUBLE AS cx FROM e, (SELECT unnest(range(16)) AS y), (SELECT unnest(range(16)) AS x)),
h AS (SELECT obj, y, x, {" + ".join(HIT.format(i=i) for i in (1, 2, 3))} AS n FROM g)
SELECT obj, count(*) AS n, sum(y)::BIGINT AS sum_y, sum(x)::BIGINT AS sum_x FROM h WHERE n % 2 = 1 GROUP BY obj""",
    "polygon_boxes": f"""WITH {P} SELECT obj, least(x1, x2, x3) AS x0, least(y1, y2, y3) AS y0, greatest(x1, x2, x3) AS x1, greatest(y1, y2, y3) AS y1,
  abs((x1 * y2 - x2 * y1) + (x2 * y3 - x3 * y2) + (x3 * y1 - x1 * y3)) / 2 AS area FROM p""",
    "label_lines": f"""WITH {P} SELECT obj, printf('%d %.6f %.6f %.6f %.6f %.6f %.6f', obj % 4, x1 / 30, y1 / 60, x2 / 30, y2 / 60, x3 / 30, y3 / 60) AS line FROM p""",
    "packed_slices": f"{V(0.1)} SELECT t % 5 AS layer, t // 5 AS t, y::BIGINT AS y, x::BIGINT AS x FROM voxels",
}
