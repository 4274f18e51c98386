"""Native unions of layers from labels, the union store and streamed fusion over vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratavox.operators import finalization as ops
from stratavox.plans.masks import V, _cells, _layers
from stratavox.session import shared_path
from stratavox.sources import unions
from stratavox.streaming import frontier, fusion


def native_union(spark, sf):
    """Ten layers folded, voids filled, smoothed, the three largest objects kept, and layer 5 put back."""
    layers = _layers(spark, sf)
    return ops.finalize(layers, 8, 50, ops.Filters(voids=6, sigma=0.7, keep=3), layers.where("ord = 5 AND x < 2"))


def union_store(spark, sf):
    """All masks of three artifacts, appended in two parts (the second one twice) and scanned with verification."""
    rows = _cells(spark, sf, 0.1).select(F.concat(F.lit("a"), F.col("label") % 3).alias("artifact"), F.col("t").alias("frame"), "y", "x")
    folder = shared_path(spark, "unions")
    for name, part in (("even", 0), ("odd", 1), ("odd", 1)):
        unions.append(rows.where(F.floor(F.col("frame") / unions.CHUNK) % 2 == part), folder, name)
    return unions.scan(spark, folder)


def stream_fusion(spark, sf):
    """Views of ten slices in four variants, one a vector; views that lack a slice do not come out."""
    rows = frontier.stream_of(spark, sf, "embeddings")
    at = F.filter(F.transform("embedding", lambda v, i: F.when(v > 0.1, i.cast("bigint"))), lambda i: i.isNotNull())
    packets = rows.select(
        F.floor(F.col("vec_id") / 40).cast("string").alias("view"), F.lit(10).cast("bigint").alias("n_slices"), F.lit(4).cast("bigint").alias("n_variants"), (F.col("vec_id") % 4).alias("variant"), F.floor(F.col("vec_id") % 40 / 4).alias("t"), at.alias("pixels")
    )
    out = shared_path(spark, "fusion")
    fusion.run(packets, out)
    return fusion.views(spark, out).select("view", "t", F.size("pixels").cast("bigint").alias("n_pixels"), F.aggregate("pixels", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("sum_px"))


QUERIES = {f.__name__: f for f in (native_union, union_store, stream_fusion)}
ORACLES = {
    "union_store": f"{V(0.1)} SELECT 'a' || (label % 3)::VARCHAR AS artifact, t AS frame, y::BIGINT AS y, x::BIGINT AS x FROM voxels",
    "stream_fusion": """WITH p AS (SELECT (vec_id // 40)::VARCHAR AS view, vec_id % 40 // 4 AS t, vec_id % 4 AS variant, unnest(range(0, 64)) AS px, unnest(embedding) AS v FROM embeddings WHERE len(embedding) = 64),
full_ AS (SELECT view FROM (SELECT view, t FROM p GROUP BY view, t HAVING count(DISTINCT variant) = 4) GROUP BY view HAVING count(*) = 10),
u AS (SELECT DISTINCT view, t, px FROM p WHERE v > 0.1::FLOAT), s AS (SELECT DISTINCT view, t FROM p JOIN full_ USING (view))
SELECT s.view, s.t, count(px) AS n_pixels, coalesce(sum(px), 0)::BIGINT AS sum_px FROM s LEFT JOIN u USING (view, t) GROUP BY s.view, s.t""",
}
