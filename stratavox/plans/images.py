"""Image trees written from the gray volumes of vectors and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratavox.plans.views import GRAYS, _grays
from stratavox.session import shared_path
from stratavox.sources import images


def _written(spark, sf, kind):
    images.register(spark)
    rows = _grays(spark, sf).groupBy("volume", F.col("t").alias("frame")).agg(F.sort_array(F.collect_list(F.struct("y", "x", "g"))).alias("all"))
    pixels = F.unhex(F.array_join(F.transform("all", lambda p: F.lpad(F.hex(p["g"]), 2, "0")), ""))
    folder = shared_path(spark, f"images-{kind}")
    rows.select(F.col("volume").cast("string").alias("volume"), "frame", F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(1).alias("channels"), pixels.alias("pixels")).write.format("image_tree").option("path", folder).option("kind", kind).mode("append").save()
    return folder


def _read(spark, folder):
    rows = spark.read.format("image_tree").option("path", folder).load()
    place = F.posexplode(F.sequence(F.lit(1), F.octet_length("pixels"))).alias("pos", "k")
    rows = rows.select(F.col("volume").cast("bigint").alias("volume"), F.col("frame").alias("t"), "width", F.hex("pixels").alias("hex"), place)
    return rows.select("volume", "t", F.floor(F.col("pos") / F.col("width")).alias("y"), (F.col("pos") % F.col("width")).cast("bigint").alias("x"), F.conv(F.substring("hex", F.col("pos") * 2 + 1, F.lit(2)), 16, 10).cast("bigint").alias("g"))


def image_tree_png(spark, sf):
    return _read(spark, _written(spark, sf, "png"))


def image_tree_tiff(spark, sf):
    return _read(spark, _written(spark, sf, "tif"))


def image_tree_check(spark, sf):
    """The frames of every volume of a published tree, and how many of its files the check finds fault with."""
    folder = _written(spark, sf, "png")
    frames = spark.read.format("image_tree").option("path", folder).load().groupBy("volume").agg(F.count("*").alias("frames"))
    faults = images.verify(spark, folder).groupBy(F.element_at(F.split("path", "/"), 1).alias("volume")).agg(F.count("*").alias("faults"))
    return frames.join(faults, "volume", "full_outer").select(F.col("volume").cast("bigint").alias("volume"), "frames", F.coalesce("faults", F.lit(0)).cast("bigint").alias("faults"))


QUERIES = {f.__name__: f for f in (image_tree_png, image_tree_tiff, image_tree_check)}
ORACLES = {
    "image_tree_png": f"WITH {GRAYS} SELECT volume, t, y, x, g FROM grays",
    "image_tree_tiff": f"WITH {GRAYS} SELECT volume, t, y, x, g FROM grays",
    "image_tree_check": "SELECT vec_id // 8 AS volume, count(*) AS frames, 0::BIGINT AS faults FROM embeddings GROUP BY vec_id // 8",
}
