"""Polygon label text: ``class x1 y1 x2 y2 ...`` with coordinates in [0, 1]."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_POINT = "array<struct<x:double,y:double>>"


def parse_polygons(lines: DataFrame, column: str = "value", strict: bool = False) -> DataFrame:
    """Adds class_id and points to text lines; bad lines go, or stop the query if ``strict``.

    A good line has a class, then three points or more in pairs. Leniently, coordinates are clamped to [0, 1]; strictly,
    they must lie there and the class must be 0.
    """
    parts = F.split(F.trim(column), r"\s+")
    numbers = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda v: v.try_cast("double"))
    rows = lines.withColumn("class_id", F.get(parts, 0).try_cast("int")).withColumn("__n", numbers)
    ok = F.col("class_id").isNotNull() & (F.size("__n") >= 6) & (F.size("__n") % 2 == 0) & F.forall("__n", lambda v: v.isNotNull())
    if strict:
        ok = ok & (F.col("class_id") == 0) & F.forall("__n", lambda v: v.between(0, 1))
        rows = rows.withColumn("__ok", F.when(F.coalesce(ok, F.lit(False)), True).otherwise(F.raise_error(F.concat(F.lit("bad polygon line: "), F.col(column))).cast("boolean"))).where("__ok")
    else:
        rows = rows.where(F.coalesce(ok, F.lit(False))).withColumn("__ok", F.lit(True))
    clamp = lambda v: F.greatest(F.lit(0.0), F.least(F.lit(1.0), v))
    points = F.transform(F.sequence(F.lit(0), (F.size("__n") / 2 - 1).cast("int")), lambda i: F.struct(clamp(F.get("__n", i * 2)).alias("x"), clamp(F.get("__n", i * 2 + 1)).alias("y")))
    return rows.withColumn("points", points.cast(_POINT)).drop("__n", "__ok")


def volume_files(paths: DataFrame, column: str = "path") -> DataFrame:
    """(volume, n, first, last, contiguous) of files named ``volume_index``; two files of one index stop the query."""
    name = F.regexp_extract(column, r"([^/]+?)_(\d+)(?:\.[^./]*)?$", 1)
    index = F.regexp_extract(column, r"([^/]+?)_(\d+)(?:\.[^./]*)?$", 2)
    rows = paths.select(name.alias("volume"), index.try_cast("bigint").alias("index")).where(F.col("index").isNotNull())
    out = rows.groupBy("volume").agg(F.count("*").alias("n"), F.countDistinct("index").alias("__d"), F.min("index").alias("first"), F.max("index").alias("last"))
    twice = F.when(F.col("__d") == F.col("n"), F.col("n")).otherwise(F.raise_error(F.concat(F.lit("two files of one index in "), F.col("volume"))).cast("bigint"))
    whole = (F.col("first").isin(0, 1)) & (F.col("last") - F.col("first") + 1 == F.col("n"))
    return out.withColumn("n", twice).withColumn("contiguous", whole).drop("__d")
