"""Deterministic views over the driver's tables in the shapes that the operators work on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def seconds_of(column: str, since: str = "1970-01-01"):
    """Whole seconds of a timestamp without zone since a day, whatever the session's zone."""
    return F.expr(f"timestampdiff(SECOND, timestamp_ntz'{since} 00:00:00', cast({column} AS timestamp_ntz))")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dataset candidates: documents with the annotation state and class of their label."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("__id"), "quality")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    rows = docs.join(labels, F.col("doc_id") == F.col("__id"), "left")
    return rows.select(
        "doc_id",
        F.col("source").alias("volume_name"),
        F.col("lang").alias("physical_view_id"),
        F.col("doc_id").alias("frame_idx"),
        F.lit("channel:gray:center").alias("presentation_variant_id"),
        F.lit("full").alias("geometry_item_id"),
        F.col("doc_id").alias("source_order"),
        F.when(F.col("quality").isNull(), 0).when(F.col("quality") == 0, 1).otherwise(2).alias("annotation_state"),
        F.coalesce(F.col("quality") == 1, F.lit(False)).alias("foreground"),
    )


def voxels(spark: SparkSession, sf_dir: str, threshold: float = 0.0) -> DataFrame:
    """Foreground voxels (t, y, x, label, v): one slice of eight columns a vector, values above the threshold."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("t"), "label", F.posexplode("embedding").alias("pos", "v"))
    cell = rows.select("t", (F.col("pos") / 8).cast("int").alias("y"), (F.col("pos") % 8).cast("int").alias("x"), "label", F.col("v").cast("double").alias("v"))
    return cell.where(F.col("v") > threshold)


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations (lineage, frame, forward, prob, event_id): one a row of events, frames of ten minutes."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("lineage"),
        F.floor(seconds_of("ts", "2024-01-01") / 600).alias("frame"),
        F.col("event_type").isin("view", "click").alias("forward"),
        (F.floor(F.col("value") * 100) % 100).cast("bigint").alias("score"),
    )


#: The same views for the SQL that results are compared with.
SQL = {
    "candidates": """candidates AS (
  SELECT d.doc_id, d.source AS volume_name, d.lang AS physical_view_id, d.doc_id AS frame_idx, 'channel:gray:center' AS presentation_variant_id,
         'full' AS geometry_item_id, d.doc_id AS source_order,
         CASE WHEN l.quality IS NULL THEN 0 WHEN l.quality = 0 THEN 1 ELSE 2 END AS annotation_state, coalesce(l.quality = 1, false) AS foreground
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)""",
    "voxels": """all_cells AS (
  SELECT vec_id AS t, label, unnest(range(0, len(embedding)::BIGINT)) AS pos, unnest(embedding)::DOUBLE AS v FROM embeddings
), voxels AS (SELECT t, (pos // 8)::INT AS y, (pos % 8)::INT AS x, label, v FROM all_cells WHERE v > {threshold})""",
    "frames": """frames AS (
  SELECT event_id, user_id AS lineage, (floor(epoch(ts)) - 1704067200)::BIGINT // 600 AS frame, event_type IN ('view', 'click') AS forward,
         (floor(value * 100)::BIGINT % 100)::BIGINT AS score FROM events)""",
}


def sql(*names: str, threshold: float = 0.0) -> str:
    """WITH clause of views."""
    return "WITH " + ", ".join(SQL[n].replace("{threshold}", repr(threshold)) for n in names)
