"""Dataset planning over the candidates view."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratavox.operators import planning
from stratavox.sources.tables import candidates, sql

CONTENT = "cafe"


def dataset_split(spark, sf):
    rows = planning.cap_background(planning.split(candidates(spark, sf)), 0.25)
    return rows.select("doc_id", "volume_name", "physical_view_id", "split_subset", "foreground", "keep")


def volume_split(spark, sf):
    return planning.split(candidates(spark, sf), 0.6, "volume").groupBy("volume_name", "split_subset").agg(F.count("*").alias("n"))


def view_split(spark, sf):
    return planning.split(candidates(spark, sf), 0.5, "view").groupBy("volume_name", "physical_view_id", "split_subset").agg(F.count("*").alias("n"))


def background_cap(spark, sf):
    return planning.cap_background(candidates(spark, sf), 0.4, ("volume_name",)).select("doc_id", "foreground", "keep")


def dataset_stats(spark, sf):
    rows = planning.split_stats(planning.cap_background(planning.split(candidates(spark, sf)), 0.25))
    return rows.withColumn("volume_name", F.coalesce("volume_name", F.lit("*")))


def augment_plan(spark, sf):
    rows = planning.split(candidates(spark, sf))
    rows = planning.augment(rows, 2.3, CONTENT, F.col("split_subset") == "train")
    return rows.select("doc_id", "split_subset", "foreground", "augmentation_index", "augmentation_seed")


def augmented_background(spark, sf):
    rows = planning.augment(planning.split(candidates(spark, sf)), 2.3, CONTENT, F.col("split_subset") == "train")
    return planning.cap_augmented(rows, 0.6).select("doc_id", "augmentation_index", "foreground", "keep")


def annotation_states(spark, sf):
    return planning.annotation_states(candidates(spark, sf))


def candidate_order(spark, sf):
    return planning.canonical_order(candidates(spark, sf)).select("doc_id", "volume_name", "order")


QUERIES = {f.__name__: f for f in (dataset_split, volume_split, view_split, background_cap, dataset_stats, augment_plan, augmented_background, annotation_states, candidate_order)}

UNIT_HASH = """sha256('["PTA-v4.0.2-split-unit","' || volume_name || '","' || physical_view_id || '","' || frame_idx::VARCHAR || '"]')"""
SPLIT_SQL = f"""units AS (SELECT DISTINCT volume_name, physical_view_id, frame_idx FROM candidates),
ranked AS (SELECT *, row_number() OVER (PARTITION BY volume_name ORDER BY {UNIT_HASH}, volume_name, physical_view_id, frame_idx::VARCHAR) AS nth, count(*) OVER (PARTITION BY volume_name) AS n FROM units),
splits AS (SELECT c.*, CASE WHEN r.nth <= floor(0.8::DOUBLE * r.n + 0.5) THEN 'train' ELSE 'val' END AS split_subset
           FROM candidates c JOIN ranked r USING (volume_name, physical_view_id, frame_idx))"""
IDENT = r"volume_name || '\u0000' || physical_view_id || '\u0000' || presentation_variant_id || '\u0000' || geometry_item_id || '\u0000' || frame_idx::VARCHAR"
RAW_IDENT = "volume_name || chr(0) || physical_view_id || chr(0) || presentation_variant_id || chr(0) || geometry_item_id || chr(0) || frame_idx::VARCHAR"
BG_HASH = """sha256('["PTA-v4.0.2-background-retention","' || {ident} || '","' || {copy} || '"]')"""
BG0 = BG_HASH.format(ident=IDENT, copy="'0'")
CAP_SQL = f"""capped AS (SELECT *, row_number() OVER (PARTITION BY volume_name, split_subset, foreground ORDER BY {BG0}, source_order) AS bg_nth,
  count(*) FILTER (WHERE foreground) OVER (PARTITION BY volume_name, split_subset) AS fg FROM splits),
planned AS (SELECT *, foreground OR bg_nth <= floor(0.25::DOUBLE / (1 - 0.25::DOUBLE) * fg) AS keep FROM capped)"""
AUG = f"""counted AS (SELECT *, split_subset = 'train' AS ok, {RAW_IDENT} AS ident FROM splits),
totals AS (SELECT *, count(*) FILTER (WHERE ok) OVER (PARTITION BY volume_name) AS n_ok,
  row_number() OVER (PARTITION BY volume_name, ok ORDER BY foreground DESC, sha256('PTA-v4' || chr(0) || 'fractional-ratio-rank' || chr(0) || 'cafe' || chr(0) || ident || chr(0) || '0' || chr(0) || '0'), ident) AS aug_nth FROM counted),
wanted AS (SELECT *, greatest(0, floor(2.3::DOUBLE * n_ok + 0.5) - n_ok)::BIGINT AS total FROM totals),
copied AS (SELECT *, CASE WHEN ok THEN total // greatest(n_ok, 1) + CASE WHEN aug_nth <= total - (total // greatest(n_ok, 1)) * n_ok THEN 1 ELSE 0 END ELSE 0 END AS copies FROM wanted),
versions AS (SELECT *, unnest(range(0, copies + 1))::INT AS augmentation_index FROM copied)"""
SEED = "('0x' || substr(sha256('PTA-v4' || chr(0) || 'seed' || chr(0) || 'cafe' || chr(0) || ident || chr(0) || augmentation_index::VARCHAR || chr(0) || '0'), 1, 8))::BIGINT"
C = sql("candidates")
BGA = BG_HASH.format(ident=IDENT, copy="augmentation_index::VARCHAR")

ORACLES = {
    "dataset_split": f"{C}, {SPLIT_SQL}, {CAP_SQL} SELECT doc_id, volume_name, physical_view_id, split_subset, foreground, keep FROM planned",
    "volume_split": f"""{C}, units AS (SELECT DISTINCT volume_name FROM candidates),
ranked AS (SELECT *, row_number() OVER (ORDER BY sha256('["PTA-v4.0.2-split-unit","' || volume_name || '"]'), volume_name) AS nth, count(*) OVER () AS n FROM units)
SELECT c.volume_name, CASE WHEN nth <= floor(0.6::DOUBLE * n + 0.5) THEN 'train' ELSE 'val' END AS split_subset, count(*) AS n FROM candidates c JOIN ranked r USING (volume_name) GROUP BY 1, 2""",
    "view_split": f"""{C}, units AS (SELECT DISTINCT volume_name, physical_view_id FROM candidates),
ranked AS (SELECT *, row_number() OVER (PARTITION BY volume_name ORDER BY sha256('["PTA-v4.0.2-split-unit","' || volume_name || '","' || physical_view_id || '"]'), volume_name, physical_view_id) AS nth, count(*) OVER (PARTITION BY volume_name) AS n FROM units)
SELECT c.volume_name, c.physical_view_id, CASE WHEN nth <= floor(0.5::DOUBLE * n + 0.5) THEN 'train' ELSE 'val' END AS split_subset, count(*) AS n
FROM candidates c JOIN ranked r USING (volume_name, physical_view_id) GROUP BY 1, 2, 3""",
    "background_cap": f"""{C}, ranked AS (SELECT *, row_number() OVER (PARTITION BY volume_name, foreground ORDER BY {BG0}, source_order) AS nth,
  count(*) FILTER (WHERE foreground) OVER (PARTITION BY volume_name) AS fg FROM candidates)
SELECT doc_id, foreground, foreground OR nth <= floor(0.4::DOUBLE / (1 - 0.4::DOUBLE) * fg) AS keep FROM ranked""",
    "dataset_stats": f"""{C}, {SPLIT_SQL}, {CAP_SQL} SELECT coalesce(volume_name, '*') AS volume_name, count(*) AS n, count(*) FILTER (WHERE split_subset = 'train') AS n_train,
  count(*) FILTER (WHERE foreground) AS n_foreground, count(*) FILTER (WHERE keep) AS n_kept, count(*) FILTER (WHERE keep AND NOT foreground) AS n_background_kept FROM planned GROUP BY ROLLUP (volume_name)""",
    "augment_plan": f"{C}, {SPLIT_SQL}, {AUG} SELECT doc_id, split_subset, foreground, augmentation_index, CASE WHEN augmentation_index > 0 THEN {SEED} END AS augmentation_seed FROM versions",
    "augmented_background": f"""{C}, {SPLIT_SQL}, {AUG},
hashed AS (SELECT *, {BGA} AS h, augmentation_index > 0 AS is_copy, count(*) FILTER (WHERE foreground) OVER (PARTITION BY volume_name, split_subset) AS fg FROM versions),
deep AS (SELECT *, CASE WHEN is_copy THEN row_number() OVER (PARTITION BY ident, is_copy, foreground ORDER BY h, source_order, augmentation_index) ELSE 0 END AS depth FROM hashed),
nth AS (SELECT *, row_number() OVER (PARTITION BY volume_name, split_subset, foreground ORDER BY is_copy, depth, h, source_order, augmentation_index) AS pos FROM deep)
SELECT doc_id, augmentation_index, foreground, foreground OR pos <= floor(0.6::DOUBLE / (1 - 0.6::DOUBLE) * fg) AS keep FROM nth""",
    "annotation_states": f"""{C} SELECT volume_name, count(*) FILTER (WHERE annotation_state = 0) AS unannotated, count(*) FILTER (WHERE annotation_state = 1) AS background,
  count(*) FILTER (WHERE annotation_state = 2) AS foreground FROM candidates GROUP BY volume_name""",
    "candidate_order": f"""{C} SELECT doc_id, volume_name, row_number() OVER (PARTITION BY volume_name ORDER BY physical_view_id, frame_idx, source_order) - 1 AS "order" FROM candidates""",
}
