"""Dataset planning: deterministic splits, background caps and augmented copies, ranked by digests of identities.

No choice depends on row order or partitioning: every rank is a digest with explicit tie-breaks. Positions within a volume
come from counts by prefix of the digest, so no volume is sorted in one task; quotas are aggregated first and joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratavox.functions import hashing, numbers, ranks

#: Domains of the ranks, and the alphabet of tags.
SPLIT_DOMAIN = "PTA-v4.0.2-split-unit"
BACKGROUND_DOMAIN = "PTA-v4.0.2-background-retention"
AUGMENT_DOMAIN = "PTA-v4"
#: Frames of a view that are put in order together.
FRAMES = 1024
UNIT = ("volume_name", "physical_view_id", "frame_idx")


def identity(df: DataFrame | None = None) -> Column:
    """The source identity of a candidate."""
    return F.concat_ws(hashing.NUL, "volume_name", "physical_view_id", "presentation_variant_id", "geometry_item_id", F.col("frame_idx").cast("string"))


def split(candidates: DataFrame, train: float = 0.8, method: str = "slice") -> DataFrame:
    """Adds split_subset: of each volume's units (of all volumes, for "volume") the first by digest are train.

    A unit is a volume, a view of a volume or a frame of a view, by ``method``; half a unit counts for train, and a share of
    one puts everything there.
    """
    unit = {"volume": UNIT[:1], "view": UNIT[:2], "slice": UNIT}[method]
    units = candidates.select(*unit).distinct()
    scope = [] if method == "volume" else ["volume_name"]
    rank = hashing.json_digest(SPLIT_DOMAIN, *(F.col(c) for c in unit))
    size = units.groupBy(*scope).agg(F.count("*").alias("__n"))
    ranked = ranks.positions(units.withColumn("__rank", rank), scope, [ranks.bucket(F.col("__rank"))], [F.col("__rank"), *(F.col(c).cast("string") for c in unit)])
    ranked = ranked.join(size, scope) if scope else ranked.crossJoin(F.broadcast(size))  # one row
    subset = F.when((F.col("__nth") <= numbers.round_half_up(train * F.col("__n"))) | F.lit(train >= 1.0), "train").otherwise("val")
    return candidates.join(ranked.select(*unit, subset.alias("split_subset")), list(unit))


def background_rank(copy: Column | None = None) -> Column:
    return hashing.json_digest(BACKGROUND_DOMAIN, identity(), F.lit(0) if copy is None else copy)


def cap_background(candidates: DataFrame, share: float, by: tuple[str, ...] = ("volume_name", "split_subset")) -> DataFrame:
    """Adds keep: all foreground, and of the background of each group so many that it makes up ``share`` at most."""
    count = candidates.groupBy(*by).agg(F.count_if("foreground").alias("__fg"))
    rows = candidates.withColumn("__rank", background_rank())
    ranked = ranks.positions(rows, [*by, "foreground"], [ranks.bucket(F.col("__rank"))], [F.col("__rank"), F.col("source_order")]).join(count, list(by))
    limit = numbers.background_limit(F.col("__fg"), F.lit(share))
    return ranked.withColumn("keep", F.col("foreground") | limit.isNull() | (F.col("__nth") <= limit)).drop("__rank", "__nth", "__fg")


def augment(candidates: DataFrame, ratio: float, content: str, eligible: Column, by: tuple[str, ...] = ("volume_name",)) -> DataFrame:
    """Originals (augmentation_index 0) and their copies, with seeds.

    The eligible candidates of a group get round(ratio * n) versions together: each the same number of copies, and the
    first by (foreground, digest) one more.
    """
    rows = candidates.withColumn("__ok", eligible).withColumn("__id", identity())
    count = rows.groupBy(*by).agg(F.count_if("__ok").alias("__n"))
    total = F.greatest(F.lit(0), numbers.round_half_up(ratio * F.col("__n")) - F.col("__n"))
    rank = hashing.joined_digest(F.lit(AUGMENT_DOMAIN), F.lit("fractional-ratio-rank"), F.lit(content), F.col("__id"), F.lit(0), F.lit(0))
    later = F.when(F.col("foreground"), 0).otherwise(1)
    rows = ranks.positions(rows.withColumn("__rank", rank), [*by, "__ok"], [later, ranks.bucket(F.col("__rank"))], [later, F.col("__rank"), F.col("__id")]).join(count, list(by))
    each = F.floor(total / F.greatest(F.col("__n"), F.lit(1)))
    copies = F.when(F.col("__ok"), each + F.when(F.col("__nth") <= total - each * F.col("__n"), 1).otherwise(0)).otherwise(0).cast("int")
    rows = rows.withColumn("augmentation_index", F.explode(F.sequence(F.lit(0), copies)))
    digest = hashing.joined_digest(F.lit(AUGMENT_DOMAIN), F.lit("seed"), F.lit(content), F.col("__id"), F.col("augmentation_index"), F.lit(0))
    seed = F.when(F.col("augmentation_index") > 0, hashing.leading_u32(digest))
    return rows.withColumn("augmentation_seed", seed).drop("__ok", "__id", "__n", "__nth", "__rank")


def cap_augmented(versions: DataFrame, share: float, by: tuple[str, ...] = ("volume_name", "split_subset")) -> DataFrame:
    """Adds keep to originals and copies: original background comes first, then copies breadth-first by source."""
    count = versions.groupBy(*by).agg(F.count_if("foreground").alias("__fg"))
    rank = background_rank(F.col("augmentation_index"))
    rows = versions.withColumn("__rank", rank).withColumn("__id", identity()).withColumn("__copy", F.col("augmentation_index") > 0)
    within = Window.partitionBy("__id", "__copy", "foreground").orderBy("__rank", "source_order", "augmentation_index")
    rows = rows.withColumn("__depth", F.when(F.col("__copy"), F.row_number().over(within)).otherwise(0))
    order = [F.col(c) for c in ("__copy", "__depth", "__rank", "source_order", "augmentation_index")]
    rows = ranks.positions(rows, [*by, "foreground"], [*order[:2], ranks.bucket(F.col("__rank"))], order).join(count, list(by))
    limit = numbers.background_limit(F.col("__fg"), F.lit(share))
    return rows.withColumn("keep", F.col("foreground") | limit.isNull() | (F.col("__nth") <= limit)).drop("__rank", "__id", "__copy", "__depth", "__nth", "__fg")


def split_stats(planned: DataFrame, by: tuple[str, ...] = ("volume_name",)) -> DataFrame:
    """Counts of each subset, group by group and for all together."""
    counts = [
        F.count("*").alias("n"),
        F.count_if(F.col("split_subset") == "train").alias("n_train"),
        F.count_if("foreground").alias("n_foreground"),
        F.count_if("keep").alias("n_kept"),
        F.count_if(F.col("keep") & ~F.col("foreground")).alias("n_background_kept"),
    ]
    return planned.rollup(*by).agg(*counts)


def annotation_states(candidates: DataFrame) -> DataFrame:
    """Frames of each volume without annotation, annotated as background, and with foreground."""
    states = {"unannotated": 0, "background": 1, "foreground": 2}
    return candidates.groupBy("volume_name").agg(*(F.count_if(F.col("annotation_state") == v).alias(k) for k, v in states.items()))


def canonical_order(candidates: DataFrame) -> DataFrame:
    """Adds the position of each candidate in its volume: by view, then frame."""
    order = [F.col(c) for c in ("physical_view_id", "frame_idx", "source_order")]
    rows = ranks.positions(candidates, ["volume_name"], [order[0], F.floor(F.col("frame_idx") / FRAMES)], order)
    return rows.withColumn("order", (F.col("__nth") - 1).cast("bigint")).drop("__nth")
