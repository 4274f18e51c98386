"""Ledgers and selections: acknowledgements, coverage packets, composed sources, frames of plans, components compared.

All of these are joins, windows and conditional aggregates over small keyed rows.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratavox.functions import numbers, ranks
from stratavox.operators.planning import background_rank, identity


def revision(pixels: Column) -> Column:
    """Digest of a mailbox's foreground, whatever the order it was offered in."""
    return F.md5(F.array_join(F.array_sort(F.array_distinct(pixels)), ",").cast("binary"))


def acknowledge(mailboxes: DataFrame, leased: DataFrame, keys: list[str]) -> DataFrame:
    """Mailboxes (keys, revision, dirty) after the ``leased`` ones (keys, revision as taken) are done.

    A leased mailbox stays dirty only if its revision has moved since; the others are as they were.
    """
    taken = leased.select(*keys, F.col("revision").alias("processed"))
    rows = mailboxes.join(taken, keys, "left")
    return rows.withColumn("dirty", F.when(F.col("processed").isNull(), F.col("dirty")).otherwise(F.col("revision") != F.col("processed")))


def frontier_stats(mailboxes: DataFrame) -> DataFrame:
    """One row: mailboxes, dirty ones, their lineages and foreground pixels; zeros where there is none."""
    none = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return mailboxes.agg(F.count("*").alias("mailboxes"), F.count_if("dirty").alias("dirty"), F.count_distinct("lineage").alias("lineages"), none(F.sum("n_pixels")).alias("pixels"))


def packet_status(packets: DataFrame, ledger: DataFrame) -> DataFrame:
    """(work_id, sha256, status) of packets: new, duplicate, or changed, which is an error and must not be taken in.

    A work_id that comes with several digests at once is changed, too.
    """
    many = packets.groupBy("work_id").agg(F.count_distinct("sha256").alias("__n"))
    known = ledger.select("work_id", F.col("sha256").alias("__known"))
    rows = packets.select("work_id", "sha256").distinct().join(many, "work_id").join(known, "work_id", "left")
    status = F.when((F.col("__n") > 1) | (F.col("__known") != F.col("sha256")), "changed").when(F.col("__known").isNotNull(), "duplicate").otherwise("new")
    return rows.select("work_id", "sha256", status.alias("status"))


def ingest_masks(ledger: DataFrame, packets: DataFrame, status: DataFrame, key: list[str]) -> DataFrame:
    """Covered pixels (key, px) of the ledger with those of new packets (work_id, key, px) merged in; each once."""
    fresh = packets.join(status.where("status = 'new'").select("work_id"), "work_id", "left_semi")
    return ledger.select(*key, "px").unionByName(fresh.select(*key, "px")).distinct()


def coverage_stats(masks: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: covered frames and pixels, merged directed ranges and the transitions that they cover."""
    a = masks.agg(F.count_distinct("lineage", "frame").alias("masked_frames"), F.count("px").alias("foreground_pixels"))
    b = edges.agg(F.count("*").alias("ranges"), F.coalesce(F.sum(F.col("stop") - F.col("start")), F.lit(0)).cast("bigint").alias("transitions"))
    return a.join(F.broadcast(b))  # one row each


def union_frames(tracks: DataFrame, *keys: str) -> DataFrame:
    """(keys, frame, n_pixels, prob, authoritative) of tracks (keys, obj, frame, px, prob, authoritative) joined into one."""
    return tracks.groupBy(*keys, "frame").agg(F.count_distinct("px").alias("n_pixels"), F.max("prob").alias("prob"), F.bool_or("authoritative").alias("authoritative"))


def composed_sources(left: DataFrame, right: DataFrame, cut: DataFrame) -> DataFrame:
    """(lineage, frame, source, reason): which side gives each frame of a matched pair.

    Authority comes first, then the side that the cut prefers, then whichever side there is. Two authoritative masks that
    differ (by ``revision``) are a conflict.
    """
    side = lambda df, s: df.select("lineage", "frame", F.col("authoritative").alias(f"auth_{s}"), F.col("revision").alias(f"rev_{s}"))
    rows = side(left, "l").join(side(right, "r"), ["lineage", "frame"], "full_outer").join(cut.select("lineage", "cut"), "lineage")
    has_l, has_r, prefer = F.col("rev_l").isNotNull(), F.col("rev_r").isNotNull(), F.col("frame") < F.col("cut")
    both, al, ar = has_l & has_r, F.coalesce("auth_l", F.lit(False)), F.coalesce("auth_r", F.lit(False))
    take_left = F.when(both & al & ~ar, True).when(both & ar & ~al, False).when(both, prefer).otherwise(has_l)
    agreed = F.when(both & al & ar, F.when(F.col("rev_l") == F.col("rev_r"), "coincident_authoritative_equal").otherwise("conflict"))
    forced = F.when(both & (al | ar), F.when(F.col("__left") == prefer, "authoritative_cut").otherwise("authoritative_override"))
    plain = F.when(F.col("__left") == prefer, "monotonic_cut").otherwise("sparse_fallback")
    rows = rows.withColumn("__left", take_left)
    return rows.select("lineage", "frame", F.when(F.col("__left"), "left").otherwise("right").alias("source"), F.coalesce(agreed, forced, plain).alias("reason"))


def withhold_overage(versions: DataFrame, flips: DataFrame, share: float) -> DataFrame:
    """``versions`` (as capped, with keep) after ``flips`` (split_subset, flips) of foreground turned out to be background.

    Each subset's limit follows from the foreground that is left; background over it goes from the tail of the order in
    which it was admitted: originals by rank, then copies breadth-first by source.
    """
    rows = versions.join(flips, "split_subset", "left").withColumn("__copy", F.col("augmentation_index") > 0)
    count = rows.groupBy("split_subset").agg(F.greatest(F.lit(0), F.count_if(F.col("keep") & F.col("foreground")) - F.coalesce(F.max("flips"), F.lit(0))).alias("__fg"))
    rows = rows.withColumns({"__rank": background_rank(F.col("augmentation_index")), "__id": identity(), "__bg": F.col("keep") & ~F.col("foreground")})
    within = Window.partitionBy("split_subset", "__id", "__copy", "__bg").orderBy("__rank", "source_order", "augmentation_index")
    rows = rows.withColumn("__depth", F.when(F.col("__copy"), F.row_number().over(within)).otherwise(0))
    order = [F.col(c) for c in ("__copy", "__depth", "__rank", "source_order", "augmentation_index")]
    rows = ranks.positions(rows, ["split_subset", "__bg"], [*order[:2], ranks.bucket(F.col("__rank"))], order).join(count, "split_subset")
    over = F.col("__bg") & (F.coalesce("flips", F.lit(0)) > 0) & F.coalesce(F.col("__nth") > numbers.background_limit(F.col("__fg"), F.lit(share)), F.lit(False))
    return rows.withColumn("keep", F.col("keep") & ~over).drop("flips", "__copy", "__fg", "__rank", "__id", "__bg", "__depth", "__nth")


def offsets_of(counts: DataFrame, key: str, *groups: str) -> DataFrame:
    """Adds first and last: the half-open range of each key's rows where all are laid end to end, in order of key."""
    order = Window.partitionBy(*groups).orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("last", F.sum("n").over(order)).withColumn("first", F.col("last") - F.col("n"))


def round_robin(plans: DataFrame, eligible: DataFrame) -> DataFrame:
    """(nth, plan, frame): the frames of all plans (plan, num_slices), frame by frame across plans; ``eligible`` (plan, frame) limits the plans it names."""
    rows = plans.select("plan", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("num_slices") - 1)).alias("frame"))
    named = eligible.select("plan").distinct().withColumn("__named", F.lit(True))
    rows = rows.join(named, "plan", "left").join(eligible.select("plan", "frame").distinct().withColumn("__ok", F.lit(True)), ["plan", "frame"], "left")
    rows = rows.where(F.col("__named").isNull() | F.col("__ok")).select("plan", "frame")
    by_frame = rows.groupBy("frame").agg(F.count("*").alias("n"))  # places from counts by frame: no frame's rows are sorted with all others
    places = offsets_of(by_frame, "frame").select("frame", "first")
    within = F.row_number().over(Window.partitionBy("frame").orderBy("plan"))
    return rows.join(places, "frame").select((F.col("first") + within - 1).alias("nth"), "plan", "frame")


def annotation_class(frames: DataFrame) -> DataFrame:
    """(volume, class) from frames (volume, state): labelled if all are annotated, partial if some are, else unlabelled."""
    n = frames.groupBy("volume").agg(F.count("*").alias("n"), F.count_if(F.col("state") > 0).alias("m"))
    return n.select("volume", F.when(F.col("m") == 0, "unlabelled").when(F.col("m") < F.col("n"), "partial").otherwise("labelled").alias("class"))


def aligned_labels(frames: DataFrame, labels: DataFrame) -> DataFrame:
    """(volume, frame, label_file): image frames (volume, frame, number) with the label of their number, null without one."""
    return frames.join(labels.select("volume", "number", "label_file"), ["volume", "number"], "left").select("volume", "frame", "label_file")


def window_tasks(windows: DataFrame) -> DataFrame:
    """(lineage, anchor, branch, ordinal, parent_branch, parent): each window with the one it starts from; the centre has none."""
    parent = F.when(F.col("ordinal") == 1, "center").when(F.col("ordinal") > 1, F.col("branch"))
    return windows.select("lineage", "anchor", "branch", "ordinal", parent.alias("parent_branch"), F.when(F.col("ordinal") > 0, F.col("ordinal") - 1).alias("parent"))


def relay_ends(episodes: DataFrame) -> DataFrame:
    """(lineage, frame, forward): what an overlap episode (lineage, start, stop) relays: forward from its first frame, backward from its last."""
    ends = F.array(F.struct(F.col("start").alias("frame"), F.lit(True).alias("forward")), F.struct((F.col("stop") - 1).alias("frame"), F.lit(False).alias("forward")))
    return episodes.select("lineage", F.explode(ends).alias("e")).select("lineage", "e.*").distinct()


def proto_mask(instances: DataFrame, prototypes: DataFrame, coefficients: DataFrame) -> DataFrame:
    """(image, y, x, logit): pixels where some instance's mask is positive, with the greatest logit.

    An instance's logit is the sum of its coefficients (instance, k, c) times the prototypes (k, y, x, p).
    """
    logits = coefficients.join(prototypes, "k").groupBy("instance", "y", "x").agg(F.sum(F.col("c") * F.col("p")).alias("logit"))
    best = logits.join(instances, "instance").groupBy("image", "y", "x").agg(F.max("logit").alias("logit"))
    return best.where("logit > 0")


def tracker_scores(rows: DataFrame, removed: float = -1024.0) -> DataFrame:
    """Tracker logits as probabilities; rows at the value that stands for a removed object go."""
    return rows.where(F.col("logit") > removed).withColumn("prob", 1 / (1 + F.exp(-F.col("logit"))))


def component_match(prediction: DataFrame, truth: DataFrame, at: list[str]) -> DataFrame:
    """One row: components of the truth that are split over several of the prediction or missed, and the other way round."""
    hits = prediction.select(*at, F.col("root").alias("p")).join(truth.select(*at, F.col("root").alias("g")), at).select("p", "g").distinct()
    n = lambda df, key: df.groupBy(key).agg(F.count("*").alias("n"))
    one = lambda df, *c: df.agg(*c)
    parts = [
        one(n(hits, "g"), F.count_if(F.col("n") > 1).alias("split"), F.count("*").alias("found")),
        one(n(hits, "p"), F.count_if(F.col("n") > 1).alias("merged"), F.count("*").alias("matched")),
        one(truth, F.count_distinct("root").alias("truth")),
        one(prediction, F.count_distinct("root").alias("predicted")),
    ]
    row = functools.reduce(lambda a, b: a.join(F.broadcast(b)), parts)  # one row each
    return row.select("truth", "predicted", "split", "merged", (F.col("truth") - F.col("found")).alias("missed"), (F.col("predicted") - F.col("matched")).alias("false"))


def clear_flanks(labelled: DataFrame, mask: DataFrame, reach: int, share: float = 0.01) -> DataFrame:
    """Roots of slice components whose pixels recur in at most ``share`` of the ``reach`` slices on each side together."""
    area = labelled.groupBy("root").agg(F.count("*").alias("n"))
    steps = F.array(*(F.lit(d) for d in range(-reach, reach + 1) if d))
    moved = labelled.withColumn("__d", F.explode(steps)).select("root", "y", "x", (F.col("t") + F.col("__d")).alias("t"))
    hits = moved.join(mask.select("t", "y", "x"), ["t", "y", "x"], "left_semi").groupBy("root").agg(F.count("*").alias("hits"))
    rows = area.join(hits, "root", "left")
    return rows.where(F.coalesce("hits", F.lit(0)) <= share * F.col("n") * 2 * reach).select("root")


def slab_ranges(volumes: DataFrame, most: int) -> DataFrame:
    """(volume, slab, start, stop): slices of each volume (volume, n_t) in as few slabs of ``most`` as hold them, evenly."""
    n = F.ceil(F.col("n_t") / most).cast("bigint")
    rows = volumes.select("volume", "n_t", n.alias("__n"), F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)).alias("slab"))
    edge = lambda k: F.floor(k * F.col("n_t") / F.col("__n"))
    return rows.select("volume", "slab", edge(F.col("slab")).alias("start"), edge(F.col("slab") + 1).alias("stop"))


def tile_overlap(pixels: DataFrame, tiles: DataFrame) -> DataFrame:
    """(obj_l, obj_r, frame, inter, iou): objects of different tiles (tile, obj, frame, y, x) that share canvas pixels."""
    on = ["frame", "gy", "gx"]
    placed = pixels.join(tiles.select("tile", "left", "top"), "tile").select("tile", "obj", "frame", (F.col("y") + F.col("top")).alias("gy"), (F.col("x") + F.col("left")).alias("gx"))
    area = placed.groupBy("obj", "frame").agg(F.count("*").alias("n"))
    side = lambda s: placed.select(F.col("tile").alias(f"tile_{s}"), F.col("obj").alias(f"obj_{s}"), *on)
    inter = side("l").join(side("r"), on).where("tile_l < tile_r").groupBy("obj_l", "obj_r", "frame").agg(F.count("*").alias("inter"))
    of = lambda s: area.select(F.col("obj").alias(f"obj_{s}"), "frame", F.col("n").alias(f"n_{s}"))
    out = inter.join(of("l"), ["obj_l", "frame"]).join(of("r"), ["obj_r", "frame"])
    return out.select("obj_l", "obj_r", "frame", "inter", (F.col("inter") / (F.col("n_l") + F.col("n_r") - F.col("inter"))).alias("iou"))


def dihedral(mask: DataFrame, size: int, code: Column) -> DataFrame:
    """Square masks under the symmetry ``code`` 0 to 7: bit 0 mirrors x, bit 1 mirrors y, bit 2 then swaps the axes."""
    bit = lambda k: F.shiftright(code.cast("int"), k).bitwiseAND(1) == 1
    rows = mask.withColumns({"__y": F.when(bit(1), size - 1 - F.col("y")).otherwise(F.col("y")), "__x": F.when(bit(0), size - 1 - F.col("x")).otherwise(F.col("x")), "__s": bit(2)})
    return rows.withColumns({"y": F.when(F.col("__s"), F.col("__x")).otherwise(F.col("__y")), "x": F.when(F.col("__s"), F.col("__y")).otherwise(F.col("__x"))}).drop("__y", "__x", "__s")


def overlay(grays: DataFrame, mask: DataFrame, at: list[str]) -> DataFrame:
    """(at, r, g, b): gray pixels, half blue where the mask is set (halves to even)."""
    rows = grays.join(mask.select(*at).distinct().withColumn("__on", F.lit(True)), at, "left")
    half = lambda other: F.when(F.col("__on"), F.rint((F.col("v") + other) / 2)).otherwise(F.col("v")).cast("bigint")
    return rows.withColumnRenamed("g", "v").select(*at, half(0).alias("r"), half(0).alias("g"), half(255).alias("b"))


def voxel_report(layers: DataFrame, spacing: tuple[float, float, float]) -> DataFrame:
    """(layer, voxels, volume): size of each layer in voxels and in the spacing's units."""
    return layers.groupBy("layer").agg(F.count("*").alias("voxels")).withColumn("volume", F.round(F.col("voxels") * math.prod(spacing), 6))


def physical_views(masks: DataFrame) -> DataFrame:
    """(view, t, y, x): the angle variants (view, variant, t, y, x) of each physical view in one."""
    return masks.select("view", "t", "y", "x").distinct()
