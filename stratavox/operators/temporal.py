"""Operators on integer frame axes: nearest-anchor domains, windows, interval merges, hand-offs and frontiers.

Intervals are half-open unless said otherwise. Everything is a window or an equi-join on the lineage; ranges of frames are
matched by running sums over sorted boundaries, not by comparing pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Frames of a session, frames that it advances.
SESSION, ADVANCE = 30, 29


def anchor_domains(anchors: DataFrame, start: int, stop: int) -> DataFrame:
    """(lineage, anchor, frame_start, frame_stop): the range nearest to each anchor, ties to the earlier one."""
    rows = anchors.select("lineage", F.col("frame").alias("anchor")).distinct()
    order = Window.partitionBy("lineage").orderBy("anchor")
    middle = lambda other: F.floor((F.col("anchor") + other) / 2) + 1
    before, after = F.lag("anchor").over(order), F.lead("anchor").over(order)
    return rows.select("lineage", "anchor", F.coalesce(middle(before), F.lit(start)).alias("frame_start"), F.coalesce(middle(after), F.lit(stop)).alias("frame_stop"))


def nearest_anchor(frames: DataFrame, anchors: DataFrame) -> DataFrame:
    """(lineage, frame, anchor): as-of join of distinct frames with the nearest anchor, ties to the earlier one."""
    a = anchors.select("lineage", "frame").distinct().withColumn("anchor", F.col("frame"))
    rows = frames.select("lineage", "frame").distinct().withColumn("anchor", F.lit(None).cast("bigint")).unionByName(a)
    order = Window.partitionBy("lineage").orderBy("frame")
    rows = rows.withColumns(
        {
            "below": F.last("anchor", ignorenulls=True).over(order.rangeBetween(Window.unboundedPreceding, 0)),
            "above": F.first("anchor", ignorenulls=True).over(order.rangeBetween(0, Window.unboundedFollowing)),
        }
    )
    nearer = F.when(F.col("above").isNull() | (F.col("frame") - F.col("below") <= F.col("above") - F.col("frame")), F.col("below")).otherwise(F.col("above"))
    return rows.where(F.col("anchor").isNull()).select("lineage", "frame", nearer.alias("anchor")).where("anchor is not null")


def domain_windows(domains: DataFrame) -> DataFrame:
    """The sessions of each domain: one around the anchor, then chains that overlap by a frame towards both ends."""
    size = F.col("frame_stop") - F.col("frame_start")
    left = F.greatest(F.col("frame_start"), F.col("anchor") - (SESSION - 1) // 2)
    stop = F.when(size <= SESSION, F.col("frame_stop")).otherwise(F.least(F.col("frame_stop"), left + SESSION))
    begin = F.when(size <= SESSION, F.col("frame_start")).otherwise(F.greatest(F.col("frame_start"), F.least(left, stop - SESSION)))
    rows = domains.withColumn("c0", begin).withColumn("c1", stop)
    n_back = F.ceil((F.col("c0") - F.col("frame_start")) / ADVANCE)
    n_front = F.ceil((F.col("frame_stop") - F.col("c1")) / ADVANCE)
    rows = rows.withColumn("k", F.explode(F.sequence(-n_back, n_front)))
    edge = F.when(F.col("k") < 0, F.col("c0") + (F.col("k") + 1) * ADVANCE).otherwise(F.col("c1") - 1 + (F.col("k") - 1) * ADVANCE)
    rows = rows.withColumn("edge", edge)
    pick = lambda back, center, front: F.when(F.col("k") < 0, back).when(F.col("k") == 0, center).otherwise(front)
    return rows.select(
        "lineage",
        "anchor",
        pick(F.lit("backward"), F.lit("center"), F.lit("forward")).alias("branch"),
        F.abs("k").alias("ordinal"),
        pick(F.greatest(F.col("frame_start"), F.col("edge") - ADVANCE), F.col("c0"), F.col("edge")).alias("window_start"),
        pick(F.col("edge") + 1, F.col("c1"), F.least(F.col("frame_stop"), F.col("edge") + SESSION)).alias("window_stop"),
        pick(F.col("edge"), F.col("anchor"), F.col("edge")).alias("prompt_frame"),
        F.when(F.col("k") == 0, "authoritative").otherwise("dogfood").alias("seed_kind"),
    )


def merge_intervals(rows: DataFrame, keys: list[str], gap: int = 0) -> DataFrame:
    """Islands of (start, stop) within ``keys``: intervals that overlap, touch or leave at most ``gap`` become one."""
    order = Window.partitionBy(*keys).orderBy("start", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("__new", F.coalesce((F.col("start") > reach + gap).cast("int"), F.lit(1)))
    rows = rows.withColumn("__island", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*keys, "__island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.count("*").alias("n")).drop("__island")


def covered_points(points: DataFrame, islands: DataFrame, keys: list[str], at: str) -> DataFrame:
    """``points`` with covered: whether some disjoint interval of the same keys holds ``at``; a running look-up, no range join."""
    p = points.withColumn("__at", F.col(at)).withColumn("__stop", F.lit(None).cast("bigint")).withColumn("__point", F.lit(True))
    i = islands.select(*keys, F.col("start").alias("__at"), F.col("stop").alias("__stop")).withColumn("__point", F.lit(False))
    both = p.unionByName(i, allowMissingColumns=True)
    order = Window.partitionBy(*keys).orderBy("__at").rangeBetween(Window.unboundedPreceding, 0)
    reach = F.max("__stop").over(order)
    return both.withColumn("covered", F.coalesce(reach > F.col("__at"), F.lit(False))).where("__point").drop("__at", "__stop", "__point")


def handoffs(candidates: DataFrame, coverage: DataFrame, edges: DataFrame, last_frame: int) -> DataFrame:
    """(lineage, frame, forward, handed): whether coverage holds all of a candidate's pixels and its next edge was observed.

    ``candidates`` and ``coverage`` are pixel tables (lineage, frame[, forward], px); ``edges`` are merged intervals
    (lineage, forward, start, stop) of observed transitions. At the end of the axis no transition is asked for.
    """
    keys = ["lineage", "frame", "forward"]
    novel = candidates.join(coverage.select("lineage", "frame", "px").distinct(), ["lineage", "frame", "px"], "left_anti").select(*keys).distinct().withColumn("novel", F.lit(True))
    seeds = candidates.select(*keys).distinct()
    edge = F.when(F.col("forward"), F.col("frame")).otherwise(F.col("frame") - 1)
    seeds = covered_points(seeds.withColumn("edge", edge), edges.select("lineage", "forward", "start", "stop"), ["lineage", "forward"], "edge")
    at_end = F.col("frame") == F.when(F.col("forward"), F.lit(last_frame)).otherwise(F.lit(0))
    handed = F.col("novel").isNull() & (F.col("covered") | at_end)
    return seeds.join(novel, keys, "left").select(*keys, handed.alias("handed"))


def prompt_support(candidates: DataFrame, coverage: DataFrame) -> DataFrame:
    """Candidate pixels together with the published pixels of the same lineage and frame."""
    keys = candidates.select("lineage", "frame").distinct()
    return candidates.select("lineage", "frame", "px").unionByName(coverage.select("lineage", "frame", "px").join(keys, ["lineage", "frame"], "left_semi")).distinct()


def sweep(frame: Column, forward: Column, n_frames: int) -> Column:
    """Number of the slab in which a mailbox is taken."""
    ahead = F.when(frame == n_frames - 1, F.ceil(F.lit((n_frames - 1) / ADVANCE))).otherwise(F.floor(frame / ADVANCE))
    back = F.when(frame == 0, F.lit(1)).otherwise(-F.floor((frame - 1) / ADVANCE))
    return F.when(forward, ahead).otherwise(back).cast("bigint")


def merge_offers(offers: DataFrame, n_frames: int) -> DataFrame:
    """Mailboxes: offers of one (lineage, tile, frame, direction) united, with their slab."""
    keys = ["lineage", "tile", "frame", "forward"]
    merged = offers.groupBy(*keys).agg(
        F.max("score").alias("score"),
        F.max("generation").alias("generation"),
        F.bit_or("provenance").alias("provenance"),
        F.array_sort(F.collect_set("px")).alias("pixels"),
        F.count("*").alias("n_offers"),
    )
    return merged.withColumn("sweep", sweep(F.col("frame"), F.col("forward"), n_frames))


def take_wave(mailboxes: DataFrame, most: int = 32) -> DataFrame:
    """The first ``most`` mailboxes, by key, of the first (direction, slab) group; forward comes first."""
    rows = mailboxes.withColumn("direction_order", F.when(F.col("forward"), 0).otherwise(1))
    first = rows.agg(F.min(F.struct("direction_order", "sweep")).alias("first"))  # one row
    rows = rows.crossJoin(F.broadcast(first)).where((F.col("direction_order") == F.col("first.direction_order")) & (F.col("sweep") == F.col("first.sweep")))
    return rows.drop("first", "direction_order").orderBy("lineage", "tile", "frame").limit(most)


def merge_mailboxes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Upsert: mailboxes of either side, united where both have one; dirty where pixels are new."""
    keys = ["lineage", "tile", "frame", "forward"]
    pair = old.alias("o").join(new.alias("n"), keys, "full_outer")
    both = lambda c, f: f(F.col(f"o.{c}"), F.col(f"n.{c}"))
    united = both("pixels", lambda a, b: F.array_sort(F.array_union(F.coalesce(a, F.array().cast("array<bigint>")), F.coalesce(b, F.array().cast("array<bigint>")))))
    dirty = F.size(united) > F.coalesce(F.size("o.pixels"), F.lit(0))
    return pair.select(*keys, both("score", F.greatest).alias("score"), both("generation", F.greatest).alias("generation"), united.alias("pixels"), dirty.alias("dirty"))


def monotonic_cut(rows: DataFrame, prior: float = 1.0) -> DataFrame:
    """(lineage, n_left, n_shared): how many shared frames come from the left, by the best sum of utilities.

    ``rows`` has (lineage, frame, left, right); prefix sums of the left and suffix sums of the right are compared for every
    cut, less ``prior`` times the distance from the middle over the span; ties go to the cut nearer the middle, then earlier.
    """
    order = Window.partitionBy("lineage").orderBy("frame")
    whole = Window.partitionBy("lineage")
    rows = rows.withColumns(
        {
            "prefix": F.sum("left").over(order.rowsBetween(Window.unboundedPreceding, 0)),
            "suffix": F.coalesce(F.sum("right").over(order.rowsBetween(1, Window.unboundedFollowing)), F.lit(0)),
            "k": F.row_number().over(order).cast("bigint"),
            "n": F.count("*").over(whole),
            "lo": F.min("frame").over(whole),
            "hi": F.max("frame").over(whole),
            "next": F.lead("frame").over(order),
            "total_right": F.sum("right").over(whole),
        }
    )
    after = rows.select("lineage", F.col("k"), "n", "lo", "hi", (F.col("prefix") + F.col("suffix")).alias("value"), F.coalesce((F.col("frame") + F.col("next")) / 2, F.col("frame") + 0.5).alias("cut"))
    none = rows.where("k = 1").select("lineage", F.lit(0).cast("bigint").alias("k"), "n", "lo", "hi", F.col("total_right").alias("value"), (F.col("lo") - 0.5).alias("cut"))
    cuts = after.unionByName(none)
    off = F.abs(F.col("cut") - (F.col("lo") + F.col("hi")) / 2)
    cuts = cuts.withColumn("off", off).withColumn("objective", F.col("value") - prior * off / F.greatest(F.lit(1), F.col("hi") - F.col("lo") + 1))
    best = F.max_by(F.struct("k", "n"), F.struct("objective", -F.col("off"), -F.col("k")))
    return cuts.groupBy("lineage").agg(best.alias("b")).select("lineage", F.col("b.k").alias("n_left"), F.col("b.n").alias("n_shared"))
