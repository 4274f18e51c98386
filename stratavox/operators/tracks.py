"""Tracks and objects: tile owners, union hypotheses, gates on metrics, runs along branches, peaks and session packing."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Objects of a session, and how much of an object must be its own.
SESSION_OBJECTS, EXCLUSIVE = 128, 0.95


def tile_owners(boxes: DataFrame, tiles: DataFrame, size: int) -> DataFrame:
    """(canvas, obj, tile): the tile that holds an object whole with the widest margin, else every tile that it touches.

    ``boxes`` (canvas, obj, x0, y0, x1, y1) and ``tiles`` (canvas, tile, left, top) meet in cells of the canvas as large as a
    tile, of which a tile touches four at most; ties go to the lower tile.
    """
    cells = lambda lo, hi: F.explode(F.sequence(F.floor(lo / size), F.floor((hi - 1) / size)))
    boxes = boxes.where((F.col("x1") > F.col("x0")) & (F.col("y1") > F.col("y0"))).withColumn("cx", cells(F.col("x0"), F.col("x1"))).withColumn("cy", cells(F.col("y0"), F.col("y1")))
    tiles = tiles.withColumn("cx", cells(F.col("left"), F.col("left") + size)).withColumn("cy", cells(F.col("top"), F.col("top") + size))
    pairs = boxes.join(tiles, ["canvas", "cx", "cy"]).drop("cx", "cy").distinct().where((F.col("x0") < F.col("left") + size) & (F.col("x1") > F.col("left")) & (F.col("y0") < F.col("top") + size) & (F.col("y1") > F.col("top")))
    margin = F.least(F.col("x0") - F.col("left"), F.col("y0") - F.col("top"), F.col("left") + size - F.col("x1"), F.col("top") + size - F.col("y1"))
    key = Window.partitionBy("canvas", "obj")
    pairs = pairs.withColumn("margin", margin).withColumn("whole", F.max("margin").over(key) >= 0)
    pairs = pairs.withColumn("nth", F.row_number().over(key.orderBy(F.col("margin").desc(), "tile")))
    return pairs.where(~F.col("whole") | (F.col("nth") == 1)).select("canvas", "obj", "tile")


def gate_failures(gates: dict[str, Column]) -> Column:
    """Names of the gates that don't hold, in order; an unknown one fails."""
    return F.filter(F.array(*(F.when(F.coalesce(ok, F.lit(False)), F.lit(None).cast("string")).otherwise(F.lit(name)) for name, ok in gates.items())), lambda s: s.isNotNull())


def similarity(terms: dict[str, float]) -> Column:
    """Weighted mean of metrics; an unknown one counts as zero."""
    total = sum(terms.values())
    value = F.lit(0.0)
    for c, w in terms.items():
        value = value + w * F.coalesce(F.col(c), F.lit(0.0))
    return value / total


def union_hypotheses(left: DataFrame, right: DataFrame, shortlist: int = 4) -> DataFrame:
    """(obj_l, a, b, gain): the pair of right tracks whose union overlaps a left one best, and by how much more than either.

    Only the ``shortlist`` best partners of a left track are paired, as the method has it; pixels meet by equi-joins.
    """
    px = ["frame", "y", "x"]
    area = left.groupBy("obj").agg(F.count("*").alias("n_l"))
    hits = left.select(F.col("obj").alias("obj_l"), *px).join(right.select(F.col("obj").alias("obj_r"), *px), px)
    inter = hits.groupBy("obj_l", "obj_r").agg(F.count("*").alias("inter"))
    size = right.groupBy(F.col("obj").alias("obj_r")).agg(F.count("*").alias("n_r"))
    one = inter.join(size, "obj_r").join(area.withColumnRenamed("obj", "obj_l"), "obj_l").withColumn("iou", F.col("inter") / (F.col("n_l") + F.col("n_r") - F.col("inter")))
    best = one.withColumn("nth", F.row_number().over(Window.partitionBy("obj_l").orderBy(F.col("iou").desc(), "obj_r"))).where(F.col("nth") <= shortlist)
    a = best.select("obj_l", F.col("obj_r").alias("a"), F.col("iou").alias("iou_a"), "n_l")
    pairs = a.join(best.select("obj_l", F.col("obj_r").alias("b"), F.col("iou").alias("iou_b")), "obj_l").where("a < b")
    members = pairs.select("obj_l", "a", "b", F.explode(F.array("a", "b")).alias("obj"))
    union = members.join(right, "obj").select("obj_l", "a", "b", *px).distinct()
    whole = union.groupBy("obj_l", "a", "b").agg(F.count("*").alias("n_u"))
    both = union.join(left.select(F.col("obj").alias("obj_l"), *px), ["obj_l", *px]).groupBy("obj_l", "a", "b").agg(F.count("*").alias("inter"))
    rows = pairs.join(whole, ["obj_l", "a", "b"]).join(both, ["obj_l", "a", "b"])
    gain = F.col("inter") / (F.col("n_l") + F.col("n_u") - F.col("inter")) - F.greatest("iou_a", "iou_b")
    rows = rows.withColumn("gain", F.round(gain, 9))
    return rows.withColumn("nth", F.row_number().over(Window.partitionBy("obj_l").orderBy(F.col("gain").desc(), "a", "b"))).where("nth = 1").select("obj_l", "a", "b", "gain")


def _unions(one: DataFrame, many: DataFrame, shortlist: int, members: int) -> DataFrame:
    """(obj, members, iou, gain): of each track of ``one`` the union of 2 to ``members`` tracks of ``many`` that overlaps it best.

    A track's ``shortlist`` best partners get a bit each. Every pixel of the track or its partners has the bits of those that hold
    it, and the pixels are counted by bits once; the overlap with any union follows from these few counts.
    """
    px = ["frame", "y", "x"]
    one, many = (df.select(F.col("obj").cast("bigint").alias("obj"), *px).distinct() for df in (one, many))
    size = lambda df, name: df.groupBy("obj").agg(F.count("*").alias(name))
    hits = one.join(many.withColumnRenamed("obj", "other"), px).groupBy("obj", "other").agg(F.count("*").alias("inter"))
    pairs = hits.join(size(one, "n"), "obj").join(size(many, "m").withColumnRenamed("obj", "other"), "other").withColumn("iou", F.col("inter") / (F.col("n") + F.col("m") - F.col("inter")))
    rank = F.row_number().over(Window.partitionBy("obj").orderBy(F.col("iou").desc(), "other")) - 1
    best = pairs.withColumn("bit", rank).where(F.col("bit") < shortlist).select("obj", "other", "bit", "iou", "n")
    theirs = best.join(many.withColumnRenamed("obj", "other"), "other").select("obj", *px, F.expr("shiftleft(2, bit)").alias("bits"))
    pixels = one.withColumn("bits", F.lit(1)).unionByName(theirs).groupBy("obj", *px).agg(F.bit_or("bits").alias("bits"))
    counts = pixels.groupBy("obj", "bits").agg(F.count("*").alias("k"))
    sets = [m for m in range(1 << shortlist) if 2 <= m.bit_count() <= members]
    tries = counts.withColumn("set", F.explode(F.array(*map(F.lit, sets))))
    in_set, own = F.expr("((bits div 2) & set) <> 0"), F.expr("(bits & 1) = 1")
    sums = tries.groupBy("obj", "set").agg(F.sum(F.when(in_set & own, F.col("k")).otherwise(0)).alias("inter"), F.sum(F.when(in_set | own, F.col("k")).otherwise(0)).alias("union"))
    listed = best.groupBy("obj").agg(F.sort_array(F.collect_list(F.struct("bit", "other", "iou"))).alias("all"))
    rows = sums.join(listed, "obj").withColumn("in", F.filter("all", lambda p: F.col("set").bitwiseAND(F.pow(F.lit(2), p["bit"]).cast("int")) != 0))
    rows = rows.where(F.size("in") == F.bit_count("set"))  # every member is there
    rows = rows.withColumns({"iou": F.col("inter") / F.col("union"), "single": F.array_max(F.transform("in", lambda p: p["iou"]))})
    top = F.max_by(F.struct(F.sort_array(F.transform("in", lambda p: p["other"])).alias("members"), "iou", (F.col("iou") - F.col("single")).alias("gain")), F.struct(F.round("iou", 12), -F.size("in"), -F.col("set"))).alias("b")
    return rows.groupBy("obj").agg(top).select("obj", "b.*")


def residual_hypotheses(left: DataFrame, right: DataFrame, shortlist: int = 4, members: int = 3, least: float = 0.0, gain: float = 0.0) -> DataFrame:
    """(kind, obj, members, iou, gain): left tracks that are split over right ones, and right tracks that are merged from left ones.

    Of a track the best union counts (by overlap, then fewer members, then better ones); it is told if its overlap reaches
    ``least`` and it gains more than ``gain`` on its best member.
    """
    both = _unions(left, right, shortlist, members).withColumn("kind", F.lit("split")).unionByName(_unions(right, left, shortlist, members).withColumn("kind", F.lit("merge")))
    return both.where((F.col("iou") >= least) & (F.col("gain") > gain)).select("kind", "obj", "members", "iou", "gain")


def flagged_runs(samples: DataFrame, least: int = 3, gap: int = 2, flank: int = 3) -> DataFrame:
    """(branch, start, stop, n): runs of flagged samples (branch, arc, bad), gaps of ``gap`` closed, with clean flanks.

    A run needs ``least`` samples from its first to its last flagged one and ``flank`` clean ones on both sides.
    """
    bad = samples.where("bad").select("branch", "arc")
    order = Window.partitionBy("branch").orderBy("arc")
    rows = bad.withColumn("new", F.coalesce((F.col("arc") - F.lag("arc").over(order) > gap + 1).cast("int"), F.lit(1)))
    rows = rows.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = rows.groupBy("branch", "run").agg(F.min("arc").alias("start"), F.max("arc").alias("stop"), F.count("*").alias("n"))
    whole = samples.groupBy("branch").agg(F.min("arc").alias("lo"), F.max("arc").alias("hi"))
    by_run = Window.partitionBy("branch").orderBy("start")
    runs = runs.join(whole, "branch").withColumn("before", F.coalesce(F.lag("stop").over(by_run), F.col("lo") - 1)).withColumn("after", F.coalesce(F.lead("start").over(by_run), F.col("hi") + 1))
    ok = (F.col("stop") - F.col("start") + 1 >= least) & (F.col("start") - F.col("before") > flank) & (F.col("after") - F.col("stop") > flank)
    return runs.where(ok).select("branch", "start", "stop", "n")


def peaks(points: DataFrame, reach: int) -> DataFrame:
    """(t, y, x, r): points kept in order of falling r, each if no kept one of the slice is within ``reach``; a group is a slice."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        kept: list[tuple[int, int]] = []
        rows = []
        for row in pdf.sort_values(["r", "y", "x"], ascending=[False, True, True]).itertuples():
            if all((row.y - a) ** 2 + (row.x - b) ** 2 > reach * reach for a, b in kept):
                kept.append((row.y, row.x))
                rows.append((row.t, row.y, row.x, row.r))
        return pd.DataFrame(rows, columns=["t", "y", "x", "r"])

    return points.select("t", "y", "x", "r").groupBy("t").applyInPandas(run, "t long, y long, x long, r double")


def pack_sessions(objects: DataFrame, most: int = SESSION_OBJECTS, exclusive: float = EXCLUSIVE) -> DataFrame:
    """(key, obj, session): first fit in order of obj; a session takes an object that shares at most 1 - ``exclusive`` of its
    pixels with those already in it. ``objects`` has (key, obj, pixels array); a group is one frame's objects."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sessions: list[tuple[set, int]] = []
        out = []
        for row in pdf.sort_values("obj").itertuples():
            pixels = set(row.pixels)
            for k, (seen, n) in enumerate(sessions):
                if n < most and len(pixels - seen) >= exclusive * len(pixels):
                    sessions[k] = (seen | pixels, n + 1)
                    break
            else:
                k = len(sessions)
                sessions.append((pixels, 1))
            out.append((row.key, row.obj, k))
        return pd.DataFrame(out, columns=["key", "obj", "session"])

    return objects.select("key", "obj", "pixels").groupBy("key").applyInPandas(run, "key long, obj long, session long")


def new_packets(packets: DataFrame, ledger: DataFrame, key: str = "work_id") -> DataFrame:
    """Packets whose key is not in the ledger, each key once (the first by digest)."""
    fresh = packets.join(ledger.select(key), key, "left_anti")
    return fresh.withColumn("__nth", F.row_number().over(Window.partitionBy(key).orderBy("sha256"))).where("__nth = 1").drop("__nth")
