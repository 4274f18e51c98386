"""The relay frontier driven to its fixed point: mailboxes of pixels that are tracked, handed on in time and to neighbouring tiles.

A mailbox (lineage, tile, frame, forward) holds pixels. A pixel is tracked from its frame in its direction for as long as
observations of it follow each other (gaps up to ``empty`` frames), at most to the end of its window of ``SESSION`` frames. What
reaches the window's end is offered to the next window; a track of a pixel in the strip that a neighbouring tile shares is
offered there, forward from its first frame and backward from its last.

Rules are monotone, so all mailboxes advance at once and only new pixels are evaluated: a round takes the pixels that the
last one added, derives offers by equi-joins, and keeps those that no earlier round had. The fixed point is the same in any
order. A round is a folder in the shared file system, finished when its marker is there; what a lost driver left unfinished
is written again, and a driver that starts over goes on after the last finished round, so each pixel is relayed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavox.operators.temporal import ADVANCE, merge_intervals
from stratavox.session import checkpointed, shared_path

KEYS = ["lineage", "tile", "frame", "forward", "px"]


def observed(observations: DataFrame, empty: int) -> DataFrame:
    """(lineage, tile, px, start, stop): maximal runs of frames, both ends included, in which a pixel is seen with gaps up to ``empty``."""
    rows = observations.select("lineage", "tile", "px", F.col("frame").cast("bigint").alias("start"), F.col("frame").cast("bigint").alias("stop")).distinct()
    return merge_intervals(rows, ["lineage", "tile", "px"], gap=empty + 1).drop("n")


def window_end(frame: Column, forward: Column, n_frames: int) -> Column:
    """The frame, included, at which the window of a mailbox ends in its direction."""
    ahead = F.least(F.lit(n_frames - 1), (F.floor(frame / ADVANCE) + 1) * ADVANCE)
    back = F.greatest(F.lit(0), F.floor((frame - 1) / ADVANCE) * ADVANCE)
    return F.when(forward, ahead).otherwise(back).cast("bigint")


def tracked(mail: DataFrame, runs: DataFrame, n_frames: int) -> DataFrame:
    """Mailbox pixels with upto, the last frame of their track, and bound, the end of their window.

    A run is found by the slabs of ``ADVANCE`` frames that it meets, so the join is an equi-join and a pixel meets few runs.
    """
    slab = lambda c: F.floor(F.col(c) / ADVANCE)
    spread = runs.select("lineage", "tile", "px", "start", "stop", F.explode(F.sequence(slab("start"), slab("stop"))).alias("slab"))
    rows = mail.select(*KEYS).withColumn("slab", slab("frame")).join(spread, ["lineage", "tile", "px", "slab"])
    rows = rows.where(F.col("frame").between(F.col("start"), F.col("stop"))).withColumn("bound", window_end(F.col("frame"), F.col("forward"), n_frames))
    upto = F.when(F.col("forward"), F.least("stop", "bound")).otherwise(F.greatest("start", "bound"))
    return rows.select(*KEYS, upto.alias("upto"), "bound")


def advance(mail: DataFrame, runs: DataFrame, strips: DataFrame, n_frames: int) -> DataFrame:
    """Offers (lineage, tile, frame, forward, px) that the given pixels make.

    ``strips`` (tile, px, to_tile, to_px) says where a tile's pixel lies in each neighbour that shares it.
    """
    tracks = tracked(mail, runs, n_frames)
    end = F.when(F.col("forward"), F.lit(n_frames - 1)).otherwise(F.lit(0))
    onward = tracks.where((F.col("upto") == F.col("bound")) & (F.col("bound") != end) & (F.col("bound") != F.col("frame"))).select("lineage", "tile", F.col("bound").alias("frame"), "forward", "px")
    beside = tracks.join(strips, ["tile", "px"])
    ends = F.explode(F.array(F.struct(F.least("frame", "upto").alias("frame"), F.lit(True).alias("forward")), F.struct(F.greatest("frame", "upto").alias("frame"), F.lit(False).alias("forward")))).alias("e")
    beside = beside.select("lineage", F.col("to_tile").alias("tile"), F.col("to_px").alias("px"), ends).select("lineage", "tile", "e.frame", "e.forward", "px")
    return onward.unionByName(beside)


def _finished(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def drive(offers: DataFrame, observations: DataFrame, strips: DataFrame, n_frames: int, empty: int = 2, most_rounds: int = 1000, ledger: str | None = None) -> DataFrame:
    """(lineage, tile, frame, forward, px, round): every pixel that any mailbox ever holds, and the round that brought it.

    ``ledger`` is the folder of an earlier call that may have stopped midway. A round that adds nothing ends the work; more
    than ``most_rounds`` are an error, as the pixels of a volume cannot need more than its windows times its tiles.
    """
    spark = offers.sparkSession
    ledger = ledger or shared_path(spark, "frontier")
    runs = checkpointed(observed(observations, empty))
    schema = "lineage bigint, tile bigint, frame bigint, forward boolean, px bigint"
    at = lambda r: f"{ledger}/round={r}"
    for r in range(most_rounds + 1):
        if not _finished(spark, at(r)):
            new = offers.select(*KEYS) if r == 0 else advance(spark.read.schema(schema).parquet(at(r - 1)), runs, strips, n_frames)
            new = new.select(*(F.col(c).cast(t).alias(c) for c, t in (f.split() for f in schema.split(", ")))).distinct()
            if r:
                new = new.join(spark.read.schema(schema).parquet(*map(at, range(r))), KEYS, "left_anti")
            new.write.mode("overwrite").parquet(at(r))
        if spark.read.schema(schema).parquet(at(r)).isEmpty():
            return spark.read.schema(schema + ", round int").option("basePath", ledger).parquet(*map(at, range(r + 1)))
    raise RuntimeError(f"the frontier did not settle in {most_rounds} rounds")
