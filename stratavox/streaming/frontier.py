"""Frontiers and relays as streams: incremental merges of offers, windowed counts, and a ledger of the pixels that relays bring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavox.session import shared_path

KEYS = ["lineage", "tile", "frame", "forward"]


def stream_of(spark: SparkSession, sf_dir: str, name: str, files_at_once: int = 1) -> DataFrame:
    """A driver table as a stream of its files, whether the table is one file or a folder of parts."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory()
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once)
    return stream.parquet(path) if folder else stream.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def drain(stream: DataFrame, mode: str, keys: list[str], out: str | None = None) -> DataFrame:
    """Runs a stream over what there is and returns the last row of each key; no row if there was no batch.

    Every micro-batch is written under its number, so a batch that is tried again replaces itself. With the folder ``out`` of
    an earlier run the stream goes on from there. If the stream has a column ``revision``, it is how many different rows the
    key has had.
    """
    spark = stream.sparkSession
    out = out or shared_path(spark, "stream")

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("__batch", F.lit(number).cast("bigint")).write.mode("overwrite").parquet(f"{out}/rows/batch={number:08d}")

    query = stream.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    schema = stream.withColumn("__batch", F.lit(0).cast("bigint")).schema
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out}/rows")
    written = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
    rows = spark.read.schema(schema).parquet(f"{out}/rows") if written else spark.createDataFrame([], schema)
    values = [c for c in stream.columns if c not in (*keys, "revision")]
    last = F.max_by(F.struct(*values), "__batch").alias("v")
    if "revision" not in stream.columns:
        return rows.groupBy(*keys).agg(last).select(*keys, "v.*")
    return rows.groupBy(*keys).agg(last, F.size(F.collect_set(F.struct(*values))).cast("bigint").alias("revision")).select(*keys, "v.*", "revision")


def merge_offers(offers: DataFrame) -> DataFrame:
    """Mailboxes that grow as offers arrive (update mode)."""
    return offers.groupBy(*KEYS).agg(F.max("score").alias("score"), F.max("generation").alias("generation"), F.bit_or("provenance").alias("provenance"), F.count("*").alias("n_offers"))


def windowed_counts(events: DataFrame, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts of each event type by tumbling window of event time; state older than the watermark is let go."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids")).select(F.col("w.start").alias("start"), "event_type", "n", "ids")


#: Pixels that one state row keeps, as the bits of one number.
CHUNK = 64


def relay_ledger(relays: DataFrame) -> DataFrame:
    """(lineage, frame, chunk, revision, n_pixels) of every chunk that relays (lineage, frame, px) reach, with the pixels it has by now.

    A state row is one number of ``CHUNK`` bits, so an update rewrites as much, however many pixels a frame has. Relays of
    known pixels repeat the chunk's row, which ``drain`` does not count as a revision.
    """
    rows = relays.select("lineage", "frame", F.shiftright("px", 6).alias("chunk"), F.expr(f"shiftleft(1L, cast(pmod(px, {CHUNK}) AS int))").alias("bit"))
    now = rows.groupBy("lineage", "frame", "chunk").agg(F.bit_or("bit").alias("bits"))
    return now.select("lineage", "frame", "chunk", F.lit(0).cast("bigint").alias("revision"), F.coalesce(F.bit_count("bits"), F.lit(0)).cast("bigint").alias("n_pixels"))


def ledger_totals(chunks: DataFrame) -> DataFrame:
    """(lineage, frame, revisions, n_pixels) of the last rows of all chunks."""
    return chunks.groupBy("lineage", "frame").agg(F.sum("revision").alias("revisions"), F.sum("n_pixels").alias("n_pixels"))
