"""Terminal fusion as a stream: slices of a view's variants are joined as they arrive, and a view comes out once it is complete.

Packets are (view, n_slices, n_variants, variant, t, pixels array): one slice of one variant, in any order, in any batch,
perhaps more than once; a slice without foreground has an empty array. State is kept for each (view, t): which variants came
and the union of their pixels, until all have; then the slice is given out, and only the fact that it was stays. A view is
published when all its slices are there, exactly once, under its own name, whatever is tried again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

FUSED = "view string, t long, n_slices long, pixels array<long>"


def _fuse(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    came, pixels, done = state.get if state.exists else ([], [], False)
    if done:
        return
    came, pixels, n_slices, expected = set(came), set(pixels), 0, 0
    for pdf in batches:
        for variant, px, slices, variants in zip(pdf["variant"], pdf["pixels"], pdf["n_slices"], pdf["n_variants"]):
            n_slices, expected = int(slices), int(variants)
            if int(variant) not in came:
                came.add(int(variant))
                pixels.update(map(int, px))
    if len(came) < expected:
        state.update((sorted(came), sorted(pixels), False))
        return
    state.update(([], [], True))
    yield pd.DataFrame({"view": [key[0]], "t": [key[1]], "n_slices": [n_slices], "pixels": [sorted(pixels)]})


def fused_slices(packets: DataFrame) -> DataFrame:
    """Each slice of each view, once, when the last of its variants has come."""
    return packets.groupBy("view", "t").applyInPandasWithState(_fuse, FUSED, "came array<long>, pixels array<long>, done boolean", "append", GroupStateTimeout.NoTimeout)


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def run(packets: DataFrame, out: str) -> None:
    """Takes all that ``packets`` has now; slices go to ``out``/slices, complete views to ``out``/views. Calls go on from each other.

    A batch writes its slices under its own number; then the views that they complete are written together, also under that
    number: if the batch is tried again both replace themselves, so a view is neither lost nor published twice.
    """
    spark = packets.sparkSession
    schema = FUSED + ", batch int"

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/slices/batch={number}")
        slices = spark.read.schema(schema).parquet(f"{out}/slices").where(F.col("batch") <= number)
        touched = slices.where(F.col("batch") == number).select("view").distinct()
        full = slices.join(touched, "view", "left_semi").groupBy("view").agg(F.count("*").alias("n"), F.max("n_slices").alias("n_slices")).where("n = n_slices").select("view")
        slices.join(full, "view", "left_semi").select("view", "t", "pixels").write.mode("overwrite").parquet(f"{out}/views/batch={number}")

    stream = fused_slices(packets).writeStream.outputMode("append").foreachBatch(keep)
    stream.option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start().awaitTermination()


def views(spark: SparkSession, out: str) -> DataFrame:
    """(view, t, pixels) of the published views."""
    schema = "view string, t long, pixels array<long>"
    return spark.read.schema(schema).parquet(f"{out}/views").select("view", "t", "pixels") if _exists(spark, f"{out}/views") else spark.createDataFrame([], schema)
