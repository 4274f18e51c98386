"""Session settings that operators read: the shared checkpoint folder and the number of shuffle partitions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only where spark.checkpoint.dir is not set and all runs on one machine, as in tests.
LOCAL = "/tmp/stratavox-checkpoints"


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, set as the checkpoint folder of the context."""
    jsc = spark.sparkContext._jsc.sc()
    here = jsc.getCheckpointDir()
    base = spark.conf.get("spark.checkpoint.dir", None) or (here.get() if here.isDefined() else None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    base = base or LOCAL
    if not here.isDefined():
        spark.sparkContext.setCheckpointDir(base)
    return base


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
