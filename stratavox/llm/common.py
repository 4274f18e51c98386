"""What the text operators share on the Spark side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavox.session import checkpoint_dir, checkpointed
from stratavox.session import shared_path as shared_dir
from stratavox.session import shuffle_partitions as partitions

__all__ = ["NULL_ID", "checkpoint_dir", "checkpointed", "fresh", "id_key", "id_out", "partitions", "remove", "shared_dir", "table", "text_key", "without"]

#: What stands for a null id inside the operators; outputs show null again.
NULL_ID = -(1 << 63)


def id_key(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("bigint"), F.lit(NULL_ID))


def text_key(column: str = "text") -> Column:
    """64-bit hash of a text, which tells texts that share an id apart; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(column).cast("string"), F.lit("")))


def id_out(column: str) -> Column:
    return F.when(F.col(column) != NULL_ID, F.col(column))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that an operator is about to add: its own replace a user's of the same name."""
    lost = {n.lower() for n in names}
    return df.select(*(f"`{c}`" for c in df.columns if c.lower() not in lost))
