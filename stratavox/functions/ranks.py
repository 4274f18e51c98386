"""Exact positions within groups of any size, without sorting a group in one task."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hexadecimal digits of a digest that tell its bucket: 4,096 of them.
DIGITS = 3


def bucket(digest: Column) -> Column:
    """The bucket of a hex digest; buckets follow each other as the digests do."""
    return F.substring(digest, 1, DIGITS)


def positions(rows: DataFrame, keys: list[str], buckets: list[Column], order: list[Column], name: str = "__nth") -> DataFrame:
    """Adds the position, from 1, of each row among those of equal ``keys`` in ``order``.

    ``buckets`` must be in line with the order: of two rows the one with the lesser buckets (nulls first) comes first. Rows are
    counted by bucket, the counts are summed up along the buckets of a group, and only the rows of one bucket are sorted together.
    """
    names = [f"__b{k}" for k in range(len(buckets))]
    rows = rows.withColumns(dict(zip(names, buckets)))
    counts = rows.groupBy(*keys, *names).agg(F.count("*").alias("__in"))
    along = Window.partitionBy(*keys).orderBy(*(F.col(b).asc_nulls_first() for b in names)).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*(F.col(c).alias(f"__k{i}") for i, c in enumerate([*keys, *names])), F.coalesce(F.sum("__in").over(along), F.lit(0)).alias("__before"))
    same = functools.reduce(operator.and_, (F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate([*keys, *names])))
    here = F.row_number().over(Window.partitionBy(*keys, *names).orderBy(*order))
    out = rows.withColumn("__here", here).join(before, same).withColumn(name, F.col("__here") + F.col("__before"))
    return out.drop("__here", "__before", *names, *(f"__k{i}" for i in range(len(keys) + len(names))))
