"""Very many small groups in Python: a partition is sorted by their keys and streamed, so a group costs no Arrow stream of its own."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavox.session import shuffle_partitions

TYPES = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string()}


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt by keys to as many tasks as a shuffle has, however few bytes they are.

    Without a number Spark joins partitions by their bytes, and rows that are short but dear in Python end in one task.
    """
    return df.repartition(shuffle_partitions(df.sparkSession), *keys)


def arrow(schema: str, types: dict[str, pa.DataType] | None = None) -> pa.Schema:
    """Arrow fields of a schema of plain columns; ``types`` adds names of others."""
    return pa.schema([(name, (TYPES | (types or {}))[kind]) for name, kind in (field.split() for field in schema.split(","))])


def streamed(df: DataFrame, keys: list[str], order: list[Column], run: Callable[[dict[str, list]], Iterable[tuple]], schema: str) -> DataFrame:
    """Rows of ``schema`` that ``run`` makes of every group of ``keys``: it gets the group's columns as lists, in ``order``.

    A task holds one group and one batch.
    """
    fields = arrow(schema)
    cols = df.columns

    def table(rows: list[tuple]) -> pa.RecordBatch:
        values = zip(*rows) if rows else ([] for _ in fields)
        return pa.RecordBatch.from_arrays([pa.array(list(v), f.type) for v, f in zip(values, fields)], schema=fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = {c: [] for c in cols}, None
        for batch in batches:
            lists = {c: batch.column(k).to_pylist() for k, c in enumerate(cols)}
            out, begin = [], 0
            for i, key in enumerate(zip(*(lists[k] for k in keys))):
                if key != last:
                    if last is not None:
                        for c in cols:
                            held[c] += lists[c][begin:i]
                        out.extend(run(held))
                        held = {c: [] for c in cols}
                    begin, last = i, key
            for c in cols:
                held[c] += lists[c][begin:]
            yield table(out)
        if last is not None:
            yield table(list(run(held)))

    return spread(df, *keys).sortWithinPartitions(*(F.col(k) for k in keys), *order).mapInArrow(cut, schema)
