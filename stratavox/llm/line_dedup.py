"""Line dedup: range-partitioned line hashes, first occurrences by streaming, compressed keep bitmaps as the result.

Each line's key (stripped of ASCII blanks, A-Z lower-cased) is hashed to 128 bits. Hashes are range-partitioned together
with the document, so a line that stands in very many documents is spread over tasks, and sorted by (hash, document,
position) within each. One pass per task keeps a single hash in mind: lines of the first document stay, those of later
ones go. Whether the first document of a task's leading hash is the first of all is settled afterwards from the tasks'
last hashes, two rows a task at most. Texts stay where they are: what comes back is one bitmap a document.

Nulls: a null text is one empty line; a null doc_id orders before all others. Rows that share a doc_id count as one
document: they neither drop each other's lines nor make a line repeated. Bitmaps go by (doc_id, 64-bit hash of the text),
so that texts that share a doc_id each get their own, and equal rows get equal ones. A key that repeats within a document
(a tie) stays or goes at all its places. An empty table gives no rows; extra columns are kept. Texts may be of any length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavox.llm import blocks, common

#: Code points that a key needs to count.
MIN_KEY = 10
BLANKS = b" \t\n\x0b\x0c\r"


def _line_hashes(min_key: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            offsets, data = blocks.column_bytes(batch.column("text"))
            ids, row = (batch.column(c).to_numpy() for c in ("id", "row"))
            for i, j in blocks.doc_groups(offsets, 8 << 20):
                out, rows, pos = [], [], []
                for d in range(i, j):
                    for p, line in enumerate(data[offsets[d] : offsets[d + 1]].tobytes().split(b"\n")):
                        key = line.strip(BLANKS).lower()
                        if len(key) >= min_key and (len(key) >= 4 * min_key or len(key.decode("utf-8", "replace")) >= min_key):
                            out.append(digest(key))
                            rows.append(d)
                            pos.append(p)
                h = np.frombuffer(b"".join(out), np.int64).reshape(-1, 2)
                at = np.array(rows, np.int64)
                yield pa.record_batch([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(ids[at]), pa.array(row[at]), pa.array(np.array(pos, np.int32))], ["h1", "h2", "id", "row", "pos"])

    return run


#: Kinds of marks: a line that goes; one that goes if an earlier task ended with its hash; a task's last hash.
GOES, ASKS, LAST = 0, 1, 2
_MARKS = "kind byte, task int, h1 long, h2 long, id long, row long, pos int"


def _first_occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    lead = last = None  # first hash of the task; (h1, h2, first document) of the hash at hand

    def marks(kind, h1, h2, ids, row, pos):
        n = len(h1)
        return pa.record_batch([pa.array(np.full(n, kind, np.int8)), pa.array(np.full(n, task, np.int32)), *(pa.array(np.asarray(x)) for x in (h1, h2, ids, row)), pa.array(np.asarray(pos, np.int32))], ["kind", "task", "h1", "h2", "id", "row", "pos"])

    for batch in batches:
        h1, h2, ids, row, pos = (batch.column(c).to_numpy() for c in ("h1", "h2", "id", "row", "pos"))
        if not len(h1):
            continue
        new = np.concatenate([[last is None or (h1[0], h2[0]) != last[:2]], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        start = np.flatnonzero(new)
        first = np.empty(len(h1), np.int64)
        begin = int(start[0]) if len(start) else len(h1)
        if begin:
            first[:begin] = last[2]
        if len(start):
            first[begin:] = np.repeat(ids[start], np.diff(np.append(start, len(h1))))
        if lead is None:
            lead = (h1[0], h2[0], ids[0])
        goes = ids != first
        asks = ~goes & (h1 == lead[0]) & (h2 == lead[1]) & (ids == lead[2])
        last = (h1[-1], h2[-1], first[-1])
        for kind, which in ((GOES, goes), (ASKS, asks)):
            if which.any():
                yield marks(kind, h1[which], h2[which], ids[which], row[which], pos[which])
    if last is not None:
        yield marks(LAST, [last[0]], [last[1]], [last[2]], [0], [0])


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_key: int = MIN_KEY) -> DataFrame:
    """(id, row, pos): lines that stand in a document with a smaller id too; ids as ``common.id_key`` gives them."""
    spark = docs.sparkSession
    rows = docs.select(common.id_key(id_col).alias("id"), common.text_key(text_col).alias("row"), F.col(text_col).cast("string").alias("text"))
    hashes = rows.mapInArrow(_line_hashes(min_key), "h1 long, h2 long, id long, row long, pos int")
    order = hashes.repartitionByRange(common.partitions(spark), "h1", "h2", "id").sortWithinPartitions("h1", "h2", "id")
    marks = common.checkpointed(order.mapInArrow(_first_occurrences, _MARKS))
    asks, last = marks.where(F.col("kind") == ASKS), marks.where(F.col("kind") == LAST).select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("task").alias("ended"))
    late = asks.join(last, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")) & (F.col("ended") < F.col("task")), "left_semi")
    return marks.where(F.col("kind") == GOES).unionByName(late).select("id", "row", "pos")


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_dropped, maps = [], []
        for n, gone in zip(batch.column("n_lines").to_pylist(), batch.column("gone")):
            keep = np.ones(n, np.uint8)
            if gone.is_valid:
                at = gone.values.to_numpy()
                keep[at[at < n]] = 0
            n_dropped.append(n - int(keep.sum()))
            maps.append(zlib.compress(np.packbits(keep).tobytes(), 1))
        yield pa.record_batch([batch.column("id"), batch.column("row"), batch.column("n_lines"), pa.array(n_dropped, pa.int64()), pa.array(maps, pa.binary())], ["id", "row", "n_lines", "n_dropped", "keep"])


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_key: int = MIN_KEY) -> DataFrame:
    """One row for each doc_id and text: id, row (hash of the text), n_lines, n_dropped and the lines kept as a compressed
    bitmap (most significant bit first)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")
    size = docs.select(common.id_key(id_col).alias("id"), common.text_key(text_col).alias("row"), lines.alias("n_lines")).groupBy("id", "row").agg(F.max("n_lines").alias("n_lines"))
    gone = dropped_lines(docs, id_col, text_col, min_key).groupBy("id", "row").agg(F.collect_set("pos").alias("gone"))
    return size.join(gone, ["id", "row"], "left").select("id", "row", "n_lines", "gone").mapInArrow(_bitmaps, "id long, row long, n_lines long, n_dropped long, keep binary")


def _apply(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = blocks.column_bytes(batch.column(text_col))
            keeps = batch.column("__keep").to_pylist()
            texts, sizes, drops = [], [], []
            for i, keep in enumerate(keeps):
                raw = data[offsets[i] : offsets[i + 1]].tobytes()
                if keep is None:
                    n, dropped = raw.count(b"\n") + 1, 0
                else:
                    lines = raw.split(b"\n")
                    n = len(lines)
                    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))[:n].tolist()
                    bits += [1] * (n - len(bits))
                    raw = b"\n".join(x for x, k in zip(lines, bits) if k)
                    dropped = bits.count(0)
                texts.append(raw)
                sizes.append(n)
                drops.append(dropped)
            names = [n for n in batch.schema.names if n != "__keep"]
            cols = [pa.array(texts, pa.binary()).cast(pa.string()) if n == text_col else batch.column(n) for n in names]
            yield pa.record_batch([*cols, pa.array(sizes, pa.int64()), pa.array(drops, pa.int64())], [*names, "__n_lines", "__n_dropped"])

    return run


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_key: int = MIN_KEY) -> DataFrame:
    """``docs`` with repeated lines taken out of its text column, and columns __n_lines and __n_dropped (in place of any so named)."""
    docs = common.without(docs, "__n_lines", "__n_dropped", "__keep")
    key, row, own, own_row = (common.fresh(docs, n) for n in ("__key", "__row", "__id", "__own_row"))
    maps = keep_bitmaps(docs, id_col, text_col, min_key).where("n_dropped > 0").select(F.col("id").alias(own), F.col("row").alias(own_row), F.col("keep").alias("__keep"))
    keyed = docs.withColumn(key, common.id_key(id_col)).withColumn(row, common.text_key(text_col))
    joined = keyed.join(maps, (F.col(key) == F.col(own)) & (F.col(row) == F.col(own_row)), "left").drop(key, row, own, own_row)
    joined = joined.withColumn(text_col, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    schema = joined.drop("__keep").withColumns({"__n_lines": F.lit(0).cast("long"), "__n_dropped": F.lit(0).cast("long")}).schema
    return joined.mapInArrow(_apply(text_col), schema)


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Lines of all ``documents`` before and after dedup, with the digest of what is kept."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    out = drop_lines(docs)
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH lines AS (
  SELECT doc_id, pos, line, lower_ascii AS key
  FROM (SELECT doc_id, pos, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii
        FROM (SELECT doc_id, unnest(range(1, len(parts) + 1)) AS pos, unnest(parts) AS line
              FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)))
), keys AS (
  SELECT key, min(doc_id) AS first_doc FROM lines WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT l.doc_id, l.pos, l.line, (k.key IS NOT NULL AND l.doc_id <> k.first_doc) AS gone FROM lines l LEFT JOIN keys k ON l.key = k.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

QUERIES = {"op6_line_dedup": op6_line_dedup}
ORACLES = {"op6_line_dedup": OP6_SQL}
