"""SimHash near-dedup with Golay-code fuzzy hashing.

Fingerprints of 64 bits are cut into three segments of 22, 21 and 21 bits. Two fingerprints at most four bits apart
differ in at most two bits over some pair of segments (the worst segment takes at least a third of the errors). For each
pair of segments a fingerprint gives the codeword indices that Golay decoding finds for the pair itself and for it with
any one bit flipped: two words at most two bits apart have a word between them at most one bit from either, so they share
a key. Candidates that share a key are verified on all 64 bits.

Only distinct fingerprints are joined; copies hang on them by value. Keys are dealt to tasks and met there. A key held by
very many fingerprints is split into blocks, and each pair of blocks is verified on its own. Within a task links that
close a cycle are not emitted, so the links never outnumber the fingerprints in it, however large a group of copies is.

Nulls: a null text has no words, thus fingerprint zero, which links like any other; a null doc_id counts as larger than
all others when the smallest of a component is taken (a component of null ids only gets null). Repeated rows each get a
row, and rows that share an id each the fingerprint and component of their own text. Ties: equal fingerprints are one node.
Texts of any length are taken whole. An empty table gives no rows; columns besides id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavox.llm import blocks, common, golay
from stratavox.operators.graph import components

#: Words of a shingle, seed of the hash, and the largest difference that links.
SHINGLE, SEED, RADIUS = 4, 42, 4
#: (lowest bit, bits) of the segments.
SEGMENTS = ((42, 22), (21, 21), (0, 21))
#: Fingerprints of one key that are verified together.
BLOCK = 2048
#: A group is large if it has this many rows and a ten-thousandth of all: so there are at most ten thousand of these.
LARGE = 1000


def fingerprint(text: bytes) -> int:
    """Majority of the bits of XXH64 over the shingles of a text's words, A-Z lower-cased; zero without words."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    if n < SHINGLE:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined, h = b" ".join(words), xxhash.xxh64_intdigest
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
        starts = np.concatenate([[0], ends[: n - SHINGLE]]).tolist()
        hashes = [h(joined[a:b], SEED) for a, b in zip(starts, (ends[SHINGLE - 1 :] - 1).tolist())]
    count = np.zeros(64, np.int64)
    values = np.array(hashes, np.uint64)
    for i in range(0, len(values), 1 << 15):
        count += np.unpackbits(values[i : i + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > len(values)).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, data = blocks.column_bytes(batch.column("text"))
        fp = [fingerprint(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.record_batch([batch.column("id"), batch.column("row"), pa.array(np.array(fp, np.uint64).view(np.int64))], ["id", "row", "fp"])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, fp): the pair of segments and two codeword indices, for each distinct combination."""
    for batch in batches:
        fp = batch.column("fp").to_numpy()
        near = [golay.neighbour_indices((fp.view(np.uint64) >> np.uint64(low)) & np.uint64((1 << bits) - 1), bits) for low, bits in SEGMENTS]
        for i in range(0, len(fp), 4096):
            out = []
            for pair, (u, v) in enumerate(((0, 1), (0, 2), (1, 2))):
                a, b = near[u][i : i + 4096].astype(np.int64), near[v][i : i + 4096].astype(np.int64)
                out.append(np.concatenate([(a << 12) | b[:, :1], (a[:, :1] << 12) | b[:, 1:]], axis=1) | (pair << 24))
            keys = np.sort(np.concatenate(out, axis=1), axis=1)
            new = np.concatenate([np.ones((len(keys), 1), bool), keys[:, 1:] != keys[:, :-1]], axis=1)
            row = np.nonzero(new)[0]
            yield pa.record_batch([pa.array(keys[new].astype(np.int32)), pa.array(fp[i : i + 4096][row])], ["key", "fp"])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among fingerprints of equal group (group, row block, column block, side), without those that close a cycle.

    The rows of a partition arrive sorted by group; they are taken in slices of whole groups.
    """
    held: list[pa.RecordBatch] = []

    def flush(table: pa.Table) -> pa.RecordBatch | None:
        g, side, fp = (table.column(c).to_numpy() for c in ("grp", "side", "fp"))
        nodes, at = np.unique(fp, return_inverse=True)
        root = np.arange(len(nodes))
        bits = fp.view(np.uint64)
        i, lag, out = np.arange(len(fp)), 1, []
        while True:
            i = i[i < len(fp) - lag]
            i = i[g[i] == g[i + lag]]
            if not len(i):
                break
            # blocks that meet only with each other hold sides 0 and 1; a block with itself holds side 2
            ok = i[(np.bitwise_count(bits[i] ^ bits[i + lag]) <= RADIUS) & ((side[i] != side[i + lag]) | (side[i] == 2))]
            while len(ok):
                a, b = root[at[ok]], root[at[ok + lag]]
                apart = a != b
                ok, a, b = ok[apart], a[apart], b[apart]
                if not len(ok):
                    break
                hi, lo = np.maximum(a, b), np.minimum(a, b)
                _, first = np.unique(hi, return_index=True)  # each root hooks once, onto a lower root
                out.append(np.stack([fp[ok[first]], fp[ok[first] + lag]], 1))
                root[hi[first]] = lo[first]
                while True:
                    up = root[root]
                    if (up == root).all():
                        break
                    root = up
            lag += 1
        if not out:
            return None
        pairs = np.concatenate(out)
        return pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= 1 << 18:
            table = pa.Table.from_batches(held).combine_chunks()
            g = table.column("grp").to_numpy()
            cut = int(np.searchsorted(g == g[-1], True)) if g[0] != g[-1] else 0  # groups are contiguous
            if cut:
                got = flush(table.slice(0, cut))
                if got is not None:
                    yield got
                held = table.slice(cut).to_batches()
                size = table.num_rows - cut
    if held:
        got = flush(pa.Table.from_batches(held).combine_chunks())
        if got is not None:
            yield got


def links(fps: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b): links between the distinct fingerprints of ``fps`` (fp) that connect all those within RADIUS bits."""
    keys = fps.select("fp").mapInArrow(_keys, "key int, fp long")
    hot = keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block)
    n = F.coalesce(F.ceil(F.col("n") / F.lit(block)), F.lit(1)).cast("int")
    rows = keys.join(hot, "key", "left").select("key", "fp", n.alias("blocks"), F.pmod(F.xxhash64("fp"), n).cast("int").alias("own"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = rows.select("key", "fp", "own", other)
    grp = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).cast("byte")
    rows = rows.select(grp.alias("grp"), side.alias("side"), "fp")
    return rows.repartition(common.partitions(fps.sparkSession), "grp").sortWithinPartitions("grp", "fp").mapInArrow(_links, "a long, b long")


def prints_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, fp) of every row, stored: its id, the hash of its text and its fingerprint."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), common.text_key(text_col).alias("row"), F.col(text_col).cast("string").alias("text"))
    return common.checkpointed(rows.mapInArrow(_fingerprints, "id long, row long, fp long"))


def _spread_join(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` joined with the one row of ``groups`` for their key; those of large groups stay where they are.

    ``size`` counts a group's rows, so at most ten thousand groups are large, and these are sent to all tasks.
    """
    groups = common.checkpointed(groups)
    total = groups.agg(F.sum(size)).first()[0] or 0
    large = F.col(size) > max(LARGE, total // 10_000)
    hot = F.broadcast(groups.where(large))  # ten thousand rows at most
    own = [c for c in groups.columns if c != key and c in rows.columns]
    hot, cold = hot.drop(*own), groups.where(~large).drop(*own)
    return rows.join(hot, key).unionByName(rows.join(F.broadcast(groups.where(large).select(key)), key, "left_anti").join(cold, key))


def _named(prints: DataFrame) -> DataFrame:
    """(fp, copies, root, component_id) of every fingerprint: how many rows have it, and its component."""
    reps = common.checkpointed(prints.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("copies")))
    linked = components(links(reps.select("fp")))
    roots = reps.join(linked, reps["fp"] == linked["node"], "left").select("fp", "least", "copies", F.coalesce("root", "fp").alias("root"))
    roots = common.checkpointed(roots)
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    return _spread_join(roots.select("fp", "copies", "root"), least, "root", "n").select("fp", "copies", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id it can reach."""
    prints = prints_of(docs, id_col, text_col)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return _spread_join(prints, _named(prints), "fp", "copies").select(F.col("id").alias("doc_id"), hexed.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with one row of each component: of the smallest id (null ids last), then of the least text hash.

    Rows are told apart by (id, text hash), so texts that share an id are decided on each; of equal rows one stays.
    """
    prints = prints_of(docs, id_col, text_col)
    rows = prints.groupBy("id", "row", "fp").agg(F.count("*").alias("n"))
    rows = common.checkpointed(_spread_join(rows, _named(prints).select("fp", "copies", "root"), "fp", "copies").select("id", "row", "n", "root"))
    least = rows.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first"), F.count("*").alias("of"))
    rows = _spread_join(rows, least, "root", "of")
    stays = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("row") == F.col("first.row"))
    marks = rows.select(common.id_key("id").alias("__id"), F.col("row").alias("__hash"), F.when(~stays, "goes").when(F.col("n") > 1, "repeats").alias("__mark"))
    marks = common.checkpointed(marks.where("__mark IS NOT NULL"))
    key, row, mark, own, own_row = (common.fresh(docs, n) for n in ("__key", "__row", "__mark", "__id", "__hash"))
    marks = marks.select(F.col("__id").alias(own), F.col("__hash").alias(own_row), F.col("__mark").alias(mark))
    keyed = docs.withColumn(key, common.id_key(id_col)).withColumn(row, common.text_key(text_col))
    marked = keyed.join(marks, (F.col(key) == F.col(own)) & (F.col(row) == F.col(own_row)), "left")
    out = marked.where(F.col(mark).isNull())
    if not marks.where(F.col(mark) == "repeats").isEmpty():
        out = out.unionByName(marked.where(F.col(mark) == "repeats").dropDuplicates([key, row]))
    return out.drop(key, row, mark, own, own_row)


def op10_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    """Fingerprints and near-duplicate components of all ``documents``."""
    return near_duplicates(common.table(spark, sf_dir, "documents"))


QUERIES = {"op10_simhash_dedup": op10_simhash_dedup}
