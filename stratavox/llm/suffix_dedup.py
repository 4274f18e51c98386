"""Exact substring dedup through merged shard Burrows-Wheeler transforms.

A window of ``width`` bytes goes if the same bytes start earlier, by (doc_id, position). Windows are dealt to tasks by
their least gram: equal windows have equal grams, so they meet, and windows in a row that share it travel as one segment.
Hashes only deal windows to tasks; whether two are equal is decided by the transforms and then byte by byte.

1. Scan: each text is cut into segments; a segment is sent as the hash of its least gram with its place, without text. Of
   segments whose bytes are equal within a batch (their bytes are compared) the earliest is sent, the others repeat.
2. By gram: a gram that one segment has, and has once, is settled: nothing equal exists. That ends unique text here.
3. All other segments fetch their text; their windows are compared through shard transforms merged by interleave
   refinement (``bwt``). A gram in very many segments is dealt again, window by window, by a second gram.
4. By document: what a batch or the merge found to repeat is covered and cut out.

Texts move once, by an even hash of document and text, and both later steps read that exchange. A passage held by very many
documents is one segment a batch before it moves; its neighbourhoods are told apart by the second gram.

Nulls: a null text is empty, a null doc_id orders before all others. Rows that share a doc_id but not the text are ordered
by a hash of the text, and each is cut by its own marks; rows equal in both each get the result of one such row. Ties do not
arise: places differ. Texts shorter than ``width`` are never touched, texts of any length are taken whole. An empty table
gives no rows; columns besides id and text are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavox.llm import blocks, bwt, common

WIDTH = bwt.STEP * bwt.DEPTH
#: Bytes of a gram; windows of WIDTH bytes hold WIDTH - GRAM + 1 grams.
GRAM = 32
#: Windows of one segment at most.
RUN = 256
#: Mark on a segment's window count: equal windows may stand within the segment.
INNER = 1 << 15
#: Segments of one gram beyond which they are dealt by a second gram, of this many bytes.
HOT, SECOND = 4096, 20
#: Bytes hashed together, of texts scanned together, and of a shard transform at most.
CHUNK, GROUP, SHARD = 1 << 20, 24 << 20, 1 << 19
#: Shards that a part is merged from at least, and bytes that one has at least.
SHARDS, LEAST_SHARD = 8, 1 << 12


def _window_min(h: np.ndarray, span: int) -> np.ndarray:
    """Minimum of each run of ``span`` values."""
    have, m = 1, h
    while have * 2 <= span:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    return np.minimum(m[: len(m) - (span - have)], m[span - have :]) if span > have else m


def cut_segments(offsets: np.ndarray, data: np.ndarray, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, gram hash, content hash) of all segments, in order of text and place.

    Texts over CHUNK are cut at fixed multiples of it, so a text always has the same segments.
    """
    out: list[tuple[np.ndarray, ...]] = []
    piece = [(i, a, min(int(offsets[i + 1]), a + CHUNK + WIDTH - 1), a - int(offsets[i])) for i in range(len(offsets) - 1) for a in range(int(offsets[i]), int(offsets[i + 1]) - WIDTH + 1, CHUNK)]
    k = 0
    while k < len(piece):
        size, first = 0, k
        while k < len(piece) and (k == first or size + piece[k][2] - piece[k][1] <= CHUNK):
            size += piece[k][2] - piece[k][1]
            k += 1
        text, a, b, base = (np.array(x, np.int64) for x in zip(*piece[first:k]))
        buf = np.concatenate([data[x:y] for x, y in zip(a, b)]) if k - first > 1 else data[a[0] : b[0]]
        start = np.concatenate([[0], np.cumsum(b - a)])
        prefix = blocks.prefix_hash(buf)
        grams = blocks.gram_hash(prefix, gram)
        low = _window_min(grams, WIDTH - gram + 1)
        n = len(low)
        new = np.empty(n + 1, bool)
        new[0] = True
        new[1:n] = low[1:] != low[:-1]
        new[start[:-1]] = True
        stop = np.minimum(start[1:] - WIDTH + 1, n)
        new[stop] = True
        edges = np.flatnonzero(new)
        edges = edges[edges <= n]
        s, e = edges[:-1] if edges[-1] == n else edges, edges[1:] if edges[-1] == n else np.append(edges[1:], n)
        owner = np.searchsorted(start, s, "right") - 1
        ok = s < stop[owner]
        s, e, owner = s[ok], e[ok], owner[ok]
        parts = -(-(e - s) // RUN)
        if (parts > 1).any():
            which = np.repeat(np.arange(len(s)), parts)
            nth = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
            s2 = s[which] + nth * RUN
            s, e, owner = s2, np.minimum(e[which], s2 + RUN), owner[which]
        # two equal windows of one segment need its gram at the start of a window before the last, or at the end of one after the first
        heads, tails = (np.concatenate([[0], np.cumsum(x)]) for x in (grams[:n] == low, grams[WIDTH - gram :] == low))
        inner = (heads[e - 1] > heads[s]) | (tails[e] > tails[s + 1])
        windows = (e - s).astype(np.uint16) | np.where(inner, INNER, 0).astype(np.uint16)
        out.append((text[owner], s - start[owner] + base[owner], windows, low[s], blocks.span_hash(prefix, s, e + WIDTH - 1)))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint16, np.uint64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*out))


def _pack(*columns: np.ndarray, delta: int = 0) -> bytes:
    """Columns as one blob, compressed unless they are hashes (32-bit unsigned); the first ``delta`` of them as differences."""
    out = [struct.pack("<I", len(columns[0]))]
    for i, c in enumerate(columns):
        raw = np.diff(c, prepend=c.dtype.type(0)).tobytes() if i < delta else c.tobytes()
        kind = np.dtype(c.dtype).char
        raw = raw if kind == "I" else zlib.compress(raw, 1)
        out += [struct.pack("<cI", kind.encode(), len(raw)), raw]
    return b"".join(out)


def _unpack(blob: bytes, delta: int = 0) -> list[np.ndarray]:
    out, at = [], 4
    while at < len(blob):
        kind, n = struct.unpack_from("<cI", blob, at)
        raw = blob[at + 5 : at + 5 + n]
        at += 5 + n
        x = np.frombuffer(raw if kind == b"I" else zlib.decompress(raw), np.dtype(kind.decode()))
        out.append(np.cumsum(x, dtype=x.dtype) if len(out) < delta else x)
    return out


def _unpack_all(blobs: list[bytes], delta: int, kinds: str) -> list[np.ndarray]:
    parts = [_unpack(b, delta) for b in blobs]
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.dtype(k)) for k in kinds]


def _by_part(part: np.ndarray, columns: list[np.ndarray], delta: int) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(part, kind="stable")
    part = part[order]
    cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else []
    for a, b in zip(cuts, cuts[1:]):
        yield int(part[a]), _pack(*(c[order[a:b]] for c in columns), delta=delta)


_BLOBS = "part int, blob binary"
_ARROW = pa.schema([("part", pa.int32()), ("blob", pa.binary())])


def _batches(rows: Iterator[tuple[int, bytes]], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    parts, blobs, size = [], [], 0
    for part, blob in rows:
        parts.append(part)
        blobs.append(blob)
        size += len(blob)
        if size >= most:
            yield pa.record_batch([pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())], schema=_ARROW)
            parts, blobs, size = [], [], 0
    if parts:
        yield pa.record_batch([pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())], schema=_ARROW)


def equal_spans(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether data[a : a + length] and data[b : b + length] hold the same bytes, for each triple."""
    same = np.ones(len(a), bool)
    i = 0
    while i < len(a):
        upto = np.cumsum(length[i : i + (1 << 14)])
        j = i + max(1, int(np.searchsorted(upto, 1 << 19, "right")))
        n = length[i:j]
        begin = np.cumsum(n) - n
        step = np.arange(int(n.sum())) - np.repeat(begin, n)
        same[i:j] = np.logical_and.reduceat(data[np.repeat(a[i:j], n) + step] == data[np.repeat(b[i:j], n) + step], begin)
        i = j
    return same


def _scan(n_parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "row"))
            offsets, data = blocks.column_bytes(batch.column("text"))
            for i, j in blocks.doc_groups(offsets, GROUP):
                own = data[offsets[i] : offsets[j]]
                text, place, windows, gram, content = cut_segments(offsets[i : j + 1] - offsets[i], own)
                if not len(text):
                    continue
                doc, row = ids[i:j][text], rows[i:j][text]
                order = np.lexsort((place, row, doc))
                # segments of equal hashes are compared with the earliest of them; those that are equal stay behind
                key = (content ^ (gram * np.uint64(0x9E3779B97F4A7C15)))[order]
                _, first, which = np.unique(key, return_index=True, return_inverse=True)
                lead = order[first[which]]
                length = (windows & np.uint16(INNER - 1)).astype(np.int64) + WIDTH - 1
                at = offsets[i:j][text] - offsets[i] + place
                again = np.flatnonzero((lead != order) & (length[lead] == length[order]))
                twin = order[again]
                keep = np.ones(len(order), bool)
                keep[again[equal_spans(own, at[twin], at[lead[again]], length[twin])]] = False
                order = order[keep]
                gram, doc, row, place, windows = (x[order] for x in (gram, doc, row, place, windows))
                part = ((gram >> np.uint64(32)) % np.uint64(n_parts)).astype(np.int32)
                yield from _batches(_by_part(part, [doc, row, place, gram.astype(np.uint32), windows], 3))

    return run


#: Where a segment's text goes: nowhere, or to the part of its gram (0 and up), or to that of its second gram.
SETTLED, AGAIN = -1, -3


def _settle(n_parts: int):
    """Segments, to their document's part, with the part where their text is compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), _ARROW)
        doc, row, place, gram, windows = _unpack_all(table.column("blob").to_pylist(), 3, "qqqIH")
        if not len(doc):
            return
        home = np.repeat(table.column("part").to_numpy(), [struct.unpack_from("<I", b.as_buffer())[0] for b in table.column("blob")])
        # rows that repeat a doc_id and its text are one: their places are the same
        order = np.lexsort((place, row, doc, gram, home))
        doc, row, place, gram, windows, home = (x[order] for x in (doc, row, place, gram, windows, home))
        new = np.concatenate([[True], (place[1:] != place[:-1]) | (row[1:] != row[:-1]) | (doc[1:] != doc[:-1]) | (gram[1:] != gram[:-1]) | (home[1:] != home[:-1])])
        doc, row, place, gram, windows, home = (x[new] for x in (doc, row, place, gram, windows, home))
        _, which, count = np.unique((home.astype(np.uint64) << np.uint64(32)) | gram, return_inverse=True, return_counts=True)
        several = (count[which] > 1) | (windows >= INNER)
        home = np.where(several, np.where(count[which] > HOT, AGAIN, home), SETTLED).astype(np.int32)
        gram = np.where(several, gram, np.uint32(0)).view(np.int32)
        order = np.lexsort((place, row, doc))
        cols = [x[order] for x in (doc, row, place, windows, home, gram)]
        yield from _batches(_by_part(blocks.parts_of(cols[0], n_parts, cols[1]), cols, 3))

    return run


class _Docs:
    """The texts of a part by (id, row)."""

    def __init__(self, table: pa.Table):
        keys = list(zip(table.column("id").to_pylist(), table.column("row").to_pylist()))
        self.index = {}
        for i, k in enumerate(keys):
            self.index.setdefault(k, i)
        self.keys = keys
        self.offsets, self.data = blocks.column_bytes(table.column("text"))

    def of(self, doc: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Index of the text of each (id, row); pairs that follow each other are looked up once."""
        if not len(doc):
            return np.zeros(0, np.int64)
        begin = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (row[1:] != row[:-1])]))
        found = [self.index[k] for k in zip(doc[begin].tolist(), row[begin].tolist())]
        return np.repeat(np.array(found, np.int64), np.diff(np.append(begin, len(doc))))


def _fetch(n_parts: int):
    def run(docs: pa.Table, segments: pa.Table) -> pa.Table:
        """The texts of the segments that are compared, to the part of their gram."""
        texts = _Docs(docs)
        doc, row, place, marked, home, gram = _unpack_all(segments.column("blob").to_pylist(), 3, "qqqHii")
        begin = texts.offsets[texts.of(doc, row)] + place if len(doc) else doc
        windows = (marked & np.uint16(INNER - 1)).astype(np.int64)
        hot = np.flatnonzero(home == AGAIN)
        if len(hot):
            data = np.concatenate([texts.data[s : s + n + WIDTH - 1] for s, n in zip(begin[hot], windows[hot])])
            which, inside, count, second, _ = cut_segments(np.concatenate([[0], np.cumsum(windows[hot] + WIDTH - 1)]), data, SECOND)
            from_ = hot[which]
            parts = ((second >> np.uint64(32)) % np.uint64(n_parts)).astype(np.int32)
            more = (doc[from_], row[from_], place[from_] + inside, count, (count & np.uint16(INNER - 1)).astype(np.int64), parts, second.astype(np.uint32).view(np.int32), begin[from_] + inside)
            doc, row, place, marked, windows, home, gram, begin = (np.concatenate(x) for x in zip((doc, row, place, marked, windows, home, gram, begin), more))
        rows = []
        order = np.lexsort((place, row, doc, home))
        order = order[home[order] >= 0]
        cuts = np.flatnonzero(np.concatenate([[True], home[order][1:] != home[order][:-1], [True]])) if len(order) else []
        for a, b in zip(cuts, cuts[1:]):
            o = order[a:b]
            text = b"".join(texts.data[s : s + n + WIDTH - 1].tobytes() for s, n in zip(begin[o], windows[o]))
            rows.append((int(home[o[0]]), _pack(doc[o], row[o], place[o], marked[o], gram[o], np.frombuffer(text, np.uint8), delta=3)))
        return pa.table([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], schema=_ARROW)

    return run


def _compare(n_parts: int, shard_bytes: int):
    """Windows of the fetched segments that stand earlier too, as runs, to their document's part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), _ARROW)
        homes, marks = table.column("part").to_numpy(), []
        for home in np.unique(homes):  # each part on its own: memory is bounded by a part
            doc, row, place, windows, gram, data = _unpack_all([table.column("blob")[int(i)].as_py() for i in np.flatnonzero(homes == home)], 3, "qqqHiB")
            order = np.lexsort((place, row, doc))
            inner, windows = windows[order] >= INNER, windows & np.uint16(INNER - 1)
            length = windows.astype(np.int64) + WIDTH - 1
            at = (np.cumsum(length) - length)[order]
            doc, row, place, windows, gram, length = (x[order] for x in (doc, row, place, windows, gram, length))
            # strings of equal bytes are one string of the transforms: the windows of the later ones all stand earlier
            whole = memoryview(data)
            hashes = np.fromiter((xxhash.xxh3_64_intdigest(whole[a:b]) for a, b in zip(at.tolist(), (at + length).tolist())), np.uint64, len(at))
            _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
            lead = first[which]
            again = np.flatnonzero((lead != np.arange(len(at))) & (length[lead] == length))
            again = again[equal_spans(data, at[again], at[lead[again]], length[again])]
            own = np.ones(len(at), bool)
            own[again] = False
            own = np.flatnonzero(own)
            # a gram that is now left with one string, which has it once, has no other windows to compare
            _, which, count = np.unique(gram[own], return_inverse=True, return_counts=True)
            own = own[(count[which] > 1) | inner[own]]
            text = np.concatenate([data[:0], *(data[a : a + n] for a, n in zip(at[own], length[own]))])
            # shards follow the part, so that what a part holds is merged from several transforms
            string, pos = bwt.repeated_windows(text, length[own], own * (RUN + 1), min(shard_bytes, max(len(text) // SHARDS, LEAST_SHARD)))
            where = np.lexsort((pos, string))
            string, pos = own[string[where]], pos[where]
            new = np.concatenate([[True], (string[1:] != string[:-1]) | (pos[1:] != pos[:-1] + 1)])[: len(string)]
            begin = np.flatnonzero(new)
            count = np.diff(np.append(begin, len(string)))
            s, start, n = np.concatenate([string[begin], again]), np.concatenate([pos[begin], np.zeros(len(again), np.int64)]), np.concatenate([count, windows[again]])
            marks.append((doc[s], row[s], place[s] + start, n.astype(np.uint16)))
        if marks:
            cols = [np.concatenate(x) for x in zip(*marks)]
            order = np.lexsort((cols[2], cols[1], cols[0]))
            cols = [x[order] for x in cols]
            yield from _batches(_by_part(blocks.parts_of(cols[0], n_parts, cols[1]), [*cols, np.full(len(order), -2, np.int32), np.zeros(len(order), np.int32)], 3))

    return run


_RESULT = "id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary"
_RESULT_ARROW = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("kept", pa.binary())])


def _cut(docs: pa.Table, marks: pa.Table) -> pa.Table:
    """Covers each text by its repeated windows and cuts the cover out."""
    if not docs.num_rows:
        return _RESULT_ARROW.empty_table()
    texts = _Docs(docs)
    offsets, data = texts.offsets, texts.data
    doc, row, place, windows, kind, _ = _unpack_all(marks.column("blob").to_pylist(), 3, "qqqHii")
    windows = (windows & np.uint16(INNER - 1)).astype(np.int64)
    order = np.lexsort((place, row, doc))
    doc, row, place, windows, kind = (x[order] for x in (doc, row, place, windows, kind))
    of = texts.of(doc, row)
    order = np.argsort(of, kind="stable")
    of, place, windows, kind = (x[order] for x in (of, place, windows, kind))
    own = np.array([texts.index[k] for k in texts.keys], np.int64)
    lo, hi = np.searchsorted(of, own, "left"), np.searchsorted(of, own, "right")
    n_spans, flat, kept = [], [], []
    for i in range(len(own)):
        a, n = int(offsets[i]), int(offsets[i + 1] - offsets[i])
        count = n - WIDTH + 1
        if count <= 0:
            n_spans.append(0)
            kept.append(data[a : a + n].tobytes())
            continue
        p, k = np.minimum(place[lo[i] : hi[i]], n), kind[lo[i] : hi[i]] == -2
        q = np.minimum(p + windows[lo[i] : hi[i]], n)
        edge = np.bincount(p[k], minlength=n + 1) - np.bincount(q[k], minlength=n + 1)
        edge += np.bincount(q[~k], minlength=n + 1) - np.bincount(p[~k], minlength=n + 1)
        edge[0] += 1  # a window repeats if its segment stayed behind in its batch, or if the merge says so
        window = np.cumsum(edge[:count]) > 0
        run = np.flatnonzero(np.diff(np.concatenate([[0], window.view(np.int8), [0]])))
        s, e = run[::2], run[1::2] + WIDTH - 1
        if len(s) > 1:
            new = np.concatenate([[True], s[1:] > e[:-1]])
            e = np.concatenate([e[np.flatnonzero(new)[1:] - 1], e[-1:]])
            s = s[new]
        n_spans.append(len(s))
        flat.append(np.stack([s, e], 1))
        text = data[a : a + n].tobytes()
        bounds = [0, *np.stack([s, e], 1).ravel().tolist(), n]
        kept.append(b"".join(text[bounds[j] : bounds[j + 1]] for j in range(0, len(bounds), 2)))
    pairs = np.concatenate(flat) if flat else np.zeros((0, 2), np.int64)
    spans = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_spans)]), pa.int32()), pa.StructArray.from_arrays([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], ["start", "stop"]))
    return pa.table([docs.column("id"), pa.array(np.diff(offsets)), spans, pa.array(kept, pa.binary())], schema=_RESULT_ARROW)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, the removed spans (maximal, as [start, stop) in UTF-8 bytes) and the kept bytes."""
    spark = docs.sparkSession
    n = 2 * common.partitions(spark)
    rows = docs.select(common.id_key(id_col).alias("id"), common.text_key(text_col).alias("row"), F.col(text_col).cast("string").alias("text"))
    home = rows.withColumn("part", F.pmod(F.xxhash64("id", "row"), F.lit(n)).cast("int"))
    blobs = rows.mapInArrow(_scan(n), _BLOBS)
    segments = common.checkpointed(blobs.repartition(common.partitions(spark), "part").mapInArrow(_settle(n), _BLOBS))
    fetched = home.groupBy("part").cogroup(segments.groupBy("part")).applyInArrow(_fetch(n), _BLOBS)
    merged = fetched.repartition(common.partitions(spark), "part").mapInArrow(_compare(n, shard_bytes), _BLOBS)
    out = home.groupBy("part").cogroup(segments.unionByName(merged).groupBy("part")).applyInArrow(_cut, _RESULT)
    return out.select(common.id_out("id").alias("doc_id"), "n_bytes", "spans", "kept")


def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Repeats of 100 bytes removed from ``documents``: sizes, spans and digest of what is kept."""
    out = remove_repeats(common.table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["stop"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op1_suffix_dedup": op1_suffix_dedup}
