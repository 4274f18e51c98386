"""Suffix, line and near-duplicate operators against brute force, with awkward rows."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import xxhash
from pyspark.sql import functions as F

from stratavox.llm import blocks, bwt, golay, line_dedup, simhash_dedup, suffix_dedup
from stratavox.operators.graph import components

SCHEMA = "doc_id long, text string, __id string, part int, key string"
AWKWARD = [(None, "null id"), (900, None), (901, ""), (902, " \n\t\n"), (903, "x" * 70_000), (904, "ab " * 9000), (905, "𝒳é\r\nLine of words here\r\n\r\n")]


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(d, t, "clash", 1, None) for d, t in rows], SCHEMA).repartition(parts)


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6))) for _ in range(40)]
    passages = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(4)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            r = rng.random()
            parts.append(rng.choice(passages)[rng.randint(0, 40):] if r < 0.35 else rng.choice(["a", "ab", "abc "]) * rng.randint(1, 500) if r < 0.5 else " ".join(rng.choice(words) for _ in range(rng.randint(1, 70))))
        rows.append((i * 7 % 131, "\n".join(parts)))
    return rows + [(200 + k, rows[k][1]) for k in range(5)] + AWKWARD


def brute_repeats(rows, width=100):
    seen, out = set(), {}
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (t or "").encode()
        cover = bytearray(len(b))
        for p in range(len(b) - width + 1):
            w = b[p : p + width]
            if w in seen:
                cover[p : p + width] = b"\1" * width
            seen.add(w)
        spans = sum(1 for i in range(len(b)) if cover[i] and (i == 0 or not cover[i - 1]))
        out[d] = (len(b), sum(cover), spans, hashlib.sha256(bytes(x for x, c in zip(b, cover) if not c)).hexdigest())
    return out


@pytest.mark.parametrize("shard", [1500, 1 << 19])
def test_suffix_dedup(spark, shard):
    rows = corpus(1)
    got = {r.doc_id: (r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in suffix_dedup.remove_repeats(frame(spark, rows), shard_bytes=shard).collect()}
    assert got == brute_repeats(rows)


def test_suffix_dedup_repeated_rows_and_empty(spark):
    text = "one two three " * 30
    for parts in (1, 3):
        got = suffix_dedup.remove_repeats(frame(spark, [(1, text), (1, text), (2, text)], parts)).collect()
        kept = len(text.encode()) - brute_repeats([(1, text)])[1][1]
        assert sorted((r.doc_id, len(r.kept)) for r in got) == [(1, kept), (1, kept), (2, 0)]
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0


def test_texts_that_share_an_id(spark):
    rng = random.Random(6)
    own = ["".join(rng.choice("abcdefgh ") for _ in range(300)) for _ in range(3)]
    rows = [(1, own[0]), (7, own[1]), (7, own[0] + own[2])]
    kept = [bytes(r.kept).decode() for r in suffix_dedup.remove_repeats(frame(spark, rows)).collect()]
    assert sorted(kept) == sorted(own)
    rows = [(1, "a line that is shared"), (7, "another line, unique\na line that is shared"), (7, "KEEP this unique line\nand this one as well")]
    got = sorted(r.text for r in line_dedup.drop_lines(frame(spark, rows)).collect())
    assert got == sorted(["a line that is shared", "another line, unique", "KEEP this unique line\nand this one as well"])


@pytest.mark.parametrize("weak", [False, True])
def test_suffix_stages_whatever_the_hashes(monkeypatch, weak):
    """The stages in one process; with hashes of three bits nearly everything collides, and bytes decide."""
    if weak:
        monkeypatch.setattr(blocks, "mix", lambda h: (h ^ (h >> np.uint64(17))) & np.uint64(7))
        monkeypatch.setattr(suffix_dedup.xxhash, "xxh3_64_intdigest", lambda b, seed=0: len(b) & 1)
    monkeypatch.setattr(suffix_dedup, "HOT", 40)
    rows = [(d, t) for d, t in corpus(11, 30) if d is not None and len(t or "") < 3000]
    n = 3
    table = pa.table({"id": [d for d, _ in rows], "row": [hash(t or "") for _, t in rows], "text": pa.array([t or "" for _, t in rows])})
    parts = blocks.parts_of(table["id"].to_numpy(), n, table["row"].to_numpy())
    of = lambda blobs, p: [pa.record_batch([b.column("part").filter(pc.equal(b.column("part"), p)), b.column("blob").filter(pc.equal(b.column("part"), p))], schema=suffix_dedup._ARROW) for b in blobs]
    scanned = list(suffix_dedup._scan(n)(iter(table.slice(0, 20).combine_chunks().to_batches() + table.slice(20).combine_chunks().to_batches())))
    segments = [b for p in range(n) for b in suffix_dedup._settle(n)(iter(of(scanned, p)))]
    fetched = [b for p in range(n) for b in suffix_dedup._fetch(n)(table.filter(pa.array(parts == p)).combine_chunks(), pa.Table.from_batches(of(segments, p))).to_batches()]
    merged = [b for p in range(n) for b in suffix_dedup._compare(n, 1 << 19)(iter(of(fetched, p)))]
    out = pa.concat_tables(suffix_dedup._cut(table.filter(pa.array(parts == p)).combine_chunks(), pa.Table.from_batches(of(segments, p) + of(merged, p))) for p in range(n))
    got = {r["id"]: (r["n_bytes"], sum(s["stop"] - s["start"] for s in r["spans"]), len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in out.to_pylist()}
    assert got == brute_repeats(rows)


def test_bwt_merge_equals_sorting():
    rng = np.random.default_rng(5)
    lengths = np.array([130, 150, 260, 100, 400])
    data = rng.integers(97, 99, lengths.sum()).astype(np.uint8)
    data[130:280] = data[280:430]
    one, many = (bwt.repeated_windows(data, lengths, np.arange(5) * 1000, s) for s in (1 << 20, 100))
    assert sorted(zip(*one)) == sorted(zip(*many))
    start = np.concatenate([[0], np.cumsum(lengths)])
    seen, expected = set(), []
    for s, n in enumerate(lengths):
        for p in range(n - 99):
            w = data[start[s] + p : start[s] + p + 100].tobytes()
            if w in seen:
                expected.append((s, p))
            seen.add(w)
    assert sorted(zip(*one)) == expected


def test_spark_hash_equal(spark):
    ids = [0, 1, -5, 1 << 40, -(1 << 63)]
    got = [r.h for r in spark.createDataFrame([(i,) for i in ids], "i long").select(F.xxhash64("i").alias("h")).collect()]
    assert sorted(got) == sorted(blocks.spark_hash_long(np.array(ids, np.int64)).tolist())


def brute_lines(rows):
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    rank = lambda d: (d is not None, d or 0)
    first, docs = {}, {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            k = key(line)
            docs.setdefault(k, set()).add(d)
            first[k] = min(first.get(k, d), d, key=rank)
    out = {}
    for d, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if not (len(key(x)) >= 10 and len(docs[key(x)]) >= 2 and first[key(x)] != d)]
        out[d] = (len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest())
    return out


def test_line_dedup(spark):
    rng = random.Random(2)
    lines = ["A common Line number one", "a common line number one  ", "short", "ünïcödé lines", "äöüäöüäöü", "x" * 12, ""]
    rows = [(i, "\n".join(rng.choice(lines + [f"own line of document {i} {k}" for k in range(3)]) for _ in range(rng.randint(1, 12)))) for i in range(80)] + AWKWARD
    out = line_dedup.drop_lines(frame(spark, rows)).withColumn("h", F.sha2(F.col("text").cast("binary"), 256))
    got = {r.doc_id: (r["__n_lines"], r["__n_dropped"], r.h) for r in out.collect()}
    assert got == brute_lines(rows)
    assert set(frame(spark, rows).columns) <= set(out.columns)


def test_line_dedup_hot_line_over_tasks(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        rows = [(i, "the very common line\n" * 3 + f"own line {i} of its own") for i in range(600)]
        got = line_dedup.keep_bitmaps(frame(spark, rows, 8)).where("n_dropped > 0").collect()
        assert sorted(r.id for r in got) == list(range(1, 600)) and {r.n_dropped for r in got} == {3}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert line_dedup.drop_lines(frame(spark, [])).count() == 0


def brute_fingerprint(t):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (t or ""))
    ws = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not ws:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(ws[i : i + 4]).encode(), seed=42) for i in range(max(1, len(ws) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    fps = np.array(fps, np.uint64)
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i] ^ fps) <= 4):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprints_and_components(spark):
    rows = corpus(3, 60)
    got = simhash_dedup.near_duplicates(frame(spark, rows)).collect()
    prints = {d: "%016x" % brute_fingerprint(t) for d, t in rows}
    assert {r.doc_id: r.fingerprint for r in got} == prints
    ids = list(prints)
    roots = brute_components([int(prints[d], 16) for d in ids])
    least = {}
    for d, r in zip(ids, roots):
        if d is not None:
            least[r] = min(least.get(r, d), d)
    assert {r.doc_id: r.component_id for r in got} == {d: least.get(r) for d, r in zip(ids, roots)}


@pytest.mark.parametrize("block", [2048, 50])
def test_links_lose_none(spark, block):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(60)]
    fps = set(base)
    for b in base:
        for _ in range(12):
            x = b
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << bit
            fps.add(x)
    for _ in range(400):
        x = base[0]
        for bit in rng.sample(range(64), rng.randint(1, 6)):
            x ^= 1 << bit
        fps.add(x)
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    links = simhash_dedup.links(spark.createDataFrame([(s,) for s in signed], "fp long").repartition(4), block)
    found = {r.node: r.root for r in components(links).collect()}
    mine = [found.get(s, s) for s in signed]
    theirs = brute_components(fps)
    assert len(set(zip(mine, theirs))) == len(set(mine)) == len(set(theirs))


def test_keep_one_and_large_groups(spark, monkeypatch):
    monkeypatch.setattr(simhash_dedup, "LARGE", 2)  # on the driver: which groups are joined in place
    rows = corpus(5, 40)
    rows += [(300 + i, rows[3][1]) for i in range(12)] + [(None, rows[4][1]), (None, rows[4][1]), (rows[6][0], "quite another text under an id that is taken, with enough words")]
    got = simhash_dedup.near_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    prints = [brute_fingerprint(t) for _, t in rows]
    roots = brute_components(prints)
    least = {}
    for (d, _), r in zip(rows, roots):
        if d is not None:
            least[r] = min(least.get(r, d), d)
    order = lambda x: tuple((v is None, v or 0) if not isinstance(v, str) else v for v in x)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=order) == sorted(((d, "%016x" % p, least.get(r)) for (d, _), p, r in zip(rows, prints, roots)), key=order)
    kept = simhash_dedup.keep_one(frame(spark, rows))
    assert set(frame(spark, rows).columns) == set(kept.columns)
    firsts = {}
    for (d, _), r in zip(rows, roots):
        firsts[r] = min(firsts.get(r, (True, 0)), (d is None, d or 0))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted(firsts.values())
    assert simhash_dedup.keep_one(frame(spark, [])).count() == 0 and simhash_dedup.near_duplicates(frame(spark, [])).count() == 0


def test_golay_decodes_within_three():
    words = np.random.default_rng(1).integers(0, 1 << 23, 500)
    index = golay.decode(words)
    x = index.astype(np.uint32) << 11
    codeword = x | golay._remainder(x)
    assert (np.bitwise_count(codeword ^ words.astype(np.uint32)) <= 3).all()
    flipped = golay.neighbour_indices(words, 23)
    for i in range(50):  # words at most two bits apart share an index
        other = golay.neighbour_indices(np.array([words[i] ^ 0b101]), 23)
        assert set(flipped[i]) & set(other[0])


def test_a_part_is_merged_from_several_transforms(monkeypatch, spark):
    """Texts of a driver table as one part: at least eight shards are interleaved, and the repeats are those of a plain scan."""
    texts = [(r.text or "").encode() for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").limit(160).collect()]
    texts = [t[:20_000] for t in texts if len(t) >= 100]
    data = np.frombuffer(b"".join(texts), np.uint8)
    lengths = np.array([len(t) for t in texts])
    seen, real = [], bwt.merge
    monkeypatch.setattr(bwt, "merge", lambda shards: seen.append(len(shards)) or real(shards))
    string, pos = bwt.repeated_windows(data, lengths, np.arange(len(texts)) * 1_000_000, min(suffix_dedup.SHARD, max(len(data) // suffix_dedup.SHARDS, suffix_dedup.LEAST_SHARD)))
    known, want = set(), set()
    for i, t in enumerate(texts):
        for p in range(len(t) - 99):
            w = t[p : p + 100]
            if w in known:
                want.add((i, p))
            known.add(w)
    assert seen[0] >= 7 and set(zip(string.tolist(), pos.tolist())) == want and len(want) > 1000


def test_positions_beyond_31_bits_are_refused():
    with pytest.raises(ValueError, match="31 bits"):
        bwt.Rows(np.zeros(0, np.uint8), np.array([1 << 31]))
