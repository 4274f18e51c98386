"""WARC round trips at any split, edit matching against brute force, and the pipeline against its parts."""

import gzip
import hashlib
import random
import zlib

import pytest

import corpus_pipeline
from stratavox.llm import common, decontam, simhash_dedup, warc


class Bytes:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at : at + n]


@pytest.mark.parametrize("split", [1, 7, 64, 1000, 1 << 20])
def test_every_split_owns_each_record_once(split):
    rng = random.Random(split)
    payloads = [bytes(rng.getrandbits(8) for _ in range(rng.randint(0, 300))) for _ in range(12)] + [warc.MAGIC * 40, zlib.compress(b"x" * 500), b"\x1f\x8b\x08WARC/1.1\r\n"]
    data = b"".join(warc.record(i, f"http://h/{i}", p, None, level=rng.choice([0, 6])) for i, p in enumerate(payloads))
    got = []
    for a in range(0, len(data), split):
        got += [r for _, r in warc.read_range(Bytes(data), len(data), a, min(len(data), a + split))]
    assert [r["block"].partition(b"\r\n\r\n")[2] for r in got] == payloads


def test_warc_round_trip(spark):
    big = "é" * 600
    rows = [(1, "u", big), (2, None, big), (3, "v w", None), (4, "u", "small"), (5, "u", "small"), (None, "u", big), (7, "u", ""), (8, "u", "y" * 200_000), (8, "u", "y" * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder = common.shared_dir(spark, "warc")
    got = warc.read(spark, folder, warc.write(pages, folder), split=500, with_payload=True).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert by[1].record_type == "revisit" and by[1].refers_to == 2 and by[1].payload_bytes == 1200 and by[1].payload_digest == hashlib.sha1(big.encode()).hexdigest()
    assert by[2].record_type == by[None].record_type == by[4].record_type == by[8].record_type == "response" and by[2].refers_to is None
    assert by[3].payload_bytes == 0 and by[7].payload_bytes == 0 and bytes(by[8].payload) == b"y" * 200_000
    empty = common.shared_dir(spark, "warc")
    assert warc.read(spark, empty, warc.write(pages.limit(0), empty)).count() == 0


def sub_distance(p, t):
    prev = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        cur = [i]
        for j, d in enumerate(t, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (c != d)))
        prev = cur
    return min(prev)


def test_myers_equals_dynamic_programming():
    rng = random.Random(0)
    for _ in range(200):
        p, t = ("".join(rng.choice("abc") for _ in range(rng.randint(a, b))) for a, b in ((1, 90), (0, 120)))
        assert decontam.myers(p, t)[0] == sub_distance(p, t)


def test_matches_equal_brute_force(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    items = [(i, " ".join(word() for _ in range(25))) for i in range(6)] + [(6, "zq zq"), (7, None), (8, "exactly fifteen"), (9, "nineteen characters"), (10, " \n ")]
    docs = []
    for d in range(60):
        text = " ".join(word() for _ in range(rng.randint(0, 60)))
        if d % 3 == 0:
            chars = list(items[d % 6][1])
            for _ in range(rng.randint(0, 14)):
                k = rng.randrange(len(chars))
                chars[k : k + 1] = rng.choice([[], ["x"], [chars[k], "y"]])
            text += "  " + "".join(chars).upper().replace(" ", "\n", 1) + " " + word()
        docs.append((d, text))
    docs += [(None, items[0][1]), (900, None), (901, ""), (902, "z" * 50_000), (903, "so ZQ  zq so"), (904, "Exactly\nfifteen"), (905, "exactly fiften"), (906, "exactly ften"), (907, "ninteen characters"), (None, "clean, without an id"), (0, "clean, under an id that is taken")]
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    expected = set()
    for d, t in docs:
        for i, x in items:
            n = decontam.normal(x)
            if n and len(decontam.normal(t)) < 2000 and sub_distance(n, decontam.normal(t)) <= int(len(n) * decontam.ERROR_RATE):
                expected.add((d, i))
    for chars in (1 << 20, 200):
        assert {(r.doc_id, r.item_id) for r in decontam.matches(a, b, block_chars=chars).collect()} == expected
        left = sorted((r.text or "") for r in decontam.clean(a, b, block_chars=chars).collect())
        bad = {t for d, t in docs for i, x in items if decontam.normal(x) and len(decontam.normal(t)) < 2000 and sub_distance(decontam.normal(x), decontam.normal(t)) <= int(len(decontam.normal(x)) * decontam.ERROR_RATE)}
        assert left == sorted((t or "") for _, t in docs if t not in bad)
    assert {(903, 6), (904, 8), (905, 8), (907, 9)} <= expected and not {(906, 8)} & expected
    assert decontam.clean(a.limit(0), b).count() == 0 and decontam.clean(a, b.limit(0)).count() == len(docs)
    assert decontam.matches(a, b.limit(0)).count() == 0


def test_other_writers_archives(spark, tmp_path):
    raw = b"x" * 1500
    good = hashlib.sha1(raw).hexdigest()

    def member(head, block):
        c = zlib.compressobj(6, zlib.DEFLATED, 31)
        text = b"WARC/1.0\r\n" + b"".join(k + b": " + v + b"\r\n" for k, v in head) + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"
        return c.compress(text) + c.flush()

    http = b"HTTP/1.1 200 OK\r\n\r\n" + raw
    data = member([(b"WARC-Type", b"warcinfo"), (b"WARC-Record-ID", b"<urn:uuid:1>")], b"software: other")
    data += member([(b"WARC-Type", b"response"), (b"WARC-Record-ID", b"<urn:uuid:2>"), (b"WARC-Payload-Digest", b"sha1:" + good.encode())], http)
    data += member([(b"WARC-Type", b"response"), (b"WARC-Payload-Digest", b"md5:abc")], http) + member([(b"WARC-Type", b"response")], http)
    (tmp_path / "a.warc.gz").write_bytes(data)
    archives = spark.createDataFrame([("a.warc.gz", len(data))], "name string, size long")
    got = warc.read(spark, f"file://{tmp_path}", archives, split=300).collect()
    assert sorted((r.record_type, r.record_id or "", r.page_id, r.payload_digest == good) for r in got) == [("response", "", None, True), ("response", "", None, True), ("response", "urn:uuid:2", None, True), ("warcinfo", "urn:uuid:1", None, False)]


def test_each_stage_against_brute_force(spark):
    """Small documents through every stage, each judged on its own input by plain Python."""
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(60)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    rows = [(i, say(60) + "\n" + say(30), "en", f"s{i % 3}", 0) for i in range(60)]
    rows += [(100 + i, rows[i][1], "en", "s1", 0) for i in range(5)] + [(200, "9 8 7 !!", None, None, 0), (201, None, "en", None, 0), (202, "", None, None, 0)]
    rows += [(203, " ".join("".join(rng.choice("qwxzkvyu") for _ in range(7)) for _ in range(80)), None, "s2", 0), (3, say(70), "en", "s0", 0), (None, say(80), "en", "s0", 0), (None, say(75), "en", "s0", 0)]
    rows += [(300, rows[50][1], "en", "s0", 0), (300, rows[50][1], "en", "s0", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    key = lambda r: (r.doc_id if r.doc_id is not None else -1, r.text or "")
    kept = corpus_pipeline.language_stage(spark, docs, None)
    left = sorted(map(key, kept.collect()))
    assert left == sorted((d if d is not None else -1, t) for d, t, *_ in rows if d not in (200, 201, 202, 203))
    lines = corpus_pipeline.line_stage(spark, kept, None).collect()
    first = {}
    for d, t in left:
        for line in t.split("\n"):
            first[line.strip().lower()] = min(first.get(line.strip().lower(), d), d)
    assert sorted(map(key, lines)) == sorted((d, "\n".join(x for x in t.split("\n") if len(x.strip()) < 10 or first[x.strip().lower()] == d)) for d, t in left)
    assert all(r.n_chars == len(r.text) for r in lines)
    prints = [simhash_dedup.fingerprint((t or "").encode()) for _, t in left]
    group = list(range(len(left)))
    for _ in left:
        for i in range(len(left)):
            for j in range(len(left)):
                if bin(prints[i] ^ prints[j]).count("1") <= simhash_dedup.RADIUS:
                    group[i] = min(group[i], group[j])
    near = sorted(map(key, corpus_pipeline.near_duplicate_stage(spark, kept, None).collect()))
    assert len(near) == len(set(group))
    of = {}
    for (d, t), g in zip(left, group):
        of.setdefault(g, []).append((d < 0, d))
    assert sorted(d for d, _ in near) == sorted(min(v)[1] for v in of.values())
    mixed = corpus_pipeline.mixing_stage(spark, kept, None).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r["size"]) for r in mixed) == sorted((d, len(t.split())) for d, t in left)
    assert abs(sum(r.taken for r in mixed) - sum(r["size"] for r in mixed)) <= 3 * 120


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert len(corpus_pipeline.STAGES) == 5
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, sf)
        assert sorted(out.columns) == sorted(docs.columns)
        path = common.shared_dir(spark, f"test-{name}")
        out.write.parquet(path)
        kept = spark.read.parquet(path)
        now = {r.doc_id for r in kept.select("doc_id").collect()}
        assert now <= ids and len(now) == kept.count()
        ids = now
    items = [decontam.normal(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert not any(i in decontam.normal(r.text) for r in kept.collect() for i in items)
    mixed = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in mixed} == ids


def test_stages_take_awkward_rows(spark, sf):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "some words here", None, "s", 3), (3, "Hello there world " * 9, "en", None, 1), (3, "Hello there world " * 9, "en", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, frame, sf).count() <= len(rows)


@pytest.mark.parametrize("split", [120, 1 << 20])
@pytest.mark.parametrize("harm", ["cut", "flip", "length"])
def test_damaged_archives_are_not_silent(spark, tmp_path, harm, split):
    rng = random.Random(5)
    members = [warc.record(i, f"http://h/{i}", bytes(rng.getrandbits(8) for _ in range(400)), None) for i in range(4)]
    bad = 3 if harm == "cut" else 1
    if harm == "cut":
        members[3] = members[3][:-30]
    elif harm == "flip":
        members[1] = members[1][:250] + bytes([members[1][250] ^ 0x41]) + members[1][251:]
    else:
        members[1] = gzip.compress(gzip.decompress(members[1])[:-200])
    data = b"".join(members)
    (tmp_path / "a.warc.gz").write_bytes(data)
    archives = spark.createDataFrame([("a.warc.gz", len(data))], "name string, size long")
    with pytest.raises(Exception, match=f"begins at byte {sum(map(len, members[:bad]))} is damaged"):
        warc.read(spark, f"file://{tmp_path}", archives, split=split).collect()
    got = {r.page_id: r for r in warc.read(spark, f"file://{tmp_path}", archives, split=split, damaged=True).collect()}
    assert sorted(got) == [0, 1, 2, 3] and [i for i in got if got[i].damage] == [bad]
    assert got[bad].payload_bytes is None and got[bad].payload_digest is None and got[bad].url == f"http://h/{bad}"
    assert all(got[i].payload_bytes == 400 for i in range(4) if i != bad)


def test_pages_with_clashing_columns(spark, tmp_path):
    schema = "page_id long, url string, html string, name string, size long, refers_to long, payload binary"
    pages = spark.createDataFrame([(1, "u", "x" * 1200, "n", 5, 9, b"p"), (2, None, "x" * 1200, None, None, None, None), (None, "v", None, "m", 1, 1, None)], schema)
    folder = f"file://{tmp_path}/w"
    got = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes, r.url) for r in warc.read(spark, folder, warc.write(pages, folder)).collect()}
    assert got == {1: ("revisit", 2, 1200, "u"), 2: ("response", None, 1200, None), None: ("response", None, 0, "v")}
