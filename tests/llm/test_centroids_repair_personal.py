"""Centroid clustering, conversation repair and personal data against brute force, with awkward rows."""

import functools
import hashlib
import os
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from stratavox.llm import centroids, personal_data, turn_repair
from stratavox.llm.registry import oracle_sql, queries


@pytest.mark.parametrize("name", ["op11_centroids", "op12_turn_repair"])
def test_against_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
    found = con.execute(oracle_sql()[name])
    columns = [c[0] for c in found.description]
    got = queries()[name](spark, sf).select(*columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, found.fetchall()))


# --- centroids


def plain_clusters(rows, k, rounds, dim, scale=64, seed="1"):
    good = [(i, [int(np.floor(float(np.float64(x)) * scale)) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(good, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    z = [v for _, v in first]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda: [min((far(v, c), n) for n, c in enumerate(z)) for _, v in good]
    for _ in range(rounds):
        got = assign()
        for n in range(len(z)):
            mine = [v for (_, v), (_, m) in zip(good, got) if m == n]
            if mine:
                z[n] = [sum(c) // len(mine) for c in zip(*mine)]
    got = assign()
    own = [sum(d for d, m in got if m == n) for n in range(len(z))]
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in z]
    return sorted((-1 if i is None else i, n, d, own[n], sum(own), name[n]) for (i, _), (d, n) in zip(good, got))


def vectors(seed, n, dim):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 1, (6, dim))
    rows = [(i, [float(np.float32(x)) for x in middle[rng.integers(6)] + rng.normal(0, 0.2, dim)]) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(60)]  # one very common vector
    rows += [rows[3], rows[3], (rows[4][0], rows[5][1])]  # repeated rows, one id with two vectors
    return rows + [(None, rows[1][1]), (9001, None), (9002, []), (9003, rows[2][1][:-1]), (9004, [*rows[2][1][:-1], None]), (9005, [*rows[2][1][:-1], float("nan")]), (9006, [*rows[2][1][:-1], float("-inf")]), (9007, [-5000.25] * dim)]


@pytest.mark.parametrize("leaf", [centroids.LEAF, 3])
@pytest.mark.parametrize("dim", [2, 5])
def test_clusters_equal_plain_rounds(spark, monkeypatch, leaf, dim):
    # the query's tasks keep the module's sizes; small leaves are tried here
    rows = vectors(dim, 400, dim)
    frame = spark.createDataFrame([(i, v, "clash", 1) for i, v in rows], "vec_id long, embedding array<float>, cluster string, id int").repartition(3)
    got = centroids.cluster(frame, k=7, rounds=3, dim=dim).drop("centroid").collect()
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == plain_clusters(rows, 7, 3, dim)
    points = np.array([centroids.scaled(np.array(v), 64) for _, v in rows[:460]])
    monkeypatch.setattr(centroids, "LEAF", leaf)
    order, nodes = centroids.build(points)
    assert sorted(order) == list(range(460))
    z = points[[0, 9, 9, 50, 200]]  # two equal centroids
    whole, leaves = centroids.filtered(nodes, z)
    found = np.full(460, -1)
    for node, open_ in [(n, np.array([c])) for n, c in whole] + leaves:
        span = slice(nodes["start"][node], nodes["stop"][node])
        found[span] = open_[centroids.nearest(points[order][span], z[open_])[0]]
        assert (nodes["sums"][node] == points[order][span].sum(0)).all() and nodes["squares"][node] == (points[order][span] ** 2).sum()
    assert (found == ((points[order][:, None] - z) ** 2).sum(2).argmin(1)).all()
    assert leaf > 40 or whole  # small leaves: some nodes go whole


def test_few_vectors_none_and_too_large(spark):
    schema = "vec_id long, embedding array<double>"
    rows = [(1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [4.0, -1.0])]
    got = centroids.cluster(spark.createDataFrame(rows, schema), dim=2).drop("centroid").collect()
    assert sorted(map(tuple, got)) == plain_clusters(rows, 16, 3, 2)
    assert centroids.cluster(spark.createDataFrame([], schema), dim=2).collect() == []
    assert centroids.cluster(spark.createDataFrame([(1, None)], schema), dim=2).collect() == []
    with pytest.raises(Exception, match="would not fit"):
        centroids.cluster(spark.createDataFrame([(1, [1e30, 0.0])], schema), dim=2).collect()
    # far beyond what doubles hold exactly
    rows = [(i, [2.0e6 - i, -1.9e6 + 7 * i]) for i in range(30)]
    got = centroids.cluster(spark.createDataFrame(rows, schema), dim=2, k=3).drop("centroid").collect()
    assert sorted(map(tuple, got)) == plain_clusters(rows, 3, 3, 2)


# --- repair


def spoil(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        f = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text
        yield from [] if f == 0 else [(conv, turn, "user" if f == 4 else role, text)] * (2 if f == 3 else 1)


def plain_repair(rows):
    """Cheapest edits of one conversation's rows (turn, role, text), by search over what is kept, changed and inserted."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    blank = re.compile(r"[\x20\x09-\x0D]*")
    faults, seen = [], set()
    for _, role, text in rows:
        ink = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append(1 if blank.fullmatch(text) else 2 if (role, text) in seen else 0 if ink[-1] in ".!?" else 3)
        seen.add((role, text))

    @functools.cache
    def best(i, last, inserts=2):
        # the cheapest (cost, audit) from row i on, if the roles so far end with ``last`` ("" for none); more inserts never pay
        follow = {"": "u", "s": "u", "u": "a", "a": "u"}[last]
        ways = [(0, "")] if i == len(rows) and last in ("", "a") else []
        step = lambda cost, edit, rest: ways.append((cost + rest[0], edit + rest[1]))
        if i < len(rows):
            extra, initial = 3 if faults[i] == 3 else 0, rows[i][1][:1]
            step(4, "D", best(i + 1, last))
            if faults[i] in (0, 3):
                step(extra + 3, "R", best(i + 1, follow))
                if initial == follow or (initial == "s" and not last):
                    step(extra, "K", best(i + 1, initial))
        if inserts:
            step(3, "I", best(i, follow, inserts - 1))
        return min(ways, default=(10**9, ""))

    cost, audit = best(0, "")
    out, k, total = [], 0, sum(e != "D" for e in audit)
    for e in audit:
        role = "user" if len(out) % 2 == total % 2 else "assistant"
        if e != "D":
            out.append(f"{rows[k][1] if e == 'K' else role}:{'' if e == 'I' else rows[k][2]}")
        k += e != "I"
    assert k == len(rows) and re.fullmatch(r"(s?(ua)+)?", "".join(x[0] for x in out))
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    bad = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, faults.count(1), faults.count(2), faults.count(3), bad, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def conversations(seed, n=150):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut off", "so. ", "é ...\n", "", " \t", None, "long " * 30 + ".", "x"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "sage"]
    rows = []
    for c in [None, *range(n)]:
        for t in range(rng.choice([0, 1, 2, 4, 7, 12])):
            rows.append((c, rng.choice([t, t, t, t + 3, None]), rng.choice(roles), rng.choice(texts)))
    rows += [rows[5], rows[5]]
    rows += [(5000, t % 300, rng.choice(roles[:5]), rng.choice(texts[:6]) + str(rng.choice([t, 1])) + rng.choice([".", ""])) for t in range(700)]  # one very long conversation
    return rows + [(5001, 7, "user", "Same.")] * 300


@pytest.mark.parametrize("bits", [8, 2])
def test_repair_equals_search(spark, monkeypatch, bits):
    monkeypatch.setattr(turn_repair, "BITS", bits)
    rows = conversations(bits)
    frame = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], "conv_id long, turn long, role string, text string, place string, nth int, conv int").repartition(5)
    ids = frame.select(F.col("conv_id").alias("conv"))
    plans, turns = turn_repair.repair(turn_repair.damaged(frame), ids)
    groups = defaultdict(list)
    for c, *rest in spoil(rows):
        groups[c].append(tuple(rest))
    want = {c: plain_repair(groups[c]) for c in {r[0] for r in rows}}
    lines = defaultdict(dict)
    for r in turns.collect():
        assert r.nth not in lines[r.conv]
        lines[r.conv][r.nth] = f"{r.role}:{r.text}"
    got = {r.conv: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, hashlib.sha256("\n".join(lines[r.conv][i] for i in range(len(lines[r.conv]))).encode()).hexdigest()) for r in plans.collect()}
    assert got == want and len({w[6] for w in want.values()}) > 40


def test_repair_of_nothing(spark, tmp_path):
    schema = "conv_id long, turn long, role string, text string"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/conversations.parquet")
    assert turn_repair.op12_turn_repair(spark, str(tmp_path)).collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "Hello."), (None, None, None, None)], schema).write.parquet(f"{tmp_path}/two/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in turn_repair.op12_turn_repair(spark, f"{tmp_path}/two").collect()}
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) and set(got) == {gone, None}


# --- personal data

PLAIN = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(re.sub("[^0-9]", "", m)) <= 19 and sum(sum(map(int, str(int(d) * (1 + i % 2)))) for i, d in enumerate(reversed(re.sub("[^0-9]", "", m)))) % 10 == 0),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def plain_base(text):
    return [(k, m.start(), m.end()) for k, (form, check) in enumerate(PLAIN.values()) for m in re.finditer(form, text) if check(m[0])]


def test_base_spans_equal_plain_expressions():
    rng = random.Random(3)
    parts = ["a", "Z", "9", "42", "255", "256", "007", "1", "@", "@@", ".", "..", "-", "_", "%", "+", "+1", " ", "(", ")", "\n", "é", "𝒳", "4111 1111 1111 1111", "4111111111111112", "a.b@c-d.e", "1.2.3.4", "٣", "x@y"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert personal_data.base_spans(text) == plain_base(text), text
        spans = personal_data.base_spans(text)
        for a, b in personal_data.candidates(text, spans):
            assert a < b and not any(x < b and y > a for _, x, y in spans)


@pytest.mark.parametrize("unit", ["x", "1", "1 ", "1.", "a@", "+1", "+1 ", "@", ".", "(at)", "a(at)b.", "9-", "[", "0000000", "a1 "])
def test_very_long_texts_are_read_once(unit):
    text = unit * (400_000 // len(unit))
    spans = personal_data.base_spans(text)
    personal_data.candidates(text, spans)


def corpus():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    filler = lambda n: " ".join(word() for _ in range(n))
    email = lambda: f"{word()}{rng.randint(1, 999)}@{word()}.org"
    rows = [(i, f"{filler(9)} please write to: {email()} {filler(4)}") for i in range(60)]
    rows += [(100 + i, f"{filler(5)} ring me on +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} {filler(3)}") for i in range(60)]
    # an identifier that no base form matches, in the seeds' context and with one new context each
    rows += [(200 + i, f"{filler(4)} please write to: {word()}{i}(at){word()}.org {filler(2)}") for i in range(3)]
    rows += [(210, f"{filler(4)} ring me on 555 01{rng.randint(10, 99)} {filler(2)}")]
    # numbers in contexts of other things
    rows += [(300 + i, f"{filler(3)} copies sold {rng.randint(10000, 99999)} {filler(3)}") for i in range(40)]
    return rows + [(400, None), (401, ""), (402, "\n \t"), (None, rows[0][1]), (0, rows[70][1]), (403, "é" * 50_000)]


def test_patterns_find_what_expressions_miss(spark):
    rows = corpus()
    frame = spark.createDataFrame([(i, t, "clash", 5) for i, t in rows], "doc_id long, text string, base string, rid int").repartition(4)
    got = sorted(((-1 if r.doc_id is None else r.doc_id), tuple(map(tuple, r.base)), tuple(map(tuple, r.spans))) for r in personal_data.find(frame).collect())
    want = []
    for i, t in rows:
        base = tuple(plain_base(t or ""))
        more = []
        if i in (200, 201, 202):
            m = re.search(r"\w+\(at\)\w+\.org", t)
            more = [(0, *m.span())]
        if i == 210:
            m = re.search(r"555 \d+", t)
            more = [(3, *m.span())]
        want.append((-1 if i is None else i, base, tuple(sorted([*base, *more]))))
    assert got == sorted(want)


def test_scores_equal_plain_rounds(spark):
    rng = random.Random(5)
    pairs = sorted({(f"p{int(rng.random() ** 2 * 30)}", f"i{rng.randint(0, 80)}") for _ in range(400)})
    seeds = {f"i{n}": n % 4 for n in range(0, 80, 2)}
    one = personal_data.ONE
    graph = spark.createDataFrame([(p, i, *(one if seeds.get(i) == k else 0 for k in range(4))) for p, i in pairs], "pattern string, instance string, s0 long, s1 long, s2 long, s3 long")
    score = {i: [one if seeds.get(i) == k else 0 for k in range(4)] for _, i in pairs}
    for _ in range(personal_data.ROUNDS):
        by = defaultdict(list)
        for p, i in pairs:
            by[p].append(i)
        conf = {p: [sum(score[i][k] for i in mine) // (len(mine) + 1) for k in range(4)] for p, mine in by.items()}
        of = defaultdict(list)
        for p, i in pairs:
            of[i].append(p)
        score = {i: score[i] if i in seeds else [sum(conf[p][k] for p in mine) // len(mine) for k in range(4)] for i, mine in of.items()}
    assert {r.pattern: [r.s0, r.s1, r.s2, r.s3] for r in personal_data.score(graph).collect()} == conf


def test_personal_data_of_nothing(spark):
    assert personal_data.find(spark.createDataFrame([], "doc_id long, text string")).collect() == []
