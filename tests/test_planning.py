"""Fixed vectors and invariants of the planners."""

from pyspark.sql import functions as F

from stratavox.functions import hashing
from stratavox.operators import geometry, planning, temporal


def test_digest_vectors(spark):
    one = spark.range(1)
    split = hashing.json_digest(planning.SPLIT_DOMAIN, F.lit("src0"), F.lit("fr"), F.lit(7))
    seed = hashing.joined_digest(*map(F.lit, ("PTA-v4", "seed", "cafe", "src0", "fr", "channel:gray:center", "full", "7", "1", "0")))
    got = one.select(split.alias("a"), seed.alias("b"), hashing.leading_u32(seed).alias("c")).first()
    assert got.a == "eddff907f2718020a794f3918b93cad2ab67b70313c333dc717de54ef618f700"
    assert got.b == "ff38aa91f4382ff9b16f1b0b8c249a8dc50ef897a3762738e3393e9465595771"
    assert got.c == 4281903761


def test_json_text_escapes(spark):
    got = spark.createDataFrame([('a"b\\c\0d',)], "s string").select(hashing.json_text(F.col("s")).alias("j")).first().j
    assert got == '"a\\"b\\\\c\\u0000d"'


def test_windows_own_every_frame_once(spark):
    anchors = spark.createDataFrame([(1, a) for a in (3, 90, 91, 400)] + [(2, 10)], "lineage long, frame long")
    windows = temporal.domain_windows(temporal.anchor_domains(anchors, 0, 500)).collect()
    for lineage in (1, 2):
        owned = []
        for w in (w for w in windows if w.lineage == lineage):
            a, b = w.window_start, w.window_stop
            assert b - a <= temporal.SESSION
            if w.branch == "backward":
                b -= 1
            if w.branch == "forward":
                a += 1
            owned += range(a, b)
        assert sorted(owned) == list(range(500))


def test_interval_merge_touching(spark):
    rows = spark.createDataFrame([(1, 0, 3), (1, 3, 5), (1, 7, 9), (1, 8, 8)], "k long, start long, stop long")
    got = sorted((r.start, r.stop, r.n) for r in temporal.merge_intervals(rows, ["k"]).collect())
    assert got == [(0, 5, 2), (7, 9, 2)]


def test_affine_inverse():
    m = geometry.affine(9, 7, 12, 33.0)
    a, b, c, d, e, f = geometry.invert(m)
    x, y = 2.5, 1.25
    u, v = m[0] * x + m[1] * y + m[2], m[3] * x + m[4] * y + m[5]
    assert abs(a * u + b * v + c - x) < 1e-9 and abs(d * u + e * v + f - y) < 1e-9


def test_positions_equal_one_sort(spark):
    import random

    from stratavox.functions import ranks

    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([0, 1, None]), f"{rng.randrange(1 << 20):08x}", k) for k in range(3000)]
    rows += [("c", 0, "00000000", k) for k in range(50)]
    frame = spark.createDataFrame(rows, "key string, part int, digest string, n long").repartition(6)
    order = [F.col(c) for c in ("part", "digest", "n")]
    got = {r.n if r.key != "c" else (r.n, "c"): r["__nth"] for r in ranks.positions(frame, ["key"], [order[0], ranks.bucket(order[1])], order).collect()}
    want = {}
    for key in ("a", "b", "c", None):
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        want |= {(r[3] if key != "c" else (r[3], "c")): k for k, r in enumerate(mine, 1)}
    assert got == want
    assert ranks.positions(frame, [], [ranks.bucket(order[1])], order[1:]).selectExpr("count(distinct __nth) = count(*) AND max(__nth) = count(*) AS ok").first().ok
