"""Classifiers, language identification, quality rules and mixing: brute force, held-out accuracy and awkward rows."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratavox.llm import blocks, language_id, mixing, quality_classifier, quality_rules, toxicity

AWKWARD = [(None, "null id"), (900, None), (901, ""), (902, " \n\t"), (903, "wort " * 20_000), (904, "1234 5678"), (905, "𝒳é zz"), (905, "𝒳é zz")]


def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def awkward(spark):
    return spark.createDataFrame([(d, t, "en", None, 1.0) for d, t in AWKWARD], "doc_id long, text string, lang string, source string, score double")


def test_viterbi_is_best_labelling():
    rng = np.random.default_rng(0)
    scores, doc = rng.normal(size=(9, 3)).astype(np.float32) * 5, np.array([0, 0, 0, 2, 2, 2, 2, 3, 3])
    got = language_id.viterbi(scores, doc, 5, 2.0)
    for d in (0, 2, 3):
        at = np.flatnonzero(doc == d)
        value = lambda p: sum(scores[i, x] for i, x in zip(at, p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))
        best = max(itertools.product(range(3), repeat=len(at)), key=value)
        assert abs(value(best) - value(tuple(int(v) for v in got[at]))) < 1e-4


def test_language_held_out_accuracy(spark, sf):
    docs = documents(spark, "/root/testdata/sf0.01")
    got = language_id.op3_language_id(spark, "/root/testdata/sf0.01").where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in got) / len(got) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_spans_scripts_and_awkward_rows(spark, sf):
    rng = random.Random(0)
    make = lambda a, n: " ".join("".join(rng.choice(a) for _ in range(rng.randint(2, 7))) for _ in range(n))
    rows = [(i, make("abcdefgh", 80), "aa") for i in range(30)] + [(100 + i, make("qrstuvwx", 80), "qq") for i in range(30)] + [(200 + i, make("абвгдежз", 80), "ru") for i in range(30)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    mixed = make("abcdefgh", 20) + " " + make("абвгдежз", 30)
    langs, scores, spans = language_id.label([mixed, None, "", "12 34", "абв", "𝒳"], model)
    assert langs[:5] == ["ru", "und", "und", "und", "ru"] and [s["lang"] for s in spans[0].as_py()] == ["aa", "ru"]
    assert mixed[spans[0][1]["start"].as_py() :][:1] in "абвгдежз" and scores[1] == 0
    out = language_id.identify(awkward(spark), model).collect()
    assert len(out) == len(AWKWARD) and {r.lang_pred for r in out if r.doc_id in (900, 901, 902, 904)} == {"und"}
    assert language_id.identify(awkward(spark).limit(0), model).count() == 0
    assert {r.lang_pred for r in language_id.identify(awkward(spark), None).collect()} == {"und"}


def test_language_score_and_many_languages(spark):
    rng = random.Random(1)
    alphabets = ["".join(rng.sample("abcdefghijklmnopqrstuvwxyz", 9)) for _ in range(300)]
    make = lambda a, n: " ".join("".join(rng.choice(a) for _ in range(rng.randint(3, 6))) for _ in range(n))
    rows = [(k * 10 + j, make(a, 60), f"l{k:03d}") for k, a in enumerate(alphabets) for j in range(3)]
    docs = spark.createDataFrame(rows + [(9000 + i, rows[0][1], "l000") for i in range(30)], "doc_id long, text string, lang string")
    model = language_id.fit(docs, F.lit(True), sample=3)
    assert len(model.langs) == 300
    tests = [make(a, 80) for a in alphabets[::7]]
    langs, scores, _ = language_id.label(tests, model)
    assert sum(x == f"l{k * 7:03d}" for k, x in enumerate(langs)) / len(tests) > 0.9
    two = language_id.fit(docs.where("lang IN ('l000', 'l001')"), F.lit(True), sample=3)
    (lang,), (score,), _ = language_id.label([rows[0][1]], two)
    assert lang == "l000" and score > 0.9
    w = language_id.Words([rows[0][1]])  # the score from its three shares, plainly
    s = two.scores(w)
    seen = {t for text in {r[1] for r in rows[:3]} for g in [language_id.Words([text])] for i in range(len(g.start)) for t in g.grams(0, len(g.c))[0][g.start[i] : g.stop[i]]}
    has = [t in seen for i in range(len(w.start)) for t in w.grams(0, len(w.c))[0][w.start[i] : w.stop[i]]]
    total = s.sum(axis=0, dtype=np.float64)
    assert abs(score - np.mean(has) / (1 + np.exp(total[1] - total[0]))) < 1e-6
    _, (low,), _ = language_id.label([" ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(8)) for _ in range(50))], two)
    assert low < 0.25


def auc(y, s):
    rank = np.argsort(np.argsort(s)) + 1
    pos = y == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_quality_classifier(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    got = quality_classifier.op2_quality_classifier(spark, sf).join(labels, "doc_id").where("held_out").collect()
    assert auc(np.array([r.quality for r in got]), np.array([r.score for r in got])) > 0.9
    docs = documents(spark, sf)
    model = quality_classifier.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"), F.lit(True), sample=60)
    out = quality_classifier.score(awkward(spark), model).collect()
    assert len(out) == len(AWKWARD) and all(0 <= r.score <= 1 for r in out)
    same = [r.score for r in out if r.doc_id == 905]
    assert same[0] == same[1]
    assert model.scores(["ab\tcd."])[0] == model.scores(["ab\tcd.", "zz zz "])[0]
    long = " ".join(f"w{i % 300} x{i % 7}" for i in range(4000))
    assert model.scores([long, "é a𝒳"], 500).tolist() == model.scores([long, "é a𝒳"]).tolist()  # piece by piece
    assert quality_classifier.score(awkward(spark).limit(0), model).count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_classifier.fit(docs, none, F.lit(True)).scores(["any"])[0] == 0.5
    assert quality_classifier.fit(docs, spark.createDataFrame([(0, 1), (1, 1)], "doc_id long, quality int"), F.lit(True)).scores(["any"])[0] > 0.999
    assert quality_classifier.train([]).scores([""])[0] == 0.5


def test_quality_features_and_gradient():
    """Features against a plain count of words, distances and character n-grams; the gradient against differences."""
    text = "the Über the\nthe cat 𝒳y cat"
    words = text.split()
    got = [np.bincount(rows, minlength=4) for rows, _ in quality_classifier.rows_of([text])]
    marked = [f" {w} " for w in words]
    expected = [len(words), 3] + [sum(max(0, len(w) - n + 1) for w in marked) for n in quality_classifier.GRAMS]
    assert [int(g.sum()) for g in got] == expected
    apart = [list(zip(*np.unique(np.concatenate([r for r, _ in quality_classifier.rows_of([t])]), return_counts=True))) for t in ("one two", "three")]
    both = [np.concatenate([r[d == k] for r, d in quality_classifier.rows_of(["one two", "three"])]) for k in (0, 1)]
    assert [list(zip(*np.unique(b, return_counts=True))) for b in both] == apart
    rng = np.random.default_rng(3)
    table, layer, bias = rng.normal(size=(10, 4)), rng.normal(size=(4, 2)), rng.normal(size=2)
    rows, share = np.array([1, 4, 7]), np.array([0.5, 0.3, 0.2])

    def loss(table, layer, bias):
        z = share @ table[rows] @ layer + bias
        return np.log(np.exp(z).sum()) - z[1]

    by = quality_classifier.gradient(table, layer, bias, rows, share, 1)
    for which, value in enumerate((table, layer, bias)):
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in value.shape)
            if which == 0:
                at = (int(rng.choice(rows)), at[1])
            moved = [v.copy() for v in (table, layer, bias)]
            moved[which][at] += 1e-6
            slope = (loss(*moved) - loss(table, layer, bias)) / 1e-6
            mine = by[0][list(rows).index(at[0]), at[1]] if which == 0 else by[which][at]
            assert abs(slope - mine) < 1e-4


def test_out_of_fold_has_not_seen_the_fold():
    """Labels of a fold change neither the features nor the probabilities that the chain is given for it."""
    rng = np.random.default_rng(2)
    n = 200
    doc = np.repeat(np.arange(n), 6)
    name = rng.integers(0, 40, len(doc))
    y = (rng.random(n) < 0.3).astype(float)
    fold = rng.integers(0, toxicity.FOLDS, n)
    known, dense = np.ones(n, bool), np.ones((n, 1))
    before = toxicity.out_of_fold(doc, name, 40, y, known, fold, dense)
    other = np.where(fold == 1, 1 - y, y)
    after = toxicity.out_of_fold(doc, name, 40, other, known, fold, dense)
    assert np.array_equal(before[fold == 1], after[fold == 1]) and not np.array_equal(before[fold != 1], after[fold != 1])


def test_chain_equals_plain_scores():
    """Prediction against a plain reading of the weights, with an awkward text on a trained chain."""
    rng = random.Random(4)
    vocabulary = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(10) for j in range(10)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(20)) + (" vilething" if k % 4 == 0 else "") for k in range(120)]
    feats = [np.unique(toxicity.features(*blocks.column_bytes(pa.array([t])))[0]) for t in texts]
    chain = toxicity.train([(f, (int(k % 3 == 0), int(k % 4 == 0)), f"{k:04x}") for k, f in enumerate(feats)])
    tests = texts[:10] + ["", None, "  ", "vilething", "VILETHING x9 " * 3, "vilething " * 50_000]
    got = chain.predict(tests)
    assert got.tolist() == chain.predict(tests, 64).tolist()
    for t, p in zip(tests, got):
        found = set(toxicity.features(*blocks.column_bytes(pa.array([t or ""])))[0].tolist())
        before = []
        for link in chain.links:
            m = len(link.kept)
            z = sum(w for h, w in zip(link.kept.tolist(), link.weights[:m]) if h in found) + sum(a * b for a, b in zip(before, link.weights[m:])) + link.weights[-1]
            before.append(1 / (1 + np.exp(-z)))
        assert np.allclose(before, p, atol=1e-5)
    assert got[13, 1] > 0.5 > got[10, 1]


def test_toxicity_chain(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    got = toxicity.op4_toxicity(spark, sf).join(labels, "doc_id").where("held_out").collect()
    y, p = np.array([r.toxic for r in got]), np.array([r.predicted for r in got])
    assert (p[y == 1] == 1).mean() > 0.75 and (p[y == 0] == 1).mean() < 0.01
    chain = toxicity.train([])
    assert chain.predict(["", "abc"]).tolist() == [[0.5, 0.5], [0.5, 0.5]]
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.score(awkward(spark).limit(0), toxicity.fit(documents(spark, sf), empty, F.lit(True))).count() == 0
    out = toxicity.score(awkward(spark), chain).collect()
    assert len(out) == len(AWKWARD)


def brute_features(t):
    t = t or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", t)
    tri = Counter(zip(ws, ws[1:], ws[2:]))
    cover = set()
    for i in range(len(ws) - 2):
        if tri[ws[i], ws[i + 1], ws[i + 2]] > 1:
            cover |= {i, i + 1, i + 2}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(ws) < 50 or 100 * len(cover) > 50 * len(ws)
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover), failed


def test_quality_rules(spark):
    docs = documents(spark, "/root/testdata/sf0.01").select("doc_id", "text", "lang", "source")
    extra = awkward(spark).select((F.col("doc_id") + 1_000_000).alias("doc_id"), "text", "lang", "source").unionByName(spark.createDataFrame([(2_000_000, " ".join(f"a{i % 300} b{i % 7}" for i in range(3000)), None, None)], "doc_id long, text string, lang string, source string"))
    rows = docs.unionByName(extra)
    got = quality_rules.judge(rows).collect()
    text = {r.doc_id: r.text for r in rows.collect()}
    assert len(got) == rows.count()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_features(text[r.doc_id])
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    clean = [r for r in got if labels.get(r.doc_id) == 1 and not r.base_failed]
    junk = [r for r in got if labels.get(r.doc_id) == 0]
    assert sum(r.kept for r in clean) / len(clean) > 0.99 and sum(r.kept for r in junk) / len(junk) < 0.2
    assert quality_rules.judge(rows.limit(0)).count() == 0


def test_scripts_exclude_and_small_samples_win_nothing(spark):
    """Latin letter pairs that no sample has are not given to the language with the smallest sample, which is Cyrillic."""
    rng = random.Random(4)
    make = lambda a, n: " ".join("".join(rng.choice(a) for _ in range(rng.randint(2, 7))) for _ in range(n))
    rows = [(i, make("abcdefgh", 5000), "en") for i in range(40)] + [(900, make("абвгдежз", 30) + " abc", "ru")]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    new = [make("qrstuvwxyz", 40), make("zyxwvq", 200), "abc " + make("qrstuv", 30), make("jklmnop", 3)]
    assert language_id.label(new, model)[0] == ["en"] * 4
    assert language_id.label([make("абвг", 20), make("абвг", 20) + " abcd efgh"], model)[0] == ["ru", "ru"]
    rows[-1] = (900, make("абвгдежз", 30), "ru")
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    w = language_id.Words(["abc абв עברית"])
    model.tables()
    scores = model.scores(w)
    assert (scores[0] > -1e6).tolist() == [True, False] and (scores[1] > -1e6).tolist() == [False, True] and (scores[2] > -1e6).all()
    # a long text of one script stays in it however much the other's words would weigh
    langs, _, spans = language_id.label([make("qrstuvwxyz", 60_000) + " " + make("абвг", 40)], model)
    assert langs == ["en"] and [x["lang"] for x in spans[0].as_py()] == ["en", "ru"]


def test_mixing(spark):
    rng = random.Random(1)
    sizes = {"a": 300, "b": 20, "c": 100, None: 5}
    rows = [(i, s, rng.randint(1, 60)) for i, (s, n) in enumerate((s, k) for s, m in sizes.items() for k in range(m) for n in [0])]
    df = spark.createDataFrame([(i, s[0] if isinstance(s, tuple) else s, n) for i, s, n in rows] + [(None, "a", 7), (900, "z", 0)], "doc_id long, source string, size long")
    got = mixing.mix(df).collect()
    assert len(got) == df.count()
    size, target, taken = Counter(), {}, Counter()
    for r in got:
        size[r.source] += r.size
        target[r.source] = r.target
        taken[r.source] += r.taken
        assert r.taken % max(1, r.size) == 0 and r.taken <= 3 * r.size and r.source_size >= r.size
    assert abs(sum(target.values()) - sum(size.values())) < 1e-6
    for s in size:
        assert target[s] <= 3 * size[s] + 1e-9 and abs(taken[s] - target[s]) <= 60
    again = {(r.doc_id, r.source): r.taken for r in mixing.mix(df.repartition(7), cells=1, finer=2).collect()}
    assert again == {(r.doc_id, r.source): r.taken for r in got}
    assert mixing.mix(df.limit(0)).count() == 0


def plain_mix(rows, weights=mixing.WEIGHTS, most=mixing.MOST):
    """Words taken of each row, in the words of the definition, one source after the other."""
    sources = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, s or ""))
    size = {s: sum(n for _, x, n in rows if x == s) for s in sources}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sources)}
    target, open_, left = {}, set(sources), float(sum(size.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > most * size[s]}
        for s in over or set(open_):
            target[s] = most * size[s] if over else level * weight[s]
            left -= target[s]
            open_.discard(s)
    out = []
    for s in sources:
        whole = int(target[s] // size[s]) if size[s] else 0
        missing = target[s] - whole * size[s]
        own = sorted((r for r in rows if r[1] == s), key=lambda r: -r[2])
        certain, rest = [], [r for r in own if r[2]]
        while rest and missing > 0:
            c = (missing - sum(r[2] for r in certain)) / sum(r[2] ** 2 for r in rest)
            top = rest[0][2]
            if c * top < 1:
                break
            certain += [r for r in rest if r[2] == top]
            rest = [r for r in rest if r[2] < top]
        draw, taken = missing - sum(r[2] for r in certain), 0
        ranked = []
        for r in rest if missing > 0 else []:
            digest = hashlib.md5(f"{mixing.SEED}:{'' if r[0] is None else r[0]}".encode()).hexdigest()
            u, share = (int(digest[:13], 16) + 0.5) / 2**52, c * r[2]
            ranked.append(((u / (1 - u)) * ((1 - share) / share), r[0] is not None, r[0] or 0, r[2], r))
        extra = Counter(certain)
        for *_, r in sorted(ranked, key=lambda x: x[:4]):
            if taken + r[2] / 2 <= draw:
                extra[r] += 1
            taken += r[2]
        for r in own:
            more = extra[r] > 0
            extra[r] -= more
            out.append((r[0], r[1], r[2], r[2] * (whole + more)))
    return target, out


@pytest.mark.parametrize("case", ["several", "one source", "certain", "repeated ids", "whole copies", "no words"])
def test_mixing_against_plain(spark, monkeypatch, case):
    rng = random.Random(len(case))
    rows = {
        "several": [(i, rng.choice("abcd"), rng.randint(1, 90)) for i in range(300)] + [(None, None, 5), (None, "a", 8)],
        "one source": [(i, "a", rng.randint(0, 50)) for i in range(100)],
        "certain": [(i, "ab"[i % 2], 4000 if i < 4 else rng.randint(1, 20)) for i in range(120)],
        "repeated ids": [(i % 3, "ab"[i % 2], 10 + i % 3) for i in range(200)] + [(None, "a", 7)] * 40,
        "whole copies": [(i, "a", 10) for i in range(50)] + [(100 + i, "b", 10) for i in range(5)],
        "no words": [(1, "a", 0), (2, None, 0)],
    }[case]
    monkeypatch.setattr(mixing, "CHUNK", 16)
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, size long")).collect()
    target, expected = plain_mix(rows)
    order = lambda r: tuple((v is None, v if v is not None else 0) if not isinstance(v, str) else (False, v) for v in r)
    assert sorted(((r.doc_id, r.source, r["size"], r.taken) for r in got), key=order) == sorted(expected, key=order)
    assert all(abs(r.target - target[r.source]) < 1e-6 for r in got)


def test_quality_verdict_against_plain(spark):
    """Fences and verdicts from sorted values; groups of one, of a few and of hundreds, and reruns in another order."""
    rng = random.Random(3)
    rows = []
    for k, (lang, source, n) in enumerate((("en", "a", 260), ("en", "b", 150), ("de", "a", 1), (None, None, 4))):
        for i in range(n):
            words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) + rng.choice(["", "", "#" * rng.randint(0, 9) if i % 20 == 0 else ""]) for _ in range(rng.randint(51, 90))]
            rows.append((k * 1000 + i, " ".join(words) + "\nsame line\n" * rng.choice([1, 1, 9 if i % 30 == 0 else 1]), lang, source))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    again = {r.doc_id: r.kept for r in quality_rules.judge(docs.repartition(9)).collect()}
    assert again == {d: r.kept for d, r in got.items()} and 0 < sum(again.values()) < len(again)

    def edge(v):
        shift = v.bit_length() - (2 * quality_rules.PARTS).bit_length() + 1
        return v if v < 2 * quality_rules.PARTS else v >> shift << shift

    def fence(ids, ratio):
        values = sorted(edge(got[d][ratio]) for d in ids)
        rank = lambda v, p: sorted(v)[-(-len(v) * p // 100) - 1]
        q = {p: rank(values, p) for p in quality_rules.QUANTILES}
        size = quality_rules.SIZES.get(ratio)
        single = 10_000 // max(1, rank([edge(got[d][size]) for d in ids], 50)) if size else 1
        scale = quality_rules.REACH * max(q[75] - q[25], single, 1)
        reach = lambda v: max(scale, v) if size else scale
        high = next(v for v in values if v >= q[90] and not any(v < w <= v + reach(v) for w in values))
        low = next(v for v in reversed(values) if v <= q[10] and not any(v - scale <= w < v for w in values))
        return len(values), -1 if size else low - scale, high + reach(high)

    fine = {d: r for d, r in got.items() if not r.base_failed}
    where = {d: (lang, source) for d, _, lang, source in rows}
    k = quality_rules.PRIOR
    for d, r in got.items():
        ok = d in fine
        for ratio in quality_rules.RATIOS if ok else ():
            a = fence(fine, ratio)
            b = fence([x for x in fine if where[x][0] == where[d][0]], ratio)
            c = fence([x for x in fine if where[x] == where[d]], ratio)
            for side, sign in ((1, 1), (2, -1)):
                limit = (c[0] * c[side] + k * ((b[0] * b[side] + k * a[side]) / (b[0] + k))) / (c[0] + k)
                ok = ok and sign * r[ratio] >= sign * limit
        assert r.kept == ok
