"""Toxicity by classifier chains: linear models in a row, each fed the earlier ones' probabilities.

The categories are predicted in a fixed order. The model of a category sees the text's features and the probabilities of
the categories before it; for training those probabilities come from models that have not seen the text (out-of-fold), so
that a later model learns how far an earlier one can be trusted. A fold's models choose their features from the other
folds' texts alone, so held-out labels do not leak into them. Features are the words of a text and the beginnings of its
words, present or not; of those a category keeps the ones whose shares of texts differ most between its two classes, in
units of the chance difference.

Each category has a label column of its own. The tables here label two: whether a text is unfit (``quality`` 0) and
whether it is toxic, so the chain is unfit, then toxic. A document is called toxic by the last.

Nulls: a null or empty text has no features. A row without a label of a category is not learned from in that category;
with one class only the probabilities are its share, without any label one half. Different labels of one doc_id are
several examples; of several texts under one doc_id that with the least hash is learned from. Ties: equal texts have equal
scores, which depend on the text only; of features that differ as much the smaller hash is kept. Very long texts are taken
piece by piece, with the same result as in one. Empty tables give no rows. Columns besides the text are handed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavox.llm import blocks, common
from stratavox.llm.subwords import Text, grouped

#: Labelled rows learned from at most, of each class of the last category; features that a category keeps at most.
SAMPLE, FEATURES = 3000, 4000
#: Bytes of a word's beginning; texts of the sample that need a feature.
HEADS, MIN_TEXTS = (4, 5, 6), 4
FOLDS, RIDGE, ROUNDS = 5, 0.1, 150
#: (category, its label column, the label that means it), in the order of the chain.
CATEGORIES = (("unfit", "quality", 0), ("toxic", "toxic", 1))
CUT = 0.5
#: Characters taken together, and of a piece of a long text.
GROUP = 2 << 20


def features(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of all words and beginnings, repeats included."""
    text = Text(offsets, data, letters_only=True)
    parts = [(text.words(), text.doc), *(text.heads(n) for n in HEADS)]
    return np.concatenate([h for h, _ in parts]), np.concatenate([d for _, d in parts])


class Design:
    """Present features as (text, feature) pairs, and dense columns beside them, the last of ones."""

    def __init__(self, doc: np.ndarray, feature: np.ndarray, n: int, k: int, dense: np.ndarray):
        self.doc, self.feature, self.n, self.k, self.dense = doc, feature, n, k, dense

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc, weights=w[: self.k][self.feature], minlength=self.n) + self.dense @ w[self.k :]

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(self.feature, weights=r[self.doc], minlength=self.k), self.dense.T @ r])

    def of(self, rows: np.ndarray) -> "Design":
        new = np.full(self.n, -1)
        new[rows] = np.arange(rows.sum())
        ok = rows[self.doc]
        return Design(new[self.doc[ok]], self.feature[ok], int(rows.sum()), self.k, self.dense[rows])


def logistic(x: Design, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by accelerated gradient steps; the last weight is the intercept, which is not shrunk."""
    w = np.zeros(x.k + x.dense.shape[1])
    share = np.clip(y.mean() if len(y) else 0.5, 1e-4, 1 - 1e-4)
    w[-1] = np.log(share / (1 - share))
    if len(np.unique(y)) < 2:
        return w
    v = np.ones(len(w))
    for _ in range(20):  # largest curvature, by power iteration
        v = x.back(x.times(v))
        v /= np.linalg.norm(v)
    rate = 1 / (np.linalg.norm(x.back(x.times(v))) / 4 * 1.1 + RIDGE)
    shrink = np.append(np.full(len(w) - 1, RIDGE), 0)
    ahead, last, t = w, w, 1.0
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-x.times(ahead)))
        w = ahead - rate * (x.back(p - y) + shrink * ahead)
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        ahead, last = w + (before - 1) / t * (w - last), w
    return w


def choose(doc: np.ndarray, name: np.ndarray, n_names: int, y: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The features kept, from those of ``rows`` with label ``y`` only."""
    ok = rows[doc]
    d, f = doc[ok], name[ok]
    bad = np.bincount(f, weights=y[d], minlength=n_names)
    all_ = np.bincount(f, minlength=n_names)
    n_bad = y[rows].sum()
    n_good = rows.sum() - n_bad
    share = all_ / max(1.0, n_bad + n_good)
    noise = share * (1 - share) * (1 / max(1.0, n_bad) + 1 / max(1.0, n_good))
    gap = np.abs(bad / max(1.0, n_bad) - (all_ - bad) / max(1.0, n_good)) / np.sqrt(np.maximum(noise, 1e-12))
    able = np.flatnonzero(all_ >= MIN_TEXTS)
    return np.sort(able[np.lexsort((able, -gap[able]))][:FEATURES])


def design(doc: np.ndarray, name: np.ndarray, n_names: int, kept: np.ndarray, dense: np.ndarray) -> Design:
    place = np.full(n_names, -1)
    place[kept] = np.arange(len(kept))
    ok = place[name] >= 0
    return Design(doc[ok], place[name[ok]], len(dense), len(kept), dense)


class Link:
    """One category's kept hashes and weights: of these, of the probabilities before it, and the intercept."""

    def __init__(self, kept: np.ndarray, weights: np.ndarray):
        self.kept, self.weights = kept, weights
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[kept >> np.uint64(44)] = True

    def found(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``hashes``, kept feature) of the hashes that are kept."""
        if not len(self.kept):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ok = np.flatnonzero(self.maybe[hashes >> np.uint64(44)])
        at = np.minimum(np.searchsorted(self.kept, hashes[ok]), len(self.kept) - 1)
        hit = self.kept[at] == hashes[ok]
        return ok[hit], at[hit]


class Chain:
    def __init__(self, links: list[Link]):
        self.links = links

    def predict(self, texts: list[str | None], most: int = GROUP) -> np.ndarray:
        """(texts, categories)."""
        codes: list[list[np.ndarray]] = [[] for _ in self.links]
        for base, some, _ in grouped(texts, most):
            hashes, doc = features(*blocks.column_bytes(pa.array(some, pa.string())))
            for k, link in enumerate(self.links):
                i, f = link.found(hashes)
                codes[k].append(np.unique((base + doc[i]) * np.int64(max(1, len(link.kept))) + f))
        out = np.zeros((len(texts), len(self.links)))
        for k, link in enumerate(self.links):
            m = len(link.kept)
            code = np.unique(np.concatenate(codes[k])) if codes[k] else np.zeros(0, np.int64)
            z = np.bincount(code // max(1, m), weights=link.weights[:m][code % max(1, m)], minlength=len(texts)) if m and len(code) else np.zeros(len(texts))
            out[:, k] = 1 / (1 + np.exp(-(z + out[:, :k] @ link.weights[m : m + k] + link.weights[-1])))
        return np.round(out, 6)


def out_of_fold(doc: np.ndarray, name: np.ndarray, n_names: int, y: np.ndarray, known: np.ndarray, fold: np.ndarray, dense: np.ndarray) -> np.ndarray:
    """Probabilities of each text from a model, features included, that has seen the other folds only."""
    out = np.zeros(len(y))
    for k in range(FOLDS):
        inside, outside = (fold != k) & known, fold == k
        if outside.any():
            x = design(doc, name, n_names, choose(doc, name, n_names, y, inside), dense)
            out[outside] = 1 / (1 + np.exp(-x.of(outside).times(logistic(x.of(inside), y[inside]))))
    return out


def train(examples: list[tuple[np.ndarray, tuple[int | None, ...], str]], categories: int = len(CATEGORIES)) -> Chain:
    """From (distinct hashes, a label or None for each category, digest of the id) of each text."""
    n = len(examples)
    doc = np.repeat(np.arange(n), [len(e[0]) for e in examples]) if n else np.zeros(0, np.int64)
    names, name = np.unique(np.concatenate([e[0] for e in examples]) if n else np.zeros(0, np.uint64), return_inverse=True)
    fold = np.array([int(e[2][:4], 16) % FOLDS for e in examples], np.int64)
    dense, links = np.ones((n, 1)), []
    for c in range(categories):
        known = np.array([e[1][c] is not None for e in examples], bool)
        y = np.array([float(e[1][c] or 0) for e in examples])
        kept = choose(doc, name, len(names), y, known)
        links.append(Link(names[kept], logistic(design(doc, name, len(names), kept, dense).of(known), y[known])))
        if c + 1 < categories:
            dense = np.hstack([dense[:, :-1], out_of_fold(doc, name, len(names), y, known, fold, dense)[:, None], dense[:, -1:]])
    return Chain(links)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for text in batch.column("text").to_pylist():
            parts = [np.unique(features(*blocks.column_bytes(pa.array(some, pa.string())))[0]) for _, some, _ in grouped([text], GROUP)]
            found.append(np.unique(np.concatenate(parts)).tobytes() if parts else b"")
        yield pa.record_batch([batch.column("h"), batch.column("y"), pa.array(found, pa.binary())], ["h", "y", "found"])


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted(((r["h"], [-1 if v is None else v for v in r["y"]], r["found"]) for batch in batches for r in batch.to_pylist()))
    chain = train([(np.frombuffer(found, np.uint64), tuple(None if v < 0 else v for v in y), h) for h, y, found in rows], len(rows[0][1]) if rows else len(CATEGORIES))
    yield pa.record_batch([pa.array([x.kept.tobytes() for x in chain.links], pa.binary()), pa.array([x.weights.tobytes() for x in chain.links], pa.binary()), pa.array(range(len(chain.links)), pa.int32())], ["kept", "weights", "k"])


def fit(docs: DataFrame, labels: DataFrame, learn, categories: tuple = CATEGORIES, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Chain:
    """Learned from ``sample`` labelled rows at most of each class of the last category, for which ``learn`` on the id holds."""
    y = F.array(*((F.col(c) == v).cast("int") for _, c, v in categories))
    y = labels.where(learn & F.col(categories[-1][1]).isNotNull()).select(F.col(id_col).alias("__id"), y.alias("y"))
    y = y.withColumn("h", F.md5(F.coalesce(F.col("__id").cast("string"), F.lit("")).cast("binary")))
    picked = [y.where(F.element_at("y", -1) == k).orderBy("h", "y").limit(sample) for k in (0, 1)]  # ids and labels only, ``sample`` rows each
    rows = docs.select(F.col(id_col).alias("__doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(picked[0].unionByName(picked[1])), F.col("__doc") == F.col("__id"))
    rows = rows.groupBy("__id", "h", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("h", "y", "text")
    found = rows.mapInArrow(_examples, "h string, y array<int>, found binary")
    got = found.repartition(1).mapInArrow(_learn, "kept binary, weights binary, k int").collect()  # FEATURES a category
    links = [Link(np.frombuffer(r.kept, np.uint64), np.frombuffer(r.weights)) for r in sorted(got, key=lambda r: r.k)]
    return Chain(links) if links else train([], len(categories))


def _score(shared, text_col: str, names: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        for batch in batches:
            scores = chain.predict(batch.column(text_col).to_pylist())
            kept = [n for n in batch.schema.names if n != text_col]
            yield pa.record_batch([*(batch.column(n) for n in kept), *(pa.array(scores[:, k]) for k in range(len(names)))], [*kept, *names])

    return run


def score(docs: DataFrame, chain: Chain, text_col: str = "text", categories: tuple = CATEGORIES) -> DataFrame:
    """``docs`` with a probability for each category in place of the text."""
    names = tuple(f"p_{c}" for c, _, _ in categories)
    docs = common.without(docs, *names)
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # FEATURES weights a category at most
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text_col), *(f"{n} double" for n in names)])
    return docs.mapInArrow(_score(shared, text_col, names), schema)


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every text of ``documents``, learned from labels outside the held-out fold."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = fit(docs, common.table(spark, sf_dir, "labels"), ~held_out())
    out = score(docs, chain)
    return out.select("doc_id", held_out().alias("held_out"), F.col("p_toxic").alias("score"), (F.col("p_toxic") >= CUT).cast("int").alias("predicted"), "p_unfit")


QUERIES = {"op4_toxicity": op4_toxicity}
