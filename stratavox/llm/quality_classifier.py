"""Quality classifier: supervised subword embeddings in the manner of a bag of hashed words and character n-grams.

Each word and each character n-gram of a word (its ends marked) is hashed to a row of one embedding table; a text is the
average of its rows, a softmax layer on top gives the labels. A word that came up a short while before also gives a token
for how far back that is: without it, texts that run in circles look like the good text they repeat (the README has the
figures). Table and layer are learned together by stochastic gradient descent in numpy, text by text, along the gradient
of the averaged model, on a bounded sample of labelled rows; one executor task learns, the driver gets the model alone.
For scoring table and layer are multiplied out: a row then counts by one number, and a text's score is the logistic of an
average over the whole text.

Nulls: a null or empty text has no rows and gets the score of the intercept alone, and is learned from like any other.
Rows without a label are not learned from; without both labels in the sample every score is the share of label 1 (0.5 if
there is none at all). Different labels of one doc_id are several
examples; of several texts under one doc_id that with the
least hash is learned from. Ties: equal texts have equal scores, which depend on the text only. Very long texts are taken
piece by piece, with the same result as in one. Empty tables give no rows. Columns besides the text are handed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavox.llm import blocks, common
from stratavox.llm.subwords import grouped

#: Labelled rows learned from at most: those with the least digest of their id.
SAMPLE = 3000
TABLE_BITS, WIDTH, EPOCHS, SEED = 17, 8, 8, 7
#: Steps of the layer, the intercept and the table.
RATE, BIAS_RATE, TABLE_RATE = 0.5, 0.05, 20.0
GRAMS = (3, 4)
#: Distances, in words, to the word's last time are told apart by power of two up to this one.
NEAR = 8
CUT = 0.7
#: Characters taken together, and of a piece of a long text.
GROUP = 2 << 20


def rows_of(texts: list[str], skip: list[int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(table row, text) of every feature, kind by kind; texts ascend within a kind. ``skip`` characters of each only count as what is before."""
    joined = "\n" + "\n".join(texts) + "\n"
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    start = 1 + np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])[:-1]]).astype(np.int64)
    begin = start + np.array(skip if skip is not None else [0] * len(texts), np.int64)
    inside = ~((cp == 32) | ((cp >= 9) & (cp <= 13)))
    c = np.where(inside, cp, 0).astype(np.uint32)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
    first, last = edge[::2], edge[1::2]
    owner = np.searchsorted(start, first, "right") - 1
    words = blocks.span_hash(blocks.prefix_hash(c), first, last)
    new = first >= begin[owner]
    yield (words[new] >> np.uint64(64 - TABLE_BITS)).astype(np.uint32), owner[new]
    order = np.lexsort((np.arange(len(words)), words, owner))
    same = (words[order][1:] == words[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    gap = np.zeros(len(words), np.int64)
    gap[order[1:][same]] = (order[1:] - order[:-1])[same]
    again = np.flatnonzero((gap > 0) & (gap < 1 << NEAR) & new)
    far = np.log2(gap[again]).astype(np.uint64)
    yield (blocks.mix(far + np.uint64(0x1234567)) >> np.uint64(64 - TABLE_BITS)).astype(np.uint32), owner[again]
    for n in GRAMS:
        m = len(c) - n + 1
        if m <= 0:
            continue
        ok, h = np.ones(m, bool), np.full(m, 2166136261 + n, np.uint32)
        for k in range(n):
            if 0 < k < n - 1:  # only the ends of a gram may be the ends of a word
                ok &= inside[k : m + k]
            h = (h ^ c[k : m + k]) * np.uint32(16777619)
            h ^= h >> np.uint32(13)
        at = np.flatnonzero(ok)
        text = np.searchsorted(start, at + 1, "right") - 1  # by its second character, which is inside a word
        seen = at + 1 >= begin[text]
        yield (h[at[seen]] * np.uint32(0x9E3779B1)) >> np.uint32(32 - TABLE_BITS), text[seen]


class Model:
    def __init__(self, weight: np.ndarray, bias: float):
        self.weight, self.bias = weight, bias

    def scores(self, texts: list[str | None], most: int = GROUP) -> np.ndarray:
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for base, some, skip in grouped(texts, most, 1 << NEAR):
            for rows, doc in rows_of(some, skip):
                total[base : base + len(some)] += np.bincount(doc, weights=self.weight[rows], minlength=len(some))
                count[base : base + len(some)] += np.bincount(doc, minlength=len(some))
        return np.round(1 / (1 + np.exp(-(total / np.maximum(count, 1) + self.bias))), 6)


def gradient(table: np.ndarray, layer: np.ndarray, bias: np.ndarray, rows: np.ndarray, share: np.ndarray, y: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the cross entropy of one text, given its distinct rows and their shares: by its rows of the table, layer, bias."""
    mean = share @ table[rows] if len(rows) else np.zeros(table.shape[1], table.dtype)
    z = mean @ layer + bias
    p = np.exp(z - z.max())
    p /= p.sum()
    p[y] -= 1
    return share[:, None] * (layer @ p)[None, :], np.outer(mean, p), p


def train(examples: list[tuple[np.ndarray, np.ndarray, int]]) -> Model:
    """From (distinct rows, counts, label) of each text."""
    size = 1 << TABLE_BITS
    labels = np.array([e[2] for e in examples])
    share = float(labels.mean()) if len(labels) else 0.5
    if len(labels) == 0 or share in (0.0, 1.0):
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros(size, np.float32), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(SEED)
    table = rng.uniform(-1 / WIDTH, 1 / WIDTH, (size, WIDTH)).astype(np.float32)
    layer, bias = np.zeros((WIDTH, 2), np.float32), np.log(np.array([1 - share, share], np.float32))
    shares = [(c / max(1, c.sum())).astype(np.float32) for _, c, _ in examples]
    step, steps = 0, EPOCHS * len(examples)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(examples)):
            rows, _, y = examples[i]
            rate = np.float32(1 - step / steps)
            step += 1
            by_rows, by_layer, by_bias = gradient(table, layer, bias, rows, shares[i], y)
            layer -= RATE * rate * by_layer
            bias -= BIAS_RATE * rate * by_bias
            table[rows] -= TABLE_RATE * rate * by_rows
    return Model(table @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]))


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out_rows, out_counts = [], []
        for text in batch.column("text").to_pylist():
            count = np.zeros(1 << TABLE_BITS, np.int64)
            for _, some, skip in grouped([text], GROUP, 1 << NEAR):
                for rows, _ in rows_of(some, skip):
                    count += np.bincount(rows, minlength=1 << TABLE_BITS)
            rows = np.flatnonzero(count)
            out_rows.append(rows.astype(np.uint32).tobytes())
            out_counts.append(count[rows].astype(np.float32).tobytes())
        yield pa.record_batch([batch.column("h"), batch.column("y"), pa.array(out_rows, pa.binary()), pa.array(out_counts, pa.binary())], ["h", "y", "rows", "counts"])


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    got = sorted((r["h"], r["y"], r["rows"], r["counts"]) for batch in batches for r in batch.to_pylist())
    model = train([(np.frombuffer(rows, np.uint32), np.frombuffer(counts, np.float32), int(y > 0)) for _, y, rows, counts in got])
    yield pa.record_batch([pa.array([model.weight.astype(np.float32).tobytes()], pa.binary()), pa.array([model.bias])], ["weight", "bias"])


def fit(docs: DataFrame, labels: DataFrame, learn, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    """Learned from ``sample`` labelled rows at most, for which the condition ``learn`` on the id holds."""
    y = labels.where(learn & F.col(label_col).isNotNull()).select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("y"))
    h = F.md5(F.coalesce(F.col("__id").cast("string"), F.lit("")).cast("binary"))
    picked = y.withColumn("h", h).orderBy("h", "y").limit(sample)  # ids and labels only; at most ``sample`` rows
    rows = docs.select(F.col(id_col).alias("__doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).join(F.broadcast(picked), F.col("__doc") == F.col("__id"))
    rows = rows.groupBy("__id", "h", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("h", "y", "text")
    found = rows.mapInArrow(_examples, "h string, y int, rows binary, counts binary")
    got = found.repartition(1).mapInArrow(_learn, "weight binary, bias double").collect()
    return Model(np.frombuffer(got[0].weight, np.float32), got[0].bias) if got else train([])


def _score(shared, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [n for n in batch.schema.names if n != text_col]
            yield pa.record_batch([*(batch.column(n) for n in names), pa.array(shared.value.scores(batch.column(text_col).to_pylist()))], [*names, "score"])

    return run


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with the score (0 to 1) in place of the text."""
    docs = common.without(docs, "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number for each row of the table
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text_col), "score double"])
    return docs.mapInArrow(_score(shared, text_col), schema)


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def op2_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Quality score of every text of ``documents``, learned from labels outside the held-out fold."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, common.table(spark, sf_dir, "labels"), ~held_out())
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


QUERIES = {"op2_quality_classifier": op2_quality_classifier}
