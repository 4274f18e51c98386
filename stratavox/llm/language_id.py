"""Language identification of mixed text: script ranges narrow the candidates, Viterbi with a switching penalty labels spans.

Every word gets one score a language, the log-likelihood of its letters' bigrams and trigrams under hashed models that are
learned from a bounded sample of labelled texts. A word's script, looked up by code-point ranges, admits only languages
that are written in it in the sample; the others are not scored and cannot be chosen (all are, for a script that no language
is written in). A gram that a language's sample lacks costs the same in every language, however small its sample. A Viterbi pass over the words, where changing the language costs a fixed penalty,
gives the best labelling; runs of equal labels are the spans. The pass runs over all texts of a batch at once, word by word.

A text's language is the one with most letters. Its score is the product of three shares: of the letters that have this
language; of the probability, among all languages, that the words so labelled have it; and of the trigrams at the text's words that
the sample of their language has too. Text in no known language has few of these.

Nulls: a null or letterless text is ``und`` with score 0 and no spans; rows with a null language are not learned from.
Ties go to the language that sorts first. Without any labelled text everything is ``und``. Repeated rows each get a row,
and count once in the sample. There may be any number of languages. An empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratavox.llm import blocks, common
from stratavox.llm.subwords import pieces

#: Distinct texts learned from for each language at most: those with the least hash of id and text.
SAMPLE = 400
#: Parts in which each language's hashes are ranked before they are ranked together.
SALTS = 16
#: log2 of the hashed gram tables, share of unseen grams, cost of a change of language.
TABLE_BITS, UNSEEN, SWITCH = 16, 0.01, 8.0
#: What stands for the score of a language that the script excludes: no sum of scores within a text outweighs it.
EXCLUDED = -1e9
#: Share of a language's words in a script from which the script admits it.
ADMIT = 0.1
#: Characters scored together.
GROUP = 2 << 20

#: First code point, last code point and name of script ranges (Unicode blocks).
SCRIPT_RANGES = (
    (0x0041, 0x024F, "Latin"),
    (0x0250, 0x02AF, "Latin"),
    (0x0370, 0x03FF, "Greek"),
    (0x0400, 0x052F, "Cyrillic"),
    (0x0530, 0x058F, "Armenian"),
    (0x0590, 0x05FF, "Hebrew"),
    (0x0600, 0x077F, "Arabic"),
    (0x0900, 0x097F, "Devanagari"),
    (0x0980, 0x09FF, "Bengali"),
    (0x0A00, 0x0A7F, "Gurmukhi"),
    (0x0A80, 0x0AFF, "Gujarati"),
    (0x0B80, 0x0BFF, "Tamil"),
    (0x0C00, 0x0C7F, "Telugu"),
    (0x0C80, 0x0CFF, "Kannada"),
    (0x0D00, 0x0D7F, "Malayalam"),
    (0x0E00, 0x0E7F, "Thai"),
    (0x10A0, 0x10FF, "Georgian"),
    (0x1100, 0x11FF, "Hangul"),
    (0x1200, 0x137F, "Ethiopic"),
    (0x1E00, 0x1EFF, "Latin"),
    (0x1F00, 0x1FFF, "Greek"),
    (0x3040, 0x30FF, "Kana"),
    (0x3400, 0x4DBF, "Han"),
    (0x4E00, 0x9FFF, "Han"),
    (0xAC00, 0xD7AF, "Hangul"),
    (0xF900, 0xFAFF, "Han"),
)
SCRIPTS = ("Other", *sorted({s for _, _, s in SCRIPT_RANGES}))


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the basic plane: kind (0 none, 1 mark, 2 letter), lower case, script."""
    kind, lower, script = np.zeros(1 << 16, np.uint8), np.arange(1 << 16, dtype=np.uint32), np.zeros(1 << 16, np.uint8)
    for i in range(1 << 16):
        c = chr(i)
        kind[i] = 2 if c.isalpha() else unicodedata.category(c)[0] == "M"
        if kind[i] == 2 and len(low := c.lower()) == 1:
            lower[i] = ord(low)
    for a, b, name in SCRIPT_RANGES:
        script[a : b + 1] = SCRIPTS.index(name)
    return kind, lower, script


class Words:
    """The words (runs of letters and marks) of some texts, with what scoring needs."""

    def __init__(self, texts: list[str | None]):
        lengths = np.array([len(t) if t else 0 for t in texts], np.int64)
        joined = "\n".join(t or "" for t in texts) + "\n"
        cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.text_start = np.concatenate([[0], np.cumsum(lengths + 1)])
        kind, lower, script = _tables()
        low16 = np.minimum(cp, 0xFFFF)
        k = kind[low16]
        wide = np.flatnonzero(cp > 0xFFFF)
        if len(wide):
            k = k.copy()
            values, inverse = np.unique(cp[wide], return_inverse=True)
            k[wide] = np.array([2 if chr(v).isalpha() else unicodedata.category(chr(v))[0] == "M" for v in values], np.uint8)[inverse]
        inside = k > 0
        edge = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
        self.start, self.stop = edge[::2], edge[1::2]
        letters = np.concatenate([[0], np.cumsum(k == 2)])
        self.letters = letters[self.stop] - letters[self.start]
        ok = self.letters > 0
        self.start, self.stop, self.letters = self.start[ok], self.stop[ok], self.letters[ok]
        self.doc = np.searchsorted(self.text_start, self.start, "right") - 1
        self.script = np.where(cp[self.start] > 0xFFFF, 0, script[low16[self.start]])
        c = np.where(cp > 0xFFFF, cp, lower[low16])
        self.c = np.where(inside, c, 0).astype(np.uint32)

    def grams(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the trigram around, and the bigram from, each character in [a, b)."""
        shift = np.uint32(32 - TABLE_BITS)
        c = np.concatenate([self.c[a - 1 : a] if a else np.zeros(1, np.uint32), self.c[a : b + 1], np.zeros(max(0, b + 1 - len(self.c)), np.uint32)])
        two = c[1:-1] * np.uint32(0x9E3779B1) ^ (c[2:] * np.uint32(0x85EBCA6B) + np.uint32(0x27D4EB2F))
        three = two * np.uint32(0xC2B2AE35) ^ (c[:-2] * np.uint32(0x165667B1))
        three ^= three >> np.uint32(15)
        return (three * np.uint32(0x9E3779B1)) >> shift, (two * np.uint32(0x85EBCA77)) >> shift


class Model:
    """Log-likelihood tables of hashed grams by language, and which languages each script admits.

    Counts are held sparse, (places, counts) for each language; the tables are made where they are first needed.
    """

    def __init__(self, langs: list[str], three: list, two: list, scripts: np.ndarray):
        self.langs, self.counts, self.scripts, self.ready = langs, (three, two), scripts, False

    def __getstate__(self):
        return {"langs": self.langs, "counts": self.counts, "scripts": self.scripts, "ready": False}

    def tables(self) -> None:
        if self.ready:
            return
        size = 1 << TABLE_BITS

        def logs(counts):
            out = np.empty((size, len(counts)), np.float32)
            for k, (at, n) in enumerate(counts):
                out[:, k] = np.log(UNSEEN / size)
                out[at, k] = np.log((1 - UNSEEN) * n / max(1.0, float(n.sum())) + UNSEEN / size)
            return out

        self.three, self.two = (logs(c) for c in self.counts)
        self.seen = np.zeros((size, len(self.langs)), bool)
        for k, (at, _) in enumerate(self.counts[0]):
            self.seen[at, k] = True
        share = self.scripts / np.maximum(1, self.scripts.sum(axis=1, keepdims=True))
        admitted = (share >= ADMIT).T
        admitted[~admitted.any(axis=1)] = True
        self.sets, of = np.unique(admitted, axis=0, return_inverse=True)
        self.set_of = of.reshape(-1)  # scripts that admit the same languages are scored together
        self.ready = True

    def known(self, w: Words, tag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(trigrams of each word that its language ``tag`` has, all its trigrams)."""
        out = np.zeros(len(w.start))
        i, step = 0, 1 << 20
        while i < len(w.start):
            a = int(w.start[i])
            j = max(i + 1, int(np.searchsorted(w.stop, a + step, "right")))
            b = int(w.stop[j - 1])
            three, _ = w.grams(a, b)
            word = np.repeat(np.arange(i, j), w.stop[i:j] - w.start[i:j])
            at = np.arange(len(word)) + np.repeat(w.start[i:j] - a - np.concatenate([[0], np.cumsum(w.stop[i:j] - w.start[i:j])[:-1]]), w.stop[i:j] - w.start[i:j])
            out[i:j] = np.bincount(word - i, weights=self.seen[three[at], tag[word]], minlength=j - i)
            i = j
        return out, w.stop - w.start

    def scores(self, w: Words) -> np.ndarray:
        """(words, languages): only those that the word's script admits are scored."""
        out = np.full((len(w.start), len(self.langs)), EXCLUDED, np.float32)
        i, step = 0, max(1 << 14, (1 << 20) // max(1, len(self.langs)))
        while i < len(w.start):
            a = int(w.start[i])
            j = max(i + 1, int(np.searchsorted(w.stop, a + step, "right")))
            b = int(w.stop[j - 1])
            three, two = w.grams(a, b)
            bounds = np.stack([w.start[i:j] - a, w.stop[i:j] - a], 1).ravel()
            which = self.set_of[w.script[i:j]]
            for k in np.flatnonzero(np.bincount(which)):
                langs = np.flatnonzero(self.sets[k])
                whole = len(langs) == len(self.langs)
                value = self.three[three] if whole else self.three[np.ix_(three, langs)]
                value += self.two[two] if whole else self.two[np.ix_(two, langs)]
                sums = np.add.reduceat(np.concatenate([value, np.zeros((1, value.shape[1]), np.float32)]), bounds, axis=0)[::2]
                mine = np.flatnonzero(which == k)
                if whole and len(mine) == j - i:
                    out[i:j] = sums
                else:
                    out[np.ix_(i + mine, langs)] = sums[mine]
            i = j
        return out


def viterbi(scores: np.ndarray, doc: np.ndarray, n_docs: int, switch: float = SWITCH) -> np.ndarray:
    """Best label of each word: the scores add up along a text, and each change of label costs ``switch``."""
    count = np.bincount(doc, minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    order = np.argsort(-count, kind="stable")
    count, first = count[order], first[order]
    active = len(count) - np.searchsorted(count[::-1], np.arange(int(count[0]) if len(count) else 0), "right")
    n_lang = scores.shape[1]
    kind = np.uint8 if n_lang <= 256 else np.uint32
    from_ = np.empty(scores.shape, kind)
    own = np.arange(n_lang, dtype=kind)
    best = np.zeros((len(count), n_lang), np.float32)
    for t, k in enumerate(active):
        at = first[:k] + t
        prev = best[:k]
        top = prev.max(axis=1, keepdims=True) - np.float32(switch)
        stay = prev >= top
        from_[at] = np.where(stay, own, prev.argmax(axis=1).astype(kind)[:, None])
        best[:k] = np.maximum(prev, top) + scores[at]
        if t % 64 == 63:  # only differences matter, and so they stay exact in long texts
            best[:k] -= best[:k].max(axis=1, keepdims=True)
    label = np.empty(len(scores), kind)
    now = best.argmax(axis=1).astype(kind)
    for t in range(len(active) - 1, -1, -1):
        at = first[: active[t]] + t
        label[at] = now[: active[t]]
        now[: active[t]] = from_[at, now[: active[t]]]
    return label


_OUT = "lang_pred string, score double, spans array<struct<start:int,stop:int,lang:string>>"
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("lang", pa.string())]))


def label(texts: list[str | None], model: Model | None) -> tuple[list[str], np.ndarray, pa.Array]:
    """Language, score and spans (in code points) of each text."""
    n = len(texts)
    if model is None:
        return ["und"] * n, np.zeros(n), pa.array([[]] * n, _SPAN)
    model.tables()
    w = Words(texts)
    scores = model.scores(w)
    tag = viterbi(scores, w.doc, n).astype(np.int64)
    n_lang = len(model.langs)
    letters = np.bincount(w.doc * n_lang + tag, weights=w.letters, minlength=n * n_lang).reshape(n, n_lang)
    pred, total = letters.argmax(axis=1), letters.sum(axis=1)
    share = letters.max(axis=1) / np.maximum(1, total)
    bounds = np.searchsorted(w.doc, np.arange(n + 1))
    sums = blocks.segment_sum(np.where((tag == pred[w.doc])[:, None], scores, 0), bounds)
    post = np.exp(sums - sums.max(axis=1, keepdims=True))
    sure = post[np.arange(n), pred] / post.sum(axis=1)
    has, of = model.known(w, tag)
    fit = np.bincount(w.doc, weights=has, minlength=n) / np.maximum(1, np.bincount(w.doc, weights=of, minlength=n))
    names = np.array(model.langs, object)
    langs = np.where(total > 0, names[pred], "und").tolist()
    new = np.concatenate([[True], (tag[1:] != tag[:-1]) | (w.doc[1:] != w.doc[:-1])])[: len(tag)]
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(tag)) - 1 if len(begin) else begin
    base = w.text_start[w.doc[begin]]
    spans = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(w.doc[begin], np.arange(n + 1)), pa.int32()),
        pa.StructArray.from_arrays([pa.array(w.start[begin] - base, pa.int32()), pa.array(w.stop[end] - base, pa.int32()), pa.array(names[tag[begin]].tolist(), pa.string())], ["start", "stop", "lang"]),
    )
    return langs, np.where(total > 0, share * sure * fit, 0.0), spans


def _least(sample: int):
    """The ``sample`` least distinct hashes of each language in a task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, np.ndarray] = {}
        for batch in batches:
            code = batch.column("lang").dictionary_encode()
            which, h = code.indices.to_numpy(), batch.column("h").to_numpy()
            for k, lang in enumerate(code.dictionary.to_pylist()):
                kept[lang] = np.unique(np.concatenate([kept.get(lang, h[:0]), h[which == k]]))[:sample]
        if kept:
            yield pa.record_batch([pa.array(np.repeat(np.array(list(kept), object), [len(v) for v in kept.values()]).tolist(), pa.string()), pa.array(np.concatenate(list(kept.values())))], ["lang", "h"])

    return run


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, list[np.ndarray]] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            have = total.setdefault(lang, [np.zeros(1 << TABLE_BITS, np.int64), np.zeros(1 << TABLE_BITS, np.int64), np.zeros(len(SCRIPTS), np.int64)])
            for piece, _ in pieces(text, GROUP, 0):
                w = Words([piece])
                inside = w.c > 0
                for table, places in zip(have, w.grams(0, len(w.c))):
                    at, n = np.unique(places[inside], return_counts=True)
                    table[at] += n
                have[2] += np.bincount(w.script, minlength=len(SCRIPTS))
    for lang, have in total.items():
        at = [np.flatnonzero(x) for x in have[:2]]
        blobs = [at[0].astype(np.uint32), have[0][at[0]], at[1].astype(np.uint32), have[1][at[1]], have[2]]
        yield pa.record_batch([pa.array([lang]), *(pa.array([x.tobytes()], pa.binary()) for x in blobs)], ["lang", "at3", "n3", "at2", "n2", "scripts"])


def fit(docs: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model | None:
    """A model of the languages in ``docs`` where the condition ``learn`` holds, from ``sample`` distinct texts a language at most."""
    rows = docs.where(learn & F.col(lang_col).isNotNull() & (F.length(text_col) > 0))
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).withColumn("h", F.xxhash64("lang", "text"))
    # each task sends the least hashes of each language, these are ranked, and texts come after: they never move to be ranked
    least = rows.select("lang", "h").mapInArrow(_least(sample), "lang string, h long").distinct()
    nth = lambda *by: F.row_number().over(Window.partitionBy("lang", *by).orderBy("h"))
    least = least.withColumn("salt", F.pmod(F.hash("h"), F.lit(SALTS))).withColumn("nth", nth("salt")).where(F.col("nth") <= sample)
    least = least.withColumn("nth", nth()).where(F.col("nth") <= sample)
    limit = least.groupBy("lang").agg(F.max("h").alias("limit")).select(F.col("lang").alias("__lang"), "limit")  # a row a language
    picked = rows.join(F.broadcast(limit), (F.col("lang") == F.col("__lang")) & (F.col("h") <= F.col("limit")))
    picked = picked.groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "text")
    got = picked.repartition(common.partitions(docs.sparkSession), "lang").mapInArrow(_counts, "lang string, at3 binary, n3 binary, at2 binary, n2 binary, scripts binary")
    got = sorted(got.collect(), key=lambda r: r.lang)  # sparse counts, a row a language
    if not got:
        return None
    pair = lambda r, k: (np.frombuffer(r[f"at{k}"], np.uint32), np.frombuffer(r[f"n{k}"], np.int64))
    return Model([r.lang for r in got], [pair(r, 3) for r in got], [pair(r, 2) for r in got], np.stack([np.frombuffer(r.scripts, np.int64) for r in got]))


def _label(model, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            offsets, _ = blocks.column_bytes(batch.column(text_col))
            for i, j in blocks.doc_groups(offsets, max(1 << 16, GROUP // max(1, len(m.langs) // 8 if m else 1))):
                part = batch.slice(i, j - i)
                langs, score, spans = label(part.column(text_col).to_pylist(), m)
                yield pa.record_batch([*part.columns, pa.array(langs), pa.array(score), spans], [*part.schema.names, "lang_pred", "score", "spans"])

    return run


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and the labelled spans; the text itself is carried on only if asked for."""
    docs = common.without(docs, "lang_pred", "score", "spans")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # sparse counts of a bounded sample for each language
    out = docs.mapInArrow(_label(shared, text_col), ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), _OUT]))
    return out if keep_text else out.drop(text_col)


def held_out(id_col: str = "doc_id", folds: int = 5, fold: int = 0):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of every text of ``documents``, learned from those outside the held-out fold."""
    docs = common.table(spark, sf_dir, "documents")
    model = fit(docs, ~held_out())
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


QUERIES = {"op3_language_id": op3_language_id}
