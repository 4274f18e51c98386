"""Personal data by bootstrapping: seed entities induce lexical patterns, patterns and instances score each other, and patterns
of high confidence find identifiers that the seeds' expressions do not match.

Seeds are spans of four kinds with checks of their own (``base_spans``). Everything else that looks like an identifier (a word
with a digit or an @, digit groups, an address with "(at)") is a candidate, of no kind so far. The words before a mention, and
around it, are its lexical patterns; letters in lower case, numbers as 0, at least one word among them. Mentions give a
bipartite graph of patterns and instances, one edge for each pair, over all documents. Then, ``ROUNDS`` times in Spark:

    confidence of a pattern for a kind = sum of its instances' scores / (number of its instances + 1)
    score of an instance for a kind    = mean confidence of its patterns; seeds keep 1 for their kind

in millionths, rounded down, so sums are exact and reruns agree. Candidates count as non-members until they score, so a
pattern that stands before anything at all stays low. A mention is added if one of its patterns reaches ``ACCEPT`` for a kind
whose form it has; the best (pattern, then the first kind) wins. With the 1 below the line no pattern is accepted that has less than nine instances' worth of score.

The graph is joined on edges that are distinct beforehand and summed partially; Spark splits keys that many edges share.
Nothing is collected, and accepted patterns are broadcast only where Spark finds them small.

Nulls: a null text is empty; null ids stay null. Rows with one id are told apart and give a row each; of a repeated text the
graph sees each edge once. Ties: base matches are leftmost for each kind and may overlap between kinds; added spans overlap no
base span. Empty texts have no spans, an empty table no rows; texts may be of any length; extra columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import operator
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavox.llm import common

KINDS = ("email", "ip", "card", "phone")
#: One, in the unit of scores; confidence from which a pattern adds mentions; rounds of scoring.
ONE, ACCEPT, ROUNDS = 1_000_000, 900_000, 3
#: Characters before and after a mention in which pattern words are looked for, and longest word or instance told in full.
REACH, LONGEST = 96, 48

#: The forms of the base kinds. Possessive runs and what may not stand before a match keep them linear.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

_WORDLIKE = re.compile(r"(?<![A-Za-z0-9._%+@/()\[\]-])[A-Za-z._%+/()\[\]-]*+[0-9@][A-Za-z0-9._%+@/()\[\]-]*+")
_NUMERIC = re.compile(r"[0-9().+/-]+")
_AT = re.compile(r"[\[({]at[\])}]", re.I)
_AFTER_AT = re.compile(r" ?[A-Za-z0-9-]++(?: ?(?:\.|[\[({]dot[\])}]) ?[A-Za-z0-9-]++)+", re.I)
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = (ord(d) - 48) << (i & 1)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local@domain: what stands before each @, back to the end of the match before."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            out.append((start, done))
        else:
            # what has been looked at holds no match, but a later @ begins after it anyway
            done = max(done, start)
        at = text.find("@", max(at + 1, done))
    return out


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, ordered: leftmost non-overlapping matches of each kind that pass its check."""
    out = [(0, a, b) for a, b in _emails(text)]
    small = lambda part: len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(map(small, m[0].split(".")))]
    out += [(2, m.start(), m.end()) for m in _CARD.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans that look like identifiers and overlap no span of ``taken``, ordered."""
    found: list[list[int]] = []
    for m in _WORDLIKE.finditer(text):
        a, b = m.span()
        while a < b and not (text[a].isalnum() or text[a] in "+("):
            a += 1
        while b > a and not (text[b - 1].isalnum() or text[b - 1] in ")]"):
            b -= 1
        if a == b:
            continue
        if found and a == found[-1][1] + 1 and text[a - 1] == " " and _NUMERIC.fullmatch(text, a, b) and _NUMERIC.fullmatch(text, found[-1][2], found[-1][1]):
            found[-1][1:] = [b, a]  # digit groups with a blank between
        else:
            found.append([a, b, a])
    spans = [(a, b) for a, b, _ in found]
    for m in _AT.finditer(text):
        a = m.start() - (text[m.start() - 1 : m.start()] == " ")
        b = a
        while a > 0 and text[a - 1] in LOCAL:
            a -= 1
        tail = _AFTER_AT.match(text, m.end())
        if a < b and tail:
            spans.append((a, tail.end()))
    out, done, i = [], 0, 0
    taken = sorted((a, b) for _, a, b in taken)
    for a, b in sorted(spans, key=lambda s: (s[0], -s[1])):
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        # the first that ends later overlaps, or all that come after begin later still
        if a >= done and not (i < len(taken) and taken[i][0] < b):
            out.append((a, b))
            done = b
    return out


def forms(mention: str) -> int:
    """Bits of the kinds whose form a mention may have."""
    digits, letters = len(_digits(mention)), any(c.isalpha() for c in mention)
    email = letters and len(mention) >= 6 and ("@" in mention or bool(_AT.search(mention)))
    ip = not letters and digits >= 4 and mention.count(".") >= 2
    card, phone = not letters and digits >= 8, not letters and 5 <= digits <= 15
    return email | ip << 1 | card << 2 | phone << 3


def _short(word: str) -> str:
    return word if len(word) <= LONGEST else f"{word[:8]}~{hashlib.md5(word.encode('utf-8', 'surrogatepass')).hexdigest()}"


def _tokens(text: str) -> list[str]:
    return ["0" if t[0].isdigit() else _short(t) for t in _TOKEN.findall(text)]


def patterns(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns of a mention: three and two words before it, two before and one after."""
    before = _tokens(text[max(0, start - REACH) : start].lower())
    before = ["^", "^", "^", *before][-3:]
    after = (_tokens(text[end : end + REACH].lower()) or ["$"])[0]
    left = {n: " ".join(before[-n:]) for n in (2, 3)}
    worded = lambda n: any(t[0].isalpha() for t in before[-n:])
    return [f"{left[n]} _" for n in (3, 2) if worded(n)] + ([f"{left[2]} _ {after}"] if worded(2) else [])


_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
_MENTION = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("seed", pa.int32()), ("forms", pa.int32()), ("instance", pa.string()), ("patterns", pa.list_(pa.string()))])
_FOUND = "doc_id bigint, base array<struct<kind:int,start:int,end:int>>, mentions array<struct<start:int,end:int,seed:int,forms:int,instance:string,patterns:array<string>>>"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            base, mentions = [], []
            for value in part.column("text"):
                text = value.as_py() or ""
                spans = base_spans(text)
                every = [(a, b, k, 0) for k, a, b in spans] + [(a, b, -1, forms(text[a:b])) for a, b in candidates(text, spans)]
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                mentions.append([{"start": a, "end": b, "seed": k, "forms": f, "instance": _short(text[a:b].lower()), "patterns": patterns(text, a, b)} for a, b, k, f in every])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(base, pa.list_(_SPAN)), pa.array(mentions, pa.list_(_MENTION))], ["doc_id", "base", "mentions"])


def mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, doc_id, base, mentions) of each row, written to the shared folder once; rid is the row's own number."""
    spark = docs.sparkSession
    path = common.shared_dir(spark, "mentions")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows.mapInArrow(_find, _FOUND).withColumn("rid", F.monotonically_increasing_id()).write.parquet(path)
    return spark.read.parquet(path)


def _per_kind(make) -> list[Column]:
    return [make(k).alias(f"s{k}") for k in range(len(KINDS))]


def edges(found: DataFrame) -> DataFrame:
    """(pattern, instance, s0..s3): every pair that occurs, with the kinds of which the instance is a seed."""
    each = found.select(F.explode("mentions").alias("m")).select("m.instance", "m.seed", F.explode("m.patterns").alias("pattern"))
    return each.groupBy("pattern", "instance").agg(*_per_kind(lambda k: F.max(F.when(F.col("seed") == k, ONE).otherwise(0)).cast("bigint")))


def score(graph: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, s0..s3) after so many rounds: a pattern's confidence for each kind."""
    seeds = graph.groupBy("instance").agg(*_per_kind(lambda k: F.max(f"s{k}")))
    instances = seeds
    for r in range(rounds):
        both = graph.select("pattern", "instance").join(instances, "instance")
        by_pattern = both.groupBy("pattern").agg(F.count("*").alias("n"), *_per_kind(lambda k: F.sum(f"s{k}")))
        scored = by_pattern.select("pattern", *_per_kind(lambda k: F.expr(f"s{k} div (n + 1)")))
        if r + 1 == rounds:
            return scored
        means = graph.select("pattern", "instance").join(scored, "pattern").groupBy("instance").agg(F.count("*").alias("n"), *_per_kind(lambda k: F.sum(f"s{k}")))
        means = means.select("instance", *(F.expr(f"s{k} div n").alias(f"m{k}") for k in range(len(KINDS))))
        seeded = functools.reduce(operator.or_, (F.col(f"s{k}") > 0 for k in range(len(KINDS))))
        moved = seeds.join(means, "instance").select("instance", *_per_kind(lambda k: F.when(seeded, F.col(f"s{k}")).otherwise(F.col(f"m{k}"))))
        instances = common.checkpointed(moved)
    return seeds.limit(0)


def discovered(found: DataFrame, scored: DataFrame, accept: int = ACCEPT) -> DataFrame:
    """(rid, kind, start, end, confidence, pattern) of the mentions that accepted patterns add."""
    good = scored.where(F.greatest(*(F.col(f"s{k}") for k in range(len(KINDS)))) >= accept)
    unknown = found.select("rid", F.explode(F.filter("mentions", lambda m: (m["seed"] < 0) & (m["forms"] > 0))).alias("m")).select("rid", "m.start", "m.end", "m.forms", F.explode("m.patterns").alias("pattern"))
    kind = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(f"s{k}").alias("confidence")) for k in range(len(KINDS))))).alias("z")
    hits = unknown.join(good, "pattern").select("rid", "start", "end", "forms", "pattern", kind)
    hits = hits.where((F.col("z.confidence") >= accept) & F.expr("(forms & shiftleft(1, z.kind)) != 0"))
    best = F.max(F.struct(F.col("z.confidence").alias("confidence"), (-F.col("z.kind")).alias("kind"), "pattern")).alias("best")
    return hits.groupBy("rid", "start", "end").agg(best).select("rid", (-F.col("best.kind")).alias("kind"), "start", "end", "best.confidence", "best.pattern")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, accept: int = ACCEPT) -> DataFrame:
    """(doc_id, base, spans) of every row: base spans, and all spans with those found by patterns; each (kind, start, end), ordered."""
    found = mentions(docs, id_col, text_col)
    graph = common.checkpointed(edges(found))
    more = discovered(found, score(graph, rounds), accept)
    added = more.groupBy("rid").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    rows = found.select("rid", "doc_id", "base").join(added, "rid", "left")
    every = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.concat("base", "added"))
    return rows.select("doc_id", F.sort_array("base").alias("base"), F.sort_array(every).alias("spans"))


def _written(column: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def op13_personal_data(spark, sf_dir: str) -> DataFrame:
    """Personal data in all ``documents``: counts and a hash of the base spans, and all spans."""
    found = find(common.table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{KINDS[k]}")
    return found.select("doc_id", *(count(k) for k in range(len(KINDS))), F.sha2(_written("base"), 256).alias("base_sha256"), _written("spans").alias("spans"))


QUERIES = {"op13_personal_data": op13_personal_data}
