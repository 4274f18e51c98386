"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters with a budget of k edits is cut into k + 1 pieces: where the item stands with at most k edits,
at least one piece stands unchanged. An Aho-Corasick automaton over all pieces finds these in one pass over each text; a
hit gives the place where the whole item should stand, and Myers' bit-parallel edit distance decides there. Texts and items
are compared in lower case with blanks as single spaces.

The items are the query set: they are taken in blocks of bounded size, each sent to all tasks, and each block sees all
texts. With several blocks, each is done, stored and let go before the next is sent, so one block is held at a time.
Nothing is dropped: every hit of every piece is verified, however short the item. An item whose budget is 0 (under 15
characters at the usual rate) is one piece and matches where it stands unchanged.

Nulls: a null text is empty; a null item, or one of blanks only, says nothing and stands nowhere. A null doc_id is returned
as null. Repeated rows each get their matches; repeated items are items of their own. Ties: of equally near places of an
item the first counts. Without documents or items there are no matches. Texts of any length are searched whole. ``clean``
decides on each row by its own text, never by its id, and keeps all columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavox.llm import common

#: Edits allowed for each character of an item, and characters of a block of items.
ERROR_RATE, BLOCK_CHARS = 0.07, 1 << 20
#: Places and windows of a text remembered as already verified; beyond that they are forgotten and verified again.
MEMO = 1 << 14


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """(offset, piece) of budget + 1 pieces of nearly equal length that make up the item."""
    n = len(item)
    cuts = [n * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """(least edit distance of the pattern to any substring of the text, end of the first such)."""
    m = len(pattern)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & full
        pv = (mh << 1 & full) | (full & ~(xv | ph))
        mv = ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = [(i, t, int(len(t) * rate)) for i, t in items]
        where: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text, budget) in enumerate(self.items):
            for offset, piece in pieces(text, budget):
                where.setdefault(piece, []).append((n, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, at in where.items():
            self.automaton.add_word(piece, (len(piece), at))
        self.automaton.make_automaton()

    def matches(self, raw: str | None) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, budget, end in the normal text) of the items that stand in a text, the nearest place of each."""
        text = normal(raw)
        tried: set[tuple[int, int]] = set()
        seen: dict[tuple[int, str], tuple[int, int]] = {}
        best: dict[int, tuple[int, int]] = {}
        for last, (size, at) in self.automaton.iter(text):
            for n, offset in at:
                _, item, budget = self.items[n]
                start = last + 1 - size - offset
                if (n, start) in tried:
                    continue
                if len(tried) >= MEMO:
                    tried.clear()
                tried.add((n, start))
                a = max(0, start - budget)
                window = text[a : max(0, start + len(item) + budget)]
                if len(window) < len(item) - budget:
                    continue
                if (n, window) not in seen:
                    found = window.find(item)
                    if len(seen) >= MEMO:
                        seen.clear()
                    seen[n, window] = (0, found + len(item)) if found >= 0 else myers(item, window)
                distance, end = seen[n, window]
                if distance <= budget:
                    best[n] = min(best.get(n, (distance, a + end)), (distance, a + end))
        return [(self.items[n][0], d, self.items[n][2], end) for n, (d, end) in sorted(best.items())]


_SCHEMA = "doc_id long, item_id long, distance int, budget int, end int"


def _match(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, rate = shared.value
        matcher = Matcher(items, rate)
        for batch in batches:
            rows = [(d, *m) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()) for m in matcher.matches(t)]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.record_batch([pa.array([r[k] for r in rows], kinds[k]) for k in range(5)], ["doc_id", "item_id", "distance", "budget", "end"])

    return run


def item_blocks(items: DataFrame, id_col: str, text_col: str, chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items that say something, in lists of at most ``chars`` characters (or one item)."""
    block, size = [], 0
    for r in items.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).cast("string").alias("t")).toLocalIterator():
        text = normal(r.t)
        if not text:
            continue
        if block and size + len(text) > chars:
            yield block
            block, size = [], 0
        block.append((r.i, text))
        size += len(text)
    if block:
        yield block


def _each_block(start: DataFrame, items: DataFrame, id_col: str, text_col: str, rate: float, chars: int, step) -> DataFrame:
    """``step(frame, shared block)`` for one block after the other; all but the last are stored and their block let go."""
    out, shared = start, None
    for block in item_blocks(items, id_col, text_col, chars):
        if shared is not None:
            out = common.checkpointed(out)
            shared.unpersist()
        shared = start.sparkSession.sparkContext.broadcast((block, rate))  # BLOCK_CHARS characters, or one item
        out = step(out, shared)
    return out


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, distance, budget, end): each item that stands in a text within its budget of edits."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    none = docs.sparkSession.createDataFrame([], _SCHEMA)
    return _each_block(none, items, item_id_col, item_text_col, rate, block_chars, lambda out, shared: out.unionByName(rows.mapInArrow(_match(shared), _SCHEMA)))


def _without(shared, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(*shared.value)
        for batch in batches:
            yield batch.filter(pa.array([not matcher.matches(t) for t in batch.column(text_col).to_pylist()], pa.bool_()))

    return run


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs``, all columns, without the rows in whose text an item stands."""
    return _each_block(docs, items, item_id_col, item_text_col, rate, block_chars, lambda out, shared: out.mapInArrow(_without(shared, text_col), docs.schema))


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every item of ``benchmark`` that stands in a text of ``documents`` within its budget of edits."""
    return matches(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


QUERIES = {"op9_decontamination": op9_decontamination}
