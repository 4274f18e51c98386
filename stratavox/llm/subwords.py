"""Word and subword features of whole texts as hashes, computed over byte arrays of many texts at once."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

from stratavox.llm import blocks

#: A-Z lower-cased, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Blanks; and bytes of words of letters (ASCII letters and all bytes of multi-byte characters).
BLANK = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))
LETTER = (np.arange(256) >= 128) | ((LOWER >= 97) & (LOWER <= 122))


_EDGE = re.compile(r"[\x20\x09-\x0D]")


class Text:
    """Lower-cased bytes of some texts, one after the other with a blank after each, and their words."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, letters_only: bool = False):
        n = len(offsets) - 1
        length = np.diff(offsets)
        self.start = offsets[:-1] + np.arange(n)
        self.stop = self.start + length
        self.bytes = np.full(len(data) + n, 32, np.uint8)
        keep = np.ones(len(self.bytes), bool)
        keep[self.stop] = False
        self.bytes[keep] = LOWER[data]
        inside = LETTER[self.bytes] if letters_only else ~BLANK[self.bytes]
        edge = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
        self.word_start, self.word_stop = edge[::2], edge[1::2]
        self.prefix = blocks.prefix_hash(self.bytes)
        self.doc = np.searchsorted(self.start, self.word_start, "right") - 1
        self.n = n

    def words(self) -> np.ndarray:
        return blocks.span_hash(self.prefix, self.word_start, self.word_stop)

    def heads(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, doc) of the first ``size`` bytes of the words that are longer."""
        ok = np.flatnonzero(self.word_stop - self.word_start > size)
        s = self.word_start[ok]
        return blocks.span_hash(self.prefix, s, s + size) ^ np.uint64(0x51ED270B35A1F3C9), self.doc[ok]

    def grams(self, size: int) -> np.ndarray:
        """32-bit hashes of the ``size`` bytes from each place of ``bytes``; the last ones wrap into padding."""
        b = np.concatenate([self.bytes, np.zeros(size, np.uint8)]).astype(np.uint32)
        n = len(self.bytes)
        h = np.full(n, 2166136261 + size, np.uint32)
        for k in range(size):
            h = (h ^ b[k : k + n]) * np.uint32(16777619)
            h ^= h >> np.uint32(13)
        return h * np.uint32(0x9E3779B1)


def pieces(text: str, most: int, back: int) -> list[tuple[str, int]]:
    """(piece, characters of it that the piece before has already) of a long text, cut at blanks.

    Each piece begins with the last ``back`` words of what is before it, so that what a word owes to words close before it
    is the same as in the whole. A word longer than ``most`` is not cut.
    """
    out, at = [], 0
    while at < len(text):
        stop = at + most
        if stop < len(text):
            found = _EDGE.search(text, stop)
            stop = found.start() if found else len(text)
        reach, before = 0, ""
        while at and back and reach < at:
            reach = min(at, max(1 << 12, reach * 2))
            before = text[at - reach : at]
            if len(before.split()) > back:  # the first of these may be cut
                break
        out.append((before + text[at:stop], len(before)))
        at = max(stop, at + 1)
    return out or [("", 0)]


def grouped(texts: list[str | None], most: int, back: int = 0) -> Iterator[tuple[int, list[str], list[int]]]:
    """(index of the first text, texts, characters to skip) in groups of ``most`` characters; long texts piece by piece."""
    held, first, size = [], 0, 0
    for i, t in enumerate(texts):
        t = t or ""
        if held and (size + len(t) > most):
            yield first, held, [0] * len(held)
            held, size = [], 0
        if len(t) > most:
            for piece, skip in pieces(t, most, back):
                yield i, [piece], [skip]
            continue
        if not held:
            first = i
        held.append(t)
        size += len(t) + 1
    if held:
        yield first, held, [0] * len(held)
