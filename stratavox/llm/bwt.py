"""Shard Burrows-Wheeler transforms over byte blocks and their merge by interleave refinement.

A symbol is a block of ``STEP`` bytes; a text of n bytes is read as STEP interleaved strings (one for each residue of
the position), each closed by a terminator. A shard's transform lists, for its suffixes sorted by their first DEPTH
symbols, the symbol that precedes each. Shards are merged without comparing suffixes: the interleave (which shard each
merged row comes from) starts as the concatenation and is refined by one symbol in each round, by a stable distribution
of the rows by the symbols of the merged transform. A class boundary that appears in round r is a common prefix of r
symbols; classes left after DEPTH rounds are the repeated intervals of STEP * DEPTH bytes.
"""

from __future__ import annotations

import numpy as np

from stratavox.llm import blocks

STEP, DEPTH = 20, 5


def _stable_order(keys: np.ndarray) -> np.ndarray:
    """Stable distribution of rows by a 32-bit key: counting by its lower, then its upper half."""
    keys = keys.astype(np.uint32)
    order = np.argsort((keys & np.uint32(0xFFFF)).astype(np.uint16), kind="stable")
    high = (keys >> np.uint32(16)).astype(np.uint16)
    return order[np.argsort(high[order], kind="stable")] if high.any() else order


def _dense(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.unique((a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64), return_inverse=True)[1].astype(np.uint32)


class Rows:
    """All suffix rows of some strings: len + 1 rows a string, the last STEP of them terminators."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray):
        self.lengths = lengths
        self.first = np.concatenate([[0], np.cumsum(lengths + 1)])
        text = np.concatenate([[0], np.cumsum(lengths)])
        n = int(self.first[-1])
        if n >= 1 << 31:
            raise ValueError(f"{n} suffixes in one part, whose places have 31 bits: use more partitions")
        self.string = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths + 1)
        self.pos = np.arange(n, dtype=np.int32) - self.first.astype(np.int32)[self.string]
        self.at = self.pos + text.astype(np.int32)[self.string]  # byte in data
        self.left = lengths.astype(np.int32)[self.string] - self.pos  # bytes from here to the string's end
        full = self.left >= STEP
        prefix = blocks.prefix_hash(data)
        at = self.at[full]
        hashes = blocks.span_hash(prefix, at, at + STEP)
        self.symbol = np.zeros(n, np.uint32)
        self.symbol[full] = np.unique(hashes, return_inverse=True)[1] + 1


def build_shard(rows: Rows, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, transform) of strings [lo, hi): rows sorted by their first DEPTH symbols, by prefix doubling."""
    a, b = int(rows.first[lo]), int(rows.first[hi])
    s1, left = rows.symbol[a:b], rows.left[a:b]

    def ahead(rank: np.ndarray, symbols: int) -> np.ndarray:
        out = np.zeros(b - a, np.uint32)
        ok = np.flatnonzero(left >= symbols * STEP)
        out[ok] = rank[ok + symbols * STEP]
        return out

    rank, done = s1, 1
    while done * 2 <= DEPTH:
        rank = _dense(rank, ahead(rank, done) + np.uint32(1) * (left >= done * STEP))
        done *= 2
    for more in range(done, DEPTH):
        rank = _dense(rank, ahead(s1, more))
    rank[left < STEP] = 0
    # terminators come first, as they do in the merge; ranks of other rows keep their order among themselves
    order = _stable_order(np.where(left < STEP, 0, rank.astype(np.int64) + 1))
    pos = rows.pos[a:b][order]
    before = np.where(pos >= STEP, s1[order - np.minimum(STEP, pos)], 0).astype(np.uint32)
    return (order + a).astype(np.int32), before


def merge(shards: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(merged suffix array, common prefix in symbols, DEPTH at most, with the row before)."""
    sizes = [len(sa) for sa, _ in shards]
    n = sum(sizes)
    small = np.uint16 if len(shards) < 65536 else np.uint32
    z = np.repeat(np.arange(len(shards), dtype=small), sizes)
    last = np.concatenate([t for _, t in shards])
    cls = np.zeros(n, np.int32)
    common = np.full(n, DEPTH, np.int8)
    for done in range(DEPTH):
        c = np.empty(n, np.uint32)
        c[np.argsort(z, kind="stable")] = last
        order = _stable_order(c)
        z, c, cls = z[order], c[order], cls[order]
        new = np.empty(n, bool)
        new[:1] = True
        new[1:] = (c[1:] != c[:-1]) | ((cls[1:] != cls[:-1]) & (c[1:] != 0))
        common[new & (common == DEPTH)] = done
        cls = np.cumsum(new, dtype=np.int32)
    sa = np.empty(n, np.int32)
    sa[np.argsort(z, kind="stable")] = np.concatenate([s for s, _ in shards])
    return sa, common


def repeated_windows(data: np.ndarray, lengths: np.ndarray, order_key: np.ndarray, shard_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """(string, position) of each window of STEP * DEPTH bytes that also stands earlier.

    ``order_key`` gives, for each string, the order of its first window; the windows of a string follow it one by one, so
    keys must be at least a string's length apart. Every repeat is compared byte by byte with the first of its class.
    """
    width = STEP * DEPTH
    if not len(lengths):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows = Rows(data, lengths)
    cuts, size = [0], 0
    for i, n in enumerate(lengths):
        size += int(n)
        if size >= shard_bytes:
            cuts.append(i + 1)
            size = 0
    if cuts[-1] != len(lengths):
        cuts.append(len(lengths))
    sa, common = merge([build_shard(rows, a, b) for a, b in zip(cuts, cuts[1:])])
    interval = np.cumsum(common < DEPTH, dtype=np.int32)  # rows that share all DEPTH symbols with the row before repeat its window
    whole = rows.left[sa] >= width
    sa, cls = sa[whole], interval[whole]
    if not len(sa):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = order_key[rows.string[sa]] + rows.pos[sa]
    starts = np.flatnonzero(np.concatenate([[True], cls[1:] != cls[:-1]]))
    size = np.diff(np.append(starts, len(sa)))
    least = np.minimum.reduceat(key, starts)
    lead = np.repeat(least, size)
    by_key = np.zeros(len(starts), np.int64)
    is_lead = np.flatnonzero(key == lead)
    group = np.repeat(np.arange(len(starts)), size)
    by_key[group[is_lead]] = sa[is_lead]
    rep = np.flatnonzero(key != lead)
    here, there = rows.at[sa[rep]].astype(np.int64), rows.at[by_key[group[rep]]].astype(np.int64)
    same = np.ones(len(rep), bool)
    for d in range(0, width, 4):
        block = np.ones(len(rep), bool)
        for e in range(d, d + 4):
            block &= data[here + e] == data[there + e]
        same &= block
    if not same.all():  # a hash collision between blocks: settle the classes concerned by their bytes
        bad = np.unique(group[rep[~same]])
        extra = np.isin(group, bad)
        same &= ~np.isin(group[rep], bad)
        seen: dict[bytes, int] = {}
        again = []
        for i in sorted(np.flatnonzero(extra), key=lambda i: key[i]):
            text = data[rows.at[sa[i]] : rows.at[sa[i]] + width].tobytes()
            if text in seen:
                again.append(i)
            seen.setdefault(text, i)
        rep = np.concatenate([rep[same], np.array(again, np.int64)])
    return rows.string[sa[rep]], rows.pos[sa[rep]]
