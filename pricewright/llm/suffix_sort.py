"""Suffix sorting by induction, with disk-backed queues that carry suffixes and common-prefix values.

Suffixes that are smaller than the next (S) after a larger one (L) are the seeds. Their blocks, from a seed to the
next, are sorted and named; if names repeat, the sequence of names is sorted by the same procedure, recursively. From
the seeds in order all L suffixes are induced by one pass upwards, and from those all S suffixes by one downwards: the
suffix one place before each that is read goes to the queue of its first symbol. What is pushed to a queue arrives in
order, so a queue of one symbol is a file that grows at its end, and all queues together are a priority queue by
symbol. Each entry carries the length of the prefix it shares with the entry before it, up to `cap`: one more than
the least of those between the entries it was induced from. Memory holds a block of each queue; the rest is on disk.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 16
#: Symbols of a sequence of names that get a queue each.
QUEUES = 1024


class Queue:
    """Entries (position, common prefix with the entry before) in order; blocks that are full go to a file."""

    def __init__(self, path: str):
        self.path, self.held, self.n_held, self.blocks = path, [], 0, []

    def push(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        if len(pos):
            self.held.append((pos, lcp))
            self.n_held += len(pos)
            if self.n_held >= BLOCK:
                self._spill()

    def _spill(self) -> None:
        pos, lcp = (np.concatenate(x) for x in zip(*self.held, strict=True))
        with open(self.path, "ab") as f:
            self.blocks.append((f.tell(), len(pos)))
            f.write(pos.tobytes() + lcp.tobytes())
        self.held, self.n_held = [], 0

    def _load(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        at, n = self.blocks[i]
        with open(self.path, "rb") as f:
            f.seek(at)
            return np.frombuffer(f.read(8 * n), np.int64), np.frombuffer(f.read(2 * n), np.int16)

    def upward(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """In order, with what is pushed meanwhile."""
        i = 0
        while True:
            if i < len(self.blocks):
                yield self._load(i)
                i += 1
            elif self.held:
                self._spill()
            else:
                return

    def downward(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """From the last to the first; each value is the common prefix with the entry yielded before."""
        if self.held:
            self._spill()
        above = 0
        for i in reversed(range(len(self.blocks))):
            pos, lcp = self._load(i)
            back = lcp[::-1]
            yield pos[::-1], np.concatenate([[above], back[:-1]]).astype(np.int16)
            above = back[-1]

    def close(self) -> None:
        if os.path.exists(self.path):
            os.remove(self.path)


def common(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, up to cap. Compares a word of 8 bytes at a time."""
    out, n, size = np.zeros(len(a), dtype=np.int16), len(text), text.dtype.itemsize
    per = 8 // size
    words = np.ndarray(max(n - per + 1, 0), np.uint64, text, strides=(size,))
    ones = np.uint64((1 << (8 * size)) - 1)
    alive, k = np.arange(len(a)), 0
    while len(alive) and k < cap:
        i, j = a[alive] + k, b[alive] + k
        room = np.maximum(i, j) + per <= n
        for x, y, at in zip(i[~room].tolist(), j[~room].tolist(), alive[~room].tolist(), strict=True):
            m = 0
            while max(x, y) + m < n and text[x + m] == text[y + m]:
                m += 1
            out[at] = min(k + m, cap)
        alive = alive[room]
        differ = words[i[room]] ^ words[j[room]]
        same, going = np.zeros(len(alive), dtype=np.int16), np.ones(len(alive), dtype=bool)
        for m in range(per):
            going &= (differ >> np.uint64(8 * size * m)) & ones == 0
            same += going
        out[alive] = np.minimum(k + same, cap)
        alive, k = alive[going], k + per
    return out


class Minima:
    """Minima of ranges of a block."""

    def __init__(self, x: np.ndarray):
        self.levels = [x]
        while len(self.levels[-1]) > 1 << (len(self.levels) - 1):
            last, w = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-w], last[w:]))

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Of x[lo..hi], both inclusive, lo <= hi."""
        size = hi - lo + 1
        level = np.frexp(size.astype(np.float64))[1] - 1
        out = np.empty(len(lo), dtype=self.levels[0].dtype)
        for k in np.flatnonzero(np.bincount(level)):
            at = level == k
            out[at] = np.minimum(self.levels[k][lo[at]], self.levels[k][hi[at] - (1 << k) + 1])
        return out


class _Pass:
    """Pushes the suffixes before those that are read, with the least common prefix since the last push to the same queue."""

    def __init__(self, text: np.ndarray, queues: dict[int, Queue], cap: int, upward: bool):
        self.text, self.queues, self.cap, self.upward, self.since = text, queues, cap, upward, {}

    def read(self, pos: np.ndarray, lcp: np.ndarray, symbol: int, own: bool) -> None:
        """own: the entries are of the kind that is being induced, so equal symbols before them are as well."""
        has = np.flatnonzero(pos > 0)
        before = self.text[pos[has] - 1].astype(np.int64)
        keep = (before > symbol if self.upward else before < symbol) | (own & (before == symbol))
        at, sym = has[keep], before[keep]
        order = np.argsort(sym, kind="stable")
        at, sym = at[order], sym[order]
        low = int(lcp.min()) if len(lcp) else self.cap
        touched = set()
        if len(at):
            least = Minima(lcp)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(sym)) + 1])
            value = np.empty(len(at), dtype=np.int16)
            inner = np.ones(len(at), dtype=bool)
            inner[cuts] = False
            i = np.flatnonzero(inner)
            if len(i):
                value[i] = least.of(at[i - 1] + 1, at[i])
            value[cuts] = least.of(np.zeros(len(cuts), np.int64), at[cuts])
            ends = np.append(cuts[1:], len(at))
            for a, b in zip(cuts, ends, strict=True):
                q = int(sym[a])
                value[a] = min(int(value[a]), self.since.get(q, 0))
                self.queues[q].push(pos[at[a:b]] - 1, np.minimum(value[a:b] + 1, self.cap).astype(np.int16) if q in self.since else np.concatenate([[0], np.minimum(value[a + 1 : b] + 1, self.cap)]).astype(np.int16))
                rest = lcp[at[b - 1] + 1 :]
                self.since[q] = int(rest.min()) if len(rest) else self.cap
                touched.add(q)
        for q in self.since:
            if q not in touched:
                self.since[q] = min(self.since[q], low)


def _seeds(text: np.ndarray) -> np.ndarray:
    """Positions of the seeds, the last place (a symbol smaller than all others) included."""
    n = len(text)
    step = np.sign(text[:-1].astype(np.int64) - text[1:].astype(np.int64)).astype(np.int8)  # 1: L, -1: S, 0: as the next
    nxt = np.where(step != 0, np.arange(n - 1), n)
    nxt = np.minimum.accumulate(nxt[::-1])[::-1]
    larger = np.append(step[np.minimum(nxt, n - 2)] == 1, False)
    return np.flatnonzero(~larger[1:] & larger[:-1]) + 1


def _named(text: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Names of the blocks from each seed to the next, in the order of the blocks."""
    size = np.append(np.diff(seeds) + 1, 1)
    rank, depth = np.zeros(len(seeds), dtype=np.int64), 0
    open_ = np.arange(len(seeds))
    bits = (2 * int(text.max()) + 2).bit_length()
    step = (63 - len(seeds).bit_length()) // bits  # symbols that fit in one key beside the rank
    while len(open_):
        # Some symbols further; a block that ends is smaller than one that goes on.
        key = rank[open_]
        for k in range(depth, depth + step):
            inside = k < size[open_]
            c = np.zeros(len(open_), dtype=np.int64)
            # At its last place a block's type is S: larger than an inner L of the same symbol.
            c[inside] = text[seeds[open_][inside] + k].astype(np.int64) * 2 + 1 + (k == size[open_][inside] - 1)
            key = key << bits | c
        order = np.argsort(key)
        key = key[order]
        new = np.concatenate([[False], key[1:] != key[:-1]])
        group = np.cumsum(new)
        first = np.flatnonzero(np.concatenate([[True], new[1:]]))
        # Ranks count the blocks before the group, so refining one group leaves the others where they are.
        base = rank[open_][order]
        began = np.flatnonzero(np.concatenate([[True], base[1:] != base[:-1]]))
        offset = first[group] - np.repeat(began, np.diff(np.append(began, len(order))))
        rank[open_[order]] = base + offset
        depth += step
        count = np.bincount(group)
        many = count[group] > 1
        again = open_[order][many]
        open_ = np.sort(again[size[again] > depth])
    taken = np.zeros(len(seeds), dtype=np.int64)
    taken[rank] = 1
    return np.cumsum(taken)[rank] - 1


def _doubled(names: np.ndarray, cap: int) -> np.ndarray:
    """The order of the suffixes of `names` by their first `cap` names: only groups that tie are sorted again."""
    n, k = len(names), 1
    start = np.concatenate([[0], np.cumsum(np.bincount(names))])
    rank = start[names]
    open_ = np.flatnonzero(np.diff(start)[names] > 1)
    while len(open_) and k < cap:
        after = np.where(open_ + k < n, rank[np.minimum(open_ + k, n - 1)], -1)
        order = np.argsort(rank[open_] * (n + 1) + after)  # ties get one rank, so their order is free
        base, then = rank[open_][order], after[order]
        fresh = np.concatenate([[True], base[1:] != base[:-1]])
        began = np.flatnonzero(fresh)
        new = fresh | np.concatenate([[True], then[1:] != then[:-1]])
        first, group = np.flatnonzero(new), np.cumsum(new) - 1
        rank[open_[order]] = base + first[group] - np.repeat(began, np.diff(np.append(began, len(order))))
        open_ = np.sort(open_[order][np.bincount(group)[group] > 1])
        k *= 2
    return np.argsort(rank, kind="stable")


def suffixes(text: np.ndarray, folder: str, cap: int, depth: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks (positions, common prefix with the suffix before, up to cap) of all suffixes in order. The last symbol of
    `text` must be smaller than all others; symbols are not negative."""
    text, n = np.asarray(text), len(text)  # a plain view of what may be a memory map
    if n == 1:
        yield np.zeros(1, np.int64), np.zeros(1, np.int16)
        return
    seeds = _seeds(text)
    names = _named(text, seeds)
    if len(seeds) and names.max() + 1 < len(seeds):
        # Names that follow each other are sorted by the same procedure, or, where they are many, by doubling.
        few = names.max() < QUEUES
        order = np.concatenate([pos for pos, _ in suffixes(names, folder, cap, depth + 1)]) if few else _doubled(names, cap)
    else:
        order = np.argsort(names, kind="stable")
    sorted_seeds = seeds[order]
    seed_lcp = np.concatenate([[0], common(text, sorted_seeds[:-1], sorted_seeds[1:], cap)]).astype(np.int16)
    symbols = np.flatnonzero(np.bincount(text))
    at = np.searchsorted(text[sorted_seeds], symbols)
    ends = np.append(at[1:], len(sorted_seeds))
    larger = {int(c): Queue(f"{folder}/{depth}-l-{int(c)}") for c in symbols}
    smaller = {int(c): Queue(f"{folder}/{depth}-s-{int(c)}") for c in symbols}
    up = _Pass(text, larger, cap, True)
    for c, a, b in zip(symbols.tolist(), at, ends, strict=True):
        last, start = -1, True
        for pos, lcp in larger[c].upward():
            if start:
                lcp = np.concatenate([[0], lcp[1:]]).astype(np.int16)
                start = False
            up.read(pos, lcp, c, True)
            last = pos[-1]
        for i in range(a, b, BLOCK):
            j = min(b, i + BLOCK)
            pos, lcp = sorted_seeds[i:j], seed_lcp[i:j].copy()
            if i == a:
                lcp[0] = common(text, np.array([last]), pos[:1], cap)[0] if last >= 0 else 0
            up.read(pos, lcp, c, False)
    down = _Pass(text, smaller, cap, False)
    junction: dict[int, int] = {}
    for c in reversed(symbols.tolist()):
        last, start = -1, True
        for pos, lcp in smaller[c].upward():
            if start:
                lcp = np.concatenate([[0], lcp[1:]]).astype(np.int16)
                start = False
            down.read(pos, lcp, c, True)
            last = pos[-1]
        for k, (pos, lcp) in enumerate(larger[c].downward()):
            if k == 0:
                junction[c] = int(common(text, np.array([last]), pos[:1], cap)[0]) if last >= 0 else 0
                lcp = np.concatenate([[junction[c]], lcp[1:]]).astype(np.int16)
            down.read(pos, lcp, c, False)
    for i, c in enumerate(symbols.tolist()):
        if i == 0:
            yield np.array([n - 1]), np.zeros(1, np.int16)  # the last place, smaller than all; never induced
        start = True
        for pos, lcp in larger[c].upward():
            yield pos, np.concatenate([[0], lcp[1:]]).astype(np.int16) if start else lcp
            start = False
        first = True
        for pos, lcp in smaller[c].downward():
            yield pos, np.concatenate([[junction.get(c, 0)], lcp[1:]]).astype(np.int16) if first else lcp
            first = False
        larger[c].close()
        smaller[c].close()
