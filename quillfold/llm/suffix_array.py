"""Suffix sorting by induced sorting in memory, with queues that can spill to disk.

The suffixes of one string are sorted in the manner of external induced
sorting: suffixes that begin a rising run (LMS suffixes) are sorted first, by
naming their substrings and sorting the reduced string of names; from them a
scan upward induces the order of the falling suffixes, and a scan downward that
of the rising ones. Every scan takes tuples out of a monotone priority queue
whose priority is (symbol, arrival): one first-in-first-out list for each
symbol. Tuples go in and out in blocks, and a queue above its share of memory
writes blocks to an unnamed file of its task, which disappears with it. That
bounds the queues alone: the text, the popped suffixes, their order and ranks
are whole arrays in memory.
"""

from __future__ import annotations

import tempfile

import numpy as np

#: Bytes that the queues of one string hold in memory.
MEMORY = 256 << 20


class BlockQueue:
    """A monotone priority queue of (symbol, arrival, suffix), by blocks; large ones lie on disk."""

    def __init__(self, symbols: int, memory: int = MEMORY):
        self.lists: list[list] = [[] for _ in range(symbols)]
        self.held, self.memory, self.file, self.kind = 0, memory, None, np.dtype(np.int64)

    def push(self, symbols: np.ndarray, suffixes: np.ndarray) -> None:
        """Suffixes of equal symbols keep the order in which they come."""
        if not len(symbols):
            return
        order = np.argsort(symbols, kind="stable")
        symbols, suffixes = symbols[order], suffixes[order]
        cut = np.flatnonzero(np.r_[True, symbols[1:] != symbols[:-1]])
        for a, b in zip(cut, [*cut[1:], len(symbols)], strict=True):
            self.lists[int(symbols[a])].append(suffixes[a:b])
        self.held += suffixes.nbytes
        self.kind = suffixes.dtype
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for blocks in self.lists:
            for k, block in enumerate(blocks):
                if isinstance(block, np.ndarray):
                    at = self.file.tell()
                    self.file.write(np.ascontiguousarray(block).tobytes())
                    blocks[k] = (at, len(block))
        self.held = 0

    def pop(self, symbol: int) -> np.ndarray:
        """All suffixes of a symbol, in order of arrival."""
        blocks, self.lists[symbol] = self.lists[symbol], []
        out = []
        for block in blocks:
            if isinstance(block, tuple):
                self.file.seek(block[0])
                block = np.frombuffer(self.file.read(self.kind.itemsize * block[1]), self.kind)
            else:
                self.held -= block.nbytes
            out.append(block)
        return np.concatenate(out) if out else np.zeros(0, self.kind)

    def close(self) -> None:
        if self.file:
            self.file.close()


def _rising(t: np.ndarray) -> np.ndarray:
    """For each suffix whether it is less than the next one (the last, least symbol counts as rising)."""
    n = len(t)
    differs = np.flatnonzero(t[:-1] != t[1:])
    at = np.searchsorted(differs, np.arange(n - 1))
    up = np.ones(n, bool)
    up[:-1] = t[differs[at]] < t[differs[at] + 1]
    return up


def _induce(t: np.ndarray, up: np.ndarray, lms: np.ndarray, symbols: int, memory: int) -> np.ndarray:
    """All suffixes in order, given the LMS ones in order (or, to sort LMS substrings, in order of their first symbols)."""
    n = len(t)
    seeds, down = BlockQueue(symbols, memory), BlockQueue(symbols, memory)
    seeds.push(t[lms], lms)
    falling: list[list[np.ndarray]] = []
    for c in range(symbols):
        mine = []
        block = down.pop(c)
        while len(block):  # a block may induce suffixes of its own symbol
            mine.append(block)
            before = block[block > 0] - 1
            before = before[~up[before]]
            down.push(t[before], before)
            block = down.pop(c)
        falling.append(mine)
        block = seeds.pop(c)
        before = block[block > 0] - 1
        before = before[~up[before]]
        down.push(t[before], before)
    seeds.close()
    down.close()
    rise = BlockQueue(symbols, memory)
    out = []
    for c in range(symbols - 1, -1, -1):
        mine = []
        block = rise.pop(c)  # in falling order
        while len(block):
            mine.append(block)
            before = block[block > 0] - 1
            before = before[up[before]]
            rise.push(t[before], before)
            block = rise.pop(c)
        own = np.concatenate(falling[c])[::-1] if falling[c] else lms[:0]
        before = own[own > 0] - 1
        before = before[up[before]]
        rise.push(t[before], before)
        out += [*mine, own]
    rise.close()
    # the last suffix is the least and is induced by nothing
    order = np.concatenate(out)[::-1]
    return np.concatenate([np.array([n - 1], order.dtype), order[order != n - 1]])


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, int]:
    order = np.argsort(keys)
    s = keys[order]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(np.r_[False, s[1:] != s[:-1]])
    return rank, int(rank.max()) + 1 if len(rank) else 0


def suffix_array(text: bytes, depth: int | None = None, memory: int = MEMORY) -> np.ndarray:
    """The places of the suffixes of ``text`` in order; with ``depth``, in order of at least their first ``depth`` bytes."""
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    # symbols of 16 bits are dealt to their lists by a radix sort
    t = np.zeros(n + 1, np.uint16)
    t[:n] = np.frombuffer(text, np.uint8)
    t[:n] += 1
    up = _rising(t)
    is_lms = np.zeros(n + 1, bool)
    is_lms[1:] = up[1:] & ~up[:-1]
    lms = np.flatnonzero(is_lms).astype(np.int32 if n < 1 << 31 else np.int64)
    first = _induce(t, up, lms, 257, memory)
    in_order = first[is_lms[first]]
    # names: neighbours in this order are equal if their substrings up to the next LMS suffix are
    following = np.full(n + 1, n, np.int64)
    following[lms[:-1]] = lms[1:]
    size = following[in_order] - in_order
    same = np.zeros(len(in_order), bool)
    if len(in_order) > 1:
        a, b = in_order[:-1], in_order[1:]
        open_pairs = np.flatnonzero(size[:-1] == size[1:])
        k = 0
        while len(open_pairs):
            done = k > size[open_pairs]
            same[open_pairs[done] + 1] = True
            open_pairs = open_pairs[~done]
            open_pairs = open_pairs[t[np.minimum(a[open_pairs] + k, n)] == t[np.minimum(b[open_pairs] + k, n)]]
            k += 1
    same[0:1] = False
    name = np.cumsum(~same) - 1
    rank_at = np.zeros(n + 1, np.int64)
    rank_at[in_order] = name
    rank = rank_at[lms]
    count, reach = int(name[-1]) + 1, 1
    # the reduced string: ranks of one, two, four ... names; a name is two bytes at least
    while count < len(lms) and (depth is None or 2 * reach <= depth + 2):
        next_rank = np.full(len(rank), -1, np.int64)
        next_rank[:-reach or None] = rank[reach:] if reach < len(rank) else next_rank[:-reach or None]
        rank, count = _ranks(rank * (count + 1) + next_rank + 1)
        reach *= 2
    ordered = lms[np.argsort(rank, kind="stable")]
    return _induce(t, up, ordered, 257, memory)[1:]
