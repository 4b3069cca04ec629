"""Sets of hashed word shingles of many texts at a time.

A batch of texts is one array of bytes. Words of up to ``SHORT`` bytes are
hashed together by differences of a running sum (a polynomial with one odd base
and a random number for each byte), longer ones by XXH3; both are mixed again
with their neighbours' hashes to that of a shingle. Nothing is kept from one
batch to the next, so a worker holds no vocabulary.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SHORT = 32
#: Bytes over which one running sum goes.
PIECE = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0xD1342543DE82EF95
_rng = np.random.Generator(np.random.PCG64(20))
_BYTE = _rng.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_POWER = np.cumprod(np.r_[np.uint64(1), np.full(PIECE + SHORT, _BASE, np.uint64)])
_INVERSE = np.cumprod(np.r_[np.uint64(1), np.full(PIECE + SHORT, pow(_BASE, -1, 1 << 64), np.uint64)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers in which every bit depends on every other."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(d: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    size = ends - starts
    out = np.empty(len(starts), np.uint64)
    short = np.flatnonzero(size <= SHORT)
    piece = starts[short] // PIECE
    edge = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1], True]) if len(short) else []
    for a, b in zip(edge[:-1], edge[1:], strict=True):
        own = short[a:b]
        base = int(piece[a]) * PIECE
        part = d[base : base + PIECE + SHORT]
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * _POWER[: len(part)], out=total[1:])
        s, e = starts[own] - base, ends[own] - base
        out[own] = mix((total[e] - total[s]) * _INVERSE[s] + size[own].astype(np.uint64))
    for k in np.flatnonzero(size > SHORT):
        out[k] = xxhash.xxh3_64_intdigest(d[starts[k] : ends[k]].tobytes())
    return out


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of ``width`` words, A-Z lower-cased.

    A text of fewer words is one shingle; a null one or one without words has none.
    """
    raw = pc.fill_null(texts.cast(pa.large_binary()), b"")
    n = len(raw)
    none = np.zeros(0, np.uint64)
    if not n:
        return []
    _, offsets, data = raw.buffers()
    at = np.frombuffer(offsets, np.int64)[raw.offset : raw.offset + n + 1]
    if data is None or at[-1] == at[0]:
        return [none] * n
    d = _LOWER[np.frombuffer(data, np.uint8)[at[0] : at[-1]]]
    at = at - at[0]
    word = ~_SPACE[d]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    cuts = at[(at > 0) & (at < len(d))]
    begins[cuts] = word[cuts]  # texts stand side by side
    stops = word.copy()
    stops[:-1] &= ~word[1:]
    stops[cuts - 1] = word[cuts - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    h = _word_hashes(d, starts, ends)
    bounds = np.searchsorted(starts, at)
    rows = len(h) - width + 1
    every = np.zeros(max(0, rows), np.uint64)
    for k in range(width if rows > 0 else 0):
        every = mix(every * np.uint64(0x9E3779B97F4A7C15) + h[k : rows + k] + np.uint64(k + 1))
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= width:
            s = np.sort(every[a : b - width + 1])
            keep = np.ones(len(s), bool)
            keep[1:] = s[1:] != s[:-1]
            out.append(s[keep])
        elif b > a:
            out.append(np.array([xxhash.xxh3_64_intdigest(h[a:b].tobytes(), seed=b - a)], np.uint64))
        else:
            out.append(none)
    return out


def shingles(text: str | None, width: int) -> np.ndarray:
    """The set of one text."""
    return shingle_sets(pa.array([text], pa.string()), width)[0]
