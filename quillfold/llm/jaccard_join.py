"""An exact Jaccard self-join of shingle sets, as a join in a metric space.

Both distances used here are metrics: the Jaccard distance d, and the size h of
the symmetric difference. Sets with a similarity of at least t have
``h <= (1-t)/(1+t) * (|x|+|y|)``.

1. *Classes.* Equal sets are one class, represented by its least document.
2. *Cells.* Distances between unrelated texts are all 1, so pivots that are
   documents can't split a corpus: every document would lie in every window. The
   first pivots are therefore the shingles themselves, in one order for all, rare
   ones first. A set's home region is that of its first pivot. The inequality
   for h bounds how many of its first pivots a similar set can lack, so the set
   is replicated to the regions of that many more pivots and no further. In a
   region two sets meet only if their distances to fixed pivots (``PARTS`` or
   more parts of the universe, one for a few shingles) allow it: h(x, y) is at
   least the sum over the parts of ``||x & U| - |y & U||``. What still meets is
   one cell; no similar pair lies across two cells. Regions of more than ``REGION`` sets skip that test.
3. *Voronoi regions.* Every cell of more than ``LEAF`` sets is split by pivots
   drawn from it. Each set goes to its nearest pivot, and also to each pivot p with
   ``d(x,p) <= d(x,own) + 2r`` (the triangle inequality leaves no similar pair
   elsewhere). Sets within r of a pivot are linked to it, and sets that linked
   pivots caught need not meet again; a region where nobody has to is done. The
   others are split in the same way until ``LEAF`` sets are left, which are
   compared. A cell of up to ``TASK`` sets and ``TASK_BYTES`` is split within one
   task, a larger one by a job for each level.
4. *Translation.* Where all sets lie within each other's windows, pivots from
   among them can't split a region. Within a task its sets meet where their
   distances to the pivots allow. A larger region takes one more pivot m, the
   shingles that most of some of its sets have. As h(x,y) is the same for
   ``x ^ m`` and ``y ^ m``, sets near m are linked without a comparison
   (``h(x,m) + h(y,m)`` is small enough), and the others are compared by their
   differences from m, which are much smaller than the sets. The differences are
   dealt to blocks of bounded size, and each pair of blocks that can hold an
   unlinked pair is a tile in a task of its own. So no set is written more than
   once and none is shuffled more often than its region has blocks.

Sets are sorted 64-bit hashes of their shingles and classes are told apart by
128 bits; everything else is exact. No all-pairs list is made: each step gives
links that connect what is connected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import sized, small_batches, written
from .components import components
from .shingle import mix, shingle_sets

#: Sets of a region that are compared without a further split.
LEAF = 4
#: Sets, and bytes of them, of a cell that one task splits.
TASK = 512
TASK_BYTES = 16 << 20
#: Sets of a first region above which it is one cell without a test of each pair.
REGION = 4096
#: Bytes up to which the pivots of all large regions are broadcast.
PIVOT_BYTES = 32 << 20
PIVOTS = 8
#: Sets whose majority is the pivot of a translation.
MEDIAN = 15
#: Sets, and bytes of differences, of a block of a region that pivots can't split.
BLOCK_SETS = 2048
BLOCK_BYTES = 8 << 20
#: Copies of its sets, on average, above which a split by pivots isn't used.
COPIES = 1.25
#: Fixed pivots of which each set keeps its coordinates, at least.
PARTS = 32
#: Documents, and the share of all, from which common shingles are read; from how many documents on a shingle comes late, and how many are ordered.
SAMPLE, SAMPLE_SHARE = 2000, 1 / 16
OFTEN, ORDERED = 256, 1 << 20


def prefix(s: np.ndarray, common: np.ndarray, times: np.ndarray, num: int, den: int) -> np.ndarray:
    """The pivots whose regions a set enters: its first ones, those in ``common`` (sorted) last, the most frequent at the end."""
    n = len(s)
    if len(common):
        at = np.minimum(np.searchsorted(common, s), len(common) - 1)
        often = common[at] == s
        if often.any():
            s = np.concatenate([s[~often], s[often][np.argsort(times[at[often]], kind="stable")]])
    return s[: n + (-num * n // den) + 1]


def per_part(num: int, den: int) -> int:
    """Shingles of a part of the universe up to which coordinates tell unrelated sets apart.

    Two unrelated sets of n shingles differ by about ``1.13 sqrt(x)`` in a part
    of x; over all parts that must be well above the ``2n (den-num)/(den+num)``
    by which similar ones can differ.
    """
    return max(4, int((1.13 * (den + num) / (2 * max(1, den - num))) ** 2 / 3))


def coordinates(s: np.ndarray, per: int) -> bytes:
    """How many shingles lie in each part of the universe, 255 at most; twice as many parts where one would hold more than ``per``.

    The halves of a part stand side by side.
    """
    bits = PARTS.bit_length() - 1
    while (per << bits) < len(s):
        bits += 1
    part = (mix(s) >> np.uint64(64 - bits)).astype(np.int64)
    return np.minimum(np.bincount(part, minlength=1 << bits), 255).astype(np.uint8).tobytes()


def _digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def _common(rows: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that a sample finds in many documents, sorted, and how often: they come last in the order of pivots.

    Any order gives the same result; this one keeps regions small. The sample is
    ``SAMPLE`` documents, or a part of ``SAMPLE_SHARE`` if that is more; the most
    frequent ``ORDERED`` shingles at most are collected.
    """
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = rows.count()
    if not total:
        return none
    share = min(1.0, max(SAMPLE_SHARE, SAMPLE / total))
    some = rows.sample(share, seed=1) if share < 1 else rows

    def run(batches):
        for b in batches:
            sets = [s.view(np.int64) for s in shingle_sets(b.column(1), width)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets) if sets else [], pa.int64())], ["s"])

    counted = some.mapInArrow(run, "s long").groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    with small_batches(rows.sparkSession):
        found = counted.where(F.col("n") >= max(4, int(share * OFTEN))).orderBy(F.desc("n"), "s").limit(ORDERED).toArrow()
    if not found.num_rows:
        return none
    values, times = found["s"].to_numpy().view(np.uint64), found["n"].to_numpy()
    order = np.argsort(values)
    return values[order], times[order]


def _prepared(rows: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """``doc_id, n, digest, pivots, coords`` for every row."""
    common, times = _common(rows, width)
    per = per_part(num, den)

    def run(batches):
        for b in batches:
            ns, digests, pivots, coords = [], [], [], []
            for i, s in zip(b.column(0).to_pylist(), shingle_sets(b.column(1), width), strict=True):
                ns.append(len(s))
                linked = len(s) and i is not None
                digests.append(_digest(s) if linked else None)
                pivots.append(prefix(s, common, times, num, den).view(np.int64) if linked else [])
                coords.append(coordinates(s, per) if linked else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ns, pa.int64()), pa.array(digests, pa.binary()), pa.array(pivots, pa.list_(pa.int64())), pa.array(coords, pa.binary())],
                ["doc_id", "n", "digest", "pivots", "coords"],
            )

    return rows.mapInArrow(run, "doc_id long, n long, digest binary, pivots array<long>, coords binary")


def _cells(classes: DataFrame, num: int, den: int) -> DataFrame:
    """``id, component``: classes that may be similar are in one component."""
    rows = classes.select("rep", F.explode("pivots").alias("pivot"))
    # a region with a large share of all rows is one cell at once: each of its sets is linked to its least one; which
    # regions these are is read from a sample, which changes the work but not the result
    sample = rows.sample(0.01, seed=1)
    hot = sized(written(sample.groupBy("pivot").count().where("count > 100").select("pivot"), "hot"))
    cold = rows.join(hot, "pivot", "left_anti")
    w = Window.partitionBy("pivot")
    near = cold.select("rep", "pivot", F.min("rep").over(w).alias("head"), F.count(F.lit(1)).over(w).alias("k"))
    near = written(near.where("k > 1"), "regions")
    warm = rows.join(hot, "pivot", "left_semi")
    heads = sized(written(warm.groupBy("pivot").agg(F.min("rep").alias("head")), "heads"))
    links = warm.join(heads, "pivot").where("rep <> head").select(F.col("rep").alias("a"), F.col("head").alias("b")).distinct()
    links = links.unionByName(near.where(f"k > {REGION} and rep <> head").select(F.col("rep").alias("a"), F.col("head").alias("b")))

    def run(batches):
        """Links that connect what may be similar in each region; rows come by region and size."""
        at, kept = None, []
        for b in batches:
            pivot = b.column(0).to_numpy()
            rest = list(zip(*(c.to_pylist() for c in b.columns[1:]), strict=True))
            cut = np.flatnonzero(np.r_[True, pivot[1:] != pivot[:-1]]) if len(pivot) else []
            pairs = []
            for i, j in zip(cut, [*cut[1:], len(pivot)], strict=True):
                if pivot[i] != at:
                    pairs += _may_meet(kept, num, den)
                    at, kept = pivot[i], []
                kept += rest[i:j]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["a", "b"])
        pairs = _may_meet(kept, num, den)
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["a", "b"])

    small = near.where(f"k <= {REGION}").select("pivot", "rep")
    placed = small.join(classes.select("rep", "n", "coords"), "rep").select("pivot", "rep", "n", "coords")
    tested = placed.repartition("pivot").sortWithinPartitions("pivot", "n", "rep").mapInArrow(run, "a long, b long")
    return components(links.unionByName(tested))


def _far(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least symmetric difference that coordinates of one set and of some others allow."""
    return np.abs(a.astype(np.int16) - b).sum(-1, dtype=np.int64)


def _folded(c: np.ndarray) -> np.ndarray:
    """Coordinates for half as many parts."""
    return np.minimum(c[..., ::2].astype(np.int16) + c[..., 1::2], 255).astype(np.uint8)


def _may_meet(rows: list[tuple[int, int, bytes]], num: int, den: int) -> list[tuple[int, int]]:
    """Links between (id, size, coordinates), by size, that connect every pair whose coordinates allow similarity."""
    k = len(rows)
    if k < 2:
        return []
    n = np.array([r[1] for r in rows], np.int64)
    ends = np.searchsorted(n * num, n * den, side="right")
    parts = np.array([len(r[2]) for r in rows])
    level = {int(p): np.frombuffer(b"".join(r[2] for r in rows if len(r[2]) == p), np.uint8).reshape(-1, int(p)) for p in np.unique(parts)}
    first = {p: int(np.searchsorted(parts, p)) for p in level}  # the number of parts ascends with the size
    group = np.arange(k)
    out = []
    for i in range(k - 1):
        end = int(ends[i])
        if end <= i + 1:
            continue
        c = level[int(parts[i])][i - first[int(parts[i])]]
        for p, block in level.items():
            j = np.arange(max(i + 1, first[p]), min(end, first[p] + len(block)))
            j = j[group[j] != group[i]]
            if not len(j):
                continue
            others = block[j - first[p]]
            while others.shape[1] > len(c):
                others = _folded(others)
            j = j[_far(c, others) * (den + num) <= (n[j] + n[i]) * (den - num)]
            for g in np.unique(group[j]):
                out.append((rows[i][0], rows[int(j[group[j] == g][0])][0]))
                group[group == g] = group[i]
    return out


class Near:
    """Sets of one region, with links between them; only shingles that two of them share are held."""

    def __init__(self, ids: list[int], sets: list[np.ndarray], labels: list[int | None], num: int, den: int):
        order = sorted(range(len(ids)), key=lambda i: (len(sets[i]), ids[i]))
        self.num, self.den = num, den
        self.ids = [ids[i] for i in order]
        sets = [sets[i] for i in order]
        self.sizes = np.array([len(x) for x in sets], np.int64)
        flat = np.sort(np.concatenate(sets))
        again = np.zeros(len(flat), bool)
        again[1:] = flat[1:] == flat[:-1]
        shared = flat[again]
        shared = shared[np.r_[True, shared[1:] != shared[:-1]]] if len(shared) else shared
        words = max(1, (len(shared) + 63) // 64)
        self.dense = words * len(ids) <= 1 << 21
        bits = np.zeros((len(ids), words * 8), np.uint8) if self.dense else None
        cols = []
        for i, x in enumerate(sets):
            at = np.minimum(np.searchsorted(shared, x), max(0, len(shared) - 1))
            at = at[shared[at] == x] if len(shared) else at[:0]
            if self.dense:
                row = np.zeros(words * 64, np.uint8)
                row[at] = 1
                bits[i] = np.packbits(row)
            else:
                cols.append(at.astype(np.int32))
        if self.dense:
            self.bits = bits.view(np.uint64)
        else:
            self.starts = np.r_[0, np.cumsum([len(c) for c in cols])]
            self.cols = np.concatenate(cols)
            self.mark = np.zeros(len(shared) + 1, np.int32)
        self.parent = list(range(len(ids)))
        self.links: list[tuple[int, int]] = []
        #: Regions that were split, and pairs that were compared.
        self.splits = self.compared = 0
        first: dict[object, int] = {}
        for i, (k, label) in enumerate(zip(self.ids, (labels[i] for i in order), strict=True)):
            self.parent[self.find(i)] = self.find(first.setdefault(k, i))
            if label is not None:
                self.parent[self.find(i)] = self.find(first.setdefault((label,), i))

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def roots(self, some: np.ndarray) -> np.ndarray:
        return np.array([self.find(i) for i in some.tolist()], np.int64)

    def common(self, i: int, some: np.ndarray) -> np.ndarray:
        """How many shingles set i shares with each of some others."""
        self.compared += len(some)
        if self.dense:
            return np.bitwise_count(self.bits[some] & self.bits[i]).sum(1).astype(np.int64)
        own = self.cols[self.starts[i] : self.starts[i + 1]]
        self.mark[own] = 1
        out = np.array([self.mark[self.cols[self.starts[j] : self.starts[j + 1]]].sum() for j in some.tolist()], np.int64)
        self.mark[own] = 0
        return out

    def link(self, i: int, some: np.ndarray, common: np.ndarray) -> None:
        near = self.den * common >= self.num * (self.sizes[i] + self.sizes[some] - common)
        for j in some[near].tolist():
            a, b = self.find(i), self.find(j)
            if a != b:
                self.parent[a] = b
                self.links.append((self.ids[i], self.ids[j]))

    def meet(self, some: np.ndarray, d: np.ndarray | None = None) -> None:
        """Compare those that aren't connected, where sizes and distances ``d`` to pivots allow it; ``some`` ascends."""
        r = 1 - self.num / self.den + 1e-9
        root = self.roots(some)
        for k in range(len(some) - 1):
            i = int(some[k])
            rest = slice(k + 1, k + 1 + int(np.searchsorted(self.sizes[some[k + 1 :]] * self.num, self.sizes[i] * self.den, side="right")))
            ask = root[rest] != root[k]
            if d is not None and ask.any():
                ask &= (np.abs(d[rest] - d[k]) <= r).all(1)
            if ask.any():
                found = len(self.links)
                others = some[rest][ask]
                self.link(i, others, self.common(i, others))
                if len(self.links) > found:
                    root = self.roots(some)

    def join(self, some: np.ndarray | None = None, leaf: int = LEAF) -> None:
        """Link what is similar among ``some`` by Voronoi regions, recursively."""
        some = np.arange(len(self.ids)) if some is None else some
        if len(np.unique(self.roots(some))) < 2:
            return
        if len(some) <= leaf:
            return self.meet(some)
        self.splits += 1
        r = 1 - self.num / self.den
        pivots, d = [], np.zeros((len(some), 0))
        nearest = np.full(len(some), 2.0)
        for _ in range(min(PIVOTS, 2 + len(some) // 8)):
            k = int(np.argmax(nearest))  # the farthest from all pivots so far
            if nearest[k] <= 0:
                break
            pivots.append(int(some[k]))
            shared = self.common(pivots[-1], some)
            self.link(pivots[-1], some, shared)
            own = 1 - shared / (self.sizes[pivots[-1]] + self.sizes[some] - shared)
            own[k] = 0.0  # shingles that it alone has aren't held
            d = np.column_stack([d, own])
            nearest = np.minimum(nearest, own)
        home = d.argmin(1)
        regions = [np.flatnonzero((home == j) | (d[:, j] <= nearest + 2 * r + 1e-9)) for j in range(len(pivots))]
        regions = [x for x in regions if len(x) > 1 and len(np.unique(self.roots(some[x]))) > 1]
        if regions and (max(map(len, regions)) > 0.8 * len(some) or sum(map(len, regions)) > 2 * len(some)):
            self.meet(some, d)  # all lie within each other's windows
        else:
            for x in regions:
                self.join(some[x], leaf)


def _distance(common: int, a: int, b: int) -> float:
    return 1 - common / (a + b - common)


_PART = pa.schema([("region", pa.int64()), ("rep", pa.int64()), ("set", pa.binary()), ("label", pa.int64())])


def _picked(rows: DataFrame, seed: int, n: int) -> DataFrame:
    """``region, pivots``: n sets of each region, chosen by hashes of their names."""
    pick = [F.min(F.struct(F.xxhash64("rep", F.lit(seed + k)).alias("h"), "rep", "set")).alias(f"p{k}") for k in range(n)]
    return rows.groupBy("region").agg(*pick).select("region", F.array(*[F.struct(f"p{k}.rep", f"p{k}.set") for k in range(n)]).alias("pivots"))


def _told(rows: DataFrame, pivots: DataFrame) -> tuple[DataFrame, object]:
    """``rows`` for a task that needs its region's pivots: they come by broadcast if they are few, else in a fifth column."""
    size = pivots.agg(F.sum(F.aggregate("pivots", F.lit(0).cast("long"), lambda a, p: a + F.octet_length(p["set"])))).head()[0] or 0
    told = rows.select("region", "rep", "set", "label")
    if size > PIVOT_BYTES:
        return told.join(pivots, "region"), None
    return told, rows.sparkSession.sparkContext.broadcast({r.region: [(p.rep, bytes(p.set)) for p in r.pivots] for r in pivots.collect()})


def _rows_with_pivots(batches, known):
    """``(new, region, rep, set, label, pivots)`` of each row; ``new`` where the region begins."""
    at = None
    for b in batches:
        columns = [b.column(k) for k in range(b.num_columns)]
        for k in range(b.num_rows):
            region, rep, raw, label = (c[k].as_py() for c in columns[:4])
            new = region != at
            if new:
                given = known.value[region] if known else [(p["rep"], p["set"]) for p in columns[4][k].as_py()]
                at, pivots = region, dict(given)
            yield new, region, rep, raw, label, pivots
        yield None


def _split(rows: DataFrame, num: int, den: int, level: int) -> tuple[DataFrame, DataFrame]:
    """The Voronoi regions of each region of ``rows``, and the links to pivots."""
    r = 1 - num / den
    schema = "region long, rep long, set binary, label long, cells array<struct<cell:int,home:boolean>>, near array<long>"
    arrow = pa.schema([*_PART, ("cells", pa.list_(pa.struct([("cell", pa.int32()), ("home", pa.bool_())]))), ("near", pa.list_(pa.int64()))])
    told, known = _told(rows, written(_picked(rows, 100 * level, PIVOTS), "pivots"))

    def run(batches):
        out = []
        for row in _rows_with_pivots(batches, known):
            if row is None:
                yield pa.RecordBatch.from_pylist(out, arrow)
                out = []
                continue
            new, region, rep, raw, label, given = row
            if new:
                ps = {i: np.frombuffer(v, np.uint64) for i, v in given.items()}
                reps = sorted(ps)
                near = Near(reps, [ps[p] for p in reps], [None] * len(reps), num, den)
                near.meet(np.arange(len(reps)))
                least: dict[int, int] = {}
                for k, p in enumerate(near.ids):
                    least[near.find(k)] = min(p, least.get(near.find(k), p))
                group = {p: least[near.find(k)] for k, p in enumerate(near.ids)}  # pivots linked to one another
            x = np.frombuffer(raw, np.uint64)
            common = [len(np.intersect1d(x, ps[p], assume_unique=True)) for p in reps]
            d = [_distance(c, len(x), len(ps[p])) for c, p in zip(common, reps, strict=True)]
            hit = [den * c >= num * (len(x) + len(ps[p]) - c) for c, p in zip(common, reps, strict=True)]
            own = int(np.argmin(d))
            cells = [{"cell": j, "home": j == own} for j in range(len(reps)) if j == own or d[j] <= d[own] + 2 * r + 1e-9]
            out.append({"region": region, "rep": rep, "set": raw, "label": group[reps[own]] if hit[own] else label, "cells": cells, "near": [p for p, y in zip(reps, hit, strict=True) if y and p != rep]})

    done = written(told.mapInArrow(run, schema), "voronoi")
    return done, done.select(F.col("rep").alias("a"), F.explode("near").alias("b"))


def _open(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Regions (``keys``) in which two sets may be unconnected, and with a digest of who is in them."""
    who = [F.bit_xor(F.xxhash64("rep", F.lit(k))).alias(f"who{k}") for k in range(2)]
    state = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high"), F.count("label").alias("told"), *who)
    return state.where("n > 1 and (told < n or low <> high)").drop("low", "high", "told")


def _tile_links(rows: list[tuple[int, int | None, int, bytes]], own: int, num: int, den: int) -> list[tuple[int, int]]:
    """Links that connect the similar pairs of the first ``own`` of (id, label, size, difference) with the others, or of all where there are no others."""
    k = len(rows)
    n = np.array([r[2] for r in rows], np.int64)
    diffs = [np.frombuffer(r[3], np.uint64) for r in rows]
    d = np.array([len(x) for x in diffs], np.int64)
    group = np.arange(k)
    first: dict[object, int] = {}
    for i, (rep, label, *_) in enumerate(rows):  # one document, or linked to one
        for key in (rep,) if label is None else (rep, (label,)):
            j = first.setdefault(key, i)
            if group[i] != group[j]:
                group[group == group[i]] = group[j]
    begin = own if own < k else 0
    flat = np.concatenate(diffs[begin:])
    order = np.argsort(flat, kind="stable")
    values, holder = flat[order], np.repeat(np.arange(begin, k), d[begin:])[order]
    out = []
    for i in range(own):
        if (group[begin:] == group[i]).all():
            continue
        low = np.searchsorted(values, diffs[i], "left")
        many = np.searchsorted(values, diffs[i], "right") - low
        at = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
        shared = np.bincount(holder[at], minlength=k)
        common = (n[i] + n - d[i] - d + 2 * shared) // 2
        near = den * common >= num * (n[i] + n - common)
        near[: max(begin, i + 1)] = False
        j = np.flatnonzero(near & (group != group[i]))
        for g in np.unique(group[j]):
            out.append((rows[i][0], rows[int(j[group[j] == g][0])][0]))
            group[group == g] = group[i]
    return out


def _translated(rows: DataFrame, num: int, den: int, level: int) -> DataFrame:
    """``a, b``: links of each region, by differences from a middle set of it.

    With ``D = x ^ m`` and ``slack = (den-num)|x| - (den+num)|D|``, x and y are
    similar if their slacks sum to 0 or more. The set of the largest slack is the
    head: all that any such sum connects is caught and linked to it. Of the others
    each meets all sets of its region, those caught too, in tiles of two blocks.
    """
    arrow = pa.schema([("region", pa.int64()), ("rep", pa.int64()), ("label", pa.int64()), ("n", pa.int64()), ("diff", pa.binary())])
    told, known = _told(rows, written(_picked(rows, 100 * level + 50, MEDIAN), "pivots"))

    def run(batches):
        out = []
        for row in _rows_with_pivots(batches, known):
            if row is None:
                yield pa.RecordBatch.from_pylist(out, arrow)
                out = []
                continue
            new, region, rep, raw, label, given = row
            if new:
                some = [np.frombuffer(v, np.uint64) for v in given.values()]
                values, times = np.unique(np.concatenate(some), return_counts=True)
                middle = values[2 * times > len(some)]
            x = np.frombuffer(raw, np.uint64)
            out.append({"region": region, "rep": rep, "label": label, "n": len(x), "diff": np.setxor1d(x, middle, assume_unique=True).tobytes()})

    done = written(told.mapInArrow(run, "region long, rep long, label long, n long, diff binary"), "translated")
    done = done.withColumn("slack", (den - num) * F.col("n") - (den + num) * (F.octet_length("diff") / 8).cast("long"))
    heads = done.groupBy("region").agg(F.max(F.struct("slack", "rep")).alias("head")).select("region", F.col("head.rep").alias("head"), F.col("head.slack").alias("most"))
    state = done.join(sized(written(heads, "heads")), "region").withColumn("caught", F.col("slack") + F.col("most") >= 0)
    links = state.where("caught and rep <> head").select(F.col("rep").alias("a"), F.col("head").alias("b"))

    # none where there is no such set
    parts = lambda which: F.ceil(F.greatest(F.count_if(which) / BLOCK_SETS, F.coalesce(F.sum(F.when(which, F.octet_length("diff"))), F.lit(0)) / BLOCK_BYTES))
    blocks = state.groupBy("region").agg(parts(~F.col("caught")).alias("free"), parts(F.col("caught")).alias("fast")).where("free > 0")
    h = F.xxhash64("rep", F.lit(level))
    placed = state.join(sized(written(blocks, "blocks")), "region").withColumn("block", F.when(F.col("caught"), F.col("free") + F.pmod(h, F.col("fast"))).otherwise(F.pmod(h, F.col("free"))))
    others = F.sequence(F.lit(0).cast("long"), F.when(F.col("caught"), F.col("free") - 1).otherwise(F.col("free") + F.col("fast") - 1))
    tiles = placed.withColumn("label", F.when(F.col("caught"), F.col("head")).otherwise(F.col("label"))).withColumn("other", F.explode(others))
    tiles = tiles.select("region", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "rep", "label", "n", "diff")

    def compare(batches):
        at, kept, own = None, [], 0

        def ended():
            pairs = _tile_links(kept, own, num, den) if len(kept) > 1 and own else []
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["a", "b"])

        for b in batches:
            for region, low, high, block, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (region, low, high) != at:
                    yield ended()
                    at, kept, own = (region, low, high), [], 0
                own += block == low
                kept.append(tuple(row))
        yield ended()

    dealt = tiles.repartition("region", "low", "high").sortWithinPartitions("region", "low", "high", "block", "rep")
    return links.unionByName(dealt.mapInArrow(compare, "a long, b long"))


def _leaf_links(rows: DataFrame, num: int, den: int, leaf: int) -> DataFrame:
    """``a, b``: links of each region that fits a task."""

    def run(batches):
        at, ids, sets, labels = None, [], [], []

        def ended():
            pairs = []
            if len(ids) > 1:
                near = Near(ids, sets, labels, num, den)
                near.join(leaf=leaf)
                pairs = near.links
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["a", "b"])

        for b in batches:
            regions, reps, raws, told = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist()
            for k, region in enumerate(regions):
                if region != at:
                    if len(ids) > 1:
                        yield ended()
                    at, ids, sets, labels = region, [], [], []
                ids.append(reps[k])
                sets.append(np.frombuffer(raws[k].as_py(), np.uint64))
                labels.append(told[k])
        yield ended()

    dealt = rows.select("region", "rep", "set", "label").repartition("region").sortWithinPartitions("region", "rep")
    return dealt.mapInArrow(run, "a long, b long")


def _region_links(rows: DataFrame, num: int, den: int, leaf: int, task: int) -> DataFrame:
    """Links within each region of ``rows`` (``region, rep, set, label``), by recursion."""
    links = []
    level = 0
    while True:
        sizes = rows.groupBy("region").agg(F.count(F.lit(1)).alias("size"), F.sum(F.octet_length("set")).alias("bytes"))
        big = sizes.where((F.col("size") > task) | ((F.col("bytes") > TASK_BYTES) & (F.col("size") > 2))).drop("bytes")
        big = sized(written(big, "large-regions"))
        if not big.limit(1).count():
            links.append(_leaf_links(rows, num, den, leaf))
            break
        links.append(_leaf_links(rows.join(big, "region", "left_anti"), num, den, leaf))
        done, near = _split(rows.join(big, "region"), num, den, level)
        links.append(near)
        parts = done.select(F.col("region").alias("parent"), "rep", "set", "label", F.explode("cells.cell").alias("cell"))
        child = written(_open(parts, ["parent", "cell"]).select("parent", "cell", "n"), "children")
        # where a region keeps almost all of its parent, or windows replicate many sets, distances to pivots can't split it
        stats = child.groupBy("parent").agg(F.max("n").alias("most"), F.sum("n").alias("all"))
        stuck = stats.join(big.withColumnRenamed("region", "parent"), "parent").where(f"most > 0.7 * size or all > {COPIES} * size").select("parent")
        stuck = sized(written(stuck, "stuck"))
        if stuck.limit(1).count():
            links.append(_translated(done.join(stuck, F.col("region") == F.col("parent"), "left_semi").select("region", "rep", "set", "label"), num, den, level))
            child = child.join(stuck, "parent", "left_anti")
        rows = parts.join(child.drop("n"), ["parent", "cell"], "left_semi")
        rows = rows.select(F.xxhash64("parent", "cell").alias("region"), "rep", "set", "label")
        rows = written(rows, "regions")
        level += 1
    out = links[0]
    for x in links[1:]:
        out = out.unionByName(x)
    return out


def jaccard_join(docs: DataFrame, num: int = 80, den: int = 100, width: int = 5, id_col: str = "doc_id", text_col: str = "text",
                 leaf: int = LEAF, task: int = TASK) -> DataFrame:
    """``doc_id, n_shingles, class_id, component_id`` for every row of ``docs``.

    Documents are linked when ``den * |x & y| >= num * |x | y|`` over their sets
    of distinct ``width``-word shingles; a text of fewer words is one shingle, a
    null text or one without words has none and links with nothing.
    ``class_id`` is the least id with an equal set, ``component_id`` the least id
    that links reach. Rows that share an id are one document. A row with a null
    id links with nothing and has null ids. Other columns aren't read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sets = written(_prepared(rows, width, num, den), "sets")
    real = sets.where("digest is not null")
    reps = written(real.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    copies = written(real.select("doc_id", "digest").join(reps, "digest").where("doc_id <> rep").select("doc_id", "digest"), "copies")
    classes = real.join(sized(copies), ["doc_id", "digest"], "left_anti").withColumnRenamed("doc_id", "rep")
    cells = written(_cells(classes, num, den), "cells")
    wanted = sized(written(reps.join(cells.withColumnRenamed("id", "rep"), "rep"), "wanted"))

    def fetch(batches):
        for b in batches:
            reps, cell, out = [], [], []
            names, found, places = b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()
            for i, s, digest, c in zip(names, shingle_sets(b.column(1), width), found, places, strict=True):
                if _digest(s) == digest:  # another row may share the id
                    reps.append(i)
                    cell.append(c)
                    out.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(reps, pa.int64()), pa.array(out, pa.binary()), pa.array([None] * len(reps), pa.int64())], ["region", "rep", "set", "label"])

    members = (
        rows.join(wanted, rows.doc_id == wanted.rep).select("doc_id", "text", "digest", "component")
        .mapInArrow(fetch, "region long, rep long, set binary, label long")
    )
    members = written(members, "members")
    linked = components(_region_links(members, num, den, leaf, task))
    # several classes can share a representative's id: they are one document
    names = real.select("doc_id", "digest", "n").join(reps, "digest")
    shared = sets.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    if shared.limit(1).count():
        own = names.join(shared, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
        linked = components(linked.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(own))
    done = names.join(linked.withColumnRenamed("id", "rep"), "rep", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("rep").alias("class_id"), F.coalesce("component", "rep").alias("component_id"))
    alone = sets.where("digest is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id"))
    return done.unionByName(alone)
