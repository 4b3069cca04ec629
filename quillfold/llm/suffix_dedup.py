"""Removal of repeated passages, by suffix sorting of shards.

A byte goes if some string of ``length`` bytes over it also starts earlier (in a
smaller document, or earlier in the same one). Every step is exact.

1. *Copies.* Of equal texts all but that of the least id go whole.
2. *Anchors.* Every string of ``length`` bytes holds ``length - K + 1`` strings of
   K bytes; the one with the least hash (the leftmost of equal ones) is its
   anchor. Equal strings have equal anchors at equal places, so a string whose
   anchor occurs once in the corpus occurs once. Only hashes, ids and places of
   anchors are shuffled; most occur once and end there.
3. *Shards.* The stretch of strings around each repeated anchor goes to the shard
   of the anchor's hash; of equal stretches in a task only the first does, as the
   later ones are repeats whatever else there is. Equal stretches of a shard are one, with the place of
   its first occurrence for each offset. The different ones are joined and their
   suffixes sorted by induced sorting in memory (see ``suffix_array``), to the
   depth of ``length`` bytes; neighbours that share ``length`` bytes are one
   string, and all but its first occurrence are repeats.
4. Anchors that a sample finds in many rows are dealt to many shards at once;
   any other whose stretches fill a task (``LARGE``) is sorted in batches there.
   Only stretches with a first occurrence in their batch go on to the next round,
   and there each is cut in two by what stands beside its anchor: of the
   ``length - K`` bytes of a string that the anchor leaves, half lie to its left
   or half to its right, and strings are dealt by these bytes and the anchor
   together. Equal strings stay together, and different surroundings part. The
   part that is known grows until, after a few rounds, it is the whole string. So
   no task gathers an anchor, be its stretches alike or not.

Memory: a task sorts at most ``LARGE`` bytes of different stretches and one more
at a time, in memory. The reduced string is sorted by doubling its names, and
common prefixes are found by comparing sorted neighbours: both give what
carrying them would.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import sized, text_of, written
from .suffix_array import suffix_array

LENGTH = 100
BATCH = 2 << 20
#: Bytes of different stretches that a task holds before it passes them on.
HELD = 24 << 20
SALTS = 64
#: Bytes of one anchor's stretches that a task sorts; more are sorted in batches and go on.
LARGE = 6 << 20
#: Anchors that are dealt to many shards from the start; others are found large where they are sorted.
HINTS = 2000


def _k(length: int) -> int:
    """Bytes of an anchor."""
    return max(1, (length * 9) // 25)


def _hashes(b: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every string of k bytes."""
    out, have = (b.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), 1
    out ^= out >> np.uint64(29)
    while have < k:
        step = min(have, k - have)
        n = len(out) - step
        out = (out[:n] * np.uint64(0xBF58476D1CE4E5B9)) ^ (out[step:] + np.uint64(have * 0x632BE59BD9B4E019 & (1 << 64) - 1))
        out ^= out >> np.uint64(31)
        have += step
    return out * np.uint64(0x94D049BB133111EB)


def anchors(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and place of each anchor, and the first and last start of the strings that have it."""
    none = np.zeros(0, np.int64)
    if len(text) < length:
        return none, none, none, none
    k = _k(length)
    h = _hashes(np.frombuffer(text, np.uint8), k)
    window = length - k + 1
    least, place, have = h, np.arange(len(h)), 1
    while have < window:
        step = min(have, window - have)
        n = len(least) - step
        later = least[step:] < least[:n]  # of equal ones the left stays
        least, place = np.where(later, least[step:], least[:n]), np.where(later, place[step:], place[:n])
        have += step
    new = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    return h[place[new]].view(np.int64), place[new], new, np.r_[new[1:], len(place)] - 1


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.r_[0, flags.astype(np.int8), 0])
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def _spread(sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The places ``at[k], at[k] + 1, ...``, ``sizes[k]`` of them, one k after the other."""
    return np.arange(sizes.sum()) + np.repeat(at - np.cumsum(sizes) + sizes, sizes)


def first_occurrences(stretches: list[bytes], first: np.ndarray, length: int) -> np.ndarray:
    """For each start in each stretch the least of ``first`` over equal strings of ``length`` bytes.

    ``first`` gives an order number for each start of the stretches, one after the other.
    """
    text = b"".join(stretches)
    sizes = np.array([len(s) for s in stretches])
    starts = _spread(sizes - length + 1, np.cumsum(sizes) - sizes)
    valid = np.zeros(len(text) + 1, bool)
    valid[starts] = True
    value = np.zeros(len(text) + 1, np.int64)
    value[starts] = first
    order = suffix_array(text, length)
    order = order[valid[order]]
    if not len(order):
        return first[:0]
    # neighbours whose common prefix reaches ``length``, by words of eight bytes, the last of which may overlap
    step = min(8, length)
    t = np.frombuffer(text, np.uint8)
    words = np.ndarray(len(t) - step + 1, "<u8", t, strides=(1,)).copy() if step == 8 else t
    open_at = np.arange(1, len(order))
    for k in [*range(0, length - 8, 8), length - 8] if step == 8 else range(length):
        open_at = open_at[words[order[open_at] + k] == words[order[open_at - 1] + k]]
        if not len(open_at):
            break
    new = np.ones(len(order), bool)
    new[open_at] = False
    group = np.cumsum(new) - 1
    least = np.minimum.reduceat(value[order], np.flatnonzero(new))
    value[order] = least[group]
    return value[starts]


#: Starts whose repeats are looked up at once.
STARTS = 1 << 20


def _shard(rows: list[tuple], length: int) -> list[np.ndarray | list]:
    """doc, h, repeat first, repeat last, rest, low and high of stretches ``(hot, doc, h, start, text, anchor, low, high)`` of some anchors."""
    hot, doc, h, start, raw, anchor, low, high = zip(*rows, strict=True)
    hot, (doc, h, start, anchor) = np.array(hot, bool), (np.array(x, np.int64) for x in (doc, h, start, anchor))
    order = np.lexsort((h, doc))
    number = np.empty(len(rows), np.int64)
    number[order] = np.cumsum(np.r_[False, (doc[order[1:]] != doc[order[:-1]]) | (h[order[1:]] != h[order[:-1]])])
    keys = (number << 32) + start
    by_text: dict[bytes, int] = {}
    mine = np.array([by_text.setdefault(t, len(by_text)) for t in raw], np.int64)
    texts = list(by_text)
    sizes = np.array([len(t) for t in texts]) - length + 1
    at = np.cumsum(sizes) - sizes
    base = np.full(len(texts), np.iinfo(np.int64).max)
    np.minimum.at(base, mine, keys)
    first = _spread(sizes, base)
    # strings of one stretch differ, as the anchor's place in each does: an anchor with one stretch needs no sorting
    _, which, times = np.unique(anchor[np.unique(mine, return_index=True)[1]], return_inverse=True, return_counts=True)
    several = times[which] > 1
    if several.any():
        sorted_too = np.repeat(several, sizes)
        first[sorted_too] = first_occurrences([texts[k] for k in np.flatnonzero(several).tolist()], first[sorted_too], length)
    out, more = [], []
    count = sizes[mine]
    part = np.cumsum(count) // STARTS
    edge = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
    for a, z in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        n = count[a:z]
        begin = np.cumsum(n) - n
        place = _spread(n, keys[a:z])
        repeat = place > first[_spread(n, at[mine[a:z]])]
        new = np.zeros(len(repeat) + 1, bool)
        new[begin] = new[-1] = True
        x = np.flatnonzero(repeat & (new[:-1] | ~np.r_[False, repeat[:-1]]))
        y = np.flatnonzero(repeat & (new[1:] | ~np.r_[repeat[1:], False]))
        own = a + np.searchsorted(begin, x, side="right") - 1
        low_bits = (1 << 32) - 1
        out.append((doc[own], h[own], place[x] & low_bits, place[y] & low_bits))
        more.append(a + np.flatnonzero(hot[a:z] & (np.add.reduceat(repeat.astype(np.int64), begin) < n)))
    rest = np.concatenate(more)
    out.append((doc[rest], h[rest], start[rest], np.full(len(rest), -1)))
    columns = [np.concatenate(c) for c in zip(*out, strict=True)]
    none = [None] * (len(columns[0]) - len(rest))
    return columns + [none + [c[k] for k in rest.tolist()] for c in (raw, low, high)]


def _values(c: pa.Array) -> list:
    """What ``to_pylist`` gives, sooner for whole numbers and strings of bytes."""
    if c.null_count or not len(c):
        return c.to_pylist()
    if pa.types.is_binary(c.type):
        c = c.cast(pa.large_binary())
        _, at, data = c.buffers()
        at = np.frombuffer(at, np.int64)[c.offset : c.offset + len(c) + 1]
        data = memoryview(data)[at[0] : at[-1]].tobytes() if data else b""
        at = (at - at[0]).tolist()
        return [data[a:z] for a, z in zip(at[:-1], at[1:], strict=True)]
    return c.to_numpy(zero_copy_only=False).tolist()


_REPEATS = "anchor long, doc_id long, h long, first long, last long, rest binary, low int, high int"
_STRETCH = "anchor long, salt long, hot boolean, doc_id long, h long, start long, text binary, low int, high int"


def _repeats(stretches: DataFrame, length: int, large: int | None) -> DataFrame:
    """Repeated starts, and those stretches of hot or large anchors that go on (``rest``, with what is known of their strings)."""

    def run(batches):
        kinds = [pa.int64()] * 5 + [pa.binary(), pa.int32(), pa.int32()]
        schema = pa.schema(list(zip(("anchor", "doc_id", "h", "first", "last", "rest", "low", "high"), kinds, strict=True)))

        def done(rows, anchor):
            cols = _shard(rows, length) if rows else [()] * 7
            return pa.RecordBatch.from_arrays([pa.array([anchor] * len(cols[0]), pa.int64()), *[pa.array(c, t) for c, t in zip(cols, kinds[1:], strict=True)]], schema=schema)

        # ``held`` are stretches of several small anchors, or of one hot or large one
        held, size, at, own, begun = [], 0, None, 0, 0
        for b in batches:
            columns = [_values(c) for c in b.columns]
            for anchor, salt, hot, doc, h, start, text, low, high in zip(*columns, *[repeat(None)] * (9 - len(columns))):  # noqa: B905
                if (anchor, salt) != at:
                    if held and (size > BATCH or hot or held[0][0]):
                        yield done(held, at[0])
                        held, size = [], 0
                    at, own, begun, forced = (anchor, salt), 0, len(held), False
                held.append((hot or forced, doc, h, start, text, anchor, low, high))
                size += len(text)
                own += len(text)
                if hot and size > BATCH:
                    yield done(held, anchor)
                    held, size = [], 0
                elif not hot and large is not None and own > large:
                    # it goes on by itself, in batches: what is first in one of them is looked at again
                    if begun:
                        yield done(held[:begun], None)
                    yield done([(True, *r[1:]) for r in held[begun:]], anchor)
                    held, size, own, begun, forced = [], 0, 0, 0, True
        if held:
            yield done(held, at[0])

    known = [c for c in ("low", "high") if c in stretches.columns]  # nothing is known at first
    rows = stretches.select("anchor", "salt", "hot", "doc_id", "h", "start", "text", *known)
    dealt = rows.repartition("anchor", "salt").sortWithinPartitions("hot", "anchor", "salt", "doc_id", "start")
    return dealt.mapInArrow(run, _REPEATS)


def _halves(rest: DataFrame, length: int) -> DataFrame:
    """Stretches cut by what their strings have beside the part known so far, which grows by half of what is left."""
    k = _k(length)

    def run(batches):
        for b in batches:
            out = []
            for anchor, doc, h, first, text, low, high in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if low is None:  # the anchor itself: the least hash of any of the strings
                    hashes = _hashes(np.frombuffer(text[:length], np.uint8), k)
                    low = int(np.argmin(hashes))
                    high = low + k
                side = max(1, (length - (high - low)) // 2)
                last = len(text) - length  # of the starts, from 0
                cut = low - side  # strings that start here or before reach ``side`` bytes further to the left
                for left, a, z in ((True, 0, min(last, cut)), (False, max(0, cut + 1), last)):
                    if a > z:
                        continue
                    lo, hi = (low - side, high) if left else (low, min(high + side, a + length))
                    key = xxhash.xxh3_64_intdigest(text[lo:hi] + (b"<" if left else b">"), seed=anchor & (1 << 64) - 1)
                    out.append((key - (1 << 63), 0, False, doc, h, first + a, text[a : z + length], lo - a, hi - a))
            cols = list(zip(*out, strict=True)) or [()] * 9
            kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["anchor", "salt", "hot", "doc_id", "h", "start", "text", "low", "high"])

    return rest.select("anchor", "doc_id", "h", "first", "rest", "low", "high").mapInArrow(run, _STRETCH)


def repeated_passages(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, spans, kept_sha256`` for every row of ``docs``.

    ``spans`` are the removed runs of bytes ``[start, end)``; a null text is
    empty, and texts shorter than ``length`` bytes keep all. Null ids come after
    all others. Rows that repeat an id and its text are one document; of several
    texts with one id, the order is that of a hash of the text. Other columns
    aren't read. An empty table gives no row.
    """
    text = text_of(text_col)
    big = F.lit((1 << 63) - 1)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), big).alias("doc_id"), text.alias("text"))
    keyed = rows.select("doc_id", F.xxhash64("text").alias("h"), "text")
    # copies: digests of 256 bits tell texts apart; copies of one text share h
    facts = written(keyed.select("doc_id", "h", F.sha2("text", 256).alias("sha"), F.octet_length("text").cast("long").alias("n_bytes")), "texts")
    least = facts.groupBy("sha").agg(F.min(F.struct("doc_id", "h")).alias("keep"))

    least = written(least, "owners")
    copies = facts.join(least, "sha").where("doc_id <> keep.doc_id or h <> keep.h").select("doc_id", "h").distinct()
    own = keyed.where(F.octet_length("text") >= length).join(sized(written(copies, "copies")), ["doc_id", "h"], "left_anti")

    def anchored(batches):
        for b in batches:
            out = [[], [], []]
            for doc, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                hashes, _, first, last = anchors(t.as_py().encode(), length)
                for col, x in zip(out, (hashes, np.full(len(hashes), doc), (first << bits) + last - first), strict=True):
                    col.append(x)
            cols = [np.concatenate(x).astype(kind) if x else np.zeros(0, kind) for x, kind in zip(out, (np.int64, np.int64, np.int64), strict=True)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(np.isin(cols[0], hot))], ["anchor", "doc_id", "starts", "hot"])

    # the first start of an anchor and how many follow are one number: these rows are most of what is shuffled
    bits = max(8, length.bit_length())
    schema = "anchor long, doc_id long, starts long, hot boolean"
    hot = np.zeros(0, np.int64)
    sample = own.select("doc_id", "text").sample(0.02, seed=1).mapInArrow(anchored, schema)
    # these are repeated without a count; no task gathers their places. Which ones are told from the start changes the work alone
    hot = np.array([r.anchor for r in sample.groupBy("anchor").count().where("count > 20").orderBy(F.desc("count"), "anchor").limit(HINTS).collect()], np.int64)
    spots = own.select("doc_id", "text").mapInArrow(anchored, schema)
    salted = spots.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).otherwise(0))
    marked = salted.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("anchor", "salt"))).where("n > 1 or hot").select("doc_id", "starts", "anchor")
    wanted = marked.groupBy("doc_id").agg(F.collect_set(F.struct("starts", "anchor")).alias("want"))
    # several texts under one id: which of them has an anchor isn't known
    shared = facts.groupBy("doc_id").agg(F.min("h") != F.max("h")).toDF("doc_id", "shared").where("shared")
    asked = wanted.join(sized(written(shared, "shared")), "doc_id", "left")
    texts = written(own.join(asked, "doc_id").dropDuplicates(["doc_id", "h"]), "passages")

    def cut(batches):
        schema = pa.schema([("anchor", pa.int64()), ("salt", pa.int64()), ("hot", pa.bool_()), ("doc_id", pa.int64()), ("h", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("text", pa.binary())])
        held: dict[bytes, tuple] = {}
        size = 0
        known = set(hot.tolist())

        def stretches():
            rows = [(anchor, doc % SALTS if hot else 0, hot, doc, h, first, last, text) for text, (doc, h, first, last, anchor, hot) in held.items()]
            cols = list(zip(*rows, strict=True)) or [()] * 8
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

        for b in batches:
            repeats = []
            want = list(zip(*map(_values, b.column(3).flatten().flatten()), strict=True))
            ends = np.cumsum(b.column(3).value_lengths().to_numpy()).tolist()
            for doc, h, t, begin, end, shared in zip(_values(b.column(0)), _values(b.column(1)), b.column(2), [0, *ends], ends, b.column(4).to_pylist()):  # noqa: B905
                raw = t.as_py().encode()
                asked = sorted(want[begin:end])
                if shared:
                    own = {anchor for _, anchor in asked}
                    hashes, _, first, last = anchors(raw, length)
                    asked = [x for x in zip(((first << bits) + last - first).tolist(), hashes.tolist(), strict=True) if x[1] in own]
                run = None
                for starts, anchor in asked:
                    first = starts >> bits
                    last = first + (starts & (1 << bits) - 1)
                    text = raw[first : last + length]
                    old = held.get(text)
                    new = doc, h, first, last, anchor, anchor in known
                    if old is None:
                        held[text] = new
                        size += len(text) + 300
                    elif old[:3] < new[:3]:
                        if run and run[1] + 1 == first:
                            run[1] = last
                        else:
                            run = [first, last]
                            repeats.append((doc, h, run))
                    else:
                        held[text] = new
                        repeats.append((old[0], old[1], old[2:4]))
            n = len(repeats)
            yield pa.RecordBatch.from_arrays([
                pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_()), pa.array([r[0] for r in repeats], pa.int64()), pa.array([r[1] for r in repeats], pa.int64()),
                pa.array([r[2][0] for r in repeats], pa.int64()), pa.array([r[2][1] for r in repeats], pa.int64()), pa.nulls(n, pa.binary())], schema=schema)
            if size > HELD:
                yield stretches()
                held.clear()
                size = 0
        yield stretches()

    pieces = written(texts.select("doc_id", "h", "text", "want", "shared").mapInArrow(cut, "anchor long, salt long, hot boolean, doc_id long, h long, first long, last long, text binary"), "stretches")
    stretches = pieces.where("text is not null").select("anchor", "salt", "hot", "doc_id", "h", F.col("first").alias("start"), "text")
    found = written(_repeats(stretches, length, LARGE), "repeats")
    repeats = found.where("rest is null").select("doc_id", "h", "first", "last")
    rounds = length.bit_length() + 1  # what isn't known of a string is halved each time
    for left in range(rounds, -1, -1):
        rest = found.where("rest is not null")
        if not rest.limit(1).count():
            break
        found = written(_repeats(_halves(rest, length), length, LARGE if left else None), "repeats")
        repeats = repeats.unionByName(found.where("rest is null").select("doc_id", "h", "first", "last"))
    early = pieces.where("text is null").select("doc_id", "h", "first", "last")
    runs = repeats.unionByName(early).groupBy("doc_id", "h").agg(F.collect_list(F.struct("first", "last")).alias("runs"))

    def kept(batches):
        for b in batches:
            removed, spans, shas, all_spans = [], [], [], []
            for t, rs in zip(b.column(2), b.column(3).to_pylist(), strict=True):
                raw = t.as_py().encode()
                gone = np.zeros(len(raw) + 1, np.int32)
                for r in rs:
                    gone[r["first"]] += 1
                    gone[r["last"] + length] -= 1
                flags = np.cumsum(gone)[:-1] > 0
                a, z = _runs(flags)
                removed.append(int(flags.sum()))
                spans.append(len(a))
                all_spans.append([{"start": int(x), "end": int(y) + 1} for x, y in zip(a, z, strict=True)])
                shas.append(hashlib.sha256(np.frombuffer(raw, np.uint8)[~flags].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                pa.array(all_spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(shas, pa.string())],
                ["doc_id", "h", "n_removed", "n_spans", "spans", "kept_sha256"])

    cuts = texts.select("doc_id", "h", "text").join(runs, ["doc_id", "h"]).mapInArrow(
        kept, "doc_id long, h long, n_removed long, n_spans long, spans array<struct<start:bigint,end:bigint>>, kept_sha256 string")
    copy = (F.col("n_bytes") >= length) & ~((F.col("doc_id") == F.col("keep.doc_id")) & (F.col("h") == F.col("keep.h")))
    no_spans = F.array().cast("array<struct<start:bigint,end:bigint>>")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    done = facts.join(least, "sha").withColumn("copy", copy).join(cuts, ["doc_id", "h"], "left")
    zero, empty = F.lit(0).cast("long"), F.sha2(F.lit(""), 256)
    pick = lambda gone, name, other: F.when(F.col("copy"), gone).otherwise(F.coalesce(F.col(name), other)).alias(name)
    return done.select(
        F.when(F.col("doc_id") != big, F.col("doc_id")).alias("doc_id"), "n_bytes", pick(F.col("n_bytes"), "n_removed", zero), pick(F.lit(1).cast("long"), "n_spans", zero),
        pick(whole, "spans", no_spans), pick(empty, "kept_sha256", F.col("sha")))
