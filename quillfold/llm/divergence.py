"""Divergence of the sources of a language: how far the words of each are from those of every other.

1. Words are counted where the texts are: a task keeps counts of (language,
   source, word) and of the documents that hold it, a bounded number of them,
   and Spark adds up what the tasks found.
2. Words of enough documents of a language are dealt by a hash to vocabulary
   chunks of about ``CHUNK`` words, each with a place in its chunk.
3. A source's counts in one chunk are packed into one row (places and counts).
   Sources are dealt to blocks of about ``BLOCK``. Each row is replicated to the
   tiles of its block: the pairs (own block, any block) and (any block, own).
4. A task computes the submatrix of a tile while the chunks come one after
   another: it holds the sums, and the packed rows of two blocks of one chunk.

Replicated are counts, not texts: a row for each source, chunk and block, twice.
A source with a third of all documents is a vector like others. All arithmetic
is in integers, exact up to 9e15 words of a source.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import sized, text_of, written

SCALE = 1_000_000_000
CHUNK = 4096
BLOCK = 16
#: Entries of a task's counts after which they are handed on.
HELD = 400_000
#: Bytes of a text that are split into words at once.
PIECE = 1 << 20
#: Bytes of words as they are, but for A-Z; everything else is a space.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def _pieces(raw: bytes):
    """The words of a text in UTF-8, some at a time, none cut in two."""
    at = 0
    while at < len(raw):
        end = at + PIECE
        if end < len(raw):
            while end < len(raw) and _WORDS[raw[end]] != 32:
                end += 1
        yield raw[at:end].translate(_WORDS).split()
        at = end


def word_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents of each word; a row with a null term stands for the group itself."""
    rows = docs.select(text_of(lang_col).alias("lang"), text_of(source_col).alias("source"), text_of(text_col).alias("text"))

    def count(batches):
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def out():
            for (lang, source), (n, d) in held.items():
                terms = [None, *n]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.binary()).cast(pa.string()),
                    pa.array([0, *n.values()], pa.int64()), pa.array([0, *map(d.__getitem__, n)], pa.int64())], ["lang", "source", "term", "n", "docs"])

        for b in batches:
            texts = b.column(2).cast(pa.binary())
            for lang, source, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts, strict=True):
                n, d = held.setdefault((lang, source), (Counter(), Counter()))
                size -= len(n)
                own: set[bytes] = set()
                for words in _pieces(raw.as_py()):
                    n.update(words)
                    own.update(words)
                d.update(own)
                size += len(n)
                if size > HELD:
                    yield from out()
                    held, size = {}, 0
        yield from out()

    found = rows.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: str, total: str, v: str) -> Column:
    """``1 + floor(SCALE * (n + 1) / (total + v))``, in decimals, which are exact."""
    return F.expr(f"1 + (cast({SCALE} as decimal(10,0)) * cast({n} + 1 as decimal(20,0))) div cast({total} + {v} as decimal(20,0))")


def _shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The same in 64-bit integers, three digits at a time; ``total`` is over zero."""
    whole, rest = np.divmod(counts + 1, total)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digits
    return whole + 1


def _value(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // q


class Tile:
    """The sums of one tile: sources of one block against those of another."""

    def __init__(self, key: tuple):
        self.key, self.sides, self.chunk, self.begun = key, ({}, {}), None, False
        self.seen = 0

    def group(self, side: int, source: str, total: int, v: int) -> None:
        self.sides[side][source] = (len(self.sides[side]), total, v)

    def begin(self) -> None:
        """All sources are known, as they come before all counts."""
        self.begun = True
        self.totals = [np.array([t + v for _, t, v in s.values()], np.int64) for s in self.sides]
        self.sums = np.zeros([len(s) for s in self.sides], np.int64)
        self.v = next((v for s in self.sides for _, _, v in s.values()), 0)

    def counts(self, side: int, source: str, chunk: int, width: int, places: np.ndarray, n: np.ndarray) -> None:
        if not self.begun:
            self.begin()
        if chunk != self.chunk:
            self.flush()
            self.chunk, self.rows = chunk, tuple(np.zeros((len(s), width), np.int64) for s in self.sides)
        self.rows[side][self.sides[side][source][0], places] = n

    def flush(self) -> None:
        if self.chunk is None:
            return
        p, q = (_shares(c, t[:, None]) for c, t in zip(self.rows, self.totals, strict=True))
        for k in range(len(p)):
            self.sums[k] += _value(p[k], q).sum(axis=1)
        self.seen += p.shape[1]
        self.chunk = None

    def rows_out(self) -> pa.RecordBatch:
        if not self.begun:
            self.begin()
        self.flush()
        if self.v > self.seen:  # words that no source of the tile has
            p, q = (_shares(np.zeros(len(t), np.int64), t) for t in self.totals)
            self.sums += (self.v - self.seen) * _value(p[:, None], q[None, :])
        out = [(self.key[0], a, b, int(self.sums[i, j])) for a, (i, *_) in self.sides[0].items() for b, (j, *_) in self.sides[1].items() if a != b]
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string()), pa.array(columns[3], pa.int64())], ["lang", "source", "item", "value"])


def _pair_values(groups: DataFrame, packed: DataFrame, block: int) -> DataFrame:
    """``lang, source, item, value`` from groups (``lang, source, total, v, s``) and packed counts (``lang, source, chunk, width, places, n``)."""
    blocks = F.greatest(F.lit(1), F.ceil(F.col("s") / block)).cast("int")
    own = groups.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int"))
    heads = own.select("lang", "source", "blocks", "block", "total", "v", F.lit(-1).alias("chunk"), F.lit(0).alias("width"), F.array().cast("array<int>").alias("places"), F.array().cast("array<long>").alias("n"))
    body = packed.join(sized(own.select("lang", "source", "blocks", "block", "total", "v")), ["lang", "source"]).select(*heads.columns)
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    tiles = F.concat(F.transform(every, lambda b: F.struct(F.col("block").alias("i"), b.alias("j"), F.lit(0).alias("side"))), F.transform(every, lambda b: F.struct(b.alias("i"), F.col("block").alias("j"), F.lit(1).alias("side"))))
    rows = heads.unionByName(body).withColumn("t", F.explode(tiles)).select("lang", "t.i", "t.j", "chunk", "t.side", "source", "total", "v", "width", "places", "n")

    def run(batches):
        tile = None
        for b in batches:
            places, n = ((c.offsets.to_numpy(), c.values.to_numpy()) for c in b.columns[-2:])
            for r, (lang, i, j, chunk, side, source, total, v, width) in enumerate(zip(*(c.to_pylist() for c in b.columns[:-2]), strict=True)):
                if tile is None or tile.key != (lang, i, j):
                    if tile is not None:
                        yield tile.rows_out()
                    tile = Tile((lang, i, j))
                if chunk < 0:
                    tile.group(side, source, total, v)
                else:
                    tile.counts(side, source, chunk, width, *(x[o[r] : o[r + 1]] for o, x in (places, n)))
        if tile is not None:
            yield tile.rows_out()

    n = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n, "lang", "i", "j").sortWithinPartitions("lang", "i", "j", "chunk", "side", "source")
    return dealt.mapInArrow(run, "lang string, source string, item string, value long")


def audit(docs: DataFrame, least: int = 3, top: int = 200, chunk: int = CHUNK, block: int = BLOCK, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``lang, source, part, item, value, rank``: how each source of a language differs.

    Null texts, languages and sources are ''. Words are runs of letters A-Z and
    of all characters from U+0080 on; only A-Z are lower-cased. Words of
    ``least`` documents of a language count. With ``p`` the smoothed share of a
    word in a source, in parts of ``SCALE``, and ``q`` that of another source or
    of the language, the divergence is the sum of ``floor((p - q)^2 / q)``.
    Part ``pair`` has every other source of the language; part ``term`` the
    ``top`` words that the source has more often than its language. Sources
    without words take part; a row that stands twice counts twice. A language
    without counted words has pairs of value 0 and no terms; so has an empty
    table no row. Other columns aren't read.
    """
    counted = written(word_counts(docs, lang_col, source_col, text_col), "word-counts")
    words = counted.where("term is not null")
    # V and the places of the words of each language
    terms = written(words.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("d")).where(F.col("d") >= least).drop("d"), "terms")
    langs = counted.where("term is null").groupBy("lang").agg(F.count(F.lit(1)).alias("s")).join(
        terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total")), "lang", "left").na.fill(0)
    langs = written(langs, "langs")
    chunks = F.greatest(F.lit(1), F.ceil(F.col("v") / chunk)).cast("int")
    by_chunk = Window.partitionBy("lang", "chunk")
    placed = terms.join(langs.select("lang", "v"), "lang").withColumn("chunk", F.pmod(F.xxhash64("term"), chunks).cast("int")).select(
        "lang", "term", "lang_n", "chunk", (F.row_number().over(by_chunk.orderBy("term")) - 1).alias("place"), F.count(F.lit(1)).over(by_chunk).cast("int").alias("width"))
    kept = written(words.join(placed, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n", "chunk", "place", "width"), "kept-counts")
    packed = kept.groupBy("lang", "source", "chunk").agg(F.max("width").alias("width"), F.collect_list(F.struct("place", "n")).alias("c")).select("lang", "source", "chunk", "width", F.col("c.place").alias("places"), F.col("c.n").alias("n"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = written(counted.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").na.fill(0, ["total"]).join(langs, "lang"), "groups")
    pairs = written(_pair_values(groups, packed, block), "pairs")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    p, q = _share("n", "total", "v"), _share("lang_n", "lang_total", "v")
    above = kept.join(sized(groups), ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    valued = above.select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value"))
    return ranked(pairs, "pair").unionByName(ranked(valued, "term").where(F.col("rank") <= top))
