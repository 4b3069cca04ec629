"""A quality classifier from positive and unlabelled documents.

A linear score f over counted properties of a text (and their squares) is fitted
by the non-negative unbiased risk with the squared loss ``l(s) = (1-s)^2 / 4``:
with class prior p, the risk of the positives as positives is ``p E+[l(f)]``,
and the risk of the negatives is estimated from unlabelled text as
``E_u[l(-f)] - p E+[l(-f)]``, which is held at zero or above; where it falls
below, its gradient is turned round. Only labels of 1 train the model, beside
unlabelled texts; labels of 0 aren't read.

The prior is estimated from the same two samples. Above any threshold t of a
score there are at least ``p P+(f >= t)`` of the unlabelled texts, so p is at most
``P_u(f >= t) / P+(f >= t)``; the least such ratio is the estimate, each share
moved by its standard error so that thin tails don't win. The score for this is
fitted with p = 0.5 to one half of the rows, by a hash of the id, and the ratios
are counted over the other half, as positives that trained a score lie higher in
it than their like. The model is then fitted to all rows with the estimate.

With this loss the risk needs only the first two moments of the inputs over the
positives and over the unlabelled texts. They are sums, so every text that isn't
held out counts, whatever the size of the corpus: tasks add up their rows, Spark
adds up the tasks, and the driver gets a few thousand numbers.

The model never sees labels, languages, sources or ids of what it scores.
Scoring reads every whole text and moves none.
"""

from __future__ import annotations

import math
import operator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sized, written

THRESHOLD = 0.7
#: The score at which f is 0.4, between the classes' targets of -1 and 1: ``(0.4 + 1) / 2 = 0.7``.
SLOPE = math.log(0.7 / 0.3) / 0.4

_WORD_END_MARK = regex.compile(rb"[!#$%&*+/<=>@\\^_|~-]{2,}(?=\s|$)").findall
_UPPER = regex.compile(rb"[A-Z]{2,}").findall
_DIGIT = regex.compile(rb"[0-9]").findall
_PUNCT = regex.compile(rb"[.,;:?!]").findall
_SYMBOL = regex.compile(rb"[#$%&*+/<=>@\\^_|~{}\[\]]").findall
_BARE = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))

FEATURES = (
    "log_words", "word_length", "long_words", "distinct_share", "adjacent_repeats", "log_repeats", "top_word_share",
    "mark_rate", "log_marks", "upper_rate", "log_upper", "symbol_rate", "log_symbols", "digit_rate", "punct_rate",
    "end_marks", "lone_symbols", "line_words", "line_repeats", "log_line_repeats", "compressible", "mark_any", "upper_any", "lone_any",
)


def features(text: str | None) -> list[float]:
    """The numbers of one text, in the order of ``FEATURES``; an empty text has zeros."""
    b = (text or "").encode()
    words = b.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size = len(b)
    lines = [x for x in b.split(b"\n") if x.strip()]
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    marks, upper = len(_WORD_END_MARK(b)), len(_UPPER(b))
    symbols, digits, punct = len(_SYMBOL(b)), len(_DIGIT(b)), len(_PUNCT(b))
    lone = sum(v for w, v in counts.items() if len(w) == 1 and not w.isalnum() and w[0] < 128)
    ends = sum(x.rstrip()[-1:] in b".!?:" for x in lines) / len(lines)
    line_repeats = len(lines) - len(set(lines))
    distinct = sum(len(set(words[k : k + 200])) for k in range(0, n, 200))  # in blocks, as it would fall with the length of a text
    return [
        math.log1p(n), size / n, sum(v for w, v in counts.items() if len(w) > 20) / n, len(counts) / math.sqrt(n),
        repeats / n, math.log1p(repeats), max(counts.values()) / n,
        marks / n, math.log1p(marks), upper / n, math.log1p(upper), symbols / size, math.log1p(symbols), digits / size, punct / n,
        ends, lone / n, math.log1p(n / len(lines)), line_repeats / len(lines), math.log1p(line_repeats), distinct / n,
        float(marks > 2), float(upper > 5), float(lone > 2),
    ]


@dataclass
class Model:
    """Weights over standardised features; ``prior`` is the estimated share of good texts."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([z, z * z / 6, np.ones((len(z), 1))])

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(SLOPE * (self.inputs(x) @ self.weights), -30, 30)))


@dataclass
class Moments:
    """Number, mean and mean outer product of inputs."""

    n: int
    mean: np.ndarray
    second: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        return Moments(n, *((self.n * a + other.n * b) / n for a, b in ((self.mean, other.mean), (self.second, other.second))))


def fit(positive: Moments, unlabelled: Moments, prior: float, steps: int = 2000, rate: float = 0.05, ridge: float = 1e-3) -> np.ndarray:
    """The weights of least non-negative unbiased risk; deterministic.

    Without the clamp the minimum solves a linear system. Where the negative
    risk is below zero there, gradient steps go on from it: against the whole
    risk where the negative part is above zero, up the negative part elsewhere.
    """
    own = ridge * np.eye(len(unlabelled.mean))
    whole = unlabelled.second / 2 + own
    w = np.linalg.solve(whole, prior * positive.mean - unlabelled.mean / 2)
    negative = lambda w: ((1 + 2 * unlabelled.mean @ w + w @ unlabelled.second @ w) - prior * (1 + 2 * positive.mean @ w + w @ positive.second @ w)) / 4
    best, least = w, -negative(w)
    for t in range(steps):
        if negative(w) >= 0:
            return w
        up = (unlabelled.mean + unlabelled.second @ w - prior * (positive.mean + positive.second @ w)) / 2
        w = w + rate / (1 + t / 100) * np.linalg.solve(whole, up)
        if -negative(w) < least:
            best, least = w, -negative(w)
    return best


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The class prior from counts of scores in ascending bins: the least ratio of shares above a bin's start.

    Each share is moved by one standard error against the estimate's fall (shares
    are smoothed for it, so a share of 1 has an error, too), so few positives
    give a prior that is too high rather than too low. The result lies in 0.01 to
    0.99.
    """
    n_p, n_u = positive.sum(), unlabelled.sum()
    above = lambda x: np.cumsum(x[::-1])[::-1]
    error = lambda k, n: np.sqrt((k + 1) / (n + 2) * (n - k + 1) / (n + 2) / n)
    p, u = above(positive), above(unlabelled)
    low, high = p / n_p - error(p, n_p), u / n_u + error(u, n_u)
    ratios = high[low > 0] / low[low > 0]
    return float(np.clip(ratios.min(), 0.01, 0.99)) if len(ratios) else 0.5


def _features(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        for b in batches:
            x = [features(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"])

    return rows.mapInArrow(run, f"doc_id {rows.schema[0].dataType.simpleString()}, x array<double>")


def _moments(rows: DataFrame, model: Model) -> dict[tuple[int, int], Moments]:
    """Moments of the inputs of ``x`` for each ``kind`` and ``half``: sums per task, then per number."""
    k = 2 * len(FEATURES) + 1

    def run(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            groups = np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()], 1)
            x = np.array(b.column(2).to_pylist()).reshape(len(groups), len(FEATURES))
            for kind, half in np.unique(groups, axis=0):
                z = model.inputs(x[(groups == (kind, half)).all(1)])
                sums[int(kind), int(half)] = sums.get((int(kind), int(half)), 0) + np.concatenate([[len(z)], z.sum(0), (z.T @ z).ravel()])
        for (kind, half), v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([half], pa.int32()), pa.array([v], pa.list_(pa.float64()))], ["kind", "half", "v"])

    parts = rows.select("kind", "half", "x").mapInArrow(run, "kind int, half int, v array<double>")
    sums = parts.select("kind", "half", F.posexplode("v").alias("at", "v")).groupBy("kind", "half", "at").agg(F.sum("v").alias("v"))
    out: dict[tuple[int, int], np.ndarray] = {}
    for r in sums.collect():  # four groups of 1 + k + k * k numbers
        out.setdefault((r.kind, r.half), np.zeros(1 + k + k * k))[r["at"]] = r.v
    return {g: Moments(int(v[0]), v[1 : k + 1] / v[0], v[k + 1 :].reshape(k, k) / v[0]) for g, v in out.items()}


#: Bins of the scores that the prior is estimated from.
BINS = 1000


def _score_counts(rows: DataFrame, model: Model) -> np.ndarray:
    """How many rows of each ``kind`` (0 or 1) score in each bin: counts per task, then per bin."""

    def run(batches):
        counts = np.zeros((2, BINS), np.int64)
        for b in batches:
            x = np.array(b.column(1).to_pylist()).reshape(b.num_rows, len(FEATURES))
            at = np.minimum((model.score(x) * BINS).astype(int), BINS - 1)
            np.add.at(counts, (b.column(0).to_numpy(), at), 1)
        kind, at = counts.nonzero()
        yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(at, pa.int32()), pa.array(counts[kind, at], pa.int64())], ["kind", "bin", "n"])

    out = np.zeros((2, BINS), np.int64)
    for r in rows.select("kind", "x").mapInArrow(run, "kind int, bin int, n long").groupBy("kind", "bin").agg(F.sum("n").alias("n")).collect():  # 2 * BINS rows at most
        out[r.kind, r.bin] = r.n
    return out


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are for tests alone."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Fit on all texts and labels of 1 that aren't held out; of repeated ids the least label that isn't null counts.

    Rows without an id are left out; rows that repeat one each count. Null and
    empty texts are scored as empty. Without any positive label, or any text, the
    model gives every text 0.5. The prior is 0.5 where one half has no positive.
    """
    k = len(FEATURES)
    known = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
        .groupBy(F.col(id_col).alias("doc_id")).agg(F.min(label_col).alias("y"))
    )
    rows = written(_features(docs.where(F.col(id_col).isNotNull() & ~held_out(F.col(id_col))), id_col, text_col), "features")
    n, *sums = rows.agg(F.count(F.lit(1)), *[f(F.get("x", F.lit(i))) for i in range(k) for f in (F.avg, F.stddev_pop)]).head()
    model = Model(np.zeros(k), np.ones(k), np.zeros(2 * k + 1), 0.5)
    if not n:
        return model
    model = Model(np.array(sums[::2]), np.array(sums[1::2]) + 1e-6, model.weights, model.prior)
    good = sized(written(known.where("y = 1").select("doc_id", F.lit(1).alias("kind")), "good"))
    half = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(2)).cast("int").alias("half")
    both = rows.select(F.lit(0).alias("kind"), half, "x").unionByName(rows.join(good, "doc_id").select("kind", half, "x"))
    found = _moments(both, model)
    whole = [[found[kind, h] for h in (0, 1) if (kind, h) in found] for kind in (0, 1)]
    if not whole[1]:
        return model
    if len(whole[1]) == 2:  # positives on both sides, else the prior stays 0.5
        model.weights = fit(found[1, 0], found[0, 0], model.prior)
        unlabelled, positive = _score_counts(both.where("half = 1"), model)
        model.prior = estimated_prior(positive, unlabelled)
    positive, unlabelled = (reduce(operator.add, whole[kind]) for kind in (1, 0))
    model.weights = fit(positive, unlabelled, model.prior)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, keep: list[str] = ()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; null and empty texts are scored as empty.

    Repeated rows are each scored. ``keep`` names columns to carry.
    """
    rows = docs.select(F.struct(F.col(id_col).alias("doc_id"), *[F.col(c) for c in keep if c != id_col]).alias("r"), F.col(text_col).alias("text"))

    def run(batches):
        for b in batches:
            x = np.array([features(t.as_py()) for t in b.column(1)]).reshape(b.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x), pa.float64())], ["r", "score"])

    from pyspark.sql import types as T

    out = T.StructType([T.StructField("r", rows.schema[0].dataType), T.StructField("score", T.DoubleType())])
    done = rows.mapInArrow(run, out)
    return done.select(
        "r.doc_id", *[f"r.{c}" for c in keep if c != id_col], held_out(F.col("r.doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
