"""Exact nearest vectors inside groups, in tiles of bounded size, pruned by distances to pivots.

The vectors of a group are dealt to blocks of about ``VECTORS`` and its queries
to blocks of about ``QUERIES``; a task gets tiles, each of one block of both, so
a group of any size takes many tasks and none holds more than a tile. In a tile:

1. Unit vectors lie on a sphere. Each is filed under the nearest of some pivots
   and sorted by its distance from it, in runs of ``RUN``. For a query at
   distance ``x`` from a pivot, a run with distances from ``lo`` to ``hi`` can't
   be nearer than ``max(lo - x, x - hi)``, by the triangle inequality.
2. Runs are read in the order of that bound. A query takes part in a run only if
   the bound leaves room for a better score than its k-th so far.
3. What comes within ``MARGIN`` of the k-th is scored again as the expression
   ``retrieval.cosine`` does it, term by term in doubles, so scores and their
   ties are the same to the last bit.

The k best of each tile meet in one ranking, which has a partial step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

VECTORS, QUERIES = 16_384, 1024
RUN, PIVOTS = 256, 16
MARGIN = 1e-8


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``max(0, cosine)`` of the rows of ``a`` and ``b``: sums in order, 0 where a vector has no length."""
    dot, aa, bb = np.zeros(len(a)), np.zeros(len(a)), np.zeros(len(a))
    for d in range(a.shape[1]):
        x, y = a[:, d], b[:, d]
        dot += x * y
        aa += x * x
        bb += y * y
    norm = np.sqrt(aa) * np.sqrt(bb)
    return np.maximum(0.0, np.divide(dot, norm, out=np.zeros_like(dot), where=norm != 0))


def _unit(m: np.ndarray) -> np.ndarray:
    n = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, n, out=np.zeros_like(m), where=n != 0)


def _runs(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int, float, float]]]:
    """An order of the vectors, the pivots, and runs ``start, end, pivot, lo, hi`` of that order."""
    pivots = units[np.linspace(0, len(units) - 1, min(PIVOTS, -(-len(units) // RUN))).astype(int)]
    dist = np.sqrt(np.maximum(0.0, 2 - 2 * units @ pivots.T))
    own = dist.argmin(axis=1)
    near = dist[np.arange(len(units)), own]
    order = np.lexsort((near, own))
    runs = []
    for p in range(len(pivots)):
        lo, hi = np.searchsorted(own[order], [p, p + 1])
        runs += [(s, min(s + RUN, hi), p, near[order[s]], near[order[min(s + RUN, hi) - 1]]) for s in range(lo, hi, RUN)]
    return order, pivots, runs


def candidates(vectors: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Pairs (query, vector) that hold the k best vectors of each query with all ties, and how many pairs were compared."""
    v, q = _unit(vectors), _unit(queries)
    flat = ~v.any(axis=1)  # vectors without length aren't on the sphere; they score 0
    on = np.flatnonzero(~flat)
    best = np.full((len(q), k), -np.inf)
    found_q, found_v, found_s, compared = [], [], [], 0

    def take(rows: np.ndarray, cols: np.ndarray, scores: np.ndarray) -> None:
        nonlocal compared
        compared += scores.size
        best[rows] = -np.partition(-np.concatenate([best[rows], scores], axis=1), k - 1, axis=1)[:, :k]
        r, c = np.nonzero(scores >= best[rows].min(axis=1, keepdims=True) - MARGIN)
        found_q.append(rows[r])
        found_v.append(cols[c])
        found_s.append(scores[r, c])

    if flat.any():
        cols = np.flatnonzero(flat)
        take(np.arange(len(q)), cols, np.zeros((len(q), len(cols))))
    if len(on):
        order, pivots, runs = _runs(v[on])
        x = np.sqrt(np.maximum(0.0, 2 - 2 * q @ pivots.T))
        bounds = np.stack([np.maximum(0.0, np.maximum(lo - x[:, p], x[:, p] - hi)) for _, _, p, lo, hi in runs], axis=1)
        # a query without length scores 0 everywhere, as negative cosines do
        ceiling = np.maximum(0.0, np.where(q.any(axis=1)[:, None], 1 - bounds * bounds / 2, 0.0))
        for r in np.argsort(-ceiling.max(axis=0), kind="stable"):
            rows = np.flatnonzero(ceiling[:, r] >= best.min(axis=1) - MARGIN)
            if len(rows):
                cols = on[order[runs[r][0] : runs[r][1]]]
                take(rows, cols, np.maximum(0.0, q[rows] @ v[cols].T))
    qi, vi, s = (np.concatenate(x) for x in (found_q, found_v, found_s))
    stay = s >= best.min(axis=1)[qi] - MARGIN
    return qi[stay], vi[stay], compared


def best_of_tile(vectors: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``query, vector, score`` of each query's best: k, and more where scores lie within ``MARGIN`` of the k-th.

    Vectors come in the order in which equal scores are preferred; of exactly
    equal scores k are enough.
    """
    qi, vi, _ = candidates(vectors, queries, k)
    s = exact_scores(vectors[vi], queries[qi])
    order = np.lexsort((vi, -s, qi))
    qi, vi, s = qi[order], vi[order], s[order]
    begins = np.concatenate(([True], (qi[1:] != qi[:-1]) | (s[1:] != s[:-1])))
    rank = np.arange(len(qi)) - np.maximum.accumulate(np.where(begins, np.arange(len(qi)), 0))
    keep = rank < k
    return qi[keep], vi[keep], s[keep]


def _matrix(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``size, rows, matrix`` of the whole vectors of each size; null vectors and those with a null are in none."""
    sizes = np.array([-1 if x is None else x for x in pa.compute.list_value_length(column).to_pylist()])
    if column.null_count or column.flatten().null_count:
        sizes = np.array([-1 if x is None or None in x else len(x) for x in column.to_pylist()])
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        if size > 0:
            yield int(size), rows, column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), size)


def _tile(rows: pa.RecordBatch, k: int) -> pa.RecordBatch:
    """The best vectors of the queries of one tile: ``query_id, group, id, score``."""
    is_query = np.array(rows["kind"].to_pylist()) == 0
    q_rows, v_rows = np.flatnonzero(is_query), np.flatnonzero(~is_query)
    by_size = {size: (r, m) for size, r, m in _matrix(rows["vec"].take(pa.array(v_rows)))}
    out_q, out_v, out_s = [], [], []
    left = set(range(len(q_rows)))
    for size, r, m in _matrix(rows["vec"].take(pa.array(q_rows))):
        own, vectors = by_size.get(size, (np.zeros(0, int), np.zeros((0, size))))
        every = np.zeros((len(v_rows), size))  # vectors of other sizes have no angle with these queries
        every[own] = vectors
        qi, vi, s = best_of_tile(every, m, k)
        out_q, out_v, out_s = [*out_q, r[qi]], [*out_v, vi], [*out_s, s]
        left -= set(r.tolist())
    for q in left:  # a query that isn't a vector scores 0 everywhere
        n = min(k, len(v_rows))
        out_q, out_v, out_s = [*out_q, np.full(n, q)], [*out_v, np.arange(n)], [*out_s, np.zeros(n)]
    qi, vi, s = (np.concatenate(x) if x else np.zeros(0) for x in (out_q, out_v, out_s))
    at_q, at_v = pa.array(q_rows[qi.astype(int)]), pa.array(v_rows[vi.astype(int)])
    return pa.RecordBatch.from_arrays([rows["query_id"].take(at_q), rows["grp"].take(at_q), rows["id"].take(at_v), pa.array(s, pa.float64())], ["query_id", "grp", "id", "score"])


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole tiles of sorted rows, each in one batch."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        keys = list(zip(*(b[c].to_pylist() for c in ("grp", "vblock", "qblock")), strict=True))
        starts = [0, *(n for n in range(1, len(keys)) if keys[n] != keys[n - 1]), len(keys)]
        for lo, hi in zip(starts, starts[1:], strict=False):
            if held and tuple(held[0][c][0].as_py() for c in ("grp", "vblock", "qblock")) != keys[lo]:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            if hi > lo:
                held.append(b.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def top_vectors(vectors: DataFrame, queries: DataFrame, k: int, group: str, id_col: str, vec_col: str = "embedding", block: int = VECTORS, query_block: int = QUERIES) -> DataFrame:
    """``query_id, group, id, score, rank`` of the k nearest of each query's own group.

    ``queries`` has ``query_id``, the group and a vector. The score is ``max(0,
    cosine)``; scores that are equal in nine digits go to the smaller id. A
    vector that is null, has a null or another size than the query scores 0;
    entries must be finite. Rows of a null group and queries without vectors in
    their group have no row. Repeated ids count as often as they stand.
    """
    v = vectors.select(F.col(group).alias("grp"), F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).where("grp is not null")
    q = queries.select(F.col(group).alias("grp"), "query_id", F.col(vec_col).alias("vec")).where("grp is not null")
    # only groups of more than one block: at most one for every ``block`` rows
    large = lambda rows, size, name: rows.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name)).where(F.col(name) > 1)
    v_large, q_large = large(v, block, "vblocks"), large(q, query_block, "qblocks")

    def blocked(rows: DataFrame, key: str) -> DataFrame:
        found = rows.join(v_large, "grp", "left").join(q_large, "grp", "left").na.fill(1, ["vblocks", "qblocks"])
        return found.withColumn("own", F.pmod(F.xxhash64(key), F.col("vblocks" if key == "id" else "qblocks")).cast("int"))

    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    id_type, q_type, grp_type = (x.simpleString() for x in (v.schema["id"].dataType, q.schema["query_id"].dataType, v.schema["grp"].dataType))
    rows = blocked(q, "query_id").select("grp", every("vblocks").alias("vblock"), F.col("own").alias("qblock"), F.lit(0).alias("kind"), F.lit(None).cast(id_type).alias("id"), "query_id", "vec").unionByName(
        blocked(v, "id").select("grp", F.col("own").alias("vblock"), every("qblocks").alias("qblock"), F.lit(1).alias("kind"), "id", F.lit(None).cast(q_type).alias("query_id"), "vec"))

    def run(batches):
        for tile in _tiles(batches):
            kinds = tile["kind"]
            if kinds[0].as_py() == 0 and kinds[-1].as_py() == 1:  # both
                yield _tile(tile, k)

    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n, "grp", "vblock", "qblock").sortWithinPartitions("grp", "vblock", "qblock", "kind", "id")
    scored = dealt.mapInArrow(run, f"query_id {q_type}, grp {grp_type}, id {id_type}, score double").withColumnRenamed("grp", group)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 9)), "id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k)
