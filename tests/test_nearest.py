"""Nearest vectors in tiles: the same rows as all pairs, ties and odd vectors included; fewer comparisons where vectors cluster."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quillfold.operators import nearest, retrieval


def all_pairs(v, q, k):
    scored = v.join(q.select("query_id", "g", F.col("embedding").alias("_q")), "g").select("query_id", "g", "id", F.greatest(F.lit(0.0), retrieval.cosine(F.col("embedding"), F.col("_q"))).alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 9)), "id"))
    return sorted(map(tuple, scored.withColumn("rank", rank).where(F.col("rank") <= k).collect()))


@pytest.mark.parametrize("block,query_block,k", [(16_384, 1024, 3), (20, 7, 5), (1, 1, 2), (50, 3, 40)])
def test_equals_all_pairs(spark, block, query_block, k):
    rng = random.Random(block)
    base = [[float(np.float32(rng.gauss(0, 1))) for _ in range(5)] for _ in range(30)]
    vec = lambda: rng.choice([*base, [0.0] * 5, None, [1.0, None, 0.0, 0.0, 0.0], [1.0, 2.0], [2 * x for x in base[0]]])
    rows = [(rng.choice([1, 1, 1, 2, 3, None]), f"v{rng.randrange(10_000)}", vec()) for _ in range(200)] + [(1, "tie", base[0])] * 3
    asked = [(rng.choice([1, 1, 2, 9, None]), i, vec()) for i in range(40)]
    v = spark.createDataFrame(rows, "g int, id string, embedding array<float>")
    q = spark.createDataFrame(asked, "g int, query_id long, embedding array<float>")
    got = nearest.top_vectors(v, q, k, "g", "id", block=block, query_block=query_block)
    assert got.columns == ["query_id", "g", "id", "score", "rank"]
    assert sorted(map(tuple, got.collect())) == all_pairs(v, q, k)
    assert nearest.top_vectors(v.limit(0), q, k, "g", "id").count() == nearest.top_vectors(v, q.limit(0), k, "g", "id").count() == 0


def test_scores_are_those_of_the_expression(spark):
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=(2, 300, 64)).astype(np.float32)
    df = spark.createDataFrame([(x.tolist(), y.tolist()) for x, y in zip(a, b, strict=True)], "a array<float>, b array<float>")
    want = [r[0] for r in df.select(F.greatest(F.lit(0.0), retrieval.cosine(F.col("a"), F.col("b")))).collect()]
    assert nearest.exact_scores(a.astype(float), b.astype(float)).tolist() == want


def test_pivots_prune_clusters():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 32))
    v = (centres[rng.integers(0, 40, 8000)] + 0.05 * rng.normal(size=(8000, 32)))
    q = v[:50]
    qi, vi, compared = nearest.candidates(v, q, 8)
    assert compared < 0.5 * len(v) * len(q)
    full = np.argsort(-(nearest._unit(q) @ nearest._unit(v).T), axis=1)[:, :8]
    pairs = set(zip(qi.tolist(), vi.tolist(), strict=True))
    assert all((i, j) in pairs for i in range(50) for j in full[i].tolist())


def test_a_large_group_takes_many_tiles(spark):
    """One label holds all rows: its tiles are spread, and no task gets more than a tile's rows."""
    v = spark.range(4000).select(F.lit("hot").alias("g"), "id", F.array(*[F.sin(F.col("id") * (d + 1)).cast("float") for d in range(8)]).alias("embedding"))
    q = v.where("id % 100 = 0").withColumnRenamed("id", "query_id")
    got = nearest.top_vectors(v, q, 5, "g", "id", block=250, query_block=10)
    assert sorted(map(tuple, got.collect())) == all_pairs(v, q, 5)
