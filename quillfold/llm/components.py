"""Connected components of a table of links, by alternating stars.

Large star: each node hands its larger neighbours to the least of its
neighbourhood. Small star: each node hands its smaller ones and itself to the
least of them. Both keep the components; when nothing changes, every node is
linked to the least of its component. The links never leave the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import adopt, release, scope, written


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    out = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    out = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return out.unionByName(own).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` (its least id) of every node of the links ``a, b`` (longs).

    Links of a node to itself and links with a null are left out; repeated links
    count once. No link gives no row.
    """
    first = edges.select("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    mark = lambda x: tuple(x.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head())
    paths: list[str] = []
    with scope(paths):
        e = written(first, "links")
    now = mark(e)
    while now[0]:
        newer: list[str] = []
        with scope(newer):
            e = written(_small_star(_large_star(e)), "links")
        before, now = now, mark(e)
        release(paths)  # the links before this round
        paths = newer
        if before == now:
            break
    adopt(paths)
    roots = e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
