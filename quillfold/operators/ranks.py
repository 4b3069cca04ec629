"""Ranks inside groups of any size, without a window over a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.registry_tables import scratch


def ranked(rows: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "rank", buckets: int | None = None) -> DataFrame:
    """``rows`` with their place, from 1, in their group (``by``), in the order of ``order``; rows that tie have places in any order.

    Rows are dealt by ranges of group and order, so a large group is cut into
    several buckets. A place is that in the bucket and the number of rows of the
    group in the buckets before; only groups in several buckets have such rows,
    at most two for each bucket, and these are broadcast. The dealt rows are
    written once, as ranges drawn a second time may differ.
    """
    spark = rows.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch(spark, "ranked")
    rows.repartitionByRange(n, *by, *order).withColumn("_bucket", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.parquet(path)
    sizes = dealt.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    over = Window.partitionBy(*by)
    before = F.sum("_size").over(over.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    spread = sizes.withColumn("_before", before).withColumn("_parts", F.count(F.lit(1)).over(over)).where("_parts > 1 and _before is not null")
    keys = [f"_by{k}" for k in range(len(by))]
    spread = spread.select(*[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], F.col("_bucket").alias("_b"), "_before")
    own = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy(*order))
    same = F.col("_bucket") == F.col("_b")
    for c, k in zip(by, keys, strict=True):
        same = same & F.col(c).eqNullSafe(F.col(k))
    return dealt.withColumn("_own", own).join(F.broadcast(spread), same, "left").withColumn(name, (F.col("_own") + F.coalesce("_before", F.lit(0))).cast("long")).select(*rows.columns, name)
