"""Evaluation and review statistics over runs and decisions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: targets of an evaluation
TARGETS = {"success_rate": 0.9, "calls_per_document": 3.0, "citation_rate": 1.0, "seconds": 180.0}


def evaluation(runs: DataFrame) -> DataFrame:
    """One row of rates over ``success, n_calls, n_cited, seconds``; empty denominators give 0."""
    good, n = F.count_if("success"), F.count(F.lit(1))
    calls, cited = F.sum(F.when(F.col("success"), F.col("n_calls"))), F.sum(F.when(F.col("success"), F.col("n_cited")))
    ratio = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    took = F.when(F.col("success"), F.col("seconds"))
    out = runs.agg(n.alias("n_documents"), good.alias("n_success"), ratio(good, n).alias("success_rate"), ratio(calls, good).alias("calls_per_document"), ratio(cited, calls).alias("citation_rate"),
                   F.coalesce(F.avg(took), F.lit(0.0)).alias("mean_seconds"), F.coalesce(F.percentile(took, F.lit(0.5)), F.lit(0.0)).alias("p50_seconds"), F.coalesce(F.percentile(took, F.lit(0.95)), F.lit(0.0)).alias("p95_seconds"))
    return out.withColumn("passes", (F.col("success_rate") >= TARGETS["success_rate"]) & (F.col("calls_per_document") >= TARGETS["calls_per_document"]) & (F.col("citation_rate") >= TARGETS["citation_rate"]) & (F.col("mean_seconds") < TARGETS["seconds"]))


def calibration(decisions: DataFrame) -> DataFrame:
    """``band, n, approval_rate, edit_rate, rejection_rate`` over ``band, decision``."""
    share = lambda d: F.avg((F.col("decision") == d).cast("double"))
    return decisions.groupBy("band").agg(F.count(F.lit(1)).alias("n"), share("approved").alias("approval_rate"), share("edited").alias("edit_rate"), share("rejected").alias("rejection_rate"))


def queue(items: DataFrame) -> DataFrame:
    return items.groupBy("queue").agg(F.count(F.lit(1)).alias("depth"), F.min("since").alias("oldest"))


def corrections(edits: DataFrame, directions) -> DataFrame:
    """The matrix of corrected directions: a row for each former one, a column for each new one."""
    return edits.groupBy("from_call").pivot("to_call", list(directions)).count().na.fill(0)


def percentiles(rows: DataFrame, value: str, shares: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Percentiles with linear interpolation, under the names of ``shares``; nulls are left out."""
    return rows.groupBy(*by).agg(*[F.percentile(F.col(value).cast("double"), F.lit(p)).alias(name) for name, p in shares.items()])


def agreement(rows: DataFrame, agrees: Column, by: str = "doc_id") -> DataFrame:
    """``by, agreement``: the share of rows that were agreed with; unknown ones don't count."""
    return rows.groupBy(by).agg(F.avg(agrees.cast("double")).alias("agreement"))
