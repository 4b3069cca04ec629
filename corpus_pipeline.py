"""The corpus pipeline: quality, exact copies, near copies, benchmark leaks, tokens.

Each stage takes the documents that its predecessor kept and returns documents
(the last one tokens). Between stages they are written as Parquet: a stage is
called when its predecessor's result has been written, so it begins by removing
the tables that the predecessor wrote for itself, and no others.

Documents with null or empty texts are scored like others; copies of null and
empty texts are equal. Rows without an id are scored and their exact copies go;
they have no near copies and no leaks. Rows that repeat an id and its text
become one in the second stage; of several texts under one id all go or stay
together from the third on. Extra columns are carried by all stages but the last.
Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillfold.llm import bpe, decontam, exact_dedup, jaccard_join, quality
from quillfold.llm.common import new_path, release, scope, sized, table, written
from quillfold.llm.queries import vocabulary

_tables: dict[str, list[str]] = {}


def _stage(function: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that removes the tables of the stage called before it and lists its own."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        tables = _tables.setdefault(spark.sparkContext.applicationId, [])
        release(tables)
        with scope(tables):
            return function(spark, docs, sf_dir)

    return run_stage


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Documents whose id isn't in ``gone`` (``doc_id``); texts are shuffled only if these ids are too many to broadcast."""
    return docs.join(sized(written(gone.distinct(), "gone")), "doc_id", "left_anti").select(*docs.columns)


@_stage
def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; rows are kept or go one by one, whatever their id.

    They are written here, in small Arrow batches: a batch of the session's size
    holds many long texts, several times over, in the executor and its worker.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    columns = docs.columns
    scored = quality.score(docs, model, keep=columns)
    return written(scored.where("predicted = 1").select(*columns), "accepted")


@_stage
def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, that of the least id; rows that repeat an id and its text become one."""
    marks = written(exact_dedup.exact_dedup(docs).groupBy("doc_id", "text_sha256").agg(F.min("kept").alias("kept"), F.count(F.lit(1)).alias("n")), "marks")
    sha = F.sha2(exact_dedup.normalised(F.col("text")), 256)
    odd = sized(written(marks.where("not kept or n > 1").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"), F.col("kept").alias("_kept")), "odd"))
    found = docs.withColumn("_sha0", sha).join(odd, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_sha0") == F.col("_sha")), "left")
    once = found.where("_sha is null").select(*docs.columns)
    # rows that repeat an id and its text: few, and only these are brought together
    again = found.where("_kept").dropDuplicates(["doc_id", "_sha0"]).select(*docs.columns)
    return once.unionByName(again)


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least id of each group that similar texts connect (five-word shingles, 0.8); rows without an id stay."""
    found = jaccard_join.jaccard_join(docs, num=80, den=100, width=5)
    return without(docs, found.where("component_id < doc_id").select("doc_id"))


@_stage
def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, as it is or with exchanged slots; rows without an id stay."""
    return without(docs, decontam.contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id"))


@_stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The digests of ids and of the decoded text of every document, written here in small Arrow batches."""
    return written(bpe.encode_decode_digests(docs, vocabulary("byte_bpe_50k.json")), "tokens")


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", drop_exact_copies),
    ("n-gram jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("bpe encoding and decoding", tokens),
]

#: Training, similarity components and merges have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before: list[str] = []
    for name, stage in STAGES[:-1]:
        result = stage(spark, docs, sf_dir)
        kept: list[str] = []
        with scope(kept):
            path = new_path(spark, f"pipeline-{name.replace(' ', '-')}")
        result.write.parquet(path)
        release(before)  # read by the stage that has just been written
        docs, before = spark.read.parquet(path), kept
    return STAGES[-1][1](spark, docs, sf_dir)
