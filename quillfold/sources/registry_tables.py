"""The registry: tables of results under one path, each replaced document by document."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..errors import StorageError
from .commits import VersionedTables

#: Columns of the tables; constraints are queries (``violations``).
SCHEMAS = {
    "managers": "manager_id string, name string, aliases array<string>, created_at timestamp",
    "documents": "doc_id long, manager_id string, blob_id string, file_hash string, title string, publication_date date, as_of_date date, document_type string, status string, confidence double, extraction_coverage double, analyst_attention_required boolean",
    "allocation_calls": "doc_id long, pos int, asset_class_category string, sub_asset_class string, call string, conviction string, time_horizon string, rationale_bullets array<string>, key_risks array<string>, tooltip_text string, citations string, confidence double, needs_analyst_review boolean",
    "summaries": "doc_id long, executive_summary string, search_descriptor string, key_takeaways string, overall_sentiment string",
    "document_tags": "doc_id long, tag_type string, value string, confidence double, source string",
    "evidence_blocks": "doc_id long, chunk_id string, page int, text string, block_type string, bbox string",
    "pipeline_runs": "run_id string, doc_id long, ts timestamp, status string, error string, stages_completed array<string>, total_runtime_seconds double",
}
#: The column whose rows are replaced together.
KEYS = {"managers": "manager_id"}
STATUSES = ("pending", "processing", "needs_review", "published", "completed", "failed")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that the cluster shares; a local one only where none is set and the master is local."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise StorageError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="quillfold-")
    return f"{base.rstrip('/')}/quillfold/{name}-{uuid.uuid4().hex}"


class Registry:
    """Tables of results under one path, in versions; tables that nothing was saved to are empty."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path = spark, path.rstrip("/")
        self.tables = VersionedTables(spark, self.path, KEYS, buckets)

    def save(self, table: str, rows: DataFrame) -> int:
        """Replace the rows of the documents (or managers) in ``rows``."""
        return self.tables.publish({table: rows})

    def publish(self, tables: Mapping[str, DataFrame], documents: DataFrame | None = None, base: int | None = None) -> int:
        """Replace the rows of documents in several tables at once; ``documents`` lists those whose old rows go everywhere."""
        return self.tables.publish(tables, documents, base)

    def read(self, table: str, version: int | None = None) -> DataFrame:
        rows = self.tables.read(table, version)
        if rows is not None:
            return rows
        if table not in SCHEMAS:
            raise StorageError(f"no table {table}")
        return self.spark.createDataFrame([], SCHEMAS[table])

    def execute(self, sql: str, **parameters) -> DataFrame:
        """The rows of a query over the tables, which it names as they are, in braces: ``select * from {documents}``."""
        version = max(self.tables.versions(), default=0)  # one for all tables
        named = {t: self.read(t, version) for t in SCHEMAS if "{" + t + "}" in sql}
        return self.spark.sql(sql, args=parameters or None, **named)


def open_registry(spark: SparkSession, path: str | None = None, buckets: int = 64) -> Registry:
    """The registry at a path, or at that of the settings."""
    return Registry(spark, path or Settings.read().registry_path, buckets)


def violations(documents: DataFrame, tags: DataFrame) -> DataFrame:
    """``doc_id, rule`` of rows that break a constraint."""
    status = documents.where(~F.col("status").isin(*STATUSES)).select("doc_id", F.lit("unknown status").alias("rule"))
    score = documents.where(~F.col("confidence").between(0, 1)).select("doc_id", F.lit("confidence out of range").alias("rule"))
    hashes = documents.groupBy("file_hash").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("doc_id")).where("n > 1").select("doc_id", F.lit("repeated file hash").alias("rule"))
    twice = tags.groupBy("doc_id", "tag_type", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id", F.lit("repeated tag").alias("rule"))
    return status.unionByName(score).unionByName(hashes).unionByName(twice)
