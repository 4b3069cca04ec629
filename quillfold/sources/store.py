"""Sources and sinks: PDFs and JSON records, content-addressed blobs, the registry tables.

Every path may be in any store that Spark reads.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..errors import StorageError
from ..functions import text as X

BLOB_ID = "^[0-9a-fA-F]{64}$"


def read_files(spark: SparkSession, path: str, recursive: bool = False, glob: str | None = None) -> DataFrame:
    """``path, length, content`` of files; a missing path is an error."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path).select("path", "length", "content")


def parse_files(files: DataFrame, parser: Callable[[bytes], Iterator[dict]], schema: str) -> DataFrame:
    """Rows of ``parser(content)`` per file, with ``path``; a file that can't be parsed becomes one row with ``error``.

    The parser (of PDFs, for example) is the caller's; it runs in Arrow batches,
    and its rows are records of ``schema``, missing fields null.
    """
    out = T.StructType.fromDDL(f"path string, error string, {schema}")
    arrow = to_arrow_schema(out)

    def run(batches):
        for b in batches:
            rows = []
            for path, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                try:
                    rows += [{"path": path, "error": None, **r} for r in parser(content.as_py() or b"")]
                except Exception as e:  # one bad file must not end the job; it becomes a row
                    rows.append({"path": path, "error": f"{type(e).__name__}: {e}"[:500]})
            yield pa.RecordBatch.from_pylist([{n: r.get(n) for n in arrow.names} for r in rows], arrow)

    return files.select("path", "content").mapInArrow(run, out)


#: What a parser of pages gives: text blocks with their place and font, and cells of tables.
PAGE_PARTS = "page int, idx int, kind string, text string, size double, flags int, x0 double, y0 double, x1 double, y1 double, table_index int, row int, col int"


def parse_documents(files: DataFrame, parser: Callable[[bytes], Iterator[dict]]) -> DataFrame:
    """Blocks of files in reading order: ``path, error, pos, page, idx, block_id, text, block_type, is_header``.

    The parser gives ``PAGE_PARTS``: parts of kind ``text`` in order, and of kind
    ``cell`` for tables. On each page cells come first; blank parts are left out
    and text blocks numbered without them. A file that fails is one row with
    ``error``.
    """
    rows = parse_files(files, parser, PAGE_PARTS).withColumn("text", X.strip(F.coalesce("text", F.lit("")))).where("error is not null or text <> ''")
    sizes = rows.groupBy("path").agg(F.avg(F.when(F.col("size") > 0, F.col("size"))).alias("average"))
    cell = F.coalesce(F.col("kind") == "cell", F.lit(False))
    n = F.row_number().over(Window.partitionBy("path", "page", "kind").orderBy("idx")) - 1
    rows = rows.join(sizes, "path").withColumn("idx", F.when(cell, F.col("idx")).otherwise(n))
    kind = F.when(F.col("error").isNotNull(), F.lit(None).cast("string")).when(cell, "TABLE_CELL").otherwise(
        X.block_type(F.col("text"), F.col("page"), F.col("idx"), F.col("size"), F.coalesce("flags", F.lit(0)), F.col("average")))
    name = F.when(cell, F.concat_ws("_", "page", "table_index", "row", "col")).otherwise(F.concat_ws("_", "page", "idx"))
    order = Window.partitionBy("path").orderBy("page", F.when(cell, 0).otherwise(1), "table_index", "row", "col", "idx")
    return rows.select(
        "path", "error", (F.row_number().over(order) - 1).alias("pos"), "page", "idx", F.when(F.col("error").isNull(), name).alias("block_id"), F.when(F.col("error").isNull(), F.col("text")).alias("text"),
        kind.alias("block_type"), (cell & (F.col("row") == 0)).alias("is_header"))


def read_records(spark: SparkSession, path: str, schema: str, recursive: bool = False) -> DataFrame:
    """JSON records, one document per file, with their path; broken ones keep null fields and their text in ``_corrupt_record``."""
    reader = spark.read.schema(f"{schema}, _corrupt_record string").option("multiLine", True).option("recursiveFileLookup", str(recursive).lower())
    return reader.json(path).withColumn("path", F.col("_metadata.file_path"))


def blobs(files: DataFrame, content_col: str = "content", metadata: Column | None = None) -> DataFrame:
    """``blob_id, content, size, metadata``: one row per different non-empty content; of several metadata the last in order stays.

    ``metadata`` is a record (of columns of ``files``), kept as JSON with its keys in order.
    """
    kept = F.to_json(metadata) if metadata is not None else F.lit("{}")
    rows = files.select(F.col(content_col).cast("binary").alias("content"), kept.alias("metadata")).where(F.octet_length("content") > 0)
    return rows.groupBy(F.sha2("content", 256).alias("blob_id")).agg(F.first("content").alias("content"), F.max("metadata").alias("metadata")).select(
        "blob_id", "content", F.octet_length("content").alias("size"), "metadata")


class BlobStore:
    """Contents under their hash, in one table; ids are checked before anything is read."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _table(self) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self.path)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            return None

    def _known(self, blob_id: str) -> DataFrame:
        if not re.fullmatch(BLOB_ID, blob_id or ""):
            raise StorageError("a blob id is 64 hexadecimal digits")
        table = self._table()
        empty = self.spark.createDataFrame([], "blob_id string, content binary, size int, metadata string, part string")
        return (empty if table is None else table.where(F.col("part") == blob_id[:2].lower())).where(F.col("blob_id") == blob_id.lower())

    def store(self, files: DataFrame, content_col: str = "content", metadata: Column | None = None) -> None:
        """Add contents that the store doesn't have; empty ones are an error, and nothing is written then."""
        if files.where((F.coalesce(F.octet_length(F.col(content_col).cast("binary")), F.lit(0)) == 0)).limit(1).count():
            raise StorageError("an empty content can't be stored")
        new = blobs(files, content_col, metadata)
        known = self._table()
        new = new if known is None else new.join(known.select("blob_id"), "blob_id", "left_anti")
        new.withColumn("part", F.substring("blob_id", 1, 2)).write.mode("append").partitionBy("part").parquet(self.path)

    def exists(self, blob_id: str) -> bool:
        return self._known(blob_id).limit(1).count() > 0

    def retrieve(self, blob_id: str) -> bytes:
        row = self._known(blob_id).select("content").first()
        if row is None:
            raise StorageError(f"no blob {blob_id}")
        return bytes(row.content)

    def metadata(self, blob_id: str) -> dict:
        row = self._known(blob_id).select("metadata").first()
        if row is None:
            raise StorageError(f"no blob {blob_id}")
        return json.loads(row.metadata)

    def delete(self, blob_id: str) -> None:
        """Remove a content; one that isn't there is no error."""
        if not self.exists(blob_id):
            return
        part = blob_id[:2].lower()
        rest = self._table().where(F.col("part") == part).where(F.col("blob_id") != blob_id.lower())
        _overwrite_parts(rest, self.path, f"{self.path}/part={part}")


def _overwrite_parts(rows: DataFrame, path: str, emptied: str | None = None) -> None:
    """Replace the partitions of ``rows``, which may be read from them: a written copy beside the table comes between, and goes."""
    spark = rows.sparkSession
    beside = f"{path}-{uuid.uuid4().hex}"
    try:
        rows.write.parquet(beside)
        copy = spark.read.schema(rows.schema).parquet(beside)
        if emptied is not None and not copy.limit(1).count():
            _remove(spark, emptied)
            return
        copy.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)
    finally:
        _remove(spark, beside)


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def latest_runs(runs: DataFrame) -> DataFrame:
    """The last status of each run of an append-only log ``run_id, ts, status, error``; errors are cut to 500 characters."""
    last = runs.groupBy("run_id").agg(F.max_by(F.struct("ts", "status", "error"), F.struct("ts", "status")).alias("r"))
    return last.select("run_id", "r.ts", "r.status", F.left("r.error", F.lit(500)).alias("error"))


def matched_files(records: DataFrame, files: DataFrame, stem_col: str = "stem") -> DataFrame:
    """Each record's file by its stem, with or without .pdf; the first folder wins (``files``: ``folder_order, name, path``)."""
    names = files.withColumn("_stem", F.regexp_replace("name", r"(?i)\.pdf$", ""))
    order = Window.partitionBy(stem_col).orderBy("folder_order", "path")
    return records.join(names, F.col(stem_col) == F.col("_stem"), "left").withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n", "_stem", "name", "folder_order")
