"""Shared folders, written tables and column helpers of the training-data operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as the contracts of the word operators name it.
SPACE = r"[\x20\x09-\x0D]+"

_written: dict[str, SparkSession] = {}
_own: dict[str, str] = {}
_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only where the setting is absent and the master is local, as in tests on one
    machine, a temporary folder is made, once for an application. On a cluster
    the setting must be there: its machines share no other folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        path = _own.get(app) or _own.setdefault(app, "file://" + tempfile.mkdtemp(prefix="quillfold-"))
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, removed with its scope or when the driver ends."""
    path = f"{shared_dir(spark)}/quillfold/{name}-{uuid.uuid4().hex}"
    _written[path] = spark
    if (paths := _scope.get()) is not None:
        paths.append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _clean() -> None:
    for path, spark in _written.items():
        try:
            remove(spark, path)
        except Exception:  # the session may have ended before
            return


@contextmanager
def scope(paths: list[str]) -> Iterator[None]:
    """Tables that are written inside are listed in ``paths``, for ``release``."""
    token = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(token)


def release(paths: list[str]) -> None:
    """Remove the tables of a scope, and no others; nothing that reads them may be pending."""
    while paths:
        path = paths.pop()
        if spark := _written.pop(path, None):
            remove(spark, path)


def adopt(paths: list[str]) -> None:
    """Hand the tables of an ended scope to the one around it."""
    if (outer := _scope.get()) is not None:
        outer += paths


#: Rows and bytes of an Arrow batch in jobs that write a table: a batch of long texts must fit several times into an executor and its worker.
BATCH_ROWS, BATCH_BYTES = 1000, 1 << 20
_ARROW = "spark.sql.execution.arrow.maxRecordsPerBatch"
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Jobs that begin and end inside have this setting; the session's comes back after them."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> Iterator[None]:
    """Jobs that end inside send Arrow batches of at most ``rows`` rows and about ``size`` bytes; a longer row is one batch."""
    least = lambda key, most: str(min(most, now) if (now := int(spark.conf.get(key))) > 0 else most)
    with _setting(spark, _ARROW, least(_ARROW, rows)), _setting(spark, _ARROW_BYTES, str(size)):
        yield


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read again.

    This cuts the lineage with files that outlive any executor, so the job's
    shuffle files go when it ends, not when the driver happens to collect its
    garbage.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    with small_batches(spark), _setting(spark, _CLEANUP, "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows and bytes (of the rows as text) up to which a written table is broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 64 << 20


def sized(rows: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if it is found within ``BROADCAST_ROWS`` and ``BROADCAST_BYTES``; else joins shuffle it."""
    if rows.count() > BROADCAST_ROWS:
        return rows
    width = rows.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("long"))).head()[0] or 0
    return F.broadcast(rows) if width <= BROADCAST_BYTES else rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: Column | str) -> Column:
    """A text column whose nulls are the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def lower_ascii(column: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used, in lambdas too."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, more: Callable[[Column, Column], Column], block: int = 128) -> Column:
    """For each of some whole numbers what ``more`` (a sum or maximum, from 0) makes of all before it; a last entry holds that of all.

    Blocks are folded first and then joined, so an array of n numbers copies
    about ``n * block + n * n / block`` of them, not n squared.
    """
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    step = lambda a, x: F.struct(more(a["at"], x).cast("int").alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out"))
    fold = lambda v: F.aggregate(v, zero, step)
    all_of = lambda v: let(fold(v), lambda r: F.concat(r["out"], F.array(r["at"])))
    moved = lambda ps, starts: F.flatten(F.transform(ps, lambda p, k: F.transform(p["out"], lambda x: more(F.get(starts, k), x).cast("int"))))
    joined = lambda ps: let(all_of(F.transform(ps, lambda p: p["at"])), lambda starts: F.concat(moved(ps, starts), F.array(F.element_at(starts, -1))))
    blocks = lambda v: F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / block).cast("int")), lambda k: fold(F.slice(v, k * block + 1, block)))
    return let(values, lambda v: F.when(F.size(v) <= block, all_of(v)).otherwise(let(blocks(v), joined)))


def spans_between(gaps: Column, hits: Column) -> Column:
    """``start, end`` of matches, given the lengths of the gaps around them (one more) and their own, in order."""
    def spans(h: Column) -> Column:
        total = running(F.zip_with(F.slice(gaps, 1, F.size(h)), h, lambda g, x: g + x), lambda a, x: a + x)
        return F.zip_with(F.slice(total, 2, F.size(h)), h, lambda e, x: F.struct((e - x).cast("int").alias("start"), e.cast("int").alias("end")))

    return let(hits, lambda h: F.when(F.size(h) > 0, spans(h)).otherwise(F.array().cast("array<struct<start:int,end:int>>")))


def matches(text: Column, pattern: str) -> Column:
    """``start, end, value`` of each match of ``pattern``, in code points; linear in the text but for many thousand matches."""
    by = F.lit(pattern)
    gaps = F.transform(F.split(text, pattern, -1), F.length)

    def found(h: Column) -> Column:
        spans = spans_between(gaps, F.transform(h, F.length))
        return F.zip_with(spans, h, lambda s, v: F.struct(s["start"].alias("start"), s["end"].alias("end"), v.alias("value")))

    return let(F.regexp_extract_all(text, by, F.lit(0)), lambda h: F.when(F.size(h) > 0, found(h)).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>")))


def matches_by(text: Column, pattern: Column) -> Column:
    """``start, end`` of each match of a pattern that is a column."""
    return spans_between(F.transform(F.split(text, pattern, -1), F.length), F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length))


#: Code points of a block of a text that is cut at many places.
CUT = 4096


def cut_at(text: Column, spans: Callable[[Callable[[Column, Column], Column]], Column]) -> Column:
    """``spans(piece)``, where ``piece(start, size)`` gives code points of the text: only the blocks around them are read."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.length(text) / CUT).cast("int")), lambda k: F.substring(text, k * CUT + 1, F.lit(CUT)))

    def piece(b: Column, start: Column, size: Column) -> Column:
        first = F.floor(start / CUT).cast("int")
        last = F.floor((start + size) / CUT).cast("int")
        return F.substring(F.array_join(F.slice(b, first + 1, last - first + 1), ""), start - first * CUT + 1, size)

    return let(blocks, lambda b: spans(lambda start, size: piece(b, start, size)))
