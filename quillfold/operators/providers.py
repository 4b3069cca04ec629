"""Model providers: functions of a text column, offline and deterministic by default.

A provider's answers should be written before they are used (``answers``), so
that a task that runs again doesn't ask again.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import prompts as prompts_of
from ..functions import schemas
from ..functions import text as T
from . import calls as C
from . import retrieval


def hashed_embedding(text: Column, size: int = 64) -> Column:
    """A bag of hashed words, scaled to length one; a text without words is all zeros."""
    slots = F.transform(T.words(F.lower(text)), lambda w: F.pmod(F.xxhash64(w), F.lit(size)))
    counts = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.size(F.filter(slots, lambda s: s == i)).cast("double"))
    norm = F.sqrt(F.aggregate(counts, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(counts, lambda x: F.when(norm > 0, x / norm).otherwise(0.0).cast("float"))


class Caller:
    """Asks a provider in small batches: tries again with a doubling delay, some batches at once, not more a second than allowed.

    A batch that fails every time is asked prompt by prompt, so that one bad
    prompt costs no other its answer; a prompt that fails gives an error.
    """

    def __init__(self, ask: Callable, tries: int = 3, delay: float = 1.0, batch: int = 16, concurrency: int = 4, per_second: float | None = None):
        self.ask, self.tries, self.delay, self.batch, self.concurrency, self.per_second = ask, tries, delay, batch, concurrency, per_second
        self.free = 0.0
        self.turn = threading.Lock()

    def _wait(self) -> None:
        if self.per_second:
            with self.turn:
                at = max(self.free, time.monotonic())
                self.free = at + 1 / self.per_second
            time.sleep(max(0.0, at - time.monotonic()))

    def _tried(self, prompts: list[str]) -> list[str]:
        for k in range(self.tries):
            self._wait()
            try:
                said = list(self.ask(pd.Series(prompts)))
                if len(said) != len(prompts):
                    raise ValueError(f"{len(said)} answers to {len(prompts)} prompts")
                return said
            except Exception:
                if k == self.tries - 1:
                    raise
                time.sleep(self.delay * 2**k)
        raise ValueError("a provider needs at least one try")

    def _one(self, prompts: list[str]) -> list[tuple[str | None, str | None]]:
        try:
            return [(None if a is None else str(a), "no answer" if a is None else None) for a in self._tried(prompts)]
        except Exception as e:  # the failure of a prompt is a row
            if len(prompts) == 1:
                return [(None, f"{type(e).__name__}: {e}"[:500])]
            return [x for p in prompts for x in self._one([p])]

    def __call__(self, prompts: list[str]) -> list[tuple[str | None, str | None]]:
        """An answer or an error for each prompt, in order."""
        parts = [prompts[k : k + self.batch] for k in range(0, len(prompts), self.batch)]
        with ThreadPoolExecutor(self.concurrency) as pool:
            return [x for part in pool.map(self._one, parts) for x in part]


#: Rows of an Arrow batch of prompts.
PROMPT_ROWS = 256


def answers(prompts: DataFrame, ask: Callable, path: str, prompt_col: str = "prompt", **options) -> DataFrame:
    """``prompt_hash, answer, ask_error`` from ``ask`` (a function of a pandas series of prompts).

    Only prompts without an answer at ``path`` are asked; those that failed are
    asked again by the next call. ``options`` are those of ``Caller``;
    ``per_second`` is for a task. If two jobs asked one prompt at once, its least
    answer counts for both. A null prompt has no answer.
    """
    spark = prompts.sparkSession
    new = prompts.select(T.hash16(F.col(prompt_col)).alias("prompt_hash"), F.col(prompt_col).alias("prompt")).where("prompt is not null").dropDuplicates(["prompt_hash"])
    try:
        new = new.join(spark.read.schema(_ANSWERS).parquet(path).where("answer is not null").select("prompt_hash").distinct(), "prompt_hash", "left_anti")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise

    def run(batches):
        call = Caller(ask, **options)
        for b in batches:
            for k in range(0, b.num_rows, PROMPT_ROWS):
                part = b.slice(k, PROMPT_ROWS)
                said = call(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([x[k] for x in said], pa.string()) for k in (0, 1))], ["prompt_hash", "answer", "ask_error"])

    new.mapInArrow(run, _ANSWERS).write.mode("append").parquet(path)
    kept = spark.read.schema(_ANSWERS).parquet(path).groupBy("prompt_hash").agg(F.min("answer").alias("answer"), F.max("ask_error").alias("ask_error"))
    return kept.withColumn("ask_error", F.when(F.col("answer").isNull(), F.col("ask_error")))


_ANSWERS = "prompt_hash string, answer string, ask_error string"


def expansion(chunks: DataFrame, having: Column, ask: Callable, path: str, seeds: int = 8, keep: int = 10, **options) -> DataFrame:
    """Chunks without a keyword that a provider names for their document (``chunks`` with ``place``), the first ``keep`` known ones.

    Documents without a keyword, or whose seeds are all of their chunks, aren't
    asked about. A provider that fails, or an answer that is no such record,
    gives no expansion and no error.
    """
    asked = retrieval.prompt_parts(chunks, having).join(retrieval.skips_expansion(chunks, having, seeds).where("not skip"), "doc_id")
    told = asked.select("doc_id", schemas.prompt("candidates", prompts_of.expansion(F.slice("seeds", 1, seeds), F.col("others"))).alias("prompt"))
    said = told.withColumn("prompt_hash", T.hash16(F.col("prompt"))).join(answers(told, ask, path, **options), "prompt_hash")
    record = C.parsed(said, schemas.record_type("candidates").simpleString(), schemas.keys("candidates"))
    good = record.where((F.size("errors") == 0) & (F.size(schemas.limits("candidates", F.col("value"))) == 0))
    return retrieval.expanded(chunks.where(~having), good.select("doc_id", F.array_distinct("value.additional_chunk_ids").alias("ids")), keep)
