"""A queue of stages over a stream of documents: state by document, work by whole batches.

The state of a document says which stage it waits for and which attempt that is,
and what its input is while it waits for a timer. What is due leaves the stateful
operator as rows; a stage is a DataFrame function over all rows that are due for
it in a micro-batch. What went well goes on to the next stage at once, and what
has failed or passed the last one comes back as a stream of results. A result
that fails is due again after a doubling delay, by a timer, until its attempts
are used up. So no stage's work runs inside the state, and a slow or failing
document holds up no other.

The state is a list of documents in each of ``BUCKETS`` groups. A group is read and
written once for all of its documents in a micro-batch, and these rows are held
meanwhile: calls to the state store take much longer than what is done with a
document. So a group's list, about 150 bytes a document, is written as a whole.

Everything can be replayed: a result counts only for the version, stage and
attempt that its document waits for, the same document again changes nothing, an
older version of a document (by ``ts``, then by hash) never replaces a newer one,
and ended documents are written in a folder for each batch, which a batch that
runs again replaces. A stage may therefore be asked twice for one row, and must
give the same for it.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

#: A stage: from ``doc_id, value`` to ``doc_id, value, error`` (null where it went well).
Stage = Callable[[DataFrame], DataFrame]

#: ``ts`` is in microseconds.
MESSAGE = "doc_id long, ts long, version string, stage int, attempt int, value string, error string"
#: A result answers ``stage`` and ``attempt``; ``reached`` is the stage where it failed or after which it stands (null: the same).
RESULT = f"{MESSAGE}, reached int"
TURN = "doc_id long, kind string, ts long, version string, stage int, attempt int, value string, error string"
_STATE = "doc_id long, since long, status string, ts long, version string, stage int, attempt int, value string, error string, until long"
_FIELDS = ("status", "ts", "version", "stage", "attempt", "value", "error", "until")
#: Stage of a message that brings a document instead of a result.
DOCUMENT = -1
_ASKED = ("doc_id", "ts", "version", "stage", "attempt")
#: Groups of documents whose states are entered together.
BUCKETS = 8192
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Progress(StatefulProcessor):
    """Where a document stands: ``due`` (asked for), ``waiting`` (for its timer), ``done`` or ``failed``."""

    def __init__(self, n_stages: int, tries: int, delay_ms: int, remember_ms: int | None):
        self.n_stages, self.tries, self.delay_ms, self.remember_ms = n_stages, tries, delay_ms, remember_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getListState("progress", _STATE, self.remember_ms)

    def _read(self) -> None:
        """The documents of a group: when each was changed, and where it stands."""
        rows = [tuple(r) for r in self.state.get()]
        self.since = {r[0]: r[1] for r in rows}
        self.known = {r[0]: dict(zip(_FIELDS, r[2:], strict=True)) for r in rows}

    def _write(self, now: int) -> None:
        """Ended documents are kept as long as they shall be known."""
        old = {i for i, at in self.since.items() if self.remember_ms is not None and at + self.remember_ms <= now and self.known[i]["status"] in ("done", "failed")}
        self.state.put([(i, self.since[i], *s.values()) for i, s in self.known.items() if i not in old])

    def _keep(self, doc_id: int, s: dict, now: int) -> None:
        """Inputs are kept only while a document waits: what is due has left with its input, and a failed result brings it back."""
        self.since[doc_id] = now
        self.known[doc_id] = s if s["status"] == "waiting" else s | {"value": None}

    def _turn(self, doc_id: int, s: dict, now: int) -> Row:
        self._keep(doc_id, s, now)
        return Row(doc_id=doc_id, kind=s["status"], **{k: s[k] for k in ("ts", "version", "stage", "attempt", "value", "error")})

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        of: dict[int, list[Row]] = {}
        for r in rows:
            of.setdefault(r.doc_id, []).append(r)
        now, self.timers, self.changed = timerValues.getCurrentProcessingTimeInMs(), set(), False
        self._read()
        out = [t for doc_id, own in of.items() if (t := self._input(doc_id, own, now))]
        if self.changed:
            self._write(now)
        for until in self.timers:
            self.handle.registerTimer(until)
        yield from out

    def _input(self, doc_id: int, rows: list[Row], now: int) -> Row | None:
        s = self.known.get(doc_id)
        s = dict(s) if s else None
        changed = touched = False
        for r in rows:
            if r.stage == DOCUMENT:
                version = hashlib.sha256((r.value or "").encode("utf-8", "surrogatepass")).hexdigest()
                if s is None or (r.ts, version) > (s["ts"], s["version"]):
                    if s and version == s["version"]:  # seen again: it is as new as its newest row
                        s["ts"], touched = r.ts, True
                    else:
                        s = {"status": "due", "ts": r.ts, "version": version, "stage": 0, "attempt": 1, "value": r.value, "error": None, "until": None}
                        changed = True
            elif s and s["status"] == "due" and (r.version, r.stage, r.attempt) == (s["version"], s["stage"], s["attempt"]):
                changed = True
                reached = r.stage if r.reached is None else r.reached
                if r.error is None:
                    s |= {"stage": reached + 1, "attempt": 1, "value": r.value}
                    s["status"] = "due" if s["stage"] < self.n_stages else "done"
                else:
                    attempt = s["attempt"] if reached == s["stage"] else 1
                    s |= {"stage": reached, "attempt": attempt, "value": r.value, "error": r.error}
                    if attempt < self.tries:
                        s |= {"status": "waiting", "until": now + self.delay_ms * 2 ** (attempt - 1)}
                    else:
                        s["status"] = "failed"
        self.changed |= changed or touched
        if not changed:
            if touched:
                self._keep(doc_id, s, now)
            return None
        if s["status"] == "waiting":
            self.timers.add(s["until"])
            self._keep(doc_id, s, now)
            return None
        if s["status"] != "failed":
            s["error"] = None
        return self._turn(doc_id, s, now)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        self._read()
        over = [(i, s) for i, s in self.known.items() if s["status"] == "waiting" and s["until"] <= now]
        out = [self._turn(i, s | {"status": "due", "attempt": s["attempt"] + 1, "error": None, "until": None}, now) for i, s in over]
        if out:
            self._write(now)
        yield from out

    def close(self) -> None:
        pass


def turns(messages: DataFrame, n_stages: int, tries: int = 3, delay_ms: int = 1000, remember_ms: int | None = None) -> DataFrame:
    """What is due for a stage, and what has ended, from a stream of ``MESSAGE`` rows.

    ``remember_ms`` is how long an ended document is known; one that comes again
    later runs again, to the same end. Rows without a ``doc_id`` or ``ts`` are
    left out.
    """
    rows = messages.where("doc_id is not null and ts is not null")
    if "reached" not in rows.columns:
        rows = rows.withColumn("reached", F.lit(None).cast("int"))
    return rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS))).groupBy("bucket").transformWithState(Progress(n_stages, tries, delay_ms, remember_ms), TURN, "append", "processingTime")


def _answered(due: DataFrame, k: int, stage: Stage) -> DataFrame:
    """A result of the k-th stage for each due row; one that the stage leaves out has failed. Of failed ones the value is the input."""
    said = stage(due.select("doc_id", "value")).select("doc_id", "value", "error").groupBy("doc_id").agg(F.min(F.struct("error", "value")).alias("r"))
    out = due.withColumnRenamed("value", "input").join(said, "doc_id", "left")
    error = F.when(F.col("r").isNull(), "no result").otherwise(F.col("r.error"))
    return out.select(*_ASKED, F.when(error.isNull(), F.col("r.value")).otherwise(F.col("input")).alias("value"), error.alias("error"), F.lit(k).alias("reached"))


def start(documents: DataFrame, stages: Sequence[tuple[str, Stage]], path: str, tries: int = 3, delay_ms: int = 1000, remember_ms: int | None = None, every: str = "1 second") -> StreamingQuery:
    """Run ``stages`` over a stream of ``documents`` (``doc_id, ts, value``; a null value is an empty text), with all its files under ``path``.

    A stage whose job fails has failed for all rows that were due, and is tried
    again as they are. Started again on the same ``path``, it goes on where it was.
    """
    spark = documents.sparkSession
    results = f"{path}/results"
    spark.createDataFrame([], RESULT).write.mode("append").parquet(results)
    new = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"), F.lit(None).cast("string").alias("version"),
                           F.lit(DOCUMENT).alias("stage"), F.lit(0).alias("attempt"), F.coalesce(F.col("value").cast("string"), F.lit("")).alias("value"), F.lit(None).cast("string").alias("error"), F.lit(None).cast("int").alias("reached"))
    back = spark.readStream.schema(RESULT).parquet(results)

    def work(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        here = f"{path}/turns/batch={batch_id}"
        batch.write.mode("overwrite").parquet(here)  # the state is asked once, whatever follows
        rows = session.read.schema(TURN).parquet(here)
        kinds = {tuple(r) for r in rows.select("kind", "stage").distinct().collect()}  # at most three for each stage
        carried = None  # what has passed the stage before
        for k, (name, stage) in enumerate(stages):
            due = carried
            if ("due", k) in kinds:
                own = rows.where((F.col("kind") == "due") & (F.col("stage") == k)).select(*_ASKED, "value")
                due = own if carried is None else own.unionByName(carried)
            carried = None
            if due is None:
                continue
            last = k == len(stages) - 1
            step = f"{path}/steps/stage={k}"  # of this batch alone
            try:
                _answered(due, k, stage).write.mode("append" if last else "overwrite").parquet(results if last else step)
            except Exception as e:  # the stage is asked again for these rows
                told = f"{name}: {type(e).__name__}: {e}"[:500]
                due.select(*_ASKED, "value", F.lit(told).alias("error"), F.lit(k).alias("reached")).write.mode("append").parquet(results)
                continue
            if not last:
                said = session.read.schema(RESULT).parquet(step)
                said.where("error is not null").write.mode("append").parquet(results)
                well = said.where("error is null").select(*_ASKED, "value")
                carried = well if well.limit(1).count() else None
        if kinds - {("due", k) for k in range(len(stages))}:
            rows.where("kind <> 'due'").write.mode("overwrite").parquet(f"{path}/ended/batch={batch_id}")

    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return (turns(new.unionByName(back), len(stages), tries, delay_ms, remember_ms).writeStream.foreachBatch(work)
                .option("checkpointLocation", f"{path}/progress").trigger(processingTime=every).start())
    finally:
        spark.conf.set(PROVIDER, before)


def ended(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """``doc_id, status, stage, attempts, value, error``: the end of each document's newest version; ``stage`` names where it failed."""
    try:
        rows = spark.read.schema(f"{TURN}, batch long").parquet(f"{path}/ended")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        rows = spark.createDataFrame([], f"{TURN}, batch long")
    last = rows.groupBy("doc_id").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "doc_id"]), F.struct("ts", "version", "batch")).alias("r"))
    failed = F.col("r.kind") == "failed"
    stage = F.get(F.array(*map(F.lit, names)), F.col("r.stage"))
    return last.select("doc_id", F.col("r.kind").alias("status"), F.when(failed, stage).alias("stage"), F.col("r.attempt").alias("attempts"), F.when(~failed, F.col("r.value")).alias("value"), "r.error")


def wait(query: StreamingQuery, done: Callable[[], bool], limit: float = 600.0, every: float = 1.0) -> None:
    """Let ``query`` run until ``done``; its failure, or no end within ``limit`` seconds, is an error."""
    until = time.monotonic() + limit
    while not done():
        if query.exception() or not query.isActive:
            raise RuntimeError(f"the stages have stopped: {query.exception()}")
        if time.monotonic() > until:
            raise TimeoutError(f"the stages haven't ended within {limit:g} s")
        time.sleep(every)


def in_batch(documents: DataFrame, stages: Sequence[tuple[str, Stage]]) -> DataFrame:
    """What a run over the stream comes to for stages that don't fail by chance, without a stream: the rows of ``ended`` but ``attempts``."""
    rows = documents.where("doc_id is not null and ts is not null").withColumn("value", F.coalesce("value", F.lit(""))).withColumn("version", F.sha2("value", 256))
    rows = rows.groupBy("doc_id").agg(F.max_by(F.struct("value"), F.struct("ts", "version")).alias("r"))
    rows = rows.select("doc_id", "r.value", F.lit(None).cast("string").alias("error"), F.lit(None).cast("string").alias("stage"))
    for name, stage in stages:
        said = stage(rows.where("error is null").select("doc_id", "value")).select("doc_id", F.struct("value", "error").alias("_r"))
        rows = rows.join(said, "doc_id", "left")
        now = F.when(F.col("_r").isNull(), "no result").otherwise(F.col("_r.error"))
        rows = rows.select("doc_id", F.when(F.col("error").isNull(), F.col("_r.value")).alias("value"), F.coalesce("error", now).alias("error"), F.when(F.col("error").isNotNull(), F.col("stage")).when(now.isNotNull(), name).alias("stage"))
    failed = F.col("error").isNotNull()
    return rows.select("doc_id", F.when(failed, "failed").otherwise("done").alias("status"), "stage", F.when(~failed, F.col("value")).alias("value"), "error")
