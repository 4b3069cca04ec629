"""The queue of stages: retries by timers, replayed and late input, restart, stages that fail as jobs."""

import datetime as dt
import os

from pyspark.sql import functions as F

from quillfold.streaming import stages as S


def doc(i, hour, value):
    return (i, dt.datetime(2024, 1, 1, hour), value)


def feed(spark, path, rows):
    spark.createDataFrame(rows, "doc_id long, ts timestamp, value string").coalesce(1).write.mode("append").parquet(path)


def source(spark, path):
    return spark.readStream.schema("doc_id long, ts timestamp, value string").parquet(path)


def upper(rows):
    return rows.select("doc_id", F.upper("value").alias("value"), F.when(F.col("value").contains("bad"), "bad text").alias("error"))


def marked(rows):
    return rows.where("value not like '%LOST%'").select("doc_id", F.concat(F.coalesce("value", F.lit("")), F.lit("!")).alias("value"), F.lit(None).cast("string").alias("error"))


def test_replayed_and_late_input_give_the_batch_rows(spark, tmp_path):
    src, path = str(tmp_path / "in"), str(tmp_path / "run")
    tried = str(tmp_path / "tried")
    os.mkdir(tried)

    def flaky(rows):
        """Fails as a job the first time it is asked for document 3 alone or with others."""
        if rows.where("doc_id = 3").count() and not os.path.exists(f"{tried}/once"):
            open(f"{tried}/once", "w").close()
            raise ConnectionError("busy")
        return upper(rows)

    stages = [("upper", flaky), ("mark", marked)]
    first = [doc(1, 1, "a"), doc(2, 1, "bad"), doc(3, 1, "c"), doc(4, 1, "lost"), doc(5, 5, "new"), (None, dt.datetime(2024, 1, 1), "x"), doc(6, 1, None)]
    feed(spark, src, first)
    q = S.start(source(spark, src), stages, path, tries=3, delay_ms=200, every="0 seconds")
    try:
        S.wait(q, lambda: S.ended(spark, path, ["upper", "mark"]).count() == 6, 120)
    finally:
        q.stop()
    got = {r.doc_id: tuple(r)[1:] for r in S.ended(spark, path, ["upper", "mark"]).collect()}
    assert got[1][0] == "done" and got[1][3] == "A!"
    assert got[2] == ("failed", "upper", 3, None, "bad text")  # tried three times
    assert got[4] == ("failed", "mark", 3, None, "no result")
    assert got[3][3] == "C!" and got[6][3] == "!"

    # started again: replays and an older version change nothing, a newer one runs
    later = [*first, doc(5, 2, "old"), doc(1, 9, "newer"), doc(6, 8, None)]
    feed(spark, src, later)
    q = S.start(source(spark, src), stages, path, tries=3, delay_ms=200, every="0 seconds")
    try:
        S.wait(q, lambda: S.ended(spark, path, ["upper", "mark"]).where("doc_id = 1 and value = 'NEWER!'").count() == 1, 120)
    finally:
        q.stop()
    rows = S.ended(spark, path, ["upper", "mark"]).drop("attempts")
    want = S.in_batch(spark.createDataFrame(first + later, "doc_id long, ts timestamp, value string"), [("upper", upper), ("mark", marked)])
    assert sorted(map(str, rows.collect())) == sorted(map(str, want.collect()))
    written = spark.read.schema(f"{S.TURN}, batch long").parquet(f"{path}/ended")
    assert written.count() == 7  # six documents, and the newer version of one


def test_a_result_for_another_version_or_attempt_counts_for_nothing(spark, tmp_path):
    src, path = str(tmp_path / "in"), str(tmp_path / "run")
    feed(spark, src, [doc(1, 1, "a")])
    stale = [(1, 5, "no such version", 0, 1, "wrong", None), (1, 5, None, 0, 7, "wrong", None)]
    spark.createDataFrame(stale, S.MESSAGE).write.parquet(f"{path}/results")
    q = S.start(source(spark, src), [("upper", upper)], path, every="0 seconds")
    try:
        S.wait(q, lambda: S.ended(spark, path, ["upper"]).count() == 1, 60)
    finally:
        q.stop()
    assert tuple(S.ended(spark, path, ["upper"]).first()) == (1, "done", None, 1, "A", None)
    assert S.ended(spark, str(tmp_path / "nowhere"), ["upper"]).count() == 0


def test_documents_of_one_group_pass_all_stages_in_one_round(spark, tmp_path, monkeypatch):
    """What goes well comes back as one result; retries of documents that share a group's state are told apart."""
    monkeypatch.setattr(S, "BUCKETS", 2, raising=False)
    src, path = str(tmp_path / "in"), str(tmp_path / "run")
    texts = ["a", "bad", "c", "lost", "e", "bad too", "g", "lost too"]
    feed(spark, src, [doc(i, 1, t) for i, t in enumerate(texts)])
    q = S.start(source(spark, src), [("upper", upper), ("mark", marked)], path, tries=2, delay_ms=200, every="0 seconds")
    try:
        S.wait(q, lambda: S.ended(spark, path, ["upper", "mark"]).count() == len(texts), 120)
    finally:
        q.stop()
    got = {r.doc_id: tuple(r)[1:5] for r in S.ended(spark, path, ["upper", "mark"]).collect()}
    for i, t in enumerate(texts):
        assert got[i] == (("failed", "upper", 2, None) if "bad" in t else ("failed", "mark", 2, None) if "lost" in t else ("done", None, 1, t.upper() + "!"))
    back = {r.doc_id: r["count"] for r in spark.read.schema(S.MESSAGE).parquet(f"{path}/results").groupBy("doc_id").count().collect()}
    assert back == {i: 2 if "bad" in t or "lost" in t else 1 for i, t in enumerate(texts)}
