"""Providers that fail, are slow or answer wrongly: retries, rows of failure, expansion, limits of records."""

import json
import time

import pandas as pd
from pyspark.sql import functions as F

from quillfold.functions import schemas
from quillfold.operators import providers
from quillfold.operators.providers import Caller


def test_a_provider_that_fails_twice_succeeds():
    seen = []

    def ask(s: pd.Series) -> pd.Series:
        seen.append(time.monotonic())
        if len(seen) < 3:
            raise ConnectionError("busy")
        return s.str.upper()

    assert Caller(ask, delay=0.05, concurrency=1)(["a", "b"]) == [("A", None), ("B", None)]
    assert len(seen) == 3 and seen[1] - seen[0] >= 0.05 and seen[2] - seen[1] >= 0.1


def test_one_bad_prompt_costs_no_other():
    def ask(s: pd.Series) -> pd.Series:
        if (s == "bad").any():
            raise ValueError("no " + "x" * 900)
        return s.where(s != "null", None)

    got = Caller(ask, delay=0, batch=4)([*"abc", "bad", *"de", "null"])
    assert [x[0] for x in got] == ["a", "b", "c", None, "d", "e", None]
    assert got[3][1].startswith("ValueError: no x") and len(got[3][1]) == 500 and got[6] == (None, "no answer")
    assert Caller(lambda s: s[:1], delay=0)(["a", "b"]) == [("a", None), ("b", None)]  # an answer is missing: asked one by one
    assert Caller(ask)([]) == []


def test_rate_and_concurrency():
    began = time.monotonic()
    Caller(lambda s: s, batch=1, concurrency=8, per_second=50)([str(k) for k in range(20)])
    assert time.monotonic() - began >= 19 / 50
    began = time.monotonic()
    Caller(lambda s: (time.sleep(0.2), s)[1], batch=1, concurrency=8)([str(k) for k in range(8)])
    assert time.monotonic() - began < 1.2


def test_failed_prompts_are_asked_again(spark, tmp_path):
    def down(s: pd.Series) -> pd.Series:
        raise TimeoutError("down")

    df = spark.createDataFrame([("p",), ("p",), ("q",), (None,)], "prompt string")
    path = str(tmp_path / "answers")
    first = providers.answers(df, down, path, delay=0)
    assert sorted((r.answer, r.ask_error) for r in first.collect()) == [(None, "TimeoutError: down")] * 2
    assert sorted((r.answer, r.ask_error) for r in providers.answers(df, lambda s: s.str.upper(), path).collect()) == [("P", None), ("Q", None)]
    # a job that asked at the same time has left another answer: still one row for each prompt
    spark.read.parquet(path).where("answer is not null").withColumn("answer", F.lit("Z")).write.mode("append").parquet(path)
    assert sorted(r.answer for r in providers.answers(df, down, path, delay=0).collect()) == ["P", "Q"]


def test_expansion(spark, tmp_path):
    rows = [(d, k, f"{d}_{k}", 1, "key" if k < n else f"other {what}") for d, n, what in ((1, 2, "fine"), (2, 0, "none"), (3, 5, "all"), (4, 1, "fails"), (5, 1, "odd")) for k in range(5)]
    chunks = spark.createDataFrame(rows, "doc_id long, chunk_index int, chunk_id string, page int, text string")

    def ask(s: pd.Series) -> pd.Series:
        def one(p):
            if "other fails" in p:
                raise ConnectionError("down")
            return "no json" if "other odd" in p else json.dumps({"additional_chunk_ids": ["1_4", "zz", "1_0", "1_3", "1_4"], "reasoning": "r"})

        return s.map(one)

    got = providers.expansion(chunks, F.col("text") == "key", ask, str(tmp_path / "a"), delay=0)
    assert sorted((r.doc_id, r.chunk_id, r.place) for r in got.collect()) == [(1, "1_3", 2), (1, "1_4", 1)]


CALL = {"asset_class_category": "EQ_DM", "sub_asset_class": "EQ_US", "call": "OVERWEIGHT", "conviction": None, "time_horizon": None, "rationale_bullets": ["a"], "key_indicators": [], "key_risks": [],
        "citations": [{"chunk_id": "c", "block_ids": [], "page": 1, "text_span": "t"}], "confidence": 0.5, "needs_analyst_review": False, "review_reason": None}
RECORDS = {
    "calls": {"allocation_calls": [CALL], "overall_sentiment": "NEUTRAL", "sentiment_rationale": ["x"], "sentiment_citations": CALL["citations"], "sentiment_confidence": 1},
    "candidates": {"additional_chunk_ids": [], "reasoning": "r"},
    "tooltips": {"tooltips": [{"sub_asset_class": "EQ_US", "tooltip_text": "t" * 150}]},
}


def test_each_limit_passes_and_fails(spark):
    call = lambda **new: {"allocation_calls": [CALL, {**CALL, **new}]}
    cases = {
        "calls": [({}, ""), ({"allocation_calls": []}, ""), ({"allocation_calls": None}, "allocation_calls"), (call(sub_asset_class=None), "sub_asset_class"), (call(call="BUY"), "call"), (call(conviction="VERY"), "conviction"),
                  (call(rationale_bullets=list("abcd")), ""), (call(rationale_bullets=[]), "rationale_bullets"), (call(rationale_bullets=list("abcde")), "rationale_bullets"), (call(key_risks=list("abcd")), "key_risks"),
                  (call(citations=[]), "citations"), (call(citations=CALL["citations"] * 4), "citations"), (call(confidence=1.1), "confidence"), (call(confidence=None), "confidence"), ({"overall_sentiment": "GOOD"}, "overall_sentiment"),
                  ({"sentiment_rationale": []}, "sentiment_rationale"), ({"sentiment_citations": CALL["citations"] * 4}, "sentiment_citations"), ({"sentiment_confidence": -0.1}, "sentiment_confidence")],
        "candidates": [({}, ""), ({"reasoning": None}, "reasoning")],
        "tooltips": [({}, ""), ({"tooltips": []}, "tooltips"), ({"tooltips": [{"sub_asset_class": "EQ_US", "tooltip_text": "t" * 151}]}, "tooltip_text"), ({"tooltips": [{"sub_asset_class": None, "tooltip_text": "t"}]}, "sub_asset_class")],
    }
    for stage, some in cases.items():
        df = spark.createDataFrame([(k, json.dumps({**RECORDS[stage], **change})) for k, (change, _) in enumerate(some)], "k int, answer string")
        value = F.from_json("answer", schemas.record_type(stage).simpleString())
        got = {r.k: r.f for r in df.withColumn("value", value).select("k", F.array_join(schemas.limits(stage, F.col("value")), ",").alias("f")).collect()}
        assert [got[k] for k in range(len(some))] == [f for _, f in some]
