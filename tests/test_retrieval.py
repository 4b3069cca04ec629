"""Passages by vectors and the queries of a run."""

from pyspark.sql import functions as F

from quillfold.operators import providers, retrieval
from quillfold.operators import run as R


def test_passages_are_the_nearest_of_their_own_document(spark):
    texts = ["gold rises", "bonds fall today", "gold gold", "weather report"]
    chunks = spark.createDataFrame([(d, f"{d}_{k}", 1, t) for d in (1, 2) for k, t in enumerate(texts if d == 1 else texts[1:2])], "doc_id long, chunk_id string, page int, text string")
    queries = spark.createDataFrame([(1, 0, "gold"), (1, 1, "bonds fall"), (2, 0, "gold"), (3, 0, "gold"), (1, 2, None)], "doc_id long, query_order int, query string")
    hits = {(r.doc_id, r.query_order, r["rank"]): r.chunk_id for r in retrieval.nearest_chunks(chunks, queries, providers.hashed_embedding, 1).collect()}
    assert hits == {(1, 0, 1): "1_2", (1, 1, 1): "1_1", (2, 0, 1): "2_0"}
    got = retrieval.passages(chunks, queries, providers.hashed_embedding, 2, 2).collect()
    assert {(r.doc_id, r.place, r.chunk_id) for r in got} == {(1, 1, "1_2"), (1, 2, "1_1"), (2, 1, "2_0")} and all(r.text for r in got)


def test_queries_of_a_run(spark):
    rows = spark.sql("""select 1L as doc_id, 'OUTLOOK' as document_type, cast(null as string) as manager_name, 'NEUTRAL' as overall_sentiment, array('a', 'b', 'c') as sentiment_rationale,
      array(named_struct('sub_asset_class', 'GOLD', 'key_risks', cast(null as array<string>)), named_struct('sub_asset_class', 'GOLD', 'key_risks', array('rates'))) as calls""")
    texts = lambda df: [r.query for r in df.orderBy("query_order").collect()]
    assert texts(R.summary_queries(rows)) == ["OUTLOOK", "NEUTRAL sentiment a b", "GOLD outlook"]
    assert texts(R.tag_queries(rows)) == ["OUTLOOK macro outlook themes", "risks uncertainties rates", "growth inflation policy rates regime"]


def test_stored_rows_are_read_back_with_their_schema(spark, tmp_path):
    rows = spark.createDataFrame([(1, None)], "a int, b array<string>")
    got = R._stored(rows.where(F.col("a") > 1), str(tmp_path / "w"))
    assert got.schema == rows.schema and got.count() == 0
