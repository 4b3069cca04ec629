"""Page scores that are equal but for the rounding of doubles; vocabularies beside large tables; one index page for all."""

from pyspark.sql import functions as F

from quillfold.operators import calls, exports, triage


def test_equal_page_scores_tie(spark):
    """All counts whose scores are equal in hundredths give one double."""
    rows = [(1, 1, 1, t, u, [], b, 0, False) for u in range(1, 6) for t in range(u, 25) for b in range(8)]
    f = spark.createDataFrame(rows, "doc_id long, page int, n_pages int, keyword_total long, keyword_unique long, header_hits array<string>, bullets long, cells long, penalty boolean")
    exact = lambda r: min(300, 90 * r.keyword_unique + min(200, 15 * r.keyword_total)) + min(150, 10 * r.bullets)
    got = {(exact(r), r.score) for r in triage.page_scores(f).collect()}
    assert got == {(k, k / 100) for k, _ in got}


def test_one_index_page_for_all(spark):
    df = spark.range(2500).select(F.col("id").alias("doc_id"), F.lit("A page").alias("title"), F.lit(None).cast("string").alias("manager_name"), F.lit(None).cast("date").alias("publication_date"), F.lit(0.7).alias("score"),
        F.lit("MEDIUM").alias("band"), F.lit(None).cast("string").alias("executive_summary"), F.lit(None).cast("array<struct<asset_class_category:string,sub_asset_class:string,call:string,confidence:double,rationale_bullets:array<string>,tooltip_text:string>>").alias("calls"),
        F.array(F.struct(F.lit(1).alias("page"), F.lit("x").alias("excerpt"))).alias("citations"))
    pack = exports.report_pack(df, items=None)
    index = pack.where("name like 'index%'").select("name", F.regexp_extract_all("html", F.lit("<li><a href='([^']*)'"), 1).alias("names")).collect()
    assert [r.name for r in index] == ["index.html"] and len(index[0].names) == 2500 and index[0].names == sorted(index[0].names)
    assert exports.report_pack(df.limit(1), items=None).count() == 1


def test_taxonomy_faults_do_not_shuffle_calls(spark):
    code = lambda *codes: F.get(F.array(*map(F.lit, codes)), (F.col("id") % 2).cast("int"))
    rows = spark.range(1000).select(code("EQ_DM", "NOPE").alias("asset_class_category"), code("EQ_US", "EUR").alias("sub_asset_class"))
    plan = calls.taxonomy_faults(rows, calls.taxonomy(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
