"""A whole run with providers that need no service."""

from pyspark.sql import functions as F

from quillfold.operators import run as R
from quillfold.sources import synth
from quillfold.sources.registry_tables import open_registry

LINE = "We are overweight US equities and underweight gold as growth holds up while rate cuts come, says Acme Capital. "


def test_run(spark, tmp_path):
    texts = ["steady", "nothing", "broken", "astray", "steady", ""]
    docs = spark.createDataFrame([(k, "\n".join(f"{LINE * 3}{w} {j}" for j in range(24)) if w else "") for k, w in enumerate(texts)], "doc_id long, text string")
    path = str(tmp_path / "registry")
    got = R.run(docs, synth.PROVIDERS, path, F.to_date(F.lit("2025-08-01")))
    rows = {r.doc_id: r for r in got.outcomes.collect()}
    assert {i: r.status for i, r in rows.items()} == {0: "completed", 1: "failed", 2: "failed", 3: "failed", 4: "duplicate", 5: "failed"}
    assert rows[1].error == "ExtractionError: no asset class tag (after stage s8_tooltips)" and rows[2].error_type == "ValidationError" and "Mismatched taxonomy: GOLD belongs to ALT_COMMODITIES, not EQ_DM" in rows[3].error
    assert rows[4].document_id == 0 and rows[0].n_calls == 2 and 0.7 < rows[0].score <= 1 and rows[0].band in ("MEDIUM", "HIGH")
    made = {r.sub_asset_class: r for r in got.calls.collect()}
    assert made["EQ_US"].n_mentions == 2 and made["EQ_US"].review_reason and made["EQ_US"].tooltip_text == "tip 0" and made["GOLD"].tooltip_text == "tip 1"
    assert {(r.tag_type, r.value) for r in got.tags.collect()} == {("asset_class", "EQ_DM"), ("asset_class", "ALT_COMMODITIES"), ("region", "us"), ("theme", "growth"), ("theme", "rate_cuts"), ("macro_regime", "soft_landing")}
    registry = open_registry(spark, path)
    kept = {t: registry.read(t).count() for t in ("documents", "allocation_calls", "document_tags", "summaries", "pipeline_runs")}
    assert kept == {"documents": 5, "allocation_calls": 2, "document_tags": 6, "summaries": 1, "pipeline_runs": 5}
    assert registry.execute("select count(*) as n from {documents} d join {allocation_calls} c on c.doc_id = d.doc_id where d.status = 'completed'").first().n == 2
