"""Queries of files, the registry, synthetic documents and model records."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import Settings
from ..functions import schemas
from ..operators import calls as C
from ..operators import exports
from ..sources import store, synth
from ..sources.pages import page_source, register
from ..sources.registry_tables import Registry, open_registry, scratch
from .queries import BLOCKS, query
from .registry import Tables


@query("src_pdf", f"with {BLOCKS} select doc_id, page, idx, sha256(text) as digest from blocks where page <= 3")
def src_pdf(spark, sf_dir):
    """Each document as a file; its first pages, of five lines each, through the data source."""

    def lines(content, pages):
        return ({"page": k // 5 + 1, "idx": k % 5, "kind": "text", "text": x} for k, x in enumerate(content.decode().split("\n")) if k // 5 + 1 in pages)

    path = scratch(spark, "files")
    docs = Tables(spark, sf_dir).documents
    exports.write_report_pack(docs.select(F.concat(F.col("doc_id").cast("string"), F.lit(".pdf")).alias("name"), F.col("text").alias("html")), path)
    register(spark, page_source("text_pages", lines))
    rows = spark.read.format("text_pages").option("path", path).option("pattern", r"\.pdf$").load().where("page <= 3 and error is null")
    return rows.select(F.regexp_extract("path", r"([0-9]+)\.pdf$", 1).cast("long").alias("doc_id"), "page", "idx", F.sha2("text", 256).alias("digest"))


@query("src_json_docs", "select doc_id, lang, n_chars from documents")
def src_json_docs(spark, sf_dir):
    path = scratch(spark, "records")
    Tables(spark, sf_dir).documents.select("doc_id", "lang", "n_chars").write.json(path)
    return spark.read.schema("doc_id long, lang string, n_chars long").json(path)


@query("snk_persist", "select o_orderkey as doc_id, case when o_orderkey % 3 = 0 then 'published' else o_orderstatus end as status from orders")
def snk_persist(spark, sf_dir):
    rows = Tables(spark, sf_dir).orders.selectExpr("o_orderkey as doc_id", "o_orderstatus as status")
    registry = Registry(spark, scratch(spark, "registry"), 4)
    registry.save("documents", rows)
    registry.save("documents", rows.where("doc_id % 3 = 0").withColumn("status", F.lit("published")))
    return registry.read("documents")


@query("snk_registry", """select c_mktsegment as manager_id, count(*) as n_documents, count(distinct b) as n_blocks, 0 as n_runs from customer, lateral (select unnest([0, 1]) as b) group by 1""")
def snk_registry(spark, sf_dir):
    registry = open_registry(spark, scratch(spark, "registry"), 4)
    docs = Tables(spark, sf_dir).customer.selectExpr("c_custkey as doc_id", "c_mktsegment as manager_id")
    blocks = docs.select("doc_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("b"))
    registry.publish({
        "documents": docs, "managers": docs.select("manager_id").distinct().withColumn("name", F.initcap(F.lower("manager_id"))),
        "evidence_blocks": blocks.select("doc_id", F.col("b").cast("string").alias("chunk_id"))})
    return registry.execute("""
        select m.manager_id, count(*) as n_documents, count(distinct b.chunk_id) as n_blocks, cast(count(r.run_id) as int) as n_runs
        from {documents} d join {managers} m on d.manager_id = m.manager_id join {evidence_blocks} b on b.doc_id = d.doc_id left join {pipeline_runs} r on r.doc_id = d.doc_id group by m.manager_id""")


@query("src_db_open", "select o_orderkey as doc_id, o_orderstatus as status from orders")
def src_db_open(spark, sf_dir):
    path = scratch(spark, "registry")
    open_registry(spark, path, 4).save("documents", Tables(spark, sf_dir).orders.selectExpr("o_orderkey as doc_id", "o_orderstatus as status"))
    return open_registry(spark, path).read("documents")


@query("src_settings", "select 'registry' as registry_path, 'blobs' as blob_path, 'DEBUG' as log_level, 'offline' as embedding_provider")
def src_settings(spark, sf_dir):
    s = Settings.read({"LOG_LEVEL": " debug "})
    return spark.createDataFrame([(s.registry_path, s.blob_path, s.log_level, s.embedding_provider)], "registry_path string, blob_path string, log_level string, embedding_provider string")


@query("snk_sections_print", "select doc_id, 'lang: ' || lang || chr(10) || 'source: ' || source || chr(10) || 'n_chars: ' || n_chars as shown from documents")
def snk_sections_print(spark, sf_dir):
    return exports.printed(Tables(spark, sf_dir).documents, ["lang", "source", "n_chars"])


_LINE = "(" + "[" + ", ".join("[" + ", ".join("'" + (h + "\n" + t.format(*v)).replace("'", "''") + "'" for h, t in synth.LINES) + "]" for v in synth.VARIANTS) + "])[d % 5 + 1][p]"


@query("src_synth", f"select d as doc_id, p as page, {_LINE} || chr(10) || 'Page ' || p || '.' as text, 3 as n_calls, 0 as n_faults from range(0, (select count(*) from region)) a(d), range(1, 7) b(p)")
def src_synth(spark, sf_dir):
    pages = synth.documents(spark, Tables(spark, sf_dir).region.count())
    chunks = synth.index(pages)
    given = chunks.groupBy("doc_id").agg(F.collect_list("chunk_id").alias("allowed"), F.array_join(F.collect_list("text"), " ").alias("source"))
    said = C.guarded(C.parsed(synth.answers(pages)).join(given, "doc_id").withColumn("output", F.col("answer")))
    faults = said.select("doc_id", F.size("value.allocation_calls").alias("n_calls"), (F.size("errors") + F.when(F.col("fault").isNotNull(), 1).otherwise(0)).alias("n_faults"))
    return pages.select("doc_id", F.col("page").cast("long").alias("page"), "text").join(faults, "doc_id")


@query("fn_halluc_quote", "select doc_id, case when doc_id % 2 = 0 then '' else regexp_replace(text, '[^a-z ]', '', 'g') end as quotes from documents where len(regexp_replace(text, '[^a-z ]', '', 'g')) >= 60")
def fn_halluc_quote(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select("doc_id", F.regexp_replace("text", "[^a-z ]", "").alias("t")).where("length(t) >= 60")
    said = F.concat(F.lit('{"why": "as \\"'), F.col("t"), F.lit('\\" says"}'))
    rows = d.select("doc_id", said.alias("output"), F.when(F.col("doc_id") % 2 == 0, F.col("t")).otherwise("").alias("source"))
    return C.llm_faults(rows).select("doc_id", F.array_join("quotes", "|").alias("quotes"))


@query("fn_extract_nested", "select l_orderkey as doc_id, count(*) + 1 as n_citations, count(distinct l_partkey) + 1 as n_chunks from lineitem group by 1")
def fn_extract_nested(spark, sf_dir):
    cites = F.array(F.struct(F.col("l_partkey").cast("string").alias("chunk_id"), F.col("l_linenumber").alias("page")))
    nested = Tables(spark, sf_dir).lineitem.groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.collect_list(F.struct("l_linenumber", cites.alias("citations"))).alias("allocation_calls"))
    mood = F.array(F.struct(F.lit("mood").alias("chunk_id"), F.lit(1).alias("page")))
    flat = C.citations_of(F.struct(F.col("allocation_calls"), mood.alias("sentiment_citations")))
    return nested.select("doc_id", flat.alias("c")).select("doc_id", F.size("c").cast("long").alias("n_citations"), F.size(F.array_distinct(F.transform("c", lambda c: c.chunk_id))).cast("long").alias("n_chunks"))


@query("fn_llm_schemas", f"select doc_id, sha256(text) as context, '{','.join(schemas.TASKS)}' as stages from documents")
def fn_llm_schemas(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    text = F.col("text")
    asked = lambda p, stage: F.endswith(p, F.concat(F.lit("# Document\n"), text)) & F.contains(p, F.lit(schemas.TASKS[stage][0])) & F.contains(p, F.lit(f"- {schemas.keys(stage)[0]}: "))
    stages = F.array_join(F.array_compact(F.array(*[F.when(asked(schemas.prompt(s, text), s), s) for s in schemas.TASKS])), ",")
    said = F.substring_index(schemas.prompt("calls", text), "# Document\n", -1)
    return d.select("doc_id", F.sha2(F.when(F.contains(text, F.lit("# Document\n")), text).otherwise(said), 256).alias("context"), stages.alias("stages"))


@query("fn_llm_records", "select event_id, case event_id % 3 when 0 then '' when 1 then 'theme_tags' else 'unknown key more' end as faults from events")
def fn_llm_records(spark, sf_dir):
    tail = '"risk_tags": [], "macro_regime_tags": ["goldilocks"], "novel_themes": ["x"], "confidence": 0.5'
    k = F.col("event_id") % 3
    text = F.when(k == 0, '{"theme_tags": ["growth"], ' + tail + "}").when(k == 1, '{"theme_tags": ["bogus"], ' + tail + "}").otherwise('{"theme_tags": [], "more": 1, ' + tail + "}")
    rows = C.parsed(Tables(spark, sf_dir).events.select("event_id", text.alias("answer")), schemas.record_type("tags").simpleString(), schemas.keys("tags"))
    return rows.select("event_id", F.array_join(F.concat("errors", schemas.limits("tags", F.col("value"))), ";").alias("faults"))
