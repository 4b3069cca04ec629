"""Queries of aggregates, windows, top-k, set operations, scalar functions, guards and streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import prompts
from ..functions import text as T
from ..functions import vocab
from ..operators import calls as C
from ..operators import chunking, confidence, documents, exports, metrics, providers, retrieval, triage
from ..sources.registry_tables import scratch
from ..streaming import ingest as streaming
from ..streaming import stages
from .queries import BLOCKS, CALL_ROWS, COMMON, CORPUS_SECTIONS, STRIP, WORDS, _blocks, _calls, _hits_sql, _list, _section_type_sql, query
from .registry import Tables

#: Triage with words of the corpus: substrings, whole words, headers, page penalties, and small thresholds.
TRIAGE = {"words": ("tion", "ing", "eau", "ung"), "whole": ("the", "der"), "headers": {"a": "(?i)thst", "b": "(?i)aden"}, "penalties": ("!!", "(?i)lorem")}

# ---------------------------------------------------------------- aggregates


@query("agg_coverage", f"with {BLOCKS} select doc_id, max(page) as page_count, count(distinct case when {STRIP.format('text')} <> '' then page end) as covered, round(count(distinct case when {STRIP.format('text')} <> '' then page end) / max(page), 6)::double as coverage from blocks group by doc_id")
def agg_coverage(spark, sf_dir):
    return documents.coverage(_blocks(spark, sf_dir)).withColumn("coverage", F.round("coverage", 6))


@query("agg_font_avg", "select l_orderkey, round(avg(case when l_discount > 0 then l_quantity end), 6)::double as average from (select * replace (case when l_discount > 0 then l_quantity else -1 end as l_quantity) from lineitem) group by l_orderkey")
def agg_font_avg(spark, sf_dir):
    spans = Tables(spark, sf_dir).lineitem.selectExpr("l_orderkey", "case when l_discount > 0 then l_quantity else -1 end as size")
    return documents.font_average(spans, ["l_orderkey"]).withColumn("average", F.round("average", 6))


def _count_sql(word: str, whole: bool) -> str:
    if whole:
        return rf"len(regexp_extract_all(regexp_replace(lower(text), '([^\p{{L}}\p{{N}}_])', '\1\1', 'g'), '(?:^|[^\p{{L}}\p{{N}}_]){word}(?:[^\p{{L}}\p{{N}}_]|$)'))"
    return f"(len(lower(text)) - len(replace(lower(text), '{word}', ''))) // {len(word)}"


_TOTAL = " + ".join(_count_sql(w, w in TRIAGE["whole"]) for w in (*TRIAGE["words"], *TRIAGE["whole"]))
_UNIQUE = " + ".join(f"max(case when {_count_sql(w, w in TRIAGE['whole'])} > 0 then 1 else 0 end)" for w in (*TRIAGE["words"], *TRIAGE["whole"]))
_HEADERS = "list_sort(list_filter([" + ", ".join(f"max(case when is_head and regexp_matches(text, '{p}') then '{k}' end)" for k, p in TRIAGE["headers"].items()) + "], lambda x: x is not null))"
FEATURES = f"""{BLOCKS},
marked as (select *, block_type = 'HEADING' or row_number() over (partition by doc_id, page order by pos) <= 3 as is_head from blocks),
sizes as (select doc_id, max(page) as n_pages from blocks group by doc_id),
features as (select doc_id, page, any_value(n_pages) as n_pages, cast(sum({_TOTAL}) as bigint) as keyword_total, {_UNIQUE} as keyword_unique, {_HEADERS} as header_hits,
  count_if(block_type = 'BULLET') as bullets, count_if(block_type = 'TABLE_CELL') as cells, bool_or({' or '.join(f"regexp_matches(text, '{p}')" for p in TRIAGE['penalties'])}) as penalty
  from marked join sizes using (doc_id) group by doc_id, page),
scores as (select *, case when len(header_hits) > 0 then 2.0 else 0 end + least(3.0, 0.9 * keyword_unique + least(2.0, 0.15 * keyword_total)) + least(1.5, 0.1 * bullets + case when cells >= 20 then 1 else 0 end)
  + case when n_pages <= 1 then 0.0 when (page - 1) / (n_pages - 1) <= 0.2 then 0.5 when (page - 1) / (n_pages - 1) between 0.35 and 0.7 then 0.3 else 0 end - case when penalty then 1.5 else 0 end as score from features)
"""


@query("agg_page_features", f"with {FEATURES} select doc_id, page, n_pages, keyword_total, cast(keyword_unique as bigint) as keyword_unique, array_to_string(header_hits, ',') as header_hits, bullets, cells, penalty from features")
def agg_page_features(spark, sf_dir):
    f = triage.page_features(_blocks(spark, sf_dir), **TRIAGE)
    return f.withColumn("header_hits", F.array_join("header_hits", ",")).withColumn("bullets", F.col("bullets").cast("long")).withColumn("cells", F.col("cells").cast("long"))


@query("agg_page_score", f"with {FEATURES} select doc_id, page, round(score, 6)::double as score from scores")
def agg_page_score(spark, sf_dir):
    return triage.page_scores(triage.page_features(_blocks(spark, sf_dir), **TRIAGE)).select("doc_id", "page", F.round("score", 6).alias("score"))


@query("agg_keyword_map", f"with {BLOCKS}, k as (select doc_id, pos, block_id, unnest({_hits_sql('text', COMMON)}) as keyword from blocks) select doc_id, keyword, string_agg(block_id, ',' order by pos) as block_ids from k group by 1, 2")
def agg_keyword_map(spark, sf_dir):
    return retrieval.keyword_map(_blocks(spark, sf_dir), COMMON).select("doc_id", "keyword", F.array_join("block_ids", ",").alias("block_ids"))


@query("agg_signal_density", f"with {BLOCKS} select doc_id, pos, len({_hits_sql('text', COMMON)}) as density from blocks")
def agg_signal_density(spark, sf_dir):
    return _blocks(spark, sf_dir).select("doc_id", "pos", F.size(T.hits(F.col("text"), COMMON)).cast("long").alias("density"))


@query("agg_call_merge", f"""with recursive {CALL_ROWS}, o as (select *, row_number() over (partition by doc_id, asset_class_category, sub_asset_class order by pos, part, supp, qty, confidence) as k,
  case when part % 3 = 0 then cast(part as varchar) end as conviction from calls),
fold as (select doc_id, asset_class_category, sub_asset_class, k, confidence, part, conviction, [part] as parts, cast(null as varchar) as review_reason, 1 as n from o where k = 1
  union all select f.doc_id, f.asset_class_category, f.sub_asset_class, o.k, greatest(f.confidence, o.confidence), case when o.confidence > f.confidence then o.part else f.part end,
    case when o.confidence > f.confidence then coalesce(o.conviction, f.conviction) else coalesce(f.conviction, o.conviction) end,
    list_slice(case when o.confidence > f.confidence then (case when list_contains(f.parts, o.part) then list_concat([o.part], list_filter(f.parts, lambda x: x <> o.part)) else list_concat([o.part], f.parts) end)
      when list_contains(f.parts, o.part) then f.parts else list_concat(f.parts, [o.part]) end, 1, 3),
    case when f.review_reason is null then '' else f.review_reason || '; ' end || '{C.MERGED}', f.n + 1
  from fold f join o on o.doc_id = f.doc_id and o.asset_class_category = f.asset_class_category and o.sub_asset_class = f.sub_asset_class and o.k = f.k + 1)
select doc_id, asset_class_category, sub_asset_class, round(confidence, 6)::double as confidence, part, conviction, array_to_string(parts, ',') as parts, coalesce(review_reason, '') as review_reason, n as n_mentions
from fold qualify row_number() over (partition by doc_id, asset_class_category, sub_asset_class order by k desc) = 1""")
def agg_call_merge(spark, sf_dir):
    c = _calls(spark, sf_dir).withColumn("conviction", F.when(F.col("part") % 3 == 0, F.col("part").cast("string"))).withColumn("parts", F.array("part")).withColumn("review_reason", F.lit(None).cast("string"))
    keys = ["doc_id", "asset_class_category", "sub_asset_class"]
    m = C.merged_calls(c.withColumn("c0", F.col("confidence")), keys, ["pos", "part", "supp", "qty", "c0"], ["conviction"], {"parts": 3}, ["part"])
    return m.select(*keys, F.round("confidence", 6).alias("confidence"), "part", "conviction", F.array_join("parts", ",").alias("parts"), F.coalesce("review_reason", F.lit("")).alias("review_reason"), "n_mentions")


@query("agg_ocr_quality", rf"""select doc_id, round(case when text is null then 1 when {STRIP.format('text')} = '' then 0 else 1 - len(regexp_extract_all(text || ' ', '[\p{{C}}□■▪▫●○◆◇]')) / len(text || ' ') end, 6)::double as ocr from documents""")
def agg_ocr_quality(spark, sf_dir):
    return confidence.ocr_quality(Tables(spark, sf_dir).documents, "text").select("doc_id", F.round("ocr", 6).alias("ocr"))


@query("agg_table_success", "select l_orderkey as doc_id, round(avg(case when l_quantity > 10 then 1.0 else 0 end), 6)::double as tables from lineitem group by 1")
def agg_table_success(spark, sf_dir):
    t = Tables(spark, sf_dir).lineitem.selectExpr("l_orderkey as doc_id", "case when l_quantity > 10 then l_quantity else 0 end as n_cells")
    return confidence.table_success(t).withColumn("tables", F.round("tables", 6))


_STRUCTURE = "case when bool_or(block_type = 'HEADING') then 0.4 else 0 end + case when bool_or(block_type = 'PARAGRAPH') then 0.3 else 0 end + case when count(distinct block_type) >= 3 then 0.3 when count(distinct block_type) = 2 then 0.15 else 0 end"


@query("agg_structure", f"with {BLOCKS} select doc_id, round({_STRUCTURE}, 6)::double as structure from blocks group by doc_id")
def agg_structure(spark, sf_dir):
    return confidence.structure_quality(_blocks(spark, sf_dir)).withColumn("structure", F.round("structure", 6))


@query("agg_extraction_q", f"with {BLOCKS} select doc_id, round(0.4 * count(distinct case when {STRIP.format('text')} <> '' then page end) / max(page) + 0.2 + 0.2 + 0.2 * ({_STRUCTURE}), 6)::double as extraction from blocks group by doc_id")
def agg_extraction_q(spark, sf_dir):
    b = _blocks(spark, sf_dir)
    rows = documents.coverage(b).join(confidence.structure_quality(b), "doc_id").withColumn("ocr", F.lit(1.0)).withColumn("tables", F.lit(None).cast("double"))
    return rows.select("doc_id", F.round(confidence.extraction_quality(), 6).alias("extraction"))


_LONG = "list_distinct(list_filter(" + WORDS.format("lower({})") + ", lambda w: len(w) > 2))"


def _overlap_sql(a: str, b: str) -> str:
    la, lb = _LONG.format(a), _LONG.format(b)
    return f"case when len({la}) = 0 then 0.0 else len(list_intersect({la}, {lb})) / len({la}) end"


def _mention_sql(v: str, t: str) -> str:
    long = f"list_filter({WORDS.format(f'lower({v})')}, lambda w: len(w) > 2)"
    return f"case when contains(lower({t}), lower({v})) then 1.0 when len({long}) > 0 and len(list_filter({long}, lambda w: not contains(lower({t}), w))) = 0 then 0.8 else 0.0 end"


#: A claim is the first line of a document; it cites its own document and the next one.
_CLAIMS = "claims as (select d.doc_id as claim_id, string_split(d.text, chr(10))[1] as value, c.doc_id as chunk_id, c.text as chunk from documents d join documents c on c.doc_id = d.doc_id or c.doc_id = d.doc_id + 1)"


def _cited(spark, sf_dir):
    cited = F.explode(F.array("doc_id", F.col("doc_id") + 1)).alias("chunk_id")
    return Tables(spark, sf_dir).documents.select(F.col("doc_id").alias("claim_id"), F.split("text", "\n")[0].alias("value"), cited)


def _chunk_texts(spark, sf_dir):
    return Tables(spark, sf_dir).documents.select(F.col("doc_id").alias("chunk_id"), "text")


def _claims(spark, sf_dir):
    return _cited(spark, sf_dir).join(_chunk_texts(spark, sf_dir).withColumnRenamed("text", "chunk"), "chunk_id")


@query("set_word_overlap", f"with {_CLAIMS} select claim_id, chunk_id, round({_overlap_sql('value', 'chunk')}, 6)::double as overlap from claims")
def set_word_overlap(spark, sf_dir):
    return _claims(spark, sf_dir).select("claim_id", "chunk_id", F.round(T.word_overlap(F.col("value"), F.col("chunk")), 6).alias("overlap"))


@query("fn_explicit_mention", f"with {_CLAIMS} select claim_id, chunk_id, {_mention_sql('value', 'chunk')}::double as mention from claims")
def fn_explicit_mention(spark, sf_dir):
    return _claims(spark, sf_dir).select("claim_id", "chunk_id", T.explicit_mention(F.col("value"), F.col("chunk")).alias("mention"))


def _entail_sql(v: str, t: str) -> str:
    head = rf"regexp_replace(left(lower({v}), 20), '([^\p{{L}}\p{{N}}\s])', '\\\1', 'g')"
    return rf"""case when regexp_matches(lower({t}), '(we|our|the)\s+\w*\s*' || {head}) or regexp_matches(lower({t}), {head} || '\s+(is|are|will|should)') or regexp_matches(lower({t}), '(expect|believe|view|see)\s+.*' || {head}) then 1.0
      when len(list_filter(list_slice({WORDS.format(f'lower({v})')}, 1, 3), lambda w: contains(lower({t}), w))) > 0 then 0.5 else 0.0 end"""


@query("fn_entail", f"with {_CLAIMS} select claim_id, chunk_id, {_entail_sql('value', 'chunk')}::double as entail from claims")
def fn_entail(spark, sf_dir):
    return _claims(spark, sf_dir).select("claim_id", "chunk_id", T.entailment(F.col("value"), F.col("chunk")).alias("entail"))


@query("agg_evidence", f"with {_CLAIMS} select claim_id, round(max(0.5 * {_mention_sql('value', 'chunk')} + 0.3 * {_overlap_sql('value', 'chunk')} + 0.2 * {_entail_sql('value', 'chunk')}), 6)::double as strength from claims group by claim_id")
def agg_evidence(spark, sf_dir):
    return confidence.evidence(_cited(spark, sf_dir), _chunk_texts(spark, sf_dir)).withColumn("strength", F.round("strength", 6))


LANGUAGE = {"OVERWEIGHT": (" the ", " und "), "UNDERWEIGHT": (" que ",)}


@query("fn_explicit_lang", r"""select doc_id, (case doc_id % 3 when 0 then regexp_matches(lower(text), ' the | und ') when 1 then regexp_matches(lower(text), ' que ') else false end)::int::double as said from documents""")
def fn_explicit_lang(spark, sf_dir):
    direction = F.element_at(F.array(*map(F.lit, ("OVERWEIGHT", "UNDERWEIGHT", "UNCERTAIN"))), (F.col("doc_id") % 3 + 1).cast("int"))
    return Tables(spark, sf_dir).documents.select("doc_id", T.call_language(direction, F.col("text"), LANGUAGE).alias("said"))


@query("agg_call_evidence", r"select doc_id, round(0.5 * (n_chars % 100) / 100 + 0.5 * (regexp_matches(lower(text), '\bneutral\b|\bbenchmark weight\b|\bhold\b'))::int, 6)::double as strength from documents")
def agg_call_evidence(spark, sf_dir):
    return Tables(spark, sf_dir).documents.select("doc_id", F.round(confidence.call_evidence((F.col("n_chars") % 100) / 100, F.lit("NEUTRAL"), F.col("text")), 6).alias("strength"))


_SUMMARY = "summary as (select doc_id, 0.6 * avg(best) + 0.2 * least(1.0, any_value(n) / 4) + 0.2 * least(1.0, any_value(np) / 4) as summary from (select l_orderkey as doc_id, l_returnflag, max(l_tax * 10) as best from lineitem group by 1, 2) join (select l_orderkey as doc_id, count(*) as n, count(distinct l_linenumber) as np from lineitem group by 1) using (doc_id) group by doc_id)"


def _summary(spark, sf_dir):
    rows = Tables(spark, sf_dir).lineitem.selectExpr("l_orderkey as doc_id", "l_returnflag as takeaway", "l_tax * 10 as overlap", "l_linenumber as page")
    return confidence.summary_evidence(rows, rows.select("doc_id", "page"))


@query("agg_summary_evidence", f"with {_SUMMARY} select doc_id, round(summary, 6)::double as summary from summary")
def agg_summary_evidence(spark, sf_dir):
    return _summary(spark, sf_dir).withColumn("summary", F.round("summary", 6))


#: A document's scores: extraction and profile from its order, call confidences from its lines.
_DOCS = f"""{_SUMMARY}, conf as (select l_orderkey as doc_id, list(l_discount * 10 order by l_discount) as scores, avg(l_discount * 10) as mean, bool_or(l_tax > 0.07) as review from lineitem group by 1),
docs as (select o_orderkey as doc_id, (o_orderkey % 100) / 100 as extraction, (o_orderkey % 7) / 7 as profile, mean, coalesce(scores, []) as scores, coalesce(review, false) as review, coalesce(summary, 0) as summary,
  (o_orderkey % 90) / 60 as coverage, (o_orderkey % 45) / 40 as ocr, o_orderkey % 13 = 0 as manager_unclear, o_orderkey % 11 = 0 as date_unclear
  from orders left join conf on conf.doc_id = o_orderkey left join summary s on s.doc_id = o_orderkey),
scored as (select *, 0.15 * extraction + 0.15 * profile + 0.5 * coalesce(mean, 0.5) + 0.2 * summary as score,
  list_filter([case when coverage < 0.5 then 'low_extraction_coverage' end, case when ocr < 0.7 then 'poor_ocr_quality' end, case when manager_unclear then 'manager_name_unclear' end, case when date_unclear then 'publication_date_unclear' end,
    case when review then 'call_needs_review' end, case when len(list_filter(scores, lambda x: x < 0.5)) > 0 then 'low_confidence_call' end, case when len(scores) = 0 then 'no_calls_extracted' end,
    case when len(scores) > 0 and len(list_filter(scores, lambda x: x < 0.6)) > len(scores) * 0.3 then 'many_low_confidence_calls' end], lambda r: r is not null) as reasons from docs),
banded as (select *, case when score >= 0.8 then 'HIGH' when score >= 0.6 then 'MEDIUM' else 'LOW' end as band from scored),
routed as (select *, len(reasons) > 0 or band = 'LOW' as required, score >= 0.8 and coverage >= 0.7 and not (len(reasons) > 0 or band = 'LOW') and not manager_unclear and not date_unclear as auto,
  cast('0x' || left(sha256(cast(doc_id as varchar)), 8) as bigint) % 100 < 20 as spot from banded)
"""


def _scored(spark, sf_dir):
    t = Tables(spark, sf_dir)
    conf = t.lineitem.groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.array_sort(F.collect_list(F.col("l_discount") * 10)).alias("scores"), F.avg(F.col("l_discount") * 10).alias("mean"), F.bool_or(F.col("l_tax") > 0.07).alias("review"))
    k = F.col("o_orderkey")
    rows = t.orders.select(k.alias("doc_id"), (k % 100 / 100).alias("extraction"), (k % 7 / 7).alias("profile"), (k % 90 / 60).alias("coverage"), (k % 45 / 40).alias("ocr"), (k % 13 == 0).alias("manager_unclear"), (k % 11 == 0).alias("date_unclear"))
    rows = rows.join(conf, "doc_id", "left").join(_summary(spark, sf_dir), "doc_id", "left")
    rows = rows.withColumn("scores", F.coalesce("scores", F.array().cast("array<double>"))).withColumn("review", F.coalesce("review", F.lit(False))).withColumn("summary", F.coalesce("summary", F.lit(0.0)))
    c = F.col
    rows = rows.withColumn("score", confidence.document_score(c("extraction"), c("profile"), c("mean"), c("summary")))
    rows = rows.withColumn("reasons", confidence.attention(c("coverage"), c("ocr"), c("manager_unclear"), c("date_unclear"), c("scores"), c("review"))).withColumn("band", T.band(c("score")))
    rows = rows.withColumn("required", (F.size("reasons") > 0) | (c("band") == "LOW"))
    return rows.withColumn("auto", confidence.auto_publishable(c("score"), c("coverage"), c("required"), c("manager_unclear"), c("date_unclear"))).withColumn("spot", confidence.spot_checked(c("doc_id")))


@query("agg_doc_conf", f"with {_DOCS} select doc_id, round(score, 6)::double as score, band from banded")
def agg_doc_conf(spark, sf_dir):
    return _scored(spark, sf_dir).select("doc_id", F.round("score", 6).alias("score"), "band")


@query("agg_attention", f"with {_DOCS} select doc_id, array_to_string(reasons, ',') as reasons, required from routed")
def agg_attention(spark, sf_dir):
    return _scored(spark, sf_dir).select("doc_id", F.array_join("reasons", ",").alias("reasons"), "required")


@query("agg_field_conf", f"""with {_DOCS} select doc_id, f.field_name, round(f.confidence, 6)::double as confidence, f.reasons, f.explicit as has_explicit_evidence from docs, lateral (select unnest([
  {{'field_name': 'extraction_quality', 'confidence': extraction::double, 'reasons': 'text_coverage,structure_quality', 'explicit': true}}, {{'field_name': 'profile', 'confidence': profile::double, 'reasons': 'manager_name_evidence', 'explicit': profile > 0.5}},
  {{'field_name': 'calls', 'confidence': coalesce(mean, 0.5)::double, 'reasons': len(scores) || ' calls extracted', 'explicit': round(coalesce(mean, 0.5), 9) > 0.5}},
  {{'field_name': 'summary', 'confidence': summary::double, 'reasons': 'summary_evidence,' || len(scores) || ' summary citations,3 takeaways', 'explicit': len(scores) >= 2}}]) as f)""")
def agg_field_conf(spark, sf_dir):
    c, n = F.col, F.size("scores")
    f = confidence.field_confidences(c("extraction"), c("profile"), F.round(F.coalesce("mean", F.lit(0.5)), 9), n, c("summary"), n, F.lit(3))
    return _scored(spark, sf_dir).select("doc_id", F.inline(f)).select("doc_id", "field_name", F.round("confidence", 6).alias("confidence"), F.array_join("reasons", ",").alias("reasons"), "has_explicit_evidence")


@query("rt_auto", f"with {_DOCS} select doc_id, auto from routed")
def rt_auto(spark, sf_dir):
    return _scored(spark, sf_dir).select("doc_id", "auto")


@query("rt_spot", f"with {_DOCS} select doc_id, band = 'MEDIUM' and spot as spot from routed")
def rt_spot(spark, sf_dir):
    return _scored(spark, sf_dir).select("doc_id", ((F.col("band") == "MEDIUM") & F.col("spot")).alias("spot"))


@query("rt_route", f"with {_DOCS} select doc_id, case band when 'HIGH' then case when auto then 'auto_publish' else 'must_review' end when 'MEDIUM' then case when spot then 'spot_check' else 'auto_publish' end else 'must_review' end as route from routed")
def rt_route(spark, sf_dir):
    return _scored(spark, sf_dir).select("doc_id", confidence.route(F.col("band"), F.col("auto"), F.col("spot")).alias("route"))


_RUNS = "runs as (select event_id % 10 <> 0 as success, event_id % 5 as n_calls, event_id % 3 as n_cited, value as seconds from events)"


@query("agg_eval", f"""with {_RUNS}, r as (select count(*) as n_documents, count_if(success) as n_success, count_if(success) / count(*) as success_rate, sum(case when success then n_calls end) / count_if(success) as calls_per_document,
  sum(case when success then n_cited end) / sum(case when success then n_calls end) as citation_rate, avg(case when success then seconds end) as mean_seconds, quantile_cont(case when success then seconds::double end, 0.5) as p50_seconds,
  quantile_cont(case when success then seconds::double end, 0.95) as p95_seconds from runs)
select n_documents, n_success, round(success_rate, 6)::double as success_rate, round(calls_per_document, 6)::double as calls_per_document, round(citation_rate, 6)::double as citation_rate, round(mean_seconds, 6)::double as mean_seconds,
  round(p50_seconds, 6)::double as p50_seconds, round(p95_seconds, 6)::double as p95_seconds, success_rate >= 0.9 and calls_per_document >= 3 and citation_rate >= 1 and mean_seconds < 180 as passes from r""")
def agg_eval(spark, sf_dir):
    runs = Tables(spark, sf_dir).events.selectExpr("event_id % 10 <> 0 as success", "event_id % 5 as n_calls", "event_id % 3 as n_cited", "value as seconds")
    out = metrics.evaluation(runs)
    return out.select("n_documents", "n_success", *[F.round(c, 6).alias(c) for c in ("success_rate", "calls_per_document", "citation_rate", "mean_seconds", "p50_seconds", "p95_seconds")], "passes")


@query("agg_percentile", "select event_type, round(quantile_cont(value::double, 0.5), 6)::double as p50, round(quantile_cont(value::double, 0.95), 6)::double as p95 from events group by event_type")
def agg_percentile(spark, sf_dir):
    found = metrics.percentiles(Tables(spark, sf_dir).events, "value", {"p50": 0.5, "p95": 0.95}, ["event_type"])
    return found.select("event_type", F.round("p50", 6).alias("p50"), F.round("p95", 6).alias("p95"))


@query("agg_validate", """select event_id, case event_id % 6 when 0 then '' when 1 then 'unknown key extra' when 2 then 'Call 0: invalid category ''NOPE'';Call 0: invalid sub_asset ' || chr(39) || chr(39) when 3 then 'Invalid theme_tags value: ''Bogus'';Invalid region_tags value: ''moon' || chr(39)
  when 4 then 'Call 0: missing citations;Summaries: missing citations' else 'Call 0 citation 0: missing chunk_id;Call 0 citation 1: invalid page' end as errors from events""")
def agg_validate(spark, sf_dir):
    good = "array(named_struct('chunk_id', 'c', 'page', 1))"
    rows = Tables(spark, sf_dir).events.selectExpr(
        "event_id", "case when event_id % 6 = 1 then array('unknown key extra') else array() end as schema_errors",
        f"""array(named_struct('asset_class_category', case when event_id % 6 in (1, 2) then 'NOPE' else 'EQ_DM' end, 'sub_asset_class', case when event_id % 6 <> 2 then 'EQ_US' end, 'citations',
          case event_id % 6 when 4 then null when 5 then array(named_struct('chunk_id', '', 'page', 2), named_struct('chunk_id', 'd', 'page', 0)) else {good} end)) as allocation_calls""",
        """named_struct('theme_tags', case when event_id % 6 = 3 then array('Growth', 'Bogus') else array('inflation') end, 'risk_tags', array('crowded_trade'), 'region_tags', case when event_id % 6 = 3 then array('moon') else array('US') end, 'macro_regime_tags', cast(null as array<string>)) as tags""",
        f"named_struct('citations', case when event_id % 6 <> 4 then {good} end) as summaries")
    return exports.validated(rows, "event_id").withColumn("errors", F.array_join("errors", ";"))


@query("agg_invalid_tags", f"""with t as (select doc_id, unnest(list_distinct({WORDS.format('lower(text)')})) as value from documents)
select doc_id, 'Invalid theme_tags value: ' || chr(39) || value || chr(39) as error from t where not list_contains({_list(vocab.THEMES)}, value)""")
def agg_invalid_tags(spark, sf_dir):
    t = Tables(spark, sf_dir).documents.select("doc_id", F.lit("theme").alias("tag_type"), F.explode(F.array_distinct(T.words(F.lower("text")))).alias("value"))
    return exports.invalid_tags(t).select("doc_id", "error")


@query("agg_queue_stats", "select event_type as queue, count(*) as depth, min(ts) as oldest from events group by 1")
def agg_queue_stats(spark, sf_dir):
    return metrics.queue(Tables(spark, sf_dir).events.select(F.col("event_type").alias("queue"), F.col("ts").alias("since")))


@query("agg_corrections", "select l_returnflag as from_call, count_if(l_linestatus = 'F') as F, count_if(l_linestatus = 'O') as O from lineitem group by 1")
def agg_corrections(spark, sf_dir):
    return metrics.corrections(Tables(spark, sf_dir).lineitem.selectExpr("l_returnflag as from_call", "l_linestatus as to_call"), ["F", "O"])


@query("agg_calibration", "select case when l_discount * 10 >= 0.8 then 'HIGH' when l_discount * 10 >= 0.6 then 'MEDIUM' else 'LOW' end as band, count(*) as n, round(avg((l_returnflag = 'A')::int), 6)::double as approval_rate, round(avg((l_returnflag = 'N')::int), 6)::double as edit_rate, round(avg((l_returnflag = 'R')::int), 6)::double as rejection_rate from lineitem group by 1")
def agg_calibration(spark, sf_dir):
    rows = Tables(spark, sf_dir).lineitem.select(T.band(F.col("l_discount") * 10).alias("band"), F.when(F.col("l_returnflag") == "A", "approved").when(F.col("l_returnflag") == "N", "edited").otherwise("rejected").alias("decision"))
    return metrics.calibration(rows).select("band", "n", *[F.round(c, 6).alias(c) for c in ("approval_rate", "edit_rate", "rejection_rate")])


# ---------------------------------------------------------------- windows

@query("win_boilerplate", f"""with {BLOCKS}, e as (select *, row_number() over (partition by doc_id, page order by pos) = 1 as top, row_number() over (partition by doc_id, page order by pos desc) = 1 as bottom from blocks),
r as (select doc_id, page, pos, 'top' as edge, text, block_type from e where top union all select doc_id, page, pos, 'bottom', text, block_type from e where bottom),
n as (select *, block_type in ('HEADING', 'PARAGRAPH') and lead(text, 1) over w = text and lead(text, 2) over w = text as run from r window w as (partition by doc_id, edge order by page)),
g as (select distinct doc_id, pos from (select *, coalesce(lag(run, 1) over w, false) or coalesce(lag(run, 2) over w, false) as gone from n window w as (partition by doc_id, edge order by page)) where gone)
select doc_id, count(*) as kept from blocks anti join g using (doc_id, pos) group by doc_id""")
def win_boilerplate(spark, sf_dir):
    return documents.drop_boilerplate(_blocks(spark, sf_dir)).groupBy("doc_id").agg(F.count(F.lit(1)).alias("kept"))


_SECTIONS = f"""{BLOCKS}, headed as (select * replace (case when left(text, 1) = 'E' then 'HEADING' else 'PARAGRAPH' end as block_type) from blocks),
cut as (select *, cast(sum((block_type = 'HEADING')::int) over w as bigint) - (case when first_value(block_type) over w = 'HEADING' then 1 else 0 end) as section_index from headed window w as (partition by doc_id order by pos))"""


def _headed(spark, sf_dir):
    return _blocks(spark, sf_dir).withColumn("block_type", F.when(F.startswith("text", F.lit("E")), "HEADING").otherwise("PARAGRAPH"))


@query("win_sections", f"""with {_SECTIONS} select doc_id, doc_id || '_sec_' || section_index as section_id, case when min_by(block_type, pos) = 'HEADING' then min_by(text, pos) end as title, min_by(block_id, pos) as start_block_id, max_by(block_id, pos) as end_block_id,
  case when min_by(block_type, pos) = 'HEADING' then {_section_type_sql('min_by(text, pos)', CORPUS_SECTIONS)} end as section_type, count(*) as n_blocks from cut group by doc_id, section_index""")
def win_sections(spark, sf_dir):
    return documents.section_table(_headed(spark, sf_dir), CORPUS_SECTIONS)


@query("jn_section_range", f"with {_SECTIONS} select doc_id, pos, section_index from cut")
def jn_section_range(spark, sf_dir):
    return documents.sections(_headed(spark, sf_dir)).select("doc_id", "pos", "section_index")


_PACK = f"""b as (select doc_id, row_number() over (partition by doc_id order by pos) as k, s as text, block_id, page from (select *, {STRIP.format('text')} as s from blocks) where s <> ''),
fold as (select doc_id, 0::bigint as k, '' as cur, null::int as page, 0 as n, null::varchar as done, null::int as done_page from documents
  union all select f.doc_id, b.k, case when f.cur = '' or len(f.cur) + len(b.text) > 1600 then b.text else f.cur || chr(10) || chr(10) || b.text end,
    case when f.cur = '' or len(f.cur) + len(b.text) > 1600 then b.page else f.page end, f.n + 1,
    case when f.cur <> '' and len(f.cur) + len(b.text) > 1600 and len(f.cur) >= 800 then f.cur end, f.page
  from fold f join b on b.doc_id = f.doc_id and b.k = f.k + 1),
out as (select doc_id, k, done as text, done_page as page from fold where done is not null union all
  select doc_id, k + 1, cur, page from (select *, row_number() over (partition by doc_id order by k desc) as last from fold) where last = 1 and len(cur) >= 800)"""


@query("win_chunk_fallback", f"with recursive {BLOCKS}, {_PACK} select doc_id, page, sha256(text) as digest from out")
def win_chunk_fallback(spark, sf_dir):
    c = chunking.packed(_blocks(spark, sf_dir), by_section=False)
    return c.select("doc_id", "page", F.sha2("text", 256).alias("digest"))


_CHUNK_SQL = f"""with recursive {BLOCKS},
cut as (select *, {STRIP.format('text')} as s, cast(sum((block_type = 'HEADING')::int) over w as bigint) - (case when first_value(block_type) over w = 'HEADING' then 1 else 0 end) as section_index from blocks window w as (partition by doc_id order by pos)),
titles as (select doc_id, section_index, case when min_by(block_type, pos) = 'HEADING' then min_by(text, pos) end as section from cut group by 1, 2),
c as (select doc_id, section_index, row_number() over (partition by doc_id, section_index order by pos) as k, s as text, block_id, page, len(s) > 1600 as large from cut where s <> ''),
w as (select doc_id, block_id, {WORDS.format('text')} as w from c where large),
wf as (select doc_id, block_id, 0 as i, w, 0 as n, 1 as piece from w union all select doc_id, block_id, i + 1, w, case when n > 0 and n + len(w[i + 1]) + 1 > 1600 then 0 else n end + len(w[i + 1]) + 1, case when n > 0 and n + len(w[i + 1]) + 1 > 1600 then piece + 1 else piece end from wf where i < len(w)),
pieces as (select doc_id, block_id, piece, string_agg(w[i], ' ' order by i) as text from wf where i > 0 group by 1, 2, 3),
listed as (select doc_id, block_id, list(text order by piece) as pieces from pieces group by 1, 2),
part as (select c.*, pieces from c left join listed using (doc_id, block_id)),
pack as (select distinct doc_id, section_index, 0::bigint as k, ''::varchar as cur, []::varchar[] as ids, null::int as page, []::struct(text varchar, ids varchar[], page int)[] as made from part
  union all select f.doc_id, f.section_index, b.k,
    case when b.large then case when len(f.cur) < 800 then f.cur else '' end when f.cur = '' or len(f.cur) + len(b.text) > 1600 then b.text else f.cur || chr(10) || chr(10) || b.text end,
    case when b.large then case when len(f.cur) < 800 then f.ids else [] end when f.cur = '' or len(f.cur) + len(b.text) > 1600 then [b.block_id] else list_append(f.ids, b.block_id) end,
    case when b.large then case when len(f.cur) < 800 then f.page end when f.cur = '' or len(f.cur) + len(b.text) > 1600 then b.page else f.page end,
    case when b.large then list_concat(case when len(f.cur) >= 800 then [struct_pack(text := f.cur, ids := f.ids, page := coalesce(f.page, 1))] else [] end, list_transform(b.pieces, lambda p: struct_pack(text := p, ids := [b.block_id], page := b.page)))
      when f.cur <> '' and len(f.cur) + len(b.text) > 1600 and len(f.cur) >= 800 then [struct_pack(text := f.cur, ids := f.ids, page := coalesce(f.page, 1))] else [] end
  from pack f join part b on b.doc_id = f.doc_id and b.section_index = f.section_index and b.k = f.k + 1),
made as (select doc_id, section_index, k, unnest(made) as x, generate_subscripts(made, 1) as j from pack where len(made) > 0
  union all select doc_id, section_index, k + 1, struct_pack(text := cur, ids := ids, page := coalesce(page, 1)), 1 from (select *, row_number() over (partition by doc_id, section_index order by k desc) as last from pack) where last = 1 and len(cur) >= 800),
{{whole}},
every as (select doc_id, section_index, k, j, x.text as text, array_to_string(x.ids, ',') as block_ids, x.page as page, section from made join titles using (doc_id, section_index)
  union all select doc_id, 0, k, 1, text, block_ids, page, null from out where doc_id not in (select doc_id from made)),
numbered as (select *, cast(row_number() over (partition by doc_id order by section_index, k, j) - 1 as int) as chunk_index from every)
select doc_id, chunk_index, doc_id || '_' || chunk_index as chunk_id, block_ids, page, text, section from numbered"""
_WHOLE = _PACK.replace("0 as n, null::varchar as done", "''::varchar as ids, 0 as n, null::varchar as done").replace(
    "f.n + 1,", "case when f.cur = '' or len(f.cur) + len(b.text) > 1600 then b.block_id else f.ids || ',' || b.block_id end, f.n + 1,").replace(
    "then f.cur end, f.page", "then f.cur end, f.page, f.ids").replace("null::int as done_page", "null::int as done_page, null::varchar as done_ids").replace(
    "done_page as page from fold", "done_page as page, done_ids as block_ids from fold").replace("select doc_id, k + 1, cur, page from", "select doc_id, k + 1, cur, page, ids from")


@query("win_chunk", _CHUNK_SQL.replace("{whole}", _WHOLE))
def win_chunk(spark, sf_dir):
    return chunking.chunks(_blocks(spark, sf_dir)).select("doc_id", "chunk_index", "chunk_id", F.array_join("block_ids", ",").alias("block_ids"), "page", "text", "section")


@query("win_split_large", f"""with recursive w as (select doc_id, {WORDS.format('text')} as w from documents),
fold as (select doc_id, 0 as k, w, 0 as n, 1 as piece from w union all select doc_id, k + 1, w, case when n > 0 and n + len(w[k + 1]) + 1 > 1600 then 0 else n end + len(w[k + 1]) + 1, case when n > 0 and n + len(w[k + 1]) + 1 > 1600 then piece + 1 else piece end from fold where k < len(w))
select doc_id, piece, count(*) as n_words from fold where k > 0 group by doc_id, piece""")
def win_split_large(spark, sf_dir):
    rows = Tables(spark, sf_dir).documents.select("doc_id", F.posexplode(chunking.split_large(F.col("text"))).alias("k", "piece"))
    return rows.select("doc_id", (F.col("k") + 1).alias("piece"), F.size(F.split("piece", " ")).cast("long").alias("n_words"))


_CHUNKS = f"{BLOCKS}, chunks as (select doc_id, pos as chunk_index, doc_id || '_' || pos as chunk_id, block_id, page, text from blocks)"


def _line_chunks(spark, sf_dir):
    return _blocks(spark, sf_dir).select("doc_id", F.col("pos").alias("chunk_index"), F.concat_ws("_", F.col("doc_id").cast("string"), F.col("pos").cast("string")).alias("chunk_id"), F.array("block_id").alias("block_ids"), "page", "text")


@query("win_rank_density", f"with {_CHUNKS}, d as (select *, len({_hits_sql('text', COMMON)}) as density from chunks) select doc_id, chunk_index, density, row_number() over (partition by doc_id order by density desc, page, chunk_index) as place from d where density > 0 qualify place <= 30")
def win_rank_density(spark, sf_dir):
    return retrieval.ranked_by_density(_line_chunks(spark, sf_dir), COMMON).select("doc_id", "chunk_index", F.col("density").cast("long").alias("density"), F.col("place").cast("long").alias("place"))


@query("win_first_pages", f"with {_CHUNKS} select doc_id, chunk_id, row_number() over (partition by doc_id order by page, chunk_id) as place from chunks where page <= 2 qualify place <= 6")
def win_first_pages(spark, sf_dir):
    return retrieval.first_pages(_line_chunks(spark, sf_dir)).select("doc_id", "chunk_id", F.col("place").cast("long").alias("place"))


@query("win_keep_first", "select l_orderkey, l_partkey, min((l_linenumber, l_suppkey, l_quantity))[1] as l_linenumber from lineitem group by 1, 2")
def win_keep_first(spark, sf_dir):
    rows = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_quantity")
    return retrieval.keep_first(rows, ["l_orderkey", "l_partkey"], ["l_linenumber", "l_suppkey", "l_quantity"]).select("l_orderkey", "l_partkey", "l_linenumber")


@query("win_slug", r"""with s as (select p_partkey, regexp_replace(regexp_replace(regexp_replace(lower(p_type), '[^a-z0-9\s_-]', '', 'g'), '[\s_-]+', '-', 'g'), '^-+|-+$', '', 'g') as s from part), n as (select *, row_number() over (partition by s order by p_partkey) as n from s)
select p_partkey, case when n = 1 then s else s || '-' || n end as slug from n""")
def win_slug(spark, sf_dir):
    return exports.unique_slugs(Tables(spark, sf_dir).part, "p_type", "p_partkey").select("p_partkey", "slug")


# ---------------------------------------------------------------- top-k

_TOPK = """q as (select vec_id as query_id, label, embedding from embeddings where vec_id % 10 = 0), hits as (select query_id, e.label, e.vec_id as id, greatest(0.0, list_cosine_similarity(e.embedding::double[], q.embedding::double[])) as score from embeddings e join q using (label)),
ranked as (select *, row_number() over (partition by query_id order by round(score, 9) desc, id) as rank from hits)"""


def _top(spark, sf_dir, k):
    e = Tables(spark, sf_dir).embeddings
    return retrieval.top_vectors(e, e.where("vec_id % 10 = 0").withColumnRenamed("vec_id", "query_id"), k, "label", "vec_id")


@query("topk_vector", f"with {_TOPK} select query_id, label, id, round(score, 6)::double as score, rank from ranked where rank <= 8")
def topk_vector(spark, sf_dir):
    return _top(spark, sf_dir, 8).select("query_id", "label", "id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


def _merged_sql(k: int, keep: int) -> str:
    return f"with {_TOPK}, f as (select label, id, min_by(score, (query_id, rank)) as score, min(query_id) as q, min_by(rank, (query_id, rank)) as r from ranked where rank <= {k} group by label, id) select label, id, round(score, 6)::double as score, row_number() over (partition by label order by round(score, 9) desc, q, r) as place from f qualify place <= {keep}"


def _merged(spark, sf_dir, k, keep):
    m = retrieval.merged_queries(_top(spark, sf_dir, k).withColumnRenamed("query_id", "query_order"), keep, "label")
    return m.select("label", "id", F.round("score", 6).alias("score"), F.col("place").cast("long").alias("place"))


@query("topk_multiquery_sum", _merged_sql(20, 30))
def topk_multiquery_sum(spark, sf_dir):
    return _merged(spark, sf_dir, 20, 30)


@query("topk_multiquery_tag", _merged_sql(15, 20))
def topk_multiquery_tag(spark, sf_dir):
    return _merged(spark, sf_dir, 15, 20)


@query("topk_metadata", f"""with {_CHUNKS}, front as (select doc_id, chunk_id, 0 as part, row_number() over (partition by doc_id order by page, chunk_id) as spot, 1.0 as score from chunks where page <= 2 qualify spot <= 6),
hits as (select doc_id, chunk_id, 1 as part, row_number() over (partition by doc_id order by len(text) desc, chunk_index) as spot, 1.0 / len(text) as score from chunks where len(text) > 0 qualify spot <= 8),
once as (select doc_id, chunk_id, min((part, spot)) as k, min_by(score, (part, spot)) as score from (select * from front union all select * from hits) group by 1, 2)
select doc_id, chunk_id, round(score, 6)::double as score, row_number() over (partition by doc_id order by k, chunk_id) as place from once qualify place <= 12""")
def topk_metadata(spark, sf_dir):
    c = _line_chunks(spark, sf_dir)
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc(F.length("text")), "chunk_index"))
    hits = c.where("length(text) > 0").withColumn("rank", rank).where("rank <= 8").withColumn("score", 1 / F.length("text"))
    found = retrieval.metadata_chunks(c, hits)
    return found.select("doc_id", "chunk_id", F.round("score", 6).alias("score"), F.col("place").cast("long").alias("place"))


@query("topk_multiquery_small", _merged_sql(8, 12))
def topk_multiquery_small(spark, sf_dir):
    return _merged(spark, sf_dir, 8, 12)


@query("topk_no_keyword", f"with {_CHUNKS}, h as (select distinct doc_id from chunks where len({_hits_sql('text', ('zqx', 'the', 'and'))}) > 0) select doc_id, chunk_index, 0.5::double as score from chunks anti join h using (doc_id) where chunk_index < 50")
def topk_no_keyword(spark, sf_dir):
    return retrieval.without_keywords(_line_chunks(spark, sf_dir), ("zqx", "the", "and")).select("doc_id", "chunk_index", "score")


@query("topk_triage", f"""with {FEATURES}, s as (select *, greatest(1, least(6, n_pages)) as cap, page <= 1 as must from scores),
seeds as (select doc_id, page, n_pages from s where must or len(header_hits) > 0 or keyword_unique >= 6),
guard as (select distinct doc_id, g.page from seeds, lateral (select unnest([seeds.page - 1, seeds.page, seeds.page + 1]) as page) g where g.page between 1 and seeds.n_pages),
m as (select s.*, g.page is not null as guard from s left join guard g on g.doc_id = s.doc_id and g.page = s.page),
c as (select *, count_if(guard) over (partition by doc_id) as n_guard, count_if(must) over (partition by doc_id) as n_must, row_number() over (partition by doc_id, must, guard order by score desc, page) as r from m),
fixed as (select doc_id, page from c where case when n_guard >= cap then must or (guard and r <= cap - n_must) else guard end),
free as (select *, cap - n_guard as room, (page - 1) // cast(ceil(n_pages / 4) as int) as seg from c where n_guard < cap and not guard),
sr as (select *, row_number() over (partition by doc_id, seg order by score desc, page) as sr from free),
p0 as (select *, row_number() over (partition by doc_id order by seg, sr) as n from sr where sr <= greatest(1, ceil(room / 4))),
picks as (select doc_id, page from p0 where n <= room),
rest as (select f.doc_id, f.page, room, coalesce(t.taken, 0) as taken, row_number() over (partition by f.doc_id order by score desc, f.page) as g from free f anti join picks p using (doc_id, page) left join (select doc_id, count(*) as taken from picks group by 1) t using (doc_id))
select * from fixed union all select * from picks union all select doc_id, page from rest where g <= room - taken""")
def topk_triage(spark, sf_dir):
    scores = triage.page_scores(triage.page_features(_blocks(spark, sf_dir), **TRIAGE))
    return triage.select_pages(scores, max_pages=6, first_pages=1, unique_words=6)


_HEAD = "'[' || chunk_id || '] (page ' || page || '):' || chr(10)"


@query("lim_prompt", f"""with {_CHUNKS}, m as (select *, contains(text, 'tion') as seed, row_number() over (partition by doc_id, contains(text, 'tion') order by chunk_index) as k from chunks)
select doc_id, sha256('## Passages that keywords found' || chr(10) || coalesce(string_agg(case when seed and k <= 8 then {_HEAD} || text end, chr(10) || chr(10) order by chunk_index), '') || chr(10) || chr(10) || '## Other passages, shortened' || chr(10)
  || coalesce(string_agg(case when not seed and k <= 15 then {_HEAD} || case when len(text) > 300 then left(text, 300) || '...' else text end end, chr(10) || chr(10) order by chunk_index), '')) as digest from m group by doc_id""")
def lim_prompt(spark, sf_dir):
    parts = retrieval.prompt_parts(_line_chunks(spark, sf_dir), F.contains("text", F.lit("tion")))
    return parts.select("doc_id", F.sha2(prompts.expansion(F.col("seeds"), F.col("others")), 256).alias("digest"))


@query("fn_prompt_join", f"with {_CHUNKS} select doc_id, sha256(string_agg('[Chunk ' || chunk_id || ' | Page ' || page || ']' || chr(10) || text, chr(10) || chr(10) || '---' || chr(10) || chr(10) order by chunk_index)) as digest from chunks group by doc_id")
def fn_prompt_join(spark, sf_dir):
    parts = retrieval.prompt_parts(_line_chunks(spark, sf_dir), F.lit(True))
    return parts.select("doc_id", F.sha2(prompts.chunks(F.col("seeds")), 256).alias("digest"))


_PROMPT_CALLS = "c as (select l_orderkey as doc_id, l_linenumber as k, l_partkey as p, l_suppkey as s, case when l_linenumber % 2 = 0 then 'HIGH' end as conviction from lineitem where l_linenumber <= 3 and l_tax > 0.02)"


@query("fn_prompt_calls", f"""with {_PROMPT_CALLS}, t as (select doc_id, string_agg('- S' || p || ': OVERWEIGHT' || coalesce(' (' || conviction || ')', ''), chr(10) order by k, p, s) as lines,
  string_agg('- S' || p || ': OVERWEIGHT | Risks: ' || case when k = 1 then 'None' else 'r' || k || ', x, y' end, chr(10) order by k, p, s) as risks, list(struct_pack(k := k, p := p, s := s, conviction := conviction) order by k, p, s) as l from c group by 1)
select o_orderkey as doc_id, coalesce(lines, 'No allocation calls extracted.') as lines, coalesce(risks, 'No allocation calls extracted.') as risks,
  array_to_string(list_transform(coalesce(l, []), lambda x, i: '[Call ' || (i - 1) || ']' || chr(10) || 'Asset: S' || x.p || ' (C)' || chr(10) || 'Direction: OVERWEIGHT' || coalesce(' (' || x.conviction || ' conviction)', '') || chr(10) || 'Rationale: a; b' || chr(10) || 'Risks: ' || case when x.k = 1 then 'None specified' else 'r' || x.k || ', x' end), chr(10) || chr(10)) as tooltips,
  '[' || array_to_string(list_transform(coalesce(l, []), lambda x, i: '{{"index":' || (i - 1) || ',"asset_class_category":"C","sub_asset_class":"S' || x.p || '","call":"OVERWEIGHT","conviction":' || coalesce('"' || x.conviction || '"', 'null') || ',"rationale_bullets":["a","b","c"],"citations":[{{"chunk_id":"' || x.s || '","page":' || x.k || ',"text_span":"t"}}]}}'), ',') || ']' as verification,
  'Manager: ' || o_orderpriority || chr(10) || 'Document Type: OTHER' || chr(10) || 'Publication Date: ' || case when o_orderkey % 2 = 0 then cast(cast(o_orderdate as date) as varchar) else 'Unknown' end || chr(10) || 'Asset Classes: EQ_DM, FI_HY' || chr(10) || 'Regions: ' || case when o_orderkey % 3 = 0 then 'us' else 'Not specified' end as profile
from orders left join t on o_orderkey = doc_id""")
def fn_prompt_calls(spark, sf_dir):
    t = Tables(spark, sf_dir)
    k, c = F.col("l_linenumber"), F.col
    call = F.struct(
        F.lit("C").alias("asset_class_category"), F.concat(F.lit("S"), c("l_partkey").cast("string")).alias("sub_asset_class"), F.lit("OVERWEIGHT").alias("call"), F.when(k % 2 == 0, "HIGH").alias("conviction"),
        F.array(*map(F.lit, "abc")).alias("rationale_bullets"), F.when(k > 1, F.array(F.concat(F.lit("r"), k.cast("string")), F.lit("x"), F.lit("y"))).alias("key_risks"),
        F.array(F.struct(c("l_suppkey").cast("string").alias("chunk_id"), k.alias("page"), F.lit("t").alias("text_span"))).alias("citations"))
    rows = t.lineitem.where("l_linenumber <= 3 and l_tax > 0.02").groupBy(c("l_orderkey").alias("doc_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", call.alias("call")))), lambda x: x.call).alias("calls"))
    o = t.orders.select(c("o_orderkey").alias("doc_id"), "o_orderpriority", "o_orderdate").join(rows, "doc_id", "left")
    calls = F.coalesce("calls", F.array().cast(rows.schema["calls"].dataType))
    profile = prompts.profile(c("o_orderpriority"), F.lit("OTHER"), F.when(c("doc_id") % 2 == 0, c("o_orderdate").cast("date")), F.array(F.lit("EQ_DM"), F.lit("FI_HY")), F.when(c("doc_id") % 3 == 0, F.array(F.lit("us"))))
    return o.select("doc_id", prompts.calls(calls).alias("lines"), prompts.calls_with_risks(calls).alias("risks"), prompts.calls_for_tooltips(calls).alias("tooltips"), prompts.calls_for_verification(calls).alias("verification"), profile.alias("profile"))


# ---------------------------------------------------------------- sets

@query("set_vocab_union", f"select unnest({_list([*vocab.POSITIONING, *(t for t, _ in vocab.synonym_rows())])}) as keyword union select lower(w) from part, lateral (select unnest(string_split(p_type, ' ')) as w) union select lower(p_brand) from part")
def set_vocab_union(spark, sf_dir):
    """The library's vocabulary and a caller's, which are the words and brands of parts."""
    both = spark.createDataFrame([(w,) for w in vocab.POSITIONING], "keyword string").union(C.synonyms(spark).select("term"))
    part = Tables(spark, sf_dir).part
    return both.union(part.select(F.explode(F.split(F.lower("p_type"), " ")))).union(part.select(F.lower("p_brand"))).distinct()


@query("set_union_keepfirst", f"with {_CHUNKS}, u as (select 0 as o, doc_id, chunk_id from chunks where contains(text, 'tion') union all select 1, doc_id, chunk_id from chunks where contains(text, 'ing')) select doc_id, chunk_id, min(o) as o from u group by 1, 2")
def set_union_keepfirst(spark, sf_dir):
    c = _line_chunks(spark, sf_dir)
    u = c.where("contains(text, 'tion')").select(F.lit(0).alias("o"), "doc_id", "chunk_id").unionByName(c.where("contains(text, 'ing')").select(F.lit(1).alias("o"), "doc_id", "chunk_id"))
    return retrieval.keep_first(u, ["doc_id", "chunk_id"], ["o"])


@query("set_merge_unique", f"select doc_id, array_to_string(list_slice(list_filter(w, lambda x, i: list_position(w, x) = i), 1, 5), ' ') as merged from (select doc_id, {WORDS.format('lower(text)')} as w from documents)")
def set_merge_unique(spark, sf_dir):
    w = T.words(F.lower("text"))
    return Tables(spark, sf_dir).documents.select("doc_id", F.array_join(T.merged_unique(w, w, 5), " ").alias("merged"))


@query("set_pages", "select l_orderkey as doc_id, count(distinct page) as pages from (select l_orderkey, l_linenumber as page from lineitem union all select l_orderkey, l_partkey % 5 from lineitem) group by 1")
def set_pages(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return exports.cited_pages(li.selectExpr("l_orderkey as doc_id", "l_linenumber as page"), li.selectExpr("l_orderkey as doc_id", "l_partkey % 5 as page"))


@query("set_tags", f"with {CALL_ROWS} select doc_id, string_agg(distinct lower(sub_asset_class), ',' order by lower(sub_asset_class)) as subs, string_agg(distinct asset_class_category, ',' order by asset_class_category) as categories from calls group by 1")
def set_tags(spark, sf_dir):
    return C.rule_tags(_calls(spark, sf_dir)).select("doc_id", F.array_join("sub_assets", ",").alias("subs"), F.array_join("categories", ",").alias("categories"))


@query("set_tag_objects", f"""with {CALL_ROWS}, r as (select doc_id, list(distinct asset_class_category) as a, list(distinct sub_asset_class) as s, max(confidence) as confidence from calls group by 1), u as (select doc_id, 'asset_class' as tag_type, unnest(a) as value, 'rule' as source, 1.0 as confidence from r union all select doc_id, 'theme', unnest(s), 'llm', confidence from r)
select doc_id, tag_type, value, source, round(confidence, 6)::double as confidence from u""")
def set_tag_objects(spark, sf_dir):
    r = _calls(spark, sf_dir).groupBy("doc_id").agg(F.collect_set("asset_class_category").alias("a"), F.collect_set("sub_asset_class").alias("s"), F.max("confidence").alias("confidence"))
    return C.tags(r, {"a": ("asset_class", "rule"), "s": ("theme", "llm")}).withColumn("confidence", F.round("confidence", 6))


# ---------------------------------------------------------------- functions and guards

@query("fn_halluc_pct", f"""with {_CLAIMS} select claim_id, chunk_id, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(value, '[a-z]+tion'), lambda m: not contains(chunk, m)))), ',') as markers from claims""")
def fn_halluc_pct(spark, sf_dir):
    return _claims(spark, sf_dir).select("claim_id", "chunk_id", F.array_join(T.ungrounded(F.col("value"), F.col("chunk"), "[a-z]+tion"), ",").alias("markers"))


_MONTH = "case m " + " ".join(f"when '{m}' then len(list_filter({_list(n)}, lambda x: contains(lower(props), x))) > 0" for m, n in vocab.MONTHS.items()) + " end"


@query("fn_date_grounded", f"select o_orderkey, contains(props, y) and (contains(props, m) or contains(props, ltrim(m, '0')) or {_MONTH}) as grounded from (select o_orderkey, strftime(o_orderdate, '%Y') as y, strftime(o_orderdate, '%m') as m, o_orderkey || ' in ' || (1992 + o_orderkey % 7) || case when o_orderkey % 2 = 0 then ' March' else '' end as props from orders)")
def fn_date_grounded(spark, sf_dir):
    k = F.col("o_orderkey")
    source = F.concat(k.cast("string"), F.lit(" in "), (k % 7 + 1992).cast("string"), F.when(k % 2 == 0, " March").otherwise(""))
    return Tables(spark, sf_dir).orders.select("o_orderkey", T.date_grounded(F.date_format("o_orderdate", "yyyy-MM-dd"), source).alias("grounded"))


@query("gd_llm_output", r"""select event_id, case event_id % 6 when 0 then null when 1 then 'Invalid citation chunk_id: zz' when 2 then 'Invalid asset_class_category: NOPE' when 3 then 'Invalid sub_asset_class: NOPE'
  when 4 then 'Mismatched taxonomy: EQ_US belongs to EQ_DM, not EQ_EM' else 'Potential hallucination detected: 2021-03-05, 7.5%' end as fault from events""")
def gd_llm_output(spark, sf_dir):
    k = F.col("event_id") % 6
    category = F.when(k == 2, "NOPE").when(k == 4, "EQ_EM").otherwise("EQ_DM")
    answer = F.concat(F.lit('{"allocation_calls":[{"asset_class_category":"'), category, F.lit('","sub_asset_class":"'), F.when(k == 3, "NOPE").otherwise("EQ_US"), F.lit('","call":"OVERWEIGHT","citations":[{"chunk_id":"c1","page":1}],"review_reason":"from 2021-03-05 at 7.5%"}],"overall_sentiment":"NEUTRAL","sentiment_rationale":[],"sentiment_citations":[{"chunk_id":"'),
                      F.when(k == 1, "zz").otherwise("c2"), F.lit('","page":1}],"sentiment_confidence":0.5}'))
    rows = C.parsed(Tables(spark, sf_dir).events.select("event_id", answer.alias("answer"), answer.alias("output"), F.array(F.lit("c1"), F.lit("c2")).alias("allowed"), F.when(k == 5, "nothing").otherwise("7.5% in March 2021").alias("source")))
    return C.guarded(rows).select("event_id", "fault")


@query("gd_markers", r"""select event_id, case when contains(s, y) and (contains(s, '3') or contains(lower(s), 'mar')) then '' else '2021-03-05' end as dates, case when contains(s, '7.5%') then '' else '7.5%' end as percents from (select event_id, event_id || case when event_id % 2 = 0 then ' 7.5% of ' else ' ' end || case when event_id % 3 = 0 then 'March 2021' else 'n' end as s, '2021' as y from events)""")
def gd_markers(spark, sf_dir):
    k = F.col("event_id")
    source = F.concat(k.cast("string"), F.when(k % 2 == 0, " 7.5% of ").otherwise(" "), F.when(k % 3 == 0, "March 2021").otherwise("n"))
    rows = Tables(spark, sf_dir).events.select("event_id", F.lit('{"as_of": "2021-03-05", "share": "7.5%"}').alias("output"), source.alias("source"))
    return C.llm_faults(rows).select("event_id", F.array_join("dates", ",").alias("dates"), F.array_join("percents", ",").alias("percents"))


@query("fn_json_schema_parse", "select event_id, event_id % 4 = 0 or event_id % 4 = 3 as has_errors, case event_id % 4 when 0 then 'not a JSON object' when 1 then '' when 2 then '' else 'unknown key extra;missing key b' end as errors from events")
def fn_json_schema_parse(spark, sf_dir):
    k = F.col("event_id") % 4
    text = F.when(k == 0, "nothing").when(k == 1, '{"a": 1, "b": "x"}').when(k == 2, '```json\n{"b": null, "a": 2}\n```').otherwise('{"a": 1, "extra": 2}')
    rows = C.parsed(Tables(spark, sf_dir).events.select("event_id", text.alias("answer")), "struct<a:int,b:string>", ("a", "b"))
    return rows.select("event_id", (F.size("errors") > 0).alias("has_errors"), F.array_join("errors", ";").alias("errors"))


@query("prj_call_parse", "select o_orderkey as doc_id, 0 as pos, 'EQ_US' as sub_asset_class, o_totalprice as confidence, 'RISING' as direction, 'See rationale' as why from orders")
def prj_call_parse(spark, sf_dir):
    answer = F.concat(F.lit('{"allocation_calls":[{"asset_class_category":"EQ_DM","sub_asset_class":"EQ_US","call":"OVERWEIGHT","key_indicators":[{"name":"","direction":"improving"}],"citations":[{"chunk_id":"c","page":2}],"confidence":'), F.col("o_totalprice").cast("string"),
                      F.lit('}],"overall_sentiment":"BULLISH","sentiment_rationale":[],"sentiment_citations":[],"sentiment_confidence":0.5}'))
    rows = C.parsed(Tables(spark, sf_dir).orders.select(F.col("o_orderkey").alias("doc_id"), answer.alias("answer")))
    return C.call_rows(rows).select("doc_id", "pos", "sub_asset_class", "confidence", F.col("key_indicators")[0]["direction"].alias("direction"), F.col("key_indicators")[0]["why_it_matters"].alias("why"))


@query("fn_agreement", "select l_orderkey as doc_id, round(avg((l_returnflag = 'A')::int), 6)::double as agreement from lineitem group by 1")
def fn_agreement(spark, sf_dir):
    rows = Tables(spark, sf_dir).lineitem.withColumnRenamed("l_orderkey", "doc_id")
    return metrics.agreement(rows, F.col("l_returnflag") == "A").withColumn("agreement", F.round("agreement", 6))


@query("fn_embedding")
def fn_embedding(spark, sf_dir):
    return Tables(spark, sf_dir).benchmark.select("item_id", providers.hashed_embedding(F.col("text")).alias("embedding"))


@query("gd_expand_skip", f"with {_CHUNKS}, k as (select doc_id, count(*) as n, count_if(contains(text, 'tion')) as hits from chunks group by 1) select doc_id, hits = 0 or least(hits, 8) = n as skip from k")
def gd_expand_skip(spark, sf_dir):
    return retrieval.skips_expansion(_line_chunks(spark, sf_dir), F.contains("text", F.lit("tion")))


_STAGES = ("s0_ingest", "s1_extract", "s2_clean", "s3_index", "s4_metadata", "s5_candidates", "s6_calls", "s7_summaries", "s8_tooltips", "s9_tags", "s10_confidence")


@query("gd_pipeline_error", f"""with r as (select o_orderkey as doc_id, o_orderkey % 12 as n, case when o_orderkey % 5 = 0 then 'it broke' end as message, case o_orderkey % 3 when 0 then 'LLMError' when 1 then 'ValidationError' else 'Oops' end as kind from orders)
select doc_id, case when message is not null then 'failed' when n = 11 then 'completed' when n > 0 then 'processing' else 'pending' end as status, case when message is not null then replace(kind, 'Oops', 'PipelineError') end as error_type,
  case when message is not null then replace(kind, 'Oops', 'PipelineError') || ': it broke' || case when n = 0 then ' (before any stage)' else ' (after stage ' || ({_list(_STAGES)})[n] || ')' end end as error from r""")
def gd_pipeline_error(spark, sf_dir):
    k = F.col("o_orderkey")
    runs = Tables(spark, sf_dir).orders.select(k.alias("doc_id"), (k % 12).cast("int").alias("n_stages"), F.when(k % 5 == 0, "it broke").alias("message"), F.when(k % 3 == 0, "LLMError").when(k % 3 == 1, "ValidationError").otherwise("Oops").alias("error_type"))
    return exports.outcomes(runs, _STAGES)


# ---------------------------------------------------------------- streams (an extension)

@query("st_tumbling", "select time_bucket(interval 1 hour, ts) as start, time_bucket(interval 1 hour, ts) + interval 1 hour as \"end\", event_type, count(*) as n, round(sum(value), 4)::double as total from events group by 1, 2, 3")
def st_tumbling(spark, sf_dir):
    return streaming.event_windows(Tables(spark, sf_dir).events).withColumn("total", F.round("total", 4))


@query("st_sessions", """with g as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 30 minutes then 0 else 1 end as new from events), s as (select *, sum(new) over (partition by user_id order by ts rows unbounded preceding) as k from g)
select user_id, min(ts) as start, max(ts) + interval 30 minutes as "end", count(*) as n from s group by user_id, k""")
def st_sessions(spark, sf_dir):
    return streaming.sessions(Tables(spark, sf_dir).events)


def _squeezed(rows):
    text = F.trim(F.regexp_replace("value", r"[ \t\n\r]+", " "))
    return rows.select("doc_id", text.alias("value"), F.when(text == "", "no text").alias("error"))


def _counted(rows):
    n = F.size(F.split("value", " "))
    return rows.select("doc_id", n.cast("string").alias("value"), F.when(n < 5, "too short").alias("error"))


@query("st_stages", r"""with t as (select doc_id, trim(regexp_replace(coalesce(text, ''), '[ \t\n\r]+', ' ', 'g')) as v from documents), n as (select *, len(string_split(v, ' ')) as n from t),
e as (select *, case when v = '' then 'no text' when n < 5 then 'too short' end as error from n)
select doc_id, case when error is null then 'done' else 'failed' end as status, case error when 'no text' then 'clean' when 'too short' then 'count' end as stage,
  (case when error is null then 1 else 2 end)::int as attempts, case when error is null then n::varchar end as value, error from e""")
def st_stages(spark, sf_dir):
    """All documents through two stages as a stream; those that fail are tried twice."""
    docs = spark.readStream.schema(Tables(spark, sf_dir).documents.schema).parquet(f"{sf_dir}/documents*.parquet")  # a pattern: a stream takes no path of one file
    docs = docs.select("doc_id", F.timestamp_seconds(F.lit(0)).alias("ts"), F.col("text").alias("value"))
    names, path, n = ("clean", "count"), scratch(spark, "stages"), Tables(spark, sf_dir).documents.select("doc_id").distinct().count()
    q = stages.start(docs, list(zip(names, (_squeezed, _counted), strict=True)), path, tries=2, delay_ms=100, every="0 seconds")
    try:
        stages.wait(q, lambda: stages.ended(spark, path, names).count() == n)
    finally:
        q.stop()
    return stages.ended(spark, path, names)


def flagship(spark, sf_dir):
    """Documents to blocks, sections and chunks, ranked by keyword density."""
    c = chunking.chunks(documents.blocks(Tables(spark, sf_dir).documents).withColumn("text", T.normalize_text(F.col("text"))))
    return retrieval.ranked_by_density(c, [*vocab.keywords(), *COMMON]).select("doc_id", "chunk_id", "page", "density", "place")


_NORMAL_SQL = (
    _CHUNK_SQL.replace("{whole}", _WHOLE).replace("blocks as (select doc_id, pos, page, idx, page ||", "raw as (select doc_id, pos, page, idx, page ||")
    .replace(",\ncut as", ",\nblocks as (select * replace (" + STRIP.format("regexp_replace(replace(text, '-' || chr(10), ''), ' +', ' ', 'g')") + " as text) from raw),\ncut as", 1))
_FLAGSHIP_SQL = _NORMAL_SQL.replace("\nselect doc_id, chunk_index, doc_id ||", ",\nchunked as (select doc_id, chunk_index, doc_id ||") + f"""),
d as (select *, len({_hits_sql('text', [*vocab.keywords(), *COMMON])}) as density from chunked)
select doc_id, chunk_id, page, density, row_number() over (partition by doc_id order by density desc, page, chunk_index) as place from d where density > 0 qualify place <= 30"""


@query("flagship", _FLAGSHIP_SQL)
def flagship_query(spark, sf_dir):
    return flagship(spark, sf_dir).withColumn("density", F.col("density").cast("long")).withColumn("place", F.col("place").cast("long"))
