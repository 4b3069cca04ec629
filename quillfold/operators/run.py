"""A whole run over a corpus: documents to calls, scores, routes and stored results.

Each stage is one set of DataFrame operations over all documents, and what a
stage asks of a model is asked once for each different prompt and written before
it is used. A document that fails at a stage goes on as a row with its error; the
others don't wait for it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import prompts, schemas, vocab
from ..functions import text as T
from ..sources.registry_tables import Registry
from . import calls as C
from . import chunking, confidence, documents, exports, providers, retrieval, triage

STAGES = ("s0_ingest", "s1_extract", "s2_clean", "s3_index", "s4_metadata", "s5_candidates", "s6_calls", "s7_summaries", "s8_tooltips", "s9_tags", "s10_confidence")
NO_ASSETS = "no asset class tag"
#: Chunks that a provider names come after those with keywords in a prompt.
LAST = 1_000_000


@dataclass
class Run:
    """What a run gives: one row per document in ``outcomes`` and ``profiles``, rows per document in the others."""

    outcomes: DataFrame
    profiles: DataFrame
    calls: DataFrame
    tags: DataFrame
    chunks: DataFrame


def _asked(rows: DataFrame, stage: str, context: Column, ask: Callable, path: str) -> DataFrame:
    """``rows`` with ``answer`` of a stage's prompt about ``context``; prompts that were asked before aren't asked again."""
    told = rows.withColumn("prompt", schemas.prompt(stage, context))
    answers = providers.answers(told, ask, f"{path}/answers-{stage}")
    return told.withColumn("prompt_hash", T.hash16(F.col("prompt"))).join(answers, "prompt_hash", "left").drop("prompt_hash", "prompt")


def _stored(rows: DataFrame, path: str) -> DataFrame:
    """``rows``, written once and read by all that follows."""
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


#: What the front matter is asked for among a document's chunks.
METADATA_QUERY = "asset manager, title, publication date and as-of date of this outlook"


def summary_queries(rows: DataFrame) -> DataFrame:
    """``doc_id, query_order, query``: what a document is, its mood, and the assets it speaks of first."""
    mood = F.concat_ws(" ", "overall_sentiment", F.lit("sentiment"), F.slice("sentiment_rationale", 1, 2))
    assets = F.concat_ws(" ", F.slice(F.array_distinct(F.transform("calls", lambda c: c.sub_asset_class)), 1, 3), F.lit("outlook"))
    return _queries(rows, F.concat_ws(" ", "document_type", "manager_name"), mood, assets)


def tag_queries(rows: DataFrame) -> DataFrame:
    """``doc_id, query_order, query``: the outlook, the risks, and the regime."""
    risks = F.concat_ws(" ", F.lit("risks uncertainties"), F.slice(F.array_distinct(F.flatten(F.transform("calls", lambda c: F.coalesce(c.key_risks, F.array().cast("array<string>"))))), 1, 3))
    return _queries(rows, F.concat_ws(" ", "document_type", F.lit("macro outlook themes")), risks, F.lit("growth inflation policy rates regime"))


def _queries(rows: DataFrame, *texts: Column) -> DataFrame:
    return rows.select("doc_id", F.posexplode(F.array(*texts)).alias("query_order", "query"))


def _parsed(rows: DataFrame, stage: str) -> DataFrame:
    """``value`` and ``problem``, the first thing that is wrong with an answer, or null."""
    out = C.parsed(rows, schemas.record_type(stage).simpleString(), schemas.keys(stage))
    wrong = F.concat(F.array_compact(F.array("ask_error")), "errors", schemas.limits(stage, F.col("value")))
    return out.withColumn("problem", F.get(wrong, F.lit(0))).drop("ask_error")


def cleaned_blocks(blocks: DataFrame, disclaimers: Sequence[str] = vocab.DISCLAIMERS, **pages) -> DataFrame:
    """Normalised blocks without boilerplate, disclaimers marked, long documents cut to their chosen pages."""
    rows = blocks.withColumn("text", T.normalize_text(F.col("text")))
    return triage.triage(documents.drop_boilerplate(documents.mark_disclaimers(rows, disclaimers)), **pages)


def candidate_chunks(chunks: DataFrame, words: Sequence[str], keep: int = 30) -> DataFrame:
    """The chunks that calls are read from: by density of keywords, or the first ones where no chunk has any."""
    found = retrieval.ranked_by_density(chunks, words, keep).select("doc_id", "chunk_id", "page", "text", "place")
    rest = retrieval.without_keywords(chunks, words, keep).select("doc_id", "chunk_id", "page", "text", (F.col("chunk_index") + 1).cast("int").alias("place"))
    return found.unionByName(rest)


def _context(chunks: DataFrame, order: str) -> DataFrame:
    """``doc_id, parts, allowed, source``: a document's chosen chunks in order, their ids, and their text."""
    row = F.struct(order, "chunk_id", "page", "text")
    part = F.transform(F.array_sort(F.collect_list(row)), lambda c: F.struct(c.chunk_id.alias("chunk_id"), c.page.alias("page"), c.text.alias("text")))
    return chunks.groupBy("doc_id").agg(part.alias("parts")).select(
        "doc_id", "parts", F.transform("parts", lambda c: c.chunk_id).alias("allowed"), F.array_join(F.transform("parts", lambda c: c.text), " ").alias("source"))


def run(docs: DataFrame, ask: Mapping[str, Callable], path: str, asof: Column, words: Sequence[str] | None = None, known: DataFrame | None = None,
        embed: Callable[[Column], Column] = providers.hashed_embedding, **pages) -> Run:
    """Run all stages over ``docs`` (``doc_id, text``), store results in the registry at ``path``, and return them.

    ``ask`` gives a provider for each of the stages ``metadata``, ``calls``,
    ``summaries``, ``tooltips`` and ``tags``: a pandas function from prompts to
    answers. With one for ``candidates``, too, documents with keywords are asked for
    further chunks; if it fails there are none. ``embed`` makes vectors of texts:
    the front matter and the passages of summaries and tags are retrieved by them.
    What stages share is written under ``path``. Copies of a document (or of one in ``known``) aren't run again; they
    have the status of their owner's copy, ``duplicate``. ``pages`` are options of
    the page triage.
    """
    spark = docs.sparkSession
    words = list(words if words is not None else vocab.keywords())
    registry = Registry(spark, path)
    work = f"{path}/work-{uuid.uuid4().hex}"
    ingested = documents.ingest(docs, registry=known)
    own = docs.join(ingested.where("not is_duplicate").select("doc_id"), "doc_id", "left_semi")
    blocks = documents.blocks(own)
    extraction = documents.coverage(blocks).join(confidence.structure_quality(blocks), "doc_id").withColumn("ocr", F.lit(1.0)).withColumn("tables", F.lit(1.0))
    extraction = extraction.select("doc_id", "coverage", confidence.extraction_quality().alias("extraction"))
    chunks = chunking.chunks(cleaned_blocks(blocks, **pages))
    registry.save("evidence_blocks", chunks.select("doc_id", "chunk_id", "page", "text", F.lit("PARAGRAPH").alias("block_type"), F.lit(None).cast("string").alias("bbox")))
    chunks = registry.read("evidence_blocks").withColumn("chunk_index", F.element_at(F.split("chunk_id", "_"), -1).cast("int"))  # stored once, read by all later stages

    # profile
    hits = retrieval.nearest_chunks(chunks, _queries(chunks.select("doc_id").distinct(), F.lit(METADATA_QUERY)), embed, 8)
    front = _stored(retrieval.metadata_chunks(chunks, hits), f"{work}/front")
    front = front.join(chunks.select("doc_id", "chunk_id", "page", "text"), ["doc_id", "chunk_id"])
    meta = _parsed(_asked(_context(front, "place"), "metadata", prompts.chunks(F.col("parts")), ask["metadata"], path), "metadata")
    v = F.col("value")
    meta = meta.select(
        "doc_id", "problem", T.manager_name(v["manager_name"]).alias("manager_name"), v["title"].alias("title"), T.plausible_date(v["publication_date"], asof).alias("publication_date"),
        F.try_to_date(v["as_of_date"], "yyyy-MM-dd").alias("as_of_date"), F.coalesce(v["document_type"], F.lit("OTHER")).alias("document_type"),
        F.coalesce(v["asset_classes_covered"], F.array().cast("array<string>")).alias("assets"), F.coalesce(v["regions"], F.array().cast("array<string>")).alias("regions"),
        F.coalesce(v["manager_name_uncertain"], F.lit(False)).alias("said_uncertain"))
    meta = _stored(meta, f"{work}/meta").withColumn("manager_unclear", F.col("said_uncertain") | (F.col("manager_name") == "Unspecified")).withColumn("date_unclear", F.col("publication_date").isNull())

    # calls
    picked = candidate_chunks(chunks, words)
    if "candidates" in ask:
        having = F.size(T.hits(F.col("text"), words, vocab.WHOLE_WORDS)) > 0
        more = providers.expansion(chunks, having, ask["candidates"], f"{path}/answers-candidates")
        picked = picked.unionByName(more.select("doc_id", "chunk_id", "page", "text", (F.col("place") + LAST).alias("place")))
    told = _asked(_context(picked, "place"), "calls", prompts.chunks(F.col("parts")), ask["calls"], path)
    answers = C.guarded(_parsed(told, "calls").withColumn("output", F.col("answer")))
    answers = _stored(answers.withColumn("problem", F.coalesce("problem", "fault")), f"{work}/answers")
    rows = C.call_rows(answers.where("problem is null"))
    lists = {"rationale_bullets": 5, "key_indicators": 5, "key_risks": 5, "citations": 5}
    merged = C.merged_calls(rows, ["doc_id", "asset_class_category", "sub_asset_class"], ["pos"], ["conviction", "time_horizon"], lists, ["pos", "call", "needs_analyst_review"])
    merged = merged.withColumn("needs_analyst_review", F.coalesce("needs_analyst_review", F.lit(False)) | F.col("merged"))
    merged = merged.withColumn("place", F.row_number().over(Window.partitionBy("doc_id").orderBy("pos", "asset_class_category", "sub_asset_class")) - 1)
    merged = _stored(merged, f"{work}/merged")
    fields = ("asset_class_category", "sub_asset_class", "call", "conviction", "rationale_bullets", "key_risks", "citations", "confidence")
    by_doc = merged.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", F.struct(*fields).alias("c")))), lambda x: x.c).alias("calls"),
                                          F.collect_list("confidence").alias("scores"), F.avg("confidence").alias("mean"), F.bool_or("needs_analyst_review").alias("review"))

    # texts about the calls
    base = answers.where("problem is null").select("doc_id", "value.overall_sentiment", "value.sentiment_rationale").join(by_doc, "doc_id").join(meta.select("doc_id", "document_type", "manager_name"), "doc_id", "left")
    base = _stored(base, f"{work}/base")
    told = base.join(_context(retrieval.passages(chunks, summary_queries(base), embed, 20, 30), "place"), "doc_id")
    said = _parsed(_asked(told, "summaries", F.concat(prompts.calls(F.col("calls")), F.lit("\n\n"), prompts.chunks(F.col("parts"))), ask["summaries"], path), "summaries").select(
        "doc_id", F.col("problem").alias("summary_problem"), F.col("value").alias("summary"))
    said = _stored(said, f"{work}/said")
    tips = _parsed(_asked(base.select("doc_id", "calls"), "tooltips", prompts.calls_for_tooltips(F.col("calls")), ask["tooltips"], path), "tooltips")
    tips = tips.select("doc_id", F.posexplode("value.tooltips").alias("pos", "t")).select("doc_id", "pos", "t.sub_asset_class", "t.tooltip_text")
    zipped = exports.zipped_tooltips(merged.select("doc_id", F.col("place").alias("pos"), "sub_asset_class"), tips).where("fault is null or fault = 'missing tooltip'")
    final = merged.join(zipped.select("doc_id", F.col("pos").alias("place"), "tooltip_text"), ["doc_id", "place"], "left")
    profile = prompts.profile(F.col("manager_name"), F.col("document_type"), F.col("publication_date"), F.col("assets"), F.col("regions"))
    seen = _context(retrieval.passages(chunks, tag_queries(base), embed, 15, 20), "place").select("doc_id", "parts")
    about = F.concat(profile, F.lit("\n\n"), prompts.calls_with_risks(F.col("calls")), F.lit("\n\n"), prompts.chunks(F.col("parts")))
    tagged = _parsed(_asked(meta.join(base.select("doc_id", "calls"), "doc_id").join(seen, "doc_id"), "tags", about, ask["tags"], path), "tags")
    tagged = tagged.where("problem is null").join(C.rule_tags(merged), "doc_id").select("doc_id", "categories", "sub_assets", "regions", "value.theme_tags", "value.risk_tags", "value.macro_regime_tags", F.col("value.confidence").alias("confidence"))
    none = F.array().cast("array<string>")
    tagged = tagged.select("doc_id", "confidence", *[F.coalesce(c, none).alias(c) for c in ("categories", "regions", "theme_tags", "risk_tags", "macro_regime_tags")])
    tags = C.tags(tagged, {"categories": ("asset_class", "rule"), "regions": ("region", "rule"), "theme_tags": ("theme", "llm"), "risk_tags": ("risk", "llm"), "macro_regime_tags": ("macro_regime", "llm")})

    # evidence and scores
    texts = chunks.select("chunk_id", "page", "text")
    managers = front.select("doc_id", "chunk_id").join(meta.select("doc_id", "manager_name"), "doc_id").select(F.col("doc_id").alias("claim_id"), F.col("manager_name").alias("value"), "chunk_id")
    profile_score = confidence.evidence(managers, texts).select(F.col("claim_id").alias("doc_id"), F.col("strength").alias("profile"))
    points = said.where("summary_problem is null").select("doc_id", F.posexplode("summary.key_takeaways").alias("takeaway", "t"))
    points = points.select("doc_id", "takeaway", F.col("t.text").alias("value"), F.explode("t.citations.chunk_id").alias("chunk_id")).join(texts, "chunk_id")
    points = points.select("doc_id", "takeaway", T.word_overlap(F.col("value"), F.col("text")).alias("overlap"), "page")
    cites = said.where("summary_problem is null").select("doc_id", F.explode("summary.citations.page").alias("page"))
    rows = ingested.select("doc_id", "file_hash", "document_id", "is_duplicate").join(extraction, "doc_id", "left").join(meta, "doc_id", "left").join(answers.select("doc_id", F.col("problem").alias("call_problem")), "doc_id", "left")
    rows = rows.join(by_doc.drop("calls"), "doc_id", "left").join(said, "doc_id", "left").join(confidence.summary_evidence(points, cites).withColumnRenamed("summary", "summary_score"), "doc_id", "left").join(profile_score, "doc_id", "left")
    c = F.col
    rows = rows.withColumn("scores", F.coalesce("scores", F.array().cast("array<double>")))
    rows = rows.withColumn("score", confidence.document_score(F.coalesce("extraction", F.lit(0.0)), F.coalesce("profile", F.lit(0.0)), c("mean"), F.coalesce("summary_score", F.lit(0.0)))).withColumn("band", T.band(c("score")))
    unclear = [F.coalesce(x, F.lit(True)) for x in ("manager_unclear", "date_unclear")]
    reasons = confidence.attention(F.coalesce("coverage", F.lit(0.0)), F.lit(1.0), *unclear, c("scores"), F.coalesce("review", F.lit(False)))
    rows = rows.withColumn("reasons", reasons).withColumn("required", (F.size("reasons") > 0) | (c("band") == "LOW"))
    auto = confidence.auto_publishable(c("score"), F.coalesce("coverage", F.lit(0.0)), c("required"), *unclear)
    rows = rows.withColumn("route", confidence.route(c("band"), auto, confidence.spot_checked(c("doc_id"))))

    rows = _stored(rows, f"{work}/rows")

    # how far each document came, and why it stopped
    some = F.size("scores") > 0
    stops = ((c("extraction").isNull(), 1, "ExtractionError", "no text"), (c("problem").isNotNull(), 4, "LLMError", c("problem")), (c("call_problem").isNotNull(), 6, "ValidationError", c("call_problem")),
             (~some, 9, "ExtractionError", NO_ASSETS), (c("summary_problem").isNotNull(), 7, "LLMError", c("summary_problem")))
    stage, kind, message = F.lit(len(STAGES)), F.lit(None).cast("string"), F.lit(None).cast("string")
    for when, n, name, said_why in reversed(stops):
        stage, kind = F.when(when, n).otherwise(stage), F.when(when, name).otherwise(kind)
        message = F.when(when, F.lit(said_why) if isinstance(said_why, str) else said_why).otherwise(message)
    ended = rows.where("not is_duplicate").select("doc_id", stage.alias("n_stages"), kind.alias("error_type"), message.alias("message"))
    status = exports.outcomes(ended, STAGES)
    outcomes = rows.join(status, "doc_id", "left").select(
        "doc_id", "document_id", F.when(c("is_duplicate"), "duplicate").otherwise(c("status")).alias("status"), "error_type", "error", *[F.when(c("status") == "completed", c(x)).alias(x) for x in ("score", "band", "route", "reasons")], F.size("scores").alias("n_calls"))
    log = status.select(F.concat(F.lit("run_"), c("doc_id").cast("string")).alias("run_id"), "doc_id", F.current_timestamp().alias("ts"), "status", "error")
    # all results of a document change at once; those of an earlier run go
    registry.publish({
        "documents": rows.where("not is_duplicate").join(status, "doc_id").select("doc_id", "file_hash", "title", "status", c("score").alias("confidence"), c("coverage").alias("extraction_coverage")),
        "allocation_calls": final.select("doc_id", c("place").alias("pos"), "asset_class_category", "sub_asset_class", "call", "conviction", "confidence", "tooltip_text"),
        "document_tags": tags.select("doc_id", "tag_type", "value", "confidence", "source"),
        "summaries": said.where("summary_problem is null").select("doc_id", "summary.executive_summary", "summary.search_descriptor"),
        "pipeline_runs": log,
    }, own.select("doc_id"))
    return Run(outcomes, meta.drop("problem", "said_uncertain"), final, tags, chunks)
