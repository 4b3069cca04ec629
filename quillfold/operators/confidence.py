"""Evidence, confidence and routing: weighted scores per document, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# fixed values: weights of the scores
EXTRACTION = {"coverage": 0.4, "ocr": 0.2, "tables": 0.2, "structure": 0.2}
EVIDENCE = {"explicit": 0.5, "overlap": 0.3, "entailment": 0.2}
SUMMARY = {"alignment": 0.6, "citations": 0.2, "pages": 0.2}
DOCUMENT = {"extraction": 0.15, "profile": 0.15, "calls": 0.5, "summary": 0.2}
SPOT_CHECK_SHARE = 20
#: Claims on one chunk that are answered in one row.
CLAIMS = 64


def structure_quality(blocks: DataFrame) -> DataFrame:
    kinds = F.countDistinct("block_type")
    score = (F.when(F.bool_or(F.col("block_type") == "HEADING"), 0.4).otherwise(0.0) + F.when(F.bool_or(F.col("block_type") == "PARAGRAPH"), 0.3).otherwise(0.0)
             + F.when(kinds >= 3, 0.3).when(kinds == 2, 0.15).otherwise(0.0))
    return blocks.groupBy("doc_id").agg(score.alias("structure"))


def ocr_quality(texts: DataFrame, text_col: str = "ocr_text") -> DataFrame:
    """``ocr``: 1 without OCR text (null), 0 for blank text, else the share of readable characters; texts end in a space."""
    t = F.concat(F.col(text_col), F.lit(" "))
    bad = F.regexp_count(t, F.lit(r"[\p{C}□■▪▫●○◆◇]"))
    return texts.withColumn("ocr", F.when(F.col(text_col).isNull(), 1.0).when(T.strip(F.col(text_col)) == "", 0.0).otherwise(1 - bad / F.length(t)))


def table_success(tables: DataFrame) -> DataFrame:
    return tables.groupBy("doc_id").agg(F.coalesce(F.avg((F.col("n_cells") > 0).cast("double")), F.lit(1.0)).alias("tables"))


def extraction_quality() -> Column:
    return sum((w * F.coalesce(F.col(c), F.lit(1.0 if c in ("ocr", "tables") else 0.0)) for c, w in EXTRACTION.items()), F.lit(0.0))


def evidence(claims: DataFrame, chunks: DataFrame, together: int = CLAIMS) -> DataFrame:
    """``claim_id, strength``: the best of a claim's citations (``claim_id, value, chunk_id``); 0 without any known chunk.

    Claims go to the texts: those on one chunk are packed, about ``together`` in a
    row, so a text moves once for that many (and not at all where the packed claims
    are few enough to be broadcast), and is put in lower case and cut into words
    once. A chunk that very many claims cite is spread over many rows. Repeated
    citations count once; null ids of claims or chunks meet no chunk.
    """
    c = claims.select("claim_id", "value", "chunk_id").distinct()
    parts = c.where("chunk_id is not null").groupBy("chunk_id").agg(F.ceil(F.count(F.lit(1)) / together).alias("n")).where("n > 1").withColumnRenamed("chunk_id", "_chunk")
    dealt = c.join(parts, F.col("chunk_id") == F.col("_chunk"), "left").withColumn("part", F.pmod(F.xxhash64("claim_id", "value"), F.coalesce("n", F.lit(1))))
    packed = dealt.groupBy("chunk_id", "part").agg(F.collect_list(F.struct("claim_id", "value")).alias("claims"))

    def score(x: Column, low: Column, words: Column) -> Column:
        return T.once(F.coalesce(x.value, F.lit("")), lambda v: EVIDENCE["explicit"] * T.mentioned_in(x.value, low) + EVIDENCE["overlap"] * T.shared_words(T.long_words(v), words)
                      + EVIDENCE["entailment"] * T.entailed_by(v, low))

    known = F.struct(F.lower("text").alias("low"), T.long_words(F.col("text")).alias("words"))
    found = T.once(known, lambda k: F.transform("claims", lambda x: F.struct(x.claim_id.alias("claim_id"), score(x, k.low, k.words).alias("score"))))
    met = packed.join(chunks.select("chunk_id", "text").where("text is not null"), "chunk_id").select(F.explode(found).alias("f")).select("f.claim_id", "f.score")
    rows = met.unionByName(claims.select("claim_id", F.lit(0.0).alias("score")))
    return rows.groupBy("claim_id").agg(F.max("score").alias("strength"))


def call_evidence(strength: Column, direction: Column, text: Column) -> Column:
    return 0.5 * strength + 0.5 * T.call_language(direction, text)


def summary_evidence(takeaways: DataFrame, citations: DataFrame) -> DataFrame:
    """``takeaways``: ``doc_id, takeaway, overlap, page`` per citation; ``citations``: ``doc_id, page`` of the summary itself."""
    best = takeaways.groupBy("doc_id", "takeaway").agg(F.max("overlap").alias("best")).groupBy("doc_id").agg(F.avg("best").alias("alignment"))
    count = citations.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_citations"))
    pages = citations.select("doc_id", "page").unionByName(takeaways.select("doc_id", "page")).groupBy("doc_id").agg(F.countDistinct("page").alias("n_pages"))
    out = pages.join(best, "doc_id", "left").join(count, "doc_id", "left")
    score = SUMMARY["alignment"] * F.coalesce("alignment", F.lit(0.0)) + SUMMARY["citations"] * F.least(F.lit(1.0), F.coalesce("n_citations", F.lit(0)) / 4) + SUMMARY["pages"] * F.least(F.lit(1.0), F.col("n_pages") / 4)
    return out.select("doc_id", score.alias("summary"))


def document_score(extraction: Column, profile: Column, calls: Column, summary: Column) -> Column:
    """``calls`` is the mean call confidence; a document without calls counts 0.5 there."""
    return DOCUMENT["extraction"] * extraction + DOCUMENT["profile"] * profile + DOCUMENT["calls"] * F.coalesce(calls, F.lit(0.5)) + DOCUMENT["summary"] * summary


def attention(coverage: Column, ocr: Column, manager_unclear: Column, date_unclear: Column, scores: Column, review: Column) -> Column:
    """The reasons for an analyst's attention, in order; ``scores`` is the array of call confidences, ``review`` whether a call asks for it."""
    n = F.size(scores)
    low = lambda x: F.size(F.filter(scores, lambda s: s < x))
    return F.array_compact(F.array(
        F.when(coverage < 0.5, "low_extraction_coverage"), F.when(ocr < 0.7, "poor_ocr_quality"), F.when(manager_unclear, "manager_name_unclear"),
        F.when(date_unclear, "publication_date_unclear"), F.when(review, "call_needs_review"), F.when(low(0.5) > 0, "low_confidence_call"),
        F.when(n == 0, "no_calls_extracted"), F.when((n > 0) & (low(0.6) > n * 0.3), "many_low_confidence_calls")))


def field_confidences(extraction: Column, profile: Column, calls: Column, n_calls: Column, summary: Column, n_citations: Column, n_takeaways: Column) -> Column:
    def field(name, value, reasons, explicit):
        return F.struct(F.lit(name).alias("field_name"), value.cast("double").alias("confidence"), reasons.alias("reasons"), explicit.alias("has_explicit_evidence"), value.cast("double").alias("evidence_strength"))

    text = lambda n, s: F.concat(n.cast("string"), F.lit(s))
    return F.array(
        field("extraction_quality", extraction, F.array(F.lit("text_coverage"), F.lit("structure_quality")), F.lit(True)),
        field("profile", profile, F.array(F.lit("manager_name_evidence")), profile > 0.5), field("calls", calls, F.array(text(n_calls, " calls extracted")), calls > 0.5),
        field("summary", summary, F.array(F.lit("summary_evidence"), text(n_citations, " summary citations"), text(n_takeaways, " takeaways")), n_citations >= 2))


def auto_publishable(score: Column, coverage: Column, required: Column, manager_unclear: Column, date_unclear: Column) -> Column:
    return (score >= 0.8) & (coverage >= 0.7) & ~required & ~manager_unclear & ~date_unclear


def spot_checked(doc_id: Column, share: int = SPOT_CHECK_SHARE) -> Column:
    """A fixed share of documents, by the hash of their id: a run that repeats routes them alike."""
    return F.pmod(F.conv(F.substring(F.sha2(doc_id.cast("string"), 256), 1, 8), 16, 10).cast("long"), F.lit(100)) < share


def route(band: Column, auto: Column, spot: Column) -> Column:
    return F.when(band == "HIGH", F.when(auto, "auto_publish").otherwise("must_review")).when(band == "MEDIUM", F.when(spot, "spot_check").otherwise("auto_publish")).otherwise("must_review")
