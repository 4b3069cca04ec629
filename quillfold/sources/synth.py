"""Synthetic documents for evaluations, with answers of a model and an index that need no service.

Everything is a function of the document's number, so repeated runs are alike.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGES = 6
#: Words of documents whose calls can't be read, that have none, or that name a wrong category.
ODD = ("broken", "nothing", "astray")
#: What a document of each variant prefers, avoids and expects.
VARIANTS = (
    ("US equities", "european credit", "slower inflation"), ("emerging market bonds", "the dollar", "rate cuts"), ("gold", "long treasuries", "higher deficits"),
    ("investment grade credit", "small caps", "a soft landing"), ("japan equities", "real estate", "a weaker yen"),
)
#: The heading of each page and its sentence, about the variant's three subjects.
LINES = (
    ("Executive summary", "We are overweight {0} and underweight {1}."), ("Macro outlook", "Our base case is {2}."), ("Asset allocation", "We prefer {0} and increase exposure to it."),
    ("Fixed income", "We remain cautious on {1}."), ("Risks", "The main risk to our view is that {2} does not come."), ("Appendix", "Past performance is no guide."),
)


def documents(spark: SparkSession, n: int) -> DataFrame:
    """``doc_id, page, text, published, as_of`` of n documents of six pages each."""
    def filled(k: int, line: int):
        return LINES[line][0] + "\n" + LINES[line][1].format(*VARIANTS[k])

    text = F.create_map(*[x for k in range(len(VARIANTS)) for p in range(PAGES) for x in (F.lit(k * PAGES + p), F.lit(filled(k, p)))])
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.explode(F.sequence(F.lit(1), F.lit(PAGES))).alias("page"))
    at = ((F.col("doc_id") % len(VARIANTS)) * PAGES + F.col("page") - 1).cast("int")
    return rows.select("doc_id", "page", F.concat(F.element_at(text, at), F.lit("\nPage "), F.col("page").cast("string"), F.lit(".")).alias("text"),
                       F.to_date(F.lit("2025-07-15")).alias("published"), F.to_date(F.lit("2025-06-30")).alias("as_of"))


def index(pages: DataFrame) -> DataFrame:
    """One chunk for each page: ``doc_id, chunk_index, chunk_id, block_ids, page, text``."""
    return pages.select("doc_id", (F.col("page") - 1).alias("chunk_index"), F.concat_ws("_", F.col("doc_id").cast("string"), (F.col("page") - 1).cast("string")).alias("chunk_id"),
                        F.array(F.concat_ws("_", F.col("page").cast("string"), F.lit("0"))).alias("block_ids"), "page", "text")


def answers(pages: DataFrame) -> DataFrame:
    """``doc_id, answer``: what a model would say to the calls stage, three calls that cite the document's own pages."""
    cite = lambda page: F.array(F.struct(F.concat_ws("_", F.col("doc_id").cast("string"), F.lit(str(page - 1))).alias("chunk_id"), F.array(F.lit(f"{page}_0")).alias("block_ids"), F.lit(page).alias("page"), F.lit("as stated").alias("text_span")))
    call = lambda category, sub, way, page, score: F.struct(F.lit(category).alias("asset_class_category"), F.lit(sub).alias("sub_asset_class"), F.lit(way).alias("call"), F.array(F.lit("stated view")).alias("rationale_bullets"), cite(page).alias("citations"), F.lit(score).alias("confidence"))
    three = F.array(call("EQ_DM", "EQ_US", "OVERWEIGHT", 1, 0.9), call("FI_SOV_NA", "US_TREASURIES", "UNDERWEIGHT", 4, 0.8), call("ALT_COMMODITIES", "GOLD", "NEUTRAL", 3, 0.7))
    record = F.struct(three.alias("allocation_calls"), F.lit("NEUTRAL").alias("overall_sentiment"), F.array(F.lit("mixed")).alias("sentiment_rationale"), cite(2).alias("sentiment_citations"), F.lit(0.8).alias("sentiment_confidence"))
    return pages.select("doc_id").distinct().select("doc_id", F.to_json(record).alias("answer"))


def cited(prompt: str) -> list[dict]:
    """A citation of the first chunk of a prompt."""
    found = re.findall(r"\[Chunk (\S+) \| Page (\d+)\]", prompt)
    return [{"chunk_id": c, "block_ids": [], "page": int(p), "text_span": "We are overweight"} for c, p in found[:1]]


def metadata(prompts: pd.Series) -> pd.Series:
    """An answer of the metadata stage, the same for each document."""
    one = lambda p: {"manager_name": "Acme Capital", "title": "Outlook", "publication_date": "2025-07-15", "as_of_date": None, "document_type": "OTHER", "asset_classes_covered": ["EQ_DM"], "regions": ["us"],
                     "time_horizon": None, "intended_audience": None, "citations": cited(p), "manager_name_uncertain": False, "publication_date_uncertain": False}
    return prompts.map(lambda p: json.dumps(one(p)))


def call(category: str, sub: str, confidence: float, cites: list[dict]) -> dict:
    return {"asset_class_category": category, "sub_asset_class": sub, "call": "OVERWEIGHT", "conviction": "HIGH", "time_horizon": None, "rationale_bullets": ["growth"], "key_indicators": [], "key_risks": ["rates"],
            "citations": cites, "confidence": confidence, "needs_analyst_review": False, "review_reason": None}


def calls(prompts: pd.Series) -> pd.Series:
    """Three calls, of which two are of one asset; documents with an odd word of ``ODD`` get what their word says."""
    def one(p):
        doc = p.split("# Document\n")[1]
        if ODD[0] in doc:
            return "I can't"
        many = [] if ODD[1] in doc else [call("EQ_DM", "EQ_US", 0.9, cited(p)), call("ALT_COMMODITIES", "GOLD", 0.85, cited(p)), call("EQ_DM", "EQ_US", 0.8, cited(p))]
        if ODD[2] in doc:
            many = [call("EQ_DM", "GOLD", 0.9, cited(p))]
        return json.dumps({"allocation_calls": many, "overall_sentiment": "NEUTRAL", "sentiment_rationale": ["steady"], "sentiment_citations": cited(p), "sentiment_confidence": 0.8})

    return prompts.map(one)


def summaries(prompts: pd.Series) -> pd.Series:
    """A summary within its limits, with three takeaways."""
    def one(p):
        points = [{"text": "overweight US equities growth", "citations": cited(p)} for _ in range(3)]
        return json.dumps({"executive_summary": "word " * 120, "search_descriptor": "x" * 80, "key_takeaways": points, "citations": cited(p), "confidence": 0.9})

    return prompts.map(one)


def tooltips(prompts: pd.Series) -> pd.Series:
    """A numbered tip for each call of a prompt."""
    return prompts.map(lambda p: json.dumps({"tooltips": [{"sub_asset_class": s, "tooltip_text": f"tip {k}"} for k, s in re.findall(r"\[Call (\d+)\]\nAsset: (\S+)", p)]}))


def tags(prompts: pd.Series) -> pd.Series:
    """Tags of the vocabularies, the same for each document."""
    return prompts.map(lambda p: json.dumps({"theme_tags": ["growth", "rate_cuts"], "risk_tags": [], "macro_regime_tags": ["soft_landing"], "novel_themes": [], "confidence": 0.7}))


#: Providers of all stages, for runs without a service.
PROVIDERS = {"metadata": metadata, "calls": calls, "summaries": summaries, "tooltips": tooltips, "tags": tags}
