"""Records that models return, as Spark types, and prompts that ask for them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import vocab

_CITES = "array<struct<chunk_id:string,block_ids:array<string>,page:int,text_span:string>>"
#: stage: the record's fields. Unknown and missing keys are errors (see ``calls.parsed``).
_CALL = f"asset_class_category:string,sub_asset_class:string,call:string,conviction:string,time_horizon:string,rationale_bullets:array<string>,key_indicators:array<struct<name:string,direction:string,why_it_matters:string>>,key_risks:array<string>,citations:{_CITES},confidence:double,needs_analyst_review:boolean,review_reason:string"
RECORDS = {
    "calls": f"allocation_calls array<struct<{_CALL}>>, overall_sentiment string, sentiment_rationale array<string>, sentiment_citations {_CITES}, sentiment_confidence double",
    "metadata": f"manager_name string, title string, publication_date string, as_of_date string, document_type string, asset_classes_covered array<string>, regions array<string>, time_horizon string, intended_audience string, citations {_CITES}, manager_name_uncertain boolean, publication_date_uncertain boolean",
    "candidates": "additional_chunk_ids array<string>, reasoning string",
    "summaries": f"executive_summary string, search_descriptor string, key_takeaways array<struct<text:string,citations:{_CITES}>>, citations {_CITES}, confidence double",
    "tooltips": "tooltips array<struct<sub_asset_class:string,tooltip_text:string>>",
    "tags": "theme_tags array<string>, risk_tags array<string>, macro_regime_tags array<string>, novel_themes array<string>, confidence double",
    "verification": "verified array<struct<sub_asset_class:string,agrees:boolean,note:string>>",
}
#: stage: the words that a record's lists may hold.
ALLOWED = {"tags": {"theme_tags": vocab.THEMES, "risk_tags": vocab.RISKS, "macro_regime_tags": vocab.REGIMES}, "metadata": {"regions": vocab.REGIONS}}
# --- fixed values: how many entries the lists of a call and of the sentiment may have -----------
CALL_LISTS = {"rationale_bullets": (1, 4), "key_indicators": (0, 5), "key_risks": (0, 3), "citations": (1, 3)}
SENTIMENT_LISTS = {"sentiment_rationale": (1, 3), "sentiment_citations": (1, 3)}
SENTIMENTS = ("NET_POSITIVE", "NEUTRAL", "NET_NEGATIVE")
#: stage: what is asked, and the rules for the answer.
TASKS = {
    "metadata": ("Describe the document that these excerpts are from: who wrote it, when, of what kind it is and which assets it covers.", (
        "Take the manager's name from a title page, a footer or a disclaimer; where none is stated, answer Unknown and set manager_name_uncertain.",
        "Write dates as YYYY-MM-DD; give null for a date that isn't stated, and set publication_date_uncertain for one that is only implied.",
        "asset_classes_covered names at least one category.", "Cite the chunks that each answer rests on.", "Add nothing that the excerpts don't say.")),
    "candidates": ("Some passages of this document were found by words of positioning. Name further passages that state a position in other words.", (
        "A position may be a comparison, a preference, a shift or a rebalancing without any of the usual words.", "Use only the ids that are shown.",
        "Name at most ten, the clearest first; an empty list is an answer.")),
    "calls": ("List each allocation call of these excerpts: an asset, the direction taken, its reasons and its sources.", (
        "A call needs a stated view; a description of the market is none.", "Use the codes of categories and sub-assets below; each sub-asset belongs to one category.",
        "Give OVERWEIGHT, UNDERWEIGHT or NEUTRAL where the text says so, UNCERTAIN where it leaves the direction open.", "State conviction only where the text does.",
        "Give one to five reasons, each close to the text, and the indicators and risks that it names.",
        "Every call cites at least one chunk, with its page and a span of at most 200 characters, word for word.",
        "confidence is 0.9 and more for an explicit call, about 0.7 for an implied one, below 0.5 for a guess; ask for review below 0.6.",
        "Judge the sentiment of the whole document as NET_POSITIVE, NEUTRAL or NET_NEGATIVE, with its own citations.")),
    "summaries": ("Summarise the document from its calls and excerpts.", (
        "executive_summary has 120 to 180 words and names the manager's main views.", "search_descriptor is one line of 50 to 200 characters.",
        "Give three to five key takeaways, each with citations of its own.", "Numbers and dates are those of the excerpts.")),
    "tooltips": ("Write one tooltip for each call, in the order of the calls.", (
        "At most 25 words and 150 characters.", "Say the direction and the main reason; a phrase that fits any asset says nothing.", "Repeat the call's sub_asset_class with its tooltip.")),
    "tags": ("Tag the document with words of the lists below.", (
        "Use a tag only where the text or a call supports it.", "Themes that no list has go to novel_themes, at most five.", "confidence is that of the tags as a whole.")),
    "verification": ("Check each extracted call against the excerpts.", (
        "Agree only if asset and direction are both supported by a cited chunk.", "Say in a note what is wrong where you don't agree.", "Answer for every call, in order.")),
}


def record_type(stage: str) -> T.StructType:
    return T.StructType.fromDDL(RECORDS[stage])


def keys(stage: str) -> list[str]:
    return record_type(stage).names


def limits(stage: str, value: Column) -> Column:
    """Violated limits of a parsed record, in order."""
    none = F.array().cast("array<string>")
    size = lambda c: F.size(F.coalesce(c, none))
    if stage == "summaries":
        takeaways = F.size(F.coalesce(value["key_takeaways"], F.array().cast(record_type(stage)["key_takeaways"].dataType)))
        checks = [F.when(~F.length(value["executive_summary"]).between(100, 1000), "executive_summary"), F.when(~F.length(value["search_descriptor"]).between(50, 200), "search_descriptor"), F.when(~takeaways.between(3, 5), "key_takeaways")]
    elif stage == "tags":
        checks = [F.when(size(F.array_except(F.coalesce(value[k], none), F.array(*map(F.lit, words)))) > 0, k) for k, words in ALLOWED["tags"].items()]
    elif stage == "metadata":
        checks = [F.when(size(value["asset_classes_covered"]) == 0, "asset_classes_covered"), F.when(F.size(F.coalesce(value["citations"], F.array().cast(_CITES))) == 0, "citations")]
    elif stage == "calls":
        one = value["allocation_calls"]
        some = lambda test: F.exists(one, lambda c: ~F.coalesce(test(c), F.lit(False)))
        between = lambda c, lo, hi: F.coalesce(F.size(c), F.lit(0)).between(lo, hi) if lo == 0 else F.size(c).between(lo, hi)
        share = lambda x: F.coalesce(x.between(0, 1), F.lit(False))
        checks = [
            F.when(one.isNull(), "allocation_calls"), F.when(some(lambda c: c["asset_class_category"].isNotNull() & c["sub_asset_class"].isNotNull()), "sub_asset_class"),
            F.when(some(lambda c: c["call"].isin(*vocab.CALL_DIRECTIONS)), "call"), F.when(some(lambda c: c["conviction"].isNull() | c["conviction"].isin(*vocab.BANDS)), "conviction"),
            *[F.when(some(lambda c, k=k, lo=lo, hi=hi: between(c[k], lo, hi)), k) for k, (lo, hi) in CALL_LISTS.items()], F.when(some(lambda c: share(c["confidence"])), "confidence"),
            F.when(~F.coalesce(value["overall_sentiment"].isin(*SENTIMENTS), F.lit(False)), "overall_sentiment"),
            *[F.when(~F.coalesce(between(value[k], lo, hi), F.lit(False)), k) for k, (lo, hi) in SENTIMENT_LISTS.items()], F.when(~share(value["sentiment_confidence"]), "sentiment_confidence")]
    elif stage == "candidates":
        checks = [F.when(value["reasoning"].isNull(), "reasoning")]
    elif stage == "tooltips":
        tips = value["tooltips"]
        checks = [F.when(F.coalesce(F.size(tips), F.lit(0)) < 1, "tooltips"), F.when(F.exists(tips, lambda t: t["sub_asset_class"].isNull()), "sub_asset_class"),
                  F.when(F.exists(tips, lambda t: ~F.coalesce(F.length(t["tooltip_text"]) <= 150, F.lit(False))), "tooltip_text")]
    else:
        checks = [F.when(value.isNull(), "record")]
    return F.array_compact(F.array(*checks))


def taxonomy_text() -> str:
    """The categories that have sub-assets, one to a line."""
    return "\n".join(f"- {c}: {', '.join(subs)}" for c, subs in vocab.TAXONOMY.items() if subs)


def prompt(stage: str, context: Column, words: Sequence[str] = ()) -> Column:
    """The task, its rules, the wanted fields, the allowed words (and any others given) and the document's part."""
    task, rules = TASKS[stage]
    fields = "\n".join(f"- {f.name}: {f.dataType.simpleString()}" for f in record_type(stage))
    allowed = "".join(f"\n{k}: {', '.join(v)}" for k, v in ALLOWED.get(stage, {}).items())
    parts = [f"# Task\n{task}", "# Rules\n" + "\n".join(f"{k}. {r}" for k, r in enumerate(rules, 1)), f"# Answer\nOne JSON object with exactly these fields:\n{fields}"]
    if allowed or words:
        parts.append("# Allowed words" + allowed + ("\n" + ", ".join(words) if words else ""))
    if stage == "calls":
        parts.append(f"# Categories and sub-assets\n{taxonomy_text()}")
    return F.concat(F.lit("\n\n".join(parts) + "\n\n# Document\n"), context)
