"""The parts of prompts: chunks, calls and profiles as text, as column expressions over arrays of records.

The separators and headers below are fixed values: answers cite the ids in them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as T

# --- fixed values: separators and limits ------------------------------------------------------
CHUNK_GAP = "\n\n---\n\n"
NO_CALLS = "No allocation calls extracted."
SHOWN_CHUNKS, PREVIEWED_CHUNKS, PREVIEW = 8, 15, 300
FIRST_REASONS = 2


def _lines(rows: Column, line, gap: str = "\n") -> Column:
    return F.array_join(F.transform(rows, line), gap)


def _some(x: Column, otherwise: str) -> Column:
    return F.when(F.size(F.coalesce(x, F.array().cast("array<string>"))) > 0, F.array_join(x, ", ")).otherwise(otherwise)


def chunks(rows: Column) -> Column:
    """Chunks (``chunk_id, page, text``), each under a header with its id and page."""
    return _lines(rows, lambda c: F.concat(F.lit("[Chunk "), c["chunk_id"], F.lit(" | Page "), c["page"].cast("string"), F.lit("]\n"), c["text"]), CHUNK_GAP)


def expansion(seeds: Column, others: Column) -> Column:
    """The first chunks that keywords found in full, and previews of the first others."""
    head = lambda c: F.concat(F.lit("["), c["chunk_id"], F.lit("] (page "), c["page"].cast("string"), F.lit("):\n"))
    full = _lines(F.slice(seeds, 1, SHOWN_CHUNKS), lambda c: F.concat(head(c), c["text"]), "\n\n")
    seen = _lines(F.slice(others, 1, PREVIEWED_CHUNKS), lambda c: F.concat(head(c), T.preview(c["text"], PREVIEW)), "\n\n")
    return F.concat(F.lit("## Passages that keywords found\n"), full, F.lit("\n\n## Other passages, shortened\n"), seen)


def calls(rows: Column) -> Column:
    """One line for each call (``sub_asset_class, call, conviction``)."""
    line = lambda c: F.concat(F.lit("- "), c["sub_asset_class"], F.lit(": "), c["call"], F.coalesce(F.concat(F.lit(" ("), c["conviction"], F.lit(")")), F.lit("")))
    return F.when(F.size(rows) > 0, _lines(rows, line)).otherwise(NO_CALLS)


def calls_with_risks(rows: Column) -> Column:
    line = lambda c: F.concat(F.lit("- "), c["sub_asset_class"], F.lit(": "), c["call"], F.lit(" | Risks: "), _some(c["key_risks"], "None"))
    return F.when(F.size(rows) > 0, _lines(rows, line)).otherwise(NO_CALLS)


def calls_for_tooltips(rows: Column) -> Column:
    """Calls by number, with the first reasons and risks of each."""
    def one(c: Column, k: Column) -> Column:
        conviction = F.coalesce(F.concat(F.lit(" ("), c["conviction"], F.lit(" conviction)")), F.lit(""))
        return F.concat(
            F.lit("[Call "), k.cast("string"), F.lit("]\nAsset: "), c["sub_asset_class"], F.lit(" ("), c["asset_class_category"], F.lit(")\nDirection: "), c["call"], conviction,
            F.lit("\nRationale: "), F.array_join(F.slice(F.coalesce(c["rationale_bullets"], F.array().cast("array<string>")), 1, FIRST_REASONS), "; "),
            F.lit("\nRisks: "), _some(F.slice(c["key_risks"], 1, FIRST_REASONS), "None specified"))

    return _lines(rows, one, "\n\n")


def calls_for_verification(rows: Column) -> Column:
    """Calls by number as JSON, with their citations."""
    return F.to_json(F.transform(rows, lambda c, k: F.struct(
        k.alias("index"), *[c[f].alias(f) for f in ("asset_class_category", "sub_asset_class", "call", "conviction", "rationale_bullets")],
        F.transform(c["citations"], lambda x: F.struct(x["chunk_id"].alias("chunk_id"), x["page"].alias("page"), x["text_span"].alias("text_span"))).alias("citations"))), {"ignoreNullFields": "false"})


def profile(manager: Column, kind: Column, published: Column, assets: Column, regions: Column) -> Column:
    return F.concat(
        F.lit("Manager: "), manager, F.lit("\nDocument Type: "), kind, F.lit("\nPublication Date: "), F.coalesce(published.cast("string"), F.lit("Unknown")),
        F.lit("\nAsset Classes: "), F.array_join(assets, ", "), F.lit("\nRegions: "), _some(regions, "Not specified"))
