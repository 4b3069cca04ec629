"""Structured calls: parsing of model answers, merging of duplicates, taxonomy, guards, tags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vocab

MERGED = "Duplicate call merged from multiple mentions"
CITATION = "struct<chunk_id:string,block_ids:array<string>,page:int,text_span:string>"
CALL = (
    "struct<asset_class_category:string,sub_asset_class:string,call:string,conviction:string,time_horizon:string,rationale_bullets:array<string>,"
    f"key_indicators:array<struct<name:string,direction:string,why_it_matters:string>>,key_risks:array<string>,citations:array<{CITATION}>,"
    "confidence:double,needs_analyst_review:boolean,review_reason:string>"
)
ANSWER = f"struct<allocation_calls:array<{CALL}>,overall_sentiment:string,sentiment_rationale:array<string>,sentiment_citations:array<{CITATION}>,sentiment_confidence:double>"
ANSWER_KEYS = ("allocation_calls", "overall_sentiment", "sentiment_rationale", "sentiment_citations", "sentiment_confidence")


def parsed(answers: DataFrame, schema: str = ANSWER, keys: Sequence[str] = ANSWER_KEYS, json_col: str = "answer") -> DataFrame:
    """``answers`` with ``value`` and ``errors``: unparsable text, missing and unknown keys are errors, rows stay."""
    text = T.json_clean(F.col(json_col))
    value = F.from_json(text, schema)
    have = F.coalesce(F.json_object_keys(text), F.array().cast("array<string>"))
    want = F.array(*map(F.lit, keys))
    errors = F.concat(
        F.when(F.json_object_keys(text).isNull(), F.array(F.lit("not a JSON object"))).otherwise(F.array().cast("array<string>")),
        F.transform(F.array_sort(F.array_except(have, want)), lambda k: F.concat(F.lit("unknown key "), k)),
        F.when(F.json_object_keys(text).isNotNull(), F.transform(F.array_sort(F.array_except(want, have)), lambda k: F.concat(F.lit("missing key "), k))).otherwise(F.array().cast("array<string>")))
    return answers.withColumn("value", value).withColumn("errors", errors)


def citation(c: Column) -> Column:
    return F.struct(c.chunk_id.alias("chunk_id"), c.block_ids.alias("block_ids"), c.page.cast("int").alias("page"), F.substring(c.text_span, 1, 200).alias("text_span"))


def indicators(x: Column) -> Column:
    """Key indicators with canonical directions and the defaults for missing names and reasons."""
    name = lambda i: F.when(F.coalesce(T.strip(i["name"]), F.lit("")) == "", "indicator").otherwise(i["name"])
    why = lambda i: F.substring(F.when(F.coalesce(T.strip(i["why_it_matters"]), F.lit("")) == "", "See rationale").otherwise(i["why_it_matters"]), 1, 200)
    return F.transform(x, lambda i: F.struct(name(i).alias("name"), T.indicator(i["direction"]).alias("direction"), why(i).alias("why_it_matters")))


def call_rows(answers: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per call of each parsed answer, in order."""
    rows = answers.select(id_col, F.posexplode(F.col("value.allocation_calls")).alias("pos", "c"))
    return rows.select(
        id_col, "pos", "c.asset_class_category", "c.sub_asset_class", "c.call", "c.conviction", "c.time_horizon", "c.rationale_bullets", indicators(F.col("c.key_indicators")).alias("key_indicators"),
        "c.key_risks", F.transform("c.citations", citation).alias("citations"), "c.confidence", "c.needs_analyst_review", "c.review_reason")


def merged_calls(calls: DataFrame, keys: Sequence[str], order: Sequence[str], coalesced: Sequence[str] = (), lists: Mapping[str, int] | None = None, carried: Sequence[str] = ()) -> DataFrame:
    """Calls with equal ``keys``, folded in ``order``.

    The one of higher confidence (of equal ones the earlier) is primary: it gives
    ``carried`` and, where not null, ``coalesced``; ``lists`` are joined without
    repeats up to a limit, primary first. Each merge marks the call for review
    and adds the reason. ``confidence`` and ``review_reason`` are columns of
    ``calls``. A group is all calls of one document and asset.
    """
    lists = dict(lists or {})
    fields = [*carried, *coalesced, *lists, "confidence", "review_reason"]
    item = F.struct(*order, F.struct(*fields, F.lit(1).alias("n")).alias("v"))
    group = calls.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x.v).alias("g"))

    def step(a, b):
        swap = b.confidence > a.confidence
        first = lambda f: F.when(swap, b[f]).otherwise(a[f])
        second = lambda f: F.when(swap, a[f]).otherwise(b[f])
        some = lambda x: F.when(F.coalesce(x, F.lit("")) != "", x)
        reason = F.concat_ws("; ", some(first("review_reason")), some(second("review_reason")), F.lit(MERGED))
        return F.struct(
            *[first(f).alias(f) for f in carried], *[F.coalesce(first(f), second(f)).alias(f) for f in coalesced],
            *[T.merged_unique(first(f), second(f), n).alias(f) for f, n in lists.items()],
            F.greatest(a.confidence, b.confidence).alias("confidence"), reason.alias("review_reason"), (a.n + 1).alias("n"))

    merged = F.aggregate(F.slice("g", 2, F.greatest(F.size("g") - 1, F.lit(0))), F.get("g", F.lit(0)), step)
    return group.select(*keys, merged.alias("m")).select(*keys, *[f"m.{f}" for f in fields], (F.col("m.n") > 1).alias("merged"), F.col("m.n").alias("n_mentions"))


def taxonomy(spark) -> DataFrame:
    return spark.createDataFrame(vocab.taxonomy_rows(), "category string, sub_asset string").coalesce(1)


def synonyms(spark, rows: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    return spark.createDataFrame(list(rows or vocab.synonym_rows()), "term string, sub_asset string").coalesce(1)


def synonyms_of(terms: DataFrame, assets: DataFrame) -> DataFrame:
    """``category, sub_asset, n_terms, terms``: all terms of each sub-asset that has one, in alphabetical order."""
    return terms.join(assets, "sub_asset").groupBy("category", "sub_asset").agg(F.count(F.lit(1)).alias("n_terms"), F.array_sort(F.collect_list("term")).alias("terms"))


def known_terms(mentions: DataFrame, terms: DataFrame, column: str = "mention") -> DataFrame:
    """Mentions that are synonyms of anything."""
    return mentions.join(terms.select("term").distinct(), F.lower(T.strip(F.col(column))) == F.col("term"), "left_semi")


def resolved(mentions: DataFrame, terms: DataFrame, assets: DataFrame, column: str = "mention") -> DataFrame:
    """Mentions with ``category`` and ``sub_asset`` of their exact, lower-cased, stripped synonym; null without one.

    The vocabularies are relations of a few hundred rows; Spark broadcasts them by their size.
    """
    known = terms.join(assets, "sub_asset").withColumnRenamed("term", "_term")
    return mentions.join(known, F.lower(T.strip(F.col(column))) == F.col("_term"), "left").drop("_term")


def taxonomy_faults(calls: DataFrame, assets: DataFrame, category: str = "asset_class_category", sub: str = "sub_asset_class") -> DataFrame:
    """Calls with ``fault``: unknown_category, unknown_sub_asset, mismatch or null. ``assets`` is a vocabulary and is broadcast: calls have few codes, each in a great part of the rows."""
    cats = assets.select(F.col("category").alias("_c")).distinct()
    subs = assets.select(F.col("sub_asset").alias("_s"), F.col("category").alias("_sc"))
    rows = calls.join(F.broadcast(cats), F.col(category) == F.col("_c"), "left").join(F.broadcast(subs), F.col(sub) == F.col("_s"), "left")
    fault = F.when(F.col("_s").isNull(), "unknown_sub_asset").when(F.col("_c").isNull() & ~F.col(category).isin(*vocab.TAXONOMY), "unknown_category").when(F.col("_sc") != F.col(category), "mismatch")
    return rows.withColumn("fault", fault).drop("_c", "_s", "_sc")


def citation_faults(citations: DataFrame, allowed: DataFrame) -> DataFrame:
    """Citations (``doc_id, chunk_id``) of chunks that weren't given."""
    return citations.join(allowed.select("doc_id", "chunk_id"), ["doc_id", "chunk_id"], "left_anti")


def nested(value: Column, paths: Sequence[str]) -> Column:
    """All records at some paths of a nested record, one after another; ``calls[].citations[]`` goes through arrays."""
    def at(x: Column, steps: list[str]) -> Column:
        step, *rest = steps
        inner = x[step.removesuffix("[]")]
        if not step.endswith("[]"):
            return at(inner, rest) if rest else F.array(inner)
        return inner if not rest else F.flatten(F.transform(inner, lambda y: at(y, rest)))

    found = [at(value, p.split(".")) for p in paths]
    return F.flatten(F.filter(F.array(*found), lambda x: x.isNotNull()))


def citations_of(value: Column) -> Column:
    """The citations of an answer: those of its calls, then those of its sentiment."""
    return nested(value, ["allocation_calls[].citations[]", "sentiment_citations[]"])


def _owner(sub: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(v) for c, s in vocab.taxonomy_rows() for v in (s, c)]), sub)


def taxonomy_fault(call: Column) -> Column:
    """What is wrong with a call's codes, in words; null where nothing is."""
    c, s = call["asset_class_category"], call["sub_asset_class"]
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("None")) for p in parts])
    return (F.when(~F.coalesce(c.isin(*vocab.TAXONOMY), F.lit(False)), text("Invalid asset_class_category: ", c)).when(_owner(s).isNull(), text("Invalid sub_asset_class: ", s))
            .when(_owner(s) != c, text("Mismatched taxonomy: ", s, " belongs to ", _owner(s), ", not ", c)))


def guarded(answers: DataFrame, value_col: str = "value", allowed_col: str = "allowed", text_col: str = "output", source_col: str = "source") -> DataFrame:
    """``answers`` with ``fault``: the first rule that an answer breaks, in words, or null.

    The order of the rules is citations of chunks that weren't given (``allowed``
    is an array of ids), codes outside the taxonomy, and then dates, percents and
    quotes that the source doesn't hold, all of them sorted.
    """
    value, none = F.col(value_col), F.array().cast("array<string>")
    unknown = F.filter(F.transform(citations_of(value), lambda c: c["chunk_id"]), lambda i: ~F.coalesce(F.array_contains(F.coalesce(F.col(allowed_col), none), i), F.lit(False)))
    faults = F.filter(F.transform(F.coalesce(value["allocation_calls"], F.array().cast(f"array<{CALL}>")), taxonomy_fault), lambda f: f.isNotNull())
    rows = llm_faults(answers, text_col, source_col)
    marks = F.array_sort(F.array_union(F.array_union("dates", "percents"), F.transform("quotes", lambda q: F.concat(F.lit('\\"'), q, F.lit('\\"')))))
    fault = (F.when(F.size(unknown) > 0, F.concat(F.lit("Invalid citation chunk_id: "), F.coalesce(F.get(unknown, F.lit(0)), F.lit("None")))).when(F.size(faults) > 0, F.get(faults, F.lit(0)))
             .when(F.size(marks) > 0, F.concat(F.lit("Potential hallucination detected: "), F.array_join(marks, ", "))))
    return rows.withColumn("fault", fault)


def llm_faults(outputs: DataFrame, text_col: str = "output", source_col: str = "source") -> DataFrame:
    """``outputs`` with ``dates``, ``percents`` and ``quotes`` that the source doesn't support."""
    text, source = F.col(text_col), F.col(source_col)
    dates = F.regexp_extract_all(text, F.lit(r"\d{4}-\d{2}-\d{2}"), F.lit(0))
    # from an escaped quote to the end of its JSON string, without giving back; the quote ends at the last escaped one there
    runs = F.regexp_extract_all(text, F.lit(r'\\"(?:[^"\\]|\\.)*+'), F.lit(0))
    inner = F.transform(runs, lambda r: F.substring(r, 3, F.length(r) - F.instr(F.reverse(r), '"') - 3))
    long = F.filter(inner, lambda q: F.length(F.regexp_replace(q, r"\\.", "x")) >= 50)
    quotes = F.transform(long, lambda q: F.replace(F.replace(q, F.lit('\\"'), F.lit('"')), F.lit("\\\\"), F.lit("\\")))
    return outputs.withColumn("dates", F.array_sort(F.array_distinct(F.filter(dates, lambda d: ~T.date_grounded(d, source))))).withColumn(
        "percents", T.ungrounded(text, source, r"\d+(?:\.\d+)?%")).withColumn("quotes", F.array_sort(F.array_distinct(F.filter(quotes, lambda q: ~F.contains(source, q)))))


def tags(rows: DataFrame, lists: Mapping[str, tuple[str, str]], id_col: str = "doc_id") -> DataFrame:
    """Typed tags, one row each and each once: ``doc_id, tag_type, value, source, confidence``.

    ``lists``: column of tags -> (type, source); rule tags have confidence 1, model tags the row's ``confidence``.
    """
    out = None
    for column, (kind, source) in lists.items():
        confidence = F.lit(1.0) if source == "rule" else F.col("confidence").cast("double")
        part = rows.select(id_col, F.lit(kind).alias("tag_type"), F.explode(column).alias("value"), F.lit(source).alias("source"), confidence.alias("confidence"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy(id_col, "tag_type", "value").agg(F.max_by("source", "confidence").alias("source"), F.max("confidence").alias("confidence"))


def rule_tags(calls: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id, categories, sub_assets``: the different categories of a document's calls, and their sub-assets in lower case, sorted."""
    return calls.groupBy(id_col).agg(
        F.array_sort(F.collect_set("asset_class_category")).alias("categories"), F.array_sort(F.collect_set(F.lower("sub_asset_class"))).alias("sub_assets"))
