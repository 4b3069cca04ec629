"""Page triage: cheap signals per page, then a bounded choice of pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vocab


def page_features(blocks: DataFrame, words: Sequence[str] = vocab.TRIAGE_WORDS, whole: Sequence[str] = vocab.TRIAGE_WHOLE_WORDS,
                  headers: Mapping[str, str] = vocab.HEADERS, penalties: Sequence[str] = vocab.PENALTY) -> DataFrame:
    """Per page, blank ones too: keyword totals, header hits, bullets, cells and whether it is a contents or disclaimer page."""
    pages = blocks.groupBy("doc_id").agg(F.max("page").alias("n_pages")).select("doc_id", "n_pages", F.explode(F.sequence(F.lit(1), F.col("n_pages"))).alias("page"))
    first = F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("pos")) <= 3
    heads = F.array_compact(F.array(*[F.when(F.col("text").rlike(p), k) for k, p in headers.items()]))
    def counted(x):
        """How often the keywords found in a lower-cased text stand there; only whole words need a pattern."""
        plain = F.filter(x["found"], lambda k: ~k.isin(*whole)) if whole else x["found"]
        literal = F.aggregate(plain, F.lit(0), lambda n, k: n + F.floor((F.length(x["low"]) - F.length(F.replace(x["low"], k, F.lit("")))) / F.length(k)).cast("int"))
        worded = [F.when(F.array_contains(x["found"], k), F.regexp_count(x["low"], F.lit(rf"(?<![\p{{L}}\p{{N}}_]){k}(?![\p{{L}}\p{{N}}_])"))).otherwise(0) for k in whole]
        return F.struct(x["found"].alias("found"), sum(worded, literal).alias("total"))

    pair = F.struct(F.lower("text").alias("low"), T.hits(F.col("text"), [*words, *whole], whole).alias("found"))
    hit = F.get(F.transform(F.array(pair), counted), F.lit(0))
    rows = blocks.withColumn("hit", hit).withColumn("found", F.col("hit.found")).withColumn("total", F.col("hit.total")).withColumn(
        "heads", F.when((F.col("block_type") == "HEADING") | first, heads).otherwise(F.array().cast("array<string>"))).withColumn("bad", T.any_match(F.col("text"), penalties))
    per = rows.groupBy("doc_id", "page").agg(
        F.sum("total").alias("keyword_total"), F.array_distinct(F.flatten(F.collect_list("found"))).alias("found"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("heads")))).alias("header_hits"),
        F.count_if(F.col("block_type") == "BULLET").alias("bullets"), F.count_if(F.col("block_type") == "TABLE_CELL").alias("cells"), F.bool_or("bad").alias("penalty"))
    none = F.array().cast("array<string>")
    return pages.join(per, ["doc_id", "page"], "left").select(
        "doc_id", "page", "n_pages", F.coalesce("keyword_total", F.lit(0)).cast("long").alias("keyword_total"), F.size(F.coalesce("found", none)).cast("long").alias("keyword_unique"),
        F.coalesce("header_hits", none).alias("header_hits"), F.coalesce("bullets", F.lit(0)).alias("bullets"), F.coalesce("cells", F.lit(0)).alias("cells"), F.coalesce("penalty", F.lit(False)).alias("penalty"))


def page_scores(features: DataFrame) -> DataFrame:
    """``prior, score``; scores are added up in whole hundredths, so equal ones tie and aren't told apart by the rounding of doubles."""
    share = (F.col("page") - 1) / (F.col("n_pages") - 1)
    prior = F.when(F.col("n_pages") <= 1, 0.0).when(share <= 0.2, 0.5).when(share.between(0.35, 0.7), 0.3).otherwise(0.0)
    words = F.least(F.lit(300), 90 * F.col("keyword_unique") + F.least(F.lit(200), 15 * F.col("keyword_total")))
    shape = F.least(F.lit(150), 10 * F.col("bullets") + F.when(F.col("cells") >= 20, 100).otherwise(0))
    hundredths = F.when(F.size("header_hits") > 0, 200).otherwise(0) + words + shape + F.round(100 * prior).cast("long") - F.when(F.col("penalty"), 150).otherwise(0)
    return features.withColumn("prior", prior).withColumn("score", hundredths / F.lit(100.0))


def neighbours(pages: DataFrame, window: int = 1) -> DataFrame:
    """Pages within ``window`` of given ones (``doc_id, page, n_pages``), clipped to the document."""
    near = pages.select("doc_id", "n_pages", F.explode(F.sequence(F.col("page") - window, F.col("page") + window)).alias("page"))
    return near.where(F.col("page").between(1, F.col("n_pages"))).select("doc_id", "page", "n_pages").distinct()


def select_pages(scores: DataFrame, max_pages: int = 40, first_pages: int = 5, unique_words: int = 3, window: int = 1, segments: int = 4) -> DataFrame:
    """``doc_id, page`` kept. Ties of scores go to the lower page.

    First pages always stay. Pages with a header or enough keywords, and their
    neighbours, are guardrails: beyond the cap the best of them stay. Otherwise
    the rest is filled from each segment's best pages, each up to its quota and
    what earlier segments left, then from the best overall.
    """
    # every window is of one document, so its pages move once
    doc = Window.partitionBy("doc_id")
    by_score = lambda *keys: Window.partitionBy("doc_id", *keys).orderBy(F.desc("score"), "page")
    s = scores.withColumn("cap", F.greatest(F.lit(1), F.least(F.lit(max_pages), F.col("n_pages")))).withColumn("must", F.col("page") <= first_pages)
    seed = F.col("must") | (F.size("header_hits") > 0) | (F.col("keyword_unique") >= unique_words)
    s = s.withColumn("guard", F.max(seed).over(doc.orderBy("page").rangeBetween(-window, window)))
    s = s.withColumn("n_guard", F.count_if("guard").over(doc)).withColumn("n_must", F.count_if("must").over(doc))
    capped = F.col("n_guard") >= F.col("cap")
    s = s.withColumn("r", F.row_number().over(by_score("must", "guard"))).withColumn("free", ~capped & ~F.col("guard")).withColumn("room", F.col("cap") - F.col("n_guard"))
    fixed = F.when(capped, F.col("must") | (F.col("guard") & (F.col("r") <= F.col("cap") - F.col("n_must")))).otherwise(F.col("guard"))
    size, quota = F.ceil(F.col("n_pages") / segments), F.greatest(F.lit(1), F.ceil(F.col("room") / segments))
    s = s.withColumn("seg", F.floor((F.col("page") - 1) / size)).withColumn("sr", F.row_number().over(by_score("free", "seg")))
    # a segment's picks, in segment order: the first ``room`` of all segments' quotas stay
    s = s.withColumn("quoted", F.col("free") & (F.col("sr") <= quota) if segments > 1 else F.lit(False))
    s = s.withColumn("n", F.row_number().over(Window.partitionBy("doc_id", "quoted").orderBy("seg", "sr"))).withColumn("pick", F.col("quoted") & (F.col("n") <= F.col("room")))
    s = s.withColumn("taken", F.count_if("pick").over(doc)).withColumn("rest", F.col("free") & ~F.col("pick")).withColumn("g", F.row_number().over(by_score("rest")))
    return s.where(fixed | F.col("pick") | (F.col("rest") & (F.col("g") <= F.col("room") - F.col("taken")))).select("doc_id", "page")


def triage(blocks: DataFrame, min_pages: int = 40, **options) -> DataFrame:
    """Blocks on chosen pages; documents under ``min_pages`` keep all."""
    features = page_features(blocks, **{k: options.pop(k) for k in ("words", "whole", "headers", "penalties") if k in options})
    long = features.where(F.col("n_pages") >= min_pages)
    keep = select_pages(page_scores(long), **options)
    short = features.where(F.col("n_pages") < min_pages).select("doc_id", "page")
    return blocks.join(keep.unionByName(short), ["doc_id", "page"], "left_semi")
