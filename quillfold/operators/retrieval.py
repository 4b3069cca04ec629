"""Top-k retrieval inside a document: exact cosine, keyword density, multi-query merges."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vocab
from .nearest import top_vectors  # noqa: F401


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """0 where a vector has no length."""
    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0))


def merged_queries(found: DataFrame, keep: int, group: str = "doc_id") -> DataFrame:
    """Hits of several queries (``group, query_order, rank, id, score``): each id once, with the score of its first query; the best ``keep``."""
    first = found.groupBy(group, "id").agg(F.min(F.struct("query_order", "rank", "score")).alias("f"))
    order = Window.partitionBy(group).orderBy(F.desc(F.round("f.score", 9)), "f.query_order", "f.rank")
    return first.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep).select(group, "id", F.col("f.score").alias("score"), "place")


def nearest_chunks(chunks: DataFrame, queries: DataFrame, embed: Callable[[Column], Column], k: int) -> DataFrame:
    """``doc_id, query_order, chunk_id, score, rank``: the k chunks of its own document nearest to each query (``doc_id, query_order, query``); a null query asks nothing."""
    vectors = chunks.select("doc_id", "chunk_id", embed(F.col("text")).alias("embedding"))
    asked = queries.where("query is not null").select("doc_id", F.concat_ws(":", "query_order", "doc_id").alias("query_id"), embed(F.col("query")).alias("embedding"))
    found = top_vectors(vectors, asked, k, "doc_id", "chunk_id")
    return found.select("doc_id", F.split_part("query_id", F.lit(":"), F.lit(1)).cast("int").alias("query_order"), F.col("id").alias("chunk_id"), "score", "rank")


def passages(chunks: DataFrame, queries: DataFrame, embed: Callable[[Column], Column], k: int, keep: int) -> DataFrame:
    """``doc_id, chunk_id, page, text, place``: the best ``keep`` chunks of a document for its queries, each once."""
    best = merged_queries(nearest_chunks(chunks, queries, embed, k).withColumnRenamed("chunk_id", "id"), keep)
    return best.select("doc_id", F.col("id").alias("chunk_id"), "place").join(chunks.select("doc_id", "chunk_id", "page", "text"), ["doc_id", "chunk_id"])


def keyword_map(blocks: DataFrame, words: Sequence[str], whole: Sequence[str] = vocab.WHOLE_WORDS) -> DataFrame:
    """``doc_id, keyword, block_ids`` in block order; disclaimers are skipped."""
    rows = blocks.where("block_type <> 'DISCLAIMER'").select("doc_id", "pos", "block_id", F.explode(T.hits(F.col("text"), words, whole)).alias("keyword"))
    return rows.groupBy("doc_id", "keyword").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "block_id"))), lambda x: x.block_id).alias("block_ids"))


def ranked_by_density(chunks: DataFrame, words: Sequence[str], keep: int = 30, whole: Sequence[str] = vocab.WHOLE_WORDS) -> DataFrame:
    """The ``keep`` chunks of each document with most distinct keywords, then by page and order; at least one keyword."""
    n = F.size(T.hits(F.col("text"), words, whole))
    rows = chunks.withColumn("density", n).where("density > 0")
    order = Window.partitionBy("doc_id").orderBy(F.desc("density"), "page", "chunk_index")
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)


def chunks_of_blocks(chunks: DataFrame, blocks: DataFrame) -> DataFrame:
    """Chunks that hold any of the given blocks (``doc_id, block_id``)."""
    hit = chunks.select("doc_id", "chunk_index", F.explode("block_ids").alias("block_id")).join(blocks.select("doc_id", "block_id"), ["doc_id", "block_id"], "left_semi")
    return chunks.join(hit.select("doc_id", "chunk_index").distinct(), ["doc_id", "chunk_index"], "left_semi")


def without_keywords(chunks: DataFrame, words: Sequence[str], keep: int = 50, whole: Sequence[str] = vocab.WHOLE_WORDS) -> DataFrame:
    """The first ``keep`` chunks, with score 0.5, of documents in which no chunk has a keyword."""
    having = chunks.where(F.size(T.hits(F.col("text"), words, whole)) > 0).select("doc_id").distinct()
    rest = chunks.join(having, "doc_id", "left_anti")
    return rest.where(F.col("chunk_index") < keep).withColumn("score", F.lit(0.5))


def first_pages(chunks: DataFrame, pages: int = 2, keep: int = 6) -> DataFrame:
    order = Window.partitionBy("doc_id").orderBy("page", "chunk_id")
    return chunks.where(F.col("page") <= pages).withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)


def keep_first(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order."""
    value = F.min(F.struct(*order, *[c for c in rows.columns if c not in order and c not in keys])).alias("_r")
    return rows.groupBy(*keys).agg(value).select(*keys, "_r.*")


def expanded(chunks: DataFrame, asked: DataFrame, keep: int = 10) -> DataFrame:
    """Chunks asked for by id (``doc_id, ids``); unknown ids are ignored, the first ``keep`` known ones stay."""
    ids = asked.select("doc_id", F.posexplode("ids").alias("asked_at", "chunk_id"))
    known = ids.join(chunks, ["doc_id", "chunk_id"])
    return known.withColumn("place", F.row_number().over(Window.partitionBy("doc_id").orderBy("asked_at"))).where(F.col("place") <= keep)


def metadata_chunks(chunks: DataFrame, hits: DataFrame, pages: int = 2, first: int = 6, keep: int = 12) -> DataFrame:
    """``doc_id, chunk_id, score, place``: the first pages' chunks with score 1, then the best of a query (``doc_id, chunk_id, score, rank``), each once."""
    front = first_pages(chunks, pages, first).select("doc_id", "chunk_id", F.lit(0).alias("part"), F.col("place").cast("long").alias("at"), F.lit(1.0).alias("score"))
    found = hits.select("doc_id", "chunk_id", F.lit(1).alias("part"), F.col("rank").cast("long").alias("at"), F.col("score").cast("double").alias("score"))
    once = keep_first(front.unionByName(found), ["doc_id", "chunk_id"], ["part", "at"])
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("part", "at", "chunk_id"))
    return once.withColumn("place", place).where(F.col("place") <= keep).select("doc_id", "chunk_id", "score", "place")


def skips_expansion(chunks: DataFrame, having: Column, seeds: int = 8) -> DataFrame:
    """``doc_id, skip``: documents that aren't asked for further chunks, as none has a keyword (``having``) or the seeds are all."""
    counts = chunks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(having).alias("hits"))
    return counts.select("doc_id", ((F.col("hits") == 0) | (F.least(F.col("hits"), F.lit(seeds)) == F.col("n"))).alias("skip"))


def prompt_parts(chunks: DataFrame, having: Column) -> DataFrame:
    """``doc_id, seeds, others``: a document's chunks with a keyword and without, in order, for the prompts."""
    row = F.struct("chunk_index", "chunk_id", "page", "text")
    pick = lambda some: F.transform(F.array_sort(F.collect_list(F.when(some, row))), lambda c: F.struct(c.chunk_id.alias("chunk_id"), c.page.alias("page"), c.text.alias("text")))
    return chunks.groupBy("doc_id").agg(pick(having).alias("seeds"), pick(~having).alias("others"))
