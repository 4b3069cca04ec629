"""Packing of blocks into retrieval chunks by boundary pointers.

Blocks are packed in order until the next one would carry a chunk over the
limit. Pending text is carried past an oversized block unless it is long enough
to stand alone, and text that never gets long enough is dropped. Where a chunk
begins depends on the chunk before it, so this looks like a fold over blocks; it
is done without one, and without gathering a section's texts:

1. Running sums place each block on a line of lengths. A chunk that began at a
   block ends before the first block whose end is too far from there, which is a
   count over a range of that line. So every block knows where a chunk that
   began at it would end.
2. These pointers, some integers for each block, are followed from the first
   block of a document by pointer doubling: in each round the known beginnings
   are carried twice as far, so a document of n blocks takes log2(n) rounds.
3. Chunks meet their blocks in one sort by place, and only the blocks of one
   chunk are brought together, which the limit bounds.

Texts are shuffled once, by document; windows over a document stream and spill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .documents import sections

MAX_CHARS, MIN_CHARS = 1600, 800


def split_large(text: Column, limit: int = MAX_CHARS) -> Column:
    """Pieces of whole words: a piece ends before the word that would carry its length (a space per word) over the limit.

    With one space between words, a piece is the longest run of up to
    ``limit - 1`` characters that ends where a word does, or a longer word alone.
    """
    plain = F.regexp_replace(T.strip(text), r"\s+", " ")
    return F.regexp_extract_all(plain, F.lit(rf"(?s)\S.{{0,{max(0, limit - 2)}}}(?= |\z)|\S+"), F.lit(0))


def _pointers(rows: DataFrame, limit: int, least: int, split: bool) -> DataFrame:
    """A row for each block that is packed: its place on the line of lengths and how far a chunk from there reaches.

    ``at`` is the length of all blocks before it, with two characters for each
    join; ``reach`` and ``enough`` are the numbers of blocks that begin at most
    so far from it as a chunk may go on, and as it is too short to stand alone.
    ``gap`` tells that an oversized block follows, ``last`` is the number of the
    last block of its section.
    """
    over = Window.partitionBy("doc_id").orderBy("pos")
    sizes = rows.select("doc_id", "pos", "block_type", F.length(T.strip(F.col("text"))).alias("n"))
    seen = sections(sizes).where((F.col("block_type") != "DISCLAIMER") & (F.col("n") > 0)).withColumn("large", (F.col("n") > limit) if split else F.lit(False))
    following = F.lead(F.struct("section_index", "large")).over(over)
    end = F.sum(F.when(~F.col("large"), F.col("n") + 2).otherwise(0)).over(over.rowsBetween(Window.unboundedPreceding, 0))
    seen = seen.select("doc_id", "pos", "n", "section_index", "large", end.alias("end"), following.alias("f"), F.max("large").over(Window.partitionBy("doc_id")).alias("any_large"))
    body = seen.where(~F.col("large")).select(
        "doc_id", "pos", "n", "section_index", "any_large", (F.col("end") - F.col("n") - 2).alias("at"), F.coalesce((F.col("f.section_index") == F.col("section_index")) & F.col("f.large"), F.lit(False)).alias("gap"))
    line = Window.partitionBy("doc_id").orderBy("at")
    count = lambda w: F.count(F.lit(1)).over(w).cast("int")
    return body.select(
        "doc_id", "pos", "n", "any_large", "at", "gap",
        count(line.rangeBetween(Window.unboundedPreceding, limit + 4)).alias("reach"), count(line.rangeBetween(Window.unboundedPreceding, least + 1)).alias("enough"),
        count(Window.partitionBy("doc_id").orderBy("section_index").rangeBetween(Window.unboundedPreceding, 0)).alias("last"))


def _first_beyond(b: Column, x: Column, reach: Column, distance: int, never: Column) -> Column:
    """The number of the first block that ends at ``x.at + distance`` or later, given how many begin before."""
    tail = F.element_at(b, -1)
    return F.when(reach < F.size(b), reach).when(tail["at"] + tail["n"] + 2 >= x["at"] + distance, F.size(b)).otherwise(never)


def _beginnings(jumps: Column) -> Column:
    """The blocks that are reached from the first one by ``jumps`` (the number of the next block for each), by doubling."""
    m = F.size(jumps)
    to = lambda j: lambda x: F.when(x <= F.size(j), F.get(j, x - 1)).otherwise(x)

    def twice(state, _):
        return F.struct(F.concat(state["known"], F.filter(F.transform(state["known"], to(state["jump"])), lambda x: x <= F.size(state["jump"]))).alias("known"),
                        F.transform(state["jump"], to(state["jump"])).alias("jump"))

    begun = F.struct(F.array(F.lit(1)).alias("known"), jumps.alias("jump"))
    return F.array_sort(F.aggregate(F.sequence(F.lit(1), F.ceil(F.log2(m + 1)).cast("int")), begun, twice)["known"])


def _bounds(rows: DataFrame, limit: int, least: int, split: bool, by_section: bool) -> DataFrame:
    """``doc_id, first, last, whole``: the places of the first and last block of each chunk.

    By section, a document without any chunk is packed whole.
    """
    points = _pointers(rows, limit, least, split)
    docs = points.groupBy("doc_id").agg(F.max("any_large").alias("any_large"), F.array_sort(F.collect_list(F.struct("at", "n", "pos", "gap", "reach", "enough", "last"))).alias("b"))
    b, m = F.col("b"), F.size("b")
    # the last block of a chunk that has an oversized one behind it: the first at or after each block, from the back
    gaps = F.transform(F.filter(F.transform(b, lambda x, i: F.struct(x["gap"].alias("gap"), (i + 1).alias("k"))), lambda x: x["gap"]), lambda x: x["k"])

    def over_limit(x, i):
        return F.greatest(_first_beyond(b, x, x["reach"], limit + 5, m + 1), i + 2)

    def jump(x, i):
        # where an oversized block ends a chunk that is long enough
        cut = F.when(F.size("gaps") == 0, m + 1).otherwise(F.coalesce(F.get("gaps", F.get("gap_at", _first_beyond(b, x, x["enough"], least + 2, m + 1) - 1)) + 1, m + 1))
        return F.least(over_limit(x, i), cut, x["last"] + 1)

    def chunks_of(jumps):
        ends = lambda r: F.get(b, F.get(jumps, r - 1) - 2)
        made = F.transform(_beginnings(jumps), lambda r: F.struct(F.get(b, r - 1)["pos"].alias("first"), ends(r)["pos"].alias("last"), (ends(r)["at"] + ends(r)["n"] - F.get(b, r - 1)["at"]).alias("size")))
        return F.filter(made, lambda c: c["size"] >= least)

    # how many gaps lie before each block: a running count, as the blocks are in order
    docs = docs.withColumn("gaps", gaps).withColumn("gap_at", _gaps_before(F.col("gaps"), m)).withColumn("whole_jumps", F.transform(b, over_limit))
    if by_section:
        docs = docs.withColumn("own_jumps", F.transform(b, jump))
        docs = docs.withColumn("own", chunks_of(F.col("own_jumps")))
        whole = (F.size("own") == 0) & ~F.col("any_large")
        docs = docs.select("doc_id", whole.alias("whole"), F.explode(F.when(whole, chunks_of(F.col("whole_jumps"))).otherwise(F.col("own"))).alias("c"))
    else:
        docs = docs.select("doc_id", F.lit(True).alias("whole"), F.explode(chunks_of(F.col("whole_jumps"))).alias("c"))
    return docs.select("doc_id", "c.first", "c.last", "whole")


def _gaps_before(gaps: Column, m: Column) -> Column:
    """For each of ``m`` blocks the number of ``gaps`` (sorted) before it."""
    runs = F.transform(F.concat(F.array(F.lit(0)), gaps), lambda g, i: F.array_repeat(i.cast("int"), (F.coalesce(F.get(gaps, i), m) - g).cast("int")))
    return F.flatten(runs)


def packed(rows: DataFrame, limit: int = MAX_CHARS, least: int = MIN_CHARS, by_section: bool = True) -> DataFrame:
    """``doc_id, place, k, text, block_ids, page, section`` of each chunk; ``place, k`` order a document's chunks.

    By section, blocks over the limit are split and documents without a chunk
    are packed whole; otherwise each document is one section and nothing is
    split.
    """
    marks = _bounds(rows, limit, least, by_section, by_section).select("doc_id", F.col("first").alias("pos"), F.lit(0).alias("kind"), F.struct("first", "last", "whole").alias("mark"))
    text = T.strip(F.col("text"))
    body = (F.col("block_type") != "DISCLAIMER") & (text != "")
    heading = F.col("block_type") == "HEADING"
    lines = rows.select("doc_id", "pos", F.lit(1).alias("kind"), F.when(body, text).alias("text"), "block_id", "page", F.when(heading, F.col("text")).alias("title")).where("text is not null or title is not null")
    over = Window.partitionBy("doc_id").orderBy("pos", "kind")
    large = (F.length("text") > limit) if by_section else F.lit(False)
    placed = lines.unionByName(marks, allowMissingColumns=True).select(
        "doc_id", "pos", "text", "block_id", "page", large.alias("large"), F.last("mark", True).over(over).alias("mark"), F.last("title", True).over(over).alias("title")).where("text is not null")
    inside = ~F.col("large") & (F.col("pos") <= F.col("mark.last"))
    first = F.when(F.col("large"), F.col("pos")).when(inside, F.col("mark.first"))
    whole = F.col("mark.whole") & ~F.col("large")
    # a title goes with the first block only: it may be long
    parts = placed.select("doc_id", first.alias("first"), "large", "pos", "text", "block_id", "page", F.when((first == F.col("pos")) & ~F.coalesce(whole, F.lit(False)), F.col("title")).alias("title")).where("first is not null")
    made = parts.groupBy("doc_id", "first", "large").agg(F.array_sort(F.collect_list(F.struct("pos", "text", "block_id", "page"))).alias("b"), F.max("title").alias("section"))
    whole_text = F.array_join(F.transform("b", lambda x: x["text"]), "\n\n")
    texts = F.when(F.col("large"), split_large(whole_text, limit)).otherwise(F.array(whole_text))
    return made.select(
        "doc_id", F.element_at("b", -1)["pos"].alias("place"), F.posexplode(texts).alias("k", "text"), F.transform("b", lambda x: x["block_id"]).alias("block_ids"),
        F.coalesce(F.get("b", F.lit(0))["page"], F.lit(1)).alias("page"), "section")


def chunks(rows: DataFrame, limit: int = MAX_CHARS, least: int = MIN_CHARS) -> DataFrame:
    """``doc_id, chunk_index, chunk_id, block_ids, page, text, section``; documents without a chunk are packed whole, unsplit."""
    n = F.row_number().over(Window.partitionBy("doc_id").orderBy("place", "k")) - 1
    return packed(rows, limit, least).withColumn("chunk_index", n).select(
        "doc_id", "chunk_index", F.concat_ws("_", F.col("doc_id").cast("string"), F.col("chunk_index").cast("string")).alias("chunk_id"), "block_ids", "page", "text", "section")
