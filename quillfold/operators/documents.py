"""Documents as ordered blocks: ingest, typing, cleaning, sections.

Blocks are rows ``doc_id, pos, page, idx, block_id, text, block_type``. A
document is the unit of every window here, so windows never gather more than one
document; everything else is a projection or an aggregate with a partial step.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vocab


def ingest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", registry: DataFrame | None = None) -> DataFrame:
    """``doc_id, file_hash, document_id, is_duplicate``: the first id with a hash owns it, known hashes win.

    ``registry`` has ``file_hash, document_id`` of what was stored before.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.sha2(F.col(text_col), 256).alias("file_hash"))
    first = rows.groupBy("file_hash").agg(F.min("doc_id").alias("first_id"))
    out = rows.join(first, "file_hash")
    if registry is None:
        return out.select("doc_id", "file_hash", F.col("first_id").alias("document_id"), (F.col("doc_id") != F.col("first_id")).alias("is_duplicate"))
    known = registry.groupBy("file_hash").agg(F.min("document_id").alias("known_id"))
    out = out.join(known, "file_hash", "left")
    return out.select("doc_id", "file_hash", F.coalesce("known_id", "first_id").alias("document_id"),
                      (F.col("known_id").isNotNull() | (F.col("doc_id") != F.col("first_id"))).alias("is_duplicate"))


def blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lines_per_page: int = 5) -> DataFrame:
    """The lines of texts as blocks; the generator runs beside the scan, without a shuffle."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "text"))
    rows = rows.withColumn("page", F.floor(F.col("pos") / lines_per_page).cast("int") + 1).withColumn("idx", F.col("pos") % lines_per_page)
    return rows.select("doc_id", "pos", "page", "idx", F.concat_ws("_", "page", "idx").alias("block_id"), "text", T.block_type(F.col("text"), F.col("page"), F.col("idx")).alias("block_type"))


def html_blocks(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``page_id, pos, tag, text, block_type`` of headings, paragraphs, list items and footers of HTML."""
    pattern = r"(?s)<(h[1-6]|p|li|footer)(?:\s[^>]*)?>(.*?)</\1>"
    html = F.col(html_col)
    tags, bodies = F.regexp_extract_all(html, F.lit(pattern), F.lit(1)), F.regexp_extract_all(html, F.lit(pattern), F.lit(2))
    rows = pages.select(F.col(id_col).alias("page_id"), F.posexplode(F.arrays_zip(tags, bodies)).alias("pos", "x"))
    text = T.strip(F.regexp_replace(F.regexp_replace(F.col("x")["1"], "<[^>]*>", " "), r"\s+", " "))
    rows = rows.select("page_id", "pos", F.col("x")["0"].alias("tag"), text.alias("text")).where("text <> ''")
    kind = F.when(F.col("tag").rlike("^h"), "HEADING").when(F.col("tag") == "li", "BULLET").when(F.col("tag") == "footer", "FOOTER").otherwise("PARAGRAPH")
    return rows.withColumn("block_type", kind)


def table_cells(tables: DataFrame) -> DataFrame:
    """One TABLE_CELL block per non-empty cell of ``doc_id, page, table_index, rows array<array<string>>``."""
    at = tables.select("doc_id", "page", "table_index", F.posexplode("rows").alias("row", "cells"))
    at = at.select("doc_id", "page", "table_index", "row", F.posexplode("cells").alias("col", "text")).withColumn("text", T.strip(F.coalesce("text", F.lit(""))))
    return at.where("text <> ''").select(
        "doc_id", "page", F.concat_ws("_", "page", F.lit("tbl"), "table_index").alias("table_id"), "row", "col", "text", (F.col("row") == 0).alias("is_header"),
        F.concat_ws("_", "page", "table_index", "row", "col").alias("block_id"), F.lit("TABLE_CELL").alias("block_type"), F.lit(0.9).alias("confidence"))


def coverage(rows: DataFrame) -> DataFrame:
    """``doc_id, page_count, covered, coverage``: pages with any text over all pages."""
    covered = F.countDistinct(F.when(T.strip(F.col("text")) != "", F.col("page")))
    return rows.groupBy("doc_id").agg(F.max("page").alias("page_count"), covered.alias("covered")).withColumn(
        "coverage", F.when(F.col("page_count") > 0, F.col("covered") / F.col("page_count")).otherwise(0.0))


def font_average(spans: DataFrame, by: Sequence[str] = ("doc_id",), size: str = "size") -> DataFrame:
    """``by, average``: the mean of the positive font sizes; null where there is none."""
    return spans.groupBy(*by).agg(F.avg(F.when(F.col(size) > 0, F.col(size))).alias("average"))


def typed_by_font(spans: DataFrame, by: Sequence[str] = ("doc_id",), bold_mask: int = 2) -> DataFrame:
    """``spans`` (``text, page, idx, size, flags``) with ``block_type`` by all rules, fonts included.

    Which bit of ``flags`` is bold depends on the reader of the files; 2 is the
    italic bit of some, and ``bold_mask=16`` their bold one.
    """
    c = F.col
    return spans.join(font_average(spans, by), list(by)).withColumn(
        "block_type", T.block_type(c("text"), c("page"), c("idx"), c("size"), c("flags"), c("average"), bold_mask))


def mark_disclaimers(rows: DataFrame, patterns: Sequence[str] = vocab.DISCLAIMERS) -> DataFrame:
    """Types every matching block DISCLAIMER; ``first_disclaimer`` is the first one's id in its document."""
    is_one = T.any_match(F.col("text"), patterns)
    first = F.min_by(F.when(is_one, F.col("block_id")), F.when(is_one, F.col("pos"))).over(Window.partitionBy("doc_id"))
    return rows.withColumn("first_disclaimer", first).withColumn("block_type", F.when(is_one, "DISCLAIMER").otherwise(F.col("block_type")))


def drop_boilerplate(rows: DataFrame) -> DataFrame:
    """Without the second and third of three equal first (or last) blocks of consecutive present pages."""
    page = Window.partitionBy("doc_id", "page").orderBy("pos")
    ends = rows.withColumn("top", F.row_number().over(page) == 1).withColumn("bottom", F.row_number().over(Window.partitionBy("doc_id", "page").orderBy(F.desc("pos"))) == 1)

    def gone(edge: str) -> DataFrame:
        over = Window.partitionBy("doc_id").orderBy("page")
        row = ends.where(edge).select("doc_id", "page", "pos", "text", "block_type")
        typed = F.col("block_type").isin("HEADING", "PARAGRAPH")
        start = row.withColumn("run", typed & (F.lead("text", 1).over(over) == F.col("text")) & (F.lead("text", 2).over(over) == F.col("text")))
        before = F.coalesce(F.lag("run", 1).over(over), F.lit(False)) | F.coalesce(F.lag("run", 2).over(over), F.lit(False))
        return start.withColumn("gone", before).where("gone").select("doc_id", "pos")

    return rows.join(gone("top").unionByName(gone("bottom")).distinct(), ["doc_id", "pos"], "left_anti")


def sections(rows: DataFrame, patterns: Mapping[str, str] = vocab.SECTIONS) -> DataFrame:
    """Blocks with ``section_index``: a heading opens a section; a running sum numbers them from 0."""
    over = Window.partitionBy("doc_id").orderBy("pos")
    n = F.sum((F.col("block_type") == "HEADING").cast("long")).over(over)
    first = F.first("block_type").over(over) == "HEADING"
    return rows.withColumn("section_index", n - F.when(first, 1).otherwise(0))


def section_table(rows: DataFrame, patterns: Mapping[str, str] = vocab.SECTIONS) -> DataFrame:
    """``doc_id, section_id, title, start_block_id, end_block_id, section_type``."""
    s = sections(rows, patterns).groupBy("doc_id", "section_index").agg(
        F.min_by("block_id", "pos").alias("start_block_id"), F.max_by("block_id", "pos").alias("end_block_id"),
        F.min_by(F.struct("block_type", "text"), "pos").alias("head"), F.count(F.lit(1)).alias("n_blocks"))
    title = F.when(F.col("head.block_type") == "HEADING", F.col("head.text"))
    return s.select("doc_id", F.concat_ws("_sec_", F.col("doc_id").cast("string"), F.col("section_index").cast("string")).alias("section_id"), title.alias("title"),
                    "start_block_id", "end_block_id", T.first_label(title, patterns).alias("section_type"), "n_blocks")
