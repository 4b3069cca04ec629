"""Result records: flat calls, search records, reports, validation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import ERRORS
from ..functions import text as T
from ..functions import vocab
from ..sources.pages import register
from .ranks import ranked

#: kind of tag: the words that it may have.
TAG_LISTS = {"theme": vocab.THEMES, "risk": vocab.RISKS, "region": vocab.REGIONS, "macro_regime": vocab.REGIMES}


def flat_calls(profiles: DataFrame, calls: DataFrame) -> DataFrame:
    as_of = F.coalesce("as_of_date", "publication_date").alias("as_of_date")
    return calls.join(profiles.select("doc_id", "manager_name", as_of), "doc_id").select(
        "manager_name", "doc_id", "as_of_date", "asset_class_category", "sub_asset_class", "call", "rationale_bullets", "tooltip_text")


def search_records(profiles: DataFrame, calls: DataFrame, order: str = "pos") -> DataFrame:
    nested = calls.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct(order, "asset_class_category", "sub_asset_class", "call", "tooltip_text"))), lambda c: F.struct(
        c.asset_class_category.alias("asset_class_category"), c.sub_asset_class.alias("sub_asset_class"), c.call.alias("call"), c.tooltip_text.alias("tooltip_text"))).alias("calls"))
    return profiles.join(nested, "doc_id", "left")


def citation_pages(citations: DataFrame) -> DataFrame:
    """``doc_id, page, excerpt``: the excerpts of a page joined by " ... ", in order."""
    return citations.groupBy("doc_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text_span"))), lambda x: x.text_span), " ... ").alias("excerpt"))


def unique_slugs(rows: DataFrame, name_col: str, order: str) -> DataFrame:
    """``slug``: the first row of a name keeps it, the next get -2, -3 ...; rows of one name may be any part of all."""
    s = rows.withColumn("_s", F.when(T.slug(F.col(name_col)) == "", "report").otherwise(T.slug(F.col(name_col))))
    numbered = ranked(s, ["_s"], [order], "_n")
    return numbered.withColumn("slug", F.when(F.col("_n") == 1, F.col("_s")).otherwise(F.concat_ws("-", "_s", "_n"))).drop("_s", "_n")


def records_json(rows: DataFrame, id_col: str = "doc_id", path: str | None = None) -> DataFrame:
    """``id, json``: each row as one JSON object; with ``path`` the objects are written there too, one to a line."""
    out = rows.select(id_col, F.to_json(F.struct(*rows.columns)).alias("json"))
    if path is not None:
        out.select("json").write.text(path)
    return out


def printed(rows: DataFrame, fields: Sequence[str], id_col: str = "doc_id", missing: str = "Not stated") -> DataFrame:
    """``id, shown``: chosen fields, one to a line, as ``name: value``."""
    lines = [F.concat(F.lit(f"{f}: "), F.coalesce(F.col(f).cast("string"), F.lit(missing))) for f in fields]
    return rows.select(id_col, F.concat_ws("\n", *lines).alias("shown"))


def cited_chunks(citations: DataFrame, chunks: DataFrame, id_col: str = "chunk_id", carried: Sequence[str] = ("text",)) -> DataFrame:
    """Citations with the columns of their chunk, null where no chunk has the id."""
    return citations.join(chunks.select(id_col, *carried), id_col, "left")


def cited_pages(*citations: DataFrame) -> DataFrame:
    """``doc_id, pages``: how many different pages some tables of citations (``doc_id, page``) name."""
    rows = reduce(DataFrame.unionByName, [c.select("doc_id", F.col("page").cast("long").alias("page")) for c in citations])
    return rows.groupBy("doc_id").agg(F.countDistinct("page").alias("pages"))


def zipped_tooltips(calls: DataFrame, tooltips: DataFrame, id_col: str = "doc_id", pos_col: str = "pos", key_col: str = "sub_asset_class") -> DataFrame:
    """Calls and tooltips place by place: ``id, pos, key, tooltip_text, fault``.

    ``fault`` is ``missing tooltip``, ``unexpected tooltip`` or ``other asset``
    where the two lists don't stand side by side.
    """
    left = calls.select(id_col, pos_col, F.col(key_col).alias("_a"), F.lit(True).alias("_called"))
    right = tooltips.select(id_col, pos_col, F.col(key_col).alias("_b"), "tooltip_text", F.lit(True).alias("_told"))
    fault = F.when(F.col("_told").isNull(), "missing tooltip").when(F.col("_called").isNull(), "unexpected tooltip").when(~F.col("_a").eqNullSafe(F.col("_b")), "other asset")
    return left.join(right, [id_col, pos_col], "full").select(id_col, pos_col, F.coalesce("_a", "_b").alias(key_col), "tooltip_text", fault.alias("fault"))


def highlights(citations: DataFrame, blocks: DataFrame, keys: Sequence[str] = ("doc_id", "citation_id")) -> DataFrame:
    """``keys, boxes``: the places (``bbox``) of the blocks of a citation (``block_ids``), in order; citations without any are left out."""
    asked = citations.select(*keys, F.posexplode("block_ids").alias("at", "block_id"))
    shared = [c for c in ("doc_id", "block_id") if c in asked.columns and c in blocks.columns]
    found = asked.join(blocks.select(*shared, "bbox").where("bbox is not null"), shared)
    return found.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "bbox"))), lambda x: x.bbox).alias("boxes"))


def validated(records: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id, errors array<string>``: what is wrong with output records, in order.

    ``records``: ``schema_errors array<string>`` of the parser, ``allocation_calls``
    (``asset_class_category, sub_asset_class, citations``), ``tags`` (a record of
    the lists of ``TAG_LISTS``) and ``summaries`` (with ``citations``). Codes, tags
    and citations are looked at only where the schema is clean.
    """
    none = F.array().cast("array<string>")
    subs = [s for _, s in vocab.taxonomy_rows()]
    said = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    no = lambda k: F.concat(F.lit("Call "), k.cast("string"))
    text = lambda x: F.coalesce(x, F.lit(""))
    codes = F.flatten(F.transform("allocation_calls", lambda c, k: F.array_compact(F.array(
        F.when(~text(c["asset_class_category"]).isin(*vocab.TAXONOMY), said(no(k), ": invalid category '", text(c["asset_class_category"]), "'")),
        F.when(~text(c["sub_asset_class"]).isin(*subs), said(no(k), ": invalid sub_asset '", text(c["sub_asset_class"]), "'"))))))
    def bad_tags(kind: str, words: Sequence[str]) -> Column:
        other = F.filter(F.coalesce(F.col("tags")[f"{kind}_tags"], none), lambda t: ~F.lower(t).isin(*words))
        return F.transform(other, lambda t: said(f"Invalid {kind}_tags value: '", t, "'"))

    tags = [bad_tags(kind, words) for kind, words in TAG_LISTS.items()]
    cited = F.flatten(F.transform("allocation_calls", lambda c, k: F.concat(
        F.when(F.coalesce(F.size(c["citations"]), F.lit(0)) <= 0, F.array(said(no(k), ": missing citations"))).otherwise(none),
        F.coalesce(F.flatten(F.transform(c["citations"], lambda x, j: F.array_compact(F.array(
            F.when(text(x["chunk_id"]) == "", said(no(k), " citation ", j.cast("string"), ": missing chunk_id")),
            F.when(F.coalesce(x["page"], F.lit(0)) < 1, said(no(k), " citation ", j.cast("string"), ": invalid page")))))), none))))
    whole = F.when(F.coalesce(F.size(F.col("summaries")["citations"]), F.lit(0)) <= 0, F.array(F.lit("Summaries: missing citations"))).otherwise(none)
    found = F.concat(F.coalesce(codes, none), *tags, F.coalesce(cited, none), whole)
    broken = F.coalesce("schema_errors", none)
    return records.select(id_col, F.when(F.size(broken) > 0, broken).otherwise(found).alias("errors"))


def outcomes(runs: DataFrame, stages: Sequence[str], id_col: str = "doc_id") -> DataFrame:
    """``id, status, error_type, error``: how runs ended.

    ``runs``: ``n_stages`` (how many of ``stages`` ended), ``error_type`` (a name
    of ``errors.ERRORS``, else it counts as ``PipelineError``) and ``message``;
    null messages are of runs that didn't fail. The error names the last stage
    that ended.
    """
    names = F.array(*map(F.lit, stages))
    last = F.when(F.col("n_stages") > 0, F.get(names, F.least(F.col("n_stages"), F.lit(len(stages))) - 1))
    failed = F.col("message").isNotNull()
    kind = F.when(F.col("error_type").isin(*ERRORS), F.col("error_type")).otherwise("PipelineError")
    status = F.when(failed, "failed").when(F.col("n_stages") >= len(stages), "completed").when(F.col("n_stages") > 0, "processing").otherwise("pending")
    error = F.concat(kind, F.lit(": "), F.col("message"), F.coalesce(F.concat(F.lit(" (after stage "), last, F.lit(")")), F.lit(" (before any stage)")))
    return runs.select(id_col, status.alias("status"), F.when(failed, kind).alias("error_type"), F.when(failed, F.left(error, F.lit(500))).alias("error"))


def invalid_tags(tags: DataFrame) -> DataFrame:
    """Tags outside the vocabulary of their type."""
    ok = F.lit(False)
    for kind, values in TAG_LISTS.items():
        ok = ok | ((F.col("tag_type") == kind) & F.lower("value").isin(*values))
    return tags.where(F.col("tag_type").isin(*TAG_LISTS) & ~ok).withColumn("error", F.concat(F.lit("Invalid "), F.col("tag_type"), F.lit("_tags value: '"), F.col("value"), F.lit("'")))


def _citation_html(page: Column, excerpt: Column) -> Column:
    text = F.concat(F.lit('<div class="citation"><div class="citation-meta">p.'), page.cast("string"), F.lit('</div><div class="citation-text">'), T.escaped_html(excerpt), F.lit("</div></div>"))
    return F.when(F.coalesce(excerpt, F.lit("")) != "", text).otherwise(F.concat(F.lit('<span class="citation-meta">p.'), page.cast("string"), F.lit("</span>")))


def report_html(records: DataFrame) -> DataFrame:
    """``doc_id, html``: a page for each document.

    ``records``: ``title, manager_name, publication_date, score, band,
    executive_summary, calls array<struct<asset_class_category, sub_asset_class,
    call, confidence, rationale_bullets, tooltip_text>>, citations
    array<struct<page, excerpt>>``; what is null is not stated. Texts are escaped.
    """
    none = '<span class="muted">Not stated</span>'
    shown = lambda c: F.when(T.has_value(c), F.replace(T.escaped_html(c), F.lit("\n"), F.lit("<br>"))).otherwise(none)
    words = F.array().cast("array<string>")
    bullets = lambda xs: F.when(F.size(F.coalesce(xs, words)) > 0, F.concat(F.lit("<ul>"), F.array_join(F.transform(xs, lambda b: F.concat(F.lit("<li>"), T.escaped_html(b), F.lit("</li>"))), ""), F.lit("</ul>"))).otherwise(none)
    score = lambda x: F.concat(F.lit('<span class="confidence-dot '), T.dot(x), F.lit('"></span>'), T.shown_percent(x))
    call = lambda c: F.concat(
        F.lit('<section class="call"><h3>'), T.escaped_html(T.display_name(c["sub_asset_class"])), F.lit("</h3><p>"), T.escaped_html(T.display_name(c["asset_class_category"], True)),
        F.lit(' <span class="'), T.badge(c["call"]), F.lit('">'), T.token_words(c["call"]), F.lit("</span> "), score(c["confidence"]), F.lit("</p><p>"), shown(c["tooltip_text"]), F.lit("</p>"), bullets(c["rationale_bullets"]), F.lit("</section>"))
    part = lambda name, body: F.concat(F.lit(f"<h2>{name}</h2>"), body)
    list_of = lambda col, one: F.coalesce(F.array_join(F.transform(col, one), ""), F.lit(""))
    html = F.concat(
        F.lit("<!doctype html><html><head><meta charset='utf-8'><title>"), T.escaped_html(F.coalesce("title", F.lit("Not stated"))), F.lit("</title></head><body><h1>"), shown(F.col("title")), F.lit("</h1><p>"),
        shown(F.col("manager_name")), F.lit(" | "), T.shown_date(F.col("publication_date")), F.lit(' | <span class="'), T.badge(F.col("band")), F.lit('">'), T.token_words(F.col("band")), F.lit("</span> "), score(F.col("score")), F.lit("</p>"),
        part("Summary", F.concat(F.lit("<p>"), shown(F.col("executive_summary")), F.lit("</p>"))), part("Calls", list_of("calls", call)),
        part("Sources", list_of("citations", lambda c: _citation_html(c["page"], c["excerpt"]))), F.lit("</body></html>"))
    return records.select("doc_id", html.alias("html"))


#: Documents of one page of a report pack's index.
INDEX_ITEMS = 1000


def report_pack(records: DataFrame, title: str = "Report pack", name_col: str = "title", items: int | None = INDEX_ITEMS) -> DataFrame:
    """``name, html``: the pages of ``report_html`` under unique names, and an index where there is more than one.

    The index links the pages in the order of their names, ``items`` of them on
    each of ``index.html``, ``index-2.html`` ...; an index page links the next.
    With None there is one index page for all, so one row that grows with the
    pack; its items are still made in parts, which only their text leaves.
    """
    named = unique_slugs(records, name_col, "doc_id").withColumn("name", F.concat("slug", F.lit(".html")))
    pages = report_html(named).join(named.select("doc_id", "name"), "doc_id").select("name", "html")
    shown = named.select(F.lit(0).alias("_all"), "name", F.coalesce(F.col(name_col), F.lit("Not stated")).alias("shown"), T.shown_date(F.col("publication_date")).alias("date"), T.token_words(F.col("band")).alias("band"))
    placed = ranked(shown, ["_all"], ["name"], "_place").withColumn("part", F.floor((F.col("_place") - 1) / (items or INDEX_ITEMS)))
    item = F.struct("name", "shown", "date", "band")
    parts = placed.groupBy("part").agg(F.array_sort(F.collect_list(item)).alias("items"))
    line = lambda x: F.concat(F.lit("<li><a href='"), x["name"], F.lit("'>"), T.escaped_html(x["shown"]), F.lit("</a> "), x["date"], F.lit(" "), x["band"], F.lit("</li>"))
    head = F.lit("<!doctype html><html><head><meta charset='utf-8'><title>"), T.escaped_html(F.lit(title)), F.lit("</title></head><body><h1>"), T.escaped_html(F.lit(title)), F.lit("</h1><ul>")
    lines = F.array_join(F.transform("items", line), "").alias("lines")
    if items is None:
        whole = parts.select("part", F.size("items").alias("n"), lines).groupBy().agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "lines"))), lambda p: p["lines"]), "").alias("lines"), F.sum("n").alias("n"))
        return pages.unionByName(whole.where("n > 1").select(F.lit("index.html").alias("name"), F.concat(*head, "lines", F.lit("</ul></body></html>")).alias("html")))
    # each part knows whether another follows: the first row of the next one says so to it
    follows = placed.where((F.col("_place") - 1) % items == 0).select((F.col("part") - 1).alias("part"), F.lit(True).alias("more"))
    parts = parts.join(follows, "part", "left").where("part > 0 or size(items) > 1")
    file = lambda part: F.when(part == 0, "index.html").otherwise(F.concat(F.lit("index-"), (part + 1).cast("string"), F.lit(".html")))
    forward = F.when(F.col("more"), F.concat(F.lit("<p><a href='"), file(F.col("part") + 1), F.lit("'>More</a></p>"))).otherwise("")
    index = parts.select(file(F.col("part")).alias("name"), F.concat(*head, lines, F.lit("</ul>"), forward, F.lit("</body></html>")).alias("html"))
    return pages.unionByName(index)


def write_report_pack(pack: DataFrame, path: str, overwrite: bool = False) -> None:
    """The pages of a pack as files in a folder (a URI); none is there before all are written."""
    register(pack.sparkSession)
    pack.select("name", "html").write.format("report_files").option("path", path).mode("overwrite" if overwrite else "append").save()
