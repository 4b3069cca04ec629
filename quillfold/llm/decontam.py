"""Benchmark decontamination by template canonicalisation, in DataFrame functions alone.

A text's template has one token for each word or number: numbers become ``0``,
a unit after a number ``1``, a capitalised word inside a sentence (a name)
``2``, every other word itself in lower case; all else only separates. A
capitalised word elsewhere, as at the head of a sentence, a text or a quote, may
be a name or not: a window that holds some has two readings, one with all of
them as words and one with all of them as ``2``. Windows of ``WINDOW`` template
tokens of the benchmark are joined by hash with those of the corpus; one occurs
where a reading does. Where it occurs several times, the place counts whose
distance from the item's place most other windows share; where several such
distances hold enough windows, each copy is judged by itself, too. A document
holds an item when enough of the item's windows occur in it, and its slots are
consistent: each value that the item has in a slot stands for one value of the
document wherever it occurs. So a question whose numbers, names or units were
exchanged throughout is found as ``reparameterised``, and a chance likeness of
templates is not. An item of fewer than ``INFORMATIVE`` different words is no
template that tells anything: it is found only with the values that it has.

The windows of the corpus are never shuffled where the benchmark's fit into a
broadcast of ``BROADCAST_WINDOWS`` rows, which is checked by counting; beyond
that the same join shuffles both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, sized, text_of, written

WINDOW = 8
COVERAGE = 0.5
CONSISTENT = 0.8
#: Different words, beside placeholders, that an item must have to be found with other values.
INFORMATIVE = 4
BROADCAST_WINDOWS = 2_000_000
#: Units that become a placeholder after a number.
UNITS = (
    "km", "m", "cm", "mm", "mi", "miles", "mile", "ft", "feet", "inches", "kg", "g", "mg", "lb", "lbs", "pounds", "oz", "tons",
    "l", "ml", "litres", "liters", "gallons", "s", "ms", "sec", "seconds", "min", "minutes", "h", "hr", "hours", "days", "weeks",
    "months", "years", "dollars", "euros", "cents", "percent", "degrees", "meters", "metres", "kilometers", "kilograms", "grams",
    "mph", "kmh", "w", "kw", "v", "hz", "gb", "mb", "kb",
)
_NUMBER = r"[0-9]+(?:[.,:/][0-9]+)*"
_UNIT = r"(?i) 0 \s*(?:" + "|".join(sorted(UNITS, key=len, reverse=True)) + r")(?![\p{L}])"
# the capital is looked for first: most places are left at once
_CAPITALISED = r"(?=\p{Lu})(?<!\p{L})\p{Lu}\p{Ll}+(?!\p{L})"
_NAME = r"(?=\p{Lu})(?<=[\p{L}\p{N},;)] )\p{Lu}\p{Ll}+(?!\p{L})"


def _marked(text: Column) -> Column:
    """A text whose numbers and units are placeholders."""
    return F.regexp_replace(F.regexp_replace(text, _NUMBER, " 0 "), _UNIT, " 0 1 ")


def _tokens(marked: Column, names: str) -> Column:
    return F.array_remove(F.split(F.lower(F.regexp_replace(marked, names, "2")), r"[^\p{L}012]+"), "")


def template(text: Column, names: str = _NAME) -> Column:
    """The template tokens of a text; with ``_CAPITALISED`` every capitalised word is a name."""
    return _tokens(_marked(text), names)


def _hashed(tokens: Column) -> Column:
    return F.transform(tokens, lambda x: F.xxhash64(x))


def _surface(text: Column) -> Column:
    """The words and numbers that the template's tokens stand for, in lower case."""
    return F.lower(F.regexp_replace(text, rf"({_NUMBER})", " $1 ")), rf"{_NUMBER}|\p{{L}}+"


def surface_tokens(text: Column) -> Column:
    spaced, pattern = _surface(text)
    return F.regexp_extract_all(spaced, F.lit(pattern), F.lit(0))


def _grams(hashes: Column, size: int) -> Column:
    """A hash of each window of ``size`` hashes; none where there are fewer.

    Windows of a power of two are made of two halves, each hashed once for all
    windows that it is in.
    """
    none = F.array().cast("array<bigint>")
    if size & (size - 1):
        return let(hashes, lambda h: F.when(F.size(h) >= size, F.transform(F.sequence(F.lit(1), F.size(h) - size + 1), lambda i: F.xxhash64(F.slice(h, i, size)))).otherwise(none))

    def doubled(of: Column, half: int) -> Column:
        pairs = lambda h: F.zip_with(F.slice(h, 1, F.size(h) - half), F.slice(h, half + 1, F.size(h) - half), lambda x, y: F.xxhash64(x, y))
        return let(of, lambda h: F.when(F.size(h) > half, pairs(h)).otherwise(none))

    half = 1
    while half < size:
        hashes, half = doubled(hashes, half), 2 * half
    return hashes


def _windows(rows: DataFrame, keys: list[str], size: int) -> DataFrame:
    """``keys, pos, w, wide``: the hashes of both readings of each window of ``size`` tokens, given as hashes ``t`` and ``u``."""
    both = F.zip_with(_grams(F.col("t"), size), _grams(F.col("u"), size), lambda x, y: F.struct(x.alias("w"), y.alias("wide")))
    return rows.select(*keys, F.posexplode(both).alias("pos", "s")).select(*keys, "pos", "s.w", "s.wide")


def _readings(windows: DataFrame) -> DataFrame:
    """A row for each reading of a window, as ``w``."""
    both = F.when(F.col("w") == F.col("wide"), F.array("w")).otherwise(F.array("w", "wide"))
    return windows.select(*[c for c in windows.columns if c not in ("w", "wide")], F.explode(both).alias("w"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", window: int = WINDOW, coverage: float = COVERAGE, consistent: float = CONSISTENT, informative: int = INFORMATIVE) -> DataFrame:
    """``doc_id, item_id, n_matched, n_windows, n_slots, n_changed, kind``: one row for each item that a document holds.

    ``n_matched`` of the item's ``n_windows`` distinct windows occur in the
    document; ``n_changed`` of the ``n_slots`` slots in them have another value
    there. Of several copies that of the fewest changes is told. ``kind`` is ``verbatim`` or ``reparameterised``. Items of fewer words
    than a window are matched whole, and their capitalised first words are names
    only if two words, and half of all, are left beside placeholders; items without a word, null texts and null
    ids match nothing. Items with equal templates are told apart by their slots
    alone. Rows that repeat an id are one document (or item). Empty tables give
    no row; other columns aren't read.
    """
    items = benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).alias("item_id"), text_of(item_text_col).alias("text"))
    items = items.select("item_id", template(F.col("text")).alias("t"), template(F.col("text"), _CAPITALISED).alias("u"), surface_tokens(F.col("text")).alias("raw")).where(F.size("t") > 0).dropDuplicates(["item_id"])
    items = written(items.withColumn("size", F.least(F.lit(window), F.size("t"))), "items")
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())  # at most ``window`` numbers
    if not sizes:
        sizes = [window]
    both = let(_marked(text_of(text_col)), lambda m: F.struct(_hashed(_tokens(m, _NAME)).alias("t"), _hashed(_tokens(m, _CAPITALISED)).alias("u")))
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), both.alias("b")).select("doc_id", "b.t", "b.u")
    # of a window that an item has twice, the first place counts
    known = None
    for k in sizes:
        kept = F.size(F.filter("u", lambda x: ~x.isin("0", "1", "2")))
        own = items.where(F.col("size") == k)
        if k < window:
            own = own.withColumn("u", F.when((kept >= 2) & (2 * kept >= k), F.col("u")).otherwise(F.col("t")))
        own = _windows(own.select("item_id", _hashed(F.col("t")).alias("t"), _hashed(F.col("u")).alias("u")), ["item_id"], k).groupBy("item_id", "w").agg(F.min("pos").alias("ipos"), F.min_by("wide", "pos").alias("wide"))
        own = _readings(own).withColumn("size", F.lit(k))
        known = own if known is None else known.unionByName(own)
    known = written(known, "item-windows")
    fits = known.count() <= BROADCAST_WINDOWS
    found = None
    for k in sizes:
        side = known.where(F.col("size") == k).drop("size")
        hit = _readings(_windows(rows, ["doc_id"], k)).join(F.broadcast(side) if fits else side, "w").select("doc_id", "item_id", "ipos", "pos")
        found = hit if found is None else found.unionByName(hit)
    found = written(found.distinct(), "found-windows")
    totals = known.groupBy("item_id").agg(F.countDistinct("ipos").alias("n_windows"), F.max("size").alias("size"))
    totals = sized(written(totals, "item-sizes"))
    enough = F.col("n_matched") >= F.ceil(F.col("n_windows") * coverage)
    collected = [F.count(F.lit(1)).alias("n_matched"), F.collect_list(F.struct("ipos", "pos")).alias("spots")]
    # at each distance of the places, the windows of the item that stand there
    away = F.col("pos") - F.col("ipos")
    shared = F.count(F.lit(1)).over(Window.partitionBy("doc_id", "item_id", away))
    places = found.withColumn("n", shared).groupBy("doc_id", "item_id", "ipos").agg(F.max_by("pos", F.struct("n", -F.col("pos"))).alias("pos"))
    whole = places.groupBy("doc_id", "item_id").agg(*collected).withColumn("copy", F.lit(None).cast("int")).join(totals, "item_id").where(enough)
    # copies that stand for themselves, where there are several
    copies = found.groupBy("doc_id", "item_id", away.alias("copy")).agg(F.count(F.lit(1)).alias("n_matched")).join(totals, "item_id").where(enough)
    several = copies.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("doc_id", "item_id"))).where("n > 1").select("doc_id", "item_id", "copy")
    apart = found.withColumn("copy", away).join(several, ["doc_id", "item_id", "copy"], "left_semi").groupBy("doc_id", "item_id", "copy").agg(*collected).join(totals, "item_id")
    likely = written(whole.unionByName(apart), "likely")
    # slots: places of the item's template that hold a placeholder, inside windows that matched
    slots = items.select("item_id", "raw", "t", F.posexplode("u").alias("at", "kind")).where(F.col("kind").isin("0", "1", "2"))
    slots = slots.select("item_id", "at", F.get("raw", F.col("at")).alias("value"), (F.get("t", F.col("at")) == F.col("kind")).alias("sure"))
    slots = sized(written(slots, "slots"))
    spot = F.array_min(F.filter("spots", lambda s: (s.ipos <= F.col("at")) & (F.col("at") < s.ipos + F.col("size"))))
    wanted = likely.select("doc_id", "item_id", "copy", "size", "spots").join(slots, "item_id").select(
        "doc_id", "item_id", "copy", "value", "sure", F.struct((spot.pos + F.col("at") - spot.ipos).alias("place")).place.alias("place"), "at").where("place is not null")
    asked = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "copy", "at", "value", "sure", "place")).alias("asked"))
    asked = written(asked, "asked")
    few = sized(asked.select("doc_id"))  # texts move only if they are asked about
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).join(few, "doc_id", "left_semi").join(asked, "doc_id")
    there = texts.select("doc_id", "asked", surface_tokens(F.col("text")).alias("raw")).select("doc_id", "raw", F.explode("asked").alias("a")).select(
        "doc_id", "a.item_id", "a.copy", "a.at", "a.value", "a.sure", F.get("raw", F.col("a.place")).alias("now"))
    there = there.groupBy("doc_id", "item_id", "copy", "at", "value", "sure").agg(F.min("now").alias("now"))
    by_value = there.groupBy("doc_id", "item_id", "copy", "value", "now").agg(F.count(F.lit(1)).alias("n"), F.max("sure").alias("sure")).groupBy("doc_id", "item_id", "copy", "value").agg(
        F.sum("n").alias("all"), F.max("n").alias("most"), F.sum(F.when(~F.col("value").eqNullSafe(F.col("now")), F.col("n")).otherwise(0)).alias("changed"), F.max("sure").alias("sure"))
    # a capitalised word that is the same throughout was a word, not a name
    by_value = by_value.where("sure or changed > 0")
    checked = by_value.groupBy("doc_id", "item_id", "copy").agg(F.sum("all").alias("n_slots"), F.sum("most").alias("agree"), F.sum("changed").alias("n_changed"))
    checked = checked.withColumnsRenamed({"doc_id": "_doc", "item_id": "_item", "copy": "_copy"})
    none = F.lit(0).cast("long")
    same = (F.col("doc_id") == F.col("_doc")) & (F.col("item_id") == F.col("_item")) & F.col("copy").eqNullSafe(F.col("_copy"))
    words = F.size(F.array_distinct(F.filter("t", lambda x: ~x.isin("0", "1", "2"))))
    told = sized(written(items.select("item_id", (words >= informative).alias("telling")), "telling"))
    done = likely.select("doc_id", "item_id", "copy", "n_matched", "n_windows").join(checked, same, "left").join(told, "item_id")
    changed, slot = F.coalesce("n_changed", none), F.coalesce("n_slots", none)
    kept = done.where(F.coalesce(F.col("agree") >= consistent * F.col("n_slots"), F.lit(True)) & (F.col("telling") | (changed == 0)))
    best = kept.groupBy("doc_id", "item_id").agg(F.min(F.struct(changed.alias("n_changed"), (-F.col("n_matched")).alias("less"), slot.alias("n_slots"), "n_windows")).alias("x"))
    return best.select(
        "doc_id", "item_id", (-F.col("x.less")).alias("n_matched"), "x.n_windows", "x.n_slots", "x.n_changed",
        F.when(F.col("x.n_changed") > 0, "reparameterised").otherwise("verbatim").alias("kind"))
