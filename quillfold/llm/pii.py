"""Personal data: patterns, and terms that give protected values away.

*Base.* Emails, network addresses, card numbers and phone numbers are found by
patterns, leftmost and non-overlapping for each kind. Spark has no function for
the places of matches, so a text is split at a pattern: the lengths of the gaps
and of the matches give the places, in code points.

*Method.* Protected entities are the values found and the classes that they
belong to, as most values occur once: the kind, the domain of an email, the
network (two numbers) of an address, the issuer (six digits) of a card, the
country and area (four digits) of a phone number. Over all documents the corpus
estimates how much a term t tells of an entity e: ``PMI(t; e) = log2(p(e|t) /
p(e))``. Knowing e is worth its information content ``IC(e) = -log2 p(e)``. A
term with ``PMI >= disclosure * IC``, seen with e in at least ``support``
different texts, is a span of kind ``term`` wherever it stands in a text with
e: it is generalised, or removed where it tells nearly all of e. Base values go
altogether.

Only DataFrame functions run here. Co-occurrence is counted where entities are;
terms that can't reach the threshold even among these documents are dropped
before the counts of terms in the whole corpus are joined to the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_at, let, lower_ascii, matches, running, sized, spans_between, text_of, written

KINDS = ("email", "ip", "card", "phone", "term")
SUPPORT = 3
DISCLOSURE = 0.8
#: From this share of IC on a term is removed, below it is generalised.
REMOVED = 0.95

# The contract's patterns in forms that take linear time and no deep recursion: what is repeated is never given back,
# and a run is tried from its beginning only.
_LABEL = "A-Za-z0-9-"
_LOCAL = r"A-Za-z0-9._%+-"
_EMAIL = rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[{_LABEL}]++(?:\.[{_LABEL}]++)++"
_IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?+[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_TERM = r"[\p{L}\p{N}]+"


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    value = lambda i: F.substring(digits, n - i, F.lit(1)).cast("int")
    each = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i % 2 == 0, value(i)).otherwise(value(i) * 2 - F.when(value(i) > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def base_spans(text: Column) -> Column:
    """``start, rank, end, kind, value`` of the base spans of a text, by start, then kind."""
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    digit = text.rlike("[0-9]")
    bare = lambda s: F.regexp_replace(s.value, "[^0-9]", "")
    email = F.when(F.contains(text, F.lit("@")), matches(text, _EMAIL)).otherwise(none)
    ip = F.filter(
        F.when(digit & F.contains(text, F.lit(".")), matches(text, _IP)).otherwise(none),
        lambda s: F.forall(F.split(s.value, r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.coalesce(F.regexp_replace(p, "^0+", "").try_cast("int"), F.lit(0)) <= 255)),
    )
    near = F.filter(F.when(digit, matches(text, _CARD)).otherwise(none), lambda s: (s.end - s.start >= 12) & (s.end - s.start <= 37))
    card = F.filter(near, lambda s: F.length(bare(s)).between(12, 19) & _luhn(bare(s)))
    phone = F.filter(F.when(digit & F.contains(text, F.lit("+")), matches(text, _PHONE)).otherwise(none), lambda s: F.length(bare(s)).between(9, 15))

    def named(spans: Column, rank: int) -> Column:
        return F.transform(spans, lambda s: F.struct(s.start.alias("start"), F.lit(rank).alias("rank"), s.end.alias("end"), F.lit(KINDS[rank]).alias("kind"), s.value.alias("value")))

    return F.array_sort(F.concat(*[named(spans, k) for k, spans in enumerate((email, ip, card, phone))]))


def joined_spans(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def entities(spans: Column) -> Column:
    """The protected entities of a text with base ``spans``: their values and the classes of these, each once."""
    digits = lambda v: F.regexp_replace(v.value, "[^0-9]", "")
    part = (
        lambda v: F.when(v.kind == "email", F.lower(F.substring_index(v.value, "@", -1))).when(v.kind == "ip", F.substring_index(v.value, ".", 2))
        .when(v.kind == "card", F.left(digits(v), F.lit(6))).otherwise(F.left(digits(v), F.lit(4)))
    )
    named = F.transform(spans, lambda v: F.array(v.kind, F.concat_ws(" of ", v.kind, part(v)), F.concat_ws(":", v.kind, v.value)))
    return F.array_distinct(F.flatten(named))


def told_terms(docs: DataFrame, held: DataFrame, text_col: str, support: int, disclosure: float) -> DataFrame:
    """``e, t, share``: the terms that disclose an entity; ``held`` has ``h, entities, own, text`` of texts with entities.

    ``share`` is PMI over IC, at most 1 but for rounding.
    """
    bare = F.array_distinct(F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(_TERM), F.lit(0)))
    once = held.groupBy("h").agg(F.first(F.struct("entities", "own", "text")).alias("x"), F.count(F.lit(1)).alias("n")).select("h", "n", "x.*")
    once = written(once.select("n", "entities", F.array_except(bare, "own").alias("terms")), "entity-texts")
    total = max(docs.count(), 2)
    known = once.select("n", F.explode("entities").alias("e")).groupBy("e").agg(F.sum("n").alias("df_e"), F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= support).drop("texts")
    # what all texts hold tells nothing
    known = sized(written(known.where(F.col("df_e") < total), "known-entities"))
    pairs = (
        once.select("n", F.explode("entities").alias("e"), "terms").join(known, "e").select("n", "e", "df_e", F.explode("terms").alias("t"))
        .groupBy("e", "df_e", "t").agg(F.sum("n").alias("both"), F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= support).drop("texts")
    )
    share = lambda df: 1 + F.log2(F.col("both") / F.col(df)) / F.greatest(F.log2(F.lit(total) / F.col("df_e")), F.lit(1e-9))
    near = once.select("n", F.explode("terms").alias("t")).groupBy("t").agg(F.sum("n").alias("df_near"))
    likely = written(pairs.join(near, "t").where(share("df_near") >= disclosure), "likely-terms")
    wanted = sized(written(likely.select("t").distinct(), "wanted-terms"))
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(lower_ascii(text_of(text_col)), F.lit(_TERM), F.lit(0)))).alias("t"))
    counts = words.join(wanted, "t", "left_semi").groupBy("t").agg(F.count(F.lit(1)).alias("df_t"))
    return likely.join(counts, "t").where(share("df_t") >= disclosure).select("e", "t", share("df_t").alias("share"))


def disclosing_terms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """``doc_id, h, terms array<struct<start,rank,end,kind,share>>`` of documents in which terms disclose an entity.

    ``h`` is the hash of the text, for ids that several rows share. Null and
    empty texts have no entities. The words of a text's entities are no terms of
    it. Of terms that start together the higher share comes last. An empty table
    gives no row; other columns aren't read.
    """
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).where("text rlike '[0-9]' or contains(text, '@')")
    with_spans = rows.withColumn("s", base_spans(F.col("text"))).where("size(s) > 0")
    # the words of entities themselves are protected already
    words = F.array_distinct(F.flatten(F.transform("s", lambda s: F.regexp_extract_all(lower_ascii(s.value), F.lit(_TERM), F.lit(0)))))
    held = written(with_spans.select("doc_id", F.xxhash64("text").alias("h"), "text", entities(F.col("s")).alias("entities"), words.alias("own")), "entities")
    told = told_terms(docs, held, text_col, support, disclosure)
    # a text's own terms first: only those in it can be placed
    by_term = sized(written(told.groupBy("t").agg(F.collect_list(F.struct("e", "share")).alias("tells")), "told-terms"))
    inside = F.explode(F.array_except(F.array_distinct(F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(_TERM), F.lit(0))), "own"))
    best = F.array_max(F.transform(F.filter("tells", lambda x: F.array_contains("entities", x.e)), lambda x: x.share))
    hit = held.select("doc_id", "h", "entities", inside.alias("t")).join(by_term, "t").withColumn("share", best).where("share is not null")
    hit = hit.groupBy("doc_id", "h").agg(F.collect_set(F.struct("t", "share")).alias("found")).join(held.select("doc_id", "h", "text").dropDuplicates(["doc_id", "h"]), ["doc_id", "h"])
    placed = hit.select("doc_id", "h", "text", F.explode("found").alias("x")).select("doc_id", "h", "text", "x.*")
    pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}])\Q"), F.col("t"), F.lit(r"\E(?![\p{L}\p{N}])"))
    gaps = F.transform(F.split(lower_ascii(F.col("text")), pattern, -1), F.length)
    n = F.length("t")
    spans = spans_between(F.col("g"), F.transform(F.slice("g", 2, F.greatest(F.size("g") - 1, F.lit(0))), lambda x: n))
    named = F.transform(spans, lambda s: F.struct(s.start.alias("start"), F.lit(4).alias("rank"), s.end.alias("end"), F.lit("term").alias("kind"), F.col("share")))
    return placed.withColumn("g", gaps).select("doc_id", "h", named.alias("s")).groupBy("doc_id", "h").agg(F.array_sort(F.flatten(F.collect_list("s"))).alias("terms"))


def sanitised(text: Column, spans: Column) -> Column:
    """The text with spans (by start) exchanged; what overlaps an earlier span goes with it.

    A term of a share below ``REMOVED`` is generalised to ``[TERM]``, one above
    goes; base values are exchanged for their kind.
    """
    say = lambda s: F.when(s.share >= REMOVED, "").otherwise(F.concat(F.lit("["), F.upper(s.kind), F.lit("]")))

    def clean(piece, s: Column, reach: Column) -> Column:
        pieces = F.transform(s, lambda x, k: let(F.get(reach, k), lambda at: F.when(x.start >= at, F.concat(piece(at, x.start - at), say(x))).otherwise("")))
        end = F.element_at(reach, -1)
        return F.concat(F.array_join(pieces, ""), piece(end, F.length(text) - end))

    whole = lambda s: let(running(F.transform(s, lambda x: x.end), F.greatest), lambda reach: cut_at(text, lambda piece: clean(piece, s, reach)))
    return let(spans, lambda s: F.when(F.size(s) > 0, whole(s)).otherwise(text))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT, disclosure: float = DISCLOSURE, clean: bool = True) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term`` (and ``clean_text``) per row.

    A null text is empty and has no spans. Null and repeated ids are kept; each
    row is judged by its own text. Other columns aren't read. An empty table
    gives no row.
    """
    text = text_of(text_col)
    terms = disclosing_terms(docs, id_col, text_col, support, disclosure)
    base = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("h"), base_spans(text).alias("base"), *([text.alias("text")] if clean else []))
    rows = base.join(terms.withColumnsRenamed({"doc_id": "_id", "h": "_h"}), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left")
    no_terms = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,share:double>>")
    wide = F.transform("base", lambda s: F.struct(s.start.alias("start"), s["rank"].alias("rank"), s.end.alias("end"), s.kind.alias("kind"), F.lit(None).cast("double").alias("share")))
    rows = rows.withColumn("all", F.array_sort(F.concat(wide, F.coalesce("terms", no_terms))))
    number = lambda k: F.size(F.filter("base", lambda s: s.kind == k)).cast("long")
    return rows.select(
        "doc_id", *[number(k).alias(f"n_{k}") for k in KINDS[:4]], F.sha2(joined_spans(F.col("base")), 256).alias("base_sha256"),
        joined_spans(F.col("all")).alias("spans"), F.size(F.coalesce("terms", no_terms)).cast("long").alias("n_term"),
        *([sanitised(F.col("text"), F.col("all")).alias("clean_text")] if clean else []))
