"""Scalar operators as column expressions: no Python runs per row."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Mapping, Sequence
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import names, vocab


#: What ``\s`` matches.
SPACES = " \t\n\x0b\f\r"


def strip(x: Column) -> Column:
    """Without ASCII white space at both ends."""
    return F.btrim(x, F.lit(SPACES))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(x: Column) -> Column:
    """Tokens between white space; a blank text has none."""
    return F.array_remove(F.split(strip(x), r"\s+"), "")


def normalize_text(x: Column) -> Column:
    """Join hyphenated line ends, make runs of spaces one space, strip."""
    return strip(F.regexp_replace(F.replace(x, F.lit("-\n"), F.lit("")), " +", " "))


def block_type(text: Column, page: Column, index: Column, size: Column | None = None, flags: Column | None = None, average: Column | None = None, bold_mask: int = 2) -> Column:
    """HEADING, BULLET or PARAGRAPH by the first rule that holds; font columns are optional."""
    bullet = text.rlike(r"^\s*(?:" + "|".join(rf"\Q{m}\E" for m in vocab.BULLETS) + r"|[1-9]\.)")
    out = F.when(~text.rlike(r"\S"), "PARAGRAPH").when(bullet, "BULLET")
    if flags is not None:
        out = out.when(flags.bitwiseAND(bold_mask) != 0, "HEADING")
    if size is not None and average is not None:
        out = out.when((average > 0) & (size > average * 1.2), "HEADING")
    out = out.when((index < 3) & (page == 1), "HEADING")
    if size is not None:
        out = out.when(size >= 14, "HEADING")
    return out.otherwise("PARAGRAPH")


def special_ratio(text: Column) -> Column:
    """Share of characters that are neither letters, numbers nor white space."""
    return F.when(F.length(text) > 0, F.length(F.regexp_replace(text, r"[\p{L}\p{N}\s]", "")) / F.length(text)).otherwise(0.0)


def block_confidence(text: Column) -> Column:
    n = F.length(text)

    def score(ratio: Column) -> Column:
        raw = F.lit(0.8) - F.when(n < 5, 0.3).otherwise(0.0) - F.when(ratio > 0.5, 0.2).otherwise(0.0) + F.when((n > 20) & (ratio < 0.3), 0.1).otherwise(0.0)
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw))

    return once(special_ratio(text), score)


def unit_clamp(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def normalized_box(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column) -> Column:
    return F.struct(unit_clamp(x0 / width).alias("x0"), unit_clamp(y0 / height).alias("y0"), unit_clamp(x1 / width).alias("x1"), unit_clamp(y1 / height).alias("y1"))


def cell_box(row: Column, col: Column, rows: Column, cols: Column) -> Column:
    """The grid estimate of a table cell's place: 80 % of the width from 0.1, 60 % of the height from 0.2."""
    w, h = F.lit(0.8) / cols, F.lit(0.6) / rows
    return F.struct((0.1 + col * w).alias("x0"), (0.2 + row * h).alias("y0"), (0.1 + (col + 1) * w).alias("x1"), (0.2 + (row + 1) * h).alias("y1"))


def any_match(text: Column, patterns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.rlike(p) for p in patterns])


def first_label(text: Column, patterns: Mapping[str, str]) -> Column:
    """The key of the first pattern that matches, else null."""
    out = None
    for name, p in patterns.items():
        out = F.when(text.rlike(p), name) if out is None else out.when(text.rlike(p), name)
    return out


#: Keywords that are looked for one by one; more go through an automaton of all of them.
FEW_KEYWORDS = 16


def _letter(c: str) -> bool:
    return c == "_" or unicodedata.category(c)[0] in "LN"


@lru_cache(8)
def keyword_finder(plain: tuple[str, ...], worded: tuple[str, ...]) -> Callable[[str | None], list[str]]:
    """A function from a lower-cased text to its keywords, in order; ``worded`` ones only where no letter or number is beside them.

    The automaton reads a text once, whatever the number of keywords.
    """
    import ahocorasick

    index = ahocorasick.Automaton()
    for k in {*plain, *worded}:
        index.add_word(k, k)
    index.make_automaton()
    alone, known = frozenset(worded), {k: None for k in sorted({*plain, *worded})}

    def find(text: str | None) -> list[str]:
        out: set[str] = set()
        for end, k in index.iter(text or ""):
            if k not in out and (k not in alone or not (end >= len(k) and _letter(text[end - len(k)]) or end + 1 < len(text) and _letter(text[end + 1]))):
                out.add(k)
                if len(out) == len(known):
                    break
        return sorted(out)

    return find


def hits(text: Column, substrings: Sequence[str], whole: Sequence[str] = vocab.WHOLE_WORDS) -> Column:
    """The keywords in a text: as substrings, those in ``whole`` as whole words; in alphabetical order; none in a null text.

    A few keywords are looked for one after another in the JVM; the time for
    more of them doesn't depend on their number.
    """
    plain = tuple(sorted({k for k in substrings if k and k not in whole}))
    worded = tuple(sorted({k for k in substrings if k and k in whole}))
    if len(plain) + len(worded) > FEW_KEYWORDS:
        return _searched(plain, worded)(F.lower(text))

    def found(low: Column) -> Column:
        out = F.filter(F.array(*map(F.lit, plain)), lambda k: F.contains(low, k)) if plain else F.array().cast("array<string>")
        ones = [F.when(F.contains(low, F.lit(k)) & low.rlike(rf"(?<![\p{{L}}\p{{N}}_])\Q{k}\E(?![\p{{L}}\p{{N}}_])"), F.lit(k)) for k in worded]
        return F.array_sort(F.concat(out, F.array_compact(F.array(*ones)))) if ones else out

    return once(F.lower(text), found)


def _searched(plain: tuple[str, ...], worded: tuple[str, ...]) -> Callable[[Column], Column]:
    @F.arrow_udf("array<string>")
    def search(texts: pa.Array) -> pa.Array:
        find = keyword_finder(plain, worded)
        return pa.array([find(t) for t in texts.to_pylist()], pa.list_(pa.string()))

    return search


def manager_name(x: Column) -> Column:
    s = strip(F.coalesce(x, F.lit("")))
    return F.when((s == "") | F.lower(s).isin(*vocab.UNKNOWN_MANAGERS), "Unspecified").otherwise(s)


def plausible_date(x: Column, asof: Column, days: int = vocab.MAX_AGE_DAYS) -> Column:
    """The ISO date if it isn't in the future or too old, else null."""
    d = F.try_to_date(x, "yyyy-MM-dd")
    return F.when(d.between(F.date_sub(asof, days), asof), d)


def indicator(x: Column) -> Column:
    up = F.upper(x)
    table = F.create_map(*[F.lit(v) for kv in vocab.INDICATOR.items() for v in kv])
    return F.coalesce(F.element_at(table, up), up)


def allowed_tags(tags: Column, allowed: Sequence[str]) -> Column:
    """Lower-cased, stripped tags that the vocabulary has, in their order."""
    return F.filter(F.transform(tags, lambda t: F.lower(strip(t))), lambda t: t.isin(*allowed))


def band(score: Column) -> Column:
    return F.when(score >= 0.8, "HIGH").when(score >= 0.6, "MEDIUM").otherwise("LOW")


def long_words(x: Column) -> Column:
    """The distinct lower-cased words longer than two characters."""
    return F.array_distinct(F.filter(words(F.lower(x)), lambda w: F.length(w) > 2))


def shared_words(left: Column, right: Column) -> Column:
    """The share of the words of ``left`` that ``right`` has; both are arrays without repeats."""
    return F.when(F.size(left) == 0, 0.0).otherwise(F.size(F.array_intersect(left, right)) / F.size(left))


def word_overlap(a: Column, b: Column) -> Column:
    """Share of the distinct words of ``a`` longer than two characters that ``b`` has."""
    return shared_words(long_words(a), long_words(b))


def explicit_mention(value: Column, text: Column) -> Column:
    return F.when(value.isNull(), 0.0).otherwise(once(F.lower(text), lambda t: mentioned_in(value, t)))


def mentioned_in(value: Column, low: Column) -> Column:
    """``explicit_mention`` in a text that is in lower case already."""
    v = F.lower(value)
    long = F.filter(words(v), lambda w: F.length(w) > 2)
    some = F.when(F.size(long) > 0, F.forall(long, lambda w: F.contains(low, w))).otherwise(F.lit(False))
    return F.when(value.isNull(), 0.0).when(F.contains(low, v), 1.0).when(some, 0.8).otherwise(0.0)


def entailment(value: Column, text: Column) -> Column:
    return once(F.lower(text), lambda t: entailed_by(value, t))


def entailed_by(value: Column, low: Column) -> Column:
    """``entailment`` by a text that is in lower case already."""
    v = F.lower(value)
    head = F.regexp_replace(F.substring(v, 1, 20), r"([^\p{L}\p{N}\s])", r"\\$1")
    patterns = [F.concat(F.lit(r"(we|our|the)\s+\w*\s*"), head), F.concat(head, F.lit(r"\s+(is|are|will|should)")), F.concat(F.lit(r"(expect|believe|view|see)\s+.*"), head)]
    some = F.exists(F.slice(words(v), 1, 3), lambda w: F.contains(low, w))
    # no pattern matches without the head, and looking for that is cheap
    return F.when(F.contains(low, F.substring(v, 1, 20)) & reduce(lambda a, b: a | b, [F.rlike(low, p) for p in patterns]), 1.0).when(some, 0.5).otherwise(0.0)


def call_language(direction: Column, text: Column, table: Mapping[str, Sequence[str]] = vocab.CALL_LANGUAGE) -> Column:
    low, out = F.lower(text), F.lit(0.0)
    for name, patterns in table.items():
        out = F.when(direction == name, F.when(any_match(low, patterns), 1.0).otherwise(0.0)).otherwise(out)
    return out


def token_estimate(x: Column) -> Column:
    return F.floor(F.length(x) / 4)


def hash16(x: Column) -> Column:
    return F.substring(F.sha2(x, 256), 1, 16)


def json_clean(x: Column) -> Column:
    """Without the fence of a code block around it."""
    s = F.regexp_replace(strip(x), r"^```(?:json)?", "")
    return strip(F.regexp_replace(s, r"```$", ""))


def preview(x: Column, n: int) -> Column:
    return F.when(F.length(x) > n, F.concat(F.left(x, F.lit(n)), F.lit("..."))).otherwise(x)


def humanized(x: Column) -> Column:
    return F.initcap(F.lower(F.replace(x, F.lit("_"), F.lit(" "))))


def slug(x: Column) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(strip(x)), r"[^a-z0-9\s_-]", ""), r"[\s_-]+", "-")
    return F.regexp_replace(s, "^-+|-+$", "")


def redacted(message: Column, secrets: Sequence[str] = (), limit: int = 500) -> Column:
    out = reduce(lambda m, s: F.replace(m, F.lit(s), F.lit("[REDACTED]")), [s for s in secrets if s], message)
    sensitive = reduce(lambda a, b: a | b, [F.contains(F.lower(out), F.lit(w)) for w in vocab.SENSITIVE])
    return F.when(sensitive, "[REDACTED]").when(F.length(out) > limit, F.concat(F.lit("[TRUNCATED payload length="), F.length(out), F.lit("]"))).otherwise(out)


def ungrounded(text: Column, source: Column, pattern: str) -> Column:
    """Distinct matches of ``pattern`` that the source doesn't have verbatim, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: ~F.contains(source, m))))


def date_grounded(iso: Column, source: Column) -> Column:
    """The year is in the source, and its month as a number or by name."""
    year, month = F.substring(iso, 1, 4), F.substring(iso, 6, 2)
    low = F.lower(source)
    named = F.lit(False)
    for m, names in vocab.MONTHS.items():
        named = named | ((month == m) & reduce(lambda a, b: a | b, [F.contains(low, F.lit(n)) for n in names]))
    bare = F.regexp_replace(month, "^0+", "")
    bare = F.when(bare == "", "0").otherwise(bare)
    return F.contains(source, year) & (F.contains(source, month) | F.contains(source, bare) | named)


def merged_unique(a: Column, b: Column, limit: int) -> Column:
    return F.slice(F.array_distinct(F.concat(a, b)), 1, limit)


def tooltip_faults(text: Column) -> Column:
    """The faults of a tooltip, in order."""
    n = F.size(words(text))
    generic = reduce(lambda a, b: a | b, [F.contains(F.lower(text), F.lit(p)) for p in vocab.GENERIC_TOOLTIPS])
    return F.array_compact(F.array(F.when(n > 25, "too_many_words"), F.when(F.length(text) > 150, "too_many_characters"), F.when(generic & (n < 15), "generic")))


def _looked_up(key: Column, table: Mapping[str, str]) -> Column:
    return F.element_at(F.create_map(*[F.lit(v) for kv in table.items() for v in kv]), key)


def token_words(x: Column) -> Column:
    """An enumeration's word as readable text; nothing is "Not stated"."""
    return F.when(F.coalesce(x, F.lit("")) == "", "Not stated").otherwise(humanized(x))


def display_name(code: Column, category: bool = False, table: Mapping[str, str] | None = None) -> Column:
    """The name of a category or sub-asset, else its words."""
    known = table if table is not None else names.CATEGORY_NAMES if category else names.SUB_ASSET_NAMES
    return F.coalesce(_looked_up(code, known), token_words(code))


def shown_date(x: Column) -> Column:
    return F.coalesce(F.date_format(x, "MMM dd, yyyy"), F.lit("Not stated"))


def shown_time(x: Column) -> Column:
    """A timestamp, in the session's zone, which is UTC for reports; nothing is empty."""
    return F.coalesce(F.concat(F.date_format(x, "dd MMM yyyy HH:mm"), F.lit(" UTC")), F.lit(""))


def shown_seconds(x: Column) -> Column:
    return F.format_string("%.2fs", x.cast("double"))


def shown_percent(x: Column) -> Column:
    """Whole percents, halves to the even one."""
    return F.coalesce(F.concat(F.bround(x * 100, 0).cast("int").cast("string"), F.lit("%")), F.lit("Not stated"))


def has_value(x: Column) -> Column:
    s = strip(F.coalesce(x, F.lit("")))
    return (s != "") & (F.lower(s) != "not stated")


def badge(x: Column) -> Column:
    return F.concat(F.lit("badge badge--"), F.coalesce(_looked_up(x, names.BADGES), F.lit("neutral")))


def dot(score: Column) -> Column:
    """The dot of a confidence; none is medium."""
    return F.concat(F.lit("confidence-dot--"), F.when(score.isNull(), "medium").otherwise(F.lower(band(score))))


def escaped_html(x: Column) -> Column:
    pairs = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"))
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, x)
