"""License scans by ordered signature rules, in DataFrame functions alone.

A rule is a regular expression, a label, a priority and a confidence. Some are
signatures of license texts, written out by hand (see ``signatures``); the
others are notices: license names, each with its versions, in the forms in which
a name is given. Several hundred in all. A document is held against a rule only
if it contains the rule's keyword and a part that its form needs; every match of
the rule holds both. All matches are intervals of the text; one that lies inside
another of at least its priority is suppressed, and of equal intervals the first
rule stays. Suppression is a running maximum over the sorted intervals of a
document, so a text with ten thousand notices takes no pairs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import let, lower_ascii, matches_by, text_of
from .signatures import GAP, GATES, SIGNATURES

_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What isn't in a word, before A-Z are made lower case.
_RAW_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Phrases and labels of the base; fixed values of the contract.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: label: (keyword, the name as a pattern over lower-cased text); every match of the pattern contains the keyword.
NAMES = {
    "apache": ("apache", r"apache"), "apache-2.0": ("apache", r"apache(?: software)?(?: license)?,? *(?:version |v)?2(?:\.0)?"),
    "apache-1.1": ("apache", r"apache(?: software)?(?: license)?,? *(?:version |v)?1\.1"),
    "mit": ("mit", r"mit"), "mit-0": ("mit", r"mit no attribution"), "x11": ("x11", r"x11"),
    "bsd": ("bsd", r"bsd"), "bsd-2-clause": ("bsd", r"(?:simplified bsd|bsd[ -]2[ -]clause|2[ -]clause bsd)"),
    "bsd-3-clause": ("bsd", r"(?:(?:new|modified|revised) bsd|bsd[ -]3[ -]clause|3[ -]clause bsd)"), "0bsd": ("bsd", r"(?:0bsd|zero[ -]clause bsd)"),
    "gpl": ("general public", r"(?:gnu )?general public"), "gpl-2.0": ("gpl", r"(?:gnu )?gpl *-?(?:version |v)?2(?:\.0)?"),
    "gpl-3.0": ("gpl", r"(?:gnu )?gpl *-?(?:version |v)?3(?:\.0)?"), "gpl-any": ("gpl", r"(?:gnu )?gpl"),
    "gpl-3.0-text": ("general public", r"(?:gnu )?general public license,? *(?:version |v)3(?:\.0)?"),
    "gpl-2.0-text": ("general public", r"(?:gnu )?general public license,? *(?:version |v)2(?:\.0)?"),
    "lgpl": ("lesser", r"(?:gnu )?lesser general public"), "lgpl-2.1": ("lgpl", r"(?:gnu )?lgpl *-?(?:version |v)?2\.1"), "lgpl-3.0": ("lgpl", r"(?:gnu )?lgpl *-?(?:version |v)?3(?:\.0)?"),
    "agpl": ("affero", r"(?:gnu )?affero general public"), "agpl-3.0": ("agpl", r"(?:gnu )?agpl *-?(?:version |v)?3(?:\.0)?"),
    "mpl": ("mozilla", r"mozilla public"), "mpl-2.0": ("mpl", r"mpl *-?(?:version |v)?2(?:\.0)?"), "mpl-1.1": ("mpl", r"mpl *-?(?:version |v)?1\.1"),
    "epl": ("eclipse", r"eclipse public"), "epl-2.0": ("epl", r"epl *-?(?:version |v)?2(?:\.0)?"), "epl-1.0": ("epl", r"epl *-?(?:version |v)?1(?:\.0)?"),
    "cddl": ("cddl", r"cddl"), "isc": ("isc", r"isc"), "zlib": ("zlib", r"zlib"), "boost": ("boost", r"boost(?: software)?"), "unlicense": ("unlicense", r"unlicense"),
    "artistic": ("artistic", r"artistic"), "wtfpl": ("wtfpl", r"wtfpl"), "eupl": ("eupl", r"eupl"), "ofl": ("ofl", r"(?:sil )?ofl"), "postgresql": ("postgresql", r"postgresql"), "python": ("python", r"python software foundation"), "psf": ("psf", r"psf"), "openssl": ("openssl", r"openssl"),
    "cc0": ("cc0", r"cc0"), "cc-by": ("cc", r"cc[ -]by"), "cc-by-sa": ("cc", r"cc[ -]by-sa"), "cc-by-nc": ("cc", r"cc[ -]by-nc"), "cc-by-nd": ("cc", r"cc[ -]by-nd"),
    "cc-by-nc-sa": ("cc", r"cc[ -]by-nc-sa"), "cc-by-nc-nd": ("cc", r"cc[ -]by-nc-nd"),
    "cc-by-long": ("creative commons", r"creative commons attribution"), "cc-by-sa-long": ("creative commons", r"creative commons attribution[ -]share ?alike"),
    "cc-by-nc-long": ("creative commons", r"creative commons attribution[ -]non ?commercial"), "cc-by-nd-long": ("creative commons", r"creative commons attribution[ -]no ?deriv(?:ative)?s?(?: works)?"),
}
#: Labels of other spellings of a license that has a label already.
SAME = {"psf": "python", "gpl-any": "gpl", "gpl-3.0-text": "gpl-3.0", "gpl-2.0-text": "gpl-2.0", "cc-by-long": "cc-by", "cc-by-sa-long": "cc-by-sa", "cc-by-nc-long": "cc-by-nc", "cc-by-nd-long": "cc-by-nd"}
#: form: (priority, confidence, pattern around the name). A higher priority suppresses a lower one inside it.
FORMS = {
    "identifier": (4, 1.0, r"spdx-license-identifier: *{}(?:-only|-or-later|\+)?"),
    "granted": (3, 0.95, r"(?:licensed|released|distributed|published|available|made available|provided|redistributed) under (?:the )?(?:terms of )?(?:the )?(?:a )?{}(?: public)?(?: licen[sc]e)?(?:,? *(?:version |v)?[0-9](?:\.[0-9])?)?"),
    "covered": (3, 0.9, r"(?:subject to|governed by|covered by|under) (?:the )?(?:terms of )?(?:the )?{}(?: licen[sc]e)"),
    "versioned": (2, 0.85, r"{} licen[sc]e,? *(?:version |v)?[0-9](?:\.[0-9])?"),
    "versioned short": (2, 0.85, r"{}[ -](?:version |v)?[1-4]\.[0-9]"),
    "field": (2, 0.85, r"licen[sc]e(?:d)?: *(?:the )?{}"),
    "named": (1, 0.75, r"{} licen[sc]e"),
}
#: form: parts of its pattern beside the name, of which no match can lack all.
NEEDS = {
    "identifier": ("spdx-license-identifier:",),
    "granted": ("ed under ", "available under "),
    "covered": (" licen",),
    "versioned": (" licen",),
    "versioned short": (".",),
    "field": ("licen",),
    "named": (" licen",),
}


#: Every short notice with a version contains this.
SHORT = r"[ -](?:version |v)?[1-4]\.[0-9]"


def rule_rows() -> list[tuple]:
    """``rule, keyword, needs, pattern, label, priority, confidence, form``, in order: signatures first."""
    rows = []
    for label, keyword, priority, confidence, signature in SIGNATURES:
        word, tail = keyword.split()[-1], f"(?:{GAP})?".join(part.replace(" ", GAP) for part in signature.split(" ?"))
        rows.append((len(rows), word, [word], rf"(?<![a-z0-9]){tail}", label, priority, confidence, "signature"))
    for form, (priority, confidence, around) in FORMS.items():
        for name, (keyword, pattern) in NAMES.items():
            rows.append((len(rows), keyword, list(NEEDS[form]), rf"(?<![a-z0-9]){around.replace('{}', pattern)}(?![a-z0-9])", SAME.get(name, name), priority, confidence, f"{form}: {name}"))
    return rows


def rules(spark: SparkSession) -> DataFrame:
    """The rules as a table: a few hundred rows, whatever the data."""
    return spark.createDataFrame(rule_rows(), "rule int, keyword string, needs array<string>, pattern string, label string, priority int, confidence double, form string").coalesce(1)


def _lower(text: Column) -> Column:
    """The text in lower case, character by character: other letters than A-Z tell nothing here.

    Two characters, whose lower case is longer or an ASCII letter, take a slower way.
    """
    odd = F.contains(text, F.lit("\u0130")) | F.contains(text, F.lit("\u212a"))
    return F.when(odd, lower_ascii(text)).otherwise(F.lower(text))


def detections(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, h, start, end, rule, label, priority, confidence, suppressed`` of every match.

    ``start`` and ``end`` are code points of the text; ``h`` hashes the text, for
    ids that several rows share: rows that repeat both count once. Null and empty
    texts have no match; null ids are kept. Other columns aren't read.
    """
    table = F.broadcast(rules(docs.sparkSession))
    any_of = lambda t, parts: reduce(lambda a, b: a | b, [F.contains(t, F.lit(p)) for p in parts])
    marks = sorted({n for form, needs in NEEDS.items() for n in needs if form != "versioned short"})
    found_in = lambda t, words: F.filter(F.array(*map(F.lit, words)), lambda k: F.contains(t, k))
    of_texts, of_notices = (sorted({r[1] for r in rule_rows() if (r[7] == "signature") == kind}) for kind in (True, False))

    def keywords(t: Column) -> Column:
        """The keywords in a lower-cased text, of those rules that its gates leave."""
        none = F.array().cast("array<string>")
        notice = any_of(t, marks) | t.rlike(SHORT)
        return F.array_union(F.when(any_of(t, GATES), found_in(t, of_texts)).otherwise(none), F.when(notice, found_in(t, of_notices)).otherwise(none))

    # the text is made lower case once; those without a keyword go no further
    low = let(_lower(text_of(text_col)), lambda t: F.struct(t.alias("t"), keywords(t).alias("k")))
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_of(text_col)).alias("h"), low.alias("x"))
    # the outer form, as a filter that is inferred from the plain one would look for the keywords once more
    keyed = keyed.select("doc_id", "h", F.col("x.t").alias("t"), F.explode_outer("x.k").alias("keyword")).where("keyword is not null")
    held = keyed.join(table, "keyword").where(F.exists("needs", lambda n: F.contains(F.col("t"), n)))
    tried = held.where(F.rlike("t", F.col("pattern"))).select("doc_id", "h", "rule", "label", "priority", "confidence", F.explode(matches_by(F.col("t"), F.col("pattern"))).alias("s"))
    found = tried.select("doc_id", "h", "s.start", "s.end", "rule", "label", "priority", "confidence").distinct()
    order = Window.partitionBy("doc_id", "h").orderBy("start", F.desc("end"), F.desc("priority"), "rule").rowsBetween(Window.unboundedPreceding, -1)
    levels = sorted({r[5] for r in rule_rows()})
    inside = F.lit(False)
    for p in levels:
        reach = F.max(F.when(F.col("priority") >= p, F.col("end"))).over(order)
        inside = inside | ((F.col("priority") == p) & F.coalesce(reach >= F.col("end"), F.lit(False)))
    return found.withColumn("suppressed", inside)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_found`` per row.

    The base counts the places where the words of a phrase stand together.
    ``labels`` are those of the base and of the rules that stay after
    suppression; ``score`` is the highest confidence among them (0.8 for a base
    place), 0 without any. A null text is empty. Null and repeated ids are kept.
    Other columns aren't read. An empty table gives no row.
    """
    text = text_of(text_col)
    kept = detections(docs, id_col, text_col).where("not suppressed").groupBy(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).agg(
        F.collect_set("label").alias("found"), F.max("confidence").alias("best"), F.count(F.lit(1)).alias("n_found"))
    # words are cut only where a phrase can stand; their number needs no lower case
    likely = text.rlike("(?i)" + "|".join("[^a-z]+".join(p.split()) for p in PHRASES))
    none, no_places = F.array().cast("array<string>"), F.array().cast("array<int>")

    def places(w: Column, phrase: str) -> Column:
        parts = phrase.split()
        at = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.get(w, i) == parts[0])
        return F.when(F.size(w) >= len(parts), F.filter(at, lambda i: F.slice(w, i + 1, len(parts)) == F.array(*map(F.lit, parts)))).otherwise(no_places)

    words = let(F.array_remove(F.split(lower_ascii(text), _NOT_WORD), ""), lambda w: F.struct(*[places(w, p).alias(f"p{k}") for k, p in enumerate(PHRASES)]))
    empty = F.struct(*[no_places.alias(f"p{k}") for k in range(len(PHRASES))])
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("_h2"), F.size(F.array_remove(F.split(text, _RAW_GAP), "")).cast("long").alias("n_words"), F.when(likely, words).otherwise(empty).alias("p"))
    rows = rows.select("doc_id", "_h2", "n_words", "p.*")
    every = F.flatten(F.array(*[f"p{k}" for k in range(len(PHRASES))]))
    base = F.array_compact(F.array(*[F.when(F.size(f"p{k}") > 0, F.lit(x)) for k, x in enumerate(PHRASES.values())]))
    rows = rows.select("doc_id", "_h2", "n_words", every.alias("all"), base.alias("base"))
    done = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h2") == F.col("_h")), "left")
    return done.select(
        "doc_id", "n_words", F.size("all").cast("long").alias("n_base"), F.array_min("all").cast("long").alias("first_word"), F.array_max("all").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("found", none))), ",").alias("labels"),
        F.greatest(F.when(F.size("base") > 0, 0.8).otherwise(0.0), F.coalesce("best", F.lit(0.0))).alias("score"),
        F.coalesce("n_found", F.lit(0)).cast("long").alias("n_found"))
