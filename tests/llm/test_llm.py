"""The training-data operators against brute force, round trips and held-out labels, with their edge cases."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from quillfold.llm import bpe, chat, common, components, decontam, exact_dedup, jaccard_join, licenses, pii, quality, suffix_array, suffix_dedup, token_store
from quillfold.llm.queries import vocabulary

SF = "/root/testdata/sf0.001"
#: Nulls, empty and blank texts, ties, repeated rows, odd characters; extra columns with the operators' own names.
EDGE = [(1, None), (2, ""), (3, " \n\t"), (4, "a"), (5, "same text of some words here ok"), (6, "same text of some words here ok"), (6, "same text of some words here ok"), (None, "same text of some words here ok"),
        (8, "Ünï ©ode 漢字 😀 \x01 é"), (9, "x" * 5000), (10, "w " * 3000), (11, "<|endoftext|> hi <|x|> \\ |")]
SCHEMA = "doc_id long, text string"


def edge(spark, empty=False):
    df = spark.createDataFrame([] if empty else EDGE, SCHEMA)
    return df.select("*", *[F.lit(1).alias(c) for c in ("h", "n", "pos", "name", "id", "score", "rep", "tree", "_v", "size")])


def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# ---------------------------------------------------------------- exact dedup

def test_exact_dedup(spark):
    base = docs(spark).select("doc_id", "text").unionByName(spark.createDataFrame([(9000 + i, "".join(random.Random(i // 3).choices("ab ", k=700))) for i in range(60)], SCHEMA))
    rows = base.collect()
    groups = collections.defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")].append(r.doc_id)
    want = {i: (min(g), len(g), i == min(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}
    for size in (64, 2048):
        got = {r.doc_id: tuple(r)[1:] for r in exact_dedup.exact_dedup(base, block_bytes=size).collect()}
        assert got == want


def test_exact_dedup_edges(spark):
    got = collections.Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(edge(spark)).collect())
    assert got[1, 1, 2, True] == 1 and got[2, 1, 2, False] == 1 and got[6, 5, 4, False] == 2 and got[None, 5, 4, False] == 1 and sum(got.values()) == len(EDGE)
    assert exact_dedup.exact_dedup(edge(spark, True)).count() == 0


def test_hot_blocks_are_named_alike(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", 10)
    rows = [(i, "copy " * 40 if i % 2 else f"own {i}") for i in range(400)]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, SCHEMA), block_bytes=32)
    assert got.where("kept").count() == 201


# ---------------------------------------------------------------- components and Jaccard join

def brute_components(links):
    parent = {}

    def find(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(1000, 1060)]
    df = spark.createDataFrame([*links, (7, 7), (None, 3)], "a long, b long").select("*", *[F.lit(1).alias(c) for c in ("id", "component", "m")])
    got = {r.id: r.component for r in components.components(df).collect()}
    assert got == {i: c for i, c in brute_components([x for x in links if x[0] != x[1]]).items()}
    assert components.components(df.limit(0)).count() == 0


def brute_jaccard(rows, num, den, width):
    sets = {}
    for i, t in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        sets[i] = frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    found = brute_components(links)
    return {i: (len(s), found.get(i, i)) for i, s in sets.items()}


def near_copies(rng, n=150):
    base = [[rng.choice("abcdefghijklmnop") * rng.randint(1, 3) for _ in range(40)] for _ in range(6)]
    rows = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = f"z{rng.randrange(50)}"
        rows.append((i, " ".join(w)))
    return rows + [(1000 + k, t) for k, t in enumerate(["", None, "one", "one", "ONE", "two words", "a b c"])]


@pytest.mark.parametrize("num,width,leaf,task", [(90, 3, 4, 512), (80, 5, 64, 512), (80, 5, 2, 8), (60, 2, 3, 4), (90, 3, 2, 3)])
def test_jaccard_join(spark, num, width, leaf, task):
    rows = near_copies(random.Random(num + leaf))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_join(spark.createDataFrame(rows, SCHEMA), num, 100, width, leaf=leaf, task=task).collect()}
    assert got == brute_jaccard(rows, num, 100, width)


@pytest.mark.parametrize("num,leaf", [(90, 4), (80, 2), (50, 4)])
def test_voronoi_regions_link_what_pairs_link(num, leaf):
    """Within a task: the same groups as all pairs, with labels for granted, and fewer comparisons where regions part."""
    splits = 0
    for seed in range(30):
        rng = np.random.default_rng(seed)
        centres = [rng.choice(5000, 60, replace=False) for _ in range(rng.integers(1, 6))]
        sets = []
        for _ in range(rng.integers(2, 90)):
            x = centres[rng.integers(len(centres))].copy()
            k = rng.integers(0, 20)
            x[rng.choice(60, k, replace=False)] = rng.choice(5000, k)
            sets.append(np.unique(x).astype(np.uint64))
        ids = list(range(len(sets)))
        near = jaccard_join.Near(ids, sets, [None] * len(sets), num, 100)
        near.join(leaf=leaf)
        pairs = [(a, b) for a in ids for b in ids[:a] if 100 * len(np.intersect1d(sets[a], sets[b])) >= num * len(np.union1d(sets[a], sets[b]))]
        want, got = brute_components(pairs), brute_components(near.links)
        assert {i: want.get(i, i) for i in ids} == {i: got.get(i, i) for i in ids}
        assert all(p in pairs or p[::-1] in pairs for p in near.links)
        splits += near.splits
    assert splits > 20


def test_voronoi_regions_are_entered_on_the_corpus(spark):
    """Cells of real documents go through splits, and those compare less than all pairs."""
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    sets = [jaccard_join.shingle_sets(pa.array([r.text]), 3)[0] for r in d]
    by_first = collections.defaultdict(list)
    for k, x in enumerate(sets):
        for s in x.tolist()[: len(x) - 9 * len(x) // 10 + 1]:
            by_first[s].append(k)
    cells = [v for v in by_first.values() if len(v) > jaccard_join.LEAF]
    splits = 0
    for v in cells[:50]:
        near = jaccard_join.Near(v, [sets[k] for k in v], [None] * len(v), 90, 100)
        near.join()
        splits += near.splits
    assert cells and splits > 0


def test_a_region_that_pivots_cannot_split_is_translated(spark, monkeypatch):
    """A family of near copies, all within each other's windows, with copies of copies; no blocks of pairs."""
    calls = []
    real = jaccard_join._translated
    monkeypatch.setattr(jaccard_join, "_translated", lambda *a: calls.append(1) or real(*a))
    rng = random.Random(4)
    words = [f"w{k}" for k in range(120)]
    families = [words]
    for _ in range(4):
        w = list(words)
        for _ in range(5):
            w[rng.randrange(120)] = f"f{rng.randrange(10**6)}"
        families.append(w)
    rows = []
    for i in range(160):
        w = list(rng.choice(families))
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(120)] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    for num in (90, 80):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_join(spark.createDataFrame(rows, SCHEMA), num, 100, 3, leaf=2, task=10).collect()}
        assert got == brute_jaccard(rows, num, 100, 3)
    assert calls


def test_sets_of_a_region_that_pivots_cannot_split_are_written_few_times(spark, monkeypatch):
    """Loose copies of one text, few of them near its middle, compared in tiles of small blocks."""
    sets = []
    real = jaccard_join.written

    def counted(df, name):
        out = real(df, name)
        if {"set", "diff"} & set(out.columns):
            sets.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "written", counted)
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 40, raising=False)
    rng = random.Random(7)
    words = [f"w{k}" for k in range(200)]
    rows = []
    for i in range(240):
        w = list(words)
        for _ in range(rng.randint(2, 9)):
            w[rng.randrange(200)] = f"e{rng.randrange(60)}"
        rows.append((i, " ".join(w)))
    n = len({t for _, t in rows})
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_join(spark.createDataFrame(rows, SCHEMA), 90, 100, 3, task=30).collect()}
    assert got == brute_jaccard(rows, 90, 100, 3)
    assert sum(sets) <= 4 * n


def test_jaccard_edges(spark):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_join(edge(spark), 90, 100, 3).collect()), key=repr)
    assert (None, 5, None) in got and (6, 5, 5) in got and (1, 0, 1) in got and (10, 1, 10) in got and len(got) == len(EDGE)
    assert jaccard_join.jaccard_join(edge(spark, True)).count() == 0


# ---------------------------------------------------------------- personal data

def brute_spans(t):
    out = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 12 <= len(d) <= 19 and sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d[::-1])) % 10 == 0:
            out.append((m.start(), 2, m.end(), "card"))
    out += [(m.start(), 3, m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


def test_base_spans(spark):
    rng = random.Random(3)
    parts = ["a", "b", "@", ".", ".", "1", "2", "55", "0", " ", "-", "+", "(", "é", "😀", "_", "c.d", "4111 1111 1111 1111", "+1 (23) 456-7890", "1.2.3.4", "x@y.zz", "\x01", "%"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))) for i in range(1500)] + [(9000, "1" * 30000), (9001, "a" * 30000 + "@"), (9002, "a@" + "b." * 9000 + "c")]
    df = spark.createDataFrame(rows, SCHEMA).unionByName(docs(spark).select("doc_id", "text").withColumn("doc_id", F.col("doc_id") + 100000))
    got = pii.personal_data(df)
    texts = {r.doc_id: r.text for r in df.collect()}
    for r in got.collect():
        want = brute_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert ",".join(s for s in r.spans.split(",") if not s.startswith("term")) == want


def brute_terms(rows, support=3, disclosure=0.8):
    """Term spans by counting each entity and term over all rows."""
    word = regex.compile(r"[\p{L}\p{N}]+")
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    df, state, found = collections.Counter(), {}, []
    for i, t in rows:
        t = t or ""
        df.update(set(word.findall(low(t))))
        spans = [(k, t[int(a) : int(b)]) for k, a, b in (x.split(":") for x in brute_spans(t).split(",") if x)]
        if not spans:
            continue
        own = {w for _, v in spans for w in word.findall(low(v))}
        names = set()
        for k, v in spans:
            d = re.sub("[^0-9]", "", v)
            part = {"email": v.rpartition("@")[2].lower(), "ip": ".".join(v.split(".")[:2]), "card": d[:6], "phone": d[:4]}[k]
            names |= {k, f"{k} of {part}", f"{k}:{v}"}
        terms = set(word.findall(low(t))) - own
        state.setdefault(t, [0, names, terms])[0] += 1
        found.append((i, t, names, terms))
    df_e, both, texts, seen = collections.Counter(), collections.Counter(), collections.Counter(), collections.Counter()
    for n, names, terms in state.values():
        for e in names:
            df_e[e] += n
            seen[e] += 1
            for w in terms:
                both[e, w] += n
                texts[e, w] += 1
    share = {k: math.log2(v * len(rows) / (df[k[1]] * df_e[k[0]])) / math.log2(len(rows) / df_e[k[0]]) for k, v in both.items() if texts[k] >= support and seen[k[0]] >= support and df_e[k[0]] < len(rows)}
    out = {}
    for i, t, names, terms in found:
        spans = set()
        for w in terms:
            if any(share.get((e, w), 0) >= disclosure - 1e-12 for e in names):
                spans |= {(m.start(), m.end()) for m in regex.finditer(rf"(?<![\p{{L}}\p{{N}}]){regex.escape(w)}(?![\p{{L}}\p{{N}}])", low(t))}
        out[i] = spans
    return out


def test_disclosing_terms_are_those_of_a_count(spark):
    """PMI by brute force over the whole small corpus; the corpus has such terms."""
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute_terms([(r.doc_id, r.text) for r in d.collect()])
    rows = pii.personal_data(d).collect()
    got = {r.doc_id: {tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s.startswith("term")} for r in rows}
    assert {i: x for i, x in got.items() if x} == {i: x for i, x in want.items() if x}
    assert sum(r.n_term for r in rows) == sum(map(len, want.values())) > 0


def test_disclosing_terms(spark):
    rows = [(i, f"the wizardo code{i} writes to joe@mail.example.com now") for i in range(4)] + [(10 + i, f"the weather of day{i} is fine") for i in range(40)]
    got = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(rows, SCHEMA)).collect()}
    words = {rows[0][1][int(a) : int(b)] for k, a, b in (s.split(":") for s in got[0].spans.split(",")) if k == "term"}
    assert "wizardo" in words and "the" not in words and "code0" not in words
    assert "joe@" not in got[0].clean_text and "wizardo" not in got[0].clean_text and got[10].clean_text == rows[4][1]
    assert got[0].clean_text == "the  code0   [EMAIL] "


def test_a_class_of_values_is_an_entity(spark):
    rows = [(i, f"badge{i} of the greenhouse is staff{i}@plant.example.org") for i in range(5)] + [(10 + i, f"the weather of day{i}") for i in range(60)] + [(100, "the greenhouse is warm"), (101, "a greenhouse")]
    got = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(rows, SCHEMA), disclosure=0.6).collect()}
    assert got[2].clean_text == "badge2 of the [TERM] [TERM] [EMAIL]" and got[100].clean_text == "the greenhouse is warm" and got[100].n_term == 0


def test_texts_with_ten_thousands_of_matches(spark):
    many = " ".join(f"+1 (555) {k:07d}" for k in range(30000))
    r = pii.personal_data(spark.createDataFrame([(1, many), (2, "no")], SCHEMA)).where("doc_id = 1").first()
    assert r.n_phone == 30000 and r.base_sha256 == hashlib.sha256(brute_spans(many).encode()).hexdigest() and r.clean_text == " ".join(["[PHONE]"] * 30000)
    notice = "MIT License. " * 20000
    assert licenses.scan(spark.createDataFrame([(1, notice)], SCHEMA)).first().n_base == 20000


def test_running_sums_and_maxima(spark):
    rng = random.Random(6)
    rows = [(k, [rng.randint(0, 9) for _ in range(n)]) for k, n in enumerate([0, 1, 2, 127, 128, 129, 1000])]
    df = spark.createDataFrame(rows, "id int, v array<int>")
    got = {r.id: (r.s, r.m) for r in df.select("id", common.running(F.col("v"), lambda a, x: a + x).alias("s"), common.running(F.col("v"), F.greatest).alias("m")).collect()}
    assert got == {k: ([sum(v[:i]) for i in range(len(v) + 1)], [max(v[:i], default=0) for i in range(len(v) + 1)]) for k, v in rows}


def test_pii_edges(spark):
    assert pii.personal_data(edge(spark)).count() == len(EDGE)
    assert pii.personal_data(edge(spark, True)).count() == 0


# ---------------------------------------------------------------- decontamination

def test_decontamination(spark):
    items = [(1, "In the town Anna Berg sold 12 apples and 7 pears for 12 dollars each and then Anna walked 5 km home to sleep"), (2, "short one"), (3, None), (None, "x y")]
    rows = [(1, "Foo bar. In the town Olga Stern sold 99 apples and 3 pears for 99 dollars each and then Olga walked 8 miles home to sleep. Ok"),
            (2, "In the town Olga Stern sold 99 apples and 3 pears for 98 dollars each and then Dora walked 8 km home to sleep"), (3, "a short one here"), (4, None), (5, ""), (None, "short one"), (6, items[0][1]), (6, items[0][1])]
    got = {(r.doc_id, r.item_id, r.kind) for r in decontam.contaminated(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id int, text string")).collect()}
    assert got == {(1, 1, "reparameterised"), (3, 2, "verbatim"), (6, 1, "verbatim")}


def test_decontamination_finds_every_passage(spark):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    d = docs(spark)
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(d, bench).collect()}
    want = {(r.doc_id, r.item_id) for r in d.join(bench.withColumnRenamed("text", "b"), F.contains("text", F.col("b"))).collect()}
    assert want and want <= got and len(got - want) <= 3
    assert decontam.contaminated(edge(spark), bench).count() == 0
    assert decontam.contaminated(edge(spark, True), bench).count() == 0
    assert decontam.contaminated(d, bench.limit(0)).count() == 0


def test_decontamination_exchanges_names_that_begin_sentences(spark):
    items = [
        (1, "Alice has 3 apples and gives some to Bob. Alice then buys 7 more apples at the shop. How many apples does Alice have?"),
        (2, "\"Wanda\" (Boris) drove off in the rain.\nWanda came home.\nBoris slept until noon that day. Wanda did not. Boris ate cold soup."),
        (3, "Rosa had 5 red hats and gave one to Tom. Vera had 6 red hats and gave one to Max. Rosa and Vera went home."), (4, "Short one"), (5, "Hello"),
    ]
    rows = [
        (1, "Carol has 4 apples and gives some to Dan. Carol then buys 9 more apples at the shop. How many apples does Carol have?"),
        (2, "so: \"Clara\" (Peter) drove off in the rain.\nClara came home.\nPeter slept until noon that day. Clara did not. Peter ate cold soup."),
        (3, "Once more. Lena had 8 red hats and gave one to Jan. Ida had 2 red hats and gave one to Kai. Lena and Ida went home."),
        (4, "Carol has 4 apples and gives some to Dan. Emil then buys 9 more apples at the shop. How many apples does Fred have?"),
        (5, "we know alice has 3 apples and gives some to Bob. alice then buys 7 more apples at the shop. how many apples does Alice have?"),
        (6, "Only one. This one. World"),
    ]
    found = decontam.contaminated(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id int, text string")).collect()
    got = {(r.doc_id, r.item_id, r.kind) for r in found}
    assert got == {(1, 1, "reparameterised"), (2, 2, "reparameterised"), (3, 3, "reparameterised"), (5, 1, "verbatim")}
    assert all(r.n_matched == r.n_windows for r in found if r.doc_id in (1, 3))


def test_decontamination_needs_words_to_exchange_values(spark):
    items = [(1, "42"), (2, "It was 1984"), (3, "the small red box weighs 5 kg")]
    rows = [(i, f"there are {i} of them") for i in range(50)] + [(100, "it was 1985 then"), (101, "it was 1984 then"), (102, "the small red box weighs 7 kg")]
    got = {(r.doc_id, r.item_id, r.kind) for r in decontam.contaminated(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id int, text string")).collect()}
    assert got == {(42, 1, "verbatim"), (101, 2, "verbatim"), (102, 3, "reparameterised")}


def test_decontamination_judges_every_copy(spark):
    item = "the train leaves at 7 and the bus leaves at 7 so both of them leave at 7 and nobody waits for more than 7 minutes there"
    mixed = item.replace("7", "{}").format(1, 2, 3, 4)
    rows = [(1, f"{mixed} . next one {item}"), (2, f"{item} . next one {mixed}"), (3, mixed), (4, f"{mixed} . then {item.replace('7', '9')}")]
    got = {(r.doc_id, r.kind) for r in decontam.contaminated(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(1, item)], "item_id int, text string")).collect()}
    assert got == {(1, "verbatim"), (2, "verbatim"), (4, "reparameterised")}


# ---------------------------------------------------------------- tokens

def odd_texts():
    rng = random.Random(1)
    chars = "ab cd'sS'tTvrelLmd \t\n\r\x0b\x0c\x1c\x85\xa0 　​éßİΣςσ٣²½漢字😀👍🏽́éǅﬁ<|endoftext|>!?.,-_¿ªº µÀÿ0123"
    return ["".join(rng.choice(chars) for _ in range(rng.randint(0, 60))) for _ in range(800)] + ["<|endoftext|> hi <|endoftext|>", "a" * 5000, "", "It's we'll I'd DON'T"]


def test_bpe_is_the_library(spark):
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    own, lib = bpe.loaded(path), Tokenizer.from_file(path)
    for t in odd_texts() + [r.text for r in docs(spark).limit(60).collect()]:
        ids = lib.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == ids and own.decode(ids) == lib.decode(ids, skip_special_tokens=False)
    df = bpe.encode(edge(spark), path)
    back = bpe.decode(df, path)
    assert sorted((r.doc_id or 0, r.text) for r in back.collect()) == sorted((i or 0, t or "") for i, t in EDGE)
    assert bpe.encode_decode_digests(edge(spark, True), path).count() == 0


def test_token_store(spark, tmp_path):
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    d = docs(spark).select("doc_id", "text").unionByName(spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(odd_texts())], SCHEMA))
    shards = token_store.write_tokens(d, path, f"file://{tmp_path}/t", n_shards=5)
    got = sorted(map(tuple, token_store.read_tokens(shards).collect()))
    at, want = 0, []
    for r in d.orderBy("doc_id").collect():
        ids = np.array(lib.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((r.doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want
    first = shards.orderBy("shard").first().path
    reader = token_store.ShardReader(first)
    assert reader.read_id(want[0][0]).tolist() == lib.encode(d.where(F.col("doc_id") == want[0][0]).first().text, add_special_tokens=False).ids + [1]
    file = first.removeprefix("file://")
    raw = bytearray(open(file, "rb").read())
    raw[12] ^= 255
    open(file, "wb").write(raw)
    with pytest.raises(Exception, match="."):
        token_store.ShardReader(first).read(0)


def test_full_shards_are_followed_by_others(spark, tmp_path):
    """One id with most of the rows, in one range: files stay within their bounds, and all ids are read back in order."""
    path = vocabulary("word_bpe_49k.json")
    d = spark.range(300).select(F.when(F.col("id") < 200, 7).otherwise(F.col("id")).alias("doc_id"), F.repeat(F.lit("word "), (F.col("id") % 40).cast("int")).alias("text"))
    d = d.unionByName(spark.createDataFrame([(8, "long " * 5000), (None, None)], SCHEMA))
    whole = token_store.write_tokens(d, path, f"file://{tmp_path}/whole", n_shards=1)
    parts = token_store.write_tokens(d, path, f"file://{tmp_path}/parts", n_shards=1, shard_bytes=2000, shard_docs=50)
    rows = parts.orderBy("shard", "part").collect()
    assert whole.count() == 1 and len(rows) > 6 and len({r.path for r in rows}) == len(rows) and sum(r.n_docs for r in rows) == 302
    assert all(r.n_docs <= 50 and (r.n_ids <= 1000 or r.n_docs == 1) for r in rows)
    assert [r.start for r in rows] == [sum(x.n_ids for x in rows[:k]) for k in range(len(rows))]
    assert sorted(map(str, token_store.read_tokens(parts).collect())) == sorted(map(str, token_store.read_tokens(whole).collect()))


def test_shards_are_in_the_public_seekable_layout(spark, tmp_path):
    """Read by the format's own description alone: footer, table, frames; and by any decompressor from end to end."""
    import struct

    import xxhash
    import zstandard

    path = vocabulary("word_bpe_49k.json")
    shards = token_store.write_tokens(docs(spark).limit(20), path, f"file://{tmp_path}/s", n_shards=1)
    raw = open(shards.first().path.removeprefix("file://"), "rb").read()
    n, descriptor, magic = struct.unpack("<IBI", raw[-9:])
    assert magic == 0x8F92EAB1 and descriptor == 0x80
    table = [struct.unpack("<III", raw[len(raw) - 9 - 12 * (n - k) : len(raw) - 9 - 12 * (n - k - 1)]) for k in range(n)]
    assert struct.unpack("<II", raw[-9 - 12 * n - 8 : -9 - 12 * n]) == (0x184D2A5E, 12 * n + 9)
    assert sum(c for c, _, _ in table) == len(raw) - 9 - 12 * n - 8
    at, parts = 0, []
    for c, d, x in table[:-1]:
        part = zstandard.ZstdDecompressor().decompress(raw[at : at + c])
        assert len(part) == d and xxhash.xxh64_intdigest(part) & 0xFFFFFFFF == x
        parts.append(part)
        at += c
    assert zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read() == b"".join(parts)
    with pytest.raises(KeyError):
        token_store.ShardReader(shards.first().path).read_id(-5)


def test_vocabularies_that_ask_for_more_are_refused_or_encoded_whole(tmp_path):
    import json

    spec = json.load(open(vocabulary("byte_bpe_50k.json")))
    for change in ({"ignore_merges": True}, {"dropout": 0.1}):
        file = tmp_path / "v.json"
        file.write_text(json.dumps(spec | {"model": spec["model"] | change}))
        with pytest.raises(ValueError, match="isn't done here"):
            bpe.ByteBPE(str(file))
    file.write_text(json.dumps(spec | {"added_tokens": [t | {"lstrip": True} for t in spec["added_tokens"]]}))
    with pytest.raises(ValueError, match="lstrip"):
        bpe.ByteBPE(str(file))
    spec = json.load(open(vocabulary("word_bpe_49k.json")))
    assert token_store.WordEncoder(vocabulary("word_bpe_49k.json"), 2, 1).by_word
    for norm in (None, {"type": "NFC"}, {"type": "Sequence", "normalizers": [{"type": "Lowercase"}, {"type": "StripAccents"}, {"type": "NFKD"}]}):
        file.write_text(json.dumps(spec | {"normalizer": norm}))
        encoder = token_store.WordEncoder(str(file), 2, 1)
        assert not encoder.by_word
        assert encoder.encode("Ärger IT'S") == np.array(encoder.tok.encode("Ärger IT'S", add_special_tokens=False).ids + [1], "<u2").tobytes()


def test_token_store_edges(spark, tmp_path):
    path = vocabulary("word_bpe_49k.json")
    got = token_store.read_tokens(token_store.write_tokens(edge(spark), path, f"file://{tmp_path}/e")).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted([i for i, _ in EDGE], key=lambda i: (i is not None, i or 0)) and got[1].n_tokens == 1
    assert token_store.read_tokens(token_store.write_tokens(edge(spark, True), path, f"file://{tmp_path}/n")).count() == 0


# ---------------------------------------------------------------- suffixes

def test_suffix_array():
    rng = random.Random(1)
    for k in range(300):
        s = bytes(rng.choice(b"ab" if k % 2 else b"abc\x00\xff") for _ in range(rng.randint(0, 60))) * (1 + k % 3)
        assert suffix_array.suffix_array(s, memory=64 if k % 3 == 0 else 1 << 20).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def brute_repeats(rows, length):
    seen, out = set(), {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            x = b[p : p + length]
            if x in seen:
                gone[p : p + length] = True
            seen.add(x)
        runs = int((np.diff(np.r_[0, gone.astype(int), 0]) == 1).sum())
        out[i] = len(b), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()
    return out


@pytest.mark.parametrize("salts,large,hints", [(1, 1 << 20, 2000), (3, 1 << 20, 2000), (3, 60, 0), (2, 0, 2)])
def test_repeated_passages(spark, monkeypatch, salts, large, hints):
    """With many hot anchors, with none that are known before and every shard too large, and with both."""
    monkeypatch.setattr(suffix_dedup, "SALTS", salts)
    monkeypatch.setattr(suffix_dedup, "LARGE", large)
    monkeypatch.setattr(suffix_dedup, "HINTS", hints)
    monkeypatch.setattr(suffix_dedup, "BATCH", 1 << 21 if large else 40)
    rng = random.Random(salts)
    base = ["".join(rng.choice("abcdé ") for _ in range(60)) for _ in range(6)]
    rows = [(i, "".join(rng.choice(base)[rng.randint(0, 20) : rng.randint(21, 60)] for _ in range(rng.randint(0, 8)))) for i in range(200)] + [(1000, None), (1001, ""), (1002, "a" * 2000), (1003, "ab" * 900)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.repeated_passages(spark.createDataFrame(rows, SCHEMA), 20).collect()}
    assert got == brute_repeats(rows, 20)


def test_a_hot_phrase_in_ever_other_surroundings_parts(spark, monkeypatch):
    """An anchor in all documents with different bytes beside it: sorted in many small shards, with the right answer."""
    monkeypatch.setattr(suffix_dedup, "LARGE", 4000)
    monkeypatch.setattr(suffix_dedup, "HINTS", 0)
    most = []
    real = suffix_dedup._halves
    monkeypatch.setattr(suffix_dedup, "_halves", lambda r, n: most.append(real(r, n).groupBy("anchor").count().agg(F.max("count")).first()[0]) or real(r, n))
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice("abcdefgh") for _ in range(70)) + "the phrase that everybody has" + "".join(rng.choice("abcdefgh") for _ in range(70))) for i in range(300)]
    rows += [(400 + i, rows[i][1][30:140]) for i in range(20)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.repeated_passages(spark.createDataFrame(rows, SCHEMA), 40).collect()}
    assert got == brute_repeats(rows, 40) and most and max(most) < 40


def test_texts_that_share_an_id_keep_their_own_anchors(spark):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    common = [word(60) for _ in range(4)]
    rows = [(i % 30, word(rng.randint(0, 90)) + rng.choice(common) + word(rng.randint(0, 90)) + rng.choice(common)) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    rank = {tuple(r)[1:]: k for k, r in enumerate(df.select(F.xxhash64("text").alias("h"), "doc_id", "text").orderBy("doc_id", "h").collect())}
    want = brute_repeats([(rank[r], r[1]) for r in rows], 20)
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.repeated_passages(df, 20).collect())
    assert got == sorted((i, *want[k]) for (i, _), k in rank.items())


@pytest.mark.parametrize("starts", [1, 50, 1 << 20])
def test_a_shard_gives_arrays_of_runs(monkeypatch, starts):
    """Repeats of all stretches are looked up together, in parts of any size; places take 32 bits while a text allows it."""
    monkeypatch.setattr(suffix_dedup, "STARTS", starts, raising=False)
    rng = random.Random(starts)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(12, 20))) for _ in range(60)]
    rows = [(k % 3 == 0, 7 * k % 40, k % 2, 1000 * k, t, k % 4, None, None) for k, t in enumerate(texts)]
    doc, h, first, last, rest, _, _ = suffix_dedup._shard(rows, 12)
    own = {(r[1], r[2], r[3] + j): (r[5], r[4][j : j + 12]) for r in rows for j in range(len(r[4]) - 11)}
    least = {}
    for place in sorted(own):
        least.setdefault(own[place][1], place)
    gone = {(d, x, p) for d, x, a, z in zip(doc.tolist(), h.tolist(), first.tolist(), last.tolist(), strict=True) for p in range(a, z + 1)}
    assert gone == {place for place, (_, t) in own.items() if least[t] != place}
    some_left = {r[3] for r in rows if r[0] and any((r[1], r[2], r[3] + j) not in gone for j in range(len(r[4]) - 11))}
    assert {int(a) for a, t in zip(first, rest, strict=True) if t is not None} == some_left
    assert suffix_array.suffix_array(b"banana").dtype == np.int32


def test_repeated_passages_edges(spark):
    got = suffix_dedup.repeated_passages(edge(spark), 20)
    assert got.count() == len(EDGE) and got.where("doc_id = 9").first().n_removed == 4999
    assert suffix_dedup.repeated_passages(edge(spark, True)).count() == 0


# ---------------------------------------------------------------- conversations

def test_chat_round_trip(spark):
    texts = ["</s>[INST] ok [/INST]", "a | b \\ <|user|> <|end|>", "<<SYS>>x<</SYS>>", "", None, "\\I \\p \\s", "<", ">|"]
    nodes = [(1, k, k - 1 if k else None, "assistant" if k % 2 else "user", t, 0.0) for k, t in enumerate(texts)]
    talk = chat.conversations(spark.createDataFrame(nodes, "tree long, node long, parent long, role string, text string, score double"))
    r = talk.select(chat.read_back(F.col("formatted")).alias("t"), chat.loss_text(F.col("formatted"), F.col("loss")).alias("l")).first()
    assert [x.text for x in r.t] == [t or "" for t in texts] and r.l == "".join(t or "" for t in texts[1::2])


def test_chat_trees(spark):
    nodes = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "a", 0.2), (1, 3, 1, "assistant", "b", 0.9), (1, 4, 3, "user", "more", 0.1), (2, 1, 2, "user", "x", 1.0), (2, 2, 1, "user", "y", 1.0), (3, 1, 99, "user", "orphan", None), (None, 1, None, "user", "z", 1.0), (1, 1, None, "user", "q", 0.0)]
    df = spark.createDataFrame(nodes, "tree long, node long, parent long, role string, text string, score double")
    got = {(r.tree, r.leaf): r["rank"] for r in chat.conversations(df).collect()}
    assert got == {(1, 4): 1, (1, 2): 2, (3, 1): 1, (None, 1): 1}  # a null tree is one of its own
    assert [r.leaf for r in chat.conversations(df, top=1).where("tree = 1").collect()] == [4]
    chain = spark.range(300).select(F.lit(5).cast("long").alias("tree"), F.col("id").alias("node"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"), F.lit(0.0).alias("score"))
    assert chat.conversations(chain).first().n_turns == 300
    assert chat.conversations(df.limit(0)).count() == 0


def test_chat_edges(spark):
    """Nulls anywhere, ties, repeated rows, extra columns with the operators' own names, no row."""
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "assistant", "tie"), (1, None, None, None), (None, 0, "user", "lost"), (None, 1, "assistant", "and found"), (2, 5, "assistant", "x" * 20000), (3, 0, "", "")]
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame(rows, schema).select("*", *[F.lit(1).alias(c) for c in ("tree", "node", "parent", "leaf", "score", "pos", "n", "up", "back", "rank")])
    got = {r.conv_id: r for r in chat.digests(chat.conversations(chat.thread(df))).collect()}
    sha = lambda turns: hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert {i: r.n_turns for i, r in got.items()} == {1: 4, None: 2, 2: 1, 3: 1}
    assert got[1].turns_sha256 == sha([("", ""), ("assistant", "tie"), ("user", "a"), ("user", "a")]) and got[None].turns_sha256 == sha([("user", "lost"), ("assistant", "and found")])
    assert got[2].loss_chars == 20000 and got[3].loss_chars == 0 and got[1].loss_sha256 == hashlib.sha256(b"tie").hexdigest()
    assert chat.digests(chat.conversations(chat.thread(df.limit(0)))).count() == 0


def test_long_conversations(spark):
    chain = spark.range(3000).select(F.lit(5).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.col("id").cast("string").alias("text"))
    r = chat.digests(chat.conversations(chat.thread(chain))).first()
    assert r.n_turns == 3000 and r.loss_sha256 == hashlib.sha256("".join(str(k) for k in range(1, 3000, 2)).encode()).hexdigest()


# ---------------------------------------------------------------- licenses

def brute_license(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels, found = [], set(), []
    for phrase, label in licenses.PHRASES.items():
        q = phrase.split()
        for i in range(len(w) - len(q) + 1):
            if w[i : i + len(q)] == q:
                places.append(i)
                labels.add(label)
    for rule, _, _, pattern, label, priority, confidence, _ in licenses.rule_rows():
        found += [(m.start(), m.end(), priority, rule, label, confidence) for m in re.finditer(pattern, low)]
    before = lambda b, a: (b[0], -b[1], -b[2], b[3]) < (a[0], -a[1], -a[2], a[3])
    kept = [a for a in found if not any(b[0] <= a[0] and a[1] <= b[1] and b[2] >= a[2] and before(b, a) for b in found)]
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | {a[4] for a in kept})), max([0.8 if places else 0.0, *(a[5] for a in kept)]), len(kept)


def test_licenses(spark):
    rng = random.Random(3)
    parts = ["mit", "license", "License.", "Licensed under the", "Apache", "Version 2.0", "CC BY", "CC BY-SA 4.0", "GNU General Public", "é", "GPL v3", "SPDX-License-Identifier:", "MIT\n", "under the terms of", "BSD 3-clause", "Creative Commons Attribution", ",", "İ"]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 20)))) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).unionByName(docs(spark).select((F.col("doc_id") + 10000).alias("doc_id"), "text"))
    got = {r.doc_id: tuple(r)[1:] for r in licenses.scan(df).collect()}
    assert got == {r.doc_id: brute_license(r.text) for r in df.collect()}
    assert licenses.rules(spark).count() >= 300
    assert licenses.scan(edge(spark)).count() == len(EDGE) and licenses.scan(edge(spark, True)).count() == 0


def test_every_license_rule_is_tried(spark):
    notices = ["Released under the Apache 2.0 terms", "distributed under MIT", "Made available under CC0", "Mozilla Public 2.0", "the PSF license", "Python Software Foundation License", "licensed under zlib2.0", "X11 v1.1"]
    rng = random.Random(5)
    parts = [*notices, "released under the", "provided under", "python", "PSF", "Apache", "MIT", "CC0", "commit 1.2", "success", "Mozilla Public", "v2", "2.0", "-1.1", "boost 1.0", "OFL", "license: the", "governed by the", "licence", "Eclipse Public", "unlicense", ","]
    rows = list(enumerate(notices)) + [(100 + i, " ".join(rng.choice(parts) for _ in range(rng.randint(1, 9)))) for i in range(300)]
    want = collections.Counter()
    for i, text in rows:
        want.update((i, m.start(), m.end(), r[0], r[4], r[5]) for r in licenses.rule_rows() for m in re.finditer(r[3], text.lower()))
    df = spark.createDataFrame(rows, SCHEMA)
    got = collections.Counter((r.doc_id, r.start, r.end, r.rule, r.label, r.priority) for r in licenses.detections(df).collect())
    assert got == want and {i for i, *_ in want} >= set(range(len(notices)))
    scanned = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert [scanned[i].labels for i in range(5)] == ["apache", "mit", "cc0", "mpl", "python"] and all(scanned[i].score > 0 for i in range(len(notices)))
    assert licenses.rules(spark).count() == len(licenses.rule_rows()) > 400


def sample_match(pattern, rng):
    """A text that a signature's pattern matches, by its parse tree."""
    import re._constants as K
    import re._parser as P

    def walk(items):
        out = ""
        for op, arg in items:
            if op is K.LITERAL:
                out += chr(arg)
            elif op is K.ANY:
                out += "x"
            elif op is K.IN:
                first = arg[0]
                out += " " if first == (K.CATEGORY, K.CATEGORY_SPACE) else chr(first[1] if first[0] is K.LITERAL else first[1][0])
            elif op in (K.MAX_REPEAT, K.MIN_REPEAT):
                low, high, body = arg
                out += "".join(walk(body) for _ in range(low if rng.random() < 0.5 else min(max(low, 1), high)))
            elif op is K.SUBPATTERN:
                out += walk(arg[3])
            elif op is K.BRANCH:
                out += walk(rng.choice(arg[1]))
            elif op not in (K.ASSERT, K.ASSERT_NOT):
                raise AssertionError(op)
        return out

    return walk(P.parse(pattern))


def test_every_signature_is_tried_and_holds_its_keyword(spark):
    """Texts drawn from each signature's own pattern, commented and wrapped: the gate lets each of them through."""
    rng = random.Random(8)
    signatures = [r for r in licenses.rule_rows() if r[7] == "signature"]
    rows = []
    for r in signatures:
        for k in range(3):
            text = sample_match(r[3], rng)
            assert re.search(r[3], text) and r[1] in text and any(g in text for g in licenses.GATES), (r[4], text)
            rows.append((r[0] * 10 + k, "Header.\n * " + (text if k else text.upper().replace(" ", "\n * ")) + " end"))
    got = {(r.doc_id, r.rule) for r in licenses.detections(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {(i, i // 10) for i, _ in rows} <= got and len(signatures) > 140


def test_license_texts_and_what_is_none(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining\n * a copy of this software and associated documentation files (the\n * \"Software\"), to deal in the Software without restriction"
    gpl = "you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version."
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met: Neither the name of Foo Inc. nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    none = ["He was granted permission to use the hall free of charge.", "We commit license plates to memory", "a boost in sales, version 1.0 of the plan", "the regents met; the university of california won", "permits: general public welcome", "an eclipse in public", "mitlicense", "redistribution of wealth is permitted", "The artistic director", "confidential talks about software", "submit 2.0", "success 1.1 and cc by the way"]
    rows = [(1, mit), (2, gpl), (3, bsd), *((10 + k, t) for k, t in enumerate(none))]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1].labels == "mit" and got[1].score == 0.99
    assert set(got[2].labels.split(",")) >= {"gpl-3.0-or-later", "gpl"} and set(got[3].labels.split(",")) == {"bsd", "bsd-3-clause"}
    assert {t: got[10 + k].labels for k, t in enumerate(none) if got[10 + k].labels} == {"success 1.1 and cc by the way": "cc-by"}


# ---------------------------------------------------------------- quality

def test_quality_on_held_out_labels(spark):
    d, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.train(d, labels)
    got = quality.score(d, model).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) >= 0.95 * len(got)
    rows = quality.score(d.limit(20), model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)


def test_quality_edges(spark):
    labels = spark.createDataFrame([(4, 1), (None, 1), (5, None)], "doc_id long, quality int")
    model = quality.train(edge(spark), labels)
    got = quality.score(edge(spark), model)
    assert got.count() == len(EDGE) and got.where("score is null or score < 0 or score > 1").count() == 0
    assert quality.score(edge(spark, True), quality.train(edge(spark, True), labels)).count() == 0


def test_quality_counts_every_row_of_an_id_once(spark):
    """Sixty rows of one labelled id are sixty positives and sixty texts, whatever the joins; nothing is squared."""
    rows = [(1, f"good text number {k} with some words") for k in range(60)] + [(5, "BAD!! ### @@@ %%%")]
    d, labels = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(1, 1), (1, 1)], "doc_id long, quality int")
    seen = []
    real = quality._moments
    try:
        quality._moments = lambda r, m: seen.append(r.groupBy("kind").count().collect()) or real(r, m)
        quality.train(d, labels)
    finally:
        quality._moments = real
    assert not quality.train(d.limit(0), labels).weights.any()
    assert {(r.kind, r["count"]) for r in seen[0]} == {(0, sum(zlib.crc32(str(i).encode()) % 4 != 2 for i, _ in rows)), (1, 60)}


def test_quality_prior_needs_no_zeros(spark):
    """Zeros aren't read; the estimate is near the share of ones that they would have given (on 200 texts it's too high, as its errors say)."""
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    one, other = quality.train(d, labels), quality.train(d, labels.where("quality = 1"))
    assert one.prior == other.prior and np.allclose(one.weights, other.weights)
    seen = labels.where(~quality.held_out(F.col("doc_id"))).agg(F.avg(F.col("quality").cast("double"))).head()[0]
    assert abs(one.prior - seen) < 0.1


@pytest.mark.parametrize("prior", [0.2, 0.5, 0.9])
def test_quality_prior_of_a_known_mixture(prior):
    rng = np.random.default_rng(5)
    good, bad = rng.beta(8, 2, 40_000), rng.beta(2, 8, 40_000)
    counts = lambda x: np.histogram(x, quality.BINS, (0, 1))[0]
    n = int(40_000 * prior)
    got = quality.estimated_prior(counts(good[:5000]), counts(np.concatenate([good[5000 : 5000 + int(n * 0.8)], bad[: int((40_000 - n) * 0.8)]])))
    assert abs(got - prior) < 0.05
    assert quality.estimated_prior(counts(good[:1]), counts(bad[:1])) <= 0.99


def test_quality_moments_equal_sums_over_all_rows(spark):
    rng = np.random.default_rng(2)
    x, kind, half = rng.normal(size=(300, len(quality.FEATURES))), rng.integers(0, 2, 300), rng.integers(0, 2, 300)
    rows = spark.createDataFrame([(int(a), int(b), v.tolist()) for a, b, v in zip(kind, half, x, strict=True)], "kind int, half int, x array<double>").repartition(7)
    model = quality.Model(x.mean(0), x.std(0), rng.normal(size=2 * len(quality.FEATURES) + 1) / 9, 0.5)
    got = quality._moments(rows, model)
    assert set(got) == {(0, 0), (0, 1), (1, 0), (1, 1)}
    for (a, b), m in got.items():
        z = model.inputs(x[(kind == a) & (half == b)])
        assert m.n == len(z) and np.allclose(m.mean, z.mean(0)) and np.allclose(m.second, z.T @ z / len(z))
    both = got[0, 0] + got[0, 1]
    assert both.n == (kind == 0).sum() and np.allclose(both.mean, model.inputs(x[kind == 0]).mean(0))
    assert (quality._score_counts(rows, model).sum(1) == np.bincount(kind)).all()


def test_quality_negative_risk_is_held_at_zero():
    """With a prior that is too high the unclamped minimum has a negative part below zero; the fit goes up again."""
    rng = np.random.default_rng(1)
    moments = lambda x: quality.Moments(len(x), x.mean(0), x.T @ x / len(x))
    p = np.column_stack([rng.normal(1, 1, (400, 3)), np.ones(400)])
    u = np.vstack([p, np.column_stack([rng.normal(-1, 1, (100, 3)), np.ones(100)])])
    negative = lambda w, prior: ((1 + u @ w) ** 2).mean() / 4 - prior * ((1 + p @ w) ** 2).mean() / 4
    w = quality.fit(moments(p), moments(u), 0.8)
    assert negative(w, 0.8) >= 0 and ((p @ w > 0).mean() > 0.9) and ((u[400:] @ w < 0).mean() > 0.8)
    assert negative(quality.fit(moments(p), moments(u), 0.95), 0.95) >= negative(quality.fit(moments(p), moments(u), 0.95, steps=0), 0.95)


def test_late_repetition_is_seen():
    at = quality.FEATURES.index("compressible")
    words = [f"w{i}" for i in range(1000)]
    varied, late = quality.features(" ".join(words))[at], quality.features(" ".join(words[:200] + ["w0", "w1"] * 400))[at]
    assert varied == 1 and late == (200 + 4 * 2) / 1000 and quality.features("a b a b")[at] == 0.5


# ---------------------------------------------------------------- tables and the pipeline

def test_only_a_scope_is_released(spark):
    """Tables of another call that is still pending stay."""
    pending = exact_dedup.exact_dedup(docs(spark))
    paths = []
    with common.scope(paths):
        common.written(spark.range(3), "own")
    common.release(paths)
    assert not paths and pending.count() == docs(spark).count()


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Conf:
        @staticmethod
        def get(key, default=None):
            return default

    class Cluster:
        conf = Conf

        class sparkContext:
            master, applicationId = "yarn", "app"

    with pytest.raises(RuntimeError, match="checkpoint"):
        common.shared_dir(Cluster)


def test_arrow_batches_are_small_for_written_tables_alone(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    sizes = spark.range(5000).coalesce(1).mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in bs), "n long")
    assert common.written(sizes, "sizes").agg(F.max("n")).first()[0] <= common.BATCH_ROWS
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_pipeline_edges(spark, tmp_path):
    """Nulls in every column, repeated rows and ids, extra columns; and no row."""
    import corpus_pipeline as P

    text = "a good text of some words that says one thing or another and ends here."
    schema = "doc_id long, text string, lang string, source string, n_chars long, h int, component_id int"
    rows = [(1, text, "en", "s", 1, 1, 1), (1, text, "en", "s", 1, 1, 1), (1, text + " More.", "en", None, 1, 1, 1), (2, text, None, "s", None, 1, 1), (None, text, "en", "s", 1, 1, 1), (None, None, None, None, None, None, None), (7, "", "en", "s", 0, 1, 1), (8, None, "en", "s", 0, 1, 1)]
    for given in (rows, []):
        d = spark.createDataFrame(given, schema)
        for name, stage in P.STAGES[:-1]:
            before = d.count()
            out = stage(spark, d, SF)
            assert out.columns == d.columns
            path = f"{tmp_path}/{len(given)}-{name}"
            out.write.parquet(path)
            d = spark.read.parquet(path)
            assert d.count() <= before
        assert P.STAGES[-1][1](spark, d, SF).count() == d.count()


# ---------------------------------------------------------------- the stages

def test_pipeline(spark, tmp_path):
    import corpus_pipeline as P

    d = docs(spark)
    columns = d.columns
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    for name, stage in P.STAGES:
        before = d.collect()
        stage(spark, d, SF).write.parquet(f"{tmp_path}/{name}")
        d = spark.read.parquet(f"{tmp_path}/{name}")
        if name == "quality classifier":
            assert d.columns == columns and {r.doc_id for r in d.collect()} <= {r.doc_id for r in before}
        elif name == "exact dedup":
            first = {}
            for r in sorted(before, key=lambda r: r.doc_id):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text), r.doc_id)
            assert sorted(r.doc_id for r in d.collect()) == sorted(first.values())
        elif name == "n-gram jaccard join":
            want = {c for _, c in brute_jaccard([(r.doc_id, r.text) for r in before], 80, 100, 5).values()}
            assert {r.doc_id for r in d.collect()} == want
        elif name == "benchmark decontamination":
            leaks = {r.doc_id for r in before if any(b.text in r.text for b in bench)}
            left = {r.doc_id for r in d.collect()}
            assert not leaks & left and len(left) >= len(before) - len(leaks) - 3
        else:
            assert {r.doc_id for r in d.collect()} == {r.doc_id for r in before}
            assert {(r.doc_id, r.decoded_sha256) for r in d.collect()} == {(r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in before}
