"""Chunk packing and keyword search against plain folds, and at sizes that no fold over arrays would stand."""

import random

import pytest
from pyspark.sql import functions as F

from quillfold.functions import text as T
from quillfold.functions import vocab
from quillfold.operators import chunking

BLOCK = "doc_id long, pos int, page int, block_id string, text string, block_type string"


def pieces(text, limit):
    out, cur, n = [], [], 0
    for w in text.split():
        if cur and n + len(w) + 1 > limit:
            out, cur, n = [*out, " ".join(cur)], [], 0
        cur, n = [*cur, w], n + len(w) + 1
    return [*out, " ".join(cur)] if cur else out


def pack(blocks, limit, least, split):
    """Chunks (text, ids, page) of sorted blocks, by a plain fold."""
    out, cur, ids, page = [], "", [], None
    for b in blocks:
        text = b["text"].strip(" \t\n\x0b\f\r")
        if b["block_type"] == "DISCLAIMER" or not text:
            continue
        if split and len(text) > limit:
            if len(cur) >= least:
                out.append((cur, ids, page))
                cur, ids, page = "", [], None
            out += [(p, [b["block_id"]], b["page"]) for p in pieces(text, limit)]
            continue
        if cur and len(cur) + len(text) > limit:
            if len(cur) >= least:
                out.append((cur, ids, page))
            cur, ids, page = "", [], None
        page = b["page"] if page is None else page
        cur, ids = (cur + "\n\n" + text if cur else text), [*ids, b["block_id"]]
    return [*out, (cur, ids, page)] if len(cur) >= least else out


def chunked(blocks, limit, least):
    parts = []
    for b in blocks:
        if b["block_type"] == "HEADING" or not parts:
            parts.append([])
        parts[-1].append(b)
    own = [(*c, part[0]["text"] if part[0]["block_type"] == "HEADING" else None) for part in parts for c in pack(part, limit, least, True)]
    return own or [(*c, None) for c in pack(blocks, limit, least, False)]


def random_blocks(rng, doc, n, long):
    kinds = ["PARAGRAPH"] * 8 + ["HEADING", "DISCLAIMER", "BULLET"]
    word = lambda: "".join(rng.choices("aé漢😀b", k=rng.choice([1, 2, 5, 9, rng.randint(1, long)])))
    return [dict(doc_id=doc, pos=k, page=k // 5 + 1, block_id=f"{k}", text=rng.choice(["", " \t", "  "]) + rng.choice([" ", "  ", "\n"]).join(word() for _ in range(rng.randint(0, 6))) + rng.choice(["", " ", "\r"]), block_type=rng.choice(kinds)) for k in range(n)]


@pytest.mark.parametrize("limit,least,long", [(40, 20, 12), (40, 20, 60), (12, 11, 20), (100, 1, 30), (5, 5, 9)])
def test_chunks_equal_a_fold(spark, limit, least, long):
    rng = random.Random(limit * least + long)
    docs = [random_blocks(rng, d, rng.choice([1, 2, 7, 40, 90]), long) for d in range(60)]
    df = spark.createDataFrame([tuple(b.values()) for d in docs for b in d], BLOCK).repartition(3)
    got, whole = {}, {}
    for r in chunking.chunks(df, limit, least).orderBy("doc_id", "chunk_index").collect():
        assert r.chunk_id == f"{r.doc_id}_{len(got.setdefault(r.doc_id, []))}"
        got[r.doc_id].append((r.text, r.block_ids, r.page, r.section))
    for r in chunking.packed(df, limit, least, by_section=False).orderBy("doc_id", "place", "k").collect():
        whole.setdefault(r.doc_id, []).append((r.text, r.block_ids, r.page))
    for d, blocks in enumerate(docs):
        assert got.get(d, []) == chunked(blocks, limit, least)
        assert whole.get(d, []) == pack(blocks, limit, least, False)


def test_a_section_of_a_million_blocks(spark):
    """One section of one document; chunks are counted against a fold over the lengths."""
    n = 1_000_000
    size = lambda k: (k * 7919) % 83 + 1
    rows = spark.range(n).select(
        F.lit(1).cast("long").alias("doc_id"), F.col("id").cast("int").alias("pos"), F.floor(F.col("id") / 5).cast("int").alias("page"), F.col("id").cast("string").alias("block_id"),
        F.expr("repeat('x', int(id * 7919 % 83 + 1))").alias("text"), F.lit("PARAGRAPH").alias("block_type"))
    want, cur, first = [], 0, 0
    for k in range(n):
        if cur and cur + size(k) > 1600:
            want.append((first, k - 1, cur))
            cur = 0
        first, cur = (first, cur + 2 + size(k)) if cur else (k, size(k))
    want += [(first, n - 1, cur)] if cur >= 800 else []
    got = chunking.chunks(rows).select("chunk_index", F.get("block_ids", F.lit(0)).cast("int"), F.element_at("block_ids", -1).cast("int"), F.length("text")).orderBy("chunk_index").collect()
    assert [tuple(r)[1:] for r in got] == want and len(want) > 20_000


def test_split_of_long_texts(spark):
    rng = random.Random(5)
    texts = ["", " ", "a", "x" * 99, "a " * 5000, " \n".join("w" * rng.randint(1, 30) for _ in range(9000)), "é😀 " * 3000, "a b\u0085 c " * 50]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    for limit in (1, 2, 10, 1600):
        got = {r.k: r.p for r in df.select("k", chunking.split_large(F.col("t"), limit).alias("p")).collect()}
        assert [got[k] for k in range(7)] == [pieces(t, limit) for t in texts[:7]]
        assert "".join(got[7]) == texts[7].replace(" ", "") or limit > 2


def test_keywords_by_automaton_and_one_by_one(spark, monkeypatch):
    words = [*vocab.keywords(), "the", "weight", "overweigh", "s&p", "ow", "😀b", "it"]
    rng = random.Random(1)
    parts = [*words, "x", "é", "_", "9", " ", "-", "n", "OVERWEIGHT", "İ"]
    texts = ["", None, "it", "item it.", "n_n n9 n", *("".join(rng.choices(parts, k=rng.randint(1, 40))) for _ in range(300)), *(" ".join(rng.choices(parts, k=30)) for _ in range(100))]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").repartition(4)
    fast = {r.k: r.h for r in df.select("k", T.hits(F.col("t"), words).alias("h")).collect()}
    monkeypatch.setattr(T, "FEW_KEYWORDS", 10_000)
    slow = {r.k: r.h for r in df.select("k", T.hits(F.col("t"), words).alias("h")).collect()}
    assert fast == slow and fast[1] == [] and fast[2] == ["it"] and "n" in fast[4]


def test_strip_takes_ascii_white_space(spark):
    df = spark.createDataFrame([(" \t\n\x0b\f\r a b \r\n",), (" a ",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(T.strip(F.col("t"))).collect()] == ["a b", " a ", "", None]
