"""Divergence of sources against brute force in Python's integers, and the SQL of the round's operators on the small tables."""

import collections
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quillfold.llm import common, divergence, queries

SF = "/root/testdata/sf0.001"


def brute(rows, least=3, top=200):
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    groups, df = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for lang, source, text in rows:
        words = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", low(text or ""))
        groups[lang or "", source or ""].update(words)
        df[lang or ""].update(set(words))
    out = []
    for lang in {k for k, _ in groups}:
        kept = [t for t, d in df[lang].items() if d >= least]
        own = {s: c for (k, s), c in groups.items() if k == lang}
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[x] for x in kept) + len(kept)) for t in kept}
        p = {s: share(c) for s, c in own.items()}
        q = share(sum(own.values(), collections.Counter()))
        f = lambda a, b: (a - b) ** 2 // b
        for s in own:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in own if o != s)
            terms = sorted((-f(p[s][t], q[t]), t.encode(), t) for t in kept if own[s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, part, item, -v, k) for part, xs in (("pair", pairs), ("term", terms)) for k, (v, _, item) in enumerate(xs, 1)]
    return sorted(out)


def corpus(rng, n, sources):
    words = [w for k in range(60) for w in (f"wort{chr(97 + k % 26)}{'x' * (k // 26)}", "É" * (k % 3 + 1) + "a")] + ["The", "the", "漢字", "x1y"]
    return [(rng.choice(["en", "de"]), f"s{rng.randrange(sources)}" if rng.random() < 0.7 else "s0", " ".join(rng.choices(words, k=rng.randint(0, 30)))) for _ in range(n)]


@pytest.mark.parametrize("chunk,block,held", [(4096, 16, 400_000), (7, 2, 50), (1, 1, 1)])
def test_audit(spark, monkeypatch, chunk, block, held):
    monkeypatch.setattr(divergence, "HELD", held)
    rows = corpus(random.Random(chunk), 400, 7) + [("en", "silent", "12 34"), ("en", "", None), ("only", "a", "one two"), ("only", "b", "three"), (None, None, "x"), (None, "z", "x"), (None, "z", "x x")]
    df = spark.createDataFrame(rows, "lang string, source string, text string").select("*", *[F.lit(1).alias(c) for c in ("n", "term", "chunk", "v", "s", "block", "item")])
    got = divergence.audit(df, chunk=chunk, block=block, top=20)
    assert sorted(map(tuple, got.collect())) == brute(rows, top=20)


def test_audit_of_a_table_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("lang", "source", "text").collect()]
    got = queries.op13_divergence(spark, SF)
    assert sorted(map(tuple, got.collect())) == brute(rows)
    assert divergence.audit(spark.read.parquet(f"{SF}/documents.parquet").limit(0)).count() == 0


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 5)
    text = "Alpha beta-gamma ÉÉÉÉÉÉÉÉ " * 5
    words = [w for p in divergence._pieces(text.encode()) for w in p]
    assert [w.decode() for w in words] == ["alpha", "beta", "gamma", "ÉÉÉÉÉÉÉÉ"] * 5


def test_shares_are_exact_for_large_counts():
    rng = random.Random(3)
    for _ in range(200):
        total = rng.randint(1, 9 * 10**15)
        n = rng.randint(0, total - 1)
        assert int(divergence._shares(np.array([n]), np.array([total]))[0]) == 1 + 10**9 * (n + 1) // total


def test_wide_rows_are_not_broadcast(spark, monkeypatch):
    rows = common.written(spark.range(20).select("id", F.repeat(F.lit("x"), 1000).alias("t")), "wide")
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(common.sized(rows))
    monkeypatch.setattr(common, "BROADCAST_BYTES", 10_000)
    assert not hinted(common.sized(rows))


@pytest.mark.parametrize("name", ["op11_warc_zip", "op12_infill", "op13_divergence"])
def test_sql_says_the_same(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, SF)
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert sorted(map(str, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(str, want.select(*columns).fetchall()))
