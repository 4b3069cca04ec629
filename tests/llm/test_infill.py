"""Fill-in-middle: cuts through checkpoints against plain slicing, restoring, and edge rows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quillfold.llm import infill

SF = "/root/testdata/sf0.001"
TEXTS = ["", "a", "é", "漢字 😀 mixed ascii", "  two\n\nlines \r\n here ", "\n\n\n", "x" * 4096, "😀" * 3000, "word " * 2500 + "é", "ab\ncd" * 999]


def units(text, unit):
    """The units of a text, by plain Python."""
    starts = [k for k in range(len(text)) if k == 0 or unit == "code_point" or (text[k - 1] == "\n" if unit == "line" else text[k - 1] in " \t\n\x0b\x0c\r" and text[k] not in " \t\n\x0b\x0c\r")]
    return starts


@pytest.mark.parametrize("unit", ["code_point", "word", "line"])
@pytest.mark.parametrize("step,block", [(1, 7), (3, 64), (1024, 1 << 20)])
def test_checkpoints(unit, step, block):
    rng = random.Random(step)
    for text in [*TEXTS, *("".join(rng.choices("ab \né😀\t", k=rng.randint(1, 300))) for _ in range(30))]:
        raw, starts = text.encode(), units(text, unit)
        index = infill.Checkpoints(raw, unit, step, block)
        assert (index.n, index.n_points) == (len(starts), len(text))
        assert len(index.bytes) == -(-len(starts) // step)
        for k in {0, 1, len(starts), len(starts) - 1, *rng.sample(range(len(starts) + 1), min(20, len(starts) + 1))} - {-1}:
            point = starts[k] if k < len(starts) else len(text)
            assert index.cut(k) == (len(text[:point].encode()), point)


def brute(i, t, rate=90, spm=20):
    h = [int(hashlib.sha256(f"1:{i}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(t)
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, t
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = t[:a], t[a:b], t[b:]
    return (n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < spm else (n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_infill_equals_plain_slicing(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    hard = [(5000 + k, t) for k, t in enumerate(TEXTS * 5)] + [(7000 + k, t) for k, t in enumerate(["<P>", "a<M", "<<S>>", "x<", "<<<", "<P <S <M", ">P<"] * 9)]
    rows = base.unionByName(spark.createDataFrame(hard, "doc_id long, text string"))
    got = infill.infilled(rows, keep=["text"]).withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    assert len(got) == rows.count()
    for r in got:
        assert tuple(r)[1:6] == brute(r.doc_id, r.text)
        assert r.back == r.text
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    forms = [r.form for r in got if r.text and "<P>" not in r.text]
    assert 0.8 < 1 - forms.count("plain") / len(forms) < 0.98


def test_infill_edges(spark):
    rows = [(1, None), (2, ""), (3, "same"), (3, "same"), (None, "no id"), (None, "no id"), (4, "long é " * 400_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(1).alias(c) for c in ("n", "form", "output", "_h", "_text", "prefix_chars")])
    for unit in infill.UNITS:
        got = infill.infilled(df, unit=unit, rate=100).withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
        by = {}
        for r in got:
            by.setdefault(r.doc_id, []).append(r)
        assert [r.form for r in by[1] + by[2]] == ["plain", "plain"] and by[1][0].output == ""
        assert by[3][0] == by[3][1] and by[None][0] == by[None][1]
        assert by[4][0].back == "long é " * 400_000 and by[4][0].form != "plain"
    assert infill.digests(infill.infilled(df.limit(0))).count() == 0
