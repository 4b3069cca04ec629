"""Worked values and edge cases of the document operators."""

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from quillfold.errors import ERRORS, ExtractionError, LLMError, PipelineError, StorageError, WeakEvidenceError
from quillfold.functions import text as T
from quillfold.functions import vocab
from quillfold.operators import calls as C
from quillfold.operators import chunking, confidence, documents, exports, providers, retrieval, triage
from quillfold.sources import store
from quillfold.streaming import ingest


def one(spark, column, **values):
    row = spark.createDataFrame([Row(**values)]) if values else spark.range(1)
    return row.select(column.alias("x")).first().x


def test_vocabulary_sizes():
    assert len(vocab.POSITIONING) == 50 and len(vocab.TAXONOMY) == 29 and len(vocab.taxonomy_rows()) == 92
    assert len(vocab.THEMES) == 25 and len(vocab.RISKS) == len(vocab.REGIONS) == len(vocab.REGIMES) == 10
    assert len(vocab.synonym_rows()) == 236 and len(vocab.keywords()) == 284
    assert {s for _, s in vocab.synonym_rows()} <= {s for _, s in vocab.taxonomy_rows()}


@pytest.mark.parametrize("score,band", [(0.8, "HIGH"), (0.79, "MEDIUM"), (0.6, "MEDIUM"), (0.59, "LOW")])
def test_band(spark, score, band):
    assert one(spark, T.band(F.lit(score))) == band


def test_document_score(spark):
    assert round(one(spark, confidence.document_score(F.lit(0.86), F.lit(1.0), F.lit(0.7367), F.lit(0.7111))), 4) == 0.7896
    assert round(one(spark, confidence.document_score(F.lit(1.0), F.lit(1.0), F.lit(None).cast("double"), F.lit(1.0))), 4) == 0.75


def test_ocr(spark):
    df = spark.createDataFrame([("AA\x00\x01",), (None,), ("  ",)], "ocr_text string")
    assert [round(r.ocr, 6) for r in confidence.ocr_quality(df).collect()] == [0.6, 1.0, 0.0]


def scores(spark, n, headers=(), unique=None):
    rows = [(1, p, n, 0, (unique or {}).get(p, 0), ["h"] if p in headers else [], 0, 0, False, 0.0, float(p)) for p in range(1, n + 1)]
    return spark.createDataFrame(rows, "doc_id int, page int, n_pages int, keyword_total long, keyword_unique int, header_hits array<string>, bullets int, cells int, penalty boolean, prior double, score double")


def test_triage_guardrails_over_the_cap(spark):
    got = triage.select_pages(scores(spark, 20, headers=range(1, 21)), max_pages=10, first_pages=5, window=0)
    assert sorted(r.page for r in got.collect()) == [1, 2, 3, 4, 5, 16, 17, 18, 19, 20]


def test_triage_large_document(spark):
    flat = scores(spark, 50).withColumn("score", F.lit(1.0))
    pages = sorted(r.page for r in triage.select_pages(flat).collect())
    assert len(pages) == 40 and pages[:5] == [1, 2, 3, 4, 5] and 50 not in pages


def test_merge_of_duplicates(spark):
    rows = [(1, 0, "EQ_DM", "EQ_US", "OVERWEIGHT", None, 0.9, ["a"], None), (1, 1, "EQ_DM", "EQ_US", "NEUTRAL", "HIGH", 0.85, ["b"], "why")]
    df = spark.createDataFrame(rows, "doc_id int, pos int, cat string, sub string, call string, conviction string, confidence double, cites array<string>, review_reason string")
    r = C.merged_calls(df, ["doc_id", "cat", "sub"], ["pos"], ["conviction"], {"cites": 3}, ["call"]).collect()
    assert len(r) == 1 and r[0].call == "OVERWEIGHT" and r[0].conviction == "HIGH" and r[0].cites == ["a", "b"] and r[0].merged
    assert r[0].review_reason == "why; " + C.MERGED


def pack(blocks):
    """The chunker, as a plain loop over (section, text, id, page)."""
    out, sections = [], sorted({b[0] for b in blocks})
    for s in sections:
        cur, ids, page = "", [], None
        for _, text, i, p in (b for b in blocks if b[0] == s):
            t = text.strip()
            if not t:
                continue
            if len(t) > 1600:
                pieces, line, n = [], [], 0
                for w in t.split():
                    if line and n + len(w) + 1 > 1600:
                        pieces.append(" ".join(line))
                        line, n = [], 0
                    line.append(w)
                    n += len(w) + 1
                pieces += [" ".join(line)] if line else []
                if len(cur) >= 800:
                    out.append((cur, ids, page))
                    cur, ids, page = "", [], None
                out += [(x, [i], p) for x in pieces]
                continue
            if cur and len(cur) + len(t) > 1600:
                if len(cur) >= 800:
                    out.append((cur, ids, page))
                cur, ids, page = "", [], None
            page = page or p
            cur = cur + "\n\n" + t if cur else t
            ids = [*ids, i]
        if len(cur) >= 800:
            out.append((cur, ids, page))
    return out


def test_chunks_against_a_loop(spark):
    rng = random.Random(5)
    for _ in range(3):
        rows, plain, section = [], [], 0
        for k in range(60):
            size = rng.choice([0, 30, 200, 500, 900, 1700, 4000])
            text = " ".join("w" * rng.randint(1, 12) for _ in range(size // 6))
            kind = "HEADING" if rng.random() < 0.15 and k else "PARAGRAPH"
            section += kind == "HEADING"
            rows.append((7, k, k // 5 + 1, f"b{k}", text, kind))
            plain.append((section, text, f"b{k}", k // 5 + 1))
        df = spark.createDataFrame(rows, "doc_id int, pos int, page int, block_id string, text string, block_type string")
        got = [(r.text, r.block_ids, r.page) for r in chunking.chunks(df).orderBy("chunk_index").collect()]
        assert got == pack(plain)


def test_boilerplate_keeps_the_first_copy(spark):
    rows = [(1, 3 * (p - 1) + k, p, f"{p}_{k}", t, "PARAGRAPH") for p in range(1, 6) for k, t in enumerate(["head", f"body {p}", "foot" if p < 4 else f"end {p}"])]
    left = documents.drop_boilerplate(spark.createDataFrame(rows, "doc_id int, pos int, page int, block_id string, text string, block_type string"))
    assert sorted(r.block_id for r in left.collect() if r.text in ("head", "foot")) == ["1_0", "1_2"]


def test_guards(spark):
    source = "The share was 7.5% in March 2021."
    df = spark.createDataFrame([('{"a": "2021-03-01 2020-01-01 7.5% 8%"}', source)], "output string, source string")
    r = C.llm_faults(df).first()
    assert r.dates == ["2020-01-01"] and r.percents == ["8%"] and r.quotes == []


def test_embedding_and_retrieval(spark):
    df = spark.createDataFrame([(1, "g", "a b"), (2, "g", "a b"), (3, "g", "zz"), (4, "g", "")], "id int, g string, text string").withColumn("embedding", providers.hashed_embedding(F.col("text")))
    got = retrieval.top_vectors(df, df.where("id = 1").withColumnRenamed("id", "query_id"), 2, "g", "id").orderBy("rank").collect()
    assert [r.id for r in got] == [1, 2] and got[0].score == pytest.approx(1.0, abs=1e-6)


def test_answers_are_asked_once(spark, tmp_path):
    df = spark.createDataFrame([("p",), ("p",), ("q",)], "prompt string")
    path = str(tmp_path / "answers")
    assert providers.answers(df, lambda s: s.str.upper(), path).count() == 2
    assert providers.answers(df, lambda s: s.str.upper(), path).count() == 2


def test_store(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.pdf").write_bytes(b"one")
    (tmp_path / "in" / "b.pdf").write_bytes(b"one")
    (tmp_path / "in" / "c.json").write_text('{"document_id": "x"}')
    files = store.read_files(spark, str(tmp_path / "in"), glob="*.pdf")
    blobs = store.BlobStore(spark, str(tmp_path / "blobs"))
    kept = files.withColumn("name", F.lit("a"))
    blobs.store(kept, metadata=F.struct("name"))
    blobs.store(kept, metadata=F.struct("name"))
    ids = [r.blob_id for r in spark.read.parquet(str(tmp_path / "blobs")).collect()]
    assert len(ids) == 1 and blobs.exists(ids[0]) and blobs.retrieve(ids[0].upper()) == b"one" and blobs.metadata(ids[0]) == {"name": "a"}
    with pytest.raises(StorageError):
        blobs.retrieve("short")
    with pytest.raises(StorageError, match="empty"):
        blobs.store(spark.createDataFrame([(bytearray(b""),)], "content binary"))
    blobs.delete(ids[0])
    blobs.delete(ids[0])
    assert not blobs.exists(ids[0])
    with pytest.raises(StorageError, match="no blob"):
        blobs.metadata(ids[0])
    assert store.read_records(spark, str(tmp_path / "in" / "c.json"), "document_id string").first().document_id == "x"
    broken = store.parse_files(files, lambda b: 1 / 0, "pos int, text string")
    assert [r.error[:17] for r in broken.collect()] == ["ZeroDivisionError"] * 2


def test_streaming_ingest(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.sql("select 'h1' as file_hash, timestamp'2024-01-01 00:00:00' as ts union all select 'h1', timestamp'2024-01-01 01:00:00' union all select 'h2', timestamp'2024-01-01 02:00:00'").coalesce(1).write.parquet(src)
    q = ingest.new_documents(spark.readStream.schema("file_hash string, ts timestamp").parquet(src)).writeStream.format("memory").queryName("fresh").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("fresh").count() == 2


def test_settings():
    from quillfold.config import Settings

    assert Settings.read({"LOG_LEVEL": " debug "}).log_level == "DEBUG"
    for bad in ({"LOG_LEVEL": "LOUD"}, {"EMBEDDING_PROVIDER": "openai"}, {"REGISTRY_PATH": " "}):
        with pytest.raises(ValueError):
            Settings.read(bad)


def test_errors():
    assert issubclass(WeakEvidenceError, ExtractionError) and all(issubclass(e, PipelineError) for e in ERRORS.values()) and len(ERRORS) == 7
    assert LLMError("late", stage="s6_calls").stage == "s6_calls"


@pytest.mark.parametrize("mention,asset", [("Bunds", "GERMAN_BUNDS"), (" US Stocks ", "EQ_US"), ("canada", "CANADA_GOVT"), ("Office real estate", "RE_OFFICE"), ("polish government bonds", "POLISH_BONDS"),
                                           ("dollar", "USD"), ("Canadian dollar", "CAD"), ("eur hy", "HY_EUROPE"), ("large caps", "EQ_SIZE_LARGE"), ("unknown asset", None), ("", None)])
def test_mentions(spark, mention, asset):
    df = spark.createDataFrame([(mention,)], "mention string")
    assert C.resolved(df, C.synonyms(spark), C.taxonomy(spark)).first().sub_asset == asset


def test_displays(spark):
    got = spark.range(1).select(
        T.display_name(F.lit("EQ_DM"), True), T.display_name(F.lit("ODD_CODE")), T.display_name(F.lit(None).cast("string")), T.shown_percent(F.lit(0.785)), T.shown_percent(F.lit(None).cast("double")),
        T.dot(F.lit(None).cast("double")), T.badge(F.lit("x")), T.shown_date(F.lit(None).cast("date")), T.escaped_html(F.lit("<a href='x'>&\"")), T.has_value(F.lit(" not stated ")), T.shown_seconds(F.lit(1.005))).first()
    assert list(got)[:3] == ["Equities: Developed Markets", "Odd Code", "Not stated"] and got[3] in ("78%", "79%") and got[4] == "Not stated"
    assert list(got)[5:10] == ["confidence-dot--medium", "badge badge--neutral", "Not stated", "&lt;a href=&#x27;x&#x27;&gt;&amp;&quot;", False]


def test_parsed_documents(spark):
    """Cells come first on a page, blank blocks have no number, fonts type blocks, and a broken file is a row."""
    parts = {"a": [{"page": 1, "idx": k, "kind": "text", "text": t, "size": s, "flags": 0} for k, (t, s) in enumerate([(" Title ", 20.0), ("  ", 10.0), ("- point", 10.0), ("text", 10.0), ("more", 10.0)])]
             + [{"page": 1, "idx": 0, "kind": "cell", "text": "Asset", "table_index": 0, "row": 0, "col": 0}, {"page": 2, "idx": 0, "kind": "text", "text": "end", "size": 10.0}]}
    files = spark.createDataFrame([("a", bytearray(b"a")), ("b", bytearray(b"b"))], "path string, content binary")
    rows = store.parse_documents(files, lambda b: parts[b.decode()]).orderBy("path", "pos").collect()
    assert [(r.block_id, r.text, r.block_type) for r in rows if r.path == "a"] == [
        ("1_0_0_0", "Asset", "TABLE_CELL"), ("1_0", "Title", "HEADING"), ("1_1", "- point", "BULLET"), ("1_2", "text", "HEADING"), ("1_3", "more", "PARAGRAPH"), ("2_0", "end", "PARAGRAPH")]
    assert rows[-1].path == "b" and rows[-1].error.startswith("KeyError")


def test_guard_order(spark):
    """Citations come before codes, codes before markers; an answer without faults has none."""
    def answer(category="EQ_DM", sub="EQ_US", chunk="c", note=""):
        return '{"allocation_calls":[{"asset_class_category":"%s","sub_asset_class":"%s","citations":[{"chunk_id":"%s"}],"review_reason":"%s"}],"sentiment_citations":null}' % (category, sub, chunk, note)

    long = "q" * 60
    cases = [(answer(), None), (answer("NOPE", chunk="d", note="9%"), "Invalid citation chunk_id: d"), (answer("NOPE", "NOPE", note="9%"), "Invalid asset_class_category: NOPE"), (answer("EQ_EM", note="9%"), "Mismatched taxonomy: EQ_US belongs to EQ_DM, not EQ_EM"),
             (answer(note="9% 8% 2020-01-01"), "Potential hallucination detected: 2020-01-01, 8%, 9%"), (answer(note='said \\"' + long + '\\" so'), 'Potential hallucination detected: \\"' + long + '\\"'), ("{}", None)]
    df = spark.createDataFrame([(k, a, a, ["c"], "source") for k, (a, _) in enumerate(cases)], "k int, answer string, output string, allowed array<string>, source string")
    got = {r.k: r.fault for r in C.guarded(C.parsed(df)).collect()}
    assert got == {k: f for k, (_, f) in enumerate(cases)}


def test_report_pack(spark):
    call = ("EQ_DM", "EQ_US", "OVERWEIGHT", 0.9, ["a < b"], "Tip")
    rows = [(k, "Same & Title", "M", 0.85, "HIGH", "line one\nline two", [call], [(1, "x ... y"), (2, "")]) for k in range(2)]
    schema = "doc_id int, title string, manager_name string, score double, band string, executive_summary string, calls array<struct<asset_class_category:string,sub_asset_class:string,call:string,confidence:double,rationale_bullets:array<string>,tooltip_text:string>>, citations array<struct<page:int,excerpt:string>>"
    df = spark.createDataFrame(rows, schema).withColumn("publication_date", F.to_date(F.lit("2025-07-15")))
    got = {r.name: r.html for r in exports.report_pack(df).collect()}
    assert sorted(got) == ["index.html", "same-title-2.html", "same-title.html"]
    page = got["same-title.html"]
    assert "<h1>Same &amp; Title</h1>" in page and "<li>a &lt; b</li>" in page and "line one<br>line two" in page and "Jul 15, 2025" in page and "US Equities" in page and "90%" in page
    assert '<div class="citation-text">x ... y</div>' in page and '<span class="citation-meta">p.2</span>' in page and got["index.html"].count("<li>") == 2
    assert [r.name for r in exports.report_pack(df.limit(1)).collect()] == ["same-title.html"]
