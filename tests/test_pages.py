"""Data sources of pages and report files; ranks and index pages at sizes beyond one window."""

import os

import pytest
from pyspark.sql import functions as F

from quillfold.operators import exports, ranks
from quillfold.sources import pages


def test_pages_are_read_by_partitions_and_filters(spark, tmp_path):
    def parse(content, wanted):
        """A page for each line; a file that says so is broken."""
        for n, line in enumerate(content.decode().split("\n"), 1):
            if line == "broken":
                raise ValueError("bad line")
            if n in wanted:
                yield {"page": n, "idx": 0, "kind": "text", "text": line}

    def parse_few(content, wanted):
        assert wanted.last == 2 and wanted.only is None  # filters came here
        return parse(content, wanted)

    for k in range(20):
        (tmp_path / f"f{k:02d}.pdf").write_text("\n".join(f"page {j} of {k}" for j in range(1, 6)) if k != 7 else "fine\nbroken")
    (tmp_path / "other.txt").write_text("x")
    pages.register(spark, pages.page_source("test_pages", parse), pages.page_source("test_few", parse_few))
    read = lambda name, **options: spark.read.format(name).options(path=f"file://{tmp_path}", pattern=r"\.pdf$", **options).load()
    df = read("test_pages", partitionBytes=200)
    assert df.rdd.getNumPartitions() > 5 and df.count() == 19 * 5 + 1
    bad = df.where("error is not null").collect()
    assert [(os.path.basename(r.path), r.error) for r in bad] == [("f07.pdf", "ValueError: bad line")] and bad[0].page is None
    assert sorted({r.page for r in df.where("page in (2, 4)").collect()}) == [2, 4]
    assert read("test_few").where("page < 3").count() == 19 * 2
    assert df.where("page >= 2 and page <= 3 and page = 3").select("text").count() == 19
    some = spark.read.format("test_pages").schema("path string, text string").options(path=f"file://{tmp_path}", pattern=r"f01\.pdf$").load()
    assert some.columns == ["path", "text"] and [r.text for r in some.collect()][:2] == ["page 1 of 1", "page 2 of 1"]
    (tmp_path / "empty").mkdir()
    assert spark.read.format("test_pages").options(path=f"file://{tmp_path}/empty").load().count() == 0


def test_report_files_are_there_together_or_not_at_all(spark, tmp_path):
    out = f"file://{tmp_path}/pack"
    seen = lambda: sorted(n for n in os.listdir(tmp_path / "pack") if n[0] not in "._")  # noqa: E731  a task that a failed job leaves behind may still write beside
    rows = spark.createDataFrame([(f"p{k}.html", f"é {k}") for k in range(40)], "name string, html string").repartition(5)
    exports.write_report_pack(rows, out)
    assert seen() == sorted(f"p{k}.html" for k in range(40)) and (tmp_path / "pack" / "p3.html").read_text() == "é 3"
    for wrong in (rows.union(rows.limit(1)), rows.withColumn("name", F.when(F.col("name") == "p9.html", "a/b").otherwise(F.concat(F.lit("n"), "name"))), rows.withColumn("html", F.when(F.col("name") == "p5.html", F.raise_error("no")).otherwise("x"))):
        with pytest.raises(Exception):
            exports.write_report_pack(wrong, out)
        assert seen() == sorted(f"p{k}.html" for k in range(40)) and (tmp_path / "pack" / "p3.html").read_text() == "é 3"
    exports.write_report_pack(rows.limit(2), out, overwrite=True)
    assert len(seen()) == 2


def test_ranks_of_a_group_of_a_million(spark):
    rows = spark.range(1_000_000).select(F.when(F.col("id") % 50 == 0, F.concat(F.lit("t"), F.col("id") % 1000)).otherwise("hot").alias("t"), (F.col("id") * 7919 % 1_000_003).alias("k"))
    got = ranks.ranked(rows, ["t"], ["k"], buckets=16)
    n = got.groupBy("t").agg(F.count("*").alias("n"), F.countDistinct("rank").alias("d"), F.max("rank").alias("m"), F.min("rank").alias("one")).collect()
    assert len(n) == 21 and all(r.n == r.d == r.m and r.one == 1 for r in n) and max(r.n for r in n) == 980_000
    # the order is kept: a sample against a count of smaller keys
    hot = got.where("t = 'hot'").cache()
    for r in hot.where("rank in (1, 777, 500000, 980000)").collect():
        assert hot.where(F.col("k") <= r.k).count() == r.rank
    # one group takes several tasks
    assert rows.where("t = 'hot'").repartitionByRange(16, "t", "k").select(F.spark_partition_id()).distinct().count() == 16
    few = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "t string, k int")
    assert sorted(map(tuple, ranks.ranked(few, ["t"], ["k"], buckets=3).collect()), key=str) == sorted([(None, 1, 1), (None, 2, 2), ("a", 1, 1)], key=str)
    assert ranks.ranked(few.limit(0), ["t"], ["k"]).count() == 0


def test_index_of_many_documents(spark):
    df = spark.range(100_000).selectExpr("id as doc_id", "case when id % 2 = 0 then 'Same' else concat('T', id) end as title", "'M' as manager_name", "date'2025-01-02' as publication_date", "0.5d as score", "'LOW' as band", "'s' as executive_summary",
        "cast(null as array<struct<asset_class_category:string,sub_asset_class:string,call:string,confidence:double,rationale_bullets:array<string>,tooltip_text:string>>) as calls", "cast(null as array<struct<page:int,excerpt:string>>) as citations")
    pack = exports.report_pack(df, items=3000)
    index = pack.where("name like 'index%'").select("name", F.regexp_extract_all("html", F.lit("<li><a href='([^']*)'"), 1).alias("names"), F.contains("html", F.lit(">More<")).alias("more")).collect()
    assert len(index) == 34 and sum(len(r.names) for r in index) == 100_000 and [r.name for r in index if not r.more] == ["index-34.html"]
    by = {r.name: r.names for r in index}
    every = [n for k in range(34) for n in by["index.html" if k == 0 else f"index-{k + 1}.html"]]
    assert every == sorted(every) and len(set(every)) == 100_000
