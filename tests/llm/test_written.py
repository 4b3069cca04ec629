"""What jobs that write a table send to Python, and what they leave behind."""

import time

import pyarrow as pa
from pyspark.sql import functions as F
from quillfold.llm.common import BATCH_BYTES, written


def test_batches_of_long_texts_are_bounded_by_bytes(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    rows = spark.range(0, 900, 1, 1).select("id", F.repeat(F.lit("x"), 20_000).alias("text"))
    found = written(rows.mapInArrow(sizes, "n long, size long"), "sizes").collect()
    assert sum(r.n for r in found) == 900
    assert max(r["size"] for r in found) < 2 * BATCH_BYTES
    assert spark.conf.get(key) == before


def test_a_written_table_leaves_no_shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = manager.getAllFiles()
        return {n for k in range(found.size()) if (n := found.apply(k).getName()).startswith("shuffle_")}

    before = files()
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    table = written(counts, "counts")
    for _ in range(50):  # removed by messages
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert table.count() == counts.count() == 7
