"""Exact deduplication by deterministic block naming.

Each normalised text is cut into blocks of a fixed size. Equal blocks get equal
integer names, by sorting them; then adjacent names are paired and the pairs
named in the same way, until one name is left for each document. Two documents
have the same last name (and the same number of blocks) exactly if their texts
are equal: no step trusts a digest.

Names: the blocks are dealt to buckets by a hash, each bucket is sorted, and a
block's name is its bucket and its rank there. That is a function of the data
alone, so a task that runs again after a lost executor gives the same names.
Blocks that make up more than ``1 / HOT_SHARE`` of all rows never meet in one
task: their hashes are fewer than ``HOT_SHARE``, and they are named by a small
table, which is broadcast if a count finds it small. Groups of equal texts with
such a part of all rows reach their rows by a broadcast, too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, sized, text_of, written

BLOCK_BYTES = 2048
BUCKETS = 1 << 16
#: A key with more than this part of all rows is named through a broadcast; so at most this many keys are.
HOT_SHARE = 1000


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space."""
    return F.regexp_replace(text_of(text), SPACE, " ")


def _named(rows: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``rows`` (``total`` at most) with ``name``: equal for equal ``keys``, different for different ones."""
    hashed = rows.withColumn("_h", F.xxhash64(*keys))
    hot = (
        hashed.groupBy("_h").agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > max(50, total // HOT_SHARE))
        .select("_h", F.lit(True).alias("_hot"))
    )
    flagged = hashed.join(sized(written(hot, "hot")), "_h", "left")
    bucket = F.pmod(F.col("_h"), F.lit(BUCKETS))
    rank = F.dense_rank().over(Window.partitionBy("_bucket").orderBy(*keys)).cast("long")
    cold = (
        flagged.where("_hot is null").withColumn("_bucket", bucket)
        .withColumn("name", F.col("_bucket") * (1 << 40) + rank)
        .drop(*keys, "_h", "_hot", "_bucket")
    )
    warm = flagged.where("_hot")
    # few keys have so many rows each: they are named by rank in their bucket, below zero
    few = warm.select("_h", *keys).distinct().withColumn("_bucket", bucket)
    names = written(few.withColumn("name", -(F.col("_bucket") * (1 << 40) + rank)).drop("_bucket"), "hot-names")
    fits = names.count() <= 4 * HOT_SHARE  # of a block each; more only where hashes of different blocks are equal
    hot_named = warm.join(F.broadcast(names) if fits else names, ["_h", *keys]).drop(*keys, "_h", "_hot")
    return cold.unionByName(hot_named)


def identities(docs: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(id, _v, identity)``: one row per distinct id and text; equal identities mean equal texts.

    ``_v`` tells texts apart that share an id; rows that repeat both are one.
    """
    text = normalised(F.col(text_col))
    raw = text.cast("binary")
    blocks = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("_v"), raw.alias("_b"),
        F.greatest(F.lit(1), F.ceil(F.octet_length(raw) / block_bytes)).cast("int").alias("n"),
    ).select(
        "id", "_v", "n",
        F.posexplode(F.transform(
            F.sequence(F.lit(0), F.col("n") - 1),
            lambda i: F.col("_b").substr(i * block_bytes + 1, F.lit(block_bytes)),
        )).alias("pos", "block"),
    )
    total = docs.agg(F.sum(F.greatest(F.lit(1), F.ceil(F.octet_length(raw) / block_bytes)))).head()[0] or 0
    level = written(_named(blocks, ["block"], total), "names")
    done = level.where("n = 1").select("id", "_v", "n", "name").distinct()
    size, depth = 1, 0
    parts = [done.select("id", "_v", F.lit(0).alias("depth"), "name")]
    open_rows = level.where("n > 1")
    while left := open_rows.count():
        size, depth = size * 2, depth + 1
        # max is the only value at its place, repeated rows or not
        pairs = open_rows.groupBy("id", "_v", "n", F.floor(F.col("pos") / 2).alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
            # no name is 0: it stands for the missing half of a last pair
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(0).cast("long")).alias("b"),
        )
        level = written(_named(pairs, ["a", "b"], left), "names")
        parts.append(level.where(F.col("n") <= size).select("id", "_v", F.lit(depth).alias("depth"), "name"))
        open_rows = level.where(F.col("n") > size)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("id", "_v", F.struct("depth", "name").alias("identity"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Null texts are empty; all empty texts are equal. Of equal texts the smallest
    id stays (a null id only if there is no other). Rows that repeat an id and
    its text share one fate. ``group_size`` counts rows. Other columns of
    ``docs`` are not read. An empty table gives an empty result.
    """
    text = normalised(F.col(text_col))
    ids = identities(docs, id_col, text_col, block_bytes)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("_v"), F.sha2(text, 256).alias("text_sha256"))
    both = rows.join(ids, rows.doc_id.eqNullSafe(ids.id) & (rows._v == ids._v)).select("doc_id", "text_sha256", "identity")
    both = written(both, "identities")
    groups = written(both.groupBy("identity").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups")
    total = groups.agg(F.sum("group_size")).head()[0] or 0
    # rows of the largest groups stay where they are: there are fewer than HOT_SHARE such groups, at any size
    large = F.broadcast(groups.where(F.col("group_size") > max(50, total // HOT_SHARE)))
    told = both.join(large, "identity").unionByName(both.join(large.select("identity"), "identity", "left_anti").join(groups, "identity"))
    return told.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
    )
