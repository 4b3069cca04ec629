"""Evidence of claims, packed by the chunk that they cite, against each citation alone."""

from pyspark.sql import functions as F

from quillfold.functions import text as T
from quillfold.operators import confidence

CHUNKS = [("a", "We expect Global Growth to slow; bonds are cheap."), ("b", "Rates will rise.\nEquities (US) is fine"), ("c", ""), ("d", None), ("e", "GLOBAL growth " * 3000)]
VALUES = ["global growth", "bonds", "rates", "Equities (US)", "growth to surprise", "of", "", None, "global growth global growth", "[a-z]+ *"]


def alone(claims, chunks):
    c = claims.join(chunks.where("text is not null"), "chunk_id", "left")
    v = F.coalesce("value", F.lit(""))
    parts = confidence.EVIDENCE
    score = parts["explicit"] * T.explicit_mention(F.col("value"), F.col("text")) + parts["overlap"] * T.word_overlap(v, F.col("text")) + parts["entailment"] * T.entailment(v, F.col("text"))
    return c.groupBy("claim_id").agg(F.coalesce(F.max(F.when(F.col("text").isNotNull(), score)), F.lit(0.0)).alias("strength"))


def rows(df):
    return sorted((str(r.claim_id), round(r.strength, 9)) for r in df.collect())


def test_evidence_is_that_of_each_citation_alone(spark):
    chunks = spark.createDataFrame(CHUNKS, "chunk_id string, text string").withColumn("claim_id", F.lit("clash"))
    hot = [(i, VALUES[i % len(VALUES)], "a") for i in range(300)]  # one chunk has nearly all claims
    other = [(i, VALUES[i % len(VALUES)], c) for i in range(0, 30) for c in ("b", "c", "d", "e", "nowhere", None)]
    claims = spark.createDataFrame([*hot, *other, *hot[:9], (None, "bonds", "a"), (999, "bonds", None)], "claim_id long, value string, chunk_id string").withColumn("text", F.lit("clash"))
    want = rows(alone(claims.drop("text"), chunks.drop("claim_id")))
    assert len(want) == 302 and len({s for _, s in want}) > 4
    for together in (1, 4, 64):
        assert rows(confidence.evidence(claims, chunks, together)) == want
    assert confidence.evidence(claims.limit(0), chunks).count() == 0
    assert rows(confidence.evidence(claims.where("claim_id = 0"), chunks.limit(0))) == [("0", 0.0)]
