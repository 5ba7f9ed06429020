"""Evaluation (V2-V9): precision, recall and NDCG at k per query, their macro
averages and the weighted score.  Everything is a join plus grouped sums; no
per-query list is ever collected.

Truth is long: ``(qid, relevant)`` with one row per relevant id and a NULL
``relevant`` for a query whose relevant set is empty."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Weights of the combined score (precision, recall, NDCG).
WEIGHT_PRECISION = 0.20
WEIGHT_RECALL = 0.50
WEIGHT_NDCG = 0.30


def responses_long(responses: DataFrame) -> DataFrame:
    """``(qid, response array)`` -> ``(qid, rank, source_name)``, rank from 1."""
    return responses.select("qid", F.posexplode("response").alias("_pos", "source_name")) \
        .select("qid", (F.col("_pos") + 1).alias("rank"), "source_name")


def ideal_dcg(m) -> F.Column:
    """sum_{i=1..m} 1/log2(i+1); 0 for m = 0."""
    m = F.col(m) if isinstance(m, str) else m
    return F.when(m <= 0, F.lit(0.0)).otherwise(F.aggregate(
        F.sequence(F.lit(1).cast("bigint"), m.cast("bigint")), F.lit(0.0).cast("double"),
        lambda a, i: a + F.lit(1.0) / F.log2(i + 1)))


def metrics_per_query(responses: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """V2-V6: for every truth query that has a response (inner join, V2):
    ``qid, n_relevant, hits, precision, recall, ndcg``.

    precision = hits in the first k / k; recall = hits / |relevant| (0 when the
    set is empty); ndcg = DCG / ideal DCG over min(|relevant|, k) places."""
    if k < 1:
        raise ValueError("k must be >= 1")
    rel = truth.select("qid", "relevant").distinct()
    n_rel = rel.groupBy("qid").agg(F.count("relevant").alias("n_relevant"))
    answered = responses.select("qid").distinct()
    top = responses_long(responses).where(F.col("rank") <= k)
    hits = (top.join(rel.where(F.col("relevant").isNotNull()),
                     (top.qid == rel.qid) & (top.source_name == rel.relevant))
            .select(top.qid, top.rank)
            .groupBy("qid").agg(F.count(F.lit(1)).alias("hits"),
                                F.sum(F.lit(1.0) / F.log2(F.col("rank") + 1)).alias("dcg")))
    base = n_rel.join(answered, "qid", "inner").join(hits, "qid", "left")
    hits_c = F.coalesce("hits", F.lit(0)).cast("bigint")
    dcg = F.coalesce("dcg", F.lit(0.0))
    idcg = ideal_dcg(F.least(F.col("n_relevant"), F.lit(k)))
    return base.select(
        "qid", F.col("n_relevant").cast("bigint").alias("n_relevant"), hits_c.alias("hits"),
        (hits_c / F.lit(float(k))).alias("precision"),
        F.when(F.col("n_relevant") == 0, F.lit(0.0))
         .otherwise(hits_c / F.col("n_relevant")).alias("recall"),
        F.when(idcg == 0, F.lit(0.0)).otherwise(dcg / idcg).alias("ndcg"))


def missing_results(responses: DataFrame, truth: DataFrame) -> DataFrame:
    """V2's warnings as data: truth queries without any response (anti join)."""
    return (truth.select("qid").distinct()
            .join(responses.select("qid").distinct(), "qid", "left_anti"))


def metrics_summary(per_query: DataFrame) -> DataFrame:
    """V7 + V8: one row ``n_queries, precision, recall, ndcg, score``; averages
    over no queries are NULL."""
    agg = per_query.agg(F.count(F.lit(1)).alias("n_queries"),
                        F.avg("precision").alias("precision"),
                        F.avg("recall").alias("recall"),
                        F.avg("ndcg").alias("ndcg"))
    return agg.withColumn("score", F.col("precision") * WEIGHT_PRECISION
                          + F.col("recall") * WEIGHT_RECALL + F.col("ndcg") * WEIGHT_NDCG)
