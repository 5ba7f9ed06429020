"""Reranking (E3, R1, R2): score (query, candidate text) pairs and keep the
best ``k`` per query, ties by retrieval rank.

Candidate texts are attached with the I3 lookup (the candidate set is bounded
by ``n_queries x candidates`` and broadcast).  Scorers:

* default :func:`lexical_overlap` -- number of distinct query tokens present in
  the candidate, a built-in array expression (JVM-side, SQL-checkable);
* :func:`bm25_scores` -- BM25 with each query's candidates as its collection:
  document frequencies, average length and sums are grouped in Spark;
* any user ``pair_scorer_loader() -> fn(queries: list[str], texts: list[str])
  -> list[float]`` (e.g. a cross-encoder), called on batches of ``batch_size``
  pairs inside an Arrow task; the loader runs once per task.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import tokens
from .ids import lookup_text

# The reference's rerank batch size and final k.
DEFAULT_RERANK_BATCH = 16
DEFAULT_RERANK_K = 10
# Usual parameters of BM25: saturation of counts, weight of the length.
BM25_K1, BM25_B = 1.2, 0.75
SCORE_DIGITS = 9            # scores that differ less are ties


def lexical_overlap(query_col: str = "query", text_col: str = "text") -> F.Column:
    return F.size(F.array_intersect(F.array_distinct(tokens(query_col)),
                                    F.array_distinct(tokens(text_col)))).cast("double")


def candidate_pairs(queries: DataFrame, candidates: DataFrame, chunks: DataFrame,
                    n_queries: int | None = None, per_query: int | None = None) -> DataFrame:
    """``(qid, id, rank, query, text)`` for every candidate.  With the
    query count and candidates per query known, the candidate set has a proven
    size bound and the lookups broadcast it."""
    bound = n_queries * per_query if n_queries is not None and per_query else None
    with_text = lookup_text(candidates.select("qid", "id", "rank"), chunks, hit_bound=bound)
    # query texts have no proven width: the planner sizes this join at runtime
    return with_text.join(queries.select("qid", "query"), "qid")


def score_pairs(pairs: DataFrame, scorer_loader: Callable | None = None,
                batch_size: int = DEFAULT_RERANK_BATCH) -> DataFrame:
    """Adds ``rerank_score double``."""
    if scorer_loader is None:
        return pairs.withColumn("rerank_score", lexical_overlap())
    schema = T.StructType([*pairs.schema.fields, T.StructField("rerank_score", T.DoubleType())])

    def run(batches):
        fn = scorer_loader()
        for pdf in batches:
            out = np.empty(len(pdf), dtype=np.float64)
            qs, ts = pdf["query"].tolist(), pdf["text"].tolist()
            for i in range(0, len(pdf), batch_size):
                out[i:i + batch_size] = np.asarray(fn(qs[i:i + batch_size], ts[i:i + batch_size]),
                                                   dtype=np.float64)
            yield pdf.assign(rerank_score=out)

    return pairs.mapInPandas(run, schema)


def bm25_scores(pairs: DataFrame, k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """``(qid, id, rank, rerank_score)`` of :func:`candidate_pairs`.

    A candidate's score adds, over the different tokens of its query, ``idf * tf *
    (k1 + 1) / (tf + k1 * (1 - b + b * length / average))`` with ``idf = ln(1 + (N - df
    + 0.5) / (df + 0.5))``; N, df and the average are those of the query's candidates,
    so each query is a group of at most its candidates.  Texts are read in place: only
    counts of the query's tokens are shuffled.  A candidate without any token of the
    query, or without text, scores 0."""
    words = pairs.select("qid", "id", "rank", F.array_distinct(tokens("query")).alias("q"),
                         tokens(F.coalesce("text", F.lit(""))).alias("t"))
    hits = F.filter(F.transform("q", lambda term: F.struct(
        term.alias("term"), F.size(F.filter("t", lambda x: x == term)).alias("tf"))), lambda h: h.tf > 0)
    query = Window.partitionBy("qid")
    counted = (words.select("qid", "id", "rank", F.size("t").alias("length"), hits.alias("hits"))
               .withColumn("n", F.count(F.lit(1)).over(query)).withColumn("average", F.avg("length").over(query))
               .select("qid", "id", "rank", "length", "n", "average", F.explode_outer("hits").alias("hit"))
               .withColumn("df", F.count("hit").over(Window.partitionBy("qid", "hit.term"))))
    tf, df, n = F.col("hit.tf"), F.col("df"), F.col("n")
    weight = F.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * (k1 + 1) / (
        tf + k1 * (1 - b + b * F.col("length") / F.nullif("average", F.lit(0.0))))
    return counted.groupBy("qid", "id", "rank").agg(
        F.round(F.coalesce(F.sum(weight), F.lit(0.0)), SCORE_DIGITS).alias("rerank_score"))


def bm25_reranker(k1: float = BM25_K1, b: float = BM25_B, candidates: int = 100) -> Callable:
    """:func:`reranker` with BM25 over each query's candidates."""
    def apply(queries: DataFrame, cands: DataFrame, chunks: DataFrame, k: int):
        return rerank_top_k(bm25_scores(candidate_pairs(queries, cands, chunks, queries.count(), candidates), k1, b), k)
    return apply


def rerank_top_k(scored: DataFrame, k: int = DEFAULT_RERANK_K) -> DataFrame:
    """R2: best ``k`` per query by score, ties by retrieval rank:
    ``(qid, id, rank, score, retrieval_rank)``."""
    if k < 1:
        raise ValueError("k must be >= 1")
    w = Window.partitionBy("qid").orderBy(F.col("rerank_score").desc(), F.col("rank").asc())
    return (scored.select("qid", "id", F.col("rank").alias("retrieval_rank"),
                          F.col("rerank_score").alias("score"),
                          F.row_number().over(w).alias("rank"))
            .where(F.col("rank") <= k))


def reranker(scorer_loader: Callable | None = None,
             batch_size: int = DEFAULT_RERANK_BATCH, candidates: int = 100) -> Callable:
    """A ``reranker(queries, candidates, chunks, k)`` for
    :func:`quarry.plans.pipeline.run_queries`."""
    def apply(queries: DataFrame, cands: DataFrame, chunks: DataFrame, k: int):
        pairs = candidate_pairs(queries, cands, chunks, queries.count(), candidates)
        return rerank_top_k(score_pairs(pairs, scorer_loader, batch_size), k)
    return apply
