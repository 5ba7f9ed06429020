"""Result shaping: candidate cut (R3), chunk -> document roll-up (R4) and the
per-query response list (R5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ids import lookup_source


def cut_candidates(candidates: DataFrame, k: int, rank_col: str = "rank") -> DataFrame:
    """The first ``k`` candidates of each query (no rerank)."""
    if k < 1:
        raise ValueError("k must be >= 1")
    return candidates.where(F.col(rank_col) <= k)


def rollup_documents(hits: DataFrame, chunks: DataFrame, hit_bound: int | None = None,
                     rank_col: str = "rank") -> DataFrame:
    """Ranked chunk hits ``(qid, id, rank)`` -> ranked, de-duplicated
    documents ``(qid, rank, source_name)``: each document keeps the place of its
    best chunk; unknown chunk ids are dropped (I2).  Runs after the chunk cut,
    so a query can get fewer documents than chunks."""
    named = lookup_source(hits.select("qid", "id", rank_col), chunks, hit_bound)
    best = named.groupBy("qid", "source_name").agg(F.min(rank_col).alias("_best"))
    w = Window.partitionBy("qid").orderBy("_best")
    return best.select("qid", F.row_number().over(w).alias("rank"), "source_name")


def query_responses(queries: DataFrame, docs: DataFrame) -> DataFrame:
    """``(qid, query, response array<string>)`` in rank order (at most k
    names per query, so the collected list is bounded); a query with no hits
    gets an empty list.  A query id seen twice yields one response; as a table
    has no order, the larger query text is kept."""
    lists = docs.groupBy("qid").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "source_name"))),
                    lambda x: x["source_name"]).alias("_resp"))
    q = queries.groupBy("qid").agg(F.max("query").alias("query"))
    # one short list per query; names have no proven width, so the join
    # strategy is left to AQE's measured sizes
    return (q.join(lists, "qid", "left")
            .select("qid", "query",
                    F.coalesce("_resp", F.array().cast("array<string>")).alias("response")))
