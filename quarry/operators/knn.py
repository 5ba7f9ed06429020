"""Exact k-nearest-neighbour search (Q1) and the shared per-query top-k (Q4).

Plan: few queries (one block, checked against the broadcast limit and ``PART_ANSWERS``)
are shipped to the executors; each corpus task scores its Arrow batches against them and
keeps a running top-k per query (``functions/vectors.py``: ``TopRows``), so a task emits
at most ``k`` rows per query.  More queries meet the corpus in a shuffle, in a grid of
groups with a bounded number of queries and rows: no task, and never the driver, holds
more than a group, and a query gets ``k`` rows from each part of the corpus, not from
each task.  The pairs are still all scored: the work is queries times rows.  A window
``row_number() <= k`` per query merges the results (Catalyst adds a ``WindowGroupLimit``
before the shuffle).  With many corpus partitions the merge is done in two levels so no
single task receives every partial result of a query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..session import DEFAULT_BROADCAST_BYTES, materialize

METRICS = ("cosine", "l2")
TWO_LEVEL_MIN_PARTITIONS = 64
TWO_LEVEL_GROUPS = 256
GRID_BYTES = 32 << 20       # of the vectors on one side of a group
PART_ANSWERS = 1 << 19      # rows that the queries of a task or group may get
SCORED = "qid string, id bigint, score double"
NONE = pa.schema([("qid", pa.string()), ("id", pa.int64()), ("score", pa.float64())])


def check_metric(metric: str) -> str:
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, got {metric!r}")
    return metric


def top_k_per_query(scored: DataFrame, k: int, metric: str = "cosine",
                    qid_col: str = "qid", id_col: str = "id", score_col: str = "score",
                    rank_col: str = "rank", groups: int = 1) -> DataFrame:
    """Q4: best ``k`` rows per query, best first (higher score for cosine, lower
    distance for l2), ties by lower id; adds ``rank`` 1..k."""
    order = [F.col(score_col).desc() if metric == "cosine" else F.col(score_col).asc(),
             F.col(id_col).asc()]
    if groups > 1:
        g = F.pmod(F.xxhash64(id_col), F.lit(groups))
        w1 = Window.partitionBy(qid_col, g).orderBy(*order)
        scored = (scored.withColumn("_r1", F.row_number().over(w1))
                  .where(F.col("_r1") <= k).drop("_r1"))
    w = Window.partitionBy(qid_col).orderBy(*order)
    return (scored.withColumn(rank_col, F.row_number().over(w))
            .where(F.col(rank_col) <= k))


def _side(dim: int, most: int | None = None) -> int:
    """Vectors on one side of a group: ``GRID_BYTES`` of doubles, at most ``most``."""
    return max(1, min(GRID_BYTES // (8 * max(dim, 1)), most or GRID_BYTES))


def meet(rows: DataFrame, asked: DataFrame, n_rows: dict[int, int], n_asked: dict[int, int],
         row_side: int, query_side: int, kernel) -> tuple[DataFrame, int]:
    """``rows(list_bucket, id, ...)`` and ``asked(list_bucket, qid, ...)`` of the same bucket
    meet in a shuffle: the rows of a bucket are cut into parts of about ``row_side``, its
    queries into parts of about ``query_side``, and ``kernel(rows, asked)`` gets each pair
    of parts.  The counts, one for each bucket, are ``n_rows`` and ``n_asked``.  Returns
    ``(qid, id, score)`` and the number of groups."""
    spark = rows.sparkSession
    sizes = [(b, -(-n // row_side), -(-n_asked[b] // query_side)) for b, n in n_rows.items() if b in n_asked]
    if not sizes:
        return spark.createDataFrame([], SCORED), 0
    total = sum(n * m for _, n, m in sizes)
    more = -(-3 * spark.sparkContext.defaultParallelism // total)      # every core has groups
    sizes = [(b, n, max(m, min(m * more, -(-n_asked[b] // 256)))) for b, n, m in sizes]
    plan = F.broadcast(spark.createDataFrame(sizes, "list_bucket int, parts int, qparts int"))

    def cut(key: str, n: str):
        return F.pmod(F.xxhash64(key), n).cast("int")

    def all_of(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    group = ["list_bucket", "part", "qpart"]
    rows = rows.join(plan, "list_bucket").withColumn("part", cut("id", "parts")).withColumn(
        "qpart", all_of("qparts")).drop("parts", "qparts")
    asked = asked.join(plan, "list_bucket").withColumn("qpart", cut("qid", "qparts")).withColumn(
        "part", all_of("parts")).drop("parts", "qparts")
    return rows.groupBy(*group).cogroup(asked.groupBy(*group)).applyInArrow(kernel, SCORED), \
        sum(n * m for _, n, m in sizes)


def _block_topk(corpus: DataFrame, bc, k: int, metric: str, id_col: str,
                vec_col: str) -> DataFrame:
    def score(batches):
        qids, Q = bc.value
        top = V.TopRows(Q, k, metric)
        for rb in V.slices(batches, vec_col):
            X, valid = V.list_column_matrix(rb.column(vec_col), None)
            if len(X):
                top.add(X, rb.column(id_col).to_numpy(zero_copy_only=False)[valid].astype(np.int64))
        yield top.batch(pa.array(qids, pa.string()))

    return corpus.select(F.col(id_col).cast("bigint").alias(id_col), vec_col).mapInArrow(
        score, SCORED).withColumnRenamed(id_col, "id")


def _grid_topk(corpus: DataFrame, queries: DataFrame, n_q: int, k: int, metric: str, dim: int) -> DataFrame:
    """``corpus(id, v)`` against ``queries(qid, v)`` in groups of bounded size."""
    def score(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return pa.Table.from_batches([], NONE)
        top = V.TopRows(V.list_column_matrix(asked.column("v"))[0], k, metric)
        top.add(V.list_column_matrix(rows.column("v"), None)[0],
                rows.column("id").combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64))
        return pa.Table.from_batches([top.batch(asked.column("qid").combine_chunks())])

    one = F.lit(0).alias("list_bucket")
    n = corpus.count()
    if not n:
        return corpus.sparkSession.createDataFrame([], SCORED)
    return meet(corpus.select(one, "id", "v"), queries.select(one, "qid", "v"), {0: n}, {0: n_q},
                _side(dim), _side(dim, max(1, PART_ANSWERS // k)), score)[0]


def knn_search(corpus: DataFrame, queries: DataFrame, k: int, metric: str = "cosine",
               id_col: str = "id", vec_col: str = "embedding", qid_col: str = "qid",
               qvec_col: str = "embedding",
               max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Exact top-``k`` of ``corpus`` for every query.

    Returns ``qid string, id bigint, score double, rank int``; score is cosine
    similarity (higher first) or squared L2 distance (lower first).  Queries
    with a NULL vector, and padding, produce no rows."""
    check_metric(metric)
    if k < 1:
        raise ValueError("k must be >= 1")
    spark = corpus.sparkSession
    sc = spark.sparkContext
    corpus = corpus.select(id_col, vec_col)
    nparts = corpus.rdd.getNumPartitions()
    groups = TWO_LEVEL_GROUPS if nparts > TWO_LEVEL_MIN_PARTITIONS else 1
    present = queries.where(F.col(qvec_col).isNotNull())
    n_q, n_ids, dim = present.agg(F.count(F.lit(1)), F.count_distinct(qid_col),
                                  F.max(F.size(qvec_col))).first()
    if n_ids != n_q:
        raise ValueError("query ids must be unique and not null")
    if not n_q:
        return spark.createDataFrame([], "qid string, id bigint, score double, rank int")
    if n_q > min(max_broadcast_bytes // (dim * 8 + 64), PART_ANSWERS // k):
        # read once for the count, once for the search: not computed anew
        corpus = materialize(corpus.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("v"))
                             .where("v IS NOT NULL"), "knn-corpus")
        asked = materialize(present.select(F.col(qid_col).cast("string").alias("qid"), F.col(qvec_col).alias("v")),
                            "knn-queries")
        return top_k_per_query(_grid_topk(corpus, asked, n_q, k, metric, dim), k, metric)
    rows = present.select(F.col(qid_col).cast("string").alias("qid"), F.col(qvec_col).alias("v")).toArrow()
    bc = sc.broadcast((rows.column("qid").to_pylist(), V.list_column_matrix(rows.column("v"))[0]))
    return top_k_per_query(_block_topk(corpus, bc, k, metric, id_col, vec_col), k, metric, groups=groups)
