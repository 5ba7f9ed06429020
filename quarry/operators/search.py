"""Search over an IVF / IVF-PQ index (Q2-Q7).

* Q2 probe: each query's ``nprobe`` nearest lists, scored in an Arrow task over
  the (small) query table against the broadcast centroid matrix.
* Q3 scan: no join.  The queries are sent to the tasks with the lists they probe; a
  task walks its postings list by list, scores each list against the queries that
  probe it by products of matrices (product codes are decoded: the asymmetric
  estimate is the exact score against the decoded vector) and emits its ``k`` best
  per query.  More queries than one block meet the postings in the shuffle of
  ``operators/shared.py``.
  Postings lie in folders by bucket of lists, so unprobed buckets aren't read.
* Q4: window top-k per query (partial ``WindowGroupLimit`` before the shuffle).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..session import DEFAULT_BROADCAST_BYTES, KERNEL_BYTES, materialize
from .ivf import (DEFAULT_NPROBE, LISTS_PER_BUCKET, TIE_DIGITS, IvfIndex, _coarse_scores, _prep,
                  centroid_matrix, codebook_tensor)
from .knn import PART_ANSWERS, SCORED, TWO_LEVEL_GROUPS, TWO_LEVEL_MIN_PARTITIONS, check_metric, top_k_per_query


def _meta(index: IvfIndex) -> dict:
    if index is None or index.postings is None:
        raise ValueError("there is no index to search; build or load one first")  # Q7
    return index.meta.first().asDict()


def probe_rows(X: np.ndarray, C: np.ndarray, p: int, metric: str) -> np.ndarray:
    """The ``p`` best lists of each vector, best first, ties to the lower list."""
    out = np.empty((len(X), p), dtype=np.int64)
    step = max(1, KERNEL_BYTES // (8 * len(C)))
    for at in range(0, len(X), step):
        s = np.round(_coarse_scores(X[at:at + step], C, metric, rounded=False), TIE_DIGITS)
        out[at:at + step] = np.argsort(-s, axis=1, kind="stable")[:, :p]
    return out


def probe_lists(queries: DataFrame, centroids: DataFrame, nprobe: int = DEFAULT_NPROBE,
                metric: str = "cosine", qid_col: str = "qid",
                vec_col: str = "embedding") -> DataFrame:
    """Q2: ``(qid, list_id, coarse, probe_rank)`` for the ``nprobe`` best lists
    (ties -> lower list id).  ``coarse`` is the inner product of unit vectors
    (cosine) or the squared L2 distance to the centroid."""
    check_metric(metric)
    C = centroid_matrix(centroids, metric)
    bc = queries.sparkSession.sparkContext.broadcast(C)
    p = min(nprobe, C.shape[0])

    def probe(batches):
        Cm = bc.value
        # of the scores, their rounded form and their order, a slice at a time
        for rb in V.slices(batches, vec_col, 4 * Cm.shape[0]):
            X, valid = V.list_column_matrix(rb.column(vec_col))
            if len(X) == 0:
                continue
            qids = rb.column(qid_col).filter(pa.array(valid))
            raw = _coarse_scores(X, Cm, metric, rounded=False)
            order = np.argsort(-np.round(raw, TIE_DIGITS), axis=1, kind="stable")[:, :p]
            top = np.take_along_axis(raw, order, 1)
            yield pa.RecordBatch.from_arrays(
                [qids.take(pa.array(np.repeat(np.arange(len(X)), p))),
                 pa.array(order.reshape(-1).astype(np.int32)),
                 pa.array((top if metric == "cosine" else -top).reshape(-1)),
                 pa.array(np.tile(np.arange(1, p + 1, dtype=np.int32), len(X)))],
                names=["qid", "list_id", "coarse", "probe_rank"])

    return queries.select(F.col(qid_col).cast("string").alias(qid_col), vec_col).mapInArrow(
        probe, "qid string, list_id int, coarse double, probe_rank int")


def _decode(codes: np.ndarray, lists: np.ndarray, C: np.ndarray, cb: np.ndarray) -> np.ndarray:
    """The vectors that product codes stand for: centroid plus code sub-vectors.  The
    asymmetric estimate of a query is its exact score against these."""
    return C[lists] + cb[np.arange(cb.shape[0]), codes].reshape(len(codes), -1)


def scan_lists(batches, qids, Q: np.ndarray, C, cb, by_list: dict | None, metric: str, k: int):
    """Batches of postings sorted by list against queries: each list is scored against all
    queries that probe it (``by_list``; None: all lists are probed by all queries), and
    only the ``k`` best per query come out, ``(qid, id, score)``."""
    # rounded, so that equal vectors tie wherever they are stored
    top = V.TopRows(Q, k, "product" if metric == "cosine" else "l2", 12)
    step = max(64, V.SLICE_BYTES // (8 * max(Q.shape[1], 1)))
    for whole in batches:
        for lo in range(0, whole.num_rows, step):
            rb = whole.slice(lo, step)
            lists = rb.column("list_id").to_numpy(zero_copy_only=False)
            ids = rb.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
            if cb is None:
                x = _prep(V.list_column_matrix(rb.column("embedding"))[0], metric)
            else:
                codes = pa.concat_arrays([rb.column("codes")])       # offsets from 0
                x = _decode(np.frombuffer(codes.buffers()[2], np.uint8, len(codes) * cb.shape[0]).reshape(
                    -1, cb.shape[0]), lists, C, cb)
            if by_list is None:
                top.add(x, ids)
                continue
            edge = np.flatnonzero(np.diff(lists)) + 1
            for at, end in zip([0, *edge.tolist()], [*edge.tolist(), len(lists)]):
                queries = by_list.get(int(lists[at]))
                if queries is not None:
                    top.add(x[at:end], ids[at:end], queries)
    if top.n:
        yield top.batch(pa.array(qids, pa.string()))


def _scan_kernel(bc, metric: str, k: int):
    """:func:`scan_lists` beside broadcast queries."""
    return lambda batches: scan_lists(batches, *bc.value, metric, k)


def ivf_search(index: IvfIndex, queries: DataFrame, k: int, nprobe: int = DEFAULT_NPROBE,
               qid_col: str = "qid", vec_col: str = "embedding",
               max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
               probes: DataFrame | None = None) -> DataFrame:
    """Q3 + Q4: ``(qid, id, score, rank)``; cosine scores are higher-better,
    L2 scores are squared distances (lower-better).  PQ scores are the
    asymmetric estimates ``q.c + sum_m q_m . cb_m[code_m]`` (cosine) or
    ``sum_m |(q-c)_m - cb_m[code_m]|^2`` (L2).

    Queries (unique ids; null vectors give no rows) go to the tasks with the lists
    they probe while they take about ``max_broadcast_bytes`` and ``PART_ANSWERS``
    result rows; there is no join.  More queries are searched by one shared scan
    (:func:`quarry.operators.shared.shared_search`).  The postings are read by list
    bucket, a partition of their folder, so buckets that no query probes aren't opened.
    A probe of all lists scores all postings with all queries.

    ``probes(qid, list_id)``, at most ``nprobe`` for each query, takes the place of the
    flat probe (flat postings only)."""
    meta = _meta(index)
    metric = meta["metric"]
    if k < 1:
        raise ValueError("k must be >= 1")
    spark = queries.sparkSession
    sc = spark.sparkContext
    if probes is not None and index.is_pq:
        raise ValueError("given probes need flat postings")
    C = centroid_matrix(index.centroids, metric) if probes is None else None
    cb = codebook_tensor(index.codebooks) if index.is_pq else None
    present = queries.where(F.col(vec_col).isNotNull()).select(
        F.col(qid_col).cast("string").alias("qid"), F.col(vec_col).alias("embedding"))
    if probes is None:
        present = present.withColumn("lists", F.lit(None).cast("array<int>"))
    else:
        present = present.join(probes.groupBy("qid").agg(F.collect_list("list_id").alias("lists")), "qid", "left")
    present = materialize(present, "ivf-queries")
    n_q, n_ids, dim = present.agg(F.count(F.lit(1)), F.count_distinct("qid"),
                                  F.max(F.size("embedding"))).first()
    if n_ids != n_q:
        raise ValueError("query ids must be unique and not null")
    if not n_q:
        return spark.createDataFrame([], "qid string, id bigint, score double, rank int")
    p = min(nprobe, meta["nlist"])
    full = probes is None and p == meta["nlist"]
    if n_q > min(max_broadcast_bytes // (dim * 8 + (0 if full else p * 16) + 64), PART_ANSWERS // k):
        from .shared import shared_search
        return shared_search(index, present.select("qid", "embedding"), k, nprobe, probes=probes)
    payload = "codes" if index.is_pq else "embedding"
    nparts = index.postings.rdd.getNumPartitions()
    groups = TWO_LEVEL_GROUPS if nparts > TWO_LEVEL_MIN_PARTITIONS else 1
    rows = present.toArrow()
    qids, Q = rows.column("qid").to_pylist(), V.list_column_matrix(rows.column("embedding"))[0]
    postings, by_list = index.postings, None
    if not full:
        if probes is None:
            probed, owner = probe_rows(Q, C, p, metric).ravel(), np.repeat(np.arange(len(Q)), p)
        else:
            chosen = rows.column("lists").to_pylist()
            probed = np.concatenate([np.asarray(x or [], dtype=np.int64) for x in chosen])
            owner = np.repeat(np.arange(len(Q)), [len(x or []) for x in chosen])
        # the queries of each list, by one sort
        order = np.argsort(probed, kind="stable")
        lids, first = np.unique(probed[order], return_index=True)
        by_list = dict(zip(lids.tolist(), np.split(owner[order], first[1:])))
        if "list_bucket" in postings.columns and p < meta["nlist"]:
            postings = postings.where(F.col("list_bucket").isin(sorted({x // LISTS_PER_BUCKET for x in by_list})))
    bc = sc.broadcast((qids, _prep(Q, metric), C, cb, by_list))
    out = postings.select("list_id", "id", payload).mapInArrow(_scan_kernel(bc, metric, k), SCORED)
    return top_k_per_query(out, k, metric, groups=groups)


def retrieve(index: IvfIndex, queries: DataFrame, k: int = 100,
             nprobe: int = DEFAULT_NPROBE, **kw) -> DataFrame:
    """Q5: the retriever façade -- candidates ``(qid, id, score, rank)``."""
    return ivf_search(index, queries, k, nprobe, **kw)


def drop_padding(candidates: DataFrame, id_col: str = "id") -> DataFrame:
    """Remove ``-1`` padding ids from imported candidate lists."""
    return candidates.where(F.col(id_col) != -1)


__all__ = ["probe_lists", "ivf_search", "retrieve", "drop_padding", "TIE_DIGITS"]
