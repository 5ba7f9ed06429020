"""Exact search that skips lists (Q1 over an index with flat postings).

Each list has a radius, the largest distance of a member from its centroid.  By the
triangle inequality a member of the list is no nearer to a query than the centroid's
distance less the radius, and no farther than the two together; for cosine the inner
product differs from the centroid's by at most the radius.  So

1. the ``nprobe`` nearest lists of each query are searched, which gives a k-th score;
2. of the other lists those are searched whose best possible member reaches that score
   (equal scores too: a smaller id would win), or, if fewer than k rows were found, the
   k-th score that the radii promise;
3. both results are merged.

The rows are those of a search through every list, for any data; how much is skipped
depends on how well the lists part the data, and is told by :func:`probed_rows`.
Centroids and radii (one number for each list) are broadcast like the centroids of every
search; queries meet the postings in the shuffle of ``operators/shared.py``."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..session import KERNEL_BYTES, materialize
from .ivf import IvfIndex, _prep, centroid_matrix
from .knn import top_k_per_query
from .search import _meta, probe_lists
from .shared import shared_search

FIRST_LISTS = 4         # lists searched for the first bound
SLACK = 1e-9            # far above the rounding of scores, far below their differences


def list_radii(index: IvfIndex) -> DataFrame:
    """``(list_id, radius, n)``: largest distance from the centroid and number of rows of
    each list that has rows.  One pass, partial maxima before the shuffle."""
    metric = _meta(index)["metric"]
    if index.is_pq:
        raise ValueError("product codes don't hold the vectors; exact search needs flat postings")
    bc = index.postings.sparkSession.sparkContext.broadcast(centroid_matrix(index.centroids, metric))

    def kernel(batches):
        c = bc.value
        far, n = np.full(len(c), -1.0), np.zeros(len(c), np.int64)
        for rb in batches:
            x, valid = V.list_column_matrix(rb.column("embedding"))
            if len(x):
                lists = rb.column("list_id").to_numpy(zero_copy_only=False)[valid]
                np.maximum.at(far, lists, V.row_norms(_prep(x, metric) - c[lists]))
                n += np.bincount(lists, minlength=len(c))
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(far[some]), pa.array(n[some])],
                                         names=["list_id", "radius", "n"])

    return index.postings.select("list_id", "embedding").mapInArrow(
        kernel, "list_id int, radius double, n bigint").groupBy("list_id").agg(
        F.max("radius").alias("radius"), F.sum("n").alias("n"))


def _bounds(q: np.ndarray, c: np.ndarray, radius: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """For each query and list the least and the greatest cost that a member can have;
    cost: squared distance, or minus the inner product."""
    d = np.sqrt(V.sq_l2_distances(q, np.einsum("ij,ij->i", q, q), c))
    near = np.maximum(d - radius - SLACK, 0.0)
    if metric == "l2":
        return near ** 2, (d + radius + SLACK) ** 2
    product, reach = q @ c.T, V.row_norms(q)[:, None] * radius + SLACK
    # vectors of length one (or zero): both limits hold, the lower counts
    return -np.minimum(product + reach, 1.0 - near ** 2 / 2), -(product - reach)


def candidate_lists(queries: DataFrame, index: IvfIndex, radii: DataFrame, k: int) -> DataFrame:
    """``(qid, list_id)`` of the lists that may hold one of a query's ``k`` best rows.
    ``queries(qid, embedding, kth)``: ``kth`` is the score of a k-th row known already,
    or null."""
    metric = _meta(index)["metric"]
    known = radii.orderBy("list_id").toArrow()
    lists = known.column("list_id").to_numpy()
    radius, n = known.column("radius").to_numpy(), known.column("n").to_numpy()
    bc = queries.sparkSession.sparkContext.broadcast((centroid_matrix(index.centroids, metric)[lists], lists, radius, n))

    def kernel(batches):
        c, lists, radius, n = bc.value
        step = max(1, KERNEL_BYTES // (64 * max(len(lists), 1)))
        for rb in batches:
            x, valid = V.list_column_matrix(rb.column("embedding"))
            rb = rb.filter(pa.array(valid))
            for at in range(0, len(x) if len(lists) else 0, step):
                part = rb.slice(at, step)
                least, most = _bounds(_prep(x[at:at + step], metric), c, radius, metric)
                # the cost within which the radii promise k rows
                order = np.argsort(most, axis=1)
                rows = np.cumsum(n[order], axis=1)
                place = np.minimum((rows < k).sum(axis=1), len(lists) - 1)
                limit = np.take_along_axis(most, order, 1)[np.arange(len(place)), place]
                limit = np.where(rows[:, -1] < k, np.inf, limit)
                kth = part.column("kth").to_numpy(zero_copy_only=False).astype(np.float64)
                kth = kth if metric == "l2" else -kth
                limit = np.fmin(limit, kth)         # a null is no bound
                limit += SLACK * (1.0 + np.abs(np.where(np.isfinite(limit), limit, 0.0)))
                query, found = np.nonzero(least <= limit[:, None])
                yield pa.RecordBatch.from_arrays([part.column("qid").take(pa.array(query)), pa.array(lists[found])],
                                                 names=["qid", "list_id"])

    return queries.select("qid", "embedding", "kth").mapInArrow(kernel, "qid string, list_id int")


def _searched(index: IvfIndex, queries: DataFrame, k: int, nprobe: int, radii: DataFrame):
    """The first result, and the lists that remain for each query."""
    first = materialize(shared_search(index, queries, k, nprobe), "pruned-first")
    worst = F.min if _meta(index)["metric"] == "cosine" else F.max
    kth = first.groupBy("qid").agg(F.count(F.lit(1)).alias("n"), worst("score").alias("worst")).select(
        "qid", F.when(F.col("n") >= k, F.col("worst")).alias("kth"))
    done = probe_lists(queries, index.centroids, nprobe, _meta(index)["metric"]).select("qid", "list_id")
    rest = materialize(candidate_lists(queries.join(kth, "qid", "left"), index, radii, k).join(
        done, ["qid", "list_id"], "left_anti"), "pruned-lists")
    return first, done, rest


def _queries(queries: DataFrame, qid_col: str, vec_col: str) -> DataFrame:
    return materialize(queries.where(F.col(vec_col).isNotNull()).select(
        F.col(qid_col).cast("string").alias("qid"), F.col(vec_col).alias("embedding")), "pruned-queries")


def exact_search(index: IvfIndex, queries: DataFrame, k: int, nprobe: int = FIRST_LISTS, qid_col: str = "qid",
                 vec_col: str = "embedding") -> DataFrame:
    """The ``k`` best of all indexed rows for each query, ``(qid, id, score, rank)``, as
    :func:`quarry.operators.knn.knn_search`: ties to the lower id, null query vectors give
    no rows, query ids must be unique."""
    metric = _meta(index)["metric"]
    present = _queries(queries, qid_col, vec_col)
    first, _, rest = _searched(index, present, k, nprobe, materialize(list_radii(index), "radii"))
    return top_k_per_query(first.drop("rank").unionByName(
        shared_search(index, present, k, probes=rest).drop("rank")), k, metric)


def probed_rows(index: IvfIndex, queries: DataFrame, k: int, nprobe: int = FIRST_LISTS, qid_col: str = "qid",
                vec_col: str = "embedding") -> DataFrame:
    """What :func:`exact_search` reads: ``(qid, lists, rows, all_rows)``."""
    present = _queries(queries, qid_col, vec_col)
    radii = materialize(list_radii(index), "radii")
    _, done, rest = _searched(index, present, k, nprobe, radii)
    return done.unionByName(rest).join(radii, "list_id").groupBy("qid").agg(
        F.count(F.lit(1)).alias("lists"), F.sum("n").alias("rows")).crossJoin(
        F.broadcast(radii.agg(F.sum("n").alias("all_rows"))))
