"""Exact search through an index equals the search without one, and skips lists."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators.ivf import build_index
from quarry.operators.knn import knn_search
from quarry.operators.pruned import _bounds, exact_search, list_radii, probed_rows


def frame(spark, groups=20, n=600, dim=6, seed=9):
    r = np.random.default_rng(seed)
    mid = r.normal(size=(groups, dim)) * 10
    m = (mid[r.integers(0, groups, n)] + r.normal(size=(n, dim))).astype(np.float32)
    m[50:90] = m[50]            # equal rows: ties at the k-th place
    m[200] = 0                  # no direction
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id long, embedding array<float>")


def as_queries(df):
    return df.select(F.col("id").cast("string").alias("qid"), "embedding")


def rows(df):
    return sorted((r.qid, r["rank"], r.id, r.score) for r in df.collect())


@pytest.mark.parametrize("metric,k", [("cosine", 5), ("l2", 5), ("l2", 1000)])
def test_equal_to_the_search_of_all_rows(spark, metric, k):
    df = frame(spark)
    index = build_index(df, metric, 20, train_iters=3)
    queries = as_queries(df.where("id % 25 = 0 OR id = 55")).unionByName(
        spark.createDataFrame([("none", None)], "qid string, embedding array<float>"))
    got = exact_search(index, queries, k, 2)
    want = knn_search(df, queries, k, metric)
    got, want = rows(got), rows(want)
    np.testing.assert_allclose([r[3] for r in got], [r[3] for r in want], rtol=1e-9, atol=1e-9)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    if metric == "l2":      # cosines of equal rows may differ in the last bits without an index
        assert [r[2] for r in got] == [r[2] for r in want]
    if k == 5:
        seen = probed_rows(index, queries, k, 2).agg(F.sum("rows"), F.sum("all_rows")).first()
        assert seen[0] < 0.6 * seen[1]


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_bounds_hold_for_every_member(spark, metric):
    r = np.random.default_rng(2)
    q, c = r.normal(size=(30, 5)), r.normal(size=(4, 5))
    x = np.concatenate([c + r.normal(size=(4, 5)) * s for s in (0.1, 1, 3)])
    if metric == "cosine":
        q, c, x = (m / np.linalg.norm(m, axis=1)[:, None] for m in (q, c, x))
        x[5] = q[3] = 0
    lists = np.arange(len(x)) % 4
    radius = np.array([np.linalg.norm(x[lists == i] - c[i], axis=1).max() for i in range(4)])
    least, most = _bounds(q, c, radius, metric)
    cost = -(q @ x.T) if metric == "cosine" else ((q[:, None] - x[None]) ** 2).sum(axis=2)
    assert (least[:, lists] <= cost).all() and (cost <= most[:, lists]).all()


def test_radii_and_codes(spark):
    df = frame(spark)
    index = build_index(df, "l2", 8, train_iters=1)
    c = {r.list_id: np.array(r.centroid) for r in index.centroids.collect()}
    far = {}
    for r in index.postings.collect():
        far.setdefault(r.list_id, []).append(np.linalg.norm(np.array(r.embedding) - c[r.list_id]))
    for r in list_radii(index).collect():
        assert r.n == len(far[r.list_id]) and abs(r.radius - max(far[r.list_id])) < 1e-9
    with pytest.raises(ValueError):
        exact_search(build_index(df, "l2", 8, 3, 2, train_iters=0), as_queries(df), 3)
