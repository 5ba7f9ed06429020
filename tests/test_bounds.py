"""Searches hold a bounded number of rows and scores, and lose nothing by it."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.functions import vectors as V
from quarry.operators import knn as K
from quarry.operators import search as Q
from quarry.operators import ivf, kmeans
from quarry.operators.ivf import build_index
from quarry.operators.kmeans import nearest, nearest_codes, scores


def all_scores(q, x, metric):
    dot = np.einsum("qd,nd->qn", q, x)
    if metric == "l2":
        return ((q[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    if metric == "cosine":
        den = np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(x, axis=1)[None, :]
        return np.where(den > 0, dot / np.where(den > 0, den, 1), 0.0)
    return dot


@pytest.mark.parametrize("metric", ["cosine", "product", "l2"])
@pytest.mark.parametrize("scale", [1.0, 1e-6, 1e18])
def test_top_rows_are_those_of_all_pairs(metric, scale):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(3000, 6)), 1)
    x[50:400] = x[7]                                # many ties
    x[900] = 0
    q, x = x[::60] * scale, x * scale
    ids = rng.permutation(3000)
    top = V.TopRows(q, 9, metric)
    for at in range(0, 3000, 700):
        top.add(x[at:at + 700], ids[at:at + 700])
        assert top.n <= top.most
    number, found, got = top.result()
    s = all_scores(q, x, metric)
    want = np.sort(s if metric == "l2" else -s, axis=1)[:, :9]
    size = max(1.0, float(np.abs(want).max()))
    assert np.allclose((got if metric == "l2" else -got).reshape(-1, 9) / size, want / size, atol=1e-12)
    # of equal vectors the lower ids
    for i in np.flatnonzero((q == x[7]).all(axis=1)):
        if metric != "product":
            same = ids[(x == x[7]).all(axis=1)]
            assert found.reshape(-1, 9)[i].tolist() == sorted(same.tolist())[:9]


def test_slices_bound_wide_batches():
    m = pa.array(np.arange(5000 * 512, dtype=np.float32).reshape(5000, 512).tolist(), pa.list_(pa.float32()))
    rb = pa.RecordBatch.from_arrays([pa.array(range(5000)), m], names=["id", "v"])
    parts = list(V.slices([rb], "v", 4096))
    assert max(p.num_rows for p in parts) * 4096 * 8 <= V.SLICE_BYTES
    assert [i for p in parts for i in p.column("id").to_pylist()] == list(range(5000))


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_many_queries_meet_the_rows_in_groups(spark, monkeypatch, metric):
    """More queries than a task may hold: groups in a shuffle instead of blocks through
    the driver, for the exact search and for a probe of all lists."""
    monkeypatch.setattr(K, "PART_ANSWERS", 100)
    monkeypatch.setattr(Q, "PART_ANSWERS", 100)
    x = np.random.default_rng(1).normal(size=(300, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, embedding array<float>")
    queries = df.select(F.col("id").cast("string").alias("qid"), "embedding")
    s = all_scores(x.astype(float), x.astype(float), metric)
    order = np.argsort(s if metric == "l2" else -s, axis=1, kind="stable")[:, :5]
    want = {str(i): r.tolist() for i, r in enumerate(order)}
    index = build_index(df, metric, 20, train_iters=0)
    for found in (K.knn_search(df, queries, 5, metric), Q.ivf_search(index, queries, 5, 1 << 30)):
        assert "CoGroup" in found._jdf.queryExecution().executedPlan().toString()
        got = {}
        for r in found.orderBy("qid", "rank").collect():
            got.setdefault(r.qid, []).append(r.id)
        assert got == want


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_nearest_is_exact(metric):
    rng = np.random.default_rng(2)
    c = rng.integers(-2 ** 20, 2 ** 20, size=(40, 6)).astype(float)
    c[30:] = c[:10] + rng.integers(-1, 2, size=(10, 6))     # nearly equal centres
    c[39] = c[5]
    x = np.concatenate([c, rng.integers(-2 ** 20, 2 ** 20, size=(500, 6))])
    assert (nearest(x, c, metric) == np.argmax(scores(x, c, metric), axis=1)).all()


def test_tied_codes_are_scored_once(monkeypatch):
    rng = np.random.default_rng(4)
    rows = rng.integers(-2, 3, size=(700, 8)).astype(float)
    books = np.stack([rows[:64, :4], rows[:64, 4:]])            # many equal codes
    want = np.stack([np.argmax(scores(rows[:, 4 * j:4 * j + 4], books[j], "l2"), axis=1) for j in (0, 1)], axis=1)
    monkeypatch.setattr(kmeans, "scores", None)
    assert (nearest_codes(rows, books) == want).all()


def test_encoding_rounds_only_near_ties(monkeypatch):
    rng = np.random.default_rng(5)
    r = rng.normal(size=(900, 8))
    r[100:200] = r[:100] + rng.choice([0.0, 2e-10], size=(100, 8))
    cb = np.stack([r[:128, :4], r[72:200, 4:]])
    want = np.stack([np.argmin(np.round(V.sq_l2_distances(r[:, 4 * j:4 * j + 4], (r[:, 4 * j:4 * j + 4] ** 2).sum(1), cb[j]), 9),
                               axis=1) for j in (0, 1)], axis=1)
    rounded, plain = [], np.round
    monkeypatch.setattr(ivf.np, "round", lambda x, n: rounded.append(len(x)) or plain(x, n))
    assert (ivf._encode(r, cb) == want).all() and sum(rounded) < 900


def test_wide_rows_add_up_by_label():
    rng = np.random.default_rng(6)
    x, labels = rng.integers(-9, 9, size=(500, 300)).astype(float), rng.integers(0, 7, 500)
    sums, n = np.zeros((9, 300), np.int64), np.zeros(9, np.int64)
    kmeans.add_rows(sums, n, x, labels)
    assert (n == np.bincount(labels, minlength=9)).all()
    assert all((sums[k] == x[labels == k].sum(0)).all() for k in range(9))


def test_slices_are_small():
    rb = pa.RecordBatch.from_arrays([V.matrix_to_list_array(np.zeros((3000, 1024)))], names=["v"])
    assert max(p.num_rows for p in V.slices([rb], "v")) * 1024 * 8 <= 4 << 20


def test_codes_are_made_once_for_the_layout(spark):
    seen = spark.sparkContext.accumulator(0)
    v = spark.createDataFrame([(i, [float(i % 7), float(i % 5), 1.0, float(i)]) for i in range(300)],
                              "id bigint, embedding array<float>")

    def count(batches):
        for rb in batches:
            seen.add(rb.num_rows)
            yield rb

    index = build_index(v.mapInArrow(count, v.schema), "cosine", 4, 2, 4, train_iters=0)
    # the statistics, the sample and one pass of encoding
    assert index.postings.count() == 300 and seen.value == 900
