"""Exact search against numpy brute force; IVF / PQ index properties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators.ivf import build_index, index_size, load_index
from quarry.operators.knn import knn_search
from quarry.operators.search import ivf_search
from quarry.session import scratch_path
from quarry.sources.tables import read_embeddings
from quarry.streaming.append import append_batch, empty_index_like

from conftest import SF01


@pytest.fixture(scope="module")
def emb(spark):
    df = read_embeddings(spark, SF01)
    rows = df.orderBy("id").collect()
    ids = np.array([r.id for r in rows])
    X = np.array([r.embedding for r in rows], dtype=np.float64)
    return df, ids, X


def _queries(df):
    return df.select(F.col("id").cast("string").alias("qid"), "embedding")


def _brute(ids, X, k, metric):
    if metric == "cosine":
        U = X / np.linalg.norm(X, axis=1, keepdims=True)
        S = U @ U.T
        order = np.lexsort((np.broadcast_to(ids, S.shape), -S), axis=1)
    else:
        D = ((X[:, None, :] - X[None, :, :]) ** 2).sum(-1)
        order = np.lexsort((np.broadcast_to(ids, D.shape), D), axis=1)
    return {str(q): [int(ids[j]) for j in order[i, :k]] for i, q in enumerate(ids)}


def _lists(df):
    out = {}
    for r in df.orderBy("qid", "rank").collect():
        out.setdefault(r.qid, []).append(r.id)
    return out


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_knn_matches_brute_force(spark, emb, metric):
    df, ids, X = emb
    got = _lists(knn_search(df, _queries(df), 10, metric))
    assert got == _brute(ids, X, 10, metric)


def test_knn_multi_block_equals_single(spark, emb):
    df, ids, X = emb
    small = knn_search(df, _queries(df), 5, "cosine", max_broadcast_bytes=64 * 1024)
    assert _lists(small) == _brute(ids, X, 5, "cosine")


def test_knn_rejects_unknown_metric(spark, emb):
    df, _, _ = emb
    with pytest.raises(ValueError):
        knn_search(df, _queries(df), 5, "ip")


def test_ivf_properties(spark, emb):
    df, ids, X = emb
    index = build_index(df, "cosine", 1024, None, train_iters=0, adaptive=True)
    post = index.postings.select("id", "list_id").collect()
    assert sorted(r.id for r in post) == sorted(ids.tolist())      # each id exactly once
    assert index_size(index) == len(ids)
    meta = index.meta.first()
    assert meta.nlist == len(ids) // 8 and meta.ntotal == len(ids)
    exact = _brute(ids, X, 10, "cosine")
    full = _lists(ivf_search(index, _queries(df), 10, nprobe=10_000))
    assert full == exact                                            # full probe == exact
    recalls = []
    for nprobe in (1, 4, 16, meta.nlist):
        got = _lists(ivf_search(index, _queries(df), 10, nprobe))
        recalls.append(np.mean([len(set(got.get(q, [])) & set(v)) / 10 for q, v in exact.items()]))
    assert all(a <= b + 1e-9 for a, b in zip(recalls, recalls[1:]))
    assert recalls[-1] == 1.0


def test_trained_ivfpq_recall_and_persistence(spark, emb):
    df, ids, X = emb
    path = scratch_path(spark, "test-index")
    index = build_index(df, "cosine", 1024, pq_m=16, pq_bits=8, train_iters=10, path=path, adaptive=True)
    again = load_index(spark, path)
    assert again.is_pq and index_size(again) == len(ids)
    assert again.codebooks.count() == 16 * 256
    exact = _brute(ids, X, 10, "cosine")
    got = _lists(ivf_search(again, _queries(df), 10, nprobe=10_000))
    recall = np.mean([len(set(got[q]) & set(v)) / 10 for q, v in exact.items()])
    assert recall >= 0.6


def test_l2_pq_scores_match_reconstruction(spark, emb):
    """ADC for L2 equals the squared distance to the decoded vector."""
    df, ids, X = emb
    index = build_index(df, "l2", 1024, pq_m=8, pq_bits=8, train_iters=0, adaptive=True)
    C = np.array([r.centroid for r in index.centroids.orderBy("list_id").collect()])
    cb = {}
    for r in index.codebooks.collect():
        cb[(r.m, r.code)] = np.array(r.subvector)
    dec = {}
    for r in index.postings.collect():
        codes = np.frombuffer(r.codes, dtype=np.uint8)
        dec[r.id] = C[r.list_id] + np.concatenate([cb[(m, int(c))] for m, c in enumerate(codes)])
    q = _queries(df).where(F.col("qid") == "3")
    got = ivf_search(index, q, 5, nprobe=10_000).orderBy("rank").collect()
    x = X[list(ids).index(3)]
    want = sorted((float(((x - v) ** 2).sum()), i) for i, v in dec.items())[:5]
    assert [r.id for r in got] == [i for _, i in want]
    assert np.allclose([r.score for r in got], [d for d, _ in want])


def test_incremental_add_equals_bulk(spark, emb):
    df, _, _ = emb
    bulk = build_index(df, "cosine", 1024, pq_m=8, train_iters=0, adaptive=True)
    path = scratch_path(spark, "test-append")
    inc = empty_index_like(bulk, path)
    append_batch(path, df.where(F.col("id") < 200), 0, inc)
    append_batch(path, df.where(F.col("id") >= 200), 1, inc)
    append_batch(path, df.where(F.col("id") >= 200), 1, inc)       # replay: idempotent
    back = load_index(spark, path).postings.select("id", "list_id", "codes")
    want = bulk.postings.select("id", "list_id", "codes")
    assert back.count() == want.count()
    assert back.exceptAll(want).count() == 0


def test_ivf_multi_block_equals_single(spark, emb):
    df, _, _ = emb
    index = build_index(df, "cosine", 1024, pq_m=8, train_iters=0, adaptive=True)
    q = _queries(df).where(F.col("id") < 60)
    one = _lists(ivf_search(index, q, 5, nprobe=4))
    many = _lists(ivf_search(index, q, 5, nprobe=4, max_broadcast_bytes=64 * 1024 // 8))
    assert one == many and len(one) == 60


def test_index_invariant_under_repartitioning(spark, emb):
    df, _, _ = emb
    a = build_index(df.repartition(3), "cosine", 1024, pq_m=8, train_iters=2, adaptive=True)
    b = build_index(df.repartition(7, "id"), "cosine", 1024, pq_m=8, train_iters=2, adaptive=True)
    pa_ = a.postings.select("id", "list_id", "codes")
    pb_ = b.postings.select("id", "list_id", "codes")
    assert pa_.count() == pb_.count() and pa_.exceptAll(pb_).count() == 0


def test_spark_ml_engine_and_random_sample(spark, emb):
    from quarry.operators.ivf import train_centroids, training_sample
    df, ids, _ = emb
    sample = training_sample(df, 300, mode="random", seed=7)
    n = sample.count()
    assert 150 < n < 450 and n < len(ids)
    cents = train_centroids(sample, 16, "cosine", train_iters=5, engine="ml").collect()
    assert 1 <= len(cents) <= 16
    assert sorted(c.list_id for c in cents) == list(range(len(cents)))
    assert all(abs(np.linalg.norm(c.centroid) - 1) < 1e-5 for c in cents)


def test_ivf_flat_l2_full_probe_is_exact(spark, emb):
    df, ids, X = emb
    index = build_index(df, "l2", 1024, None, train_iters=3, adaptive=True)
    got = _lists(ivf_search(index, _queries(df), 10, nprobe=10_000))
    assert got == _brute(ids, X, 10, "l2")
