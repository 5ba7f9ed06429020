"""Building, adding to, rebuilding and searching an index without losing rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from quarry.operators.chunking import chunk_corpus
from quarry.operators.ivf import build_index, load_index
from quarry.operators.knn import knn_search
from quarry.operators.search import ivf_search
from quarry.plans.pipeline import (evaluate, index_chunks, model_embedder, preprocess, round_doubles,
                                   run_queries)
from quarry.session import scratch_path
from quarry.sources.tables import read_benchmark_queries, read_documents, read_embeddings
from quarry.operators.truth import derive_truth
from quarry.streaming.append import append_batch, start_append_stream


def vectors(spark, n=300, dim=8, first=0, step=1, seed=1):
    m = np.random.default_rng(seed).normal(size=(n, dim))
    return spark.createDataFrame([(first + i * step, [float(x) for x in r]) for i, r in enumerate(m)],
                                 "id long, embedding array<float>")


def folder(spark, df, parts):
    path = scratch_path(spark, "arrivals")
    df.repartition(parts).write.parquet(path)
    return path


def test_two_streams_add_up(spark):
    path = scratch_path(spark, "idx")
    build_index(vectors(spark), "cosine", 8, train_iters=2, path=path)
    for first in (1000, 2000):
        src = folder(spark, vectors(spark, 90, first=first, seed=first), 3)
        for _ in range(2):          # a second run of the same stream adds nothing
            start_append_stream(spark, src, vectors(spark, 1).schema, path, max_files_per_trigger=1).awaitTermination()
    index = load_index(spark, path)
    assert index.postings.count() == index.meta.first().ntotal == 480
    assert index.postings.select("id").distinct().count() == 480
    with pytest.raises(ValueError):         # an id that is there already
        append_batch(path, vectors(spark, 1, first=1000), "again")


def test_rebuild_replaces_added_postings(spark):
    path = scratch_path(spark, "idx")
    build_index(vectors(spark), "cosine", 8, train_iters=1, path=path)
    append_batch(path, vectors(spark, 50, first=1000), "more")
    assert load_index(spark, path).meta.first().ntotal == 350
    build_index(vectors(spark, 200), "cosine", 8, train_iters=1, path=path)
    assert load_index(spark, path).postings.count() == 200


def test_sparse_ids_and_bounds(spark):
    sparse = vectors(spark, first=1_000_000, step=3)
    index = build_index(sparse, "cosine", 8, train_iters=2, n_train=100)
    assert index.meta.first().n_train == 100 and index.postings.count() == 300
    assert build_index(sparse, "cosine", 8, train_iters=1).meta.first().n_train == 300
    with pytest.raises(ValueError):
        build_index(sparse, "cosine", 1024, train_iters=1)
    assert build_index(sparse, "cosine", 1024, train_iters=1, adaptive=True).meta.first().nlist == 37
    for bits in (0, 9):
        with pytest.raises(ValueError):
            build_index(sparse, "cosine", 8, pq_m=2, pq_bits=bits)
    nulls = sparse.unionByName(spark.createDataFrame([(5, None)], sparse.schema))
    assert build_index(nulls, "cosine", 8, train_iters=1).meta.first().ntotal == 300


def test_repeated_query_ids_are_refused_or_resolved(spark):
    v = vectors(spark, 20)
    q = v.select(F.lit("a").alias("qid"), "embedding").limit(2)
    index = build_index(v, "cosine", 2, train_iters=1)
    for search in (lambda: knn_search(v, q, 3), lambda: ivf_search(index, q, 3)):
        with pytest.raises(ValueError):
            search()
    docs = spark.createDataFrame([(i, str(i), f"word{i} common text") for i in range(6)],
                                 "doc_id long, source_name string, text string")
    queries = spark.createDataFrame([("1", "word2"), ("1", "word4"), ("2", "word3")], "qid string, query string")
    run = run_queries(preprocess(docs), queries, 64, 1, 3)
    assert {r.qid: r.response for r in run.responses.collect()} == {"1": ["4"], "2": ["3"]}


def test_null_and_repeated_keys_keep_their_text(spark):
    docs = spark.createDataFrame([(1, "a", "x one"), (1, "b", "y two"), (None, "c", "n"), (2, "d", "z"), (2, "d", "z")],
                                 "doc_id long, source_name string, text string")
    rows = chunk_corpus(docs).collect()
    assert sorted(r.chunk_id for r in rows) == list(range(5))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in rows) == [
        (False, 1, "x one"), (False, 1, "y two"), (False, 2, "z"), (False, 2, "z"), (True, 0, "n")]


def test_unprobed_buckets_are_not_read(spark):
    index = build_index(read_embeddings(spark, SF01), "cosine", 1024, train_iters=0, adaptive=True)
    q = read_embeddings(spark, SF01).limit(1).select(F.col("id").cast("string").alias("qid"), "embedding")
    plan = ivf_search(index, q, 5, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "list_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "Join" not in plan


def _letters():
    def embed(texts):
        return np.array([[t.count(c) for c in "acst"] for t in texts], dtype=np.float32)
    return embed


def test_user_model_from_build_to_evaluation(spark):
    docs = spark.createDataFrame([(i, f"doc{i}", f"Page {i} tells of {'cats' if i % 2 else 'dogs'}") for i in range(10)],
                                 "doc_id long, source_name string, text string")
    chunks, embedder = preprocess(docs), model_embedder(_letters, 4)
    index = index_chunks(chunks, pq_m=None, nlist=2, train_iters=2, embedder=embedder)
    queries = spark.createDataFrame([("1", "cats")], "qid string, query string")
    for idx in (None, index):
        run = run_queries(chunks, queries, k=3, candidates=5, index=idx, nprobe=2, embedder=embedder)
        assert run.hits.count() == 3
        assert {int(s[3:]) % 2 for s in run.responses.first().response} == {1}
    truth = spark.createDataFrame([("1", "doc1")], "qid string, relevant string")
    assert evaluate(run.responses, truth, 3)[1].first().n_queries == 1


def test_ranking_quality_floor(spark):
    run = run_queries(preprocess(read_documents(spark, SF01)), read_benchmark_queries(spark, SF01), 1024)
    truth = derive_truth(read_documents(spark, SF01), read_benchmark_queries(spark, SF01))
    row = round_doubles(evaluate(run.responses, truth)[1]).first()
    assert (row.precision, row.recall) >= (0.085, 0.625) and abs(row.ndcg - 0.567861) < 1e-6
