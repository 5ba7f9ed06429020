"""Streaming add over several micro-batches; reruns are idempotent."""

import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.operators.ivf import build_index, load_index
from quarry.session import scratch_path
from quarry.sources.tables import read_embeddings
from quarry.streaming.append import (append_batch, empty_index_like, id_bucket, look_up_ids, read_ids, read_rejects,
                                      start_append_stream)

from conftest import SF01


def test_stream_batches_and_replay(spark):
    emb = read_embeddings(spark, SF01)
    bulk = build_index(emb, "cosine", 1024, pq_m=8, train_iters=0, adaptive=True)
    src = tempfile.mkdtemp(prefix="quarry-stream-src-", dir="/tmp")
    for i, (lo, hi) in enumerate([(0, 150), (150, 320), (320, 10_000)]):
        emb.where((F.col("id") >= lo) & (F.col("id") < hi)).coalesce(1) \
            .write.parquet(f"{src}/part{i}")
    files = sorted(spark.read.parquet(f"{src}/part*").inputFiles())
    flat = tempfile.mkdtemp(prefix="quarry-stream-flat-", dir="/tmp")
    import shutil
    for j, f in enumerate(files):
        shutil.copy(f.replace("file:", ""), f"{flat}/f{j}.parquet")
    path = scratch_path(spark, "stream-test")
    empty_index_like(bulk, path)
    ckpt = scratch_path(spark, "stream-ckpt")
    schema = emb.schema
    for _ in range(2):                           # second run: nothing new, same result
        q = start_append_stream(spark, flat, schema, path, checkpoint=ckpt,
                                max_files_per_trigger=1)
        q.awaitTermination()
    got = load_index(spark, path).postings
    assert got.select("batch_id").distinct().count() >= 3
    want = bulk.postings.select("id", "list_id", "codes")
    assert got.count() == want.count()
    assert got.select("id", "list_id", "codes").exceptAll(want).count() == 0


def _batch(spark, rows):
    return spark.createDataFrame([(i, v) for i, v in rows], "id long, embedding array<float>")


def _index(spark, n=40):
    path = scratch_path(spark, "ledger")
    vectors = _batch(spark, [(i, [float(i % 7 + 1), float(i % 3), 1.0]) for i in range(n)])
    build_index(vectors, "l2", 4, train_iters=0, path=path)
    return path


def test_rejects_and_replays(spark):
    path = _index(spark)
    v = [1.0, 2.0, 3.0]
    rows = [(100, v), (100, [3.0, 2.0, 1.0]), (100, v), (7, v), (101, None), (None, v), (None, v), (102, v)]
    for _ in range(2):
        append_batch(path, _batch(spark, rows), "a", repeats="reject")
    append_batch(path, _batch(spark, [(102, v), (103, v), (104, v)]), "b", repeats="reject")
    # a replay of the first batch still finds its own rows new, though b came after
    append_batch(path, _batch(spark, rows), "a", repeats="reject")
    got = sorted((r.batch_id, r.id if r.id is not None else -1, r.reason, r.n_rows) for r in read_rejects(spark, path).collect())
    assert got == [("a", -1, "no id", 2), ("a", 7, "stored", 1), ("a", 100, "repeated", 2), ("a", 101, "no vector", 1),
                   ("b", 102, "stored", 1)]
    index = load_index(spark, path)
    ids = sorted(r.id for r in index.postings.select("id").collect())
    assert ids == [*range(40), 100, 102, 103, 104] == sorted(r.id for r in read_ids(spark, path).collect())
    assert index.meta.first().ntotal == 44


def test_refused_batch_changes_nothing(spark):
    path = _index(spark)
    for rows in ([(5, [1.0, 1.0, 1.0])], [(200, [1.0, 1.0, 1.0])] * 2):
        with pytest.raises(ValueError):
            append_batch(path, _batch(spark, rows), "x")
    assert load_index(spark, path).postings.count() == 40 and read_rejects(spark, path).count() == 0
    append_batch(path, _batch(spark, []), "empty", repeats="reject")
    assert read_ids(spark, path).count() == 40


def test_a_batch_reads_its_own_buckets_only(spark):
    path = _index(spark)
    for k in range(4):
        append_batch(path, _batch(spark, [(k * 1_000_000 + 500 + i, [1.0, float(i), 2.0]) for i in range(30)]), f"b{k}")
    new = _batch(spark, [(3_000_600 + i, [1.0, 0.0, 0.0]) for i in range(30)]).select("id")
    found = look_up_ids(spark, path, new, "next")
    files = found._jdf.queryExecution().executedPlan().toString()
    assert "id_bucket" in files.split("PartitionFilters: [")[1].split("]")[0]
    buckets = read_ids(spark, path).select("id_bucket").distinct().count()
    assert new.select(id_bucket()).distinct().count() == 1 < 4 <= buckets
    assert found.count() == 0
    assert look_up_ids(spark, path, new.withColumn("id", F.col("id") - 100), "next").count() == 30


def test_rebuild_starts_a_new_ledger(spark):
    path = _index(spark)
    append_batch(path, _batch(spark, [(500, [1.0, 1.0, 1.0])]), "a", repeats="reject")
    build_index(_batch(spark, [(i, [1.0, float(i), 2.0]) for i in range(10)]), "l2", 2, train_iters=0, path=path)
    append_batch(path, _batch(spark, [(500, [1.0, 1.0, 1.0]), (3, [1.0, 1.0, 1.0])]), "a", repeats="reject")
    assert [(r.id, r.reason) for r in read_rejects(spark, path).collect()] == [(3, "stored")]
    assert load_index(spark, path).postings.count() == 11
