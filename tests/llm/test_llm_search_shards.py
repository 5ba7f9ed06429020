"""MaxScore and the external shuffle, against brute force; the pipeline."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF001
from quarry.llm import common, maxscore
from quarry.llm.common import scratch_path
from quarry.llm.sharding import SHARDS, fisher_yates, op4_external_shuffle, rendezvous_shard, shuffle_shards


def test_postings_equal_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n, d = rng.integers(1, 200), rng.integers(0, 40)
        w = rng.integers(-50, 50, (n, d)) if rng.random() < 0.7 else rng.integers(-2, 2, (n, d))
        w = w * (1 << 30) if rng.random() < 0.1 else w
        ids, q = rng.permutation(n).astype(np.int64), rng.integers(-20, 20, d).astype(np.int64)
        score, found = maxscore.Postings(ids, w).search(q, 0, 5, -np.inf)
        want = sorted((-int(s), int(i)) for s, i in zip(w @ q, ids) if i)[:5]
        assert [(-int(s), int(i)) for s, i in zip(score, found)] == want


def test_essential_terms_follow_the_floor():
    span = np.array([100.0 - 5 * t for t in range(21)])         # 20 terms, spread 5 each
    assert [maxscore.essential(-40.0, span, f) for f in (-np.inf, -40.0, -39.0, 0.0, 10.5, 20.5, 1000.0)] == [20, 20, 20, 13, 10, 8, 8]
    rng = np.random.default_rng(5)
    for d in (1, 12, 40):
        w, ids = rng.integers(-50, 50, (300, d)), rng.permutation(300).astype(np.int64)
        for q in rng.integers(-20, 20, (10, d)).astype(np.int64):
            every = sorted((-int(s), int(i)) for s, i in zip(w @ q, ids) if i)
            for floor in (-np.inf, float(-every[4][0]), float(-every[40][0])):
                score, found = maxscore.Postings(ids, w).search(q, 0, 5, floor)
                assert [(-int(s), int(i)) for s, i in zip(score, found)] == every[:5]


def test_search_rows(spark, monkeypatch):
    rng = np.random.default_rng(2)
    vecs = [(int(i), [float(x) for x in rng.integers(-3, 4, 6) / 2]) for i in range(0, 500, 5)]
    bad = [(100, None), (700, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (800, [float("nan")] * 6), (900, [float("inf")] * 6), (None, [1.0] * 6), (1000, [])]
    df = spark.createDataFrame([(i, v, "s", 1) for i, v in vecs + bad[1:]], "vec_id long, embedding array<double>, score string, rank int")
    whole = maxscore.whole_vectors(df, "vec_id", "embedding")
    queries = whole.where("id % 100 = 0")

    def want():
        ok = {i: [int(np.floor(1024 * x)) for x in v] for i, v in vecs}
        out = []
        for q in [i for i in ok if i % 100 == 0]:
            best = sorted((-sum(a * b for a, b in zip(ok[q], ok[c])), c) for c in ok if c != q)[:10]
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(best)]
        return sorted(out)

    assert sorted(map(tuple, maxscore.top_k_search(whole, queries).collect())) == want()
    assert sorted(map(tuple, maxscore.top_k_search(whole, queries, block_bytes=400).collect())) == want()
    monkeypatch.setattr(maxscore, "POSTINGS_ROWS", 7)
    assert maxscore.top_k_search(whole.where("false"), whole.where("false")).count() == 0
    with pytest.raises(ValueError):
        maxscore.top_k_search(whole, queries.unionByName(queries.selectExpr("id", "reverse(w) AS w")))


def test_search_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF001}/embeddings.parquet'")
    want = sorted(con.execute("SELECT query_id, rank, vec_id, score FROM (" + maxscore.ORACLE_OP2 + ")").fetchall())
    assert sorted(map(tuple, maxscore.op2_maxscore(spark, SF001).select("query_id", "rank", "vec_id", "score").collect())) == want


def test_shards_hold_all_records(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 20)
    rows = [(k if k % 5 else None, "t%d é" % k if k % 7 else None, "c", k) for k in range(300)] + [(9, "same", "c", 0)] * 200
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string, slot long")
    out = shuffle_shards(df, scratch_path(spark, "t"), bucket_bytes=200)
    got = out.collect()
    assert sorted([tuple(r[:4]) for r in got], key=repr) == sorted(rows, key=repr)
    slots = {}
    for r in got:
        slots.setdefault(r["_shard"], []).append(r["_slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = shuffle_shards(df.repartition(5), scratch_path(spark, "t"), bucket_bytes=200)
    place = lambda d: sorted([tuple(r) for r in d.collect()], key=repr)
    assert place(again) == place(out)           # a function of the rows, not of their order
    assert shuffle_shards(df.where("false"), scratch_path(spark, "t")).count() == 0
    with pytest.raises(ValueError):
        shuffle_shards(df.withColumnRenamed("slot", "_slot"), scratch_path(spark, "t"))


def test_number_hot_copies(spark):
    df = spark.createDataFrame([(1, "a")] * 30 + [(2, "b")] * 3, "doc_id long, text string")
    got = sorted(tuple(r) for r in common.number_hot_copies(df, "n", 10).collect())
    assert got == sorted([(1, "a", k) for k in range(30)] + [(2, "b", 0)] * 3)


def test_growing_takes_only_into_the_new_shard(spark):
    df = spark.range(5000).select("id", rendezvous_shard(F.col("id"), SHARDS).alias("a"),
                                  rendezvous_shard(F.col("id"), SHARDS + 1).alias("b"))
    rows = df.collect()
    assert all(r.b in (r.a, SHARDS) for r in rows) and {r.a for r in rows} == set(range(SHARDS))
    assert 100 < sum(r.a != r.b for r in rows) < 320


def test_shuffle_query(spark):
    rows = op4_external_shuffle(spark, SF001).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    import zlib
    assert len(rows) == len(docs)
    for r in rows:
        raw = (docs[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 8, zlib.crc32(raw), "key")
    assert fisher_yates.__doc__


def test_pipeline_stages_and_run(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "simhash_near_dedup", "substring_dedup", "pii", "best_fit_packing"]
    step, ids = docs, None
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, step, SF001)
        if k < 4:
            assert out.columns == docs.columns
            now = {r.doc_id for r in out.select("doc_id").collect()}
            assert ids is None or now <= ids
            ids = now
        step = common.materialize(out, "test-stage")
    assert {r.doc_id for r in step.collect()} == ids
    key = lambda d: sorted(tuple(r) for r in d.select("doc_id", "piece", "length", "ids_crc32").collect())
    assert key(entry.queries()["pipeline"](spark, SF001)) == key(step)
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        empty = common.materialize(stage(spark, empty, SF001), "test-empty")
        assert empty.count() == 0


def test_queries_are_registered():
    names = set(entry.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
