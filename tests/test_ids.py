"""Dense ids from the two-level prefix sum equal a global running sum."""

import random

from quarry.operators.chunking import chunk_corpus
from quarry.operators.ids import chunk_manifest, dense_offsets, dense_row_ids
from quarry.sources.tables import read_documents

from conftest import SF001


def test_dense_offsets_match_cumsum(spark):
    rnd = random.Random(1)
    rows = [(k, rnd.randint(0, 5)) for k in rnd.sample(range(10_000), 500)]
    df = spark.createDataFrame(rows, "k long, n long")
    expect, acc = {}, 0
    for k, n in sorted(rows):
        expect[k] = acc
        acc += n
    for parts in (1, 3, 16):
        got = {r.k: r.base for r in dense_offsets(df, "k", "n", parts).collect()}
        assert got == expect


def test_dense_row_ids(spark):
    df = spark.createDataFrame([(f"n{i:03d}",) for i in range(50)][::-1], "name string")
    got = sorted((r.row_id, r.name) for r in dense_row_ids(df, "name").collect())
    assert got == [(i, f"n{i:03d}") for i in range(50)]


def test_chunk_ids_dense_and_ordered(spark):
    chunks = chunk_corpus(read_documents(spark, SF001)).collect()
    ids = sorted(c.chunk_id for c in chunks)
    assert ids == list(range(len(ids)))
    order = sorted(chunks, key=lambda c: (c.doc_id, c.chunk_idx))
    assert [c.chunk_id for c in order] == ids
    n = chunk_manifest(spark.createDataFrame(chunks)).first().n_chunks
    assert n == len(chunks)


def test_truth_pattern_blocks_equal_single(spark):
    """Passages above the broadcast cap are scanned in several blocks; the
    result equals one block and a plain-Python containment check."""
    from quarry.operators.truth import derive_truth
    from quarry.sources.tables import read_benchmark_queries
    docs = read_documents(spark, SF001)
    queries = read_benchmark_queries(spark, SF001)
    one = sorted(tuple(r) for r in derive_truth(docs, queries).collect())
    many = sorted(tuple(r) for r in derive_truth(docs, queries, max_broadcast_bytes=2048).collect())
    assert one == many
    d = {r.source_name: " ".join(r.text.split()) for r in docs.collect()}
    q = {r.qid: " ".join(r.query.split()) for r in queries.collect()}
    want = sorted((qi, name) for qi, p in q.items() for name, t in d.items() if p in t)
    assert one == want
