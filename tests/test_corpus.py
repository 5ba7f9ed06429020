"""Chunk ids over several loads, and documents added to an index."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from quarry.operators.chunking import chunk_corpus
from quarry.operators.corpus import add_chunks, read_corpus, read_loads, reserve_ids
from quarry.operators.ivf import index_size
from quarry.plans.pipeline import add_documents
from quarry.sources.tables import read_documents
from quarry.streaming.append import read_ids

from conftest import SF001


def _rows(df):
    return sorted(tuple(r) for r in df.select("chunk_id", "doc_id", "chunk_idx", "text").collect())


def test_loads_equal_one_load(spark, tmp_path):
    docs = read_documents(spark, SF001)
    path = str(tmp_path / "c")
    parts = [docs.where("doc_id < 70"), docs.where("false"), docs.where("doc_id >= 70 AND doc_id < 71"), docs.where("doc_id > 70")]
    for k, part in enumerate(parts):
        add_chunks(part, path, f"load{k}")
    whole = _rows(chunk_corpus(docs))
    assert _rows(read_corpus(spark, path)) == whole
    # a retry keeps ids and rows; other documents under the same name are refused
    again = add_chunks(parts[0], path, "load0")
    assert _rows(again) == [r for r in whole if r[1] < 70] and _rows(read_corpus(spark, path)) == whole
    with pytest.raises(ValueError):
        add_chunks(parts[3], path, "load0")
    with pytest.raises(ValueError):
        add_chunks(parts[3], path, "../x")
    assert _rows(read_corpus(spark, path)) == whole
    loads = sorted(read_loads(spark, path).collect())
    assert [r.load for r in loads] == ["load0", "load1", "load2", "load3"] and loads[1].n == 0
    assert sum(r.n for r in loads) == len(whole)


def test_repeated_and_null_keys_go_on(spark, tmp_path):
    rows = [(1, "a", "x y"), (1, "b", "z"), (None, "c", "u v"), (None, None, None), (2, "d", " ")]
    docs = spark.createDataFrame(rows, "doc_id long, source_name string, text string")
    path = str(tmp_path / "c")
    for load in ("a", "b"):
        add_chunks(docs, path, load)
    got = read_corpus(spark, path).collect()
    assert sorted(r.chunk_id for r in got) == list(range(6))
    assert {r.load for r in got if r.chunk_id < 3} == {"a"}


def test_loads_side_by_side_get_ranges_of_their_own(spark, tmp_path):
    path = str(tmp_path / "c")
    with ThreadPoolExecutor(4) as pool:
        firsts = list(pool.map(lambda k: reserve_ids(spark, path, f"l{k}", 10), range(8)))
    assert sorted(firsts) == list(range(0, 80, 10))
    assert reserve_ids(spark, path, "l3", 10) == firsts[3]


def test_added_documents_are_found(spark, tmp_path):
    docs = read_documents(spark, SF001)
    path = str(tmp_path / "c")
    options = dict(dim=64, nlist=4, pq_m=None, train_iters=0)
    for load, part in (("one", "doc_id < 90"), ("two", "doc_id >= 90"), ("two", "doc_id >= 90"), ("one", "doc_id < 90")):
        index = add_documents(docs.where(part), path, load, **options)
    chunks = read_corpus(spark, path)
    assert index_size(index) == chunks.count() == index.postings.select("id").distinct().count()
    assert index.postings.join(chunks, index.postings.id == chunks.chunk_id, "left_anti").count() == 0
    added = {r.id for r in read_ids(spark, f"{path}/index").where("batch_id = 'two'").collect()}
    assert added == {r.chunk_id for r in chunks.where("load = 'two'").collect()}
