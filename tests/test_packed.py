"""Packed vectors and the vectorised steps of the default index: same rows, fewer passes."""

import random
from hashlib import md5

import numpy as np
import pyarrow as pa
import pytest

from quarry.functions import vectors as V
from quarry.functions.text import WHITESPACE_CHARS, chunk_texts, clean_text, word_windows
from quarry.operators.chunking import chunk_documents, document_chunk_counts
from quarry.operators.embed import hash_embed, hash_embed_sparse, normalize
from quarry.operators.ivf import build_index
from quarry.operators.kmeans import Grid, packed_extent
from quarry.plans import pipeline as P


@pytest.mark.parametrize("dim", [1, 7, 32, 33, 100])
def test_packed_rows_come_back_bit_by_bit(dim):
    rng = np.random.default_rng(dim)
    m = rng.normal(size=(40, dim)).astype(np.float32)
    m[rng.random(m.shape) < 0.8] = 0
    m[3], m[5, 0], m[6, 0] = 0, -0.0, np.nan
    packed = V.pack_rows(m)
    assert (V.unpack_rows(packed).view(np.uint32) == m.view(np.uint32)).all()
    assert np.array_equal(V.unpack_rows(packed.slice(10, 20), np.float64), m[10:30], equal_nan=True)
    x, valid = V.list_column_matrix(packed.take(pa.array([1, None, 2])))
    assert np.array_equal(x, m[[1, 2]]) and valid.tolist() == [True, False, True]
    assert V.list_column_matrix(V.pack_rows(m[:0]))[0].shape == (0, 0)
    if dim > 1:
        with pytest.raises(ValueError, match="different lengths"):
            V.unpack_rows(pa.concat_arrays([packed, V.pack_rows(m[:, 1:])]))


def test_word_buckets_are_those_of_md5():
    random.seed(1)
    words = ["".join(random.choices("aßé漢x9-", k=random.randint(0, 40))) for _ in range(3000)] + ["x" * n for n in range(130)]
    want = [int(md5(w.encode()).hexdigest()[:8], 16) % 997 for w in words]
    assert V.word_buckets(pa.array(words), 997).tolist() == want


def test_word_counts_are_those_of_split():
    random.seed(6)
    texts = ["".join(random.choices(letters + WHITESPACE_CHARS[:10] + wide, k=random.randint(0, 30)))
             for letters in ("ab", "é漢x") for wide in ("", "\u2003\x85\xa0") for _ in range(300)]
    arr = pa.array([None if t == "a" else t.encode() for t in ["", "a", *texts, ""]], pa.binary())
    want = [len((t or b"").decode().split()) for t in arr.to_pylist()]
    assert V.word_counts(arr).tolist() == want and V.word_counts(arr.slice(5, 40)).tolist() == want[5:45]
    assert V.word_counts(arr.slice(0, 0)).tolist() == [] and V.word_counts(pa.array([b"a\xff b"])).tolist() == [2]


def test_embedding_equals_its_sparse_form(spark):
    random.seed(2)
    texts = ["".join(random.choices("ab é" + WHITESPACE_CHARS, k=random.randint(0, 60))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate([*texts, "", " ", "\n", None, "a᠎b"])), "chunk_id long, text string")
    want = {}
    for r in hash_embed_sparse(df, dim=32).collect():
        want.setdefault(r.chunk_id, np.zeros(32))[r.bucket] = r.n
    for packed in (False, True):
        got = hash_embed(df, dim=32, packed=packed).toArrow()
        x, _ = V.list_column_matrix(got.column("embedding"))
        assert len(x) == 205 and all((v == want.get(i, 0)).all() for i, v in zip(got.column("chunk_id").to_pylist(), x))


def test_windows_equal_the_expression(spark):
    random.seed(3)
    texts = ["".join(random.choices("abc" + WHITESPACE_CHARS, k=n)) for n in range(80)]
    df = spark.createDataFrame([(i, str(i), t) for i, t in enumerate([*texts, None])], "doc_id long, source_name string, text string")
    for size, overlap in ((4, 1), (3, 5), (100, 10)):
        want = {(r.doc_id, i): t for r in df.where(clean_text("text") != "").select(
            "doc_id", chunk_texts(clean_text("text"), size, overlap).alias("c")).collect() for i, t in enumerate(r.c)}
        got = {(r.doc_id, r.chunk_idx): r.text for r in chunk_documents(df, size, overlap).collect()}
        assert got == want and list(word_windows([], size, overlap)) == []
        counts = {r.doc_id: r.n for r in document_chunk_counts(df, size, overlap).collect()}
        assert counts == {d: sum(k[0] == d for k in want) for d, _ in want}


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_packed_vectors_make_the_same_index(spark, metric):
    rng = np.random.default_rng(4)
    x = rng.poisson(0.3, size=(400, 40)).astype(np.float32)
    x[7] = x[3]                                                 # equal vectors among the first centres
    emb = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, embedding array<float>")
    packed = V.pack_vectors(emb, "embedding")
    assert packed_extent(packed.repartition(3)) == (400, 40, x.max()) and Grid.of(packed, metric) == Grid.of(emb, metric)
    one, two = (build_index(df, metric, 12, 8, 4, train_iters=4) for df in (emb, packed))
    for a, b, keys in ((one.centroids, two.centroids, ["list_id"]), (one.codebooks, two.codebooks, ["m", "code"]),
                       (one.postings.select("id", "list_id", "codes"), two.postings.select("id", "list_id", "codes"), ["id"]),
                       (one.meta, two.meta, ["nlist"])):
        assert a.orderBy(*keys).collect() == b.orderBy(*keys).collect()
    with pytest.raises(ValueError, match="product codes"):
        build_index(packed, metric, 12)


def test_default_index_writes_its_vectors_once(spark, monkeypatch):
    """Before, the training sample was a second copy of all vectors, number by number."""
    from quarry.operators import ivf
    written = []
    for module in (P, ivf):
        keep = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, name, keep=keep: written.append(
            (name, dict(df.dtypes).get("embedding"))) or keep(df, name))
    rng = np.random.default_rng(5)
    chunks = spark.createDataFrame([(i, " ".join(f"w{w}" for w in rng.integers(0, 90, 30))) for i in range(300)],
                                   "chunk_id long, text string")
    index = P.index_chunks(chunks, 64, nlist=8, pq_m=8, pq_bits=4, train_iters=2, adaptive=False)
    assert written == [("embedded", "binary"), ("ivf-codes", None)]
    plain = build_index(normalize(P.build_flat_corpus(chunks, 64)), "cosine", 8, 8, 4, train_iters=2)
    assert plain.postings.select("id", "list_id", "codes").orderBy("id").collect() == \
        index.postings.select("id", "list_id", "codes").orderBy("id").collect()
