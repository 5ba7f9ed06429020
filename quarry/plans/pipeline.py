"""The reference's four commands as DataFrame pipelines:

* :func:`preprocess` -- corpus -> chunk table with dense ids (written once);
* :func:`build_flat_corpus` -- chunk table -> embeddings (the uncompressed index);
* :func:`run_queries` -- queries -> candidates -> (rerank | cut) -> roll-up ->
  responses, all queries in one job;
* :func:`evaluate` -- responses x truth -> per-query metrics and summary.

* :func:`index_chunks` -- chunk table -> IVF / IVF-PQ index (the ``index`` command);
* :func:`add_documents` -- more documents into a corpus and its index.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..functions.text import DEFAULT_CHUNK_OVERLAP, DEFAULT_CHUNK_WORDS
from ..operators.chunking import chunk_corpus
from ..operators.corpus import add_chunks, read_loads
from ..operators.embed import DEFAULT_HASH_DIM, hash_embed, model_embed, normalize
from ..operators.evaluate import metrics_per_query, metrics_summary
from ..operators.ivf import (DEFAULT_NLIST, DEFAULT_NPROBE, DEFAULT_PQ_BITS, IvfIndex,
                             build_index, load_index)
from ..operators.knn import knn_search
from ..operators.search import ivf_search
from ..operators.results import cut_candidates, query_responses, rollup_documents
from ..session import materialize, path_exists
from ..streaming.append import append_batch

# The reference's retrieval defaults.
DEFAULT_TOP_K = 10
DEFAULT_CANDIDATES = 100
# Sub-spaces of the default index; divides the default embedding width.
DEFAULT_PQ_M = 64

# ``embedder(df, text_col, id_col) -> (id_col, embedding array<float>)``, used for
# chunks and queries alike.  ``model_embedder`` wraps a user model.
Embedder = Callable[[DataFrame, str, str], DataFrame]


def hash_embedder(dim: int = DEFAULT_HASH_DIM, packed: bool = False) -> Embedder:
    return lambda df, text_col, id_col: hash_embed(df, text_col, id_col, dim, packed=packed)


def model_embedder(model_loader: Callable, dim: int, **options) -> Embedder:
    """An embedder from ``model_loader() -> fn(list[str]) -> (n, dim) array``."""
    return lambda df, text_col, id_col: model_embed(df, model_loader, dim, text_col, id_col, **options)


@dataclass
class RetrievalRun:
    chunks: DataFrame
    embedded: DataFrame
    queries: DataFrame
    candidates: DataFrame
    hits: DataFrame
    documents: DataFrame
    responses: DataFrame


def preprocess(docs: DataFrame, chunk_words: int = DEFAULT_CHUNK_WORDS,
               overlap: int = DEFAULT_CHUNK_OVERLAP, persist: bool = True) -> DataFrame:
    """Corpus ``(doc_id, source_name, text)`` -> chunk table, written to the
    checkpoint folder (it is read by embedding, lookups and roll-up)."""
    chunks = chunk_corpus(docs, chunk_words, overlap)
    return materialize(chunks, "chunks") if persist else chunks


def build_flat_corpus(chunks: DataFrame, dim: int = DEFAULT_HASH_DIM,
                      embedder: Embedder | None = None, packed: bool = False) -> DataFrame:
    """Chunk table -> ``(id, embedding)``, by default with the hashing embedder; ``packed``
    vectors (``functions/vectors.py``), none null, for an index with product codes."""
    embedder = embedder or hash_embedder(dim, packed)
    vectors = embedder(chunks, "text", "chunk_id").withColumnRenamed("chunk_id", "id")
    return V.pack_vectors(vectors, "embedding") if packed else vectors


def embed_queries(queries: DataFrame, dim: int = DEFAULT_HASH_DIM,
                  embedder: Embedder | None = None) -> DataFrame:
    return (embedder or hash_embedder(dim))(queries, "query", "qid")


def index_chunks(chunks: DataFrame, dim: int = DEFAULT_HASH_DIM, metric: str = "cosine",
                 nlist: int = DEFAULT_NLIST, pq_m: int | None = DEFAULT_PQ_M,
                 pq_bits: int = DEFAULT_PQ_BITS, n_train: int | None = None,
                 train_iters: int = 20, seed: int = 42, path: str | None = None,
                 embedder: Embedder | None = None, adaptive: bool = True,
                 engine: str = "lloyd") -> IvfIndex:
    """The ``index`` command: embed every chunk (hashing, or the given
    ``embedder``), L2-normalise (P6), train -- on all vectors, or the first
    ``n_train`` -- and add all chunks; product codes unless ``pq_m`` is None."""
    vectors = build_flat_corpus(chunks, dim, embedder, packed=bool(pq_m) and engine == "lloyd")
    if metric == "cosine":
        vectors = normalize(vectors)
    # embed once: the build reads the vectors for statistics, the training
    # and the assignment pass
    vectors = materialize(vectors, "embedded")
    return build_index(vectors, metric, nlist, pq_m, pq_bits, n_train, train_iters, seed, path,
                       adaptive=adaptive, engine=engine)


def add_documents(docs: DataFrame, path: str, load: str, dim: int = DEFAULT_HASH_DIM,
                  chunk_words: int = DEFAULT_CHUNK_WORDS, overlap: int = DEFAULT_CHUNK_OVERLAP,
                  embedder: Embedder | None = None, **build) -> IvfIndex:
    """Add ``docs`` as ``load`` to the corpus at ``path`` (``operators.corpus``) and its
    chunks to the index in ``path/index``; the first load builds and trains the index
    (``build``: options of :func:`index_chunks`), later ones are encoded with its
    parameters.  A load that failed is run again under its name; one that is done
    changes nothing when run again."""
    spark = docs.sparkSession
    chunks = add_chunks(docs, path, load, chunk_words, overlap)
    target = f"{path}/index"
    founder = read_loads(spark, path).where("n > 0").orderBy("number").first()
    if founder is None:
        raise ValueError("the first load has no chunks to train an index on")
    if load == founder["load"]:
        # postings are written last
        if not path_exists(spark, f"{target}/postings/_SUCCESS"):
            index_chunks(chunks, dim, path=target, embedder=embedder, **build)
        return load_index(spark, target)
    index = load_index(spark, target)
    vectors = build_flat_corpus(chunks, dim, embedder)
    if index.meta.first()["metric"] == "cosine":
        vectors = normalize(vectors)
    append_batch(target, materialize(vectors, "embedded"), load, index)
    return load_index(spark, target)


def run_queries(chunks: DataFrame, queries: DataFrame, dim: int = DEFAULT_HASH_DIM,
                k: int = DEFAULT_TOP_K, candidates: int = DEFAULT_CANDIDATES,
                embedded: DataFrame | None = None, reranker=None,
                index: IvfIndex | None = None, nprobe: int = DEFAULT_NPROBE,
                k_documents: bool = False, embedder: Embedder | None = None) -> RetrievalRun:
    """Retrieval of ``candidates`` chunks per query -- exact, or through an
    IVF / IVF-PQ ``index`` with ``nprobe`` -- then either the
    ``reranker(queries, candidates, chunks, k)`` or the plain cut to ``k``,
    then the document roll-up and the response lists.

    ``k_documents=True`` rolls all candidates up first and keeps ``k``
    documents (the reference cuts ``k`` chunks first, so it may return fewer)."""
    # one row per query id before anything is searched (the larger text of a
    # repeated id), so that no result mixes two queries
    queries = materialize(queries.groupBy(F.col("qid").cast("string").alias("qid"))
                          .agg(F.max("query").alias("query")), "queries")
    n_queries = queries.count()
    q_emb = embed_queries(queries, dim, embedder)
    if index is not None:
        cands = ivf_search(index, q_emb, candidates, nprobe)
    else:
        embedded = embedded if embedded is not None else build_flat_corpus(chunks, dim, embedder)
        cands = knn_search(embedded, q_emb, candidates, "cosine")
    # every later step reads the candidates; they are searched once
    cands = materialize(cands, "candidates")
    if reranker is not None:
        hits = reranker(queries, cands, chunks, candidates if k_documents else k)
    else:
        hits = cands if k_documents else cut_candidates(cands, k)
    bound = n_queries * (candidates if k_documents else k)
    docs = rollup_documents(hits, chunks, hit_bound=bound)
    if k_documents:
        docs = docs.where(F.col("rank") <= k)
    responses = query_responses(queries, docs)
    return RetrievalRun(chunks, embedded, queries, cands, hits, docs, responses)


def evaluate(responses: DataFrame, truth: DataFrame, k: int = DEFAULT_TOP_K):
    # both sides are used more than once
    responses, truth = materialize(responses, "responses"), materialize(truth, "truth")
    per_query = metrics_per_query(responses, truth, k)
    return per_query, metrics_summary(per_query)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (for comparisons across engines)."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if f.dataType.typeName() == "double" else F.col(f.name)
                       for f in df.schema.fields])
