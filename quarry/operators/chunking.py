"""Documents -> cleaned, overlapping word chunks with dense ids.

Schema of the chunk table:
``chunk_id bigint, doc_id <key>, source_name string, chunk_idx bigint,
chunk_ref string, text string``.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions import text as T
from ..functions import vectors as V
from ..session import materialize, shuffle_partitions
from .ids import bounded_broadcast, dense_offsets_sized

BATCH_LETTERS = 4 << 20     # of the chunks that a task gives out at a time
COUNT_ROWS = 256            # texts whose words are counted at a time


def documents_from_table(docs: DataFrame, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """Table-shaped corpus (e.g. ``documents``): the id doubles as the file name."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.col(id_col).cast("string").alias("source_name"),
                       F.col(text_col).alias("text"))


def clean_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """P1 + P2: normalise whitespace; drop documents that are empty before or
    after cleaning."""
    return (docs.where(T.has_words(text_col))
            .withColumn(text_col, T.clean_text(text_col)))


def _texts(docs: DataFrame, *cols: str) -> DataFrame:
    """``cols`` and the bytes of the texts that aren't null."""
    return docs.where(F.col("text").isNotNull()).select(*cols, F.col("text").cast("string").cast("binary").alias("_t"))


def chunk_documents(docs: DataFrame, chunk_words: int = T.DEFAULT_CHUNK_WORDS,
                    overlap: int = T.DEFAULT_CHUNK_OVERLAP,
                    key: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """P1-P4 without ids: ``(doc_id, source_name, chunk_idx, chunk_ref, text)``
    plus any ``carry`` columns.

    One narrow stage: split, window, explode.  Each document's chunks are generated inside
    the task that read it; nothing is shuffled.  The words are those of the cleaned text:
    Python splits at the white space that ``clean_text`` maps, so a window's words joined by
    spaces are the same text at a fraction of the cost."""
    T.chunk_step(chunk_words, overlap)
    src = _texts(docs, key, "source_name", *carry)
    names = [key, "source_name", *carry]
    schema = StructType([*[src.schema[c] for c in names], StructField("chunk_idx", LongType()),
                         StructField("text", StringType())])

    def out(rb, rows, idx, texts):
        rows = pa.array(rows, pa.int32())
        return pa.RecordBatch.from_arrays([*[rb.column(c).take(rows) for c in names], pa.array(idx, pa.int64()),
                                           pa.array(texts, pa.string())], names=[*names, "chunk_idx", "text"])

    def windows(batches):
        for rb in batches:
            rows, idx, texts, size = [], [], [], 0
            for row, text in enumerate(rb.column("_t")):
                words = text.as_py().decode("utf-8", "replace").split()
                for i, chunk in enumerate(T.word_windows(words, chunk_words, overlap)):
                    rows.append(row)
                    idx.append(i)
                    texts.append(chunk)
                    size += len(chunk)
                    if size > BATCH_LETTERS:
                        yield out(rb, rows, idx, texts)
                        rows, idx, texts, size = [], [], [], 0
            if rows:
                yield out(rb, rows, idx, texts)

    return src.mapInArrow(windows, schema).select(
        *names, "chunk_idx", T.chunk_ref("source_name", "chunk_idx").alias("chunk_ref"), "text")


def document_chunk_counts(docs: DataFrame, chunk_words: int = T.DEFAULT_CHUNK_WORDS,
                          overlap: int = T.DEFAULT_CHUNK_OVERLAP,
                          key: str = "doc_id") -> DataFrame:
    """``(key, n)``: chunks per non-empty document, from the closed form (no
    chunk strings are built)."""
    src = _texts(docs, key)

    def count(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, COUNT_ROWS):
                rb = whole.slice(at, COUNT_ROWS)
                yield pa.RecordBatch.from_arrays([rb.column(key), pa.array(V.word_counts(rb.column("_t")), pa.int64())],
                                                 names=[key, "_words"])

    counted = src.mapInArrow(count, StructType([src.schema[key], StructField("_words", LongType())]))
    return counted.where("_words > 0").select(key, T.chunk_count("_words", chunk_words, overlap).alias("n"))


def chunk_corpus(docs: DataFrame, chunk_words: int = T.DEFAULT_CHUNK_WORDS,
                 overlap: int = T.DEFAULT_CHUNK_OVERLAP, key: str = "doc_id",
                 first_id: Callable[[int], int] | None = None) -> DataFrame:
    """Chunks with dense ``chunk_id`` 0..N-1 in (key, chunk_idx) order (I1);
    ``first_id(N)`` gives another first id than 0, as for a load that goes on after
    earlier ones (:mod:`.corpus`).

    The per-document base offset comes from :func:`dense_offsets` over one row
    per document; the document text is joined to its base *before* exploding,
    so the join moves documents, not the (larger, overlapping) chunks.

    Keys may repeat or be null: such documents are numbered in (key, name, text)
    order first, nulls last, and keep their own chunks and ids."""
    n, keys = docs.agg(F.count(F.lit(1)), F.count_distinct(key)).first()
    if n != keys:
        order = [F.col(key).asc_nulls_last(), F.col("source_name").asc_nulls_last(), F.xxhash64("text")]
        row = "_row"
        numbered = materialize(
            docs.select(key, "source_name", "text")
            .repartitionByRange(shuffle_partitions(docs.sparkSession), *order)
            .sortWithinPartitions(*order).withColumn(row, F.monotonically_increasing_id()), "numbered")
        keyed = numbered.select(F.col(row), "source_name", "text")
        chunks = chunk_corpus(keyed, chunk_words, overlap, row, first_id)
        return chunks.join(numbered.select(row, F.col(key)), row).select(
            "chunk_id", key, "source_name", "chunk_idx", "chunk_ref", "text")
    counts = document_chunk_counts(docs, chunk_words, overlap, key)
    base, base_bytes, n_chunks = dense_offsets_sized(counts, key, "n")
    first = first_id(n_chunks) if first_id else 0
    # broadcast (key, base) when its exact size fits, so the document text is
    # not shuffled; otherwise a shuffle join
    with_base = docs.select(key, "source_name", "text").join(
        bounded_broadcast(base, 1, base_bytes), key, "inner")
    chunks = chunk_documents(with_base, chunk_words, overlap, key, carry=("base",))
    return chunks.select(
        (F.col("base") + F.col("chunk_idx") + F.lit(first)).alias("chunk_id"),
        key, "source_name", "chunk_idx", "chunk_ref", "text")
