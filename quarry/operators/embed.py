"""Text embedding (E1, E2) and L2 normalisation.

Two embedders:

* the default **feature-hashing embedder** (no model files): an Arrow task splits a
  slice of texts into words, hashes its different words and counts the buckets, with
  vectorised steps throughout.  Its sparse form ``(id, bucket, n)`` is
  plain SQL and is what the DuckDB oracle computes.
* a **pluggable model embedder**: ``model_loader() -> fn(list[str]) -> 2-D array``,
  run through ``predict_batch_udf`` so the model loads once per Python worker and
  sees fixed-size batches (the reference's batch of 64).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vectors as V

# Defaults for the hashing embedder and the model batch size.
DEFAULT_HASH_DIM = 1024
DEFAULT_EMBED_BATCH = 64


def hash_embed_sparse(df: DataFrame, text_col: str = "text", id_col: str = "chunk_id",
                      dim: int = DEFAULT_HASH_DIM) -> DataFrame:
    """``(id, bucket bigint, n bigint)``: term counts per hash bucket.  Pure SQL;
    partial aggregation runs map-side (a chunk's tokens are all in one task)."""
    return (df.select(F.col(id_col).alias(id_col),
                      F.explode(V.hash_buckets(text_col, dim)).alias("bucket"))
            .groupBy(id_col, "bucket").agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def hash_embed(df: DataFrame, text_col: str = "text", id_col: str = "chunk_id",
               dim: int = DEFAULT_HASH_DIM, out_col: str = "embedding",
               keep: tuple[str, ...] = (), packed: bool = False) -> DataFrame:
    """``(id, *keep, embedding array<float>)`` with raw term counts (exact small
    integers), or packed vectors (``functions/vectors.py``).  Cosine search normalises in
    double at scoring time; call :func:`normalize` to store unit vectors (as the index
    does)."""
    src = df.select(id_col, *keep, F.col(text_col).cast("string").cast("binary").alias("_t"))
    schema = T.StructType([*[src.schema[c] for c in (id_col, *keep)], T.StructField(
        out_col, T.BinaryType() if packed else T.ArrayType(T.FloatType(), False))])

    def densify(batches):
        step = max(64, V.SLICE_BYTES // (8 * dim))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                rb = whole.slice(at, step)
                m = V.bucket_counts(rb.column("_t"), dim)
                yield pa.RecordBatch.from_arrays(
                    [*[rb.column(c) for c in (id_col, *keep)], V.pack_rows(m) if packed else V.matrix_to_list_array(m)],
                    names=[id_col, *keep, out_col])

    return src.mapInArrow(densify, schema)


def normalize(df: DataFrame, col: str = "embedding") -> DataFrame:
    """Unit-scale a vector column (zero vectors stay zero); packed vectors stay
    packed.  One vectorised numpy pass per Arrow batch; Spark's higher-order functions are
    interpreted per element, which is slow for wide vectors."""
    packed = isinstance(df.schema[col].dataType, T.BinaryType)
    schema = T.StructType([f if f.name != col or packed else
                           T.StructField(col, T.ArrayType(T.FloatType(), False))
                           for f in df.schema.fields])
    names = df.columns

    def unit(batches):
        for rb in V.slices(batches, col):
            X, valid = V.list_column_matrix(rb.column(col))
            n = V.row_norms(X)
            U = np.where(n[:, None] > 0, X / np.where(n > 0, n, 1.0)[:, None], 0.0)
            keep = pa.array(valid)
            cols = [rb.column(c).filter(keep) if not valid.all() else rb.column(c)
                    for c in names]
            cols[names.index(col)] = V.pack_rows(U) if packed else V.matrix_to_list_array(U)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return df.where(F.col(col).isNotNull()).mapInArrow(unit, schema)


def model_embed(df: DataFrame, model_loader: Callable, dim: int,
                text_col: str = "text", id_col: str = "chunk_id",
                out_col: str = "embedding", batch_size: int = DEFAULT_EMBED_BATCH,
                normalize_output: bool = False) -> DataFrame:
    """E1 with a user model.  ``model_loader()`` runs once per Python worker and
    returns ``fn(texts: np.ndarray[str]) -> np.ndarray[(n, dim)]``."""
    from pyspark.ml.functions import predict_batch_udf

    def make_predict():
        fn = model_loader()

        def predict(texts: np.ndarray) -> np.ndarray:
            out = np.asarray(fn(list(texts)), dtype=np.float32).reshape(len(texts), dim)
            if normalize_output:
                n = np.linalg.norm(out, axis=1, keepdims=True)
                out = np.where(n > 0, out / np.where(n > 0, n, 1), 0).astype(np.float32)
            return out
        return predict

    udf = predict_batch_udf(make_predict, return_type=T.ArrayType(T.FloatType()),
                            batch_size=batch_size)
    return df.select(id_col, udf(F.col(text_col)).alias(out_col))
