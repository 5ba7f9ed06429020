"""Incremental index add (X10) as Structured Streaming.

New vectors (or new chunks to embed) arrive as files in a folder.  A streaming
query reads them, assigns lists and encodes them with the index's **frozen**
centroids / codebooks, and ``foreachBatch`` writes each micro-batch to its own
``postings/batch_id=<stream>.<epoch>`` folder with mode ``overwrite``.  A micro-batch
replayed after a failure rewrites the same folder, so the sink is idempotent;
the bulk build lives in ``batch_id=-1``.  ``availableNow`` drains the backlog in
bounded micro-batches and stops.

Which ids the index holds is kept in a ledger, ``ids/batch_id=.../id_bucket=...``.
A bucket holds runs of neighbouring ids, spread by a hash, so a micro-batch of new
ids looks into a few buckets only (``PartitionFilters`` on ``id_bucket``); other
buckets aren't opened.  The ledger is made from the postings at the first addition.
Rows that can't be added go to ``rejects/batch_id=...`` and the stream goes on.
A batch writes postings, then ledger, then rejects, and leaves its own entries out
when it looks ids up: ended anywhere between and replayed, it gives the same rows.
One writer at a time may add to an index.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.ivf import IvfIndex, assign_lists, layout_postings, load_index, pq_encode, read_postings, with_bucket, write_bulk
from ..session import path_exists, scratch_table

# The ledger's buckets: runs of 2^12 neighbouring ids, spread over at most 1,024 folders.
ID_RUN_BITS = 12
ID_BUCKETS = 1024


def encode_batch(index: IvfIndex, vectors: DataFrame, metric: str) -> DataFrame:
    """Frozen-parameter X6 (+ X8) for one batch of ``(id, embedding)`` rows."""
    assigned = assign_lists(vectors, index.centroids, metric)
    if index.is_pq:
        return pq_encode(assigned, index.centroids, index.codebooks, metric)
    return assigned.select("list_id", "id", "embedding")


def id_bucket(col: str = "id") -> Column:
    """Bucket of an id in the ledger: neighbouring ids share one."""
    return F.pmod(F.xxhash64(F.shiftright(col, ID_RUN_BITS)), F.lit(ID_BUCKETS)).cast("int")


def read_ids(spark: SparkSession, index_path: str) -> DataFrame:
    """The ledger: ``(id, batch_id, id_bucket)``."""
    return spark.read.schema("id bigint, batch_id string, id_bucket int").parquet(f"{index_path}/ids")


def read_rejects(spark: SparkSession, index_path: str) -> DataFrame:
    """Rows that were not added: ``(id, reason, n_rows, batch_id)`` with the reasons
    ``stored`` (the index has the id), ``repeated`` (within one batch), ``no id``
    and ``no vector``."""
    schema = "id bigint, reason string, n_rows bigint, batch_id string"
    if not path_exists(spark, f"{index_path}/rejects"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{index_path}/rejects")


def _ensure_ids(spark: SparkSession, index_path: str, is_pq: bool) -> None:
    if path_exists(spark, f"{index_path}/ids/_SUCCESS"):
        return
    ids = read_postings(spark, index_path, is_pq).select("id", "batch_id").withColumn("id_bucket", id_bucket())
    # a bucket's rows meet in one task per batch, not in a file from every task
    ids.repartition("id_bucket").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        "batch_id", "id_bucket").parquet(f"{index_path}/ids")


def look_up_ids(spark: SparkSession, index_path: str, ids: DataFrame, batch_id: int | str) -> DataFrame:
    """Those of ``ids`` (distinct) that another batch of the index holds.  Only the
    buckets of these ids are read; their numbers (at most ``ID_BUCKETS``) are the
    one thing that the driver gets."""
    buckets = sorted(r[0] for r in ids.select(id_bucket().alias("b")).distinct().collect())
    stored = read_ids(spark, index_path).where(F.col("id_bucket").isin(buckets) & (F.col("batch_id") != str(batch_id)))
    return ids.join(stored.select("id"), "id", "left_semi")


def append_batch(index_path: str, vectors: DataFrame, batch_id: int | str,
                 index: IvfIndex | None = None, repeats: str = "error") -> None:
    """Batch form of X10: write one batch of postings under ``batch_id``; the same
    name again replaces that batch (a replay), another one adds to the index.

    An id that the index has from another batch isn't added again, and of rows that
    share an id in the batch one is added (the least by a hash of its vector).
    ``repeats="error"``: such a batch is refused as a whole; ``"reject"``: the rows
    left over are counted in :func:`read_rejects`, as are rows without id or vector."""
    if not re.fullmatch(r"[A-Za-z0-9_.]+", str(batch_id)):
        raise ValueError("a batch is named by letters, digits, dots and underscores (-1 is the bulk build)")
    if repeats not in ("error", "reject"):
        raise ValueError("repeats must be 'error' or 'reject'")
    spark = vectors.sparkSession
    index = index or load_index(spark, index_path)
    metric = index.meta.first()["metric"]
    _ensure_ids(spark, index_path, index.is_pq)
    rows = vectors.select(F.col("id").cast("bigint").alias("id"), F.col("embedding").cast("array<float>").alias("embedding"))
    whole = F.col("id").isNotNull() & F.col("embedding").isNotNull()
    by_id = rows.where(whole).groupBy("id").agg(
        F.min(F.struct(F.xxhash64("embedding").alias("h"), "embedding")).alias("v"), F.count(F.lit(1)).alias("n"))
    with scratch_table(by_id, "append-rows") as by_id:
        stored = look_up_ids(spark, index_path, by_id.select("id"), batch_id).withColumn("stored", F.lit(True))
        with scratch_table(by_id.join(stored, "id", "left"), "append-marked") as marked:
            new = F.col("stored").isNull()
            left_over = marked.where(~new | (F.col("n") > 1)).select(
                "id", F.when(new, "repeated").otherwise("stored").alias("reason"),
                (F.col("n") - new.cast("int")).alias("n_rows"))
            if repeats == "error":
                some = [r[0] for r in left_over.limit(5).collect()]
                if some:
                    raise ValueError(f"ids already in the index or repeated in the batch: {some} ...")
            # an id without a vector is named, rows without an id are counted
            lacking = rows.where(~whole).groupBy("id").agg(F.count(F.lit(1)).alias("n_rows")).select(
                "id", F.when(F.col("id").isNull(), "no id").otherwise("no vector").alias("reason"), "n_rows")
            accepted = marked.where(new).select("id", "v.embedding")
            postings = layout_postings(encode_batch(index, accepted, metric))
            _write_batch(with_bucket(postings), f"{index_path}/postings/batch_id={batch_id}", "list_bucket")
            _write_batch(accepted.select("id").withColumn("id_bucket", id_bucket()).repartition("id_bucket"),
                         f"{index_path}/ids/batch_id={batch_id}", "id_bucket")
            if repeats == "reject":
                _write_batch(left_over.unionByName(lacking), f"{index_path}/rejects/batch_id={batch_id}")


def _write_batch(df: DataFrame, path: str, *partitions: str) -> None:
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (w.partitionBy(*partitions) if partitions else w).parquet(path)


def start_append_stream(spark: SparkSession, source_dir: str, schema: StructType,
                        index_path: str, checkpoint: str | None = None,
                        glob: str | None = None, max_files_per_trigger: int | None = None,
                        prepare: Callable[[DataFrame], DataFrame] | None = None,
                        available_now: bool = True,
                        stream: str | None = None, repeats: str = "reject"):
    """Start the streaming add; returns the ``StreamingQuery``.

    ``prepare`` turns source rows into ``(id, embedding)`` (e.g. chunk ->
    embed); by default the source already has those columns.
    ``stream`` names the stream (default: from source folder and glob); its
    checkpoint lies under the index unless ``checkpoint`` is given.  Repeated ids
    are rejected (:func:`read_rejects`) unless ``repeats="error"``."""
    index = load_index(spark, index_path)
    # A stream is known by its source: run again, it goes on where it stopped; its
    # batches have their own names beside those of other streams.
    name = re.sub(r"[^A-Za-z0-9]", "", stream or hashlib.sha1(
        f"{source_dir.rstrip('/')}|{glob or ''}".encode()).hexdigest()[:16])
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    if prepare is not None:
        stream = prepare(stream)
    stream = stream.select(F.col("id").cast("bigint").alias("id"), "embedding")

    def sink(batch: DataFrame, batch_id: int):
        append_batch(index_path, batch, f"{name}.{batch_id}", index, repeats)

    writer = (stream.writeStream.foreachBatch(sink)
              .option("checkpointLocation", checkpoint or f"{index_path}/streams/{name}"))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def empty_index_like(index: IvfIndex, path: str) -> IvfIndex:
    """Copy an index's trained parameters to ``path`` with no postings (the
    starting point when every vector arrives through the stream)."""
    index.centroids.write.mode("overwrite").parquet(f"{path}/centroids")
    meta = index.meta.withColumn("ntotal", F.lit(0).cast("bigint"))
    meta.write.mode("overwrite").parquet(f"{path}/meta")
    if index.codebooks is not None:
        index.codebooks.write.mode("overwrite").parquet(f"{path}/codebooks")
    write_bulk(index.postings.drop("batch_id", "list_bucket").limit(0), path)
    return load_index(index.postings.sparkSession, path)
