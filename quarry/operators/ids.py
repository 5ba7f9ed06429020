"""Dense sequential ids (I1), manifest (I4) and the id lookups.

Dense ids are assigned with a two-level prefix sum instead of one global
``row_number()`` (which would pull every row into one task):

1. per-key counts ``(key, n)`` are written to the checkpoint folder;
2. they are range-partitioned on the key and tagged with ``spark_partition_id()``,
   then written again so the partition id cannot move on recomputation;
3. per-partition totals (one row per partition) are prefix-summed on the driver;
4. inside each partition a running sum over the key gives the local offset.

Only step 3 touches the driver, and its input has as many rows as partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import DEFAULT_BROADCAST_BYTES, materialize, shuffle_partitions


def dense_offsets(counts: DataFrame, key: str, count_col: str = "n",
                  num_partitions: int | None = None) -> DataFrame:
    """``(key, count)`` rows with unique keys -> ``(key, base)`` where ``base`` is
    the sum of the counts of all smaller keys (so ids ``base .. base+count-1``
    belong to ``key``)."""
    return dense_offsets_sized(counts, key, count_col, num_partitions)[0]


def dense_offsets_sized(counts: DataFrame, key: str, count_col: str = "n",
                        num_partitions: int | None = None) -> tuple[DataFrame, int, int]:
    """:func:`dense_offsets` plus the exact byte size of the ``(key, base)``
    result (key bytes + 16 per key) -- a proven bound for broadcasting it -- and the
    number of ids, both from the per-partition totals at no extra pass."""
    spark = counts.sparkSession
    nparts = num_partitions or max(1, shuffle_partitions(spark))
    frozen = materialize(counts.select(key, F.col(count_col).cast("bigint").alias("_n")),
                         "dense-counts")
    ranged = materialize(
        frozen.repartitionByRange(nparts, key).withColumn("_pid", F.spark_partition_id()),
        "dense-ranged")
    totals = (ranged.groupBy("_pid")
              .agg(F.sum("_n").alias("_t"),
                   F.sum(F.octet_length(F.col(key).cast("string")) + 16).alias("_b"))
              .orderBy("_pid").collect())          # one row per partition
    rows, acc, n_bytes = [], 0, 0
    for r in totals:
        rows.append((int(r["_pid"]), acc))
        acc += int(r["_t"] or 0)
        n_bytes += int(r["_b"] or 0)
    offsets = spark.createDataFrame(rows, "_pid int, _off bigint")
    w = (Window.partitionBy("_pid").orderBy(key)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (ranged.join(F.broadcast(offsets), "_pid")
            .select(key, (F.col("_off") + F.sum("_n").over(w) - F.col("_n")).alias("base")),
            n_bytes, acc)


def dense_row_ids(df: DataFrame, key: str, id_col: str = "row_id") -> DataFrame:
    """Ids 0..N-1 in ``key`` order for a table with a unique ``key``."""
    base = dense_offsets(df.select(key).withColumn("n", F.lit(1)), key, "n")
    return df.join(base, key).withColumnRenamed("base", id_col)


def chunk_manifest(chunks: DataFrame) -> DataFrame:
    """One-row manifest ``n_chunks`` (the reference's ``{"chunks": N}``)."""
    return chunks.agg(F.count(F.lit(1)).cast("bigint").alias("n_chunks"))


def bounded_broadcast(df: DataFrame, row_bound: int, row_bytes: int,
                      limit: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` when its proven size bound fits; otherwise leave the
    join strategy to the planner (AQE may still pick a broadcast at runtime)."""
    return F.broadcast(df) if row_bound * row_bytes <= limit else df


def _cut_by_ids(hits: DataFrame, chunks: DataFrame, cols: list[str], hit_bound: int | None,
                id_col: str) -> DataFrame:
    """The rows of the big chunk table whose id is among the hits: an inner join
    against the distinct hit ids, broadcast when their count is bounded (an id
    is 8 bytes, so the size is proven; the rest of a hit row is not shipped)."""
    ids = hits.select(id_col).distinct()
    ids = ids if hit_bound is None else bounded_broadcast(ids, hit_bound, 16)
    return chunks.select(F.col("chunk_id").alias(id_col), *cols).join(ids, id_col, "inner")


def lookup_source(hits: DataFrame, chunks: DataFrame, hit_bound: int | None = None,
                  id_col: str = "id") -> DataFrame:
    """Attach ``source_name`` to each hit; hits with an unknown id are dropped
    (inner join).  The chunk table is first cut to the hit ids; joining that
    small result back to the hits is left to the planner (AQE measures it)."""
    found = _cut_by_ids(hits, chunks, ["source_name"], hit_bound, id_col)
    return hits.join(found, id_col, "inner")


def lookup_text(hits: DataFrame, chunks: DataFrame, hit_bound: int | None = None,
                id_col: str = "id") -> DataFrame:
    """Attach chunk text, ``''`` for unknown ids (left join + default).

    The preserved side of an outer join cannot be broadcast, so the big chunk
    table is first cut down by an inner join against the (broadcast) distinct hit
    ids; the left join then runs between two small tables, planned by AQE from
    their measured sizes (chunk texts have no proven width)."""
    found = _cut_by_ids(hits, chunks, [F.col("text").alias("_text")], hit_bound, id_col)
    return (hits.join(found, id_col, "left")
            .withColumn("text", F.coalesce(F.col("_text"), F.lit("")))
            .drop("_text"))
