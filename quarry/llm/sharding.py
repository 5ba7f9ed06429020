"""Two-pass external shuffle into shards (operator 4).

Law ``key``: the shard of a record is a function of its key and the number of
shards alone (rendezvous hashing: the shard with the largest seeded hash takes
it), so that one more shard takes records only into itself.

Pass one scatters the records by seeded hashes: to a shard, and uniformly to
buckets of a size that fits into a task's memory.  Pass two permutes each bucket
by Fisher-Yates with a generator seeded by shard and bucket, and writes it.  A
record's slot is the number of records in the shard's earlier buckets, known from
a count of the scatter, plus its place in its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import free_name, materialize, number_hot_copies, row_hash, scratch_path, table

SHARDS = 24
SEED = 20240229
BUCKET_BYTES = 16 << 20
RECORD_BYTES = 8            # counted for each record beside its text


def rendezvous_shard(key: Column, shards: int, seed: int = SEED) -> Column:
    """The shard with the largest seeded hash of (key, shard).  A further shard
    takes a key only by having a larger hash than all others; no key moves
    between the others."""
    draws = [F.struct(F.xxhash64(key, F.lit(s), F.lit(seed)), F.lit(s).alias("s")) for s in range(shards)]
    return F.array_max(F.array(*draws))["s"]


def fisher_yates(group: pa.Table, shard: int, bucket: int, seed: int) -> pa.Table:
    """The rows of a bucket in random order (a function of the rows, the seed and
    the bucket's name), with their slots from ``_base`` on."""
    group = group.take(pa.compute.sort_indices(group.column("_o")))
    rng = np.random.Generator(np.random.PCG64([seed, shard, bucket]))
    order = np.arange(group.num_rows)
    rng.shuffle(order)                  # Fisher-Yates
    slot = pa.array(group.column("_base").to_numpy() + np.arange(len(order)), pa.int64())
    return group.take(pa.array(order)).append_column("_slot", slot)


def shuffle_shards(records: DataFrame, path: str, shards: int = SHARDS, key_col: str = "doc_id",
                   text_col: str = "text", seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write all records in shuffled order as Parquet under ``path``, a folder
    ``_shard=<n>`` for each shard, and return them read from there: all columns
    of the input, ``_shard`` and ``_slot`` (gapless from 0 in each shard; files
    are read in slot order by sorting on it).

    Null keys share one shard; records with equal keys do too.  Records that are
    equal in all columns stay apart by a running number, so a hot one is spread
    over buckets.  A null text counts as no bytes.  Empty table: no rows."""
    spark = records.sparkSession
    names = records.columns
    taken = [n for n in names if n.lower() in ("_shard", "_slot", "_bucket", "_base", "_o")]
    if taken:
        raise ValueError(f"columns {taken} have names that the output needs")
    size = F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + RECORD_BYTES
    shard = rendezvous_shard(F.col(key_col), shards, seed)
    held = {r[0]: r[1] for r in records.groupBy(shard.alias("s")).agg(F.sum(size)).collect()}  # <= shards rows
    buckets = [max(1, -(-int(held.get(s, 0)) // bucket_bytes)) for s in range(shards)]

    rows = number_hot_copies(records, free_name(records, "_copy"))
    copy = rows.columns[-1]
    draw = F.xxhash64(row_hash(rows), F.lit(seed + 1))      # over all columns and the copy's number
    rows = (rows.withColumn("_shard", shard).withColumn("_o", draw)
            .withColumn("_bucket", F.pmod(F.xxhash64("_o", F.lit(seed + 2)), F.array(
                *[F.lit(b).cast("bigint") for b in buckets])[F.col("_shard")]).cast("int"))
            .drop(copy))

    # first slot of each bucket; joined on the buckets' key, which the grouping
    # needs anyway, so the records are shuffled once
    count = rows.groupBy("_shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_shard").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    base = materialize(count.select("_shard", "_bucket", (F.sum("_n").over(before) - F.col("_n")).alias("_base")),
                       "bucket-slots")
    rows = rows.join(base, ["_shard", "_bucket"])

    def permute(key, group):
        return fisher_yates(group, key[0].as_py(), key[1].as_py(), seed).select(kept)

    fields = {f.name: f for f in rows.schema.fields} | {"_slot": StructField("_slot", LongType())}
    kept = [*names, "_shard", "_slot"]
    out = rows.groupBy("_shard", "_bucket").applyInArrow(permute, StructType([fields[c] for c in kept]))
    out.write.mode("overwrite").partitionBy("_shard").option("compression", "zstd").parquet(path)
    if not held:
        return spark.createDataFrame([], out.schema)
    return spark.read.parquet(path).select(kept)


def op4_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = shuffle_shards(docs, scratch_path(spark, "shards"))
    text = F.coalesce(F.col("text"), F.lit(""))
    return out.select(
        "doc_id", (F.octet_length(text) + RECORD_BYTES).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
        F.col("_shard").cast("int").alias("shard"), F.col("_slot").alias("slot"),
        rendezvous_shard(F.col("doc_id"), SHARDS + 1).cast("int").alias("grown_shard"))
