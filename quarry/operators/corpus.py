"""A corpus that grows by loads: chunk ids that go on after the stored ones.

A corpus folder holds ``chunks/load=<name>`` and ``loads/<number>.json``, one small
file for each load with the range of ids reserved for it.  The ranges follow each
other, so the high-water mark is the end of the last one.  A range is reserved
before the chunks are written: a load that failed is run again under its name, gets
its range again and replaces what it had written; loads that run side by side get
ranges of their own, because a number can be taken only once.
"""

from __future__ import annotations

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import path_exists
from .chunking import chunk_corpus

LOAD_SCHEMA = "number bigint, load string, first bigint, n bigint"
TRIES = 100                 # numbers that other loads may take meanwhile


def read_loads(spark: SparkSession, path: str) -> DataFrame:
    """``(number, load, first, n)``: the ids ``first .. first + n - 1`` belong to ``load``."""
    if not path_exists(spark, f"{path}/loads"):
        return spark.createDataFrame([], LOAD_SCHEMA)
    return spark.read.schema(LOAD_SCHEMA).json(f"{path}/loads")


def _take(spark: SparkSession, folder: str, name: str, content: str) -> bool:
    """Write the file ``name`` whole, unless it exists: a rename that doesn't replace."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    draft, final = hadoop.Path(f"{folder}/_{uuid.uuid4().hex}"), hadoop.Path(f"{folder}/{name}")
    fs = final.getFileSystem(conf)
    out = fs.create(draft, False)
    out.write(bytearray(content.encode()))
    out.close()
    files = hadoop.FileContext.getFileContext(fs.getUri(), conf)
    no_options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        files.rename(fs.makeQualified(draft), fs.makeQualified(final), no_options)
        return True
    except Py4JJavaError as e:
        fs.delete(draft, False)
        if not fs.exists(final):
            raise RuntimeError(f"{final} can't be written") from e
        return False


def reserve_ids(spark: SparkSession, path: str, load: str, n: int) -> int:
    """The first of ``n`` ids reserved for ``load``: after all earlier ranges, or the
    range that the load already has (then ``n`` must be the same)."""
    if not re.fullmatch(r"[A-Za-z0-9_.]+", load):
        raise ValueError("a load is named by letters, digits, dots and underscores")
    for _ in range(TRIES):
        taken = read_loads(spark, path).collect()       # one row for each load
        for r in taken:
            if r["load"] == load:
                if r["n"] != n:
                    raise ValueError(f"load {load} had {r['n']} chunks and now has {n}; give it another name")
                return r["first"]
        first = max((r["first"] + r["n"] for r in taken), default=0)
        number = len(taken)
        row = json.dumps({"number": number, "load": load, "first": first, "n": n})
        if _take(spark, f"{path}/loads", f"{number:010d}.json", row):
            return first
    raise RuntimeError(f"no range for load {load}: others took {TRIES} numbers meanwhile")


def add_chunks(docs: DataFrame, path: str, load: str, chunk_words: int = T.DEFAULT_CHUNK_WORDS,
               overlap: int = T.DEFAULT_CHUNK_OVERLAP, key: str = "doc_id") -> DataFrame:
    """Chunk ``docs`` into the corpus at ``path`` as ``load`` and return the chunks of
    this load.  Ids are dense over all loads, in order of the loads, and within one in
    (key, chunk_idx) order.  The same name again replaces the load under the same ids."""
    spark = docs.sparkSession
    chunks = chunk_corpus(docs, chunk_words, overlap, key, lambda n: reserve_ids(spark, path, load, n))
    target = f"{path}/chunks/load={load}"
    chunks.write.mode("overwrite").parquet(target)
    return spark.read.schema(chunks.schema).parquet(target)


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """The chunks of all loads, with a column ``load``."""
    return spark.read.option("basePath", f"{path}/chunks").parquet(f"{path}/chunks").withColumn(
        "load", F.col("load").cast("string"))
