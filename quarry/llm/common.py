"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path

# Rows above which equal rows count as a hot group that needs an ordinal of its own.
HOT_ROWS = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark (any path Spark can open)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def worker_state() -> dict:
    """A store that lives as long as the Python worker process, so that caches
    serve all tasks a worker runs.  (The package is pickled by value, so module
    globals would be new in each task.)"""
    name = "_quarry_llm_worker_state"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have (compared without case)."""
    have = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in have:
        name += "_"
    return name


def row_hash(df: DataFrame) -> Column:
    """64-bit hash over all columns of a row; nulls and the column they stand in count."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        parts += [c if f.dataType.typeName() not in ("map", "variant") else F.to_json(c), c.isNull()]
    return F.xxhash64(*parts)


def number_hot_copies(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Add ``column``: 0, or for rows that occur over ``limit`` (``HOT_ROWS``) times in equal
    form a running number of the copy, so that a hash over (row, column) spreads
    them.  The number is a function of the data alone, so it survives a retry.

    Equal rows are counted by their hash first (eight bytes a row); only if some
    count is above the limit are those rows collapsed to (row, count) -- with a
    partial aggregate before the shuffle -- and expanded again."""
    limit = HOT_ROWS if limit is None else limit
    h = free_name(df, "_rowhash")
    hashed = df.withColumn(h, row_hash(df))
    hot = materialize(hashed.groupBy(h).count().where(F.col("count") > limit).select(h), "hot-rows")
    if hot.isEmpty():
        return df.withColumn(column, F.lit(0).cast("bigint"))
    n = free_name(df, "_n")
    copies = (hashed.join(hot, h, "left_semi").drop(h)
              .groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias(n))
              .withColumn(column, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)))
              .drop(n))
    rest = hashed.join(hot, h, "left_anti").drop(h).withColumn(column, F.lit(0).cast("bigint"))
    return rest.unionByName(copies)


__all__ = ["table", "worker_state", "free_name", "row_hash", "number_hot_copies",
           "materialize", "scratch_path"]
