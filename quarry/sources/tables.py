"""Readers for the table-shaped inputs (``documents``, ``pages``, ``benchmark``,
``embeddings``) with a parallelism guard for small, single-split inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition only when the scan yields fewer splits than the
    cluster has cores (e.g. one large row group).  Large inputs already arrive
    in many splits and are left untouched, so no shuffle is added at scale."""
    spark = df.sparkSession
    want = min_partitions or spark.sparkContext.defaultParallelism
    have = df.rdd.getNumPartitions()
    return df.repartition(want) if have < want else df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_documents(spark: SparkSession, sf_dir: str, parallel: bool = True) -> DataFrame:
    """``documents`` as a corpus: ``doc_id, source_name, text``."""
    df = read_table(spark, sf_dir, "documents").select(
        "doc_id", F.col("doc_id").cast("string").alias("source_name"), "text")
    return spread(df) if parallel else df


def read_pages(spark: SparkSession, sf_dir: str, parallel: bool = True) -> DataFrame:
    """``pages`` as a corpus of unknown-extension files: the raw HTML is the
    text (markup kept, as for any file without a known suffix)."""
    df = read_table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("doc_id"), F.col("page_id").cast("string").alias("source_name"),
        F.col("html").alias("text"))
    return spread(df) if parallel else df


def read_benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``benchmark`` as the query set: ``qid string, query string``."""
    return read_table(spark, sf_dir, "benchmark").select(
        F.col("item_id").cast("string").alias("qid"), F.col("text").alias("query"))


def read_embeddings(spark: SparkSession, sf_dir: str, parallel: bool = True) -> DataFrame:
    """``embeddings`` as ``id bigint, embedding array<float>``."""
    df = read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), "embedding")
    return spread(df) if parallel else df
