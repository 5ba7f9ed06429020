"""Result sink and reader.

The reference writes one JSON file per query id into a results folder (stale
files of earlier runs survive).  Here results are one dataset
``(qid, query, response array<string>)`` written with mode ``overwrite``; a
repeated query id yields one row (see ``query_responses``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RESULT_SCHEMA = "qid string, query string, response array<string>"


def write_results(responses: DataFrame, path: str, fmt: str = "json") -> None:
    responses.select("qid", "query", "response").write.mode("overwrite").format(fmt).save(path)


def read_results(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    reader = spark.read.format(fmt)
    if fmt == "json":
        reader = reader.schema(RESULT_SCHEMA)
    return reader.load(path)


def export_chunks_jsonl(chunks: DataFrame, path: str) -> None:
    """S8 export in the reference's line format: ``{"id": <int>, "text": ...}``
    (one JSON object per line; Spark writes one file per partition)."""
    chunks.select(chunks["chunk_id"].alias("id"), "text").write.mode("overwrite").json(path)


def export_id_mapping(chunks: DataFrame, path: str) -> None:
    """Id -> ``<file>::chunk<n>`` mapping as JSON lines ``{"id", "ref"}``."""
    chunks.select(chunks["chunk_id"].alias("id"), chunks["chunk_ref"].alias("ref")) \
        .write.mode("overwrite").json(path)


def read_chunks_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """The exported chunk lines: ``chunk_id, text``."""
    return spark.read.schema("id bigint, text string").json(path).withColumnRenamed("id", "chunk_id")


def read_id_mapping(spark: SparkSession, path: str) -> DataFrame:
    """The exported id mapping: ``chunk_id, chunk_ref``."""
    return spark.read.schema("id bigint, ref string").json(path).withColumnsRenamed(
        {"id": "chunk_id", "ref": "chunk_ref"})
