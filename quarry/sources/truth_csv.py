"""Ground-truth CSV (S10, V1): ``query_id, relevant_document_ids`` where the
second column is a stringified list (single or double quotes).

Parsing follows the reference: single quotes become double quotes and the
result is read as JSON; the element type is kept, so an integer id never equals
a string file name (it still counts towards the relevant-set size).  A query id
listed twice keeps its last row.  Output is long: one row per distinct relevant
id, ``relevant`` NULL for an empty list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Non-string ids are tagged with a NUL prefix, which no file name contains.
NON_STRING_TAG = "\u0000"


def parse_truth(rows: DataFrame, strict_json: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(query_id string, relevant_document_ids string)`` -> (truth, rejects)."""
    src = rows.withColumn("_order", F.monotonically_increasing_id())
    last = (src.groupBy("query_id")
            .agg(F.max_by(F.struct("relevant_document_ids", "_order"), "_order").alias("_r"))
            .select(F.col("query_id").cast("string").alias("qid"),
                    F.col("_r.relevant_document_ids").alias("raw")))
    text = F.col("raw") if strict_json else F.replace(F.col("raw"), F.lit("'"), F.lit('"'))
    parsed = last.select("qid", "raw", F.try_parse_json(text).alias("_v"))
    is_array = F.schema_of_variant("_v").startswith("ARRAY")
    bad = parsed.where(F.col("_v").isNull() | ~is_array).select("qid", "raw")
    elems = (parsed.where(is_array)
             .select("qid", F.explode_outer(F.variant_get("_v", "$", "array<variant>"))
                     .alias("e")))
    rel = F.when(F.col("e").isNull(), F.lit(None).cast("string")) \
        .when(F.schema_of_variant("e") == "STRING", F.variant_get("e", "$", "string")) \
        .otherwise(F.concat(F.lit(NON_STRING_TAG), F.to_json("e")))
    return elems.select("qid", rel.alias("relevant")).distinct(), bad


def read_truth_csv(spark: SparkSession, path: str,
                   strict_json: bool = False) -> tuple[DataFrame, DataFrame]:
    """Quoted fields may hold line breaks.  If every query id is a whole number the
    ids are numbers (``007`` is ``7``), otherwise they stay as written."""
    rows = spark.read.option("header", True).option("escape", "\"").option("multiLine", True).schema(
        "query_id string, relevant_document_ids string").csv(path)
    number = F.trim("query_id").try_cast("bigint")
    if rows.where(F.col("query_id").isNotNull() & number.isNull()).isEmpty():
        rows = rows.withColumn("query_id", number.cast("string"))
    return parse_truth(rows, strict_json)
