"""The corpus pipeline: documents -> quality rules -> near-duplicate removal ->
repeated passages cut -> personal data replaced -> packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written
and read again as the next one's ``docs``; all but the last return the columns of
``documents``.  Empty tables, null texts and ids, equal rows and further columns
pass as each operator states.  No ``ORACLE_SQL``: SQL has neither the tokenizer
nor the components; the stages are tested against brute force."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.bpe import default_tokenizer
from quarry.llm.common import materialize, table
from quarry.llm.divergence import keep_good
from quarry.llm.feistel import pseudonymise
from quarry.llm.lines import without_repeats
from quarry.llm.packing import pack
from quarry.llm.simhash import keep_one

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", lambda spark, docs, sf_dir: keep_good(docs)),
    ("simhash_near_dedup", lambda spark, docs, sf_dir: keep_one(docs)),
    ("substring_dedup", lambda spark, docs, sf_dir: without_repeats(docs)),
    ("pii", lambda spark, docs, sf_dir: pseudonymise(docs)),
    ("best_fit_packing", lambda spark, docs, sf_dir: pack(docs, default_tokenizer())),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; between them, Parquet in the
    checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{k}-{name}")
    return docs
