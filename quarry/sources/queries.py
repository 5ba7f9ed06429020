"""Query sets (S9): a JSON array of objects whose id sits under ``query_num``,
``id`` or ``query_id`` and whose text sits under ``query`` or ``text``.

The reference resolves them with Python ``or``: the first *truthy* id among
``query_num``, ``id`` wins, else ``query_id`` whatever it is; same for
``query`` then ``text``; an item whose resolved id or text is missing / null is
skipped.  Fields are read as VARIANT so ``0`` (falsy) and ``"0"`` (truthy) stay
apart; the resolution is a column expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The alias order of the query-file fields.
ID_FIELDS = ("query_num", "id", "query_id")
TEXT_FIELDS = ("query", "text")
QUERY_FILE_SCHEMA = ", ".join(f"{c} variant" for c in (*ID_FIELDS, *TEXT_FIELDS))


def truthy(v: Column) -> Column:
    """Python truthiness of a JSON value held in a VARIANT column."""
    t = F.schema_of_variant(v)
    return (F.when(v.isNull() | (t == "VOID"), F.lit(False))
            .when(t == "BOOLEAN", F.variant_get(v, "$", "boolean"))
            .when(t == "STRING", F.variant_get(v, "$", "string") != "")
            .when(t.startswith("ARRAY") | t.startswith("OBJECT"),
                  ~F.to_json(v).isin("[]", "{}"))
            .otherwise(F.variant_get(v, "$", "double") != 0))


def py_str(v: Column) -> Column:
    """``str(value)`` for strings, integers and booleans (JSON text otherwise)."""
    t = F.schema_of_variant(v)
    return (F.when(t == "STRING", F.variant_get(v, "$", "string"))
            .when(t == "BOOLEAN", F.when(F.variant_get(v, "$", "boolean"), "True")
                  .otherwise("False"))
            .otherwise(F.to_json(v)))


def _py_or(cols: list[Column]) -> Column:
    """``a or b or c``: first truthy value, else the last one."""
    out = cols[-1]
    for c in reversed(cols[:-1]):
        out = F.when(truthy(c), c).otherwise(out)
    return out


def resolve_queries(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """VARIANT alias columns -> (``qid, query`` rows, rejected rows)."""
    for c in (*ID_FIELDS, *TEXT_FIELDS):
        if c not in raw.columns:
            raw = raw.withColumn(c, F.lit(None).cast("variant"))
    qid = _py_or([F.col(c) for c in ID_FIELDS])
    text = _py_or([F.col(c) for c in TEXT_FIELDS])
    res = raw.select(qid.alias("_q"), text.alias("_t"), *[F.col(c) for c in raw.columns])
    ok = (F.col("_q").isNotNull() & (F.schema_of_variant("_q") != "VOID")
          & F.col("_t").isNotNull() & (F.schema_of_variant("_t") != "VOID"))
    good = res.where(ok).select(py_str(F.col("_q")).alias("qid"), py_str(F.col("_t")).alias("query"))
    bad = res.where(~ok).drop("_q", "_t")
    return good, bad


def read_query_file(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A JSON array file (or a folder of them) -> (queries, rejects)."""
    raw = spark.read.option("multiLine", True).schema(QUERY_FILE_SCHEMA).json(path)
    return resolve_queries(raw)
