"""Folder of files -> documents.

* S1 scan: ``binaryFile`` over the folder, direct children only; the file name
  is the document name (the reference sorts by path; our ids follow the name
  order, which equals code-point path order inside one folder).
* S2 size limit (only if asked for): pushed into the file listing, so the
  content of a larger file is never read; it is listed in the rejects.
* S3 / S5 text: UTF-8 with invalid bytes dropped.  Valid UTF-8 (the common
  case) is a plain cast; only invalid files go through a small pandas UDF.
* S4 JSON: the first present key of text / content / body; otherwise the whole
  value dumped again with ASCII escapes; invalid JSON is an error.  Texts under a
  key are taken in SQL (VARIANT); only other values go through Python.
* S6 binary formats: a user ``extractor(bytes) -> str`` per suffix (e.g. a PDF
  library); without one the file is read as text, like any unknown suffix.
* S7 integer-stem scan: ``<int>.<ext>`` files, id = the stem, raw text.
* S13 errors never fail the job: each row carries ``error``; :func:`split_rejects`
  separates good rows from rejects.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import file_name, file_stem, file_suffix
from ..session import materialize

# The text / JSON suffixes and key order.
TEXT_SUFFIXES = (".txt", ".md")
JSON_SUFFIX = ".json"
JSON_TEXT_KEYS = ("text", "content", "body")

_TEXT_ERROR = T.StructType([T.StructField("text", T.StringType()),
                            T.StructField("error", T.StringType())])


@F.pandas_udf(T.StringType())
def _decode_ignore(content: pd.Series) -> pd.Series:
    return content.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore"))


def utf8_text(content) -> F.Column:
    """UTF-8 decode that drops invalid bytes.  Valid rows are a cast; the Python
    function gets null for them."""
    c = F.col(content) if isinstance(content, str) else content
    valid = F.is_valid_utf8(c)
    return F.when(valid, c.cast("string")).otherwise(_decode_ignore(F.when(~valid, c)))


@F.pandas_udf(_TEXT_ERROR)
def _render_json(raw: pd.Series) -> pd.DataFrame:
    """Values that SQL can't render as Python does; no input ends the job."""
    def show(doc):
        if doc is None:
            return None, None
        try:
            value = json.loads(doc)
            named = [value[k] for k in JSON_TEXT_KEYS if k in value] if type(value) is dict else []
            text = str(named[0]) if named else json.dumps(value)
            return text.encode("utf-8", "replace").decode("utf-8"), None
        except Exception as problem:  # noqa: BLE001
            return "", f"invalid JSON: {type(problem).__name__}: {problem}"[:500]
    return pd.DataFrame([show(x) for x in raw], columns=["text", "error"])


def json_text(col) -> F.Column:
    """S4 on a string column: struct ``(text, error)``; blank input is empty text."""
    raw = F.col(col) if isinstance(col, str) else col
    value = F.try_parse_json(raw)
    named = F.lit(None).cast("variant")
    for key in reversed(JSON_TEXT_KEYS):
        field = F.try_variant_get(value, f"$.{key}", "variant")
        named = F.when(field.isNotNull(), field).otherwise(named)
    blank = raw.isNull() | (F.trim(raw) == "")
    # escapes of lone surrogates are left to Python, which keeps their order
    text = F.schema_of_variant(value).startswith("OBJECT") & (F.schema_of_variant(named) == "STRING") \
        & ~raw.contains("\\ud") & ~raw.contains("\\uD")
    text = F.coalesce(text, F.lit(False))
    rest = _render_json(F.when(~blank & ~text, F.trim(raw)))
    return F.when(blank, F.struct(F.lit("").alias("text"), F.lit(None).cast("string").alias("error"))).when(
        text, F.struct(F.variant_get(named, "$", "string").alias("text"), F.lit(None).cast("string").alias("error"))
    ).otherwise(rest)


def _plain_path(c) -> F.Column:
    """A path without scheme and authority, so that ``/x``, ``file:/x``,
    ``file:///x`` and ``hdfs://host/x`` compare by their folders."""
    return F.regexp_replace(F.regexp_replace(c, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), "^/+|/+$", "")


def scan_folder(spark: SparkSession, folder: str, max_bytes: int | None = None) -> DataFrame:
    """S1 + S2: ``(path, source_name, suffix, length, content)`` for the files
    directly inside ``folder`` (no recursion), of at most ``max_bytes`` if given.
    Hidden and ``_``-prefixed files are skipped by Spark's file source."""
    whole = folder if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", folder) else os.path.abspath(folder)
    parent = F.regexp_replace(F.col("path"), "/[^/]*$", "")
    df = spark.read.format("binaryFile").load(folder)
    df = df.where(_plain_path(parent) == _plain_path(F.lit(whole)))
    if max_bytes is not None:
        df = df.where(F.col("length") <= max_bytes)
    return df.select("path", file_name("path").alias("source_name"),
                     file_suffix(file_name("path")).alias("suffix"), "length", "content")


def oversized_files(spark: SparkSession, folder: str, max_bytes: int) -> DataFrame:
    """The files that a limit leaves out, as reject rows; their content isn't read."""
    files = scan_folder(spark, folder).where(F.col("length") > max_bytes)
    return files.select("source_name", F.lit("").alias("text"), F.format_string(
        f"%d bytes, above the limit of {max_bytes}", "length").alias("error"))


def read_folder(spark: SparkSession, folder: str, max_bytes: int | None = None,
                extractors: dict[str, Callable[[bytes], str]] | None = None) -> DataFrame:
    """S1-S6 + S13: ``(doc_id, source_name, text, error)``; ``doc_id`` is the
    file name (so ids follow name order).  Every file is read once; the result is
    written, so that extractors run once however often it is used."""
    files = scan_folder(spark, folder, max_bytes)
    extractors = {k.lower(): v for k, v in (extractors or {}).items()}
    own = F.col("suffix").isin(list(extractors)) if extractors else F.lit(False)
    plain = files.select("source_name", "suffix", "content", utf8_text(F.when(~own, F.col("content"))).alias("raw"))
    is_json = F.col("suffix") == JSON_SUFFIX
    result = F.when(is_json & ~own, json_text(F.when(is_json & ~own, F.col("raw"))))
    for suffix, fn in extractors.items():
        mine = F.col("suffix") == suffix
        result = F.when(mine, _extract_udf(fn)(F.when(mine, F.col("content")))).otherwise(result)
    out = plain.select("source_name", F.col("raw"), result.alias("r"), (is_json | own).alias("_r")).select(
        "source_name", F.when(F.col("_r"), F.col("r.text")).otherwise(F.col("raw")).alias("text"),
        F.when(F.col("_r"), F.col("r.error")).alias("error"))
    if max_bytes is not None:
        out = out.unionByName(oversized_files(spark, folder, max_bytes))
    out = materialize(out, "folder")
    return out.select(F.col("source_name").alias("doc_id"), "source_name", "text", "error")


def preprocess_folder(spark: SparkSession, folder: str, max_bytes: int | None = None,
                      extractors: dict[str, Callable[[bytes], str]] | None = None,
                      **chunking) -> tuple[DataFrame, DataFrame]:
    """The ``preprocess`` command: a folder -> (chunk table, rejects)."""
    from ..plans.pipeline import preprocess
    good, rejects = split_rejects(read_folder(spark, folder, max_bytes, extractors))
    return preprocess(good.drop("error"), **chunking), rejects


def _extract_udf(fn: Callable[[bytes], str]):
    @F.pandas_udf(_TEXT_ERROR)
    def run(content: pd.Series) -> pd.DataFrame:
        texts, errors = [], []
        for b in content:
            try:
                texts.append(None if b is None else (fn(bytes(b)) or ""))
                errors.append(None)
            except Exception as e:  # noqa: BLE001 -- a bad file never fails the job
                texts.append("")
                errors.append(f"{type(e).__name__}: {e}")
        return pd.DataFrame({"text": texts, "error": errors})
    return run


def split_rejects(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable documents, rejects with their error)."""
    return docs.where(F.col("error").isNull()), docs.where(F.col("error").isNotNull())


def integer_stem_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id bigint, text)`` for ``<int>.<ext>`` files, text with line ends
    as ``\\n`` (no cleaning or chunking); other names are skipped."""
    files = scan_folder(spark, folder).where(F.col("suffix") != "")
    ids = files.select(file_stem("source_name").try_cast("bigint").alias("doc_id"), "content")
    return ids.where(F.col("doc_id").isNotNull()).select(
        "doc_id", F.regexp_replace(utf8_text("content"), "\r\n?", "\n").alias("text"))
