"""Ground truth derived from the tables: a query's relevant documents are the
documents whose whitespace-normalised text contains the whitespace-normalised
query passage.

This is a substring (theta) join.  Instead of a nested-loop join of queries x
documents, the passages -- the small side, size-checked -- are compiled once per
task into an Aho-Corasick automaton and every document is scanned once, so the
work is linear in the corpus.  Pattern sets above the broadcast limit are split
into blocks, each scanning the corpus once.  Output is long
``(qid, relevant)``: one row per (query, document) match, never a collected
list.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text
from ..session import DEFAULT_BROADCAST_BYTES

try:  # optional accelerator; plain ``in`` scanning is the fallback
    import ahocorasick  # type: ignore
except Exception:  # pragma: no cover
    ahocorasick = None


def _pattern_blocks(queries: DataFrame, limit: int):
    pats = (queries.select(F.col("qid").cast("string").alias("qid"),
                           clean_text("query").alias("p"))
            .where(F.col("p").isNotNull()))
    block, size = [], 0
    for r in pats.toLocalIterator():
        b = len(r["p"].encode("utf-8")) + len(r["qid"]) + 64
        if block and size + b > limit:
            yield block
            block, size = [], 0
        block.append((r["qid"], r["p"]))
        size += b
    if block:
        yield block


def _matcher(block):
    empty = [q for q, p in block if p == ""]
    if ahocorasick is not None:
        auto = ahocorasick.Automaton()
        by_pat: dict[str, list[str]] = {}
        for q, p in block:
            if p:
                by_pat.setdefault(p, []).append(q)
        for p, qs in by_pat.items():
            auto.add_word(p, qs)
        if by_pat:
            auto.make_automaton()

            def find(text: str) -> set[str]:
                found = set(empty)
                for _, qs in auto.iter(text):
                    found.update(qs)
                return found
            return find

    def find_plain(text: str) -> set[str]:
        return {q for q, p in block if p in text}
    return find_plain


def derive_truth(docs: DataFrame, queries: DataFrame,
                 max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``docs(source_name, text)`` x ``queries(qid, query)`` -> ``(qid, relevant)``
    for every document containing the query passage (both whitespace-normalised)."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    # the scan splits at the white space that ``clean_text`` maps
    raw = docs.where(F.col("text").isNotNull()) \
        .select("source_name", F.col("text").cast("string").cast("binary").alias("text"))
    parts = []
    for block in _pattern_blocks(queries, max_broadcast_bytes):
        bc = sc.broadcast(block)

        def scan(batches, bc=bc):
            find = _matcher(bc.value)
            for pdf in batches:
                qs, names = [], []
                for name, text in zip(pdf["source_name"], pdf["text"]):
                    for q in find(" ".join(text.decode("utf-8", "replace").split())):
                        qs.append(q)
                        names.append(name)
                yield pd.DataFrame({"qid": qs, "relevant": names}, dtype=object)

        parts.append(raw.mapInPandas(scan, "qid string, relevant string"))
    if not parts:
        return spark.createDataFrame([], "qid string, relevant string")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()
