"""Best-fit packing of documents into token sequences with large-item matching
(operator 5).

Documents are tokenized once, in place, into narrow piece rows.  Packing looks at
the number of pieces of each length only: at most ``capacity`` numbers, whatever
the size of the corpus.  From them the driver makes a plan -- which lengths go
together, how many times -- and every piece finds its sequence from its rank
among the pieces of its length.

Plan: lengths above a third of the capacity are matched greedily, the largest
with the largest partner that still fits, at most two to a sequence; shorter
ones, in falling order, go to the smallest gap that takes them, and open a new
sequence only if none does.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import (Recent, default_tokenizer, raw_texts, read_config, slices, worker_tokenizer)
from .common import materialize, table, worker_state

CAPACITY = 2048
END_ID = 0
SALTS = 256                 # parts a length's pieces are ranked in
WORD_CACHE = 450_000
RANK_BITS = 44              # ranks below 2^44, lengths below 2^19


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
                 end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenize every text, add ``end_id`` and cut what is longer than
    ``capacity`` into pieces: ``(id, piece, start, length, ids_crc32)``.  A null
    or empty text is the end id alone.  Ids of a piece exist only in the task."""
    config = docs.sparkSession.sparkContext.broadcast(read_config(tokenizer_path))

    def run(batches):
        tok = worker_tokenizer(config.value)
        words = worker_state().setdefault("word_ids", {}).setdefault(
            id(tok), Recent(lambda w: np.array(tok.word_ids(w), "<u4").tobytes(), WORD_CACHE))
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for rb in slices(batch, "t"):
                rows, piece, start, length, crc = [], [], [], [], []
                for r, raw in enumerate(raw_texts(rb.column("t"))):
                    if tok.spaced:
                        ids = b"".join(map(words.__getitem__, tok.prepare(raw).split())) + end
                    else:
                        ids = np.array(tok.ids(raw.decode("utf-8", "replace")), "<u4").tobytes() + end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at:at + 4 * capacity]
                        rows.append(r)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                yield pa.RecordBatch.from_arrays(
                    [rb.column("i").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                     pa.array(crc, pa.int64())],
                    names=["i", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).mapInArrow(
        run, f"i {kind}, piece int, start bigint, length bigint, ids_crc32 bigint") \
        .withColumnRenamed("i", id_col)


# ------------------------------------------------------------------ plan

def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple]:
    """``{length: pieces}`` -> rows ``(length, lo, hi, sequence, each, offset)``:
    pieces of ``length`` with rank in ``[lo, hi)`` go ``each`` to a sequence, the
    first to ``sequence`` at ``offset``, and so on.

    Sequences that are filled alike are handled together, so the work and the
    plan depend on the number of different lengths, not on the number of pieces."""
    left = {n: c for n, c in counts.items() if c > 0}
    if any(n < 1 or n > capacity for n in left):
        raise ValueError("piece lengths must lie in 1..capacity")
    used = dict.fromkeys(left, 0)
    plan, gaps = [], {}         # gap -> [(first sequence, number of sequences)]
    sizes = []                  # gaps that occur, sorted
    opened = 0

    def take(length, first, sequences, each, offset, n=None):
        n = sequences * each if n is None else n
        plan.append((length, used[length], used[length] + n, first, each, offset))
        used[length] += n
        left[length] -= n

    def leave(gap, first, sequences):
        if gap > 0 and sequences > 0:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((first, sequences))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        n = large[-1]
        k = bisect_left(large, capacity - n + 1) - 1    # the largest that fits beside it
        if k < 0:
            m = left[n]
            take(n, opened, m, 1, 0)
            leave(capacity - n, opened, m)
            opened += m
        elif large[k] == n:
            m = left[n] // 2
            if m:
                take(n, opened, m, 2, 0)
                leave(capacity - 2 * n, opened, m)
                opened += m
            if left[n]:         # one is over: the next smaller, if any, goes with it
                take(n, opened, 1, 1, 0)
                room = capacity - n
                if k > 0:
                    p = large[k - 1]
                    take(p, opened, 1, 1, n)
                    room -= p
                    if not left[p]:
                        large.remove(p)
                leave(room, opened, 1)
                opened += 1
        else:
            p = large[k]
            m = min(left[n], left[p])
            take(n, opened, m, 1, 0)
            take(p, opened, m, 1, n)
            leave(capacity - n - p, opened, m)
            opened += m
            if not left[p]:
                large.pop(k)
        if not left[n]:
            large.remove(n)

    for n in sorted((x for x in left if left[x]), reverse=True):
        while left[n]:
            k = bisect_left(sizes, n)
            if k == len(sizes):         # no gap takes it
                first, number, gap = opened, -(-left[n] // (capacity // n)), capacity
                opened += number
            else:
                gap = sizes[k]
                first, number = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    sizes.pop(k)
            each = gap // n
            full = min(number, left[n] // each)
            offset = capacity - gap
            if full:
                take(n, first, full, each, offset)
                leave(gap - each * n, first, full)
            rest = number - full
            if rest and left[n]:        # the last few: less than one sequence takes
                some = left[n]
                take(n, first + full, 1, each, offset, some)
                leave(gap - some * n, first + full, 1)
                rest -= 1
                full += 1
            if rest:
                leave(gap, first + full, rest)
    return plan


def rank_in_length(pieces: DataFrame, id_col: str, salts: int = SALTS) -> DataFrame:
    """Add ``rank``: 0.. within each length, without one window over a length.
    Pieces are dealt by a hash into ``salts`` parts of a length; the parts'
    counts (at most ``capacity * salts`` rows) give each part's first rank.
    Equal rows are counted first and expanded last, so a group of repeated rows
    is one row in between."""
    cols = [id_col, "piece", "start", "length", "ids_crc32"]
    rows = (pieces.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_salt", F.pmod(F.xxhash64(id_col, "piece", "ids_crc32"), F.lit(salts))))
    rows = materialize(rows, "pack-rows")
    parts = rows.groupBy("length", "_salt").agg(F.sum("_n").alias("_m"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    base = parts.select("length", "_salt", (F.sum("_m").over(before) - F.col("_m")).alias("_base"))
    inside = Window.partitionBy("length", "_salt").orderBy(*cols[:3], "ids_crc32").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = (rows.withColumn("_r", F.sum("_n").over(inside) - F.col("_n"))
              .join(base, ["length", "_salt"])
              .select(*cols, (F.col("_base") + F.col("_r")).alias("_first"), "_n"))
    return ranked.select(*cols, F.explode(F.sequence(
        F.col("_first"), F.col("_first") + F.col("_n") - 1)).alias("rank")), parts


def assign_sequences(ranked: DataFrame, plan: list[tuple], id_col: str) -> DataFrame:
    """Give each ranked piece its sequence and offset.  The plan goes to the
    tasks; its size depends on the capacity alone."""
    p = np.array(sorted(plan), dtype=np.int64).reshape(-1, 6)
    bc = ranked.sparkSession.sparkContext.broadcast((p[:, 0] << RANK_BITS | p[:, 1], p))

    def run(batches):
        keys, rows = bc.value
        for rb in batches:
            n = rb.column("length").to_numpy()
            r = rb.column("rank").to_numpy()
            at = rows[np.searchsorted(keys, n << RANK_BITS | r, side="right") - 1]
            k, i = np.divmod(r - at[:, 1], at[:, 4]) if len(r) else (r, r)
            yield pa.RecordBatch.from_arrays(
                [*[rb.column(c) for c in ("i", "piece", "start", "length", "ids_crc32")],
                 pa.array(at[:, 3] + k), pa.array(at[:, 5] + i * n)],
                names=["i", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    kind = ranked.schema[id_col].dataType.simpleString()
    return ranked.withColumnRenamed(id_col, "i").mapInArrow(
        run, f"i {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
             "sequence_id bigint, offset bigint").withColumnRenamed("i", id_col)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents: one row per piece, ``(id, piece, start, length,
    ids_crc32, sequence_id, offset)``.  Null text: as empty; null ids and
    repeated rows are packed like others; empty table: no rows; further columns
    are not read.  The result is a function of the rows, not of their order."""
    pieces = token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col)
    ranked, parts = rank_in_length(pieces, id_col)
    counts = {r[0]: r[1] for r in parts.groupBy("length").agg(F.sum("_m")).collect()}  # <= capacity
    return assign_sequences(ranked, plan_packing(counts, capacity), id_col)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_tokenizer())
