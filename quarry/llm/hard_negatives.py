"""Hard negatives by a secondary sort (operator 11).

An anchor's positives are its best-scoring rows of the same label; the hard negatives
of a positive are the best rows of other labels whose score lies in a window below
the positive's.  Pair scores are packed into byte keys that sort as (anchor, score
from high to low, positives first, id).  One shuffle by anchor with a sort inside the
partitions brings every anchor's pairs in that order to a streaming iterator: a
positive opens its window, later rows of other labels are emitted to the windows that
are open, and a window closes when it is full or the scores have fallen below it.  The
iterator holds one row and a few windows, never an anchor's pairs.  (``repartition`` by
anchor and ``sortWithinPartitions`` are the DataFrame form of the RDD call
``repartitionAndSortWithinPartitions``; the sort runs and spills in the JVM.)

Not every pair is shuffled.  A first pass of the same kind finds the positives: each
task keeps its best few rows of the anchor's label.  With their scores known, each
task keeps for every window its best few rows inside it.  What a task leaves out is
preceded there by as many rows as a window can return, so nothing is lost, and an
anchor gets a bounded number of rows from each task.

Anchors go to the tasks in blocks of a fixed size; the result of each is written
before the next is sent.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table
from .maxscore import EXACT, _matrices

POSITIVES = 5
NEGATIVES = 5
LOWEST = 80                 # per cent of the positive's score that a negative needs
SCALE = 256
ANCHOR_EVERY = 100
RELABEL_EVERY = 7
LABELS = 10
BLOCK_BYTES = 16 << 20      # of anchors sent to the tasks at a time
SCORE_CELLS = 4 << 20       # scores computed together in a task
KEYS = "anchor_id bigint, key binary"
POSITIVE, NEGATIVE = 0, 1

_U = np.uint64
_SIGN = _U(1 << 63)


def labelled_vectors(df: DataFrame, id_col: str, vec_col: str, label, scale: int = SCALE) -> DataFrame:
    """``(id, label, w)``: each component x as ``floor(scale * x)``.  Rows with a null
    id or label, a null vector, or a null, NaN or infinite component take no part."""
    x = F.transform(F.col(vec_col), lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"),
                     F.when(~F.coalesce(bad, F.lit(True)), F.transform(
                         x, lambda v: F.floor(v * float(scale)).cast("bigint"))).alias("w"))
    return rows.where("id IS NOT NULL AND label IS NOT NULL AND w IS NOT NULL")


# ------------------------------------------------------------------ keys

def _ordered(x: np.ndarray) -> np.ndarray:
    return (x.astype(np.int64).view(_U) ^ _SIGN).astype(">u8").view(np.uint8).reshape(-1, 8)


def pack(anchor: np.ndarray, score: np.ndarray, kind: np.ndarray, row: np.ndarray) -> pa.Array:
    """25 bytes that sort as (anchor, score from high to low, kind, row id)."""
    out = np.empty((len(anchor), 25), np.uint8)
    out[:, :8], out[:, 8:16] = _ordered(anchor), ~_ordered(score)
    out[:, 16], out[:, 17:] = kind, _ordered(row)
    offsets = pa.array(np.arange(0, 25 * len(out) + 1, 25, dtype=np.int32))
    return pa.BinaryArray.from_buffers(pa.binary(), len(out), [None, offsets.buffers()[1], pa.py_buffer(out.tobytes())])


def unpack(keys: pa.Array):
    """``(anchor, score, kind, row id)`` of an array of keys."""
    raw = np.frombuffer(b"".join(keys.to_pylist()), np.uint8).reshape(-1, 25)

    def number(part):
        return (np.ascontiguousarray(part).view(">u8").ravel().astype(_U) ^ _SIGN).view(np.int64)

    return number(raw[:, :8]), number(~raw[:, 8:16]), raw[:, 16], number(raw[:, 17:])


# ------------------------------------------------------------------ scores in the tasks

class Anchors:
    """A block of anchors of one vector length."""

    def __init__(self, ids, labels, weights, windows=None):
        self.ids, self.labels, self.w = np.array(ids, np.int64), np.array(labels, np.int64), weights
        # scores of each anchor's positives, different ones only
        self.windows = [sorted(set(p), reverse=True) for p in windows] if windows is not None else None
        self.most = float(np.abs(weights.astype(float)).sum(axis=1).max(initial=0))

    def tiles(self, ids: np.ndarray, labels: np.ndarray, weights: np.ndarray):
        """Scores of all anchors with some rows at a time: (row ids, labels, scores)."""
        exact = self.most * float(np.abs(weights.astype(float)).max(initial=0)) < EXACT
        kind = np.float64 if exact else np.int64        # beyond: 64-bit whole numbers
        a, step = self.w.astype(kind), max(1, SCORE_CELLS // len(self.ids))
        for at in range(0, len(ids), step):
            part = slice(at, at + step)
            yield ids[part], labels[part], (a @ weights[part].astype(kind).T).astype(np.int64)


def _best(score: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return np.lexsort((ids, -score))


class Positives:
    """The best ``k`` rows of each anchor's label seen by a task."""

    kind = POSITIVE

    def __init__(self, block: Anchors, k: int):
        self.block, self.k = block, k
        self.floor = np.full(len(block.ids), np.iinfo(np.int64).min)
        self.held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def add(self, ids, labels, weights):
        b = self.block
        for row, label, score in b.tiles(ids, labels, weights):
            hit = (label == b.labels[:, None]) & (row != b.ids[:, None]) & (score >= self.floor[:, None])
            for a in np.flatnonzero(hit.any(axis=1)):
                s, i = score[a, hit[a]], row[hit[a]]
                if a in self.held:
                    s, i = np.concatenate([self.held[a][0], s]), np.concatenate([self.held[a][1], i])
                top = _best(s, i)[:self.k]
                self.held[a] = s[top], i[top]
                if len(top) == self.k:
                    self.floor[a] = s[top[-1]]


class Negatives:
    """For each window of each anchor, the best ``k`` rows of other labels in it."""

    kind = NEGATIVE

    def __init__(self, block: Anchors, k: int, lowest: int):
        self.block, self.k = block, k
        # a positive below zero has an empty window
        self.windows = [[(_least(p, lowest), p) for p in w if p >= 0] for w in block.windows]
        self.high = np.array([max((p for _, p in w), default=-1) for w in self.windows], np.int64)
        self.floor = np.array([min((lo for lo, _ in w), default=0) for w in self.windows], np.int64)
        self.held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def add(self, ids, labels, weights):
        b = self.block
        for row, label, score in b.tiles(ids, labels, weights):
            hit = (label != b.labels[:, None]) & (row != b.ids[:, None])
            hit &= (score <= self.high[:, None]) & (score >= self.floor[:, None])
            for a in np.flatnonzero(hit.any(axis=1)):
                s, i = score[a, hit[a]], row[hit[a]]
                if a in self.held:
                    s, i = np.concatenate([self.held[a][0], s]), np.concatenate([self.held[a][1], i])
                order = _best(s, i)
                s, i = s[order], i[order]
                keep, floor = np.zeros(len(s), bool), []
                for lo, p in self.windows[a]:
                    at = int(np.searchsorted(-s, -p))       # first score of at most p
                    to = min(at + self.k, int(np.searchsorted(-s, -lo, side="right")))
                    keep[at:to] = True
                    floor.append(int(s[to - 1]) if to == at + self.k else lo)
                self.floor[a] = min(floor)
                self.held[a] = s[keep], i[keep]


def _least(positive: int, lowest: int) -> int:
    """The smallest whole score with ``100 * score >= lowest * positive``."""
    return -(-lowest * positive // 100)


def _keys(block, make):
    """Task: rows in, the packed pairs that its ``make(anchors)`` keeps out."""
    def run(batches):
        kept = {n: make(a) for n, a in block.value.items()}
        for rb in batches:
            if not rb.num_rows:
                continue
            ids = rb.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
            labels = rb.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
            for n, rows, weights in _matrices(pa.concat_arrays([rb.column("w")])):
                if n in kept:
                    kept[n].add(ids[rows], labels[rows], weights)
        for found in kept.values():
            for a, (s, i) in found.held.items():
                if len(s):
                    own = np.full(len(s), found.block.ids[a])
                    kind = np.full(len(s), found.kind, np.uint8)
                    yield pa.RecordBatch.from_arrays([pa.array(own), pack(own, s, kind, i)], names=["anchor_id", "key"])
    return run


# ------------------------------------------------------------------ the sorted stream

def _sorted_by_key(pairs: DataFrame) -> DataFrame:
    return pairs.repartition("anchor_id").sortWithinPartitions("key")


def first_positives(k: int):
    """Streaming iterator: the first ``k`` pairs of each anchor."""
    def run(batches):
        anchor, n = None, 0
        for rb in batches:
            anchors = rb.column("anchor_id").to_pylist()
            keep = []
            for at, a in enumerate(anchors):
                anchor, n = (a, n + 1) if a == anchor else (a, 1)
                if n <= k:
                    keep.append(at)
            a, s, _, i = unpack(rb.column("key").take(pa.array(keep, pa.int64())))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(i), pa.array(s)],
                                             names=["anchor_id", "positive_id", "positive_score"])
    return run


def open_windows(k: int, lowest: int):
    """Streaming iterator: positives open windows, later rows of other labels go to
    every open window that has room and whose scores they have not left."""
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]

    def run(batches):
        anchor, windows = None, []
        for rb in batches:
            out = []
            for a, s, kind, i in zip(*(x.tolist() for x in unpack(rb.column("key")))):
                if a != anchor:
                    anchor, windows = a, []
                if kind == POSITIVE:
                    windows.append([i, s, _least(s, lowest), 0])
                    continue
                windows = [w for w in windows if w[3] < k and s >= w[2]]
                for w in windows:
                    w[3] += 1
                    out.append((a, w[0], w[3], i, w[1], s))
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if n == "rank" else pa.int64()) for n, c in zip(names, cols)], names=names)
    return run


def mine_hard_negatives(vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES,
                        negatives: int = NEGATIVES, lowest: int = LOWEST,
                        block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(id, label, w)`` rows and anchors -> ``(anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score)``.

    Of each anchor, the ``positives`` rows of its label with the highest inner
    products; for each of these, the ``negatives`` best rows of other labels with
    ``lowest`` per cent to 100 per cent of its score, ranked from 1; ties to the
    smaller id.  A positive without such rows gives none.  Rows with the anchor's id
    are neither; vectors of other lengths don't meet the anchor.  Of anchor rows that
    share an id, the least by (label, vector) counts; other rows that repeat an id
    are rows of their own, so repeated rows may give equal results.  Rows with nulls
    take no part.  Scores must fit 64 bits."""
    spark = vectors.sparkSession
    vectors = vectors.select("id", "label", "w").where("id IS NOT NULL AND label IS NOT NULL AND w IS NOT NULL")
    anchors = anchors.where("id IS NOT NULL AND label IS NOT NULL AND w IS NOT NULL")
    anchors = materialize(anchors.groupBy("id").agg(F.min(F.struct("label", "w")).alias("v"))
                          .select("id", "v.label", "v.w"), "anchors")
    size = anchors.agg(F.sum(F.size("w") * 8 + 64 + 8 * positives)).first()[0] or 0
    blocks = max(1, -(-int(size) * 2 // block_bytes))

    def pairs(make, rows: DataFrame, windows: bool):
        parts = []
        for b in range(blocks):
            mine = rows.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()    # <= block_bytes
            block = {}
            for n in {len(r["w"]) for r in mine}:
                same = [r for r in mine if len(r["w"]) == n]
                block[n] = Anchors([r["id"] for r in same], [r["label"] for r in same],
                                   np.array([r["w"] for r in same], np.int64).reshape(len(same), n),
                                   [r["scores"] for r in same] if windows else None)
            out = vectors.mapInArrow(_keys(spark.sparkContext.broadcast(block), make), KEYS)
            parts.append(materialize(out, "pairs") if blocks > 1 else out)
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    found = pairs(lambda a: Positives(a, positives), anchors, False)
    best = materialize(_sorted_by_key(found).mapInArrow(
        first_positives(positives), "anchor_id bigint, positive_id bigint, positive_score bigint"), "positives")
    # at most `positives` scores for each anchor
    scores = best.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list("positive_score").alias("scores"))
    found = pairs(lambda a: Negatives(a, negatives, lowest), anchors.join(scores, "id"), True)

    def as_keys(batches):
        for rb in batches:
            a, s, i = (rb.column(c).to_numpy() for c in ("anchor_id", "positive_score", "positive_id"))
            yield pa.RecordBatch.from_arrays([rb.column("anchor_id"), pack(a, s, np.full(len(a), POSITIVE, np.uint8), i)],
                                             names=["anchor_id", "key"])

    stream = _sorted_by_key(best.mapInArrow(as_keys, KEYS).unionByName(found))
    return stream.mapInArrow(open_windows(negatives, lowest),
                             "anchor_id bigint, positive_id bigint, rank int, negative_id bigint,"
                             " positive_score bigint, negative_score bigint")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    rows = labelled_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", label)
    return mine_hard_negatives(rows, rows.where(F.col("id") % ANCHOR_EVERY == 0))


ORACLE_OP11 = f"""
WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % {RELABEL_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor({SCALE}::DOUBLE * x::DOUBLE) AS BIGINT)) AS w
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor_id, c.id, a.label = c.label AS same,
             CAST(list_sum(list_transform(list_zip(a.w, c.w), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v a JOIN v c ON a.id <> c.id WHERE a.id % {ANCHOR_EVERY} = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES}),
n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score,
             CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, s.id) AS INTEGER) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
       AND {LOWEST} * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}"""
