"""Exact top-k search by MaxScore over sharded postings (operator 2).

Terms are the positions of a vector; a posting is a candidate's whole-number
weight at a position.  Each task holds a shard of the candidates as postings
(one weight array per term) with the lowest and highest weight of every term.
For a query, a term's contribution lies between two bounds known from these; the
*spread* between them is how much the term can still tell candidates apart.
Terms are split so that the spreads of the non-essential ones cannot lift a
candidate over the current k-th score by themselves (from the lowest score that the
bounds allow): the essential postings are traversed for all candidates of a block,
and only candidates that stay competitive are probed in the other terms, largest
spread first.  A shard's first k-th score comes from a few candidates scored in full;
at least eight terms are essential.  Shards keep
their k best per query; a merge by query gives the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table

TOP_K = 10
SCALE = 1024
QUERY_EVERY = 100
QUERY_BLOCK_BYTES = 16 << 20        # of query vectors sent to the tasks at a time
POSTINGS_ROWS = 8192                # candidates of a shard block
FIRST_ROWS = 64                     # candidates scored in full for a first k-th score
EXACT = 1 << 53                     # whole numbers below this are exact as doubles


def whole_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """``(id, w)``: each component x as ``floor(scale * x)``.  Vectors that are
    null or hold a null, NaN or infinite component take no part."""
    x = F.transform(F.col(vec_col), lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (df.where(F.col(vec_col).isNotNull() & ~F.coalesce(bad, F.lit(True)))
            .select(F.col(id_col).cast("bigint").alias("id"),
                    F.transform(x, lambda v: F.floor(v * float(scale)).cast("bigint")).alias("w")))


def _matrices(column: pa.Array):
    """Rows of a list column by vector length: ``{length: (rows, matrix)}``."""
    off = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.int64)
    length = np.diff(off)
    for n in np.unique(length):
        rows = np.nonzero(length == n)[0]
        yield int(n), rows, flat[off[rows][:, None] + np.arange(n)]


def essential(lowest: float, span: np.ndarray, floor: float) -> int:
    """How many leading terms are essential: the spreads of the others (``span[t]``
    from term t on) don't lift a candidate of the lowest score to ``floor``."""
    n = len(span) - 1
    below = lowest + span < floor
    return min(max(int(np.argmax(below)) if below.any() else n, 8), n)


class Postings:
    """A block of candidates as weights per term, with the terms' bounds."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, terms = ids[order], np.ascontiguousarray(weights[order].T)
        self.low = terms.min(axis=1) if terms.size else np.zeros(len(terms), np.int64)
        self.high = terms.max(axis=1) if terms.size else np.zeros(len(terms), np.int64)
        self.terms, self.most = terms, float(np.abs(terms.astype(float)).max(initial=0))

    def search(self, q: np.ndarray, own: int, k: int, floor: float):
        """The k best candidates that may beat ``floor`` (a score already reached
        k times): (scores, ids), ties to the smaller id."""
        exact = np.abs(q).astype(float).sum() * self.most < EXACT
        kind = np.float64 if exact else np.int64        # beyond: 64-bit whole numbers
        w, q = self.terms, q.astype(kind)
        top = np.maximum(q * self.low.astype(kind), q * self.high.astype(kind))
        low = np.minimum(q * self.low.astype(kind), q * self.high.astype(kind))
        order = np.argsort(-(top - low), kind="stable")         # largest spread first
        rest = np.append(np.cumsum(top[order][::-1])[::-1], kind(0))   # upper bound of terms from t on
        least = np.append(np.cumsum(low[order][::-1])[::-1], kind(0))
        live = np.nonzero(self.ids != own)[0]
        if not len(live):
            return live.astype(np.int64), live.astype(np.int64)
        if floor == -np.inf and exact and len(live) > FIRST_ROWS >= k:
            full = q @ w[:, live[:FIRST_ROWS]].astype(kind)
            floor = np.partition(full, len(full) - k)[len(full) - k]
        t = essential(least[0], rest - least, floor) if exact else len(q)
        part = order[:t]
        score = (q[part] @ w[part].astype(kind))[live]
        while t < len(q):
            # k candidates are certain to reach this score
            sure = score + least[t]
            mark = max(floor, np.partition(sure, len(sure) - k)[len(sure) - k]) if len(sure) > k else floor
            stay = score + rest[t] >= mark
            if not stay.all():
                live, score = live[stay], score[stay]
            if not len(live):
                break
            part = order[t:t + 8]                               # probe
            t += len(part)
            score = score + q[part] @ w[np.ix_(part, live)].astype(kind)
        if len(live) > k:
            mark = np.partition(score, len(score) - k)[len(score) - k]
            stay = score >= mark
            live, score = live[stay], score[stay]
        best = np.lexsort((self.ids[live], -score))[:k]
        return score[best].astype(np.int64), self.ids[live[best]]


def _search_shard(queries, k: int):
    def run(batches):
        found: dict[int, list] = {}
        floor = [-np.inf] * len(queries.value)

        def block(ids, weights):
            p = Postings(ids, weights)
            for n, (qid, q) in enumerate(queries.value):
                if len(q) != len(p.terms):
                    continue
                s, c = p.search(q, qid, k, floor[n])
                if not len(s):
                    continue
                have = found.get(n)
                if have is not None:
                    s, c = np.concatenate([have[0], s]), np.concatenate([have[1], c])
                best = np.lexsort((c, -s))[:k]
                found[n] = (s[best], c[best])
                if len(best) == k:
                    floor[n] = float(s[best[-1]]) if abs(int(s[best[-1]])) < EXACT else -np.inf

        for rb in batches:
            for at in range(0, rb.num_rows, POSTINGS_ROWS):
                part = rb.slice(at, POSTINGS_ROWS)
                ids = part.column("id").to_numpy(zero_copy_only=False)
                for _, rows, weights in _matrices(pa.concat_arrays([part.column("w")])):
                    block(ids[rows], weights)
        for n, (s, c) in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(s), queries.value[n][0])), pa.array(c), pa.array(s)],
                names=["query_id", "vec_id", "score"])
    return run


def top_k_search(candidates: DataFrame, queries: DataFrame, k: int = TOP_K,
                 block_bytes: int = QUERY_BLOCK_BYTES) -> DataFrame:
    """``(id, w)`` candidates and queries -> ``(query_id, rank, vec_id, score)``:
    each query's k largest inner products, ties to the smaller id.  Rows with the
    query's own id are no candidates; a query meets only vectors of its length;
    rows with null ids take no part; equal query rows are one query, and a query
    id that occurs with different vectors is an error.

    The queries go to the tasks in blocks of at most ``block_bytes``, cut by hash;
    each block's result is written before the next is sent."""
    spark = candidates.sparkSession
    candidates = candidates.where("id IS NOT NULL")
    queries = materialize(queries.where("id IS NOT NULL").distinct(), "queries")
    n, ids, size = queries.agg(F.count(F.lit(1)), F.count_distinct("id"),
                               F.sum(F.size("w") * 8 + 64)).first()
    if n != ids:
        raise ValueError("a query id occurs with different vectors")
    blocks = max(1, -(-int(size or 0) * 2 // block_bytes))
    parts = []
    for b in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()   # <= block_bytes
        bc = spark.sparkContext.broadcast([(r["id"], np.array(r["w"], np.int64)) for r in rows])
        out = candidates.mapInArrow(_search_shard(bc, k), "query_id bigint, vec_id bigint, score bigint")
        parts.append(materialize(out, "top-k") if blocks > 1 else out)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op2_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return top_k_search(vectors, vectors.where(F.pmod("id", F.lit(QUERY_EVERY)) == 0))


ORACLE_OP2 = f"""
WITH v AS (SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(floor({SCALE}::DOUBLE * x::DOUBLE) AS BIGINT)) AS w
           FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.id AS query_id, c.id AS vec_id,
             CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.id <> c.id WHERE q.id % {QUERY_EVERY} = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {TOP_K}"""
