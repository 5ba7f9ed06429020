"""One scan of the postings for any number of queries (Q3).

``ivf_search`` sends one block of queries to the postings.  Here probes and postings meet
in a shuffle instead: both are grouped by ``(bucket, part, query part)``, where a bucket is
a run of lists that share a folder, its rows are cut into parts of at most ``PART_ROWS``
(fewer for wide vectors: ``GRID_BYTES``) and its queries into parts of at most
``PART_QUERIES`` (fewer for a large k: ``PART_ANSWERS``).  A bucket that holds a third of
all rows, or that a third of all queries probe, is therefore many groups of bounded size.
The postings are read once and no query passes through the driver, which gets two numbers
for each bucket (set by the number of lists).  A query goes to a bucket once, with all the
lists that it probes there.  If all lists are probed, all postings are one bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..session import materialize, shuffle_partitions
from .ivf import DEFAULT_NPROBE, LISTS_PER_BUCKET, IvfIndex, _prep, centroid_matrix, codebook_tensor
from .knn import (NONE, PART_ANSWERS, SCORED, TWO_LEVEL_GROUPS, TWO_LEVEL_MIN_PARTITIONS, _side, meet,
                  top_k_per_query)
from .search import _meta, probe_lists, scan_lists

PART_ROWS = 1 << 16
PART_QUERIES = 1 << 16


def _counts(rows: DataFrame) -> dict[int, int]:
    return {r[0]: r[1] for r in rows.groupBy("list_bucket").count().collect()}


def shared_search(index: IvfIndex, queries: DataFrame, k: int, nprobe: int = DEFAULT_NPROBE,
                  qid_col: str = "qid", vec_col: str = "embedding", probes: DataFrame | None = None) -> DataFrame:
    """Q3 + Q4 as :func:`quarry.operators.search.ivf_search`, with the same rows
    ``(qid, id, score, rank)``: unique query ids, null vectors give no rows.  ``probes(qid,
    list_id)`` takes the place of the flat probe (flat postings only)."""
    meta = _meta(index)
    metric = meta["metric"]
    if k < 1:
        raise ValueError("k must be >= 1")
    if probes is not None and index.is_pq:
        raise ValueError("given probes need flat postings")
    spark = queries.sparkSession
    present = queries.where(F.col(vec_col).isNotNull()).select(
        F.col(qid_col).cast("string").alias("qid"), F.col(vec_col).alias("embedding"))
    n_q, n_ids = present.agg(F.count(F.lit(1)), F.count_distinct("qid")).first()
    if n_ids != n_q:
        raise ValueError("query ids must be unique and not null")
    postings = index.postings
    payload = "codes" if index.is_pq else "embedding"
    full = probes is None and nprobe >= meta["nlist"]
    if full:            # every list is probed by every query: one bucket with all of them
        one = F.lit(0).alias("list_bucket")
        asked = present.select(one, "qid", "embedding", F.lit(None).cast("array<int>").alias("lists"))
        rows = postings.select(one, "list_id", "id", payload)
        n_asked, n_rows = {0: n_q}, {0: postings.count()}
    else:
        if probes is None:
            probes = probe_lists(present, index.centroids, nprobe, metric)
        bucket = F.floor(F.col("list_id") / LISTS_PER_BUCKET).cast("int")
        # a query's lists of a bucket: at most as many as a bucket has
        asked = materialize(probes.select("qid", "list_id", bucket.alias("list_bucket")).groupBy("qid", "list_bucket").agg(
            F.collect_list("list_id").alias("lists")).join(present, "qid"), "shared-probes")
        n_asked = _counts(asked)
        if "list_bucket" not in postings.columns:
            postings = postings.withColumn("list_bucket", bucket)
        rows = postings.where(F.col("list_bucket").isin(sorted(n_asked))).select("list_bucket", "list_id", "id", payload)
        n_rows = _counts(rows)                  # of a partition column: no data are read
        # neighbouring buckets share a group while they fit one, so that a query's rows are
        # cut to k over many lists before they are shuffled
        side, run, held, runs = _side(meta["dim"], PART_ROWS), -1, 0, {}
        for b in sorted(n_rows):
            if run < 0 or held + n_rows[b] > side:
                run, held = run + 1, 0
            runs[b], held = run, held + n_rows[b]
        if runs:
            of_run = F.broadcast(spark.createDataFrame(list(runs.items()), "list_bucket int, run int"))
            rows, asked = (df.join(of_run, "list_bucket").drop("list_bucket").withColumnRenamed("run", "list_bucket")
                           for df in (rows, asked))
        by_run = {run: [b for b in runs if runs[b] == run] for run in set(runs.values())}
        n_rows, n_asked = ({run: sum(n[b] for b in bs) for run, bs in by_run.items()} for n in (n_rows, n_asked))
        n_asked = {run: min(n, n_q) for run, n in n_asked.items()}
    n_rows = {b: n for b, n in n_rows.items() if n}
    if not n_rows or not n_q:
        return spark.createDataFrame([], SCORED + ", rank int")
    bc = spark.sparkContext.broadcast(
        (centroid_matrix(index.centroids, metric), codebook_tensor(index.codebooks)) if index.is_pq else (None, None))

    def scan(rows: pa.Table, probing: pa.Table) -> pa.Table:
        if not rows.num_rows or not probing.num_rows:
            return pa.Table.from_batches([], NONE)
        # a query has a row for each of the buckets that share the group
        codes = probing.column("qid").combine_chunks().dictionary_encode()
        number, qids = codes.indices.to_numpy(), codes.dictionary
        _, first = np.unique(number, return_index=True)
        q, _ = V.list_column_matrix(probing.column("embedding").combine_chunks().take(pa.array(first)))
        by_list = None
        if not full:
            lists = probing.column("lists").combine_chunks()
            owner, flat = number[lists.value_parent_indices().to_numpy()], lists.flatten().to_numpy()
            order = np.argsort(flat, kind="stable")
            found, first = np.unique(flat[order], return_index=True)
            by_list = dict(zip(found.tolist(), np.split(owner[order], first[1:])))
            rows = rows.sort_by([("list_id", "ascending"), ("id", "ascending")])
        out = list(scan_lists(rows.combine_chunks().to_batches(), qids, _prep(q, metric), *bc.value, by_list, metric, k))
        return pa.Table.from_batches(out, NONE)

    scored, n_groups = meet(rows, asked, n_rows, n_asked, _side(meta["dim"], PART_ROWS),
                            _side(meta["dim"], min(PART_QUERIES, max(1, PART_ANSWERS // k))), scan)
    groups = TWO_LEVEL_GROUPS if not full and max(shuffle_partitions(spark), n_groups) > TWO_LEVEL_MIN_PARTITIONS else 1
    return top_k_per_query(scored, k, metric, groups=groups)
