"""Two-level coarse quantiser (X5, X6, Q2 for many lists): cells, and lists in each cell.

A flat quantiser sends all centroids to every task and scores every row against every
list.  Here ``cells`` top centres (about the root of the number of lists) are broadcast,
and the lists are a table ``(cell, list_id, centroid)`` that never reaches the driver
whole: a row meets only the lists of its cell.

* A vector belongs to its nearest top centre, and there to the nearest list; ties go to
  the lower number.  This *is* the quantiser, in training, adding and probing alike.
* A cell gets lists in proportion to its training rows (at least one, at most
  ``CELL_LISTS``), numbered cell after cell.
* Rows and lists meet in ``(cell, part)`` groups of about ``PART_ROWS`` rows, so a cell
  with a third of all rows is many groups; where the lists fit a broadcast, rows aren't
  shuffled at all.
* Vectors and centres are whole numbers on a grid (``operators/kmeans.py``): every score
  and sum is exact, and the index is the same for any partitioning.

Null vectors take no part.  Fewer training rows than lists is an error.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions import vectors as V
from ..session import DEFAULT_BROADCAST_BYTES, KERNEL_BYTES, delete_path, scratch_path, scratch_table
from .ivf import (DEFAULT_NPROBE, MIN_TRAIN_PER_LIST, IvfIndex, layout_postings, read_postings,
                  training_sample, write_bulk)
from .kmeans import SUMS, Grid, _running_sums, first_rows, lloyd, nearest, parallel_start, scores, sums_batch
from .knn import check_metric
from .search import ivf_search
from .shared import shared_search

PART_ROWS = 8192            # rows of a cell that meet its lists in one group
CELL_LISTS = 4096           # lists of one cell, at most
LISTS = "cell int, list_id int, centroid array<double>"


@dataclass(frozen=True)
class Tree:
    grid: Grid
    tops: np.ndarray        # whole numbers, (cells x dim): set by parameters
    lists: DataFrame        # LISTS, whole numbers
    nlist: int

    @property
    def list_bytes(self) -> int:
        return self.nlist * (self.tops.shape[1] * 8 + 16)


@dataclass(frozen=True)
class TreeIndex:
    tree: Tree
    index: IvfIndex


def default_cells(nlist: int) -> int:
    """Top centres for ``nlist`` lists: the root, rounded up."""
    return max(1, math.isqrt(max(nlist, 1) - 1) + 1)


# ------------------------------------------------------------------ rows and their cells

def _best(s: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the ``n`` highest scores of each row, best first, ties to the lower."""
    return np.lexsort((np.broadcast_to(np.arange(s.shape[1]), s.shape), -s), axis=1)[:, :n]


def place(vectors: DataFrame, grid: Grid, tops: np.ndarray, vec_col: str = "embedding",
          n_cells: int = 1) -> DataFrame:
    """The rows with a vector and ``cell``, their nearest top centre; with ``n_cells``
    above 1, a row for each of the nearest cells.  No shuffle."""
    bc = vectors.sparkSession.sparkContext.broadcast(tops)
    n = min(n_cells, len(tops))

    def kernel(batches):
        c = bc.value
        for rb in batches:
            x, valid = V.list_column_matrix(rb.column(vec_col))
            if not len(x):
                continue
            x, rb = grid.rows(x), rb.filter(pa.array(valid))
            if n == 1:
                cell = nearest(x, c, grid.metric)
            else:
                step = max(1, KERNEL_BYTES // (24 * len(c)))
                cell = np.concatenate([_best(scores(x[at:at + step], c, grid.metric), n).ravel()
                                       for at in range(0, len(x), step)])
                rb = rb.take(pa.array(np.repeat(np.arange(len(x)), n)))
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(cell.astype(np.int32))],
                                             names=[*rb.schema.names, "cell"])

    rows = vectors.select(*[c for c in vectors.columns if c != "cell"])
    return rows.mapInArrow(kernel, StructType([*rows.schema, StructField("cell", IntegerType())]))


def _centres(lists: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    lists = lists.sort_by("list_id")
    return lists.column("list_id").to_numpy(), V.list_column_matrix(lists.column("centroid"))[0]


def _spread(rows: DataFrame, lists: DataFrame, counts: dict[int, int], key: str):
    """Rows and lists with ``part``: a row is in one part of its cell, a list in all.
    ``counts`` has one number for each cell."""
    parts = F.broadcast(rows.sparkSession.createDataFrame(
        [(c, -(-n // PART_ROWS)) for c, n in counts.items()], "cell int, parts int"))
    left = rows.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64(key), "parts").cast("int"))
    right = lists.join(parts, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return left.drop("parts"), right.drop("parts")


def _cell_counts(placed: DataFrame) -> dict[int, int]:
    return {r[0]: r[1] for r in placed.groupBy("cell").count().collect()}


def _in_cells(placed: DataFrame, tree: Tree, kernel, schema: str, key: str, broadcast_bytes: int) -> DataFrame:
    """``kernel(rows, list ids, centres)`` for the rows of each cell, in groups of any
    size: beside broadcast lists up to ``broadcast_bytes``, else by a shuffle."""
    if tree.list_bytes > broadcast_bytes:
        left, right = _spread(placed, tree.lists, _cell_counts(placed), key)
        return left.groupBy("cell", "part").cogroup(right.groupBy("cell", "part")).applyInArrow(
            lambda rows, lists: kernel(rows, *_centres(lists)), schema)
    cell = tree.lists.orderBy("list_id").toArrow()
    numbers, (ids, centres) = cell.sort_by("list_id").column("cell").to_numpy(), _centres(cell)
    edge = np.searchsorted(numbers, np.arange(len(tree.tops) + 1))      # lists are numbered cell after cell
    bc = placed.sparkSession.sparkContext.broadcast((ids, centres, edge))

    def beside(batches):
        ids, centres, edge = bc.value
        for rb in batches:
            if not rb.num_rows:
                continue
            rb = rb.take(pa.array(np.argsort(rb.column("cell").to_numpy(), kind="stable")))
            cells = rb.column("cell").to_numpy()
            cut = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]
            out = []
            for lo, hi in zip(cut, cut[1:]):
                own = slice(edge[cells[lo]], edge[cells[lo] + 1])
                out.append(kernel(pa.Table.from_batches([rb.slice(lo, hi - lo)]), ids[own], centres[own]))
            yield from pa.concat_tables(out).combine_chunks().to_batches()

    return placed.mapInArrow(beside, schema)


# ------------------------------------------------------------------ training

def _rounds(rows: DataFrame, lists: DataFrame, counts: dict[int, int], grid: Grid, iters: int, path: str) -> DataFrame:
    """At most ``iters`` Lloyd rounds inside the cells; ends when no list moves.  The
    lists of each round are a table; the driver gets a count."""
    spark = rows.sparkSession

    def partial(rows: pa.Table, lists: pa.Table) -> pa.Table:
        ids, c = _centres(lists)
        if not rows.num_rows or not len(ids):
            return pa.table({"key": pa.array([], pa.int32()), "s": pa.array([], pa.list_(pa.int64())),
                             "n": pa.array([], pa.int64())})
        x = grid.rows(V.list_column_matrix(rows.column("embedding"))[0])
        s, n = V.group_sums(x, nearest(x, c, grid.metric), len(ids))
        rb = sums_batch(s.astype(np.int64), n)
        return pa.table({"key": pa.array(ids[rb.column("key").to_numpy()].astype(np.int32)),
                         "s": rb.column("s"), "n": rb.column("n")})

    def move(batches):
        for rb in batches:
            if not rb.num_rows:
                continue
            old, _ = V.list_column_matrix(rb.column("centroid"))
            s, some = V.list_column_matrix(rb.column("s"), np.int64)
            sums, n = np.zeros(old.shape, np.int64), np.zeros(len(old), np.int64)
            if len(s):
                sums[some] = s
                n[some] = rb.column("n").drop_null().to_numpy()
            new = grid.centre(sums, n, old)
            yield pa.RecordBatch.from_arrays(
                [rb.column("cell"), rb.column("list_id"), V.matrix_to_list_array(new, pa.float64()),
                 pa.array((new != old).any(axis=1))], names=["cell", "list_id", "centroid", "moved"])

    left, _ = _spread(rows, lists, counts, "id")
    # partitioned once for all rounds; what the cache loses is read and shuffled again
    left = left.repartition("cell", "part").persist()
    before = None
    for r in range(iters):
        _, right = _spread(rows, lists, counts, "id")
        sums = left.groupBy("cell", "part").cogroup(right.groupBy("cell", "part")).applyInArrow(
            partial, SUMS).repartition("key").mapInArrow(_running_sums, SUMS).withColumnRenamed("key", "list_id")
        now = f"{path}-{r}"
        lists.join(sums, "list_id", "left").select("cell", "list_id", "centroid", "s", "n").mapInArrow(
            move, LISTS + ", moved boolean").write.parquet(now)
        moved = spark.read.parquet(now)
        lists = moved.drop("moved")
        if before:
            delete_path(spark, before)
        before = now
        if not moved.where("moved").limit(1).count():
            break
    left.unpersist()
    return lists


def train_tree(sample: DataFrame, nlist: int, metric: str = "cosine", cells: int | None = None,
               train_iters: int = 20, seed: int = 42, start: str = "first", path: str | None = None) -> Tree:
    """Top centres by Lloyd rounds over ``sample(id, embedding)``, then the lists of all
    cells at once, beginning with each cell's first rows by id.  The tree's tables are
    written under ``path``.  Rounding shares down and the bound of a cell make the number
    of lists differ a little from ``nlist``: see ``Tree.nlist``."""
    check_metric(metric)
    if start not in ("first", "parallel"):
        raise ValueError("start must be 'first' or 'parallel'")
    spark = sample.sparkSession
    path = path or scratch_path(spark, "tree")
    sample = sample.select(F.col("id").cast("bigint").alias("id"), "embedding").where("embedding IS NOT NULL")
    total = sample.count()
    if not 1 <= nlist <= total:
        raise ValueError(f"{total} training vectors for {nlist} lists")
    cells = min(cells or default_cells(nlist), nlist)
    grid = Grid.of(sample, metric)
    tops = first_rows(sample, cells, grid, "id", "embedding") if start == "first" else \
        parallel_start(sample, cells, grid, seed)
    tops = lloyd(sample, tops, grid, train_iters)
    # a top centre that no row chose has no lists and goes; the others keep their rows
    tops = tops[sorted(_cell_counts(place(sample, grid, tops)))]
    with scratch_table(place(sample, grid, tops), "tree-rows") as rows:
        counts = _cell_counts(rows)
        shares, at = [], 0
        for c in sorted(counts):
            share = min(max(1, counts[c] * nlist // total), CELL_LISTS)
            shares.append((c, share, at))
            at += share
        plan = F.broadcast(spark.createDataFrame(shares, "cell int, share int, at int"))
        nth = F.row_number().over(Window.partitionBy("cell").orderBy("id"))
        # the literal bound lets each task keep a cell's first rows before the shuffle
        firsts = rows.withColumn("nth", nth).where(F.col("nth") <= max(s for _, s, _ in shares)) \
            .join(plan, "cell").where("nth <= share").withColumn("list_id", F.expr("at + nth - 1"))

        def on_grid(batches):
            for rb in batches:
                x, _ = V.list_column_matrix(rb.column("embedding"))
                if len(x):
                    yield pa.RecordBatch.from_arrays([rb.column("cell"), rb.column("list_id"), V.matrix_to_list_array(
                        grid.rows(x), pa.float64())], names=["cell", "list_id", "centroid"])

        begin = scratch_path(spark, "tree-lists")
        firsts.select("cell", "list_id", "embedding").mapInArrow(on_grid, LISTS).write.parquet(begin)
        lists = _rounds(rows, spark.read.parquet(begin), counts, grid, train_iters, begin)
        lists.write.mode("overwrite").parquet(f"{path}/lists")
        delete_path(spark, begin)
    spark.createDataFrame(pa.table({
        "cell": pa.array(np.arange(len(tops), dtype=np.int32)),
        "centroid": V.matrix_to_list_array(tops, pa.float64())})).write.mode("overwrite").parquet(f"{path}/tops")
    spark.createDataFrame([(metric, grid.raw, grid.scale, at)], "metric string, raw double, scale double, nlist int") \
        .write.mode("overwrite").parquet(f"{path}/tree")
    return load_tree(spark, path)


def load_tree(spark: SparkSession, path: str) -> Tree:
    meta = spark.read.parquet(f"{path}/tree").first()
    tops = spark.read.parquet(f"{path}/tops").orderBy("cell").toArrow()
    return Tree(Grid(meta["metric"], meta["raw"], meta["scale"]), V.list_column_matrix(tops.column("centroid"))[0],
                spark.read.parquet(f"{path}/lists"), meta["nlist"])


# ------------------------------------------------------------------ assignment and probing

def assign_tree(vectors: DataFrame, tree: Tree, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """X6 from the top down: ``(cell, list_id, id, embedding)`` of ``vectors(id, embedding)``."""
    grid = tree.grid

    def kernel(rows: pa.Table, ids: np.ndarray, c: np.ndarray) -> pa.Table:
        x = grid.rows(V.list_column_matrix(rows.column("embedding"))[0]) if rows.num_rows else np.zeros((0, c.shape[1]))
        lists = ids[nearest(x, c, grid.metric)] if len(ids) else np.zeros(0, np.int32)
        return pa.table({"cell": rows.column("cell"), "list_id": pa.array(lists.astype(np.int32)),
                         "id": rows.column("id"), "embedding": rows.column("embedding")})

    placed = place(vectors.select(F.col("id").cast("bigint").alias("id"),
                                  F.col("embedding").cast("array<float>").alias("embedding")), grid, tree.tops)
    return _in_cells(placed, tree, kernel, "cell int, list_id int, id bigint, embedding array<float>", "id",
                     broadcast_bytes)


def probe_tree(queries: DataFrame, tree: Tree, nprobe: int = DEFAULT_NPROBE, n_cells: int = 4,
               broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Q2 from the top down: of the lists of each query's ``n_cells`` nearest cells the
    ``nprobe`` nearest, ``(qid, list_id, coarse, probe_rank)``; ``coarse`` is the
    whole-number score on the grid, ties to the lower list."""
    grid = tree.grid

    def kernel(rows: pa.Table, ids: np.ndarray, c: np.ndarray) -> pa.Table:
        found, qids, out = [], [], []
        step = max(1, KERNEL_BYTES // (24 * max(len(ids), 1)))
        for at in range(0, rows.num_rows if len(ids) else 0, step):
            part = rows.slice(at, step)
            s = scores(grid.rows(V.list_column_matrix(part.column("embedding"))[0]), c, grid.metric)
            order = _best(s, nprobe)
            qids.append(part.column("qid").combine_chunks().take(pa.array(np.repeat(np.arange(len(s)), order.shape[1]))))
            found.append(ids[order].ravel())
            out.append(np.take_along_axis(s, order, 1).ravel())
        return pa.table({"qid": pa.chunked_array(qids, pa.string()),
                         "list_id": pa.array(np.concatenate([np.zeros(0, np.int32), *found]).astype(np.int32)),
                         "coarse": pa.array(np.concatenate([np.zeros(0), *out]).astype(np.int64))})

    placed = place(queries.select(F.col("qid").cast("string").alias("qid"), "embedding"), grid, tree.tops,
                   n_cells=n_cells)
    best = Window.partitionBy("qid").orderBy(F.desc("coarse"), "list_id")
    return _in_cells(placed, tree, kernel, "qid string, list_id int, coarse bigint", "qid", broadcast_bytes) \
        .withColumn("probe_rank", F.row_number().over(best)).where(F.col("probe_rank") <= nprobe)


# ------------------------------------------------------------------ index

def build_tree_index(vectors: DataFrame, nlist: int, metric: str = "cosine", cells: int | None = None,
                     n_train: int | None = None, train_iters: int = 20, seed: int = 42, start: str = "first",
                     path: str | None = None, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> TreeIndex:
    """An index of ``vectors(id, embedding)`` with a two-level quantiser and flat postings,
    in the folder layout of :func:`quarry.operators.ivf.build_index`."""
    spark = vectors.sparkSession
    path = path or scratch_path(spark, "tree-index")
    vectors = vectors.select(F.col("id").cast("bigint").alias("id"),
                             F.col("embedding").cast("array<float>").alias("embedding")).where("embedding IS NOT NULL")
    total, ids, dim = vectors.agg(F.count(F.lit(1)), F.count_distinct("id"), F.max(F.size("embedding"))).first()
    if ids != total:
        raise ValueError("vector ids must be unique")
    with scratch_table(training_sample(vectors, n_train), "tree-sample") as sample:
        n_sample = sample.count()
        tree = train_tree(sample, nlist, metric, cells, train_iters, seed, start, path)
    spark.createDataFrame(
        [(metric, int(dim), tree.nlist, 0, 0, int(total), n_sample, n_sample >= MIN_TRAIN_PER_LIST * nlist)],
        "metric string, dim int, nlist int, pq_m int, pq_bits int, ntotal bigint, "
        "n_train bigint, train_ok boolean").write.mode("overwrite").parquet(f"{path}/meta")
    write_bulk(layout_postings(assign_tree(vectors, tree, broadcast_bytes).drop("cell")), path)
    return load_tree_index(spark, path)


def load_tree_index(spark: SparkSession, path: str) -> TreeIndex:
    tree = load_tree(spark, path)
    postings = read_postings(spark, path, False)
    return TreeIndex(tree, IvfIndex(tree.lists.select("list_id", "centroid"), postings,
                                    spark.read.parquet(f"{path}/meta")))


def tree_search(built: TreeIndex, queries: DataFrame, k: int, nprobe: int = DEFAULT_NPROBE, n_cells: int = 4,
                broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, shared: bool = False) -> DataFrame:
    """Q3 + Q4 over the lists that :func:`probe_tree` picks: ``(qid, id, score, rank)``;
    ``shared=True`` scans once for any number of queries."""
    probes = probe_tree(queries, built.tree, nprobe, n_cells, broadcast_bytes)
    if shared:
        return shared_search(built.index, queries, k, nprobe, probes=probes)
    return ivf_search(built.index, queries, k, nprobe, probes=probes)
