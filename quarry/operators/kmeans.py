"""k-means training in whole numbers, so that a result doesn't depend on how the rows
are partitioned (X5, X7).

Vectors and centres are put on a grid, a power of two chosen from the largest
component and the width, such that every inner product is a whole number below 2^53.
Scores are then exact in any order of summation, equal scores go to the lower
number, and sums of vectors are exact 64-bit numbers; only the division by the count
rounds, once per centre on the driver.  Training stops when no centre moves.

In each round the centres are broadcast (their size is set by parameters); every task
adds up its rows per centre.  The tasks' sums are added on the driver while they are
known to be small, and else by a shuffle in which a task streams over the rows of its
keys; the driver gets one row per centre.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V

EXACT_BITS = 50             # sums of products stay below 2^50, with signs and factors below 2^53
SCORE_BYTES = 16 << 20      # of the (rows x centres) score matrix at a time
SINGLE_BYTES = 2 << 20      # of the same in single precision: about what a core's caches hold
DRIVER_BYTES = 128 << 20    # of the tasks' sums added on the driver
CODE_ROWS = 256             # rows whose codes are found at a time: scores of a sub-space stay in a core's cache
PART_BYTES = 512 << 20      # of a training task's vectors, as floats
PARTS_PER_CORE = 2          # training tasks, if they hold less
PARALLEL_ROUNDS = 5         # of the k-means|| start
OVERSAMPLING = 2            # expected picks of a round, as a multiple of k
SUMS = "key int, s array<bigint>, n bigint"


def grid_scale(largest: float, dim: int) -> float:
    """The power of two by which values of at most ``largest`` are multiplied."""
    if not largest > 0:
        return 1.0
    bits = (EXACT_BITS - max(dim - 1, 0).bit_length()) // 2 - 2
    return math.ldexp(1.0, bits - math.frexp(largest)[1])


def snap(x: np.ndarray, scale: float) -> np.ndarray:
    """Nearest whole numbers of ``scale * x`` (halves upwards), as doubles."""
    y = x * scale
    y += 0.5
    return np.floor(y, out=y)


def unit_grid(x: np.ndarray, scale: float) -> np.ndarray:
    """Whole-number vectors scaled to length one, on the grid; zero stays zero."""
    n = np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    return snap(np.divide(x, n, out=np.zeros_like(x), where=n > 0), scale)


def packed_extent(vectors: DataFrame, vec_col: str = "embedding") -> tuple[int, int, float]:
    """Number, width and largest component of packed vectors."""

    def extent(batches):
        n, dim, largest = 0, 0, 0.0
        for rb in V.slices(batches, vec_col):
            x, _ = V.list_column_matrix(rb.column(vec_col), None)
            if len(x):
                n, dim, largest = n + len(x), max(dim, x.shape[1]), float(np.maximum(largest, np.abs(x).max()))
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([dim]), pa.array([largest])], names=["n", "dim", "largest"])

    tasks = vectors.select(vec_col).mapInArrow(extent, "n bigint, dim bigint, largest double")
    return tuple(tasks.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("dim"), F.lit(0)),
                           F.coalesce(F.max("largest"), F.lit(0.0))).first())


@dataclass(frozen=True)
class Grid:
    metric: str
    raw: float              # scale of the stored vectors
    scale: float            # scale of the training vectors and of the centres

    @classmethod
    def of(cls, vectors: DataFrame, metric: str, vec_col: str = "embedding") -> Grid:
        if dict(vectors.dtypes)[vec_col] == "binary":
            _, dim, largest = packed_extent(vectors, vec_col)
        else:
            largest, dim = vectors.agg(F.max(F.array_max(F.transform(vec_col, lambda x: F.abs(x)))),
                                       F.max(F.size(vec_col))).first()
        return cls.at(metric, float(largest or 0.0), int(dim or 1))

    @classmethod
    def at(cls, metric: str, largest: float, dim: int) -> Grid:
        """For vectors of that width and largest component."""
        raw = grid_scale(largest, dim)
        return cls(metric, raw, grid_scale(1.0, dim) if metric == "cosine" else raw)

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Stored vectors as training vectors (unit length for cosine)."""
        x = snap(x, self.raw)
        return unit_grid(x, self.scale) if self.metric == "cosine" else x

    def centre(self, sums: np.ndarray, n: np.ndarray, old: np.ndarray) -> np.ndarray:
        """New centres from sums and counts; one without rows, or whose mean has no
        direction (cosine), stays."""
        new = old.copy()
        some = n > 0
        mean = np.floor(sums[some] / n[some, None] + 0.5)
        if self.metric == "cosine":
            turned = unit_grid(mean, self.scale)
            mean = np.where((turned != 0).any(axis=1)[:, None], turned, old[some])
        new[some] = mean
        return new


def scores(x: np.ndarray, c: np.ndarray, metric: str) -> np.ndarray:
    """Exact whole-number scores, higher is nearer: inner products, or for L2 what is
    left of minus the squared distance without the row's own square."""
    s = x @ c.T
    return s if metric == "cosine" else 2 * s - np.einsum("ij,ij->i", c, c)[None, :]


def exact_labels(x: np.ndarray, c: np.ndarray, metric: str) -> np.ndarray:
    """Numbers of the nearest centres by exact scores, ties to the lower one."""
    s = x @ c.T
    if metric != "cosine":
        s *= 2
        s -= np.einsum("ij,ij->i", c, c)
    return np.argmax(s, axis=1)


class Nearest:
    """Number of the nearest centre of each row, ties to the lower one.  Scores are made in
    single precision; a row for which another centre is within their error (and ``slack``)
    of the best one is left to ``exact(rows, centres)``.  Equal centres are scored once."""

    def __init__(self, c: np.ndarray, metric: str, exact: Callable | None = None, slack: float = 0.0):
        first: dict[bytes, int] = {}
        self.number = np.array([i for i, row in enumerate(np.ascontiguousarray(c)) if first.setdefault(row.tobytes(), i) == i])
        self.c = c[self.number]
        self.exact = exact or (lambda x, c: exact_labels(x, c, metric))
        self.slack, self.product = slack, metric == "cosine"
        own = np.einsum("ij,ij->i", self.c, self.c)
        self.reach = float(np.sqrt(own.max()))
        # the L2 score's factor and own square as a column more
        near = self.c.T if self.product else np.vstack([2 * self.c.T, -own])
        with np.errstate(over="ignore"):
            self.near = np.ascontiguousarray(near, np.float32)
        self.step = max(1, SINGLE_BYTES // (4 * len(self.c)))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x), np.int64)
        for at in range(0, len(x), self.step):
            out[at:at + self.step] = self._tile(x[at:at + self.step])
        return self.number[out]

    def _tile(self, x: np.ndarray) -> np.ndarray:
        n, dim = x.shape
        # rows may be in single precision: their lengths get its error on top
        size = (1 + dim * 2.0 ** -23) * np.sqrt(np.einsum("ij,ij->i", x, x).astype(np.float64))
        if not (size.max() < 1e15 and self.reach < 1e15):       # single precision might overflow
            return self.exact(x.astype(np.float64, copy=False), self.c)
        if self.product:
            near = x.astype(np.float32, copy=False)
        else:
            near = np.ones((n, dim + 1), np.float32)
            near[:, :dim] = x
        s, row = near @ self.near, np.arange(n)
        best = np.argmax(s, axis=1)
        top = s[row, best].astype(np.float64)
        s[row, best] = -np.inf
        second = s[row, np.argmax(s, axis=1)]
        error = V.single_error(dim) * (size * self.reach if self.product else (size + self.reach) ** 2)
        unsure = np.flatnonzero(~(second < top - error - self.slack))
        if len(unsure):
            best[unsure] = self.exact(x[unsure].astype(np.float64, copy=False), self.c)
        return best


def nearest(x: np.ndarray, c: np.ndarray, metric: str) -> np.ndarray:
    """:class:`Nearest` for one block of rows."""
    return Nearest(c, metric)(x) if len(x) else np.zeros(0, np.int64)


def add_rows(sums: np.ndarray, n: np.ndarray, x: np.ndarray, labels: np.ndarray) -> None:
    """Whole-number rows added to the sums and counts of their labels."""
    if x.shape[1] < 256:
        s, k = V.group_sums(x, labels, len(n))
        sums += s.astype(np.int64)          # below 2^53 in a batch
        n += k
        return
    n += np.bincount(labels, minlength=len(n))
    for row, label in zip(x.astype(np.int64), labels.tolist()):     # wide rows: a row at a time costs least
        sums[label] += row


def sums_batch(sums: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    some = np.flatnonzero(n)
    return pa.RecordBatch.from_arrays(
        [pa.array(some.astype(np.int32)), V.matrix_to_list_array(sums[some], pa.int64()), pa.array(n[some])],
        names=["key", "s", "n"])


def _running_sums(batches):
    """Arrow kernel: rows of equal keys added up; all rows of a key are here."""
    at: dict[int, int] = {}
    sums, n = None, np.zeros(0, np.int64)
    for rb in batches:
        if not rb.num_rows:
            continue
        s, _ = V.list_column_matrix(rb.column("s"), np.int64)
        keys, inverse = np.unique(rb.column("key").to_numpy(), return_inverse=True)
        new = [k for k in keys.tolist() if k not in at]
        at.update(zip(new, range(len(at), len(at) + len(new))))
        if sums is None:
            sums = np.zeros((0, s.shape[1]), np.int64)
        sums = np.concatenate([sums, np.zeros((len(new), s.shape[1]), np.int64)])
        n = np.concatenate([n, np.zeros(len(new), np.int64)])
        rows = np.array([at[k] for k in keys.tolist()])[inverse]
        np.add.at(sums, rows, s)
        np.add.at(n, rows, rb.column("n").to_numpy())
    if sums is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.fromiter(at, np.int32, len(at))), V.matrix_to_list_array(
            sums, pa.int64()), pa.array(n)], names=["key", "s", "n"])


def add_up(partials: DataFrame, keys: int, dim: int, driver_bytes: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The tasks' ``(key, s, n)`` added per key: ``(keys x dim)`` sums and counts.
    ``keys * dim`` is set by parameters; beyond ``driver_bytes`` for all tasks
    together the rows are added in Spark first."""
    limit = DRIVER_BYTES if driver_bytes is None else driver_bytes
    if partials.rdd.getNumPartitions() * keys * (dim * 8 + 16) > limit:
        partials = partials.repartition("key").mapInArrow(_running_sums, SUMS)
    sums, n = np.zeros((keys, dim), np.int64), np.zeros(keys, np.int64)
    for rb in partials.toArrow().to_batches():
        if rb.num_rows:
            at = rb.column("key").to_numpy()
            np.add.at(sums, at, V.list_column_matrix(rb.column("s"), np.int64)[0])
            np.add.at(n, at, rb.column("n").to_numpy())
    return sums, n


def on_grid(data: DataFrame, grid: Grid, vec_col: str = "embedding") -> DataFrame:
    """The vectors as training vectors, packed.  They are whole numbers of at most 2^24
    (see ``grid_scale``), which floats hold exactly."""

    def put(batches):
        for rb in V.slices(batches, vec_col):
            x, _ = V.list_column_matrix(rb.column(vec_col))
            if len(x):
                yield pa.RecordBatch.from_arrays([V.pack_rows(grid.rows(x))], names=["x"])

    return data.select(vec_col).mapInArrow(put, "x binary")


def few_parts(data: DataFrame, n_rows: int | None, dim: int) -> DataFrame:
    """``data`` in no more partitions than its work needs: every task of a round gives sums
    as large as the centres, so that tasks of few rows are mostly sums.  A partition gets at
    most ``PART_BYTES`` of vectors, and there are some for every core."""
    if n_rows is None:
        return data
    cores = data.sparkSession.sparkContext.defaultParallelism
    want = max(PARTS_PER_CORE, -(-n_rows * dim * 4 // (PART_BYTES * cores))) * cores
    return data.coalesce(want) if data.rdd.getNumPartitions() > want else data


def lloyd(data: DataFrame, start: np.ndarray, grid: Grid, iters: int, vec_col: str = "embedding",
          driver_bytes: int | None = None, n_rows: int | None = None) -> np.ndarray:
    """At most ``iters`` rounds from whole-number centres; ends when none moves.  The
    vectors are put on the grid once for all rounds; what the cache cannot hold, or loses,
    is read again from ``data``, whose number of rows (if known) sets the number of tasks."""
    sc = data.sparkSession.sparkContext
    c = start
    rows = on_grid(few_parts(data, n_rows, start.shape[1]), grid, vec_col).persist()
    for _ in range(iters):
        bc = sc.broadcast(c)

        def partial(batches, bc=bc):
            centres = bc.value
            sums, n = np.zeros(centres.shape, np.int64), np.zeros(len(centres), np.int64)
            near = Nearest(centres, grid.metric)
            for rb in V.slices(batches, "x"):
                x = V.unpack_rows(rb.column("x"))
                add_rows(sums, n, x, near(x))
            yield sums_batch(sums, n)

        sums, n = add_up(rows.mapInArrow(partial, SUMS), *c.shape, driver_bytes)
        bc.unpersist()
        new = grid.centre(sums, n, c)
        if np.array_equal(new, c):
            break
        c = new
    rows.unpersist()
    return c


# ------------------------------------------------------------------ starts

def first_rows(data: DataFrame, k: int, grid: Grid, id_col: str, vec_col: str) -> np.ndarray:
    """The first ``k`` rows by id (a bounded top-k, not a sort)."""
    rows = data.select(id_col, vec_col).orderBy(id_col).limit(k).toArrow()
    return grid.rows(V.list_column_matrix(rows.column(vec_col))[0])


def _cost(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distance of each row to its nearest centre, whole numbers."""
    own = np.einsum("ij,ij->i", x, x)
    step = max(1, SCORE_BYTES // (8 * len(c)))
    return np.concatenate([np.zeros(0), *[own[at:at + step] - scores(x[at:at + step], c, "l2").max(axis=1)
                                          for at in range(0, len(x), step)]])


def parallel_start(data: DataFrame, k: int, grid: Grid, seed: int, id_col: str = "id",
                   vec_col: str = "embedding") -> np.ndarray:
    """k-means‖: from the first row, rounds in which each row is picked with a chance
    in proportion to its squared distance from the picks so far (a hash of id, seed
    and round decides; costs are exact, so any partitioning picks the same rows).
    The picks (about ``rounds * 2k``, by parameters) are weighted by the rows
    nearest to them, and reduced to ``k`` by taking the one of largest weight times
    squared distance again and again."""
    sc = data.sparkSession.sparkContext
    dim = int(data.agg(F.max(F.size(vec_col))).first()[0])
    picks = first_rows(data, 1, grid, id_col, vec_col)
    for r in range(PARALLEL_ROUNDS):
        bc = sc.broadcast(picks)

        def cost(batches, bc=bc):
            total = 0
            for rb in V.slices(batches, vec_col):
                x, _ = V.list_column_matrix(rb.column(vec_col))
                if len(x):
                    for part in np.array_split(_cost(grid.rows(x), bc.value).astype(np.int64), 1 + len(x) // 1024):
                        total += int(part.sum())        # 1,024 times 2^52 still fits
            yield pa.RecordBatch.from_arrays([pa.array([str(total)])], names=["total"])

        total = sum(int(row[0]) for row in data.select(vec_col).mapInArrow(cost, "total string").collect())
        if not total:
            break
        share = OVERSAMPLING * k / float(total)

        def pick(batches, bc=bc, share=share):
            for rb in V.slices(batches, vec_col):
                x, _ = V.list_column_matrix(rb.column(vec_col))
                if len(x):
                    take = rb.column("_u").to_numpy() < share * _cost(grid.rows(x), bc.value)
                    yield rb.filter(pa.array(take)).select([id_col, vec_col])

        u = F.pmod(F.xxhash64(F.lit(seed), F.lit(r), id_col), F.lit(1 << 53)) / float(1 << 53)
        got = data.select(id_col, vec_col, u.alias("_u")).mapInArrow(
            pick, data.select(id_col, vec_col).schema).orderBy(id_col).toArrow()
        bc.unpersist()
        if got.num_rows:
            picks = np.concatenate([picks, grid.rows(V.list_column_matrix(got.column(vec_col))[0])])
    picks = np.unique(picks, axis=0)
    bc = sc.broadcast(picks)

    def weigh(batches):
        n = np.zeros(len(bc.value), np.int64)
        for rb in batches:
            x, _ = V.list_column_matrix(rb.column(vec_col))
            if len(x):
                n += np.bincount(nearest(grid.rows(x), bc.value, "l2"), minlength=len(n))
        yield sums_batch(np.zeros((len(n), 1), np.int64), n)

    _, weight = add_up(data.select(vec_col).mapInArrow(weigh, SUMS), len(picks), 1)
    chosen = [int(np.argmax(weight))]
    far = np.full(len(picks), np.inf)
    while len(chosen) < min(k, len(picks)):
        far = np.minimum(far, _cost(picks, picks[chosen[-1:]]))
        gain = np.maximum(weight, 1) * far
        gain[chosen] = -1.0
        chosen.append(int(np.argmax(gain)))
    centres = picks[chosen]
    if len(centres) < k:        # fewer different picks than centres: rows by id
        centres = np.concatenate([centres, first_rows(data, k, grid, id_col, vec_col)[:k - len(centres)]])
    return centres.reshape(-1, dim)


# ------------------------------------------------------------------ codes of sub-vectors

class NearestCodes:
    """:class:`Nearest` in every sub-space: for each row and sub-space the nearest code."""

    def __init__(self, books: np.ndarray, exact: Callable | None = None, slack: float = 0.0):
        self.near = [Nearest(book, "l2", exact, slack) for book in books]
        self.shape, self.slack = books.shape, slack

    def __call__(self, r: np.ndarray) -> np.ndarray:
        out = np.empty((len(self.near), len(r)), np.int64)
        for at in range(0, len(r), CODE_ROWS):
            self._tile(r[at:at + CODE_ROWS], out[:, at:at + CODE_ROWS])
        return out.T

    def _tile(self, r: np.ndarray, out: np.ndarray) -> None:
        m, k, width = self.shape
        n = len(r)
        parts = r.reshape(n, m, width).transpose(1, 0, 2)
        size = (1 + width * 2.0 ** -23) * np.sqrt(np.einsum("jnw,jnw->jn", parts, parts).astype(np.float64))
        if not max(size.max(), *(near.reach for near in self.near)) < 1e15:
            for j, near in enumerate(self.near):
                out[j] = near(parts[j])
            return
        rows = np.ones((m, n, width + 1), np.float32)
        rows[:, :, :width] = parts
        best, top, second = np.empty((m, n), np.int64), np.empty((m, n), np.float32), np.empty((m, n), np.float32)
        tile = np.empty(n * k, np.float32)
        for j, near in enumerate(self.near):
            codes = len(near.c)
            s = np.matmul(rows[j], near.near, out=tile[:n * codes].reshape(n, codes))
            flat, first = s.ravel(), np.arange(0, n * codes, codes)
            np.argmax(s, axis=1, out=best[j])
            at = first + best[j]
            top[j] = flat[at]
            flat[at] = -np.inf
            second[j] = flat[first + np.argmax(s, axis=1)]
        reach = np.array([near.reach for near in self.near])[:, None]
        sure = second < top.astype(np.float64) - V.single_error(width) * (size + reach) ** 2 - self.slack
        for j, near in enumerate(self.near):
            unsure = np.flatnonzero(~sure[j])
            if len(unsure):
                best[j, unsure] = near.exact(parts[j, unsure].astype(np.float64, copy=False), near.c)
            out[j] = near.number[best[j]]


def nearest_codes(r: np.ndarray, books: np.ndarray) -> np.ndarray:
    """:class:`NearestCodes` for one block of rows."""
    return NearestCodes(books)(r)


def lloyd_codes(resid: DataFrame, start: np.ndarray, scale: float, iters: int,
                driver_bytes: int | None = None, centres: np.ndarray | None = None) -> np.ndarray:
    """:func:`lloyd` in all sub-spaces at once: ``(m, codes, width)`` whole numbers.  With
    ``centres``, a row holds a packed training vector and the number of the centre that it
    is taken from (``grid_residuals``)."""
    sc = resid.sparkSession.sparkContext
    m, k, width = start.shape
    books = start
    bc_c = None if centres is None else sc.broadcast(centres.astype(np.float32))
    resid = resid.select("residual", *(() if centres is None else ("list_id",)))
    for _ in range(iters):
        bc = sc.broadcast(books)

        def partial(batches, bc=bc):
            # whole numbers of at most 2^24: doubles add up 2^29 rows exactly
            sums, n = np.zeros(m * k * width), np.zeros(m * k, np.int64)
            near = NearestCodes(bc.value)
            first, column = np.arange(m) * k, np.arange(width)
            for rb in V.slices(batches, "residual"):
                if bc_c is None:
                    r, _ = V.list_column_matrix(rb.column("residual"))
                    r = snap(r, scale) if len(r) else r
                else:
                    r = V.unpack_rows(rb.column("residual"))
                    r -= bc_c.value[rb.column("list_id").to_numpy()]
                if not len(r):
                    continue
                codes = near(r) + first
                sums += np.bincount((codes[:, :, None] * width + column).ravel(), r.ravel(), len(sums))
                n += np.bincount(codes.ravel(), minlength=len(n))
            yield sums_batch(sums.reshape(-1, width).astype(np.int64), n)

        sums, n = add_up(resid.mapInArrow(partial, SUMS), m * k, width, driver_bytes)
        bc.unpersist()
        flat = books.reshape(m * k, width).copy()
        some = n > 0
        flat[some] = np.floor(sums[some] / n[some, None] + 0.5)
        new = flat.reshape(m, k, width)
        if np.array_equal(new, books):
            break
        books = new
    return books
