"""Inverted-file index with optional product quantisation (X1-X12), stored as
plain Parquet tables:

* ``centroids(list_id int, centroid array<float>)``
* ``codebooks(m int, code int, subvector array<double>)`` (PQ only)
* ``postings(list_id int, id bigint, codes binary | embedding array<float>)``,
  range-partitioned and sorted on ``(list_id, id)``, in folders by batch and
  bucket of lists: unprobed buckets are pruned, a hot list spreads over files
* ``meta(metric, dim, nlist, pq_m, pq_bits, ntotal, n_train, train_ok)``

Training is the only driver barrier: centroids (``nlist x dim``) and codebooks
(``2^bits x dim``) are collected -- both bounded by parameters, size-checked --
and broadcast to the Arrow kernels that assign and encode every vector.
With ``train_iters=0`` the parameters are the first ``nlist`` (resp. ``2^bits``)
training rows -- k-means' "first-k" start without Lloyd steps -- which makes
every later stage exactly reproducible by SQL.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..session import DEFAULT_BROADCAST_BYTES, delete_path, materialize, scratch_path, shuffle_partitions
from .kmeans import (Grid, Nearest, NearestCodes, few_parts, first_rows, grid_scale, lloyd, lloyd_codes,
                     packed_extent, parallel_start, snap)
from .knn import check_metric

# The reference's index defaults.
DEFAULT_NLIST = 1024
DEFAULT_NPROBE = 32
DEFAULT_PQ_BITS = 8
DEFAULT_N_TRAIN = 40000
MIN_TRAIN_PER_LIST = 39
LISTS_PER_BUCKET = 16       # lists that share a folder of postings
LEDGERS = ("ids", "rejects")    # kept by streaming/append.py beside the postings
TIE_DIGITS = 9
# Centroids and codebooks are set by parameters (nlist x dim, 2^bits x dim), not by
# the data; this bound only catches parameters that no executor could hold.
PARAMETER_BYTES = 1 << 30


@dataclass
class IvfIndex:
    centroids: DataFrame
    postings: DataFrame
    meta: DataFrame
    codebooks: DataFrame | None = None

    @property
    def is_pq(self) -> bool:
        return self.codebooks is not None


# ------------------------------------------------------------------ parameters

def adaptive_nlist(total: int, nlist: int = DEFAULT_NLIST) -> int:
    """Fewer vectors than lists -> about 8 vectors per list, at least 1."""
    return max(1, int(total / 8)) if total < nlist else nlist


def adaptive_nlist_col(total, nlist: int = DEFAULT_NLIST):
    t = F.col(total) if isinstance(total, str) else total
    return F.when(t < nlist, F.greatest(F.lit(1), F.floor(t / 8)).cast("int")) \
        .otherwise(F.lit(nlist))


def training_sample(vectors: DataFrame, n_train: int | None = None, mode: str = "first",
                    seed: int = 42, id_col: str = "id") -> DataFrame:
    """All vectors, or if ``n_train`` is given the first ``n_train`` by rank of
    id (whatever the ids' values), or a seeded random sample of about that size."""
    if n_train is None:
        return vectors
    if mode == "first":
        return vectors.orderBy(id_col).limit(n_train)
    if mode == "random":
        total = vectors.count()
        frac = min(1.0, n_train / max(total, 1))
        return vectors.sample(False, frac, seed)
    raise ValueError("mode must be 'first' or 'random'")


def _check_bytes(nbytes: int, what: str, limit: int = PARAMETER_BYTES):
    if nbytes > limit:
        raise ValueError(f"{what} needs {nbytes} bytes, above the broadcast limit {limit}")


def _unit(m: np.ndarray) -> np.ndarray:
    n = V.row_norms(m)
    return np.where(n[:, None] > 0, m / np.where(n > 0, n, 1.0)[:, None], 0.0)


def _prep(x: np.ndarray, metric: str) -> np.ndarray:
    return _unit(x) if metric == "cosine" else x


# ------------------------------------------------------------------ coarse quantiser

def train_centroids(sample: DataFrame, nlist: int, metric: str = "cosine",
                    train_iters: int = 20, seed: int = 42, id_col: str = "id",
                    vec_col: str = "embedding", engine: str = "lloyd",
                    start: str = "first", grid: Grid | None = None, n_rows: int | None = None) -> DataFrame:
    """``(list_id, centroid)``.  ``train_iters=0``: the first ``nlist`` sample
    rows by id (a bounded top-k, not a sort).  Default engine: distributed Lloyd
    rounds in whole numbers (``operators/kmeans.py``), which give the same bits for
    any partitioning; they begin at the first rows, or with ``start="parallel"`` at
    a k-means‖ choice.  ``engine="ml"``: Spark ML k-means (cosine distance for the
    cosine metric, which rejects zero vectors; it can return fewer than ``nlist``
    centres on small data, so list ids are numbered densely from what comes back)."""
    spark = sample.sparkSession
    if start not in ("first", "parallel"):
        raise ValueError("start must be 'first' or 'parallel'")
    if train_iters == 0:
        first = sample.select(id_col, vec_col).orderBy(id_col).limit(nlist).toArrow()
        centers, _ = V.list_column_matrix(first.column(vec_col))
    elif engine == "lloyd":
        grid = grid or Grid.of(sample, metric, vec_col)
        data = sample.select(id_col, vec_col)
        if start == "first":
            begin = first_rows(data, nlist, grid, id_col, vec_col)
        else:
            data.persist()
            begin = parallel_start(data, nlist, grid, seed, id_col, vec_col)
            data.unpersist()
        centers = lloyd(data, begin, grid, train_iters, vec_col, n_rows=n_rows) / grid.scale
    else:
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.functions import array_to_vector
        usable = sample.where(F.exists(vec_col, lambda x: x != 0)) if metric == "cosine" \
            else sample
        data = usable.select(array_to_vector(vec_col).alias("features"))
        km = KMeans(k=nlist, seed=seed, maxIter=train_iters,
                    distanceMeasure="cosine" if metric == "cosine" else "euclidean")
        centers = np.asarray(km.fit(data).clusterCenters(), dtype=np.float64)
        if metric == "cosine":
            centers = _unit(centers)
    _check_bytes(centers.nbytes, "centroids")
    return spark.createDataFrame(pa.table({
        "list_id": pa.array(np.arange(len(centers), dtype=np.int32)),
        "centroid": V.matrix_to_list_array(centers, pa.float32())}))


def _collect_matrix(df: DataFrame, key: str, vec: str) -> tuple[np.ndarray, np.ndarray]:
    """Bounded collect through Arrow (no per-value Python objects)."""
    tbl = df.select(key, vec).orderBy(key).toArrow()
    keys = tbl.column(key).to_numpy().astype(np.int64)
    mat, _ = V.list_column_matrix(tbl.column(vec))
    return keys, mat


# Small driver-side memo of the bounded parameter collects, keyed by the
# DataFrame object (kept alive in the entry, so ids are not reused).
_PARAM_MEMO: dict[tuple, tuple] = {}


def _memo(df: DataFrame, tag: str, build):
    key = (id(df), tag)
    hit = _PARAM_MEMO.get(key)
    if hit is not None and hit[0] is df:
        return hit[1]
    if len(_PARAM_MEMO) > 64:
        _PARAM_MEMO.clear()
    val = build()
    _PARAM_MEMO[key] = (df, val)
    return val


def centroid_matrix(centroids: DataFrame, metric: str) -> np.ndarray:
    """Bounded collect (``nlist x dim``); list ids must be 0..nlist-1."""
    def build():
        keys, mat = _collect_matrix(centroids, "list_id", "centroid")
        if len(keys) and not np.array_equal(keys, np.arange(len(keys))):
            raise ValueError("list ids must be dense from 0")
        _check_bytes(mat.nbytes, "centroids")
        return mat
    return _prep(_memo(centroids, "centroids", build), metric)


def _coarse_scores(x: np.ndarray, C: np.ndarray, metric: str,
                   rounded: bool = True) -> np.ndarray:
    """Higher is better: inner product of unit vectors, or minus squared L2.
    Rounded to 9 places for arg-max so ties break alike in every engine."""
    if metric == "cosine":
        s = _unit(x) @ C.T
    else:
        s = -V.sq_l2_distances(x, np.einsum("ij,ij->i", x, x), C)
    return np.round(s, TIE_DIGITS) if rounded else s


def assign_lists(vectors: DataFrame, centroids: DataFrame, metric: str = "cosine",
                 id_col: str = "id", vec_col: str = "embedding",
                 keep_vector: bool = True) -> DataFrame:
    """Nearest centroid per vector (ties -> lowest list id):
    ``(id, list_id[, embedding])``; packed vectors stay packed."""
    check_metric(metric)
    bc = vectors.sparkSession.sparkContext.broadcast(centroid_matrix(centroids, metric))
    kind = "binary" if dict(vectors.dtypes)[vec_col] == "binary" else "array<float>"
    out_schema = f"{id_col} bigint, list_id int" + (f", {vec_col} {kind}" if keep_vector else "")

    def best(x, c):         # for cosine, x are unit vectors
        return np.argmax(np.round(x @ c.T, TIE_DIGITS) if metric == "cosine" else _coarse_scores(x, c, metric), axis=1)

    def assign(batches):
        # rounded scores tie only within a unit of the last place
        near = Nearest(bc.value, metric, best, 4 * 10.0 ** -TIE_DIGITS)
        for rb in V.slices(batches, vec_col):
            X, valid = V.list_column_matrix(rb.column(vec_col))
            ids = rb.column(id_col).to_numpy(zero_copy_only=False)[valid]
            lists = near(_prep(X, metric)).astype(np.int32) if len(X) else np.zeros(0, np.int32)
            cols = [pa.array(ids.astype(np.int64)), pa.array(lists)]
            names = [id_col, "list_id"]
            if keep_vector:
                vcol = rb.column(vec_col)
                cols.append(vcol.filter(pa.array(valid)) if not valid.all() else vcol)
                names.append(vec_col)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return vectors.select(F.col(id_col).cast("bigint").alias(id_col), vec_col) \
        .mapInArrow(assign, out_schema)


# ------------------------------------------------------------------ product quantiser

def residuals(assigned: DataFrame, centroids: DataFrame, metric: str = "cosine",
              id_col: str = "id", vec_col: str = "embedding") -> DataFrame:
    """``x - c(list)`` (unit vectors for cosine) as ``(id, list_id, residual
    array<double>)``."""
    bc = assigned.sparkSession.sparkContext.broadcast(centroid_matrix(centroids, metric))

    def resid(batches):
        C = bc.value
        for rb in V.slices(batches, vec_col):
            X, valid = V.list_column_matrix(rb.column(vec_col))
            lists = rb.column("list_id").to_numpy(zero_copy_only=False)[valid]
            ids = rb.column(id_col).to_numpy(zero_copy_only=False)[valid]
            R = _prep(X, metric) - C[lists] if len(X) else X
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids.astype(np.int64)), pa.array(lists.astype(np.int32)),
                 V.matrix_to_list_array(R, pa.float64())],
                names=[id_col, "list_id", "residual"])

    return assigned.select(id_col, "list_id", vec_col).mapInArrow(
        resid, f"{id_col} bigint, list_id int, residual array<double>")


def grid_centres(centroids: DataFrame, grid: Grid) -> np.ndarray:
    return snap(_collect_matrix(centroids, "list_id", "centroid")[1], grid.scale)


def grid_residuals(sample: DataFrame, centroids: DataFrame, grid: Grid, id_col: str = "id",
                   vec_col: str = "embedding", packed: bool = False) -> DataFrame:
    """Training vectors less their nearest centre, both on the grid, as ``(id, residual)``:
    exact multiples of the grid's step.  They are whole numbers of at most 2^24 steps (see
    ``grid_scale``), which floats hold exactly at half the size of doubles, unless the
    vectors themselves come near the end of the floats' range.

    A centre has few zeros, and so has a residual.  ``packed`` therefore leaves the
    difference to the reader, as ``(id, list_id, residual)``: the packed training vector, in
    steps, and the number of the centre (:func:`grid_centres`) to be taken from it."""
    bc = sample.sparkSession.sparkContext.broadcast(grid_centres(centroids, grid))
    kind, sql = (pa.float32(), "float") if 2.0 ** -100 < grid.scale < 2.0 ** 100 else (pa.float64(), "double")

    def resid(batches):
        near = Nearest(bc.value, grid.metric)
        for rb in V.slices(batches, vec_col):
            x, valid = V.list_column_matrix(rb.column(vec_col))
            ids = rb.column(id_col).filter(pa.array(valid))
            if not len(x):
                continue
            x = grid.rows(x)
            lists = near(x)
            if packed:
                yield pa.RecordBatch.from_arrays([ids, pa.array(lists.astype(np.int32)), V.pack_rows(x)],
                                                 names=[id_col, "list_id", "residual"])
            else:
                yield pa.RecordBatch.from_arrays([ids, V.matrix_to_list_array((x - bc.value[lists]) / grid.scale, kind)],
                                                 names=[id_col, "residual"])

    return sample.select(F.col(id_col).cast("bigint").alias(id_col), vec_col).mapInArrow(
        resid, f"{id_col} bigint, " + ("list_id int, residual binary" if packed else f"residual array<{sql}>"))


def train_codebooks(resid: DataFrame, pq_m: int, pq_bits: int = DEFAULT_PQ_BITS,
                    train_iters: int = 20, id_col: str = "id",
                    dim: int | None = None, scale: float | None = None,
                    centres: np.ndarray | None = None) -> DataFrame:
    """A k-means of ``2^bits`` codes in each sub-space, all sub-spaces at once.
    The first ``2^bits`` rows by id are the start (``train_iters=0`` stops there).
    Rounds run in whole numbers on a grid (``scale``; default: from the largest
    component), so the codes don't depend on the partitioning.  In each round every
    task adds up its rows per code in all sub-spaces; the driver gets one row per
    code (``m x 2^bits``).  No task holds a sub-space whole.

    ``centres`` (with ``scale``) goes with the packed form of :func:`grid_residuals`."""
    ksub = 1 << pq_bits
    spark = resid.sparkSession
    resid = resid.select(id_col, "residual", *(() if centres is None else ("list_id",))).persist()
    first = resid.orderBy(id_col).limit(ksub).toArrow()
    if not first.num_rows:
        raise ValueError("no training data for the product quantiser")
    start, _ = V.list_column_matrix(first.column("residual"))
    if centres is not None:
        start = (start - centres[first.column("list_id").to_numpy()]) / scale
    dim = dim or start.shape[1]
    if dim % pq_m:
        raise ValueError(f"dim {dim} is not divisible by pq_m {pq_m}")
    if len(start) < ksub:
        raise ValueError(f"PQ training needs >= {ksub} rows, got {len(start)}")
    dsub = dim // pq_m
    if train_iters:
        if scale is None:
            scale = grid_scale(float(resid.agg(F.max(F.array_max(F.transform(
                "residual", lambda x: F.abs(x))))).first()[0] or 0.0), dim)
        start = snap(start, scale)
    cb = start.reshape(ksub, pq_m, dsub).transpose(1, 0, 2).copy()
    if train_iters:
        cb = lloyd_codes(resid, cb, scale, train_iters, centres=centres) / scale
    resid.unpersist()
    return spark.createDataFrame(pa.table({
        "m": pa.array(np.repeat(np.arange(pq_m, dtype=np.int32), ksub)),
        "code": pa.array(np.tile(np.arange(ksub, dtype=np.int32), pq_m)),
        "subvector": V.matrix_to_list_array(cb.reshape(pq_m * ksub, dsub), pa.float64())}))


def codebook_tensor(codebooks: DataFrame) -> np.ndarray:
    """Bounded collect: ``(m, 2^bits, dsub)``."""
    def build():
        rows = codebooks.orderBy("m", "code").collect()
        m = max(r["m"] for r in rows) + 1
        k = max(r["code"] for r in rows) + 1
        t = np.asarray([r["subvector"] for r in rows], dtype=np.float64).reshape(m, k, -1)
        _check_bytes(t.nbytes, "codebooks")
        return t
    return _memo(codebooks, "codebooks", build)


def _coder(cb: np.ndarray) -> NearestCodes:
    """Each row's code in every sub-space: the least of the distances rounded to 9 places."""
    def rounded(r, c):
        d = V.sq_l2_distances(r, np.einsum("ij,ij->i", r, r), c)
        best = np.argmin(d, axis=1)
        # rounded distances tie only within a unit of the last place: most rows need no rounding
        least = d[np.arange(len(d)), best]
        first = np.argmax(d <= (least + 4 * 10.0 ** -TIE_DIGITS + 1e-14 * least)[:, None], axis=1)
        unsure = np.flatnonzero(first != best)
        if len(unsure):
            best[unsure] = np.argmin(np.round(d[unsure], TIE_DIGITS), axis=1)
        return best

    return NearestCodes(cb, rounded, 4 * 10.0 ** -TIE_DIGITS)


def _encode(R: np.ndarray, cb: np.ndarray) -> np.ndarray:
    return _coder(cb)(R).astype(np.uint8)


def pq_encode(assigned: DataFrame, centroids: DataFrame, codebooks: DataFrame,
              metric: str = "cosine", id_col: str = "id",
              vec_col: str = "embedding") -> DataFrame:
    """``(list_id, id, codes binary)``, one byte per sub-space."""
    sc = assigned.sparkSession.sparkContext
    bc_c = sc.broadcast(centroid_matrix(centroids, metric))
    bc_b = sc.broadcast(codebook_tensor(codebooks))

    def enc(batches):
        C, cb = bc_c.value, bc_b.value
        coder = _coder(cb)
        # of the distances to a sub-space's codes, a slice at a time
        for rb in V.slices(batches, vec_col, 4 * cb.shape[1]):
            X, valid = V.list_column_matrix(rb.column(vec_col))
            lists = rb.column("list_id").to_numpy(zero_copy_only=False)[valid].astype(np.int32)
            ids = rb.column(id_col).to_numpy(zero_copy_only=False)[valid].astype(np.int64)
            codes = coder(_prep(X, metric) - C[lists]).astype(np.uint8) if len(X) else \
                np.zeros((0, cb.shape[0]), np.uint8)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lists), pa.array(ids),
                 pa.array([c.tobytes() for c in codes], pa.binary())],
                names=["list_id", id_col, "codes"])

    return assigned.select(id_col, "list_id", vec_col).mapInArrow(
        enc, f"list_id int, {id_col} bigint, codes binary")


# ------------------------------------------------------------------ build / persist

def layout_postings(postings: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """X9 layout: range-partition on (list_id, id) -- a hot list is split over
    several partitions -- and sort inside each partition."""
    n = num_partitions or shuffle_partitions(postings.sparkSession)
    return postings.repartitionByRange(n, "list_id", "id").sortWithinPartitions("list_id", "id")


def build_index(vectors: DataFrame, metric: str = "cosine", nlist: int = DEFAULT_NLIST,
                pq_m: int | None = None, pq_bits: int = DEFAULT_PQ_BITS,
                n_train: int | None = None, train_iters: int = 20, seed: int = 42,
                path: str | None = None, id_col: str = "id",
                vec_col: str = "embedding", sampling: str = "first",
                adaptive: bool = False, engine: str = "lloyd", start: str = "first") -> IvfIndex:
    """X1-X9 + X11: train on the sample, assign (and encode) every vector and
    write the index tables under ``path`` (default: a folder in the checkpoint
    directory).  Parameters are written once, straight into the index folder.

    All vectors train unless ``n_train`` bounds them; ``adaptive=True`` lowers
    ``nlist`` for small inputs (X2), otherwise a larger ``nlist`` than there are
    vectors is an error.  Null vectors are left out.  A rebuild in the same folder
    replaces all postings, added ones included.

    ``vectors`` may be packed, for an index with product codes; they are read several
    times and should be written.  Others are written packed for the training."""
    check_metric(metric)
    if pq_m and not 1 <= pq_bits <= 8:
        raise ValueError(f"pq_bits must be 1 to 8 (a code is one byte), got {pq_bits}")
    spark = vectors.sparkSession
    path = path or scratch_path(spark, "ivf-index")
    vectors = vectors.select(F.col(id_col).cast("bigint").alias("id"),
                             F.col(vec_col).alias("embedding")).where("embedding IS NOT NULL")
    packed = dict(vectors.dtypes)["embedding"] == "binary"
    if packed and not pq_m:
        raise ValueError("packed vectors need product codes")
    if packed:
        total, dim, largest = packed_extent(vectors)
        unique = vectors.agg(F.countDistinct("id")).first()[0]
    else:
        total, dim, unique = vectors.agg(F.count(F.lit(1)), F.max(F.size("embedding")), F.countDistinct("id")).first()
    dim = int(dim or 0)
    if total == 0:
        raise ValueError("no vectors to index")
    if unique != total:
        raise ValueError("vector ids must be unique")
    if pq_m and dim % pq_m:
        raise ValueError(f"dim {dim} is not divisible by pq_m {pq_m}")
    if adaptive:
        nlist = adaptive_nlist(total, nlist)
    if packed and n_train is None and engine == "lloyd":
        sample, n_sample = vectors, total       # they are written already
        grid = Grid.at(metric, largest, dim) if train_iters else None
    else:
        sample = training_sample(vectors, n_train, sampling, seed)
        sample = materialize(sample, "ivf-sample")
        n_sample = sample.count()
        grid = Grid.of(sample, metric) if train_iters else None
    if n_sample < nlist:
        raise ValueError(f"{n_sample} training vectors for {nlist} lists; lower nlist or set adaptive")
    train_centroids(sample, nlist, metric, train_iters, seed, engine=engine, start=start, grid=grid, n_rows=n_sample) \
        .write.mode("overwrite").parquet(f"{path}/centroids")
    centroids = spark.read.parquet(f"{path}/centroids")
    nlist_actual = int(centroid_matrix(centroids, metric).shape[0])
    assigned = assign_lists(vectors, centroids, metric)
    codebooks = None
    if pq_m:
        if grid is not None:
            resid = grid_residuals(few_parts(sample, n_sample, dim), centroids, grid, packed=True)
        else:
            resid = residuals(assign_lists(sample, centroids, metric), centroids, metric)
        train_codebooks(resid, pq_m, pq_bits, train_iters, dim=dim, scale=grid and grid.scale,
                        centres=grid and grid_centres(centroids, grid)) \
            .write.mode("overwrite").parquet(f"{path}/codebooks")
        codebooks = spark.read.parquet(f"{path}/codebooks")
        # the range layout reads its rows twice: codes are small, so they are made once
        postings = materialize(pq_encode(assigned, centroids, codebooks, metric), "ivf-codes")
    else:
        postings = assigned.select("list_id", "id", "embedding")
    spark.createDataFrame(
        [(metric, dim, nlist_actual, pq_m or 0, pq_bits if pq_m else 0, total, n_sample,
          n_sample >= MIN_TRAIN_PER_LIST * nlist)],
        "metric string, dim int, nlist int, pq_m int, pq_bits int, ntotal bigint, "
        "n_train bigint, train_ok boolean").write.mode("overwrite").parquet(f"{path}/meta")
    write_bulk(layout_postings(postings), path)
    return IvfIndex(centroids, read_postings(spark, path, bool(pq_m)),
                    spark.read.parquet(f"{path}/meta"), codebooks)


def write_bulk(postings: DataFrame, path: str) -> None:
    """Replace all postings under ``path``, added batches too, by one bulk batch; the
    ledgers of additions (ids, rejects) belong to the postings and go first."""
    spark = postings.sparkSession
    for ledger in LEDGERS:
        delete_path(spark, f"{path}/{ledger}")
    with_bucket(postings).withColumn("batch_id", F.lit(-1)).write.mode("overwrite").option(
        "partitionOverwriteMode", "static").partitionBy("batch_id", "list_bucket").parquet(f"{path}/postings")


def read_postings(spark: SparkSession, path: str, is_pq: bool) -> DataFrame:
    """All batches; the schema is given, so an index without postings can be read."""
    payload = "codes binary" if is_pq else "embedding array<float>"
    return spark.read.schema(f"list_id int, id bigint, {payload}, batch_id string, list_bucket int").parquet(
        f"{path}/postings")


def with_bucket(postings: DataFrame) -> DataFrame:
    return postings.withColumn("list_bucket", F.floor(F.col("list_id") / LISTS_PER_BUCKET).cast("int"))


def save_index(index: IvfIndex, path: str | None) -> IvfIndex:
    """X11: write the tables under one folder and return the re-read index."""
    spark = index.postings.sparkSession
    if path is None:
        path = scratch_path(spark, "ivf-index")
    index.centroids.write.mode("overwrite").parquet(f"{path}/centroids")
    index.meta.write.mode("overwrite").parquet(f"{path}/meta")
    if index.codebooks is not None:
        index.codebooks.write.mode("overwrite").parquet(f"{path}/codebooks")
    write_bulk(index.postings.drop("batch_id", "list_bucket"), path)
    return load_index(spark, path)


def load_index(spark: SparkSession, path: str) -> IvfIndex:
    """X11: read an index folder (all ``postings/batch_id=*`` parts); what it holds
    is told by its own metadata, never by the driver's disk."""
    centroids = spark.read.parquet(f"{path}/centroids")
    is_pq = bool(spark.read.parquet(f"{path}/meta").first()["pq_m"])
    postings = read_postings(spark, path, is_pq)
    # the number of postings is counted on load (Parquet footers), so it holds
    # after any number of additions
    meta = spark.read.parquet(f"{path}/meta").withColumn("ntotal", F.lit(postings.count()).cast("bigint"))
    codebooks = spark.read.parquet(f"{path}/codebooks") if is_pq else None
    return IvfIndex(centroids, postings, meta, codebooks)


def index_size(index: IvfIndex) -> int:
    """``ntotal``."""
    return index.postings.count()
