"""Whole-number training: same bits for any partitioning, equal to plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from quarry.operators import kmeans as km
from quarry.operators.ivf import build_index, grid_residuals, train_centroids, train_codebooks
from quarry.sources.tables import read_embeddings


def rows_of(df, *keys):
    return [tuple(r) for r in df.orderBy(*keys).collect()]


def plain_lloyd(x, c, metric, scale, rounds):
    """Python whole numbers throughout."""
    x, c = x.astype(int).tolist(), c.astype(int).tolist()
    for _ in range(rounds):
        members = [[] for _ in c]
        for v in x:
            dot = [sum(a * b for a, b in zip(v, w)) for w in c]
            if metric == "l2":
                dot = [2 * d - sum(b * b for b in w) for d, w in zip(dot, c)]
            members[dot.index(max(dot))].append(v)
        for j, group in enumerate(members):
            if group:
                mean = np.floor(np.array([sum(col) for col in zip(*group)]) / len(group) + 0.5)
                if metric == "cosine":
                    n = np.sqrt(float(sum(int(t) ** 2 for t in mean)))
                    mean = np.floor(mean / n * scale + 0.5) if n else np.array(c[j])
                c[j] = [int(t) for t in mean]
    return np.array(c, float)


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_equal_to_plain_loops(spark, metric):
    emb = read_embeddings(spark, SF01).where("id < 120")
    grid = km.Grid.of(emb, metric)
    x = grid.rows(np.array([r.embedding for r in emb.orderBy("id").collect()], float))
    start = x[:7]
    assert (km.first_rows(emb, 7, grid, "id", "embedding") == start).all()
    assert np.abs(x).max() * np.abs(x).max() * 64 < 2 ** 52 and np.abs(x).max() > 2 ** 15
    want = plain_lloyd(x, start, metric, grid.scale, 4)
    assert (km.lloyd(emb, start, grid, 4) == want).all()
    assert (km.lloyd(emb.repartition(9), start, grid, 4, driver_bytes=0) == want).all()


@pytest.mark.parametrize("start", ["first", "parallel"])
def test_same_bits_for_any_partitioning(spark, monkeypatch, start):
    emb = read_embeddings(spark, SF01)
    one = build_index(emb.coalesce(1), "cosine", 16, 8, 4, train_iters=3, start=start)
    monkeypatch.setattr(km, "DRIVER_BYTES", 0)
    many = build_index(emb.repartition(13, F.rand(3)), "cosine", 16, 8, 4, train_iters=3, start=start)
    assert rows_of(one.centroids, "list_id") == rows_of(many.centroids, "list_id")
    assert rows_of(one.codebooks, "m", "code") == rows_of(many.codebooks, "m", "code")
    assert rows_of(one.postings.select("id", "list_id", "codes"), "id") == rows_of(many.postings.select("id", "list_id", "codes"), "id")


def cost(spark, emb, centroids):
    c = np.array([r.centroid for r in centroids.orderBy("list_id").collect()])
    x = np.array([r.embedding for r in emb.collect()])
    return float((((x[:, None, :] - c[None]) ** 2).sum(axis=2)).min(axis=1).sum())


def test_parallel_start_is_better_than_the_first_rows(spark):
    rng = np.random.default_rng(8)
    # the first rows by id all lie in one of twelve far groups
    centres = rng.normal(size=(12, 6)) * 50
    rows = [(int(i), [float(v) for v in centres[i // 50] + rng.normal(size=6)]) for i in range(600)]
    emb = spark.createDataFrame(rows, "id long, embedding array<float>")
    first, parallel = (train_centroids(emb, 12, "l2", 2, start=s) for s in ("first", "parallel"))
    assert cost(spark, emb, parallel) < 6 * 600 * 1.5 < cost(spark, emb, first)
    again = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(20)], "id long, embedding array<float>")
    assert train_centroids(again, 4, "l2", 3, start="parallel").count() == 4


def test_zero_vectors_and_wide_ranges(spark):
    rows = [(0, [0.0, 0.0]), (1, [1e30, 0.0]), (2, [1e-30, 0.0]), (3, [0.0, -1e30])]
    emb = spark.createDataFrame(rows, "id long, embedding array<double>")
    for metric in ("cosine", "l2"):
        c = np.array([r.centroid for r in train_centroids(emb, 2, metric, 3).orderBy("list_id").collect()])
        assert np.isfinite(c).all() and c.shape == (2, 2)


def test_training_stops_when_nothing_moves(spark):
    emb = read_embeddings(spark, SF01)
    grid = km.Grid.of(emb, "cosine")
    start = km.first_rows(emb, 4, grid, "id", "embedding")
    settled = km.lloyd(emb, start, grid, 60)
    rounds = []

    class Counted(km.Grid):
        def centre(self, *a):
            rounds.append(1)
            return super().centre(*a)

    assert (km.lloyd(emb, settled, Counted(grid.metric, grid.raw, grid.scale), 60) == settled).all() and len(rounds) == 1


def test_codes_settle_alike_from_float_residuals(spark):
    emb = read_embeddings(spark, SF01)
    grid = km.Grid.of(emb, "cosine")
    resid = grid_residuals(emb, train_centroids(emb, 8, "cosine", 2, grid=grid), grid)
    exact = resid.select(F.transform("residual", lambda x: x * grid.scale).alias("r")).first().r
    assert all(v == int(v) for v in exact)
    books = train_codebooks(resid, 8, 4, 3)
    assert books.count() == 8 * 16 and rows_of(books, "m", "code") == rows_of(train_codebooks(resid.repartition(5), 8, 4, 3), "m", "code")


@pytest.mark.parametrize("largest", [1.0, 1e30])
def test_residuals_are_exact_in_half_the_bytes(spark, largest):
    rng = np.random.default_rng(8)
    rows = (rng.normal(size=(80, 24)) * largest).astype(np.float32)
    emb = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(rows)], "id bigint, embedding array<float>")
    grid = km.Grid.of(emb, "l2")
    centres = train_centroids(emb, 5, "l2", 2, grid=grid)
    resid = grid_residuals(emb, centres, grid)
    c = km.snap(np.array([r.centroid for r in centres.orderBy("list_id").collect()]), grid.scale)
    x = km.snap(rows.astype(float), grid.scale)
    want = (x - c[km.nearest(x, c, "l2")]) / grid.scale
    got = np.array([r.residual for r in resid.orderBy("id").collect()])
    assert (got == want).all() and resid.dtypes[1][1] == "array<float>"
