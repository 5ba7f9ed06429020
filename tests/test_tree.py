"""Two-level quantiser: against plain numpy, by either route, with hot cells and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import tree as T
from quarry.operators.ivf import build_index
from quarry.operators.kmeans import scores
from quarry.operators.knn import knn_search
from quarry.operators.search import ivf_search
from quarry.session import scratch_path


def clustered(n=1200, dim=8, groups=40, hot=0, seed=3):
    r = np.random.default_rng(seed)
    mid = r.normal(size=(groups, dim)) * 3
    m = mid[r.integers(0, groups, n)] + r.normal(size=(n, dim))
    m[:hot] = m[0]              # one vector many times
    return m.astype(np.float32)


def frame(spark, m, parts=3):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)]
    return spark.createDataFrame(rows, "id long, embedding array<float>").repartition(parts)


def lists_of(tree):
    return {r.list_id: (r.cell, np.array(r.centroid)) for r in tree.lists.collect()}


def assigned(df):
    return {r.id: (r.cell, r.list_id) for r in df.collect()}


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_assignment_and_probing_equal_plain_loops(spark, monkeypatch, metric):
    monkeypatch.setattr(T, "PART_ROWS", 64)         # many parts of a cell
    m = clustered(700)
    df = frame(spark, m)
    tree = T.train_tree(df, 30, metric, train_iters=3)
    lists = lists_of(tree)
    assert sorted(lists) == list(range(tree.nlist)) and abs(tree.nlist - 30) <= len(tree.tops)
    x = tree.grid.rows(m.astype(np.float64))
    top = scores(x, tree.tops, metric)
    expected = {}
    for i in range(len(x)):
        cell = int(np.argmax(top[i]))
        own = sorted(k for k, (c, _) in lists.items() if c == cell)
        s = [scores(x[i:i + 1], lists[k][1][None, :], metric)[0, 0] for k in own]
        expected[i] = (cell, own[int(np.argmax(s))])
    assert assigned(T.assign_tree(df, tree)) == expected
    assert assigned(T.assign_tree(df, tree, broadcast_bytes=0)) == expected         # by shuffle

    queries = df.where("id % 100 = 0").select(F.col("id").cast("string").alias("qid"), "embedding")
    probes = []
    for i in range(0, len(x), 100):
        cells = sorted(range(len(tree.tops)), key=lambda c: (-top[i, c], c))[:2]
        of = [(scores(x[i:i + 1], v[None, :], metric)[0, 0], k) for k, (c, v) in lists.items() if c in cells]
        probes += [(str(i), k, int(s), r) for r, (s, k) in enumerate(sorted(of, key=lambda t: (-t[0], t[1]))[:5], 1)]
    for limit in (1 << 20, 0):
        got = T.probe_tree(queries, tree, 5, 2, limit).select("qid", "list_id", "coarse", "probe_rank").collect()
        assert sorted(map(tuple, got)) == sorted(probes)


def test_same_tree_for_any_partitioning_and_a_hot_cell(spark, monkeypatch):
    monkeypatch.setattr(T, "PART_ROWS", 50)
    m = clustered(900, hot=300)
    trees = []
    for parts in (1, 7):
        tree = T.train_tree(frame(spark, m, parts), 40, "l2", train_iters=4, start="parallel")
        trees.append({k: (c, tuple(v)) for k, (c, v) in lists_of(tree).items()})
    assert trees[0] == trees[1]
    left, _ = T._spread(T.place(frame(spark, m), tree.grid, tree.tops), tree.lists,
                        T._cell_counts(T.place(frame(spark, m), tree.grid, tree.tops)), "id")
    # the hot cell is cut into parts, none of which holds much more than PART_ROWS rows
    assert left.groupBy("cell", "part").count().agg(F.max("count")).first()[0] < 100


def test_cell_bound_leaves_no_row_out(spark, monkeypatch):
    monkeypatch.setattr(T, "CELL_LISTS", 3)
    built = T.build_tree_index(frame(spark, clustered(400, hot=200)), 60, "l2", cells=5, train_iters=2)
    assert built.tree.nlist <= 15 and built.index.postings.count() == 400


def test_recall_at_equal_probes(spark):
    m = clustered(2000, 16, groups=64)
    df = frame(spark, m)
    queries = df.where("id % 20 = 0").select(F.col("id").cast("string").alias("qid"), "embedding")
    exact = {(r.qid, r.id) for r in knn_search(df, queries, 10, "cosine").collect()}
    built = T.build_tree_index(df, 64, "cosine", train_iters=5)
    flat = build_index(df, "cosine", 64, train_iters=5)
    found = {(r.qid, r.id) for r in T.tree_search(built, queries, 10, 16, 4).collect()}
    plain = {(r.qid, r.id) for r in ivf_search(flat, queries, 10, 16).collect()}
    recall, recall_flat = len(found & exact) / len(exact), len(plain & exact) / len(exact)
    print(f"recall at 16 of 64 lists: two levels {recall:.3f}, flat {recall_flat:.3f}")
    assert recall >= 0.9 and recall_flat >= 0.9
    everything = T.tree_search(built, queries, 10, 1 << 20, 1 << 20)
    assert {(r.qid, r.id) for r in everything.collect()} == exact


def test_stored_index_nulls_and_errors(spark):
    m = clustered(200)
    df = frame(spark, m).unionByName(spark.createDataFrame([(900, None)], "id long, embedding array<float>"))
    path = scratch_path(spark, "tree-test")
    T.build_tree_index(df, 16, "l2", train_iters=2, path=path)
    again = T.load_tree_index(spark, path)
    assert again.index.postings.count() == again.index.meta.first().ntotal == 200
    queries = spark.createDataFrame([("a", [float(x) for x in m[3]]), ("none", None)],
                                    "qid string, embedding array<float>")
    rows = T.tree_search(again, queries, 1).collect()
    assert [(r.qid, r.id) for r in rows] == [("a", 3)]
    with pytest.raises(ValueError):
        T.train_tree(df, 201)
    with pytest.raises(ValueError):
        T.train_tree(df.limit(0), 4)
    with pytest.raises(ValueError):
        T.build_tree_index(df.unionByName(df), 4)


def test_more_lists_than_a_flat_quantiser_may_hold(spark, monkeypatch):
    """With the flat bound set low, the flat build refuses; the tree's lists never reach
    the driver."""
    from quarry.operators import ivf
    monkeypatch.setattr(ivf, "PARAMETER_BYTES", 4096)
    monkeypatch.setattr(ivf._check_bytes, "__defaults__", (4096,))
    df = frame(spark, clustered(2000, 8))
    with pytest.raises(ValueError):
        build_index(df, "l2", 400, train_iters=1)
    built = T.build_tree_index(df, 400, "l2", train_iters=1, broadcast_bytes=0)
    assert built.tree.nlist >= 390 and built.index.postings.count() == 2000
