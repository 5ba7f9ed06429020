"""The shared scan gives the rows of the scan by query blocks, whatever its parts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import shared as S
from quarry.operators.ivf import build_index
from quarry.operators.search import ivf_search
from quarry.operators.tree import build_tree_index, tree_search
from quarry.session import materialize


def frame(spark, n=400, dim=8, hot=150, seed=5):
    m = np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32)
    m[:hot] = m[0]              # one list holds more than a third of the rows
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id long, embedding array<float>")


def as_queries(df):
    return df.select(F.col("id").cast("string").alias("qid"), "embedding")


def rows(df):
    return sorted((r.qid, r["rank"], r.id, round(r.score, 9)) for r in df.collect())


@pytest.mark.parametrize("metric,pq_m", [("cosine", None), ("l2", None), ("cosine", 4), ("l2", 4)])
def test_equal_to_blocks(spark, monkeypatch, metric, pq_m):
    monkeypatch.setattr(S, "PART_ROWS", 60)
    monkeypatch.setattr(S, "PART_QUERIES", 25)
    df = frame(spark)
    index = build_index(df, metric, 40, pq_m, 4, train_iters=1)
    queries = as_queries(df.where("id % 3 = 0"))
    assert rows(S.shared_search(index, queries, 7, 5)) == rows(ivf_search(index, queries, 7, 5))


def test_one_scan_of_bounded_groups(spark, monkeypatch):
    monkeypatch.setattr(S, "PART_ROWS", 60)
    monkeypatch.setattr(S, "PART_QUERIES", 25)
    df = frame(spark)
    index = build_index(df, "l2", 40, train_iters=0)
    found = S.shared_search(index, as_queries(df), 3, 4)
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    # the probes' table and the postings, each once, whatever the number of queries
    assert len(scans) == 2 and sum("batch_id" in line for line in scans) == 1, scans
    assert all("PartitionFilters" in line for line in scans)
    assert rows(found) == rows(ivf_search(index, as_queries(df), 3, 4))


def test_tree_odd_queries_and_errors(spark):
    df = frame(spark)
    built = build_tree_index(df, 30, "l2", train_iters=1)
    queries = as_queries(df.where("id % 20 = 0"))
    assert rows(tree_search(built, queries, 4, 6, 2, shared=True)) == rows(tree_search(built, queries, 4, 6, 2))
    empty = spark.createDataFrame([("x", None)], "qid string, embedding array<float>")
    assert S.shared_search(built.index, empty, 3, probes=materialize(
        spark.createDataFrame([], "qid string, list_id int"), "none")).count() == 0
    with pytest.raises(ValueError):
        S.shared_search(built.index, queries.unionByName(queries), 3)
    with pytest.raises(ValueError):
        S.shared_search(built.index, queries, 0)
