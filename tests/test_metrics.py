"""Hand-computed evaluation cases."""

import math

import pytest

from quarry.operators.evaluate import metrics_per_query, metrics_summary, missing_results


def _resp(spark, rows):
    return spark.createDataFrame(rows, "qid string, query string, response array<string>")


def _truth(spark, rows):
    return spark.createDataFrame(rows, "qid string, relevant string")


def test_metric_cases(spark):
    resp = _resp(spark, [
        ("none", "q", ["a", "b"]),          # no hits
        ("all", "q", ["a", "b"]),           # all hits
        ("short", "q", ["x"]),              # fewer than k retrieved, 1 hit
        ("empty", "q", ["a"]),              # empty relevant set
        ("many", "q", ["r1", "z", "r2"]),   # relevant > k
        ("typed", "q", ["7"]),              # integer truth never equals a name
    ])
    truth = _truth(spark, [
        ("none", "c"), ("all", "a"), ("all", "b"), ("short", "x"), ("short", "y"),
        ("empty", None), ("many", "r1"), ("many", "r2"), ("many", "r3"), ("many", "r4"),
        ("typed", "\u00007"), ("nores", "a"),
    ])
    k = 2
    got = {r.qid: r for r in metrics_per_query(resp, truth, k).collect()}
    assert set(got) == {"none", "all", "short", "empty", "many", "typed"}
    assert got["none"].precision == 0 and got["none"].ndcg == 0
    assert got["all"].precision == 1 and got["all"].recall == 1 and got["all"].ndcg == pytest.approx(1)
    assert got["short"].precision == 0.5 and got["short"].recall == 0.5
    assert got["short"].ndcg == pytest.approx(1 / (1 + 1 / math.log2(3)))
    assert got["empty"].recall == 0 and got["empty"].ndcg == 0 and got["empty"].n_relevant == 0
    assert got["many"].hits == 1 and got["many"].recall == 0.25     # r2 is at rank 3 > k
    assert got["typed"].hits == 0 and got["typed"].n_relevant == 1
    assert [r.qid for r in missing_results(resp, truth).collect()] == ["nores"]
    s = metrics_summary(metrics_per_query(resp, truth, k)).first()
    assert s.n_queries == 6
    assert s.score == pytest.approx(0.2 * s.precision + 0.5 * s.recall + 0.3 * s.ndcg)


def test_empty_evaluation_is_null(spark):
    resp = _resp(spark, [("a", "q", ["x"])])
    truth = _truth(spark, [("b", "x")])
    s = metrics_summary(metrics_per_query(resp, truth, 10)).first()
    assert s.n_queries == 0 and s.precision is None and s.score is None


def test_k_must_be_positive(spark):
    with pytest.raises(ValueError):
        metrics_per_query(_resp(spark, [("a", "q", [])]), _truth(spark, [("a", "x")]), 0)
