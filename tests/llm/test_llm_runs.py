"""Periodic runs against a search over every period."""

import hashlib
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from quarry.llm import runs


def every_period(words, least=12):
    """(start, length, period) by comparing the words at every distance."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def rows_of(words, least):
    return list(zip(*(x.tolist() for x in runs.find_runs(np.asarray(words, np.int64), least))))


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.sampled_from([1, 2, 4, 12]))
def test_any_words(words, least):
    assert rows_of(words, least) == every_period(words, least)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 1), min_size=1, max_size=6), st.integers(1, 5)), max_size=5),
       st.integers(1, 3))
def test_nested_repetitions(parts, times):
    words = [w for part, n in parts for w in part * n] * times
    assert rows_of(words, 2) == every_period(words, 2)


def test_fibonacci_words_and_long_runs():
    for n in (34, 89, 120, 233):
        assert rows_of(fibonacci(n), 2) == every_period(fibonacci(n), 2)
    assert rows_of([7] * 300_000, 12) == [(0, 300_000, 1)]
    assert rows_of(list(range(1000)) * 2 + [5], 12) == [(0, 2000, 1000)]
    assert rows_of([], 12) == []


def test_rows_of_every_kind(spark):
    hot = "la " * 20 + "end"
    rows = [(1, hot, 5, "x"), (1, hot, 5, "x"), (2, None, 1, "y"), (3, "", 2, "z"), (None, "a b " * 6, 3, None),
            (4, "one two three", 1, "w"), (5, "été ü " * 9 + " ", 9, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int, collapsed string")
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed)
                  for r in runs.periodic_runs(docs).collect()), key=repr)
    assert got == sorted([
        (1, 21, [(0, 20, 1)], "la end"), (1, 21, [(0, 20, 1)], "la end"), (2, 0, [], ""), (3, 0, [], ""),
        (None, 12, [(0, 12, 2)], "a b"), (4, 3, [], "one two three"),
        (5, 19, [(0, 18, 2)], "été ü  ")], key=repr)
    assert runs.periodic_runs(docs.where("false")).count() == 0


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    got = {r.doc_id: r for r in runs.op13_periodic_runs(spark, SF001).collect()}
    assert len(got) == len(docs) and sum(r.n_runs > 0 for r in got.values()) > 10
    for d in docs:
        words = (d.text or "").encode().split()
        h = zlib.crc32(str(d.doc_id).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        if len(words) > 1500:
            continue
        want = every_period(words)
        drop = {i for s, n, q in want for i in range(s + q, s + n)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in drop)
        best = min(want, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        r = got[d.doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(want), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if want else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in want).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(kept).hexdigest()


def test_plan_has_no_shuffle(spark):
    plan = runs.op13_periodic_runs(spark, SF001).where(F.col("n_runs") >= 0)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and plan.count("MapInArrow (") <= 1
