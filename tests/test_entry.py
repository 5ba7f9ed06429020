"""Driver contract at sf0.001: flagship runs, every query has a callable, and a
sample of queries equals its DuckDB oracle."""

import os
import shutil
import subprocess
import sys

import duckdb

import __spark_entry__ as E
from conftest import ROOT, SF001

TABLES = "documents embeddings pages benchmark events labels conversations".split()


def test_entry_flagship(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    assert set(df.columns) == {"n_queries", "precision", "recall", "ndcg", "score"}


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def _duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def _canon(rows):
    out = []
    for r in rows:
        out.append(tuple(round(v, 6) if isinstance(v, float) else v for v in r))
    return sorted(out, key=repr)


def test_sample_queries_match_oracle(spark):
    con = _duck()
    for name in ("chunk_documents", "dense_chunk_ids", "knn_exact", "doc_rollup",
                 "metrics_per_query", "ivf_search", "ivfpq_search", "rerank_lexical"):
        s = E.queries()[name](spark, SF001)
        cols = sorted(s.columns)
        got = _canon(tuple(r[c] for c in cols) for r in s.collect())
        d = con.execute(E.oracle_sql()[name]).df()
        assert sorted(d.columns) == cols, name
        want = _canon(tuple(None if (isinstance(v, float) and v != v) else v
                            for v in (row[c] for c in cols))
                      for row in d.to_dict("records"))
        assert got == want, name
    assert os.path.exists(SF001)


def test_the_rest_works_without_the_optional_folders(tmp_path):
    """A copy without the training-data operators imports and runs a query, whether
    or not their pipeline file is still there."""
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=lambda d, names: {n for n in names if n in (".git", "llm", "__pycache__")})
    code = f"""
import sys; sys.path.insert(0, {str(copy)!r})
import __spark_entry__ as E
from quarry.session import build_session
assert E.__file__.startswith({str(copy)!r}) and "pipeline" not in E.queries()
assert len(E.queries()) > 40 and not [q for q in E.queries() if q.startswith("op")]
spark = build_session("local[2]", shuffle_partitions=2, extra={{"spark.driver.memory": "1g"}})
print("rows", E.queries()["chunk_manifest"](spark, {SF001!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    for name in ("corpus_pipeline.py", None):
        r = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
        assert r.stdout.strip().endswith("rows 1"), r.stderr[-2000:]
        if name:
            (copy / name).unlink()
