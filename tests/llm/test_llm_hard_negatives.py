"""Hard negatives against a loop over all pairs, and DuckDB."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from quarry.llm import hard_negatives as hn


def every_pair(rows, anchors, positives=5, negatives=5, lowest=80):
    out = []
    for aid, alabel, aw in anchors:
        scored = sorted((-sum(x * y for x, y in zip(aw, w)), i, label) for i, label, w in rows
                        if i != aid and len(w) == len(aw))
        for ps, pid, _ in [x for x in scored if x[2] == alabel][:positives]:
            window = [x for x in scored if x[2] != alabel and lowest * -ps <= 100 * -x[0] <= 100 * -ps]
            out += [(aid, pid, r + 1, n, -ps, -ns) for r, (ns, n, _) in enumerate(window[:negatives])]
    return sorted(out)


def test_keys_sort_as_stated():
    rng = np.random.default_rng(1)
    n = 500
    a, s, i = (rng.integers(-3, 3, n) * (1 << int(k)) for k in (0, 40, 20))
    kind = rng.integers(0, 2, n).astype(np.uint8)
    keys = hn.pack(a, s, kind, i)
    assert [x.tolist() for x in hn.unpack(keys)] == [x.tolist() for x in (a, s, kind, i)]
    want = sorted(zip(a.tolist(), (-s).tolist(), kind.tolist(), i.tolist()))
    order = sorted(range(n), key=lambda k: keys[k].as_py())
    assert [(int(a[k]), -int(s[k]), int(kind[k]), int(i[k])) for k in order] == want


def random_rows(rng, n, big=1):
    return [(int(i), int(rng.integers(0, 3)), [int(x) * big for x in rng.integers(-3, 6, 4 if rng.random() < 0.9 else 3)])
            for i in rng.permutation(n) - 20]


@pytest.mark.parametrize("big", [1, 1 << 28])
def test_rows_with_ties_and_blocks(spark, monkeypatch, big):
    rng = np.random.default_rng(2)
    rows = random_rows(rng, 300, big)
    df = spark.createDataFrame(rows, "id long, label long, w array<bigint>").repartition(7)
    anchors = [r for r in rows if r[0] % 9 == 0]
    pick = df.where("id % 9 = 0")
    want = every_pair(rows, anchors)
    assert len(want) > 300
    assert sorted(map(tuple, hn.mine_hard_negatives(df, pick).collect())) == want
    assert sorted(map(tuple, hn.mine_hard_negatives(df, pick, block_bytes=2000).collect())) == want
    monkeypatch.setattr(hn, "SCORE_CELLS", 100)
    assert sorted(map(tuple, hn.mine_hard_negatives(df, pick, 2, 3, 50).collect())) == every_pair(rows, anchors, 2, 3, 50)


def test_nulls_repeats_and_empty(spark):
    rows = [(100, 1, [1.0, 0.0], "x", 5), (1, 1, [0.5, 0.0], "x", 5), (2, 2, [0.45, 0.0], "y", 6), (2, 2, [0.45, 0.0], "y", 6),
            (3, 2, [0.39, 0.0], None, 7), (4, None, [0.5, 0.0], "z", 8), (5, 2, None, "z", 8), (6, 2, [0.5, None], "z", 8),
            (7, 2, [float("nan"), 0.5], "z", 8), (8, 2, [float("inf"), 0.5], "z", 8), (None, 2, [0.5, 0.0], "z", 8),
            (9, 2, [0.5, 0.0], "tie", 1), (10, 2, [0.48], "short", 1), (200, 3, [1.0, 0.0], "alone", 1), (100, 1, [1.0, 0.0], "x", 5)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>, key string, rank int")
    whole = hn.labelled_vectors(df, "vec_id", "embedding", F.col("label"))
    got = sorted(map(tuple, hn.mine_hard_negatives(whole, whole.where("id % 100 = 0")).collect()))
    p = 256 * 128
    n = 256 * 115
    assert got == [(100, 1, 1, 9, p, p), (100, 1, 2, 2, p, n), (100, 1, 3, 2, p, n)]
    assert hn.mine_hard_negatives(whole.where("false"), whole.where("false")).count() == 0
    assert hn.mine_hard_negatives(whole, whole.where("false")).count() == 0


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF01}/embeddings.parquet')")
    want = con.execute(hn.ORACLE_OP11)
    names = [d[0] for d in want.description]
    got = hn.op11_hard_negatives(spark, SF01)
    assert got.columns == names
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall()) and got.count() > 20
    assert dict(got.dtypes) == {n: "int" if n == "rank" else "bigint" for n in names}
