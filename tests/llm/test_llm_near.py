"""SimHash with pivots and line deduplication, against brute force."""

import random

import numpy as np

from quarry.llm import simhash
from quarry.llm.components import connected_components

SCHEMA = "doc_id long, text string, fp string, h int, root string"


def corpus(n=120, seed=2):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(60)]
    texts = []
    for k in range(n):
        if k % 3 == 2:              # a near copy
            t = rng.choice(texts).split()
            t[rng.randrange(len(t))] = "changed"
            texts.append(" ".join(t))
        else:
            texts.append(" ".join(rng.choice(words) for _ in range(rng.randint(30, 400))))
    return [*texts, None, "", " \n", "One", "one", "ONE two three", "long " * 50_000, texts[0], texts[0]]


def frame(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "a", 1, "b") for i, t in zip(ids, texts)], SCHEMA)


def classes(fps, distance):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin((fps[i] ^ fps[j]) & (2**64 - 1)).count("1") <= distance:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def check(spark, texts, ids):
    got = simhash.near_duplicates(frame(spark, texts, ids)).collect()
    assert len(got) == len(texts)
    fps = [simhash.fingerprint((t or "").encode()) for t in texts]
    root = classes(fps, 4)
    small = {}
    for i, r in zip(ids, root):
        small[r] = min([x for x in (small.get(r), i) if x is not None], default=None)
    want = sorted(((i, f, small[r]) for i, f, r in zip(ids, fps, root)), key=repr)
    assert sorted(((r.doc_id, r.fp, r.component_id) for r in got), key=repr) == want


def test_components_equal_brute_force(spark, monkeypatch):
    texts = corpus()
    check(spark, texts, list(range(len(texts))))
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 3)      # buckets are split
    ids = [None if k % 11 == 0 else k // 2 for k in range(len(texts))]       # null and repeated ids
    check(spark, texts, ids)


def test_near_linked_fingerprints(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-2**63, 2**63, 40, dtype=np.int64)
    near = [int(b) ^ sum(1 << int(i) for i in rng.choice(63, rng.integers(0, 7), replace=False)) for b in base]
    fps = sorted({int(b) for b in base} | set(near) | {0, -1, 1, 15, 31})
    got = {r.fp: r.root for r in simhash.linked(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()}
    root = classes(fps, 4)
    mine = [got.get(f, f) for f in fps]
    assert {(a, b) for a in range(len(fps)) for b in range(len(fps)) if root[a] == root[b]} \
        == {(a, b) for a in range(len(fps)) for b in range(len(fps)) if mine[a] == mine[b]}


def test_fingerprint_parts():
    assert simhash.fingerprint(b"") == simhash.fingerprint(b" \t\n\x0b") == 0
    assert simhash.fingerprint(b"A b") == simhash.fingerprint(b"a  B\n")
    masks = simhash.bucket_masks(6, 4)
    assert len(masks) == 15 and len(set(masks)) == 15


def test_keep_one(spark):
    texts = corpus(60)
    docs = frame(spark, texts).unionByName(frame(spark, texts))     # every row twice
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted(r.doc_id for r in kept.collect())
    root = classes([simhash.fingerprint((t or "").encode()) for t in texts], 4)
    assert got == sorted({min(i for i in range(len(texts)) if root[i] == r) for r in root})
    empty = frame(spark, [])
    assert simhash.keep_one(empty).count() == 0 and simhash.near_duplicates(empty).count() == 0
    null = spark.createDataFrame([(None, "a b c d e", "x", 1, ""), (None, "a b c d e", "y", 1, "")], SCHEMA)
    assert simhash.keep_one(null).count() == 1


def test_keep_one_with_null_and_repeated_ids(spark):
    rng = random.Random(4)
    text = lambda: " ".join("w%d" % rng.randrange(10_000) for _ in range(80))
    texts = [text() for _ in range(40)]
    texts += texts[:4]                                      # copies: of null ids and of repeated ones
    ids = [None if k % 2 else 7 if k % 4 else k for k in range(40)] + [None, None, 7, 7]
    got = sorted(r.text for r in simhash.keep_one(frame(spark, texts, ids)).collect())
    assert got == sorted(set(texts))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 199)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(51), 0), **dict.fromkeys(range(100, 160), 100), 199: 199, 200: 199}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
