"""One-permutation MinHash against exact likeness and a loop over shingles."""

import hashlib

import numpy as np
import pytest

from conftest import SF001
from quarry.llm import minhash
from quarry.llm.minhash import Sketches, likeness

M64 = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15


def mix(h):
    h = (h ^ (h >> 30)) * 0xBF58476D1CE4E5B9 & M64
    h = (h ^ (h >> 27)) * 0x94D049BB133111EB & M64
    return h ^ (h >> 31)


def plain(text, shingle=5, bins=512, bits=4):
    """The stored numbers of one text, shingle by shingle and bin by bin."""
    words = []
    for w in text.encode().split():
        words.append(mix(sum((b + 1) * pow(BASE, k, 1 << 64) for k, b in enumerate(w)) & M64))
    if not words:
        return None
    low, width = {}, bins.bit_length() - 1
    for at in range(max(1, len(words) - shingle + 1)):
        h = 0
        for w in words[at:at + shingle]:
            h = (h * BASE + w) & M64
        h = mix(h ^ minhash.SEED)
        b, v = h >> (64 - width), h & ((1 << (64 - width)) - 1)
        low[b] = min(low.get(b, v), v)
    out = []
    for b in range(bins):
        j, attempt = b, 0
        while j not in low:
            attempt += 1
            j = mix((mix(b + attempt * bins) + BASE) & M64) % bins
        out.append(mix((low[j] + b * BASE) & M64) & ((1 << bits) - 1))
    return out


def grams(text):
    w = text.encode().split()
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def texts(rng, n):
    vocab = ["wort", "été", "x", "data", "na", " ", "longer-word" * 3] + [f"w{k}" for k in range(200)]
    return [" ".join(rng.choice(vocab, rng.integers(0, 80))) + rng.choice(["", " ", "\n\t"]) for _ in range(n)]


def test_sketches_equal_the_plain_form(monkeypatch):
    rng = np.random.default_rng(3)
    docs = texts(rng, 60) + ["", " \n", "a", "a b", "a b c d", "a b c d e", "a b c d e f", "z" * 5000, "q " * 400]
    for part in (1 << 22, 97):                  # also with words read in many parts
        monkeypatch.setattr(minhash, "SCAN_BYTES", part)
        for bins, bits in ((512, 4), (64, 1), (32, 8)):
            got = Sketches.of([d.encode() for d in docs], bins=bins, bits=bits)
            for d, low, some in zip(docs, got.low.tolist(), got.some.tolist()):
                want = plain(d, 5, bins, bits)
                assert some == (want is not None) and (not some or low == want), d[:40]
            again = Sketches.parse(got.hex(), bins, bits)
            assert (again.low == got.low).all() and (again.some == got.some).all()


def test_both_ways_of_filling_agree(monkeypatch):
    rng = np.random.default_rng(4)
    low = np.where(rng.random((40, 64)) < rng.random((40, 1)) * 0.5, rng.integers(0, 1000, (40, 64)), -1).astype(np.int64)
    low = low.view(np.uint64)
    few = minhash.densify(low)
    monkeypatch.setattr(minhash, "FEW", 0)
    assert (minhash.densify(low) == few).all()


def test_likeness_is_unbiased():
    rng = np.random.default_rng(5)
    for words in (60, 400, 3000):
        errors = []
        for _ in range(60):
            a = [f"v{k}" for k in rng.integers(0, 10 ** 6, words)]
            cut = int(words * rng.random())
            b = a[:cut] + [f"u{k}" for k in rng.integers(0, 10 ** 6, words - cut)]
            x, y = " ".join(a), " ".join(b)
            true = len(grams(x) & grams(y)) / len(grams(x) | grams(y))
            s = Sketches.of([x.encode(), y.encode()])
            errors.append(float(likeness(s.take([0]), s.take([1]))[0]) - true)
        assert abs(np.mean(errors)) < 0.02 and np.sqrt(np.mean(np.square(errors))) < 0.06


def check_rows(rows, docs):
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0]))
    assert len(rows) == len(docs)
    got = {r.doc_id: r for r in rows}
    for (i, t), (j, u) in zip(order, order[1:] + order[:1]):
        t, u, r = t or "", u or "", got[i]
        half = len(t) // 2
        new = t[:len(t) - half] + u[:half]
        one = Sketches.of([x.encode() for x in (t, new, u)])
        assert r.n_chars == len(t) and (r.fingerprint, r.edited_fingerprint) == tuple(one.hex()[:2])
        assert r.near_edited == pytest.approx(float(likeness(one.take([0]), one.take([1]))[0]))
        assert r.near_next == pytest.approx(float(likeness(one.take([0]), one.take([2]))[0]))
        yield r, new


def test_neighbours_over_many_ranges(spark):
    rng = np.random.default_rng(6)
    docs = [(int(i), t) for i, t in zip(rng.permutation(300) * 7 - 500, texts(rng, 300))]
    docs[5] = (docs[5][0], None)
    docs.append((None, "no id at all"))
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, _range int, fingerprint string")
    for size in (1 << 24, 2000, 200):
        rows = minhash.compare_with_next(df, range_bytes=size).collect()
        for r, new in check_rows(rows, docs):
            assert r.edited == new


def test_repeated_rows_and_empty_tables(spark, monkeypatch):
    from quarry.llm import common
    schema = "doc_id long, text string"
    assert minhash.compare_with_next(spark.createDataFrame([], schema)).count() == 0
    one = minhash.compare_with_next(spark.createDataFrame([(4, "a b c")], schema)).collect()[0]
    assert (one.edited, one.near_next, one.near_edited < 1) == ("a ba ", 1.0, True)
    monkeypatch.setattr(common, "HOT_ROWS", 20)
    hot = [(7, "same words again and again " * 9)] * 200 + [(7, "other words here")] * 3 + [(None, None)] * 90
    rows = minhash.compare_with_next(spark.createDataFrame(hot, schema), range_bytes=500).collect()
    assert len(rows) == len(hot)
    assert sum(r.near_next == 1.0 for r in rows) >= 199 + 2 + 89
    assert {r.fingerprint for r in rows if r.doc_id is None} == {""}
    assert len({r.fingerprint for r in rows}) == 3


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    rows = minhash.op12_minhash(spark, SF001).collect()
    near, exact = [], []
    for r, new in check_rows(rows, docs):
        assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        a, b = grams(dict(docs)[r.doc_id] or ""), grams(new)
        near.append(r.near_edited)
        exact.append(len(a & b) / len(a | b) if a | b else 1.0)
    assert np.sqrt(np.mean((np.array(near) - exact) ** 2)) < 0.05
    prints = {r.doc_id: r.fingerprint for r in minhash.fingerprints(spark.read.parquet(f"{SF001}/documents.parquet")).collect()}
    assert all(prints[r.doc_id] == r.fingerprint for r in rows)
