"""Chunk-reuse BPE and packing: against the tokenizers library itself and by
properties of a packing."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from quarry.llm.bpe import (ChunkEncoder, WordTokenizer, cut_points, default_tokenizer, encode_decode,
                            read_config)
from quarry.llm.packing import CAPACITY, pack, plan_packing

SCHEMA = "doc_id long, text string, size long, i string"
ODD = ["", " ", "x" * 20_000, "<|endoftext|>" * 50, "a\x1cb\x85c　d e", "it's 'S don'T" * 50,
       "H̱ é É", "Σίσυφος ΣΑΣ", "İstanbul ŉ", "... a, b. c ,d .e\n,f"]


@pytest.fixture(scope="module")
def tok():
    return WordTokenizer(read_config(default_tokenizer()))


def odd_texts(n=300):
    rng = random.Random(5)
    alphabet = "aé ßÉ́ \t\n'sİΣς<|endoftext|>中1²_-.,"
    return ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 700))) for _ in range(n)]


def test_chunks_give_the_librarys_ids(tok):
    enc = ChunkEncoder(tok)
    for text in odd_texts():
        ids = tok.tok.encode(text, add_special_tokens=False).ids
        n, digits, names = enc.encode(text.encode())
        assert (n, digits.decode()) == (len(ids), " ".join(map(str, ids)))
        assert names.decode() == tok.tok.decode(ids, skip_special_tokens=False)


def test_cut_points_follow_content():
    rng = np.random.default_rng(1)
    body = bytes(rng.integers(97, 123, 20_000, dtype=np.uint8))
    a, b = cut_points(body), cut_points(b"another start. " + body)
    shared = {len(body) - x for x in a} & {len(body) + 15 - x for x in b}
    assert len(shared) > len(a) / 2
    assert a[-1] == len(body) and all(y - x <= 8192 for x, y in zip(a, a[1:]))
    assert cut_points(b"") == [] and cut_points("é".encode() * 9000)[-1] == 18_000


def rows(spark, texts):
    data = [(None if k % 7 == 3 else k, t, k, "x") for k, t in enumerate(texts)]
    return spark.createDataFrame(data, SCHEMA)


def test_encode_decode_rows(spark, tok):
    texts = [*odd_texts(20), None, "same", "same"]
    got = encode_decode(rows(spark, texts), default_tokenizer()).collect()
    want = []
    for k, t in enumerate(texts):
        ids = tok.tok.encode(t or "", add_special_tokens=False).ids
        want.append((None if k % 7 == 3 else k, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(tok.tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert encode_decode(rows(spark, []), default_tokenizer()).count() == 0


def packed(plan):
    seqs = {}
    for n, lo, hi, first, each, offset in plan:
        for r in range(lo, hi):
            k, i = divmod(r - lo, each)
            seqs.setdefault(first + k, []).append((offset + i * n, n))
    return seqs


def test_plans_are_packings():
    rng = random.Random(3)
    for _ in range(300):
        cap = rng.choice([1, 7, 30, 100, 2048])
        counts = {rng.randint(1, cap): rng.randint(1, rng.choice([1, 3, 50])) for _ in range(rng.randint(0, 40))}
        seqs = packed(plan_packing(counts, cap))
        assert sum(map(len, seqs.values())) == sum(counts.values())
        for pieces in seqs.values():
            at = 0
            for offset, n in sorted(pieces):
                assert offset == at
                at += n
            assert at <= cap
            assert sum(3 * n > cap for _, n in pieces) <= 2


def test_plan_is_near_the_bound():
    rng = random.Random(4)
    counts = {n: rng.randint(1, 300) for n in range(1, 2049)}
    total = sum(n * c for n, c in counts.items())
    assert len(packed(plan_packing(counts, 2048))) <= 1.02 * -(-total // 2048)


def test_pack_rows(spark, tok):
    texts = [*odd_texts(30), None, "same words here", "same words here", "the and of " * 3000]
    docs = rows(spark, texts).unionByName(rows(spark, texts[:5]))        # repeated rows
    got = [r.asDict() for r in pack(docs, default_tokenizer()).collect()]
    want = []
    for k, t in list(enumerate(texts)) + list(enumerate(texts[:5])):
        ids = tok.tok.encode(t or "", add_special_tokens=False).ids + [0]
        for p in range(0, len(ids), CAPACITY):
            part = ids[p:p + CAPACITY]
            want.append((None if k % 7 == 3 else k, p // CAPACITY, p, len(part),
                         zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got], key=repr) \
        == sorted(want, key=repr)
    seqs = {}
    for r in got:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in seqs.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= CAPACITY
    assert pack(rows(spark, []), default_tokenizer()).count() == 0
