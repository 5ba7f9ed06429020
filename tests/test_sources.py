"""File edge cases in a temp folder, query-file aliases, truth CSV parsing."""

import json
import os
import tempfile

from quarry.sources.files import (integer_stem_documents, json_text, preprocess_folder, read_folder,
                                  split_rejects)
from quarry.sources.queries import read_query_file
from quarry.sources.sinks import read_results, write_results
from quarry.sources.truth_csv import NON_STRING_TAG, read_truth_csv


def _folder(files: dict) -> str:
    d = tempfile.mkdtemp(prefix="quarry-src-", dir="/tmp")
    for name, data in files.items():
        p = os.path.join(d, name)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as f:
            f.write(data if isinstance(data, bytes) else data.encode("utf-8"))
    return d


def test_json_rule(spark):
    cases = [('{"text": ""}', ""), ('{"content": 1, "body": "b"}', "1"), ('{"body": null}', "None"),
             ('[1, "é"]', '[1, "\\u00e9"]'), ("  ", ""), ('{"body": "b", "text": "t é\\n"}', "t é\n"),
             ('{"text": true}', "True"), ('{"a": 1.50}', '{"a": 1.5}'), ('"only a string"', '"only a string"'),
             (' {"content": "x"} ', "x"), ('{"a": NaN}', '{"a": NaN}')]
    bad = ["{bad", "1" * 5000, "[" * 100_000]      # no input ends the job
    df = spark.createDataFrame([(i, c) for i, c in enumerate([c for c, _ in cases] + bad + ['{"text": "\\ud800"}', None])],
                               "i int, raw string")
    got = {r.i: r.r for r in df.select("i", json_text("raw").alias("r")).collect()}
    for i, (_, want) in enumerate(cases):
        assert (got[i].text, got[i].error) == (want, None), cases[i]
    for i in range(len(cases), len(cases) + len(bad)):
        assert got[i].text == "" and got[i].error.startswith("invalid JSON")
    assert got[len(cases) + 3].error is None and got[len(cases) + 4].text == ""


def test_folder_uris_and_limits(spark):
    d = _folder({"a.txt": "one", "big.txt": "x" * 2000, "sub/in.txt": "no", "n.json": '{"text": "j"}'})
    for uri in (d, "file://" + d, "file:" + d, d + "/"):
        assert {r.source_name for r in read_folder(spark, uri).collect()} == {"a.txt", "big.txt", "n.json"}
    rows = {r.source_name: r for r in read_folder(spark, d, max_bytes=1000).collect()}
    assert rows["big.txt"].error.startswith("2000 bytes") and rows["a.txt"].error is None
    chunks, rejects = preprocess_folder(spark, d, max_bytes=1000)
    assert sorted(r.text for r in chunks.collect()) == ["j", "one"]
    assert [r.source_name for r in rejects.collect()] == ["big.txt"]


def test_folder_is_read_once(spark):
    calls = _folder({"x": "x"})
    d = _folder({"ok.pdf": b"PAGE1", "t.txt": "t"})

    def extract(b: bytes) -> str:
        with open(os.path.join(calls, str(os.getpid()) + "-" + os.urandom(4).hex()), "w"):
            pass
        return b.decode().lower()

    chunks, _ = preprocess_folder(spark, d, extractors={".pdf": extract})
    assert chunks.count() == 2 and len(os.listdir(calls)) == 2


def test_folder_edge_cases(spark):
    d = _folder({
        "a.txt": b"hello \xff\xfe world",           # invalid UTF-8 dropped
        "b.MD": "Upper case suffix",
        "c.json": '{"text": "from json"}',
        "d.json": "",                               # empty -> skipped (no error)
        "e.json": '{"text": ""}',                   # present but empty wins
        "f.json": '{"content": 1}',
        "g.json": '["x", 2]',
        "h.json": "{not json",                      # error row
        "i.html": "<p>kept raw</p>",
        "j.pdf": b"%PDF-1.4 fake",
        "big.txt": "x" * 2000,
        "sub/inner.txt": "not listed",
    })
    docs = read_folder(spark, d, max_bytes=1000).collect()
    by = {r.source_name: r for r in docs}
    assert by["big.txt"].error and by["big.txt"].text == "" and "inner.txt" not in by
    assert by["a.txt"].text == "hello  world"
    assert by["b.MD"].text == "Upper case suffix"
    assert by["c.json"].text == "from json"
    # a zero-byte file yields no scan split in Spark: it contributes nothing,
    # exactly like the reference's "empty -> skip"
    assert "d.json" not in by or by["d.json"].text == ""
    assert by["e.json"].text == ""
    assert by["f.json"].text == "1"
    assert by["g.json"].text == '["x", 2]'
    assert by["h.json"].error and by["h.json"].text == ""
    assert by["i.html"].text == "<p>kept raw</p>"
    assert by["j.pdf"].text.startswith("%PDF")          # no extractor: read as text
    good, bad = split_rejects(read_folder(spark, d, max_bytes=1000))
    assert sorted(r.source_name for r in bad.collect()) == ["big.txt", "h.json"]
    assert good.count() == len(docs) - 2


def test_extractor_plugin_and_failures(spark):
    d = _folder({"ok.pdf": b"PAGE1", "bad.pdf": b"BROKEN", "t.txt": "t"})

    def extract(b: bytes) -> str:
        if b == b"BROKEN":
            raise ValueError("unreadable pdf")
        return b.decode().lower()

    by = {r.source_name: r for r in read_folder(spark, d, extractors={".PDF": extract}).collect()}
    assert by["ok.pdf"].text == "page1" and by["ok.pdf"].error is None
    assert by["bad.pdf"].error.startswith("ValueError")


def test_integer_stem_scan(spark):
    d = _folder({"12.txt": "twelve", "x.txt": "no", "007.md": "se\r\nven", "noext": "skip"})
    got = sorted((r.doc_id, r.text) for r in integer_stem_documents(spark, d).collect())
    assert got == [(7, "se\nven"), (12, "twelve")]


def test_query_aliases(spark):
    items = [
        {"query_num": 0, "id": "7", "query": "a"},       # 0 is falsy -> id "7"
        {"query_num": "0", "text": "b"},                # "0" is truthy
        {"query_id": 3, "query": ""},                   # '' or missing -> None -> skip
        {"id": 5, "query": None, "text": "c"},          # None or "c" -> "c"
        {"query_num": 0},                               # last alias missing -> skip
        {"query_id": 0, "text": "z"},                   # last alias kept even if falsy
    ]
    d = _folder({"q.json": json.dumps(items)})
    good, bad = read_query_file(spark, os.path.join(d, "q.json"))
    assert sorted((r.qid, r.query) for r in good.collect()) == [
        ("0", "b"), ("0", "z"), ("5", "c"), ("7", "a")]
    assert bad.count() == 2


def test_truth_csv(spark):
    d = _folder({"gt.csv": "query_id,relevant_document_ids\n"
                           "1,\"['a.txt', 'b.txt']\"\n"
                           "2,\"[\"\"c.txt\"\", 7]\"\n"
                           "3,[]\n"
                           "1,\"['z.txt']\"\n"
                           "4,{bad\n"})
    truth, bad = read_truth_csv(spark, os.path.join(d, "gt.csv"))
    got = sorted((r.qid, r.relevant) for r in truth.collect())
    assert got == [("1", "z.txt"), ("2", NON_STRING_TAG + "7"), ("2", "c.txt"), ("3", None)] or \
        sorted(got, key=str) == sorted([("1", "z.txt"), ("2", NON_STRING_TAG + "7"),
                                        ("2", "c.txt"), ("3", None)], key=str)
    assert [r.qid for r in bad.collect()] == ["4"]


def test_results_round_trip(spark):
    resp = spark.createDataFrame([("q1", "text", ["a", "b"]), ("q2", "t", [])],
                                 "qid string, query string, response array<string>")
    path = tempfile.mkdtemp(prefix="quarry-res-", dir="/tmp") + "/results"
    write_results(resp, path)
    write_results(resp.limit(1), path)       # overwrite: no stale results survive
    back = read_results(spark, path).collect()
    assert len(back) == 1 and back[0].qid in ("q1", "q2")


def test_chunk_exports_and_refs(spark):
    from pyspark.sql import functions as F

    from quarry.functions.text import source_from_ref
    from quarry.sources.sinks import export_chunks_jsonl, export_id_mapping
    chunks = spark.createDataFrame([(0, "a.txt", "a.txt::chunk0", "x y"),
                                    (1, "b::c.md", "b::c.md::chunk0", "z")],
                                   "chunk_id long, source_name string, chunk_ref string, text string")
    out = tempfile.mkdtemp(prefix="quarry-exp-", dir="/tmp")
    export_chunks_jsonl(chunks, out + "/chunks")
    export_id_mapping(chunks, out + "/ids")
    lines = sorted(spark.read.text(out + "/chunks").collect(), key=lambda r: r.value)
    assert json.loads(lines[0].value) == {"id": 0, "text": "x y"}
    refs = {r.id: r.ref for r in spark.read.json(out + "/ids").collect()}
    assert refs == {0: "a.txt::chunk0", 1: "b::c.md::chunk0"}
    # P5: the name is cut at the first '::', as in the reference
    got = [r.s for r in chunks.orderBy("chunk_id").select(
        source_from_ref(F.col("chunk_ref")).alias("s")).collect()]
    assert got == ["a.txt", "b"]


def test_search_without_index_raises():
    import pytest

    from quarry.operators.search import ivf_search
    with pytest.raises(ValueError):
        ivf_search(None, None, 10)


def test_folder_corpus_ids_follow_name_order(spark):
    from quarry.plans.pipeline import preprocess
    from quarry.sources.files import split_rejects
    words = " ".join(f"w{i}" for i in range(30))
    d = _folder({"b.txt": words, "a.md": "alpha beta", "c.json": '{"body": "gamma"}',
                 "é.txt": "delta", "bad.json": "{"})
    docs, _ = split_rejects(read_folder(spark, d))
    chunks = preprocess(docs, chunk_words=20, overlap=5).orderBy("chunk_id").collect()
    assert [c.chunk_ref for c in chunks] == [
        "a.md::chunk0", "b.txt::chunk0", "b.txt::chunk1", "c.json::chunk0", "é.txt::chunk0"]
    assert [c.chunk_id for c in chunks] == list(range(5))
    assert chunks[2].text == " ".join(f"w{i}" for i in range(15, 30))
