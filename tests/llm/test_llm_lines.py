"""Line and passage dedup against a version in plain strings, and what it must catch."""

import random
import re

import pytest

from quarry.llm import lines

M64 = (1 << 64) - 1
A = 0x9E3779B97F4A7C15


def mix(h):
    h = (h ^ (h >> 30)) * 0xBF58476D1CE4E5B9 & M64
    h = (h ^ (h >> 27)) * 0x94D049BB133111EB & M64
    return h ^ (h >> 31)


def folded(word):
    return "".join(c.lower() if c < "\x80" or "À" <= c <= "Þ" and c != "×" else c for c in word)


def word_hash(word):
    return mix(sum((b + 1) * pow(A, k, 1 << 64) for k, b in enumerate(word.encode())) & M64)


def text_units(text):
    """Words (place, folded) and units (first word, number of words, content)."""
    words = [(m.start(), folded(m.group())) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    hashes = []
    for k in range(len(words) - 7):
        h = 0
        for _, w in words[k:k + 8]:
            h = (h * A + word_hash(w)) & M64
        hashes.append(mix(h ^ 1))
    picked = set()
    for lo in range(-11, len(hashes)) if hashes else ():
        near = range(max(lo, 0), min(lo + 12, len(hashes)))
        low = min(hashes[k] for k in near)
        picked |= {k for k in near if hashes[k] == low}
    units = [(k, 8, ("stretch", *(w for _, w in words[k:k + 8]))) for k in picked]
    begin = 0
    for line in text.split("\n"):
        n = len(re.findall(r"[^\x20\x09-\x0D]+", line))
        if n >= 3:
            units.append((begin, n, ("line", *(w for _, w in words[begin:begin + n]))))
        begin += n
    return words, sorted(units, key=lambda u: (u[0], u[2][0]))


def plain(texts):
    """Texts in rank order -> (text, removed spans)."""
    known, everywhere = {}, {}
    parsed = [text_units(t or "") for t in texts]
    for k, (_, units) in enumerate(parsed):
        for at, n, content in units:
            known.setdefault(content, (k, at))
            everywhere[content] = everywhere.get(content, 0) + 1
    out = []
    for k, (text, (words, units)) in enumerate(zip(texts, parsed)):
        gone, stay, wide = set(), [], []
        for at, n, content in units:
            if known[content] == (k, at):
                if everywhere[content] > 1:
                    stay.append((at, at + n))
                continue
            a, b = at, at + n
            home, first = known[content]
            if min(p for p, _, c in units if c == content) < at:
                home, first = k, min(p for p, _, c in units if c == content)
            if content[0] == "stretch":
                other = parsed[home][0]
                for _ in range(11):
                    if not (a > 0 and first - (at - a) > 0 and words[a - 1][1] == other[first - (at - a) - 1][1]):
                        break
                    a -= 1
                for _ in range(11):
                    end = first + b - at
                    if not (b < len(words) and end < len(other) and words[b][1] == other[end][1]):
                        break
                    b += 1
            wide.append((a, b))
            gone |= set(range(a, b))
        for a, b in stay:
            if not any(x <= a and b <= y for x, y in wide):
                gone -= set(range(a, b))
        spans, j = [], 0
        while j < len(words):
            if j not in gone:
                j += 1
                continue
            lo = j
            while j < len(words) and j in gone:
                j += 1
            start, end = words[lo][0], words[j][0] if j < len(words) else len(text)
            if text[text.rfind("\n", 0, start) + 1:start].strip(" \t\n\v\f\r"):
                tail = text.find("\n", words[j - 1][0], end)
                end = tail if tail >= 0 else end
            spans.append((start, end))
        new = text
        for s, e in reversed(spans):
            new = new[:s] + new[e:]
        out.append((new, spans))
    return out


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "s") for i, t in zip(ids, texts)], "doc_id long, text string, _spans string")


def results(spark, texts, **kw):
    return {r.doc_id: (r.text, [tuple(s) for s in r.removed])
            for r in lines.deduplicate(frame(spark, texts), **kw).collect()}


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))


def test_equal_to_plain_strings(spark, monkeypatch):
    rng = random.Random(8)
    pool = [" ".join(rng.choice(["ab", "Cd", "ÉF", "gh", "×Þ"]) + str(rng.randint(0, 3)) for _ in range(rng.randint(1, 14)))
            for _ in range(40)] + [words(rng, 40) for _ in range(5)]
    texts = ["".join(rng.choice(pool) + rng.choice([" ", "\n", "\n\n", " \t"]) for _ in range(rng.randint(0, 12)))
             for _ in range(60)] + [None, "", "\n", "A b c.\nA  B c.\n", "ha " * 60, "one two three four five six seven " * 10]
    want = dict(enumerate(plain(texts)))
    assert results(spark, texts) == want
    monkeypatch.setattr(lines, "FILTER_BYTES", 8)        # a filter that lets everything pass
    monkeypatch.setattr(lines, "SLICE", 50)
    assert results(spark, texts) == want


@pytest.mark.parametrize("n", [20, 35, 50, 80])
def test_passages_inside_sentences_go_whole(spark, n):
    rng = random.Random(n)
    passages = [words(rng, n) for _ in range(40)]
    texts = [f"{words(rng, 11)} {p} {words(rng, 12)}." for p in passages * 3]
    got = results(spark, texts)
    left = 0
    for k, t in enumerate(texts):
        own, new = t.split(), got[k][0].split()
        if k < 40:
            assert got[k] == (t, [])
        else:
            assert new[:11] == own[:11] and new[-12:] == own[-12:]
            left += len(new) - 23
    assert left == 0


def test_clean_texts_stay(spark):
    rng = random.Random(3)
    clean = [f"{words(rng, 30)}.\n{words(rng, 2)}\n{words(rng, 9)}" for _ in range(50)] + ["Et.\nOui, non.", "Et.\nOui, non."]
    assert results(spark, clean) == {k: (t, []) for k, t in enumerate(clean)}


def test_a_kept_occurrence_is_never_cut(spark):
    rng = random.Random(4)
    a, b, c = words(rng, 25), words(rng, 25), words(rng, 25)
    texts = [f"{a} {words(rng, 5)}", f"{a} {b}", f"{b} {c}", f"{b}", "ha " * 60, f"{c} " * 7]
    got = results(spark, texts)
    assert got[0][0] == texts[0]
    assert got[1][0] == b and got[2][0] == c and got[3][0] == ""
    assert got[4][0].split() == ["ha"] * 8
    # whole repetitions go; what stays begins in one and ends in the next, once
    assert len(got[5][0].split()) < 25 and got[5][0].strip() in texts[5]
    alone = results(spark, [f"{c} " * 7])[0][0].split()
    assert alone[:25] == c.split() and len(alone) < 50


def test_lines_breaks_and_offsets(spark):
    texts = ["Tête à tête ici.\nsecond line here\n", "début: ünï\nTÊTE À TÊTE ICI.\n\nend of it\nsecond  line here"]
    got = results(spark, texts)
    assert got[0][0] == texts[0]
    assert got[1][0] == "début: ünï\nend of it\n"
    new = texts[1]
    for s, e in reversed(got[1][1]):
        new = new[:s] + new[e:]
    assert new == got[1][0]


def test_spans_of_equal_rows_are_listed_once(spark):
    text = "one two three\nfour five six"
    docs = frame(spark, [text, *[f"{text}\nseven eight nine"] * 50], [1] + [2] * 50)
    rows = lines.repeated_spans(docs, "doc_id", "text").collect()
    assert [sorted((s.word, s.words) for s in r.spans) for r in rows] == [[(0, 3), (3, 3)]]
    assert sorted({r.text for r in lines.deduplicate(docs).collect()}) == ["one two three\nfour five six", "seven eight nine"]


def test_ties_nulls_names_and_empty_tables(spark):
    docs = frame(spark, ["one two three", "one two three\nfour", "one two three", None], [1, 1, None, None])
    got = lines.without_repeats(docs)
    assert got.columns == docs.columns
    assert sum("one two three" in (r.text or "") for r in got.collect()) == 1
    assert got.count() == 4 and lines.deduplicate(frame(spark, [])).count() == 0
    named = docs.withColumnRenamed("_spans", "removed")
    assert lines.deduplicate(named).columns == ["doc_id", "text", "removed"]
