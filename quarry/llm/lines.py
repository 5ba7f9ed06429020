"""Substring deduplication by hashing lines and passages (operator 8).

Units of a text are its lines (of three words or more) and, because repeated passages
also stand inside longer lines, stretches of eight words.  Of the stretches only
those are units whose hash is the smallest among some twelve neighbours
("winnowing"): the choice depends on the words alone, and two texts that share
nineteen words or more share a unit there, wherever the passage stands.  Words are
compared without regard to case (Latin letters) and white space.

Of each digest the occurrence in the document with the smallest id, and there the
first, is kept, and every other one is removed.  A removed stretch is then widened
word by word as long as the words around the kept one, up to the next possible unit,
are the same.  Words of a kept occurrence are not cut, unless it lies whole inside such
a widened stretch.  Removed spans are reported as offsets (code points) in the original
text.

Two passes read the texts.  The first groups digests only, with a partial aggregate,
and writes those that recur.  The second finds the units again, and lets those pass
that a Bloom filter of the recurring digests knows (its size is bounded, a fuller one
only lets more pass); they are grouped by a longer digest for the kept occurrence, and
joined with it, so that a wrong guess of the filter costs a row and nothing else.  A
digest that stands everywhere is one row per task in the groups and a hot key in
the joins, whose rows Spark splits.  Spans are listed by document, each once however
often the row is repeated.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from ..session import materialize, scratch_table
from .bpe import raw_texts, slices
from .common import free_name, row_hash, table
from .minhash import mix, word_hashes

MIN_LINE_WORDS = 3
STRETCH = 8                 # words of a stretch
NEIGHBOURS = 12             # stretches of which the smallest hash is a unit
AROUND = NEIGHBOURS - 1     # words around a unit that no other unit needs to cover
SLICE = 2 << 20             # bytes of text looked at together
FILTER_BITS = 12            # of the Bloom filter for each recurring digest
FILTER_BYTES = 64 << 20     # and its greatest size
SEGMENT = 1 << 20           # bytes of the filter that one task makes
LAST = (1 << 63) - 1        # rank of documents without id
KEEP, REMOVE = 0, 1
# kinds of rows of the second pass: a unit to look up; a later occurrence in its own
# document; a first occurrence that has later ones there
LOOK_UP, AGAIN, FIRST = 0, 1, 2

_U = np.uint64
_A, _B = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)     # odd multipliers
_NONE = _U(0xFFFFFFFFFFFFFFFF)


def fold(raw: bytes) -> np.ndarray:
    """UTF-8 bytes with A-Z and the capitals of Latin-1 in lower case, place by place."""
    b = np.frombuffer(raw.lower(), np.uint8).copy()
    upper = np.flatnonzero(b[:-1] == 0xC3) + 1
    upper = upper[(b[upper] >= 0x80) & (b[upper] <= 0x9E) & (b[upper] != 0x97)]
    b[upper] += 0x20
    return b


class Words:
    """The words of some texts: hash, first byte and text of each, in order."""

    def __init__(self, raws: list[bytes]):
        self.size = np.array([len(r) for r in raws], np.int64)
        self.base = np.cumsum(self.size + 1) - self.size - 1    # where each text begins
        self.raw = fold(b"\n".join(raws))
        self.hash, self.first = word_hashes(self.raw)
        self.text = np.searchsorted(self.base, self.first, side="right") - 1
        self.begin = np.searchsorted(self.text, np.arange(len(raws) + 1))   # each text's first word
        # the line of each word; texts share none
        self.line = np.searchsorted(np.flatnonzero(self.raw == 10), self.first)


def _slide(a: np.ndarray, pick) -> np.ndarray:
    """``pick`` over each run of NEIGHBOURS values."""
    two = pick(a[:-1], a[1:])
    four = pick(two[:-2], two[2:])
    eight = pick(four[:-4], four[4:])
    n = len(a) - NEIGHBOURS + 1
    return pick(eight[:n], four[8:8 + n])


def chosen(h: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which stretches are units: the smallest of some NEIGHBOURS in a row; at the
    ends of a text, of those that there are."""
    apart = np.full(len(h) + (int(text[-1]) + 2) * NEIGHBOURS, _NONE)
    place = np.arange(len(h)) + (text + 1) * NEIGHBOURS
    apart[place] = h
    low = _slide(apart, np.minimum)
    reach = np.full(len(low) + 2 * (NEIGHBOURS - 1), _U(0))
    reach[NEIGHBOURS - 1:NEIGHBOURS - 1 + len(low)] = low
    return _slide(reach, np.maximum)[place] == h


def _ordered_hash(words: Words, start: np.ndarray, line_end: np.ndarray, base: np.uint64) -> np.ndarray:
    """Polynomial hash of each run of words ``start .. line_end``."""
    if not len(start):
        return np.zeros(0, _U)
    width = line_end - start
    power = np.cumprod(np.concatenate([np.ones(1, _U), np.full(max(int(width.max()) - 1, 0), base)]))
    place = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width)
    rows = np.repeat(start, width) + place
    return np.add.reduceat(words.hash[rows] * power[place], np.cumsum(width) - width)


class Units:
    """Units of some texts, by text: first word, number of words and two digests."""

    COLUMNS = ("word", "words", "stretch", "d", "d1", "text")

    def __init__(self, w: Words):
        n = max(len(w.hash) - STRETCH + 1, 0)
        a, b = np.zeros(n, _U), np.zeros(n, _U)
        for t in range(STRETCH):
            a, b = a * _A + w.hash[t:n + t], b * _B + w.hash[t:n + t]
        whole = np.flatnonzero(w.text[:n] == w.text[len(w.text) - n:]) if n else np.zeros(0, np.int64)
        a, b = mix(a[whole] ^ _U(1)), mix(b[whole] ^ _U(2))
        if len(whole):
            take = chosen(a, w.text[whole])
            whole, a, b = whole[take], a[take], b[take]
        first = np.flatnonzero(np.append(True, w.line[1:] != w.line[:-1])) if len(w.line) else np.zeros(0, np.int64)
        last = np.append(first[1:], len(w.line))[:len(first)]
        long = last - first >= MIN_LINE_WORDS
        first, last = first[long], last[long]
        self.word = np.concatenate([whole, first])
        self.words = np.concatenate([np.full(len(whole), STRETCH), last - first])
        self.stretch = np.arange(len(self.word)) < len(whole)
        self.d = np.concatenate([a, mix(_ordered_hash(w, first, last, _A) ^ _U(3))]).view(np.int64)
        self.d1 = np.concatenate([b, mix(_ordered_hash(w, first, last, _B) ^ _U(4))]).view(np.int64)
        self.text = w.text[self.word]
        order = np.lexsort((self.word, self.d1, self.d, self.text))
        for name in self.COLUMNS:
            setattr(self, name, getattr(self, name)[order])
        same = (self.text[1:] == self.text[:-1]) & (self.d[1:] == self.d[:-1]) & (self.d1[1:] == self.d1[:-1])
        self.again = np.append(False, same) if len(self.d) else np.zeros(0, bool)

    def where(self, mask: np.ndarray) -> Units:
        part = Units.__new__(Units)
        for name in self.COLUMNS:
            setattr(part, name, getattr(self, name)[mask])
        return part

    def around(self, w: Words, side: int) -> pa.Array:
        """Two bytes for each of up to AROUND words before (-1) or after (1) each
        stretch, nearest first; none for a line, which is whole."""
        low, high = w.begin[self.text], w.begin[self.text + 1]
        step = np.arange(AROUND)[None, :]
        at = (self.word[:, None] - 1 - step) if side < 0 else (self.word + self.words)[:, None] + step
        there = (at >= low[:, None]) & (at < high[:, None]) & self.stretch[:, None]
        short = (w.hash >> _U(48)).astype(np.uint16)
        values = short[np.clip(at, 0, len(short) - 1)][there]
        offsets = np.append(0, np.cumsum(2 * there.sum(axis=1))).astype(np.int32)
        return pa.BinaryArray.from_buffers(pa.binary(), len(self.d), [None, pa.array(offsets).buffers()[1],
                                                                      pa.py_buffer(values.tobytes())])


# ------------------------------------------------------------------ the two passes

def digest_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(d, id)``: first pass, the different digests of each document."""
    def run(batches):
        for batch in batches:
            for rb in slices(batch, "t", SLICE):
                u = Units(Words(raw_texts(rb.column("t"))))
                once = ~u.again
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u.d[once]), rb.column("id").take(pa.array(u.text[once]))], names=["d", "id"])

    return docs.select(_rank(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(run, "d bigint, id bigint")


def _rank(id_col: str):
    return F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(LAST))


def _bits(d: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment of each digest and its four bits there, of segments of ``size`` bytes."""
    h = mix(d.view(_U) ^ _B)
    bits = [(h >> _U(s)) % _U(8 * size) for s in (0, 13, 26, 39)]
    return (mix(h) >> _U(32)).astype(np.int64), np.stack(bits, axis=1).astype(np.int64)


def bloom_filter(digests: DataFrame) -> tuple[np.ndarray, int]:
    """A Bloom filter of column ``d`` and the size of its segments; at most
    FILTER_BYTES, made a segment at a time."""
    want = min(FILTER_BYTES, max(1, digests.count()) * FILTER_BITS // 8)
    parts = -(-want // SEGMENT)
    size = -(-want // parts)

    def segments(batches):
        for rb in batches:
            d = rb.column("d").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array((_bits(d, size)[0] % parts).astype(np.int32)), rb.column("d")],
                                             names=["part", "d"])

    def fill(batches):
        held: dict[int, np.ndarray] = {}
        for rb in batches:
            part, d = rb.column("part").to_numpy(), rb.column("d").to_numpy()
            bits = _bits(d, size)[1]
            for p in np.unique(part).tolist():
                held.setdefault(p, np.zeros(8 * size, bool))[bits[part == p].ravel()] = True
        for p, b in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([np.packbits(b).tobytes()], pa.binary())],
                                             names=["part", "bits"])

    out = np.zeros((parts, size), np.uint8)
    rows = digests.select("d").mapInArrow(segments, "part int, d bigint").repartition("part").mapInArrow(
        fill, "part int, bits binary")
    for r in rows.toLocalIterator():
        out[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel(), size


def known(d: np.ndarray, bloom: tuple[np.ndarray, int]) -> np.ndarray:
    """Digests that the filter may hold."""
    filled, size = bloom
    part, bits = _bits(d, size)
    byte = filled[(part % (len(filled) // size))[:, None] * size + (bits >> 3)]
    return ((byte >> (7 - (bits & 7)).astype(np.uint8)) & 1).all(axis=1)


UNIT_ROW = "id bigint, h bigint, d bigint, d1 bigint, word int, words int, kind int, l binary, r binary"


def unit_rows(docs: DataFrame, id_col: str, text_col: str, bloom) -> DataFrame:
    """Second pass: ``(id, h, d, d1, word, words, kind, l, r)``, units that the filter
    knows with the words around them, and repetitions within a document.  ``h`` is the
    row's hash."""
    def run(batches):
        for batch in batches:
            for rb in slices(batch, "t", SLICE):
                w = Words(raw_texts(rb.column("t")))
                u = Units(w)
                ahead = np.append(u.again[1:], False)
                # the first occurrence of each unit in its text
                first = np.maximum.accumulate(np.where(u.again, 0, np.arange(len(u.d))))
                for kind, mask in ((LOOK_UP, ~u.again & known(u.d, bloom.value)), (AGAIN, u.again),
                                   (FIRST, ahead & ~u.again)):
                    if not mask.any():
                        continue
                    part = u.where(mask)
                    row = pa.array(part.text)
                    near = part if kind == LOOK_UP else u.where(first[mask])
                    sides = [near.around(w, -1), near.around(w, 1)]
                    start = part.word - w.begin[part.text]
                    yield pa.RecordBatch.from_arrays(
                        [rb.column("id").take(row), rb.column("h").take(row), pa.array(part.d), pa.array(part.d1),
                         pa.array(start.astype(np.int32)), pa.array(part.words.astype(np.int32)),
                         pa.array(np.full(len(start), kind, np.int32)), *sides],
                        names=["id", "h", "d", "d1", "word", "words", "kind", "l", "r"])

    return docs.select(_rank(id_col).alias("id"), row_hash(docs).alias("h"), F.col(text_col).alias("t")).mapInArrow(
        run, UNIT_ROW)


def repeated_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, h, spans)``: for each document that loses something, the first word
    and the number of words of its units to remove or to keep, and for those to
    remove the words around the kept occurrence."""
    spark = docs.sparkSession
    grouped = digest_rows(docs, id_col, text_col).groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    with scratch_table(grouped.where("n > 1").select("d"), "repeated-units") as recurring:
        bloom = spark.sparkContext.broadcast(bloom_filter(recurring))
    with scratch_table(unit_rows(docs, id_col, text_col, bloom), "units") as rows:
        units = rows.where(F.col("kind") == LOOK_UP)
        # the first document of each digest, by (id, row hash)
        kept = units.groupBy("d", "d1").agg(F.min(F.struct("id", "h", "l", "r")).alias("k"),
                                            F.max(F.struct("id", "h")).alias("z"))
        kept = kept.where("k.id <> z.id OR k.h <> z.h").select(
            "d", "d1", F.col("k.id").alias("k_id"), F.col("k.h").alias("k_h"), F.col("k.l").alias("k_l"), F.col("k.r").alias("k_r"))
        own = F.expr("id = k_id AND h = k_h")
        found = units.drop("l", "r").join(kept, ["d", "d1"]).select(
            "id", "h", "word", "words", F.when(own, KEEP).otherwise(REMOVE).alias("what"),
            F.when(~own, F.col("k_l")).alias("l"), F.when(~own, F.col("k_r")).alias("r"))
        within = rows.where(F.col("kind") != LOOK_UP).select(
            "id", "h", "word", "words", F.when(F.col("kind") == FIRST, KEEP).otherwise(REMOVE).alias("what"), "l", "r")
        # rows equal in all columns give the same spans: a set is bounded by one text's units
        spans = found.unionByName(within).groupBy("id", "h").agg(
            F.collect_set(F.struct("word", "words", "what", "l", "r")).alias("spans"))
        return materialize(spans.where(F.exists("spans", lambda x: x.what == REMOVE)), "spans")


# ------------------------------------------------------------------ cutting

def lost_words(short: np.ndarray, spans: list[dict]) -> np.ndarray:
    """Which words go, from a text's short word hashes and its spans.  A kept
    occurrence stays, unless it lies inside a stretch that stands elsewhere as a whole
    (the choice of units may differ at its ends)."""
    removed = []
    for s in spans:
        if s["what"] != REMOVE:
            continue
        a, b = s["word"], s["word"] + s["words"]
        for value in np.frombuffer(s["l"] or b"", np.uint16).tolist():
            if not a or short[a - 1] != value:
                break
            a -= 1
        for value in np.frombuffer(s["r"] or b"", np.uint16).tolist():
            if b == len(short) or short[b] != value:
                break
            b += 1
        removed.append((a, b))
    gone = np.zeros(len(short), bool)
    if not removed:
        return gone
    for a, b in removed:
        gone[a:b] = True
    removed = np.array(sorted(removed))
    reach = np.maximum.accumulate(removed[:, 1])        # the furthest end of those that begin up to here
    for s in spans:
        a, b = s["word"], s["word"] + s["words"]
        at = int(np.searchsorted(removed[:, 0], a, side="right")) - 1
        if s["what"] == KEEP and (at < 0 or reach[at] < b):
            gone[a:b] = False
    return gone


def cut(raw: bytes, first: np.ndarray, gone: np.ndarray) -> tuple[str, list[dict]]:
    """The text without the words that are gone, and the removed spans (code points).
    A span reaches to the next word; of words that end their line but don't begin
    it, the line break stays."""
    b = np.frombuffer(raw, np.uint8)
    place = np.cumsum(np.append(0, (b & 0xC0) != 0x80))         # code points before each byte
    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    kept, spans, at = [], [], 0
    for lo, hi in edge.reshape(-1, 2).tolist():
        start = int(first[lo])
        end = int(first[hi]) if hi < len(first) else len(raw)
        line = raw.rfind(b"\n", 0, start) + 1
        if raw[line:start].strip():
            tail = raw.find(b"\n", int(first[hi - 1]), end)
            end = tail if tail >= 0 else end
        kept.append(raw[at:start])
        spans.append({"start": int(place[start]), "end": int(place[end])})
        at = end
    kept.append(raw[at:])
    return b"".join(kept).decode(), spans


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                spans_col: str = "removed") -> DataFrame:
    """``docs`` with repeated units cut out of the text, and ``spans_col``, the
    removed spans ``array<struct<start, end>>`` of the original text (empty if
    none).  No row is dropped: a text may become empty.  Null text stays null; null
    ids rank last; rows with equal ids rank by a hash of the row.  Rows equal in
    all columns are one document here: each keeps or loses the same.  A column of
    ``docs`` named as ``spans_col`` is replaced."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() == spans_col.lower()])
    i, h, sp = (free_name(docs, x) for x in ("_id", "_h", "_spans"))
    found = repeated_spans(docs, id_col, text_col).select(
        F.col("id").alias(i), F.col("h").alias(h), F.col("spans").alias(sp))
    keyed = docs.withColumn(h, row_hash(docs)).withColumn(i, _rank(id_col))
    joined = keyed.join(found, [i, h], "left").select(*[F.col(f"`{c}`") for c in docs.columns], sp)
    at = docs.columns.index(text_col)
    kind = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))
    schema = StructType([*docs.schema.fields, StructField(spans_col, kind)])
    names = docs.columns

    def run(batches):
        for batch in batches:
            for rb in slices(batch, text_col, SLICE):
                texts, spans = rb.column(text_col), rb.column(sp).to_pylist()
                hit = [k for k, x in enumerate(spans) if x]
                gone = [[] for _ in spans]
                if hit:
                    raws = raw_texts(texts.take(pa.array(hit)))
                    w = Words(raws)
                    short = (w.hash >> _U(48)).astype(np.uint16)
                    new = texts.to_pylist()
                    for j, k in enumerate(hit):
                        own = slice(int(w.begin[j]), int(w.begin[j + 1]))
                        lost = lost_words(short[own], spans[k])
                        if lost.any():
                            new[k], gone[k] = cut(raws[j], w.first[own] - w.base[j], lost)
                    texts = pa.array(new, texts.type)
                cols = [rb.column(c) for c in range(len(names))]
                cols[at] = texts
                spans = pa.array(gone, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
                yield pa.RecordBatch.from_arrays([*cols, spans], names=[*names, spans_col])

    return joined.mapInArrow(run, schema)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", "removed", F.size("removed").alias("n_removed"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated units cut out, same columns."""
    name = free_name(docs, "_removed")
    return deduplicate(docs, spans_col=name).drop(name)
