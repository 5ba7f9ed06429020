"""Periodic runs of words by a dictionary of basic factors (operator 13).

A *run* is a stretch of consecutive words whose smallest period ``q`` repeats at
least twice in it and that no neighbouring word extends.  The dictionary names all
stretches ("factors") of 1, 2, 4, ... words, so that equal ones have equal names;
a name for 2L words is the pair of two names for L.  Only factors that occur again
in their text are carried to the next power, so ordinary prose drops out early.

A run of period ``L <= q < 2L`` starts with a factor of L words that comes again q
words later.  Along the successors of a factor, occurrences at most L/2 apart have
one common distance (two periods of one word have their greatest common divisor as
a period too): they form arithmetic progressions, of which at most four meet within
2L words.  Two members of one progression have a smaller period; of two
progressions, a run's start and its repetition are such that at least one of them
is the first of its own, or the run would begin earlier.  So the distances between
each occurrence and the first members of the progressions near it propose every
period, a few for each word and power.  A proposal that could begin one word
earlier is dropped; the others are extended by the names from the longest power
down, and of proposals with the same stretch the smallest period stays.

The texts are worked on where they are read, about a megabyte at a time and a longer
text by itself; there is no shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import raw_texts, slices
from .common import table

MIN_LENGTH = 12             # words of the shortest run
SLICE = 1 << 20             # bytes of text looked at together
RUN = "struct<start:bigint,length:bigint,period:bigint>"

# A change of a text before it is searched: (id, number of words) -> word numbers or None.
Edit = Callable[[int | None, int], np.ndarray | None]


class Factors:
    """Names of the factors of ``2^k`` words for each power k at which one comes
    again.  Words are whole numbers; texts that lie side by side share none."""

    def __init__(self, words: np.ndarray):
        self.n = n = len(words)
        single = -1 - np.arange(n + 1, dtype=np.int64)      # a name for what occurs once
        self.names: list[np.ndarray] = []
        # per power: (occurrences by name and place, their names)
        self.again: list[tuple[np.ndarray, np.ndarray]] = []
        at, key, step = np.arange(n), words.astype(np.int64), 1
        while len(at):
            order = np.argsort(key, kind="stable")
            at, key = at[order], key[order]
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            twice = ~(new & np.append(new[1:], True))
            at, name = at[twice], (np.cumsum(new) - 1)[twice]
            if not len(at):
                break
            names = single.copy()
            names[at] = name
            self.names.append(names)
            self.again.append((at, name))
            at = np.sort(at)
            at = at[at + step < n]
            at = at[names[at + step] >= 0]
            key = names[at] * n + names[at + step]
            step *= 2

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of words that agree from ``i`` and from ``j > i`` on."""
        m = np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            names = self.names[k]
            m += np.where(names[i + m] == names[np.minimum(j + m, self.n)], 1 << k, 0)
        return m


def proposals(at: np.ndarray, name: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) proposed by the factors of ``size`` words, periods in
    ``[size, 2 size)``; ``at`` are occurrences by name and place."""
    first = np.ones(len(at), bool)
    first[1:] = (name[1:] != name[:-1]) | (2 * (at[1:] - at[:-1]) > size)
    series = np.cumsum(first) - 1
    head, of = at[first], name[first]
    places, periods = [], []
    for t in (1, 2, 3):                     # series t further on start over t * size / 2 later
        to = np.minimum(series + t, len(head) - 1)
        q = head[to] - at
        ok = (of[to] == name) & (q >= size) & (q < 2 * size)
        places.append(at[ok])
        periods.append(q[ok])
        to = np.maximum(series - t, 0)
        q = at - head[to]
        ok = (of[to] == name) & (q >= size) & (q < 2 * size)
        places.append(head[to][ok])
        periods.append(q[ok])
    return np.concatenate(places), np.concatenate(periods)


def find_runs(words: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, length, period)`` of all runs, by start, then period."""
    f = Factors(words)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for k, (at, name) in enumerate(f.again):
        i, q = proposals(at, name, 1 << k)
        before = np.maximum(i - 1, 0)
        starts = (i == 0) | (words[before] != words[before + q])
        found.append((i[starts], q[starts]))
    start, period = (np.concatenate(x) for x in zip(*found))
    length = period + f.common(start, start + period)
    ok = length >= np.maximum(min_length, 2 * period)
    start, length, period = start[ok], length[ok], period[ok]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    if len(start):
        new = np.ones(len(start), bool)     # one stretch: its smallest period
        new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
        start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def collapse(raws: list[bytes], ids: list, edit: Edit | None, min_length: int):
    """Runs of each text and its words without the repetitions."""
    texts, numbers, base = [], [], 0
    for raw, doc in zip(raws, ids):
        words = raw.split()                 # at x20, x09-x0D
        order = edit(doc, len(words)) if edit else None
        if order is not None:
            words = [words[j] for j in order.tolist()]
        known = dict.fromkeys(words)
        known = dict(zip(known, range(base, base + len(known))))
        base += len(known)
        texts.append(words)
        numbers.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
    sizes = np.array([len(w) for w in texts], np.int64)
    ends = np.cumsum(sizes)
    start, length, period = find_runs(np.concatenate(numbers), min_length)
    doc = np.searchsorted(ends, start, side="right")
    change = np.zeros(int(ends[-1]) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    keep = np.cumsum(change) == 0
    n_runs = np.bincount(doc, minlength=len(texts))
    collapsed = []
    for k, words in enumerate(texts):
        if n_runs[k]:
            words = compress(words, keep[ends[k] - sizes[k]:ends[k]].tolist())
        collapsed.append(b" ".join(words))
    runs = pa.StructArray.from_arrays([pa.array(start - (ends - sizes)[doc]), pa.array(length), pa.array(period)],
                                      names=["start", "length", "period"])
    offsets = np.append(0, np.cumsum(n_runs)).astype(np.int32)
    return sizes, pa.ListArray.from_arrays(pa.array(offsets), runs), collapsed


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_length: int = MIN_LENGTH, edit: Edit | None = None) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` for every row of ``docs``: all runs of
    its words of at least ``min_length``, by start, then period, and the text
    without the words that a run repeats, joined by one space.

    Words are what lies between spaces, tabs and line ends.  A null text has no
    words; equal rows and null ids each give a row; further columns of ``docs``,
    whatever their names, are left behind.  ``edit`` may give another order of a
    text's words before the search.  One text is held whole in its task."""
    def search(batches):
        for batch in batches:
            for rb in slices(batch, "_text", SLICE):
                ids = rb.column("doc_id").to_pylist()
                sizes, runs, collapsed = collapse(raw_texts(rb.column("_text")), ids, edit, min_length)
                yield pa.RecordBatch.from_arrays(
                    [rb.column("doc_id"), pa.array(sizes), runs, pa.array(collapsed, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("_text"))
    return rows.mapInArrow(search, f"doc_id bigint, n_words bigint, runs array<{RUN}>, collapsed string")


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The query's own repetitions: of every tenth document by checksum, the words
    from a on repeat with period p.  A null id has none."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i >= a, a + (i - a) % p, i)


def longest(runs: str = "runs") -> Column:
    """The run of greatest length; ties to the smallest start, then period."""
    return F.array_max(F.transform(runs, lambda r: F.struct(
        r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), edit=planted)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start.cast("string"), r.length.cast("string"),
                                                               r.period.cast("string")), F.lit("\n")))
    best = found.withColumn("best", longest())
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
