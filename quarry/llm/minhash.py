"""One-permutation MinHash fingerprints (operator 12).

Every shingle of five words is hashed once.  The top bits of the hash choose one of
the bins, and each bin keeps its smallest hash.  An empty bin takes the value of
another: a hash of (bin, attempt), the same for all texts, names bins one after the
other until one that isn't empty (optimal densification), so two texts of likeness R
agree in any bin with chance R.  Only the low bits of a bin's value, mixed with the
number of the bin, are stored.  Bins of different values still agree with chance
``2^-bits``, which :func:`likeness` takes off again.

Words and shingles are hashed over whole buffers of text at once; a text is never cut
short.  For comparing each text with the next one the rows are dealt once, by ranges
of (id, hash of the text) between keys that a bounded sample gives; the first row of
each range also goes to the range before it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .bpe import slices
from .common import number_hot_copies, table, worker_state

SHINGLE = 5
BINS = 512
BITS = 4
SEED = 12
SLICE = 4 << 20             # bytes of text hashed together
SLICE_ROWS = 1024
SCAN_BYTES = 1 << 22        # bytes whose words are hashed together
FEW = 16                    # filled bins up to which empty ones look through all of them
RANGE_BYTES = 16 << 20      # text aimed at in one range of neighbours
MAX_RANGES = 1 << 18        # keys sent to the tasks, 25 bytes each
RANGES_PER_TASK = 8
KEYS_PER_RANGE = 8          # sampled keys for each range

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_EMPTY = _U(0xFFFFFFFFFFFFFFFF)


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64, public domain)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _powers(n: int) -> np.ndarray:
    state = worker_state()
    have = state.get("minhash_powers")
    if have is None or len(have) < n:
        have = np.cumprod(np.concatenate([np.ones(1, _U), np.full(max(n, 256) - 1, _BASE)]))
        if len(have) <= 1 << 20:
            state["minhash_powers"] = have
    return have


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, first byte)`` of every word of a buffer of UTF-8 text; words lie
    between spaces, tabs and line ends.  Long buffers are read in parts that end at
    a word's end."""
    gap = (raw == 32) | ((raw >= 9) & (raw <= 13))
    hashes, firsts, at = [], [], 0
    while at < len(raw):
        to = at + SCAN_BYTES
        if to < len(raw):
            rest = np.argmax(gap[to:])
            to = to + int(rest) if gap[to + int(rest)] else len(raw)
        b, g = raw[at:to], gap[at:to]
        begins = ~g
        begins[1:] &= g[:-1]
        start = np.flatnonzero(begins)
        if len(start):
            width = np.diff(np.append(start, len(b)))
            place = np.arange(start[0], len(b)) - np.repeat(start, width)
            # bytes after a word are gaps up to the next one and count nothing
            terms = np.where(g[start[0]:], _U(0), b[start[0]:].astype(_U) + _U(1))
            terms *= _powers(int(width.max()))[place]
            hashes.append(mix(np.add.reduceat(terms, start - start[0])))
            firsts.append(start + at)
        at = to
    if not hashes:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(firsts)


def shingle_hashes(texts: list[bytes], shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """``(text, hash)`` of all shingles; a text of fewer words has one, of them all."""
    raw = np.frombuffer(b"\n".join(texts), np.uint8)
    words, first = word_hashes(raw)
    ends = np.cumsum([len(t) + 1 for t in texts])
    text = np.searchsorted(ends, first, side="right")
    count = np.bincount(text, minlength=len(texts))
    n = max(len(words) - shingle + 1, 0)
    h = words[:n].copy()
    for t in range(1, shingle):
        h = h * _BASE + words[t:n + t]
    whole = text[:n] == text[len(text) - n:] if n else np.zeros(0, bool)
    owner, h = text[:n][whole], h[whole]
    short = np.flatnonzero((count > 0) & (count < shingle))
    if len(short):
        begin = (np.cumsum(count) - count)[short]
        own = np.zeros(len(short), _U)
        for t in range(shingle - 1):
            more = count[short] > t
            own[more] = own[more] * _BASE + words[begin[more] + t]
        owner, h = np.append(owner, short), np.append(h, own)
    return owner, mix(h ^ _U(SEED))


def _named(attempt: int, bins: int) -> np.ndarray:
    """The bin that each empty bin looks at in an attempt."""
    x = np.arange(bins, dtype=_U) + _U(attempt) * _U(bins)
    return (mix(mix(x) + _BASE) % _U(bins)).astype(np.int64)


def _first_attempt(bins: int) -> np.ndarray:
    """``[c, j]``: the attempt at which bin c looks at bin j for the first time."""
    state = worker_state()
    key = f"minhash_attempts_{bins}"
    if key not in state:
        out = np.zeros((bins, bins), np.int32)
        at, attempt = np.arange(bins), 0
        while (out == 0).any():
            for _ in range(bins):
                attempt += 1
                j = _named(attempt, bins)
                new = out[at, j] == 0
                out[at[new], j[new]] = attempt
        state[key] = out
    return state[key]


def densify(low: np.ndarray) -> np.ndarray:
    """Fill the empty bins of each row from the bins that the attempts name; a row
    without any value stays empty."""
    filled = low != _EMPTY
    n = filled.sum(axis=1)
    bins = low.shape[1]
    out = low.copy()
    for r in np.flatnonzero((n > 0) & (n <= FEW)):
        have = np.flatnonzero(filled[r])
        first = _first_attempt(bins)[:, have]
        values = low[r, have[np.argmin(first, axis=1)]]
        out[r] = np.where(filled[r], low[r], values)
    row, col = np.nonzero(~filled & (n > FEW)[:, None])
    attempt = 0
    while len(row):
        attempt += 1
        j = _named(attempt, bins)[col]
        hit = filled[row, j]
        out[row[hit], col[hit]] = low[row[hit], j[hit]]
        row, col = row[~hit], col[~hit]
    return out


class Sketches:
    """Stored bits of some texts: one row of ``bins`` small numbers for each, and
    whether it has any word."""

    def __init__(self, low: np.ndarray, some: np.ndarray, bits: int):
        self.low, self.some, self.bits = low, some, bits

    @classmethod
    def of(cls, texts: list[bytes], shingle: int = SHINGLE, bins: int = BINS, bits: int = BITS) -> Sketches:
        owner, h = shingle_hashes(texts, shingle)
        low = np.full(len(texts) * bins, _EMPTY)
        width = int(bins).bit_length() - 1
        np.minimum.at(low, owner * bins + (h >> _U(64 - width)).astype(np.int64), h & _U((1 << (64 - width)) - 1))
        low = low.reshape(len(texts), bins)
        some = (low != _EMPTY).any(axis=1)
        values = mix(densify(low) + np.arange(bins, dtype=_U)[None, :] * _BASE)
        stored = (values & _U((1 << bits) - 1)).astype(np.uint8)
        stored[~some] = 0
        return cls(stored, some, bits)

    def take(self, rows) -> Sketches:
        return Sketches(self.low[rows], self.some[rows], self.bits)

    def hex(self) -> list[str]:
        """Packed bits in hexadecimal; of a text without words an empty string."""
        planes = [(self.low >> s) & 1 for s in range(self.bits - 1, -1, -1)]
        packed = np.packbits(np.stack(planes, axis=2).reshape(len(self.low), -1), axis=1)
        return [p.tobytes().hex() if s else "" for p, s in zip(packed, self.some)]

    @classmethod
    def parse(cls, fingerprints: list[str], bins: int = BINS, bits: int = BITS) -> Sketches:
        some = np.array([bool(f) for f in fingerprints], bool)
        raw = b"".join(bytes.fromhex(f) if f else bytes(bins * bits // 8) for f in fingerprints)
        planes = np.unpackbits(np.frombuffer(raw, np.uint8)).reshape(len(some), bins, bits)
        return cls((planes * (1 << np.arange(bits - 1, -1, -1))).sum(axis=2).astype(np.uint8), some, bits)


def likeness(a: Sketches, b: Sketches) -> np.ndarray:
    """Estimated share of common shingles, row by row: the share of equal bins, less
    what unequal values give by chance.  Two texts without words are alike, one
    without and one with words are not."""
    chance = 2.0 ** -a.bits
    same = (a.low == b.low).mean(axis=1)
    est = np.clip((same - chance) / (1 - chance), 0.0, 1.0)
    return np.where(a.some & b.some, est, (a.some == b.some).astype(float))


def _check(bins: int, bits: int):
    if bins < 2 or bins & (bins - 1) or not 1 <= bits <= 8 or bins * bits % 8:
        raise ValueError("bins must be a power of two, bits 1 to 8, and their product whole bytes")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 bins: int = BINS, bits: int = BITS) -> DataFrame:
    """``(doc_id, fingerprint)`` for every row, where it is read.  A null text is
    empty and its fingerprint an empty string; null ids and equal rows each give a
    row; further columns, whatever their names, are left behind."""
    _check(bins, bits)

    def run(batches):
        for rb in _pieces(batches):
            texts = [t.encode() for t in rb.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [rb.column("doc_id"), pa.array(Sketches.of(texts, shingle, bins, bits).hex(), pa.string())],
                names=["doc_id", "fingerprint"])

    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, fingerprint string")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_text"))


def _pieces(batches):
    for batch in batches:
        for part in slices(batch, "_text", SLICE):
            for at in range(0, part.num_rows, SLICE_ROWS):
                yield part.slice(at, SLICE_ROWS)


# ------------------------------------------------------------------ neighbours

def _order_key(some: np.ndarray, doc_id: np.ndarray, h: np.ndarray, copy: np.ndarray) -> np.ndarray:
    """Bytes that sort as (id with nulls first, hash of the text, copy)."""
    out = np.empty((len(h), 25), np.uint8)
    out[:, 0] = some
    for k, x in enumerate((doc_id, h, copy)):
        signed = x.astype(np.int64).view(_U) ^ _U(1 << 63)
        out[:, 1 + 8 * k:9 + 8 * k] = signed.astype(">u8").view(np.uint8).reshape(-1, 8)
    return out.view("S25").ravel()


def _by_neighbours(docs: DataFrame, id_col: str, text_col: str, range_bytes: int) -> DataFrame:
    """Rows ``(_range, _guest, doc_id, _text)``, each range sorted by (doc_id, text)
    in one partition; its last row, a guest, is the first of the next range (of the
    last range: of the first)."""
    spark = docs.sparkSession
    rows = _texts(docs, id_col, text_col).withColumn("_h", F.xxhash64("_text"))
    rows = number_hot_copies(rows, "_copy")
    key = F.struct(F.col("doc_id").isNotNull().alias("s"), F.coalesce("doc_id", F.lit(0)).alias("d"),
                   F.col("_h").alias("h"), F.col("_copy").alias("c"))
    n, size, least = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("_text")), F.min(key)).first()
    # several ranges for each task, so that they spread evenly
    tasks = max(shuffle_partitions(spark), -(-int(size or 0) // (range_bytes * RANGES_PER_TASK)))
    wanted = min(MAX_RANGES, tasks * RANGES_PER_TASK)
    every = max(1, n // max(1, wanted * KEYS_PER_RANGE))

    def keys_of(tbl) -> np.ndarray:
        return _order_key(*[np.asarray(tbl.column(c).to_numpy(zero_copy_only=False)) for c in "sdhc"])

    # a sample by hash, of about KEYS_PER_RANGE keys for each range
    sample = rows.where(F.pmod(F.xxhash64("doc_id", "_h", "_copy"), F.lit(every)) == 0).select(key.alias("k"))
    cuts = np.unique(keys_of(sample.select("k.*").toArrow().combine_chunks()))
    cuts = cuts[KEYS_PER_RANGE // 2::KEYS_PER_RANGE]
    first = None if least is None else _order_key(*[np.array([least[c]]) for c in "sdhc"])[0]
    bc = spark.sparkContext.broadcast((cuts, first))

    @F.pandas_udf("array<struct<r:int,g:boolean>>")
    def places(s: pd.Series, d: pd.Series, h: pd.Series, c: pd.Series) -> pd.Series:
        bounds, smallest = bc.value
        keys = _order_key(*[x.to_numpy() for x in (s, d, h, c)])
        at = np.searchsorted(bounds, keys, side="right")
        opens = at > 0
        if len(bounds):
            opens &= bounds[np.maximum(at - 1, 0)] == keys
        out = []
        for r, o, m in zip(at.tolist(), opens.tolist(), (keys == smallest).tolist()):
            p = [{"r": r, "g": False}]
            if o:
                p.append({"r": r - 1, "g": True})
            if m:
                p.append({"r": len(bounds), "g": True})
            out.append(p)
        return pd.Series(out)

    placed = rows.withColumn("_p", F.explode(places(*[key.getField(c) for c in "sdhc"])))
    return (placed.select(F.col("_p.r").alias("_range"), F.col("_p.g").alias("_guest"), "doc_id", "_text", "_h", "_copy")
            .repartition(tasks, "_range")
            .sortWithinPartitions("_range", "_guest", F.asc_nulls_first("doc_id"), "_h", "_copy")
            .select("_range", "_guest", "doc_id", "_text"))


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by the first as many
    code points of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                      bins: int = BINS, bits: int = BITS, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited,
    near_next)`` for every row: its text edited by the next one's, the fingerprints
    of both, and their likeness to each other and to the next row's.

    The next row is the one after it by id, the first one after the last; a single
    row is its own next.  Null ids come first; rows of one id lie in the order of the
    hashes of their texts.  Null texts are empty.  Equal rows each give a row, and
    many of them are numbered so that ranges can part them.  Further columns of
    ``docs`` are left behind."""
    _check(bins, bits)

    def run(batches):
        last = None                     # (range, doc_id, text, sketch) that waits for its next
        for rb in _pieces(batches):
            texts = rb.column("_text").to_pylist()
            rng, guest = rb.column("_range").to_pylist(), rb.column("_guest").to_pylist()
            ids = rb.column("doc_id").to_pylist()
            own = Sketches.of([t.encode() for t in texts], shingle, bins, bits)
            if last is not None:
                rng, guest, ids, texts = [last[0]] + rng, [False] + guest, [last[1]] + ids, [last[2]] + texts
                own = Sketches(np.vstack([last[3].low, own.low]), np.append(last[3].some, own.some), bits)
            # every row but a guest has its next right behind it
            rows = [k for k in range(len(texts) - 1) if not guest[k]]
            after = [k + 1 for k in rows]
            if any(rng[k] != rng[k + 1] for k in rows):
                raise RuntimeError("a range ends without the first row of the next")
            new = [edited(texts[k], texts[k + 1]) for k in rows]
            mine = own.take(rows)
            changed = Sketches.of([t.encode() for t in new], shingle, bins, bits)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[k] for k in rows], pa.int64()), pa.array([len(texts[k]) for k in rows], pa.int64()),
                     pa.array(new, pa.string()), pa.array(mine.hex(), pa.string()), pa.array(changed.hex(), pa.string()),
                     pa.array(likeness(mine, changed)), pa.array(likeness(mine, own.take(after)))],
                    names=["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
            last = None if guest[-1] else (rng[-1], ids[-1], texts[-1], own.take([len(texts) - 1]))
        if last is not None:
            raise RuntimeError("a range ends without the first row of the next")

    return _by_neighbours(docs, id_col, text_col, range_bytes).mapInArrow(
        run, "doc_id bigint, n_chars bigint, edited string, fingerprint string, edited_fingerprint string,"
             " near_edited double, near_next double")


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next")
