"""Vector column expressions and the numpy kernels used inside Arrow tasks."""

from __future__ import annotations

import math
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import WHITESPACE_CHARS, white_space_words


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- expressions

def hash_bucket(token, dim: int) -> Column:
    """Feature-hash bucket of a token: first 32 bits of its MD5, modulo ``dim``.
    The same number comes out of DuckDB (``('0x'||substr(md5(t),1,8))::BIGINT``)
    and Python (``int(md5(t).hexdigest()[:8], 16)``)."""
    h = F.conv(F.substring(F.md5(_col(token)), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(dim))


def hash_buckets(text, dim: int) -> Column:
    """array<bigint> of the buckets of a text's words (split at white space)."""
    return F.transform(white_space_words(text), lambda t: hash_bucket(t, dim))


# ---------------------------------------------------------------- words in Arrow tasks

_OTHER_WHITE = "[" + WHITESPACE_CHARS.replace(" ", "") + "]"
_WIDE_WHITE = "[" + "".join(c for c in WHITESPACE_CHARS if c > "\x7f") + "]"
_IN_WORDS = np.array([chr(b) not in WHITESPACE_CHARS or b > 0x7f for b in range(256)])
# Of MD5 (RFC 1321): left turns and constants of the 64 steps, initial state.
_TURNS = np.repeat([[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]], 4, axis=0).ravel().tolist()
_SINES = [np.uint32(int(abs(math.sin(i + 1)) * 2 ** 32)) for i in range(64)]
_STATE = [np.uint32(x) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
MD5_WORDS = 1 << 13         # hashed at a time: what a core's caches hold


def _md5_start(blocks: np.ndarray) -> np.ndarray:
    """First 32 bits, as a number, of the MD5 of messages of one block each: ``(n, 16)``
    little-endian words, padding included."""
    x = np.ascontiguousarray(blocks.T)
    a, b, c, d = (np.full(x.shape[1], v) for v in _STATE)
    for i in range(64):
        if i < 16:
            f, g = d ^ (b & (c ^ d)), i
        elif i < 32:
            f, g = c ^ (d & (b ^ c)), (5 * i + 1) % 16
        elif i < 48:
            f, g = b ^ c ^ d, (3 * i + 5) % 16
        else:
            f, g = c ^ (b | ~d), 7 * i % 16
        f += a
        f += x[g]
        f += _SINES[i]
        turn = _TURNS[i]
        a, d, c, b = d, c, b, b + (f << np.uint32(turn) | f >> np.uint32(32 - turn))
    return (a + _STATE[0]).byteswap()


def word_buckets(words: pa.Array, dim: int) -> np.ndarray:
    """:func:`hash_bucket` of each word of a string array without nulls."""
    words = pa.concat_arrays([words.cast(pa.binary())])         # offsets from 0
    at = np.frombuffer(words.buffers()[1], np.int32)[:len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    size, out = np.diff(at), np.empty(len(words), np.int64)
    short = np.flatnonzero(size < 56)                           # with padding, one block
    for lo in range(0, len(short), MD5_WORDS):
        some = short[lo:lo + MD5_WORDS]
        n = size[some]
        blocks = np.zeros((len(some), 64), np.uint8)
        first = np.cumsum(n) - n
        place = np.arange(n.sum()) - np.repeat(first, n)        # of a byte in its word
        blocks.ravel()[place + np.repeat(np.arange(len(some)) * 64, n)] = data[place + np.repeat(at[some], n)]
        blocks[np.arange(len(some)), n] = 0x80
        blocks[:, 56:58] = (8 * n).astype("<u2")[:, None].view(np.uint8)
        out[some] = _md5_start(blocks.view("<u4"))
    for i in np.flatnonzero(size >= 56):
        out[i] = int(md5(data[at[i]:at[i + 1]].tobytes()).hexdigest()[:8], 16)
    return out % dim


def utf8_column(arr: pa.Array) -> pa.Array:
    """Binary texts as strings; null is empty, what isn't UTF-8 is replaced."""
    arr = arr.fill_null(b"")
    try:
        return arr.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([t.decode("utf-8", "replace") for t in arr.to_pylist()], pa.string())


def word_counts(texts: pa.Array) -> np.ndarray:
    """Number of words of each binary text, at any white space of ``clean_text``: places
    where a word's byte follows white space, or for white space beyond ASCII a split."""
    texts = pa.concat_arrays([utf8_column(texts)])              # offsets from 0
    at = np.frombuffer(texts.buffers()[1], np.int32)[:len(texts) + 1]
    word = _IN_WORDS[np.frombuffer(texts.buffers()[2] or b"", np.uint8, int(at[-1]))]
    first = word.copy()
    first[1:] &= ~word[:-1]
    begin = at[:-1][np.diff(at) > 0]
    first[begin] = word[begin]
    n = np.diff(np.searchsorted(np.flatnonzero(first), at))
    for i in np.flatnonzero(pc.match_substring_regex(texts, _WIDE_WHITE).to_numpy(zero_copy_only=False)).tolist():
        n[i] = len(texts[i].as_py().split())
    return n


def bucket_counts(texts: pa.Array, dim: int) -> np.ndarray:
    """Binary texts -> (n, dim) float32 term-count matrix of their words' buckets.  Words
    are those of :func:`quarry.functions.text.white_space_words`; a word that occurs often
    in the texts is hashed once."""
    texts = utf8_column(texts)
    odd = pc.match_substring_regex(texts, _OTHER_WHITE)
    if pc.any(odd).as_py():
        texts = pc.replace_with_mask(texts, odd, pa.array([" ".join(t.split()) for t in texts.filter(odd).to_pylist()], pa.string()))
    split = pc.split_pattern(texts, " ")
    rows, words = split.value_parent_indices().to_numpy(), split.flatten().dictionary_encode()
    bucket = word_buckets(words.dictionary, dim)
    there = (pc.binary_length(words.dictionary).to_numpy() > 0)
    number = words.indices.to_numpy()
    cells = rows.astype(np.int64) * dim + bucket[number]
    flat = np.bincount(cells[there[number]], minlength=len(texts) * dim)
    return flat.reshape(-1, dim).astype(np.float32)


# ---------------------------------------------------------------- arrow / numpy

SLICE_BYTES = 4 << 20       # of the vectors of a batch that are worked on at a time


def slices(batches, vec_col: str, width: int = 0):
    """The batches cut so that a slice's vectors, or rows of ``width`` numbers, take
    about ``SLICE_BYTES`` as doubles, however many rows a batch has."""
    for rb in batches:
        if not rb.num_rows:
            continue
        col = rb.column(vec_col)
        dim = packed_dim(col) if is_packed(col.type) else len(col.flatten()) // rb.num_rows
        step = max(64, SLICE_BYTES // (8 * max(dim, width, 1)))
        for at in range(0, rb.num_rows, step):
            yield rb.slice(at, step)


def list_column_matrix(arr: pa.Array, dtype=np.float64) -> tuple[np.ndarray, np.ndarray]:
    """Arrow list<float> column, or one of packed vectors -> (dense row-major matrix, mask
    of non-null rows).  All non-null rows must have the same length; ``dtype=None`` keeps
    the column's."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    packed = is_packed(arr.type)
    dtype = dtype or (np.float32 if packed else arr.type.value_type.to_pandas_dtype())
    valid = np.asarray(arr.is_valid().to_numpy(zero_copy_only=False), dtype=bool)
    if not valid.all():
        arr = arr.filter(pa.array(valid))
    n = len(arr)
    if n == 0:
        return np.zeros((0, 0), dtype=dtype), valid
    if packed:
        return unpack_rows(arr, dtype), valid
    values = arr.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    dim = len(values) // n
    if dim * n != len(values):
        raise ValueError("vectors of different lengths in one column")
    return values.reshape(n, dim), valid


def matrix_to_list_array(m: np.ndarray, value_type=pa.float32()) -> pa.Array:
    n, dim = m.shape
    offsets = pa.array(np.arange(0, (n + 1) * dim, dim, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(m.reshape(-1).astype(
        value_type.to_pandas_dtype(), copy=False)))


# A packed vector is binary: its length (32 bits), a bit for each component that isn't
# zero, filled up to 32, and these components as floats.  It crosses between Spark and
# Python as one block of bytes instead of number by number, and a vector of few words is
# a fraction of its width; a dense one takes 1/32 more.

def is_packed(kind: pa.DataType) -> bool:
    return pa.types.is_binary(kind)


def _words(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit words of a packed column and where each row begins (and the last ends)."""
    _, at, data = arr.buffers()
    at = np.frombuffer(at, np.int32)[arr.offset:arr.offset + len(arr) + 1] // 4
    data = np.frombuffer(data, np.uint32, int(at[-1])) if data is not None else np.zeros(0, np.uint32)
    return data[at[0]:], at - at[0]


def packed_dim(arr: pa.Array) -> int:
    """Length of a packed column's vectors (0 if all are null)."""
    words, _ = _words(arr)
    return int(words[0]) if len(words) else 0


def pack_rows(m: np.ndarray) -> pa.Array:
    """Row-major matrix -> packed vectors, as floats."""
    m = np.ascontiguousarray(m, dtype=np.float32)
    n, dim = m.shape
    some = m.view(np.uint32) != 0           # a negative zero or NaN stays as it is
    head = 1 + -(-dim // 32)
    heads = np.zeros((n, 4 * head), np.uint8)
    heads[:, :4] = np.frombuffer(np.uint32(dim).tobytes(), np.uint8)
    heads[:, 4:4 + -(-dim // 8)] = np.packbits(some, axis=1)
    at = np.zeros(n + 1, np.int64)
    np.cumsum(head + np.count_nonzero(some, axis=1), out=at[1:])
    if at[-1] >= 1 << 29:
        raise ValueError("too many vectors to pack at a time")
    words, place = np.empty(at[-1], np.uint32), at[:-1, None] + np.arange(head)
    rest = np.ones(len(words), bool)
    rest[place] = False
    words[place] = heads.view(np.uint32)
    words[rest] = m.view(np.uint32).ravel()[np.flatnonzero(some)]
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((4 * at).astype(np.int32)), pa.py_buffer(words)])


def unpack_rows(arr: pa.Array, dtype=np.float32) -> np.ndarray:
    """Packed vectors (none null) -> row-major matrix."""
    words, at = _words(arr)
    dim = int(words[0])
    place = at[:-1, None] + np.arange(1 + -(-dim // 32))
    if (words[at[:-1]] != dim).any():
        raise ValueError("vectors of different lengths in one column")
    rest = np.ones(len(words[:at[-1]]), bool)
    rest[place] = False
    some = np.unpackbits(words[place[:, 1:]].view(np.uint8), axis=1, count=dim).view(bool)
    m = np.zeros(len(arr) * dim, dtype)
    m[np.flatnonzero(some)] = words[:at[-1]][rest].view(np.float32)
    return m.reshape(-1, dim)


def pack_vectors(df: DataFrame, col: str) -> DataFrame:
    """The rows with a vector, an array<float> column packed (other types stay)."""
    df = df.where(F.col(col).isNotNull())
    if df.schema[col].dataType.simpleString() != "array<float>":
        return df
    names = df.columns

    def pack(batches):
        for rb in slices(batches, col):
            m, _ = list_column_matrix(rb.column(col), np.float32)
            yield pa.RecordBatch.from_arrays([pack_rows(m) if c == col else rb.column(c) for c in names], names=names)

    return df.mapInArrow(pack, T.StructType([T.StructField(col, T.BinaryType()) if f.name == col else f
                                             for f in df.schema.fields]))


def row_norms(m: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", m, m))


def cosine_scores(q: np.ndarray, qn: np.ndarray, x: np.ndarray) -> np.ndarray:
    """dot / (|q| |x|) in float64, 0 where either norm is 0.  The division is
    done last, as ``dot / (|q| * |x|)``, so exact integer dots (term counts) give
    the same bits as the SQL form."""
    xn = row_norms(x)
    d = q @ x.T
    den = qn[:, None] * xn[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        s = np.where(den > 0, d / np.where(den > 0, den, 1.0), 0.0)
    return s


def sq_l2_distances(q: np.ndarray, qsq: np.ndarray, x: np.ndarray) -> np.ndarray:
    xsq = np.einsum("ij,ij->i", x, x)
    d = qsq[:, None] + xsq[None, :]
    dot = q @ x.T
    dot *= 2.0
    d -= dot
    return np.maximum(d, 0.0, out=d)


def single_error(dim: int) -> float:
    """Twice the greatest error of a single-precision product of two vectors of length
    one, their rounding included."""
    return (dim + 16) * 2.0 ** -23


class TopRows:
    """The ``k`` best rows of each query, kept while blocks of rows come by.

    A block is scored by a product of matrices in single precision.  Rows whose score,
    with the greatest error it can have, doesn't reach the query's k-th score so far are
    out; the others are scored in double precision, each pair for itself, so a score
    depends on the two vectors alone, and equal vectors tie wherever they are stored.
    The result is that of scoring every pair in double precision.  Held are at most a
    few times ``k`` rows for each query and a tile of scores, whatever the number of rows.

    ``metric``: "cosine", "product" (both: higher first) or "l2" (squared distance, lower
    first); ties go to the lower id, NaN comes last.  ``digits`` rounds the scores."""

    QUERIES, ROWS, PAIR_BYTES = 1024, 2048, 8 << 20

    def __init__(self, q: np.ndarray, k: int, metric: str, digits: int | None = None):
        self.q, self.k, self.metric, self.digits = q, k, metric, digits
        self.sq = np.einsum("ij,ij->i", q, q)
        self.norm = np.sqrt(self.sq)
        near = q
        if metric == "cosine":
            near = np.divide(q, self.norm[:, None], out=np.zeros_like(q), where=self.norm[:, None] > 0)
        self.reach = np.ones(len(q)) if metric == "cosine" else self.norm
        # beyond these lengths single precision might overflow
        self.wide = bool(len(q)) and not self.reach.max() < 1e15
        self.near = near if self.wide else near.astype(np.float32)
        self.error = single_error(q.shape[1])
        self.limit = np.full(len(q), -np.inf)       # of the k-th row so far, higher is better
        self.held, self.n, self.kept = [], 0, 0
        self.most = max(3 * k * len(q), 1 << 18)

    def add(self, x: np.ndarray, ids: np.ndarray, queries: np.ndarray | None = None) -> None:
        """A block of rows for all queries, or for those numbered ``queries``."""
        queries = np.arange(len(self.q)) if queries is None else queries
        if not len(queries):
            return
        step = max(64, min(self.ROWS, SLICE_BYTES // (8 * max(x.shape[1], 1))))
        for lo in range(0, len(x), step):
            rows = x[lo:lo + step].astype(np.float64)
            sq = np.einsum("ij,ij->i", rows, rows)
            near, top = rows, float(np.sqrt(sq.max()))
            if self.metric == "cosine":
                norm = np.sqrt(sq)[:, None]
                near, top = np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0), 1.0
            kind = np.float64 if self.wide or not top < 1e15 else np.float32
            near, own_sq = near.astype(kind, copy=False), sq.astype(kind)
            for at in range(0, len(queries), self.QUERIES):
                self._tile(queries[at:at + self.QUERIES], rows, sq, near, own_sq, top, ids[lo:lo + step])
            if self.n - self.kept > max(1 << 14, self.k * len(self.q) // 2):
                self._cut()

    def _tile(self, queries, rows, sq, near, own_sq, top, ids):
        s = self.near[queries].astype(near.dtype, copy=False) @ near.T
        reach = self.reach[queries]
        scale = reach * top
        if self.metric == "l2":     # the squared distance less the query's own square
            s *= 2
            s -= own_sq
            scale = (reach + top) ** 2
        slack = self.error * scale + 1e-12
        limit = self.limit[queries] - slack
        new = np.flatnonzero(np.isneginf(limit))
        if len(new) and len(rows) > self.k:
            at = len(rows) - self.k
            limit[new] = np.partition(s[new], at, axis=1)[:, at] - 2 * slack[new]
        hit = np.flatnonzero(~(s < limit.astype(s.dtype)[:, None]))     # NaN goes on
        if not len(hit):
            return
        q, row = np.divmod(hit, len(rows))
        q = queries[q]
        self.held.append((q, ids[row], self._exact(q, row, rows, sq)))
        self.n += len(hit)
        if self.n > self.most:
            self._cut()

    def _exact(self, q, row, rows, sq):
        dot = np.empty(len(q))
        step = max(1, self.PAIR_BYTES // (8 * max(rows.shape[1], 1)))
        for at in range(0, len(q), step):
            part = slice(at, at + step)
            dot[part] = np.einsum("ij,ij->i", self.q[q[part]], rows[row[part]])
        if self.metric == "cosine":
            # divided last, so that whole-number products give the bits of the SQL form
            den = self.norm[q] * np.sqrt(sq)[row]
            with np.errstate(divide="ignore", invalid="ignore"):
                s = np.where(den > 0, dot / np.where(den > 0, den, 1.0), 0.0)
        elif self.metric == "l2":
            s = np.maximum(self.sq[q] + sq[row] - 2.0 * dot, 0.0)
        else:
            s = dot
        return s if self.digits is None else np.round(s, self.digits)

    def _cut(self):
        q, ids, s = (np.concatenate(x) for x in zip(*self.held))
        order = np.lexsort((ids, s if self.metric == "l2" else -s, q))
        q = q[order]
        first = np.flatnonzero(np.diff(q, prepend=-1))
        place = np.arange(len(q)) - np.repeat(first, np.diff(first, append=len(q)))
        keep = place < self.k
        order, q, place = order[keep], q[keep], place[keep]
        s = s[order]
        last = place == self.k - 1
        self.limit[q[last]] = self.sq[q[last]] - s[last] if self.metric == "l2" else s[last]
        self.held, self.n, self.kept = [(q, ids[order], s)], len(q), len(q)

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(query numbers, ids, scores)`` by query, best first."""
        if not self.n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self._cut()
        return self.held[0]

    def batch(self, qids: pa.Array) -> pa.RecordBatch:
        """:meth:`result` as ``(qid, id, score)``."""
        q, ids, s = self.result()
        return pa.RecordBatch.from_arrays([qids.take(pa.array(q)), pa.array(ids), pa.array(s)],
                                          names=["qid", "id", "score"])


def group_sums(x: np.ndarray, labels: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per-label row sums and counts (sort + ``reduceat``; no scatter-add)."""
    sums = np.zeros((k, x.shape[1]), dtype=np.float64)
    cnt = np.bincount(labels, minlength=k)
    if len(x):
        order = np.argsort(labels, kind="stable")
        uniq, starts = np.unique(labels[order], return_index=True)
        sums[uniq] = np.add.reduceat(x[order], starts, axis=0)
    return sums, cnt
