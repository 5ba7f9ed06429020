"""BPE encoding and decoding with reuse of content-defined chunks (operator 10).

A rolling hash over the bytes of a text cuts it into chunks whose borders depend
on the content near them only, so that passages shared by documents give the
same chunks.  A chunk is encoded once and kept in a bounded store of the Python
worker; later documents take its ids from there.  A border may fall inside a
word: then the word is put together from both sides and encoded again, over as
many chunks as it spans, which gives exactly the ids of the whole text because
the tokenizer never joins tokens across white space (checked from its
configuration; a tokenizer of another kind is given whole texts).

The reuse is per worker process, not global: a global chunk table would shuffle
all chunk texts and then all their ids, which costs more than it saves.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import worker_state

WINDOW = 16                 # bytes under the rolling hash
CHUNK_BITS = 9              # one border in 512 positions on average
MIN_CHUNK, MAX_CHUNK = 128, 8192
STORE_CHUNKS = 12_000       # chunks kept per generation of the store
STORE_WORDS = 300_000       # words kept per generation of the word cache
SLICE_BYTES = 4 << 20       # text bytes turned into Python objects at a time

# A full stop or comma between an ASCII letter and white space is a token run of its own.
_STOP = re.compile(rb"(?<=[a-z])([.,])(?=[ \n])")
_SPACE = re.compile(rb"[ \t\n\r\x0b\x0c]")
# Characters for which lower-casing and normalisation are the same everywhere
# and change no neighbour: printable ASCII and accented Latin letters.
_PLAIN = re.compile("[!-~À-įı-ſ]*")


class Recent(dict):
    """A dict that fills itself by ``make(key)`` and keeps between ``cap`` and
    ``2 * cap`` of the latest keys (two generations)."""

    def __init__(self, make, cap: int):
        super().__init__()
        self.make, self.cap, self.old = make, cap, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.cap:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE:
    printable Latin-1 characters stand for themselves, the others are numbered
    upwards from 256."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, n = {}, 0
    for b in range(256):
        if b in keep:
            table[b] = chr(b)
        else:
            table[b] = chr(256 + n)
            n += 1
    return [table[b] for b in range(256)]


class WordTokenizer:
    """A tokenizer together with what its configuration says about white space.

    ``spaced``: white space ends every token and gives none itself, so a text's
    ids are those of its words in turn."""

    def __init__(self, config: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(config)
        self.tok.no_truncation()
        self.tok.no_padding()
        c = json.loads(config)
        pre = c.get("pre_tokenizer") or {}
        steps = pre.get("pretokenizers") or [pre]
        norm = c.get("normalizer") or {}
        norms = [n.get("type") for n in norm.get("normalizers") or ([norm] if norm else [])]
        first = steps[0] if steps else {}
        pattern = (first.get("pattern") or {}).get("Regex", "")
        # every special token must hold "<|", which prepare() and word_ids() look for
        self.specials = [t["content"] for t in c.get("added_tokens", [])]
        self.spaced = (first.get("type") == "Split" and first.get("invert") is True
                       and first.get("behavior") == "Removed"
                       and r"[^\s\p{L}\p{N}]+" in pattern and r"[\p{L}]+" in pattern
                       and all("<|" in s for s in self.specials)
                       and norms in (["NFC", "Replace", "Lowercase"], [])
                       and not any(_SPACE.search(s.encode()) or t["lstrip"] or t["rstrip"]
                                   for s, t in zip(self.specials, c.get("added_tokens", []))))
        self.lower = "Lowercase" in norms
        self.pattern = regex.compile(pattern) if self.spaced else None
        self.letters = byte_alphabet() if [s.get("type") for s in steps[1:]] == ["ByteLevel"] else None
        self.joined_by_space = c.get("decoder") is None
        self.model = self.tok.model
        self.single = Recent(lambda c: [t.id for t in self.model.tokenize(c)], 4096)

    def prepare(self, raw: bytes) -> bytes:
        """The text with the same ids but fewer different words: ASCII letters in
        lower case, a space before single full stops and commas.  Not done where
        it could change ids: special tokens, and combining marks (which may
        combine with a small letter but not with its capital)."""
        if not self.spaced or not self.lower or b"<|" in raw or b"\xcc" in raw or b"\xcd" in raw:
            return raw
        return _STOP.sub(rb" \1", raw.lower())

    def ids(self, text: str) -> list[int]:
        """As the library gives them."""
        return self.tok.encode(text, add_special_tokens=False).ids

    def word_ids(self, word: bytes) -> list[int]:
        """Ids of one word (no white space in it).  Plain words go straight to
        the BPE model, split by the tokenizer's own pattern; others, and words
        that hold a special token, go through the whole tokenizer."""
        text = word.decode("utf-8", "replace")
        if self.letters is None or not _PLAIN.fullmatch(text) or "<|" in text:
            return self.ids(text)
        text = text.lower() if self.lower else text
        out = []
        parts = (text,) if text.isalpha() else self.pattern.findall(text)
        for part in parts:
            if not part.isascii():
                part = "".join(map(self.letters.__getitem__, part.encode()))
            if len(part) == 1:
                out += self.single[part]
            else:
                out += [t.id for t in self.model.tokenize(part)]
        return out


def read_config(path: str) -> str:
    """The tokenizer's file, read once on the driver; its content (a file of
    fixed size) goes to the tasks, so executors need no copy of it."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def worker_tokenizer(config: str) -> WordTokenizer:
    state = worker_state().setdefault("tokenizers", {})
    if config not in state:
        state[config] = WordTokenizer(config)
    return state[config]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES):
    """Cut a batch into runs of rows with about ``most`` bytes in ``column``."""
    col = batch.column(column)
    lengths = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, null as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


# ------------------------------------------------------------------ chunks

def _gear() -> np.ndarray:
    return np.random.Generator(np.random.PCG64(10)).integers(0, 1 << 32, 256, dtype=np.uint32)


def cut_points(raw: bytes, bits: int = CHUNK_BITS, least: int = MIN_CHUNK,
               most: int = MAX_CHUNK, gear: np.ndarray | None = None) -> list[int]:
    """Ends of the chunks of ``raw``.  A border follows each position where the
    top ``bits`` of the hash of the last 16 bytes are zero, at least ``least``
    and at most ``most`` bytes after the border before, never inside a character."""
    n = len(raw)
    if n <= least:
        return [n] if n else []
    gear = _gear() if gear is None else gear
    b = np.frombuffer(raw, np.uint8)
    h = gear[b]
    step = 1
    while step < WINDOW:        # h over 2 * step bytes from two h over step bytes
        nxt = h.copy()
        nxt[step:] += h[:-step] << np.uint32(step)
        h, step = nxt, 2 * step
    inner = (b & 0xC0) == 0x80  # not the first byte of a character
    marks = np.nonzero((h[:-1] >> np.uint32(32 - bits) == 0) & ~inner[1:])[0] + 1
    out, last = [], 0
    for m in [*marks.tolist(), n]:
        while m - last > most:
            end = last + most
            while inner[end]:
                end -= 1
            out.append(end)
            last = end
        if m - last >= least or m == n and m > last:
            out.append(m)
            last = m
    return out


class ChunkEncoder:
    """Encodes texts chunk by chunk.  For each word and chunk it keeps the number
    of tokens, the ids as decimal digits and the token strings, both joined by
    one space."""

    def __init__(self, tokenizer: WordTokenizer):
        self.t = tokenizer
        size = tokenizer.tok.get_vocab_size(with_added_tokens=True)
        self.names = [(tokenizer.tok.id_to_token(i) or "").encode() for i in range(size)]
        self.digits = [b"%d" % i for i in range(size)]
        self.gear = _gear()
        self.words = Recent(self._word, STORE_WORDS)
        self.chunks = Recent(self._chunk, STORE_CHUNKS)
        self.seen = self.encoded = 0

    def _pack(self, ids: list[int]):
        return (len(ids), b" ".join(map(self.digits.__getitem__, ids)),
                b" ".join(map(self.names.__getitem__, ids)))

    def _word(self, word: bytes):
        return self._pack(self.t.word_ids(word))

    def _join(self, words: list[bytes]):
        got = list(map(self.words.__getitem__, words))
        n, digits, names = zip(*got) if got else ((), (), ())
        if 0 in n:
            n, digits, names = zip(*[x for x in got if x[0]] or [(0, b"", b"")])
        return sum(n), b" ".join(digits), b" ".join(names)

    def _chunk(self, chunk: bytes):
        """(part of a word at the front, whole words, part of a word at the end);
        no white space at all: (None, the part, None)."""
        self.encoded += 1
        first = _SPACE.search(chunk)
        if first is None:
            return None, chunk, None
        head = chunk[:first.start()]
        tail = b"" if chunk[-1:].isspace() else chunk.rsplit(None, 1)[-1]
        inner = chunk[len(head):len(chunk) - len(tail)]
        return head, self._join(inner.split()), tail

    def encode(self, raw: bytes):
        """(number of tokens, decimal ids, token strings) of a whole text."""
        if not self.t.spaced:
            return self._pack(self.t.ids(raw.decode("utf-8", "replace")))
        raw = self.t.prepare(raw)
        parts, word, at = [], b"", 0
        for end in cut_points(raw, gear=self.gear):
            self.seen += 1
            head, body, tail = self.chunks[raw[at:end]]
            at = end
            if head is None:        # the word goes on beyond this chunk
                word += body
                continue
            word += head
            if word:                # repaired at the border
                parts.append(self.words[word])
            parts.append(body)
            word = tail
        if word:
            parts.append(self.words[word])
        parts = [p for p in parts if p[0]]
        return (sum(p[0] for p in parts), b" ".join([p[1] for p in parts]),
                b" ".join([p[2] for p in parts]))


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                  text_col: str = "text", digests: bool = True) -> DataFrame:
    """Encode and decode every text.

    ``digests=False``: ``(id, n_tokens, ids string, decoded string)`` with the
    decimal ids joined by a space; ``digests=True``: their SHA-256 in hex instead.
    Null and empty texts have no tokens.  One row per input row, in any order;
    repeated rows and null ids are kept; other columns are not read."""
    spark = docs.sparkSession
    config = spark.sparkContext.broadcast(read_config(tokenizer_path))

    def run(batches):
        state = worker_state()
        tok = worker_tokenizer(config.value)
        enc = state.setdefault("chunk_encoders", {}).setdefault(id(tok), ChunkEncoder(tok))
        for batch in batches:
            for rb in slices(batch, "t"):
                n, a, b = [], [], []
                for raw in raw_texts(rb.column("t")):
                    count, ids, names = enc.encode(raw)
                    if not tok.joined_by_space:
                        names = tok.tok.decode(list(map(int, ids.split())),
                                               skip_special_tokens=False).encode()
                    n.append(count)
                    a.append(hashlib.sha256(ids).hexdigest() if digests else ids.decode())
                    b.append(hashlib.sha256(names).hexdigest() if digests else names.decode())
                yield pa.RecordBatch.from_arrays(
                    [rb.column("i"), pa.array(n, pa.int64()), pa.array(a, pa.string()),
                     pa.array(b, pa.string())], names=["i", "n_tokens", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).mapInArrow(
        run, f"i {kind}, n_tokens bigint, ids string, decoded string")
    names = ("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded")
    return out.select(F.col("i").alias(id_col), "n_tokens", F.col("ids").alias(names[0]),
                      F.col("decoded").alias(names[1]))


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op10_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import table
    return encode_decode(table(spark, sf_dir, "documents"), default_tokenizer())
