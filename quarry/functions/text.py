"""Column expressions for text: whitespace normalisation, word chunking, chunk
references, file-name suffixes.  All are built-in Spark SQL functions, so they
stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points Python's ``str.split()`` treats as whitespace,
# written as one regex class that Java regex and RE2 (DuckDB) both accept.
# \s covers tab, LF, VT, FF, CR and space in Java; \x{0b} is listed again because
# RE2's \s lacks it.
WHITESPACE_CLASS = (r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
                    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
WHITESPACE_RUN = WHITESPACE_CLASS + "+"
NON_WHITESPACE = "[^" + WHITESPACE_CLASS[1:]
# The same 29 code points as characters, in code-point order
# (tab, LF, VT, FF, CR, FS, GS, RS, US, space, NEL, NBSP, OGHAM SPACE MARK,
# EN QUAD .. HAIR SPACE, LINE SEPARATOR, PARAGRAPH SEPARATOR, NARROW NBSP,
# MEDIUM MATHEMATICAL SPACE, IDEOGRAPHIC SPACE).
WHITESPACE_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                    + "".join(chr(c) for c in range(0x2000, 0x200B))
                    + "\u2028\u2029\u202f\u205f\u3000")

# Default chunk size and overlap, in words.
DEFAULT_CHUNK_WORDS = 400
DEFAULT_CHUNK_OVERLAP = 50

# Token pattern for the hashing embedder and lexical scorer: runs of letters or
# digits, after lower-casing.
NON_TOKEN_RUN = r"[^\p{L}\p{N}]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(text) -> Column:
    """Whitespace runs (Python's definition) to one space, trimmed.

    Every whitespace code point is first mapped to a space with ``translate``
    (a per-character table lookup); the collapse is then the trivial pattern
    ``' {2,}'``.  Same result as replacing ``WHITESPACE_RUN``, at about half the
    CPU cost of matching the Unicode class."""
    spaced = F.translate(_col(text), WHITESPACE_CHARS, " " * len(WHITESPACE_CHARS))
    # runs of two and more: a single space stays as it is
    return F.trim(F.regexp_replace(spaced, " {2,}", " "))


def has_words(text) -> Column:
    """True when cleaning leaves something: the text holds a non-whitespace
    character.  A find-first match, far cheaper than cleaning, so it can run
    wherever Catalyst pushes the filter."""
    return _col(text).rlike(NON_WHITESPACE)


def chunk_step(chunk_words: int, overlap: int) -> int:
    if chunk_words < 1:
        raise ValueError("chunk_words must be >= 1")
    return max(1, chunk_words - overlap)


def chunk_count(n_words, chunk_words: int = DEFAULT_CHUNK_WORDS,
                overlap: int = DEFAULT_CHUNK_OVERLAP) -> Column:
    """Number of chunks for a text of ``n_words`` words (0 for 0 words).

    Windows start at 0, step, 2*step, ... and stop after the first window that
    reaches the end, so the count is
    min(ceil(n/step), ceil(max(n-cw, 0)/step) + 1)."""
    step = chunk_step(chunk_words, overlap)
    n = _col(n_words).cast("bigint")
    ceil_n = F.floor((n + F.lit(step - 1)) / F.lit(step)).cast("bigint")
    rest = F.greatest(n - F.lit(chunk_words), F.lit(0))
    ceil_rest = F.floor((rest + F.lit(step - 1)) / F.lit(step)).cast("bigint")
    return F.when(n <= 0, F.lit(0).cast("bigint")).otherwise(
        F.least(ceil_n, ceil_rest + F.lit(1)))


def chunk_texts(clean, chunk_words: int = DEFAULT_CHUNK_WORDS,
                overlap: int = DEFAULT_CHUNK_OVERLAP) -> Column:
    """array<string> of overlapping word windows of an already cleaned text
    (single spaces, trimmed, non-empty)."""
    step = chunk_step(chunk_words, overlap)

    def windows(words):
        last = chunk_count(F.size(words), chunk_words, overlap) - F.lit(1)
        return F.transform(
            F.sequence(F.lit(0).cast("bigint"), last),
            lambda i: F.array_join(F.slice(words, (i * step + 1).cast("int"),
                                           F.lit(chunk_words)), " "))

    # the words are bound to a lambda's variable: inside ``transform`` the expression
    # itself would split the whole text again for every window
    return F.transform(F.array(F.split(_col(clean), " ")), windows)[0]


def word_windows(words: list[str], chunk_words: int, overlap: int) -> Iterator[str]:
    """:func:`chunk_texts` of one text's words, inside a task."""
    step = chunk_step(chunk_words, overlap)
    for at in range(0, len(words), step):
        yield " ".join(words[at:at + chunk_words])
        if at + chunk_words >= len(words):
            return


def chunk_ref(source_name, chunk_idx) -> Column:
    """``<source>::chunk<idx>``."""
    return F.concat(_col(source_name).cast("string"), F.lit("::chunk"),
                    _col(chunk_idx).cast("string"))


def source_from_ref(ref) -> Column:
    """Text before the first ``::`` (a name that itself holds ``::`` is cut)."""
    return F.substring_index(_col(ref), "::", 1)


def file_name(path) -> Column:
    return F.element_at(F.split(_col(path), "/"), -1)


def file_suffix(name) -> Column:
    """Lower-cased suffix including the dot; '' when there is none and for
    dot-files such as ``.hidden``."""
    return F.lower(F.regexp_extract(_col(name), r"^.+(\.[^./]+)$", 1))


def file_stem(name) -> Column:
    """Name without its last suffix (the name itself when there is no suffix)."""
    return F.when(file_suffix(name) == "", _col(name)).otherwise(
        F.regexp_extract(_col(name), r"^(.+)\.[^./]+$", 1))


def white_space_words(text) -> Column:
    """Words between white space as they stand, as array<string>."""
    return F.filter(F.split(clean_text(text), " "), lambda t: t != "")


def tokens(text) -> Column:
    """Lower-cased letter/digit runs, as array<string>, empties removed."""
    spaced = F.trim(F.regexp_replace(F.lower(_col(text)), NON_TOKEN_RUN, " "))
    return F.filter(F.split(spaced, " "), lambda t: t != "")
