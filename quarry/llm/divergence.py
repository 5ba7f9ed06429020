"""Quality rules by distribution divergence (operator 9), in SQL functions only.

Every document gives two histograms: its characters by class, and its words over
the function words of all known languages and one bin for other words.  The
references are the same histograms summed over all documents of a language.  A
document is rejected if the Jensen-Shannon distance to the nearest reference is
too large in either histogram, provided it is long enough for the histogram to
mean something.  Before that come base rules on length and repetition.

All of it is a projection over the documents; only the references (about 40
numbers for each language) go through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, materialize, table

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50              # base: fewer words fail
REPEAT_PERCENT = 50         # base: more repeated words fail
MIN_CLASS_CHARS = 200       # guards: shorter texts aren't judged by the histogram
MIN_HIST_WORDS = 80
MAX_CLASS_DISTANCE = 0.28
MAX_WORD_DISTANCE = 0.46

# The most frequent function words of each language.
FUNCTION_WORDS = {
    "en": ["the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "las", "se", "del", "un", "por"],
}
WORDS = sorted({w for ws in FUNCTION_WORDS.values() for w in ws})
FORMS = sorted({f for w in WORDS for f in (w, w.capitalize(), w.upper())})
FEW = 16                    # repeated windows of a text that are looked up one by one


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def _without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE + "+", -1), lambda w: w != "")


def class_histogram(text: Column, spaces: Column, symbols: Column) -> Column:
    """Characters by class: capital, small, digit, white space, symbol, other."""
    def classes(m: Column) -> Column:
        own = [F.char_length(m) - F.char_length(F.replace(m, F.lit(c), F.lit(""))) for c in "Aa0"]
        return F.array(*own, spaces, symbols, F.char_length(m) - own[0] - own[1] - own[2] - spaces - symbols)

    return let(F.mask(text, F.lit("A"), F.lit("a"), F.lit("0"), F.lit(".")), classes)


def word_histogram(words: Column) -> Column:
    """Counts of ``WORDS`` among the words (small, capitalised or capitals), then
    of all others.  The known words are joined with a space on either side of
    each, and each word's count follows from the length without it."""
    known = F.filter(words, lambda w: w.isin(*FORMS))
    joined = F.concat(F.lit(" "), F.lower(F.array_join(known, "  ")), F.lit(" "))
    return let(joined, lambda s: let(F.transform(F.array(*map(F.lit, WORDS)), lambda w: (
        (F.char_length(s) - F.char_length(F.replace(s, F.concat(F.lit(" "), w, F.lit(" ")), F.lit(""))))
        / (F.char_length(w) + 2)).cast("int")), lambda h: F.concat(
            h, F.array(F.size(words) - F.aggregate(h, F.lit(0), lambda a, b: a + b)))))


def window_hashes(words: Column) -> Column:
    """64-bit hashes of the windows of three words, in order."""
    n = F.size(words)
    return F.when(n < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))), lambda i: F.xxhash64(
            F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))


def neighbours(a: Column) -> Column:
    return F.arrays_zip(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))).alias("a"),
                        F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0))).alias("b"))


def repeated(ordered: Column) -> Column:
    """The hashes that occur twice or more among ordered ones."""
    return F.array_distinct(F.transform(
        F.filter(neighbours(ordered), lambda z: z["a"] == z["b"]), lambda z: z["a"]))


def covered_words(hashes: Column, twice: Column) -> Column:
    """Words that lie in a window whose hash is among ``twice``: each window
    covers three words less what the next one covers again.  A few repeated
    hashes are looked up one by one; many by sorting hashes with their places,
    so the work never grows with the square of a text."""
    at = F.sequence(F.lit(0), F.greatest(F.size(hashes) - 1, F.lit(0)))
    few = F.filter(at, lambda i: F.array_contains(twice, F.get(hashes, i)))

    def by_sorting(s: Column) -> Column:
        same = F.filter(neighbours(s), lambda z: z["a"]["h"] == z["b"]["h"])
        return F.sort_array(F.array_distinct(F.flatten(F.transform(
            same, lambda z: F.array(z["a"]["i"], z["b"]["i"])))))

    many = let(F.sort_array(F.transform(at, lambda i: F.struct(F.get(hashes, i).alias("h"), i.alias("i")))), by_sorting)

    def covered(p: Column) -> Column:
        return F.aggregate(neighbours(p), F.lit(3).cast("bigint"),
                           lambda a, z: a + F.least(z["b"] - z["a"], F.lit(3)))

    return F.when(F.size(twice) == 0, F.lit(0).cast("bigint")).otherwise(
        let(F.when(F.size(twice) <= FEW, few).otherwise(many), covered))


def js_distance(p: Column, q: list[float]) -> Column:
    """Jensen-Shannon distance (base 2) of counts ``p`` from fractions ``q``."""
    def terms(total: Column) -> Column:
        def one(c: Column, f: Column) -> Column:
            x = c / total
            m = (x + f) / 2
            return (F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
                    + F.when(f > 0, f * F.log2(f / m)).otherwise(0.0)) / 2
        return F.aggregate(F.zip_with(p, F.array(*map(F.lit, q)), one), F.lit(0.0), lambda a, b: a + b)

    total = F.aggregate(p, F.lit(0.0), lambda a, b: a + b)
    return let(total, lambda t: F.when(t > 0, F.sqrt(F.greatest(terms(t), F.lit(0.0)))).otherwise(1.0))


def measure(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct column of base counts and both histograms, and its
    name.  Null text: no words, no characters."""
    t, w, h, o, d, m = (free_name(docs, x) for x in ("_t", "_w", "_h", "_o", "_d", "_m"))
    c = F.col
    step = docs.withColumn(t, F.coalesce(c(f"`{text_col}`"), F.lit("")))
    step = step.withColumn(w, words_of(c(t)))
    lines = F.filter(F.split(c(t), "\n", -1), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    length = F.char_length(c(t))
    step = step.withColumn(m, F.struct(
        F.size(c(w)).cast("bigint").alias("n_words"),
        F.char_length(F.array_join(c(w), "")).cast("bigint").alias("word_chars"),
        (length - F.char_length(_without(c(t), SYMBOLS))).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        word_histogram(c(w)).alias("words"))).withColumn(h, window_hashes(c(w))).drop(w)
    step = step.withColumn(o, F.sort_array(c(h)))
    step = step.withColumn(d, repeated(c(o))).drop(o)
    spaces, symbols = length - c(m)["word_chars"], c(m)["n_symbols"]
    step = step.withColumn(m, F.struct(
        *[c(m)[x].alias(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "words")],
        covered_words(c(h), c(d)).alias("n_repeat_words"),
        class_histogram(c(t), spaces, symbols).alias("classes")))
    return step.drop(t, h, d), m


def references(hists: DataFrame, lang_col: str, classes: Column, words: Column) -> dict[str, tuple]:
    """``{language: (class fractions, word fractions)}`` over all documents that
    carry the language; languages outside ``FUNCTION_WORDS`` or without text
    have none."""
    sums = hists.where(F.col(lang_col).isin(*FUNCTION_WORDS)).groupBy(F.col(lang_col).alias("l")).agg(
        F.array(*[F.sum(classes[i]) for i in range(6)]).alias("c"),
        F.array(*[F.sum(words[i]) for i in range(len(WORDS) + 1)]).alias("w")).collect()
    out = {}
    for r in sums:
        if sum(r["c"]) and sum(r["w"]):
            out[r["l"]] = tuple([x / sum(h) for x in h] for h in (r["c"], r["w"]))
    return dict(sorted(out.items()))


def text_references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, tuple]:
    """References straight from the texts, without the base counts."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    step = docs.where(F.col(lang_col).isin(*FUNCTION_WORDS)).select(
        F.col(lang_col).alias("l"), t.alias("t"), words_of(t).alias("w"))
    length = F.char_length("t")
    hist = step.select("l", class_histogram(
        F.col("t"), length - F.char_length(F.array_join("w", "")),
        length - F.char_length(_without(F.col("t"), SYMBOLS))).alias("c"), word_histogram(F.col("w")).alias("w"))
    return references(hist, "l", F.col("c"), F.col("w"))


def verdict(m: Column, refs: dict[str, tuple]) -> tuple[Column, Column]:
    """(base_failed, kept) of a measured document."""
    def nearest(h: Column, k: int) -> Column:
        d = [js_distance(h, r[k]) for r in refs.values()]
        return F.least(*d) if len(d) > 1 else d[0] if d else F.lit(None).cast("double")

    failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > REPEAT_PERCENT * m["n_words"])
    far = (((m["word_chars"] >= MIN_CLASS_CHARS) & (nearest(m["classes"], 0) > MAX_CLASS_DISTANCE))
           | ((m["n_words"] >= MIN_HIST_WORDS) & (nearest(m["words"], 1) > MAX_WORD_DISTANCE)))
    return failed, ~failed & ~F.coalesce(far, F.lit(False))


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: its columns but the text, ``n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, kept``.  The texts are
    read once; the narrow counts are written and give references and verdicts.
    Null text: no words (base_failed); no known language anywhere: base rules only."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    counted, m = measure(docs, text_col)
    counted = materialize(counted.select(*rest, m), "quality")
    refs = references(counted, lang_col, F.col(m)["classes"], F.col(m)["words"])
    failed, kept = verdict(F.col(m), refs)
    return counted.select(*rest, *[F.col(m)[c].alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        failed.alias("base_failed"), kept.alias("kept"))


def op9_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).drop("lang")


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents that are kept, with their columns, in one more pass over the
    texts instead of a shuffle of them."""
    refs = text_references(docs, text_col, lang_col)
    counted, m = measure(docs, text_col)
    # The filter names the partition only to stay above the measuring projection:
    # pushed below it, every use of a count would measure the text again.
    p = free_name(counted, "_p")
    counted = counted.withColumn(p, F.spark_partition_id())
    return counted.where(verdict(F.col(m), refs)[1] & (F.col(p) >= 0)).drop(m, p)


def _oracle() -> str:
    """The same rules in DuckDB SQL."""
    def quoted(values) -> str:
        return ", ".join(f"'{v}'" for v in values)

    space = r"[\x20\x09-\x0D]"

    def letters(kind: str) -> str:
        return rf"length(regexp_replace(t, '[^\p{{{kind}}}]', '', 'g'))"

    def distance(table: str, out: str) -> str:
        x, m = "(h.n / h.total)", "((h.n / h.total + r.f) / 2)"
        return f"""
{out}_all AS (SELECT doc_id, k, n, sum(n) OVER (PARTITION BY doc_id) AS total FROM {table}),
{out}_ref AS (SELECT lang, k, sum(n) / sum(sum(n)) OVER (PARTITION BY lang) AS f FROM {table} JOIN m USING (doc_id)
  WHERE lang IN ({quoted(FUNCTION_WORDS)}) GROUP BY lang, k),
{out}_one AS (SELECT h.doc_id, r.lang, sqrt(greatest(sum(
    (CASE WHEN h.n > 0 THEN {x} * log2({x} / {m}) ELSE 0 END + CASE WHEN r.f > 0 THEN r.f * log2(r.f / {m}) ELSE 0 END) / 2), 0)) AS d
  FROM {out}_all h JOIN {out}_ref r ON r.k = h.k WHERE h.total > 0 GROUP BY h.doc_id, r.lang),
{out} AS (SELECT doc_id, min(d) AS d FROM {out}_one GROUP BY doc_id)"""

    return rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '{space}+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
tri AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS c FROM win),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM tri WHERE c > 1) GROUP BY doc_id),
m AS (SELECT w.doc_id, lang, t, ws, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             length(regexp_replace(t, '[^{SYMBOLS}]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
             coalesce(cov.n, 0) AS n_repeat_words FROM w LEFT JOIN cov ON cov.doc_id = w.doc_id),
c0 AS (SELECT doc_id, {letters("Lu")} AS a, {letters("Ll")} AS b, {letters("Nd")} AS c, length(t) - word_chars AS s, n_symbols AS y, length(t) AS n FROM m),
ch AS (SELECT doc_id, unnest([1, 2, 3, 4, 5, 6]) AS k, unnest([a, b, c, s, y, n - a - b - c - s - y]) AS n FROM c0),
kw AS (SELECT doc_id, lower(x) AS k, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS x FROM m) WHERE x IN ({quoted(FORMS)}) GROUP BY ALL),
wh AS (SELECT m.doc_id, v.k, coalesce(kw.n, 0) AS n FROM m CROSS JOIN (SELECT unnest([{quoted(WORDS)}]) AS k) v
         LEFT JOIN kw ON kw.doc_id = m.doc_id AND kw.k = v.k
       UNION ALL SELECT m.doc_id, '', n_words - coalesce(kn.n, 0) FROM m LEFT JOIN
         (SELECT doc_id, sum(n) AS n FROM kw GROUP BY doc_id) kn ON kn.doc_id = m.doc_id),
{distance("ch", "cd").lstrip()},
{distance("wh", "wd").lstrip()},
v AS (SELECT m.*, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed,
             (word_chars >= {MIN_CLASS_CHARS} AND coalesce(cd.d > {MAX_CLASS_DISTANCE}, false))
             OR (n_words >= {MIN_HIST_WORDS} AND coalesce(wd.d > {MAX_WORD_DISTANCE}, false)) AS far
      FROM m LEFT JOIN cd ON cd.doc_id = m.doc_id LEFT JOIN wd ON wd.doc_id = m.doc_id)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND NOT far AS kept FROM v"""


ORACLE_OP9 = _oracle()
