"""URL filtering: rules first, then host word segmentation with naive Bayes
(operator 6).

Host labels and path parts are split at everything that is no letter, and each
run of letters by a unigram Viterbi: the split with the largest probability,
where a run outside the lexicon costs by its length.  The words of host and path
are scored by multinomial naive Bayes with additive smoothing, trained here on the
labelled names below (both lists are parameters; none is a host of the given
pages).  A name without labelled words scores as the prior says: allowed.  The
unigrams are half those of the names and half those of the words seen in the
documents, not in the urls of the table: a run-together name that is frequent there
would count as a word of its own and never be split.

The whole counted lexicon takes part, of any size: it isn't shipped to the tasks but
joined to the parts of the different runs of letters in the urls, and each run is
split by the words that it holds.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table

# (verdict, host, path): the rule holds for the host and its subdomains where the
# url's path starts with its path; the longest rule wins.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

# Labelled names to train on.
BLOCK_NAMES = """online-casino casino-slots casino-bonus casino-royal poker-room poker-bonus bet-now sports-betting betting-tips best-bets free-bet lottery-win jackpot-slots gambling-bonus roulette-win
buy-pills viagra-pills cheap-viagra cialis-online pharma-pills diet-pills weight-loss-pills
adult-video adult-dating adult-cams x-adult free-porn porn-tube porn-videos sex-cams sex-chat xxx-video
xxx-tube hot-escorts escort-girls nude-cams webcam-sex spam-links link-farm link-spam spam-bot click-farm
ad-track ads-tracker ad-server ads-server adserver-track click-track track-click popup-ads popunder-ads
ads-click payday-loans fast-loans cheap-loans quick-cash easy-money get-rich free-money crypto-doubler
replica-watches cheap-replica fake-watches warez-crack crack-keygen free-warez torrent-crack malware-download
phishing-login hack-tool free-prizes win-prizes claim-prize free-iphone""".split()
ALLOW_NAMES = """daily-news world-news local-news news-blog my-blog tech-blog travel-blog food-blog photo-blog blog-post
music-video free-library city-library public-library open-library online-library university-press online-university
history-museum art-museum science-lab data-science open-science science-today health-news health-care school-books
book-club book-store online-store home-garden garden-tips home-page farm-life farm-house organic-farm game-review
card-games free-software open-source source-code code-review software-download download-page data-track track-record
race-track sports-news football-club sports-club weather-today city-guide travel-guide user-guide help-center
support-center contact-page about-us shop-online web-design web-mail chat-room video-lessons learn-online cooking-tips
best-recipes easy-recipes quick-recipes money-matters bank-service hot-water fast-food link-page member-login
article-archive story-index forum-topic wiki-page""".split()
PRIOR_BLOCK = 0.2
SMOOTHING = 0.1
UNKNOWN_RUN, UNKNOWN_LETTER = -15.0, -1.4       # log probability of a run outside the lexicon
SHORT_PART, WHOLE_PART = 4, 8   # letters of parts that are common, and that are joined whole
SALTS = 16                      # parts of a hot key in a join
PART_ROWS = 100_000             # parts of runs held at a time
MICRO = 1e-9                    # unit of the summed log odds: whole numbers add up alike in any order

_LETTERS = re.compile(r"[^\W\d_]+")


class NameModel:
    """Unigram segmentation and naive Bayes over words, from labelled names."""

    def __init__(self, block: list[str], allow: list[str], prior: float = PRIOR_BLOCK,
                 seen: dict[str, int] | None = None):
        self.count = [Counter(w for n in names for w in n.split("-")) for names in (allow, block)]
        both = self.count[0] + self.count[1]
        total = sum(both.values())
        share = {w: c / total for w, c in both.items()}
        if seen:
            text = sum(seen.values())
            share = {w: share.get(w, 0) / 2 + seen.get(w, 0) / text / 2 for w in {**seen, **share}}
        self.named = {w: c / total for w, c in both.items()}
        self.unigram = {w: math.log(x) for w, x in share.items()}
        size = len(both)
        self.odds = {w: math.log((self.count[1][w] + SMOOTHING) / (sum(self.count[1].values()) + SMOOTHING * size))
                     - math.log((self.count[0][w] + SMOOTHING) / (sum(self.count[0].values()) + SMOOTHING * size)) for w in both}
        self.prior = math.log(prior / (1 - prior))

    def unigrams(self, counts: dict[str, int], text: int) -> dict[str, float]:
        """Log probabilities of words counted ``counts`` times in a text of ``text``."""
        if not text:
            return {w: self.unigram[w] for w in counts if w in self.unigram}
        share = {w: self.named.get(w, 0) / 2 + c / text / 2 for w, c in counts.items()}
        return {w: math.log(x) for w, x in share.items() if x}

    def segment(self, run: str, unigram: dict[str, float] | None = None) -> list[str]:
        """Viterbi over the ends of words; parts outside the lexicon (``unigram``;
        default: all of it) are one run each."""
        unigram = self.unigram if unigram is None else unigram
        n = len(run)
        lengths = sorted({len(w) for w in unigram if 1 < len(w) <= n}, reverse=True)
        # best split up to each end, and the best that ends in a run outside the lexicon:
        # (log probability, start of the last part)
        best, other = [(0.0, 0)], (-math.inf, 0)
        for end in range(1, n + 1):
            other = max((other[0], other[1]), (best[-1][0] + UNKNOWN_RUN, end - 1), key=lambda x: x[0])
            other = (other[0] + UNKNOWN_LETTER, other[1])
            top = other
            for k in lengths:
                if k <= end:
                    known = unigram.get(run[end - k:end])
                    if known is not None and best[end - k][0] + known > top[0]:
                        top = (best[end - k][0] + known, end - k)
            best.append(top)
        out, end = [], n
        while end:
            out.append(run[best[end][1]:end])
            end = best[end][1]
        return out[::-1]

    def words(self, text: str) -> list[str]:
        return [w for run in _LETTERS.findall(text.lower()) for w in self.segment(run)]

    def score(self, host: str, path: str) -> float:
        """Log odds of block; words outside the lexicon say nothing."""
        return self.prior + sum(self.odds.get(w, 0.0) for w in self.words(host) + self.words(path))


def host_and_path(url):
    """Columns (host, path) of a url column; empty without ``://``."""
    rest = F.when(F.instr(url, F.lit("://")) > 0, F.substr(url, F.instr(url, F.lit("://")) + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    # ASCII capitals only
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_of(host, path, rules=RULES):
    """Columns (rule, its verdict) of the longest rule that fits; null if none."""
    rule = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def seen_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(word, n)``: runs of 2 and more letters in lower case over all rows with
    their number."""
    word = F.explode(F.split(F.lower(F.col(text_col)), r"[^\p{L}]+")).alias("word")
    return docs.select(word).where(F.length("word") > 1).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def runs_of(host: Column, path: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.concat_ws(" ", host, path)), F.lit(r"\p{L}+"), F.lit(0))


def _part_lengths(longest: int) -> list[int]:
    """Lengths of the parts that are joined: all up to ``WHOLE_PART``, then doubled."""
    out = list(range(2, WHOLE_PART + 1))
    while 2 * out[-1] <= longest:
        out.append(2 * out[-1])
    return out


def run_lexicons(runs: DataFrame, words: DataFrame, letters: tuple[str, ...] = ()) -> DataFrame:
    """``run`` (different ones) and ``words`` (word, n) -> ``(run, lexicon array<word,
    n>)`` for runs that may hold a word of the names (``words.named``, or one of the
    ``letters``).

    A word is joined by its first letters: all of them up to ``WHOLE_PART``, else the
    largest power of two of them.  A run gives the hashes of all its parts of those
    lengths, so its rows grow with its length and not with the square; a word that
    agrees in its first letters only, or in a hash, is never met in the run by the
    look-up of whole words.  Short parts are in many runs, so their rows are salted."""
    n = F.length("word")
    longest = words.agg(F.max(n)).first()[0] or 0
    lengths = _part_lengths(longest)
    head = F.lit(lengths[0])
    for k in lengths[1:]:
        head = F.when(n >= k, F.lit(k)).otherwise(head)
    salts = F.when(n <= SHORT_PART, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    heads = words.withColumn("_salt", F.explode(salts)).select(
        "word", "n", "named", F.xxhash64(F.concat(F.substr("word", F.lit(1), head), F.col("_salt").cast("string"))).alias("_h"))

    def parts(batches):
        for rb in batches:
            held = []
            for key, salt, run in zip(*[rb.column(c).to_pylist() for c in ("_run", "_salt", "run")]):
                # hashed as Spark's xxhash64 does
                hashes = {xxhash.xxh64_intdigest(f"{run[at:at + k]}{salt if k <= SHORT_PART else 0}", 42)
                          for k in lengths for at in range(len(run) - k + 1)}
                held += [(key, h) for h in hashes]
                if len(held) > PART_ROWS:
                    yield batch(held)
                    held = []
            if held:
                yield batch(held)

    def batch(held):
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in held], pa.binary()), pa.array(
            np.array([h for _, h in held], np.uint64).view(np.int64))], names=["_run", "_h"])

    keyed = runs.select("run", F.unhex(F.md5("run")).alias("_run"))
    pieces = keyed.withColumn("_salt", F.pmod(F.xxhash64("_run"), F.lit(SALTS)).cast("int")).mapInArrow(
        parts, "_run binary, _h bigint")
    found = (pieces.join(heads, "_h").groupBy("_run")
             .agg(F.collect_set(F.struct("word", "n")).alias("lexicon"), F.max("named").alias("_named")))
    single = F.lit(False)
    for letter in letters:
        single = single | F.col("run").contains(letter)
    return keyed.join(found, "_run", "left").where(F.coalesce("_named", F.lit(False)) | single).select("run", "lexicon")


def run_odds(model: NameModel, lexicons: DataFrame, text: int) -> DataFrame:
    """``(run, odds)``: the summed log odds of the words of each run, in units of
    ``MICRO``, where they aren't zero; ``text``: all words of the documents."""
    def score(batches):
        for rb in batches:
            out = []
            for run, lexicon in zip(rb.column("run").to_pylist(), rb.column("lexicon").to_pylist()):
                counts = Counter()
                for x in lexicon or []:
                    counts[x["word"]] += x["n"]
                out.append(sum(round(model.odds.get(w, 0.0) / MICRO) for w in model.segment(run, model.unigrams(counts, text))))
            yield pa.RecordBatch.from_arrays([rb.column("run"), pa.array(out, pa.int64())], names=["run", "odds"])

    return lexicons.select("run", "lexicon").mapInArrow(score, "run string, odds bigint").where("odds <> 0")


def judge_urls(pages: DataFrame, id_cols: list[str], url_col: str = "url", rules=RULES,
               block_names: list[str] = BLOCK_NAMES, allow_names: list[str] = ALLOW_NAMES,
               words: DataFrame | None = None) -> DataFrame:
    """``id_cols, host, path, rule, verdict`` for every row.  Null urls and urls
    without ``://`` have an empty host and path, fit no rule and are allowed; a
    url's verdict is a function of the url alone, so repeated rows agree.  ``words``
    (word, n), as from ``seen_words``, adds to the unigrams; it may be of any size."""
    spark = pages.sparkSession
    model = NameModel(block_names, allow_names)
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(*[F.col(c).alias(f"_id{k}") for k, c in enumerate(id_cols)], host.alias("_host"), path.alias("_path"))
    rule, verdict = rule_of(F.col("_host"), F.col("_path"), rules)
    rows = rows.withColumns({"_rule": rule, "_verdict": verdict})
    urls = rows.where("_verdict IS NULL").select("_host", "_path").distinct()

    named = spark.createDataFrame([(w, 0, True) for w in sorted(model.named) if len(w) > 1], "word string, n bigint, named boolean")
    text = 0
    if words is not None:
        words = materialize(words.select("word", F.col("n").cast("bigint").alias("n")), "seen-words")
        text = words.agg(F.sum("n")).first()[0] or 0
        named = words.withColumn("named", F.lit(False)).unionByName(named)
    runs = materialize(rows.where("_verdict IS NULL").select(F.explode(runs_of(F.col("_host"), F.col("_path"))).alias("run"))
                       .distinct(), "url-runs")
    letters = tuple(sorted(w for w in model.named if len(w) == 1))
    odds = materialize(run_odds(model, run_lexicons(runs, named, letters), text), "run-odds")

    # a run or a url may be in a third of all rows: their few scores are dealt to
    # every salt, the rows to one each
    salted = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    used = urls.select("_host", "_path", F.explode(runs_of(F.col("_host"), F.col("_path"))).alias("run")).withColumn(
        "_salt", F.pmod(F.xxhash64("_host", "_path"), F.lit(SALTS)).cast("int"))
    default = model.prior > 0
    block = F.sum("odds") + F.lit(round(model.prior / MICRO)) > 0
    judged = (used.join(odds.withColumn("_salt", salted), ["run", "_salt"]).groupBy("_host", "_path")
              .agg(block.alias("_block")).where(F.col("_block") != default).withColumn("_salt", salted))
    rows = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    out = rows.join(judged, ["_host", "_path", "_salt"], "left")
    named_verdict = F.when(F.coalesce("_block", F.lit(default)), "block").otherwise("allow")
    return out.select(*[F.col(f"_id{k}").alias(c) for k, c in enumerate(id_cols)], F.col("_host").alias("host"),
                      F.col("_path").alias("path"), F.col("_rule").alias("rule"),
                      F.coalesce("_verdict", named_verdict).alias("verdict"))


def op6_host_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = seen_words(table(spark, sf_dir, "documents"))
    return judge_urls(table(spark, sf_dir, "pages"), ["page_id"], words=words)
