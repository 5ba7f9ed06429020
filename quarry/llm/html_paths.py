"""Main-text extraction by tag-path ratios (operator 1).

A page is read into text blocks, each under its path of tags from the root (with
class names, so that differently styled parts differ).  For every path the text
length and the punctuation of all its blocks are summed and divided by their
number; the two ratios are fused with a prior for what the path's names say
(an article, a menu), carried to the blocks, smoothed along the page, averaged
for each path again and cut at a threshold.  The element that holds most of the
selected blocks is the content, widened to every element around it that adds a
real share of the selected text (a text in several parts or articles); what lies
between the parts and a heading beside them belong to it.  All of its blocks are
returned in page order but those in parts that are no content by name (menus,
notices, adverts, comments ...), unless such a part holds most of the page's weight
itself.

Each page is a matter of its own, so the work is one Arrow pass without a shuffle.
"""

from __future__ import annotations

import html as _html
import re
from statistics import pstdev

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import slices
from .common import table

THRESHOLD = 0.5             # of the standard deviation of the smoothed scores
SMOOTHING = (0.25, 0.5, 0.25)
REAL = 0.05                 # share of the selected text that widens the content
MOST = 0.6                  # a part with a doubtful name that holds so much is content

# HTML element names by what they do here.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe xmp noembed noframes".split())
BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol
optgroup option p pre search section select summary table tbody td tfoot th thead tr ul""".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
             "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
HOLDS = set("table ul ol dl select div article section body".split())   # what an implied end doesn't cross
NOT_CONTENT = set("nav footer aside form button select option input label dialog menu object svg math canvas "
                  "audio video map datalist output progress meter fieldset search head".split())
CONTENT = set("article main".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
# Words in class, id and role that name parts which are no content.
BAD_WORDS = set("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie
cookies consent gdpr notice notices alert popup modal overlay sidebar aside menu nav navbar navigation breadcrumb
breadcrumbs footer foot masthead topbar toolbar comment comments discussion disqus respond reply replies share sharing
social related recommended recommendations newsletter subscribe subscription signup login register search form widget
pagination pager copyright legal disclaimer contentinfo complementary skip hidden toc outbrain taboola""".split())
# Of these, words that also begin names of subjects: in a compound name ("share-prices",
# "related-work") they count only beside words of page furniture.
WEAK_WORDS = set("""ad ads banner social related share sharing search form legal register top head promo alert
complementary hidden foot""".split())
FURNITURE = set("""area articles bar block box btn button buttons container content group icons image info inner item
items links list module outer page panel post posts row section side site slot stories strip text title unit
wrap wrapper left right bottom main media""".split())
DOUBTFUL = set("header head top".split())       # no content unless they hold a heading of the content
GOOD_WORDS = set("article content main post entry story text body".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*+>|"
                  r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
# A tag whose quotes don't close: it ends at the next ">".
_LOOSE = re.compile(r"()<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_OPEN = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
MOST_DEPTH = 128            # elements nested deeper belong to the one at this depth
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORD = re.compile(r"[a-z0-9]+")
_PUNCT = re.compile(r"[.,;:!?…。，、؟]")


def name_words(value: str) -> set[str]:
    """Words of a class, id or role; weak ones of a compound name that also has words
    of a subject are left out."""
    words = set()
    for token in value.split():
        own = set(_WORD.findall(token))
        if any(w not in BAD_WORDS and w not in FURNITURE and not any(c.isdigit() for c in w) and len(w) > 2 for w in own):
            own -= WEAK_WORDS
        words |= own
    return words


def tags(page: str):
    """Matches of all tags and comments, in one pass.  What begins like a tag and has no
    end is text; after a tag whose quotes don't close, quotes mean nothing."""
    pos, last, strict = 0, page.rfind(">"), True
    while True:
        found = _OPEN.search(page, pos)
        if found is None or found.start() > last and not page.startswith("<!--", found.start()):
            return
        m = _TAG.match(page, found.start()) if strict or page[found.start() + 1] in "!?" else None
        if m is None:
            strict = False
            m = _LOOSE.match(page, found.start())
        if m is None:
            pos = found.end()
            continue
        after = yield m
        pos = m.end() if after is None else after


class Element:
    __slots__ = ("tag", "parent", "depth", "up", "kinds", "name", "bad", "good", "doubtful", "weight", "total", "heading")

    def __init__(self, tag, parent, name="", words=frozenset(), hidden=False):
        self.tag, self.parent, self.name = tag, parent, name
        self.depth = parent.depth + 1 if parent else 0
        self.up = None
        plain = tag not in ("html", "body")
        self.bad = plain and tag not in CONTENT and (hidden or tag in NOT_CONTENT or bool(BAD_WORDS & words)) or (
            tag == "article" and bool(BAD_WORDS & words))
        self.doubtful = plain and not self.bad and (tag == "header" or bool(DOUBTFUL & words))
        self.good = tag in CONTENT or "main" in words and plain or bool(GOOD_WORDS & words) and plain
        self.weight = self.total = 0.0
        self.heading = False
        # of the element or one around it: bad, content, good, doubtful
        own = (self.bad, tag in CONTENT, self.good, self.doubtful)
        self.kinds = tuple(x or y for x, y in zip(own, parent.kinds)) if parent else own

    def line(self) -> tuple[Element, ...]:
        """The element and those around it, from the inside out."""
        if self.up is None:
            self.up = (self, *(self.parent.line() if self.parent else ()))
        return self.up


def read_blocks(page: str) -> list[tuple[Element, str]]:
    """Text blocks of a page in order: (element that holds the text, text)."""
    root = Element("#root", None)
    at, blocks, text, holder = root, [], [], None

    def flush():
        nonlocal text, holder
        joined = " ".join("".join(text).split())
        if joined:
            blocks.append((holder, joined))
        text, holder = [], None

    def put(raw: str, decode=True):
        nonlocal holder
        if raw:
            text.append(_html.unescape(raw) if decode and "&" in raw else raw)
            if holder is None and not raw.isspace():
                e = at
                while e.tag not in BLOCK and e.parent is not None:
                    e = e.parent
                holder = e
                if e.tag in HEADINGS:
                    for x in e.line():
                        x.heading = True

    def close(tags: set, stop: set) -> None:
        nonlocal at
        e = at
        while e.parent is not None and e.tag not in stop:
            if e.tag in tags:
                at = e.parent
            e = e.parent

    pos, n, found, skip = 0, len(page), tags(page), None
    while pos < n:
        try:
            m = found.send(skip)
        except StopIteration:
            put(page[pos:])
            break
        put(page[pos:m.start()])
        pos, skip = m.end(), None
        if m[1]:
            put(m[1], False)
        if m[3] is None:
            continue
        tag = m[3].lower()
        if m[2]:                                # end tag
            if tag in BLOCK:
                flush()
            e = at
            while e.parent is not None and e.tag != tag:
                e = e.parent
            if e.parent is not None:
                at = e.parent
            continue
        if tag in RAW:                          # its content is no markup and no text
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, pos)
            pos = skip = end.end() if end else n
            continue
        if tag == "br":
            put(" ")
            continue
        if tag in BLOCK:
            flush()
        if tag in VOID:
            continue
        if tag in CLOSED_BY:
            close(CLOSED_BY[tag], HOLDS - CLOSED_BY[tag])
        elif tag in BLOCK:
            close({"p"}, HOLDS - {"p"})
        words, name, hidden = set(), tag, False
        for a in _ATTR.finditer(m[4] or ""):
            key, value = a[1].lower(), (a[2] or a[3] or a[4] or "").lower()
            if key in ("class", "id", "role"):
                words |= name_words(value)
                name += f".{value}" if key == "class" else ""
            elif key == "hidden" or key == "aria-hidden" and value == "true":
                hidden = True
            elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                hidden = True
        if not (m[4] or "").rstrip().endswith("/") or tag not in ("svg", "path"):
            at = Element(tag, at if at.depth < MOST_DEPTH else at.parent, name, words, hidden)
    flush()
    return blocks


def _content(x: Element) -> Element:
    """The article or main element around an element, or the element itself."""
    return next((y for y in x.line() if y.tag in CONTENT and not any(z.bad for z in y.line())), x)


def _heading(blocks: list, lines: list, first: int, best: Element) -> tuple[int, Element]:
    """Content that begins with a heading beside it: (its first block, the element
    that holds both).  Right under the body only a heading just before it counts."""
    if any(x.tag == "h1" for e, _ in blocks[first:first + 1] for x in e.line()):
        return first, best
    for around in (best, best.parent):
        if around is None:
            break
        outer = around.tag in ("#root", "html", "body")
        k, found = first - 1, None
        while k >= 0 and around in lines[k]:
            e = blocks[k][0]
            beside = e.parent is around or e.parent is not None and e.parent.parent is around and (
                e.parent.tag == "hgroup" or e.parent.tag == "header" and around.good)
            if e.tag in HEADINGS and beside and not any(x.bad for x in lines[k]):
                found = k
            elif found is not None or outer:
                break
            k -= 1
        if found is not None:
            return found, around
    return first, best


def main_blocks(page: str) -> list[str]:
    """The content blocks of a page, in order."""
    blocks = read_blocks(page)
    if not blocks:
        return []
    # numbers of paths from the root: (number of the path around, name) -> number
    numbers: dict[tuple[int, str], int] = {}
    paths, ratios, last = [], {}, {}
    for e, t in blocks:
        if e not in last:
            path = 0
            for x in reversed(e.line()):
                path = last[x] if x in last else numbers.setdefault((path, x.name), len(numbers) + 1)
                last[x] = path
        path = last[e]
        paths.append(path)
        r = ratios.setdefault(path, [0, 0, 0])
        r[0] += len(t)
        r[1] += len(_PUNCT.findall(t))
        r[2] += 1

    def prior(e: Element) -> float:
        bad, content, good, doubtful = e.kinds
        return 0.0 if bad else (4.0 if content else 2.0 if good else 1.0) * (0.25 if doubtful else 1.0)

    def scored(use_prior: bool):
        raw = []
        for (e, _), p in zip(blocks, paths):
            length, punct, n = ratios[p]
            raw.append(length / n * (1 + punct / n) * (prior(e) if use_prior else 1.0))
        smooth = [sum(w * raw[min(max(k + d, 0), len(raw) - 1)] for d, w in zip((-1, 0, 1), SMOOTHING))
                  if raw[k] else 0.0 for k in range(len(raw))]
        by_path: dict[int, list[float]] = {}
        for p, x in zip(paths, smooth):
            by_path.setdefault(p, []).append(x)
        return {p: sum(x) / len(x) for p, x in by_path.items()}, smooth

    by_path, smooth = scored(True)
    named = any(by_path.values())
    if not named:                               # only parts with bad names
        by_path, smooth = scored(False)
        if not any(e.kinds[2] for e, _ in blocks):
            return []
    cut = min(THRESHOLD * pstdev(smooth), max(by_path.values()))
    chosen = [k for k, p in enumerate(paths) if by_path[p] > 0 and by_path[p] >= cut]

    # the element that holds the selected blocks
    places: dict[int, Element] = {}
    for k in chosen:
        e, t = blocks[k]
        for x, share in zip((e.parent or e).line()[:2], (1.0, 0.5)):
            x.weight += share * len(t) * by_path[paths[k]]
            places[id(x)] = x
    best = max(places.values(), key=lambda x: x.weight)
    core = best = _content(best)

    # further parts: where the winner is an article, others count; else every selected block
    lines = [e.line() for e, _ in blocks]
    marked = any(x.tag in CONTENT for x in core.line())
    parts = [k for k in chosen if core not in lines[k] and (blocks[k][0].kinds[1] if marked else
             named or blocks[k][0].kinds[2])]
    length = sum(len(blocks[k][1]) for k in chosen if core in lines[k]) + sum(len(blocks[k][1]) for k in parts)
    around = {id(x): n for n, x in enumerate(core.line())}
    meets = {k: next(around[id(x)] for x in lines[k] if id(x) in around) for k in parts}
    more = [0] * len(around)
    for k in parts:
        more[meets[k]] += len(blocks[k][1])
    wide, have = 0, 0
    for n in range(1, len(more)):
        have += more[n]
        if have >= REAL * length:
            wide, have = n, 0
    holders = {id(core)}
    ends = []
    if wide:
        best = core.line()[wide]
        for k in parts:
            if meets[k] <= wide:
                holder = _content(blocks[k][0].parent or blocks[k][0])
                if id(holder) in around:
                    ends.append(k)
                else:
                    holders.add(id(holder))
    ends += [k for k, line in enumerate(lines) if any(id(x) in holders for x in line)]
    first, best = _heading(blocks, lines, min(ends), best)

    inside = [(*blocks[k], lines[k][:lines[k].index(best)]) for k in range(first, max(ends) + 1) if best in lines[k]]
    everything = sum(len(t) for _, t, _ in inside) or 1
    for _, t, line in inside:
        for x in line:
            x.total += len(t)

    def dropped(x: Element) -> bool:
        if x.tag in NOT_CONTENT:
            return x.bad
        return (x.bad and x.total < MOST * everything) or (x.doubtful and not x.heading and x.total < MOST * everything)

    return [t for _, t, line in inside if not any(dropped(x) for x in line)]


def extract_text(pages: DataFrame, id_cols: list[str], html_col: str = "html") -> DataFrame:
    """``id_cols``, ``text`` (blocks joined by a line break, empty if none) and
    ``n_chars`` (code points) for every page.  Null html: empty; repeated rows
    and null ids are kept; other columns are not read."""
    cols = pages.select(*[F.col(c) for c in id_cols], F.col(html_col).alias("_html"))

    def run(batches):
        for batch in batches:
            for rb in slices(batch, "_html"):
                out = ["\n".join(main_blocks(p)) if p else "" for p in rb.column("_html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*[rb.column(c) for c in range(len(id_cols))], pa.array(out, pa.string()),
                     pa.array([len(t) for t in out], pa.int64())], names=[*id_cols, "text", "n_chars"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cols.schema.fields[:-1])
    return cols.mapInArrow(run, schema + ", text string, n_chars bigint")


def op1_tag_path_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"), ["page_id", "url"])
