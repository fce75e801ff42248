"""HTML extraction by a maximum-scoring subsequence.

A page becomes a sequence of words and tags.  Every word scores the log odds, learned
from labelled pages, that words in its place belong to the article, every tag a
learned negative score; the best contiguous run (one linear scan) is the content
region, and its blocks in places of positive score are the text.

A word's *place* is its nearest container other than the article itself (a
navigation list, a footer, a division with its classes) and its block element.
Labelled pages are those that mark their article up (``article`` or ``main``): words
inside it are content.  Places never seen get +1 per word.  A boilerplate container (by
its element or its class names) costs one negative score and is left out of the text.  Names
count as whole classes (``sidebar``, ``site-footer``, ``share-links``, but neither ``no-sidebar`` nor
``share-enabled``), never on the page itself (``html``, ``body``, ``main``, ``article``), and not on
an element that holds most of the page's words and its heading or article.

``fit`` reads at most about ``MAX_PAGES`` pages, drawn by a hash of the id.  Extraction reads
whole pages, one at a time, without a shuffle.

Defined cases: null or empty html gives an empty text; a truncated tag at the end is
dropped, a truncated character reference is text; unclosed elements end with their
parent; repeated rows get equal texts; without labelled pages all places count as
never seen; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyho.llm.common import batches

MAX_PAGES = 5_000
TAG_SCORE = -0.1           # of tags never seen, and the least negative score of any tag
BOILERPLATE_SCORE = -1.0   # of a whole boilerplate container

# Element names of HTML and words by which sites name boilerplate.
BLOCKS = frozenset(("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption "
                    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p "
                    "pre section summary table tbody td tfoot th thead title tr ul").split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCKS - {"body", "html", "head", "title", "td", "th", "tr", "tbody", "thead", "tfoot"}
CONTAINERS = frozenset(("aside button dialog div fieldset footer form head header iframe menu nav noscript section "
                        "select table template ul ol").split())
BOILERPLATE = frozenset(("aside button dialog fieldset footer form head header iframe menu nav noscript select "
                         "template").split())
ARTICLE = frozenset(("article", "main"))
HINTS = frozenset(("ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs byline comment comments "
                   "consent cookie cookies copyright discussion disqus footer header masthead menu modal nav navbar "
                   "navigation newsletter notice notices pagination pager popup promo promoted promotion related "
                   "replies reply respond share sharing sidebar social sponsor sponsored subscribe toolbar widget").split())

#: Parts of a class name that say what a page has, not what the element is (fixed values).
STATES = frozenset("no not non has have with without is hide hidden show enabled disabled on off open closed active layout page".split())
PAGE = frozenset("html body main article".split())
HEADINGS = frozenset("h1 main article".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|svg|math|noscript|template|iframe)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>"
    r"|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^>]*\Z", re.S | re.I)
_NAMES = re.compile(r"\b(class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")


def is_hint(name: str) -> bool:
    """Whether a class (lower case) names boilerplate: it is such a word, or begins or ends with
    one and no part of it is a state."""
    parts = _WORD.findall(name)
    return bool(parts) and STATES.isdisjoint(parts) and (parts[0] in HINTS or parts[-1] in HINTS)


def place_of(tag: str, attributes: str) -> tuple[str, bool]:
    """Name of a container (with its classes), and whether its names are those of boilerplate."""
    words, hinted = set(), False
    for kind, *values in _NAMES.findall(attributes):
        value = "".join(values).lower()
        words.update(_WORD.findall(value))
        whole = [value.strip()] if kind.lower() == "aria-label" else value.split()
        hinted = hinted or any(is_hint(x) for x in whole if " " not in x)
    return ".".join((tag, *sorted(words))), hinted and tag not in PAGE


def segments(html: str) -> Iterator[tuple[str, str, str, bool, bool]]:
    """The page in order: ``("tag", name, "", in boilerplate, in the article)`` and ``("text",
    place, raw text, in boilerplate, in the article)``."""
    words: Counter = Counter()
    headed, total = set(), 0
    for kind, name, text, boiler, _, hints in _walk(html, frozenset()):
        if kind == "text":
            n = len(text.split())
            total += n
            for k in hints:
                words[k] += n
        elif name in HEADINGS:
            headed.update(hints)
    spared = frozenset(k for k in headed if 2 * words[k] > total)
    return (s[:5] for s in _walk(html, spared))


def _walk(html: str, spared: frozenset[int]) -> Iterator[tuple[str, str, str, bool, bool, tuple[int, ...]]]:
    """``segments``, and the elements with boilerplate names (numbered) that each is in; the names of those in
    ``spared`` don't count."""
    # tag, container, boiler, article, block, hinted elements
    stack: list[tuple[str, str, bool, bool, str, tuple[int, ...]]] = [("", "", False, False, "", ())]
    count: Counter = Counter()
    last = seen = 0
    for m in _TOKEN.finditer(html):
        if m.start() > last:
            _, container, boiler, article, block, hints = stack[-1]
            yield "text", f"{container}>{block}", html[last:m.start()], boiler, article, hints
        last = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if m["end"]:
            yield "tag", tag, "", stack[-1][2], stack[-1][3], stack[-1][5]
            if count[tag]:
                while True:
                    gone = stack.pop()[0]
                    count[gone] -= 1
                    if gone == tag:
                        break
        elif tag not in VOID and not m["attributes"].endswith("/"):
            if tag in CLOSES_P and stack[-1][0] == "p":
                count[stack.pop()[0]] -= 1
            _, container, boiler, article, block, hints = stack[-1]
            place, hinted = place_of(tag, m["attributes"]) if tag in BLOCKS or tag in CONTAINERS else (tag, False)
            if hinted:
                hints = (*hints, seen)
                hinted = seen not in spared
                seen += 1
            if tag in CONTAINERS:
                container = place if place not in ("div", "section") else container  # a nameless one says nothing
                boiler = boiler or hinted or tag in BOILERPLATE
            elif hinted:
                container, boiler = place, True
            stack.append((tag, container, boiler, article or tag in ARTICLE, tag if tag in BLOCKS else block, hints))
            count[tag] += 1
            yield "tag", tag, "", boiler, article or tag in ARTICLE, hints
        else:
            yield "tag", tag, "", stack[-1][2], stack[-1][3], stack[-1][5]
    if last < len(html):
        _, container, boiler, article, block, hints = stack[-1]
        yield "text", f"{container}>{block}", html[last:], boiler, article, hints


def counted(pages: list[str]) -> Counter:
    """(kind, name, is content) of all words and tags of labelled pages."""
    out: Counter = Counter()
    for html in pages:
        found = list(segments(html))
        if any(s[4] for s in found):
            for kind, name, text, boiler, article in found:
                if not boiler:
                    out["word" if kind == "text" else "tag", name, article] += len(text.split()) if kind == "text" else 1
    return out


def weights(counts: Counter) -> dict[tuple[str, str], float]:
    """Log odds of content per place and tag, against the odds of their kind; bounded to +-5."""
    out = {}
    for kind in ("word", "tag"):
        names = {n for k, n, _ in counts if k == kind}
        for name in names:
            yes, no = counts[kind, name, True], counts[kind, name, False]
            odds = max(-5.0, min(5.0, math.log((yes + 0.5) / (no + 0.5))))
            out[kind, name] = odds if kind == "word" else min(odds, TAG_SCORE)
    return out


def best_run(scores: list[float]) -> tuple[int, int]:
    """The contiguous run with the largest sum, as ``(first, end)``; the first and shortest of
    equals; empty if no score is positive."""
    best, first, end = 0.0, 0, 0
    total, start = 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, first, end = total, start, i + 1
    return first, end


def extract(html: str, learned: dict[tuple[str, str], float]) -> str:
    """The main text: blocks in page order, one per line."""
    found = list(segments(html))
    scores = []
    before = False
    for kind, name, text, boiler, _ in found:
        if boiler:  # skipped as a whole, so its length says nothing about what follows
            scores.append(0.0 if before else BOILERPLATE_SCORE)
        elif kind == "tag":
            scores.append(learned.get(("tag", name), TAG_SCORE))
        else:
            scores.append(learned.get(("word", name), 1.0) * len(text.split()))
        before = boiler
    first, end = best_run(scores)
    blocks: list[list[str]] = [[]]
    for (kind, name, text, boiler, _), score in zip(found[first:end], scores[first:end]):
        if kind == "tag":
            if name in BLOCKS:
                blocks.append([])
            elif name == "br":
                blocks[-1].append(" ")
        elif score >= 0 and not boiler:
            blocks[-1].append(text)
    lines = (" ".join(unescape("".join(b)).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def fit(pages: DataFrame, id_col: str = "page_id", html: str = "html", max_pages: int = MAX_PAGES) -> dict[tuple[str, str], float]:
    """Weights from about ``max_pages`` pages (all where there are fewer)."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(html).alias("html")).where("html IS NOT NULL")
    n = max(1, rows.count())
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("html")), F.lit(1 << 30)) / (1 << 30)

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for _, raw in batches(parts, "html"):
            total.update(counted([t.decode("utf-8", "replace") for t in raw]))
        keys = list(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.string(), pa.bool_()))]
            + [pa.array([total[k] for k in keys], pa.int64())], names=["kind", "name", "content", "n"])

    found = (rows.where(draw * n < max_pages).mapInArrow(work, "kind string, name string, content boolean, n bigint")
             .groupBy("kind", "name", "content").agg(F.sum("n").alias("n")).collect())
    return weights(Counter({(r["kind"], r["name"], r["content"]): r["n"] for r in found}))


def main_text(pages: DataFrame, learned: dict[tuple[str, str], float], html: str = "html", *keep: str) -> DataFrame:
    """The ``keep`` columns and ``text`` of every row."""
    shared = pages.sparkSession.sparkContext.broadcast(learned)  # the places of at most MAX_PAGES pages
    rows = pages.select(*keep, F.col(html).alias("html"))

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in batches(parts, "html"):
            texts = [extract(t.decode("utf-8", "replace"), shared.value) for t in raw]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(texts, pa.string())],
                                             names=[*keep, "text"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(work, f"{kinds}, text string")
