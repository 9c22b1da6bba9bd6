"""Main text of HTML pages as a maximum-scoring run of tokens.

A page is a sequence of tokens: tags and words.  Every token type has a weight, and one
linear scan finds the contiguous run whose weights sum highest; its words are the main
text.  Words score positive and tags negative unless labelled pages say otherwise.

Weights come from labelled pages: pages whose authors marked the article with the
``article`` element (up to ``MAX_PAGES``, those whose address hashes lowest).  A type's
weight is the log odds of its place inside rather than outside, smoothed by and, without
labelled pages, equal to its prior.  Types are few, so that what is rare on the labelled pages
(a table, a list, a listing) is judged like other content: words, words of links, tags of
content (paragraphs, headings, lists, tables, inline marks), of links, and of layout.

Elements that are no content by their tag (nav, footer, aside, form ...) or by what a class, id or
role says (ad, menu, cookie, comment, sidebar ...) are left out and weigh nothing, so the run goes
on behind them.  Names are evidence, the words decide: an element whose name only partly says
so is kept if it holds more than half of the page's words outside links, a form, a dialog or one whose
whole name says so if it holds more than four fifths; ``has-sidebar``, ``no-comments``, ``ad-free`` say nothing.

Scripts, styles, comments and other raw elements never have text.  Text of a block:
character references decoded, white space turned to one blank, trimmed; blocks are joined by a
newline.  ``br`` is white space.  Null and empty pages, and pages without words, have the empty
text.  Of runs that score the same the first is taken, and of those from one start the shortest.
Every row is a page of its own, repeated rows too; an empty table gives no rows.  A page of
any length is one row, read whole in time in proportion to it.  Other columns are ignored.
"""

from __future__ import annotations

import bisect
import html as html_
import itertools
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

MAX_PAGES = 5_000
SMOOTH = 4.0        # strength of a prior, in occurrences
LIMIT = 8.0         # largest weight

_NAMES = "a abbr article aside b blockquote body br button caption cite code dd details div dl dt em figcaption figure font " \
         "footer form h1 h2 h3 h4 h5 h6 head header hr html i img input kbd label li link main mark meta nav ol option p pre q s " \
         "section select small span strong sub summary sup table tbody td tfoot th thead time tr u ul var"
TAGS = frozenset(_NAMES.split())
BLOCKS = frozenset("address article aside blockquote body caption dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 "
                   "h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
NO_CONTENT = frozenset("nav footer aside button select menu".split())
CONTENT = frozenset("abbr b blockquote caption cite code dd dl dt em figcaption figure h1 h2 h3 h4 h5 h6 i kbd li mark ol p pre q s small "
                    "strong sub sup table tbody td tfoot th thead time tr u ul var article main".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_RAW = r"script|style|noscript|template|textarea|title|svg|math|iframe|object|canvas|audio|video|xmp|head"
_TOKEN = re.compile(
    r"<!--(?s:.*?)(?:--!?>|\Z)"
    r"|<(?P<raw>" + _RAW.replace("|head", "") + r")(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>(?s:.*?)(?:</(?P=raw)[^>]*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?:[!?/]|[a-zA-Z])[^>]*(?:>|\Z)", re.I)
_SAYS = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_WORDS = re.compile(
    r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner\w*|cookies?|consent|gdpr|notice\w*|alert|popup|modal|overlay|"
    r"newsletter|subscribe|signup|login|search|menus?|nav\w*|breadcrumbs?|side|bars?|sidebars?|footer|masthead|pagination|pager|social|shar(?:e|ing)|"
    r"related|recommend\w*|trending|widget\w*|comments?|disqus|replies|reply|respond|complementary|contentinfo|dialog")
_ALONE = frozenset("side bar bars".split())     # say something only together
_DENIES = frozenset("has no non not with without is show hide free less".split())
#: What an element may hold of the page's words outside links and still be left out.
WEAK_SHARE, STRONG_SHARE = 0.5, 0.8

#: Weights where no labelled page tells otherwise.
PRIOR = {"w": 1.0, "w:a": 0.5, "t:content": -0.3, "t:a": -1.0, "t:layout": -1.0}


def _evidence(name: str, rest: str, in_article: bool) -> float:
    """Share of the page's words up to which the element is left out: 0 without evidence."""
    if name in ("form", "dialog"):      # some pages stand in one as a whole
        return STRONG_SHARE
    if name in NO_CONTENT or (name == "header" and not in_article):
        return 1.0
    if name in ("body", "html", "article", "main") or not rest:
        return 0.0
    found = 0.0
    for m in _SAYS.finditer(rest):
        for value in m[1].strip("\"'").lower().split():
            parts = [x for x in re.split(r"[_\-\d]+", value) if x]
            hits = [x for x in parts if _WORDS.fullmatch(x)]
            if not hits or all(x in _ALONE for x in hits) and len(hits) < 2 or not _DENIES.isdisjoint(parts):
                continue
            found = max(found, STRONG_SHARE if len(hits) == len(parts) else WEAK_SHARE)
    return found


class _Page:
    """A page's tags and texts in order, and which stand in elements that are left out.

    ``kind[k]``: type of the tag, or of each word of the text (empty for white space);
    ``text[k]``: the text; ``n[k]``: its words; ``breaks[k]``: a block begins here;
    ``inside[k]``: within an article element; ``out[k]``: left out."""

    def __init__(self, page: str):
        self.kind, self.text, self.n, self.breaks, self.inside = [], [], [], [], []
        stack, opened = [], Counter()       # open elements as (name, place of the tag)
        ends: dict[int, int] = {}
        suspects = []                       # (place, share, closed by its own end tag)
        sections = []                       # places of tags that begin a section
        article, links, breaks, at = 0, 0, True, 0

        def put(kind, text, n):
            nonlocal breaks
            self.kind.append(kind)
            self.text.append(text)
            self.n.append(n)
            self.breaks.append(breaks)
            self.inside.append(article > 0)
            if n:
                breaks = False

        def words(text):
            n = len(text.split())
            put(("w:a" if links else "w") if n else "", text, n)

        for m in _TOKEN.finditer(page):
            if m.start() > at:
                words(page[at:m.start()])
            at = m.end()
            if m["name"] is None:
                continue
            name, end = m["name"].lower(), bool(m["end"])
            if name == "article" and not end:
                article += 1
            if name in BLOCKS:
                breaks = True
            elif name == "br":
                put("", " ", 0)
            here = len(self.kind)
            put("t:a" if name == "a" else "t:content" if name in CONTENT else "t:layout", "", 0)
            if end:
                if opened[name]:
                    while True:     # what was left open inside ends here too
                        other, k = stack.pop()
                        opened[other] -= 1
                        if other == "a":
                            links -= 1
                        ends[k] = here if other == name else -here
                        if other == name:
                            break
                if name == "article":
                    article = max(0, article - 1)
            elif name not in VOID:
                if name in ("article", "main", "footer", "body"):
                    sections.append(here)
                share = _evidence(name, m["rest"], article > 0)
                if share:
                    suspects.append((here, share))
                stack.append((name, here))
                opened[name] += 1
                if name == "a":
                    links += 1
        if at < len(page):
            words(page[at:])
        self.out = self._left_out(suspects, ends, sections)

    def _left_out(self, suspects, ends, sections) -> list[bool]:
        size = len(self.kind)
        before = [0, *itertools.accumulate(n if kind == "w" else 0 for n, kind in zip(self.n, self.kind))]
        out, upto = [False] * size, 0
        for k, share in suspects:           # in page order: an element in a left-out one is done
            if k < upto:
                continue
            end = ends.get(k, -size)
            if end < 0:                     # never closed: it does not swallow a new section
                s = bisect.bisect_right(sections, k)
                end = min(-end, sections[s] if s < len(sections) else size)
            else:
                end += 1
            if before[end] - before[k] <= share * before[size]:
                out[k:end] = [True] * (end - k)
                upto = end
        return out


def count_types(page: str) -> Counter:
    """Occurrences of (type, inside an article) on a page that has an article."""
    out: Counter = Counter()
    p = _Page(page)
    for kind, n, inside, gone in zip(p.kind, p.n, p.inside, p.out):
        if kind and not gone:
            out[kind, inside] += n or 1
    return out


def weigh(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Weight of each counted type: log odds of inside to outside, pulled to its prior."""
    total = {b: sum(n for (_, x), n in counts.items() if x == b) + 1 for b in (True, False)}
    out = {}
    for kind in {k for k, _ in counts}:
        share = 1 / (1 + math.exp(-PRIOR[kind]))
        a = counts.get((kind, True), 0) / total[True] * min(total.values()) + SMOOTH * share
        b = counts.get((kind, False), 0) / total[False] * min(total.values()) + SMOOTH * (1 - share)
        out[kind] = max(-LIMIT, min(LIMIT, math.log(a / b)))
    return out


def best_run(scores: list[float]) -> tuple[int, int]:
    """The contiguous run of the highest sum above 0, as [from, to); (0, 0) if there is none."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for k, x in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += x
        if total > best:
            best, span = total, (start, k + 1)
    return span


def scores(p: _Page, weights: dict[str, float]) -> list[float]:
    """Weight of each token: nothing where it is left out."""
    of = {kind: weights.get(kind, prior) for kind, prior in PRIOR.items()} | {"": 0.0}
    return [0.0 if gone else of[kind] * (n or 1) for kind, n, gone in zip(p.kind, p.n, p.out)]


def main_text(page: str | None, weights: dict[str, float]) -> str:
    if not page:
        return ""
    p = _Page(page)
    first, last = best_run(scores(p, weights))
    blocks: list[list[str]] = []
    for k in range(first, last):
        if p.breaks[k] and (not blocks or blocks[-1]):
            blocks.append([])
        if p.text[k] and not p.out[k]:
            if not blocks:
                blocks.append([])
            blocks[-1].append(p.text[k])
    lines = (" ".join(html_.unescape("".join(b)).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def _count(batches):
    for batch in batches:
        out: Counter = Counter()
        for page in batch.column("html").to_pylist():
            if page:
                out.update(count_types(page))
        keys = list(out)
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in keys], pa.string()), pa.array([i for _, i in keys], pa.bool_()),
                                          pa.array([out[k] for k in keys], pa.int64())], names=["kind", "inside", "n"])


def learn_weights(pages: DataFrame, url: str = "url", html: str = "html") -> dict[str, float]:
    """Weights from at most MAX_PAGES pages that hold an article element."""
    rows = pages.select(F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html")) \
        .filter(F.lower("html").contains("<article"))
    # The same page many times, under one address or none, counts once.
    key = F.xxhash64("url", "html")
    limit = rows.select(key.alias("key")).distinct().orderBy("key").limit(MAX_PAGES).agg(F.max("key")).first()[0]
    if limit is None:
        return {}
    counted = rows.filter(key <= limit).distinct().select("html").mapInArrow(_count, "kind string, inside boolean, n long") \
        .groupBy("kind", "inside").agg(F.sum("n").alias("n")).collect()  # a fixed, small set of types
    return weigh({(r["kind"], r["inside"]): r["n"] for r in counted})


def _extract(weights: dict[str, float], html: str):
    def run(batches):
        for batch in batches:
            k = batch.schema.get_field_index(html)
            cols = list(batch.columns)
            cols[k] = pa.array([main_text(page, weights) for page in cols[k].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)
    return run


def extract(pages: DataFrame, weights: dict[str, float] | None = None, url: str = "url", html: str = "html",
            carry: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """(*carry, text) for every row of ``pages``."""
    if weights is None:
        weights = learn_weights(pages, url, html)
    names = {c: f"carry_{k}" for k, c in enumerate(carry)}
    rows = pages.select(*[F.col(c).alias(a) for c, a in names.items()], F.col(html).cast("string").alias("text"))
    out = rows.mapInArrow(_extract(weights, "text"), rows.schema)
    return out.select(*[F.col(a).alias(c) for c, a in names.items()], "text")
