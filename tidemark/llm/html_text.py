"""Main text of web pages by a maximum-scoring subsequence.

A page is read as a sequence of words and tags. A linear model scores each by
the elements that it stands in, by their tags, classes and ids: words of an
article score above zero, tags below, and so do words where articles rarely
have any. One linear scan finds the contiguous run of the highest sum: the
content region.

Weights come from labelled pages: those that mark their content (``article``,
``main`` or ``articleBody``), at most about ``LABELLED_PAGES`` of them by a hash
of the page. They are a logistic regression on tags and classes that is drawn
towards ``PRIOR`` as if that were ``PRIOR_PAGES`` pages, so that what the prior
explains stays and what pages contradict moves. The marks themselves are no
feature of it, as the labels are made from them.

Two readings of a page compete by the score of their best region: that its marks
hold the content (words outside count against a region), and that they mean
nothing. If neither has a region, names of elements around the main heading and
most of the page are taken to mean nothing. Inside the region, an element whose own tag or class weighs at most
``INSET`` is left out (an advert, a form, comments); it scores nothing, so that
it never splits a region. Where marks hold the content, this goes for elements
inside of the marks or between two of them: whatever lies outside, the scan
alone leaves out.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.scratch import without
from tidemark.llm.words import lean

LABELLED_PAGES = 2000
PRIOR_PAGES = 100
NAMES = 4096  # learned classes and ids: the most frequent, on at least NAME_PAGES labelled pages
NAME_PAGES = 5
INSET = -1.5

# Elements of HTML by their part in a page. What RAW and REPLACED hold is never shown as text.
RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "noembed", "noframes"}
REPLACED = {"head", "svg", "object", "canvas", "audio", "video"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr", "param"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer",
    "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table",
    "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul",
}
MARKS = {"article", "main"}
# Words of a class, id or role that have a weight before any page was seen. A token has it if all its parts are such words or PLACES.
NAMED = re.compile(
    r"ads?|advert(?:s|isements?|ising|orials?)?|adsense|sponsor(?:s|ed|ship)?|promo(?:s|ted|tions?|tional)?|banner|sidebar|menus?|nav|navbar|navigation|navs|breadcrumbs?|footer|masthead|topbar|toolbar|comments?|commentlist|disqus|respond|repl(?:y|ies)"
    r"|notices?|notifications?|paywall|cookies?|consent|gdpr|popup|modal|overlay|alert|newsletter|subscribe|subscription|signup|login|share|sharing|social|related|recommend(?:ed|ations?)?|widgets?|pagination|pager|search|copyright|legal|disclaimer"
)
PLACES = re.compile(
    r"\d*|main|primary|secondary|site|page|global|top|bottom|left|right|first|last|header|container|wrapper|wrap|inner|outer|area|bar|box|block|slot|unit|list|items?|section|div|body|links?|buttons?|icons?|form|input|field|posts?|articles?|stor(?:y|ies)|readers?|users?|visitors?|reading|bootstrap|wp"
)
PAIRS = re.compile(r"\b(side|top|tool)-bar\b|\b(pop|sign)-(up)\b")
ROLES = {"complementary", "contentinfo", "navigation", "dialog", "alertdialog"}
# A header by name is one only outside of marks, where an article's own heading stands.
HEADER = re.compile(r"(?:(?:site|page|main|top|global)-?)?(?:header|banner)(?:-(?:container|wrapper|inner|area|bar))?")
LEXER = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")

# ``word`` and ``tag`` are what either scores anywhere; ``content`` and ``outside`` are added where marks hold the content; all others where an element or name is open.
PRIOR = {
    "word": 1.0,
    "tag": -0.2,
    "content": 4.0,
    "outside": -4.0,
    "elements": {
        "p": 0.5, "h": 0.5, "pre": 0.5, "blockquote": 0.5, "li": -0.3, "a": -0.8, "nav": -3.0, "footer": -3.0, "aside": -3.0, "header": -3.0, "form": -3.0, "button": -3.0, "select": -3.0,
        "menu": -3.0, "dialog": -3.0, "label": -3.0, "fieldset": -3.0, "option": -3.0,
    },
    "names": {"*": -3.0},
}
TAG_MOST, TAG_IN_CONTENT = -0.01, 1e-4  # a block of one word still adds to a marked region

Weights = dict


@lru_cache(maxsize=1 << 14)
def _named(token: str) -> bool:
    """Whether a whole token of class or id has the weight of a name that is known beforehand."""
    parts = [p.rstrip("0123456789") for p in re.split(r"[-_]+", PAIRS.sub(r"\1bar", token) if "bar" in token else PAIRS.sub(r"\2\3", token))]
    known = [bool(NAMED.fullmatch(p)) for p in parts]
    of_page = len(parts) > 1 and parts[-1] in ("page", "site", "body")  # says what the whole page is
    return not of_page and any(known) and all(k or PLACES.fullmatch(p) for k, p in zip(known, parts, strict=True))


@lru_cache(maxsize=1 << 14)
def _feature(token: str) -> str:
    """A name as the model knows it: without digits, and marked with ``*`` if known beforehand."""
    return ("*" if _named(token) else ".") + re.sub(r"\d+", "", token)[:64]


class Element:
    """An open or closed element: its parent, its own features, and whether it marks content or hides what it holds."""

    __slots__ = ("name", "parent", "own", "mark", "hidden", "words")

    def __init__(self, name: str, parent: Element | None, own: tuple[str, ...] = (), mark: bool = False, hidden: bool = False):
        self.name, self.parent, self.own, self.mark, self.hidden, self.words = name, parent, own, mark, hidden or bool(parent and parent.hidden), 0


def _element(name: str, attributes: str, parent: Element) -> Element:
    own, mark, hidden = [name] if name in PRIOR["elements"] else ["h"] if name in ("h1", "h2", "h3", "h4", "h5", "h6") else [], name in MARKS, name in REPLACED
    for m in ATTRIBUTE.finditer(attributes) if attributes and not attributes.isspace() else ():
        key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if key in ("class", "id", "role"):
            if key == "role" and value in ROLES:
                own.append("*" + value)
            for token in value.split():
                own.append("header" if HEADER.fullmatch(token.replace("_", "-")) else _feature(token))
        elif key == "itemprop":
            mark, hidden = mark or value == "articlebody", hidden or value == "comment"
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", ""):
            hidden = True
    return Element(name, parent, () if name in ("html", "body") else tuple(dict.fromkeys(own)), mark, hidden)


Run = tuple[Element, str, int, int]


def read_page(page: str) -> tuple[list[Run], list[Element]]:
    """The page as (element, text, words, block) runs, with -1 words for a tag, and all its elements in page order."""
    runs: list[Run] = []
    root = Element("", None)
    elements, stack, block, at, size = [root], [root], 0, 0, len(page)

    def text(raw: str) -> None:
        if raw and not stack[-1].hidden:
            shown = html.unescape(raw)
            n = len(shown.split())
            stack[-1].words += n
            runs.append((stack[-1], shown, n, block))

    while at < size:
        m = LEXER.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        if not m[2]:
            if m[0].startswith("<![CDATA["):
                text(m[0][9:-3])
            continue
        name = m[2].lower()
        if name in BLOCK:
            block += 1
        elif name == "br":
            text(" ")
        if m[1]:
            opened = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), None)
            if opened is not None:
                # A stray end tag of an inline element never closes a block around it.
                if name in BLOCK or not any(f.name in BLOCK for f in stack[opened + 1 :]):
                    del stack[opened:]
                else:
                    del stack[opened]
            runs.append((stack[-1], "", -1, block))
            continue
        whole = m[3].rstrip().endswith("/")
        if name in ("p", "li") and any(f.name == name for f in stack):
            while stack[-1].name in ({"p", "b", "i", "em", "strong", "span", "u", "font"} if name == "p" else {"p", "li", "b", "i"}):
                stack.pop()
        if name == "body":
            stack[1:] = [f for f in stack[1:] if f.name != "head"]
        runs.append((stack[-1], "", -1, block))
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at) if not whole else None
            if end:
                at = end.end()
            elif not whole and name in ("script", "style", "textarea", "title"):
                at = size
        elif name not in VOID and not (whole and name not in BLOCK):
            element = _element(name, m[3], stack[-1])
            elements.append(element)
            stack.append(element)
    for element in reversed(elements[1:]):
        element.parent.words += element.words
    return runs, elements


class Reading:
    """A page's elements under one reading of its marks: what words and tags score in each, and which are insets."""

    def __init__(self, runs: list[Run], elements: list[Element], weights: Weights, marks: set[Element], wrappers: frozenset[Element] = frozenset()):
        value = {**weights["elements"], **weights["names"]}
        other = weights["names"]["*"]
        weigh = lambda own: sum(value.get(f, other if f[0] == "*" else 0.0) for f in own)
        self.total: dict[Element, float] = {elements[0]: 0.0}
        self.inside: dict[Element, bool] = {elements[0]: False}
        self.named: dict[Element, bool] = {elements[0]: False}  # stands in an element that would be an inset
        self.inset: dict[Element, bool] = {elements[0]: False}
        for e in elements[1:]:
            within, own = self.inside[e.parent], 0.0
            if not (e.mark and (e in marks or within)):  # a mark's names say nothing
                own = weigh(f for f in e.own if not (f == "header" and within) and not (f == "form" and 2 * e.words >= elements[0].words) and not (e in wrappers and (f[0] in "*." or f == "header" != e.name)))
            self.inside[e] = within or e in marks
            self.total[e] = self.total[e.parent] + own
            self.named[e] = self.named[e.parent] or own <= INSET
            self.inset[e] = self.inset[e.parent] or own <= INSET and (within or not marks)
        held = [i for i, (e, _, n, _) in enumerate(runs) if n > 0 and self.inside[e]]
        first, last = (held[0], held[-1]) if held else (0, 0)
        self.left_out = [self.inset[e] or self.named[e] and not self.inside[e] and first < i < last for i, (e, _, _, _) in enumerate(runs)]
        self.scores = np.zeros(len(runs))
        for i, (e, _, n, _) in enumerate(runs):
            mark = weights["content"] if self.inside[e] else weights["outside"] if marks else 0.0
            if n < 0:
                self.scores[i] = min(TAG_MOST, weights["tag"] + min(0.0, self.total[e])) * (TAG_IN_CONTENT if self.inside[e] or self.left_out[i] else 1.0)
            elif not self.left_out[i]:
                self.scores[i] = n * (weights["word"] + self.total[e] + mark)
        self.start, self.end = best_span(self.scores)
        self.score = float(self.scores[self.start : self.end].sum())


def trusted_marks(elements: list[Element], weights: Weights) -> set[Element]:
    """The outermost marks of a page; those under a name of boilerplate only if they hold more words than the others."""
    if not any(e.mark for e in elements):
        return set()
    plain = Reading([], elements, weights, set())
    outer: list[list[Element]] = [[], []]
    under: dict[Element, bool] = {elements[0]: False}
    for e in elements[1:]:
        under[e] = under[e.parent] or e.mark
        if e.mark and not under[e.parent]:
            outer[plain.named[e.parent]].append(e)
    return set(max(outer, key=lambda marks: sum(e.words for e in marks)))


def best_span(values: np.ndarray) -> tuple[int, int]:
    """Start and end of the contiguous run with the largest positive sum, by one linear scan; (0, 0) if none."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for i, v in enumerate(values.tolist()):
        if total <= 0:
            total, start = 0.0, i
        total += v
        if total > best:
            best, span = total, (start, i + 1)
    return span


def page_wrappers(elements: list[Element]) -> frozenset[Element]:
    """Elements around at least half of the page's words and its main heading: what is named after them is the page, not a part of it."""
    around: set[Element] = set()
    for e in elements[1:]:
        at = e.parent if e.name == "h1" else None
        while at is not None and at not in around:
            around.add(at)
            at = at.parent
    return frozenset(e for e in around if 2 * e.words >= elements[0].words)


def best_reading(runs: list[Run], elements: list[Element], weights: Weights) -> Reading:
    """The reading whose region scores most: by the page's marks, or without.

    Where neither finds a region, the names of the page's wrappers are read as saying nothing.
    """
    marks = trusted_marks(elements, weights)
    found = Reading(runs, elements, weights, set())
    if marks and (marked := Reading(runs, elements, weights, marks)).score >= found.score:
        found = marked
    if found.score == 0 and (wrappers := page_wrappers(elements)):
        return Reading(runs, elements, weights, set(), wrappers)
    return found


def main_text(page: str | None, weights: Weights) -> str:
    """The page's main text: its blocks, white space closed up, joined by newlines."""
    if not page:
        return ""
    runs, elements = read_page(page)
    reading = best_reading(runs, elements, weights)
    blocks: dict[int, list[str]] = {}
    for i in range(reading.start, reading.end):
        _, text, n, block = runs[i]
        if n >= 0 and not reading.left_out[i]:
            blocks.setdefault(block, []).append(text)
    closed = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(b for b in closed if b)


def labelled(page: str) -> list[tuple[frozenset[str], bool, bool, float]]:
    """(features, is a word, is content, weight) of a page that marks its content, else nothing.

    Words, and tags, of either label weigh 1 in all. Inside marks, an element
    that the prior would leave out gives no example: its label isn't known.
    """
    runs, elements = read_page(page)
    marks = trusted_marks(elements, PRIOR)
    if not marks:
        return []
    reading = Reading(runs, elements, PRIOR, marks)
    features: dict[Element, frozenset[str]] = {elements[0]: frozenset()}
    for e in elements[1:]:
        own = () if e in marks else tuple(f for f in e.own if not (f == "header" and reading.inside[e.parent]))
        features[e] = features[e.parent].union(own) if own else features[e.parent]
    seen: dict[tuple, float] = defaultdict(float)
    total: dict[tuple, float] = defaultdict(float)
    for e, _, n, _ in runs:
        if n and not reading.inset[e]:
            key = (features[e], n > 0, reading.inside[e])
            seen[key] += abs(n)
            total[key[1:]] += abs(n)
    if (True, True) not in total:
        return []
    return [(*key, n / total[key[1:]]) for key, n in seen.items()]


def fit(examples: list[tuple[frozenset[str], bool, bool, float]]) -> Weights:
    """The weights of highest posterior: logistic regression on all examples, drawn towards ``PRIOR``."""
    known = {**PRIOR["elements"], "": 0.0, "word": PRIOR["word"], "tag": PRIOR["tag"]}
    names = list(dict.fromkeys([*known, *sorted(f for features, *_ in examples for f in features)]))
    place = {f: i for i, f in enumerate(names)}
    prior = np.array([known.get(f, PRIOR["names"]["*"] if f[:1] == "*" else 0.0) for f in names])
    lists = [[place["word" if word else "tag"], *(place[f] for f in features)] for features, word, _, _ in examples]
    weight, label = np.array([e[3] for e in examples]), np.array([e[2] for e in examples], dtype=float)
    row, column = np.repeat(np.arange(len(lists)), [len(f) for f in lists]), np.array([c for f in lists for c in f])
    # A separable bound on the curvature, so that every step goes uphill.
    step = 1 / (PRIOR_PAGES + np.bincount(column, 0.25 * weight[row] * np.array([len(f) for f in lists])[row], len(names)))
    w = prior.copy()
    for _ in range(500):
        off = weight * (label - 1 / (1 + np.exp(-np.bincount(row, w[column], len(lists)))))
        w += step * (np.bincount(column, off[row], len(names)) - PRIOR_PAGES * (w - prior))
    found = dict(zip(names, np.round(w, 4).tolist(), strict=True))
    return {
        **PRIOR,
        "word": found["word"],
        "tag": min(TAG_MOST, found["tag"]),
        "elements": {f: found[f] for f in PRIOR["elements"]},
        "names": {**PRIOR["names"], **{f: w for f, w in found.items() if f[:1] in ("*", ".") and f not in PRIOR["names"]}},
    }


def learn(pages: DataFrame, page: str = "html") -> Weights:
    """Weights from pages that mark their content; ``PRIOR`` if there are none.

    Null pages teach nothing; pages that repeat are taken or left together. An
    empty table gives ``PRIOR``. What reaches the driver are the distinct sets
    of open elements and names of at most about ``LABELLED_PAGES`` pages.
    """
    rows = pages.select(F.col(page).alias("html")).where("html is not null")
    part = min(1.0, LABELLED_PAGES / max(rows.count(), 1))
    sample = rows.where(F.pmod(F.xxhash64(F.lit("label"), "html"), F.lit(1 << 20)) < part * (1 << 20))

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = sorted({f for features, *_ in labelled(text) for f in features if f not in PRIOR["elements"]})
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["name"])

    often = sample.mapInArrow(lean(names), "name string").groupBy("name").agg(F.count("*").alias("n")).where(F.col("n") >= NAME_PAGES).orderBy(F.desc("n"), "name").limit(NAMES)
    known = {r.name for r in often.collect()} | set(PRIOR["elements"])

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, float] = defaultdict(float)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for features, word, content, n in labelled(text):
                    # A rare name is known only as one of its kind.
                    kept = sorted({f if f in known else f[0] for f in features if f in known or f[0] == "*"})
                    seen["\x1f".join(kept), word, content] += n
        if seen:
            columns = list(zip(*seen, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1]), pa.array(columns[2]), pa.array(list(seen.values()))], names=["features", "word", "content", "n"])

    summed = sample.mapInArrow(lean(examples), "features string, word boolean, content boolean, n double").groupBy("features", "word", "content").agg(F.sum("n").alias("n"))
    found = sorted((r.features, r.word, r.content, round(r.n, 6)) for r in summed.collect())
    return fit([(frozenset(f.split("\x1f")) - {""}, word, content, n) for f, word, content, n in found]) if found else PRIOR


def extract(pages: DataFrame, weights: Weights, page: str = "html", out: str = "text") -> DataFrame:
    """Add each page's main text, empty if there is none; null pages give an empty text.

    Whole pages are read and nothing is shuffled. Other columns stay; one with
    the output's name is replaced. An empty table gives no rows.
    """
    pages = without(pages.withColumn("__page", F.col(page)), out)
    page = "__page"
    schema = T.StructType([*pages.schema.fields[:-1], T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(page))
            for at in range(0, batch.num_rows, 500):
                piece = batch.slice(at, 500)
                texts = [main_text(t, weights) for t in column.slice(at, 500).to_pylist()]
                yield pa.RecordBatch.from_arrays([*piece.columns[:-1], pa.array(texts, pa.string())], names=schema.names)

    return pages.mapInArrow(lean(run), schema)
