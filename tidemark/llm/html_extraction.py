"""Main text of web pages by tag-path ratios.

A page is cut into blocks, each with the path of block elements from the root
to it. For every path of a page the text length, its part inside links, the
punctuation and the number of blocks are added up; the ratios of text and of
punctuation to blocks are the path's weight. Weights are smoothed along the page,
fused with the unsmoothed ones, and every block whose path's fused weight passes
a threshold is content. What a page says about itself only moves weights: an element
named like another part of a page (an advert, comments and so on) weighs less with
all that is in it; where the page has an article (or else a main) element, paths
inside weigh more and paths outside less; a path without text beyond its links
stays at zero. A heading is content if the block after it is. Short blocks (list items, cells,
code, captions, bylines) share their path with no long text, so they follow their surroundings: with unlinked
text and no name of another part, one inside the article, or between two content blocks of one container, is
content. Elements that are never an article's text (menus, footers, forms and so on) are left out.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*)")
#: The rest of a tag; a second form, in which no quoted value holds "<", for pages whose quotes do not close.
_REST = re.compile(r"""((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_REST_PLAIN = re.compile(r"""((?:[^<>"']|"[^"<]*"|'[^'<]*')*+)>|([^<>]*+)>""")
_MARKS = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)

# Element names of HTML and customary names of page parts.
RAW = frozenset("script style textarea title".split())
EMBEDDED = frozenset("noscript template iframe svg math object canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img br ruby rt rp".split())
OUTSIDE = frozenset("nav footer aside form button select option menu menuitem dialog fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
PARTS = frozenset("nav navbar navigation menu sidebar footer masthead advert adverts advertisement advertising sponsor sponsored cookie cookies gdpr consent popup modal overlay newsletter subscribe subscription signup login comment comments commentlist respond disqus sharing recommended breadcrumb breadcrumbs pagination pager copyright disclaimer".split())
#: Names that mean another part if they stand alone, and may do so within a longer name.
VAGUE = frozenset("side aside ad ads adv promo banner notice notices reply replies share social related widget legal skip".split())
WITHOUT = frozenset("no not non has with without hide".split())
#: Words behind a name that do not change what it means.
GENERIC = frozenset("area bar block body bottom box button buttons card cards container content group holder icons inner item items left link links list main media outer panel post posts region right row section slot stories text title top unit widget widgets wrap wrapper zone".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": set(), "tbody": {"tr", "td", "th", "thead"}}
_PUNCTUATION = re.compile(r"[.,;:!?、。，！？]")

OWN = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
THRESHOLD = 0.5
#: The weight of a path whose blocks are one unlinked character long.
LEAST = 1.0
#: What is left of the weight inside an element with the name of another part, and with one that may be such a name.
PART, DOUBT = 0.02, 0.1


class _Element:
    __slots__ = ("apart", "depth", "doubtful", "factor", "heading", "name", "parent", "path", "within")

    def __init__(self, name: str, parent: _Element | None, path: int, apart: bool = False, factor: float = 1.0, part: bool = False):
        self.name, self.parent, self.path, self.apart = name, parent, path, apart
        self.factor = factor * (parent.factor if parent else 1.0)
        self.depth = parent.depth + 1 if parent else 0
        self.heading = name in HEADINGS or (parent is not None and parent.heading)
        #: The outermost article with the name of another part that this is in, and which of article and main it is in, or is.
        self.doubtful = (parent.doubtful if parent else None) or (self if part else None)
        self.within: frozenset[str] = parent.within if parent else frozenset()
        if name in OWN:
            self.within = self.within | {name}


class _Block:
    __slots__ = ("element", "links", "text")

    def __init__(self, element: _Element, text: str, links: int):
        self.element, self.text, self.links = element, text, links


def _factor(value: str) -> float:
    """What a class or id leaves of the weight."""
    left = 1.0
    for token in value.lower().split():
        words = [w for w in re.split(r"[_-]+", token) if w]
        if not words or words[0] in WITHOUT:
            continue
        if token in PARTS or token in VAGUE:
            return PART
        # what a longer name is of stands last, but for words that every part may have
        while len(words) > 1 and words[-1] in GENERIC:
            words.pop()
        if words[-1] in PARTS:
            return PART
        if words[-1] in VAGUE:
            left = DOUBT
    return left


def _marked(attributes: str) -> tuple[bool, float, str]:
    """Whether the role says that this is no content, what the names leave of the weight, and the class for the path."""
    apart, factor, first = False, 1.0, ""
    for key, value in _MARKS.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "role":
            apart = apart or value.lower() in ROLES
            continue
        factor = min(factor, _factor(value))
        if key == "class" and value.split():
            first = value.split()[0]
    return apart, factor, first


class _Page:
    """The text blocks of a page in order, found in one pass; each step either moves ahead in the page or closes elements."""

    def __init__(self, page: str):
        self.page, self.blocks = page, []
        self.paths: dict[tuple[int, str, str], int] = {}
        self.at = self.root = _Element("", None, 0)
        self.open: Counter[str] = Counter()
        self.run, self.linked, self.anchors = [], 0, 0
        self.low: str | None = None
        self.quotes_close = True
        self._read()

    def _text(self, a: int, b: int) -> None:
        if b > a and not self.at.apart:
            text = html.unescape(self.page[a:b])
            self.run.append(text)
            if self.anchors:
                self.linked += len(text)

    def _close_block(self) -> None:
        text = " ".join("".join(self.run).split())
        if text:
            self.blocks.append(_Block(self.at, text, self.linked))
        self.run, self.linked = [], 0

    def _up(self) -> None:
        self.open[self.at.name] -= 1
        self.at = self.at.parent

    def _end_of(self, name: str, at: int, otherwise: int) -> int:
        """Where the element that was opened before ``at`` ends."""
        if self.low is None:
            self.low = self.page.lower()
        stop = self.low.find(f"</{name}", at)
        if stop < 0:
            return otherwise
        stop = self.page.find(">", stop)
        return stop + 1 if stop >= 0 else len(self.page)

    def _read(self) -> None:
        page, n, i, missing = self.page, len(self.page), 0, set()
        while i < n:
            start = page.find("<", i)
            if start < 0:
                self._text(i, n)
                break
            self._text(i, start)
            i = start
            if page.startswith("<!--", i):
                stop = page.find("-->", i + 4)
                i = stop + 3 if stop >= 0 else n
                continue
            if page.startswith(("<!", "<?"), i):
                stop = page.find(">", i)
                i = stop + 1 if stop >= 0 else n
                continue
            tag = _NAME.match(page, i)
            if not tag:
                self._text(i, i + 1)
                i += 1
                continue
            rest = _REST.match(page, tag.end()) if self.quotes_close else None
            if rest is None:
                self.quotes_close = False
                rest = _REST_PLAIN.match(page, tag.end())
            if rest is None:  # the tag does not end: it goes, up to the next
                stop = page.find("<", tag.end())
                i = stop if stop >= 0 else n
                continue
            i = rest.end()
            name, attributes = tag[2].lower(), rest[1] if rest[1] is not None else rest[2]
            if tag[1]:
                self._closing(name)
            elif name in RAW:
                i = i if attributes.endswith("/") else self._end_of(name, i, n)
            elif name in EMBEDDED:
                if name not in missing and not attributes.endswith("/"):
                    stop = self._end_of(name, i, -1)
                    if stop < 0:  # never closed: what follows is not in it
                        missing.add(name)
                    else:
                        i = stop
            else:
                self._opening(name, attributes)
        self._close_block()

    def _closing(self, name: str) -> None:
        if name == "a":
            self.anchors = max(0, self.anchors - 1)
        if name in INLINE or name in RAW or name in EMBEDDED:
            return
        self._close_block()
        if self.open[name] > 0:
            while self.at.name != name:
                self._up()
            self._up()
            self.anchors = 0

    def _opening(self, name: str, attributes: str) -> None:
        if name == "br":
            if not self.at.apart:
                self.run.append(" ")
            return
        if name == "a":
            self.anchors += 1
        if name in INLINE:
            return
        self._close_block()
        if name in VOID:
            return
        if self.at.name == "p":
            self._up()
        while self.at.name in CLOSES.get(name, ()):
            self._up()
        self.anchors = 0
        at = self.at
        apart, factor, mark = _marked(attributes)
        part = name in OWN and factor < 1
        apart = apart or (part and "article" in at.within) or name in OUTSIDE or (name == "header" and not at.within)
        if name in OWN or name in ("html", "body"):
            factor = 1.0
        if attributes.endswith("/") and name not in ("p", "div", "li"):
            return
        path = self.paths.setdefault((at.path, name, mark), len(self.paths) + 1)
        self.at = _Element(name, at, path, at.apart or apart, factor, part)
        self.open[name] += 1


def blocks(page: str) -> list[_Block]:
    return _Page(page).blocks


def _doubted(found: list[_Block]) -> set[_Element]:
    """Articles named as another part, unless the largest of them is longer than all text beside them."""
    sizes: dict[_Element | None, int] = {}
    for b in found:
        sizes[b.element.doubtful] = sizes.get(b.element.doubtful, 0) + max(0, len(b.text) - b.links)
    beside = sizes.pop(None, 0)
    within = any("article" in b.element.within for b in found if b.element.doubtful is None)
    return set(sizes) if within or beside >= max(sizes.values(), default=0) else set()


def _weights(parts: list[_Block]) -> list[float]:
    """The weight of each block: its path's fused weight, moved by what the page says about the block's elements."""
    sums: dict[int, list[int]] = {}
    for b in parts:
        x = sums.setdefault(b.element.path, [0, 0, 0, 0])
        x[0] += len(b.text)
        x[1] += b.links
        x[2] += len(_PUNCTUATION.findall(b.text))
        x[3] += 1
    ratio = {p: (x[0] - min(x[0], x[1])) / x[3] * (1 + x[2] / x[3]) for p, x in sums.items()}
    raw = [ratio[b.element.path] for b in parts]
    smooth = []
    for k in range(len(raw)):
        near = [(raw[k + d], w) for d, w in ((-1, 1), (0, 2), (1, 1)) if 0 <= k + d < len(raw)]
        smooth.append(sum(x * w for x, w in near) / sum(w for _, w in near))
    fused: dict[int, list[float]] = {}
    for b, x, y in zip(parts, raw, smooth, strict=True):
        fused.setdefault(b.element.path, []).append(math.sqrt(x * y))
    mean = {p: sum(f) / len(f) for p, f in fused.items()}
    doubted = _doubted(parts)
    weights = [mean[b.element.path] * b.element.factor * (PART if b.element.doubtful in doubted else 1.0) for b in parts]
    own = next((x for x in ("article", "main") if any(x in b.element.within for b in parts if b.element.doubtful not in doubted)), None)
    if own is None:
        return weights
    # only raises or lowers: half way up to the greatest weight on a log scale, and half
    most = max(weights)
    return [math.sqrt(w * most) if own in b.element.within else w / 2 for b, w in zip(parts, weights, strict=True)]


_WHOLE = frozenset(("", "html", "body"))
#: How far up an element's container is looked for, so that time stays in proportion to the page.
_UP = 64


def _holds(outer: _Element, inner: _Element) -> bool:
    for _ in range(_UP):
        if inner is None or inner.depth < outer.depth:
            return False
        if inner is outer:
            return True
        inner = inner.parent
    return False


def _near(a: _Element, b: _Element) -> _Element | None:
    """The innermost element that holds both; none if it is far up from either."""
    if abs(a.depth - b.depth) > _UP:
        return None
    low = min(a.depth, b.depth)
    while a.depth > low:
        a = a.parent
    while b.depth > low:
        b = b.parent
    for _ in range(_UP):
        if a is b:
            return a
        a, b = a.parent, b.parent
    return None


def _lift(parts: list[_Block], content: list[bool]) -> list[bool]:
    """Content with the short blocks that go with it."""
    doubted = _doubted(parts)
    plain = [b.element.factor == 1.0 and b.element.doubtful not in doubted and 2 * b.links <= len(b.text) for b in parts]
    within = lambda b: "article" in b.element.within
    in_article = any(good and within(b) for b, good in zip(parts, content, strict=True))
    after: list[int | None] = [None] * len(parts)
    following = None
    for k in reversed(range(len(parts))):
        after[k] = following
        following = k if content[k] else following
    out, before = list(content), None
    for k, b in enumerate(parts):
        if content[k]:
            before = k
        elif plain[k]:
            if in_article and within(b):
                out[k] = True
            elif before is not None and after[k] is not None:
                shared = _near(parts[before].element, parts[after[k]].element)
                out[k] = shared is not None and shared.name not in _WHOLE and _holds(shared, b.element)
    return out


def main_text(page: str | None) -> str:
    """The content's blocks, one a line; empty if the page has none."""
    parts = blocks(page or "")
    if not parts:
        return ""
    weights = _weights(parts)
    mean = sum(weights) / len(weights)
    spread = math.sqrt(sum((w - mean) ** 2 for w in weights) / len(weights))
    limit = min(THRESHOLD * spread, max(weights))
    content = _lift(parts, [w >= max(limit, LEAST) for w in weights])
    for k in reversed(range(len(parts) - 1)):
        if parts[k].element.heading and parts[k].element.factor >= parts[k + 1].element.factor:
            content[k] = content[k] or content[k + 1]
    return "\n".join(b.text for b, good in zip(parts, content, strict=True) if good)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page) for page in batch.column("html").to_pylist()]
        yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """The main text of every page: ``page_id, url, text, n_chars``.

    Character references are decoded, white space inside a block (line breaks
    included) is one space, blocks follow in page order with one line feed
    between them; nothing is capped. A null, empty or blank page, or one whose
    blocks are all left out, has an empty text and 0 characters. Tags that do not end go,
    text that follows an element which is never closed stays. The time grows with
    the page's length, however its elements nest. Null ids and urls stay, rows
    that repeat are extracted one by one, an empty table gives an empty result,
    and further columns are not read.
    """
    return pages.select("page_id", "url", "html").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
