"""Main text of web pages by tree scoring.

Each paragraph passes points for its length and commas to its ancestors, half as many at each step up. A container's points
are discounted by the share of its text that is in links. The best container and those of its siblings that read
like it are kept.

Elements that never hold an article, and elements with a class, id or role of things beside an article, are left out first.
Such a name says nothing on an element that wraps the article itself, as in ``class="page has-sidebar"``. Elements that are not
displayed (``hidden``, ``display: none``) and what stands in for media go too.
All passes over a page's elements are linear in them, however deep they are.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from geoledger.llm.words import raw

_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("hr".split())
#: Elements that never hold an article's text.
_NEVER = frozenset("nav footer aside menu dialog fieldset".split())
#: Words in class, id or role that mark what isn't the article: parts of a page, which may name its layout too, and things put in.
_PARTS = frozenset(
    "footer foot masthead nav navigation navbar menu breadcrumb breadcrumbs sidebar side aside complementary contentinfo widget"
    " related recommended share sharing social login signin signup search pagination pager toolbar copyright legal disclaimer form".split()
)
_INSERTS = frozenset(
    "ad ads advert advertisement advertisements adverts advertising banner sponsor sponsored promo promotion comment comments disqus reply replies"
    " respond cookie cookies consent notice notices alert popup modal overlay newsletter subscribe subscription".split()
)
_OUTER_PARTS = frozenset(["header", "head", "top", "topbar"])
#: Words before a mark that make it say what a wrapper has; words that name wrappers.
_HAS = frozenset("has have with without no hide show".split())
_WRAPPERS = frozenset("page site wrapper wrap layout container content app root body main columns row grid post entry article".split())
_ITEMS = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "td": ("tr", "table"), "th": ("tr", "table"), "tr": ("table",)}
_SAME_LEVEL = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))",
    re.S | re.I,
)
#: Elements whose content is no markup; elements whose content isn't the page's text; of them those that ``/>`` closes.
_RAW = frozenset("script style title textarea iframe".split())
_HIDDEN = frozenset("noscript template select button svg object annotation video audio canvas".split())
#: Elements within a block that are left out if they are marked as put in, or not displayed.
_INLINE = frozenset("span ins a small b i em strong font label cite u s mark".split())
_FOREIGN = frozenset("svg math".split())
#: Elements within svg or math that hold markup of the page; elements that the end of a block outside doesn't close.
_ISLANDS, _BARRIERS = frozenset(["foreignobject", "annotation-xml"]), frozenset(["template", "object"])
#: Blocks that end an svg or math they are in.
_BREAK_OUT = frozenset("blockquote body center dd div dl dt h1 h2 h3 h4 h5 h6 head hr li menu ol p pre table ul".split())
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|\Z)", re.I) for tag in _RAW}
_CLOSED = re.compile(r"(?:^|[\s\"'])/\s*>\Z")


def _tags(source: str) -> list[tuple[int, int, str, str, str]]:
    """(start, end, slash, name, attributes) of the tags outside hidden elements; what is to be left out has an empty name.

    A hidden element goes from its start to its own end, or for svg to the block that breaks out of it. One that
    is never closed, or not before the block around it, hides nothing.
    """
    tags: list[tuple[int, int, str, str, str]] = []
    hidden: list[tuple[int, int]] = []
    opened: list[tuple[str, int]] = []
    # Places in ``opened``: by name, of svg and math and islands in them, of barriers.
    places: dict[str, list[int]] = {}
    foreign: list[int] = []
    barriers: list[int] = []
    marked: list[tuple[str, int]] = []  # inline elements to be left out, and those of the same name in them (start -1)

    def cut(k: int) -> None:
        for name, _ in opened[k:]:
            places[name].pop()
        del opened[k:]
        for kind in (foreign, barriers):
            while kind and kind[-1] >= k:
                kind.pop()

    at = 0
    while m := _TOKEN.search(source, at):
        start, at, slash, name, more = m.start(), m.end(), m[1], (m[2] or "").lower(), m[3]
        inside = bool(foreign) and opened[foreign[-1]][0] in _FOREIGN
        if name in _RAW:
            if not slash and not (inside and _CLOSED.search(more)):
                end = _RAW_END[name].search(source, at)
                at = end.end() if end else len(source)
            name = ""
        elif name in _INLINE:
            if slash and marked and any(n == name for n, _ in marked):
                k = max(k for k, (n, _) in enumerate(marked) if n == name)
                if marked[k][1] >= 0:
                    hidden.append((marked[k][1], at))
                del marked[k:]
            elif not slash and not inside and len(marked) < _MARKED:
                if more != ">" and _is_put_in(more):
                    marked.append((name, start))
                elif any(n == name for n, _ in marked):
                    marked.append((name, -1))
        elif slash and (name in _HIDDEN or name in _FOREIGN or name in _ISLANDS or name in _BLOCKS):
            k = places[name][-1] if places.get(name) else -1
            if k >= 0 and not (name in _BLOCKS and barriers and barriers[-1] > k):
                if name in _HIDDEN:
                    hidden.append((opened[k][1], at))
                cut(k)
            if name in _BLOCKS:
                marked.clear()
        elif name:
            if name in _BLOCKS:
                marked.clear()
            if inside and name in _BREAK_OUT:
                while foreign and opened[foreign[-1]][0] in _FOREIGN:
                    if opened[foreign[-1]][0] in _HIDDEN:
                        hidden.append((opened[foreign[-1]][1], start))
                    cut(foreign[-1])
            if (name in _HIDDEN and (name != "annotation" or inside) or name in _FOREIGN or name in _ISLANDS and foreign or name in _BLOCKS and name not in _VOID) and not ((name in _FOREIGN or inside) and _CLOSED.search(more)):
                if name in _FOREIGN or name in _ISLANDS:
                    foreign.append(len(opened))
                if name in _BARRIERS:
                    barriers.append(len(opened))
                places.setdefault(name, []).append(len(opened))
                opened.append((name, start))
        tags.append((start, at, slash or "", name, more or ""))
    if not hidden:
        return tags
    out, end, k = [], 0, 0
    hidden.sort()
    for tag in tags:
        while k < len(hidden) and hidden[k][0] <= tag[0]:
            if hidden[k][1] > end:
                out.append((max(hidden[k][0], end), hidden[k][1], "", "", ""))
                end = hidden[k][1]
            k += 1
        if tag[0] >= end:
            out.append(tag)
    return out


#: Marked inline elements within each other.
_MARKED = 64
_UNSEEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/>])|(?:^|\s)style\s*=\s*(?:"[^"]*|'[^']*|[^\s>]*)display\s*:\s*none""", re.I)
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_PLAIN, _PART_OF_PAGE, _WRAPPER_WITH_PARTS, _INSERT, _WRAPPER_WITH_INSERTS = range(5)


def _is_put_in(attributes: str) -> bool:
    """Whether an inline element is an advert, a notice or the like, or not displayed."""
    if _UNSEEN.search(attributes):
        return True
    return any(_names(p) & _INSERTS for m in _NAMED.finditer(attributes) for p in _PART.findall(m[1]))


#: What names of comments and adverts are put together with, and words that say nothing in a name.
_COMPOUND = re.compile(r"(?:user|reader|post|article|page|fb)?(comment|advert|sponsor|newsletter|cookie|sidebar|breadcrumb|navbar|footer|popup)s?(?:list|box|form|section|area|thread|body|wrap|wrapper|holder|bar|item|content|container|count|link|note|text)?s?")
_PLAIN_WORDS = frozenset("list box links link widget container wrap wrapper bar area section block icon icons button buttons media inner outer group items item top bottom left right main primary secondary js row col".split())


def _names(part: str) -> set[str]:
    """A word of a name, and what it is a compound of."""
    m = _COMPOUND.fullmatch(part.lower())
    return {part.lower(), m[1]} if m else {part.lower()}


def _mark(tag: str, attributes: str, inside: bool) -> int:
    """What an element's tag and names say of it."""
    if tag in ("html", "body", "article", "main"):
        return _PLAIN
    if _UNSEEN.search(attributes):
        return _INSERT
    named, words = [], set()
    for m in _NAMED.finditer(attributes):
        for name in m[1].strip("\"'").split() if inside else [m[1]]:
            parts = [p.lower() for p in _PART.findall(name)]
            fit = [_names(w) for k, w in enumerate(parts) if not (k and parts[k - 1] in _HAS)]
            found = set().union(*fit)
            # In an article a name of a part of a page says so only if all of its words do: not "social-science".
            if inside and not all(w & (_PARTS | _INSERTS | _PLAIN_WORDS | _WRAPPERS | _HAS) for w in fit):
                found &= _INSERTS
            named += found
            words.update(parts)
    marks = set(named)
    if marks & _INSERTS:
        return _WRAPPER_WITH_INSERTS if words & _WRAPPERS else _INSERT
    if marks & _PARTS or tag == "form" or not inside and (marks & _OUTER_PARTS or tag == "header"):
        return _WRAPPER_WITH_PARTS if words & _WRAPPERS else _PART_OF_PAGE
    return _PLAIN


class _Page:
    """The page's containers as a tree of numbers, each above those it holds, and its blocks of text in order."""

    def __init__(self, source: str):
        self.parent, self.tag, self.inside, self.mark, self.never = [-1], ["#root"], [False], [_PLAIN], [False]
        self.blocks: list[tuple[int, str, int, int]] = []  # container, text, characters in links, links
        self._open, self._places = [0], {}
        self._text, self._link, self._linked, self._links = [], 0, [], 0
        at = 0
        for start, end, slash, name, more in _tags(source):
            if start > at:
                self._more(source[at:start])
            at = end
            if name:
                (self._end if slash else self._start)(name, more)
        self._more(source[at:])
        self._flush()
        self._leave_out()

    def _more(self, text: str) -> None:
        self._text.append(text)
        if self._link:
            self._linked.append(text)

    def _flush(self) -> None:
        node = self._open[-1]
        if self._text and not self.never[node]:
            text = " ".join(html.unescape("".join(self._text)).split())
            if text:
                self.blocks.append((node, text, len(" ".join(html.unescape("".join(self._linked)).split())), self._links))
        self._text, self._linked, self._links = [], [], 0

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "a":
            self._link, self._links = 1, self._links + 1
        elif tag == "br":
            self._more(" ")
        if tag not in _BLOCKS:
            return
        self._flush()
        self._link = 0
        if self.tag[self._open[-1]] == "p" or self.tag[self._open[-1]] in _HEADINGS and tag in _HEADINGS:
            self._cut(len(self._open) - 1)
        if tag in _ITEMS:
            self._close(_SAME_LEVEL.get(tag, (tag,)), _ITEMS[tag])
        if tag in _VOID:
            return
        above = self._open[-1]
        self.parent.append(above)
        self.tag.append(tag)
        self.inside.append(self.inside[above] or tag in ("article", "main"))
        self.mark.append(_mark(tag, attributes, self.inside[above]))
        self.never.append(self.never[above] or tag in _NEVER)
        self._places.setdefault(tag, []).append(len(self._open))
        self._open.append(len(self.tag) - 1)

    def _cut(self, k: int) -> None:
        while len(self._open) > k:
            self._places[self.tag[self._open.pop()]].pop()

    def _close(self, tags: tuple, stops: tuple) -> None:
        """Close the innermost open element of ``tags``, and all in it, if no element of ``stops`` is between."""
        last, stop = (max((self._places[t][-1] for t in names if self._places.get(t)), default=0) for names in (tags, stops))
        if last > stop:
            self._cut(last)

    def _end(self, tag: str, _: str) -> None:
        if tag == "a":
            self._link = 0
        if tag in _BLOCKS:
            self._flush()
            self._close((tag,), ())

    def _leave_out(self) -> None:
        """Drop the blocks of marked elements. A mark on what wraps the article doesn't count:

        an element that holds an ``article`` or ``main``; one named as a wrapper, with an ``h1`` or within an article, and that
        marks parts of a page, if it has more text than all that no mark covers; and one named as a wrapper, if no mark leaves
        any text. Marks within it count as before. Text in links isn't counted.
        """
        n = len(self.tag)
        plain, holds, title = [0] * n, [False] * n, [t == "h1" for t in self.tag]
        for node, text, in_links, _ in self.blocks:
            plain[node] += len(text) - in_links
        for node in range(n - 1, 0, -1):
            up = self.parent[node]
            if not self.mark[node]:
                plain[up] += plain[node]
            holds[up] |= holds[node] or self.tag[node] in ("article", "main")
            title[up] |= title[node]
        off, total = [False] * n, plain[0]
        for node in range(1, n):
            if off[self.parent[node]]:
                off[node] = True
            elif self.mark[node]:
                mark = self.mark[node]
                named = mark in (_WRAPPER_WITH_PARTS, _WRAPPER_WITH_INSERTS)
                larger = plain[node] > total and mark in (_PART_OF_PAGE, _WRAPPER_WITH_PARTS) and (named or title[node] or self.inside[node] and self.tag[node] != "form" or self.tag[node] == "form" and not total)
                if holds[node] or larger or named and not total:
                    total += plain[node]
                else:
                    off[node] = True
        self.blocks = [b for b in self.blocks if not off[b[0]]]


#: Elements that are a paragraph of their container rather than a container, unless they hold other blocks.
_OWN = frozenset("p li dt dd td th pre".split()) | _HEADINGS


def _scores(page: _Page) -> tuple[list[float], list[int], list[int], list[int]]:
    """By container: points after the discount for links; characters, of them in links, and links of all it holds."""
    n = len(page.tag)
    own, points, chars, linked, links = [0.0] * n, [0.0] * n, [0] * n, [0] * n, [0] * n
    for node, text, in_links, some in page.blocks:
        own[node] += 1 + text.count(",") + text.count("、") + min(len(text) / 100, 3)
        chars[node], linked[node], links[node] = chars[node] + len(text), linked[node] + in_links, links[node] + some
    for node in range(n - 1, -1, -1):
        passed = points[node] / 2
        if page.tag[node] in _OWN:
            passed += own[node]
        else:
            points[node] += own[node]
            passed += own[node] / 2
        up = page.parent[node]
        if up >= 0:
            points[up] += passed
            chars[up], linked[up], links[up] = chars[up] + chars[node], linked[up] + linked[node], links[up] + links[node]
    for node in range(n):
        if page.tag[node] in _HEADINGS or not points[node]:
            points[node] = 0.0
            continue
        if page.tag[node] in ("article", "main"):
            points[node] += 25
        points[node] *= 1 - linked[node] / max(1, chars[node])
    return points, chars, linked, links


def main_text(source: str | None) -> str:
    """The article's blocks joined by newlines; empty if there is none. Null is as empty."""
    if not source:
        return ""
    page = _Page(source)
    if not page.blocks:
        return ""
    points, chars, linked, links = _scores(page)
    best = max(range(len(points)), key=lambda n: (points[n], -n))
    if not points[best]:
        return "\n".join(text for _, text, in_links, _ in page.blocks if 2 * in_links < len(text))
    home, least = page.parent[best], max(10, 0.2 * points[best])
    kept = [False] * len(points)
    for node in range(len(points)):
        up, tag = page.parent[node], page.tag[node]
        if node != best and links[node] > 2 and linked[node] > 0.6 * chars[node] and not page.inside[node] and tag in ("ul", "ol", "div", "table", "section"):
            continue  # a list of links that isn't in an article: a menu
        sibling = up == home and home >= 0 and (tag == "h1" or points[node] >= least or tag == "p" and chars[node] > 80 and 4 * linked[node] < chars[node])
        kept[node] = node == best or sibling or up >= 0 and kept[up]
    return "\n".join(text for node, text, _, _ in page.blocks if kept[node])


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with its html column replaced by the main text in ``text_col`` and its code points in ``n_chars``.

    Null and empty pages, and pages without an article, get an empty text; bytes that are no UTF-8 are read as U+FFFD.
    Other columns stay (save ones named as the two new ones), rows too, repeated ones as well.
    """
    rest = [f for f in pages.schema if f.name not in (html_col, text_col, "n_chars")]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x.decode(errors="replace") if x else None) for x in b.column(0).to_pylist()]
            columns = [*b.columns[1:], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*[f.name for f in rest], text_col, "n_chars"])

    from pyspark.sql.types import LongType, StringType, StructField, StructType

    schema = StructType([*rest, StructField(text_col, StringType(), False), StructField("n_chars", LongType(), False)])
    return raw(pages, html_col, [f.name for f in rest]).mapInArrow(each, schema)
