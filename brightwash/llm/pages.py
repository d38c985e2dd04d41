"""Main text of HTML pages by smoothed text-to-tag ratios.

The standard library's parser streams the events of a page; a line is the text
of one block element. Each line's ratio of characters to tags is smoothed with
a Gaussian over its neighbours, and the smoothed ratios are clustered into two
by moving a threshold to the middle of the two means until it rests (Weninger,
Hsu and Han's CETR). The lines above it are content and say which region of the
page is kept: the articles that hold such lines if they hold most of the
content text, or else the main element if it does, or else the smallest element
that holds all content lines. Lines of menus, headers, footers, sidebars,
notices, adverts, forms and comments take no part; of the chosen region every
other line is kept, short ones too, but for lists of links on their own. Such
elements are told by their name, or by a class or id if the ratios agree: a
class never takes out an article, nor an element that holds most of the
content text, nor for a part of its name one that holds any. Scripts, buttons
and their like are hidden; one without an end tag hides up to its first block.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, small_batches

SMOOTHING = 1.0  # standard deviation of the Gaussian, in lines
_REACH = 3
_KERNEL = [math.exp(-(k**2) / (2 * SMOOTHING**2)) for k in range(-_REACH, _REACH + 1)]
APART = 4  # factor between the ratios of content and of the rest
TAG_SHARE = 0.8  # of the content lines' text that articles must hold for their tag to decide

# fixed values: elements of HTML by their role
_HIDDEN = {"script", "style", "noscript", "template", "title", "svg", "iframe", "object", "select", "textarea", "button"}
_NO_NESTING = {"button", "select"}  # the start of one ends an open one
_OUTSIDE = {"nav", "footer", "aside", "menu", "dialog"}
_BLOCKS = _OUTSIDE.union(
    ("address article blockquote body caption center dd details div dl dt fieldset figcaption figure form h1 h2 h3 h4 h5 h6 "
    "header hr html li main ol p pre section summary table tbody td tfoot th thead tr ul").split()
)
_CONTAINERS = {"root", "html", "body", "main", "article", "div", "section", "center", "table", "tbody", "tr", "td"}
_VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "source", "area", "base", "col", "embed", "track", "param"}
_BREAKS = {"br", "img"}
_CLOSED_BY_SIBLING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_WORD = (
    r"(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|popup|modal|newsletter|subscribe|"
    r"nav|navbar|navigation|menu|breadcrumbs?|sidebar|side|widget|footer|header|masthead|share|sharing|social|related|recommended|"
    r"comments?|disqus|replies|respond|login|signup|search)"
)
_HINT = re.compile(rf"(?:^|[\s_-]){_WORD}(?:$|[\s_-])")
_TITLES = {"header", "masthead"}  # may hold the title of the text
# name text of another kind, which may be longer than the main text
_OTHER = re.compile(
    r"ads?|advert\w*|adsense|sponsor\w*|cookies?|consent|gdpr|notice|popup|modal|newsletter|subscribe|related|recommended|comments?|"
    r"disqus|replies|respond"
)
# words that leave a hint beside them what it is; others ("no-sidebar", "comments-open") may tell of something else
_PLACE = (
    r"(?:area|article|block|bottom|box|container|entry|inner|left|list|main|page|post|primary|right|secondary|section|site|top|"
    r"user|wrap|wrapper)"
)
_NAMED = re.compile(rf"(?:{_PLACE}[_-])*{_WORD}(?:[_-](?:{_WORD}|{_PLACE}))*")
_ROLE = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu"}


class _Lines(HTMLParser):
    """Collects the lines of a page: text, tags, linked characters, elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, tuple[int, ...], bool]] = []
        self.names: dict[int, str] = {0: "root"}
        self.hiding: dict[int, bool] = {}  # hidden element -> whether a block started in it
        self.closed: set[int] = set()  # hidden elements with an end tag
        self.hinted: dict[int, str] = {}  # element -> weak, strong or other
        self.stack: list[tuple[str, int, bool, bool]] = [("root", 0, False, False)]  # name, number, outside, hidden
        self.parts: list[str] = []
        self.tags = self.linked = self.links = 0

    def _end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            # text directly in a hidden element is not collected: it stands before it
            depth = next((i for i, (_, n, _, _) in enumerate(self.stack) if self.hiding.get(n) is False), len(self.stack))
            path = tuple(number for _, number, _, _ in self.stack[:depth])
            self.lines.append((text, self.tags, self.linked, path, self.stack[depth - 1][2]))
        self.parts.clear()
        self.tags = self.linked = 0

    def _push(self, name: str, outside: bool, hidden: bool, hint: str | None = None) -> None:
        number = len(self.names)
        self.names[number] = name
        if hint:
            self.hinted[number] = hint
        _, _, was_outside, was_hidden = self.stack[-1]
        self.stack.append((name, number, was_outside or outside, was_hidden or hidden))

    def handle_starttag(self, name: str, attrs: list[tuple[str, str | None]]) -> None:
        if name == "head":  # what is hidden in it is so by itself; its end tag may be left out
            return
        if name in _HIDDEN:
            if name in _NO_NESTING:
                at = next((i for i in range(len(self.stack) - 1, 0, -1) if self.stack[i][0] == name), 0)
                if at and self.stack[-1][3]:
                    self._end_line()
                    del self.stack[at:]
            self._push(name, False, True)
            self.hiding[self.stack[-1][1]] = False
            return
        if name not in _BLOCKS:
            self.tags += 1
            if name == "a":
                self.links += 1
            elif name in _BREAKS:
                self.parts.append(" ")
            elif name not in _VOID and any(k in ("class", "id", "role") for k, _ in attrs):
                outside, hint = self._is_outside(name, attrs), self._hint(name, attrs)
                if outside or hint:
                    self._end_line()
                    self._push(name, outside, False, hint)
            return
        self._end_line()
        if self.stack[-1][3]:  # hidden up to here at least; all of it if the end tag comes
            self.hiding.update((n, True) for _, n, _, _ in self.stack if n in self.hiding)
        for open_name in _CLOSED_BY_SIBLING.get(name, ()):
            if self.stack[-1][0] == open_name:
                self.stack.pop()
                break
        if name != "p" and self.stack[-1][0] == "p":  # a block ends an open paragraph
            self.stack.pop()
        if name in ("article", "main"):
            while self.stack[-1][0] in ("nav", "form", "header"):  # never closed
                self.stack.pop()
        self.tags += 1
        if name not in _VOID:
            self._push(name, self._is_outside(name, attrs), False, self._hint(name, attrs))

    def _is_outside(self, name: str, attrs: list[tuple[str, str | None]]) -> bool:
        if name in _OUTSIDE:
            return True
        if name in ("body", "html", "main"):
            return False
        if name == "header":
            return not any(n in ("article", "main") for n, *_ in self.stack)
        given = dict(attrs)
        return given.get("role") in _ROLE or "hidden" in given

    def _hint(self, name: str, attrs: list[tuple[str, str | None]]) -> str | None:
        """What the class and id of an element say of it: nothing, or that it is
        outside by a name of its own (strong; other) or by part of one (weak)."""
        if name == "form":  # some pages are one form
            return "strong"
        if name in ("article", "body", "html", "main"):
            return None
        given = dict(attrs)
        names = f"{given.get('class') or ''} {given.get('id') or ''}".lower()
        if not _HINT.search(names):
            return None
        hinting = [x for x in names.split() if _HINT.search(x)]
        if any(n in ("article", "main") for n, *_ in self.stack):  # as a header there
            hinting = [x for x in hinting if not _TITLES.intersection(re.split("[_-]", x))]
            if not hinting:
                return None
        sure = [w for x in hinting if _NAMED.fullmatch(x) for w in [set(re.split("[_-]", x))] if not w & _TITLES]
        if not sure:
            return "weak"
        return "other" if all(any(map(_OTHER.fullmatch, w)) for w in sure) else "strong"

    def handle_startendtag(self, name: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(name, attrs)
        if name not in _VOID:
            self.handle_endtag(name)

    def handle_endtag(self, name: str) -> None:
        if name == "a":
            self.links = max(0, self.links - 1)
        at = next((i for i in range(len(self.stack) - 1, 0, -1) if self.stack[i][0] == name), 0)
        if at:
            number = self.stack[at][1]
            if self.hiding.get(number, True):
                self._end_line()
            if number in self.hiding:
                self.closed.add(number)
            del self.stack[at:]
        if name in _BLOCKS:
            self._end_line()
        elif name not in _HIDDEN and name != "head":
            self.tags += 1

    def handle_data(self, data: str) -> None:
        if self.stack[-1][3] and not all(self.hiding.get(n, True) for _, n, _, _ in self.stack):
            return
        self.parts.append(data)
        if self.links:
            self.linked += len(data.strip())

    def close(self) -> None:
        super().close()
        self._end_line()
        if self.closed:
            self.lines = [x for x in self.lines if self.closed.isdisjoint(x[3])]


def _smoothed(ratios: list[float]) -> list[float]:
    out = []
    for i in range(len(ratios)):
        total = weight = 0.0
        for k, w in enumerate(_KERNEL, i - _REACH):
            if 0 <= k < len(ratios):
                total += w * ratios[k]
                weight += w
        out.append(total / weight)
    return out


def _threshold(values: list[float]) -> float:
    """Two clusters on a line: the middle of their means."""
    at = sum(values) / len(values)
    for _ in range(100):
        low, high = [v for v in values if v < at], [v for v in values if v >= at]
        if not low or not high:
            return min(values)
        new = (sum(low) / len(low) + sum(high) / len(high)) / 2
        if new == at:
            break
        at = new
    return at


def _content(lines: list[tuple]) -> list[bool]:
    """Which lines are in the upper cluster and not mostly links. Ratios differ
    by factors (a menu's from a paragraph's), so their logarithms are clustered;
    clusters that are not ``APART`` are one."""
    smooth = [math.log(x) for x in _smoothed([len(text) / max(1, tags) for text, tags, _, _, _ in lines])]
    least = _threshold(smooth)
    low, high = [s for s in smooth if s < least], [s for s in smooth if s >= least]
    if low and sum(high) / len(high) - sum(low) / len(low) < math.log(APART):
        least = min(low)
    return [s >= least and 2 * linked <= len(text) for s, (text, _, linked, _, _) in zip(smooth, lines)]


def _taken_out(parser: _Lines, lines: list[tuple]) -> set[int]:
    """The elements that a hint takes out: by part of a name only those without
    content lines, by a name of their own those that hold at most half of the
    content text, or for text of another kind also those outside which there
    are content lines, an article or a main element."""
    named = {n for n, hint in parser.hinted.items() if hint != "weak"}
    held: Counter = Counter()
    beside = False
    for (text, _, _, path, outside), content in zip(lines, _content(lines)):
        if outside:
            continue
        if content:
            for n in path:
                held[n] += len(text)
        if not beside and (content or any(parser.names[n] in ("article", "main") for n in path)):
            beside = named.isdisjoint(path)
    gone = set()
    for n, hint in parser.hinted.items():
        stays = held[n] if hint == "weak" else 2 * held[n] > held[0] and not (hint == "other" and beside)
        if not stays:
            gone.add(n)
    return gone


def main_text(html: str | None) -> str:
    """The main text of one page, blocks joined by an empty line."""
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    gone = _taken_out(parser, parser.lines) if parser.hinted and parser.lines else set()
    lines = [x for x in parser.lines if not x[4] and not gone.intersection(x[3])]
    if not lines:
        return ""
    # the rest of the page is what the content differs from, taken out or not
    content = [x for x, c in zip(parser.lines, _content(parser.lines)) if c and not x[4] and gone.isdisjoint(x[3])] or lines
    whole = sum(len(text) for text, *_ in content)
    for wanted in ("article", "main"):
        # the outermost element of the name that a content line is in
        inside = [next((n for n in path if parser.names[n] == wanted), None) for _, _, _, path, _ in content]
        chosen = set(inside) - {None}
        if sum(len(x[0]) for x, n in zip(content, inside) if n is not None) >= TAG_SHARE * whole:
            return "\n\n".join(text for text, _, _, path, _ in lines if chosen.intersection(path))
    shared = content[0][3]
    for _, _, _, path, _ in content:
        shared = shared[: next((i for i, (a, b) in enumerate(zip(shared, path)) if a != b), min(len(shared), len(path)))]
    region = next(n for n in reversed(shared) if parser.names[n] in _CONTAINERS)
    # links beside content lines are the text's own; others are menus
    holders = {_holder(parser, x[3]) for x in content}
    return "\n\n".join(
        text
        for text, _, linked, path, _ in lines
        if region in path and (2 * linked <= len(text) or _holder(parser, path) in holders and not _is_page_list(parser, path))
    )


def _holder(parser: _Lines, path: tuple[int, ...]) -> int:
    """The innermost container of a line."""
    return next(n for n in reversed(path) if parser.names[n] in _CONTAINERS)


def _is_page_list(parser: _Lines, path: tuple[int, ...]) -> bool:
    """Whether a line is in a list that is not in any part of the page."""
    names = [parser.names[n] for n in path]
    return bool({"ul", "ol", "dl"}.intersection(names)) and not {"div", "section", "article", "main", "td"}.intersection(names)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with its columns but the html, and text, n_chars.

    Null and empty html give an empty text, as does a page without visible
    lines. Repeated rows give equal results. Columns named text or n_chars are
    replaced.
    """
    small_batches(pages.sparkSession)
    kept = [c for c in pages.columns if c not in (html_col, "text", "n_chars", "__html")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__html"):
            texts = [main_text(h) for h in part.column(len(kept)).to_pylist()]
            columns = [*part.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*part.schema.names[:-1], "text", "n_chars"])

    rows = pages.select(*[pages[c] for c in kept], F.col(html_col).cast("string").alias("__html"))
    schema = pages.select(*[pages[c] for c in kept]).schema.add("text", "string").add("n_chars", "long")
    return rows.mapInArrow(work, schema)
