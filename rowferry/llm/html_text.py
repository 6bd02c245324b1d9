"""HTML to text as a page is laid out.

A tree builder with implied tags (a paragraph ends where a block starts, an item where the
next one starts, cells and rows likewise, whatever the page forgot to close) makes the
tree; rules of visibility drop what a browser does not show (scripts, styles, templates,
``hidden``, ``display:none``, ``visibility:hidden``, hidden inputs, closed details but for
their summary); a renderer gives all the rest: blocks on lines of their own, an empty line
around paragraphs, lists with markers and indents, tables with aligned columns, ``pre`` as
it is. Nothing else is left out: navigation and advertisements are visible text.

Formulas (MathML) give the text of their tokens and drawings (SVG) that of their ``text``
elements, without titles, annotations and definitions.

Pages are independent rows: no shuffle, memory of one page. Nesting is followed however
deep it is: the tree is built and rendered with stacks of their own, without recursion.

Defined cases: a null page gives null, an empty one the empty text; broken tags are text;
very long pages cost in proportion; repeated rows are rendered alike; an empty table gives an empty result; all other
columns ride along in ``carry``.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Generator, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.llm.common import ship

_TAG = re.compile(
    r"<!--(?:.*?-->|.*)|<!\[CDATA\[(?:.*?\]\]>|.*)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>", re.S
)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")

# fixed values of the HTML standard
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
UNSEEN = set("script style title head template noscript iframe noembed noframes datalist object audio video canvas".split())
PARAGRAPH = set("p ul ol dl table blockquote pre h1 h2 h3 h4 h5 h6 figure fieldset hr article section".split())
BLOCK = PARAGRAPH | set(
    "address aside body center caption dd details dialog dir div dt figcaption footer form header hgroup html legend li main menu nav"
    " optgroup option search select summary tbody td tfoot th thead tr".split()
)
# a start tag ends open elements of these names, up to a boundary
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
CLOSES_P = (BLOCK | {"p"}) - {"body", "html", "option", "optgroup", "select", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
# elements within svg and math: not shown, holding text, holding HTML
DRAWN_UNSEEN = set("title desc metadata defs symbol clippath mask marker pattern annotation annotation-xml mphantom".split())
TOKENS = {"mi", "mn", "mo", "ms", "mtext"}
INNER_HTML = TOKENS | {"foreignobject", "desc", "title", "annotation-xml"}
FOREIGN = {"svg", "math"}
# a start tag of these ends svg and math
BREAKS_OUT = set(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small"
    " span strong strike sub sup table tt u ul var".split()
)
_CLOSED = re.compile(r"(?:^|[\s\"'])/$|(?:^|\s)[^\s=\"'>/]+/$")
SCOPE = {"table", "td", "th", "caption", "html", "template", "button"}
INLINE_STOP = BLOCK | SCOPE


class Node:
    __slots__ = ("tag", "attrs", "items")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.items = tag, attrs, []


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    if text and not text.isspace():
        for name, value in _ATTR.findall(text):
            if value[:1] in "\"'":
                value = value[1:-1]
            out.setdefault(name.lower(), html.unescape(value))
    return out


def parse(page: str) -> Node:
    """The tree of a page, with the tags it implies."""
    root = Node("#root", {})
    stack, at, end = [root], 0, len(page)
    places: dict[str, list[int]] = {}  # of the open elements of each name in the stack

    def add(item) -> None:
        stack[-1].items.append(item)

    def push(node: Node) -> None:
        places.setdefault(node.tag, []).append(len(stack))
        stack.append(node)

    def cut(size: int) -> None:
        while len(stack) > size:
            tag = stack.pop().tag
            places[tag].pop()
            if not places[tag]:
                del places[tag]

    def last(names: set[str]) -> int:
        """The place of the innermost open element of these names, or 0."""
        if len(names) > len(places):
            return max((at[-1] for tag, at in places.items() if tag in names), default=0)
        return max((places[tag][-1] for tag in names if tag in places), default=0)

    def close(names: set[str], stop: set[str]) -> None:
        i = last(names)
        if i and i >= last(stop):
            cut(i)

    while at < end:
        start = page.find("<", at)
        if start < 0:
            add(html.unescape(page[at:]))
            break
        if start > at:
            add(html.unescape(page[at:start]))
        m = _TAG.match(page, start)
        if not m:
            add("<")
            at = start + 1
            continue
        at = m.end()
        name = m.group(2)
        if name is None:
            if page.startswith("<![CDATA[", start):
                add(page[start + 9 : at].removesuffix("]]>"))
            continue
        name = name.lower()
        if m.group(1):
            if name == "p" and "p" not in places:
                add(Node("p", {}))
            elif name == "br":
                add(Node("br", {}))
            else:
                # the end of an inline element leaves open blocks open
                close({name}, {"table"} - {name} if name in BLOCK else INLINE_STOP)
            continue
        foreign = last(FOREIGN) if "svg" in places or "math" in places else 0
        if foreign and name in BREAKS_OUT and last(INNER_HTML) < foreign:
            cut(foreign)
            foreign = 0
        if name == "a":  # links do not nest
            close({"a"}, INLINE_STOP)
        if name in CLOSES_P:
            close({"p"}, SCOPE)
        if name in ENDS:
            names, stop = ENDS[name]
            for _ in range(3 if name in ("tr", "tbody", "thead", "tfoot") else 1):
                close(names, stop)
        if name[0] == "h" and name[1:].isdigit() and stack[-1].tag[0] == "h" and stack[-1].tag[1:].isdigit():
            cut(len(stack) - 1)
        if name in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            row = Node("tr", {})
            add(row)
            push(row)
        node = Node(name, _attributes(m.group(3)))
        add(node)
        if name in VOID or ((foreign or name in FOREIGN) and _CLOSED.search(m.group(3))):
            continue
        if name in RAW:
            tail = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            body = page[at : tail.start()] if tail else page[at:]
            node.items.append(html.unescape(body) if name == "textarea" else body)
            at = tail.end() if tail else end
        else:
            push(node)
    return root


def visible(node: Node) -> bool:
    if node.tag in UNSEEN:
        return False
    a = node.attrs
    if not a:
        return True
    if "hidden" in a or (node.tag == "input" and a.get("type", "").lower() == "hidden"):
        return False
    return not ("style" in a and _HIDING.search(a["style"]))


def _width(text: str) -> int:
    """Columns on a screen: wide characters take two, combining marks none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Writer:
    """Lines, with the empty ones that blocks ask for held back until text follows."""

    def __init__(self, item: bool = False):
        self.item = item  # of a list: lists in it keep no distance
        self.lines: list[str] = []
        self.line = ""
        self.gap = 0

    def text(self, s: str) -> None:
        """Text in flow: white space collapses, also across elements."""
        s = _SPACE.sub(" ", s)
        if not self.line or self.line[-1] in " \n":
            s = s.lstrip(" ")
        if s:
            self._open()
            self.line += s

    def _open(self) -> None:
        if not self.line:
            if self.lines:
                self.lines += [""] * self.gap
            self.gap = 0

    def newline(self) -> None:
        """End the line, if there is one."""
        if self.line:
            self.lines.append(self.line.rstrip(" "))
            self.line = ""

    def hard(self) -> None:
        """A line break that was asked for."""
        if self.line:
            self.newline()
        elif self.lines:
            self.gap = max(self.gap, 1)

    def block(self, gap: int) -> None:
        self.newline()
        self.gap = max(self.gap, gap)

    def verbatim(self, lines: list[str]) -> None:
        self.newline()
        if lines:
            self._open()
            self.lines += lines

    def done(self) -> list[str]:
        self.newline()
        return self.lines


# The parts of the renderer are generators that yield the parts they need, and are sent their results.
Part = Generator["Part", Any, Any]


def _whole(part: Part) -> Any:
    """The result of a part, however deep its parts go."""
    stack, value = [part], None
    while stack:
        try:
            stack.append(stack[-1].send(value))
            value = None
        except StopIteration as end:
            stack.pop()
            value = end.value
    return value


def _lines(items: list, item: bool = False) -> Part:
    w = Writer(item)
    yield _flow(items, w)
    return w.done()


def _pre(items: list) -> str:
    out, todo = [], [iter(items)]
    while todo:
        item = next(todo[-1], None)
        if item is None:
            todo.pop()
        elif isinstance(item, str):
            out.append(item)
        elif item.tag == "br":
            out.append("\n")
        elif visible(item):
            todo.append(iter(item.items))
    return "".join(out)


def _drawn(node: Node, w: Writer, shown: bool) -> Part:
    """What is written in a drawing or a formula; ``shown``: bare text is."""
    for item in node.items:
        if isinstance(item, str):
            if shown and (node.tag != "math" or item.strip()):
                w.text(item if node.tag not in TOKENS else item.strip())
        elif not visible(item) or item.tag in DRAWN_UNSEEN or item.attrs.get("display") == "none" or item.attrs.get("visibility") in ("hidden", "collapse"):
            continue
        elif item.tag in ("foreignobject", "text"):
            w.text(" ")
            yield _flow(item.items, w) if item.tag == "foreignobject" else _drawn(item, w, True)
            w.text(" ")
        elif item.tag == "br" or item.tag in BLOCK or item.tag in FOREIGN:
            yield _flow([item], w)
        else:
            yield _drawn(item, w, shown and node.tag != "math" or item.tag in TOKENS)


def _indent(lines: list[str], first: str) -> list[str]:
    rest = " " * _width(first)
    return [(first if i == 0 else rest) + x if x or i == 0 else "" for i, x in enumerate(lines)]


def _list(node: Node, w: Writer) -> Part:
    number = int(node.attrs["start"]) if node.attrs.get("start", "").lstrip("-").isdecimal() else 1
    for item in node.items:
        if isinstance(item, str):
            if item.strip():
                w.block(0)
                w.text(item)
        elif visible(item):
            if item.tag == "li":
                if node.tag == "ol" and item.attrs.get("value", "").lstrip("-").isdecimal():
                    number = int(item.attrs["value"])
                mark = f"{number}. " if node.tag == "ol" else "- "
                number += 1
                w.verbatim([x.rstrip() for x in _indent((yield _lines(item.items, True)) or [""], mark)])
            else:
                yield _flow([item], w)


def _rows(node: Node, rows: list, before: list) -> None:
    todo = [iter(node.items)]
    while todo:
        item = next(todo[-1], None)
        if item is None:
            todo.pop()
        elif isinstance(item, str):
            if item.strip():
                before.append(item)
        elif not visible(item):
            continue
        elif item.tag == "tr":
            rows.append([c for c in item.items if (isinstance(c, str) and c.strip()) or (isinstance(c, Node) and visible(c))])
        elif item.tag in ("tbody", "thead", "tfoot"):
            todo.append(iter(item.items))
        elif item.tag not in ("col", "colgroup"):
            before.append(item)


def _span(cell, name: str) -> int:
    value = cell.attrs.get(name, "") if isinstance(cell, Node) else ""
    return min(1000, max(1, int(value))) if value.isdecimal() and value.isascii() else 1


def _table(node: Node, w: Writer) -> Part:
    rows, before = [], []
    _rows(node, rows, before)
    for item in before:  # captions, and what stands between the rows, come first
        yield _flow([item], w)
        w.newline()
    grid: list[dict[int, list[str]]] = []
    spans: list[dict[int, int]] = []
    below: dict[int, int] = {}  # columns that a cell above still fills
    for cells in rows:
        at, line, span, fill = 0, {}, {}, {}
        for cell in cells:
            while below.get(at, 0):
                at += 1
            wide = _span(cell, "colspan")
            line[at] = yield _lines(cell.items if isinstance(cell, Node) and cell.tag in ("td", "th") else [cell])
            span[at] = wide
            for c in range(at, at + wide):
                if (tall := _span(cell, "rowspan")) > 1:
                    fill[c] = tall
            at += wide
        below = {c: n - 1 for c, n in below.items() if n > 1} | {c: n - 1 for c, n in fill.items() if n > 1}
        grid.append(line)
        spans.append(span)
    widths: dict[int, int] = {}
    for line, span in zip(grid, spans, strict=True):
        for c, lines in line.items():
            if span[c] == 1:
                widths[c] = max(widths.get(c, 0), max(map(_width, lines), default=0))
    for line, span in zip(grid, spans, strict=True):  # the last column of a span takes what is left of its text
        for c, lines in line.items():
            if span[c] > 1:
                have = sum(widths.get(i, 0) for i in range(c, c + span[c])) + 2 * (span[c] - 1)
                end = c + span[c] - 1
                widths[end] = widths.get(end, 0) + max(0, max(map(_width, lines), default=0) - have)
    out = []
    for line, span in zip(grid, spans, strict=True):
        for k in range(max((len(x) for x in line.values()), default=0)):
            text, place = "", 0
            for c in sorted(line):
                want = sum(widths.get(i, 0) + 2 for i in range(c))
                if text:
                    text += "  "
                    place = _width(text)
                part = line[c][k] if k < len(line[c]) else ""
                if part:
                    text += " " * max(0, want - place) + part
                    place = _width(text)
            out.append(text.rstrip())
    w.verbatim(out)


def _flow(items: list, w: Writer) -> Part:
    for item in items:
        if isinstance(item, str):
            w.text(item)
            continue
        if not visible(item):
            continue
        tag = item.tag
        if tag == "br":
            w.hard()
        elif tag == "wbr" or tag == "img":
            continue
        elif tag == "input":
            if item.attrs.get("type", "").lower() in ("submit", "button", "reset", "text", ""):
                w.text(item.attrs.get("value", ""))
        elif tag in BLOCK:
            gap = 1 if tag in PARAGRAPH and not (w.item and tag in ("ul", "ol")) else 0
            w.block(gap)
            if tag in ("ul", "ol", "menu", "dir"):
                yield _list(item, w)
            elif tag == "table":
                yield _table(item, w)
            elif tag == "pre":
                text = _pre(item.items).replace("\r\n", "\n")
                w.verbatim([x.rstrip() for x in text.removeprefix("\n").rstrip("\n").split("\n")] if text.strip() else [])
            elif tag == "hr":
                w.verbatim(["---"])
            elif tag in ("blockquote", "dd"):
                w.verbatim([x.rstrip() for x in _indent((yield _lines(item.items)), "  ")])
            elif tag == "li":
                w.verbatim([x.rstrip() for x in _indent((yield _lines(item.items)) or [""], "- ")])
            elif tag == "details" and "open" not in item.attrs:
                yield _flow([x for x in item.items if isinstance(x, Node) and x.tag == "summary"], w)
            else:
                yield _flow(item.items, w)
            w.block(gap)
        elif tag in FOREIGN:
            yield _drawn(item, w, tag == "math")
        else:
            if tag == "q":
                w.text("“")
            yield _flow(item.items, w)
            if tag == "q":
                w.text("”")


def render(page: str | None) -> str | None:
    """The visible text of a page."""
    if page is None:
        return None
    lines = _whole(_lines(parse(page.replace("\0", "�")).items))
    return "\n".join(lines)


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        for a in range(0, part.num_rows, 512):
            rows = part.slice(a, 512)
            yield pa.RecordBatch.from_arrays(
                [rows.column("carry"), pa.array([render(p) for p in rows.column("html").to_pylist()], pa.string())], names=["carry", "text"]
            )


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``carry`` (all other columns) and ``text``."""
    ship(pages.sparkSession)
    others = [c for c in pages.columns if c != html_col]
    rows = pages.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("carry"), F.col(html_col).alias("html"))
    return rows.mapInArrow(_run, f"carry {rows.schema['carry'].dataType.simpleString()}, text string")
