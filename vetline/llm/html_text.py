"""HTML extraction: a tree builder and a layout-aware rendering of all visible text.

The builder follows HTML's rules where they matter for text: void elements,
tags that imply the end of others (paragraphs, list items, table parts,
options), end tags without a start, raw text. The renderer walks the tree with
a stack of its own (any nesting depth) and writes what a reader would see:

* white space collapses except in ``pre`` and ``textarea``;
* blocks start on a new line, and blocks with margins are set off by one blank
  line, however many margins meet;
* list items carry a bullet or their number and are indented by its width;
* table cells are aligned in columns two spaces apart, with row and column
  spans; cells may hold several lines, lists and tables.

Not visible: comments, head, scripts, styles, templates, embedded media
fallbacks, elements marked ``hidden`` or styled ``display:none`` or
``visibility:hidden``, hidden inputs, and closed ``details`` and ``dialog``.

Each page is rendered by itself inside Arrow batches; nothing is shuffled.
Defined cases: a null page has null text, an empty one the empty text; broken
markup never fails, and what cannot be a tag is text. Tags take time that does
not depend on how deep they stand. Other columns pass through; if one has the
result's name, the result's gets underscores in front.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetline.llm.frames import fresh

# Fixed values of the HTML standard: element names by their part in parsing and layout.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript plaintext".split())
RCDATA = frozenset(("title", "textarea"))
UNSEEN = frozenset("head script style template title noscript noembed noframes iframe object audio video canvas datalist svg math "
                   "colgroup area base link meta param source track".split())
MARGIN = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir table blockquote pre figure hr fieldset listing plaintext xmp".split())
BLOCK = MARGIN | frozenset("html body address article aside center dd details dialog div dt figcaption footer form header hgroup legend li "
                           "main nav option optgroup search section summary caption tbody thead tfoot tr td th".split())
#: Starting one of these ends an open paragraph.
ENDS_P = (BLOCK - frozenset("html body option optgroup tbody thead tfoot tr td th caption legend".split()))
TABLE_SCOPE = frozenset(("table", "template", "html"))
#: For each tag, the open tags that it ends, and the tags beyond which it does not look.
IMPLIED_ENDS = {
    "li": (frozenset(("li",)), frozenset("ul ol menu dir table td th".split())),
    "dt": (frozenset(("dt", "dd")), frozenset("dl table td th".split())),
    "dd": (frozenset(("dt", "dd")), frozenset("dl table td th".split())),
    "option": (frozenset(("option",)), frozenset("select datalist optgroup".split())),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",))),
    "td": (frozenset(("td", "th")), frozenset("tr table".split())),
    "th": (frozenset(("td", "th")), frozenset("tr table".split())),
    "tr": (frozenset(("tr", "td", "th", "caption")), frozenset("tbody thead tfoot table".split())),
    "tbody": (frozenset("tbody thead tfoot tr td th caption colgroup".split()), frozenset(("table",))),
}
IMPLIED_ENDS["thead"] = IMPLIED_ENDS["tfoot"] = IMPLIED_ENDS["caption"] = IMPLIED_ENDS["colgroup"] = IMPLIED_ENDS["tbody"]

_MARKUP = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|</[^a-zA-Z][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_HIDDEN_STYLE = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.I)
_SPACE = re.compile(r"[ \t\n\f\r]+")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str] | None = None):
        self.tag, self.attributes, self.children = tag, attributes or {}, []


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(source):
        found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return found


def build(page: str) -> Node:
    """The element tree of a page; children are nodes and strings."""
    root = Node("html")
    stack = [root]
    #: Places in the stack of the open elements of each tag, and of all blocks: what a tag ends is looked up, not searched for.
    places: dict[str, list[int]] = {}
    blocks: list[int] = []

    def last(tags) -> int:
        """Place of the innermost open element of these tags, 0 (the root's) without any."""
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def push(node: Node) -> None:
        places.setdefault(node.tag, []).append(len(stack))
        if node.tag in BLOCK:
            blocks.append(len(stack))
        stack.append(node)

    def cut(at: int) -> None:
        """End the open elements from place ``at`` on."""
        while len(stack) > at:
            tag = stack.pop().tag
            places[tag].pop()
            if tag in BLOCK:
                blocks.pop()

    def close(ends: frozenset, limits: frozenset) -> None:
        """End the open elements down to the outermost of ``ends`` inside ``limits``."""
        if last(ends) > (limit := last(limits)):
            cut(min(own[k] for t in ends if (own := places.get(t)) and (k := bisect_right(own, limit)) < len(own)))

    def text(value: str) -> None:
        if value:
            if stack[-1].tag == "head" and value.strip():
                cut(len(stack) - 1)  # text begins without an end of the head
            stack[-1].children.append(html.unescape(value) if "&" in value else value)

    def start(tag: str, attributes: dict[str, str]) -> None:
        if tag in ENDS_P:
            close(frozenset(("p",)), frozenset("table td th button caption".split()))
        if tag in IMPLIED_ENDS:
            close(*IMPLIED_ENDS[tag])
        if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            start("tr", {})
        node = Node(tag, attributes)
        stack[-1].children.append(node)
        if tag not in VOID:
            push(node)

    def end(tag: str) -> None:
        if tag == "br":
            start("br", {})
        elif tag == "p" and not places.get("p"):
            start("p", {})
            cut(len(stack) - 1)
        elif places.get(tag):
            limits = TABLE_SCOPE if tag in ("td", "th", "tr", "tbody", "thead", "tfoot", "caption") else frozenset(("td", "th", "caption"))
            barrier = 0 if tag == "table" else last(limits)
            if tag not in BLOCK and blocks:
                barrier = max(barrier, blocks[-1])
            if places[tag][-1] >= barrier:
                cut(places[tag][-1])

    at = 0
    while True:
        m = _MARKUP.search(page, at) if page.find(">", at) >= 0 else None
        if not m:
            text(page[at:])
            return root
        text(page[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            end(tag)
        elif tag == "html" or tag == "body":
            if stack[-1].tag == "head":
                cut(len(stack) - 1)
        else:
            if len(stack) > 1 and stack[-1].tag == "head" and tag not in ("title", "meta", "link", "base", "style", "script", "noscript", "template"):
                cut(len(stack) - 1)  # content begins without an end of the head
            start(tag, _attributes(m[3]) if m[3].strip("/ \t\n\r\f") else {})
            if tag in RAW or tag in RCDATA:
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at) if tag != "plaintext" else None
                inner = page[at:stop.start() if stop else len(page)]
                if tag in RCDATA:
                    text(inner)
                elif inner:
                    stack[-1].children.append(inner)
                at = stop.end() if stop else len(page)
                cut(len(stack) - 1)


def visible(node: Node) -> bool:
    if node.tag in UNSEEN:
        return False
    a = node.attributes
    if not a:
        return node.tag != "dialog"
    if "hidden" in a or "style" in a and _HIDDEN_STYLE.search(a["style"]):
        return False
    return not (node.tag == "input" and a.get("type", "").lower() == "hidden" or node.tag == "dialog" and "open" not in a)


def _number(value: str | None, default: int, most: int) -> int:
    m = re.match(r"\s*[+-]?\d{1,9}", value or "")
    return max(-most, min(most, int(m[0]))) if m else default


class _Flow:
    """Lines of one flow of text: the page's, or a table cell's."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False       # a collapsed space waits for more text
        self.gap = 0             # line ends owed before the next text
        self.indent = [""]
        self.mark = ""           # a list mark waits for its item's first line

    def block(self, margin: bool) -> None:
        if self.line:
            self.lines.append("".join(self.line))
            self.line = []
        self.space = False
        self.gap = max(self.gap, 2 if margin else 1)

    def _begin(self) -> None:
        if not self.line:
            if self.gap == 2 and self.lines:
                self.lines.append("")
            self.gap = 0
            self.line.append("".join(self.indent[:-1]) + (self.mark or self.indent[-1]))
            self.mark = ""

    def text(self, value: str) -> None:
        value = _SPACE.sub(" ", value)
        if value == " " or not value:
            self.space |= bool(value and self.line)
            return
        if value[0] == " ":
            self.space |= bool(self.line)
            value = value[1:]
        if self.space and self.line:
            self.line.append(" ")
        self.space = value[-1] == " "
        self._begin()
        self.line.append(value.rstrip(" ") if self.space else value)

    def exact(self, value: str) -> None:
        """Text whose spaces and line ends count."""
        for k, part in enumerate(value.replace("\r\n", "\n").replace("\r", "\n").split("\n")):
            if k:
                self.newline()
            if part:
                self._begin()
                self.line.append(part)

    def newline(self) -> None:
        if self.line:
            self.lines.append("".join(self.line))
            self.line = []
        elif self.lines and self.gap == 0:
            self.lines.append("")
        self.space = False

    def rows(self, lines: list[str]) -> None:
        for line in lines:
            self._begin()
            self.line.append(line)
            self.lines.append("".join(self.line))
            self.line = []

    def done(self) -> list[str]:
        self.block(False)
        lines = [line.rstrip(" ") for line in self.lines]
        while lines and not lines[-1]:
            lines.pop()
        return lines


class _Table:
    """Cells of a table as they are met; ``lines`` lays them out."""

    def __init__(self):
        self.cells: list[tuple[int, int, int, list[str]]] = []  # row, column, columns spanned, lines
        self.taken: dict[int, int] = {}  # column: first row in which it is free again
        self.row = -1
        self.column = 0

    def next_row(self) -> None:
        self.row, self.column = self.row + 1, 0

    def add(self, lines: list[str], across: int, down: int) -> None:
        if self.row < 0:
            self.next_row()
        while self.taken.get(self.column, 0) > self.row:
            self.column += 1
        self.cells.append((self.row, self.column, across, lines))
        for c in range(self.column, self.column + across):
            self.taken[c] = self.row + down
        self.column += across

    def lines(self) -> list[str]:
        width: dict[int, int] = {}
        for _, c, across, lines in sorted(self.cells, key=lambda cell: cell[2]):
            need = max(map(len, lines), default=0)
            have = sum(width.get(k, 0) for k in range(c, c + across)) + 2 * (across - 1)
            for k in range(c, c + across):
                width.setdefault(k, 0)
            if need > have:
                width[c + across - 1] += need - have
        left, x = {}, 0
        for c in sorted(width):
            left[c] = x
            x += width[c] + 2 * (width[c] > 0)
        out: list[str] = []
        by_row: dict[int, list] = {}
        for cell in self.cells:
            by_row.setdefault(cell[0], []).append(cell)
        for r in sorted(by_row):
            for k in range(max(len(cell[3]) for cell in by_row[r])):
                line = ""
                for _, c, _, lines in by_row[r]:
                    if k < len(lines) and lines[k]:
                        line = line.ljust(left[c]) + lines[k]
                out.append(line)
        return out


def render(root: Node) -> str:
    """Visible text of a tree, laid out."""
    flows, tables, lists = [_Flow()], [], []
    exact = 0
    todo: list = [(root, False)]  # (node or string, whether it is being left)
    while todo:
        node, leaving = todo.pop()
        flow = flows[-1]
        if isinstance(node, str):
            (flow.exact if exact else flow.text)(node)
            continue
        tag = node.tag
        if leaving:
            if tag in ("pre", "textarea", "listing"):
                exact -= 1
            if tag in ("td", "th") and tables:
                lines = flows.pop().done()
                tables[-1].add(lines, max(1, _number(node.attributes.get("colspan"), 1, 1000)),
                               max(1, _number(node.attributes.get("rowspan"), 1, 65_534)))
                continue
            if tag == "table":
                flow.rows(tables.pop().lines())
            elif tag == "li":
                flow.block(False)
                flow.indent.pop()
                flow.mark = ""
            elif tag in ("ul", "ol", "menu", "dir"):
                lists.pop()
            elif tag in ("blockquote", "dd"):
                flow.block(False)
                flow.indent.pop()
            if tag in BLOCK:
                flow.block(tag in MARGIN and not (tag in ("ul", "ol", "menu", "dir") and lists))
            continue
        if not visible(node):
            continue
        if tag in BLOCK and tag not in ("td", "th"):
            flow.block(tag in MARGIN and not (tag in ("ul", "ol", "menu", "dir") and lists))
        if tag == "br":
            flow.newline()
        elif tag == "hr":
            flow.rows(["---"])
            flow.block(True)
        elif tag == "input" and node.attributes.get("type", "text").lower() in ("submit", "button", "reset", "text", "search", "email", "url", "tel", "number"):
            flow.text(node.attributes.get("value", ""))
        elif tag in ("pre", "textarea", "listing"):
            exact += 1
            if node.children and isinstance(node.children[0], str) and node.children[0][:1] == "\n":
                node.children[0] = node.children[0][1:]
        elif tag in ("ul", "ol", "menu", "dir"):
            lists.append([tag == "ol", _number(node.attributes.get("start"), 1, 10**9)])
        elif tag == "li":
            mark = "- "
            if lists and lists[-1][0]:
                number = _number(node.attributes.get("value"), lists[-1][1], 10**9)
                lists[-1][1] = number + 1
                mark = f"{number}. "
            flow.indent.append(" " * len(mark))
            flow.mark = mark
        elif tag in ("blockquote", "dd"):
            flow.indent.append("  ")
        elif tag == "table":
            tables.append(_Table())
        elif tag == "tr" and tables:
            tables[-1].next_row()
        elif tag in ("td", "th") and tables:
            flows.append(_Flow())
        if tag not in VOID:
            todo.append((node, True))
            children = node.children
            if tag == "details" and "open" not in node.attributes:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"]
            todo.extend((child, False) for child in reversed(children))
    return "\n".join(flows[0].done())


def extract(page: str) -> str:
    return render(build(page))


def text_of(page: Column) -> Column:
    """Column of the visible text of a column of pages."""
    @F.arrow_udf("string")
    def rendered(col: pa.Array) -> pa.Array:
        return pa.array([None if p is None else extract(p) for p in (x.as_py() for x in col)], pa.string())

    return rendered(page)


def extract_text(pages: DataFrame, into: str = "text", html_col: str = "html") -> DataFrame:
    """``pages`` with the visible text of each in column ``into`` (see above for pages that have such a column)."""
    return pages.withColumn(fresh(pages, into), text_of(F.col(html_col)))
