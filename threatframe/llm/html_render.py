"""HTML extraction by layout: a tree builder with implied tags, visibility rules, and a renderer of blocks, lists and tables.

The builder closes what HTML lets authors leave open (``p`` before blocks, ``li``, ``dt``/``dd``, ``tr``/``td``/``th``, ``option``),
opens nothing it was not told to, ignores end tags without a start, and never recurses, so depth is no limit. Not visible are
the head with everything in it (its end tag may be missing: text or a tag that has no place in it ends it), script, style, template, noscript, iframe and the like, comments, ``hidden`` elements,
``aria-hidden="true"`` and inline styles with ``display:none`` or ``visibility:hidden``.

All other text is emitted: white space collapsed outside ``pre`` and ``textarea``, one line per block, an empty line around
paragraphs, headings, lists, tables and quotes, ``- `` or numbers before list items (indented by depth), table cells padded
to the width of their column and joined by `` | ``, ``br`` and ``hr``, alternative text of images.

Null or empty html gives an empty text; null ids stay null; repeated rows are rendered each; an empty table gives an empty
result. Markup that never ends is text up to its end, as browsers read it.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatframe.llm.common import slices

# fixed values of the HTML standard
# start tags that may stand in the head; any other ends it, and so does text
IN_HEAD = set("base link meta title style script noscript template".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("head script style template noscript iframe object audio video canvas title desc defs metadata datalist".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure article section fieldset".split())
BLOCK = SPACED | set("html body div address aside center details dialog dd dt fieldset figcaption footer form header hgroup li main menu nav search summary tr caption thead tbody tfoot legend option optgroup".split())
CLOSES_P = BLOCK - {"html", "body", "tr", "caption", "thead", "tbody", "tfoot", "option", "optgroup", "legend", "summary"} | {"hr"}
# a start tag ends open elements of the second set, up to the nearest of the third
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
SCOPE = set("table td th caption html button object".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
SPACE = re.compile(r"[ \t\n\r\f\v]+")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []

    def attribute(self, name: str) -> str | None:
        for key, value in ATTRIBUTE.findall(self.attributes):
            if key.lower() == name:
                return html.unescape(value.strip("\"'"))
        return None

    def visible(self) -> bool:
        if self.tag in HIDDEN:
            return False
        if not self.attributes.strip():
            return True
        if "hidden" in self.attributes.lower():
            if self.attribute("hidden") is not None or (self.attribute("aria-hidden") or "").lower() == "true":
                return False
        return not ("style" in self.attributes.lower() and UNSEEN.search(self.attribute("style") or ""))


def build(source: str) -> Node:
    """Tree of elements and strings."""
    root = Node("#root")
    stack, at, n = [root], 0, len(source)

    def close(tags: set[str], bounds: set[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in bounds:
                return
            if stack[i].tag in tags:
                low = i
                while low > 1 and stack[low - 1].tag in tags and stack[low - 1].tag not in bounds:
                    low -= 1
                del stack[low:]
                return

    while at < n:
        m = TOKEN.search(source, at)
        text = source[at : m.start() if m else n]
        if text:
            if stack[-1].tag == "head" and SPACE.sub("", text):
                stack.pop()
            stack[-1].children.append(html.unescape(text))
        if not m:
            break
        at = m.end()
        name = m.group(2)
        if name is None:
            if m.group().startswith("<![CDATA["):
                stack[-1].children.append(m.group()[9:].removesuffix("]]>"))
            continue
        name = name.lower()
        if m.group(1):
            if name == "p" and not any(x.tag == "p" for x in stack):
                stack[-1].children.append(Node("p"))
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == name:
                    del stack[i:]
                    break
                if stack[i].tag in SCOPE and name not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html"):
                    break
            continue
        if stack[-1].tag == "head" and name not in IN_HEAD and name != "head":
            stack.pop()
        if name in CLOSES_P:
            close({"p"}, SCOPE)
        if name in IMPLIED:
            close(*IMPLIED[name])
        node = Node(name, m.group(3) or "")
        stack[-1].children.append(node)
        if name in VOID:
            continue
        if name in RAW:  # its content is text up to its end tag
            end = re.compile(rf"</{name}[\s/>]", re.I).search(source, at)
            stop = end.start() if end else n
            node.children.append(html.unescape(source[at:stop]) if name in ("textarea", "title") else source[at:stop])
            closing = source.find(">", stop)
            at = n if not end else (closing + 1 if closing >= 0 else n)
            continue
        stack.append(node)
    return root


class Lines:
    """Lines of text under construction."""

    def __init__(self):
        self.done: list[str] = []
        self.now: list[str] = []
        self.gap = False

    def text(self, value: str, kept: bool) -> None:
        if kept:
            first, *rest = value.split("\n")
            self.now.append(first)
            for line in rest:
                self.add("".join(self.now))
                self.now = [line]
        elif value:
            value = SPACE.sub(" ", value)
            if value[0] == " " and (not self.now or self.now[-1].endswith(" ")):
                value = value[1:]
            if value:
                self.now.append(value)

    def add(self, line: str) -> None:
        if self.gap and self.done:
            self.done.append("")
        self.done.append(line)
        self.gap = False

    def end(self, gap: bool = False) -> None:
        line = "".join(self.now).rstrip(" ")
        if line:
            self.add(line)
        self.now = []
        self.gap |= gap

    def result(self) -> list[str]:
        self.end()
        return self.done


def table_lines(rows: list[list[list[str]]]) -> list[str]:
    """Rows of cells (each a list of lines) with every column as wide as its widest line."""
    widths: list[int] = []
    for row in rows:
        for i, cell in enumerate(row):
            size = max((len(line) for line in cell), default=0)
            if i < len(widths):
                widths[i] = max(widths[i], size)
            else:
                widths.append(size)
    out = []
    for row in rows:
        for k in range(max((len(cell) for cell in row), default=0)):
            line = " | ".join((cell[k] if k < len(cell) else "").ljust(widths[i]) for i, cell in enumerate(row))
            out.append(line.rstrip(" "))
    return [line for line in out if line.strip(" |")]


def render(source: str) -> str:
    """Visible text of a page."""
    if not source:
        return ""
    # a stack entry is (what to do, node, lines to write to, kept white space, group); a group is a table, a row's cells or a list's
    # marks, for those children that need it; what a table, cell or item collects goes to its parent when it ends
    lines = Lines()
    stack: list[tuple] = [("open", build(source), lines, False, None)]
    while stack:
        what, node, out, kept, group = stack.pop()
        if what == "table":
            rows, parent = group
            parent.end(True)
            for line in table_lines(rows.rows):
                parent.now = [line]
                parent.end()
            parent.end(True)
        elif what == "cell":
            group.append([line for line in out.result() if line])
        elif what == "item":
            parent, mark = group
            parent.end()
            for i, line in enumerate(x for x in out.result() if x):
                parent.now = [(mark if i == 0 else " " * len(mark)) + line]
                parent.end()
        elif what == "block":
            out.end(node.tag in SPACED)
        elif isinstance(node, str):
            out.text(node, kept)
        elif node.tag == "br":
            if out.now:
                out.end()
        elif node.tag == "hr":
            out.end()
            out.text("---", False)
            out.end()
        elif node.tag == "img":
            if node.visible():
                out.text(node.attribute("alt") or "", False)
        elif node.visible():
            tag, inner, inner_group = node.tag, out, None
            kept = kept or tag in ("pre", "textarea", "xmp")
            if tag == "table":
                inner_group = Table()
                stack.append(("table", node, out, kept, (inner_group, out)))
            elif tag == "tr" and isinstance(group, Table):
                inner_group = Table(group.rows, group.row())
            elif tag in ("td", "th") and isinstance(group, Table):
                inner = Lines()
                stack.append(("cell", node, inner, kept, group.row() if group.cells is None else group.cells))
            elif tag == "li":
                inner = Lines()
                stack.append(("item", node, inner, kept, (out, group.next() if isinstance(group, Marks) else "- ")))
            elif tag in BLOCK:
                inner_group = group if isinstance(group, Table) else None
                if tag in ("ul", "ol", "menu"):
                    start = node.attribute("start") if tag == "ol" else None
                    inner_group = Marks(tag == "ol", int(start) if start and re.fullmatch(r"-?\d{1,9}", start) else 1)
                out.end(tag in SPACED)
                stack.append(("block", node, out, kept, None))
            elif isinstance(group, (Table, Marks)):
                inner_group = group  # an inline element or form around rows or items
            for child in reversed(node.children):
                stack.append(("open", child, inner, kept, inner_group))
    return "\n".join(lines.result())


class Table:
    """Rows of a table, and the cells of the row that is open, if any."""

    def __init__(self, rows: list | None = None, cells: list | None = None):
        self.rows, self.cells = [] if rows is None else rows, cells

    def row(self) -> list:
        self.rows.append([])
        return self.rows[-1]


class Marks:
    """Marks of a list's items."""

    def __init__(self, numbered: bool, start: int):
        self.numbered, self.number = numbered, start

    def next(self) -> str:
        mark = f"{self.number}. " if self.numbered else "- "
        self.number += 1
        return mark


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page_id, text of every row."""

    def rendered(batches):
        for batch in batches:
            sources = batch["html"].tolist()
            for low, high in slices([len(s) for s in sources], 4_000_000):
                yield pd.DataFrame({"page_id": batch["page_id"].iloc[low:high].astype("Int64"), "text": [render(s) for s in sources[low:high]]})

    rows = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    return rows.mapInPandas(rendered, "page_id long, text string")
