"""HTML to text with layout: a small tree builder, visibility rules, and block, list and table rendering."""

from __future__ import annotations

import re
import unicodedata
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import add_columns, table, without

# fixed values: element kinds of the public HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style template noscript title datalist iframe object video audio canvas".split())
# within drawings and formulas: what is not painted, what may hold elements of HTML, and HTML tags that end the drawing or formula
UNPAINTED = frozenset("annotation annotation-xml defs desc metadata symbol clippath mask pattern marker".split())
HOLDS_HTML = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
BREAKS_OUT = frozenset((
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s "
    "small span strong strike sub sup table tt u ul var").split())
# what an open head may hold; any other tag or text ends it
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
BLOCK = frozenset((
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr caption ul").split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure hr fieldset".split())  # a blank line around
CLOSES_P = BLOCK - frozenset("body html dd dt li td th tr tbody thead tfoot caption legend".split())
# an opening tag ends these open elements, up to one of the fences
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}), "option": ({"option"}, {"select"}), "optgroup": ({"optgroup"}, {"select"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
}
_HIDING = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\s*(?:!important\s*)?(?:;|$)", re.I)
DEEPEST = 512  # open elements; what is nested deeper becomes a sibling, as in browsers
TABLES = 20  # tables within tables that are aligned; deeper ones are plain blocks
_BLANKS = re.compile(r"[ \t\n\r\f]+")


class Node:
    """An element; children are nodes and strings."""

    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str | None]):
        self.tag, self.attrs, self.children = tag, attrs, []


class Builder(HTMLParser):
    """A tree from tags that may be missing or crossed.

    A block ends an open paragraph, list items, cells, rows and table sections end their
    like, an end tag closes up to its element if that is open in the same block (for a block:
    in the same table) and is ignored otherwise
    (a lone </p> or </br> counts as an empty element), what cannot be in a head ends an
    open one, and the end closes all.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]
        self.foreign = 0  # open drawings and formulas

    def _cut(self, at: int) -> None:
        if self.foreign:
            self.foreign -= sum(n.tag in ("svg", "math") for n in self.open[at:])
        del self.open[at:]

    def _close(self, tags: set[str], fences) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                self._cut(i)
                return
            if self.open[i].tag in fences:
                return

    def _foreign(self) -> int:
        """Where the drawing or formula begins that the next tag would belong to, or 0."""
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in ("svg", "math"):
                return i
            if self.open[i].tag in HOLDS_HTML:
                return 0
        return 0

    def handle_starttag(self, tag, attrs):
        while self.foreign and tag in BREAKS_OUT and (at := self._foreign()):
            self._cut(at)
        if tag in ("html", "body"):
            if tag == "body" and any(n.tag == "head" for n in self.open):
                self._close({"head"}, ())
            if tag == "html" or any(n.tag == "body" for n in self.open):
                return
        elif self.open[-1].tag == "head" and tag not in IN_HEAD:
            self._close({"head"}, ())
        if tag in CLOSES_P:
            self._close({"p"}, {"table", "td", "th", "button", "caption"})
        if tag in ("select", "input", "textarea"):
            self._close({"select"}, BLOCK)
        if tag == "optgroup":
            self._close({"option"}, {"select"})
        if tag in IMPLIED:
            ended, fences = IMPLIED[tag]
            if tag in ("tbody", "thead", "tfoot", "tr"):
                while any(n.tag in ended for n in self._inside(fences)) and not (tag == "tr" and self.open[-1].tag in ("tbody", "thead", "tfoot", "table")):
                    self._close(ended, fences)
            else:
                self._close(ended, fences)
            if tag in ("td", "th") and self.open[-1].tag in ("table", "tbody", "thead", "tfoot"):
                self.handle_starttag("tr", [])
        node = Node(tag, dict(attrs))
        if self.foreign:
            a = node.attrs
            if tag in UNPAINTED or a.get("display") == "none" or a.get("visibility") in ("hidden", "collapse"):
                a["hidden"] = ""
            elif tag == "text":
                a["\0apart"] = ""
        self.open[-1].children.append(node)
        if tag not in VOID and len(self.open) < DEEPEST:
            self.open.append(node)
            self.foreign += tag in ("svg", "math")

    def _inside(self, fences) -> list[Node]:
        out = []
        for node in reversed(self.open):
            if node.tag in fences:
                break
            out.append(node)
        return out

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        # only in drawings and formulas does the slash close an element
        if self.foreign and self.open[-1].tag == tag and not self.open[-1].children and self._foreign():
            self._cut(len(self.open) - 1)

    def handle_endtag(self, tag):
        if tag in ("html", "body"):
            return
        if any(n.tag == tag for n in self.open[1:]):
            # an inline element does not end the block around it, a block not the table around it
            self._close({tag}, set() if tag in ("table", "head") else {"table"} if tag in BLOCK else BLOCK)
        elif tag in ("p", "br"):
            self.open[-1].children.append(Node(tag, {}))

    def handle_data(self, data):
        if self.open[-1].tag == "head" and not _BLANKS.fullmatch(data):
            self._close({"head"}, ())
        self.open[-1].children.append(data)


def parse(html: str) -> Node:
    builder = Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def visible(node: Node) -> bool:
    """Whether a browser would paint the element, by its tag and its own attributes."""
    if node.tag in HIDDEN or "hidden" in node.attrs:
        return False
    if node.tag == "input" or node.tag == "dialog" and "open" not in node.attrs:
        return False
    style = node.attrs.get("style")
    return not (style and _HIDING.search(style))


class Page:
    """Lines under construction; runs of blanks shrink to one, margins to the larger one."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.blank = False  # a blank is due before the next word
        self.gap = 0  # empty lines due before the next text
        self.prefix: list[tuple[str, str]] = []  # first-line and other-line indents

    def text(self, data: str, pre: bool = False) -> None:
        if pre:
            first, *rest = data.split("\n")
            self._put(first)
            for more in rest:
                self.end(keep=True)
                self._put(more)
            return
        words = _BLANKS.split(data)
        for i, word in enumerate(words):
            if i:
                self.blank = self.blank or bool(self.line)
            if word:
                self._put((" " if self.blank else "") + word)
                self.blank = False

    def _put(self, piece: str) -> None:
        if piece:
            self.line.append(piece)

    def end(self, keep: bool = False) -> None:
        """End the line, if it has anything (``keep``: in any case)."""
        self.blank = False
        line = "".join(self.line).rstrip() if not keep else "".join(self.line)
        self.line = []
        if line.strip() or keep:
            if self.lines:
                self.lines += [""] * self.gap
            self.gap = 0
            self.lines.append(self._indent() + line)

    def _indent(self) -> str:
        out = []
        for i, (first, other) in enumerate(self.prefix):
            out.append(first or other)
            self.prefix[i] = ("", other)
        return "".join(out)

    def margin(self, lines: int) -> None:
        self.end()
        self.gap = max(self.gap, lines)


def width(text: str) -> int:
    """Columns of a text in a terminal: wide characters take two, combining ones none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def _below(node: Node) -> str:
    """All text below an option or the like, which holds no layout."""
    out, stack = [], [node]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            out.append(item)
        elif item.tag not in HIDDEN:
            stack.extend(reversed(item.children))
    return _BLANKS.sub(" ", "".join(out)).strip()


def chosen(select: Node) -> str:
    """What a closed select shows: the last selected option, or else the first that is not disabled; a list box shows all."""
    size = select.attrs.get("size") or "1"
    box = "multiple" in select.attrs or bool(re.fullmatch(r"\d{1,9}", size)) and int(size) > 1
    found: list[tuple[Node, bool]] = []
    stack = [(child, False) for child in reversed(select.children)]
    while stack:
        item, disabled = stack.pop()
        if isinstance(item, str) or item.tag in HIDDEN or box and not visible(item):
            continue
        disabled = disabled or "disabled" in item.attrs
        if item.tag == "option" or box and item.tag == "optgroup" and item.attrs.get("label"):
            found.append((item, disabled))
        if item.tag != "option":
            stack.extend((child, disabled) for child in reversed(item.children))
    if not box:
        found = [f for f in found if "selected" in f[0].attrs][-1:] or [f for f in found if not f[1]][:1]
    return " ".join(o.attrs.get("label") or _below(o) for o, _ in found)


def render(node: Node, level: int = 0) -> str:
    """All visible text below ``node``, block by block.

    Walks with an own stack, so nesting depth has no limit.
    """
    page = Page()
    stack: list[tuple] = [("open", node, False, 0)]
    while stack:
        step, item, pre, depth = stack.pop()
        if step == "done":
            item()
            continue
        if isinstance(item, str):
            page.text(item, pre)
            continue
        if not visible(item):
            continue
        tag = item.tag
        if tag == "br":
            page.end(keep=bool(page.lines) or bool(page.line))
            continue
        if tag == "img":
            if item.attrs.get("alt"):
                page.text(item.attrs["alt"])
            continue
        if tag == "select":
            page.text(chosen(item))
            continue
        if tag == "hr":
            page.margin(1)
            page.text("---")
            page.margin(1)
            continue
        if tag == "table" and level < TABLES:
            page.margin(1)
            for line in render_table(item, level + 1):
                page.line.append(line)
                page.end()
            page.margin(1)
            continue
        after = []
        if "\0apart" in item.attrs:
            page.text(" ")
            after.append(lambda: page.text(" "))
        if tag in BLOCK:
            margin = 1 if tag in SPACED and not (tag in ("ul", "ol") and depth) else 0
            page.margin(margin)
            after.append(lambda m=margin: page.margin(m))
        if tag in ("ul", "ol", "menu"):
            number = 0
            start = item.attrs.get("start") or "1"
            number = int(start) - 1 if re.fullmatch(r"-?\d{1,9}", start) else 0
            for child in item.children:
                if isinstance(child, Node) and child.tag == "li" and visible(child):
                    number += 1
                    child.attrs["\0mark"] = f"{number}. " if tag == "ol" else "- "
            depth += 1
        if tag in ("li", "blockquote", "dd"):
            first = item.attrs.get("\0mark") or ("- " if tag == "li" else "> " if tag == "blockquote" else "    ")
            page.prefix.append((first, "> " if tag == "blockquote" else " " * len(first)))
            after.append(page.prefix.pop)
            after.insert(0, page.end)
        pre = pre or tag in ("pre", "textarea")
        for call in reversed(after):
            stack.append(("done", call, False, 0))
        stack.extend(("open", child, pre, depth) for child in reversed(item.children))
    page.end()
    return "\n".join(page.lines)


def render_table(node: Node, level: int) -> list[str]:
    """Rows of a table with aligned columns; a cell's lines are joined by blanks, spans leave columns empty."""
    rows, captions = [], []
    tall: dict[int, int] = {}  # rows that cells from above still take, by column
    below = list(reversed(node.children))
    while below:
        child = below.pop()
        if child is None:  # no cell reaches into another section
            tall.clear()
        elif isinstance(child, str):
            if child.strip():
                captions.append(_BLANKS.sub(" ", child).strip())
        elif not visible(child):
            continue
        elif child.tag == "tr":
            cells: list[str] = []
            begun: dict[int, int] = {}
            for cell in child.children:
                across = down = 1
                if isinstance(cell, Node) and cell.tag in ("td", "th"):
                    if not visible(cell):
                        continue
                    text = _cell(cell, level)
                    span = cell.attrs.get("colspan") or "1"
                    across = max(1, min(int(span), 1000)) if re.fullmatch(r"\d{1,9}", span) else 1
                    span = (cell.attrs.get("rowspan") or "1").strip()
                    down = (min(int(span), 65534) or 65534) if re.fullmatch(r"\d{1,9}", span) else 1  # 0: to the end of the section
                else:
                    text = cell.strip() if isinstance(cell, str) else _cell(cell, level)
                    if not text:
                        continue
                while len(cells) in tall:
                    cells.append("")
                if down > 1:
                    begun.update((len(cells) + i, down) for i in range(across))
                cells += [text, *[""] * (across - 1)]
            for i, n in begun.items():
                tall[i] = max(n, tall.get(i, 0))
            tall = {i: n - 1 for i, n in tall.items() if n > 1}
            rows.append(cells)
        elif child.tag in ("tbody", "thead", "tfoot"):
            below.extend([None, *reversed(child.children), None])
        else:
            text = _cell(child, level)
            if text:
                captions.append(text)
    widths: list[int] = []
    for cells in rows:
        for i, cell in enumerate(cells):
            if i == len(widths):
                widths.append(0)
            widths[i] = max(widths[i], width(cell))
    lines = ["  ".join(cell + " " * (widths[i] - width(cell)) for i, cell in enumerate(cells)).rstrip() for cells in rows]
    return captions + [line for line in lines if line]


def _cell(node: Node, level: int) -> str:
    holder = Node("div", {})
    holder.children = node.children if node.tag in ("td", "th", "caption") else [node]
    return _BLANKS.sub(" ", render(holder, level)).strip()


def html_to_text(html: str | None) -> str:
    return render(parse(html)) if html else ""


def extract(pages: DataFrame, html_col: str = "html", name: str = "text") -> DataFrame:
    """Add the visible text of every page as ``name``.

    Whole pages, whatever their length; a null or empty page gives "". Rows are independent:
    no shuffle. A column of the input with that name is replaced, unless it is the page
    itself, which then has to be named otherwise.
    """
    rows = without(pages, name)
    names = rows.columns

    def mapped(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, 500):
                batch = whole.slice(i, 500)
                texts = [html_to_text(h.as_py()) for h in batch.column(html_col)]
                yield add_columns(batch.select(names), {name: pa.array(texts, pa.string())})

    return pages.mapInArrow(mapped, T.StructType([*rows.schema, T.StructField(name, T.StringType())]))


def op7_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text")
