"""The visible text of web pages, laid out as a browser would.

A page is read into a tree, with the tags that authors may leave out (the end of
a paragraph, list item, row, cell or option) implied. The tree is then rendered: blocks
on lines of their own with a blank line where there is a margin, list items with
bullets or numbers, indented by their depth, and tables with aligned columns.
What a browser does not show is left out: head, scripts, styles, comments, hidden
elements, closed details and the like.

A page is one row's work and linear in its length: no character is looked at again once
its tag is read, elements nest `TREE_DEPTH` deep at most (deeper ones become siblings),
indentation and padding are bounded, and tables inside tables are laid out by themselves
down to `TABLE_DEPTH` and then run on as blocks. None of these bounds drops text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchledger.llm.common import table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INVISIBLE = frozenset(
    "head title script style template noscript iframe object audio video canvas datalist meter progress "
    "noframes noembed applet defs desc metadata symbol annotation annotation-xml".split()
)
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary "
    "table tbody td text tfoot th thead tr ul caption".split()
)
MARGIN = frozenset("p h1 h2 h3 h4 h5 h6 blockquote figure dl ol ul menu dir pre table hr fieldset".split())
LISTS = frozenset("ul ol menu dir".split())
HEAD_ONLY = frozenset("base link meta title style script template noscript".split())
#: An element whose start ends an open one, unless one of the last set stands between.
IMPLIED_END = {
    "li": ({"li"}, LISTS), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "optgroup"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "body": ({"head"}, {"body"}),
}
ENDS_PARAGRAPH = BLOCK - {"option", "optgroup", "summary", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "html", "body", "text"}
#: A paragraph is not looked for beyond these.
PARAGRAPH_WITHIN = frozenset("table td th caption button object html".split())
TABLE_DEPTH = 32
TREE_DEPTH = 256
#: Wider cells, columns further right and deeper blocks are not padded or indented beyond these.
MOST_PADDED, MOST_START, MOST_INDENT = 200, 1_000, 80
MOST_COLUMNS, MOST_ROWS = 100, 1_000
COLUMN_GAP = "  "
#: Elements whose content holds no tags, the first without character references too.
RAW = frozenset("script style xmp iframe noembed noframes".split())
PLAIN = frozenset("title textarea".split())

_BLANKS = re.compile(r"[ \t\n\r\f]+")
_STYLE_NONE = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)\b", re.I)


# tags --------------------------------------------------------------------------

_TAG = re.compile(r"[a-zA-Z][^ \t\n\f\r/>]*")
_BETWEEN = re.compile(r"[ \t\n\f\r/]*")
_ATTRIBUTE = re.compile(r"[^ \t\n\f\r/>][^ \t\n\f\r/>=]*")
_EQUALS = re.compile(r"[ \t\n\f\r]*=[ \t\n\f\r]*")
_UNQUOTED = re.compile(r"[^ \t\n\f\r>]*")
_COMMENT_END = re.compile(r"--!?>")
_NUMBER = re.compile(r"&#0*([0-9]+)")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[ \t\n\f\r/>])", re.I) for tag in RAW | PLAIN}


def _decoded(text: str) -> str:
    """Character references resolved; of a number only as many digits are read as can matter."""
    return unescape(_NUMBER.sub(lambda m: "&#" + m[1][:8], text)) if "&" in text else text


def _attributes(html: str, at: int) -> tuple[dict[str, str | None], int]:
    """The attributes from `at` on and the place after the tag; the end of the text if the tag is not closed."""
    found: dict[str, str | None] = {}
    while True:
        at = _BETWEEN.match(html, at).end()
        if at >= len(html):
            return found, -1
        if html[at] == ">":
            return found, at + 1
        name = _ATTRIBUTE.match(html, at)
        at, value = name.end(), None
        equals = _EQUALS.match(html, at)
        if equals:
            at = equals.end()
            quote = html[at : at + 1]
            if quote in ("'", '"') and quote:
                end = html.find(quote, at + 1)
                if end < 0:
                    return found, -1
                value, at = html[at + 1 : end], end + 1
            else:
                unquoted = _UNQUOTED.match(html, at)
                value, at = unquoted[0], unquoted.end()
        # Of a repeated attribute, the first counts.
        found.setdefault(name[0].lower(), None if value is None else _decoded(value))


def _tokens(html: str) -> Iterator[tuple[str, str, dict[str, str | None]]]:
    """("start" | "end" | "text", tag or text, attributes), in one pass.

    What opens a tag or comment that is never closed is not shown, nor is what follows it, as in a browser.
    """
    at, size = 0, len(html)
    while at < size:
        opens = html.find("<", at)
        if opens < 0:
            opens = size
        if opens > at:
            yield "text", _decoded(html[at:opens]), {}
        if opens == size:
            return
        at = opens + 1
        tag = _TAG.match(html, at)
        if tag:
            attributes, at = _attributes(html, tag.end())
            if at < 0:
                return
            name = tag[0].lower()
            yield "start", name, attributes
            if name in _RAW_END:
                closed = _RAW_END[name].search(html, at)
                end = closed.start() if closed else size
                if end > at:
                    yield "text", html[at:end] if name in RAW else _decoded(html[at:end]), {}
                at = end
            continue
        if html.startswith("!--", at):
            at += 3
            # "<!-->" and "<!--->" are whole comments.
            short = next((s for s in (">", "->") if html.startswith(s, at)), None)
            closed = None if short else _COMMENT_END.search(html, at)
            if not short and not closed:
                return
            at = at + len(short) if short else closed.end()
            continue
        ends_tag = _TAG.match(html, at + 1) if html.startswith("/", at) else None
        if ends_tag:
            _, at = _attributes(html, ends_tag.end())
            if at < 0:
                return
            yield "end", ends_tag[0].lower(), {}
        elif html[at : at + 1] in ("!", "?") and at < size or html.startswith("/", at) and at + 1 < size:
            closed = html.find(">", at)
            if closed < 0:
                return
            at = closed + 1
        else:
            yield "text", "<", {}


# tree --------------------------------------------------------------------------


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str | None]):
        self.tag, self.attrs, self.children = tag, attrs, []

    def span(self, name: str, most: int) -> int:
        value = self.attrs.get(name) or "1"
        digits = value.lstrip("0")[:9] if value.isascii() and value.isdigit() else "1"
        return min(max(int(digits or "0"), 1), most)


class TreeBuilder:
    def __init__(self) -> None:
        self.root = Node("html", {})
        self._open = [self.root]
        self._count: Counter[str] = Counter()

    def _pop_to(self, at: int) -> None:
        for node in self._open[at:]:
            self._count[node.tag] -= 1
        del self._open[at:]

    def _imply_end(self, tags: set[str] | frozenset[str], within: set[str] | frozenset[str]) -> None:
        """End the outermost open element of `tags` that no element of `within` encloses from inside."""
        if not any(self._count[t] for t in tags):
            return
        last = None
        for at in range(len(self._open) - 1, 0, -1):
            tag = self._open[at].tag
            if tag in tags:
                last = at
            elif tag in within:
                break
        if last is not None:
            self._pop_to(last)

    def start(self, tag: str, attrs: dict[str, str | None]) -> None:
        if tag == "html":
            return
        if self._count["head"] and tag not in HEAD_ONLY and tag != "head":
            self._imply_end({"head"}, set())
        if tag in ENDS_PARAGRAPH and self._count["p"]:
            self._imply_end({"p"}, PARAGRAPH_WITHIN)
        if tag in IMPLIED_END:
            self._imply_end(*IMPLIED_END[tag])
        node = Node(tag, attrs)
        if tag not in VOID and len(self._open) >= TREE_DEPTH:
            self._pop_to(TREE_DEPTH - 1)
        self._open[-1].children.append(node)
        if tag not in VOID:
            self._open.append(node)
            self._count[tag] += 1

    def end(self, tag: str) -> None:
        if tag == "br":
            self._open[-1].children.append(Node("br", {}))
        if not self._count[tag]:
            return
        # An end tag does not reach out of a table cell, and an inline one not out of a block.
        for at in range(len(self._open) - 1, 0, -1):
            found = self._open[at].tag
            if found == tag:
                self._pop_to(at)
                return
            if found == "table" or (found in ("td", "th", "caption") and tag not in ("table", "tr", "tbody", "thead", "tfoot")):
                return
            if tag not in BLOCK and found in BLOCK and found not in ("option", "optgroup", "text"):
                return

    def text(self, data: str) -> None:
        if self._count["head"] and self._open[-1].tag == "head" and data.strip():
            self._imply_end({"head"}, set())
        self._open[-1].children.append(data)


def parse(html: str) -> Node:
    builder = TreeBuilder()
    for what, value, attributes in _tokens(html):
        if what == "start":
            builder.start(value, attributes)
        elif what == "end":
            builder.end(value)
        else:
            builder.text(value)
    return builder.root


# rendering ---------------------------------------------------------------------


def _hidden(node: Node) -> bool:
    if node.tag in INVISIBLE or "hidden" in node.attrs:
        return True
    if node.tag == "dialog" and "open" not in node.attrs:
        return True
    return bool(_STYLE_NONE.search(node.attrs.get("style") or ""))


def _shown_children(node: Node) -> list:
    if node.tag == "details" and "open" not in node.attrs:
        return [c for c in node.children if isinstance(c, Node) and c.tag == "summary"][:1]
    if node.tag == "select" and "multiple" not in node.attrs:
        return _chosen(node)
    return node.children


def _chosen(select: Node) -> list:
    """What a closed list shows: the last option marked as selected, else the first."""
    options, todo = [], list(reversed(select.children))
    while todo:
        child = todo.pop()
        if isinstance(child, Node):
            if child.tag == "option":
                options.append(child)
            elif child.tag == "optgroup":
                todo += reversed(child.children)
    marked = [o for o in options if "selected" in o.attrs]
    return (marked[-1:] or options[:1])[0].children if options else []


class Renderer:
    """Lines of text, from the events of a walk through the tree."""

    def __init__(self, depth: int = 0):
        self.lines: list[str] = []
        self._depth = depth
        self._inline: list[str] = []
        self._blank = False  # a blank line is due before the next text
        self._space = False  # a space is due within the line
        self._indent = 0
        self._marker = ""
        self._lists: list[list] = []  # [is it numbered, next number]

    # inline text

    def text(self, data: str, preserved: bool) -> None:
        if preserved:
            first, *rest = data.replace("\r\n", "\n").split("\n")
            self._inline.append(first)
            for line in rest:
                self.line_end(forced=True)
                self._inline.append(line)
            return
        words = _BLANKS.split(data)
        if words[0] == "":
            self._space = True
        kept = [w for w in words if w]
        if kept:
            if self._space and self._inline:
                self._inline.append(" ")
            self._inline.append(" ".join(kept))
            self._space = words[-1] == ""

    def line_end(self, forced: bool = False) -> None:
        """Finish the line; `forced` makes an empty one too."""
        line = "".join(self._inline).replace("\xa0", " ").rstrip()
        self._inline.clear()
        self._space = False
        if not line and not forced:
            return
        self._put(line)

    def _put(self, line: str) -> None:
        if self._blank and self.lines and self.lines[-1]:
            self.lines.append("")
        self._blank = False
        pad = " " * (min(self._indent, MOST_INDENT) - len(self._marker)) + self._marker
        self._marker = ""
        self.lines.append((pad + line).rstrip())

    # blocks

    def margin(self) -> None:
        self._blank = True

    def walk(self, root: Node) -> None:
        """Depth first, with a stack of its own: pages may nest deeper than Python's."""
        todo: list = [("in", root, False, True)]
        while todo:
            what, node, preserved, visible = todo.pop()
            if what == "text":
                if visible:
                    self.text(node, preserved)
                continue
            if what == "out":
                self._leave(node)
                continue
            if _hidden(node):
                continue
            found = _VISIBILITY.search(node.attrs.get("style") or "")
            if found:
                visible = found[1].lower() == "visible"
            if node.tag == "br":
                self.line_end(forced=True)
            elif node.tag == "wbr":
                continue
            elif node.tag == "input":
                if visible and (node.attrs.get("type") or "").lower() in ("submit", "button", "reset"):
                    self.text(f" {node.attrs.get('value') or ''} ", False)
            elif node.tag == "table" and self._depth < TABLE_DEPTH:
                self._table(node, visible)
            else:
                self._enter(node)
                preserved = preserved or node.tag in ("pre", "textarea", "listing", "xmp")
                todo.append(("out", node, preserved, visible))
                for child in reversed(_shown_children(node)):
                    todo.append(("text" if isinstance(child, str) else "in", child, preserved, visible))
        self.line_end()

    def _enter(self, node: Node) -> None:
        tag = node.tag
        if tag not in BLOCK:
            return
        self.line_end()
        if tag in MARGIN and not (tag in LISTS and self._lists):
            self.margin()
        if tag in LISTS:
            start = node.attrs.get("start") or "1"
            number = int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1
            self._lists.append([tag == "ol", number])
        elif tag == "li":
            marker = "- "
            if self._lists and self._lists[-1][0]:
                value = node.attrs.get("value") or ""
                if re.fullmatch(r"-?[0-9]{1,9}", value):
                    self._lists[-1][1] = int(value)
                marker = f"{self._lists[-1][1]}. "
                self._lists[-1][1] += 1
            self._indent += len(marker)
            # An item that begins with a list shares its first line.
            self._marker = (self._marker if len(self._marker) < MOST_INDENT else "") + marker
            node.attrs["\0indent"] = len(marker)
        elif tag in ("dd", "blockquote"):
            self._indent += 4

    def _leave(self, node: Node) -> None:
        tag = node.tag
        if tag not in BLOCK:
            return
        self.line_end()
        if tag in LISTS:
            self._lists.pop()
        elif tag == "li":
            if self._marker:  # an item without text still has its bullet
                self._put("")
            self._indent -= node.attrs["\0indent"]
        elif tag in ("dd", "blockquote"):
            self._indent -= 4
        if tag in MARGIN and not (tag in LISTS and self._lists):
            self.margin()

    # tables

    def _table(self, node: Node, visible: bool) -> None:
        self.line_end()
        self.margin()
        captions, rows = _rows_of(node)
        for caption in captions:
            for line in _block_lines(caption, self._depth + 1, visible):
                self._put(line)
        for line in _aligned([[(_block_lines(c, self._depth + 1, visible), c.span("colspan", MOST_COLUMNS), c.span("rowspan", MOST_ROWS)) for c in r] for r in rows]):
            self._put(line)
        self.margin()


def _block_lines(node: Node, depth: int, visible: bool) -> list[str]:
    inner = Renderer(depth)
    holder = Node("div", {} if visible else {"style": "visibility:hidden"})
    holder.children = [] if _hidden(node) else [node]
    inner.walk(holder)
    return _trimmed(inner.lines)


def _trimmed(lines: list[str]) -> list[str]:
    start, end = 0, len(lines)
    while start < end and not lines[start]:
        start += 1
    while end > start and not lines[end - 1]:
        end -= 1
    return lines[start:end]


def _rows_of(table_node: Node) -> tuple[list[Node], list[list[Node]]]:
    """Captions, and the cells of each row; what stands in a table outside of cells becomes a row of its own."""
    captions, rows, feet = [], [], []
    todo = [(c, rows) for c in reversed(table_node.children)]
    while todo:
        node, target = todo.pop()
        if isinstance(node, str):
            if node.strip():
                stray = Node("td", {})
                stray.children = [node]
                target.append([stray])
        elif _hidden(node):
            continue
        elif node.tag == "caption":
            captions.append(node)
        elif node.tag in ("thead", "tbody", "tfoot"):
            inside = feet if node.tag == "tfoot" else target
            todo += [(c, inside) for c in reversed(node.children)]
        elif node.tag == "tr":
            cells = []
            for c in node.children:
                if isinstance(c, Node) and c.tag in ("td", "th"):
                    if not _hidden(c):
                        cells.append(c)
                elif isinstance(c, Node) or c.strip():
                    stray = Node("td", {})
                    stray.children = [c]
                    cells.append(stray)
            target.append(cells)
        elif node.tag in ("td", "th"):
            target.append([node])
        elif node.tag not in ("colgroup", "col"):
            stray = Node("td", {})
            stray.children = [node]
            target.append([stray])
    return captions, rows + feet


def _aligned(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Cells in columns as wide as their widest one-column cell; a row as high as its highest cell."""
    placed: list[list[tuple[int, int, list[str]]]] = []
    taken: dict[int, int] = {}  # column -> rows that a cell above still covers
    for cells in rows:
        column, row, covers = 0, [], {}
        for lines, columns, down in cells:
            columns = min(columns, max(1, MOST_COLUMNS - column))
            while taken.get(column, 0) > 0:
                column += 1
            row.append((column, columns, lines))
            if down > 1:
                covers.update(dict.fromkeys(range(column, column + columns), down))
            column += columns
        taken = {c: n - 1 for c, n in (taken | covers).items() if n > 1}
        placed.append(row)
    widths: Counter[int] = Counter()
    for row in placed:
        for column, columns, lines in row:
            if columns == 1:
                widths[column] = max(widths[column], min(max(map(len, lines), default=0), MOST_PADDED))
    out = []
    starts, at = {}, 0
    for c in sorted({c for row in placed for c, _, _ in row} | widths.keys()):
        starts[c] = min(at, MOST_START)
        at += widths[c] + len(COLUMN_GAP) if widths[c] else 0
    for row in placed:
        for k in range(max((len(lines) for _, _, lines in row), default=0)):
            line = ""
            for column, _, lines in row:
                if k < len(lines) and lines[k]:
                    line = line.ljust(starts[column])
                    line += (COLUMN_GAP if line and not line.endswith(COLUMN_GAP) else "") + lines[k]
            out.append(line.rstrip())
    return out


def visible_text(html: str | None) -> str:
    renderer = Renderer()
    renderer.walk(parse(html or ""))
    return "\n".join(_trimmed(renderer.lines))


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page: its visible text, empty for NULL, empty or invisible pages.

    Broken markup is read as far as it goes and never an error. Each row is a page
    of its own, repeated rows and NULL ids included.
    """
    rows = pages.select("page_id", "url", "html")
    out = rows.select("page_id", "url", F.lit("").alias("text")).schema

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [visible_text(h.as_py()) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    return rows.mapInArrow(of_batches, out)


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
