"""Visible text of web pages, laid out: a tree builder with implied tags, visibility rules, and block rendering.

**Tree.** Tags that HTML lets authors leave out are implied: a new item, row, cell, option
or paragraph ends the open one; a table's or list's end ends what is open in it; void
elements have no end; content of script-like elements is no markup. Within svg and math
a tag may close itself, and HTML's own elements end the drawing or formula.

**Visibility.** Head, scripts, styles, templates and embedded media are hidden, as are
elements with ``hidden``, ``display:none``, ``visibility:hidden`` and hidden inputs. What is
``visibility:visible`` within the latter is shown. Formulas are shown without their
annotations; of drawings, the text elements and foreign objects.

**Layout.** White space collapses but in ``pre``. Blocks begin on lines of their own,
paragraphs and headings with an empty line between, list items with a marker and
indented, table cells padded to the width of their column.

No recursion: depth of nesting is bounded by memory only. A null page has an empty text.
Rows with a null id, and repeated rows, keep their text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.llm import common

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
HIDDEN = frozenset("head script style template noscript iframe noembed noframes title object audio video canvas datalist annotation annotation-xml".split())
IN_HEAD = frozenset("base link meta title style script noscript template head html".split())
#: Elements of svg that are not drawn where they stand, those of svg and math with HTML in them, and those of HTML that end both.
UNDRAWN = frozenset("defs symbol clippath mask pattern marker desc metadata".split())
HTML_INSIDE = {"svg": frozenset("foreignobject desc title".split()), "math": frozenset("mi mo mn ms mtext".split())}
ENDS_FOREIGN = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
BLOCKS = frozenset("address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul body caption tr".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre dl table figure".split())
LISTS, CELLS, ROW_GROUPS = frozenset(["ul", "ol", "menu"]), frozenset(["td", "th"]), frozenset(["thead", "tbody", "tfoot"])
#: What a start tag ends, and where the search for it stops.
IMPLIED = {
    "li": (frozenset(["li"]), LISTS),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "td": (CELLS, frozenset(["tr", "table"])),
    "th": (CELLS, frozenset(["tr", "table"])),
    "tr": (frozenset(["tr", "td", "th", "caption"]), frozenset(["table"])),
    **{g: (ROW_GROUPS | {"tr", "td", "th", "caption"}, frozenset(["table"])) for g in ROW_GROUPS},
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
}
SCOPE = frozenset(["table", "td", "th", "button", "caption"])

_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)\s*/?>")
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*)|(?=>)))?""")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_GONE = re.compile(r"display\s*:\s*none|content-visibility\s*:\s*hidden", re.I)
_VISIBILITY = re.compile(r"(?<![\w-])visibility\s*:\s*(hidden|collapse|visible)", re.I)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}


class Node:
    """``inner`` is svg or math if that is what tags inside belong to; ``shows``, whether something inside is visibility:visible."""

    __slots__ = ("tag", "attributes", "children", "inner", "shows")

    def __init__(self, tag: str, attributes: dict[str, str], inner: str = ""):
        self.tag, self.attributes, self.children, self.inner, self.shows = tag, attributes, [], inner, False


def _attributes(page: str, at: int) -> tuple[dict[str, str], int]:
    """Attributes of a tag whose name ends at ``at``, and the place after its ``>`` (or the page's end)."""
    out: dict[str, str] = {}
    while True:
        m = _ATTRIBUTE.match(page, at)
        if not m or m.end() == at:
            break
        if page.startswith(("=\"", "='"), m.end()):  # a quote that never closes
            return out, len(page)
        value = next((g for g in m.groups()[1:] if g is not None), "")
        out.setdefault(m[1].lower(), html.unescape(value))
        at = m.end()
    end = page.find(">", at)
    return out, len(page) if end < 0 else end + 1


def build(page: str) -> Node:
    """The tree of a page."""
    root = Node("body", {})
    stack, opened = [root], Counter()

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            opened[stack.pop().tag] -= 1

    def end_implied(ends: frozenset[str], stops: frozenset[str]) -> None:
        if not any(opened[t] for t in ends):
            return
        cut = None
        for depth in range(len(stack) - 1, 0, -1):
            tag = stack[depth].tag
            if tag in stops:
                break
            if tag in ends:
                cut = depth
        if cut is not None:
            pop_to(cut)

    def start(tag: str, attributes: dict[str, str], closed: bool = False) -> None:
        if stack[-1].inner and tag in ENDS_FOREIGN:
            depth = len(stack)
            while stack[depth - 1].inner:
                depth -= 1
            pop_to(depth)
        if opened["head"] and tag not in IN_HEAD:
            end_implied(frozenset(["head"]), frozenset())
        if tag in ("html", "body"):
            return
        outer = stack[-1].inner
        if tag in IMPLIED and not outer:
            end_implied(*IMPLIED[tag])
        if tag in BLOCKS and opened["p"] and not outer:
            end_implied(frozenset(["p"]), SCOPE)
        inner = tag if tag in HTML_INSIDE else "" if outer and tag in HTML_INSIDE[outer] else outer
        if tag == "annotation-xml" and attributes.get("encoding", "").lower() in ("text/html", "application/xhtml+xml"):
            inner = ""
        node = Node(tag, attributes, inner)
        stack[-1].children.append(node)
        if visibility(node) == "visible":
            for above in reversed(stack):
                if above.shows:
                    break
                above.shows = True
        if tag not in VOID and not (closed and (outer or inner)):
            stack.append(node)
            opened[tag] += 1

    def end(tag: str) -> None:
        if tag == "br":
            start("br", {})
        elif opened[tag]:
            stops = frozenset(["table"]) if tag in CELLS or tag in ROW_GROUPS or tag == "tr" else frozenset() if tag == "table" else SCOPE - {tag}
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    pop_to(depth)
                    return
                if stack[depth].tag in stops:
                    return

    def text(data: str) -> None:
        if data:
            if opened["head"] and stack[-1].tag == "head" and data.strip():
                end_implied(frozenset(["head"]), frozenset())
            stack[-1].children.append(html.unescape(data))

    at = 0
    while at < len(page):
        mark = page.find("<", at)
        if mark < 0:
            text(page[at:])
            break
        text(page[at:mark])
        if stack[-1].inner and page.startswith("<![CDATA[", mark):
            stop = page.find("]]>", mark)
            stack[-1].children.append(page[mark + 9:len(page) if stop < 0 else stop])
            at = len(page) if stop < 0 else stop + 3
            continue
        if page.startswith("<!--", mark):
            stop = page.find("-->", mark + 4)
            at = len(page) if stop < 0 else stop + 3
            continue
        m = _PLAIN_TAG.match(page, mark)
        if m:
            attributes, at = {}, m.end()
        else:
            m = _TAG.match(page, mark)
            if not m:
                if page.startswith(("<!", "<?", "</"), mark):
                    stop = page.find(">", mark)
                    at = len(page) if stop < 0 else stop + 1
                else:
                    text("<")
                    at = mark + 1
                continue
            attributes, at = _attributes(page, m.end())
        tag = m[2].lower()
        if m[1]:
            end(tag)
            continue
        foreign = bool(stack[-1].inner)
        start(tag, attributes, page.endswith("/>", mark, at))
        if tag == "pre" and page.startswith("\n", at):
            at += 1
        if tag in RAW and not foreign:
            stop = _RAW_END[tag].search(page, at)
            inner = page[at:stop.start() if stop else len(page)]
            stack[-1].children.append(html.unescape(inner) if tag in ("textarea", "title") else inner)
            end(tag)
            at = len(page)
            if stop:
                close = page.find(">", stop.end())
                at = len(page) if close < 0 else close + 1
    return root


class Flow:
    """Lines of one block: text runs on, and a break or a gap comes before the next text."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.gap = 0

    def end_line(self) -> None:
        if self.line:
            self.lines.append("".join(self.line))
            self.line = []
        self.space = False

    def before(self, empty_lines: int) -> None:
        """End the line; at least so many empty lines before what follows."""
        self.end_line()
        self.gap = max(self.gap, empty_lines)

    def _open(self) -> None:
        if self.gap and self.lines:
            self.lines += [""] * self.gap
        self.gap = 0

    def text(self, data: str) -> None:
        words = _SPACE.sub(" ", data)
        core = words.strip(" ")
        if not core:
            self.space |= bool(words) and bool(self.line)
            return
        if not self.line:
            self._open()
        elif self.space or words[0] == " ":
            self.line.append(" ")
        self.line.append(core)
        self.space = words[-1] == " "

    def literal(self, data: str) -> None:
        first, *rest = data.replace("\r\n", "\n").split("\n")
        if first:
            if not self.line:
                self._open()
            self.line.append(first)
        for x in rest:
            self.break_line()
            if x:
                self.line.append(x)

    def break_line(self) -> None:
        if not self.line:
            self._open()
        self.lines.append("".join(self.line))
        self.line, self.space = [], False

    def block(self, lines: list[str]) -> None:
        if lines:
            self.end_line()
            self._open()
            self.lines += lines

    def done(self) -> list[str]:
        self.end_line()
        lines = [x.rstrip() for x in self.lines]
        while lines and not lines[-1]:
            lines.pop()
        while lines and not lines[0]:
            lines.pop(0)
        return lines


class Grid:
    """Cells of a table; columns get the width of their widest line."""

    def __init__(self):
        self.rows: list[list[tuple[int, int, list[str]]]] = []
        self.taken: dict[int, int] = {}  # rows that a cell from above still covers, by column
        self.column = 0

    def row(self) -> None:
        if self.rows:
            self.taken = {c: n - 1 for c, n in self.taken.items() if n > 1}
        self.rows.append([])
        self.column = 0

    def cell(self, lines: list[str], across: int, down: int) -> None:
        if not self.rows:
            self.row()
        while self.column in self.taken:
            self.column += 1
        self.rows[-1].append((self.column, across, lines))
        if down > 1:
            self.taken |= dict.fromkeys(range(self.column, self.column + across), down)
        self.column += across

    def lines(self) -> list[str]:
        widths: Counter = Counter()
        cells = sorted((across, column, max(map(len, lines), default=0)) for row in self.rows for column, across, lines in row)
        for across, column, need in cells:
            have = sum(widths[c] for c in range(column, column + across)) + 2 * (across - 1)
            widths[column + across - 1] += max(0, need - have)
        starts, at = {}, 0
        for c in range(max(widths, default=-1) + 1):
            starts[c] = at
            at += widths[c] + 2 if widths[c] else 0
        out = []
        for row in self.rows:
            for k in range(max((len(lines) for _, _, lines in row), default=0)):
                line = ""
                for column, _, lines in row:
                    if k < len(lines) and lines[k]:
                        line = line.ljust(starts[column]) + lines[k]
                out.append(line.rstrip())
        return out


def _span(node: Node, name: str) -> int:
    value = node.attributes.get(name, "").strip()
    return min(1000, max(1, int(value))) if value.isascii() and value.isdigit() and len(value) < 6 else 1


def visibility(node: Node) -> str:
    """Its own visibility, or an empty text if it is inherited."""
    style = node.attributes.get("style")
    found = _VISIBILITY.findall(style) if style else None
    return found[-1].lower() if found else ""


def gone(node: Node) -> bool:
    a = node.attributes
    return node.tag in HIDDEN or "hidden" in a or bool(_GONE.search(a.get("style", "")))


def render(root: Node) -> str:
    """The laid-out text of a tree."""
    flows, grids, counts, pre = [Flow()], [], [], 0
    # With each node: whether it inherits visibility:hidden, and whether it is in svg outside of (0) or in (1) a text element.
    todo: list[tuple[Node | str, bool, bool, int | None]] = [(root, False, False, None)]
    while todo:
        node, leaving, hidden, drawn = todo.pop()
        flow = flows[-1]
        if isinstance(node, str):
            if not hidden and drawn != 0:
                (flow.literal if pre else flow.text)(node)
            continue
        tag = node.tag
        if not leaving:
            if gone(node) or drawn is not None and tag in UNDRAWN:
                continue
            own = visibility(node)
            hidden = own != "visible" if own else hidden
            if hidden and not node.shows:
                continue
            if tag == "svg":
                drawn = 0
            elif tag == "foreignobject":
                drawn = None
            elif tag == "text" and drawn == 0:
                drawn = 1
                flow.text(" ")
            if tag == "br":
                flow.break_line()
                continue
            if tag == "input":
                if node.attributes.get("type", "").lower() not in ("hidden", "checkbox", "radio", "password", "file"):
                    flow.text(" " + node.attributes.get("value", "") + " ")
                continue
            if tag in BLOCKS:
                flow.before(1 if tag in SPACED else 0)
            if tag in LISTS:
                flow.before(0 if counts else 1)
                start = node.attributes.get("start", "")
                counts.append(int(start) if tag == "ol" and start.isascii() and start.isdigit() and len(start) < 10 else 1 if tag == "ol" else None)
            elif tag in ("li", "blockquote", "dd") or tag in CELLS:
                flows.append(Flow())
            elif tag == "table":
                grids.append(Grid())
                flows.append(Flow())
            elif tag == "tr" and grids:
                grids[-1].row()
            elif tag == "pre":
                pre += 1
            todo.append((node, True, hidden, drawn))
            todo += [(child, False, hidden, drawn) for child in reversed(node.children)]
            continue
        if tag in LISTS:
            counts.pop()
        elif tag in ("li", "blockquote", "dd"):
            lines = flows.pop().done()
            mark = "  "
            if tag == "li":
                mark = "- " if not counts or counts[-1] is None else f"{counts[-1]}. "
                if counts and counts[-1] is not None:
                    counts[-1] += 1
                mark = " " * len(mark) if hidden else mark
                lines = lines or [""]
            flows[-1].block([((mark if i == 0 and tag == "li" else " " * len(mark)) + x).rstrip() for i, x in enumerate(lines)])
        elif tag in CELLS:
            lines = flows.pop().done()
            if grids:
                grids[-1].cell(lines, _span(node, "colspan"), _span(node, "rowspan"))
            else:
                flows[-1].block(lines)
        elif tag == "table":
            loose = flows.pop().done()  # captions, and text outside of cells
            flows[-1].block(loose + grids.pop().lines())
        elif tag == "pre":
            pre -= 1
        elif tag == "text" and drawn:
            flow.text(" ")
        if tag in BLOCKS:
            flows[-1].before(1 if tag in SPACED or (tag in LISTS and not counts) else 0)
    return "\n".join(flows[0].done())


def text_of(page: str) -> str:
    return render(build(page))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, text) of each row."""
    common.small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "html"):
                yield pa.RecordBatch.from_arrays([part.column("page_id"), pa.array([text_of(x) for x in part.column("html").to_pylist()], pa.string())], ["page_id", "text"])

    own = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    return own.mapInArrow(run, "page_id long, text string")
