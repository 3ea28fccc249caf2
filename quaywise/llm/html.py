"""Visible text of HTML pages, laid out as a browser would show it.

A page is cut into tags and texts, a tree is built from them with the tags that
HTML allows to leave out, and the tree is rendered: hidden elements are left
out, white space collapses, blocks begin on lines of their own with blank lines
around paragraphs and headings, list items have markers and are indented by
depth, preformatted text keeps its lines, and the cells of a table's rows stand
in columns. All visible text is kept, whatever part of a page it is in: what
stands in a table outside its cells and caption is moved before the table, rows
leave a wrapper that is no part of a table, cells that span rows keep their
columns, a menu shows its chosen option, and the texts of drawings and formulas
are read. Copies that a drawing makes by ``use`` are not followed.

What hides an element: its name, the attribute ``hidden``, and the last valid
``display`` of its ``style``. ``visibility`` passes on to what is within until an
element says otherwise. Rules in style sheets are not read, and scripts not run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywise.llm.common import slices, table

# Element names as the HTML standard groups them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "head script style template noscript iframe noembed noframes object audio video canvas "
    "datalist area base link meta title param source track rp".split()
)
#: Elements of drawings and formulas that show nothing in their place.
FOREIGN_HIDDEN = {
    "svg": frozenset(
        "title desc metadata defs symbol clippath mask pattern marker lineargradient radialgradient filter "
        "script style".split()
    ),
    "math": frozenset("annotation annotation-xml mphantom script style".split()),
}
#: Start tags that end an open drawing or formula.
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing "
    "menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
#: Elements of drawings and formulas that hold HTML.
HTML_WITHIN = {
    "svg": frozenset("foreignobject desc title".split()),
    "math": frozenset("mi mo mn ms mtext".split()),
}
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul caption colgroup".split()
)
#: Blocks with a blank line around them.
SPACED = frozenset("p blockquote dl figure h1 h2 h3 h4 h5 h6 ol ul menu dir pre table hr".split())
#: Elements of the standard's special category that are no blocks here, and those here that are not in it:
#: an end tag of inline content doesn't reach out of a special element.
SPECIAL = BLOCK - frozenset(["option", "optgroup"]) | frozenset(["select", "object", "button"])
#: Types of ``input`` whose value is their label.
LABELLED = frozenset("submit button reset".split())
#: Values of ``display`` that show an element. Others, but for ``none``, are no declaration.
DISPLAYED = frozenset(
    "block inline inline-block flex inline-flex grid inline-grid table inline-table table-row table-cell "
    "table-caption table-column table-column-group table-row-group table-header-group table-footer-group "
    "list-item contents flow-root flow run-in ruby inherit initial unset revert revert-layer math".split()
)
PREFORMATTED = frozenset("pre textarea listing xmp".split())
LISTS = frozenset("ul ol menu dir".split())

#: Start tag -> open elements that it closes, and those that end the search for them.
CLOSES: dict[str, tuple[frozenset[str], frozenset[str]]] = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "caption", "colgroup"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tbody": (frozenset(["tbody", "thead", "tfoot", "caption", "colgroup"]), frozenset(["table"])),
    "thead": (frozenset(["tbody", "thead", "tfoot", "caption", "colgroup"]), frozenset(["table"])),
    "tfoot": (frozenset(["tbody", "thead", "tfoot", "caption", "colgroup"]), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist", "optgroup"])),
    "optgroup": (frozenset(["optgroup"]), frozenset(["select"])),
    "body": (frozenset(["head"]), frozenset()),
}
#: Blocks that close an open paragraph.
CLOSES_P = BLOCK - frozenset("body html td th tr tbody thead tfoot caption colgroup option optgroup".split())
#: Elements that an end tag within them doesn't reach out of.
SCOPE = frozenset("table td th caption html button object template".split())
TABLE = frozenset("table caption colgroup thead tbody tfoot tr td th".split())
GROUPS = frozenset("thead tbody tfoot".split())
#: Parts of a table -> open elements that they may stand in.
STANDS_IN = {
    "tr": GROUPS | {"table"},
    "td": GROUPS | {"table", "tr"},
    "th": GROUPS | {"table", "tr"},
    "col": frozenset(["table", "colgroup"]),
} | dict.fromkeys([*GROUPS, "caption", "colgroup"], frozenset(["table"]))
#: Content that may stand in a head; anything else begins the body.
IN_HEAD = frozenset("title meta link base style script noscript template head html".split())

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"  # comments, to the end if they are not closed
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"']+|[\"'])*?)(?:>|\Z)"
    r"|</(?:[^>]+(?:>|\Z)|>)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_DECLARATION = re.compile(
    r"(?:^|[;{])\s*(display|visibility)\s*:\s*([a-z-]+)\s*(!\s*important)?\s*(?=;|\Z)", re.IGNORECASE
)
#: White space that collapses; a no-break space doesn't.
_SPACE = re.compile(r"[ \t\n\r\f]+")
#: Depth beyond which elements are not nested any further.
MAX_DEPTH = 256


#: The end of a start tag that is one element; a slash that ends an unquoted value is part of it.
_EMPTY = re.compile(r"(?<![^\s\"'])(?:[^\s\"'=]*)/\Z")


class Node:
    """``space`` is ``svg`` or ``math`` for the elements of drawings and formulas, empty for those of HTML."""

    __slots__ = ("attributes", "children", "hidden", "name", "seen", "space")

    def __init__(self, name: str, attributes: dict[str, str], space: str = ""):
        self.name = name
        self.attributes = attributes
        self.space = space
        self.children: list[Node | str] = []
        if space:
            self.hidden = name in FOREIGN_HIDDEN[space]
        else:
            self.hidden = (
                name in HIDDEN
                or "hidden" in attributes
                or (name == "input" and attributes.get("type", "").lower() == "hidden")
                or (name == "dialog" and "open" not in attributes)
            )
        # None: as the element around
        self.seen: bool | None = None
        if space or "style" in attributes:
            display, visibility = styles_of(attributes, bool(space))
            if display:  # stronger than the attribute ``hidden``
                open_dialog = name != "dialog" or "open" in attributes
                self.hidden = display == "none" or (self.hidden and not ("hidden" in attributes and name not in HIDDEN and open_dialog))
            if visibility:
                self.seen = visibility == "visible"

    def holds(self) -> str:
        """The ``space`` of the elements that begin in this one."""
        if self.space and (
            self.name in HTML_WITHIN[self.space]
            or (
                self.name == "annotation-xml"
                and self.attributes.get("encoding", "").lower() in ("text/html", "application/xhtml+xml")
            )
        ):
            return ""
        return self.space


def styles_of(attributes: dict[str, str], drawn: bool) -> tuple[str, str]:
    """``display`` and ``visibility`` of an element, empty where they are not given: the last one counts.

    Drawings may give them as attributes, which are weaker than a style.
    """
    found = {"display": "", "visibility": ""}
    if drawn:
        found = {k: attributes.get(k, "").strip().lower() for k in found}
    strong: set[str] = set()
    for m in _DECLARATION.finditer(attributes.get("style", "")):
        name, value = m[1].lower(), m[2].lower()
        valid = value in DISPLAYED or value == "none" if name == "display" else value in ("visible", "hidden", "collapse")
        if valid and (m[3] or name not in strong):
            found[name] = value
            if m[3]:
                strong.add(name)
    return found["display"], found["visibility"]


def attributes_of(rest: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(rest):
        found.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return found


def tokens(page: str, open_: list[Node]) -> Iterator[tuple[str, str, str]]:
    """``text``, ``start`` and ``end`` tokens: kind, name or text, attributes.

    ``open_`` are the open elements, which the caller keeps: in drawings and
    formulas a tag has no raw text and CDATA sections are text.
    """
    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            yield "text", page[at:], ""
            return
        if m.start() > at:
            yield "text", page[at : m.start()], ""
        at = m.end()
        if not m["name"]:
            if open_[-1].space and page.startswith("<![CDATA[", m.start()):
                stop = page.find("]]>", m.start())
                yield "raw", page[m.start() + 9 : stop if stop >= 0 else n], ""
                at = stop + 3 if stop >= 0 else n
            continue
        name = m["name"].lower()
        if m["end"]:
            yield "end", name, ""
            continue
        yield "start", name, m["rest"]
        if name in RAW and not open_[-1].space:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.IGNORECASE).search(page, at)
            stop = close.start() if close else n
            yield "raw", page[at:stop], name
            at = stop


def tree(page: str) -> Node:
    """The tree of a page, with implied ends of elements, bodies and table rows."""
    root = Node("#root", {})
    open_: list[Node] = [root]
    tables = False

    def close(names: frozenset[str], stop: frozenset[str]) -> None:
        """Close the innermost open element of ``names`` that no element of ``stop`` shields."""
        for k in range(len(open_) - 1, 0, -1):
            if open_[k].name in names:
                del open_[k:]
                return
            if open_[k].name in stop:
                return

    def around() -> int:
        """Place of the open table in which what comes next is outside of cells and captions; 0 for none."""
        for k in range(len(open_) - 1 if tables else 0, 0, -1):
            if not open_[k].space:
                if open_[k].name == "table":
                    return k
                if open_[k].name in ("td", "th", "caption", "template"):
                    return 0
        return 0

    def put(child: Node | str) -> None:
        """Add to the open element; what may not stand in a table goes before it."""
        top = open_[-1]
        if top.name in TABLE and not top.space and (k := around()):
            if isinstance(child, str):
                away = bool(child.strip(" \t\n\r\f"))
            else:
                away = child.name not in TABLE and child.name != "col"
            if away:
                # an open table is the last child of its parent
                open_[k - 1].children.insert(-1, child)
                return
        top.children.append(child)

    def leave_foreign() -> None:
        while open_[-1].holds():
            open_.pop()

    for kind, value, rest in tokens(page, open_):
        top = open_[-1]
        if kind == "raw":
            put(unescape(value) if rest in ("title", "textarea") else value)
        elif kind == "text":
            if top.name == "head" and value.strip():
                close(frozenset(["head"]), frozenset())
            put(unescape(value) if "&" in value else value)
        elif kind == "start":
            if top.holds():
                if value in BREAKOUT or (value == "font" and re.search(r"(?i)\b(?:color|face|size)\b", rest)):
                    leave_foreign()
                else:
                    node = Node(value, attributes_of(rest) if rest and not rest.isspace() else {}, top.holds())
                    top.children.append(node)
                    if not _EMPTY.search(rest) and len(open_) < MAX_DEPTH:
                        open_.append(node)
                    continue
            if value == "image":
                value = "img"
            if value not in IN_HEAD:
                close(frozenset(["head"]), SCOPE)
            if value in ("html", "body") and any(x.name == value for x in open_):
                continue
            if value in CLOSES_P:
                close(frozenset(["p"]), SCOPE)
            if value in CLOSES:
                close(*CLOSES[value])
            if tables and value in GROUPS:
                # a group of rows ends whatever is open in its table
                for k in range(len(open_) - 1, 0, -1):
                    if open_[k].name == "table" and not open_[k].space:
                        del open_[k + 1 :]
                        break
            if k := around():
                if value in STANDS_IN:
                    while open_[-1].name not in STANDS_IN[value] or open_[-1].space:
                        open_.pop()
                elif value == "table":
                    del open_[k:]
                elif value == "form":  # has no content in a table
                    continue
            tables = tables or value == "table"
            if value in ("td", "th") and open_[-1].name in ("table", "tbody", "thead", "tfoot"):
                row = Node("tr", {})
                open_[-1].children.append(row)
                open_.append(row)
            space = value if value in ("svg", "math") else ""
            node = Node(value, attributes_of(rest) if rest and not rest.isspace() else {}, space)
            put(node)
            if value not in VOID and len(open_) < MAX_DEPTH and not (space and _EMPTY.search(rest)):
                open_.append(node)
        elif value == "br":
            leave_foreign()
            put(Node("br", {}))
        elif value == "p" and not any(x.name == "p" for x in open_):
            leave_foreign()
            put(Node("p", {}))
        elif value not in ("html", "body"):
            close(frozenset([value]), _reach(value))
    return root


def _reach(name: str) -> frozenset[str]:
    """Elements beyond which the end tag of ``name`` closes nothing."""
    if name in TABLE:
        return frozenset(["table"]) - {name}
    return SCOPE - {name} if name in SPECIAL or name in SCOPE else SPECIAL


class Layout:
    """Lines of rendered text; blocks ask for a number of line ends before what comes next.

    The line that is being written is a list of parts, so a long one is put
    together once. While ``seen`` is false nothing is written.
    """

    def __init__(self, seen: bool = True) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.blank = 0  # blank lines wanted before the next text
        self.space = False
        self.indent = 0
        self.marker = ""
        self.seen = seen

    def end_line(self) -> None:
        if self.parts:
            self.lines.append("".join(self.parts).rstrip(" "))
            self.parts = []
        self.space = False

    def block(self, blank: int) -> None:
        self.end_line()
        self.blank = max(self.blank, blank)

    def _begin(self) -> None:
        if not self.parts:
            if self.blank and self.lines:
                self.lines += [""] * self.blank
            self.blank = 0
            self.parts.append(" " * self.indent + self.marker)
            if self.marker:
                self.indent += len(self.marker)
                self.marker = ""

    def text(self, value: str) -> None:
        if not self.seen or not value:
            return
        value = _SPACE.sub(" ", value)
        body = value.strip(" ")
        self.space = self.space or value[0] == " "
        if body:
            fresh = not self.parts
            self._begin()
            if self.space and not fresh:
                self.parts.append(" ")
            self.parts.append(body)
            self.space = value[-1] == " "

    def raw(self, value: str) -> None:
        if not self.seen:
            return
        for k, part in enumerate(value.split("\n")):
            if k:
                if self.parts:
                    self.end_line()
                else:
                    self.blank += 1
            if part.strip():
                self._begin()
                self.parts.append(part.rstrip("\r"))
            self.space = False

    def line_break(self) -> None:
        if self.parts:
            self.end_line()
        elif self.lines:
            self.blank = min(self.blank + 1, 2)
        self.space = False


def rendered(node: Node, seen: bool = True) -> list[str]:
    """Lines of the visible text below ``node``, which itself is ``seen`` unless it says otherwise."""
    out = Layout(seen if node.seen is None else node.seen)
    _render(node, out, False, 0)
    out.end_line()
    return out.lines


def _render(node: Node, out: Layout, raw: bool, depth: int) -> None:
    counter = 0
    if node.name == "ol":
        start = node.attributes.get("start", "1").strip()
        counter = int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1
    for child in node.children:
        if isinstance(child, str):
            (out.raw if raw else out.text)(child)
            continue
        if child.hidden:
            continue
        name = child.name
        around = out.seen
        if child.seen is not None:
            out.seen = child.seen
        if child.space == "svg":
            _render_svg(child, out, raw, depth, False)
        elif child.space:
            _render_math(child, out, raw, depth)
        elif name == "br":
            out.line_break()
        elif name == "hr":
            out.block(1)
        elif name == "img":
            if alt := child.attributes.get("alt", "").strip():
                out.text(alt)
        elif name == "input":
            kind = child.attributes.get("type", "").strip().lower()
            shown = "value" if kind in LABELLED else "alt" if kind == "image" else ""
            out.text(child.attributes.get(shown, ""))
        elif name == "select":
            _render_select(child, out, raw, depth)
        elif name == "table":
            _render_table(child, out, depth)
        elif name == "li":
            out.block(0)
            held = out.indent, out.marker
            if not out.seen:
                counter += node.name == "ol"
                out.marker = ""
            elif node.name == "ol":
                value = child.attributes.get("value", "").strip()
                counter = int(value) if re.fullmatch(r"-?\d{1,9}", value) else counter
                out.marker = f"{counter}. "
                counter += 1
            else:
                out.marker = "- "
            _render(child, out, raw, depth + 1)
            out.block(0)
            out.indent, out.marker = held
        elif name in LISTS:
            nested = depth > 0
            out.block(0 if nested else 1)
            _render(child, out, raw, depth)
            out.block(0 if nested else 1)
        elif name in BLOCK:
            blank = int(name in SPACED)
            out.block(blank)
            held = out.indent
            out.indent += 2 * (name in ("blockquote", "dd"))
            _render(child, out, raw or name in PREFORMATTED, depth)
            out.block(blank)
            out.indent = held
        else:
            _render(child, out, raw or name in PREFORMATTED, depth)
        out.seen = around


def _options(node: Node) -> Iterator[Node]:
    for child in node.children:
        if isinstance(child, Node) and not child.hidden:
            if child.name == "option":
                yield child
            yield from _options(child)


def _render_select(node: Node, out: Layout, raw: bool, depth: int) -> None:
    """A list shows all of its options, a menu the last one that is selected, or the first that may be."""
    size = node.attributes.get("size", "").strip()
    if "multiple" in node.attributes or (size.isdecimal() and len(size) < 5 and int(size) > 1):
        out.block(0)
        _render(node, out, raw, depth)
        out.block(0)
        return
    options = list(_options(node))
    chosen = [x for x in options if "selected" in x.attributes][-1:]
    chosen = chosen or [x for x in options if "disabled" not in x.attributes][:1]
    for option in chosen:
        out.text(" ")
        _render(option, out, raw, depth)
        out.text(" ")


def _render_svg(node: Node, out: Layout, raw: bool, depth: int, shown: bool) -> None:
    """Texts of a drawing, each on a line of its own; other characters in it are not drawn."""
    for child in node.children:
        if isinstance(child, str):
            if shown:
                (out.raw if raw else out.text)(child)
            continue
        if child.hidden:
            continue
        around = out.seen
        if child.seen is not None:
            out.seen = child.seen
        if child.name == "foreignobject":
            out.block(0)
            _render(child, out, raw, depth)
            out.block(0)
        elif child.name == "text":
            out.block(0)
            _render_svg(child, out, raw, depth, True)
            out.block(0)
        else:
            _render_svg(child, out, raw, depth, shown)
        out.seen = around


def _render_math(node: Node, out: Layout, raw: bool, depth: int) -> None:
    """A formula in a line, its rows as lines; cells and the parts of a fraction stand apart."""
    if node.name in HTML_WITHIN["math"]:
        _render(node, out, raw, depth)
        return
    apart = node.name in ("mfrac", "mtr", "mlabeledtr")
    block = node.name in ("mtr", "mlabeledtr") or (node.name == "math" and node.attributes.get("display") == "block")
    if block:
        out.block(0)
    for child in node.children:
        if isinstance(child, str):
            (out.raw if raw else out.text)(child)
            continue
        if not child.hidden:
            around = out.seen
            if child.seen is not None:
                out.seen = child.seen
            if apart:
                out.text(" ")
            if child.space == "math":
                _render_math(child, out, raw, depth)
            else:
                _render(_wrapped(child), out, raw, depth)
            out.seen = around
        if node.name in ("semantics", "maction"):
            break  # the others are notes and what an action shows
    if block:
        out.block(0)


def _wrapped(*children: Node | str) -> Node:
    node = Node("#stray", {})
    node.children += children
    return node


def _row_groups(node: Node) -> list[list[tuple[Node, bool | None]]]:
    """Rows that are in one group, with what the group says of their visibility.

    The first head comes first and the first foot last, wherever they stand.
    """
    groups: list[tuple[str, list[tuple[Node, bool | None]]]] = []

    def add(parent: Node, name: str, seen: bool | None) -> None:
        rows: list[tuple[Node, bool | None]] = []
        for child in parent.children:
            if isinstance(child, Node) and not child.hidden:
                if child.name == "tr":
                    rows.append((child, seen))
                elif child.name in GROUPS:
                    groups.append((name, rows))
                    rows = []
                    add(child, child.name, seen if child.seen is None else child.seen)
        groups.append((name, rows))

    add(node, "", None)
    groups = [g for g in groups if g[1]]
    names = [name for name, _ in groups]
    first = [names.index("thead")] if "thead" in names else []
    last = [names.index("tfoot")] if "tfoot" in names else []
    middle = [k for k in range(len(groups)) if k not in (*first, *last)]
    return [groups[k][1] for k in (*first, *middle, *last)]


def _span(cell: Node, name: str, most: int) -> int:
    """How many columns or rows a cell takes; rows may be given as 0 for all that follow."""
    given = cell.attributes.get(name, "1").strip()
    span = int(given) if given.isdecimal() and len(given) < 7 else 1
    return most if span == 0 and name == "rowspan" else max(1, min(span, most))


def _cells(row: Node, seen: bool, taken: list[int], rows_left: int) -> list[list[str]]:
    """Cells of a row by column; ``taken`` holds for how many rows yet a column belongs to a cell above."""
    cells: list[list[str]] = []
    loose = Node("td", {})

    def skip() -> None:
        while len(cells) < len(taken) and taken[len(cells)]:
            cells.append([])

    own: list[tuple[int, int, int]] = []
    for child in row.children:
        if isinstance(child, Node) and child.name in ("td", "th"):
            skip()
            wide, tall = _span(child, "colspan", 100), _span(child, "rowspan", rows_left)
            own.append((len(cells), wide, tall))
            cells.append([] if child.hidden else rendered(child, seen))
            cells += [[]] * (wide - 1)
        else:
            loose.children.append(child)
    if any(x.strip() if isinstance(x, str) else True for x in loose.children):
        skip()
        cells.append(rendered(loose, seen))
    taken[:] = [max(0, n - 1) for n in taken]
    for column, wide, tall in own:
        taken += [0] * (column + wide - len(taken))
        for k in range(column, column + wide):
            taken[k] = max(taken[k], tall - 1)
    return cells


def _stray(node: Node) -> Iterator[Node | str]:
    """What a table or a group of rows holds besides rows."""
    for child in node.children:
        if isinstance(child, str) or child.name not in ("tr", "col", "colgroup", *GROUPS):
            yield child
        elif child.name != "tr" and not child.hidden:
            yield from _stray(child)


def _render_table(node: Node, out: Layout, depth: int) -> None:
    """Rows as lines, cells in columns two spaces apart; a cell of several lines makes its row taller.

    The caption comes before the rows, and what the tree left outside of them.
    """
    out.block(1)
    _render(_wrapped(*_stray(node)), out, False, depth)
    out.block(0)
    grid: list[list[list[str]]] = []
    for rows in _row_groups(node):
        taken: list[int] = []
        for k, (row, seen) in enumerate(rows):
            for own in (seen, row.seen):
                seen = own if own is not None else seen
            cells = _cells(row, out.seen if seen is None else seen, taken, len(rows) - k)
            if any(cells):
                grid.append(cells)
    around, out.seen = out.seen, True  # cells hold what is seen
    columns = max(map(len, grid), default=0)
    widths = [max((len(x) for row in grid if k < len(row) for x in row[k]), default=0) for k in range(columns)]
    for row in grid:
        for k in range(max(map(len, row))):
            parts = [(cell[k] if k < len(cell) else "").ljust(w) for cell, w in zip(row, widths, strict=False)]
            out.raw("  ".join(parts).rstrip())
            out.end_line()
    out.seen = around
    out.block(1)


def page_text(page: str | None) -> str | None:
    """The visible text of a page; null for null, empty where nothing is visible.

    Null characters are left out; broken and unclosed tags are read as far as
    they go; text without any tag is one paragraph.
    """
    if page is None:
        return None
    return "\n".join(rendered(tree(page.replace("\0", ""))))


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url`` and ``text`` of every row of ``pages``.

    Repeated rows and null ids stay; an empty table gives no rows; other
    columns are not read. Pages are rendered one by one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = pa.array([page_text(x.as_py()) for x in batch.column("html")], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), texts], names=["page_id", "url", "text"]
            )

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html")).mapInArrow(
        run, "page_id long, url string, text string"
    )


def op6_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of all pages."""
    return extracted(table(spark, sf_dir, "pages"))
