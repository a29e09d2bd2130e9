"""Operator 5, HTML extraction: layout-aware rendering of all visible text.

A page goes through three steps inside one Arrow map, with nothing shuffled: a tokenizer (tags, character references,
comments, raw text elements), a tree builder with implied start and end tags, and a renderer that leaves out what
isn't visible and sets blocks, lists, preformatted text and aligned table cells. No step recurses over the page, and
none looks through the open elements for a tag: their places are kept by name. Columns that row spans hold are kept as
gaps between them, and lines are padded by PADDING at most before a cell, so work follows the page's length.

Visible is what display and visibility leave, after inline styles and the simple rules of style elements (a tag, class or
id, outside at-rules), by importance, specificity and order; a hidden attribute is weaker than any rule. Nothing inside
display: none is drawn; visibility is inherited, so a visible element inside a hidden one is. A select shows its chosen
option, a list box all, a text field its value; a dialog counts if it is open, of closed details the summary; the words
of svg, math and an object's fallback count.
"""

from __future__ import annotations

import bisect
import hashlib
import heapq
import html as _entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.common import table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text up to the end tag, whatever it holds; character references count only in the latter two.
RAW = frozenset("script style xmp iframe noembed noframes noscript textarea title".split())
REFERENCES_IN = frozenset("textarea title".split())
#: Never drawn.
HIDDEN = frozenset("head script style template noscript iframe noembed noframes title meta link base datalist audio video canvas defs symbol desc metadata annotation annotation-xml param source track area".split())
BLOCK = frozenset(
    "html body address article aside blockquote center details dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre search section summary table caption ul xmp listing".split()
)
#: Blocks with an empty line before and after.
SPACED = frozenset("p blockquote dl figure h1 h2 h3 h4 h5 h6 ol ul menu pre table hr fieldset xmp listing".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag of the first kind ends an open element of the second, unless one of the third stands between.
_CELL, _ROW, _PART, _WALL = {"td", "th"}, {"tr"}, {"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}
_INLINE_WALL = {"table", "td", "th", "caption", "html", "template"}
CLOSES: dict[str, tuple[set, set]] = {
    "li": ({"li"}, {"ul", "ol", "menu"} | _INLINE_WALL), "dt": ({"dt", "dd"}, {"dl"} | _INLINE_WALL), "dd": ({"dt", "dd"}, {"dl"} | _INLINE_WALL),
    "td": (_CELL, _WALL | _ROW), "th": (_CELL, _WALL | _ROW), "tr": (_ROW | _CELL, _WALL),
    "thead": (_PART | _ROW | _CELL, _WALL), "tbody": (_PART | _ROW | _CELL, _WALL), "tfoot": (_PART | _ROW | _CELL, _WALL), "caption": (_PART, _WALL),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "rt": ({"rt", "rp"}, {"ruby"}), "rp": ({"rt", "rp"}, {"ruby"}), "body": ({"head"}, {"html"}),
}
#: These may stand in a head; anything else ends it.
_HEAD_ONLY = frozenset("base link meta noscript script style template title".split())

_TAG = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)|([!?/]))", re.S)
_ATTRIBUTE = re.compile(r"""[\s/]*(?:(>)|([^\s/>][^\s/>=]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?)""", re.S)
_COMMENT_END = re.compile(r"--!?>")
_SPACES = re.compile(r"[ \t\n\r\f]+")
_COMMENT, _BRACE, _SELECTOR = re.compile(r"/\*.*?(?:\*/|$)", re.S), re.compile(r"[{}]"), re.compile(r"([a-z][a-z0-9]*)?(?:([.#])([\w-]+))?", re.I)
#: Columns that a line is indented by at most.
INDENT = 100
#: The standard's greatest spans of a cell.
COLSPAN, ROWSPAN = 1_000, 65_534
#: Blanks before a table cell in a line at most.
PADDING = 1_000
#: Values that count; a declaration with any other is left out, as browsers do.
_VALUES = {
    "display": frozenset("none block inline inline-block flex inline-flex grid inline-grid table inline-table table-row table-cell table-row-group table-header-group table-footer-group table-column table-column-group table-caption list-item flow-root contents ruby ruby-base ruby-text run-in inherit initial unset revert".split()),
    "visibility": frozenset("visible hidden collapse inherit initial unset revert".split()),
}
#: Inputs that don't show their value as text; unknown types are text fields.
_NO_FIELDS = frozenset("password checkbox radio file color range".split())
_ROMAN = ((1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i"))


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.children = tag, attrs, []


def tokens(page: str):
    """(kind, name or text, attributes): kind is text, start or end."""
    at, n, raw_end = 0, len(page), {}
    while at < n:
        m = _TAG.search(page, at)
        if not m:
            yield "text", _entities.unescape(page[at:]), None
            return
        if m.start() > at:
            yield "text", _entities.unescape(page[at : m.start()]), None
        comment, slash, name, odd = m.groups()
        if comment:
            if page.startswith((">", "->"), m.end()):  # <!--> and <!---> are whole comments
                at = page.index(">", m.end()) + 1
                continue
            end = _COMMENT_END.search(page, m.end())
            at = end.end() if end else n
        elif odd:
            end = page.find(">", m.end())
            at = end + 1 if end >= 0 else n
        else:
            name, attrs, at = name.lower(), {}, m.end()
            while True:
                a = _ATTRIBUTE.match(page, at)
                if not a:
                    return  # the page ends inside a tag
                at = a.end()
                if a[1]:
                    break
                value = a[3] or ""
                attrs.setdefault(a[2].lower(), _entities.unescape(value[1:-1] if value[:1] in "\"'" and value[-1:] == value[:1] and len(value) > 1 else value))
            yield ("end" if slash else "start"), name, attrs
            if not slash and name in RAW:
                if name not in raw_end:
                    raw_end[name] = re.compile(rf"</{name}(?=[\s/>])", re.I)
                end = raw_end[name].search(page, at)
                stop = end.start() if end else n
                yield "text", _entities.unescape(page[at:stop]) if name in REFERENCES_IN else page[at:stop], None
                at = stop


class _Open:
    """The open elements, and where those of each name stand."""

    def __init__(self, root: Node):
        self.stack, self.at = [root], {root.tag: [0]}

    def push(self, node: Node) -> None:
        self.stack[-1].children.append(node)
        self.at.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def cut(self, n: int) -> None:
        """Close all but the first n."""
        while len(self.stack) > n:
            self.at[self.stack.pop().tag].pop()

    def last(self, tags) -> int:
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=-1)

    def close(self, wanted: set, wall: set) -> None:
        """Close the wanted elements that no wall stands above, with all inside them."""
        while (i := self.last(wanted)) > 0 and i > self.last(wall):
            self.cut(i)


_PARTS_OF_TABLE = ("table", "thead", "tbody", "tfoot", "tr")


def build(page: str) -> tuple[Node, list[str]]:
    """The tree of a page, with the elements that HTML implies, and the texts of its style elements."""
    root, styles = Node("html", {}), []
    open_ = _Open(root)
    stack, at = open_.stack, open_.at
    for kind, name, attrs in tokens(page):
        if kind == "text":
            if stack[-1].tag == "head" and name.strip():
                open_.cut(len(stack) - 1)
            if name:
                stack[-1].children.append(name)
            if stack[-1].tag == "style" and stack[-1].attrs.get("media", "all").lower() in ("", "all", "screen"):
                styles.append(name)
        elif kind == "start":
            if name in ("html", "body") and at.get(name):
                for k, v in attrs.items():
                    stack[at[name][0]].attrs.setdefault(k, v)
                continue
            if stack[-1].tag == "head" and name not in _HEAD_ONLY:
                open_.cut(len(stack) - 1)
            if name in CLOSES:
                open_.close(*CLOSES[name])
            if name in BLOCK:  # a block ends an open paragraph
                open_.close({"p"}, _INLINE_WALL | {"button", "object"})
                if name in HEADINGS and stack[-1].tag in HEADINGS:
                    open_.cut(len(stack) - 1)
            if name in ("td", "th") and stack[-1].tag != "tr" and at.get("table"):
                if stack[-1].tag == "table":
                    open_.push(Node("tbody", {}))
                open_.push(Node("tr", {}))
            elif name == "tr" and stack[-1].tag == "table":
                open_.push(Node("tbody", {}))
            open_.push(Node(name, attrs))
            if name in VOID:
                open_.cut(len(stack) - 1)
        elif name == "br":
            stack[-1].children.append(Node("br", {}))
        elif name == "p" and not at.get("p"):
            stack[-1].children.append(Node("p", {}))
        elif name not in ("html", "body"):
            wall = () if name in _PARTS_OF_TABLE else ("table",) if name in ("td", "th") else ("table", "td", "th")
            i = open_.last((name,))
            if i > 0 and i > open_.last(w for w in wall if w != name):
                open_.cut(i)
    return root, styles


def declarations(css: str) -> list[tuple[str, str, bool]]:
    """(property, value, important) of display and visibility, in order."""
    out = []
    for part in _COMMENT.sub(" ", css).split(";"):
        name, colon, value = part.partition(":")
        name, value = name.strip().lower(), value.strip().lower()
        if colon and name in _VALUES:
            plain = re.sub(r"\s*!\s*important$", "", value)
            if plain in _VALUES[name]:
                out.append((name, plain, plain != value))
    return out


def style_rules(styles: list[str]) -> dict[tuple, list]:
    """By (tag or "", . or # or "", name or "") of the simple selectors: (property, value, important, order)."""
    out: dict[tuple, list] = {}
    order = 0
    for css in styles:
        css, depth, start, opened = _COMMENT.sub(" ", css), 0, 0, 0
        for m in _BRACE.finditer(css):
            if m[0] == "{":
                opened, depth = (m.end() if not depth else opened), depth + 1
                continue
            depth = max(0, depth - 1)
            if not depth:
                names, body = css[start : max(start, opened - 1)].strip(), css[opened : m.start()]
                start = m.end()
                if not names.startswith("@") and "{" not in body and (made := declarations(body)):
                    for one in names.split(","):
                        if (s := _SELECTOR.fullmatch(one.strip())) and s[0]:
                            out.setdefault(((s[1] or "").lower(), s[2] or "", s[3] or ""), []).extend((*d, order + i) for i, d in enumerate(made))
                    order += len(made)
    return out


def style(node: Node, rules: dict) -> tuple[bool, str | None]:
    """(whether the element is drawn at all, its own visibility; None where it inherits)."""
    a, tag = node.attrs, node.tag
    if tag in HIDDEN or (tag == "input" and a.get("type", "").lower() == "hidden"):
        return False, None
    best: dict[str, tuple] = {"display": ((False, -1, 0), "none")} if "hidden" in a or (tag == "dialog" and "open" not in a) else {}

    def weigh(name: str, value: str, rank: tuple) -> None:
        if name not in best or rank >= best[name][0]:
            best[name] = rank, value

    if rules:
        own = [("", ""), *((".", c) for c in set(a.get("class", "").split())), *([("#", a["id"])] if "id" in a else [])]
        for kind, word in own:
            for t in (tag, ""):
                for name, value, important, order in rules.get((t, kind, word), ()):
                    weigh(name, value, (important, {"": 0, ".": 10, "#": 100}[kind] + bool(t), order))
    if "style" in a:
        for order, (name, value, important) in enumerate(declarations(a["style"])):
            weigh(name, value, (important, 1_000, order))
    seen = best.get("visibility", (None, None))[1]
    seen = "visible" if seen == "initial" else None if seen in ("inherit", "unset", "revert") else seen
    drawn = best.get("display", (None, ""))[1] != "none"
    if seen == "collapse" and tag in ("tr", "thead", "tbody", "tfoot"):
        drawn = False
    return drawn, seen


def visible(node: Node, rules: dict) -> bool:
    return style(node, rules)[0]


def _shown_options(select: Node, rules: dict) -> list[Node]:
    """The option that a select shows, or all of a list box."""
    options = []
    for x in select.children:
        for o in [x, *x.children] if isinstance(x, Node) and visible(x, rules) else ():
            if isinstance(o, Node) and o.tag == "option" and visible(o, rules):
                options.append(o)
    if "multiple" in select.attrs or re.fullmatch(r"0*([2-9]|[1-9]\d+)", select.attrs.get("size", "")):
        return options
    return ([o for o in options if "selected" in o.attrs][-1:] or [o for o in options if "disabled" not in o.attrs][:1]) if options else []


class _Flow:
    """Text in lines: collapses white space, keeps block breaks, indents."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.indent, self.mark, self.gap, self.space = 0, "", False, False

    def text(self, s: str, keep: bool) -> None:
        if keep:
            for i, line in enumerate(s.expandtabs(8).replace("\r", "").split("\n")):
                if i:
                    self.end_line(True)
                self.parts.append(line)
            return
        words = _SPACES.split(s)
        if len(words) > 1 and not words[0]:
            self.space = True
        body = " ".join(w for w in words if w)
        if body:
            self.parts.append((" " if self.space and self.parts else "") + body)
            self.space = len(words) > 1 and not words[-1]

    def end_line(self, even_empty: bool = False) -> None:
        line = "".join(self.parts).rstrip(" ")
        self.parts, self.space = [], False
        if line or even_empty or self.mark:
            if self.gap and self.lines and self.lines[-1]:
                self.lines.append("")
            self.gap = False
            self.lines.append((" " * max(0, min(self.indent, INDENT) - len(self.mark)) + self.mark + line).rstrip(" "))
            self.mark = ""

    def block(self, spaced: bool) -> None:
        if self.parts:
            self.end_line()
        self.gap |= spaced

    def done(self) -> str:
        if self.parts or self.mark:
            self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        while self.lines and not self.lines[0]:
            self.lines.pop(0)
        return "\n".join(self.lines)


def _rows(table_: Node, rules: dict, seen: bool):
    """(what stands before the table, rows of drawn cells), each with whether it inherits being seen, in order; nested tables
    aren't entered."""
    captions, rows, todo = [], [], [(x, seen) for x in reversed(table_.children)]
    while todo:
        x, seen = todo.pop()
        if isinstance(x, str):
            if x.strip():
                captions.append((x, seen))
            continue
        drawn, own = style(x, rules)
        if not drawn:
            continue
        inside = own == "visible" if own else seen
        if x.tag in ("thead", "tbody", "tfoot", "colgroup"):
            todo += [(c, inside) for c in reversed(x.children)]
        elif x.tag == "tr":
            row = []
            for c in x.children:
                if isinstance(c, Node) and c.tag in ("td", "th"):
                    if visible(c, rules):
                        row.append((c, inside))
                elif not isinstance(c, str) or c.strip():
                    captions.append((c, inside))  # as browsers do
            rows.append(row)
        else:
            captions.append((x, seen))
    return captions, rows


class _Columns:
    """The columns that no cell of an earlier row holds, as gaps [start, end) in order; the last one has no end."""

    def __init__(self):
        self.starts, self.ends, self.held = [0], [float("inf")], []

    def row(self, n: int) -> None:
        """Begin row n: columns that are held up to the row before are free again."""
        while self.held and self.held[0][0] <= n:
            _, a, b = heapq.heappop(self.held)
            i = bisect.bisect_right(self.starts, a)
            if i and self.ends[i - 1] == a:
                i -= 1
                a = self.starts[i]
                del self.starts[i], self.ends[i]
            if self.starts[i] == b:
                b = self.ends[i]
                del self.starts[i], self.ends[i]
            self.starts.insert(i, a)
            self.ends.insert(i, b)

    def free(self, col: int) -> int:
        """The first free column from col on."""
        return max(col, self.starts[bisect.bisect_right(self.ends, col)])

    def hold(self, a: int, b: int, until: int) -> None:
        """Hold what is free of [a, b) for the rows before `until`."""
        i = bisect.bisect_right(self.ends, a)
        while self.starts[i] < b:
            start, end = self.starts[i], self.ends[i]
            left, right = max(start, a), min(end, b)
            heapq.heappush(self.held, (until, left, right))
            pieces = [(x, y) for x, y in ((start, left), (right, end)) if x < y]
            self.starts[i : i + 1], self.ends[i : i + 1] = [x for x, _ in pieces], [y for _, y in pieces]
            i += start < left


def _align(rows: list[list[tuple[str, int, int]]]) -> list[str]:
    """Lines of the cells (text, columns, rows) in columns of equal width, two spaces between; a cell's further lines stay
    in its column, and a column that no cell begins in takes no room. A cell takes the first free columns of its row."""
    placed, columns = [], _Columns()
    for n, cells in enumerate(rows):
        columns.row(n)
        col, row, later = 0, [], []
        for text, across, down in cells:
            col = columns.free(col)
            row.append((col, across, text.split("\n")))
            if down > 1:
                later.append((col, col + across, n + down))
            col += across
        for span in later:
            columns.hold(*span)
        if any(any(t) for _, _, t in row):
            placed.append(row)
    width: dict[int, int] = {}
    for row in placed:
        for col, across, text in row:
            width[col] = max(width.get(col, 0), *(map(len, text) if across == 1 else [0]))
    starts, at = {}, 0
    for col in sorted(width):
        starts[col], at = at, at + width[col] + 2
    lines = []
    for row in placed:
        own: list[list[str]] = [[] for _ in range(max(len(t) for _, _, t in row))]
        filled = [0] * len(own)
        for col, _, text in row:
            for i, words in enumerate(text):
                if words:
                    gap = min(max(starts[col] - filled[i], 2 if filled[i] else 0), PADDING)
                    own[i].append(" " * gap + words)
                    filled[i] += gap + len(words)
        lines += ["".join(parts).rstrip(" ") for parts in own]
    return lines


def render(page: str | None) -> str:
    """The visible text of a page. Work on open elements is kept on a list, so depth isn't bounded by the interpreter."""
    if not page:
        return ""
    (root, styles), out = build(page), _Flow()
    rules = style_rules(styles)
    # frames: (flow, step, preformatted, innermost list, seen); a step is a node, a text or a function to call in its turn
    todo: list = [(out, root, False, None, True)]
    while todo:
        flow, x, keep, lists, seen = todo.pop()
        if callable(x):
            x()
        elif isinstance(x, str):
            if seen:
                flow.text(x, keep)
        else:
            drawn, own = style(x, rules)
            if drawn:
                _enter(todo, flow, x, keep, lists, own == "visible" if own else seen, rules)
    return out.done()


def _mark(n: int, kind: str) -> str:
    """A list item's number as its list's type writes it."""
    if kind in ("a", "A") and n > 0:
        text = ""
        while n:
            n, r = divmod(n - 1, 26)
            text = chr(97 + r) + text
    elif kind in ("i", "I") and 0 < n < 4_000:
        text = ""
        for value, letters in _ROMAN:
            text += letters * (n // value)
            n %= value
    else:
        return f"{n}. "
    return f"{text.upper() if kind.isupper() else text}. "


def _enter(todo: list, flow: _Flow, x: Node, keep: bool, lists: list | None, seen: bool, rules: dict) -> None:
    tag = x.tag
    if tag == "br":
        if seen:
            flow.end_line(True)
        return
    if tag == "wbr":
        return
    if tag in ("img", "input"):
        kind = x.attrs.get("type", "text").strip().lower()
        shown = "alt" if tag == "img" or kind == "image" else "value" if kind not in _NO_FIELDS else None
        if seen and shown:
            flow.text(x.attrs.get(shown, ""), False)
        return
    if tag == "table":
        _enter_table(todo, flow, x, lists, seen, rules)
        return
    if tag == "select":
        shown = [c for o in _shown_options(x, rules) for c in [o.attrs.get("label") or " ".join(c for c in o.children if isinstance(c, str)), " "]]
        todo += [(flow, c, False, lists, seen) for c in reversed(shown)]
        return
    block, spaced = tag in BLOCK, tag in SPACED and not (tag in ("ul", "ol", "menu") and lists)
    steps: list = []
    if block:
        flow.block(spaced)
        steps.append(lambda: flow.block(spaced))
    if tag in ("ul", "ol", "menu"):
        start, back = x.attrs.get("start", ""), tag == "ol" and "reversed" in x.attrs
        first = int(start) if re.fullmatch(r"-?\d{1,9}", start) else sum(isinstance(c, Node) and c.tag == "li" and visible(c, rules) for c in x.children) if back else 1
        lists = [tag == "ol", first, -1 if back else 1, x.attrs.get("type", "1")]  # the innermost list's kind, next number, step and type
    elif tag == "li":
        own = lists or [False, 1, 1, "1"]
        value = x.attrs.get("value", "")
        if own[0] and re.fullmatch(r"-?\d{1,9}", value):
            own[1] = int(value)
        mark = _mark(own[1], x.attrs.get("type", own[3])) if own[0] else "- "
        own[1] += own[2]
        flow.indent += len(mark)
        flow.mark = mark if seen else ""
        steps.insert(0, lambda: _outdent(flow, len(mark)))
    elif tag in ("blockquote", "dd"):
        flow.indent += 4
        steps.insert(0, lambda: _outdent(flow, 4))
    elif tag in ("td", "th"):
        flow.space = True
    keep = keep or tag in ("pre", "xmp", "listing", "textarea")
    children = x.children
    if tag == "pre" and children and isinstance(children[0], str) and children[0].startswith("\n"):
        children = [children[0][1:], *children[1:]]
    if tag == "details" and "open" not in x.attrs:
        children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
    todo += [(flow, s, keep, lists, seen) for s in reversed(steps)]
    todo += [(flow, c, keep, lists, seen) for c in reversed(children)]


def _outdent(flow: _Flow, by: int) -> None:
    if flow.parts or flow.mark:
        flow.end_line()
    flow.indent -= by


def _span(x: Node, name: str, most: int) -> int:
    text = x.attrs.get(name, "").strip()
    return min(most, int(text)) if re.fullmatch(r"0*[1-9]\d{0,8}", text) else most if name == "rowspan" and re.fullmatch(r"0+", text) else 1


def _enter_table(todo: list, flow: _Flow, x: Node, lists: list | None, seen: bool, rules: dict) -> None:
    captions, rows = _rows(x, rules, seen)
    flow.block(True)
    cells = []
    for row in rows:
        cells.append([])
        for c, inherited in row:
            own = style(c, rules)[1]
            cells[-1].append((_Flow(), c, own == "visible" if own else inherited))

    def finish() -> None:
        for line in _align([[(f.done(), _span(c, "colspan", COLSPAN), _span(c, "rowspan", ROWSPAN)) for f, c, _ in row] for row in cells]):
            flow.parts.append(line)
            flow.end_line(True)
        flow.block(True)

    todo.append((flow, finish, False, None, seen))
    for row in reversed(cells):
        for f, c, shown in reversed(row):
            todo += [(f, child, False, None, shown) for child in reversed(c.children)]
    todo.append((flow, lambda: flow.block(False), False, None, seen))
    todo += [(flow, c, False, lists, inherited) for c, inherited in reversed(captions)]


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per row of pages: page_id, text, n_chars, n_lines, text_sha256.

    A null or empty page has an empty text. Broken markup never fails: it is mended as browsers do, or read as text. Very
    long pages are read whole, in time and memory that follow their length. Repeated rows give repeated results; a null id stays null. Other columns, whatever their names, are not read; an empty
    table gives an empty result."""
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{html_col}`").cast("string").alias("html"))

    def run(batches):
        for b in batches:
            texts = [render(h) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "page_id": b.column("page_id"), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                "n_lines": pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64()), "text_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
            })

    return rows.mapInArrow(run, "page_id long, text string, n_chars long, n_lines long, text_sha256 string")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
