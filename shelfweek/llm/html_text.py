"""Visible text of HTML pages, laid out as a page would show it.

A tree builder with implied start and end tags is followed by a renderer that
knows which elements are visible, which start a block, and how lists and tables
are laid out. All visible text is kept, navigation and footers included.
"""

import html
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfweek.llm.common import plainly, quoted, renamed

# Element names of HTML by how they are parsed and shown.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "head script style template noscript iframe noembed noframes datalist title meta link base "
    "audio video canvas object svg math area param source track rp".split()
)
BLOCK = frozenset(
    "address article aside body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form header hgroup html legend li main menu nav optgroup option search section summary "
    "caption tr thead tbody tfoot".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol blockquote pre table hr xmp".split())
ENDS_PARAGRAPH = BLOCK - {"tr", "thead", "tbody", "tfoot", "caption", "option", "optgroup", "body", "html"} | SPACED
# Start tag -> open elements it ends, up to the nearest of the limits.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"optgroup"}, {"select", "datalist"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "caption": ({"caption", "colgroup"}, {"table"}),
    "colgroup": ({"caption", "colgroup"}, {"table"}),
}
HEAD_ONLY = frozenset("head title base link meta style script noscript template".split())
# An end tag closes nothing outside the nearest of these.
SCOPE = frozenset("table td th caption button object template".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTES = re.compile(r"""(?:[^>"'=]|=\s*"[^"]*"|=\s*'[^']*'|[="'])*?>""")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_TOLD = re.compile(r"hidden|style|open|type|value|colspan|rowspan|start|reversed", re.I)
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)
_SPAN = re.compile(r"[0-9]{1,5}")
_BLANKS = re.compile(r"[ \t\n\r\f]+")


class Element:
    __slots__ = ("name", "attributes", "children", "seen")

    def __init__(self, name: str, attributes: dict):
        self.name, self.attributes, self.children, self.seen = name, attributes, [], True


class Open:
    """The open elements, with the places of each name, so that none is searched for one by one."""

    def __init__(self, root: Element):
        self.elements, self.places = [root], defaultdict(list)

    @property
    def top(self) -> Element:
        return self.elements[-1]

    def push(self, element: Element):
        self.places[element.name].append(len(self.elements))
        self.elements.append(element)

    def last(self, names) -> int:
        """Place of the innermost open element of these names, 0 if there is none."""
        return max((self.places[x][-1] for x in names if self.places.get(x)), default=0)

    def end(self, place: int):
        """Ends the element at a place and all inside it."""
        while len(self.elements) > place:
            self.places[self.elements.pop().name].pop()

    def end_one(self, names, limits):
        """Ends the innermost of the names, unless one of the limits is open inside it."""
        place = self.last(names)
        if place and place >= self.last(limits):
            self.end(place)


def _attributes(text: str) -> dict:
    if not _TOLD.search(text):
        return {}
    return {
        m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)
    }


def _tag_end(page: str, at: int) -> int:
    """Place after the > that ends a tag; quoted ones do not count."""
    while True:
        end = page.find(">", at)
        if end < 0:
            return -1
        quote = re.compile("""=\\s*(["'])""").search(page, at, end)
        if not quote:
            return end + 1
        close = page.find(quote[1], quote.end())
        if close < 0:
            return end + 1
        at = close + 1


def parse(page: str) -> Element:
    """The tree of a page. Unclosed and misplaced tags are put right, nothing is refused."""
    root = Element("#root", {})
    opened = Open(root)
    lower = None

    def text(part: str):
        if part:
            opened.top.children.append(html.unescape(part))

    at, size = 0, len(page)
    while at < size:
        tag = page.find("<", at)
        if tag < 0:
            text(page[at:])
            break
        text(page[at:tag])
        following = page[tag + 1 : tag + 2]
        if page.startswith("<!--", tag):
            end = page.find("-->", tag + 2)
            at = size if end < 0 else end + 3
        elif following in ("!", "?"):
            end = page.find(">", tag)
            at = size if end < 0 else end + 1
        elif following == "/":
            name = _NAME.match(page, tag + 2)
            end = page.find(">", tag)
            at = size if end < 0 else end + 1
            if name:
                _close(opened, name[0].lower())
        elif name := _NAME.match(page, tag + 1):
            end = _tag_end(page, name.end())
            if end < 0:
                break
            at = end
            kind = name[0].lower()
            element = Element(kind, _attributes(page[name.end() : end - 1]))
            _open(opened, element)
            if kind in RAW:
                if lower is None:
                    lower = page.lower() if len(page.lower()) == size else page
                close = lower.find("</" + kind, at)
                body = page[at : size if close < 0 else close]
                element.children.append(html.unescape(body) if kind in ("textarea", "title") else body)
                at = size if close < 0 else close
                if close < 0:
                    opened.end(len(opened.elements) - 1)
        else:
            text("<")
            at = tag + 1
    return root


def _open(opened: Open, element: Element) -> None:
    kind = element.name
    if kind not in HEAD_ONLY and opened.top.name == "head":
        opened.end(len(opened.elements) - 1)
    if kind in ("html", "body") and opened.last((kind,)):
        return
    if kind in IMPLIED_END:
        opened.end_one(*IMPLIED_END[kind])
    if kind in ENDS_PARAGRAPH:
        opened.end_one(("p",), SCOPE)
    if kind in ("td", "th") and opened.top.name in ("table", "thead", "tbody", "tfoot"):
        row = Element("tr", {})
        opened.top.children.append(row)
        opened.push(row)
    opened.top.children.append(element)
    if kind not in VOID:
        opened.push(element)


def _close(opened: Open, kind: str) -> None:
    if kind in ("html", "body"):
        return
    if kind == "br":
        opened.top.children.append(Element("br", {}))
        return
    place = opened.last((kind,))
    limit = 0 if kind in ("table", "tr", "tbody", "thead", "tfoot") else opened.last(SCOPE)
    if place and place >= limit:
        opened.end(place)
    elif kind == "p":
        opened.top.children.append(Element("p", {}))


def rendered(element: Element, parent: Element) -> bool:
    """Whether the element and what is in it has a place on the page."""
    own = element.attributes
    if element.name in HIDDEN or "hidden" in own or _NO_DISPLAY.search(own.get("style", "")):
        return False
    if element.name == "dialog":
        return "open" in own
    if parent.name == "details" and "open" not in parent.attributes:
        return element.name == "summary"
    return True


def seen(element: Element, parent: Element) -> bool:
    """Whether its own text is visible: as its style says, else as its parent's is."""
    told = _VISIBILITY.findall(element.attributes.get("style", ""))
    return told[-1].lower() == "visible" if told else parent.seen


class Flow:
    """Lines of running text; spacing between blocks is written when text follows."""

    def __init__(self):
        self.parts, self.breaks, self.blank, self.begun = [], 0, False, False
        self.indent, self.marker = 0, ""

    def gap(self, lines: int):
        if not lines:
            return
        self.breaks = max(self.breaks, lines)
        self.blank = False

    def line_break(self):
        self.breaks += 1
        self.blank = False

    def _start(self):
        if self.begun and self.breaks:
            self.parts.append("\n" * self.breaks)
        if not self.begun or self.breaks:
            marker = self.marker
            self.parts.append(" " * (self.indent - len(marker)) + marker)
            self.marker = ""
        elif self.blank:
            self.parts.append(" ")
        self.breaks, self.blank, self.begun = 0, False, True

    def text(self, text: str):
        words = _BLANKS.sub(" ", text)
        if not words.strip(" "):
            self.blank |= bool(words) and self.begun and not self.breaks
            return
        self.blank |= words[0] == " "
        self._start()
        self.parts.append(words.strip(" "))
        self.blank = words[-1] == " "

    def lines(self, lines: list[str]):
        """Lines that keep their blanks."""
        for n, line in enumerate(lines):
            if n:
                self.line_break()
            if line.strip():
                self._start()
                self.parts.append(line.rstrip())

    def done(self) -> str:
        return "".join(self.parts)


class Grid:
    """Rows of cells. A cell that spans rows keeps its columns free in those below."""

    def __init__(self):
        self.rows: list[list[str]] = []
        self.spanned: dict[int, int] = {}
        self.taken: set[int] = set()

    def row(self):
        self.rows.append([])
        self.taken = set(self.spanned)
        self.spanned = {column: left - 1 for column, left in self.spanned.items() if left > 1}

    def cell(self, text: str, columns: int, rows: int):
        if not self.rows:
            self.row()
        own = self.rows[-1]
        while len(own) in self.taken:
            own.append("")
        if rows > 1:
            self.spanned |= dict.fromkeys(range(len(own), len(own) + columns), rows - 1)
        own += [text] + [""] * (columns - 1)

    def aligned(self) -> list[str]:
        rows = [r for r in self.rows if any(r)]
        widths = [0] * max(map(len, rows), default=0)
        for row in rows:
            for n, cell in enumerate(row):
                widths[n] = max(widths[n], max(map(len, cell.split("\n"))))
        lines = []
        for row in rows:
            cells = [c.split("\n") for c in row]
            for n in range(max(map(len, cells))):
                own = [c[n] if n < len(c) else "" for c in cells]
                lines.append("  ".join(c.ljust(w) for c, w in zip(own, widths)).rstrip())
        return lines


def render(root: Element) -> str:
    """The visible text of a tree, without recursion, so that any depth is fine."""
    flows, lists, grids, keep = [Flow()], [], [], 0
    todo = [("enter", root, root)]
    while todo:
        what, node, parent = todo.pop()
        if isinstance(node, str):
            if not parent.seen or parent.name == "details" and "open" not in parent.attributes:
                continue
            if keep:
                flows[-1].lines(node.removeprefix("\n").split("\n"))
            elif node.strip(" \t\n\r\f") or parent.name not in ("table", "tr", "thead", "tbody", "tfoot"):
                flows[-1].text(node)
            continue
        kind = node.name
        flow = flows[-1]
        if what == "leave":
            if kind == "pre" or kind == "xmp":
                keep -= 1
            if kind in ("td", "th"):
                if grids:
                    flows.pop()
                    spans = (node.attributes.get(name, "1") for name in ("colspan", "rowspan"))
                    columns, rows = (max(1, int(x)) if _SPAN.fullmatch(x) else 1 for x in spans)
                    grids[-1].cell(flow.done(), min(columns, 100), rows)
                continue
            if kind == "table":
                lines = grids.pop().aligned()
                flow.gap(2)
                flow.lines(lines)
                flow.gap(2)
                continue
            if kind in ("ul", "ol", "menu", "dir"):
                lists.pop()
                flow.indent -= 4
            if kind in ("blockquote", "dd"):
                flow.indent -= 4
            flow.gap(2 if kind in SPACED and not (kind in ("ul", "ol") and lists) else 1 if kind in BLOCK else 0)
            continue
        if node is not root:
            if not rendered(node, parent):
                continue
            node.seen = seen(node, parent)
        if kind == "br":
            flow.line_break()
            continue
        if kind == "hr":
            flow.gap(2)
            continue
        if kind == "wbr" or kind == "img":
            continue
        if kind == "input":
            if node.seen and node.attributes.get("type", "").lower() in ("submit", "button", "reset"):
                flow.text(node.attributes.get("value", ""))
            continue
        flow.gap(2 if kind in SPACED and not (kind in ("ul", "ol") and lists) else 1 if kind in BLOCK else 0)
        if kind in ("td", "th") and grids:
            flows.append(Flow())
        elif kind == "table":
            grids.append(Grid())
        elif kind == "tr" and grids:
            grids[-1].row()
        elif kind in ("ul", "ol", "menu", "dir"):
            first = node.attributes.get("start", "1")
            lists.append([kind, int(first) if re.fullmatch(r"-?[0-9]{1,9}", first) else 1])
            flow.indent += 4
        elif kind == "li":
            if lists and lists[-1][0] == "ol":
                flow.marker = f"{lists[-1][1]}. "
                lists[-1][1] += 1
            else:
                flow.marker = "- "
            if not node.seen:
                flow.marker = ""
            flow.marker = flow.marker.rjust(min(4, flow.indent))
        elif kind in ("blockquote", "dd"):
            flow.indent += 4
        elif kind in ("pre", "xmp"):
            keep += 1
        todo.append(("leave", node, parent))
        todo.extend(("enter", child, node) for child in reversed(node.children))
    return flows[0].done()


def page_text(page: str | None) -> str:
    return render(parse(page)) if page else ""


def _extract(keep: list[str]):
    def extract(batches):
        for batch in batches:
            texts = [page_text(p) for p in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(texts, pa.string())], names=[*keep, "text"]
            )

    return extract


def extract_text(pages: DataFrame, *, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all but the page by default) with its visible ``text``.

    Whole pages are read, one at a time. A null or empty page and one without
    visible text give an empty text; repeated rows give the same one. A column
    of the input named ``text`` is replaced. Broken markup is put right as far
    as its open tags tell; nothing is refused. Of styles those in the tags count,
    not style sheets. An empty table gives no rows.
    """
    keep = [c for c in (keep or pages.columns) if c not in (html_col, "text")]
    plain, columns = plainly(keep)
    schema = pages.select(columns).schema.add("text", "string")
    rows = pages.select(*columns, F.col(quoted(html_col)).cast("string").alias("body"))
    return rows.mapInArrow(_extract(plain), schema).select(*renamed(plain, keep), "text")
