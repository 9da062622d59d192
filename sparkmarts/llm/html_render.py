"""Layout-aware text rendering of HTML.

A tokenizer feeds a tree builder that supplies the tags HTML leaves out
(implied ends of paragraphs, list items, cells and the like); a renderer walks
the tree, drops what a browser does not show, and lays out blocks, lists,
preformatted text and tables with aligned cells."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from sparkmarts.llm.common import map_slices, texts_of

# Element names of the HTML standard, by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
TEXT_ONLY = frozenset("title textarea".split())
HIDDEN = frozenset(
    "head script style template noscript iframe object canvas audio video datalist title noembed noframes "
    "meta link base param source track rp".split()
)
#: what a browser does not draw of a drawing or a formula where it stands
_UNDRAWN = {
    "svg": frozenset("defs metadata title desc symbol clippath mask marker pattern".split()),
    "math": frozenset("annotation annotation-xml mphantom".split()),
}
#: parts of a formula that stand above, below or beside each other
_APART = frozenset("mfrac msub msup msubsup munder mover munderover mroot mmultiscripts mtr".split())
#: HTML start tags that end an open svg or math, and the elements inside these that hold HTML again
_BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr "
    "ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
_HTML_INSIDE = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary ul xmp "
    "listing table caption thead tbody tfoot tr td th".split()
)
#: blocks set off by an empty line
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote ul ol dl pre table figure fieldset xmp listing hr menu dir".split())
_P_ENDS = BLOCK - frozenset("body html dd dt li legend caption thead tbody tfoot tr td th".split()) | frozenset(["table"])
#: an opening tag ends these open elements, up to (not through) the barriers
_CLOSES = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir".split())),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset("tr td th caption colgroup".split()), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "thead": (frozenset("thead tbody tfoot tr td th caption colgroup".split()), frozenset(["table"])),
    "tbody": (frozenset("thead tbody tfoot tr td th caption colgroup".split()), frozenset(["table"])),
    "tfoot": (frozenset("thead tbody tfoot tr td th caption colgroup".split()), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "body": (frozenset(["head"]), frozenset()),
}
#: parts of a table, and where the parts may stand; elements in between are left when a part begins
_PARTS = {
    "tr": frozenset("table thead tbody tfoot".split()),
    "td": frozenset("table thead tbody tfoot tr".split()),
    "th": frozenset("table thead tbody tfoot tr".split()),
    "thead": frozenset(["table"]),
    "tbody": frozenset(["table"]),
    "tfoot": frozenset(["table"]),
}
#: what may stand in a head; any other start tag and any text begin the body
_IN_HEAD = frozenset("base basefont bgsound link meta title style script noscript noframes template head".split())
_TABLE_PARTS = frozenset("caption col colgroup tbody td tfoot th thead tr".split())
_SCOPE = frozenset("table td th caption html template object foreignobject".split())

_TAG = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*+)[^>]*+>|"
    # a quoted value, which may hold >, counts only after an equals sign
    r"<([a-zA-Z][^\s/>]*+)((?>[^>=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)>",
    re.S,
)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?")
_UNSHOWN = re.compile(r"(?<![\w-])display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"(?<![\w-])visibility\s*:\s*(hidden|collapse|visible)", re.I)
#: inputs whose value is no text on the page
_TEXTLESS = frozenset("hidden password checkbox radio file image color range".split())
_SPACE = re.compile(r"[ \t\n\f\r]+")
_RUNS = ("  ", "\t", "\n", "\f", "\r")
_EMPTY_TAIL = re.compile(r"\n{3,}")
MAX_DEPTH = 512


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.kids = tag, attrs, []


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in _ATTR.findall(raw):
        if value[:1] in "\"'" and len(value) > 1:
            value = value[1:-1]
        out.setdefault(name.lower(), html.unescape(value) if "&" in value else value)
    return out


def parse(source: str) -> Node:
    """The tree of a page. Elements nested deeper than MAX_DEPTH become
    siblings at that depth, so that no input exhausts the stack."""
    root = Node("html", {})
    stack = [root]

    def text(s: str) -> None:
        if s:
            if stack[-1].tag == "head" and s.strip():
                stack.pop()
            stack[-1].kids.append(html.unescape(s) if "&" in s else s)

    def close(tags: frozenset, barriers: frozenset) -> None:
        for i in range(len(stack) - 1, 0, -1):
            tag = stack[i].tag
            if tag in tags:
                del stack[i:]
                # what stands above may end as well, e.g. a row above a cell
                close(tags, barriers)
                return
            if tag in barriers:
                return

    drawn = re.search("<(?:svg|math)", source, re.I)

    def foreign() -> int:
        """Place of the svg or math whose content is read, or 0."""
        for i in range(len(stack) - 1 if drawn else 0, 0, -1):
            if stack[i].tag in ("svg", "math"):
                return i
            if stack[i].tag in _HTML_INSIDE or stack[i].tag in BLOCK:
                return 0
        return 0

    def astray() -> bool:
        """Whether HTML inside a drawing or formula is read that opened no table there."""
        for i in range(len(stack) - 1 if drawn else 0, 0, -1):
            if stack[i].tag in ("table", "template"):
                return False
            if stack[i].tag in _HTML_INSIDE and any(x.tag in ("svg", "math") for x in stack[:i]):
                return True
        return False

    at = 0
    closed = source.rfind(">") + 1  # nothing behind it can be a tag
    while True:
        m = _TAG.search(source, at, closed)
        if not m:
            tail = source.find("<!", max(at, closed - 1))
            text(source[at : tail if tail >= 0 else None])
            return root
        text(source[at : m.start()])
        at = m.end()
        if at == closed and m[0].startswith("<!--") and not m[0].endswith(("-->", "--!>")) and m[0] != "<!-->":
            return root  # a comment without an end
        if m[1]:
            tag = m[1].lower()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in _SCOPE and tag not in _SCOPE and tag not in ("tr", "thead", "tbody", "tfoot", "body"):
                    break
            else:
                if tag == "p":
                    stack[-1].kids.append(Node("p", {}))
                elif tag == "br":
                    stack[-1].kids.append(Node("br", {}))
            continue
        if not m[2]:
            if m[0].startswith("<![CDATA[") and foreign():
                end = source.find("]]>", m.start())
                at = end + 3 if end >= 0 else len(source)
                stack[-1].kids.append(source[m.start() + 9 : end if end >= 0 else None])
            continue
        tag = m[2].lower()
        if tag == "html":
            for name, value in _attributes(m[3]).items():
                root.attrs.setdefault(name, value)
            continue
        inside = foreign()
        while inside and tag in _BREAKOUT:
            del stack[inside:]
            inside = foreign()
        if inside:
            a = _attributes(m[3].removesuffix("/"))
            if tag in _UNDRAWN[stack[inside].tag] or a.get("display") == "none" or a.get("visibility") in ("hidden", "collapse"):
                a["hidden"] = ""
            node = Node(f"svg:{tag}" if tag in BLOCK else tag, a)  # not the HTML element of that name
            stack[-1].kids.append(node)
            if not m[3].endswith("/") and len(stack) < MAX_DEPTH:
                stack.append(node)
            continue
        if drawn and tag in _TABLE_PARTS and astray():
            continue  # cells and rows need their table there
        if tag == "head" and (len(stack) > 1 or any(isinstance(k, Node) or k.strip() for k in root.kids)):
            continue  # a head after the page's first content is none
        if stack[-1].tag == "head" and tag not in _IN_HEAD:
            stack.pop()
        if tag in _P_ENDS:
            close(frozenset(["p"]), _SCOPE)
        if tag in _CLOSES:
            close(*_CLOSES[tag])
        if tag in _PARTS:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in _PARTS[tag]:
                    del stack[i + 1 :]
                    break
                if stack[i].tag in ("td", "th", "caption", "template"):
                    break
        if tag in ("td", "th") and stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
            _open(stack, Node("tr", {}))
        node = Node(tag, _attributes(m[3]) if m[3].strip() else {})
        stack[-1].kids.append(node)
        if tag in VOID or tag in ("svg", "math") and m[3].endswith("/"):
            continue
        if tag in RAW or tag in TEXT_ONLY:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(source, at)
            body = source[at : end.start() if end else len(source)]
            if tag in TEXT_ONLY:
                body = html.unescape(body)
            node.kids.append(body)
            at = end.end() if end else len(source)
        elif len(stack) < MAX_DEPTH:
            stack.append(node)


def _open(stack: list[Node], node: Node) -> None:
    stack[-1].kids.append(node)
    stack.append(node)


def visible(node: Node) -> bool:
    """Whether the element takes part in the layout; whether its text shows is up to ``hushed``."""
    a = node.attrs
    if node.tag in HIDDEN or "hidden" in a:
        return False
    if node.tag == "dialog" and "open" not in a:
        return False
    if node.tag == "input" and a.get("type", "").lower() == "hidden":
        return False
    return not ("style" in a and _UNSHOWN.search(a["style"]))


def hushed(node: Node, before: bool) -> bool:
    """Whether the text of an element is hidden; what its parent has holds unless it says otherwise."""
    if "style" in node.attrs and (found := _VISIBILITY.findall(node.attrs["style"])):
        return found[-1].lower() != "visible"
    return before


class _Page:
    """Collects lines; ``gap`` is the number of line ends owed before the next text."""

    def __init__(self):
        self.out: list[str] = []
        self.gap = 0
        self.space = False
        self.prefix = ""  # indent of the current block
        self.marker = ""  # list marker that the next text starts with
        self.hush = False  # inside an element of hidden visibility

    def owe(self, n: int) -> None:
        self.space = False
        if self.out:
            self.gap = max(self.gap, n)

    def add(self, s: str) -> None:
        lead = ""
        if not self.out or self.gap:
            lead = "\n" * self.gap + (self.prefix[: len(self.prefix) - len(self.marker)] + self.marker)
            self.gap, self.marker = 0, ""
        elif self.space:
            lead = " "
        self.space = False
        self.out.append(lead + s)

    def inline(self, s: str) -> None:
        if self.hush:
            return
        if any(x in s for x in _RUNS):  # most texts hold single spaces only
            s = _SPACE.sub(" ", s)
        if s == " ":
            self.space = self.space or bool(self.out)
            return
        if s[0] == " ":
            self.space = True
        self.add(s.strip(" "))
        self.space = s[-1] == " "

    def kept(self, s: str) -> None:
        """Preformatted text: its line ends stand."""
        if self.hush:
            return
        for i, line in enumerate(s.split("\n")):
            if i:
                self.gap += 1
            if line:
                self.add(line)


def _width(s: str) -> int:
    return sum(2 if unicodedata.east_asian_width(c) in "WF" else not unicodedata.combining(c) for c in s)


def _span(cell: Node, name: str) -> int:
    v = cell.attrs.get(name, "1")
    return min(max(int(v), 1), 100) if v.isascii() and v.isdigit() and len(v) < 4 else 1


def _parts(table: Node, hush: bool):
    """(is a row, node, whether its text is hidden) of all rows of a table and of all else that stands in it."""
    for kid in table.kids:
        if isinstance(kid, str):
            if kid.strip():
                yield False, kid, hush
        elif visible(kid):
            if kid.tag in ("thead", "tbody", "tfoot", "colgroup"):
                yield from _parts(kid, hushed(kid, hush))
            else:
                yield kid.tag == "tr", kid, hushed(kid, hush) if kid.tag == "tr" else hush


def _render_table(node: Node, page: _Page) -> None:
    before = page.hush
    parts = list(_parts(node, before))
    for is_row, kid, hush in parts:
        if not is_row:
            page.hush = hush
            _render(kid, page)
            if isinstance(kid, Node):
                page.owe(1)
    rows, ends = [], []
    busy: dict[int, int] = {}  # column -> rows still covered from above
    for tr, hush in ((kid, hush) for is_row, kid, hush in parts if is_row):
        line, col = {}, 0
        page.hush = hush
        for kid in tr.kids:
            if isinstance(kid, str) or kid.tag not in ("td", "th"):
                if isinstance(kid, Node) or kid.strip():
                    _render(kid, page)
                continue
            if not visible(kid):
                continue
            while busy.get(col, 0) > 0:
                col += 1
            own = _Page()
            own.hush = hushed(kid, hush)
            for x in kid.kids:
                _render(x, own)
            wide, high = _span(kid, "colspan"), _span(kid, "rowspan")
            line[col] = "".join(own.out).split("\n")
            for c in range(col, col + wide):
                busy[c] = high
            col += wide
        busy = {c: n - 1 for c, n in busy.items() if n > 1}
        rows.append(line)
        ends.append(col)
    page.hush = before
    width: dict[int, int] = {}
    for line in rows:
        for c, cell in line.items():
            width[c] = max(width.get(c, 0), *map(_width, cell))
    page.owe(1)
    for line in rows:
        high = max((len(cell) for cell in line.values()), default=0)
        for i in range(high):
            parts = []
            for c in sorted(width):
                s = line[c][i] if c in line and i < len(line[c]) else ""
                parts.append(s + " " * (width[c] - _width(s)))
            s = " | ".join(parts).rstrip(" ")
            if s.strip(" |"):
                page.add(s)
                page.owe(1)


def _render_svg(node: Node, page: _Page) -> None:
    """Only text and foreign objects of a drawing show characters."""
    for kid in node.kids:
        if isinstance(kid, str) or not visible(kid):
            continue
        if kid.tag in ("text", "foreignobject"):
            page.space = bool(page.out)
            _render(kid, page)
            page.space = bool(page.out)
        else:
            _render_svg(kid, page)


def _render_select(node: Node, page: _Page) -> None:
    """The chosen option, which is the first that can be chosen if none is marked; all of a list that shows several rows."""
    options = []

    def walk(of: Node) -> None:
        for kid in of.kids:
            if isinstance(kid, Node) and visible(kid):
                if kid.tag == "option":
                    options.append(kid)
                else:
                    walk(kid)

    walk(node)
    size = node.attrs.get("size", "")
    if "multiple" not in node.attrs and not (size.isascii() and size.isdigit() and int(size[:9]) > 1):
        options = [x for x in options if "selected" in x.attrs][-1:] or [x for x in options if "disabled" not in x.attrs][:1]
    for x in options:
        page.space = bool(page.out)
        for kid in x.kids:
            _render(kid, page)
        page.space = bool(page.out)


def _render(node, page: _Page, pre: bool = False, depth: int = 0) -> None:
    if isinstance(node, str):
        if pre:
            page.kept(node)
        elif node:
            page.inline(node)
        return
    if not visible(node):
        return
    tag = node.tag
    hush_before = page.hush
    if "style" in node.attrs:
        page.hush = hushed(node, hush_before)
    if tag == "br":
        page.space = False
        if page.out:
            page.gap += 1
        page.hush = hush_before
        return
    if tag == "wbr":
        page.hush = hush_before
        return
    if tag == "img":
        if node.attrs.get("alt", "").strip():
            page.inline(node.attrs["alt"])
        page.hush = hush_before
        return
    if tag == "input":
        kind = node.attrs.get("type", "text").lower()
        if kind not in _TEXTLESS and node.attrs.get("value", "").strip():
            page.inline(node.attrs["value"])
        page.hush = hush_before
        return
    block = tag in BLOCK
    if block:
        page.owe(2 if tag in SPACED and not (tag in ("ul", "ol") and depth) else 1)
    if tag == "table":
        _render_table(node, page)
    elif tag == "svg":
        _render_svg(node, page)
    elif tag == "select":
        _render_select(node, page)
    elif tag in _APART:
        for kid in node.kids:
            _render(kid, page)
            page.space = bool(page.out)
    elif tag in ("ul", "ol", "menu", "dir"):
        number = node.attrs.get("start", "1")
        number = int(number) if re.fullmatch(r"-?[0-9]{1,9}", number) else 1
        for kid in node.kids:
            if isinstance(kid, Node) and kid.tag == "li" and visible(kid):
                value = kid.attrs.get("value", "")
                if tag == "ol" and re.fullmatch(r"-?[0-9]{1,9}", value):
                    number = int(value)
                mark = f"{number}. " if tag == "ol" else "- "
                number += 1
                before, page.prefix, page.marker = page.prefix, page.prefix + " " * len(mark), mark
                page.owe(1)
                for x in kid.kids:
                    _render(x, page, pre, depth + 1)
                page.prefix, page.marker = before, ""
                page.owe(1)
            else:
                _render(kid, page, pre, depth)
    elif tag in ("blockquote", "dd"):
        before, page.prefix = page.prefix, page.prefix + "  "
        for kid in node.kids:
            _render(kid, page, pre, depth)
        page.prefix = before
    else:
        pre = pre or tag in ("pre", "xmp", "listing", "textarea")
        kids = node.kids
        if tag == "details" and "open" not in node.attrs:  # closed: its summary alone
            kids = [x for x in kids if isinstance(x, Node) and x.tag == "summary"][:1]
        if pre and kids and isinstance(kids[0], str) and kids[0].startswith("\n"):
            kids = [kids[0][1:], *kids[1:]]
        for kid in kids:
            _render(kid, page, pre, depth)
        if tag in ("td", "th"):
            page.space = True
    page.hush = hush_before
    if block:
        page.owe(2 if tag in SPACED and not (tag in ("ul", "ol") and depth) else 1)


def tree(source: str) -> Node:
    """``parse`` of a page whose line ends are made one character each."""
    return parse(source.replace("\r\n", "\n").replace("\r", "\n"))


def shown(root: Node) -> str:
    """All visible text of a tree; at most one empty line between blocks."""
    page = _Page()
    for kid in root.kids:
        _render(kid, page)
    return "".join(page.out)


def render(source: str) -> str:
    """All visible text of a page."""
    return shown(tree(source))


def nodes(root: Node, *tags: str) -> Iterator[Node]:
    """The HTML elements of some names, in the order of the page; not those of drawings, formulas and templates."""
    left = root.kids[::-1]
    while left:
        node = left.pop()
        if isinstance(node, str):
            continue
        if node.tag in tags:
            yield node
        if node.tag not in ("svg", "math", "template"):
            left += node.kids[::-1]


def title_in(root: Node) -> str:
    for node in nodes(root, "title"):
        return _SPACE.sub(" ", "".join(k for k in node.kids if isinstance(k, str))).strip()
    return ""


def extract(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None, text_col: str = "rendered") -> DataFrame:
    """Each row of ``pages`` (columns ``keep``, all by default; those named like
    an added one give way) with its title and its visible text. A null or empty
    page has empty ones."""

    def run(part: pa.RecordBatch) -> dict:
        trees = (tree(t.decode("utf-8", "surrogateescape")) for t in texts_of(part, "__text"))
        titles, texts = zip(*((title_in(x), shown(x)) for x in trees), strict=True)
        return {"title": list(titles), text_col: list(texts)}

    return map_slices(pages, html_col, run, f"title string, `{text_col}` string", keep)
