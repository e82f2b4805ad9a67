"""Layout-aware text of web pages: all that a reader would see, in the layout of a terminal.

A small tree builder adds the end tags that HTML lets authors leave out, a few
visibility rules decide what is shown, and the tree is written with blank lines
around paragraphs, marks and indents for lists, and aligned table cells.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from html import unescape
from textwrap import wrap

from pyspark.sql import DataFrame

from stratamart.llm.common import Columns, map_columns, small_batches

# Element kinds of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_HIDDEN = frozenset(
    "head title script style template noscript iframe noembed noframes object audio video canvas datalist "
    "meta link base param source track map area col colgroup defs symbol metadata desc annotation annotation-xml".split()
)
_SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dl table blockquote pre figure form fieldset hr xmp".split())
_BLOCK = _SPACED | frozenset(
    "html body div section article aside header footer nav main address li dt dd tr td th thead tbody tfoot caption "
    "figcaption details summary legend option optgroup select textarea center dialog search hgroup".split()
)
# A start tag closes an open element of these kinds, unless a kind of the second set is met first.
_P_ENDERS = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol menu dl table blockquote pre figure form fieldset hr div section article aside header "
    "footer nav main address li dt dd details summary center figcaption".split()
)
_SCOPE = frozenset("html body table td th caption div section article aside main button".split())
_CLOSES = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu", "table", "td", "th"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl", "table", "td", "th"))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl", "table", "td", "th"))),
    "tr": (frozenset(("tr", "td", "th", "caption")), frozenset(("table",))),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "thead": (frozenset(("thead", "tbody", "tfoot", "tr", "td", "th", "caption")), frozenset(("table",))),
    "tbody": (frozenset(("thead", "tbody", "tfoot", "tr", "td", "th", "caption")), frozenset(("table",))),
    "tfoot": (frozenset(("thead", "tbody", "tfoot", "tr", "td", "th", "caption")), frozenset(("table",))),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",))),
    "body": (frozenset(("head",)), frozenset()),
}
_BODY_ONLY = _BLOCK - {"html", "body"}
_DRAWN = frozenset("path rect circle ellipse line polyline polygon use stop image g text tspan mspace".split())  # may end in />

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|$)", re.DOTALL
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACES = re.compile(r"[ \t\n\r\f]+")
_SHOWN_BY = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([\w-]+)\s*(!\s*important)?", re.I)
_BRACE = re.compile(r"([^{}]*)([{}])")
_PART = re.compile(r"([.#]?)([\w-]+|\*)")
_WIDTH = re.compile(r"\((min|max)-width\s*:\s*([\d.]+)(px|em|rem)\)")
_CELL = 60  # characters; longer lines of a table cell are wrapped
_SCREEN = 1280  # pixels, of the screen that media queries ask about

Node = list  # [tag, attributes, children]; text is a plain string


def _attributes(source: str) -> dict[str, str]:
    if not source or source.isspace():
        return {}
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), unescape(a or b or c))
    return out


def parse(html: str) -> tuple[Node, list[str], int]:
    """The tree of a page, the texts of its style sheets, and its depth."""
    root: Node = ["html", {}, []]
    stack, sheets, at, deepest = [root], [], 0, 1

    def close(kinds: frozenset, until: frozenset) -> None:
        # Further ones of these kinds may be open around the first, as a row around a cell.
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in kinds:
                del stack[i:]
            elif stack[i][0] in until:
                return

    def text(piece: str) -> None:
        if piece:
            if stack[-1][0] == "head" and not piece.isspace():
                del stack[-1:]
            stack[-1][2].append(unescape(piece))

    while at < len(html):
        m = _TOKEN.search(html, at)
        if not m:
            text(html[at:])
            break
        text(html[at : m.start()])
        at = m.end()
        end, tag, rest = m.groups()
        if not tag:
            continue
        tag = tag.lower()
        if end:
            if tag == "br":
                stack[-1][2].append(["br", {}, []])
                continue
            stop = frozenset(("table",)) if tag in ("tr", "td", "th", "tbody", "thead", "tfoot", "caption") else frozenset(("td", "th", "caption")) if tag not in _BLOCK else frozenset(("td", "th")) if tag not in ("table", "body", "html") else frozenset()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag or (tag[0] == "h" and tag[1:].isdigit() and stack[i][0][0] == "h" and stack[i][0][1:].isdigit()):
                    del stack[i:]
                    break
                if stack[i][0] in stop or (tag not in _BLOCK and stack[i][0] in _BLOCK and stack[i][0] != "p"):
                    break
            continue
        if tag in ("html", "head", "body") and tag != "head":
            if tag == "body":
                close(*_CLOSES["body"])
            stack[0][1].update(_attributes(rest))
            continue
        if tag in _BODY_ONLY and stack[-1][0] == "head":
            del stack[-1]
        if tag in _P_ENDERS:
            close(frozenset(("p",)), _SCOPE)
        if tag in _CLOSES:
            close(*_CLOSES[tag])
        node: Node = [tag, _attributes(rest), []]
        stack[-1][2].append(node)
        if tag in _RAW:
            found = re.compile(f"</{tag}(?=[\\s/>]|$)[^>]*(?:>|$)", re.I).search(html, at)
            body = html[at : found.start() if found else len(html)]
            at = found.end() if found else len(html)
            if tag == "style":
                sheets.append(body)
            node[2].append(unescape(body) if tag in ("textarea", "title") else body)
        elif tag not in _VOID and not (rest.endswith("/") and tag in _DRAWN):
            stack.append(node)
            deepest = max(deepest, len(stack))
    return root, sheets, deepest


def _on_screen(query: str) -> bool:
    """Whether a list of media queries holds on a wide screen."""

    def holds(part: str) -> bool:
        words = re.sub(r"\([^)]*\)", " ", part).split()
        negated = words[:1] == ["not"]
        kind = next((w for w in words if w not in ("not", "only", "and")), "all")
        true = kind in ("all", "screen") and "portrait" not in part
        for side, number, unit in _WIDTH.findall(part.replace(" :", ":").replace(": ", ":")):
            pixels = float(number) * (1 if unit == "px" else 16)
            true = true and (pixels <= _SCREEN if side == "min" else pixels >= _SCREEN)
        return true != negated

    return any(holds(part) for part in query.lower().split(",") if part.strip()) or not query.strip()


def style_rules(sheet: str) -> Iterator[tuple[str, str]]:
    """Selectors and declarations of the rules of a sheet that hold on a screen."""
    within: list[bool | None] = []  # of each open at-rule, whether what it holds counts
    selector = None
    for before, brace in _BRACE.findall(re.sub(r"/\*.*?(?:\*/|$)", "", sheet, flags=re.DOTALL) + "}"):
        head = before.rsplit(";", 1)[-1].strip() if brace == "{" else before
        if selector is not None:
            if brace == "}":
                if all(within):
                    yield selector, before
                selector = None
        elif brace == "}":
            del within[-1:]
        elif head.startswith("@"):
            name, _, query = head[1:].partition(" ")
            within.append(_on_screen(query) if name.lower() == "media" else name.lower() in ("supports", "layer", "container", "scope"))
        else:
            selector = head


def _compounds(selector: str) -> list[tuple[str, str, frozenset, frozenset]] | None:
    """Combinator, tag, ids and classes of each compound of a selector; None if it holds more than these."""
    out, combinator = [], " "
    for word in selector.replace(">", " > ").split():
        if word == ">":
            combinator = ">"
            continue
        parts = _PART.findall(word)
        if "".join(a + b for a, b in parts) != word:
            return None
        named = lambda mark: frozenset(b.lower() for a, b in parts if a == mark)
        tags = named("") - {"*"}
        if len(tags) > 1:
            return None
        out.append((combinator, next(iter(tags), ""), named("#"), named(".")))
        combinator = " "
    return out or None


class Visibility:
    """What is shown: element kinds, the hidden attribute, and the properties display and
    visibility, as style rules and style attributes set them. Of several, importance, then
    how specific the selector is, then order decides. Selectors of tags, classes and ids
    are known, with descendants and children; rules with any other are left out.
    """

    def __init__(self, sheets: list[str]) -> None:
        self.rules: dict[str, list[tuple]] = {}  # by tag, class or id of the last compound
        order = 0
        for sheet in sheets:
            for selectors, body in style_rules(sheet):
                found = _SHOWN_BY.findall(body)
                for selector in selectors.split(",") if found else ():
                    order += 1
                    parts = _compounds(selector)
                    if parts:
                        _, tag, ids, classes = parts[-1]
                        last = "#" + min(ids) if ids else "." + min(classes) if classes else tag
                        weight = (sum(len(p[2]) for p in parts), sum(len(p[3]) for p in parts), sum(bool(p[1]) for p in parts), order)
                        self.rules.setdefault(last, []).append((parts, weight, found))
        self.path: list[tuple[str, dict]] = []  # open elements

    @staticmethod
    def _fits(part: tuple, tag: str, attributes: dict) -> bool:
        _, own, ids, classes = part
        return (not own or own == tag) and ids <= {attributes.get("id", "").lower()} and classes <= set(attributes.get("class", "").lower().split())

    def _matches(self, parts: list[tuple], tag: str, attributes: dict) -> bool:
        if not self._fits(parts[-1], tag, attributes):
            return False
        at = len(self.path)
        for part, follows in zip(reversed(parts[:-1]), reversed([p[0] for p in parts])):
            at -= 1
            while at >= 0 and not self._fits(part, *self.path[at]):
                if follows == ">":
                    return False
                at -= 1
            if at < 0:
                return False
        return True

    def style(self, tag: str, attributes: dict) -> dict[str, str]:
        """The values of display and visibility that win."""
        best: dict[str, tuple] = {}

        def offer(found: list[tuple], weight: tuple) -> None:
            for k, (name, value, important) in enumerate(found):
                rank = (bool(important), *weight, k)
                if name.lower() not in best or rank > best[name.lower()][0]:
                    best[name.lower()] = rank, value.lower()

        if self.rules:
            for name in ("", tag, *("." + c for c in attributes.get("class", "").lower().split()), "#" + attributes.get("id", "").lower()):
                for parts, weight, found in self.rules.get(name, ()):
                    if self._matches(parts, tag, attributes):
                        offer(found, (0, *weight))
        if "style" in attributes:
            offer(_SHOWN_BY.findall(attributes["style"]), (1, 0, 0, 0, 0))
        return {name: value for name, (_, value) in best.items()}

    def gone(self, tag: str, attributes: dict) -> bool:
        if tag in _HIDDEN or (tag == "dialog" and "open" not in attributes):
            return True
        display = self.style(tag, attributes).get("display") if self.rules or "style" in attributes else None
        return display == "none" if display not in (None, "inherit", "initial", "unset", "revert") else "hidden" in attributes

    def shows(self, tag: str, attributes: dict, inherited: bool) -> bool:
        if not attributes and not self.rules:
            return inherited
        value = self.style(tag, attributes).get("visibility", "inherit")
        return value == "visible" if value in ("visible", "hidden", "collapse") else inherited


class Writer:
    """Lines of text, with blank lines between blocks kept until text follows."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line = ""
        self.pending = 0  # line ends due before the next text
        self.prefix = ""  # indent of the lines to come
        self.mark = ""  # list mark for the next line

    def block(self, gap: int) -> None:
        """A block begins or ends; ``gap`` 2 leaves a blank line."""
        if self.line.strip() or self.mark:
            if self.line.strip():
                self.lines.append(self.line.rstrip())
                self.line = ""
                self.pending = gap
            return
        self.line = ""
        self.pending = max(self.pending, gap)

    def newline(self) -> None:
        self._begin()
        self.lines.append(self.line.rstrip())
        self.line, self.pending = "", 0

    def _begin(self) -> None:
        if not self.line:
            if self.pending > 1 and self.lines:
                self.lines.append("")
            self.pending = 0
            self.line = self.prefix + self.mark
            if self.mark:
                self.prefix += " " * len(self.mark)
                self.mark = ""

    def text(self, piece: str) -> None:
        piece = _SPACES.sub(" ", piece)
        if not self.line:
            piece = piece.lstrip(" ")
        elif self.line.endswith(" "):
            piece = piece.lstrip(" ") if piece.startswith(" ") else piece
        if piece:
            self._begin()
            self.line += piece

    def plain(self, piece: str) -> None:
        """Text whose spaces and line ends count."""
        first, *more = piece.split("\n")
        if first:
            self._begin()
            self.line += first
        for line in more:
            self.newline()
            if line:
                self._begin()
                self.line += line

    def result(self) -> str:
        self.block(1)
        return "\n".join(self.lines).replace("\xa0", " ").strip("\n")


def _wrapped(text: str) -> list[str]:
    """Lines of a cell, wrapped at spaces."""
    out: list[str] = []
    for line in text.split("\n"):
        out += wrap(line, _CELL, break_long_words=False, break_on_hyphens=False) if len(line) > _CELL else [line]
    return out


def _cell_width(lines: list[str]) -> int:
    """Width a cell asks for; a word too long to be wrapped sticks out of its column."""
    return max((len(line) for line in lines if len(line) <= _CELL), default=0)


def _int(value: str | None, default: int) -> int:
    try:
        return int(value) if value is not None else default
    except ValueError:
        return default


class Renderer:
    def __init__(self, visibility: Visibility) -> None:
        self.visibility = visibility

    def render(self, node: Node) -> str:
        out = Writer()
        self.children(node, out, True, False)
        return out.result()

    def children(self, node: Node, out: Writer, shown: bool, pre: bool) -> None:
        self.visibility.path.append((node[0], node[1]))
        for child in node[2]:
            if isinstance(child, str):
                if shown:
                    (out.plain if pre else out.text)(child)
            else:
                self.element(child, out, shown, pre)
        self.visibility.path.pop()

    def element(self, node: Node, out: Writer, shown: bool, pre: bool) -> None:
        tag, attributes, _ = node
        if self.visibility.gone(tag, attributes):
            return
        shown = self.visibility.shows(tag, attributes, shown)
        if tag == "br":
            out.newline()
        elif tag == "hr":
            out.block(2)
            out.text("---")
            out.block(2)
        elif tag == "table":
            out.block(2)
            self.table(node, out, shown)
            out.block(2)
        elif tag in ("ul", "ol", "menu"):
            self.listing(node, out, shown, pre)
        elif tag == "details" and "open" not in attributes:
            out.block(1)
            summary = next((c for c in node[2] if isinstance(c, list) and c[0] == "summary"), None)
            self.children([tag, attributes, [summary] if summary else []], out, shown, pre)
            out.block(1)
        elif tag == "text":  # a label of a drawing
            out.text(" ")
            self.children(node, out, shown, pre)
            out.text(" ")
        elif tag in _BLOCK:
            gap = 2 if tag in _SPACED else 1
            before = out.prefix
            out.block(gap)
            before = out.prefix
            if tag in ("blockquote", "dd"):
                out.prefix += "  "
            if tag in ("pre", "textarea", "xmp"):
                if node[2] and isinstance(node[2][0], str):
                    node[2][0] = node[2][0].removeprefix("\n")
                self.children(node, out, shown, True)
            else:
                self.children(node, out, shown, pre)
            out.block(gap)
            out.prefix = before
        else:
            self.children(node, out, shown, pre)

    def listing(self, node: Node, out: Writer, shown: bool, pre: bool) -> None:
        gap = 1 if out.prefix or out.mark else 2
        out.block(gap)
        before = out.prefix
        number = _int(node[1].get("start"), 1)
        self.visibility.path.append((node[0], node[1]))
        for child in node[2]:
            if isinstance(child, list) and child[0] == "li":
                if self.visibility.gone("li", child[1]):
                    continue
                out.block(1)
                out.prefix = before
                if node[0] == "ol":
                    number = _int(child[1].get("value"), number)
                    out.mark = f"{number}. "
                    number += 1
                else:
                    out.mark = "- "
                self.children(child, out, self.visibility.shows("li", child[1], shown), pre)
                out.block(1)
                out.prefix, out.mark = before, ""
            elif isinstance(child, list):
                self.element(child, out, shown, pre)
            elif shown:
                out.text(child)
        self.visibility.path.pop()
        out.block(gap)
        out.prefix = before

    def rows(self, node: Node, shown: bool, found: list, loose: Writer) -> None:
        """Rows of a table, cells as (node, shown, path); anything misplaced goes before the table."""
        path = self.visibility.path
        path.append((node[0], node[1]))
        for child in node[2]:
            if isinstance(child, str):
                if shown and not child.isspace():
                    loose.text(child)
                continue
            tag, attributes, _ = child
            if self.visibility.gone(tag, attributes):
                continue
            now = self.visibility.shows(tag, attributes, shown)
            if tag in ("thead", "tbody", "tfoot"):
                self.rows(child, now, found, loose)
            elif tag == "tr":
                cells = []
                path.append((tag, attributes))
                for c in child[2]:
                    if isinstance(c, list) and c[0] in ("td", "th"):
                        if not self.visibility.gone(c[0], c[1]):
                            cells.append((c, self.visibility.shows(c[0], c[1], now), path[:]))
                    elif isinstance(c, list):
                        self.element(c, loose, now, False)
                    elif now and not c.isspace():
                        loose.text(c)
                path.pop()
                found.append(cells)
            elif tag in ("td", "th"):
                found.append([(child, now, path[:])])
            else:
                self.element(child, loose, now, False)
        path.pop()

    def table(self, node: Node, out: Writer, shown: bool) -> None:
        found: list[list] = []
        loose = Writer()
        self.rows(node, shown, found, loose)
        grid: list[list[tuple[int, int, list[str]]]] = []  # column, span, lines
        taken: dict[int, int] = {}  # column -> rows still covered from above
        for cells in found:
            row, column = [], 0
            covered, taken = taken, {k: v - 1 for k, v in taken.items() if v > 1}
            for cell, now, path in cells:
                while column in covered:
                    column += 1
                span = min(100, max(1, _int(cell[1].get("colspan"), 1)))
                deep = min(1000, max(1, _int(cell[1].get("rowspan"), 1)))
                inner, before = Writer(), self.visibility.path
                self.visibility.path = path
                self.children(cell, inner, now, False)
                self.visibility.path = before
                row.append((column, span, _wrapped(inner.result())))
                if deep > 1:
                    for c in range(column, column + span):
                        taken[c] = max(taken.get(c, 0), deep - 1)
                column += span
            grid.append(row)
        widths: dict[int, int] = {}
        for row in grid:
            for column, span, lines in row:
                if span == 1:
                    widths[column] = max(widths.get(column, 0), _cell_width(lines))
        for row in grid:  # a wide cell over several columns widens the last of them
            for column, span, lines in row:
                own = range(column, column + span)
                more = _cell_width(lines) - sum(widths.get(c, 0) for c in own) - 2 * (span - 1)
                if span > 1 and more > 0:
                    widths[own[-1]] = widths.get(own[-1], 0) + more
        before = loose.result()
        if before:
            out.plain(before)
            out.block(1)
        starts, at = {}, 0
        for column in range(max((c + s for row in grid for c, s, _ in row), default=0)):
            starts[column] = at
            at += widths.get(column, 0) + 2
        for row in grid:
            for k in range(max((len(lines) for *_, lines in row), default=0)):
                line = ""
                for column, _, lines in row:
                    if k < len(lines) and lines[k]:
                        line = (line.rstrip() + "  " if len(line.rstrip()) + 2 > starts[column] and line.strip() else line).ljust(starts[column])
                        line += lines[k]
                if line.strip():
                    out.plain(line.rstrip())
                    out.block(1)


def page_text(html: str | None) -> str:
    """Visible text of a page; null and empty pages give an empty text."""
    if not html:
        return ""
    root, sheets, deepest = parse(html.replace("\r\n", "\n").replace("\r", "\n").replace("\x00", "�"))
    visibility = Visibility(sheets)
    # Elements are written by calls within calls, three or four a level, which take heap and no stack.
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 5 * deepest + 1000))
    return "" if visibility.gone("html", root[1]) else Renderer(visibility).render(root)


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Adds ``text`` and its length ``n_chars`` to the columns ``keep``, one row per page.

    Whole pages are read, however long or deep, and all their visible text is kept. Cells of
    tables are wrapped at 60 characters and aligned; a longer word sticks out. Null and empty pages give
    an empty text. Equal pages give equal texts, an empty table no rows. Columns other
    than ``keep`` and ``html`` are not read.
    """
    small_batches(pages.sparkSession)
    fields = {f.name: f.dataType.simpleString() for f in pages.schema}
    schema = "".join(f"`{k}` {fields[k]}, " for k in keep) + "text string, n_chars long"

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for b in batches:
            texts = [page_text(h) for h in b["html"]]
            yield {k: b[k] for k in keep} | {"text": texts, "n_chars": [len(t) for t in texts]}

    return map_columns(pages.select(*keep, "html"), run, schema)
