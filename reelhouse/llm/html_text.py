"""Layout-aware text of web pages.

A tree builder with HTML's implied tags keeps a stack of open elements; visibility rules decide
which of them show; a layout pass emits all visible text with block spacing, list
markers and indents, preformatted text as it is, and table cells aligned in columns.

Of a page's style sheets, rules for `display` and `visibility` hold whose selectors name an element by tag, classes and id; they
cascade by importance, specificity and order, with the element's own style above them. Selectors that look at other
elements, attributes or states are not applied, nor are media other than the screen.

Defined results: a null or empty page has empty text, one without tags is its own text with white
space collapsed. An unfinished tag at the end of a page shows nothing, as in browsers. Of SVG, the texts are
shown, each apart from the others, but not what is only defined or described; of MathML, all but annotations and phantoms,
with the parts of fractions and the like apart. Rows are independent, so repeated rows give repeated results and an empty table none. Other columns are ignored.
Time and memory are linear in a page's length, however deep its elements are nested: the places of open elements are kept by
tag, lists are indented by MAX_INDENT at most, tables that are nested deeper than MAX_TABLES put each cell on a line of its own
instead of in a grid, and a column is aligned as long as its padding is no more than PADDING times its text, else to PAD_WIDTH.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

PAD_WIDTH, PADDING = 48, 8
MAX_INDENT, MAX_TABLES = 240, 32

TAG = re.compile(
    r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])))*+)>"""
)
MARKUP = re.compile(r"<(?=[A-Za-z/!?])")
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
COMMENT_END = re.compile(r"--!?>")
DECLARATION = re.compile(r"(?<![\w-])(display|visibility)\s*:\s*([a-z-]+)\s*(!\s*important)?", re.I)
CSS_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
#: A selector of one element; each part of it.
SIMPLE = re.compile(r"\*|(?:[\w-]+)?(?:[.#][\w-]+)*")
PART = re.compile(r"([.#]?)([\w-]+)")
SCREEN = re.compile(r"\s*(?:|(?:only\s+)?(?:all|screen))\s*", re.I)
#: What a style sheet cannot be in, and the style elements themselves.
UNREAD = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(script|style|textarea|title|xmp|iframe|noembed|noframes|noscript|template|plaintext)(?=[\s/>])([^>]*)>(.*?)(?:</\1(?=[\s/>])|\Z)",
    re.S | re.I,
)

# Fixed values of the HTML standard, by their part in the rules below.
LARGEST_SPAN = {"colspan": 1000, "rowspan": 65534}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript".split())
RAW_ESCAPABLE = frozenset("textarea title".split())
HIDDEN = frozenset(
    "head script style title template noscript iframe noembed noframes audio video canvas datalist object "
    "base link meta param rp".split()
)
#: What SVG and MathML do not draw, elements in which HTML is read again, and those that end both.
UNDRAWN = {
    "svg": frozenset(
        "defs desc metadata title style script symbol clippath mask marker pattern lineargradient radialgradient filter".split()
    ),
    "math": frozenset("annotation annotation-xml mphantom style script".split()),
}
HTML_INSIDE = {"svg": frozenset("foreignobject desc title".split()), "math": frozenset("mi mo mn ms mtext".split())}
ENDS_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr "
    "ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
#: Elements of MathML whose parts are drawn in places of their own.
STACKED = frozenset("mfrac mroot munder mover munderover mtr mlabeledtr".split())
HEAD_ONLY = frozenset("base basefont bgsound link meta noframes noscript script style template title head html".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu blockquote pre listing table figure fieldset".split())
BLOCK = SPACED | frozenset(
    "address article aside body caption center dd details dialog dir div dt figcaption footer form header "
    "hgroup hr html legend li main nav optgroup option search section summary tbody tfoot thead tr xmp".split()
)
CLOSES_P = (BLOCK - frozenset("body html caption legend optgroup option tbody tfoot thead tr".split())) | {"plaintext"}
LISTS = frozenset("ul ol menu dir".split())
CELLS = frozenset(("td", "th"))
GROUPS = frozenset(("thead", "tbody", "tfoot"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
BARRIERS = frozenset("table td th caption html template object button foreignobject mi mo mn ms mtext annotation-xml".split())
#: Start tag -> (elements it closes, elements at which the search for them stops)
IMPLIED_ENDS = {
    "li": (frozenset(("li",)), LISTS | BARRIERS),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",)) | BARRIERS),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",)) | BARRIERS),
    "option": (frozenset(("option",)), frozenset(("select", "optgroup", "datalist")) | BARRIERS),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",)) | BARRIERS),
    "td": (CELLS, frozenset(("tr", "table"))),
    "th": (CELLS, frozenset(("tr", "table"))),
    "tr": (frozenset(("tr", "caption", "colgroup")) | CELLS, frozenset(("table",)) | GROUPS),
    "tbody": (GROUPS | CELLS | {"tr", "caption", "colgroup"}, frozenset(("table",))),
    "thead": (GROUPS | CELLS | {"tr", "caption", "colgroup"}, frozenset(("table",))),
    "tfoot": (GROUPS | CELLS | {"tr", "caption", "colgroup"}, frozenset(("table",))),
    "a": (frozenset(("a",)), BARRIERS),
    "button": (frozenset(("button",)), frozenset(("table", "td", "th", "caption"))),
}


class Flow:
    """Lines of one formatting context: a page, or a table cell."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.space = False
        self.wanted = 0  # line ends before the next text
        self.indent = 0
        self.marker = ""

    def text(self, data: str) -> None:
        words = data.split()
        if not words:
            self.space = self.space or bool(data)
            return
        if data[0].isspace():
            self.space = True
        self._open()
        if self.space and self.inline:
            self.inline.append(" ")
        self.inline.append(" ".join(words))
        self.space = data[-1].isspace()

    def preformatted(self, data: str) -> None:
        for number, line in enumerate(data.replace("\r\n", "\n").replace("\r", "\n").split("\n")):
            if number:
                self._open()
                self._end_line()
            if line:
                self._open()
                self.inline.append(line)
        self.space = False

    def block(self, blank: bool) -> None:
        """The next text begins a line, after an empty one if `blank`."""
        if self.inline:
            self._end_line()
        self.space = False
        self.wanted = max(self.wanted, 2 if blank else 1)

    def line_break(self) -> None:
        self._open()
        self._end_line()
        self.space = False

    def row(self, line: str) -> None:
        self._open()
        self.inline.append(line)
        self._end_line()

    def _open(self) -> None:
        if self.inline:
            return
        if self.wanted > 1 and self.lines and self.lines[-1]:
            self.lines.append("")
        self.wanted = 0
        if self.marker:
            self.inline.append(" " * max(0, min(self.indent, MAX_INDENT) - len(self.marker)) + self.marker)
            self.marker = ""
            self.space = False
        elif self.indent:
            self.inline.append(" " * min(self.indent, MAX_INDENT))
            self.space = False

    def _end_line(self) -> None:
        self.lines.append("".join(self.inline).rstrip(" "))
        self.inline = []

    def finish(self) -> list[str]:
        if self.inline:
            self._end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        start = 0
        while start < len(self.lines) and not self.lines[start]:
            start += 1
        return self.lines[start:]


class Grid:
    """Cells of a table, placed by row and column."""

    def __init__(self) -> None:
        self.rows: list[list[list[str]]] = []
        self.covered: dict[int, int] = {}  # column -> rows still covered by a cell above
        self.caption: list[str] = []

    def new_row(self) -> None:
        self.rows.append([])

    def add(self, lines: list[str], columns: int, rows: int) -> None:
        if not self.rows:
            self.new_row()
        row = self.rows[-1]
        self._skip_covered(row)
        for number in range(columns):
            if rows > 1:
                self.covered[len(row)] = rows
            row.append(lines if number == 0 else [])

    def _skip_covered(self, row: list) -> None:
        while self.covered.get(len(row), 0) >= 1:
            row.append([])

    def end_row(self) -> None:
        if self.rows:
            self._skip_covered(self.rows[-1])
        self.covered = {column: left - 1 for column, left in self.covered.items() if left > 1}

    def lines(self) -> Iterator[str]:
        longest: dict[int, int] = {}
        held: dict[int, int] = {}
        for row in self.rows:
            for column, cell in enumerate(row):
                for line in cell:
                    longest[column] = max(longest.get(column, 0), len(line))
                    held[column] = held.get(column, 0) + len(line)
        # a long line among many short ones is not worth padding them all
        widths = {
            column: width if width * len(self.rows) <= PADDING * held[column] + PAD_WIDTH * len(self.rows) else PAD_WIDTH
            for column, width in longest.items()
        }
        shown = [column for column in sorted(widths) if widths[column]]
        for row in self.rows:
            for number in range(max((len(cell) for cell in row), default=0)):
                parts = [
                    row[column][number] if column < len(row) and number < len(row[column]) else ""
                    for column in shown
                ]
                while parts and not parts[-1]:
                    parts.pop()
                yield " | ".join(part.ljust(widths[column]) for part, column in zip(parts, shown)).rstrip(" ")


class Styles:
    """The rules of a page's style sheets that decide whether elements show."""

    def __init__(self, html: str) -> None:
        #: (kind, name) of one part of a selector -> (specificity, order, all parts, declarations) of its rules
        self.rules: dict[tuple[str, str], list[tuple]] = {}
        self.order = 0
        if "<style" in html or "<STYLE" in html or "<Style" in html:
            for found in UNREAD.finditer(html):
                if found[1] and found[1].lower() == "style" and SCREEN.fullmatch(_attributes(found[2]).get("media", "")):
                    self._read(CSS_COMMENT.sub(" ", found[3]))

    def _read(self, sheet: str) -> None:
        at = 0
        while (brace := sheet.find("{", at)) >= 0:
            # what a block around it, or a statement before it, has left over goes
            selectors = sheet[at:brace].rpartition(";")[2].strip("} \t\r\n\f")
            if selectors.startswith("@"):
                if re.match(r"@media\b", selectors, re.I) and any(SCREEN.fullmatch(each) for each in selectors[6:].split(",")):
                    at = brace + 1  # its rules are read as if they stood alone
                else:
                    at = _after_block(sheet, brace)
                continue
            end = sheet.find("}", brace)
            end = len(sheet) if end < 0 else end
            declared = _declared(sheet[brace + 1 : end])
            if declared:
                for selector in selectors.split(","):
                    self._add(selector.strip(), declared)
            at = end + 1

    def _add(self, selector: str, declared: dict) -> None:
        if not selector or not SIMPLE.fullmatch(selector):
            return
        # tags are compared in lower case, classes and ids as they are
        parts = frozenset((kind, name if kind else name.lower()) for kind, name in PART.findall(selector))
        specificity = tuple(sum(kind == each for kind, _ in parts) for each in "#.") + (sum(not kind for kind, _ in parts),)
        self.order += 1
        key = max(parts, key=lambda part: (part[0] == "#", part[0] == ".", part[1]), default=("", "*"))
        self.rules.setdefault(key, []).append((specificity, self.order, parts, declared))

    def of(self, name: str, values: dict[str, str]) -> dict[str, str]:
        """The display and visibility of an element, as far as they are stated."""
        stated: dict[str, tuple] = {}

        def state(declared: dict, above: tuple) -> None:
            for key, (value, important) in declared.items():
                rank = (important, *above)
                if key not in stated or rank >= stated[key][0]:
                    stated[key] = (rank, value)

        if self.rules:
            own = {("", name), ("", "*"), *((".", each) for each in values.get("class", "").split()), ("#", values.get("id", ""))}
            for key in own:
                for specificity, order, parts, declared in self.rules.get(key, ()):
                    if parts <= own:
                        state(declared, (0, specificity, order))
        if style := values.get("style"):
            state(_declared(CSS_COMMENT.sub(" ", style)), (1, (0, 0, 0), 0))
        return {key: value for key, (_, value) in stated.items()}


def _after_block(sheet: str, brace: int) -> int:
    """The place after a block and all blocks in it."""
    depth = 0
    for found in re.compile(r"[{}]").finditer(sheet, brace):
        depth += 1 if found[0] == "{" else -1
        if not depth:
            return found.end()
    return len(sheet)


def _declared(block: str) -> dict[str, tuple[str, bool]]:
    """display and visibility of a block; of several the last counts, important ones before others."""
    found: dict[str, tuple[str, bool]] = {}
    for key, value, important in DECLARATION.findall(block):
        if bool(important) or not found.get(key.lower(), ("", False))[1]:
            found[key.lower()] = (value.lower(), bool(important))
    return found


def _attributes(text: str) -> dict[str, str]:
    values: dict[str, str] = {}
    if text and not text.isspace():
        for key, double, single, bare in ATTRIBUTE.findall(text):
            values.setdefault(key.lower(), unescape(double or single or bare))
    return values


class Element:
    __slots__ = ("tag", "shown", "seen", "pre", "flow", "grid", "span", "number", "foreign", "html", "drawn", "apart")

    def __init__(self, tag, shown, seen, pre, flow, grid):
        self.tag, self.shown, self.seen, self.pre = tag, shown, seen, pre
        self.flow, self.grid, self.span, self.number = flow, grid, (1, 1), 0
        # svg or math, whether HTML is read inside, whether text is drawn, and what it is set apart by
        self.foreign, self.html, self.drawn, self.apart = "", True, True, ""


class Page:
    """Tree construction and layout of one page, in a single pass."""

    def __init__(self) -> None:
        self.stack = [Element("#root", True, True, False, Flow(), None)]
        #: tag -> places of its open elements in the stack
        self.open: dict[str, list[int]] = {}
        self.styles = Styles("")

    def render(self, html: str) -> str:
        self.styles = Styles(html)
        at, end = 0, len(html)
        while at < end:
            found = MARKUP.search(html, at)
            if not found:
                self.characters(html[at:])
                break
            begin = found.start()
            if begin > at:
                self.characters(html[at:begin])
            at = self._markup(html, begin)
        while len(self.stack) > 1:
            self._pop()
        return "\n".join(self.stack[0].flow.finish())

    def _markup(self, html: str, begin: int) -> int:
        """Handle what begins with `<` and return the place after it."""
        following = html[begin + 1]
        if html.startswith("<!--", begin):
            if html.startswith(("<!-->", "<!--->"), begin):
                return html.index(">", begin) + 1
            closing = COMMENT_END.search(html, begin + 4)
            return closing.end() if closing else len(html)
        if html.startswith("<![CDATA[", begin) and self.stack[-1].foreign:
            closing_at = html.find("]]>", begin)
            self.characters(html[begin + 9 : closing_at if closing_at >= 0 else len(html)], escaped=False)
            return closing_at + 3 if closing_at >= 0 else len(html)
        if following in "!?" or (following == "/" and not html[begin + 2 : begin + 3].isalpha()):
            closing_at = html.find(">", begin)
            return closing_at + 1 if closing_at >= 0 else len(html)
        tag = TAG.match(html, begin)
        if not tag:
            return len(html)  # the page ends inside a tag
        name = tag[2].lower()
        if tag[1]:
            self.end(name)
            return tag.end()
        foreign = not self.stack[-1].html
        self.start(name, tag[3])
        if foreign:
            return tag.end()
        if name in RAW or name in RAW_ESCAPABLE:
            closing = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(html, tag.end())
            stop = closing.start() if closing else len(html)
            if name in RAW_ESCAPABLE or name == "xmp":
                self.characters(html[tag.end() : stop], raw=name == "xmp")
            return stop
        if name == "plaintext":
            self.characters(html[tag.end() :], raw=True)
            return len(html)
        return tag.end()

    def characters(self, data: str, raw: bool = False, escaped: bool = True) -> None:
        if self.stack[-1].tag == "head" and not data.isspace():
            self._pop()
        top = self.stack[-1]
        if not (top.shown and top.seen and top.drawn) or (top.tag == "details" and top.number == 1):
            return
        if not raw and escaped and "&" in data:
            data = unescape(data)
        if top.grid is not None and (top.tag in ("table", "tr") or top.tag in GROUPS) and data.isspace():
            return
        if top.pre or raw:
            top.flow.preformatted(data)
        else:
            top.flow.text(data)

    def _innermost(self, tags: frozenset) -> int:
        """Place of the innermost open element of some tags; 0 if there is none."""
        return max((self.open[tag][-1] for tag in tags if self.open.get(tag)), default=0)

    def _within(self, wanted: frozenset, barriers: frozenset) -> int:
        """Place of the innermost wanted element that no barrier hides; 0 if there is none."""
        place = self._innermost(wanted)
        return place if place and place >= self._innermost(barriers) else 0

    def _enter(self, element: Element) -> None:
        self.open.setdefault(element.tag, []).append(len(self.stack))
        self.stack.append(element)

    def _close_to(self, place: int) -> None:
        while len(self.stack) > place:
            self._pop()

    def start(self, name: str, attributes: str) -> None:
        if not self.stack[-1].html:
            if name not in ENDS_FOREIGN:
                self._push_foreign(name, attributes, self.stack[-1].foreign)
                return
            while not self.stack[-1].html:
                self._pop()
        if self.stack[-1].tag == "head" and name not in HEAD_ONLY:
            self._pop()
        if name in CLOSES_P and (place := self._within(frozenset(("p",)), BARRIERS)):
            self._close_to(place)
        if name in HEADINGS and self.stack[-1].tag in HEADINGS:
            self._pop()
        if name in IMPLIED_ENDS:
            closed, barriers = IMPLIED_ENDS[name]
            # the outermost one before the barrier
            while place := self._within(closed, barriers):
                self._close_to(place)
        if name in CELLS and self.stack[-1].tag in GROUPS | {"table"}:
            self._push("tr", "")
        top = self.stack[-1]
        if name == "br":
            if top.shown and top.seen:
                top.flow.line_break()
            return
        if name == "hr":
            if top.shown:
                top.flow.block(blank=True)
            return
        if name in VOID:
            return
        if name in UNDRAWN:
            self._push_foreign(name, attributes, name)
            return
        self._push(name, attributes)

    def _push_foreign(self, name: str, attributes: str, foreign: str) -> None:
        """An element of SVG or MathML; unlike those of HTML, it may close itself."""
        top = self.stack[-1]
        values, at = {}, 0
        for found in ATTRIBUTE.finditer(attributes):
            values.setdefault(found[1].lower(), unescape(found[2] or found[3] or found[4] or ""))
            at = found.end()
        stated = self.styles.of(name, values)
        if foreign == "svg":  # attributes that any style overrides
            stated = {key: values[key].strip().lower() for key in ("display", "visibility") if key in values} | stated
        shown = (
            top.shown
            and name not in UNDRAWN[foreign]
            and stated.get("display") != "none"
            and not (top.tag == "details" and top.number == 1)
        )
        seen = _seen(stated, top.seen)
        element = Element(name, shown, seen, top.pre, top.flow, None)
        element.foreign = foreign
        element.html = name in HTML_INSIDE[foreign] or (
            name == "annotation-xml" and values.get("encoding", "").lower() in ("text/html", "application/xhtml+xml")
        )
        if foreign == "svg":
            # text outside these is not drawn; each has a place of its own
            inside = top.foreign == "svg" and top.drawn and name != "svg"
            element.drawn = inside or name in ("text", "foreignobject")
            element.apart = "space" if name in ("text", "foreignobject") else ""
        elif name == "mtr" or (name == "math" and values.get("display", "").lower() == "block"):
            element.apart = "line"
        elif top.tag in STACKED:
            element.apart = "space"
        self._set_apart(element)
        self._enter(element)
        if attributes.endswith("/") and at < len(attributes):
            self._pop()

    def _set_apart(self, element: Element) -> None:
        if element.shown and element.apart == "line":
            element.flow.block(blank=False)
        elif element.shown and element.apart:
            element.flow.space = True

    def _push(self, name: str, attributes: str) -> None:
        top = self.stack[-1]
        values = _attributes(attributes)
        stated = self.styles.of(name, values)
        shown = (
            top.shown
            and name not in HIDDEN
            and not ("hidden" in values and "display" not in stated)
            and stated.get("display") != "none"
            and not (name == "dialog" and "open" not in values)
            and not (top.tag == "details" and top.number == 1 and name != "summary")
        )
        seen = _seen(stated, top.seen)
        element = Element(name, shown, seen, top.pre or name in ("pre", "listing", "xmp", "textarea"), top.flow, top.grid)
        if name == "details" and "open" not in values:
            element.number = 1
        if not shown:
            self._enter(element)
            return
        if name in BLOCK and name not in ("tr", *GROUPS):
            top.flow.block(name in SPACED and not (name in LISTS and self._list_depth()))
        if name == "table":
            element.grid = Grid() if len(self.open.get("table", ())) < MAX_TABLES else None
        elif name in CELLS and top.grid is None and self.open.get("table"):
            top.flow.block(blank=False)
        elif name == "tr" and top.grid is not None:
            top.grid.new_row()
        elif name in CELLS and top.grid is not None:
            element.flow = Flow()
            element.span = tuple(
                min(max(int(values.get(key, "1")[:9]) if values.get(key, "1")[:9].isdecimal() else 1, 1), most)
                for key, most in LARGEST_SPAN.items()
            )
        elif name == "caption" and top.grid is not None:
            element.flow = Flow()
        elif name in LISTS:
            element.flow.indent += 2 if name != "ol" else 3
            if name == "ol":
                begin = values.get("start", "1")
                element.number = int(begin) - 1 if re.fullmatch(r"-?\d{1,9}", begin) else 0
        elif name == "li":
            holder = self.stack[self._innermost(LISTS)]
            if holder.tag == "ol":
                holder.number += 1
                element.flow.marker = f"{holder.number}. "
            else:
                element.flow.marker = "- "
        elif name in ("dd", "blockquote"):
            element.flow.indent += 2
        self._enter(element)

    def _list_depth(self) -> bool:
        return self._innermost(LISTS) > 0

    def _pop(self) -> None:
        element = self.stack.pop()
        self.open[element.tag].pop()
        if not element.shown:
            return
        if element.foreign:
            self._set_apart(element)
            return
        name, flow, top = element.tag, element.flow, self.stack[-1]
        if name in CELLS and flow is not top.flow:
            top.grid.add(flow.finish(), *element.span)
        elif name == "tr" and top.grid is not None:
            top.grid.end_row()
        elif name == "caption" and flow is not top.flow:
            top.grid.caption = flow.finish()
        elif name in CELLS and element.grid is None and self.open.get("table"):
            flow.block(blank=False)
        elif name == "table" and element.grid is not None:
            flow.block(blank=True)
            for line in (*element.grid.caption, *element.grid.lines()):
                flow.row(line)
            flow.block(blank=True)
        elif name in LISTS:
            flow.indent -= 2 if name != "ol" else 3
            flow.block(blank=not self._list_depth())
        elif name in ("dd", "blockquote"):
            flow.indent -= 2
            flow.block(name in SPACED)
        elif name in BLOCK:
            flow.block(name in SPACED)
            if name == "li":
                flow.marker = ""

    def end(self, name: str) -> None:
        if name == "br":
            self.start("br", "")
            return
        if name in ("html", "body"):
            return  # what follows is still shown
        if name in HEADINGS:
            place = self._within(HEADINGS, BARRIERS)
        else:
            in_table = name in GROUPS or name in ("tr", "table")
            barriers = frozenset(("table",)) if in_table else BARRIERS
            place = self._within(frozenset((name,)), barriers - {name})
        if place:
            self._close_to(place)
        elif name == "p":
            top = self.stack[-1]
            if top.shown:
                top.flow.block(blank=True)


def _seen(stated: dict[str, str], inherited: bool) -> bool:
    """Whether text shows by its visibility, which is inherited unless it is stated."""
    visibility = stated.get("visibility")
    return visibility == "visible" if visibility in ("hidden", "collapse", "visible") else inherited


def html_to_text(html: str | None) -> str:
    return Page().render(html) if html else ""


def extract_text(df: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, text) with the visible text of every page; narrow, a batch of pages at a time."""
    rows = df.select(df[id_col].cast("long").alias(id_col), df[html_col].alias("html"))

    def rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array((html_to_text(page.as_py()) for page in batch.column("html")), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(id_col), texts], [id_col, "text"])

    return rows.mapInArrow(rendered, f"{id_col} long, text string")
