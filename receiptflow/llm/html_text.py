"""Visible text of HTML pages, laid out: a tree builder with implied tags feeds a renderer.

The builder keeps the stack of open elements, closes what a start tag implies to be closed (``<p>`` before a block,
``<li>``, table parts, options) and reports opening, text and closing; the renderer drops what is not displayed,
collapses white space, sets blocks apart, marks list items and aligns table cells. Nothing recurses and no tag makes it
walk the stack, so nesting may be of any depth. What layout may cost has a bound for each page, in proportion to its
length (``Room``); beyond it tables are laid out without columns.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html import unescape
from itertools import accumulate
from unicodedata import east_asian_width

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from receiptflow.llm.shared import add_columns

# --- fixed values of the HTML standard -------------------------------------------------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
ESCAPABLE_RAW = frozenset("textarea title".split())
NOT_SHOWN = frozenset(
    "head title script style template iframe noembed noframes datalist param source track area base link meta "
    "audio canvas video meter progress rp".split()
)
#: Elements of SVG and MathML whose text is not shown.
NOT_DRAWN = frozenset("defs desc metadata symbol clippath mask pattern marker lineargradient radialgradient filter annotation annotation-xml".split())
#: HTML elements whose start tag ends SVG or MathML.
ENDS_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li menu meta nobr ol p pre ruby s small "
    "span strong strike sub sup table tt u ul var".split()
)
#: Inputs that show their value.
SHOWS_VALUE = frozenset(["", *"text search url tel email number date month week time datetime-local submit button reset".split()])
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu table pre blockquote figure fieldset xmp listing".split())
BLOCKS = SPACED | frozenset(
    "address article aside body center dd details dialog dir div dt figcaption footer form header hgroup hr html legend li main nav "
    "optgroup option search section summary caption tr thead tbody tfoot td th".split()
)
#: A start tag of these closes an open paragraph.
ENDS_P = BLOCKS - frozenset("body html dd dt li optgroup option legend caption tr thead tbody tfoot td th".split()) | {"li", "dd", "dt"}
#: Which open elements a start tag closes, and the elements beyond which it does not look.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select", "datalist"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table", "tbody", "thead", "tfoot"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
}
#: An end tag does not reach beyond these to find its element.
WALLS = frozenset("table td th caption template object".split())
# ---------------------------------------------------------------------------------------------------------------------

_MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S
)
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
_DECLARATION = re.compile(r"(?:^|[;{\s])(display|visibility)\s*:\s*([a-z-]+)\s*(!\s*important)?", re.I)
_COMPOUND = re.compile(r"(\*|[a-z][\w-]*)?((?:[.#][\w-]+)*)\Z", re.I)
#: Deeper list items and quotes are indented like those of this depth, and deeper tables are rows of text, without columns.
_DEEPEST = 32
#: Characters and steps that aligning tables may take for each character of a page, and for any page.
_ROOM, _ROOM_ANY = 16, 1 << 16


@dataclass(frozen=True)
class Style:
    """What a rule of a style sheet says of elements with this tag, these classes and these ids."""

    tag: str
    classes: frozenset[str]
    ids: frozenset[str]
    name: str
    value: str
    rank: tuple[bool, int, int, int, int]  # important, ids, classes, tags, place

    def fits(self, tag: str, classes: set[str], id_: str) -> bool:
        return self.tag in ("", "*", tag) and self.classes <= classes and self.ids <= {id_}


def declarations(source: str) -> list[tuple[str, str, bool]]:
    return [(m[1].lower(), m[2].lower(), bool(m[3])) for m in _DECLARATION.finditer(source)]


def style_rules(sheets: list[str]) -> dict[str, list[Style]]:
    """Rules about ``display`` and ``visibility`` by an id, class or tag that an element must have.

    Selectors of one element (tag, classes, ids) count, those with combinators, attributes or pseudo-classes do not; of
    conditional blocks ``@media`` for all media or screens without further conditions counts.
    """
    best: dict[tuple, Style] = {}  # of equal selectors the one that counts
    place = 0
    for sheet in sheets:
        if "{" not in sheet:
            continue
        text = re.sub(r"/\*.*?(?:\*/|\Z)", " ", sheet, flags=re.S)
        skipped: list[bool] = []  # of the open blocks, whether what is inside counts
        at = 0
        for m in re.finditer(r"[{}]", text):
            head, at = text[at : m.start()], m.end()
            if m[0] == "}":
                if skipped:
                    skipped.pop()
                continue
            head = head.rpartition(";")[2].strip()
            counts = not any(skipped)
            if head.startswith("@"):
                skipped.append(re.fullmatch(r"@media\s+(only\s+)?(all|screen)", head, re.I) is None)
                continue
            skipped.append(False)
            if counts:
                end = text.find("}", at)
                said = declarations(text[at : end if end >= 0 else len(text)])
                for selector in head.split(",") if said else ():
                    part = _COMPOUND.match(selector.strip())
                    if part is None or not part[0]:
                        continue
                    names = re.findall(r"([.#])([\w-]+)", part[2])
                    ids = frozenset(n for kind, n in names if kind == "#")
                    classes = frozenset(n for kind, n in names if kind == ".")
                    tag = (part[1] or "").lower()
                    for name, value, important in said:
                        rank = (important, len(ids), len(classes), int(tag not in ("", "*")), place)
                        key = (tag, classes, ids, name)
                        if key not in best or rank > best[key].rank:
                            best[key] = Style(tag, classes, ids, name, value, rank)
                        place += 1
    used = Counter(c for rule in best.values() for c in rule.classes)
    out: dict[str, list[Style]] = {}
    for rule in best.values():  # found by the class that the fewest rules have
        rarest = min(rule.classes, key=lambda c: (used[c], c), default="")
        out.setdefault("#" + min(rule.ids) if rule.ids else "." + rarest if rarest else rule.tag, []).append(rule)
    return out


def attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(source):
        out.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return out


def width(text: str) -> int:
    """Columns of a line: two for wide characters."""
    return len(text) if text.isascii() else sum(2 if east_asian_width(c) in "WF" else 1 for c in text)


class Flow:
    """Lines of one column of text: the page or a table cell."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False  # a space is due before further text of this line
        self.gap = False  # an empty line is due before further text
        self.prefixes: list[str] = []  # of list items and quotes
        self.marker = ""
        self.spans = (1, 1)  # of a table cell: columns, rows

    def text(self, text: str) -> None:
        parts = text.split()
        if not parts:
            self.space = self.space or bool(text)
            return
        if text[0].isspace():
            self.space = True
        self._start()
        if self.space and self.line[-1:] and self.line[-1]:
            self.line.append(" ")
        self.line.append(" ".join(parts))
        self.space = text[-1].isspace()

    def exact(self, text: str) -> None:
        """Text whose white space counts."""
        first, *rest = text.replace("\r\n", "\n").split("\n")
        self._start()
        self.line.append(first)
        for x in rest:
            self.end_line(always=True)
            self.line.append(x)
        self.space = False

    def _start(self) -> None:
        if self.gap and not self.line:
            if self.lines:
                self.lines.append("")
            self.gap = False

    def end_line(self, always: bool = False) -> None:
        text = "".join(self.line).rstrip() if not always else "".join(self.line)
        if text or always:
            marker, self.marker = self.marker, ""
            indent = "".join(self.prefixes[:_DEEPEST])
            self.lines.append((indent[: len(indent) - len(marker)] + marker + text).rstrip() if marker else (indent + text).rstrip())
        self.line, self.space = [], False

    def block(self, spaced: bool) -> None:
        self.end_line()
        self.gap = self.gap or spaced

    def finish(self) -> list[str]:
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


@dataclass
class Cell:
    lines: list[str]
    columns: int
    rows: int


class Room:
    """Steps and characters that the layout of a page may still take."""

    def __init__(self, length: int):
        self.left = _ROOM * length + _ROOM_ANY

    def take(self, n: int) -> bool:
        self.left -= n
        return self.left >= 0


class Table:
    def __init__(self):
        self.rows: list[list[Cell]] = []
        self.caption: list[str] = []

    def placed(self, room: Room) -> list[list[tuple[int, Cell]]] | None:
        """Each row's own cells with their first columns: those that cells from above do not reach into."""
        taken: dict[int, int] = {}  # column: rows that a cell from above still covers
        out = []
        for k, row in enumerate(self.rows):
            if not room.take(len(taken) + sum(cell.columns for cell in row)):
                return None
            at, here = 0, []
            for cell in row:
                cell.rows = min(cell.rows, len(self.rows) - k)
                while at in taken:
                    at += 1
                here.append((at, cell))
                at += cell.columns
            taken = {c: n - 1 for c, n in taken.items() if n > 1}
            for first, cell in here:
                if cell.rows > 1:
                    taken |= dict.fromkeys(range(first, first + cell.columns), cell.rows - 1)
            out.append(here)
        return out

    def lines(self, room: Room) -> list[str]:
        return self.caption + (self._aligned(room) or self._in_turn())

    def _in_turn(self) -> list[str]:
        """Cells of a line each side by side, others below each other."""
        out = []
        for row in self.rows:
            cells = [cell.lines for cell in row if cell.lines]
            short = all(len(lines) == 1 for lines in cells)
            out += ["  ".join(lines[0] for lines in cells)] if short and cells else [x for lines in cells for x in lines]
        return out

    def _aligned(self, room: Room) -> list[str] | None:
        """Cells side by side, each column as wide as its widest cell of one column, two spaces between.

        The lines of a cell of several rows go on beside the rows below it; its last row makes room for what is left.
        None if that takes more than there is room for.
        """
        placed = self.placed(room)
        if placed is None:
            return None
        widths: list[int] = []
        for row in placed:
            for at, cell in row:
                widths += [0] * (at + cell.columns - len(widths))
                if cell.columns == 1:
                    widths[at] = max([widths[at], *map(width, cell.lines)])
        begins = [0, *accumulate(w + 2 for w in widths)]  # of the columns, in characters
        out: list[str] = []
        reaching: list[tuple[int, Cell, int, int]] = []  # column, cell, lines done, rows left with this one
        for k, row in enumerate(placed):
            reaching = [(at, cell, done, n - 1) for at, cell, done, n in reaching if n > 1]
            reaching = sorted(reaching + [(at, cell, 0, cell.rows) for at, cell in row], key=lambda x: x[0])
            height = max((len(cell.lines) - done for _, cell, done, n in reaching if n == 1), default=0)
            height = max(height, int(any(cell.lines for _, cell in row)))
            if not room.take(len(reaching) * (height + 1)):
                return None
            for i in range(height):
                parts, past, pushed = [], 0, 0
                for at, cell, done, _ in reaching:
                    if done + i < len(cell.lines) and cell.lines[done + i]:
                        text = cell.lines[done + i]
                        gap = begins[at] + pushed - past
                        if not room.take(gap):
                            return None
                        parts.append(" " * gap + text)
                        past += gap + width(text)
                        # a cell of several columns may be wider than these
                        pushed += max(0, width(text) - (begins[at + cell.columns] - 2 - begins[at]))
                out.append("".join(parts).rstrip())
            reaching = [(at, cell, done + height, n) for at, cell, done, n in reaching]
        return out


@dataclass(slots=True)
class Open:
    tag: str
    hides: bool  # with all that is inside
    visible: bool  # of the element around it


class Page:
    """Tree builder and renderer of one page."""

    def __init__(self, rules: dict[str, list[Style]] | None = None):
        self.open: list[Open] = []
        self.places: dict[str, list[int]] = {}  # of the open elements of a tag, outermost first
        self.rules = rules or {}
        self.said: dict[tuple[str, str, str], dict[str, tuple[tuple, str]]] = {}  # by rules, for a tag, its classes and id
        self.room = Room(0)
        self.sheets: list[str] = []
        self.hidden = 0
        self.visible = True
        self.exact = 0
        self.flows = [Flow()]
        self.tables: list[Table] = []
        self.counters: list[int | None] = []  # of open lists; none for bullets

    def run(self, html: str) -> str:
        at, n = 0, len(html)
        self.room = Room(n)
        while at < n:
            start = html.find("<", at)
            if start < 0:
                break
            m = _PLAIN_TAG.match(html, start)
            if m is None or '"' in m[3] or "'" in m[3] or m[3][:1] not in ("", " ", "/", "\n", "\t", "\r", "\f"):
                m = _MARKUP.match(html, start)
            if m is None:  # a plain less-than sign
                stop = html.find("<", start + 1)
                self.text(html[at : stop if stop >= 0 else n])
                at = stop if stop >= 0 else n
                continue
            if start > at:
                self.text(html[at:start])
            at = m.end()
            if m.re is _PLAIN_TAG or m[2]:
                tag = m[2].lower()
                if m[1]:
                    self.end(tag)
                elif tag == "plaintext" and not self._foreign():
                    self.begin("pre", m[3])
                    self.text(html[at:], entities=False)
                    at = n
                elif self.begin(tag, m[3]) and (tag in RAW or tag in ESCAPABLE_RAW) and not self._foreign():
                    at = self._past_line_feed(tag, html, at)
                    close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
                    stop = close.start() if close else n
                    if tag == "style":
                        self.sheets.append(html[at:stop])
                    elif stop > at:
                        self.text(html[at:stop], tag in ESCAPABLE_RAW)
                    at = stop
                else:
                    at = self._past_line_feed(tag, html, at)
        if at < n:
            self.text(html[at:])
        while self.open:
            self._pop()
        return "\n".join(self.flows[0].finish())

    # --- tree ---

    @staticmethod
    def _past_line_feed(tag: str, html: str, at: int) -> int:
        """A line feed right after these start tags is no text."""
        if tag in ("pre", "listing", "textarea"):
            at += 2 if html.startswith("\r\n", at) else html.startswith("\n", at)
        return at

    def _last(self, tag: str) -> int:
        """The place of the innermost open element of a tag, or -1."""
        found = self.places.get(tag)
        return found[-1] if found else -1

    def _foreign(self) -> bool:
        """Whether SVG or MathML is read here."""
        return max(self._last("svg"), self._last("math")) > self._last("foreignobject")

    def begin(self, tag: str, source: str) -> bool:
        """Opens an element; whether it stays open."""
        if self._foreign() and tag in ENDS_FOREIGN:
            self._close({"svg", "math"}, set())
        foreign = tag in ("svg", "math") or self._foreign()
        if not foreign:
            if tag in ENDS_P and self.places.get("p"):
                self._close({"p"}, WALLS)
            if tag in IMPLIED_END:
                self._close(*IMPLIED_END[tag])
                if tag in ("td", "th") and self._last("tr") <= self._last("table"):
                    self.begin("tr", "")
            if tag in ("body", "html") and self.open:
                self._close({"head"}, set())
                if self.places.get(tag):
                    return False
            elif tag not in NOT_SHOWN and tag != "html" and any(x.tag == "head" for x in self.open[:3]):
                self._close({"head"}, set())
        found = attributes(source) if source.strip(" /") else {}
        display, visibility = self._styled(tag, found)
        hides = tag in (NOT_DRAWN if foreign else NOT_SHOWN) or (foreign and tag in ("title", "script", "style")) or display == "none"
        hides = hides or (tag == "dialog" and "open" not in found) or (tag == "input" and found.get("type", "").lower() == "hidden")
        if self.open and self.open[-1].tag == "details-closed" and tag != "summary":
            hides = True
        if tag == "details" and "open" not in found:
            tag = "details-closed"
        visible = self.visible if visibility is None else visibility == "visible"
        if not hides and not self.hidden and visible:
            self._shown(tag, found)
        if tag in VOID and not foreign:
            return False
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append(Open(tag, hides, self.visible))
        self.hidden += hides
        self.visible = visible
        if not self.hidden:
            self._enter(tag, found)
        if foreign and source.endswith("/"):
            self._pop()
            return False
        return True

    def _styled(self, tag: str, found: dict[str, str]) -> tuple[str | None, str | None]:
        """Display and visibility of an element: of what applies, the last of the highest rank."""
        said: dict[str, tuple[tuple, str]] = {"display": ((False, -1), "none")} if "hidden" in found else {}
        if self.rules:
            key = (tag, found.get("class", ""), found.get("id", ""))
            if key not in self.said:
                self.said[key] = self._by_rules(tag, set(key[1].split()), key[2])
            for name, (rank, value) in self.said[key].items():
                if rank > said.get(name, ((), ""))[0]:
                    said[name] = rank, value
        if "style" in found:
            for place, (name, value, important) in enumerate(declarations(found["style"])):
                rank = (important, 1 << 30, place)
                if rank > said.get(name, ((), ""))[0]:
                    said[name] = rank, value
        return said.get("display", (None, None))[1], said.get("visibility", (None, None))[1]

    def _by_rules(self, tag: str, classes: set[str], id_: str) -> dict[str, tuple[tuple, str]]:
        best: dict[str, tuple[tuple, str]] = {}
        for key in ("*", "", tag, "#" + id_, *("." + c for c in classes)):
            for rule in self.rules.get(key, ()):
                if rule.rank > best.get(rule.name, ((), ""))[0] and rule.fits(tag, classes, id_):
                    best[rule.name] = rule.rank, rule.value
        return best

    def end(self, tag: str) -> None:
        if tag == "br":
            self.begin("br", "")
            return
        names = {"details-closed", "details"} if tag == "details" else {tag}
        if tag == "p" and not self.places.get("p"):
            self.begin("p", "")
        walls = WALLS - {tag} if tag not in ("table", "tr", "tbody", "thead", "tfoot") else set()
        if tag in ("tr", "tbody", "thead", "tfoot"):
            walls = {"table"}
        self._close(names, walls)

    def _close(self, tags: set[str], walls) -> None:
        """Pops up to the innermost open element of ``tags``, unless a wall comes first."""
        k = max(map(self._last, tags))
        if k < 0 or any(self._last(w) > k for w in walls):
            return
        # a start tag may close several: the outermost of them before a wall
        while k and self.open[k - 1].tag in tags and len(tags) > 2:
            k -= 1
        while len(self.open) > k:
            self._pop()

    def _pop(self) -> None:
        x = self.open.pop()
        self.places[x.tag].pop()
        if not self.hidden:
            self._leave(x.tag)
        self.hidden -= x.hides
        self.visible = x.visible

    # --- layout ---

    def text(self, text: str, entities: bool = True) -> None:
        if self.hidden or not self.visible or (self.open and self.open[-1].tag == "details-closed"):
            return
        if self._last("svg") > max(self._last("text"), self._last("foreignobject")):
            return  # SVG draws the text of its text elements only
        text = unescape(text) if entities and "&" in text else text
        if self.open and self.open[-1].tag in ("table", "tbody", "thead", "tfoot", "tr") and not text.strip():
            return
        if self.exact:
            self.flows[-1].exact(text)
        else:
            self.flows[-1].text(text)

    def _shown(self, tag: str, found: dict[str, str]) -> None:
        """Void elements that show something, and breaks."""
        flow = self.flows[-1]
        if tag == "br":
            if flow.line:
                flow.end_line()
            elif flow.lines and not flow.gap:
                flow.lines.append("")
        elif tag == "hr":
            flow.block(True)
        elif tag == "img" and found.get("alt", "").strip():
            flow.text(found["alt"])
        elif tag == "input" and (kind := found.get("type", "").lower()) in SHOWS_VALUE | {"image"}:
            value = found.get("alt" if kind == "image" else "value", "")
            if value.strip():
                flow.space = True
                flow.text(f"{value} ")

    def _enter(self, tag: str, found: dict[str, str]) -> None:
        if tag == "text" and self._foreign():  # stands at a place of its own
            self.flows[-1].end_line()
        if tag not in BLOCKS and tag != "details-closed":
            return
        flow = self.flows[-1]
        nested = tag in ("ul", "ol", "menu") and bool(self.counters)
        if tag in ("td", "th", "caption"):
            if len(self.tables) > _DEEPEST:
                flow.space = True
            elif self.tables and (tag == "caption" or self.tables[-1].rows):
                self.flows.append(Flow())
                number = lambda name: int(found[name]) if re.fullmatch(r"[0-9]{1,5}", found.get(name, "")) else 1
                rows = number("rowspan")
                self.flows[-1].spans = max(1, min(1000, number("colspan"))), min(65534, rows) if rows else 65534
            return
        flow.block(tag in SPACED and not nested)
        if tag in ("ul", "ol", "menu"):
            start = found.get("start", "1")
            self.counters.append(int(start) if tag == "ol" and re.fullmatch(r"-?\d{1,9}", start) else 1 if tag == "ol" else None)
        elif tag == "li":
            number = self.counters[-1] if self.counters else None
            if number is not None:
                self.counters[-1] = number + 1
            mark = "- " if number is None else f"{number}. "
            flow.prefixes.append(" " * len(mark))
            flow.marker = mark if self.visible else ""
        elif tag == "blockquote":
            flow.prefixes.append("> ")
        elif tag == "dd":
            flow.prefixes.append("    ")
        elif tag in ("pre", "listing", "xmp"):
            self.exact += 1
        elif tag == "table":
            self.tables.append(Table())
        elif tag == "tr" and self.tables:
            self.tables[-1].rows.append([])

    def _leave(self, tag: str) -> None:
        if tag == "text" and self._foreign():
            self.flows[-1].end_line()
        if tag not in BLOCKS and tag != "details-closed":
            return
        flow = self.flows[-1]
        if tag in ("td", "th", "caption"):
            if len(self.tables) > _DEEPEST:
                flow.space = True
            elif self.tables and len(self.flows) > 1 and (tag == "caption" or self.tables[-1].rows):
                done = self.flows.pop()
                if tag == "caption":
                    self.tables[-1].caption += done.finish()
                else:
                    self.tables[-1].rows[-1].append(Cell(done.finish(), *done.spans))
            return
        flow.end_line()
        if tag == "table" and self.tables:
            lines = self.tables.pop().lines(self.room)
            if lines:
                flow._start()
                flow.lines += ["".join(flow.prefixes[:_DEEPEST]) + x for x in lines]
        elif tag in ("ul", "ol", "menu") and self.counters:
            self.counters.pop()
        elif tag in ("li", "blockquote", "dd") and flow.prefixes:
            flow.prefixes.pop()
            flow.marker = ""
        elif tag in ("pre", "listing", "xmp") and self.exact:
            self.exact -= 1
        nested = tag in ("ul", "ol", "menu") and bool(self.counters)
        flow.block(tag in SPACED and not nested)


def visible_text(html: str | None) -> str | None:
    """The laid-out visible text of a page; none for none. Where its style sheets hide something it is read twice."""
    if html is None:
        return None
    page = Page()
    text = page.run(html)
    rules = style_rules(page.sheets)
    return Page(rules).run(html) if rules else text


def extract_text(pages: DataFrame, html_col: str = "html", name: str = "text") -> DataFrame:
    """Each row of ``pages`` with the visible text of its HTML.

    All text that a browser would display without scripts comes out once, in source order: with that of ``noscript``, of
    ``object`` without its resource, of SVG's text elements, of MathML and of inputs' values; not the head, scripts, styles
    and templates, a closed ``details`` or ``dialog``, nor what ``hidden``, an inline style or a rule of a ``style`` element
    hides (``display`` and ``visibility``; of rules see ``style_rules``; linked sheets are not read). White space is
    collapsed but in ``pre``; blocks stand on lines of their own, paragraphs, headings, lists and tables between empty
    lines; list items have ``- `` or their number, nested ones are indented (beyond 32 levels no further); table cells are
    aligned in columns, those of several columns or rows, too. Tables in more than 32 others are rows of text, and where
    aligning a page's tables would take more than 16 times its length, the rest of them have no columns: cells of a line
    each side by side, others below each other.
    Null stays null, an empty page is empty; time and text of very long pages are linear in their length; broken markup is read leniently and unclosed
    elements end with the page; formatting that reaches across blocks is not opened again, as it changes no text. Rules of
    equal rank: the last one counts. Repeated rows give the same text; an input column named like the output is replaced,
    unless it is the HTML itself; an empty table gives an empty one.
    """
    if name.lower() == html_col.lower():
        raise ValueError("the text needs a name other than the HTML's")

    def make():
        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            column = batch.column(batch.schema.get_field_index(html_col))
            return [pa.array([visible_text(x) for x in column.to_pylist()], pa.string())]

        return compute

    return add_columns(pages, [T.StructField(name, T.StringType())], make, weigh=html_col)
