"""HTML to text as it is laid out: blocks, lists and tables.

A lexer feeds a tree builder that keeps the stack of open elements, closes what a start or end tag
implies, and knows which subtrees are not shown: by element, by attribute, by inline style, by simple rules
of the page's own sheets (element, class and id selectors), and in closed details. Visibility is inherited
and may be given back further in; what has no display is gone with all that it holds. A writer turns what is
shown into lines: blocks begin new lines, paragraphs and their like keep a blank line around them, list items
carry their bullet or number and indentation, and the cells of a table stand under each other, on a grid that
knows cells over several columns and rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import slices

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset(
    "head script style title template noscript iframe noembed noframes object audio video canvas datalist".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure fieldset hr".split())
BLOCKS = SPACED | frozenset(
    "address article aside body caption center dd details dialog dir div dt figcaption footer form header hgroup "
    "html legend li main menu nav optgroup option search section summary tr".split()
)
# What a start tag closes, and the elements beyond which it does not look.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select", "datalist"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
}
BARRIERS = frozenset({"table", "td", "th", "caption", "html", "template", "button", "object"})
HEAD_PARTS = frozenset("base link meta title style script noscript template".split())

# Cells with others to their right are wrapped at spaces to this width; only a longer word stands out.
WRAP = 80
MAX_COLSPAN, MAX_ROWSPAN = 1000, 65534
# A quote opens a value right after "=" and white space; anywhere else in a tag it is an ordinary character.
GAP = r"[ \t\n\r\f]*+"
NAME = r"[^ \t\n\r\f/>][^ \t\n\r\f/>=]*+"
VALUE = r"\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^ \t\n\r\f>]*+"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([A-Za-z][^\s/>]*+)((?:[ \t\n\r\f/]++|{NAME}(?:{GAP}={GAP}(?:{VALUE}))?+)*+)>|[^<]++|<",
    re.S,
)
UNCLOSED = re.compile(r"/?[A-Za-z]")
ATTRIBUTE = re.compile(rf"({NAME})(?:{GAP}={GAP}({VALUE}))?+")
READ = re.compile("hidden|style|span|open|media", re.I)
DECLARED = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([\w-]+)\s*(!\s*important)?", re.I)
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
SPACES = re.compile(r"[ \t\n\r\f]+")
SPAN = re.compile(r"\s*(\d{1,6})")
RULE = re.compile(r"([^{}]*)\{([^{}]*)\}")
SIMPLE = re.compile(r"([A-Za-z][\w-]*|\*)?((?:[.#][\w-]+)*)$")
AT_BLOCK = re.compile(r"@[^{};]*(?:;|\{(?:[^{}]*\{[^{}]*\})*[^{}]*\})")


def attributes_of(tag: str, every: bool = False) -> dict[str, str]:
    """Names, in lower case, and values of a tag's attributes, if one that is read may be among them (or all,
    with ``every``). Of attributes with one name the first counts."""
    found: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(tag) if every or READ.search(tag) else ():
        found.setdefault(name.lower(), unescape(value[1:-1] if value[:1] in ("'", '"') else value))
    return found


Declared = dict[str, tuple[bool, tuple, str]]


def declare(into: Declared, declarations: str, rank: tuple) -> None:
    """Adds the declarations of display and visibility: important ones before others, then by rank, and of
    one rank the last."""
    for name, value, important in DECLARED.findall(declarations):
        name, weight = name.lower(), (bool(important), rank)
        if name not in into or weight >= into[name][:2]:
            into[name] = *weight, value.lower()


class Sheet:
    """The rules of a page's style elements that have one simple selector of element, classes and id, and
    declare display or visibility. Rules for other media and of other forms are left out."""

    def __init__(self) -> None:
        self.rules: dict[str, list[tuple[str, frozenset, frozenset, tuple, str]]] = {}
        self.count = 0

    def read(self, text: str) -> None:
        for selectors, declarations in RULE.findall(AT_BLOCK.sub("", COMMENT.sub("", text))):
            if not DECLARED.search(declarations):
                continue
            for selector in selectors.split(","):
                simple = SIMPLE.match(selector.strip())
                if not simple or not simple[0]:
                    continue
                tag = "" if simple[1] in (None, "*") else simple[1].lower()
                parts = re.findall(r"([.#])([\w-]+)", simple[2] or "")
                classes = frozenset(name for kind, name in parts if kind == ".")
                ids = frozenset(name for kind, name in parts if kind == "#")
                self.count += 1
                rank = (len(ids), len(classes), bool(tag), self.count)
                # Rules are found by one of their parts.
                place = f"#{min(ids)}" if ids else f".{min(classes)}" if classes else tag
                self.rules.setdefault(place, []).append((tag, classes, ids, rank, declarations))

    def declared(self, tag: str, attributes: dict[str, str]) -> Declared:
        found: Declared = {}
        classes, own = set(attributes.get("class", "").split()), attributes.get("id", "")
        places = [tag, "", *(f".{name}" for name in classes), *([f"#{own}"] if own else [])]
        for place in places:
            for of, wanted, ids, rank, declarations in self.rules.get(place, ()):
                if of in ("", tag) and wanted <= classes and ids <= {own}:
                    declare(found, declarations, rank)
        return found


NO_SHEET = Sheet()
INLINE = (9, 0, 0, 0)


def display(tag: str, attributes: dict[str, str], sheet: Sheet = NO_SHEET) -> tuple[bool, bool | None]:
    """Whether an element has no display, and its visibility (None: as its parent)."""
    declared = sheet.declared(tag, attributes) if sheet.rules else {}
    if "style" in attributes:
        declare(declared, COMMENT.sub("", attributes["style"]), INLINE)
    shown = declared.get("display", (0, 0, ""))[2]
    gone = shown == "none" or ("hidden" in attributes and not shown) or (tag == "dialog" and "open" not in attributes and not shown)
    seen = declared.get("visibility", (0, 0, ""))[2]
    if seen == "collapse" and tag in ("tr", "thead", "tbody", "tfoot"):
        gone = True
    return gone, {"hidden": False, "collapse": False, "visible": True}.get(seen)


class Writer:
    """Lines of one flow of text. Margins meet: two blocks with blank lines around them share one."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap, self.margin = False, 0
        self.indents: list[str] = []
        self.mark = ""

    def text(self, text: str, keep: bool) -> None:
        if keep:
            first, *rest = text.split("\n")
            self._put(first)
            for line in rest:
                self.end_line(force=True)
                self._put(line)
            return
        words = SPACES.sub(" ", text)
        if words == " " or not words:
            self.gap = self.gap or bool(words)
            return
        if words[0] == " ":
            self.gap, words = True, words[1:]
        ends = words[-1] == " "
        self._put((" " if self.gap and self.line else "") + (words[:-1] if ends else words))
        self.gap = ends

    def _put(self, text: str) -> None:
        if not text:
            return
        if not self.line:
            if self.margin and self.lines:
                self.lines.append("")
            self.margin = 0
            indent = "".join(self.indents)
            if self.mark:
                indent, self.mark = indent[: -len(self.mark)] + self.mark, ""
            self.line.append(indent)
        self.line.append(text)

    def end_line(self, force: bool = False) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip())
            self.line = []
        elif force and self.lines:
            self.lines.append("")
        self.gap = False

    def block(self, spaced: bool) -> None:
        self.end_line()
        self.margin = self.margin or int(spaced)

    def whole(self, lines: list[str]) -> None:
        """Lines that are laid out already."""
        for line in lines:
            self._put(line) if line else None
            self.end_line(force=True)

    def result(self) -> list[str]:
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def wrapped(line: str) -> list[str]:
    """A line cut at spaces into parts of at most ``WRAP`` characters, where its words allow."""
    if len(line) <= WRAP:
        return [line]
    lead = line[: len(line) - len(line.lstrip())]
    parts, held = [], lead
    for word in line.split():
        if held.strip() and len(held) + 1 + len(word) > WRAP:
            parts.append(held)
            held = lead
        held += (" " if held.strip() else "") + word
    return [*parts, held]


class Table:
    """Rows of cells, as (lines, columns, rows); ``rows`` 0 is down to the end."""

    def __init__(self):
        self.rows: list[list[tuple[list[str], int, int]]] = []

    def cell(self, lines: list[str], span: int, down: int) -> None:
        if not self.rows:
            self.rows.append([])
        self.rows[-1].append((lines, span, down))

    def placed(self) -> list[list[tuple[int, int, list[str]]]]:
        """The cells of each row with their first column: the next that no cell from above covers."""
        covered: dict[int, int] = {}
        out = []
        for number, row in enumerate(self.rows):
            at, cells = 0, []
            for lines, span, down in row:
                while covered.get(at, 0) > number:
                    at += 1
                cells.append((at, span, lines))
                if down != 1:
                    covered.update((at + k, number + down if down else len(self.rows)) for k in range(span))
                at += span
            out.append([
                (at, span, [part for line in lines for part in wrapped(line)] if n < len(cells) - 1 else lines)
                for n, (at, span, lines) in enumerate(cells)
            ])
        return out

    def lines(self) -> list[str]:
        rows, widths = self.placed(), {}
        for cells in rows:
            for n, (at, span, lines) in enumerate(cells):
                if span == 1:
                    # What only stands at a row's end moves nothing but what comes below it.
                    wide = max(map(len, lines), default=0)
                    widths[at] = max(widths.get(at, 0), wide if n < len(cells) - 1 else min(wide, WRAP))
        for cells in rows:
            for at, span, lines in cells[:-1]:
                own = sum(widths.get(at + k, 0) for k in range(span)) + 2 * (span - 1)
                if span > 1 and (more := max(map(len, lines), default=0) - own) > 0:
                    widths[at + span - 1] = widths.get(at + span - 1, 0) + more
        begins, at = {}, 0
        for column in range(max((cells[-1][0] for cells in rows if cells), default=-1) + 1):
            begins[column] = at
            at += widths.get(column, 0) + 2
        out = []
        for cells in rows:
            for n in range(max((len(lines) for _, _, lines in cells), default=0)):
                line = ""
                for column, _, lines in cells:
                    part = lines[n] if n < len(lines) else ""
                    if part:
                        line = line.ljust(max(begins[column], len(line) + 2 if line else 0)) + part
                out.append(line.rstrip())
        return out


class Renderer:
    """The open elements, and the writer of each flow: the page's, and one per open cell."""

    def __init__(self, sheet: Sheet = NO_SHEET):
        self.sheet = sheet
        self.open: list[str] = []
        self.counts: Counter = Counter()
        self.writers = [Writer()]
        self.tables: list[Table] = []
        self.spans: list[tuple[int, int]] = []
        self.lists: list[list] = []
        self.unseen = 0
        self.marks: list[bool] = []
        # Of each open element: whether its text is visible, and whether it is a details still without summary
        # (False: with one; None: anything else, or open).
        self.visible: list[bool] = []
        self.folded: list[bool | None] = []
        self.pre = 0

    def start(self, tag: str, attributes: dict[str, str], closed: bool) -> None:
        if tag in CLOSES:
            targets, limits = CLOSES[tag]
            self._close_within(targets, limits)
        elif self.open and self.open[-1] == "head" and tag not in HEAD_PARTS:
            self._pop()
        if tag in BLOCKS:
            self._close_within({"p"}, BARRIERS)
        if tag in ("td", "th") and self.tables and "tr" not in self._in_table():
            self.start("tr", {}, False)
        fold = self.folded[-1] if self.folded else None
        folded = fold is not None and not (fold and tag == "summary")
        if fold and tag == "summary":
            self.folded[-1] = False
        gone, seen = display(tag, attributes, self.sheet)
        shown = not self.unseen and not folded
        if shown and tag in BLOCKS and not gone:
            self.writers[-1].block(tag in SPACED and not (tag in ("ul", "ol") and self.lists))
        if tag == "br" and shown:
            self.writers[-1].end_line(force=True)
        if tag in VOID:
            return
        hidden = tag in UNSEEN or gone or folded
        self.open.append(tag)
        self.counts[tag] += 1
        self.marks.append(hidden)
        self.visible.append(seen if seen is not None else self.visible[-1] if self.visible else True)
        self.folded.append(True if tag == "details" and "open" not in attributes else None)
        self.unseen += hidden
        if self.unseen:
            return
        if tag == "table":
            self.tables.append(Table())
        elif tag == "tr" and self.tables:
            self.tables[-1].rows.append([])
        elif tag in ("td", "th") and self.tables:
            span, down = SPAN.match(attributes.get("colspan", "")), SPAN.match(attributes.get("rowspan", ""))
            columns = min(MAX_COLSPAN, max(1, int(span[1]))) if span else 1
            self.spans.append((columns, min(MAX_ROWSPAN, int(down[1])) if down else 1))
            self.writers.append(Writer())
        elif tag in ("ul", "ol"):
            self.lists.append([tag, 0])
        elif tag == "li":
            kind = self.lists[-1] if self.lists else ["ul", 0]
            kind[1] += 1
            mark = f"{kind[1]}. " if kind[0] == "ol" else "- "
            writer = self.writers[-1]
            writer.mark = mark
            writer.indents.append(" " * len(mark))
        elif tag == "pre":
            self.pre += 1

    def _in_table(self) -> list[str]:
        for n in range(len(self.open) - 1, -1, -1):
            if self.open[n] == "table":
                return self.open[n:]
        return []

    def _close_within(self, targets: set[str], limits: frozenset | set) -> None:
        """Pops up to the outermost open target that no limit shields."""
        found = None
        if not any(self.counts[tag] for tag in targets):
            return
        for n in range(len(self.open) - 1, -1, -1):
            if self.open[n] in targets:
                found = n
                if "p" in targets:
                    break
            elif self.open[n] in limits:
                break
        while found is not None and len(self.open) > found:
            self._pop()

    def _pop(self) -> None:
        tag, hidden, shown = self.open.pop(), self.marks.pop(), not self.unseen
        self.visible.pop()
        self.folded.pop()
        self.counts[tag] -= 1
        self.unseen -= hidden
        if not shown:
            return
        if tag in ("td", "th") and self.tables and len(self.writers) > 1:
            self.tables[-1].cell(self.writers.pop().result(), *self.spans.pop())
        elif tag == "table" and self.tables:
            writer = self.writers[-1]
            writer.block(True)
            writer.whole(self.tables.pop().lines())
        elif tag in ("ul", "ol") and self.lists:
            self.lists.pop()
        elif tag == "li":
            writer = self.writers[-1]
            writer.end_line()
            writer.mark = ""
            if writer.indents:
                writer.indents.pop()
        elif tag == "pre":
            self.pre -= 1
        if tag in BLOCKS:
            self.writers[-1].block(tag in SPACED and not (tag in ("ul", "ol") and self.lists))

    def end(self, tag: str) -> None:
        """Closes the element and what is open inside; an end tag without a start is ignored."""
        if not self.counts[tag]:
            return
        barrier = BARRIERS - {tag} if tag not in ("table", "body", "html", "tr", "thead", "tbody", "tfoot") else {"table"} - {tag}
        for n in range(len(self.open) - 1, -1, -1):
            if self.open[n] == tag:
                while len(self.open) > n:
                    self._pop()
                return
            if self.open[n] in barrier:
                return

    def text(self, text: str) -> None:
        if self.unseen:
            if self.open[-1] != "head" or text.isspace():
                return
            self._pop()
            if self.unseen:
                return
        if self.open and (not self.visible[-1] or self.folded[-1] is not None):
            return
        if "&" in text:
            text = unescape(text)
        self.writers[-1].text(text, self.pre > 0)

    def result(self) -> str:
        while self.open:
            self._pop()
        return "\n".join(self.writers[0].result())


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """What a page consists of: ("text", "", text), ("end", name, ""), ("start", name, attributes), and after
    a start tag whose element holds raw text ("raw", name, text). A page that ends within a tag ends there."""
    at = 0
    while match := TOKEN.match(html, at):
        at = match.end()
        tag = match[2]
        if tag is None:
            token = match[0]
            if token == "<" and UNCLOSED.match(html, at):
                return
            if token[0] != "<" or token == "<":
                yield "text", "", token
            continue
        tag = tag.lower()
        if match[1]:
            yield "end", tag, ""
            continue
        yield "start", tag, match[3]
        if tag in RAW:
            close = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(html, at)
            stop = close.start() if close else len(html)
            if stop > at:
                yield "raw", tag, html[at:stop]
            at = stop


def sheet_of(html: str) -> Sheet:
    """The rules of a page's style elements that hold for screens."""
    sheet, media = Sheet(), ""
    if "<style" not in html.lower():
        return sheet
    for kind, tag, text in tokens(html):
        if tag == "style" and kind == "start":
            media = attributes_of(text).get("media", "").lower()
        elif tag == "style" and kind == "raw" and (not media.strip() or "screen" in media or "all" in media):
            sheet.read(text)
    return sheet


def render(html: str | None) -> str:
    """The visible text of a page. Null and empty pages give an empty text. A page that ends within a tag
    ends there, as nothing after it is shown."""
    html = html or ""
    sheet = sheet_of(html)
    renderer, every = Renderer(sheet), bool(sheet.rules)
    for kind, tag, text in tokens(html):
        if kind == "text":
            renderer.text(text)
        elif kind == "end":
            renderer.end(tag)
        elif kind == "start":
            renderer.start(tag, attributes_of(text, every), text.endswith("/"))
        elif tag in ("textarea", "xmp"):
            renderer.text(text)
    return renderer.result()


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id and text of every page. A null page gives an empty text; repeated rows are rendered alike;
    an empty table gives no rows; other columns are not read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [render(html) for html in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["page_id", "text"])

    return pages.select("page_id", "html").mapInArrow(read, "page_id bigint, text string")


def op10_html_text(pages: DataFrame) -> DataFrame:
    return extract_text(pages)
