"""Visible text of HTML pages, laid out: blocks, lists and aligned tables.

A tokenizer feeds a tree builder that closes what HTML lets authors leave open (paragraphs, list items,
cells, ...). The tree is then walked once. Nothing that a browser would not show is written: heads, scripts,
styles, comments, ``hidden``, ``display: none`` and ``visibility: hidden`` (inline or by a simple selector of
a style sheet in the page), closed ``details`` and dialogs. White space collapses except in ``pre``;
blocks stand on lines of their own, paragraphs and the like with one blank line between; list items
keep bullets, numbers and indentation; the cells of a table column begin at the same place.

Tree and walk use explicit stacks, so depth is no limit; every step is linear in the page. Cells are padded
to at most ``CELL_PAD`` characters, which bounds what a table can grow to.

Edge cases. NULL and empty pages give an empty text. A page cut off within a tag, comment or script
loses that unfinished piece, as in a browser. Unknown entities stay as they are. Repeated pages give the
same text. An empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

CELL_PAD = 60
DEEPEST_TABLE = 20

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript".split())
TEXT_ONLY = frozenset("textarea title".split())
UNSEEN = frozenset(
    "head script style template noscript noembed noframes iframe datalist object audio video canvas"
    " title meta link base param map".split()
)
#: Blank line before and after; a line of their own only.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre figure table hr fieldset".split())
LINED = frozenset(
    "html body div section article aside header footer nav main address form li dt dd details summary"
    " figcaption legend caption center menu dialog search optgroup option".split()
)
#: A start tag that ends an open paragraph.
ENDS_P = SPACED | frozenset(
    "div section article aside header footer nav main address form li dt dd details figcaption center"
    " menu dialog".split()
)
#: start tag: (open elements it ends, elements that stop the search)
LIST_EDGE = frozenset("ul ol menu table td th body".split())
CLOSES = {
    "li": (frozenset(["li"]), LIST_EDGE),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl", "table", "td", "th", "body"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl", "table", "td", "th", "body"])),
    "option": (frozenset(["option"]), frozenset(["select", "optgroup", "datalist", "body"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select", "body"])),
    "td": (frozenset(["td", "th", "caption", "colgroup"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th", "caption", "colgroup"]), frozenset(["table", "tr"])),
    "tr": (frozenset(["tr", "td", "th", "caption", "colgroup"]), frozenset(["table"])),
    "thead": (frozenset(["thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"]), frozenset(["table"])),
    "rt": (frozenset(["rt", "rp"]), frozenset(["ruby", "body"])),
}
CLOSES["tbody"] = CLOSES["tfoot"] = CLOSES["thead"]
CLOSES["rp"] = CLOSES["rt"]
CELL = frozenset(["td", "th"])
TABLE_PART = frozenset("td th tr thead tbody tfoot caption colgroup table".split())

NAME = re.compile(r"/?[A-Za-z][^\s/>]*")
ATTRIBUTE = re.compile(
    r"""([^\s=>/"'][^\s=>/]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*)))?"""
)
INSIDE_TAG = re.compile(r"""(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=|["'])*+>""")
SPACE = re.compile(r"[ \t\n\r\f]+")
RULE = re.compile(r"([^{}]*)\{([^{}]*)\}")
AT_RULE = re.compile(r"@([\w-]+)([^{};]*)([{;]|\Z)")
BRACE = re.compile(r"[{}]")
FEATURE = re.compile(r"\(([^()]*)\)")
WIDTH = re.compile(r"\s*(min|max)-width\s*:\s*([\d.]+)\s*(px|r?em)\s*")
#: The screen that style sheets are read for.
SCREEN_PX = 1280
SIMPLE = re.compile(r"([a-zA-Z][\w-]*)?([.#][\w-]+)?")


class Element:
    __slots__ = ("tag", "raw", "children")

    def __init__(self, tag: str, raw: str = ""):
        self.tag, self.raw = tag, raw
        self.children: list[Element | str] = []

    def attributes(self) -> dict[str, str]:
        if not self.raw or self.raw.isspace():
            return {}
        found = {}
        for name, double, single, bare in ATTRIBUTE.findall(self.raw):
            found.setdefault(name.lower(), html.unescape(double or single or bare))
        return found


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes): ``text``, ``raw``, ``start`` and ``end``."""
    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", page[at:], ""
            return
        if lt > at:
            yield "text", page[at:lt], ""
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        match = NAME.match(page, lt + 1)
        if not match:
            yield "text", "<", ""
            at = lt + 1
            continue
        name = match.group().lower()
        end = page.find(">", match.end())
        if end < 0:
            return
        if "'" in page[match.end() : end] or '"' in page[match.end() : end]:
            inside = INSIDE_TAG.match(page, match.end())
            if not inside:
                return
            end = inside.end() - 1
        raw = page[match.end() : end]
        at = end + 1
        if name[0] == "/":
            yield "end", name[1:], ""
            continue
        yield "start", name, raw
        if (name in RAW or name in TEXT_ONLY) and not raw.endswith("/"):
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(page, at)
            stop = close.start() if close else n
            yield ("raw" if name in RAW else "text"), page[at:stop], ""
            at = stop


def tree_of(page: str) -> Element:
    """The page as a tree; what authors leave open is closed by what follows."""
    root = Element("html")
    stack = [root]
    open_count: dict[str, int] = {}

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            open_count[stack.pop().tag] -= 1

    def close(names: frozenset[str], edge: frozenset[str]) -> None:
        """Ends the outermost open element of ``names`` above the nearest ``edge``."""
        if not any(open_count.get(x) for x in names):
            return
        found = 0
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in edge:
                break
            if stack[depth].tag in names:
                found = depth
        if found:
            pop_to(found)

    p_edge = frozenset("table td th caption button object body".split())
    for kind, name, raw in tokens(page):
        if kind in ("text", "raw"):
            stack[-1].children.append(html.unescape(name) if kind == "text" and "&" in name else name)
        elif kind == "start":
            if name == "html":
                continue
            if name == "body" or (name not in UNSEEN and open_count.get("head")):
                close(frozenset(["head"]), frozenset())
            if name in ENDS_P:
                close(frozenset(["p"]), p_edge)
            if name in CLOSES:
                close(*CLOSES[name])
            if name in CELL and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
                row = Element("tr")
                stack[-1].children.append(row)
                stack.append(row)
                open_count["tr"] = open_count.get("tr", 0) + 1
            element = Element(name, raw)
            stack[-1].children.append(element)
            if name not in VOID and not (raw.endswith("/") and name in ("path", "rect", "circle", "use")):
                stack.append(element)
                open_count[name] = open_count.get(name, 0) + 1
        elif name == "br":
            stack[-1].children.append(Element("br"))
        elif open_count.get(name):
            edge = TABLE_PART - {name} if name not in TABLE_PART else frozenset(["table"] if name != "table" else [])
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == name:
                    pop_to(depth)
                    break
                if stack[depth].tag in edge:
                    break
    return root


Sheet = dict[str, dict[str, str]]


def _fits(query: str) -> bool:
    """Whether one media query holds on a screen of that width; features other than the width do not."""
    words = FEATURE.sub(" ", query).split()
    inverted = words[:1] == ["not"]
    holds = not {"print", "speech"} & set(words)
    for feature in FEATURE.findall(query):
        width = WIDTH.fullmatch(feature)
        if width is None:
            holds = False
        else:
            try:
                pixels = float(width[2]) * (1 if width[3] == "px" else 16)
            except ValueError:
                pixels = float("nan")
            holds &= SCREEN_PX >= pixels if width[1] == "min" else SCREEN_PX <= pixels
    return holds != inverted


def screen_rules(css: str) -> str:
    """Style text without the bodies of at-rules that do not apply to the screen.

    ``@media`` applies if one of its queries holds, ``@layer`` and ``@supports`` always (unless negated).
    What applies only loses its head; the brace that closed it then stands alone and starts no rule.
    """
    kept, at = [], 0
    while found := AT_RULE.search(css, at):
        kept.append(css[at : found.start()])
        at = found.end()
        name, condition = found[1].lower(), found[2].lower().strip()
        if found[3] != "{":
            continue
        if name == "media":
            applies = not condition or any(map(_fits, condition.split(",")))
        else:
            applies = name in ("layer", "supports") and not condition.startswith("not")
        if not applies:
            depth = 1
            for brace in BRACE.finditer(css, at):
                depth += 1 if brace[0] == "{" else -1
                if not depth:
                    break
            at = brace.end() if not depth else len(css)
    kept.append(css[at:])
    return "".join(kept)


def sheet_of(root: Element) -> Sheet:
    """display and visibility by simple selector (tag, .class, #id, tag.class) from style elements."""
    rules: Sheet = {}
    todo = [root]
    while todo:
        element = todo.pop()
        if element.tag == "style":
            css = re.sub(r"/\*.*?\*/", "", "".join(c for c in element.children if isinstance(c, str)), flags=re.S)
            for selectors, body in RULE.findall(screen_rules(css)):
                if "display" in body or "visibility" in body:
                    for selector in selectors.split(","):
                        if SIMPLE.fullmatch(selector.strip()) and selector.strip():
                            rules.setdefault(selector.strip(), {}).update(declarations(body))
        todo.extend(c for c in reversed(element.children) if isinstance(c, Element))
    return rules


def declarations(css: str) -> dict[str, str]:
    """display and visibility; important ones under the name with a ``!`` before it."""
    found = {}
    for declaration in css.lower().split(";"):
        name, _, value = (part.strip() for part in declaration.partition(":"))
        if name in ("display", "visibility"):
            value, _, flag = (part.strip() for part in value.partition("!"))
            found["!" + name if flag == "important" else name] = value
    return found


def style_of(element: Element, attributes: dict[str, str], sheet: Sheet) -> dict[str, str]:
    """What holds for one element: by rank of the selector, then its own style, then what is important."""
    style: dict[str, str] = {}
    if sheet:
        classes = [f".{c}" for c in attributes.get("class", "").split()]
        ids = [f"#{attributes['id']}"] if "id" in attributes else []
        ranked = ["*", element.tag]
        for names in (classes, ids):
            ranked += [*names, *(element.tag + x for x in names)]
        for selector in ranked:
            style |= sheet.get(selector, {})
    if "style" in attributes:
        style |= declarations(attributes["style"])
    return style | {k[1:]: v for k, v in style.items() if k[0] == "!"}


class Writer:
    """Lines of one block of text: the page, or a cell."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0
        self.space = False
        self.indent: list[str] = []
        self.marker: str | None = None

    def _begin(self) -> None:
        if self.lines:
            self.lines.extend([""] * (self.gap - 1))
        self.gap = 0
        if self.marker is not None:
            self.line.append("".join(self.indent[:-1]) + self.marker)
            self.marker = None
        else:
            self.line.append("".join(self.indent))

    def flow(self, text: str) -> None:
        """Running text: white space collapses, and vanishes at the ends of a line."""
        words = SPACE.split(text)
        if len(words) == 1 and not words[0]:
            return
        lead, tail = not words[0], not words[-1]
        body = " ".join(words[lead : len(words) - tail])
        if not body:
            self.space = True
            return
        if not self.line:
            self._begin()
        elif lead or self.space:
            self.line.append(" ")
        self.line.append(body)
        self.space = tail

    def verbatim(self, lines: list[str]) -> None:
        """Lines as they are, each after the indentation."""
        for i, line in enumerate(lines):
            if i:
                self.end_line(keep=True)
            if line or (i and i < len(lines) - 1):
                if not self.line:
                    self._begin()
                self.line.append(line)

    def end_line(self, keep: bool = False) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip(" "))
            self.line = []
            self.gap = 1
        elif keep:
            self.gap += 1
        self.space = False

    def block(self, lines: int) -> None:
        self.end_line()
        self.gap = max(self.gap, lines)

    def finish(self) -> list[str]:
        self.end_line()
        return self.lines


class Table:
    """Cells of an open table, and the writer that was interrupted by it."""

    def __init__(self, outer: Writer):
        self.outer = outer
        self.rows: list[list[tuple[list[str], int]]] = []
        self.down: dict[int, int] = {}
        self.captions: list[list[str]] = []

    def begin_row(self) -> None:
        self.rows.append([])

    def add(self, lines: list[str], across: int, down: int) -> None:
        if not self.rows:
            self.begin_row()
        row = self.rows[-1]
        while self.down.get(len(row), 0) >= len(self.rows):
            row.append(([], 1))
        for i in range(across):
            row.append((lines if i == 0 else [], 1))
            if down > 1:
                self.down[len(row) - 1] = len(self.rows) + down - 1

    def lines(self) -> list[str]:
        rows = [r for r in self.rows if any(cell for cell, _ in r)]
        widths: list[int] = []
        for row in rows:
            for i, (cell, _) in enumerate(row):
                if i == len(widths):
                    widths.append(0)
                widths[i] = max(widths[i], min(CELL_PAD, max(map(len, cell), default=0)))
        out = [line for caption in self.captions for line in caption]
        for row in rows:
            for k in range(max(len(cell) for cell, _ in row)):
                parts = [
                    (cell[k] if k < len(cell) else "").ljust(widths[i]) for i, (cell, _) in enumerate(row)
                ]
                out.append("  ".join(p for p, w in zip(parts, widths) if w).rstrip(" "))
        return out


def _whole(text: str | None, least: int, most: int) -> int:
    match = re.match(r"\s*(-?\d{1,9})", text or "")
    return max(least, min(most, int(match.group(1)))) if match else 1


def _number(value: int, kind: str) -> str:
    if kind in ("a", "A") and value > 0:
        letters = ""
        while value:
            value, digit = divmod(value - 1, 26)
            letters = chr(97 + digit) + letters
        return letters if kind == "a" else letters.upper()
    return str(value)


def rendered(root: Element) -> str:
    """The visible text of a tree."""
    sheet = sheet_of(root)
    writer = Writer()
    tables: list[Table] = []
    lists: list[list] = []  # [kind or None, next number]
    pre = 0
    # (element, state on leaving) or (child, shown); the last is next
    todo: list[tuple] = [("visit", root, True)]
    while todo:
        act, node, state = todo.pop()
        if act == "visit" and isinstance(node, str):
            if state:
                if pre:
                    writer.verbatim(node.replace("\r\n", "\n").split("\n"))
                else:
                    writer.flow(node)
            continue
        tag = node.tag
        if act == "visit":
            if tag in UNSEEN:
                continue
            attributes = node.attributes()
            style = style_of(node, attributes, sheet) if sheet or "style" in attributes else {}
            if "hidden" in attributes or style.get("display") == "none":
                continue
            shown = state
            if "visibility" in style:
                shown = style["visibility"] not in ("hidden", "collapse")
            children = node.children
            if tag == "br":
                writer.end_line(keep=True)
                continue
            if tag == "input":
                if attributes.get("type", "").lower() != "hidden" and shown:
                    writer.flow(f" {attributes.get('value', '')} ")
                continue
            if tag == "dialog" and "open" not in attributes:
                continue
            if tag == "details" and "open" not in attributes:
                children = [c for c in children if isinstance(c, Element) and c.tag == "summary"][:1]
            leave = None
            if tag == "table" and len(tables) < DEEPEST_TABLE:
                tables.append(Table(writer))
                leave = "table"
            elif tag == "tr" and tables:
                tables[-1].begin_row()
                leave = "row"
            elif tag in ("td", "th", "caption") and tables:
                writer = Writer()
                leave = (tag, _whole(attributes.get("colspan"), 1, 100), _whole(attributes.get("rowspan"), 1, 1000))
            elif tag in ("table", "tr", "td", "th", "caption"):
                writer.block(1)
                leave = 1
            elif tag in ("ul", "ol", "menu"):
                writer.block(1 if lists else 2)
                first = _whole(attributes.get("start"), -(10**9), 10**9)
                lists.append([None if tag != "ol" else attributes.get("type", "1"), first])
                leave = "list"
            elif tag == "li":
                if writer.marker is not None:
                    writer._begin()
                writer.block(1)
                marker = "- "
                if lists and lists[-1][0] is not None:
                    if "value" in attributes:
                        lists[-1][1] = _whole(attributes["value"], -(10**9), 10**9)
                    marker = f"{_number(lists[-1][1], lists[-1][0])}. "
                    lists[-1][1] += 1
                writer.indent.append(" " * len(marker))
                writer.marker = marker if shown else None
                leave = "item"
            elif tag in ("dd", "blockquote"):
                writer.block(1 if tag == "dd" else 2)
                writer.indent.append("  ")
                leave = tag
            elif tag == "pre":
                writer.block(2)
                pre += 1
                leave = "pre"
                if children and isinstance(children[0], str):
                    children = [children[0].removeprefix("\n"), *children[1:]]
            elif tag in SPACED or tag in LINED:
                leave = 2 if tag in SPACED else 1
                writer.block(leave)
            elif tag in ("select", "button", "textarea"):
                writer.flow(" ")
                leave = "inline"
            if leave is not None:
                todo.append(("leave", node, leave))
            todo.extend(("visit", child, shown) for child in reversed(children))
            continue
        if isinstance(state, int):
            writer.block(state)
        elif state == "table":
            table = tables.pop()
            writer = table.outer
            writer.block(2)
            writer.verbatim(table.lines())
            writer.block(2)
        elif isinstance(state, tuple):
            lines = writer.finish()
            table = tables[-1]
            writer = table.outer
            if state[0] == "caption":
                table.captions.append(lines)
            else:
                table.add(lines, state[1], state[2])
        elif state == "list":
            lists.pop()
            writer.block(1 if lists else 2)
        elif state == "item":
            writer.block(1)
            writer.indent.pop()
            writer.marker = None
        elif state in ("dd", "blockquote"):
            writer.block(1 if state == "dd" else 2)
            writer.indent.pop()
        elif state == "pre":
            writer.block(2)
            pre -= 1
        elif state == "inline":
            writer.flow(" ")
    return "\n".join(writer.finish())


def visible_text(page: str | None) -> str:
    return rendered(tree_of(page)) if page else ""


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, the visible ``text`` and its ``n_chars`` and ``n_lines``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts = [visible_text(p) for p in batch["html"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["page_id"],
                        batch["url"],
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64()),
                    ],
                    names=["page_id", "url", "text", "n_chars", "n_lines"],
                )

    return pages.selectExpr("cast(page_id AS long) AS page_id", "cast(url AS string) AS url", "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long, n_lines long"
    )
