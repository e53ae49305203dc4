"""Visible text of HTML pages, laid out.

A page becomes a tree: end tags that HTML lets authors omit are implied (``p``,
``li``, ``dt``, ``dd``, ``tr``, ``td``, ``option`` ...), and so are ``tr`` around loose
cells and the end of ``head``; stray end tags are dropped. What a browser would not
show is left out: scripts, styles, templates, ``hidden`` elements, closed ``details``
but for their summary, closed dialogs, MathML annotations, what svg only describes or defines, and
what inline styles or the page's own simple style rules (``tag``, ``.class``,
``#id``) set to ``display: none`` or ``visibility: hidden`` (a part set to visible
within an invisible one is shown). A tag is read by its attributes, each part of a
page once; a tag that nothing ends is text. Rules are read with
their nesting, those of media other than a screen ``SCREEN`` pixels wide are left
out, and the cascade decides: importance, inline style, id, class, tag, then order.

The tree is laid out as text: blocks start on lines of their own, paragraphs,
headings, lists and tables are set off by a blank line, list items have a dash or
their number and are indented by depth, ``pre`` keeps its white space, and the cells
of a table are padded to columns, apart by two spaces. Columns wider than
``WIDEST`` are not padded, so a page's text stays in proportion to the page.

One pass without a shuffle; each page on its own, without recursion, so deep
nesting is no problem. Rows: NULL and empty pages give an empty text; repeated rows
give equal texts; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDEST = 60
INDENT = "  "
#: Width of the screen for which media rules are read.
SCREEN = 1280

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is not markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
UNSEEN = frozenset(
    "head script style template noscript title iframe noembed noframes object audio video canvas datalist annotation annotation-xml".split()
)
#: Types of input that show their value.
BUTTONS = frozenset("submit button reset".split())
#: Unseen within svg.
SVG_UNSEEN = frozenset("desc defs metadata".split())
HEAD = frozenset("base link meta title style script template noscript".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dl table blockquote pre figure fieldset hr".split())
BLOCKS = SPACED | frozenset(
    "html body div section article aside header footer nav main address form li dt dd tr td th caption thead tbody tfoot "
    "legend details summary figcaption optgroup option hgroup search center dir".split()
)
ENDS_PARAGRAPH = (SPACED | frozenset(
    "div section article aside header footer nav main address form details summary figcaption center dir hgroup search li dt dd".split()
))
CELLS, SECTIONS = ("td", "th"), ("thead", "tbody", "tfoot")
#: Start tags that end open elements, and the elements beyond which they don't look.
IMPLIED: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "td": (CELLS, ("table",)),
    "th": (CELLS, ("table",)),
    "tr": (("tr", "caption"), ("table",)),
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("option", "optgroup"), ("select",)),
    **{name: (("caption", "tr", *SECTIONS), ("table",)) for name in SECTIONS},
}
#: Elements that an end tag inside them doesn't close from within.
BARRIERS = frozenset(("table", "td", "th", "caption", "button", "template"))

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)", re.S,
)
# A quote opens a value only after "="; without an end it is part of a name.
_ATTRIBUTE = re.compile(r"""[\s/]*+(=?[^\s/>=]++|=)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|(?!["'])([^\s>]*+)))?+""")
_ATTRIBUTES = re.compile(rf"((?:{_ATTRIBUTE.pattern.replace('(=?', '(?:=?').replace('([^', '(?:[^')})*+[\s/]*+)>")
_TO_END = re.compile(r"([^>]*+)>")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_CSS = re.compile(r"""((?:[^{};"']|"[^"]*"|'[^']*'|["'])*+)([{};]|\Z)""")
_DECLARATION = re.compile(r"\s*(display|visibility)\s*:\s*([\w-]+)[^!]*(!\s*important)?\s*", re.I)
_FEATURE = re.compile(r"\(\s*(min|max)-(?:device-)?width\s*:\s*(\d+(?:\.\d+)?)(px|em|rem)\s*\)")
_SELECTOR = re.compile(r"([a-zA-Z][\w-]*)?(?:\.([\w-]+)|#([\w-]+))?")


class Node:
    __slots__ = ("tag", "attributes", "children", "hidden", "block")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag = tag
        self.attributes = attributes
        self.children: list[Node | str] = []
        self.hidden = False
        self.block = tag in BLOCKS


def parse(page: str) -> Node:
    """The tree of a page."""
    return _Builder().build(page)


class _Builder:
    def __init__(self) -> None:
        self.root = Node("html", {})
        self.open = [self.root]
        self.count: Counter[str] = Counter()

    def build(self, page: str) -> Node:
        at, last = 0, page.rfind(">")
        tail = _ATTRIBUTES
        while match := _TOKEN.search(page, at):
            self.text(page[at:match.start()])
            at = match.end()
            close, name = match.groups()
            if not name:
                if match.group().startswith("<![CDATA["):
                    self.text(match.group()[9:].removesuffix("]]>"), plain=True)
                continue
            if at > last:  # nothing ends this tag
                self.text(match.group())
                continue
            ended = tail.match(page, at)
            if not ended:  # only values hold a ">": from here on the next one ends a tag, so no text is read twice
                tail = _TO_END
                ended = tail.match(page, at)
            at, rest = ended.end(), ended.group(1)
            name = name.lower()
            if close:
                self.end(name)
                continue
            self.start(name, rest)
            if name in RAW and self.open[-1].tag == name:
                close_at = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*+(?:>|\Z)", re.I).search(page, at)
                raw = page[at:close_at.start() if close_at else len(page)]
                self.text(raw, plain=name not in ("textarea", "title"))
                at = close_at.end() if close_at else len(page)
                self.end(name)
        self.text(page[at:])
        return self.root

    def text(self, raw: str, plain: bool = False) -> None:
        if not raw:
            return
        if self.open[-1].tag == "head" and raw.strip():
            self.pop_to("head")
        self.open[-1].children.append(unescape(raw) if "&" in raw and not plain else raw)

    def start(self, name: str, rest: str) -> None:
        if name in ("html", "body"):
            if name == "body" and self.count["head"]:
                self.pop_to("head")
            if name == "html" or self.count["body"]:
                return
        elif self.open[-1].tag == "head" and name not in HEAD:
            self.pop_to("head")
        if name in ENDS_PARAGRAPH and self.count["p"]:
            self.close(("p",), BARRIERS)
        if name in IMPLIED:
            self.close(*IMPLIED[name])
        if name in CELLS and self.count["table"] and self.open[-1].tag in ("table", *SECTIONS):
            self.push(Node("tr", {}))
        attributes = {}
        if rest and not rest.isspace():
            at = 0
            while found := _ATTRIBUTE.match(rest, at):
                at = found.end()
                attributes.setdefault(found[1].lower(), unescape(next(filter(None, found.groups()[1:]), "")))
        node = Node(name, attributes)
        foreign = self.count["svg"] or self.count["math"] or name in ("svg", "math")
        if self.count["svg"]:
            node.hidden = name in SVG_UNSEEN
            node.block = node.block or name == "text"
        if name in VOID or foreign and rest.endswith("/"):
            self.open[-1].children.append(node)
        else:
            self.push(node)

    def push(self, node: Node) -> None:
        self.open[-1].children.append(node)
        self.open.append(node)
        self.count[node.tag] += 1

    def close(self, names: tuple[str, ...], beyond) -> None:
        """Close the outermost open element of ``names`` this side of ``beyond``."""
        if not any(self.count[name] for name in names):
            return
        found = None
        for place in range(len(self.open) - 1, 0, -1):
            tag = self.open[place].tag
            if tag in names:
                found = place
            elif tag in beyond:
                break
            # only cells, rows and their like lie within one another
            if found is not None and len(names) == 1:
                break
        if found is not None:
            self.cut(found)

    def end(self, name: str) -> None:
        if name == "br":
            self.open[-1].children.append(Node("br", {}))
        if not self.count[name] or name in ("html", "body"):
            return
        for place in range(len(self.open) - 1, 0, -1):
            tag = self.open[place].tag
            if tag == name:
                self.cut(place)
                return
            if tag in BARRIERS and name not in ("table", "tr", *CELLS, *SECTIONS):
                return

    def pop_to(self, name: str) -> None:
        for place in range(len(self.open) - 1, 0, -1):
            if self.open[place].tag == name:
                self.cut(place)
                return

    def cut(self, place: int) -> None:
        for node in self.open[place:]:
            self.count[node.tag] -= 1
        del self.open[place:]


#: Of each property, by ("tag" | "class" | "id", name): (important, kind, order) and whether it hides.
Rules = dict[tuple[str, str], dict[str, tuple[tuple[bool, int, int], bool]]]


def on_screen(prelude: str) -> bool:
    """Whether the rules in an at-rule's block hold on the screen."""
    name, _, query = prelude.strip().lower().partition(" ")
    if name.startswith("@media"):
        return any(_matches(part) for part in f"{name[6:]} {query}".split(","))
    return name.startswith("@layer") or name.startswith("@supports") and not re.match(r"@supports\s*not\b", prelude.strip().lower())


def _matches(query: str) -> bool:
    query = query.strip()
    if query.startswith("not "):
        return not _matches(query[4:])
    for part in re.split(r"\band\b", query.removeprefix("only ")):
        part = part.strip()
        feature = _FEATURE.fullmatch(part)
        if feature:
            width = float(feature[2]) * (1 if feature[3] == "px" else 16)
            if width > SCREEN if feature[1] == "min" else width < SCREEN:
                return False
        elif part not in ("", "all", "screen"):
            return False
    return True


def declared(body: str) -> dict[str, tuple[bool, bool]]:
    """(important, hides) of display and visibility, as the last declaration has them."""
    found: dict[str, tuple[bool, bool]] = {}
    for part in _COMMENT.sub(" ", body).split(";"):
        match = _DECLARATION.fullmatch(part)
        if match:
            name, value, important = match[1].lower(), match[2].lower(), bool(match[3])
            if important or not found.get(name, (False, False))[0]:
                found[name] = (important, value == "none" if name == "display" else value in ("hidden", "collapse"))
    return found


def hiding_rules(root: Node) -> Rules:
    """What the page's own simple rules show and hide."""
    sheets, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.tag == "style" and on_screen(f"@media {node.attributes.get('media', '')}"):
            sheets.append("".join(c for c in node.children if isinstance(c, str)))
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
    rules: Rules = {}
    order = 0
    for sheet in sheets:
        blocks: list[tuple[str, bool]] = []  # prelude of each open block, and whether it is on screen
        body: list[str] = []
        for text, mark in _CSS.findall(_COMMENT.sub(" ", sheet.replace("<!--", " ").replace("-->", " "))):
            if mark == "{":
                prelude = text.strip()
                shown = not blocks or blocks[-1][1]
                # a rule within a rule has a selector that is not simple
                nested = bool(blocks) and not blocks[-1][0].startswith("@")
                blocks.append((prelude, shown and not nested and (not prelude.startswith("@") or on_screen(prelude))))
                body = []
                continue
            body.append(text)
            if mark != "}" or not blocks:
                continue
            prelude, shown = blocks.pop()
            if shown and not prelude.startswith("@"):
                order += 1
                _add(rules, prelude, declared(";".join(body)), order)
            body = []
    return rules


def _add(rules: Rules, selectors: str, found: dict[str, tuple[bool, bool]], order: int) -> None:
    for selector in selectors.split(",") if found else ():
        match = _SELECTOR.fullmatch(selector.strip())
        if not match or not match.group():
            continue
        tag, of_class, of_id = match.groups()
        if tag and (of_class or of_id):
            continue
        key = ("tag", tag.lower()) if tag else ("class", of_class) if of_class else ("id", of_id)
        own = rules.setdefault(key, {})
        for name, (important, hides) in found.items():
            weight = (important, 0 if tag else 1 if of_class else 2, order)
            if name not in own or own[name][0] < weight:
                own[name] = (weight, hides)


def concealment(node: Node, rules: Rules) -> tuple[bool, bool | None]:
    """Whether a node has no box at all, and whether what it holds is invisible (None: as around it)."""
    own = node.attributes
    if node.tag in UNSEEN or node.hidden or node.tag == "dialog" and "open" not in own:
        return True, None
    if node.tag == "input" and own.get("type", "").lower() not in BUTTONS:
        return True, None
    if not own and not rules:
        return False, None
    best = {"display": ((False, -1, 0), "hidden" in own)}
    keys = [("tag", node.tag), ("id", own.get("id", "")), *(("class", name) for name in own.get("class", "").split())]
    for found in [rules[key] for key in keys if key in rules] if rules else ():
        for name, value in found.items():
            best[name] = max(best.get(name, value), value)
    if "style" in own:
        for name, (important, hides) in declared(own["style"]).items():
            value = ((important, 3, 0), hides)
            best[name] = max(best.get(name, value), value)
    return best["display"][1], best["visibility"][1] if "visibility" in best else None


class _Flow:
    """Lines of a block of text as it is filled."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] | None = None
        self.space = False
        self.gap = 0
        self.depth: list[str] = []  # indents of the open lists and quotes
        self.marker = ""

    def begin(self) -> list[str]:
        if self.line is None:
            if self.lines and self.gap > 1:
                self.lines.append("")
            self.gap = 0
            indent = "".join(self.depth)
            if self.marker:
                indent = indent[:max(len(indent) - len(self.marker), 0)] + self.marker
                self.marker = ""
            self.line = [indent]
        return self.line

    def words(self, text: str) -> None:
        text = _SPACE.sub(" ", text)
        if text.startswith(" "):
            self.space, text = True, text[1:]
        if not text:
            return
        fresh = self.line is None
        line = self.begin()
        if self.space and not fresh:
            line.append(" ")
        self.space = text.endswith(" ")
        line.append(text.rstrip(" "))

    def kept(self, text: str) -> None:
        """Text with its white space."""
        for i, part in enumerate(text.split("\n")):
            if i:
                if self.line is None:
                    self.begin()
                self.end(1)
            if part:
                self.begin().append(part.expandtabs(8))

    def end(self, gap: int) -> None:
        if self.line is not None:
            self.lines.append("".join(self.line).rstrip(" "))
            self.line = None
        self.space = False
        self.gap = max(self.gap, gap)

    def line_break(self) -> None:
        if self.line is None:
            self.begin()
        self.end(1)

    def block(self, lines: list[str]) -> None:
        for text in lines:
            self.begin().append(text)
            self.end(1)


def render(root: Node) -> str:
    """The tree as text."""
    rules = hiding_rules(root)
    flow = _Flow()
    flows: list[_Flow] = []
    tables: list[list[list[list[str]]]] = []  # rows of cells of the open tables
    counters: list[int | None] = []  # of the open lists
    kept = 0
    stack: list[tuple[Node | str, bool, bool]] = [(root, False, False)]
    while stack:
        node, leaving, invisible = stack.pop()
        if isinstance(node, str):
            if not invisible:
                (flow.kept if kept else flow.words)(node)
            continue
        tag = node.tag
        if not leaving:
            gone, own = concealment(node, rules)
            if gone:
                continue
            invisible = invisible if own is None else own
            if tag == "br":
                if not invisible:
                    flow.line_break()
                continue
            if node.block:
                flow.end(2 if tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and counters) else 1)
            stack.append((node, True, invisible))
            children = [node.attributes.get("value", "")] if tag == "input" else node.children
            if tag == "details" and "open" not in node.attributes:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
            if tag == "pre" and children and isinstance(children[0], str):
                children = [children[0].removeprefix("\n"), *children[1:]]
            if tag in ("ul", "ol", "menu", "dir"):
                start = node.attributes.get("start", "1")
                counters.append(int(start) if tag == "ol" and re.fullmatch(r"-?\d{1,9}", start) else 1 if tag == "ol" else None)
            elif tag == "li":
                number = counters[-1] if counters else None
                flow.marker = "- " if number is None else f"{number}. "
                if number is not None:
                    counters[-1] = number + 1
                flow.depth.append(" " * len(flow.marker))
            elif tag in ("blockquote", "dd"):
                flow.depth.append(INDENT)
            elif tag == "pre":
                kept += 1
            elif tag == "table":
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in CELLS and tables:
                flows.append(flow)
                flow = _Flow()
            stack.extend((child, False, invisible) for child in reversed(children))
            continue
        if tag in ("ul", "ol", "menu", "dir"):
            counters.pop()
        elif tag == "li":
            flow.end(1)
            flow.depth.pop()
            flow.marker = ""
        elif tag in ("blockquote", "dd"):
            flow.end(1)
            flow.depth.pop()
        elif tag == "pre":
            kept -= 1
        elif tag in CELLS and tables:
            flow.end(1)
            if not tables[-1]:
                tables[-1].append([])
            tables[-1][-1].append(flow.lines)
            flow = flows.pop()
        elif tag == "table":
            flow.end(1)
            flow.block(aligned(tables.pop()))
        if node.block:
            flow.end(2 if tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and counters) else 1)
    flow.end(0)
    return "\n".join(flow.lines).replace("\xa0", " ").strip("\n")


def aligned(rows: list[list[list[str]]]) -> list[str]:
    """Lines of a table whose cells are lists of lines."""
    widths: list[int] = []
    for row in rows:
        for place, cell in enumerate(row):
            if place == len(widths):
                widths.append(0)
            widest = max(map(len, cell), default=0)
            if widest <= WIDEST:
                widths[place] = max(widths[place], widest)
    out = []
    for row in rows:
        for i in range(max(map(len, row), default=0)):
            parts = [(cell[i] if i < len(cell) else "").ljust(width) for cell, width in zip(row, widths, strict=False)]
            out.append("  ".join(parts).rstrip(" "))
    return [line for line in out if line]


def visible_text(page: str | None) -> str:
    return render(parse(page)) if page else ""


def extract(page: Column) -> Column:
    """The visible text of a whole page."""

    @F.pandas_udf("string")
    def texts(pages: pd.Series) -> pd.Series:
        return pd.Series([visible_text(page) for page in pages], dtype=object)

    return texts(page)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url and text of every page."""
    return pages.select(id_col, url_col, extract(F.col(html_col)).alias("text"))
