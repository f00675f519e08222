"""Layout-aware text of HTML pages: a tree builder with implied tags, visibility rules and a block renderer.

Shown are also the text elements of inline SVG, a line each, and the values of inputs that are buttons. ``hidden`` and ``style``
attributes hide, and so do the ``display`` and ``visibility`` rules of the page's own style elements whose selectors are
made of tags, classes, ids, descendants and children. Left out are rules with other selectors or under media
conditions, linked style sheets, generated content, the values of other inputs, and the names that a browser gives
to buttons without a value.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.words import widened

# fixed values of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Never shown. Frames and media hold fallback content only.
UNSHOWN = frozenset("area audio base canvas col colgroup datalist embed head iframe link meta noembed noframes noscript object param script source style template title track video".split())
#: Parts of inline SVG that are not drawn where they stand.
UNDRAWN = frozenset("clippath defs desc marker mask metadata pattern symbol title".split())
#: Inputs that show their value.
BUTTONS = frozenset("button reset submit".split())
#: Blocks with an empty line around them, and blocks that only begin and end a line.
SPACED = frozenset("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul".split())
BLOCKS = SPACED | frozenset(
    "address article aside body caption center dd details dialog dir div dt figcaption footer form header hgroup html legend li main nav option optgroup search section summary tbody td tfoot th thead tr".split()
)
#: An opening tag ends the open elements of its list, looked for up to the elements of the second list.
ENDS = {
    "li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th caption colgroup", "table"), "td": ("td th", "tr table"),
    "th": ("td th", "tr table"), "tbody": ("tbody thead tfoot tr td th caption colgroup", "table"), "thead": ("tbody thead tfoot tr td th caption colgroup", "table"),
    "tfoot": ("tbody thead tfoot tr td th caption colgroup", "table"), "option": ("option", "select datalist"), "optgroup": ("option optgroup", "select"), "rt": ("rt rp", "ruby"), "rp": ("rt rp", "ruby"),
    "caption": ("caption colgroup", "table"), "colgroup": ("caption colgroup", "table"),
}
ENDS = {tag: (frozenset(a.split()), frozenset(b.split())) for tag, (a, b) in ENDS.items()}
#: Elements that a stray end tag inside them does not reach beyond.
SCOPES = frozenset("table td th caption".split())
#: Nesting beyond this is laid flat, as browsers do; no text is lost.
DEPTH = 256
SPACES = re.compile(r"[ \t\n\f\r]+")
_HIDING = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(\w+)", re.I)


class Node:
    __slots__ = ("attributes", "children", "tag")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


class TreeBuilder(HTMLParser):
    """Builds the tree that the tags imply, missing end tags included."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]

    def _pop_to(self, at: int) -> None:
        del self.open[at:]

    def _end_implied(self, tag: str) -> None:
        if tag in BLOCKS and tag not in ("tbody", "thead", "tfoot", "tr", "td", "th", "caption", "option", "optgroup"):
            for at in range(len(self.open) - 1, 0, -1):
                if self.open[at].tag == "p":
                    self._pop_to(at)
                    break
                if self.open[at].tag in SCOPES or self.open[at].tag == "button":
                    break
        if tag in ENDS:
            ended, stops = ENDS[tag]
            first = None
            for at in range(len(self.open) - 1, 0, -1):
                if self.open[at].tag in stops:
                    break
                if self.open[at].tag in ended:
                    first = at
                    if tag in ("li", "dt", "dd"):
                        break
            if first:
                self._pop_to(first)

    def handle_starttag(self, tag, attrs):
        attributes = {k: v or "" for k, v in reversed(attrs)}
        if tag in ("html", "body"):
            for node in self.open[:2]:
                if node.tag == tag:
                    node.attributes = attributes | node.attributes
                    return
        if tag in ("body", "frameset") and self.open[-1].tag == "head":
            self.open.pop()
        self._end_implied(tag)
        parent = self.open[-1]
        if tag in ("td", "th") and parent.tag in ("table", "tbody", "thead", "tfoot"):
            self.handle_starttag("tr", [])
            parent = self.open[-1]
        node = Node(tag, attributes)
        parent.children.append(node)
        if tag not in VOID and len(self.open) < DEPTH:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # the slash means nothing but on void elements

    def handle_endtag(self, tag):
        if tag == "br":
            self.handle_starttag("br", [])
            return
        stops = frozenset() if tag in ("table", "body", "html") else SCOPES - {tag}
        if tag in ("tr", "tbody", "thead", "tfoot"):
            stops = frozenset(["table"])
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                if tag not in ("body", "html"):  # what follows them still belongs to the body
                    self._pop_to(at)
                return
            if self.open[at].tag in stops:
                return

    def handle_data(self, data):
        if self.open[-1].tag == "head" and data.strip():
            self.open.pop()
        self.open[-1].children.append(data)


def parse(html: str) -> Node:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return builder.root


# style sheets

_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_DECLARED = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([\w-]+)\s*(!\s*important)?", re.I)
_COMPOUND = re.compile(r"(\*|[a-z][\w-]*)?((?:[.#][\w-]+)*)", re.I)


def _declared(text: str) -> list[tuple[str, str, bool]]:
    return [(m[1].lower(), m[2].lower(), bool(m[3])) for m in _DECLARED.finditer(text)]


def _selector(text: str) -> list[tuple[str, str, frozenset[str], frozenset[str]]] | None:
    """Compounds (combinator to the one before, tag, ids, classes) from left to right; None for other selectors."""
    out, combinator = [], ""
    for part in re.sub(r"\s*>\s*", " > ", text.strip()).split():
        if part == ">":
            combinator = ">"
            continue
        found = _COMPOUND.fullmatch(part)
        if not found or not part:
            return None
        names = re.findall(r"([.#])([\w-]+)", found[2])
        tag = (found[1] or "*").lower()
        out.append((combinator or " ", tag, frozenset(n for k, n in names if k == "#"), frozenset(n for k, n in names if k == ".")))
        combinator = ""
    return out if out and not combinator else None


class StyleSheet:
    """Rules on display and visibility, by what their last compound needs."""

    def __init__(self):
        self.by_name: dict[str, list] = {}
        self.rules = 0

    def read(self, text: str) -> None:
        text, at = _COMMENT.sub(" ", text), 0
        while True:
            begin = text.find("{", at)
            if begin < 0:
                return
            head, depth, stop = text[at:begin].rpartition(";")[2].strip(), 1, begin + 1
            while stop < len(text) and depth:
                depth += {"{": 1, "}": -1}.get(text[stop], 0)
                stop += 1
            body = text[begin + 1 : stop - 1 if not depth else stop]
            if head.startswith("@"):
                if re.fullmatch(r"@media\s+(?:only\s+)?(?:all|screen)", head, re.I):
                    self.read(body)
            else:
                self._add(head, _declared(body))
            at = stop

    def _add(self, head: str, declared: list[tuple[str, str, bool]]) -> None:
        for text in head.split(",") if declared else ():
            compounds = _selector(text)
            if compounds is None:
                continue
            weight = sum(len(c[2]) for c in compounds), sum(len(c[3]) for c in compounds), sum(c[1] != "*" for c in compounds)
            _, tag, ids, classes = compounds[-1]
            name = f"#{min(ids)}" if ids else f".{min(classes)}" if classes else tag
            self.rules += 1
            self.by_name.setdefault(name, []).append((weight, self.rules, compounds, declared))

    def apply(self, root: Node) -> None:
        """Write what wins for each element into its style attribute."""
        waiting = [(root, ())]
        while waiting:
            node, above = waiting.pop()
            own = (*above, node)
            waiting += [(c, own) for c in node.children if isinstance(c, Node)]
            classes, ident = node.attributes.get("class", "").split(), node.attributes.get("id", "")
            winners: dict[str, tuple] = {}
            for name in ("*", node.tag, *{f".{c}" for c in classes}, f"#{ident}"):
                for weight, order, compounds, declared in self.by_name.get(name, ()):
                    if _matches(compounds, own):
                        for what, value, important in declared:
                            winners[what] = max(winners.get(what, ((),)), ((important, False, weight, order), value))
            if winners:
                for what, value, important in _declared(node.attributes.get("style", "")):
                    winners[what] = max(winners.get(what, ((),)), ((important, True, (), 0), value))
                node.attributes["style"] = ";".join(f"{what}:{value}" for what, (_, value) in winners.items())


def _meets(compound: tuple, node: Node) -> bool:
    _, tag, ids, classes = compound
    if tag not in ("*", node.tag) or not ids <= {node.attributes.get("id", "")}:
        return False
    return not classes or classes <= set(node.attributes.get("class", "").split())


def _matches(compounds: list, path: tuple) -> bool:
    """Whether the last element of a path matches a selector."""
    if not _meets(compounds[-1], path[-1]):
        return False
    if len(compounds) == 1:
        return True
    rest = path[:-1]
    if compounds[-1][0] == ">":
        return bool(rest) and _matches(compounds[:-1], rest)
    return any(_matches(compounds[:-1], rest[: i + 1]) for i in range(len(rest)))


def _style_texts(root: Node) -> list[str]:
    found, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        if node.tag == "style" and re.fullmatch(r"|all|screen", node.attributes.get("media", "").strip().lower()):
            found.append("".join(c for c in node.children if isinstance(c, str)))
        waiting += [c for c in reversed(node.children) if isinstance(c, Node)]
    return found


class _Page:
    """Lines of one block context."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.gap = False

    def text(self, data: str, kept: bool) -> None:
        if kept:
            first, *rest = data.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            self._put(first)
            for more in rest:
                self.end_line(True)
                self._put(more)
            return
        words = SPACES.sub(" ", data)
        if words.startswith(" "):
            self.space, words = bool(self.line), words[1:]
        if words:
            if self.space:
                self.line.append(" ")
            self.space = words.endswith(" ")
            self._put(words.rstrip(" "))

    def _put(self, data: str) -> None:
        if data:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            self.line.append(data)

    def end_line(self, forced: bool = False) -> None:
        if self.line or forced:
            self.lines.append("".join(self.line).rstrip(" "))
        self.line, self.space = [], False

    def add(self, lines: list[str], spaced: bool) -> None:
        """A block's lines."""
        self.end_line()
        if lines:
            if (spaced or self.gap) and self.lines:
                self.lines.append("")
            self.lines += lines
            self.gap = spaced

    def block(self, spaced: bool) -> None:
        self.end_line()
        self.gap = self.gap or spaced


def _shown(node: Node, visible: bool) -> tuple[bool, bool]:
    """Whether the element is laid out, and whether its text is visible."""
    style = node.attributes.get("style", "")
    if node.tag in UNSHOWN or "hidden" in node.attributes or _HIDING.search(style):
        return False, False
    if node.tag == "dialog" and "open" not in node.attributes:
        return False, False
    if node.tag == "input" and node.attributes.get("type", "").lower() == "hidden":
        return False, False
    found = _VISIBILITY.search(style)
    if found:
        visible = found[1].lower() not in ("hidden", "collapse") if found[1].lower() != "inherit" else visible
    return True, visible


def _number(text: str | None, otherwise: int, least: int, most: int) -> int:
    found = re.match(r"\s*([+-]?\d{1,9})", text or "")
    return min(most, max(least, int(found[1]))) if found else otherwise


def _label(kind: str, n: int) -> str:
    if kind in "aA" and n > 0:
        out = ""
        while n:
            n, rest = divmod(n - 1, 26)
            out = chr(ord(kind) + rest) + out
        return out
    return str(n)


def _render(node: Node, page: _Page, visible: bool, kept: bool) -> None:
    closed = node.tag == "details" and "open" not in node.attributes
    for child in node.children:
        if isinstance(child, str):
            if visible and not closed:
                page.text(child, kept)
            continue
        shown, seen = _shown(child, visible)
        if not shown or closed and child.tag != "summary":
            continue
        tag = child.tag
        if tag == "br":
            page.end_line(True)
        elif tag == "hr":
            page.block(True)
        elif tag in ("ul", "ol", "menu", "dir"):
            page.add(_list(child, seen, kept), spaced=node.tag != "li")
        elif tag == "table":
            page.add(_table(child, seen, kept), True)
        elif tag in ("blockquote", "dd"):
            page.add(["  " + x if x else x for x in _lines(child, seen, kept)], tag == "blockquote")
        elif tag == "pre" or tag == "textarea":
            page.add(_lines(child, seen, True), tag == "pre")
        elif tag == "svg":
            page.add(_drawn(child, seen), False)
        elif tag == "input":
            if seen and child.attributes.get("type", "").lower().strip() in BUTTONS:
                page.text(child.attributes.get("value", ""), kept)
        elif tag == "q":
            inner = _Page()
            _render(child, inner, seen, kept)
            inner.end_line()
            page.text("“" + " ".join(inner.lines) + "”", kept)
        elif tag in BLOCKS:
            page.block(tag in SPACED)
            _render(child, page, seen, kept)
            page.block(tag in SPACED)
        else:
            _render(child, page, seen, kept)


def _drawn(node: Node, visible: bool) -> list[str]:
    """The text elements of an SVG, a line each; embedded HTML is rendered as such."""
    out: list[str] = []
    for child in node.children:
        if isinstance(child, str) or child.tag in UNDRAWN:
            continue
        shown, seen = _shown(child, visible)
        if not shown or child.attributes.get("display", "").strip() == "none":
            continue
        if child.tag == "text":
            seen = seen and child.attributes.get("visibility", "") not in ("hidden", "collapse")
            line = " ".join(_lines(child, seen, False))
            out += [line] if line else []
        elif child.tag == "foreignobject":
            out += _lines(child, seen, False)
        else:
            out += _drawn(child, seen)
    return out


def _lines(node: Node, visible: bool, kept: bool) -> list[str]:
    page = _Page()
    if kept and node.children and isinstance(node.children[0], str):  # a line end right behind the tag is none
        node.children[0] = re.sub(r"\A\r?\n", "", node.children[0])
    _render(node, page, visible, kept)
    page.end_line()
    while page.lines and not page.lines[-1]:
        page.lines.pop()
    while page.lines and not page.lines[0]:
        page.lines.pop(0)
    return page.lines


def _list(node: Node, visible: bool, kept: bool) -> list[str]:
    """Items with bullets or numbers, their further lines set in; other content stands between the items."""
    items = [c for c in node.children if isinstance(c, Node) and c.tag == "li" and _shown(c, visible)[0]]
    step = -1 if "reversed" in node.attributes else 1
    number = _number(node.attributes.get("start"), len(items) if step < 0 else 1, -(10**9), 10**9)
    out: list[str] = []
    for child in node.children:
        if isinstance(child, str):
            if visible and child.strip(" \t\n\f\r"):
                out.append(SPACES.sub(" ", child).strip(" "))
            continue
        if child.tag != "li":
            holder = Node("div", {})
            holder.children = [child]
            out += _lines(holder, visible, kept)
            continue
        shown, seen = _shown(child, visible)
        if not shown:
            continue
        mark = "- "
        if node.tag == "ol":
            number = _number(child.attributes.get("value"), number, -(10**9), 10**9)
            mark = _label(node.attributes.get("type", "1") or "1", number) + ". "
            number += step
        lines = _lines(child, seen, kept)
        if lines:
            out.append(mark + lines[0])
            out += [" " * len(mark) + x if x else x for x in lines[1:]]
    return out


def _rows(node: Node, visible: bool) -> Iterator[tuple[Node, bool]]:
    for child in node.children:
        if isinstance(child, Node):
            shown, seen = _shown(child, visible)
            if shown and child.tag == "tr":
                yield child, seen
            elif shown and child.tag in ("tbody", "thead", "tfoot"):
                yield from _rows(child, seen)


def _outside(node: Node) -> Iterator:
    """Captions, and content that stands in a table but in none of its cells, in order."""
    for child in node.children:
        if isinstance(child, str) or child.tag not in ("tbody", "thead", "tfoot", "tr", "td", "th"):
            yield child
        elif child.tag not in ("td", "th"):
            yield from _outside(child)


def _table(node: Node, visible: bool, kept: bool) -> list[str]:
    """Stray content and the caption, then the rows with cells as wide as their column."""
    holder = Node("div", {})
    holder.children = list(_outside(node))
    out = _lines(holder, visible, kept)
    cells: list[tuple[int, int, int, list[str], str]] = []
    taken: dict[int, int] = {}
    row_count = 0
    for at, (row, seen_row) in enumerate(_rows(node, visible)):
        row_count = at + 1
        column = 0
        for child in row.children:
            if not isinstance(child, Node) or child.tag not in ("td", "th"):
                continue
            shown, seen = _shown(child, seen_row)
            if not shown:
                continue
            while taken.get(column, 0) > at:
                column += 1
            wide = _number(child.attributes.get("colspan"), 1, 1, 1000)
            high = _number(child.attributes.get("rowspan"), 1, 1, 65534)
            for c in range(column, column + wide):
                taken[c] = at + high
            cells.append((at, column, wide, _lines(child, seen, kept), child.attributes.get("align", "").lower()))
            column += wide
    widths: dict[int, int] = {}
    for _, column, wide, lines, _ in sorted(cells, key=lambda x: x[2]):
        need = max(map(len, lines), default=0)
        have = sum(widths.get(c, 0) for c in range(column, column + wide)) + 2 * (wide - 1)
        last = column + wide - 1
        if need > have or wide == 1:
            widths[last] = widths.get(last, 0) + max(0, need - have)
    starts, at = {}, 0
    for c in range(max(taken, default=-1) + 1):
        starts[c] = at
        at += widths.get(c, 0) + 2 * bool(widths.get(c, 0))
    by_row: dict[int, list] = {}
    for cell in cells:
        by_row.setdefault(cell[0], []).append(cell)
    for at in range(row_count):
        row = by_row.get(at, [])
        for i in range(max((len(x[3]) for x in row), default=0)):
            line = ""
            for _, column, wide, lines, align in row:
                if i < len(lines):
                    room = sum(widths.get(c, 0) + 2 * bool(widths.get(c, 0)) for c in range(column, column + wide)) - 2
                    piece = lines[i].rjust(room) if align == "right" else lines[i].center(room) if align == "center" else lines[i]
                    line = line.ljust(starts[column]) + piece
            out.append(line.rstrip(" "))
    while out and not out[-1]:
        out.pop()
    return out


def page_text(html: str | None) -> str:
    """All visible text of a page; empty for a missing or empty one."""
    root = parse(html or "")
    if html and re.search(r"<style", html, re.I):
        texts = [x for x in _style_texts(root) if re.search(r"display|visibility", x, re.I)]
        if texts:
            sheet = StyleSheet()
            for text in texts:
                sheet.read(text)
            sheet.apply(root)
    shown, visible = _shown(root, True)
    return "\n".join(_lines(root, visible, False)) if shown else ""


def extract_text(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text`` added for every row (replaced if there); null and empty pages give the empty text."""
    kept = pages.drop("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([page_text(x) for x in batch.column("html").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, "text"])

    return widened(kept, run, "text string")
