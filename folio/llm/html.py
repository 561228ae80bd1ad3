"""HTML extraction: a tree with implied tags, then layout-aware rendering of all visible text."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import fresh, slices, table, tidied

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
HIDDEN = frozenset("head script style template noscript iframe noembed noframes object audio video canvas datalist area base link meta param source track col colgroup title".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul caption xmp".split())
#: Blocks that an empty line sets apart.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir blockquote pre table figure fieldset article section hr xmp".split())
LISTS = frozenset(("ul", "ol", "menu", "dir"))
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul xmp li dd dt".split())
#: A start tag ends open elements of these names, up to the nearest of the stops.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist", "optgroup")),
    "optgroup": (("option", "optgroup"), ("select",)),
    "tr": (("td", "th", "tr", "caption", "colgroup"), ("table", "tbody", "thead", "tfoot")),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
    "thead": (("td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
    "tfoot": (("td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
}
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: An end tag doesn't reach beyond these; one of a part of a table only stops at the second.
SCOPE = frozenset(("table", "td", "th", "caption", "html", "template"))
TABLE_SCOPE = frozenset(("table", "html", "template"))
TABLE_PARTS = frozenset(("table", "tbody", "thead", "tfoot", "tr"))
#: What shows nothing inside of svg and math.
UNDRAWN = frozenset("title desc defs symbol clippath mask pattern marker metadata annotation annotation-xml".split())
#: Tables nested deeper are laid out as blocks, all their text included; most columns and rows that a cell may take (fixed values).
TABLE_DEPTH, MOST_COLUMNS, MOST_ROWS = 20, 1000, 65534
#: Lists and quotes nested deeper are not indented further.
INDENTED = 20
#: A table is not padded to columns where that would take over so many characters and so many times those of its cells.
PADDED, PADDED_TIMES = 100_000, 8
_open = re.compile(r"<(?:(!--)|([!?])|/([a-zA-Z][^\s/>]*)|([a-zA-Z][^\s/>]*))")
_between = re.compile(r"[\s/]*")
_name = re.compile(r"[^\s/>][^\s/>=]*")
_equals = re.compile(r"\s*=\s*")
_bare = re.compile(r"[^\s>]*")
_no_box = re.compile(r"display\s*:\s*none", re.I)
_visibility = re.compile(r"(?<![\w-])visibility\s*:\s*(\w+)", re.I)
_spaces = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []


def attributes(html: str, at: int) -> tuple[dict[str, str], int]:
    """The attributes of a tag from behind its name on, and where the tag ends; the end of the text if it never does, as in an
    unclosed quote. The first of equal names counts. Every character is looked at once."""
    out: dict[str, str] = {}
    n = len(html)
    while True:
        at = _between.match(html, at).end()
        if at >= n:
            return out, n
        if html[at] == ">":
            return out, at + 1
        m = _name.match(html, at)
        name, at, value = m[0].lower(), m.end(), ""
        if m := _equals.match(html, at):
            at = m.end()
            if html[at : at + 1] in ('"', "'"):
                end = html.find(html[at], at + 1)
                if end < 0:
                    return out, n
                value, at = html[at + 1 : end], end + 1
            else:
                m = _bare.match(html, at)
                value, at = m[0], m.end()
        out.setdefault(name, unescape(value) if "&" in value else value)


class _Stack:
    """Open elements, with counts of their names: in all, and since the last element of SCOPE and of TABLE_SCOPE, so that a
    search for one that isn't open costs nothing."""

    def __init__(self, root: Node):
        self.nodes, self.counts, self.scopes, self.tables = [root], Counter(), [Counter()], [Counter()]

    def push(self, node: Node) -> None:
        self.nodes.append(node)
        self.counts[node.tag] += 1
        self.scopes[-1][node.tag] += 1
        self.tables[-1][node.tag] += 1
        if node.tag in SCOPE:
            self.scopes.append(Counter())
        if node.tag in TABLE_SCOPE:
            self.tables.append(Counter())

    def pop(self) -> None:
        tag = self.nodes.pop().tag
        if tag in SCOPE:
            self.scopes.pop()
        if tag in TABLE_SCOPE:
            self.tables.pop()
        self.counts[tag] -= 1
        self.scopes[-1][tag] -= 1
        self.tables[-1][tag] -= 1

    def close(self, names, stops) -> None:
        """Ends open elements of these names, up to the nearest of the stops; several levels may end at once."""
        counts = self.scopes[-1] if stops is SCOPE else self.counts
        while any(counts[x] for x in names):
            for i in range(len(self.nodes) - 1, 0, -1):
                if self.nodes[i].tag in names:
                    break
                if self.nodes[i].tag in stops:
                    return
            else:
                return
            while len(self.nodes) > i:
                self.pop()
            counts = self.scopes[-1] if stops is SCOPE else self.counts

    def end(self, name: str) -> None:
        names = HEADINGS if name in HEADINGS else (name,)
        stops = TABLE_SCOPE if name in TABLE_PARTS else SCOPE
        counts = self.tables if name in TABLE_PARTS else self.scopes
        # an element of SCOPE is counted in the frame that it lies in, and begins one
        if not any(counts[-1][x] for x in names) and not (name in stops and len(counts) > 1):
            return
        for i in range(len(self.nodes) - 1, 0, -1):
            tag = self.nodes[i].tag
            if tag in names:
                while len(self.nodes) > i:
                    self.pop()
                return
            if tag in stops:
                return


def parse(html: str) -> Node:
    """A tree of Nodes and strings, in time linear in the text. Never fails: unknown, unclosed and stray tags are taken as
    browsers do, roughly; a tag that the text ends in is none, and what it holds isn't shown."""
    root = Node("#root")
    stack, at, n = _Stack(root), 0, len(html)
    nodes = stack.nodes

    def text(s: str) -> None:
        if s:
            nodes[-1].children.append(unescape(s) if "&" in s else s)

    def add(name: str, attrs: dict[str, str] | None = None) -> Node:
        nodes[-1].children.append(node := Node(name, attrs))
        return node

    while at < n:
        m = _open.search(html, at)
        if m is None:
            text(html[at:])
            break
        text(html[at : m.start()])
        if m[1] or m[2]:
            end = html.find("-->", m.end()) if m[1] else html.find(">", m.end())
            at = n if end < 0 else end + (3 if m[1] else 1)
        elif m[3]:
            name = m[3].lower()
            end = html.find(">", m.end())
            at = n if end < 0 else end + 1
            if name == "p" and not stack.scopes[-1]["p"]:
                add("p")
            elif name == "br":
                add("br")
            else:
                stack.end(name)
        else:
            name = m[4].lower()
            begin = m.end()
            attrs, at = ({}, begin + 1) if html[begin : begin + 1] == ">" else attributes(html, begin)
            if at >= n and html[-1] != ">":
                break
            if name == "body" or name == "html":
                if name == "body":
                    stack.close(("head",), ())
                if stack.counts[name]:
                    continue
            if name in CLOSES_P:
                stack.close(("p",), SCOPE)
            if name in IMPLIED:
                stack.close(*IMPLIED[name])
            if name in HEADINGS and nodes[-1].tag in HEADINGS:
                stack.pop()
            if name == "a":
                stack.close(("a",), SCOPE)
            if nodes[-1].tag == "head" and name not in HIDDEN:
                stack.pop()
            if name == "tr" and nodes[-1].tag == "table":
                stack.push(add("tbody"))
            if name in ("td", "th") and nodes[-1].tag in ("table", "tbody", "thead", "tfoot"):
                if nodes[-1].tag == "table":
                    stack.push(add("tbody"))
                stack.push(add("tr"))
            node = add(name, attrs)
            if name in RAW:
                end = _raw_end(name).search(html, at)
                body = html[at : end.start()] if end else html[at:]
                if name in ("textarea", "title"):
                    body = unescape(body)
                if body:
                    node.children.append(body)
                at = html.find(">", end.end()) + 1 or n if end else n
            elif name not in VOID and not (html[at - 2] == "/" and (stack.counts["svg"] or stack.counts["math"])):
                stack.push(node)
    return root


@lru_cache(32)
def _raw_end(name: str) -> re.Pattern:
    return re.compile(f"</{name}(?=[\\s/>])", re.I)


def boxed(node: Node) -> bool:
    """Has a place on the page: not a hidden tag or attribute, not display: none. Only a closed <details>'s summary shows;
    render() sees to that."""
    a = node.attrs
    if node.tag in HIDDEN or "hidden" in a and a["hidden"].lower() != "until-found":
        return False
    if node.tag == "input" and a.get("type", "").lower() == "hidden" or node.tag == "dialog" and "open" not in a:
        return False
    return not ("style" in a and _no_box.search(a["style"]))


def unseen(node: Node, before: bool) -> bool:
    """Whether the node's text is invisible though it has a place: visibility is inherited, and an inner one overrides it."""
    m = _visibility.findall(node.attrs["style"]) if "style" in node.attrs else None
    return m[-1].lower() in ("hidden", "collapse") if m else before


class _Out:
    """Lines of text; white space collapses across inline elements, block() breaks lines, gap() leaves one empty."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.blank = False  # an empty line is due before the next text
        self.space = False  # a space is due before the next text of this line
        self.prefix: list[str] = []  # of each open list item and quote the whole indentation
        self.marker = ""

    def text(self, s: str, pre: bool) -> None:
        if pre:
            parts = s.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            for k, part in enumerate(parts):
                if k:
                    self.block(True)
                if part:
                    self._put(part)
            return
        s = _spaces.sub(" ", s)
        core = s.strip(" ")
        if s[:1] == " ":
            self.space = bool(self.line)
        if core:
            self._put(core)
            self.space = s[-1] == " "

    def _put(self, s: str) -> None:
        if not self.line:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = self.space = False
            prefix = self.prefix[-1] if self.prefix else ""
            self.line.append(prefix[: max(0, len(prefix) - len(self.marker))] + self.marker)
            self.marker = ""
        elif self.space:
            self.line.append(" ")
        self.space = False
        self.line.append(s)

    def indent(self, by: int) -> None:
        last = self.prefix[-1] if self.prefix else ""
        self.prefix.append(last + " " * by if len(self.prefix) < INDENTED else last)

    def block(self, keep: bool = False) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip(" "))
        elif keep and self.lines:
            self.lines.append("")
        self.line, self.space = [], False

    def gap(self) -> None:
        self.block()
        self.blank = True

    def done(self) -> str:
        self.block()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return "\n".join(self.lines)


def render(node: Node, depth: int = 0, state: tuple[bool, bool, str] = (False, False, "")) -> str:
    """The visible text of a tree. Blocks stand on lines of their own, spaced ones with an empty line around; list items
    are marked with "- " or their number and indented by level, up to INDENTED levels; table cells are padded to columns, joined by two spaces.
    Of svg the texts show, of math all but annotations. state: white space is kept, text is invisible, within svg or math."""
    out = _Out()
    # (what, node, state, more): an explicit stack, so that depth is not bounded by recursion
    todo: list[tuple] = [("in", node, state, None)]
    while todo:
        step, x, state, more = todo.pop()
        pre, dark, drawing = state
        if step == "text":
            if not dark and drawing != "svg":
                out.text(x, pre)
        elif step == "out":
            if more is not None:
                del out.prefix[more:]
                out.marker = ""
            if x in SPACED and not (x in LISTS and out.prefix):
                out.gap()
            else:
                out.block()
        else:
            tag = x.tag
            if not boxed(x) or drawing and tag in UNDRAWN:
                continue
            dark = unseen(x, dark)
            if tag == "br":
                out.block(True)
                continue
            if tag == "table" and depth < TABLE_DEPTH:
                out.gap()
                for line in _table(x, depth, (pre, dark, drawing)):
                    out._put(line) if line else None
                    out.block()
                out.gap()
                continue
            if tag in ("img", "input"):
                s = x.attrs.get("value", "") if tag == "input" and x.attrs.get("type", "text").lower() not in ("password", "checkbox", "radio", "image", "file") else ""
                if s and not dark:
                    out.text(s, False)
                continue
            pre = pre or tag in ("pre", "textarea", "xmp")
            label = drawing == "svg" and tag == "text"
            if tag in ("svg", "math"):
                drawing = tag
            elif label:
                drawing = "label"
            elif tag == "foreignobject":
                drawing = ""
            if tag in BLOCK or label:
                nested = tag in LISTS and bool(out.prefix)
                out.block() if nested or tag not in SPACED else out.gap()
                if tag == "hr":
                    continue
                mark = len(out.prefix) if tag in ("li", "blockquote", "dd") else None
                if tag == "li":
                    sign = f"{more}. " if more is not None else "- "
                    out.indent(len(sign))
                    out.marker = "" if dark else sign
                elif tag in ("blockquote", "dd"):
                    out.indent(2)
                todo.append(("out", tag, state, mark))
            children = x.children
            if tag == "details" and "open" not in x.attrs:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
            steps, number = [], None
            if tag == "ol":
                start = x.attrs.get("start", "1").strip()
                number = int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1
            state = (pre, dark, drawing)
            for c in children:
                if isinstance(c, str):
                    steps.append(("text", c, state, None))
                else:
                    item = None
                    if number is not None and c.tag == "li" and boxed(c):
                        v = c.attrs.get("value", "").strip()
                        item = number = int(v) if re.fullmatch(r"-?\d{1,9}", v) else number
                        number += 1
                    steps.append(("in", c, state, item))
            if pre and tag in ("pre", "textarea") and steps and steps[0][0] == "text":
                steps[0] = ("text", steps[0][1].removeprefix("\n"), state, None)
            todo.extend(reversed(steps))
    return out.done()


def _span(cell: Node, name: str, most: int) -> int:
    got = cell.attrs.get(name, "").strip()
    return min(int(got), most) if got.isascii() and got.isdecimal() and len(got) < 1000 else 1


def _table(node: Node, depth: int, state: tuple[bool, bool, str]) -> list[str]:
    """Lines of a table: caption, then rows. A cell of several lines takes as many lines; colspan takes columns, and rowspan
    keeps its columns free in the rows below, up to the end of their group. Where padding would outgrow the text (PADDED),
    cells are joined without it."""
    lines: list[str] = []
    rows: list[list[tuple[int, int, list[str]]]] = []  # (column, columns, lines) of each row's cells
    taken: list[list[int]] = []  # [first column, column behind, row behind] that cells of rows above take, ascending
    no, group = 0, 0  # the row's number, and that behind its group's last row
    todo: list[tuple[Node | str, tuple]] = [(c, state) for c in reversed(node.children)]
    while todo:
        c, state = todo.pop()
        pre, dark, drawing = state
        if isinstance(c, str):
            if c.strip() and not dark:
                lines += _spaces.sub(" ", c).strip(" ").split("\n")
            continue
        if not boxed(c):
            continue
        inner = (pre, unseen(c, dark), drawing)
        if c.tag == "tr":
            row, at, k, below = [], 0, 0, []
            for cell in c.children:
                while k < len(taken) and taken[k][0] <= at:
                    at, k = max(at, taken[k][1]), k + 1
                if isinstance(cell, Node):
                    if cell.tag in ("td", "th") and boxed(cell):
                        box = Node("div")
                        box.children = cell.children
                        wide, high = max(_span(cell, "colspan", MOST_COLUMNS), 1), _span(cell, "rowspan", MOST_ROWS)
                        high = (group if high == 0 else min(no + high, group)) - no
                        row.append((at, wide, render(box, depth + 1, (pre, unseen(cell, inner[1]), drawing)).split("\n")))
                        if high > 1:
                            below.append([at, at + wide, no + high])
                        at += wide
                    elif cell.tag not in ("td", "th") and (s := render(cell, depth + 1, inner)):
                        row.append((at, 1, s.split("\n")))
                        at += 1
                elif cell.strip() and not inner[1]:
                    row.append((at, 1, [_spaces.sub(" ", cell).strip(" ")]))
                    at += 1
            no += 1
            old, taken = sorted([x for x in taken if x[2] > no] + below), []
            for x in old:
                if taken and taken[-1][1] == x[0] and taken[-1][2] == x[2]:
                    taken[-1][1] = x[1]
                else:
                    taken.append(x)
            if row:
                rows.append(row)
        elif c.tag in ("tbody", "thead", "tfoot"):
            taken, group = [], no + sum(isinstance(x, Node) and x.tag == "tr" and boxed(x) for x in c.children)
            todo.extend((x, inner) for x in reversed(c.children))
        else:
            lines += [x for x in render(c, depth + 1, inner).split("\n") if x]
    width: dict[int, int] = {}
    for row in rows:
        for at, span, cell in row:  # a column is where a cell begins; those that only wide cells cover have no place
            width[at] = max(width.get(at, 0), max(map(len, cell)) if span == 1 else 0)
    known = sorted(width)
    upto = [0]  # widths of the columns known, added up
    for k in known:
        upto.append(upto[-1] + width[k])

    def room(a: int, b: int) -> int:
        i, j = bisect_left(known, a), bisect_left(known, b)
        return upto[j] - upto[i] + 2 * (j - i - 1) if j > i else -1

    plain = sum(len(x) for row in rows for _, _, cell in row for x in cell)
    padded = sum(max(len(cell) for _, _, cell in row) * (room(0, row[-1][0]) + 1) for row in rows)
    align = padded <= max(PADDED, PADDED_TIMES * plain)
    for row in rows:
        for k in range(max(len(cell) for _, _, cell in row)):
            if not align:
                lines.append("  ".join([cell[k] for _, _, cell in row if k < len(cell) and cell[k]]))
                continue
            last, line = 0, []
            for at, span, cell in row:
                if at > last and (gap := room(last, at)) >= 0:  # columns of cells above
                    line.append(" " * gap)
                line.append((cell[k] if k < len(cell) else "").ljust(room(at, at + span)))
                last = at + span
            lines.append("  ".join(line).rstrip())
    return lines


def visible_text(html: str | None) -> str:
    return render(parse(html)) if html else ""


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages without html, plus text (all visible text) and n_chars; a map over whole pages.

    Null or empty html gives empty text. Unclosed tags and quotes never take more than linear time. Rows, repeats and other columns stay; new names that pages already has get
    underscores at their end."""
    kept = [c for c in pages.columns if c != html]
    names = fresh(pages.select(*kept), "text", "n_chars")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema if f.name != html), f"`{names[0]}` string, `{names[1]}` bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, html):
                got = [visible_text(x) for x in b.column(html).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(got, pa.string()), pa.array([len(g) for g in got], pa.int64())], names=[*kept, *names])

    return pages.mapInArrow(tidied(run), schema)


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
