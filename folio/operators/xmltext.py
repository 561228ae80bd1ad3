"""XML to passages: a walk over mixed content, in order."""

from __future__ import annotations

import hashlib
import html
import re
import unicodedata
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

import regex

from ..functions.text import CLEANUP, EMPTY_BRACKETS

#: Elements whose contents are left out (fixed values).
IGNORED = frozenset(["xref", "disp-formula", "inline-formula", "ref-list", "bio", "ack", "graphic", "media", "tex-math", "mml:math", "object-id", "ext-link"])
#: Elements that begin a passage (fixed values).
PASSAGE_TAGS = ("title", "p", "sec", "def-item", "list-item", "caption", "thead", "label")
CELLS = frozenset(["tr", "th", "td"])
_internal = re.compile(r"(supp|suppl|supplementary)?\s*(table|figure)\s*s?\d+")

_brackets = [regex.compile(p) for p, _ in EMPTY_BRACKETS]
#: Java's syntax for two classes, and this one.
_classes = {r"[\x{2028}\x{2029}]": "[\u2028\u2029]", r"[\p{C}&&[^\t]]": r"[^\P{C}\t]"}
_steps = [(regex.compile(_classes.get(p, p)), n.replace("$1", r"\1")) for p, n in CLEANUP]


#: What any step could change in a text of printable characters (no control, no separator but the space).
_odd = re.compile(r"[(\[{]|  |^ | $| [.,;]|, ?[.,]")


def cleanup(text: str) -> str:
    """The same steps as functions.text.cleanup; a text that none of them would change isn't put through them."""
    if text.isprintable() and not _odd.search(text):
        return text
    for pattern, new in _steps:
        text = pattern.sub(new, text)
    return text


def strip_empty_brackets(text: str) -> str:
    for p in _brackets:
        text = p.sub("", text)
    return text


def title_without_brackets(text: str) -> str:
    t = text.strip()
    return t[1:-2] + "." if t.startswith("[") and t.endswith("].") else t


def trim_sentences(text: str, most: int = 90_000) -> str:
    return ".".join(s[:most] for s in text.split("."))


@dataclass
class Chunk:
    text: str
    tag: str | None
    path: str = ""
    joined: bool = False  # no separator on either side
    tail: bool = False
    citation: bool = False

    def __post_init__(self):
        self.joined = self.joined or self.citation


@dataclass
class Elem:
    """A read-only view of an element, with merged citations."""

    tag: str
    attrib: dict
    text: str
    tail: str
    children: list = field(default_factory=list)


Handler = Callable[..., list[Chunk]]


def _children(node) -> list[Elem]:
    """Child elements; neighbouring xrefs of one kind with one punctuation sign between them become one."""
    out: list[Elem] = []
    for c in node.children if isinstance(node, Elem) else node:
        if not isinstance(c.tag, str):  # comments and instructions: their tail goes on
            if out and c.tail:
                out[-1] = Elem(out[-1].tag, out[-1].attrib, out[-1].text, out[-1].tail + c.tail, out[-1].children)
            continue
        e = Elem(c.tag, c.attrib, c.text or "", c.tail or "", list(c.children if isinstance(c, Elem) else c))
        if out and e.tag == out[-1].tag == "xref" and e.attrib.get("ref-type") == out[-1].attrib.get("ref-type"):
            sign = out[-1].tail.strip()
            if len(sign) == 1 and unicodedata.category(sign)[0] == "P":
                out[-1].text += sign + e.text
                out[-1].tail = e.tail
                continue
        out.append(e)
    return out


def walk(root, handlers: dict[str, Handler] | None = None, path: str = "") -> list[Chunk]:
    """The chunks of an element in document order, by an explicit stack. A handler takes (element, path=, handlers=) and
    returns chunks, or raises NotImplementedError for the default."""
    handlers = handlers or {}
    out: list[Chunk] = []
    top = root if isinstance(root, Elem) else Elem(root.tag, root.attrib, root.text or "", root.tail or "", list(root))
    todo: list[tuple[Elem, str] | Chunk] = [(top, f"{path}/{top.tag}" if path else top.tag)]
    while todo:
        item = todo.pop()
        if isinstance(item, Chunk):
            out.append(item)
            continue
        e, at = item
        if e.tag in handlers:
            try:
                out.extend(handlers[e.tag](e, path=at, handlers=handlers))
                continue
            except NotImplementedError:
                pass
        head, tail = e.text.strip(), e.tail.strip()
        if e.tag == "xref":
            if e.attrib.get("ref-type", "") == "bibr":
                out.append(Chunk(head, e.tag, at, citation=True))
                if tail:
                    out.append(Chunk(tail, e.tag, at, tail=True))
                continue
        elif e.tag in IGNORED and not (e.tag == "ext-link" and head and _internal.search(head.lower())):
            out.append(Chunk(tail, e.tag, at, joined=True, tail=True))
            continue
        out.append(Chunk(head, e.tag, at))
        todo.append(Chunk(tail, e.tag, at, tail=True))
        todo.extend((c, f"{at}/{c.tag}") for c in reversed(_children(e)))
    return out


def merge(chunks: list[Chunk], citations: dict[str, str] | None, seed: str = "") -> Chunk:
    """One passage of a run of chunks. With a citations map, markers stand in for citations and the map gets their texts;
    a marker's name is a hash of seed and number, so a run repeats exactly."""
    if citations is None:
        chunks = [c for c in chunks if not c.citation]
    if not chunks:
        return Chunk("", None)
    parts: list[str] = []
    before = None
    for c in chunks:
        if before is not None:
            if before.joined or c.joined or c.tail and not (c.text or before.text):
                pass
            elif c.tag == before.tag and c.tag in CELLS and not c.tail:
                parts.append("\t")
            else:
                parts.append(" ")
        text = cleanup(c.text)
        if c.citation:
            h = hashlib.sha256(f"{seed}|{len(citations)}".encode()).hexdigest()
            name = f"ANN_{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:32]}"
            citations[name] = text
            parts.append(name)
        else:
            parts.append(text)
        before = c
    lead = next((c for c in chunks if not c.tail and not c.citation), chunks[0])
    return Chunk(cleanup("".join(parts).replace("\n", "")), lead.tag, lead.path)


def passages(roots, passage_tags: Iterable[str] = PASSAGE_TAGS, handlers: dict[str, Handler] | None = None, citations: dict[str, str] | None = None, seed: str = "") -> list[Chunk]:
    """Passages of one or more elements: every chunk of a passage tag, head or tail, begins one; empty ones are dropped."""
    tags, runs = frozenset(passage_tags), [[]]
    for r in roots if isinstance(roots, (list, tuple)) else [roots]:
        for c in walk(r, handlers):
            if c.tag in tags:
                runs.append([c])
            else:
                runs[-1].append(c)
    return [m for m in (merge(r, citations, seed) for r in runs if r) if m.text]


def parse(xml: str):
    """A tree; undeclared mml and xlink prefixes are declared by a wrapper."""
    try:
        return ET.fromstring(xml)
    except ET.ParseError:
        body = re.sub(r"<\?xml.*?\?>|<!DOCTYPE.*?>", "", xml, flags=re.S)
        wrapped = f'<w_ xmlns:mml="http://www.w3.org/1998/Math/MathML" xmlns:xlink="http://www.w3.org/1999/xlink" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" xmlns:ali="http://www.niso.org/schemas/ali/1.0/">{body}</w_>'
        return ET.fromstring(wrapped)[0]


def unescape(text: str) -> str:
    return html.unescape(text)
