"""Citation markers: removal from text, with the place that each leaves."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

#: The form of a marker's name (fixed value).
MARKER = r"ANN_[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
CLOSED_BY = {"(": ")", "[": "]"}
OPENING, CLOSING = "([{", ")]}"


def _blank(c: str) -> bool:
    return c.isspace() and c != "\t"


def _back(text: str, at: int, floor: int) -> int:
    """Where the blanks that end at `at` begin."""
    while at > floor and _blank(text[at - 1]):
        at -= 1
    return at


def _on(text: str, at: int) -> int:
    """Where the blanks that begin at `at` end."""
    while at < len(text) and _blank(text[at]):
        at += 1
    return at


@dataclass
class Surroundings:
    """What stands about a marker: blanks, at most one bracket on either side with blanks inside of it, a full stop."""

    outer: int  # where the blanks before begin
    inner: int  # the bracket before, or the marker
    name: tuple[int, int]
    after: int  # behind the bracket after, or the marker
    end: int  # behind the blanks after
    brackets: str
    stop: bool

    @classmethod
    def of(cls, text: str, begin: int, end: int, floor: int) -> "Surroundings":
        inner, after, brackets = begin, end, ["", ""]
        left, right = _back(text, begin, floor), _on(text, end)
        if left > floor and text[left - 1] in OPENING:
            brackets[0], inner = text[left - 1], left - 1
        if right < len(text) and text[right] in CLOSING:
            brackets[1], after = text[right], right + 1
        last = _on(text, after)
        return cls(_back(text, inner, floor), inner, (begin, end), after, last, "".join(brackets), text[last : last + 1] == ".")

    def gone(self, pairs: set[str]) -> tuple[int, int]:
        """The stretch that goes with the marker: a lone bracket and all about it stay; before a full stop nothing stays; else
        one side's blanks do, those after if there are any."""
        if self.brackets and self.brackets not in pairs:
            return self.name
        keeps_after = not self.stop and self.end > self.after
        keeps_before = not self.stop and not keeps_after
        return (self.inner if keeps_before else self.outer), (self.after if keeps_after else self.end)


def strip_markers(text: str, markers: Mapping[str, str], marker: str = MARKER, fix_curly: bool = False) -> tuple[str, list[tuple[str, str, int]]]:
    """Text without known markers, and (id, citation text, offset) of each.

    A bracket pair around a marker goes with it, a lone bracket stays. Curly pairs count as lone brackets unless fix_curly.
    What belongs to one marker's surroundings doesn't belong to the next one's. The offset is that of the last character kept
    before the marker, or 0."""
    pairs = {a + b for a, b in CLOSED_BY.items()} | ({"{}"} if fix_curly else set())
    kept: list[str] = []
    notes: list[tuple[str, str, int]] = []
    taken = copied = size = 0
    for m in re.finditer(marker, text) if markers else ():
        about = Surroundings.of(text, m.start(), m.end(), taken)
        taken = about.end + about.stop
        if m[0] not in markers:
            continue
        begin, end = about.gone(pairs)
        kept.append(text[copied:begin])
        size, copied = size + begin - copied, end
        notes.append((m[0], markers[m[0]], max(size - 1, 0)))
    return "".join([*kept, text[copied:]]), notes
