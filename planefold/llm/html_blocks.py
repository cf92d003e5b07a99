"""Leaf text blocks of HTML pages, with the path of open elements around each.

A page is read once, from ``<`` to ``>``; the time is linear in its size, whatever is
left open in it. A ``<`` that begins no tag with an end is text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

#: Elements that don't end a block. Fixed values.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
#: Elements without an end tag. Fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text; an svg may be closed in its own tag. Fixed values.
RAW = ("script", "style", "noscript", "template", "svg", "iframe")
#: Elements that end an open one of the same kind. Fixed values.
SIBLINGS = frozenset("li dt dd tr td th option p".split())

#: What may follow the ``<`` of a tag, a comment or a declaration.
_OPEN = re.compile(r"<(?=[/!?a-zA-Z])")
_TAG = re.compile(r"/?[a-zA-Z][a-zA-Z0-9:-]*")
#: The rest of a tag up to its end or to the next quote that stands directly after ``=``.
_REST = re.compile(r"[^>=]*+(?:=[ \t\r\n\f]*+(?![\"'])[^>=]*+)*+(?:(>)|=[ \t\r\n\f]*+([\"']))")
_NAMES = re.compile(r"(?<![^\s\"'/])(?:class|id|role)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"']++))", re.I)
#: Elements around a block that its path names, the innermost.
DEPTH = 100
_WORD = re.compile(r"[a-z]+")


@dataclass
class Block:
    """Text of a block, names on its path, and how much of it is link text."""

    text: str
    path: tuple[str, ...]
    linked: float


class Reader:
    """Moves through a page once; what has no end is looked for only once."""

    def __init__(self, page: str) -> None:
        self.page, self.lower = page, page.lower() if len(page.lower()) == len(page) else page
        self.absent: set[str] = set()

    def find(self, what: str, at: int, lower: bool = False) -> int:
        """Next place of ``what``, -1 if there is none."""
        if what in self.absent:
            return -1
        found = (self.lower if lower else self.page).find(what, at)
        if found < 0:
            self.absent.add(what)
        return found

    def tag_end(self, at: int) -> int:
        """Place after the ``>`` of a tag whose name ends at ``at``, -1 if it has none.

        A quote counts directly after ``=``; one that is never closed does not.
        """
        if self.find(">", at) < 0:
            return -1
        while True:
            rest = _REST.match(self.page, at)
            if rest is None:
                return -1
            if rest[1]:
                return rest.end()
            close = self.find(rest[2], rest.end())
            at = close + 1 if close >= 0 else rest.end()

    def raw_end(self, tag: str, at: int) -> int:
        """Place after the end tag of a raw element, the end of the page if there is none."""
        while True:
            at = self.find("</" + tag, at, lower=True)
            if at < 0:
                return len(self.page)
            at += 2 + len(tag)
            stop = self.find(">", at)
            if stop < 0:
                return len(self.page)
            if not self.page[at:stop].strip():
                return stop + 1

    def markup(self):
        """Begin, end, name and attributes of each piece of markup; the name is None for what is no tag."""
        at = 0
        while True:
            opened = _OPEN.search(self.page, at)
            if opened is None:
                return
            begin, at = opened.start(), opened.end()
            if self.page.startswith("!--", at):
                stop = self.find("-->", at + 3)
                yield begin, len(self.page) if stop < 0 else stop + 3, None, ""
                at = len(self.page) if stop < 0 else stop + 3
                continue
            name = _TAG.match(self.page, at)
            if name is None:
                stop = -1 if self.page[at] == "/" else self.find(">", at)
                if stop >= 0:
                    yield begin, stop + 1, None, ""
                    at = stop + 1
                continue
            stop = self.tag_end(name.end())
            if stop < 0:
                continue
            tag, attributes = name[0].lower(), self.page[name.end() : stop - 1]
            whole = self.page[name.end()] in " \t\r\n\f/>"
            if tag in RAW and whole:
                # an svg may be closed in its own tag
                at = stop if tag == "svg" and attributes.endswith("/") else self.raw_end(tag, stop)
                yield begin, at, None, ""
                continue
            at = stop
            yield begin, at, tag, attributes


def _names(tag: str, attributes: str) -> tuple[str, ...]:
    """Element name, and the words of its class, id and role."""
    if "=" not in attributes:
        return (tag,)
    words = [w for found in _NAMES.findall(attributes) for value in found for w in _WORD.findall(value.lower())]
    return (tag, *("." + w for w in words))


def blocks(page: str) -> list[Block]:
    """All blocks with text, in page order; references decoded, white space joined to single spaces."""
    found: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    inside: dict[str, int] = {}
    parts: list[str] = []
    linked = links = 0

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                names = dict.fromkeys(n for _, own in stack[-DEPTH:] for n in own)
                found.append(Block(text, tuple(names), min(1.0, linked / len(text))))
            parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        parts.append(text)
        if links:
            linked += len(text)

    at = 0
    for begin, end, tag, attributes in Reader(page).markup():
        if begin > at:
            add(page[at:begin])
        at = end
        if not tag:
            continue
        closing, tag = tag[0] == "/", tag.lstrip("/")
        if tag in INLINE:
            if tag == "br":
                parts.append(" ")
            elif tag == "a":
                links = 0 if closing else 1
            continue
        close()
        links = 0
        if closing:
            while inside.get(tag):
                last = stack.pop()[0]
                inside[last] -= 1
                if last == tag:
                    break
        elif tag not in VOID:
            if stack and (stack[-1][0] == "p" or stack[-1][0] == tag and tag in SIBLINGS):
                inside[stack.pop()[0]] -= 1
            stack.append((tag, _names(tag, attributes)))
            inside[tag] = inside.get(tag, 0) + 1
    if at < len(page):
        add(page[at:])
    close()
    return found
