"""A page as arrays of elements: tag, parent, attributes, and the blocks of text each one holds."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
# Attributes up to the end of the tag; a quoted value may hold ">".
REST = re.compile(r"""(?:[^"'>]++|"[^"]*+"|'[^']*+')*+>""")
# Attributes up to "/>"; the slash that ends an unquoted value belongs to the value.
SELF_CLOSED = re.compile(r"""(?:[^"'>=/]++|/(?!>)|"[^"]*+"|'[^']*+'|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++)?+)*+/>""")
SKIPPED = {name: re.compile(rf"</{name}\s*>", re.I) for name in "script style textarea title noscript template iframe svg select".split()}
# A scan for the end of a tag is in one of three states at each place (outside quotes or inside one of two kinds) and
# scans in the same state stay so; after as many that ran to the end of the page the next ones would too.
OPEN_SCANS = 3
ATTRIBUTE = re.compile(r"""(class|id|role|itemprop|aria-label|data-[\w-]+|style|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
ATTRIBUTE_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data dfn em font i img ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr del ruby rt rp".split()
)
CLOSES_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol p pre section table ul".split()
)
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
STOPS = set("ul ol dl table body html article section div main td th form nav aside".split())


class Page(NamedTuple):
    """Elements in page order; ``blocks`` are (element, text, characters of it inside links)."""

    tags: list[str]
    parents: list[int]
    words: list[list[str]]
    blocks: list[tuple[int, str, int]]


def _attribute_words(raw: str) -> list[str]:
    out = []
    for name, value in ATTRIBUTE.findall(raw):
        name = name.lower()
        if name == "style":
            if re.search(r"display\s*:\s*none", value, re.I):
                out.append("hidden")
        elif name == "hidden":
            out.append("hidden")
        else:
            out += [w.lower() for w in ATTRIBUTE_WORD.findall(value)]
    return out


class _Open:
    """The open elements, with the places of each name and of the elements that stop a search."""

    def __init__(self):
        self.elements, self.names = [0], ["#root"]
        self.places: dict[str, list[int]] = {}
        self.stops: list[int] = [0]

    def push(self, element: int, name: str) -> None:
        self.places.setdefault(name, []).append(len(self.elements))
        if name in STOPS:
            self.stops.append(len(self.elements))
        self.elements.append(element)
        self.names.append(name)

    def last(self, names: set[str]) -> int:
        """Place of the innermost open element of these names, 0 if there is none."""
        return max((self.places[name][-1] for name in names if self.places.get(name)), default=0)

    def close(self, place: int) -> None:
        """Closes the element at a place and all inside it."""
        while len(self.elements) > place:
            self.elements.pop()
            name = self.names.pop()
            self.places[name].pop()
            if name in STOPS:
                self.stops.pop()


def _tags(source: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, closing, attributes) of tags; comments, declarations and skipped elements have no name.

    Every character is passed a bounded number of times: a tag whose quotes never close ends at its first ">",
    and a "<" that no ">" follows is text.
    """
    at, last, open_scans, size = 0, source.rfind(">"), 0, len(source)
    while True:
        start = source.find("<", at)
        if start < 0:
            return
        if source.startswith("<!--", start):
            end = source.find("-->", start + 4)
            at = size if end < 0 else end + 3
            yield start, at, "", False, ""
            continue
        if start > last:
            return
        if source[start + 1 : start + 2] in ("!", "?"):
            at = source.find(">", start) + 1
            yield start, at, "", False, ""
            continue
        named = NAME.match(source, start)
        if named is None:
            at = start + 1
            continue
        begin = named.end()
        rest = REST.match(source, begin) if open_scans < OPEN_SCANS else None
        if rest is None:
            open_scans += 1
            at = source.find(">", begin) + 1
        else:
            at = rest.end()
        closing, name, attributes = bool(named.group(1)), named.group(2).lower(), source[begin : at - 1]
        if name in SKIPPED and not closing:
            if not SELF_CLOSED.fullmatch(source, begin, at):
                end = SKIPPED[name].search(source, at)
                at = size if end is None else end.end()
            yield start, at, "", False, ""
        else:
            yield start, at, name, closing, attributes


def parse(source: str | None) -> Page:
    """Element 0 is the root. Inline elements make no element of their own, but links are counted.

    Contents of scripts, styles, titles, text areas, selects, templates, frames and drawings, and comments are no text; one of them
    that is closed in its own tag ("/>") has no contents. A block ends where an element other than an inline one begins or ends.
    """
    tags, parents, words, blocks = ["#root"], [-1], [[]], []
    still = _Open()
    parts: list[str] = []
    in_link = link_chars = 0

    def flush() -> None:
        nonlocal link_chars
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        if text:
            blocks.append((still.elements[-1], text, min(link_chars, len(text))))
        parts.clear()
        link_chars = 0

    at = 0
    source = source or ""
    for start, end, name, closing, attributes in _tags(source):
        if start > at:
            parts.append(source[at:start])
            if in_link:
                link_chars += start - at
        at = end
        if not name:
            continue
        if name in INLINE:
            if name == "a":
                in_link = max(0, in_link + (-1 if closing else 1))
            elif name == "br" or name == "wbr":
                parts.append(" ")
            continue
        flush()
        in_link = 0
        if closing:
            place = still.last({name})
            if place:
                still.close(place)
            continue
        place = still.last(SAME_CLOSES.get(name) or ({"p"} if name in CLOSES_P else set()))
        if place and place >= still.stops[-1]:
            still.close(place)
        if name in VOID:
            continue
        tags.append(name)
        parents.append(still.elements[-1])
        words.append(_attribute_words(attributes) if attributes else [])
        if not attributes.rstrip().endswith("/"):
            still.push(len(tags) - 1, name)
    if at < len(source):
        parts.append(source[at:])
    flush()
    return Page(tags, parents, words, blocks)
