"""Leaf blocks of a web page with the path of elements above each."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# A value in quotes may hold < and >. It counts as such only if what follows can follow a value, so that a quote that
# is never closed does not swallow the text up to another element's.
INSIDE = r"""(?:[^<>=]+|=\s*"[^"]*"(?=[\s/>])|=\s*'[^']*'(?=[\s/>])|=)*+"""
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<raw>script|style|noscript|template|iframe|svg|object)\b{INSIDE}(?:>|\Z).*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>{INSIDE}(?:>|(?=<)|\Z))", re.S | re.I)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
WORD = re.compile(r"[a-z]+")

#: Elements inside a line of text; all others begin and end a block.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag of the key ends an open element of the values, up to the nearest of BARRIERS.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
BARRIERS = frozenset("ul ol dl table body html article section div nav main aside footer header form".split())
#: Elements that end an open paragraph.
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav "
                   "ol p pre section table ul".split())


@dataclass
class Block:
    text: str
    path: list[str]  # names of elements and words of their class, id and role, outermost first
    linked: int  # characters inside links


@dataclass
class _Reader:
    blocks: list[Block] = field(default_factory=list)
    stack: list[tuple[str, list[str]]] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    def flush(self) -> None:
        text = " ".join(html.unescape("".join(self.parts)).split())
        if text:
            path = [name for tag, names in self.stack if tag not in INLINE for name in names]
            self.blocks.append(Block(text, path, min(self.linked, len(text))))
        self.parts, self.linked = [], 0

    def text(self, piece: str) -> None:
        self.parts.append(piece)
        if any(tag == "a" for tag, _ in self.stack):
            self.linked += len(piece.strip())

    def open(self, tag: str, attributes: str) -> None:
        if tag == "br" or tag == "hr":
            self.parts.append(" ")
        if tag not in INLINE:
            self.flush()
            if tag in ENDS_P:
                self.pop({"p"}, BARRIERS)
            if tag in CLOSES:
                self.pop(CLOSES[tag], BARRIERS)
        if tag in VOID or attributes.endswith("/>"):
            return
        names = [tag]
        if "=" in attributes:
            for name, value in ATTRIBUTE.findall(attributes):
                names += [f"{name.lower()}:{w}" for w in WORD.findall(value.lower())]
        self.stack.append((tag, names))

    def pop(self, tags: set[str], barriers: frozenset = frozenset()) -> None:
        """Close the innermost element of ``tags`` and all inside it, if it is not behind a barrier."""
        for depth in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[depth][0]
            if tag in tags:
                del self.stack[depth:]
                return
            if tag in barriers:
                return

    def close(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        self.pop({tag})


def leaf_blocks(page: str) -> list[Block]:
    """The texts of a page in order, without markup, scripts, styles and comments.

    A block is the text between two tags that are not inline; a line break is white space.
    Character references are decoded and runs of white space become one space. Tags may be
    unclosed, wrongly nested or cut off.
    """
    reader, at = _Reader(), 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            reader.text(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag:
            (reader.close(tag.lower()) if m["end"] else reader.open(tag.lower(), m["attributes"]))
        elif m["raw"]:
            reader.parts.append(" ")
    if at < len(page):
        reader.text(page[at:])
    reader.flush()
    return reader.blocks
