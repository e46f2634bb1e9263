"""HTML to leaf blocks: a tolerant tokenizer and the open-element stack."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

#: Attributes after a tag name: names, spaces, and values, quoted only where a quote follows the equals sign.
_ATTRS = r"(?>(?:[^\s>=]+|\s+|=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]*))*)"
_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)(" + _ATTRS + r")>|<[!?/][^>]*>|[^<]+|<", re.S)
_ATTR = re.compile(r"(?<![^\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Elements whose content is not markup, up to their end tag; one without an end tag is read on as markup.
RAW = frozenset("script style title textarea iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul
button label""".split())
#: Elements that a start tag of the key closes if they are open.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",)}
SECTIONS = frozenset("article main nav header footer aside form section figure table".split())
#: Elements whose blocks are looked at together.
CONTAINERS = frozenset("html body div section article main td th table ul ol dl form nav header footer aside center blockquote figure fieldset details".split())
_SCOPES = frozenset("html body table ul ol dl select article section main div td th blockquote form nav header footer aside".split())


@dataclass(eq=False)
class Element:
    """An open element. ``fresh`` are its features that no element around it has, so that those of a path add up once."""

    tag: str
    names: tuple[str, ...] = ()
    parent: Element | None = None
    fresh: tuple[str, ...] = ()

    def __post_init__(self):
        up = self.parent
        self.near = self if self.tag in SECTIONS or self.names else up and up.near
        self.container = self if self.tag in CONTAINERS else up and up.container
        self.in_main = self.tag in ("article", "main") or bool(up and up.in_main)

    def path(self) -> list[Element]:
        """From the outermost element to this one."""
        out, e = [], self
        while e is not None:
            out.append(e)
            e = e.parent
        return out[::-1]


@dataclass
class Block:
    text: str
    element: Element | None
    link_chars: int

    @property
    def path(self) -> list[Element]:
        return self.element.path() if self.element else []


class _Stack:
    """Open elements with the places of each tag, so that every question about them takes constant time."""

    def __init__(self):
        self.open: list[Element] = []
        self.at: dict[str, list[int]] = {}
        self.scopes: list[int] = [-1]
        self.active: dict[str, int] = {}

    def push(self, tag: str, names: tuple[str, ...]) -> None:
        marks = (f"in:{tag}", *dict.fromkeys(f"name:{n}" for n in names))
        e = Element(tag, names, self.top(), tuple(m for m in marks if not self.active.get(m)))
        for m in marks:
            self.active[m] = self.active.get(m, 0) + 1
        self.at.setdefault(tag, []).append(len(self.open))
        if tag in _SCOPES:
            self.scopes.append(len(self.open))
        self.open.append(e)

    def cut(self, place: int) -> None:
        """Close the element at ``place`` and all inside it."""
        while len(self.open) > place:
            e = self.open.pop()
            self.at[e.tag].pop()
            if e.tag in _SCOPES:
                self.scopes.pop()
            for m in (f"in:{e.tag}", *dict.fromkeys(f"name:{n}" for n in e.names)):
                self.active[m] -= 1

    def top(self) -> Element | None:
        return self.open[-1] if self.open else None

    def last(self, tag: str) -> int:
        """The place of the innermost open ``tag``, or -1."""
        places = self.at.get(tag)
        return places[-1] if places else -1

    def close_implied(self, tag: str) -> None:
        """Close an open ``tag`` that no scoping element stands above."""
        place = self.last(tag)
        if place >= 0 and place >= self.scopes[-1]:
            self.cut(place)


def _names(attrs: str) -> tuple[str, ...]:
    found = " ".join(a or b or c for _, a, b, c in _ATTR.findall(attrs)) if "=" in attrs else ""
    return tuple(t for t in re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", found).lower()) if t)


def leaf_blocks(source: str) -> list[Block]:
    """Non-empty runs of text between block boundaries in page order; references decoded, white space made single.

    Time is in proportion to the page, whatever its nesting. A tag that is
    never closed by ``>`` is text; a comment that is never closed, or a last tag, ends the page.
    """
    stack, blocks, parts, link, first = _Stack(), [], [], 0, None
    unclosed = set()  # raw elements that no end tag follows any more
    last_close = source.rfind(">")

    def flush() -> None:
        nonlocal link
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append(Block(text, first, min(link, len(text))))
            parts.clear()
        link = 0

    def put(text: str) -> None:
        nonlocal first, link
        if not parts:
            first = stack.top()
        parts.append(html.unescape(text) if "&" in text else text)
        if stack.last("a") >= 0:
            link += len(parts[-1].strip())

    pos, end = 0, len(source)
    while pos < end:
        if pos > last_close and not source.startswith("<!--", pos):  # no markup can end any more
            cut = source.find("<!--", pos)
            rest, pos = source[pos:cut if cut >= 0 else end], cut if cut >= 0 else end
            begun = rest.rfind("<")  # a tag that the page's end cuts off
            put(rest[:begun] if cut < 0 <= begun and rest[begun + 1:begun + 2].isalpha() else rest)
            continue
        m = _TOKEN.match(source, pos)
        pos = m.end()
        tag = m[2]
        if tag is None:
            piece = m[0]
            if piece[0] != "<" or len(piece) == 1:
                put(piece)
            continue
        tag = tag.lower()
        if m[1]:
            place = stack.last(tag)
            if tag in BLOCK:
                flush()
            if place >= 0:
                stack.cut(place)
            continue
        if tag in RAW:
            if not m[3].endswith("/") and tag not in unclosed:
                raw = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(source, pos)
                if raw:
                    pos = raw.end()
                else:
                    unclosed.add(tag)
            parts.append(" ")
            continue
        if tag in BLOCK:
            flush()
            for closed in ("p", *CLOSES.get(tag, ())):
                stack.close_implied(closed)
        elif tag == "br":
            parts.append("\n")
        if tag not in VOID and not m[3].endswith("/"):
            stack.push(tag, _names(m[3]))
    flush()
    return blocks
