"""HTML into leaf blocks: runs of text between block-level tags, each with its tag path.

One pass over the page, in time linear in its length. A tag ends at the first
'>' outside quoted attribute values; where a quote never closes, at the next
'>'. A tag that never ends takes the rest of the page. Elements nested deeper
than ``DEEPEST`` are flattened. Contents of raw elements are skipped up to their
end tag, or to the page's end; contents of embedded and control elements up to
their end, or that of an element around them, and not at all where the page has
no end tag for them.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass
from functools import lru_cache

TAG = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:_.-]*)")
STOP = re.compile(r"[>\"']")
# Fixed values of the language: elements whose content is not markup, and elements that hold no text of the page.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
SKIPPED = frozenset("svg math object button select template noscript".split())
DEEPEST = 100
ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|aria-label|itemprop|hidden|style)(?![\w-])(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
WORDS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")
# Fixed values of the language: tags that do not break a run of text, and tags without content.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag of the key ends an open tag of the values.
ENDS = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
    "body": ("head",),
}
#: Tags that an end tag or an implied end does not reach beyond.
WALLS = frozenset("table td th ul ol article section aside nav main header footer form blockquote".split())


@dataclass
class Block:
    text: str
    levels: tuple[tuple[str, tuple[str, ...]], ...]  # tag and name parts of classes and ids, outermost first
    link_chars: int
    path: tuple[str, ...]  # the same as one sequence

    @property
    def depth(self) -> int:
        return len(self.levels)

    def inside(self, tags: frozenset[str]) -> bool:
        return any(tag in tags for tag, _ in self.levels)


def path_of(levels: tuple[tuple[str, tuple[str, ...]], ...]) -> tuple[str, ...]:
    return tuple(p for tag, parts in levels for p in (tag, *parts))


#: Part of a path that says that an element is not shown.
HIDDEN = "!hidden"


def name_parts(rest: str) -> tuple[str, ...]:
    """Lower-case parts of class, id and role names; HIDDEN for elements that are not shown."""
    return _known_parts(rest) if len(rest) <= 300 else _parts(rest[:5_000])


def _parts(rest: str) -> tuple[str, ...]:
    out: list[str] = []
    for name, *values in ATTRIBUTE.findall(rest):
        value = "".join(values)
        name = name.lower()
        if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            out.append(HIDDEN)
        elif name != "style":
            out += [w.lower() for w in WORDS.findall(value)]
    return tuple(dict.fromkeys(out))


_known_parts = lru_cache(20_000)(_parts)


def tag_end(page: str, at: int) -> int:
    """The place of the '>' that ends the tag whose name ends at ``at``; -1 where there is none."""
    while m := STOP.search(page, at):
        place = m.start()
        if page[place] == ">":
            return place
        at = place + 1
        before = place - 1
        while page[before].isspace():
            before -= 1
        if page[before] == "=":  # elsewhere a quote is a character like others
            close = page.find(page[place], at)
            if close < 0:
                return page.find(">", at)
            at = close + 1
    return -1


class _Reader:
    """Blocks from the pieces of a page, in order."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.out: list[Block] = []
        self.stack: list[tuple[str, tuple[str, ...]]] = []
        self.run: list[str] = []
        self.links = self.linked = 0  # open links; characters inside links
        self.skipped = self.flat = 0  # open skipped elements; flattened elements that are open
        self.levels: tuple[tuple[str, tuple[str, ...]], ...] = ()
        self.path: tuple[str, ...] | None = None
        self.last_ends: dict[str, int] = {}

    def text(self, piece: str) -> None:
        if not self.skipped:
            piece = html.unescape(piece) if "&" in piece else piece
            self.run.append(piece)
            self.linked += len(piece) if self.links else 0

    def flush(self) -> None:
        text = " ".join("".join(self.run).split())
        if text:
            if self.path is None:
                self.levels = tuple(self.stack)
                self.path = path_of(self.levels)
            self.out.append(Block(text, self.levels, min(self.linked, len(text)), self.path))
        self.run.clear()
        self.linked = 0

    def pop_to(self, k: int) -> None:
        for tag, _ in self.stack[k:]:
            self.links -= tag == "a"
            self.skipped -= tag in SKIPPED
        del self.stack[k:]
        self.path = None

    def end(self, tag: str) -> None:
        inline = tag in INLINE
        if not inline:
            self.flush()
        if self.flat and not inline:
            self.flat -= 1
            return
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                self.pop_to(k)
                break
            if self.stack[k][0] in WALLS and (inline or tag in ("p", "li")):
                break

    def start(self, tag: str, rest: str, at: int) -> None:
        inline = tag in INLINE
        if not inline:
            self.flush()
        if tag == "br":
            self.run.append(" ")
        if tag in VOID or tag in SKIPPED and (rest.endswith("/") or not self.ends_later(tag, at)):
            return
        if not inline:
            for k in range(len(self.stack) - 1, -1, -1):
                open_tag = self.stack[k][0]
                if open_tag == "p" or open_tag in ENDS.get(tag, ()):
                    self.pop_to(k)
                elif open_tag in WALLS:
                    break
        if len(self.stack) >= DEEPEST:
            self.flat += not inline
            return
        self.stack.append((tag, name_parts(rest) if rest else ()))
        self.path = None
        self.links += tag == "a"
        self.skipped += tag in SKIPPED

    def ends_later(self, tag: str, at: int) -> bool:
        if tag not in self.last_ends:
            found = [m.start() for m in re.finditer(rf"</{tag}(?=[\s/>])", self.page, re.IGNORECASE)]
            self.last_ends[tag] = found[-1] if found else -1
        return self.last_ends[tag] > at


def blocks(page: str | None) -> list[Block]:
    """The page's leaf blocks in order; white space inside a block is one space."""
    page = page or ""
    reader = _Reader(page)
    at, n = 0, len(page)
    while at < n:
        place = page.find("<", at)
        if place < 0:
            reader.text(page[at:])
            break
        if place > at:
            reader.text(page[at:place])
        mark = page[place + 1 : place + 2]
        if mark in ("!", "?"):
            comment = page.startswith("<!--", place)
            # a comment may end with the dashes that begin it
            end = page.find("-->", place + 2) if comment else page.find(">", place)
            at = n if end < 0 else end + (3 if comment else 1)
            continue
        m = TAG.match(page, place + 1)
        if not m:
            if mark == "/":  # an end tag without a name is a comment
                end = page.find(">", place)
                at = n if end < 0 else end + 1
            else:
                reader.text("<")
                at = place + 1
            continue
        end = tag_end(page, m.end())
        if end < 0:
            break
        tag, at = m[2].lower(), end + 1
        if m[1]:
            reader.end(tag)
            continue
        if tag in RAW:
            reader.flush()
            raw = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(page, at)
            if not raw:
                break
            end = page.find(">", raw.start())
            at = n if end < 0 else end + 1
            continue
        reader.start(tag, page[m.end() : end], place)
    reader.flush()
    return reader.out
