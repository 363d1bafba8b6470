"""A small HTML reader for one page: blocks of text with the branch of the page that they hang on.

It follows the parts of the HTML syntax that decide where text belongs: comments, raw text elements, quoted
attributes, end tags that may be left out, and character references.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple

import xxhash

_TOKEN = re.compile(
    r"<!--(?P<comment>)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?>[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>"
    r"|<[!?/][^>]*+>"
)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_COMMENT_END = re.compile(r"--!?>")
_NAME_PART = re.compile(r"[a-z]+|[0-9]+")
_DIGITS = re.compile(r"[0-9]+")
_SPACE = re.compile(r"[ \t\n\x0b\x0c\r\xa0]+")

#: Kinds of elements in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes noscript xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre search section select summary table"
    " tbody td tfoot th thead tr ul".split()
)
#: What a start tag closes if it is open, and what that search doesn't leave.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}

#: Elements, roles and name parts of elements that hold no main text.
NOISE_TAGS = frozenset(
    "script style noscript template textarea title iframe noembed noframes nav header footer aside form button select menu"
    " dialog head svg object canvas audio video search option input".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
NOISE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising advertisements adsense banner banners breadcrumb breadcrumbs comment comments"
    " commentlist disqus consent cookie cookies copyright footer header masthead menu menus modal nav navbar navigation newsletter"
    " notice notices notification notifications alert pagination pager paywall popup popover promo promos promotion related recommended"
    " reply replies respond share sharing shares sidebar sidebars sitemap social sponsor sponsored sponsors subscribe subscription"
    " toolbar widget widgets login signup".split()
)
MAIN_TAGS = frozenset({"article", "main"})
MAIN_ROLES = frozenset({"article", "main"})
#: Noise that only wraps: a main element inside it is main content all the same, unless it is noise by itself.
WRAPPER_TAGS = frozenset({"form"})
WRAPPER_ROLES = frozenset({"form"})
WRAPPER_NAMES = frozenset("widget widgets header social notice notices login signup subscription paywall".split())
#: Elements of running text: inside a main element they are kept whatever their statistics.
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt figcaption td th article main".split())

NOISE, MAIN, OPEN = range(3)


#: Parts that turn a name into one about the layout ("has-sidebar").
LAYOUT_NAMES = frozenset("has with no without layout template".split())


class Block(NamedTuple):
    """A block's text, the hashes of its branch and of the branch's parent, and its status."""

    text: str
    branch: int
    parent: int
    status: int


def text_hash(text: str, seed: int = 0) -> int:
    """A signed 64-bit hash."""
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"), seed) - (1 << 63)


class _Element:
    """An open element; what its ancestors are is settled when it opens, so that depth costs nothing."""

    __slots__ = ("name", "branch", "noise", "main", "holder", "children")

    def __init__(self, name: str, branch: int, noise: int, main: bool, holder: _Element | None):
        self.name, self.branch, self.noise, self.main = name, branch, noise, main
        self.holder = holder or self
        self.children: list[str] = []


#: How far an element is noise: not, as a wrapper, or with everything in it.
CLEAN, WRAPPER, ALL = range(3)


def _label(name: str, attrs: str) -> tuple[str, int, bool]:
    """An element's label in the style tree, and whether its kind or names make it noise, or main content.

    Numbers in names are alike: a page's own number in an id must not make a branch of its own.
    """
    # The page itself is no part of a page, whatever it is called.
    if name in {"html", "body"}:
        return name, CLEAN, False
    noise = WRAPPER if name in WRAPPER_TAGS else ALL if name in NOISE_TAGS else CLEAN
    main, label = name in MAIN_TAGS, name
    if "=" in attrs:
        for key, *values in _ATTRIBUTE.findall(attrs):
            names = html.unescape("".join(values)).lower().split()
            if key.lower() == "role":
                for role in names:
                    if role in NOISE_ROLES:
                        noise = max(noise, WRAPPER if role in WRAPPER_ROLES else ALL)
                main = main or not MAIN_ROLES.isdisjoint(names)
                continue
            for parts in map(_NAME_PART.findall, names):
                if LAYOUT_NAMES.isdisjoint(parts):
                    for part in NOISE_NAMES.intersection(parts):
                        noise = max(noise, WRAPPER if part in WRAPPER_NAMES else ALL)
            label += ("." if key.lower() == "class" else "#") + _DIGITS.sub("0", " ".join(sorted(names)))
    return label, noise, main


class _Reader:
    def __init__(self) -> None:
        self.stack = [_Element("", 0, CLEAN, False, None)]
        self.open: Counter[str] = Counter()
        self.text: list[str] = []
        self.blocks: list[Block] = []
        self.styles: list[tuple[int, str]] = []

    def flush(self) -> None:
        if not self.text:
            return
        text = _SPACE.sub(" ", "".join(self.text)).strip(" ")
        self.text = []
        if text:
            holder = self.stack[-1].holder
            status = NOISE if holder.noise else MAIN if holder.main and holder.name in FLOW else OPEN
            self.blocks.append(Block(text, holder.branch, self.parents(), status))

    def parents(self) -> int:
        """The branch above the block that is open."""
        holder = self.stack[-1].holder
        return next((e.branch for e in reversed(self.stack) if e.holder is not holder), 0)

    def pop(self, depth: int) -> None:
        while len(self.stack) > depth:
            element = self.stack.pop()
            self.open[element.name] -= 1
            if element.children:
                self.styles.append((element.branch, " ".join(element.children)))

    def start(self, name: str, attrs: str) -> None:
        if name in BLOCK:
            self.flush()
            if name not in {"option", "optgroup"}:
                self.close({"p"}, {"table", "td", "th", "button"})
            if name in CLOSES:
                self.close(*CLOSES[name])
        elif name == "br":
            self.add(" ")
        if name in VOID:
            return
        label, noise, main = _label(name, attrs)
        top = self.stack[-1]
        # A main element stands out from what only wraps it.
        noise = noise if main and not noise and top.noise == WRAPPER else max(noise, top.noise)
        if name in BLOCK:
            top.holder.children.append(label)
            branch = text_hash(label, top.branch + (1 << 63))
            self.stack.append(_Element(name, branch, noise, top.main or main, None))
        else:
            # Inline markup belongs to its block; inline noise has no text.
            self.stack.append(_Element(name, top.branch, noise, top.main, top.holder))
        self.open[name] += 1

    def close(self, names: set[str], limits: set[str]) -> None:
        if not any(self.open[n] for n in names):
            return
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].name in names:
                self.flush()
                self.pop(k)
                return
            if self.stack[k].name in limits:
                return

    def end(self, name: str) -> None:
        if name in BLOCK:
            self.flush()
        if not self.open[name]:
            return
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].name == name:
                self.pop(k)
                return
            # Inline end tags don't close blocks.
            if name not in BLOCK and self.stack[k].name in BLOCK:
                return

    def add(self, text: str) -> None:
        element = self.stack[-1]
        if not element.noise or element.holder.noise:
            self.text.append(html.unescape(text) if "&" in text else text)


def read_page(source: str) -> tuple[list[Block], list[tuple[int, str]]]:
    """The blocks of text of a page in their order, and (branch, sequence of its children's labels) of its elements.

    Character references are decoded, white space (with no-break spaces) is collapsed, and blocks without text
    are left out. Text of raw elements (scripts, styles and the like) and markup cut off at the end are no text.
    """
    reader, at, size = _Reader(), 0, len(source)
    while at < size:
        found = _TOKEN.search(source, at)
        if not found:
            # A tag that the page's end cuts off is no text.
            cut = re.search(r"<[a-zA-Z/!?]", source[at:])
            reader.add(source[at : at + cut.start()] if cut else source[at:])
            break
        if found.start() > at:
            reader.add(source[at : found.start()])
        at = found.end()
        name = found["name"]
        if found["comment"] is not None:
            empty = re.compile("-?>").match(source, at)
            end = empty or _COMMENT_END.search(source, at)
            at = end.end() if end else size
        elif name:
            name = name.lower()
            if found["end"]:
                reader.end(name)
            elif name in RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(source, at)
                at = end.start() if end else size
                if end:
                    close = source.find(">", at)
                    at = close + 1 if close >= 0 else size
            else:
                reader.start(name, found["attrs"])
    reader.flush()
    reader.pop(1)
    return reader.blocks, reader.styles
