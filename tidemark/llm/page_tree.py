"""Trees of block elements read from HTML, with the roles that pages give them."""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from html import unescape

from xxhash import xxh64_intdigest

NEUTRAL, MAIN, NOISE = 0, 1, 2

#: Elements of HTML by what they do here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "html body address article aside blockquote caption center dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr legend li"
    " main menu nav noscript ol option optgroup p pre search section select summary table tbody td"
    " template tfoot th thead tr ul button svg canvas object audio video map".split()
)
NOISE_TAGS = frozenset(
    "head nav footer aside form search menu dialog button select template noscript svg canvas"
    " object audio video map option optgroup".split()
)
MAIN_TAGS = frozenset("article main".split())
CLOSED_BY_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "thead": frozenset(["tr", "td", "th", "tbody", "thead", "tfoot"]),
    "tbody": frozenset(["tr", "td", "th", "tbody", "thead", "tfoot"]),
    "tfoot": frozenset(["tr", "td", "th", "tbody", "thead", "tfoot"]),
    "option": frozenset(["option"]),
    "optgroup": frozenset(["option", "optgroup"]),
    "body": frozenset(["head"]),
}
#: What an implied end never reaches beyond.
SCOPE = frozenset(
    "html body table ul ol dl article main section aside nav header footer form div blockquote"
    " td th menu select".split()
)
#: Words of class names and ids by which sites mark what is not main text.
NOISE_WORDS = frozenset(
    "ad ads adsense advert adverts advertisement advertising sponsor sponsored promo promotion"
    " banner nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget widgets footer"
    " header masthead topbar cookie cookies consent gdpr notice notices notification popup modal"
    " overlay newsletter subscribe subscription signup login share sharing social related"
    " recommended comment comments disqus respond reply replies pagination pager toolbar".split()
)
HEADER_WORDS = frozenset(["header", "masthead", "banner"])
#: Words before one of the above in a name that only says how a page is laid out.
LAYOUT_WORDS = frozenset("with has no without left right".split())
MAIN_NAMES = frozenset(
    "article-body article-content article__body articlebody entry-content main-content"
    " post-body post-content story-body".split()
)
NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar"
    " toolbar".split()
)

_MARK = re.compile(
    r"<!--(?:.*?-->|.*)"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+)(?:>|\Z|[\"'][^>]*>?)"
    r"|<[!?/][^>]*>?",
    re.S,
)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I) for name in RAW}
_ATTRIBUTE = re.compile(
    r"(class|id|role|itemprop|hidden|style|aria-hidden)(?![\w-])"
    r"(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?",
    re.I,
)
_SPLIT = re.compile(r"[^a-z]+")
_DIGITS = re.compile(r"\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _words(name: str) -> list[str]:
    return [w for w in _SPLIT.split(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) if w]


def named_noise(names: list[str]) -> tuple[bool, bool]:
    """Whether names mark noise, and whether only the words for headers do."""
    found = set()
    for name in names:
        words = _words(name)
        if not LAYOUT_WORDS.intersection(words):
            found.update(NOISE_WORDS.intersection(words))
    return bool(found), bool(found) and found <= HEADER_WORDS


@lru_cache(maxsize=1 << 14)
def _looks(tag: str, rest: str) -> tuple[bytes, int, bool, bool]:
    """Shape of an element for its key, its role, whether a name gives it, whether it is a header."""
    values: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(rest):
        values.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    names = values.get("class", "").split()
    names += [values["id"]] if values.get("id") else []
    shape = _DIGITS.sub("0", " ".join([tag, *names])).encode()
    noise = only_header = False
    if names and tag not in ("html", "body"):
        noise, only_header = named_noise(names)
    hidden = (
        "hidden" in values
        or values.get("aria-hidden", "").lower() == "true"
        or bool(_HIDDEN.search(values.get("style", "")))
    )
    role = values.get("role", "").lower()
    main = tag in MAIN_TAGS or role == "main" or values.get("itemprop") == "articleBody"
    main = main or any(name.lower() in MAIN_NAMES for name in names)
    if hidden or tag in NOISE_TAGS or (role in NOISE_ROLES and not main):
        return shape, NOISE, False, False
    if tag == "header" or only_header:
        return shape, NOISE, tag != "header", True
    if noise:
        return shape, NOISE, True, False
    return shape, MAIN if main else NEUTRAL, False, False


class Node:
    __slots__ = ("tag", "parent", "key", "role", "by_name", "header", "children", "state", "text")

    def __init__(self, tag: str, parent: int, key: int) -> None:
        self.tag, self.parent, self.key = tag, parent, key
        self.role, self.by_name, self.header = NEUTRAL, False, False
        self.children: list[int] = []  # what stands in it, as hashes, in order
        self.state = NEUTRAL
        self.text = False


class Block:
    __slots__ = ("node", "text", "linked")

    def __init__(self, node: int, text: str, linked: int) -> None:
        self.node, self.text, self.linked = node, text, linked


class Page:
    """Block elements of a page, and its texts, in page order.

    A node's ``key`` follows from the tags, classes and ids from the root down
    to it, digits aside, so that like places of one site's pages have one key.
    """

    def __init__(self, html: str, site: str) -> None:
        self.nodes = [Node("#root", -1, xxh64_intdigest(site.encode()))]
        self.blocks: list[Block] = []
        self._stack = [0]
        self._open_tags = Counter()  # headings end each other and count as one
        self._buffer: list[str] = []
        self._linked = self._links = 0
        self._read(html)
        self._judge()

    def _flush(self) -> None:
        if self._buffer:
            text = " ".join("".join(self._buffer).split())
            if text:
                node = self._stack[-1]
                self.blocks.append(Block(node, text, min(self._linked, len(text))))
                self.nodes[node].children.append(0)
                self.nodes[node].text = True
            self._buffer = []
        self._linked = 0

    def _write(self, text: str) -> None:
        if "&" in text:
            text = unescape(text)
        self._buffer.append(text)
        if self._links:
            self._linked += len(text)

    def _pop(self) -> None:
        self._flush()
        tag = self.nodes[self._stack.pop()].tag
        self._open_tags["h" if tag in HEADINGS else tag] -= 1

    def _close(self, names: frozenset[str] | set[str]) -> None:
        """Ends the innermost open elements of these names, as far as the scope goes."""
        while True:
            for depth in range(len(self._stack) - 1, 0, -1):
                tag = self.nodes[self._stack[depth]].tag
                if tag in names:
                    break
                if tag in SCOPE:
                    return
            else:
                return
            while len(self._stack) > depth:
                self._pop()

    def _open(self, tag: str, rest: str) -> None:
        block = tag in BLOCK
        if not (block or rest or tag in NOISE_TAGS):
            return
        shape, role, by_name, header = _looks(tag, rest)
        if not block and role != NOISE:
            return
        if block:
            if tag in ("html", "body") and any(self.nodes[k].tag == tag for k in self._stack):
                return
            self._flush()
            self._close(CLOSED_BY_BLOCKS)
            if tag in CLOSED_BY:
                self._close(CLOSED_BY[tag])
        else:
            self._flush()
        parent = self._stack[-1]
        node = Node(tag, parent, xxh64_intdigest(shape, self.nodes[parent].key))
        node.role, node.by_name, node.header = role, by_name, header
        self.nodes[parent].children.append(node.key)
        self.nodes.append(node)
        self._stack.append(len(self.nodes) - 1)
        self._open_tags["h" if tag in HEADINGS else tag] += 1

    def _end(self, tag: str) -> None:
        if tag in ("html", "body"):
            return  # what follows still belongs to the page
        if not self._open_tags["h" if tag in HEADINGS else tag]:
            return
        block = tag in BLOCK
        for depth in range(len(self._stack) - 1, 0, -1):
            found = self.nodes[self._stack[depth]].tag
            if found == tag or (tag in HEADINGS and found in HEADINGS):
                while len(self._stack) > depth:
                    self._pop()
                return
            if found in SCOPE and (not block or tag in CLOSED_BY_BLOCKS or tag == "li"):
                return

    def _read(self, html: str) -> None:
        at, size = 0, len(html)
        while at < size:
            m = _MARK.search(html, at)
            if not m:
                self._write(html[at:])
                break
            if m.start() > at:
                self._write(html[at : m.start()])
            at = m.end()
            if not m[2]:
                continue
            tag = m[2].lower()
            if m[1]:
                if tag == "a":
                    self._links = 0
                elif tag not in VOID:
                    self._end(tag)
            elif tag in RAW:
                end = _RAW_END[tag].search(html, at)
                at = end.end() if end else size
            elif tag == "br" or tag == "wbr":
                if tag == "br":
                    self._write(" ")
            elif tag == "hr":
                self._flush()
                self._close(CLOSED_BY_BLOCKS)
            elif tag not in VOID:
                if tag == "a":
                    self._links = 1
                self._open(tag, m[3])
        while len(self._stack) > 1:
            self._pop()
        self._flush()

    def _judge(self) -> None:
        """Roles pass on to what stands inside."""
        nodes = self.nodes
        holds_main = [False] * len(nodes)
        for k in range(len(nodes) - 1, 0, -1):
            if nodes[k].role == MAIN or holds_main[k]:
                holds_main[nodes[k].parent] = True
        for k in range(1, len(nodes)):
            node, above = nodes[k], nodes[nodes[k].parent].state
            role = node.role
            if role == NOISE and node.by_name and holds_main[k]:
                role = NEUTRAL  # a name on what surrounds the main text says nothing
            if role == NOISE and node.header and above == MAIN:
                role = NEUTRAL  # an article's own heading
            node.state = NOISE if NOISE in (role, above) else max(role, above)

    def marked(self) -> bool:
        """Whether the page marks its main text."""
        return any(self.nodes[b.node].state == MAIN for b in self.blocks)
