"""A small tolerant DOM: elements in page order with their own text runs, as flat lists."""

from __future__ import annotations

import re
from html import unescape

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: elements whose content is no markup
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
#: elements whose text is never page text: no text on the page, or form controls; formulas and fallback texts are not among them
HIDDEN = frozenset("head script style textarea title template iframe select option button datalist noembed noframes "
                   "annotation annotation-xml desc metadata".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rb rp rt rtc ruby s "
                   "samp small span strike strong sub sup time tt u var wbr "
                   "math semantics mrow mi mo mn ms mtext msup msub msubsup mfrac msqrt mroot mover munder munderover mfenced mstyle "
                   "object noscript audio video canvas svg text tspan".split())
#: start tags that end an open element of the given names, up to the border names
CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])), "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])), "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "body": (frozenset(["head"]), frozenset()),
}
ENDS_PARAGRAPH = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
                           "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
PARAGRAPH = (frozenset(["p"]), frozenset(["button", "td", "th", "caption", "html", "table", "object", "template"]))

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Page:
    """Parallel lists over elements (0 is the page itself) and over text runs.

    ``runs`` holds (element, text, block number): runs of one block belong
    together, a new block starts at every block-level tag.
    """

    def __init__(self, html: str):
        self.tag, self.parent, self.attributes = ["#page"], [-1], [""]
        self.runs: list[tuple[int, str, int]] = []
        self._block = 0
        stack = [0]
        # places in the stack of the open elements of each name
        self._open: dict[str, list[int]] = {}
        at = 0
        for m in TOKEN.finditer(html):
            if m.start() < at:
                continue
            if m.start() > at:
                self._text(stack[-1], html[at:m.start()])
            at = m.end()
            name = m[2]
            if name is None:
                continue
            name = name.lower()
            if m[1]:
                self._close(stack, name)
                continue
            if name == "br":
                self.runs.append((stack[-1], " ", self._block))
                continue
            if name not in INLINE:
                self._block += 1
            if name in ENDS_PARAGRAPH:
                self._end(stack, *PARAGRAPH)
            if name in CLOSES:
                self._end(stack, *CLOSES[name])
            self.tag.append(name)
            self.parent.append(stack[-1])
            self.attributes.append(m[3])
            if name in VOID or m[3].endswith("/") and name in ("path", "circle", "rect", "use"):
                continue
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(html, at)
                if name == "xmp":
                    self.runs.append((len(self.tag) - 1, html[at:end.start() if end else len(html)], self._block))
                at = end.end() if end else len(html)
                continue
            self._open.setdefault(name, []).append(len(stack))
            stack.append(len(self.tag) - 1)
        if at < len(html):
            self._text(stack[-1], html[at:])

    def _text(self, element: int, raw: str) -> None:
        self.runs.append((element, unescape(raw) if "&" in raw else raw, self._block))

    def _close(self, stack: list[int], name: str) -> None:
        if name not in INLINE:
            self._block += 1
        self._cut(stack, self._last(name))

    def _end(self, stack: list[int], names: frozenset[str], borders: frozenset[str]) -> None:
        found = max(map(self._last, names))
        if found > max(map(self._last, borders), default=-1):
            self._cut(stack, found)

    def _last(self, name: str) -> int:
        """Place in the stack of the innermost open element of a name, -1 without one."""
        places = self._open.get(name)
        return places[-1] if places else -1

    def _cut(self, stack: list[int], at: int) -> None:
        """Close the element at this place and all inside it; each element is closed once, so pages take linear time."""
        if at > 0:
            for element in stack[at:]:
                self._open[self.tag[element]].pop()
            del stack[at:]


def attribute_tokens(attributes: str) -> set[str]:
    """Lower-case words of class, id and role."""
    if "=" not in attributes:
        return set()
    return {w.lower() for _, value in ATTRIBUTE.findall(attributes) for w in WORD.findall(value)}


def attribute_names(attributes: str) -> set[str]:
    """Whole lower-case names of class, id and role, as separated by white space."""
    if "=" not in attributes:
        return set()
    return {w for _, value in ATTRIBUTE.findall(attributes) for w in value.strip("\"'").lower().split()}
