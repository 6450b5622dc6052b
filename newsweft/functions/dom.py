"""A small document tree over the standard library's parser, with the selectors that extraction rules need.

Selectors: ``tag.class#id[attr=value]``, descendants by a blank, children by
``>``, alternatives by a comma. Paragraphs and list items end where the next
block begins, as in browsers.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

_VOID = {"br", "img", "meta", "link", "input", "hr", "source", "area", "base", "col", "embed", "wbr", "track"}
_CLOSES_P = {"p", "div", "ul", "ol", "li", "h1", "h2", "h3", "h4", "h5", "h6", "table", "section", "article", "main", "aside", "nav", "header", "footer", "figure", "form", "blockquote"}
_RAW = {"script", "style"}
_STEP = re.compile(r"(?P<tag>[a-zA-Z][\w-]*|\*)?(?P<rest>(?:[.#][\w-]+|\[[^\]]+\])*)")


def clean(s: str) -> str:
    return unicodedata.normalize("NFC", " ".join(s.split()))


class Node:
    """An element; ``inner`` holds texts and elements in order."""

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, up: Node | None = None):
        self.tag, self.attrs, self.up = tag, attrs or {}, up
        self.inner: list[Node | str] = []

    @property
    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def elements(self) -> Iterator[Node]:
        """All elements below, in document order."""
        for x in self.inner:
            if isinstance(x, Node):
                yield x
                yield from x.elements()

    def children(self) -> Iterator[Node]:
        return (x for x in self.inner if isinstance(x, Node))

    def above(self) -> Iterator[Node]:
        at = self.up
        while at is not None:
            yield at
            at = at.up

    def strings(self) -> Iterator[str]:
        for x in self.inner:
            if isinstance(x, str):
                yield x
            elif x.tag == "br":
                yield "\n"
            elif x.tag not in _RAW:
                yield from x.strings()

    def text(self, breaks: bool = False) -> str:
        """Text in single blanks; with ``breaks``, lines as <br> has them."""
        whole = "".join(self.strings()) if breaks else " ".join(self.strings())
        return "\n".join(t for x in whole.split("\n") if (t := clean(x))) if breaks else clean(whole)

    def raw(self) -> str:
        return "".join(x for x in self.inner if isinstance(x, str))

    def find(self, selector: str) -> list[Node]:
        steps = _selectors(selector)
        return [n for n in self.elements() if any(_matches(n, s, self) for s in steps)]

    def first(self, selector: str) -> Node | None:
        return next((n for n in self.elements() if any(_matches(n, s, self) for s in _selectors(selector))), None)

    def drop(self, selector: str) -> None:
        for n in self.find(selector):
            if n.up is not None and n in n.up.inner:
                n.up.inner.remove(n)


@lru_cache(maxsize=500)
def _selectors(text: str) -> list[list[tuple[str, re.Match]]]:
    """For each alternative its steps from the last to the first, each with how it hangs on the one before."""
    out = []
    for part in text.split(","):
        steps, by = [], " "
        for token in re.findall(r">|(?:[^\s>\[]|\[[^\]]*\])+", part.strip()):
            if token == ">":
                by = ">"
                continue
            m = _STEP.fullmatch(token)
            if not m:
                raise ValueError(f"selector {token!r}")
            tests = re.findall(r"([.#])([\w-]+)|\[([\w-]+)(?:=\"?([^\]\"]*)\"?)?\]", m["rest"] or "")
            steps.append((by, m["tag"], tests))
            by = " "
        out.append(steps[::-1])
    return out


def _is(n: Node, tag: str | None, tests: list[tuple]) -> bool:
    if tag and tag != "*" and n.tag != tag:
        return False
    for kind, name, attr, value in tests:
        if kind == "." and name not in n.classes or kind == "#" and n.attrs.get("id") != name:
            return False
        if attr and (attr not in n.attrs or value and n.attrs[attr] != value):
            return False
    return True


def _matches(n: Node, steps: list, root: Node) -> bool:
    by, tag, tests = steps[0]
    if not _is(n, tag, tests):
        return False
    if len(steps) == 1:
        return True
    ups = [n.up] if by == ">" else list(n.above())
    return any(u is not None and u is not root and _matches(u, steps[1:], root) for u in ups)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("")

    def handle_starttag(self, tag, attrs):
        if tag in _CLOSES_P:
            self._close("p", {"div", "td", "li", "section", "article", "main", "body"})
        if tag == "li":
            self._close("li", {"ul", "ol"})
        n = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.inner.append(n)
        if tag not in _VOID:
            self.at = n

    def _close(self, tag: str, within: set[str]) -> None:
        n = self.at
        while n.up is not None and n.tag not in within:
            if n.tag == tag:
                self.at = n.up
                return
            n = n.up

    def handle_endtag(self, tag):
        n = self.at
        while n.up is not None:
            if n.tag == tag:
                self.at = n.up
                return
            n = n.up

    def handle_data(self, data):
        self.at.inner.append(data)


def parse(html: str | None) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root
