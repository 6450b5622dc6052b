"""HTML extraction with the standard library's parser, in Arrow UDFs; patterns suffice only for flat tags."""

from __future__ import annotations

import unicodedata
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SKIP = {"script", "style", "noscript", "template", "svg"}
_FRAME = {"nav", "header", "footer", "aside", "form"}
_BLOCK = {"p", "div", "li", "h1", "h2", "h3", "h4", "article", "section", "main", "ul", "ol", "table", "tr", "td", "body", "html", "br"}
_VOID = {"br", "img", "meta", "link", "input", "hr", "source", "area", "base", "col", "embed", "wbr"}

ARTICLE = T.StructType([T.StructField("title", T.StringType()), T.StructField("description", T.StringType()), T.StructField("published", T.StringType()),
                        T.StructField("paragraphs", T.ArrayType(T.StringType())), T.StructField("links", T.ArrayType(T.StringType()))])


def _clean(s: str) -> str:
    return unicodedata.normalize("NFC", " ".join(s.split()))


class _Page(HTMLParser):
    """Collects headings, meta data, links, and the paragraphs of the article or else of the page."""

    def __init__(self, excluded: frozenset[str]):
        super().__init__(convert_charrefs=True)
        self.excluded = excluded
        self.open: list[tuple[str, bool]] = []
        self.meta: dict[str, str] = {}
        self.first: dict[str, str] = {}
        self.links: list[str] = []
        self.inner: list[str] = []
        self.outer: list[str] = []
        self.text: list[str] | None = None
        self.tag = ""

    def hidden(self) -> bool:
        return any(h for _, h in self.open)

    def inside(self, tag: str) -> bool:
        return any(t == tag for t, _ in self.open)

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag == "meta" and (name := a.get("property") or a.get("name")):
            self.meta.setdefault(name.lower(), a.get("content", ""))
        if tag == "a" and a.get("href"):  # menus too: list pages are read for them
            self.links.append(a["href"])
        if tag == "br" and self.text is not None:
            self.text.append("\n")
        if tag in ("p", "h1", "title") or (tag in _BLOCK and tag != "br" and self.tag == "p"):
            self.flush()  # an unclosed paragraph ends at the next block
            if tag in ("p", "h1", "title"):
                self.text, self.tag = [], tag
        if tag not in _VOID:
            bad = tag in _SKIP or tag in _FRAME or bool(self.excluded & set(a.get("class", "").lower().split()))
            self.open.append((tag, bad))

    def handle_endtag(self, tag):
        if tag == self.tag or (tag in _BLOCK and self.tag == "p"):
            self.flush()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        if self.text is not None and not self.hidden():
            self.text.append(data)

    def flush(self):
        if self.text is not None and (t := _clean("".join(self.text))):
            if self.tag == "p":
                (self.inner if self.inside("article") else self.outer).append(t)
            else:
                self.first.setdefault(self.tag, t)
        self.text, self.tag = None, ""


def parse(html: str | None, excluded: frozenset[str]) -> dict:
    """Title by h1, og:title, <title>; paragraphs without excluded blocks and repeated neighbours; distinct links in order."""
    page = _Page(excluded)
    page.feed(html or "")
    page.flush()
    title = page.first.get("h1") or _clean(page.meta.get("og:title", "")) or page.first.get("title")
    paragraphs = page.inner or page.outer
    paragraphs = [p for i, p in enumerate(paragraphs) if i == 0 or p != paragraphs[i - 1]]
    return {"title": title, "description": _clean(page.meta.get("og:description") or page.meta.get("description", "")) or None,
            "published": page.meta.get("article:published_time"), "paragraphs": paragraphs, "links": list(dict.fromkeys(page.links))}


def article(html, excluded: tuple[str, ...] = ("ad", "share", "related", "byline", "comments")):
    """``struct<title, description, published, paragraphs, links>`` of a page; null and broken pages give empty lists."""
    skip = frozenset(excluded)

    @F.pandas_udf(ARTICLE)
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parse(x, skip) for x in s], columns=ARTICLE.names)

    return run(html)
