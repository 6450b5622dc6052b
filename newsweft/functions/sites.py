"""Titles, dates and bodies of articles by site: one reader, a rule a site."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dom import Node, clean, parse


@dataclass(frozen=True)
class Title:
    """Places to look, in order: ``og`` and selectors; and a pattern taken off the end."""

    places: tuple[str, ...]
    off: str = ""


@dataclass(frozen=True)
class Body:
    """Where text is and what is none.

    ``roots``: selectors, the first that finds anything counts (all it finds with
    ``every``); the page if none does and ``or_page``. ``items``: what is a
    paragraph. ``drop``: what is taken out before. ``inside``: classes of ancestors
    whose text does not count. ``skip``: texts that do not count. ``stop_at``:
    class and id names, ``stop_text``: texts, at which the body ends; with
    ``stop_heading`` that only an h2 before ends it. ``once``: repeated neighbours
    (runs) or all repeats (all) count once.
    """

    roots: tuple[str, ...]
    items: str = "p"
    drop: str = ""
    inside: str = ""
    skip: str = ""
    stop_at: str = ""
    stop_text: str = ""
    stop_heading: str = ""
    once: str = ""
    join: str = "\n"
    every: bool = False
    or_page: bool = False
    breaks: bool = False


@dataclass(frozen=True)
class Site:
    title: Title
    bodies: tuple[Body, ...]
    published: tuple[str, ...] = ("meta[property=article:published_time]", "meta[name=article:published_time]", "time[datetime]")
    described: bool = False


# Where each site has its text, and what is none.
GENERIC = Body(("div.entry-content p", "div.node-content p", "article p", "div.td-post-content p", "p"), every=True)
LADDER = Body(("div.entry-content p", "div.node-content p", "article p", "p"), every=True)
NOISE = ("#comments, .comments, form, aside, nav, header, footer, .tags, .tagcloud, .post-tags, .td-post-source-tags, .related, .td_block_related_posts, .jeg_related_post, "
         ".jnews_related_post_container, .share, .social, .post-share, .post-meta")
BOILERPLATE = r"Save my name, email, and website|^(?:[#＃][^\s#]+(?:\s+|$)){3,}$"
MEMBERS_ONLY = r"(?i)you must have an account to access this content|^(Create Account|Account Required)$|^already a member\?"
SCOPES = ("article", "main", "div[itemprop=articleBody]", "div.entry-content", "div.node-content", "div.td-post-content")
DOMAIN_SCOPES = {
    "yktnews.com": ("div.td-post-content", "div.entry-content", "article .td-post-content"),
    "khitthit": ("div.td-post-content", "div.entry-content", "article .td-post-content"),
    "mizzima": ("div.td-post-content", "div.entry-content", "article .td-post-content"),
    "dvb": ("div.node-content", "div.entry-content", "article"),
    "myanmar-now": ("div.entry-content.entry.clearfix", "div.entry-content", "article"),
    "myanmarnow": ("div.entry-content.entry.clearfix", "div.entry-content", "article"),
    "gnlm.com.mm": ("div.entry-content", "div.post-content", "article"),
}
SITES = {
    "generic": Site(Title(("h1.jeg_post_title", "h1.entry-title", "h1", "og", "title")), (GENERIC,)),
    "ladder": Site(Title(("h1", "og", "title")), (LADDER,)),
    "irrawaddy": Site(Title(("h1.jeg_post_title", "h1.entry-title", "h1", "og", "title"), r"\s*[-|–—]\s*The Irrawaddy\s*$"), (Body(
        ("div.content-inner",), every=True,
        inside=r"^(jnews_inline_related_post|jeg_postblock_21|widget|widget_jnews_popular|jeg_postblock_5|jnews_related_post_container)$"),)),
    "bbc": Site(Title(("og", "h1", "title")), (Body(
        ("main[role=main]",), or_page=True,
        drop="section[aria-labelledby=article-byline], section[data-e2e=recommendations-heading], header[role=banner], nav[role=navigation], footer[role=contentinfo], aside"),)),
    "dvb": Site(Title(("h1", "og", "title")), (Body((".full_content p",), every=True),)),
    "mizzima": Site(Title(("og", "h1.entry-title", "h1", "title")), (Body(
        ("div.entry-content",), drop=".sharedaddy, .share, .social-share, .post-tags, .tags, .related-posts, .jp-relatedposts, .code-block, script, style", stop_heading=r"(?i)Related Posts"),)),
    "myanmar_now": Site(Title(("og", "h1", "title"), r"\s*[-|–—]\s*Myanmar Now\s*$"), (Body(
        ("div.entry-content.entry.clearfix", "div.entry-content", "article"), skip="ပံ့ပိုးကူညီပေးပါ", once="runs", join="\n\n",
        stop_at=r"(?i)(read[-_ ]?next|related|popular|most[-_ ]?read|subscribe|newsletter|footer|sidebar|comments?)",
        stop_text=r"^(Read Next|Related Articles|Subscribe to our channel|ဖတ်ရှုမှုအများဆုံး|Subscribe)$"),)),
    "gnlm": Site(Title(("h1.entry-title", "h1", "og", "title"), r"(?i)\s*[-|–—]\s*(?:The\s+)?Global\s+New\s+Light\s+Of\s+Myanmar\s*$"), ()),
    "frontier": Site(Title(("h1", "og", "title")), (
        Body(("div.post-content-single.elementor-widget-theme-post-content > div.elementor-widget-container", "div.post-content-single div.elementor-widget-container", "div.post-content-single", "div.entry-content"),
             items="p, h2, h3, li", or_page=True, inside=r"(?i)\b(pmpro|pmpro_card|pmpro_card_content|pmpro_content_message)\b|related|more-stories|elementor-post$|share|footer|header|menu|nav|newsletter",
             skip=MEMBERS_ONLY + "|^(share|more stories|related stories)$"),
        Body(LADDER.roots, skip=MEMBERS_ONLY, every=True)),
        ("meta[property=article:published_time]", "meta[name=article:published_time]", "meta[property=og:updated_time]", "meta[itemprop=datePublished]", "jsonld", "time", "words"), described=True),
    "eleven": Site(Title(("og", "h1#page-title", "h1", "title"), r"\s*\|\s*Eleven Media Group Co\., Ltd\s*$"), (
        Body(("div.node-content div.field-item", "div.node-content"), items="span", once="all"), Body(("div.node-content div.field-item", "div.node-content"), once="all")),
        ("div.news-detail-date-author-info-date span.date-display-single",)),
    "jetro": Site(Title(("#elem_heading_lv1 h1", "h1", "og")), (), ("meta[name=jetro-publicize_date]",)),
    "popular": Site(Title(("h1.entry-title", "h1", "og", "title")), (Body(("div.td-post-content", "div.entry-content"), drop=NOISE, skip=BOILERPLATE),)),
    "khitthit": Site(Title(("h1.entry-title", "h1", "og", "title")), (Body(("div.td-post-content", "div.entry-content"), drop=NOISE, skip=BOILERPLATE),)),
}
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
JSONLD_TYPES = {"newsarticle", "article", "webpage"}
JSONLD_DATES = ("datePublished", "dateCreated", "dateModified")
GNLM_ENDS, GNLM_NOISE = ("sharing", "share", "crp_related", "related"), ("sharing", "share", "related", "gallery", "crp_related")
GNLM_BLOCKS = "h1, h2, h3, h4, h5, h6, ul, ol, table, figure, section, article, nav, aside"
JETRO_PLACE = re.compile(r"^（[^（）]+）$")
#: Block types of a page's JSON whose text is none of the article's.
BBC_SKIPPED = {"unorderedList", "orderedList", "listItem", "urlLink"}


def title_of(page: Node, rule: Title) -> str:
    for place in rule.places:
        if place == "og":
            n = page.first("meta[property=og:title]")
            found = clean(n.attrs.get("content", "")) if n else ""
        else:
            n = page.first(place)
            found = n.text() if n else ""
        if found:
            return re.sub(rule.off, "", found).strip() if rule.off else found
    return ""


def _parts(root: Node, rule: Body) -> Iterator[str]:
    wanted = root.find(rule.items)
    heading = ""
    for n in root.elements():
        if n.tag == "h2":
            heading = n.text()
        if rule.stop_heading and re.search(rule.stop_heading, heading) and n in wanted:
            return
        if rule.stop_at and re.search(rule.stop_at, f"{n.attrs.get('class', '')} {n.attrs.get('id', '')}".strip()):
            return
        if rule.stop_text and re.search(rule.stop_text, n.text()):
            return
        if n not in wanted or rule.inside and any(re.search(rule.inside, c) for u in n.above() for c in u.classes):
            continue
        t = n.text(rule.breaks)
        if t and not (rule.skip and re.search(rule.skip, t)):
            yield t


def body_by(page: Node, rule: Body) -> str:
    if rule.drop:
        page.drop(rule.drop)
    roots: list[Node] = []
    for s in rule.roots:
        roots = page.find(s)
        if roots:
            break
    if not roots and rule.or_page:
        roots = [page]
    if roots and all(r.tag == rule.items for r in roots) and rule.every:  # the selector names the paragraphs themselves
        parts = [t for r in roots if (t := r.text(rule.breaks)) and not (rule.skip and re.search(rule.skip, t))]
    else:
        parts = [t for r in (roots if rule.every else roots[:1]) for t in _parts(r, rule)]
    if rule.once == "runs":
        parts = [t for i, t in enumerate(parts) if not i or t != parts[i - 1]]
    if rule.once == "all":
        parts = list(dict.fromkeys(parts))
    return rule.join.join(parts).strip()


def gnlm_body(page: Node) -> str:
    """A leading h3, the paragraphs up to sharing and related posts, else all, then blocks that read like paragraphs."""
    content = page.first("div.entry-content")
    if content is None:
        return ""
    parts = [t for n in content.children() if n.tag == "h3" and (t := n.text(True))][:1]
    for n in content.children():
        if n.tag == "div" and any(k in n.attrs.get("class", "") for k in GNLM_ENDS):
            break
        if n.tag in ("h2", "h3") and re.match(r"(?i)related\s+posts?:?", n.text()):
            break
        if n.tag == "p" and (t := n.text(True)):
            parts.append(t)
    parts = parts or [t for n in content.find("p") if (t := n.text(True))]
    for n in content.children():
        if n.tag == "div" and not any(k in n.attrs.get("class", "") for k in GNLM_NOISE) and not n.find(GNLM_BLOCKS):
            if len(n.text()) >= 40 and " " in n.text() and n.text(True) not in parts:
                parts.append(n.text(True))
    return "\n".join(parts).strip()


def jetro_parts(page: Node) -> tuple[str, str]:
    """Place and body: texts of the article's boxes, else of the main area."""
    main = page.first("#mainArea") or page.first("[role=main]") or page
    place = next((t for p in main.find("p") if JETRO_PLACE.match(t := p.text())), "")
    boxes, out = main.find(".elem_paragraph.wzg"), []
    for root in boxes or [main]:
        for n in root.find("h2, h3, h4, p, li"):
            t = n.text()
            if not t or t == place:
                continue
            if boxes:
                if n.tag == "li" and n.find("p") or n.tag == "p" and "noindent" in n.classes and not t.startswith("（注"):
                    continue
            elif t.startswith("ビジネス短信") or JETRO_PLACE.match(t):
                continue
            out.append(t)
    return place, "\n".join(out).strip()


def jsonld(page: Node) -> Iterator[dict]:
    """Article nodes of the page's linked data, those of a graph too."""
    for n in page.find("script[type=application/ld+json]"):
        try:
            data = json.loads(n.raw())
        except ValueError:
            continue
        found = data if isinstance(data, list) else [data, *(data.get("@graph") or [])] if isinstance(data, dict) else []
        for x in found:
            if isinstance(x, dict):
                kinds = x.get("@type") or []
                kinds = {str(k).lower() for k in (kinds if isinstance(kinds, list) else [kinds])}
                if not kinds or kinds & JSONLD_TYPES:
                    yield x


def published_of(page: Node, places: tuple[str, ...]) -> str:
    """The date as the page writes it."""
    for place in places:
        found = ""
        if place == "jsonld":
            found = next((str(x[k]) for x in jsonld(page) for k in JSONLD_DATES if x.get(k)), "")
        elif place == "words":
            m = re.search(rf"\b({MONTHS})\s+\d{{1,2}},\s*\d{{4}}\b", page.text(), re.I)
            found = m[0] if m else ""
        elif (n := page.first(place)) is not None:
            found = n.attrs.get("content") or n.attrs.get("datetime") or n.text()
        if found.strip():
            return found.strip()
    return ""


def read(html: str | None, site: str) -> dict:
    rule, page = SITES[site], parse(html)
    out = {"title": title_of(page, rule.title), "published": published_of(page, rule.published), "place": ""}
    described = [clean(n.attrs.get("content", "")) for s in ("meta[property=og:description]", "meta[name=description]") if (n := page.first(s))] + [clean(str(x.get("description") or "")) for x in jsonld(page)]
    if site == "gnlm":
        body = gnlm_body(page)
    elif site == "jetro":
        out["place"], body = jetro_parts(page)
        out["title"] = re.sub(r"\s*\|.*$", "", out["title"])
    else:
        body = next((b for r in rule.bodies if (b := body_by(page, r))), "")
    if not body and rule.described:
        body = next((d for d in described if d), "")
    return out | {"body": body}


READ = T.StructType([T.StructField(n, T.StringType()) for n in ("title", "published", "place", "body")])


def article(html: Column, site: str) -> Column:
    """``struct<title, published, place, body>`` of a page by a site's rule; blank where nothing is found."""

    @F.pandas_udf(READ)
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([read(x, site) for x in s], columns=READ.names)

    return run(html)


def _first_text(selectors: tuple[str, ...]):
    @F.pandas_udf(T.StringType())
    def run(s: pd.Series) -> pd.Series:
        def one(x: str | None) -> str:
            page = parse(x)
            return next((t for q in selectors if (n := page.first(q)) is not None and (t := n.text())), "")

        return s.map(one)

    return run


def category(html: Column) -> Column:
    """The label of the category that a page names first; blank without one."""
    return _first_text(("ul.td-category li.entry-category a", "ul.td-category a"))(html)


def in_section(html: Column, names: tuple[str, ...], slugs: tuple[str, ...]) -> Column:
    """Whether a page says that it belongs to a section: by its linked data, or by a category link near its heading."""
    wanted, paths = {clean(n).lower() for n in names}, tuple(f"/category/{s}" for s in slugs)

    @F.pandas_udf(T.BooleanType())
    def run(s: pd.Series) -> pd.Series:
        def one(x: str | None) -> bool:
            page = parse(x)
            for n in jsonld(page):
                own = n.get("articleSection") or []
                if wanted & {clean(str(v)).lower() for v in (own if isinstance(own, list) else [own])}:
                    return True
            return any(p in a.attrs["href"].lower() for a in page.find("header a[href], .entry-category a[href], .post-categories a[href]") for p in paths)

        return s.map(one)

    return run(html)


def scoped_body(url: Column, html: Column) -> Column:
    """Body for full text: the domain's scopes, then general ones, then the page; without comments, tags and boilerplate."""

    @F.pandas_udf(T.StringType())
    def run(u: pd.Series, s: pd.Series) -> pd.Series:
        def one(a: str | None, x: str | None) -> str:
            a = (a or "").lower()
            own = next((v for k, v in DOMAIN_SCOPES.items() if k in a), ())
            rule = Body((*own, *SCOPES), drop=NOISE, skip=BOILERPLATE, or_page=True, breaks="gnlm.com.mm" in a)
            page = parse(x)
            for n in page.find("a"):
                if n.text().startswith("#"):
                    n.up.inner.remove(n)
            return body_by(page, rule)

        return pd.Series([one(a, x) for a, x in zip(u, s)])

    return run(url, html)


def _paragraphs(block) -> list[str]:
    """Texts of paragraphs in a tree of blocks, without lists and links; repeated neighbours once."""
    out: list[str] = []
    if isinstance(block, list):
        found = [t for x in block for t in _paragraphs(x)]
    elif isinstance(block, dict) and block.get("type") not in BBC_SKIPPED:
        model = block.get("model") if isinstance(block.get("model"), dict) else {}
        if block.get("type") == "paragraph" and model:
            found = [clean(model["text"])] if isinstance(model.get("text"), str) else []
        else:
            found = [t for x in (block, model) for k in ("blocks", "children", "items") if x.get(k) is not None for t in _paragraphs(x[k])]
    else:
        found = []
    for t in found:
        if t and (not out or out[-1] != t):
            out.append(t)
    return out


def split_page(html: str | None, prefix: str) -> list[dict]:
    """A page of several articles, from its JSON: the headline without ``prefix``, then each subheadline, with the text up to the next."""
    n = parse(html).first("script#__NEXT_DATA__")
    try:
        blocks = json.loads(n.raw())["props"]["pageProps"]["pageData"]["content"]["model"]["blocks"]
    except (AttributeError, ValueError, KeyError, TypeError):
        return []
    out, title, parts, begun = [], "", [], False

    def done() -> None:
        if title and parts:
            out.append({"title": title, "body": "\n".join(parts)})

    for b in blocks:
        kind, model = b.get("type"), b.get("model") or {}
        first = next(iter(_paragraphs(model)), "")
        if kind == "headline" and not begun:
            begun = True
            title, parts = clean(re.sub(prefix, "", first)), []
        elif kind == "subheadline":
            done()
            title, parts = first, []
        elif kind == "text" and title:
            parts += _paragraphs(model)
    done()
    return out


SPLIT = T.ArrayType(T.StructType([T.StructField("title", T.StringType()), T.StructField("body", T.StringType())]))

# Month names, and how a title says that a page is a summary of a day's news.
MM_MONTHS = "ဇန်နဝါရီ|ဖေဖော်ဝါရီ|မတ်|ဧပြီ|မေ|ဇွန်|ဇူလိုင်|ဩဂုတ်|သြဂုတ်|စက်တင်ဘာ|အောက်တိုဘာ|နိုဝင်ဘာ|ဒီဇင်ဘာ"
MM_DAY = r"[0-9၀-၉]{1,2}\s*ရက်(?:နေ့)?"
DAY_SUMMARY = rf"(?:{MM_MONTHS})\s*{MM_DAY}\s*(?:နိုင်ငံတဝန်း\s*)?သတင်း(?:များ)?\s*အနှစ်ချုပ်\s*[-–—]\s*"
MM_SUMMARY, MM_SUMMARY_END = r"သတင်း(?:များ)?အနှစ်ချုပ်", r"အနှစ်ချုပ်\s*[-–—]"


def day_summary(title: Column) -> Column:
    """Whether a title announces a summary of a day's news: in the usual form, or with month, day, the words and a dash in any spacing."""
    t = F.regexp_replace(F.coalesce(title, F.lit("")), r"(?U)\s+", " ")
    loose = F.regexp_replace(t, " ", "").rlike(MM_SUMMARY) & t.rlike(MM_MONTHS) & t.rlike(MM_DAY) & t.rlike(MM_SUMMARY_END)
    return t.rlike(DAY_SUMMARY) | loose


def split_articles(html: Column, prefix: str = r"^\s*" + DAY_SUMMARY) -> Column:
    @F.pandas_udf(SPLIT)
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: split_page(x, prefix))

    return run(html)


#: What stands behind a reader's body, in the order in which it is looked for.
READER_STOPS = ["\nRead Next\n", "\nRelated Articles\n", "\nSubscribe to our channel\n", "\nဖတ်ရှုမှုအများဆုံး\n"]


def reader_title(c: Column) -> Column:
    """Title of a text reader's payload."""
    return F.trim(F.regexp_extract(F.coalesce(c, F.lit("")), r"(?im)^\s*Title:\s*(.+?)\s*$", 1))


def reader_body(c: Column) -> Column:
    """Text behind ``Markdown Content:``, up to the first stop of the list that occurs."""
    c = F.coalesce(c, F.lit(""))
    at = F.locate("Markdown Content:", c)
    t = F.regexp_replace(F.when(at > 0, F.substring(c, at + len("Markdown Content:"), F.length(c))).otherwise(c), r"(?U)^\s+|\s+$", "")
    cut = t
    for stop in reversed(READER_STOPS):
        place = F.locate(stop, t)
        cut = F.when(place > 0, F.regexp_replace(F.substring(t, F.lit(1), place - 1), r"(?U)\s+$", "")).otherwise(cut)
    return cut
