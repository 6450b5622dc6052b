"""Queries over fixed list and page payloads: collectors, extraction by site, list scans, archives and glossaries.

No table holds what sites return, so the payloads are written out here, and the
SQL is the rows that must come out, worked out by hand from the rules.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sites, urls
from ..session import shared_folder
from ..sources import archives, collectors, scans, sheets
from .registry import fixture, literal, query, table

DAY = "2026-05-09"
_META = '<meta property="article:published_time" content="{}">'
_ON, _OFF = "2026-05-09T10:00:00+06:30", "2026-05-08T10:00:00+06:30"


def _rss(*items: tuple[str, str, str]) -> str:
    return "<rss><channel>" + "".join(f"<item><title>{t}</title><link>{u}</link><pubDate>{d}</pubDate></item>" for t, u, d in items) + "</channel></rss>"


def _posts(*items: tuple[str, str, str]) -> str:
    return "[" + ",".join(f'{{"id": {i}, "title": {{"rendered": "{t}"}}, "link": "{u}", "date": "{d}"}}' for i, (t, u, d) in enumerate(items)) + "]"


def _page(body: str, date: str = _ON, title: str = "") -> str:
    return f"<html><head>{_META.format(date) if date else ''}</head><body>{f'<h1>{title}</h1>' if title else ''}{body}</body></html>"


def _entry(text: str, cls: str = "entry-content") -> str:
    return f'<div class="{cls}"><p>{text}</p></div>'


_NEXT = ('<script id="__NEXT_DATA__">{"props": {"pageProps": {"pageData": {"content": {"model": {"blocks": ['
         '{"type": "headline", "model": {"blocks": [{"type": "paragraph", "model": {"text": "မေ ၉ ရက် သတင်းအနှစ်ချုပ် - First"}}]}},'
         '{"type": "text", "model": {"blocks": [{"type": "paragraph", "model": {"text": "a"}}, {"type": "paragraph", "model": {"text": "a"}}, {"type": "unorderedList", "model": {"blocks": [{"type": "paragraph", "model": {"text": "link"}}]}}]}},'
         '{"type": "subheadline", "model": {"blocks": [{"type": "paragraph", "model": {"text": "Second"}}]}},'
         '{"type": "text", "model": {"blocks": [{"type": "paragraph", "model": {"text": "b"}}]}},'
         '{"type": "subheadline", "model": {"blocks": [{"type": "paragraph", "model": {"text": "No body"}}]}}]}}}}}}</script>')
_RFC, _RFC_OFF = "Sat, 09 May 2026 02:00:00 GMT", "Fri, 08 May 2026 02:00:00 GMT"

_LISTS = [
    # posts found something, so the feed of stage 2 does not count; videos and the other host are excluded
    ("Irrawaddy", 1, "https://www.irrawaddy.com/", 1, "posts", _posts(("Hinted", "https://www.irrawaddy.com/news/a.html", "2026-05-09T08:00:00"), ("V", "https://www.irrawaddy.com/video/v.html", "2026-05-09T08:00:00"),
                                                                      ("B", "https://burma.irrawaddy.com/news/b.html", "2026-05-09T08:00:00"), ("Old", "https://www.irrawaddy.com/news/old.html", "2026-05-08T08:00:00"))),
    ("Irrawaddy", 2, "https://www.irrawaddy.com/", 1, "rss", _rss(("Late", "https://www.irrawaddy.com/news/late.html", _RFC))),
    # page 2 is empty, so page 3 is not read; of two bases the one without condition frees the url
    ("Mizzima (Burmese)", 1, "https://m.example/world/", 1, "cards", '<h3 class="entry-title"><a href="/w1">W1</a></h3><h3 class="entry-title"><a href="/w2">W2</a></h3>'),
    ("Mizzima (Burmese)", 1, "https://m.example/news/", 1, "cards", '<h3 class="entry-title"><a href="/w2/">W2</a></h3><h3 class="entry-title"><a href="/photo">ဓာတ်ပုံသတင်း x</a></h3>'),
    ("Mizzima (Burmese)", 1, "https://m.example/news/", 2, "cards", "<p>nothing</p>"),
    ("Mizzima (Burmese)", 1, "https://m.example/news/", 3, "cards", '<h3 class="entry-title"><a href="/behind">Behind</a></h3>'),
    ("BBC Burmese", 1, "https://b.example/", 1, "rss", _rss(("မေ ၉ ရက် သတင်းအနှစ်ချုပ် - First", "https://b.example/day", _RFC), ("Plain", "https://b.example/plain", _RFC), ("Old", "https://b.example/old", _RFC_OFF))),
    ("Khit Thit Media", 1, "https://k.example/", 1, "cards", '<p class="entry-title td-module-title"><a href="/k1">K1</a></p><p class="entry-title td-module-title"><a href="/k2">K2</a></p>'),
    ("DVB", 1, "https://d.example/", 1, "cards", '<div class="listing_content"><a href="/p/1"><h5>D one</h5></a><div class="text-gray-500">May 9, 2026</div></div><div class="listing_content"><a href="/p/2"><h5>D two</h5></a><div class="text-gray-500">May 8, 2026</div></div>'
     '<div class="listing_content"><a href="/p/3"><h5>D three</h5></a><div class="text-gray-500">May 9, 2026</div></div>'),
    ("Myanmar Now", 1, "https://n.example/", 1, "cards", '<li class="post-item"><h2><a href="/mm/1">N one</a></h2><span class="date">May 9, 2026</span></li>'),
    # both stages count; an e-paper day, a pdf and a category are no articles
    ("GNLM", 1, "https://www.gnlm.com.mm/", 1, "rss", _rss(("G one | Global New Light Of Myanmar", "https://www.gnlm.com.mm/g-one/", _RFC), ("E", "https://www.gnlm.com.mm/9-may-2026/", _RFC))),
    ("GNLM", 2, "https://www.gnlm.com.mm/", 1, "cards", '<h2 class="entry-title"><a href="/g-two/">G two</a></h2><h2 class="entry-title"><a href="/x.pdf">P</a></h2><h2 class="entry-title"><a href="/category/n/">C</a></h2><h2 class="entry-title"><a href="https://other.example/g/">O</a></h2>'),
    ("Popular Myanmar", 1, "https://p.example/", 1, "rss", _rss(("P one", "https://p.example/one", _RFC))),
    ("Frontier Myanmar", 1, "https://www.frontiermyanmar.net/", 1, "rss", _rss(("F one", "https://www.frontiermyanmar.net/en/f-one/", _RFC), ("Pod", "https://www.frontiermyanmar.net/en/category/whim/x", _RFC), ("Login", "https://www.frontiermyanmar.net/en/login/", _RFC))),
    ("JETRO", 1, "https://j.example/biznews/", 1, "cards", '<ul><li><a href="2026/05/a.html">短信</a></li></ul>'),
    ("News Eleven", 1, "https://e.example/", 1, "cards", '<div class="frontpage-title"><a href="/article/1">E one</a></div>'),
    ("Nobody", 1, "https://x.example/", 1, "rss", "not a feed"),
]
_FETCHES = [
    ("https://www.irrawaddy.com/news/a.html", 1, 1, 200, "<title>Just a moment</title>"),  # a block page; the second stage counts
    ("https://www.irrawaddy.com/news/a.html", 2, 1, 200, _page('<div class="content-inner"><p>I body</p><div class="widget"><p>ad</p></div></div>', "", "I one")),
    ("https://www.irrawaddy.com/news/old.html", 1, 1, 200, _page('<div class="content-inner"><p>x</p></div>', _OFF, "Old")),
    ("https://m.example/w1", 1, 1, 200, _page(_entry("about something"), title="W1")),
    ("https://m.example/w2", 1, 1, 200, _page(_entry("about something"), title="W2")),
    ("https://m.example/photo", 1, 1, 200, _page(_entry("x"), title="ဓာတ်ပုံသတင်း x")),
    ("https://b.example/day", 1, 1, 200, _page(_NEXT, "", "မေ ၉ ရက် သတင်းအနှစ်ချုပ် - First")),
    ("https://b.example/plain", 1, 1, 500, "error"),
    ("https://k.example/k1", 1, 1, 200, _page(_entry("#tag word #more", "td-post-content"), title="K1")),
    ("https://k.example/k2", 1, 1, 200, _page("", title="K2")),
    ("https://d.example/p/1", 1, 1, 200, _page('<div class="full_content"><p>D body</p></div>', "", "D one")),
    ("https://d.example/p/3", 1, 1, 200, _page("", "", "D three")),
    ("https://n.example/mm/1", 1, 1, 200, _page('<div class="entry-content"><p>N a</p><p>N a</p><p>N b</p><div class="related-posts"><p>no</p></div></div>', "", "N one")),
    ("https://www.gnlm.com.mm/g-one", 1, 1, 200, _page('<div class="entry-content"><h3>Lead</h3><p>G<br>body</p><div class="sharing">x</div><p>after</p></div>', _ON, "G one - Global New Light Of Myanmar")),
    ("https://www.gnlm.com.mm/g-two", 1, 1, 200, _page(_entry("two"), _ON, "G two")),
    ("https://p.example/one", 1, 1, 200, _page(_entry("P body", "td-post-content"), title="P one")),
    ("https://www.frontiermyanmar.net/en/f-one", 1, 1, 200, '<script type="application/ld+json">{"@graph": [{"@type": "NewsArticle", "datePublished": "2026-05-09T01:00:00+00:00", "description": "F lead"}]}</script><h1>F one</h1><p>Account Required</p>'),
    ("https://j.example/biznews/2026/05/a.html", 1, 1, 200, '<meta name="jetro-publicize_date" content="2026年5月9日"><div id="mainArea"><h1>題</h1><p>（ミャンマー）</p><div class="elem_paragraph wzg"><p>本文</p><p class="noindent">（注）注</p><p class="noindent">他</p></div></div>'),
    ("https://e.example/article/1", 1, 1, 200, '<meta property="og:title" content="E one"><div class="news-detail-date-author-info-date"><span class="date-display-single" content="2026-05-09T08:00:00">May</span></div><div class="node-content"><span>s1</span><span>s1</span><span>s2</span></div>'),
]
_KEY = "https://b.example/day#bbc-title-"
_ARTICLES = [
    ("Irrawaddy", "I one", "https://www.irrawaddy.com/news/a.html", DAY, "I body", "https://www.irrawaddy.com/news/a.html"),
    ("Mizzima (Burmese)", "W2", "https://m.example/w2", DAY, "about something", "https://m.example/w2"),
    ("BBC Burmese", "First", "https://b.example/day", DAY, "a", _KEY + "First"),
    ("BBC Burmese", "Second", "https://b.example/day", DAY, "b", _KEY + "Second"),
    ("BBC Burmese", "Plain", "https://b.example/plain", DAY, "", "https://b.example/plain"),
    ("Khit Thit Media", "K1", "https://k.example/k1", DAY, "word", "https://k.example/k1"),
    ("Khit Thit Media", "K2", "https://k.example/k2", DAY, "", "https://k.example/k2"),
    ("DVB", "D one", "https://d.example/p/1", DAY, "D body", "https://d.example/p/1"),
    ("Myanmar Now", "N one", "https://n.example/mm/1", DAY, "N a\n\nN b", "https://n.example/mm/1"),
    ("GNLM", "G one", "https://www.gnlm.com.mm/g-one", DAY, "Lead\nG\nbody", "https://www.gnlm.com.mm/g-one"),
    ("GNLM", "G two", "https://www.gnlm.com.mm/g-two", DAY, "two", "https://www.gnlm.com.mm/g-two"),
    ("Popular Myanmar", "P one", "https://p.example/one", DAY, "P body", "https://p.example/one"),
    ("Frontier Myanmar", "F one", "https://www.frontiermyanmar.net/en/f-one", DAY, "F lead", "https://www.frontiermyanmar.net/en/f-one"),
    ("JETRO", "題（ミャンマー）", "https://j.example/biznews/2026/05/a.html", DAY, "本文\n（注）注", "https://j.example/biznews/2026/05/a.html"),
    ("News Eleven", "E one", "https://e.example/article/1", DAY, "s1\ns2", "https://e.example/article/1"),
]
_COLUMNS = "source VARCHAR, title VARCHAR, url VARCHAR, date DATE, body VARCHAR, row_key VARCHAR"
_AS_KEYS = "SELECT * REPLACE (CASE WHEN contains(row_key, '#bbc-title-') THEN split_part(row_key, '#bbc-title-', 1) || '#bbc-title-' || substr(sha1(title), 1, 16) ELSE row_key END AS row_key) FROM "


def payloads(spark):
    return spark.createDataFrame(_LISTS, collectors.LIST_SCHEMA), spark.createDataFrame(_FETCHES, collectors.FETCH_SCHEMA)


@fixture(_AS_KEYS + f"({literal(_COLUMNS, _ARTICLES)})")
def collect_articles(spark, sf_dir):
    """All collectors at a slot of the gated ones; a source that is no collector gives nothing."""
    gated = {"Irrawaddy": {"0 6 * * *"}, "GNLM": {"0 6 * * *"}}
    return collectors.collect(*payloads(spark), DAY, collectors.plan("0 6 * * *", None, gated))


@fixture(literal("source VARCHAR, n BIGINT", [("DVB", 1)]))
def collect_one_source(spark, sf_dir):
    """The single-source plan: a name in any case, and a gated source without a slot is left out."""
    one = collectors.plan(None, " dvb ", {"Irrawaddy": {"0 6 * * *"}}) + collectors.plan(None, "Irrawaddy", {"Irrawaddy": {"0 6 * * *"}})
    return collectors.collect(*payloads(spark), DAY, one).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@fixture(literal("source VARCHAR, title VARCHAR", [("Mizzima (Burmese)", "W2"), ("DVB", "D one")]))
def collect_keyword_hits(spark, sf_dir):
    """The keyword-filtered collectors: articles with a word of the list in title or body."""
    from dataclasses import replace

    chosen = [replace(collectors.COLLECTORS[s], keywords=("something", "D body")) for s in collectors.LEGACY]
    return collectors.collect(*payloads(spark), DAY, chosen).select("source", "title")


@fixture(literal("reason VARCHAR, n BIGINT, main BOOLEAN", [("accepted", 1, True), ("keyword_miss", 1, False), ("excluded_title", 1, False)]))
def collect_reasons(spark, sf_dir):
    """First failing rule of each candidate, and the leading one; of equal counts the first of the chain, accepted at the end but for the tie here."""
    j = collectors.judged(*payloads(spark), [collectors.COLLECTORS["Mizzima (Burmese)"]], DAY)
    n = j.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("main", F.col("reason") == "accepted")


_PAGES = [
    (1, "generic", '<h1 class="entry-title">T</h1><article><p>a</p><p> </p><p>b</p></article>', "T", "", "a\nb"),
    (2, "generic", "<title>Only</title><p>x<p>y", "Only", "", "x\ny"),
    (3, "bbc", '<meta property="og:title" content="OG"><main role="main"><aside><p>no</p></aside><section aria-labelledby="article-byline"><p>by</p></section><p>yes</p></main>', "OG", "", "yes"),
    (4, "irrawaddy", '<h1 class="jeg_post_title">J</h1><div class="content-inner"><p>a</p><div class="jeg_postblock_21"><p>n</p></div></div><div class="content-inner"><p>b</p></div>', "J", "", "a\nb"),
    (5, "mizzima", '<div class="entry-content"><p>a</p><div class="tags"><p>t</p></div><h2>Related Posts</h2><p>z</p></div>', "", "", "a"),
    (6, "myanmar_now", '<article><p>a</p><p>a</p><p>b</p><p>ပံ့ပိုးကူညီပေးပါ x</p><h3>Read Next</h3><p>z</p></article>', "", "", "a\n\nb"),
    (7, "gnlm", '<div class="entry-content"><div>A block of plain words that is longer than forty characters.</div><h3>Lead</h3><p>p</p><h3>Related posts:</h3><p>z</p></div>', "", "", "Lead\np\nA block of plain words that is longer than forty characters."),
    (8, "frontier", '<h1>F</h1><div class="post-content-single"><p>a</p><div class="pmpro_card"><p>pay</p></div><p>Create Account</p><ul><li>b</li></ul></div><time>May 9, 2026</time>', "F", "May 9, 2026", "a\nb"),
    (9, "frontier", '<meta name="description" content="D"><p>Already a member? Log in</p>', "", "", "D"),
    (10, "eleven", '<title>E | Eleven Media Group Co., Ltd</title><div class="node-content"><div class="field-item"><p>a</p><p>a</p><p>b</p></div></div>', "E", "", "a\nb"),
    (11, "jetro", '<meta name="jetro-publicize_date" content="2026-05-09"><main><h1>題</h1><p>（ミャンマー）</p><p>ビジネス短信</p><p>本文</p></main>', "題", "2026-05-09", "本文"),
    (12, "dvb", '<h1>D</h1><div class="full_content"><p>a</p></div><p>z</p>', "D", "", "a"),
    (13, "ladder", None, "", "", ""),
    (14, "popular", '<div class="td-post-content"><p>a</p><p>#a #b #c</p><nav><p>n</p></nav></div>', "", "", "a"),
]


@fixture(literal("id INTEGER, title VARCHAR, published VARCHAR, body VARCHAR", [(r[0], *r[3:]) for r in _PAGES]))
def extract_by_site(spark, sf_dir):
    rows = spark.createDataFrame([r[:3] for r in _PAGES], "id int, site string, html string")
    out = None
    for site in sorted({r[1] for r in _PAGES}):
        a = rows.filter(F.col("site") == site).select("id", sites.article(F.col("html"), site).alias("a")).select("id", "a.title", "a.published", "a.body")
        out = a if out is None else out.unionByName(a)
    return out


_SCOPED = [
    (1, "https://www.dvb.no/x", '<article><p>other</p></article><div class="node-content"><p>a <a href="/t">#tag</a></p><form><p>f</p></form><p>Save my name, email, and website in this browser</p></div>', "a"),
    (2, "https://www.gnlm.com.mm/x", '<div class="entry-content"><p>a<br>b  c</p></div>', "a\nb c"),
    (3, "https://x.example/", "<p>a</p><p>#x #y #z</p>", "a"),
    (4, None, None, ""),
]


@fixture(literal("id INTEGER, body VARCHAR", [(r[0], r[3]) for r in _SCOPED]))
def scoped_bodies(spark, sf_dir):
    return spark.createDataFrame([r[:3] for r in _SCOPED], "id int, url string, html string").select("id", sites.scoped_body(F.col("url"), F.col("html")).alias("body"))


_READER = [
    (1, "Title: T one\nURL Source: u\nMarkdown Content:\nbody\n\nRelated Articles\nx\nRead Next\ny", "T one", "body\n\nRelated Articles\nx"),
    (2, "no header", "", "no header"),
    (3, None, "", ""),
]


@fixture(literal("id INTEGER, title VARCHAR, body VARCHAR", [(r[0], *r[2:]) for r in _READER]))
def reader_payloads(spark, sf_dir):
    """The first stop of the list that occurs ends the body, wherever an earlier place has another."""
    r = spark.createDataFrame([r[:2] for r in _READER], "id int, t string")
    return r.select("id", sites.reader_title(F.col("t")).alias("title"), sites.reader_body(F.col("t")).alias("body"))


_SUMMARIES = [(1, "မေ ၉ ရက် သတင်းအနှစ်ချုပ် - x", True), (2, "မေ 9 ရက်နေ့ နိုင်ငံတဝန်း သတင်းများ အနှစ်ချုပ် – x", True), (3, "မေ ၉ ရက် သတင်း - x", False), (4, "သတင်းအနှစ်ချုပ် - x", False), (5, None, False)]


@fixture(literal("id INTEGER, summary BOOLEAN", [(r[0], r[2]) for r in _SUMMARIES]))
def day_summary_titles(spark, sf_dir):
    return spark.createDataFrame([r[:2] for r in _SUMMARIES], "id int, t string").select("id", sites.day_summary(F.col("t")).alias("summary"))


_NEWS = [
    (1, "https://news.google.com/rss/articles/CBMiHWh0dHBzOi8vd3d3LmlycmF3YWRkeS5jb20vYS8x", None, "https://www.irrawaddy.com/a/1"),
    (2, "https://news.google.com/rss/articles/AAAA", "https://www.irrawaddy.com/b/2", "https://www.irrawaddy.com/b/2"),
    (3, "https://www.irrawaddy.com/direct", None, "https://www.irrawaddy.com/direct"),
    (4, "https://other.example/x", None, ""),
    (5, "https://news.google.com/rss/articles/AAAA", None, ""),
    (6, None, None, ""),
]


@fixture(literal("id INTEGER, url VARCHAR", [(r[0], r[3]) for r in _NEWS]))
def aggregator_links(spark, sf_dir):
    """An aggregator's link by its token, else by where it leads; only the publisher's host counts."""
    r = spark.createDataFrame([r[:3] for r in _NEWS], "id int, link string, final string")
    return r.select("id", urls.publisher_link(F.col("link"), F.col("final"), "irrawaddy.com").alias("url"))


_FRONTIER = [(1, "view-source:https://www.frontiermyanmar.net/en//a-b?x=1#y", "https://www.frontiermyanmar.net/en/a-b/"), (2, "/en/a", "https://www.frontiermyanmar.net/en/a/"), (3, "https://x.example/en/a", ""), (4, "https://www.frontiermyanmar.net/my/a", ""), (5, "", ""), (6, None, "")]


@fixture(literal("id INTEGER, url VARCHAR", [(r[0], r[2]) for r in _FRONTIER]))
def section_urls(spark, sf_dir):
    r = spark.createDataFrame([r[:2] for r in _FRONTIER], "id int, u string")
    return r.select("id", urls.canonical_in(F.col("u"), "https://www.frontiermyanmar.net", "/en/").alias("url"))


_PDF = [("2026-05-09", u) for u in ("https://x.example/9-may-2026.pdf", "https://x.example/09-may-2026.pdf", "https://x.example/9-May-2026.pdf", "https://x.example/09-May-2026.pdf", "https://x.example/9-may-26.pdf", "https://x.example/09-may-26.pdf", "https://x.example/9-May-26.pdf", "https://x.example/09-May-26.pdf")]


@fixture(literal("day DATE, url VARCHAR", _PDF))
def guessed_files(spark, sf_dir):
    """All spellings of a day in a file's address, each once."""
    d = spark.createDataFrame([("2026-05-09",)], "d string").select(F.to_date("d").alias("day"))
    return scans.dated_urls(d, "https://x.example/", ".pdf").select("day", "url")


_FEEDS = [("a", 1, "x"), ("a", 2, ""), ("a", 3, "z"), ("b", 1, "y"), ("b", 2, "w")]


@fixture(literal("base VARCHAR, page INTEGER", [("a", 1), ("b", 1), ("b", 2)]))
def paged_scan(spark, sf_dir):
    return scans.until_empty(spark.createDataFrame(_FEEDS, "base string, page int, body string"), "base", "page", F.col("body") == "").select("base", "page")


_AJAX = [("u", 1, '{"items": [{"t": "a"}, {"t": "b"}], "total": 3}'), ("u", 2, '{"items": [{"t": "c"}]}'), ("u", 3, "<html>"), ("u", 4, '{"items": [{"t": "d"}]}')]


@fixture(literal("ordinal BIGINT, t VARCHAR", [(0, "a"), (1, "b"), (30, "c")]))
def ajax_pages(spark, sf_dir):
    """Pages of 30 by offset; the first that is no JSON ends the scan."""
    return scans.json_pages(spark.createDataFrame(_AJAX, "base string, page int, body string"), "t string", 30).select("ordinal", "t")


_COLUMNS_HTML = '<div data-id="top"><a href="/1">One</a></div><div data-id="side"><a href="/2">Two</a></div><div data-id="top"><a href="/3">Three</a><a href="/1">One</a></div>'


@fixture(literal("pos INTEGER, link VARCHAR", [(0, "/1"), (1, "/3")]))
def column_scan(spark, sf_dir):
    d = spark.createDataFrame([(_COLUMNS_HTML,)], "html string")
    return d.select(F.posexplode(scans.links_in(F.col("html"), "[data-id=top]")).alias("pos", "link"))


_LD = [(1, '<script type="application/ld+json">{"@graph": [{"@type": "WebSite", "name": "s"}, {"@type": ["NewsArticle"], "headline": "h", "datePublished": "d"}, {"headline": "untyped"}]}</script>'), (2, '<script type="application/ld+json">{bad</script>'), (3, None)]


@fixture(literal("id INTEGER, headline VARCHAR, published VARCHAR", [(1, None, None), (1, "h", "d"), (1, "untyped", None)]))
def linked_data(spark, sf_dir):
    """Of a graph, articles and nodes without a type; the graph's own object has none."""
    return scans.linked_data(spark.createDataFrame(_LD, "id int, html string"), "html").select("id", "headline", "published")


_FILES = [("prod_2026-04", "s", False), ("prod_2026-05", "s", False), ("dev_2026-05", "s", False), ("archive_prod_2026-05", "s", False), ("prod_old", "s", True), ("prod_doc", "d", False)]


@fixture(literal("name VARCHAR", [("prod_2026-04",), ("prod_2026-05",)]))
def archive_files(spark, sf_dir):
    f = spark.createDataFrame(_FILES, "name string, kind string, trashed boolean")
    return archives.archive_files(f, "s").select("name")


@query("SELECT (o_orderdate::DATE)::VARCHAR AS day, count(*) AS n, sum(o_orderkey)::BIGINT AS keys, count(*) FILTER (WHERE o_totalprice >= 100000) AS large, 0::BIGINT AS errors FROM orders GROUP BY 1"
       " UNION ALL SELECT 'unread', 0, NULL, 0, 1")
def archive_union(spark, sf_dir):
    """All orders as sheets by month, read by the sheet source: files of another prefix are not opened, one that can't be read is counted."""
    folder = shared_folder(spark, "sheets")
    month = F.concat(F.lit(archives.ARCHIVE_PREFIX), F.date_format("o_orderdate", "yyyy-MM"), F.lit("_"), F.expr("CAST(o_orderkey div 500000 AS STRING)"))
    rows = table(spark, sf_dir, "orders").select(month.alias("sheet"), "o_orderkey", F.to_date("o_orderdate").cast("string").alias("day"), "o_totalprice", F.lit(None).cast("string").alias("blank"))
    both = rows.unionByName(rows.withColumn("sheet", F.regexp_replace("sheet", "^prod_", "dev_")))
    sheets.write_sheets(both, "sheet", "o_orderkey", ["day", "o_orderkey", "blank", "o_totalprice"], folder)
    spark.range(1).select(F.lit('{"values": [["day"], ["cut of').alias("value"), F.lit("prod_broken").alias("sheet")).write.mode("append").partitionBy("sheet").text(folder)
    read = sheets.read_sheets(spark, folder, prefix=archives.ARCHIVE_PREFIX)
    at = lambda i: F.get("cells", F.lit(i))
    large = (at(3).cast("double") >= 100_000) & (F.get("kinds", F.lit(3)) == "number")
    day = F.when(F.col("error").isNull(), at(0)).otherwise("unread")
    return read.groupBy(day.alias("day")).agg(F.count("row_index").alias("n"), F.sum(at(1).cast("long")).alias("keys"), F.count_if(F.coalesce(large, F.lit(False))).alias("large"), F.count("error").alias("errors"))


@fixture(literal("target VARCHAR, sheet VARCHAR, n BIGINT", [("prod", "archive_prod", 1), ("dev", "archive_dev", 0)]))
def adopted_archive(spark, sf_dir):
    """Adopted rows of the archive that belongs to a sheet; a missing archive is empty."""
    rows = spark.createDataFrame([("archive_prod", 1, "a"), ("archive_prod", 2, "A"), ("archive_prod", 3, "")], "sheet string, row int, k string")
    out = None
    for target in ("prod", "dev"):
        own = archives.adopted(rows, target, exact=True).agg(F.count(F.lit(1)).alias("n")).select(F.lit(target).alias("target"), F.lit(archives.archive_of(target)).alias("sheet"), "n")
        out = own if out is None else out.unionByName(own)
    return out


_TERM_ROWS = [("mm", "en", "body", "title"), ("က", "", "か", ""), ("", "b ", "ビー", "B"), ("", "", "x", "y"), (None, None, None, "z")]


@fixture(literal("mm VARCHAR, en VARCHAR, body_ja VARCHAR, title_ja VARCHAR, ja VARCHAR", [("က", "", "か", "", "か"), ("", "b", "ビー", "B", "B")]))
def term_glossary(spark, sf_dir):
    return archives.glossary(spark.createDataFrame(_TERM_ROWS[1:], "a string, b string, c string, d string"))


@fixture(literal("mm VARCHAR, en VARCHAR, body_ja VARCHAR, title_ja VARCHAR, ja VARCHAR", [("က", "", "か", "", "か"), ("", "b", "ビー", "B", "B"), ("", "", "x", "y", "y"), ("", "", "", "z", "z")]))
def region_glossary(spark, sf_dir):
    return archives.glossary(spark.createDataFrame(_TERM_ROWS[1:], "a string, b string, c string, d string"), any_cell=True)


_SHEET = [(1, "2026-05-09", "b", "", "70"), (2, "2026-05-09", "c", "", ""), (3, "", "d", "", ""), (4, "2026-05-09", "", "", " ")]


@fixture(literal("row INTEGER, usable BOOLEAN, pending BOOLEAN", [(1, True, False), (2, True, True), (3, True, False), (4, False, True)]))
def pending_rows(spark, sf_dir):
    """Usable rows have text; pending ones a day and no final score."""
    r = spark.createDataFrame(_SHEET, "row int, a string, full_text string, b string, aa string")
    return r.select("row", archives.usable(F.col("full_text")).alias("usable"), archives.pending(F.col("a"), F.col("aa")).alias("pending"))


_TRIES = [("u", 1, ""), ("u", 2, "ပ"), ("u", 3, "late"), ("v", 1, " "), ("w", 1, None)]


@fixture(literal("url VARCHAR, body VARCHAR", [("u", "ပ"), ("v", ""), ("w", "")]))
def refetched_bodies(spark, sf_dir):
    """The first attempt whose body is not blank; blank where none is."""
    return scans.first_body(spark.createDataFrame(_TRIES, "url string, attempt int, body string"), "url")


@fixture(literal("id INTEGER, title VARCHAR", [(1, "oembed"), (2, "page"), (3, None)]))
def oembed_titles(spark, sf_dir):
    a = spark.createDataFrame([(1, "u1", None), (2, "u2", "page"), (3, "u3", "")], "id int, url string, title string")
    o = spark.createDataFrame([("u1", '{"title": "oembed"}'), ("u2", '{"title": "other"}'), ("u3", "bad")], "url string, body string")
    return scans.with_oembed(a, o).select("id", "title")


@fixture(literal("source VARCHAR, key VARCHAR", [("bbc burmese", "BBC"), ("DVB", "DVB"), ("Unknown", None)]))
def source_keys(spark, sf_dir):
    from ..functions import terminology

    names = {"bbc": "BBC", "bbc burmese": "BBC", "dvb": "DVB"}
    s = spark.createDataFrame([("bbc burmese",), ("DVB",), ("Unknown",)], "source string")
    m = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return s.select("source", F.try_element_at(m, terminology.source_style(F.col("source"))).alias("key"))
