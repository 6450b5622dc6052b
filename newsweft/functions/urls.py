"""URL functions on Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import squeeze, strip

_URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)"


def authority(u: Column) -> Column:
    return F.regexp_extract(u, _URL, 2)


def host(u: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(authority(u), r"^.*@", ""), r":\d*$", ""))


def path(u: Column) -> Column:
    return F.regexp_extract(u, _URL, 3)


def canonical(u: Column) -> Column:
    """Without query, fragment and trailing slashes."""
    u = strip(u)
    return F.when(u.rlike(_URL), F.concat(F.regexp_extract(u, _URL, 1), F.lit("://"), authority(u), F.regexp_replace(path(u), "/+$", ""))).otherwise(
        F.regexp_replace(F.regexp_replace(u, r"[?#].*$", ""), "/+$", ""))


def canonical_slash(u: Column) -> Column:
    """Lower-case host, single slashes, one at the end."""
    u = F.regexp_replace(strip(u), r"^view-source:", "")
    return F.concat(F.lower(F.regexp_extract(u, _URL, 1)), F.lit("://"), host(u), F.regexp_replace(F.concat(path(u), F.lit("/")), "/{2,}", "/"))


def key(u: Column) -> Column:
    """Stripped, cut at the fragment, without trailing slashes."""
    return F.regexp_replace(F.substring_index(strip(u), "#", 1), "/+$", "")


def slug_title(u: Column) -> Column:
    """Title from the last path segment."""
    last = F.regexp_extract(F.regexp_replace(path(u), "/+$", ""), r"([^/]*)$", 1)
    return F.initcap(squeeze(F.regexp_replace(F.coalesce(F.try_url_decode(F.regexp_replace(last, r"(?i)\.html?$", "")), last), "[-_]+", " ")))


def row_key(base: Column, title: Column, mark: str = "title") -> Column:
    """Stable key of one of several articles on a page."""
    return F.concat(canonical(base), F.lit(f"#{mark}-"), F.substring(F.sha1(title), 1, 16))


def article_shaped(u: Column, least: int = 2) -> Column:
    """A page of its own: at least so many path segments and no listing segment."""
    n = F.size(F.filter(F.split(path(u), "/"), lambda x: x != ""))
    return (n >= least) & ~path(u).rlike(r"(?i)/(category|tag|author|page|feed)(/|$)")


def excluded(u: Column, prefixes: list[str], hosts: list[str] = ()) -> Column:
    p = F.lower(path(u))
    hit = F.lit(False)
    for x in prefixes:
        hit = hit | F.startswith(p, F.lit(x))
    return hit | host(u).isin(*hosts) if hosts else hit


def absolute(base: Column, link: Column) -> Column:
    """A link on a page: absolute, protocol-relative, from the root, or beside the page."""
    root = F.concat(F.regexp_extract(base, _URL, 1), F.lit("://"), authority(base))
    return (F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
            .when(F.startswith(link, F.lit("//")), F.concat(F.regexp_extract(base, _URL, 1), F.lit(":"), link))
            .when(F.startswith(link, F.lit("/")), F.concat(root, link))
            .otherwise(F.concat(root, F.regexp_replace(path(base), "[^/]*$", ""), link)))


def amp(u: Column) -> Column:
    return F.concat(canonical(u), F.lit("/amp/"))


def publisher_link(link: Column, final: Column, host_end: str) -> Column:
    """A publisher's address behind an aggregator's link: from the address in its token, else ``final``, where the link leads; blank if another host's.

    A link that is no aggregator's is taken as it is.
    """
    link = F.coalesce(link, F.lit(""))
    token = F.regexp_extract(link, r"/articles/([^/?#]+)", 1)
    padded = F.rpad(F.translate(token, "-_", "+/"), F.ceil(F.length(token) / 4).cast("int") * 4, F.lit("="))
    inside = F.regexp_extract(F.decode(F.try_to_binary(padded, F.lit("base64")), "ISO-8859-1"), r"""(https?://[^\s"'<>\x00-\x1f\x7f-\xff]+)""", 1)
    direct = F.when(F.contains(host(link), F.lit("news.google.com")), F.coalesce(F.when(inside != "", inside), final, F.lit(""))).otherwise(link)
    return F.when(F.endswith(host(direct), F.lit(host_end)), direct).otherwise("")


def canonical_in(u: Column, base: str, section: str) -> Column:
    """An address of one section of a site: of its host, single slashes, one at the end, no query; blank if it lies elsewhere."""
    u = F.regexp_replace(strip(F.coalesce(u, F.lit(""))), r"^view-source:\s*", "")
    u = F.when(F.startswith(u, F.lit("/")), F.concat(F.lit(base), u)).otherwise(u)
    clean = canonical_slash(u)
    bare = base.split("://")[1].removeprefix("www.")
    return F.when(F.endswith(host(u), F.lit(bare)) & F.startswith(path(clean), F.lit(section)), clean).otherwise("")
