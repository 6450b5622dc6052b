"""House terms of Japanese output: what a translation must call groups, leaders and regimes."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import SPACE, bound, nfkc, strip

#: Stands for a matched term until its form is chosen; a private-use character, so no text has it.
MARK = "\ue000"

# Sources in the official style.
OFFICIAL_SOURCES = [
    "popular myanmar",
    "popular myanmar (国軍系メディア)",
    "news eleven",
    "news eleven burmese",
    "newseleven",
    "global new light of myanmar",
    "global new light",
    "global new light of myanmar (国営紙)",
    "gnlm",
]

# Spellings of the DKBA, in the order in which they are looked for, and its forms.
DKBA_PATTERNS = [
    r"親国軍勢力\s*DKBA",
    r"国軍傘下の民主カレン仏教徒軍[（(]\s*D\.?\s*K\.?\s*B\.?\s*A\.?\s*[）)]",
    r"民主カレン仏教徒軍[（(]\s*D\.?\s*K\.?\s*B\.?\s*A\.?\s*[）)]",
    r"国軍傘下(?:の)?\s*D\.?\s*K\.?\s*B\.?\s*A\.?軍?",
    r"国軍系(?:勢力)?\s*D\.?\s*K\.?\s*B\.?\s*A\.?",
    r"D\.?\s*K\.?\s*B\.?\s*A\.?,?",
    r"ဒီမိုကရေစီ\s*အကျိုးပြု\s*ကရင်တပ်မတော်",
    r"ဒီမိုကရက်တစ်ကရင်အကျိုးပြုတပ်မတော်",
    r"ဒီမိုကရေစီ\s*ကရင်\s*တပ်မတော်",
]
DKBA_FULL, DKBA_SHORT = "親国軍勢力DKBA", "DKBA"

# What is called 国軍, in the order in which it is looked for.
ARMY_PATTERNS = [
    r"親軍政権軍",
    r"軍事政権軍",
    r"軍政軍",
    r"親軍政権部隊",
    r"軍事政権部隊",
    r"親軍政権側部隊",
    r"軍事政権側部隊",
    r"親軍政権傘下(?:の)?部隊",
    r"軍事政権傘下(?:の)?部隊",
    r"親軍政権傘下(?:の)?軍",
    r"軍事政権傘下(?:の)?軍",
    r"(?:親軍政権|軍事政権)トップ・ミンアウンフライン(?:が率いる|の率いる|率いる)(?:国軍|軍|部隊|軍部隊)",
    r"ミンアウンフライン(?:が率いる|の率いる|率いる)(?:国軍|軍|部隊|軍部隊)",
    r"大統領(?:が率いる|の率いる|率いる)(?:国軍|軍|部隊|軍部隊)",
    r"国軍の部隊",
    r"国軍部隊",
]
ARMY = "国軍"

# The regime in sources of the official style, in order, and in others.
OFFICIAL_REGIME = [
    ("軍事政権下", "政府の下"),
    ("親軍政権下", "政府の下"),
    ("軍事政権側", "政府側"),
    ("親軍政権側", "政府側"),
    ("軍事政権当局", "政府当局"),
    ("親軍政権当局", "政府当局"),
    ("軍事政権トップ", "政府トップ"),
    ("親軍政権トップ", "政府トップ"),
    ("軍事政権指導者", "政府指導者"),
    ("親軍政権指導者", "政府指導者"),
    ("軍事政権", "政府"),
    ("親軍政権", "政府"),
]
OTHER_REGIME = [("軍事政権", "親軍政権")]

# The leader's name, titles and prefixes, and the forms by style and place.
LEADER_NAME = r"(?:ミン[・･]?アウン[・･]?(?:フライン|ライン)|Min\s+Aung\s+Hlaing|မင်းအောင်လှိုင်)"
LEADER_TITLE = r"(?:氏|大統領|国家大統領|暫定大統領|国軍大統領|上級大将|大将|総司令官|国軍司令官|国軍総司令官|元国軍司令官|元国軍総司令官|国家行政評議会議長|SAC議長)?"
LEADER_PREFIX = r"(?:(?:ミャンマー)?(?:親軍政権|軍事政権|国軍|軍事委員会|SAC)(?:の)?(?:トップ|指導者|最高指導者|リーダー)(?:である|としての|の|・)?\s*)"
TITLE_BEFORE = r"(?:(?:元)?国軍(?:総)?司令官|国軍総司令官|総司令官|上級大将|大将|暫定大統領|国家大統領|大統領)\s*"
LEADER_KNOWN = [r"(?:親軍政権|軍事政権)トップ・ミンアウンフライン(?:大統領)?", r"ミンアウンフライン大統領"]
LEADER_FORMS = {
    ("official", "headline"): ("大統領", "大統領"),
    ("official", "body"): ("ミンアウンフライン大統領", "大統領"),
    ("other", "headline"): ("ミンアウンフライン", "ミンアウンフライン"),
    ("other", "body"): ("親軍政権トップ・ミンアウンフライン", "ミンアウンフライン"),
}


def source_style(source: Column) -> Column:
    """Source names for comparison: NFKC, single blanks, lower case."""
    return F.lower(F.regexp_replace(nfkc(strip(F.coalesce(source, F.lit("")))), SPACE, " "))


def official(source: Column) -> Column:
    return source_style(source).isin(*OFFICIAL_SOURCES)


def _unless_error(c: Column, of) -> Column:
    """``of`` a text; texts that report an error stay as they are."""
    return bound(c, lambda x: F.when(F.startswith(x, F.lit("ERROR:")), x).otherwise(of(x)))


def _marked(c: Column, patterns: Sequence[str]) -> Column:
    for p in patterns:
        c = F.regexp_replace(c, f"(?iuU){p}", MARK)
    return c


def _chosen(c: Column, full: str, short: str, shorten: bool) -> Column:
    """The first mark becomes the full form; later ones the short form, if they are shortened."""
    if not shorten:
        return F.replace(c, F.lit(MARK), F.lit(full))
    at = F.instr(c, MARK)
    head, tail = F.substring(c, F.lit(1), at), F.substring(c, at + 1, F.length(c))
    return F.when(at > 0, F.concat(F.replace(head, F.lit(MARK), F.lit(full)), F.replace(tail, F.lit(MARK), F.lit(short)))).otherwise(c)


def dkba(c: Column, shorten: bool = False) -> Column:
    return _unless_error(c, lambda x: bound(_marked(x, DKBA_PATTERNS), lambda m: _chosen(m, DKBA_FULL, DKBA_SHORT, shorten)))


def army(c: Column) -> Column:
    def of(x: Column) -> Column:
        for p in ARMY_PATTERNS:
            x = F.regexp_replace(x, p, ARMY)
        return x

    return _unless_error(c, of)


def _regime(c: Column, style: str) -> Column:
    for a, b in OFFICIAL_REGIME if style == "official" else OTHER_REGIME:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _leader(c: Column, style: str, headline: bool) -> Column:
    full, short = LEADER_FORMS[style, "headline" if headline else "body"]

    def of(x: Column) -> Column:
        for p in LEADER_KNOWN:
            x = F.regexp_replace(x, p, MARK)
        marked = _marked(x, [LEADER_PREFIX + LEADER_NAME + LEADER_TITLE, TITLE_BEFORE + LEADER_NAME + LEADER_TITLE, LEADER_NAME + LEADER_TITLE])
        return bound(marked, lambda m: _chosen(m, full, short, shorten=not headline))

    return _unless_error(c, of)


def _by_style(source: Column, of) -> Column:
    return F.when(official(source), of("official")).otherwise(of("other"))


def regime(c: Column, source: Column) -> Column:
    return _by_style(source, lambda style: _regime(c, style))


def leader(c: Column, source: Column, headline: bool = False) -> Column:
    return _by_style(source, lambda style: _leader(c, style, headline))


def house_terms(c: Column, source: Column, headline: bool = False) -> Column:
    """All rules in their order: DKBA, leader, army, regime."""
    return _by_style(source, lambda style: _unless_error(c, lambda x: _regime(army(_leader(dkba(x, shorten=not headline), style, headline)), style)))


def without_current_year(c: Column, year: int) -> Column:
    """``2026年05月９日`` to ``5月9日`` for the given year; other years stay."""
    digits = str.maketrans("０１２３４５６７８９", "0123456789")
    day = re.compile(rf"{year}年([0-9０-９]{{1,2}})月(?:([0-9０-９]{{1,2}})日)?")

    def plain(m: re.Match) -> str:
        month, d = (None if g is None else int(g.translate(digits)) for g in m.groups())
        return f"{month}月" + ("" if d is None else f"{d}日")

    @F.pandas_udf(T.StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: x if x.startswith("ERROR:") else day.sub(plain, x), na_action="ignore")

    return run(c)


def apply_entries(c: Column, entries: Column) -> Column:
    """Glossary entries in output, one after another; ``entries`` are a row's own, ``array<struct<mm, en, ja>>`` in order.

    ``en`` is replaced where no Latin letter stands beside it.
    """

    @F.pandas_udf(T.StringType())
    def run(out: pd.Series, entries: pd.Series) -> pd.Series:
        def one(t: str | None, own) -> str:
            t = t or ""
            for e in own if own is not None else ():
                if e["en"]:
                    t = re.sub(rf"(?<![A-Za-z]){re.escape(e['en'])}(?![A-Za-z])", lambda _: e["ja"], t)  # noqa: B023
                if e["mm"]:
                    t = t.replace(e["mm"], e["ja"])
            return t

        return pd.Series([one(t, e) for t, e in zip(out, entries)])

    return run(c, entries)


def without_phrases(c: Column, phrases: Sequence[str]) -> Column:
    """Noise phrases, given as patterns, are taken out."""
    for p in phrases:
        c = F.regexp_replace(c, f"(?iu){p}", "")
    return strip(c)
