"""Text functions on Columns. ``(?U)`` makes Java's classes Unicode-aware, as news text needs."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = r"(?U)\s+"
#: Punctuation that keys ignore.
KEY_PUNCTUATION = r"""(?U)[\s\x{3000}|｜:：,，.。()（）\[\]「」『』、"'’‘“”!?！？/\\-]+"""
#: What a cell holds, and the mark of a cut one; marks of cut full texts in either form.
CELL_LIMIT = 48_000
CELL_SUFFIX = "\n\n[… セル内文字数上限のため省略 …]"
FULL_SUFFIX, FULL_SUFFIX_WITHIN = "\n\n[…本文が長いためここまでを翻訳]", "…（本文が長いためここまでを翻訳）"
#: Spellings made one before texts are compared, in order.
REPLACEMENTS = [
    ("ミンアンフライイン", "ミンアウンフライン"),
    ("ミンアウン・フライン", "ミンアウンフライン"),
    ("アウン・サン・スー・チー", "アウンサンスーチー"),
    ("アウン・サン・スーチー", "アウンサンスーチー"),
    ("キヤット", "チャット"),
    ("Kyat", "チャット"),
    ("kyat", "チャット"),
    ("Ｋ", "K"),
]
#: Lines that are no text of an article.
NO_TEXT = [
    r"^(?:Photo|Image|Video|Graphic|Map|Caption)[:：\)]",
    r"^\((?:Photo|Image|Video|Graphic|Map)\)\s*$",
    r"^(?:Credit|Credits|Source|Sources|Via|Courtesy of)[:：]",
    r"^(?:With reporting by|Reported by|Reporting by|Edited by|Compiled by|Translation|Translator|Translated by).*$",
    r"^(?:ဓာတ်ပုံ|ရုပ်ပုံ)[:：]",
    r"^(?:ရင်းမြစ်)[:：]",
    r"^(?:ဘာသာပြန်|ဘာသာပြန်သူ|တည်းဖြတ်)[:：]",
    r"^(?:BBC Burmese|DVB|Myanmar Now|The Irrawaddy|Khit Thit Media|Mizzima|RFA Burmese|VOA Burmese|Eleven Media|Frontier Myanmar|Reuters|AP|Associated Press|AFP|SCMP)\s*$",
    r"^(?:[#＃][^\s#]+(?:\s+|$)){3,}$",
    r"^(?:Save my name, email, and website.*)$",
    r"^(?:Leave a comment|Post a Comment|Your email address will not be published).*$",
    r"^(?:PDF)\s*$",
    r"""^[\s\-/–—•·|\\\(\)\[\]{}“”"'«»。、．…／]+$""",
    r"^(?:##.*)$",
]


def bound(value: Column, of) -> Column:
    """``of`` a value that is worked out once, however often ``of`` names it; not for Python UDFs inside."""
    return F.transform(F.array(value), of)[0]


def strip(c: Column) -> Column:
    """Trim all Unicode white space; Spark's trim() only trims blanks."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def nz(c: Column) -> Column:
    """Blank to null."""
    return F.when(strip(c) != "", c)


def text(c: Column) -> Column:
    """Null to empty, stripped."""
    return F.coalesce(strip(c.cast("string")), F.lit(""))


def squeeze(c: Column) -> Column:
    return strip(F.regexp_replace(c, SPACE, " "))


def without_controls(c: Column) -> Column:
    return F.regexp_replace(c, r"[\x00-\x1f\x7f-\x9f]", " ")


@F.pandas_udf(T.StringType())
def nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def normalize_input(c: Column, replacements: list[tuple[str, str]] = tuple(REPLACEMENTS), fold: bool = True) -> Column:
    """NFKC unless ``fold`` is off, controls to blanks, squeezed, then literal replacements in order."""
    c = text(c)
    c = squeeze(without_controls(nfkc(c) if fold else c))
    for a, b in replacements:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def normalize_key(c: Column, fold: bool = True) -> Column:
    """Key form: normalised, lower, without punctuation and blanks."""
    return F.regexp_replace(F.lower(normalize_input(c, fold=fold)), KEY_PUNCTUATION, "")


def latin_title_key(c: Column) -> Column:
    return squeeze(F.regexp_replace(F.replace(F.lower(nfkc(text(c))), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " "))


def clip_cell(c: Column, limit: int = CELL_LIMIT, suffix: str = CELL_SUFFIX) -> Column:
    """Text of a cell: at most ``limit`` characters, the suffix included."""
    head = F.regexp_replace(F.substring(c, 1, limit - len(suffix)), r"(?U)\s+$", "")
    return F.when(F.length(c) > limit, F.concat(head, F.lit(suffix))).otherwise(c)


def truncate(c: Column, limit: int) -> Column:
    """Squeezed, cut with an ellipsis."""
    c = squeeze(c)
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit("…"))).otherwise(c)


def compact_lines(c: Column, drop: list[str]) -> Column:
    """Squeezed non-blank lines that match none of ``drop``, joined by a blank line."""
    lines = F.filter(F.transform(F.split(c, "\n"), squeeze), lambda x: x != "")
    for pattern in drop:
        lines = F.filter(lines, lambda x: ~F.rlike(x, F.lit(pattern)))  # noqa: B023
    return F.array_join(lines, "\n\n")


def compact_body(c: Column) -> Column:
    """The text lines of a body: NFC, single blanks, without lines that are no text, a blank line between."""
    return compact_lines(nfc(F.coalesce(c, F.lit(""))), [f"(?iu){p}" for p in NO_TEXT])


def cut_full(c: Column, limit: int, within: bool = False) -> Column:
    """Full text up to a limit: the mark stands behind the limit, or ``within`` it; then a limit of 0 is none."""
    c = F.coalesce(c, F.lit(""))
    if within:
        if limit <= 0:
            return c
        return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, max(0, limit - len(FULL_SUFFIX_WITHIN))), F.lit(FULL_SUFFIX_WITHIN))).otherwise(c)
    return F.when(F.length(c) > limit, F.concat(F.regexp_replace(F.substring(c, 1, limit), r"(?U)\s+$", ""), F.lit(FULL_SUFFIX))).otherwise(c)


def as_html_lines(c: Column) -> Column:
    return F.replace(F.coalesce(c, F.lit("")), F.lit("\n"), F.lit("<br>"))


def without_category_c(c: Column) -> Column:
    """Control and format characters go, line ends too, and no-break spaces are blanks."""
    return F.regexp_replace(F.regexp_replace(c, "\u00a0|&nbsp;", " "), r"\p{C}", "")


def payload_text(c: Column) -> Column:
    """Bytes of a payload as text; what is no UTF-8 becomes the replacement character."""
    return F.coalesce(F.make_valid_utf8(c.cast("string")), F.lit(""))


NBSP = "\u00a0"
_PROPER = r"[A-Z][A-Za-z0-9&.\-]{1,20}"
_JOINING = r"(?:for|of|and|the|in|on|at|by|from|to|with|without|against|between)"
_CJK = r"\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}"


def held_together(c: Column) -> Column:
    """Names of two and three words, and words around a joining word, get no-break blanks, but in addresses; invisible characters go."""
    c = F.regexp_replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")), r"[\x{200B}\x{200C}\x{200D}\x{FEFF}]", "")
    parts = F.regexp_extract_all(c, F.lit(r"(?s)(https?://\S+|(?:(?!https?://\S).)+)"), F.lit(1))

    def one(x: Column) -> Column:
        t = F.regexp_replace(x, rf"(?i)\b({_PROPER})\s+({_JOINING})\s+({_PROPER})\b", f"$1{NBSP}$2{NBSP}$3")
        t = F.regexp_replace(t, rf"\b({_PROPER}) ({_PROPER}) ({_PROPER})\b", f"$1{NBSP}$2{NBSP}$3")
        t = F.regexp_replace(t, rf"\b({_PROPER}) ({_PROPER})\b", f"$1{NBSP}$2")
        return F.when(x.rlike("^https?://"), x).otherwise(t)

    return F.array_join(F.transform(parts, one), "")


def latin_before_cjk(c: Column) -> Column:
    """The blank between a Latin character and a Chinese or Japanese one does not break."""
    return F.regexp_replace(c, rf"([A-Za-z0-9]) ([{_CJK}])", f"$1{NBSP}$2")


def drop_hashtags(c: Column) -> Column:
    return F.regexp_replace(c, r"(?:(?<=\s)|^)#[^\s#]+", "")


def strip_tags(c: Column) -> Column:
    return squeeze(F.regexp_replace(F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"(?s)<[^>]*>", " "))


def strip_source_suffix(c: Column, sources: list[str]) -> Column:
    """Drop `` - Source`` or `` | Source`` from the end of a title."""
    names = "|".join(f"\\Q{s}\\E" for s in sources)
    return F.regexp_replace(c, rf"(?iu)\s*[-|–]\s*({names})\s*$", "")


def share_of(c: Column, letters: str) -> Column:
    """Share of characters in a class."""
    n = F.length(c)
    return F.when(n > 0, (n - F.length(F.regexp_replace(c, f"[{letters}]", ""))) / n).otherwise(0.0)


def token_estimate(c: Column) -> Column:
    """Rough tokens by script: two characters a token if mostly Burmese, four if mostly Latin, else three."""
    c = F.coalesce(c, F.lit(""))
    per = F.when(share_of(c, r"\x{1000}-\x{109F}") >= 0.6, 2).when(share_of(c, "A-Za-z") >= 0.6, 4).otherwise(3)
    return F.when(F.length(c) == 0, 0).otherwise(F.greatest(F.lit(1), F.floor(F.length(c) / per))).cast("long")


def grams(c: Column, sizes: tuple[int, ...] = (3, 4, 5)) -> Column:
    """Distinct character n-grams; shorter text has none of that size.

    The characters are bound to a lambda variable: they are split once, and a
    gram is a slice of them, so the work grows with the text and not its square.
    """
    def of(chars: Column) -> Column:
        each = [F.when(F.size(chars) >= n, F.transform(F.sequence(F.lit(1), F.size(chars) - n + 1), lambda i: F.array_join(F.slice(chars, i, F.lit(n)), "")))
                .otherwise(F.array().cast("array<string>")) for n in sizes]  # noqa: B023
        return F.array_distinct(F.concat(*each))

    letters = F.when(F.length(c) > 0, F.split(c, "")).otherwise(F.array().cast("array<string>"))
    return F.transform(F.array(letters), of)[0]


def containment(a: Column, b: Column) -> Column:
    """Shared grams over those of the smaller set; 0 where either is empty."""
    low = F.least(F.size(a), F.size(b))
    return F.when(low > 0, F.size(F.array_intersect(a, b)) / low).otherwise(0.0)


def replace_after_first(c: Column, mark: str, full: str, short: str) -> Column:
    """The first mark becomes the full term, later ones the short one."""
    parts = F.split(c, f"\\Q{mark}\\E")
    rest = F.array_join(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), short)
    return F.when(F.size(parts) > 1, F.concat(parts[0], F.lit(full), rest)).otherwise(c)


def last_block(c: Column, marker: str, stops: list[str]) -> Column:
    """Text after the last marker, up to the first line that starts with a stop."""
    tail = F.substring_index(c, marker, -1)
    for s in stops:
        tail = F.regexp_replace(tail, rf"(?s)(^|\n)\s*\Q{s}\E.*$", "")
    return strip(tail)
