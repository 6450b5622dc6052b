"""Money amounts inside text, where a replacement is computed from each match."""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .numbers import YEN_A_KYAT

#: Burmese digits and the word for a decimal point.
MM_DIGITS = "၀၁၂၃၄၅၆၇၈၉"
WIDE_DIGITS = "０１２３４５６７８９"
MM_POINT = "ဒသမ"
#: Amounts in lakh, million and billion of kyat.
UNITS = {"သိန်း": 10**5, "သန်း": 10**6, "ဘီလီယံ": 10**9}
#: Rough amounts and what they are called.
ROUGH = [
    (r"သိန်း\s*ရာ\s*ချီ", "数千万チャット規模"),
    (r"သိန်း\s*ထောင်\s*ချီ", "数億チャット規模"),
    (r"သိန်း\s*သောင်း\s*ချီ", "数十億チャット規模"),
    (r"သန်း\s*ရာ\s*ချီ", "数億チャット規模"),
    (r"သန်း\s*ထောင်\s*ချီ", "数十億チャット規模"),
    (r"သန်း\s*သောင်း\s*ချီ", "数百億チャット規模"),
]
#: Words behind an amount for "over" and "about", and their Japanese.
OVER, ABOUT = ["ကျော်"], ["လောက်", "ခန့်", "ခန့္"]
OVER_JA, ABOUT_JA = "超", "程度"
#: What shows that an amount is in kyat, and within how many characters.
KYAT = re.compile(r"(?:ငွေ\s*)?ကျပ်|kyat|ks\.?|mmk", re.IGNORECASE)
NEAR = 40
#: Currencies that take no yen in brackets, and such brackets.
FOREIGN = r"(?:米ドル|ドル|USD|US\$|\$|バーツ|THB|ユーロ|EUR|ポンド|GBP|元|人民元|CNY|ウォン|KRW)"
YEN_BRACKET = r"（\s*(?:約)?\s*[0-9０-９,，兆億万.]+(?:円|えん)\s*）"
#: A kyat amount with yen behind it; a point is no part of the amount.
KYAT_YEN = re.compile(r"([0-9０-９兆億万,\s，]+チャット)（約[^）]*円）")

#: An amount of kyat in text, number or currency first.
CURRENCY = r"(?:မြန်မာ(?:့)?(?:နိုင်ငံ)?\s*)?(?:ငွေ\s*)?ကျပ်(?:ငွေ)?"
DIGITS, SCALE, TRAIL = r"[0-9၀-၉][0-9၀-၉,.]*", r"(?:သောင်း|သိန်း|သန်း)", r"(?:\s*(?:ကျော်|လောက်|ခန့်))?"
NUMBER_FIRST = rf"{DIGITS}\s*(?:{SCALE})?\s*(?:{CURRENCY}){TRAIL}"
CURRENCY_FIRST = rf"(?:{CURRENCY})\s*(?:{SCALE})?\s*{DIGITS}{TRAIL}"

_NUMBER = r"\d+(?:[,，]\d{3})*(?:\.\d+)?"
_LADDER = ((10**12, "兆"), (10**8, "億"), (10**4, "万"))


def _amount_pattern(unit: str) -> re.Pattern:
    return re.compile(rf"(?:{_NUMBER}\s*{unit}|{unit}\s*{_NUMBER})(?:\s*(?:{'|'.join([ABOUT[0], *OVER, *ABOUT[1:]])}))?")


def normalize_amount_text(c: Column) -> Column:
    """Plain digits and points without blanks beside them, no zero-width characters, single blanks."""
    c = F.translate(F.coalesce(c, F.lit("")), MM_DIGITS + WIDE_DIGITS, "0123456789" * 2)
    c = F.regexp_replace(F.replace(c, F.lit(MM_POINT), F.lit(".")), r"(?U)\s*\.\s*", ".")
    c = F.replace(F.regexp_replace(c, r"[\x{200B}-\x{200D}\x{FEFF}]", ""), F.lit("\u00a0"), F.lit(" "))
    return F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", " "), r"^ | $", "")


def qualifier(c: Column) -> Column:
    """超 behind "over", 程度 behind "about", else nothing."""
    any_of = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(c, w))
    return F.when(any_of(OVER), OVER_JA).when(any_of(ABOUT), ABOUT_JA).otherwise("")


def number_of(c: Column) -> Column:
    """The first number of a text, with thousands in commas, as double; null if there is none."""
    found = F.regexp_extract(normalize_amount_text(c), f"({_NUMBER})", 1)
    return F.regexp_replace(found, "[,，]", "").try_cast("double")


def number_label(n: Column) -> Column:
    """2209 and 1068.66: whole numbers without, others with up to six decimals."""
    whole = n == F.floor(n)
    return F.when(whole, n.cast("long").cast("string")).when(n.isNotNull(), F.regexp_replace(F.regexp_replace(F.format_string("%.6f", n), "0+$", ""), r"\.$", ""))


def yen_text(n: int) -> str:
    parts = []
    for size, name in _LADDER:
        if n >= size:
            parts.append(f"{n // size}{name}")
            n %= size
    return "".join(parts) + (str(n) if n or not parts else "") + "円"


def kyat_text(n: int) -> str:
    """As yen, without what is below 10,000 if a larger unit is there; nothing for 0 and less."""
    if n <= 0:
        return ""
    parts, left = [], n
    for size, name in _LADDER:
        if left >= size:
            parts.append(f"{left // size}{name}")
            left %= size
    return ("".join(parts) or str(n)) + "チャット"


def kyat_number(s: str) -> int | None:
    """Units must come in order; null where they do not."""
    digits = str.maketrans(WIDE_DIGITS, "0123456789")
    m = re.fullmatch(r"(?:(\d*)兆)?(?:(\d*)億)?(?:(\d*)万)?(\d*)チャット", re.sub(r"[,\s，]", "", s).translate(digits))
    return None if not m else sum(int(g or 0) * size for g, size in zip(m.groups(), (10**12, 10**8, 10**4, 1)))


@F.pandas_udf(T.StringType())
def fix_yen(s: pd.Series) -> pd.Series:
    """Recompute the yen of every ``…チャット（約…円）``; other text stays."""

    def new(m: re.Match) -> str:
        n = kyat_number(m[1])
        return m[0] if n is None else f"{m[1]}（約{yen_text(round(n * YEN_A_KYAT))}）"

    return s.map(lambda x: KYAT_YEN.sub(new, x), na_action="ignore")


def drop_foreign_yen(c: Column) -> Column:
    """No yen in brackets behind other currencies, or behind an amount that follows one."""
    c = F.regexp_replace(c, rf"(?U)({FOREIGN})\s*{YEN_BRACKET}", "$1")
    return F.regexp_replace(c, rf"(?U)({FOREIGN}\s*[0-9０-９,，兆億万.]+)\s*{YEN_BRACKET}", "$1")


def kyat_amount(c: Column) -> Column:
    """The first amount of kyat with the number in front, else the first with the currency in front; blank without one."""
    c = F.coalesce(c, F.lit(""))
    first = F.regexp_extract(c, f"({NUMBER_FIRST})", 1)
    return F.when(first != "", first).otherwise(F.regexp_extract(c, f"({CURRENCY_FIRST})", 1))


FACTS = T.ArrayType(T.StructType([T.StructField("raw", T.StringType()), T.StructField("ja", T.StringType())]))


def _near(x: str, m: re.Match) -> bool:
    return KYAT.search(x[max(0, m.start() - NEAR) : m.end() + NEAR]) is not None


def _qualified(raw: str) -> str:
    return OVER_JA if any(w in raw for w in OVER) else ABOUT_JA if any(w in raw for w in ABOUT) else ""


def _value(raw: str) -> float:
    return float(re.sub("[,，]", "", re.search(_NUMBER, raw)[0]))


def facts_of(x: str | None) -> list[dict]:
    """Distinct amounts that have a kyat word near: rough ones, then those with a unit, with their Japanese and yen."""
    x, out = x or "", {}
    for pattern, ja in ROUGH:
        for m in re.finditer(pattern, x):
            if _near(x, m):
                out[m[0].strip(), ja] = None
    for unit, size in UNITS.items():
        for m in _amount_pattern(unit).finditer(x):
            if _near(x, m):
                kyat = _value(m[0]) * size
                out[m[0].strip(), f"{kyat_text(round(kyat))}{_qualified(m[0])}（約{yen_text(round(round(kyat) * YEN_A_KYAT))}）"] = None
    return [{"raw": r, "ja": ja} for r, ja in out]


@F.pandas_udf(FACTS)
def amount_facts(s: pd.Series) -> pd.Series:
    """Amounts in normalised Burmese text."""
    return s.map(facts_of)


def billions_of(x: str) -> list[dict]:
    """Amounts in billions near a kyat word, with the labels by which a wrong translation shows them."""
    out = {}
    for m in _amount_pattern("ဘီလီယံ").finditer(x):
        if not _near(x, m):
            continue
        n = _value(m[0])
        kyat, mark = round(n * 10**9), _qualified(m[0])
        plain = str(int(n)) if n.is_integer() else f"{n:f}".rstrip("0").rstrip(".")
        labels = {plain, f"{int(n):,}" if n.is_integer() else plain}
        out.setdefault((plain, kyat_text(kyat) + mark), {"labels": sorted(labels, key=len, reverse=True), "mark": mark, "base": kyat_text(kyat),
                                                         "full": kyat_text(kyat) + mark, "yen": f"（約{yen_text(round(kyat * YEN_A_KYAT))}）"})
    return list(out.values())


def _repaired(text: str, source: str) -> str:
    """``N億チャット`` for N billion becomes N times ten 億, unless another amount of the source is rightly called so."""
    facts = billions_of(source)
    for i, f in enumerate(facts):
        others = {v for k, o in enumerate(facts) if k != i for v in (o["base"], o["full"])} - {f["base"], f["full"]}
        for label in f["labels"]:
            wrong = f"{label}億チャット"
            if others & {wrong + w for w in ("", OVER_JA, ABOUT_JA, "くらい", "およそ")}:
                continue
            pattern = re.compile(re.escape(wrong) + rf"(?:{OVER_JA}|{ABOUT_JA}|くらい|およそ)?(?:（約[^）]*円）)?")
            text = pattern.sub(lambda m: (f["base"] if f["mark"] == OVER_JA and m.string.startswith("を超", m.end()) else f["full"]) + f["yen"], text)  # noqa: B023
    return text


@F.pandas_udf(T.StringType())
def repair_billions(s: pd.Series, source: pd.Series) -> pd.Series:
    """Output text and its source in normalised Burmese text."""
    return pd.Series([None if x is None else _repaired(x, y or "") for x, y in zip(s, source)])


@F.pandas_udf(T.DoubleType())
def title_score(a: pd.Series, b: pd.Series) -> pd.Series:
    """1 for equal keys, 0.95 where one holds the other, else the matching-blocks ratio."""

    def one(x: str | None, y: str | None) -> float:
        if not x or not y:
            return 0.0
        if x == y:
            return 1.0
        return 0.95 if x in y or y in x else SequenceMatcher(None, x, y).ratio()

    return pd.Series([one(x, y) for x, y in zip(a, b)])
