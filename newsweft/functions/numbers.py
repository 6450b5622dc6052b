"""Scores and money. Rounding is half-even everywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bound

#: Fixed value: yen a kyat.
YEN_A_KYAT = 0.0370


def safe_int(c: Column, default: int = 0) -> Column:
    return F.coalesce(F.bround(c.try_cast("double"), 0).cast("long"), F.lit(default).cast("long"))


def clamp_score(c: Column, default: int = 0) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(100), safe_int(c, default))).cast("int")


def probability_score(p: Column) -> Column:
    return clamp_score(F.nanvl(p, F.lit(0.0)) * 100)


def final_score(ml: Column, llm: Column) -> Column:
    return F.greatest(clamp_score(ml), F.when(llm.isNotNull(), clamp_score(llm)))


def score_source(ml: Column, llm: Column) -> Column:
    a, b = clamp_score(ml), clamp_score(llm)
    return F.when(llm.isNull(), "ml_only").when(b > a, "llm").when(a > b, "ml").otherwise("tie")


def kyat_to_yen(kyat: Column) -> Column:
    return F.bround(kyat.cast("double") * YEN_A_KYAT, 0).cast("long")


_UNITS = ((10**12, "兆"), (10**8, "億"), (10**4, "万"))


def _ladder(n: Column, unit: str, rest: Column) -> Column:
    parts, left = [], n
    for size, name in _UNITS:
        k = ((left - left % size) / size).cast("long")
        parts.append(F.when(k > 0, F.concat(k.cast("string"), F.lit(name))).otherwise(""))
        left = left % size
    return F.concat(*parts, rest, F.lit(unit))


def format_yen(n: Column) -> Column:
    """210億6000万円."""
    def of(x: Column) -> Column:
        ones = x % 10_000
        return F.when(x == 0, "0円").otherwise(_ladder(x, "円", F.when(ones > 0, ones.cast("string")).otherwise("")))

    return bound(n.cast("long"), of)


def format_kyat(n: Column) -> Column:
    """As yen, without what is below 10,000 if a larger unit is there; nothing for 0 and less."""
    return bound(n.cast("long"), lambda x: F.when(x <= 0, "").when(x < 10_000, F.concat(x.cast("string"), F.lit("チャット"))).otherwise(_ladder(x, "チャット", F.lit(""))))


def parse_kyat(s: Column) -> Column:
    """1兆2345億6789万チャット to a number; units must come in order. Null if it is no amount."""
    p = r"^\s*(?:(\d+)兆)?(?:(\d+)億)?(?:(\d+)万)?(\d+)?チャット\s*$"

    def of(x: Column) -> Column:
        part = lambda i, size: F.coalesce(F.regexp_extract(x, p, i).try_cast("long"), F.lit(0).cast("long")) * size
        return F.when(x.rlike(p) & x.rlike(r"\d"), part(1, 10**12) + part(2, 10**8) + part(3, 10**4) + part(4, 1))

    return bound(s, of)


def backoff_seconds(attempt: Column, base: float = 60.0, most: float = 1200.0) -> Column:
    return F.least(F.lit(most), base * F.pow(F.lit(2.0), attempt))


def length_bin(c: Column, width: int, most: int = 10) -> Column:
    return F.least(F.floor(F.length(c) / width), F.lit(most)).cast("int")


def overlap_ratio(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Overlap of two spans over the shorter one."""
    width = F.least(a1 - a0, b1 - b0)
    return F.when(width > 0, F.greatest(F.lit(0.0), F.least(a1, b1) - F.greatest(a0, b0)) / width).otherwise(0.0)
