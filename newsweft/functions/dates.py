"""Dates of feeds, sheets and pages; all zones explicit, local time is UTC+06:30."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL = "+06:30"
#: Origin of sheet serial dates and the serials taken as dates.
SERIAL_ORIGIN, SERIAL_FROM, SERIAL_TO = "1899-12-30", 10_000, 80_000


def local_date(ts: Column) -> Column:
    return F.to_date(F.from_utc_timestamp(ts, LOCAL))


def serial_date(v: Column) -> Column:
    v = v.cast("double")
    return F.when((v >= SERIAL_FROM) & (v <= SERIAL_TO), F.date_add(F.lit(SERIAL_ORIGIN).cast("date"), F.floor(v).cast("int")))


def _valid(y: Column, m: Column, d: Column) -> Column:
    return F.to_date(F.try_to_timestamp(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), F.lit("yyyy-MM-dd")))


def date_key(s: Column) -> Column:
    """``yyyyMMdd`` of a date in text: a separated date, else the first eight digits if they are one, else empty."""
    p = r"(20\d{2})[-/.年](\d{1,2})[-/.月](\d{1,2})"
    part = lambda i: F.regexp_extract(s, p, i)
    digits = F.substring(F.regexp_replace(s, r"\D", ""), 1, 8)
    plain = F.when(F.length(digits) == 8, F.to_date(F.try_to_timestamp(digits, F.lit("yyyyMMdd"))))
    found = F.when(s.rlike(p), _valid(part(1), part(2), part(3))).otherwise(plain)
    return F.coalesce(F.date_format(found, "yyyyMMdd"), F.lit(""))


def list_date(s: Column) -> Column:
    """``March 5, 2024``."""
    return F.to_date(F.try_to_timestamp(s, F.lit("MMMM d, yyyy")))


def feed_date(s: Column) -> Column:
    """Local date of an RFC 822 time; without zone it is UTC."""
    plain = F.regexp_replace(F.regexp_replace(s, r"^\s*[A-Za-z]{3},\s*", ""), r"\s*(GMT|UTC)?\s*$", "")
    zoned = F.try_to_timestamp(plain, F.lit("d MMM yyyy HH:mm:ss Z"))
    return local_date(F.coalesce(zoned, F.try_to_timestamp(plain, F.lit("d MMM yyyy HH:mm:ss"))))


def iso_local_date(s: Column) -> Column:
    """Local date of an ISO time; without offset the time is local already."""
    offset = s.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    return F.when(offset, local_date(s.try_cast("timestamp"))).otherwise(F.to_date(F.substring(s, 1, 10).try_cast("timestamp")))


def ja_date(d: Column) -> Column:
    return F.concat(F.year(d), F.lit("年"), F.month(d), F.lit("月"), F.dayofmonth(d), F.lit("日"))


def ja_to_date(s: Column) -> Column:
    p = r"(\d{4})年(\d{1,2})月(\d{1,2})日"
    return F.coalesce(_valid(*[F.regexp_extract(s, p, i) for i in (1, 2, 3)]), F.to_date(F.substring(s, 1, 10).try_cast("timestamp")))
