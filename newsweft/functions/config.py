"""Typed settings: a default where a value is missing or wrong, and bounds."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, timedelta, timezone

#: What counts as yes; local time.
YES = {"1", "true", "yes", "on", "y"}
LOCAL = timezone(timedelta(hours=6, minutes=30))


def flag(values: Mapping[str, str], name: str, default: bool = False) -> bool:
    v = values.get(name)
    return default if not v else v.strip().lower() in YES


def _bounded(v, least, most):
    v = v if least is None else max(least, v)
    return v if most is None else min(most, v)


def number(values: Mapping[str, str], name: str, default, least=None, most=None, kind: type = int):
    """A number of a kind within bounds; the default, as it is, where there is none."""
    raw = (values.get(name) or "").strip()
    try:
        return _bounded(kind(raw), least, most) if raw else default
    except ValueError:
        return default


def required(values: Mapping[str, str], name: str) -> str:
    v = (values.get(name) or "").strip()
    if not v:
        raise RuntimeError(f"setting {name} is missing")
    return v


def local_today(override: str | None = None, now: datetime | None = None) -> date:
    """The local day; an override as ``2026-05-09`` counts if it is a date."""
    try:
        return datetime.strptime((override or "").strip(), "%Y-%m-%d").date()
    except ValueError:
        return (now or datetime.now(timezone.utc)).astimezone(LOCAL).date()
