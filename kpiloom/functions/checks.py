"""Parameter checks, made before any plan is built."""

from __future__ import annotations

from datetime import date

GRANULARITIES = ("daily", "weekly", "monthly")
DETECTION_METHODS = ("zscore", "iqr")


def as_date(value: date | str) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def date_range(start: date | str, end: date | str) -> tuple[date, date]:
    start, end = as_date(start), as_date(end)
    if end < start:
        raise ValueError("end date must not lie before start date")
    return start, end


def between(name: str, value: int, low: int, high: int | None) -> int:
    if value < low or (high is not None and value > high):
        raise ValueError(f"{name} must be at least {low}" + (f" and at most {high}" if high else ""))
    return value


def days(value: int) -> int:
    return between("days", value, 1, 365)


def horizon(value: int) -> int:
    return between("horizon", value, 1, 365)


def lookback(value: int) -> int:
    return between("lookback", value, 7, 365)


def limit(value: int) -> int:
    return between("limit", value, 1, 1000)


def offset(value: int) -> int:
    return between("offset", value, 0, None)


def one_of(name: str, value: str, allowed: tuple[str, ...]) -> str:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {', '.join(allowed)}")
    return value
