"""Times of day, lap times and pit durations held as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE_PATTERN = r"^\s*[+-]?\d+\s*:\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def seconds_of_day(text: Column) -> Column:
    """``HH:MM:SS`` as seconds since midnight (a trailing ``Z`` is allowed)."""
    clock = F.split(F.regexp_replace(text, "Z$", ""), ":")
    parts = [F.try_element_at(clock, F.lit(i)).try_cast("double") for i in (1, 2, 3)]
    return parts[0] * 3600 + parts[1] * 60 + F.coalesce(parts[2], F.lit(0.0))


def as_interval(seconds: Column) -> Column:
    """Seconds as a day-time interval."""
    return F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.round(seconds, 6).cast("decimal(18,6)")
    )


def millis_interval(millis: Column) -> Column:
    """Milliseconds as a day-time interval."""
    return as_interval(millis / 1000)


def is_minute_text(text: Column) -> Column:
    """True for ``m:ss.fff`` with exactly one colon."""
    return F.coalesce(text.rlike(MINUTE_PATTERN), F.lit(False))


def _minutes_and_seconds(text: Column) -> tuple[Column, Column]:
    parts = F.split(text, ":")
    minutes = F.trim(F.try_element_at(parts, F.lit(1))).try_cast("int")
    seconds = F.trim(F.try_element_at(parts, F.lit(2))).try_cast("double")
    return minutes, seconds


def lap_millis(text: Column, mode: str = "reference") -> Column:
    """``m:ss.fff`` as milliseconds; null unless the text has that form.

    ``reference`` truncates the product of a double, so ``1:32.300`` is 92299; ``lenient``
    rounds it to 92300.
    """
    minutes, seconds = _minutes_and_seconds(text)
    product = seconds * 1000
    whole = F.round(product) if mode == "lenient" else product
    millis = minutes * 60000 + whole.cast("int")
    return F.when(is_minute_text(text), millis)


def pit_seconds(text: Column, mode: str = "reference") -> Column:
    """Pit duration in seconds.

    ``reference`` reads only ``m:ss.fff`` and gives null for plain seconds; ``lenient`` reads both.
    """
    minutes, seconds = _minutes_and_seconds(text)
    clock = F.when(is_minute_text(text), minutes * 60 + seconds)
    if mode == "lenient":
        return F.coalesce(clock, text.try_cast("double"))
    return clock
