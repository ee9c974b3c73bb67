"""Calendar rules whose meaning differs between SQL dialects (minutes, weeks, weekdays)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tavola.functions._col import as_col


def _second_of_minute_micros(ts: Column) -> Column:
    # date_part('SECOND') is decimal(8,6) seconds within the minute, fraction included.
    return (F.date_part(F.lit("SECOND"), ts) * F.lit(1_000_000)).cast("bigint")


def _minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def minutes_between(start: str | Column, end: str | Column, mode: str = "boundary") -> Column:
    """Minutes from ``start`` to ``end`` on the wall clock.

    ``boundary`` counts minute boundaries crossed (13:23:46 -> 13:53:03 is 30), the rule a
    ``datediff(minute, …)`` uses; ``elapsed`` counts whole elapsed minutes, truncated
    toward zero (29). Built from calendar fields with integer arithmetic only, so a
    TIMESTAMP_NTZ never passes through the session time zone (no DST shifts).
    """
    a, b = as_col(start), as_col(end)
    boundary = F.datediff(F.to_date(b), F.to_date(a)).cast("bigint") * 1440 + _minute_of_day(b) - _minute_of_day(a)
    if mode == "boundary":
        return boundary
    if mode != "elapsed":
        raise ValueError(f"mode must be 'boundary' or 'elapsed', got {mode!r}")
    micros = boundary * 60_000_000 + _second_of_minute_micros(b) - _second_of_minute_micros(a)
    whole = _floor_div(F.abs(micros), 60_000_000)
    return F.when(micros < 0, -whole).otherwise(whole)


def _floor_div(n: Column, d: int) -> Column:
    # n - pmod(n, d) is an exact multiple of d, so the quotient is an exact integer.
    return ((n - F.pmod(n, F.lit(d))) / F.lit(d)).cast("bigint")


def monday_week_of_year(d: str | Column) -> Column:
    """Week number with weeks starting Monday and Jan 1 always in week 1 (not ISO)."""
    day = F.to_date(as_col(d))
    jan1_weekday = F.weekday(F.trunc(day, "year"))  # Monday = 0
    return ((F.dayofyear(day) + jan1_weekday - 1) / 7).cast("int") + 1


def weekday_name(d: str | Column) -> Column:
    """Full English weekday name ('Wednesday')."""
    return F.date_format(as_col(d), "EEEE")
