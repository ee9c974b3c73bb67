"""Cleaning of messy text columns: missing-value spellings, glued units, numeric guards."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tavola.functions._col import as_col

# The spellings of "missing" the order feeds use besides NULL.
DEFAULT_SENTINEL_PATTERNS = ("%null%",)


def nullify_sentinels(
    c: str | Column,
    patterns: Sequence[str] = DEFAULT_SENTINEL_PATTERNS,
    blank: bool = True,
) -> Column:
    """NULL for blank text (any run of spaces) and for text matching a sentinel pattern.

    Patterns are SQL LIKE patterns matched case-insensitively, as a case-insensitive
    collation would compare them.
    """
    col = as_col(c)
    cond = F.lit(False)
    if blank:
        cond = cond | (F.trim(col) == F.lit(""))
    for p in patterns:
        cond = cond | col.ilike(p)
    return F.when(~F.coalesce(cond, F.lit(False)), col)


_NUMBER = r"([-+]?[0-9]*\.?[0-9]+)"


def _alternation(units: Sequence[str]) -> str:
    # Longest first so 'minutes' wins over 'minute' and 'min'.
    ordered = sorted({u for u in units}, key=len, reverse=True)
    return "|".join(re.escape(u) for u in ordered)


def strip_units(c: str | Column, units: Sequence[str], position: str = "suffix") -> Column:
    """Remove a unit glued before/after a number: ``'20km'``, ``'23.4 km'``, ``'Brand#13'``.

    One anchored, case-insensitive pattern replaces an order-dependent chain of LIKE
    branches. Text that is not ``<number><unit>`` (or ``<unit><number>``) is returned
    unchanged so a later numeric guard can reject it.
    """
    col = as_col(c)
    alt = _alternation(units)
    if position == "suffix":
        pattern = rf"(?i)^\s*{_NUMBER}\s*(?:{alt})?\s*$"
    elif position == "prefix":
        pattern = rf"(?i)^\s*(?:{alt})?\s*{_NUMBER}\s*$"
    else:
        raise ValueError(f"position must be 'suffix' or 'prefix', got {position!r}")
    return F.when(col.rlike(pattern), F.regexp_extract(col, pattern, 1)).otherwise(col)


_INTEGRAL = {"int", "integer", "bigint", "long", "smallint", "short", "tinyint", "byte"}
_INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"
_DEC_TEXT = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def numeric_cast(c: str | Column, type_name: str) -> Column:
    """Text to a numeric type; text that is not a number (or overflows) becomes NULL.

    A failed cast is expensive (an error raised and caught per row), so the text is
    matched against a number pattern first and only candidates are cast.
    """
    col = as_col(c)
    pattern = _INT_TEXT if type_name.lower() in _INTEGRAL else _DEC_TEXT
    return F.when(col.rlike(pattern), F.trim(col).try_cast(type_name))


def to_decimal(c: str | Column, precision: int = 10, scale: int = 2) -> Column:
    """Text to DECIMAL; non-numeric or out-of-range text becomes NULL instead of failing."""
    return numeric_cast(c, f"decimal({precision},{scale})")


def to_int(c: str | Column) -> Column:
    """Text to INT with a numeric guard (non-numeric text becomes NULL)."""
    return numeric_cast(c, "int")


def is_numeric(c: str | Column, type_name: str = "decimal(38,10)") -> Column:
    """True when the text parses as a number of ``type_name`` (no currency-sign quirks)."""
    return numeric_cast(c, type_name).isNotNull()
