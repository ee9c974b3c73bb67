"""Exact numeric helpers shared by every engine we compare against."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tavola.functions._col import as_col

_EXACT_DOUBLE = 2**53  # integers below this are exact as doubles


def round_ratio(num: str | Column, den: str | Column, digits: int) -> Column:
    """``round(num / den, digits)`` half away from zero, computed exactly on integers.

    ``num`` and ``den`` must be integral (scale values up first, e.g. km*10). Division by
    zero or NULL yields NULL. Result is DOUBLE: the closest double to the exact decimal.

    Operands that fit comfortably in 64 bits take a long-integer path (the quotient of an
    exact multiple is exact); larger ones fall back to DECIMAL(38,0) arithmetic.
    """
    scale = 10**digits
    limit = _EXACT_DOUBLE // (2 * scale + 2)
    nl, dl = as_col(num).try_cast("bigint"), as_col(den).try_cast("bigint")
    fits = nl.isNotNull() & dl.isNotNull() & (F.abs(nl) < limit) & (F.abs(dl) < limit)

    sgn_l = F.when((nl < 0) != (dl < 0), F.lit(-1)).otherwise(F.lit(1))
    a, b = F.abs(nl) * (2 * scale) + F.abs(dl), F.abs(dl) * 2
    fast = (sgn_l * ((a - F.pmod(a, b)) / b).cast("bigint")).cast("double") / F.lit(float(scale))

    n, d = as_col(num).cast("decimal(38,0)"), as_col(den).cast("decimal(38,0)")
    sgn = F.when((n < 0) != (d < 0), F.lit(-1)).otherwise(F.lit(1))
    an, ad = F.abs(n), F.abs(d)
    # the remainder goes first: DECIMAL division keeps few digits and rounds half up, so it
    # must only ever divide an exact multiple
    a, b = (an * (2 * scale) + ad).cast("decimal(38,0)"), (ad * 2).cast("decimal(38,0)")
    units = ((a - F.pmod(a, b)) / b).cast("decimal(38,0)")
    slow = ((sgn * units).cast("decimal(38,0)") / F.lit(scale).cast("decimal(38,0)")).cast("double")

    zero = F.when(fits, dl == 0).otherwise(d == 0)
    return F.when(~zero, F.when(fits, fast).otherwise(slow))


def to_money(c: str | Column) -> Column:
    """Exact decimal money to the shared DOUBLE output type."""
    return as_col(c).cast("double")
