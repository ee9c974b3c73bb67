"""Delimited-list text: split into tokens and pick positions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tavola.functions._col import as_col
from tavola.functions.clean import numeric_cast


def csv_items(c: str | Column, sep: str = ",", cast: str | None = None) -> Column:
    """Array of trimmed tokens of a delimited string (NULL input gives NULL).

    With ``cast`` each token is ``try_cast`` to that type; unparsable tokens become NULL.
    """
    parts = F.split(as_col(c), re.escape(sep))
    if cast is None:
        return F.transform(parts, lambda x: F.trim(x))
    return F.transform(parts, lambda x: numeric_cast(x, cast))


def csv_part(c: str | Column, position: int, sep: str = ",", cast: str | None = None) -> Column:
    """The ``position``-th (1-based) token; NULL when the list is shorter.

    Picks the token first and converts only that one (no per-token lambda).
    """
    token = F.trim(F.try_element_at(F.split(as_col(c), re.escape(sep)), F.lit(position)))
    return token if cast is None else numeric_cast(token, cast)
