"""Keys with very many rows, as a list whose length is bounded whatever the input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot above this many rows, and above this share of all rows; no more keys than
#: MOST_HOT_KEYS can hold such a share.
HOT_KEY_ROWS = 1_000_000
MOST_HOT_KEYS = 10_000


def hot_keys(rows: DataFrame, keys: Sequence[str], least: int = HOT_KEY_ROWS, most: int = MOST_HOT_KEYS) -> DataFrame:
    """``keys`` and ``__hot`` = true of every key with more than ``least`` rows and more than a
    ``most``-th of all rows: at most ``most`` keys, so the list may be broadcast explicitly (the
    optimizer's estimate cannot see the bound, and a shuffle join would put each hot key back
    into one partition)."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    share = sizes.agg((F.sum("__n") / most).alias("__share")).scalar()
    hot = sizes.filter(F.col("__n") > F.greatest(F.lit(float(least)), share))
    return F.broadcast(hot.select(*keys, F.lit(True).alias("__hot")))
