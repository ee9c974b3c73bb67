"""Top-k, ties and "first/last around an instant", written so a hot key cannot pin one task.

Ranking over raw rows partitioned by a key sends all rows of a hot key to one task.
Here every ranking first reduces rows with an aggregate (map-side combine), and ranks
only the reduced rows, then joins back where the raw rows are needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tavola.operators.joins import broadcast_if_small, splittable


def _cols(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def keep_max_ties(df: DataFrame, measure: str, group: str | Sequence[str] = ()) -> DataFrame:
    """Rows whose ``measure`` equals the maximum (per ``group``): TOP 1 WITH TIES.

    Global case: one-row aggregate joined back (a one-row side is safe to broadcast).
    Grouped case: per-group maxima by aggregate (combined map-side), joined back on the
    group keys and filtered to the maximum — a group with very many rows is split by the
    join (AQE skew handling), not sorted in one window task.
    """
    keys = _cols(group)
    if not keys:
        top = df.agg(F.max(measure).alias("__max"))
        return df.join(F.broadcast(top), F.col(measure) == F.col("__max"), "left_semi")
    # One maximum per group: join on the group keys only (reusing the aggregate's hash
    # partitioning) and keep the rows at the maximum. ``>=`` equals ``==`` here (nothing
    # exceeds its maximum) but, unlike ``==``, is not turned into a second join key,
    # which would force both sides to be re-shuffled on (keys, measure).
    tops = splittable(df.groupBy(*keys).agg(F.max(measure).alias("__max")))
    return df.join(tops, keys, "inner").filter(F.col(measure) >= F.col("__max")).drop("__max")


def top_one(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The first row by ``order`` (include a unique tie-break); plans as TakeOrdered."""
    return df.orderBy(*order).limit(1)


def rows_at_extreme(
    df: DataFrame, key: str | Sequence[str], by: str, which: str = "min"
) -> DataFrame:
    """All rows of each key whose ``by`` equals the key's min (or max) — duplicates kept.

    Equivalent to ``dense_rank() … = 1``: aggregate per key (skew-safe), join the raw
    rows back on the key and keep those at the extreme value.
    """
    keys = _cols(key)
    agg = F.min(by) if which == "min" else F.max(by)
    # One extreme per key: join on the key only (reusing the aggregate's partitioning) and
    # keep the rows at the extreme; a one-sided comparison (nothing passes its own
    # extreme) stays a filter instead of becoming a second join key.
    ext = splittable(df.groupBy(*keys).agg(agg.alias("__ext")))
    at_extreme = F.col(by) <= F.col("__ext") if which == "min" else F.col(by) >= F.col("__ext")
    return df.join(ext, keys, "inner").filter(at_extreme).drop("__ext")


def first_by(
    df: DataFrame, key: str | Sequence[str], order: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """One row per key: ``values`` of the row that is first by ``order`` (ROW_NUMBER = 1).

    ``min_by`` over a struct is an ordinary aggregate, so it combines map-side.
    """
    keys = _cols(key)
    ordering = F.struct(*[F.col(c) for c in order])
    picked = F.min_by(F.struct(*[F.col(v) for v in values]), ordering).alias("__row")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"__row.{v}").alias(v) for v in values])


def dense_rank_of(
    df: DataFrame,
    partition: str | Sequence[str],
    by: str,
    out: str = "rnk",
    descending: bool = False,
) -> DataFrame:
    """DENSE_RANK over ``partition`` ordered by ``by``, for every row of ``df``.

    Dense rank depends only on the distinct values of ``by`` per partition, so rank the
    distinct (partition, by) pairs — a hot partition collapses to its distinct values —
    and join the rank back on (partition, by).
    """
    keys = _cols(partition)
    distinct = df.select(*keys, by).distinct()
    order = F.col(by).desc() if descending else F.col(by).asc()
    ranked = distinct.withColumn(out, F.dense_rank().over(Window.partitionBy(*keys).orderBy(order)))
    return df.join(broadcast_if_small(ranked), keys + [by], "left")
