"""Rows inside any of their key's periods: an inequality join without pairs.

An equi-join on the key with ``start <= at AND at <= end`` emits every row once for every period
that holds it, and puts a hot key into one task. Here time is cut into buckets. A period is copied
to the buckets it touches, a row goes to its own, and inside a (key, bucket) a row lies in a period
if the latest end among the periods that began by then has not passed: one running maximum over
both sides, so overlapping periods count once. A key with very many rows is cut finer, one width
a key, so its rows spread over as many tasks as it has days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tavola.operators.hot import HOT_KEY_ROWS, hot_keys

#: Days of a bucket, and of a bucket of a hot key.
BUCKET_DAYS = 32
HOT_BUCKET_DAYS = 1


def in_any_period(
    rows: DataFrame,
    periods: DataFrame,
    key: str | Sequence[str],
    at: str,
    start: str,
    end: str,
    out: str = "in_period",
    bucket_days: int = BUCKET_DAYS,
    hot_bucket_days: int = HOT_BUCKET_DAYS,
    hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """``rows`` plus ``out``: whether ``at`` lies in a period of the same key, both ends included.

    Dates or instants, the same kind on both sides. A null key, a null ``at`` and a period that
    lacks an end or ends before it starts match nothing; rows are neither lost nor doubled.
    """
    keys = [key] if isinstance(key, str) else list(key)
    day = lambda c: F.unix_date(F.to_date(c))
    hot = hot_keys(rows, keys, hot_rows)
    width = F.when(F.coalesce(F.col("__hot"), F.lit(False)), hot_bucket_days).otherwise(bucket_days)
    bucket = lambda c: F.floor(day(c) / width).cast("bigint")

    own = [F.col(k).alias(f"__key{i}") for i, k in enumerate(keys)]
    named = [f"__key{i}" for i in range(len(keys))]
    # one period a start: of those that start together the longest says all
    spans = periods.filter(F.col(start) <= F.col(end)).dropna(subset=keys).groupBy(*keys, start).agg(F.max(end).alias("__end"))
    spans = spans.join(hot, keys, "left").select(
        *own, F.col(start).alias("__at"), "__end", F.explode(F.sequence(bucket(F.col(start)), bucket(F.col("__end")))).alias("__bucket"),
        F.lit(0).alias("__side"),
    )
    points = rows.join(hot, keys, "left").select(
        *own, F.col(at).alias("__at"), bucket(F.col(at)).alias("__bucket"), F.lit(1).alias("__side"),
        F.struct(*[F.col(c) for c in rows.columns]).alias("__row"),
    )
    both = points.unionByName(spans, allowMissingColumns=True)
    begun = Window.partitionBy(*named, "__bucket").orderBy("__at", "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    latest = both.withColumn("__latest", F.max("__end").over(begun)).filter(F.col("__side") == 1)
    inside = F.coalesce(F.col("__latest") >= F.col("__at"), F.lit(False))
    return latest.select("__row.*", inside.alias(out))
