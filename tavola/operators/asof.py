"""As-of lookups: for each left row, the earliest right-side instant strictly after it, or the last
right-side row before it.

A plain window over (key) would put every event of a hot key in one task, and an
equi-join on key with ``right.ts > left.ts`` emits all pairs of a key. Instead:

1. Inside each (key, time bucket) the nearest later right instant comes from a running
   minimum over rows sorted by time descending — partitions are (key, bucket), so a hot
   key is spread over its buckets. Keys with more than ``hot_rows`` rows use the finer
   ``hot_bucket`` granularity (one granularity per key, so step 2 stays exact).
2. Rows with no later right instant in their own bucket take the earliest right instant
   of any later bucket: per (key, bucket) minima are tiny (one row per bucket), and a
   running minimum over them, per key, answers "earliest in a later bucket".

``last_before`` looks the other way, in the same two steps with running maxima, and carries left rows
and values of the right row along, so both sides move once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tavola.operators.hot import HOT_KEY_ROWS, hot_keys


def next_after(
    left: DataFrame,
    right: DataFrame,
    key: str | Sequence[str],
    ts: str,
    out: str = "next_ts",
    right_ts: str | None = None,
    bucket: str = "day",
    hot_bucket: str = "minute",
    hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """``left`` plus ``out`` = min(right.ts) with right.ts > left.ts for the same key (or NULL).

    The lookup runs on distinct (key, instant) pairs of each side — copies of an instant
    share one answer — and the answer is joined back to every left row.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rts = right_ts or ts
    instants = left.select(*keys, ts).distinct()
    targets = right.select(*keys, F.col(rts).alias(ts)).distinct()
    found = _next_instants(instants, targets, keys, ts, out, bucket, hot_bucket, hot_rows)
    return left.join(found, keys + [ts], "left")


def _next_instants(
    left: DataFrame,
    rsel: DataFrame,
    keys: list[str],
    ts: str,
    out: str,
    bucket: str,
    hot_bucket: str,
    hot_rows: int,
) -> DataFrame:
    side, bkt = "__side", "__bucket"
    hot = hot_keys(left.select(*keys).unionByName(rsel.select(*keys)), keys, hot_rows)

    def bucketed(df: DataFrame) -> DataFrame:
        tagged = df.join(hot, keys, "left")
        fine = F.coalesce(F.col("__hot"), F.lit(False))
        b = F.when(fine, F.date_trunc(hot_bucket, F.col(ts))).otherwise(F.date_trunc(bucket, F.col(ts)))
        return tagged.withColumn(bkt, b).drop("__hot")

    lrows = bucketed(left.withColumn(side, F.lit(0)))
    rrows = bucketed(rsel.withColumn(side, F.lit(1)))
    both = lrows.unionByName(rrows, allowMissingColumns=True)

    # 1. nearest later right instant inside the same (key, bucket).
    w_in = (
        Window.partitionBy(*keys, bkt)
        .orderBy(F.col(ts).desc(), F.col(side).asc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    windowed = both.withColumn("__in", F.min(F.when(F.col(side) == 1, F.col(ts))).over(w_in))
    within = windowed.filter(F.col(side) == 0)

    # 2. earliest right instant in any strictly later bucket of the same key. The
    #    per-(key, bucket) minima come from the windowed rows, which are already
    #    partitioned by (key, bucket), so this aggregate adds no shuffle.
    buckets = windowed.groupBy(*keys, bkt).agg(F.min(F.when(F.col(side) == 1, F.col(ts))).alias("__bmin"))
    w_later = Window.partitionBy(*keys).orderBy(F.col(bkt).desc()).rowsBetween(Window.unboundedPreceding, -1)
    later = buckets.withColumn("__later", F.min("__bmin").over(w_later)).select(*keys, bkt, "__later")

    joined = within.join(later, keys + [bkt], "left")
    return joined.withColumn(out, F.coalesce(F.col("__in"), F.col("__later"))).drop(side, bkt, "__in", "__later")


def last_before(
    left: DataFrame,
    right: DataFrame,
    key: str | Sequence[str],
    ts: str,
    values: Mapping[str, str],
    right_ts: str | None = None,
    inclusive: bool = False,
    longest_gap: str | None = None,
    bucket: str = "day",
    hot_bucket: str = "minute",
    hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """``left`` plus ``values`` (column of ``right`` -> name in the result) of the last right row of the
    same key before ``ts`` (``inclusive``: or at it); NULL where there is none, or where it is more than
    ``longest_gap`` (an interval, e.g. '7 days') back. Of right rows at one instant the one with the
    largest values counts. A null key or instant matches nothing; no left row is lost or doubled."""
    keys = [key] if isinstance(key, str) else list(key)
    rts = right_ts or ts
    names = [f"__key{i}" for i in range(len(keys))]
    as_names = [F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]
    hot = hot_keys(left.select(*as_names).unionByName(right.select(*as_names)), names, hot_rows)
    # at one instant the side that comes first does not see the other
    left_side, right_side = (1, 0) if inclusive else (0, 1)
    lrows = left.select(*as_names, F.col(ts).alias("__ts"), F.lit(left_side).alias("__side"), F.struct(*[F.col(c) for c in left.columns]).alias("__row"))
    found = F.struct(F.col(rts).alias("__at"), *[F.col(c).alias(v) for c, v in values.items()])
    rrows = right.dropna(subset=[*keys, rts]).select(*as_names, F.col(rts).alias("__ts"), F.lit(right_side).alias("__side"), found.alias("__found"))
    both = lrows.unionByName(rrows, allowMissingColumns=True).join(hot, names, "left")
    fine = F.coalesce(F.col("__hot"), F.lit(False))
    both = both.withColumn("__bucket", F.when(fine, F.date_trunc(hot_bucket, "__ts")).otherwise(F.date_trunc(bucket, "__ts")))
    inside = Window.partitionBy(*names, "__bucket").orderBy("__ts", "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    windowed = both.withColumn("__in", F.max("__found").over(inside))
    # the last right row of any earlier bucket, from one row a bucket
    tops = windowed.groupBy(*names, "__bucket").agg(F.max("__found").alias("__top"))
    earlier = Window.partitionBy(*names).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = tops.select(*names, "__bucket", F.max("__top").over(earlier).alias("__carried"))
    rows = windowed.filter(F.col("__side") == left_side).join(carried, [*names, "__bucket"], "left")
    best = F.coalesce(F.col("__in"), F.col("__carried"))
    near = F.lit(True) if longest_gap is None else best["__at"] >= F.col("__ts") - F.expr(f"INTERVAL {longest_gap}")
    return rows.select("__row.*", *[F.when(near, best[v]).alias(v) for v in values.values()])
