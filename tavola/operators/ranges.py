"""Numbers in a total order, from ranges that many tasks sort.

Rows are cut into ranges of the order, and the cut is written down (a checkpoint), so that all that
follows sees the same ranges. What a range holds is counted where it lies; only these counts, one row
a range or one row a key and range, are summed up over the ranges before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tavola.operators.joins import broadcast_if_small
from tavola.session import materialize

_PLACE_BITS = 33  # of monotonically_increasing_id: the row's place in its partition


def with_position(df: DataFrame, order: Sequence[Column], out: str = "position") -> DataFrame:
    """``df`` plus ``out``, the place of the row in ``order``, from 1: a final ORDER BY that stays
    with the rows. Ties of ``order`` take any of their places, so name columns that tell rows apart.
    One shuffle; the counts that reach the driver are one a shuffle partition."""
    sorted_ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(sorted_ranges.withColumn("__id", F.monotonically_increasing_id()))
    number, place = F.shiftright("__id", _PLACE_BITS), F.col("__id").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    placed = placed.select(*df.columns, number.alias("__range"), place.alias("__place"))
    before, starts = 0, []
    for r in sorted(placed.groupBy("__range").count().collect()):
        starts.append((r["__range"], before))
        before += r["count"]
    starts = df.sparkSession.createDataFrame(starts, "__range long, __start long")
    position = (F.col("__start") + F.col("__place") + 1).cast("bigint")
    return placed.join(F.broadcast(starts), "__range").select(*df.columns, position.alias(out))


def dense_rank_in_ranges(
    df: DataFrame, partition: str | Sequence[str], by: str, out: str = "rnk", descending: bool = False
) -> DataFrame:
    """DENSE_RANK over ``partition`` by ``by`` for every row of ``df``, in two levels.

    The distinct (partition, by) pairs are cut into ranges, so the values of a hot partition spread
    over many tasks; a value's rank is its place among those of its partition in its range, behind
    the number of those in earlier ranges. Null keys are one partition and a null value is ranked
    first (last when descending), as the window function does."""
    keys = [partition] if isinstance(partition, str) else list(partition)
    names = [f"__key{i}" for i in range(len(keys))]
    distinct = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(by).alias("__by")).distinct()
    value_of = F.col("__by").desc_nulls_last() if descending else F.col("__by").asc_nulls_first()
    cut = materialize(distinct.repartitionByRange(*names, value_of).withColumn("__range", F.spark_partition_id()))
    sizes = cut.groupBy(*names, "__range").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*names).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *[F.col(n).alias(f"{n}_of") for n in names], F.col("__range").alias("__range_of"), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start")
    )
    local = cut.withColumn("__local", F.row_number().over(Window.partitionBy(*names, "__range").orderBy(value_of)))
    same = F.col("__range") == F.col("__range_of")
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"{n}_of"))
    ranked = local.join(broadcast_if_small(starts), same).select(*names, "__by", (F.col("__start") + F.col("__local")).cast("bigint").alias("__rank"))
    match = F.col(by).eqNullSafe(F.col("__by"))
    for k, n in zip(keys, names, strict=True):
        match = match & F.col(k).eqNullSafe(F.col(n))
    return df.join(broadcast_if_small(ranked), match, "left").select(*df.columns, F.col("__rank").alias(out))
