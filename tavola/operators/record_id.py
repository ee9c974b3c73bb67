"""Deterministic per-row record ids, computed once and carried through every branch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tavola.operators.hot import HOT_KEY_ROWS, hot_keys
from tavola.session import materialize


# Copies of one row that a single array of numbers is made for.
COPIES_AT_ONCE = 100_000
# Hash places that the rows of keys are counted in: several times the list of hot ones.
_KEY_PLACES = 65_536


def with_record_seq(df: DataFrame, key: Sequence[str], out: str = "record_seq") -> DataFrame:
    """Add ``out`` = 1..n inside each key, so that (key..., out) is unique and dense.

    Rows of a key are numbered in the order of all their other columns, whatever their
    number, the files they came from or the partitions they are in. Identical rows are first
    reduced to one with a count; the distinct rows are cut into ranges of (key, other
    columns), so that a key of any size spreads over many tasks; the ranges' sums per key
    give where each range's numbers start; the counts are expanded last.
    """
    keys = list(key)
    rest = [c for c in df.columns if c not in keys]
    distinct = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    # the range is written down once (checkpoint): all branches below read the same ranges
    ordered = [F.col(c).asc_nulls_first() for c in rest]
    ranged = distinct.repartitionByRange(*[F.col(c) for c in keys], *ordered) if df.columns else distinct
    ranged = materialize(ranged.withColumn("__range", F.spark_partition_id()))
    sums = ranged.groupBy(*keys, "__range").agg(F.sum("__n").alias("__rows"))
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        F.col("__range").alias("__of"),
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"),
    )
    inside = Window.partitionBy(*keys, "__range").orderBy(*ordered).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("__local", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    same = F.col("__range") == F.col("__of")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    first = local.join(starts, same).withColumn("__first", F.col("__start") + F.col("__local"))
    # copies in chunks, so that no array grows with a row's count
    chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__n") - 1, F.lit(COPIES_AT_ONCE).cast("bigint")))
    chunks = first.select(*df.columns, "__first", "__n", chunk.alias("__chunk"))
    copy = F.explode(F.sequence(F.col("__chunk"), F.least(F.col("__chunk") + COPIES_AT_ONCE, F.col("__n")) - 1))
    numbered = chunks.select(*df.columns, "__first", copy.alias("__copy"))
    return numbered.select(*df.columns, (F.col("__first") + F.col("__copy") + 1).cast("bigint").alias(out))


def continue_record_seq(
    df: DataFrame, key: Sequence[str], used: DataFrame, out: str = "record_seq", hot_rows: int = HOT_KEY_ROWS
) -> DataFrame:
    """``with_record_seq`` for rows that come after others: the numbers of a key go on behind the
    highest one given to it, which ``used`` (key..., high; any number of rows a key) names.

    Rows and ``used`` meet in one shuffle by key: there a key's highest number comes first and its
    rows are counted behind it. Keys that share a hash with more than ``hot_rows`` rows would be
    too long for a task; only they are cut into ranges by ``with_record_seq`` first.
    """
    keys = list(key)
    place = F.pmod(F.xxhash64(*keys), F.lit(_KEY_PLACES)) if keys else F.lit(0).cast("bigint")
    hot = [r["__place"] for r in hot_keys(df.select(place.alias("__place")), ["__place"], hot_rows).collect()]
    if not hot:
        return _continue_in_window(df, keys, used, out)
    few = _continue_in_window(df.filter(~place.isin(hot)), keys, used, out)
    return few.unionByName(_continue_in_ranges(df.filter(place.isin(hot)), keys, used, out))


def _continue_in_window(df: DataFrame, keys: list[str], used: DataFrame, out: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    rows = df.select("*", F.lit(1).alias("__row"), F.lit(None).cast("bigint").alias("__high"))
    marks = used.select(*keys, F.lit(0).alias("__row"), F.col("high").cast("bigint").alias("__high"))
    both = rows.unionByName(marks, allowMissingColumns=True)
    so_far = Window.partitionBy(*keys).orderBy("__row", *[F.col(c).asc_nulls_first() for c in rest]).rowsBetween(Window.unboundedPreceding, 0)
    number = F.coalesce(F.max("__high").over(so_far), F.lit(0)) + F.sum("__row").over(so_far)
    numbered = both.withColumn("__number", number).filter(F.col("__row") == 1)
    same_types = [F.col(c).cast(df.schema[c].dataType).alias(c) for c in df.columns]
    return numbered.select(*same_types, F.col("__number").cast("bigint").alias(out))


def _continue_in_ranges(df: DataFrame, keys: list[str], used: DataFrame, out: str) -> DataFrame:
    numbered = with_record_seq(df, keys, out)
    before = used.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.max("high").alias("__high"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    shifted = (F.col(out) + F.coalesce(F.col("__high"), F.lit(0))).cast("bigint")
    return numbered.join(before, same, "left").select(*df.columns, shifted.alias(out))
