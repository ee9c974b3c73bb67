"""Exact distinct counts that can be added up: bitmaps of ids per day, merged to longer periods.

``count(distinct)`` of a month cannot be had from those of its days. The set of a day's ids can:
as bitmaps of 32,768 ids each, written once a day. Weeks, months and any other set of days are the
OR of their bitmaps, so the rows behind them are read once, and a new day adds only its own.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day_bitmaps(df: DataFrame, day: str, ids: str) -> DataFrame:
    """(day, bucket, bits): the distinct ``ids`` (whole numbers from 0) of every day. A map-side
    combined aggregate: a hot id or day is one bitmap a task before anything moves. Null ids and
    days are left out, as ``count(distinct)`` leaves out null ids."""
    known = df.filter(F.col(ids).isNotNull() & F.col(day).isNotNull())
    at = F.col(ids).cast("bigint")
    return known.groupBy(F.to_date(day).alias("day"), F.bitmap_bucket_number(at).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")
    )


def distinct_in_periods(bitmaps: DataFrame, periods: Mapping[str, Column], out: str = "n") -> DataFrame:
    """(period, start, ``out``) of each of ``periods`` (name -> start of the period over ``day``),
    from ``day_bitmaps`` of any batches: those of one day and bucket are merged too."""
    starts = F.explode(F.array(*[F.struct(F.lit(name).alias("period"), start.alias("start")) for name, start in periods.items()]))
    merged = bitmaps.select(starts.alias("__p"), "bucket", "bits").groupBy("__p.period", "__p.start", "bucket").agg(
        F.bitmap_or_agg("bits").alias("bits")
    )
    return merged.groupBy("period", "start").agg(F.sum(F.bitmap_count("bits")).cast("bigint").alias(out))
