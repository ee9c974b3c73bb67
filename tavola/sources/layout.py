"""Physical layout for the big order tables: bucketed by the order key.

Most delivery answers join order lines to orders on the order key and then aggregate
per order. Written once with the same bucket count on that key, both tables are read
already hash-partitioned, so the join and the per-order aggregates run without a
shuffle of either table. The bucket count should be sized so one bucket of the larger
table is a few hundred MB.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tavola.operators.joins import estimated_bytes
from tavola.sources.testdata import Tables

#: Bytes of the larger table in a bucket, by the optimizer's estimate.
BUCKET_BYTES = 256 * 1024 * 1024


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, mode: str = "overwrite") -> None:
    """Save ``df`` as a catalog table bucketed and sorted by ``key``."""
    df.write.mode(mode).bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)


def bucketed_order_tables(
    spark: SparkSession,
    lineitem: DataFrame,
    orders: DataFrame,
    buckets: int,
    prefix: str = "tavola_",
) -> tuple[DataFrame, DataFrame]:
    """Write lineitem/orders bucketed on the order key; return the tables read back."""
    write_bucketed(lineitem, f"{prefix}lineitem", "l_orderkey", buckets)
    write_bucketed(orders, f"{prefix}orders", "o_orderkey", buckets)
    return spark.table(f"{prefix}lineitem"), spark.table(f"{prefix}orders")


def in_order_layout(t: Tables) -> Tables:
    """``t`` with lineitem and orders as bucketed tables of names of their own, their number of buckets
    from the larger one's size and no less than the session's shuffle partitions."""
    least = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, -(-(estimated_bytes(t.lineitem) or 0) // BUCKET_BYTES))
    lineitem, orders = bucketed_order_tables(t.spark, t.lineitem, t.orders, buckets, prefix=f"tavola_{uuid4().hex}_")
    return t.replaced(lineitem=lineitem, orders=orders)
