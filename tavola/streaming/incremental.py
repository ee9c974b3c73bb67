"""Run an answer incrementally: stream the fact table, keep the dimensions static.

The answers are plain ``DataFrame -> DataFrame`` functions, so a streaming fact input
(``readStream``) joined to static lookup tables gives a streaming aggregate whose state
Spark keeps in the checkpoint folder. Nothing here is a new operator: it is the same
plan, re-run on each micro-batch of new files.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tavola.functions.clean import numeric_cast
from tavola.session import ensure_checkpoint_dir

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _is_folder(spark: SparkSession, path: str) -> bool:
    """Asks the path's own file system, so that it holds for remote folders too."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    return fs.exists(hadoop) and fs.getFileStatus(hadoop).isDirectory()


def event_sales_stream(spark: SparkSession, events_path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Purchase events of a (growing) parquet location as a streaming ``sales`` table."""
    reader = spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
    if events_path.endswith(".parquet") and not _is_folder(spark, events_path):
        # a single file: watch its folder through a glob that matches exactly that name
        folder, base = os.path.split(events_path)
        events_path = os.path.join(folder, f"[{base[0]}]{base[1:]}")
    events = reader.parquet(events_path)
    return events.filter(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("customer_id"),
        F.to_date("ts").alias("order_date"),
        numeric_cast(F.regexp_extract("props", r"([0-9]+)", 1), "bigint").alias("product_id"),
    )


def run_incremental(
    answer: Callable[..., DataFrame],
    stream: DataFrame,
    *static: DataFrame,
    name: str,
    sink: str,
    output_mode: str = "complete",
) -> StreamingQuery:
    """Start ``answer(stream, *static)`` as a streaming query with a reliable checkpoint.

    The caller names the sink; ``memory`` brings the whole result to the driver and is for
    tests only.

    The checkpoint goes under the session's ``spark.checkpoint.dir`` (the shared folder
    on a cluster), so a restarted driver resumes from the last committed batch.
    """
    spark = stream.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    location = os.path.join(base, "streams", name)
    result = answer(stream, *static)
    return (
        result.writeStream.format(sink)
        .queryName(name)
        .outputMode(output_mode)
        .option("checkpointLocation", location)
        .start()
    )
