"""Session construction and lineage cutting.

``get_spark`` only fills in settings when it has to build a session (tests, bench); an
existing cluster session is returned untouched so the cluster's own sizing wins.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings applied only when this module creates the session.
_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.driver.memory": os.environ.get("TAVOLA_DRIVER_MEMORY", "4g"),
}


def get_spark(app: str = "tavola", master: str | None = None, **conf: str) -> SparkSession:
    """Return the active session, or build a local one with sane defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    builder = builder.master(master or os.environ.get("TAVOLA_MASTER", "local[8]"))
    settings = dict(_LOCAL_DEFAULTS)
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    if "spark.sql.warehouse.dir" not in settings and _one_machine(master or os.environ.get("TAVOLA_MASTER", "local[8]")):
        # local sessions only: catalog tables go to a scratch folder, not the working dir
        settings["spark.sql.warehouse.dir"] = tempfile.mkdtemp(prefix="tavola-warehouse-")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _one_machine(master: str) -> bool:
    """True for ``local``, ``local[...]``: the only masters a machine-local folder serves."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder checkpoints go to: the session's ``spark.checkpoint.dir`` (the shared
    folder on a cluster), else the context's current one; only when neither exists and the
    master is local (tests) a scratch folder is made. Returns the folder the context writes to."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None and not _one_machine(sc.master):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="tavola-ckpt-"))
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    Used where several answers read one cleaned table: a lost executor then recomputes
    from the checkpoint files, not from the raw sources.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
