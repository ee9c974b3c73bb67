"""Tables that grow by batches, where a repeated batch changes nothing.

INSERT ... SELECT run twice inserts twice. Here a batch owns a partition of the table: appending
writes that partition and no other (dynamic partition overwrite), so a batch that is run again after
a failure, or by mistake, puts the same rows in the same place. The files are written aside and moved
in when the job commits; until then readers see the batch as it was.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tavola.operators.joins import broadcast_if_small, unique_on
from tavola.operators.record_id import continue_record_seq
from tavola.session import ensure_checkpoint_dir, materialize

BATCH = "batch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder of the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid4().hex}"


class BatchTable:
    """A Parquet table of ``schema`` at ``path`` (shared storage), partitioned by batch number.

    With ``by``, a batch is also cut into ``buckets`` files by the hash of these columns, and what
    is read is known to lie so: joins and groups by ``by`` move no row. Spark keeps that layout in the
    catalog alone, so the folder is opened as a catalog table of a name of its own; the number
    of buckets a folder was begun with stays with it (beside it, in ``path``.buckets)."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, by: Sequence[str] = (), buckets: int = 1):
        self.spark, self.path, self.by = spark, path.rstrip("/"), list(by)
        self.columns = [f.name for f in schema if f.name != BATCH]
        self.schema = StructType([f for f in schema if f.name != BATCH]).add(BATCH, "long")
        # a table without batches can be read
        spark.createDataFrame([], self.schema).write.mode("ignore").partitionBy(BATCH).parquet(self.path)
        if self.by:
            begun = f"{self.path}.buckets"
            spark.createDataFrame([(buckets,)], "buckets int").write.mode("ignore").parquet(begun)
            self.buckets = spark.read.schema("buckets int").parquet(begun).first()["buckets"]
            self.table = f"tavola_batches_{uuid4().hex}"
            hashed = ", ".join(f"`{c}`" for c in self.by)
            spark.sql(
                f"CREATE TABLE {self.table} ({self.schema.toDDL()}) USING parquet PARTITIONED BY ({BATCH}) "
                f"CLUSTERED BY ({hashed}) SORTED BY ({hashed}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
            )

    def append(self, df: DataFrame, batch: int) -> int:
        """Makes the rows of ``df`` the rows of ``batch``; returns their number."""
        seen = Observation()
        rows = df.select(*self.columns, F.lit(batch).cast("bigint").alias(BATCH)).observe(seen, F.count(F.lit(1)).alias("n"))
        if self.by:
            self._insert(rows.repartition(self.buckets, *self.by))  # rows that lie so already stay where they are
        else:
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(self.path)
        n = seen.get["n"]
        if n == 0:  # no row names the partition: what an earlier run left in it goes
            none = self.spark.createDataFrame([], StructType(self.schema.fields[:-1]))
            if self.by:
                self.spark.sql(f"INSERT OVERWRITE TABLE {self.table} PARTITION ({BATCH} = {int(batch)}) SELECT * FROM {{none}}", none=none)
            else:
                none.write.mode("overwrite").parquet(f"{self.path}/{BATCH}={batch}")
        return n

    def _insert(self, rows: DataFrame) -> None:
        mode = "spark.sql.sources.partitionOverwriteMode"  # the writer's option of that name is for paths only
        usual = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")
        try:
            rows.write.mode("overwrite").insertInto(self.table)
        finally:
            self.spark.conf.set(mode, usual)

    def read(self, before: int | None = None, only: int | None = None) -> DataFrame:
        """All batches, those before one, or one: other partitions are not opened."""
        if self.by:
            # the batches in the folder now, whoever wrote them
            listed = self.spark.conf.get("spark.sql.hive.manageFilesourcePartitions", "true") == "true"
            (self.spark.catalog.recoverPartitions if listed else self.spark.catalog.refreshTable)(self.table)
            df = self.spark.table(self.table)
        else:
            df = self.spark.read.schema(self.schema).parquet(self.path)
        if only is not None:
            return df.filter(F.col(BATCH) == only)
        return df if before is None else df.filter(F.col(BATCH) < before)


class LastingIds:
    """IDENTITY for rows that arrive in batches: dense numbers per key that a later batch continues.

    Every batch leaves behind the highest number of each of its keys (an appended table at
    ``path``); a batch starts behind those of the batches before it. So ids once given never change,
    and a batch that is run again gives its rows the same ids. Batches are numbered in their order;
    one that is run again with other rows must be followed by those after it."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: Sequence[str], out: str = "record_seq"):
        self.key, self.out = list(key), out
        self.marks = BatchTable(spark, path, StructType([schema[k] for k in key]).add("high", "long"))

    def number(self, df: DataFrame, batch: int) -> DataFrame:
        """``df`` plus the id column; ``mark`` must follow, from the rows as they were written."""
        return continue_record_seq(df, self.key, self.marks.read(before=batch), self.out)

    def mark(self, numbered: DataFrame, batch: int) -> None:
        """Keeps the highest number of every key of a batch."""
        self.marks.append(numbered.groupBy(*self.key).agg(F.max(self.out).alias("high")), batch)

    def assign(self, df: DataFrame, batch: int) -> DataFrame:
        """``number`` and ``mark`` at once: ``df`` plus the id column, written down before it is used."""
        numbered = materialize(self.number(df, batch))
        self.mark(numbered, batch)
        return numbered


def refresh_partitions(
    spark: SparkSession, path: str, partition: str, changed: DataFrame, key: str | Sequence[str], update: Callable[[DataFrame], DataFrame]
) -> list:
    """UPDATE ... FROM JOIN on a partitioned table: rewrites the partitions of ``path`` that hold a
    key of ``changed``, each as ``update`` of its rows, and leaves the files of all others alone.
    Returns the partitions rewritten. Reads the table's key and partition columns to find them; the
    partition values that reach the driver are no more than the table has partitions."""
    keys = [key] if isinstance(key, str) else list(key)
    table = spark.read.parquet(path)
    touched = table.select(*keys, partition).join(broadcast_if_small(changed.select(*keys).distinct()), keys, "left_semi")
    values = [r[0] for r in touched.select(partition).distinct().collect()]
    if None in values:
        raise ValueError(f"{partition} is null for some of the changed rows")
    if values:
        rows = update(table.filter(F.col(partition).isin(values))).select(*table.columns)
        # one task a partition value would write a hot one alone: rows go by value and by a salt
        rows = rows.repartition(partition, F.pmod(F.xxhash64(*keys), F.lit(8)))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
        spark.catalog.refreshByPath(path)
    return sorted(values)


def update_from(df: DataFrame, changed: DataFrame, key: str | Sequence[str], values: Sequence[str]) -> DataFrame:
    """``df`` with ``values`` taken from ``changed`` where it has the key (a null there counts), as
    UPDATE ... FROM does; other rows stay as they are. A key that repeats gives its smallest row."""
    keys = [key] if isinstance(key, str) else list(key)
    new = unique_on(changed.select(*keys, F.struct(*values).alias("__new")), keys, ["__new"])
    hit = df.join(broadcast_if_small(new), keys, "left")
    taken = [F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in df.columns]
    return hit.select(*taken)
