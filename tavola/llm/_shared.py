"""Small helpers the operators of this package share."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tavola.operators.ranges import with_position
from tavola.session import ensure_checkpoint_dir

#: A word: a run of characters other than the space and the controls 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back.

    Cuts lineage like ``checkpoint()`` but compressed and column-wise, so later steps read
    only the columns they need; survives the loss of any executor."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(col: str = "text") -> Column:
    """The text; null counts as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


#: The most ranges an order is cut into.
MOST_RANGES = 2**20


class Ranges:
    """A total order of rows by some of their columns, cut into ranges of about ``rows`` rows with bounds
    from the data: distances between keys play no part, rows of one key are in one range, and keys sort
    as structs do (null first). DataFrame functions only; the bounds are one row of at most MOST_RANGES
    keys."""

    def __init__(self, keys: DataFrame, rows: int):
        self.names, n = keys.columns, keys.count()
        self.rows = max(rows, -(-n // MOST_RANGES))
        width = max(1, int((n // self.rows) ** 0.5))
        order = [F.col(c).asc_nulls_first() for c in self.names]
        # every row with its place in the order; a range begins at every ``rows``-th
        self.placed = stash(with_position(keys, order, "__at"), "range-places")
        every = self.placed.filter(F.col("__at") % self.rows == 0).groupBy().agg(F.sort_array(F.collect_set(self.key())).alias("every"))
        groups = F.when(F.size("every") > 0, F.sequence(F.lit(1), F.size("every"), F.lit(width))).otherwise(F.array().cast("array<int>"))
        fine = F.transform(groups, lambda k: F.slice("every", k, F.lit(width)))
        coarse = F.transform(groups, lambda k: F.element_at("every", k))
        self.bounds = stash(every.select(fine.alias("__fine"), coarse.alias("__coarse"), F.lit(width).alias("__width")), "range-bounds")

    def key(self) -> Column:
        return F.struct(*self.names)

    def number(self, df: DataFrame, out: str) -> DataFrame:
        """``df``, which has the key's columns, plus the number of the row's range: how many ranges begin
        at or before its key, looked up among the first of each group of bounds, then in the group."""
        d = df.crossJoin(F.broadcast(self.bounds)).withColumn("__key", self.key())
        group = F.size(F.filter("__coarse", lambda c: c <= F.col("__key")))
        inside = F.size(F.filter(F.element_at("__fine", F.greatest(group, F.lit(1))), lambda c: c <= F.col("__key")))
        number = F.when(group == 0, 0).otherwise((group - 1) * F.col("__width") + inside).cast("long")
        return d.withColumn(out, number).drop("__fine", "__coarse", "__width", "__key")


_SHIPPED: set[tuple[str, str]] = set()


def on_workers(df: DataFrame) -> DataFrame:
    """``df``, after Spark has been given this package for its Python workers: they import the
    functions that the tasks name, wherever the driver was started from."""
    package = Path(__file__).resolve().parents[1]
    files = sorted(package.rglob("*.py"))
    digest = hashlib.sha256(b"".join(f.read_bytes() for f in files)).hexdigest()[:16]
    context = df.sparkSession.sparkContext
    if (context.applicationId, digest) not in _SHIPPED:
        archive = Path(tempfile.mkdtemp(prefix="tavola-package-")).resolve() / f"tavola-{digest}.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in files:
                z.write(f, f.relative_to(package.parent))
        context.addPyFile(str(archive))  # served by the driver, fetched by every executor
        _SHIPPED.add((context.applicationId, digest))
    return df


def native_word_count(text: Column) -> Column:
    """Number of words, by built-in functions."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")
