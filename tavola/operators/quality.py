"""Value constraints (SQL CHECK) as a valid / rejected split instead of a failing insert."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def check_passes(condition: Column) -> Column:
    # A CHECK passes when its condition is TRUE or UNKNOWN; only FALSE rejects a row.
    return F.coalesce(condition, F.lit(True))


def check_split(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) rows of ``df`` under a CHECK ``condition``."""
    ok = check_passes(condition)
    return df.filter(ok), df.filter(~ok)


def check_status(df: DataFrame, condition: Column, out: str = "check_status") -> DataFrame:
    """``df`` with ``out`` = 'valid' or 'rejected' — one pass, no second scan."""
    return df.withColumn(out, F.when(check_passes(condition), F.lit("valid")).otherwise(F.lit("rejected")))


@dataclass
class Checked:
    """What ``write_checked`` wrote: rows that pass all rules, rows that fail some (``failed_rules``
    names them), and how many rows there were and failed each rule."""

    valid: DataFrame
    rejected: DataFrame
    rows: int
    failed: dict[str, int]


def write_checked(df: DataFrame, rules: Mapping[str, Column], path: str) -> Checked:
    """Writes ``df`` once, to a partition of valid and one of rejected rows at ``path``, and counts the
    failures of every rule while it is written: one scan of the input, whatever the number of rules."""
    failed = F.array_compact(F.array(*[F.when(~check_passes(c), F.lit(name)) for name, c in rules.items()]))
    status = F.when(F.size("failed_rules") == 0, F.lit("valid")).otherwise(F.lit("rejected"))
    rows = df.withColumn("failed_rules", failed.cast("array<string>")).withColumn("check_status", status)
    seen = Observation()
    counts = [F.count_if(F.array_contains("failed_rules", name)).alias(f"rule{i}") for i, name in enumerate(rules)]
    rows.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).write.partitionBy("check_status").parquet(path)
    written = df.sparkSession.read.schema(rows.schema).parquet(path)
    part = lambda status: written.filter(F.col("check_status") == status).drop("check_status")
    found = seen.get
    return Checked(part("valid").drop("failed_rules"), part("rejected"), found["rows"], {n: found[f"rule{i}"] for i, n in enumerate(rules)})
