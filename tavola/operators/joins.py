"""Joins to lookup tables, with a checked broadcast and a shuffle path beyond it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.session import materialize

# Upper bound for hinting a broadcast; above it the join is left to a shuffle join
# (and to AQE, which may still broadcast once it has seen the real size).
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of ``df`` (file sizes scaled by pruning), or None if unknown."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()  # noqa: SLF001
    except Exception:  # pragma: no cover - e.g. a Connect session exposes no plan stats
        return None
    # py4j hands a Scala BigInt over as a Python int; keep a string fallback
    return int(size) if isinstance(size, int) else int(str(size))


def fits_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df``'s estimated size is known and under ``max_bytes``.

    The session setting ``tavola.broadcast.maxBytes`` lowers the cap for every check (a
    cluster operator's limit; ``0`` turns size-based broadcasts off).
    """
    try:
        session_cap = df.sparkSession.conf.get("tavola.broadcast.maxBytes", None)
    except Exception:  # pragma: no cover - sessions without a readable conf
        session_cap = None
    if session_cap is not None:
        max_bytes = min(max_bytes, int(session_cap))
    size = estimated_bytes(df)
    return size is not None and size <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` only when ``fits_broadcast``; otherwise a shuffle join decides."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


def splittable(side: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """An aggregated side that raw rows with a hot key join: broadcast while it is small, else
    written to the checkpoint folder first. AQE splits a hot partition only when both sides
    of the join sit directly on its shuffles; read back, the aggregate does. A streaming side is
    left as it is."""
    if fits_broadcast(side, max_bytes):
        return F.broadcast(side)
    return side if side.isStreaming else materialize(side)


def unique_on(dim: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row per key: the smallest values win where the lookup table repeats a key.

    An UPDATE … FROM with several matches picks one row arbitrarily; a join would
    multiply rows instead. Pre-aggregating keeps the row count of the enriched table.
    """
    if len(values) == 1:
        return dim.groupBy(*keys).agg(F.min(values[0]).alias(values[0]))
    least = dim.groupBy(*keys).agg(F.min(F.struct(*values)).alias("__least"))  # all from one row
    return least.select(*keys, *[F.col(f"__least.{v}").alias(v) for v in values])


def enrich(
    df: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    values: Sequence[str],
    rename: dict[str, str] | None = None,
    dedupe: bool = False,
    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Left-join ``values`` of ``dim`` onto ``df`` by key(s); unmatched rows get NULL."""
    keys = [on] if isinstance(on, str) else list(on)
    side = dim.select(*keys, *values)
    if dedupe:
        side = unique_on(side, keys, values)
    if rename:
        side = side.select(*keys, *[F.col(v).alias(rename.get(v, v)) for v in values])
    ready = splittable if dedupe else broadcast_if_small
    return df.join(ready(side, max_broadcast_bytes), keys, "left")


def lookup_names(
    df: DataFrame,
    id_cols: Sequence[str],
    dim: DataFrame,
    dim_id: str,
    dim_name: str,
    suffix: str = "_name",
    key: Sequence[str] | None = None,
    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Add ``<id_col><suffix>`` for each id column by looking the id up in ``dim``.

    Small lookup table: one broadcast hash join per column, no shuffle. Large one with a
    row ``key`` given: the ids are stacked into (key, slot, id) rows, joined to the
    lookup table once, and pivoted back per key — one shuffle of the lookup table instead
    of one per column. Without a key, one shuffle join per column. All ways give the same
    rows: a lookup id that repeats counts once, with its smallest name.
    """
    lookup = unique_on(dim, [dim_id], [dim_name])
    small = fits_broadcast(dim.select(dim_id, dim_name), max_broadcast_bytes)
    if small or not key or len(id_cols) < 2:
        side = F.broadcast(lookup) if small else lookup
        out = df
        for c in id_cols:
            named = side.select(F.col(dim_id).alias(f"__id_{c}"), F.col(dim_name).alias(f"{c}{suffix}"))
            out = out.join(named, out[c] == named[f"__id_{c}"], "left").drop(f"__id_{c}")
        return out
    # rows with the same key and ids get the same names, so copies of a row are no harm
    keys = list(dict.fromkeys([*key, *id_cols]))
    slots = F.array(*[F.struct(F.lit(i).alias("slot"), F.col(c).alias("id")) for i, c in enumerate(id_cols)])
    stacked = df.select(*keys, F.explode(slots).alias("__e")).select(*keys, F.col("__e.slot").alias("__slot"), F.col("__e.id").alias("__id"))
    named = stacked.filter(F.col("__id").isNotNull()).join(
        lookup.select(F.col(dim_id).alias("__id"), F.col(dim_name).alias("__name")), "__id", "inner"
    )
    wide = named.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(
        *[F.max(F.when(F.col("__slot") == i, F.col("__name"))).alias(f"{c}{suffix}") for i, c in enumerate(id_cols)]
    )
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return df.join(wide, same, "left").drop(*[f"__{k}" for k in keys])
