"""Per-record ingredient multisets in long form: (record, item, qty).

Standard items plus extras minus exclusions, where an exclusion removes every copy of
the item, extras included. Items are compared as values, never as substrings of text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def adjust(
    standard: DataFrame,
    extras: DataFrame,
    exclusions: DataFrame,
    key: str | Sequence[str],
    item: str = "item",
    standard_is_set: bool = False,
) -> DataFrame:
    """(key..., item, qty): multiplicity of each item after adding extras and removing exclusions.

    Each input holds one row per occurrence (key..., item). The three are tagged and
    unioned, then reduced by ``adjust_tagged`` in a single aggregate.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = keys + [item]

    def tag(df: DataFrame, s: int, e: int, x: int) -> DataFrame:
        return df.select(*cols, F.lit(s).alias("__std"), F.lit(e).alias("__ext"), F.lit(x).alias("__exc"))

    rows = tag(standard, 1, 0, 0).unionByName(tag(extras, 0, 1, 0)).unionByName(tag(exclusions, 0, 0, 1))
    return adjust_tagged(rows, keys, item, "__std", "__ext", "__exc", standard_is_set)


def adjust_tagged(
    rows: DataFrame,
    key: str | Sequence[str],
    item: str,
    is_standard: str | Column,
    is_extra: str | Column,
    is_exclusion: str | Column,
    standard_is_set: bool = False,
) -> DataFrame:
    """The multiset edit from one table of tagged occurrence rows, in one aggregate.

    Per (key, item): standard copies (or 1 when the standard recipe is a set) plus
    extras, dropped entirely when any exclusion row names the item. A map-side
    combined aggregate on (key, item): one shuffle, and a hot record collapses to its
    distinct items before it moves.
    """
    keys = [key] if isinstance(key, str) else list(key)
    flag = lambda c: (F.col(c) if isinstance(c, str) else c).cast("int")
    std = F.max(flag(is_standard)) if standard_is_set else F.sum(flag(is_standard))
    g = (
        rows.filter(F.col(item).isNotNull())
        .groupBy(*keys, item)
        .agg(std.alias("__s"), F.sum(flag(is_extra)).alias("__e"), F.max(flag(is_exclusion)).alias("__x"))
    )
    qty = (F.col("__s") + F.col("__e")).cast("bigint")
    return g.filter((F.col("__x") == 0) & (qty > 0)).select(*keys, item, qty.alias("qty"))


def copies_list(
    qty: DataFrame, key: str | Sequence[str], item: str = "item", count: str = "qty", sep: str = ",", out: str = "items"
) -> DataFrame:
    """One string per key listing every copy of every item, sorted case-insensitively.

    Copies are expanded inside the collected (bounded, per-record) array, not as rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    entry = F.struct(F.lower(F.col(item)).alias("k"), F.col(item).alias("i"), F.col(count).cast("int").alias("n"))
    sorted_entries = F.array_sort(F.collect_list(entry))
    copies = F.flatten(F.transform(sorted_entries, lambda e: F.array_repeat(e["i"], e["n"])))
    return qty.groupBy(*keys).agg(F.array_join(copies, sep).alias(out))


def format_list(
    qty: DataFrame,
    key: str | Sequence[str],
    item: str = "item",
    count: str = "qty",
    sep: str = ", ",
    out: str = "items",
    times: str = "x",
    min_mark: int = 2,
) -> DataFrame:
    """One string per key: items sorted case-insensitively, ``"2xBacon"`` when qty ≥ ``min_mark``.

    The collected group is the distinct items of one record (bounded by the item
    vocabulary), not raw rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    label = F.when(F.col(count) >= min_mark, F.concat(F.col(count).cast("string"), F.lit(times), F.col(item))).otherwise(
        F.col(item)
    )
    entry = F.struct(F.lower(F.col(item)).alias("k"), F.col(item).alias("i"), label.alias("v"))
    agg = F.array_sort(F.collect_list(entry))
    return qty.groupBy(*keys).agg(F.array_join(F.transform(agg, lambda e: e["v"]), sep).alias(out))


def total_by_item(qty: DataFrame, item: str = "item", count: str = "qty", out: str = "total") -> DataFrame:
    """Total quantity of each item across all records."""
    return qty.groupBy(item).agg(F.sum(count).cast("bigint").alias(out))


def item_lists(
    items: DataFrame,
    key: Sequence[str],
    kinds: Mapping[str, str],
    kind: str = "kind",
    item: str = "item",
    pos: str = "pos",
    sep: str = ", ",
    flags: Mapping[str, str] | None = None,
) -> DataFrame:
    """(key..., <out> per kind): each kind's items as one string per key.

    ``flags`` maps kind -> column set to 1 when the key has any row of that kind (NULL
    otherwise), computed in the same aggregate.

    Items are first reduced to (key, kind, item) with their first position and count — a
    map-side combined aggregate, so a record with very many modifier rows collapses to
    its distinct items — then listed by (first position, name), each repeated as often
    as it occurs. A kind with no rows gives NULL (a string aggregate over no rows).
    """
    keys = list(key)
    per_item = items.groupBy(*keys, kind, item).agg(F.min(pos).alias("__p"), F.count(F.lit(1)).alias("__n"))

    def listed(value: str) -> Column:
        entry = F.struct(F.col("__p").alias("p"), F.col(item).alias("i"), F.col("__n").cast("int").alias("n"))
        hit = (F.col(kind) == F.lit(value)) & F.col(item).isNotNull()
        entries = F.array_sort(F.collect_list(F.when(hit, entry)))
        names = F.flatten(F.transform(entries, lambda e: F.array_repeat(e["i"], e["n"])))
        return F.when(F.size(entries) > 0, F.array_join(names, sep))

    aggs = [listed(v).alias(out) for v, out in kinds.items()]
    aggs += [F.max(F.when(F.col(kind) == F.lit(v), F.lit(1))).alias(out) for v, out in (flags or {}).items()]
    return per_item.groupBy(*keys).agg(*aggs)


def joined_list(
    df: DataFrame,
    key: str | Sequence[str],
    value: str,
    order: str | None = None,
    sep: str = ",",
    out: str = "items",
) -> DataFrame:
    """(key..., out): ``value``s of each key joined by ``sep`` in ``order`` (default: value).

    Copies of a (key, order, value) row are counted first — a map-side combined
    aggregate — so a key with many repeated rows collects one entry per distinct value;
    each value is then repeated as often as it occurred.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = order or value
    group = [*keys, value] if order == value else [*keys, order, value]
    counted = df.groupBy(*group).agg(F.count(F.lit(1)).alias("__n"))
    entry = F.struct(F.col(order).alias("o"), F.col(value).alias("v"), F.col("__n").cast("int").alias("n"))
    entries = F.array_sort(F.collect_list(entry))
    values = F.flatten(F.transform(entries, lambda e: F.array_repeat(e["v"], e["n"])))
    return counted.groupBy(*keys).agg(F.array_join(values, sep).alias(out))
