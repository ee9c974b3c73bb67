"""Ingredient answers: standard recipes, favourite modifiers, order labels, ingredient lists.

Modifiers and recipes travel in long form — (record..., pos, item) rows — so that lists
of any length work and grouping never collects more than one record's own items.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.functions import csv_items
from tavola.operators import broadcast_if_small, format_list, item_lists, joined_list, keep_max_ties, splittable, total_by_item, with_position

# Display names and fall-backs of the order label.
LABEL_UNMODIFIED = {"Meatlovers": "Meat Lovers", "Vegetarian": "Vegetarian Lovers"}
LABEL_MODIFIED = {"Meatlovers": "Meat Lovers"}
LABEL_MODIFIED_DEFAULT = "Vegetarian Lovers"
LABEL_UNMODIFIED_DEFAULT = "No modifications"
LABEL_UNKNOWN = "Unknown modification"


# I01
def standard_ingredients(
    recipe_named: DataFrame, sep: str = ",", order_by: str = "topping_id", key: str = "pizza_id"
) -> DataFrame:
    return joined_list(recipe_named, key, "topping_name", order_by, sep, out="toppings")


# I02 / I03
def top_modifier(co: DataFrame, col: str, toppings: DataFrame, sep: str = ",") -> DataFrame:
    """Most frequent modifier in ``col`` (ties kept); tokens that are not topping ids drop out."""
    ids = co.select(F.explode(csv_items(col, sep, "int")).alias("topping_id")).filter(F.col("topping_id").isNotNull())
    named = ids.join(broadcast_if_small(toppings.select("topping_id", "new_topping_name")), "topping_id", "inner")
    return top_items(named.select(F.col("new_topping_name").alias("item")))


def top_items(items: DataFrame, item: str = "item") -> DataFrame:
    """(new_topping_name, topping_count) of the most frequent item, ties kept."""
    counts = items.groupBy(item).agg(F.count(F.lit(1)).alias("topping_count"))
    return keep_max_ties(counts, "topping_count").select(F.col(item).alias("new_topping_name"), "topping_count")


# I04
def _pick(col: F.Column, mapping: Mapping[str, str] | None, default: str) -> F.Column:
    if mapping is None:  # identity: the pizza name is its own label
        return col
    expr = F.lit(default)
    for k, v in mapping.items():
        expr = F.when(col == F.lit(k), F.lit(v)).otherwise(expr)
    return expr


def label_sentence(
    name: F.Column,
    has_exclusions: F.Column,
    has_extras: F.Column,
    exclusion_list: F.Column,
    extra_list: F.Column,
    unmodified: Mapping[str, str] | None = LABEL_UNMODIFIED,
    modified: Mapping[str, str] | None = LABEL_MODIFIED,
    modified_default: str = LABEL_MODIFIED_DEFAULT,
    unmodified_default: str = LABEL_UNMODIFIED_DEFAULT,
) -> F.Column:
    """'Meat Lovers with exclude A, B and extras C' — NULL-propagating concatenation, so a
    present list that resolved to no name gives 'Unknown modification'."""
    sentence = F.concat(
        _pick(name, modified, modified_default),
        F.lit(" with "),
        F.when(has_exclusions, F.concat(F.lit("exclude "), exclusion_list)).otherwise(F.lit("")),
        F.when(has_exclusions & has_extras, F.lit(" and ")).otherwise(F.lit("")),
        F.when(has_extras, F.concat(F.lit("extras "), extra_list)).otherwise(F.lit("")),
    )
    return F.when(~has_exclusions & ~has_extras, _pick(name, unmodified, unmodified_default)).otherwise(
        F.coalesce(sentence, F.lit(LABEL_UNKNOWN))
    )


def order_label(
    rows: DataFrame,
    exclusion_items: DataFrame,
    extra_items: DataFrame,
    key: Sequence[str] = ("record_id",),
    has_exclusions: str = "exclusions",
    has_extras: str = "extras",
    **labels,
) -> DataFrame:
    """``rows`` plus ``order_details``.

    ``*_items`` are (key..., pos, item) rows of resolved modifier names; both lists come
    from one aggregate over their tagged union, joined back to ``rows`` by key.
    """
    keys = list(key)
    tagged = exclusion_items.select(*keys, "pos", "item", F.lit("x").alias("kind")).unionByName(
        extra_items.select(*keys, "pos", "item", F.lit("e").alias("kind"))
    )
    lists = item_lists(tagged, keys, {"x": "__excl", "e": "__ext"})
    joined = rows.join(lists, keys, "left")
    details = label_sentence(
        F.col("pizza_name"),
        F.col(has_exclusions).isNotNull(),
        F.col(has_extras).isNotNull(),
        F.col("__excl"),
        F.col("__ext"),
        **labels,
    )
    return joined.withColumn("order_details", details).drop("__excl", "__ext")


def order_label_of_texts(
    co: DataFrame, toppings: DataFrame, sep: str = ",", exclusions: str = "exclusions", extras: str = "extras", **labels
) -> DataFrame:
    """``order_label`` from the text lists themselves: a list's names depend on its text alone, so
    each distinct text is resolved once and joined back, and rows need no id of their own."""
    either = F.explode(F.array(exclusions, extras)).alias("__text")
    texts = co.select(either).filter(F.col("__text").isNotNull()).distinct()
    ids = texts.select("__text", F.posexplode(csv_items("__text", sep, "int")).alias("pos", "topping_id"))
    named = ids.join(broadcast_if_small(toppings.select("topping_id", F.col("topping_name").alias("item"))), "topping_id", "inner")
    lists = splittable(joined_list(named, "__text", "item", order="pos", sep=", ", out="__list"))
    out = co
    for c, name in ((exclusions, "__excl"), (extras, "__ext")):
        out = out.join(lists.select(F.col("__text").alias(c), F.col("__list").alias(name)), c, "left")
    details = label_sentence(
        F.col("pizza_name"), F.col(exclusions).isNotNull(), F.col(extras).isNotNull(), F.col("__excl"), F.col("__ext"), **labels
    )
    return out.withColumn("order_details", details).drop("__excl", "__ext")


# I05
def ingredient_list(
    qty: DataFrame,
    records: DataFrame,
    key: Sequence[str] = ("record_id",),
    divisor: int = 1,
    sep: str = ", ",
    ordered: bool = False,
) -> DataFrame:
    """(key..., pizza_name, list_order): 'Meatlovers: 2xBacon, Beef, …', alphabetical.

    ``ordered``: rows by key and pizza name (a range-partitioned global sort).

    ``divisor`` > 1 reproduces a count taken over a table loaded that many times.
    """
    keys = list(key)
    shown = qty.withColumn("qty", (F.col("qty") / divisor).cast("bigint")).filter(F.col("qty") > 0) if divisor != 1 else qty
    lists = format_list(shown, keys, sep=sep, out="__items")
    out = records.select(*keys, "pizza_name").join(lists, keys, "inner")
    out = out.select(*keys, "pizza_name", F.concat_ws("", F.col("pizza_name"), F.lit(": "), F.col("__items")).alias("list_order"))
    return out.orderBy(*keys, "pizza_name") if ordered else out


def ingredient_list_with_position(qty: DataFrame, records: DataFrame, key: Sequence[str] = ("record_id",)) -> DataFrame:
    """``ingredient_list`` with the place of each row in its final order, by key and pizza name."""
    return with_position(ingredient_list(qty, records, key), [F.col(k) for k in [*key, "pizza_name"]])


# I06
def ingredient_totals(
    qty: DataFrame,
    records: DataFrame | None = None,
    key: Sequence[str] = ("record_id",),
    delivered_only: bool = False,
    divisor: int = 1,
) -> DataFrame:
    """(topping, count_ingredients) over all pizzas, or delivered ones only."""
    rows = qty
    if delivered_only:
        if records is None:
            raise ValueError("delivered_only needs the records table")
        rows = rows.join(records.filter(F.col("delivered")).select(*key), list(key), "left_semi")
    totals = total_by_item(rows, out="count_ingredients")
    if divisor != 1:
        totals = totals.withColumn("count_ingredients", (F.col("count_ingredients") / divisor).cast("bigint"))
    return totals.select(F.col("item").alias("topping"), "count_ingredients").orderBy(F.col("count_ingredients").desc())
