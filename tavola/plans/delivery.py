"""Delivery answers: cleaning and enrichment, pizza metrics, runner experience, pricing.

Inputs follow the delivery tables: ``customer_orders(order_id, customer_id, pizza_id,
exclusions, extras, order_time)`` with one row per pizza, ``runner_orders(order_id,
runner_id, pickup_time, distance, duration, cancellation)`` with one row per order,
``pizza_names``, ``pizza_recipes``, ``pizza_toppings``, ``runners`` and ratings.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tavola.functions import (
    csv_items,
    csv_part,
    minutes_between,
    monday_week_of_year,
    nullify_sentinels,
    round_ratio,
    strip_units,
    to_decimal,
    to_int,
    to_money,
    weekday_name,
)
from tavola.operators import (
    broadcast_if_small,
    check_status,
    copies_list,
    day_bitmaps,
    distinct_in_periods,
    enrich,
    joined_list,
    lookup_names,
    top_one,
    with_position,
    with_record_seq,
    write_checked,
)
from tavola.session import materialize

# Units glued to the raw distance / duration text.
DISTANCE_UNITS = ("km",)
DURATION_UNITS = ("minutes", "mins", "minute")
# Rating range of the ratings table.
RATING_RANGE = (1, 5)

_SCALE = 1_000_000  # decimal places kept exact when a decimal enters an integer ratio


def as_timestamp(c: str | Column) -> Column:
    """Text or timestamp column to TIMESTAMP_NTZ (unparsable text becomes NULL)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast("timestamp_ntz")


def _delivered(cancellation: str = "cancellation") -> Column:
    return F.col(cancellation).isNull()


# ================================================================= cleaning
# C01
def clean_customer_orders(
    co: DataFrame, cols: Sequence[str] = ("exclusions", "extras"), patterns: Sequence[str] = ("%null%",)
) -> DataFrame:
    """Blank text and 'null' spellings (or other sentinel ``patterns``) become NULL."""
    return co.withColumns({c: nullify_sentinels(c, patterns) for c in cols})


# C02
def enrich_name(co: DataFrame, pizza_names: DataFrame) -> DataFrame:
    """Add pizza_name by pizza_id; unknown pizzas keep NULL."""
    return enrich(co, pizza_names, "pizza_id", ["pizza_name"], dedupe=True)


# C03
def enrich_cancellation(co: DataFrame, runner_orders_clean: DataFrame, unique: bool = False) -> DataFrame:
    """Copy the order's cancellation to each of its pizzas (one runner row per order).

    ``unique``: the caller knows that order_id does not repeat, so nothing is reduced first."""
    return enrich(co, runner_orders_clean, "order_id", ["cancellation"], dedupe=not unique)


# C04
def strip_runner_text(
    ro: DataFrame,
    distance_units: Sequence[str] = DISTANCE_UNITS,
    duration_units: Sequence[str] = DURATION_UNITS,
) -> DataFrame:
    """'null' spellings to NULL; units removed from distance and duration text."""
    out = clean_measures(ro, {"distance": (distance_units, "suffix"), "duration": (duration_units, "suffix")})
    return out.withColumns(
        {
            "pickup_time": nullify_sentinels("pickup_time", blank=False),
            "cancellation": nullify_sentinels("cancellation"),
        }
    )


def clean_measures(df: DataFrame, spec: dict[str, tuple[Sequence[str], str]]) -> DataFrame:
    """For each column: 'null' spellings to NULL, then the unit glued before/after the number removed."""
    return df.withColumns(
        {c: strip_units(nullify_sentinels(c, blank=False), units, pos) for c, (units, pos) in spec.items()}
    )


# C05
def distance_to_decimal(ro: DataFrame, precision: int = 10, scale: int = 1) -> DataFrame:
    return ro.withColumn("distance", to_decimal("distance", precision, scale))


# C06
def duration_to_int(ro: DataFrame) -> DataFrame:
    return ro.withColumn("duration", to_int("duration"))


def clean_runner_orders(ro: DataFrame) -> DataFrame:
    """C04 + C05 + C06 in one projection."""
    return duration_to_int(distance_to_decimal(strip_runner_text(ro)))


# C07
def runner_totals(ro_clean: DataFrame) -> DataFrame:
    return ro_clean.agg(
        to_money(F.sum("distance")).alias("total_distance"),
        F.sum("duration").cast("bigint").alias("total_duration"),
    )


# C08
def explode_recipe(recipes: DataFrame, sep: str = ",", cast: str | None = "int", item: str = "topping_id") -> DataFrame:
    """One row per recipe topping; unparsable / blank tokens drop out."""
    return (
        recipes.select("pizza_id", F.explode(csv_items("toppings", sep, cast)).alias(item))
        .filter(F.col(item).isNotNull() & (F.col(item).cast("string") != ""))
    )


# C09
def name_toppings(recipe_rows: DataFrame, toppings: DataFrame) -> DataFrame:
    return enrich(recipe_rows, toppings, "topping_id", ["topping_name"], dedupe=True)


# C10
def toppings_text(toppings: DataFrame) -> DataFrame:
    return toppings.select("topping_id", F.col("topping_name").cast("string").alias("new_topping_name"))


# C11
def split_modifiers(
    co: DataFrame,
    sep: str = ",",
    cast: str | None = "int",
    cols: dict[str, str] | None = None,
) -> DataFrame:
    """First and second entry of each list as their own columns (lists may be longer).

    ``cols`` maps list column -> output prefix (default exclusions->exclusion, extras->extra).
    """
    cols = cols or {"exclusions": "exclusion", "extras": "extra"}
    out = {}
    for src, prefix in cols.items():
        out[f"{prefix}_1"] = csv_part(src, 1, sep, cast)
        out[f"{prefix}_2"] = csv_part(src, 2, sep, cast)
    return co.withColumns(out)


# C12
def name_modifiers(
    co: DataFrame,
    toppings: DataFrame,
    name_col: str = "topping_name",
    cols: Sequence[str] = ("exclusion_1", "exclusion_2", "extra_1", "extra_2"),
    id_col: str = "topping_id",
    suffix: str = "_topping",
    key: Sequence[str] | None = None,
    max_broadcast_bytes: int | None = None,
) -> DataFrame:
    """Resolve every id column to its name through one lookup table (``key``: a unique
    row key, used to stack the columns into one join when the table is large)."""
    extra = {} if max_broadcast_bytes is None else {"max_broadcast_bytes": max_broadcast_bytes}
    return lookup_names(co, list(cols), toppings, id_col, name_col, suffix=suffix, key=key, **extra)


# C13
def recipe_lists(recipe_named: DataFrame, sep: str = ",", order_by: str = "topping_id") -> DataFrame:
    """(pizza_id, ingredients): the recipe's topping names in recipe-id order."""
    return joined_list(recipe_named, "pizza_id", "topping_name", order_by, sep, out="ingredients")


def attach_ingredients(co: DataFrame, recipe_named: DataFrame, sep: str = ",") -> DataFrame:
    return enrich(co, recipe_lists(recipe_named, sep), "pizza_id", ["ingredients"])


# C14
def with_record_id(co: DataFrame, key: Sequence[str] = ("order_id",)) -> DataFrame:
    """(key..., record_seq) identifies each pizza row; see ``with_record_seq``."""
    return with_record_seq(co, list(key))


# C15
def explode_modifier(co: DataFrame, col: str, key: Sequence[str] = ("record_id",), sep: str = ",") -> DataFrame:
    """(key..., topping_id) — one row per listed modifier, trimmed text; NULL lists vanish."""
    return co.select(*key, F.explode(csv_items(col, sep)).alias("topping_id"))


def modifier_rows(
    co: DataFrame, col: str, toppings: DataFrame, key: Sequence[str] = ("record_id",), sep: str = ","
) -> DataFrame:
    """(key..., pos, item): modifier ids resolved to names, list position kept."""
    ids = co.select(*key, F.posexplode(csv_items(col, sep, "int")).alias("pos", "topping_id"))
    dim = broadcast_if_small(toppings.select("topping_id", F.col("topping_name").alias("item")))
    return ids.join(dim, "topping_id", "inner").select(*key, "pos", "item")


# C16 / C17 / C18 — multiset of ingredients per pizza record
def recipe_multiset_inputs(
    co: DataFrame, recipe_named: DataFrame, toppings: DataFrame, key: Sequence[str] = ("record_id",)
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(standard, extras, exclusions) as long (key..., item) rows for ``operators.adjust``."""
    std_side = broadcast_if_small(recipe_named.select("pizza_id", F.col("topping_name").alias("item")))
    standard = co.select(*key, "pizza_id").join(std_side, "pizza_id", "inner").select(*key, "item")
    extras = modifier_rows(co, "extras", toppings, key).select(*key, "item")
    exclusions = modifier_rows(co, "exclusions", toppings, key).select(*key, "item")
    return standard, extras, exclusions


def recipe_multiset_rows(
    co: DataFrame, recipe_named: DataFrame, toppings: DataFrame, key: Sequence[str] = ("record_id",), sep: str = ","
) -> DataFrame:
    """(key..., item, kind): the rows of ``recipe_multiset_inputs`` in one table for
    ``operators.adjust_tagged``; kind is 'standard', 'extra' or 'exclusion'.

    Each record is read once, expanded to its pizza and its modifier ids and joined to both lookups
    at once. No union lies between the records and what follows, so a layout by key still holds there."""
    no_pizza, no_topping = F.lit(None).cast(co.schema["pizza_id"].dataType), F.lit(None).cast("int")

    def use(pizza: Column, topping: Column, kind: str) -> Column:
        return F.struct(pizza.alias("pizza"), topping.alias("topping"), F.lit(kind).alias("kind"))

    uses = [
        F.array(use(F.col("pizza_id"), no_topping, "standard")),
        F.transform(csv_items("extras", sep, "int"), lambda x: use(no_pizza, x, "extra")),
        F.transform(csv_items("exclusions", sep, "int"), lambda x: use(no_pizza, x, "exclusion")),
    ]
    rows = co.select(*key, F.explode(F.flatten(F.filter(F.array(*uses), lambda a: a.isNotNull()))).alias("__use"))
    rows = rows.select(*key, "__use.pizza", "__use.topping", "__use.kind")
    std_side = recipe_named.filter(F.col("pizza_id").isNotNull()).select(
        F.col("pizza_id").alias("__pizza"), F.lit(None).alias("__topping"), F.col("topping_name").alias("item")
    )
    side = toppings.filter(F.col("topping_id").isNotNull()).select(
        F.lit(None).alias("__pizza"), F.col("topping_id").alias("__topping"), F.col("topping_name").alias("item")
    )
    same = F.col("pizza").eqNullSafe(F.col("__pizza")) & F.col("topping").eqNullSafe(F.col("__topping"))
    return rows.join(broadcast_if_small(std_side.unionByName(side)), same, "inner").select(*key, "item", "kind")


def adjusted_recipe(qty: DataFrame, records: DataFrame, key: Sequence[str] = ("record_id",), sep: str = ",") -> DataFrame:
    """(key..., pizza_name, adjust_full_recipe): every copy listed, sorted case-insensitively."""
    lists = copies_list(qty, list(key), sep=sep, out="adjust_full_recipe")
    return records.select(*key, "pizza_name").join(lists, list(key), "inner")


def adjusted_rows(adjusted: DataFrame, key: Sequence[str] = ("record_id",), sep: str = ",") -> DataFrame:
    """C17: (key..., pizza_name, topping) — one row per listed topping."""
    return adjusted.select(*key, "pizza_name", F.explode(csv_items("adjust_full_recipe", sep)).alias("topping"))


def adjusted_copies(qty: DataFrame, records: DataFrame, key: Sequence[str] = ("record_id",)) -> DataFrame:
    """C17 straight from the multiset (key..., item, qty): every copy a row, no list in between,
    so a name that holds the separator stays whole."""
    rows = records.select(*key, "pizza_name").join(qty.select(*key, "item", "qty"), list(key), "inner")
    copies = F.explode(F.array_repeat("item", F.col("qty").cast("int")))
    return rows.select(*key, "pizza_name", copies.alias("topping"))


def drop_blank(df: DataFrame, col: str = "topping") -> DataFrame:
    """C18: remove NULL or blank tokens."""
    return df.filter(F.col(col).isNotNull() & (F.trim(F.col(col)) != ""))


# C19
def rating_check(ratings: DataFrame, col: str = "rating", bounds: tuple[int, int] = RATING_RANGE) -> DataFrame:
    return check_status(ratings, F.col(col).between(*bounds))


def check_counts(df: DataFrame, rules: Mapping[str, Column], path: str) -> DataFrame:
    """(rule, n_rows, n_failed, n_rejected): the table written as valid and rejected rows at ``path``,
    each rule's failures counted on the way; n_rejected are the rows that failed any."""
    checked = write_checked(df, rules, path)
    rejected = checked.rejected.count()
    rows = [(rule, checked.rows, failed, rejected) for rule, failed in checked.failed.items()]
    return df.sparkSession.createDataFrame(rows, "rule string, n_rows bigint, n_failed bigint, n_rejected bigint")


# C20
def delivery_report(ratings: DataFrame, co: DataFrame, ro_clean: DataFrame) -> DataFrame:
    """One row per rating: who, when, minutes to pickup, duration, km/h, pizzas.

    Pizzas are aggregated per order before any join, so nothing fans out, and all three
    joins are on order_id.
    """
    per_order = co.groupBy("order_id").agg(
        F.min("customer_id").alias("customer_id"),
        F.min(as_timestamp("order_time")).alias("order_time"),
        F.count("pizza_id").alias("total_pizzas"),
    )
    runs = ro_clean.select("order_id", "runner_id", as_timestamp("pickup_time").alias("pickup_time"), "distance", "duration")
    rows = ratings.select("order_id", "rating", "comments").join(per_order, "order_id", "left").join(runs, "order_id", "left")
    return delivery_report_of_orders(rows)


def delivery_report_of_orders(rows: DataFrame) -> DataFrame:
    """C20 from one row per rated order that holds all of it."""
    return rows.select(
        "customer_id",
        "order_id",
        "runner_id",
        "rating",
        "comments",
        "order_time",
        "pickup_time",
        minutes_between("order_time", "pickup_time").alias("time_between_order_pickup"),
        F.col("duration").cast("bigint").alias("delivery_duration"),
        _speed("distance", "duration", 1).alias("average_speed_kmph"),
        F.col("total_pizzas").cast("bigint").alias("total_pizzas"),
    )


def _speed(distance: str, duration: str, digits: int) -> Column:
    """km/h = distance / minutes * 60, rounded exactly; NULL for a zero duration."""
    num = (F.col(distance) * _SCALE).cast("decimal(38,0)") * 60
    return round_ratio(num, F.col(duration).cast("decimal(38,0)") * _SCALE, digits)


# ================================================================= A. pizza metrics
# A01
def ordered_total(co: DataFrame) -> DataFrame:
    return co.agg(F.count(F.lit(1)).alias("total_ordered"))


# A02
def unique_customers(co: DataFrame) -> DataFrame:
    return co.agg(F.countDistinct("customer_id").alias("no_customers"))


def unique_customers_in_periods(co: DataFrame, day: str = "order_time", customer: str = "customer_id") -> DataFrame:
    """(period, start, customers): exact distinct customers of every day, week (from Monday) and
    month, all merged from the days' bitmaps; the orders are read once."""
    starts = {"day": F.col("day"), "week": F.to_date(F.date_trunc("week", "day")), "month": F.to_date(F.date_trunc("month", "day"))}
    return distinct_in_periods(materialize(day_bitmaps(co, day, customer)), starts, out="customers")


# A03
def delivered_by_runner(ro_raw: DataFrame) -> DataFrame:
    """On raw runner rows: a duration that is present and not the text 'null'."""
    dur = F.col("duration")
    ok = dur.isNotNull() & (F.lower(F.trim(dur.cast("string"))) != "null")
    return ro_raw.filter(ok).groupBy("runner_id").agg(F.count("runner_id").alias("total_delivered"))


# A04
def delivered_by_type(co: DataFrame, ro_clean: DataFrame) -> DataFrame:
    """Left join: pizzas whose order has no runner row count as delivered too.

    Pizzas are counted per (order, name) before the join, so the join sees one row per
    order and name instead of one per pizza.
    """
    runs = ro_clean.select("order_id", F.col("cancellation").alias("__c"))
    per_order = co.groupBy("order_id", "pizza_name").agg(F.count("pizza_name").alias("__n"))
    rows = per_order.join(runs, "order_id", "left").filter(F.col("__c").isNull())
    return rows.groupBy("pizza_name").agg(F.sum("__n").cast("bigint").alias("total"))


# A05
def type_by_customer(co: DataFrame, values: Sequence[str], col: str = "pizza_name") -> DataFrame:
    """Count of each listed value per customer, 0 when absent (a fixed-value pivot)."""
    aggs = [F.sum(F.when(F.col(col) == v, 1).otherwise(0)).cast("bigint").alias(v) for v in values]
    return co.groupBy("customer_id").agg(*aggs)


# A06
def max_in_order(co: DataFrame) -> DataFrame:
    counts = co.filter(_delivered()).groupBy("order_id").agg(F.count("pizza_id").alias("total_pizza"))
    return top_one(counts, [F.col("total_pizza").desc(), F.col("order_id").asc()]).select("total_pizza", "order_id")


# A07
def changes_by_customer(co: DataFrame) -> DataFrame:
    unchanged = F.col("exclusions").isNull() & F.col("extras").isNull()
    return co.filter(_delivered()).groupBy("customer_id").agg(
        F.sum(F.when(unchanged, 1).otherwise(0)).cast("bigint").alias("no_change"),
        F.sum(F.when(~unchanged, 1).otherwise(0)).cast("bigint").alias("change"),
    )


# A08
def both_changes(co: DataFrame) -> DataFrame:
    both = F.col("exclusions").isNotNull() & F.col("extras").isNotNull()
    return co.filter(_delivered()).agg(F.sum(F.when(both, 1).otherwise(0)).cast("bigint").alias("change_pizza"))


# A09
def by_hour(co: DataFrame, ts: str = "order_time") -> DataFrame:
    return (
        co.groupBy(F.hour(as_timestamp(ts)).alias("hour_of_day"))
        .agg(F.count(F.lit(1)).alias("pizza_ordered"))
        .orderBy("hour_of_day")
    )


# A10
def by_weekday(co: DataFrame, ts: str = "order_time") -> DataFrame:
    t = as_timestamp(ts)
    return (
        co.groupBy(weekday_name(t).alias("day_of_week"))
        .agg(F.count(F.lit(1)).alias("volume_ordered"), F.min(F.dayofweek(t)).alias("__dow"))
        .orderBy("__dow")
        .drop("__dow")
    )


# ================================================================= B. runner experience
# B01
def signups_by_week(runners: DataFrame, col: str = "registration_date") -> DataFrame:
    return runners.groupBy(monday_week_of_year(col).alias("no_of_week")).agg(F.count(F.lit(1)).alias("total_registered"))


# B02
def avg_pickup(ro_clean: DataFrame, co: DataFrame, per: str = "pizza") -> DataFrame:
    """Mean |minutes| from order to pickup per runner, 2 dp.

    ``per='pizza'`` weights each order by its pizza rows (the literal join);
    ``per='order'`` counts each order once. Pizzas are counted per (order, order time)
    before the join, so the join sees one row per order.
    """
    pizzas = co.groupBy("order_id", as_timestamp("order_time").alias("order_time")).agg(F.count(F.lit(1)).alias("__n"))
    if per == "order":
        pizzas = pizzas.groupBy("order_id").agg(F.min("order_time").alias("order_time"), F.lit(1).alias("__n"))
    runs = ro_clean.select("order_id", "runner_id", as_timestamp("pickup_time").alias("pickup_time"))
    rows = runs.join(pizzas, "order_id", "left")
    return avg_pickup_of_orders(rows, F.col("__n"))


def avg_pickup_of_orders(orders: DataFrame, weight: Column) -> DataFrame:
    """B02 from one row per order (runner_id, order_time, pickup_time), each of a weight."""
    rows = orders.filter(F.col("pickup_time").isNotNull()).withColumn("__w", weight)
    mins = F.abs(minutes_between("order_time", "pickup_time"))
    total = F.coalesce(F.sum(F.when(mins.isNotNull(), F.col("__w"))), F.lit(0))
    return rows.groupBy("runner_id").agg(round_ratio(F.sum(mins * F.col("__w")), total, 2).alias("average_pickup_time"))


# B03
def prep_by_size(co: DataFrame, ro_clean: DataFrame) -> DataFrame:
    per_order = co.groupBy("order_id").agg(
        F.count("pizza_id").alias("no_of_pizza"), F.min(as_timestamp("order_time")).alias("order_time")
    )
    runs = ro_clean.select("order_id", as_timestamp("pickup_time").alias("pickup_time"))
    return prep_by_size_of_orders(per_order.join(runs, "order_id", "left"))


def prep_by_size_of_orders(orders: DataFrame) -> DataFrame:
    """B03 from one row per order (no_of_pizza, order_time, pickup_time)."""
    prep = orders.withColumn("prep", minutes_between("order_time", "pickup_time")).filter(F.col("prep").isNotNull())
    return prep.groupBy("no_of_pizza").agg(round_ratio(F.sum("prep"), F.count("no_of_pizza"), 2).alias("avg_preparation"))


# B04
def avg_distance(co: DataFrame, ro_clean: DataFrame) -> DataFrame:
    """Mean km per customer over pizza rows (multi-pizza orders weigh more), 2 dp.

    Pizzas are counted per (order, customer) first; each order's distance is then
    weighted by its pizza count, which equals averaging over the pizza rows.
    """
    per_order = co.groupBy("order_id", "customer_id").agg(F.count(F.lit(1)).alias("__n"))
    return avg_distance_of_orders(per_order.join(ro_clean.select("order_id", "distance"), "order_id", "left"))


def avg_distance_of_orders(rows: DataFrame) -> DataFrame:
    """B04 from one row per order and customer: distance, and ``__n`` pizzas."""
    num = F.sum((F.col("distance") * _SCALE).cast("decimal(38,0)") * F.col("__n"))
    den = F.coalesce(F.sum(F.when(F.col("distance").isNotNull(), F.col("__n"))), F.lit(0)) * _SCALE
    return rows.groupBy("customer_id").agg(round_ratio(num, den, 2).alias("avg_distance"))


# B05
def duration_spread(ro_clean: DataFrame) -> DataFrame:
    return ro_clean.agg((F.max("duration") - F.min("duration")).cast("bigint").alias("diff"))


# B06
def speed(ro_clean: DataFrame, ordered: bool = False) -> DataFrame:
    """``ordered``: shortest distance first, ties by order (a range-partitioned global sort)."""
    out = ro_clean.filter(F.col("duration").isNotNull()).select(
        "runner_id",
        "order_id",
        to_money("distance").alias("distance"),
        F.col("duration").cast("bigint").alias("duration"),
        _speed("distance", "duration", 2).alias("speed_kmph"),
    )
    return out.orderBy("distance", "order_id") if ordered else out


def speed_with_position(ro_clean: DataFrame) -> DataFrame:
    """``speed`` with the place of each row in its final order, shortest distance first."""
    return with_position(speed(ro_clean), [F.col("distance"), F.col("order_id")])


# B07
def delivery_rate(ro_clean: DataFrame) -> DataFrame:
    done = F.sum(F.when(F.col("duration").isNotNull(), 1).otherwise(0))
    return ro_clean.groupBy("runner_id").agg(round_ratio(done * 100, F.count("order_id"), 2).alias("percentage_delivery"))


# ================================================================= D. pricing
def price_of(col: Column, prices: Mapping, default: int) -> Column:
    expr = F.lit(default)
    for value, price in prices.items():
        expr = F.when(col == F.lit(value), F.lit(price)).otherwise(expr)
    return expr


# E01
def revenue(co: DataFrame, prices: Mapping[str, int], default: int, col: str = "pizza_name") -> DataFrame:
    return co.filter(_delivered()).agg(F.sum(price_of(F.col(col), prices, default)).cast("bigint").alias("total_revenue"))


# E02
def revenue_with_extras(
    co: DataFrame,
    prices: Mapping[str, int],
    default: int,
    premium_extra: Column,
    has_extra: Column,
    col: str = "pizza_name",
) -> DataFrame:
    """Price plus 2 when a premium extra is on the pizza, else 1 when any extra is."""
    charge = F.when(premium_extra, 2).when(has_extra, 1).otherwise(0)
    return co.filter(_delivered()).agg(
        F.sum(price_of(F.col(col), prices, default) + charge).cast("bigint").alias("total_revenue")
    )


def revenue_per_extra(co: DataFrame, prices: Mapping[str, int], default: int, extras: DataFrame, premium: str, key: Sequence[str] = ("record_id",), col: str = "pizza_name") -> DataFrame:
    """E02 as the question states it: $1 per extra, one more for each premium extra."""
    charges = extras.groupBy(*key).agg(
        F.sum(F.when(F.col("item") == premium, 2).otherwise(1)).alias("__charge")
    )
    rows = co.filter(_delivered()).join(charges, list(key), "left")
    total = price_of(F.col(col), prices, default) + F.coalesce(F.col("__charge"), F.lit(0))
    return rows.agg(F.sum(total).cast("bigint").alias("total_revenue"))


def best_paid_extras(orders: DataFrame, extras: DataFrame, most: int = 3) -> DataFrame:
    """OUTER APPLY: for each order its ``most`` best-paid extras (order_id, pos, item, price) as one
    text, the best first, and what they cost; an order without extras stays, with NULL."""
    own = extras.filter(F.col("order_id") == F.col("o.order_id").outer())
    best = own.orderBy(F.col("price").desc(), F.col("pos"), F.col("item")).limit(most)
    entry = F.struct((-F.col("price")).alias("p"), "pos", "item")
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["item"]), ", ")
    applied = best.select(F.when(F.count("item") > 0, listed).alias("best_extras"), to_money(F.sum("price")).alias("best_price"))
    return orders.alias("o").lateralJoin(applied, how="left").select("o.order_id", "best_extras", "best_price")


def revenue_per_extra_by_order(
    co: DataFrame, prices: Mapping[str, int], default: int, extras: DataFrame, premium: str, cancellations: DataFrame, col: str = "pizza_name"
) -> DataFrame:
    """``revenue_per_extra`` from sums per order (order_id): pizzas and extras are each reduced to a
    row an order before they meet, so pizzas need no id of their own. ``cancellations``: order_id,
    cancellation, one row an order; an order it lacks counts as delivered."""
    base = co.groupBy("order_id").agg(F.sum(price_of(F.col(col), prices, default)).alias("__base"))
    charge = extras.groupBy("order_id").agg(F.sum(F.when(F.col("item") == premium, 2).otherwise(1)).alias("__charge"))
    orders = base.join(charge, "order_id", "left").join(cancellations.select("order_id", "cancellation"), "order_id", "left")
    total = F.col("__base") + F.coalesce(F.col("__charge"), F.lit(0))
    return orders.filter(_delivered()).agg(F.sum(total).cast("bigint").alias("total_revenue"))


# E05
def profit(
    co: DataFrame,
    ro_clean: DataFrame,
    prices: Mapping,
    cost_per_km: str = "0.30",
    col: str = "pizza_id",
    default: int = 0,
) -> DataFrame:
    """Pizza revenue minus runner pay per km over delivered orders.

    Revenue is summed per order first and the distance joined once per order.
    """
    per_order = co.groupBy("order_id").agg(F.sum(price_of(F.col(col), prices, default)).alias("rev"))
    runs = ro_clean.filter(_delivered()).select("order_id", "distance")
    return profit_of_orders(runs.join(per_order, "order_id", "inner"), cost_per_km)


def profit_of_orders(rows: DataFrame, cost_per_km: str = "0.30") -> DataFrame:
    """E05 from one row per delivered order: distance, and ``rev`` of its pizzas."""
    pay = F.col("distance") * F.lit(cost_per_km).cast("decimal(4,2)")
    return rows.agg(to_money(F.sum("rev") - F.sum(pay)).alias("left_earn"))


def ratings_valid(ratings: DataFrame) -> DataFrame:
    """E03: the ratings that pass the range check."""
    return rating_check(ratings).filter(F.col("check_status") == "valid").drop("check_status")

