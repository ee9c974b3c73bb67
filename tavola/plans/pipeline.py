"""The delivery cleaning pipeline in dependency order, for tables in the delivery shape.

runner orders -> clean (C04-C06); customer orders -> sentinels (C01) -> pizza name (C02)
-> cancellation (C03); recipes -> rows (C08) -> names (C09); orders -> modifiers
(C11-C12) -> ingredients (C13); multiset per record (C16). One lazy plan; call
``tavola.materialize`` on ``orders`` when several answers read it on a cluster.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.operators import adjust
from tavola.plans import delivery as D
from tavola.session import materialize


@dataclass
class DeliveryRaw:
    customer_orders: DataFrame
    runner_orders: DataFrame
    pizza_names: DataFrame
    pizza_recipes: DataFrame
    pizza_toppings: DataFrame
    runners: DataFrame | None = None
    ratings: DataFrame | None = None


@dataclass
class DeliveryClean:
    runner_orders: DataFrame  # runner_orders_clean
    customer_orders: DataFrame  # customer_orders_clean
    recipe_named: DataFrame  # (pizza_id, topping_id, topping_name)
    toppings: DataFrame  # (topping_id, topping_name, new_topping_name)
    orders: DataFrame  # + exclusion/extra ids and names + ingredients
    records: DataFrame  # (key..., pizza_name, delivered)
    extras: DataFrame  # (key..., pos, item)
    exclusions: DataFrame  # (key..., pos, item)
    qty: DataFrame  # (key..., item, qty) adjusted multiset


def clean(raw: DeliveryRaw, key: Sequence[str] = ("record_id",), checkpoint: bool = False) -> DeliveryClean:
    """All cleaned tables as one lazy plan.

    ``checkpoint=True`` writes the two tables every answer reads (cleaned runner and
    customer orders) to ``spark.checkpoint.dir`` first, so later answers — and
    recomputation after a lost executor — start from those files, not the raw feeds.
    """
    keys = list(key)
    ro = D.clean_runner_orders(raw.runner_orders)
    if checkpoint:
        ro = materialize(ro)
    co = D.enrich_cancellation(D.enrich_name(D.clean_customer_orders(raw.customer_orders), raw.pizza_names), ro)
    if checkpoint:
        co = materialize(co)
    toppings = raw.pizza_toppings.join(D.toppings_text(raw.pizza_toppings), "topping_id")
    recipe_named = D.name_toppings(D.explode_recipe(raw.pizza_recipes), raw.pizza_toppings)
    orders = D.attach_ingredients(D.name_modifiers(D.split_modifiers(co), raw.pizza_toppings), recipe_named)
    standard, _, _ = D.recipe_multiset_inputs(co, recipe_named, raw.pizza_toppings, keys)
    extras = D.modifier_rows(co, "extras", raw.pizza_toppings, keys)
    exclusions = D.modifier_rows(co, "exclusions", raw.pizza_toppings, keys)
    qty = adjust(standard, extras.select(*keys, "item"), exclusions.select(*keys, "item"), keys, "item")
    records = co.select(*keys, "pizza_name", F.col("cancellation").isNull().alias("delivered"))
    return DeliveryClean(ro, co, recipe_named, toppings, orders, records, extras, exclusions, qty)


# Tables of the cleaning chain and the names they are written under.
CLEAN_TABLES = ("runner_orders", "customer_orders", "recipe_named", "toppings", "orders", "qty")


def write_clean(clean_tables: DeliveryClean, root: str, mode: str = "overwrite") -> dict[str, str]:
    """Materialise the cleaned tables as parquet under ``root`` (a shared folder on a cluster).

    The written tables cut lineage: answers that read them back start from the files,
    so a lost executor recomputes from there, not from the raw feeds.
    """
    paths = {}
    for name in CLEAN_TABLES:
        path = f"{root.rstrip('/')}/{name}"
        getattr(clean_tables, name).write.mode(mode).parquet(path)
        paths[name] = path
    return paths


def read_clean(spark, paths: dict[str, str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(path) for name, path in paths.items()}
