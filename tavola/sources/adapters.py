"""Bind the scale-factor tables to the diner and delivery table shapes.

Every derived table is a lazy Spark plan over the given parquet tables, so its size
grows with them. The same bindings are spelled out in SQL in ``tavola.plans.oracle``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tavola.functions.clean import numeric_cast
from tavola.operators import adjust_tagged, enrich, item_lists
from tavola.sources.testdata import Tables

# Fixed values of the bindings (see README, "Binding to the scale tables").
POINTS_UNTIL = "2024-01-25"  # end of the points period for the boost rule
DOUBLE_POINT_TYPE = "PROMO"  # the item type that earns double points
CANCELLED_STATUS = "P"  # order status read as "not delivered"


# ---------------------------------------------------------------- diner (loyalty)
def menu(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_name"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("price"),
    )


def order_sales(t: Tables) -> DataFrame:
    """One sale per order line: customer of the order, day of the order, part bought."""
    lines = t.lineitem.select("l_orderkey", "l_partkey")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("l_partkey").alias("product_id"),
    )


def event_sales(t: Tables) -> DataFrame:
    """Purchase events: user, day, product number from the event properties."""
    return t.events.filter(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("customer_id"),
        F.to_date("ts").alias("order_date"),
        numeric_cast(F.regexp_extract("props", r"([0-9]+)", 1), "bigint").alias("product_id"),
        "ts",
        "event_id",
    )


def signups(t: Tables) -> DataFrame:
    """Every signup event: user, instant."""
    return t.events.filter(F.col("event_type") == "signup").select(F.col("user_id").alias("customer_id"), "ts")


def members(t: Tables) -> DataFrame:
    """A user's first signup day is the join day."""
    first = t.events.filter(F.col("event_type") == "signup").groupBy("user_id").agg(F.min(F.to_date("ts")).alias("join_date"))
    return first.select(F.col("user_id").alias("customer_id"), "join_date")


# ---------------------------------------------------------------- delivery
class Delivery:
    """Delivery-shaped tables over the scale tables, each built on first use."""

    def __init__(self, t: Tables):
        self.t = t

    @cached_property
    def customer_orders(self) -> DataFrame:  # one row per pizza (order line)
        return customer_orders(self.t)

    @cached_property
    def lines(self) -> DataFrame:  # (order_id, pizza_id) per pizza, from the order lines alone
        return self.t.lineitem.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("pizza_id"))

    @cached_property
    def cancellations(self) -> DataFrame:
        """(order_id, cancellation) of every order; o_orderkey is the table's key."""
        status = F.col("o_orderstatus")
        return self.t.orders.select(
            F.col("o_orderkey").alias("order_id"), F.when(status == CANCELLED_STATUS, status).alias("cancellation")
        )

    @cached_property
    def runner_orders(self) -> DataFrame:  # one row per order
        return runner_orders(self.t)

    @cached_property
    def pizza_names(self) -> DataFrame:
        return pizza_names(self.t)

    @cached_property
    def _lines(self) -> DataFrame:
        """(record_id, item, flag, pos) straight from the order lines and the part types."""
        lines = self.t.lineitem.select(
            F.col("l_orderkey").alias("record_id"),
            F.col("l_partkey").alias("pizza_id"),
            F.col("l_returnflag").alias("flag"),
            F.col("l_linenumber").alias("pos"),
        )
        typed = enrich(lines, self.pizza_names, "pizza_id", ["pizza_name"])
        return typed.select("record_id", F.col("pizza_name").alias("item"), "flag", "pos")

    @cached_property
    def records(self) -> DataFrame:
        """One row per order: record_id, pizza_name (the priority label), delivered."""
        return self.t.orders.select(
            F.col("o_orderkey").alias("record_id"),
            F.col("o_orderpriority").alias("pizza_name"),
            (F.col("o_orderstatus") != CANCELLED_STATUS).alias("delivered"),
        )

    @cached_property
    def modifiers(self) -> DataFrame:
        """Per order with lines: whether it has 'R' / 'A' lines, and their item lists."""
        # every line takes part (other flags with kind NULL) so each order with lines appears
        kinds = self._lines.select(
            "record_id", "pos", "item", F.when(F.col("flag").isin("R", "A"), F.col("flag")).alias("kind")
        )
        return item_lists(
            kinds,
            ["record_id"],
            {"R": "exclusion_list", "A": "extra_list"},
            flags={"R": "exclusions", "A": "extras"},
        )

    @cached_property
    def qty(self) -> DataFrame:
        """(record_id, item, qty) from one pass over the order lines: every line's type is
        in the standard set, 'A' lines add a copy, an 'R' line removes the type."""
        return adjust_tagged(
            self._lines, "record_id", "item", F.lit(1), F.col("flag") == "A", F.col("flag") == "R", standard_is_set=True
        )

    @cached_property
    def extras(self) -> DataFrame:  # (record_id, pos, item) per 'A' line
        return self._lines.filter(F.col("flag") == "A").select("record_id", "pos", "item")

    @cached_property
    def exclusions(self) -> DataFrame:  # (record_id, pos, item) per 'R' line
        return self._lines.filter(F.col("flag") == "R").select("record_id", "pos", "item")


def customer_orders(t: Tables) -> DataFrame:
    """Order lines as pizzas. A non-zero discount / tax marks an exclusion / extra."""
    lines = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_discount", "l_tax", "l_returnflag"
    )
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("pizza_id"),
        F.when(F.col("l_discount") != 0, F.col("l_discount")).alias("exclusions"),
        F.when(F.col("l_tax") != 0, F.col("l_tax")).alias("extras"),
        F.col("o_orderdate").alias("order_time"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linenumber").alias("line"),
        F.when(F.col("o_orderstatus") == CANCELLED_STATUS, F.col("o_orderstatus")).alias("cancellation"),
    )


def order_rows(t: Tables, lines: DataFrame | None = None, value: Column | None = None) -> DataFrame:
    """One row per order with all that the per-order answers need, each table read once: the
    lines are summed up per order and joined once to the orders. ``value`` (over ``lines``, by
    default the order lines) is summed up as ``rev``. Cancelled orders have no pickup time,
    distance and duration."""
    lines = t.lineitem if lines is None else lines
    sums = [F.sum(value).alias("rev")] if value is not None else []
    per_order = lines.groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("runner_id"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
        F.sum(F.col("l_quantity").cast("decimal(12,1)")).alias("qty"),
        F.count("l_partkey").alias("total_pizzas"),
        F.count(F.lit(1)).alias("pizza_rows"),
        *sums,
    )
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    live = F.col("o_orderstatus") != CANCELLED_STATUS
    rows = orders.join(per_order, per_order.l_orderkey == orders.o_orderkey, "left")
    return rows.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("l_orderkey").isNotNull().alias("has_lines"),
        F.when(F.col("l_orderkey").isNotNull(), F.col("o_custkey")).alias("customer_id"),
        F.when(F.col("l_orderkey").isNotNull(), F.col("o_orderdate").cast("timestamp_ntz")).alias("order_time"),
        "total_pizzas",
        "pizza_rows",
        "runner_id",
        F.when(live, F.col("first_ship").cast("timestamp_ntz")).alias("pickup_time"),
        F.when(live, F.col("qty")).alias("distance"),
        F.when(live, F.datediff(F.to_date("last_ship"), F.to_date("o_orderdate"))).cast("bigint").alias("duration"),
        F.when(~live, F.col("o_orderstatus")).alias("cancellation"),
        F.col("o_orderpriority").alias("comments"),
        *["rev" for _ in sums],
    )


def runner_orders(t: Tables) -> DataFrame:
    """One delivery per order: first supplier as runner, earliest ship day as pickup,
    total quantity as distance, days from order to last ship as duration. Cancelled
    (status 'P') orders keep only the runner and the cancellation."""
    per_order = t.lineitem.groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("runner_id"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
        F.sum(F.col("l_quantity").cast("decimal(12,1)")).alias("qty"),
    )
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    live = F.col("o_orderstatus") != CANCELLED_STATUS
    return per_order.join(orders, per_order.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").alias("order_id"),
        "runner_id",
        F.when(live, F.col("first_ship")).alias("pickup_time"),
        F.when(live, F.col("qty")).alias("distance"),
        F.when(live, F.datediff(F.to_date("last_ship"), F.to_date("o_orderdate"))).cast("bigint").alias("duration"),
        F.when(~live, F.col("o_orderstatus")).alias("cancellation"),
    )


def pizza_names(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("pizza_id"), F.col("p_type").alias("pizza_name"))


def delivery(t: Tables) -> Delivery:
    """Order records for the ingredient answers: an order's item types are its standard
    recipe, its returned-flag 'A' lines add extras, its 'R' lines exclude their type."""
    return Delivery(t)
