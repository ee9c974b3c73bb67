"""Declared schemas of the diner and delivery tables, for reading conforming feeds.

    spark.read.schema(schemas.CUSTOMER_ORDERS).parquet(path)
"""

from __future__ import annotations

from pyspark.sql import types as T


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, I, D = T.StringType(), T.IntegerType(), T.DateType()

SALES = _s(("customer_id", S), ("order_date", D), ("product_id", I))
MENU = _s(("product_id", I), ("product_name", S), ("price", I))
MEMBERS = _s(("customer_id", S), ("join_date", D))
RUNNERS = _s(("runner_id", I), ("registration_date", D))
# Raw feeds keep modifiers, times, distance and duration as text; cleaning types them.
CUSTOMER_ORDERS = _s(
    ("order_id", I), ("customer_id", I), ("pizza_id", I), ("exclusions", S), ("extras", S), ("order_time", S)
)
RUNNER_ORDERS = _s(
    ("order_id", I), ("runner_id", I), ("pickup_time", S), ("distance", S), ("duration", S), ("cancellation", S)
)
PIZZA_NAMES = _s(("pizza_id", I), ("pizza_name", S))
PIZZA_RECIPES = _s(("pizza_id", I), ("toppings", S))
PIZZA_TOPPINGS = _s(("topping_id", I), ("topping_name", S))
RATINGS = _s(("order_id", I), ("rating", I), ("comments", S))
