"""The reference's literal rows, as fixed test inputs (values must equal the reference's)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from tavola import schemas
from tavola.plans.pipeline import DeliveryRaw

D = dt.date

# Diner sales (customer, day, product), menu, members.
SALES = [
    ("A", D(2021, 1, 1), 1), ("A", D(2021, 1, 1), 2), ("A", D(2021, 1, 7), 2), ("A", D(2021, 1, 10), 3),
    ("A", D(2021, 1, 11), 3), ("A", D(2021, 1, 11), 3), ("B", D(2021, 1, 1), 2), ("B", D(2021, 1, 2), 2),
    ("B", D(2021, 1, 4), 1), ("B", D(2021, 1, 11), 1), ("B", D(2021, 1, 16), 3), ("B", D(2021, 2, 1), 3),
    ("C", D(2021, 1, 1), 3), ("C", D(2021, 1, 1), 3), ("C", D(2021, 1, 7), 3),
]
MENU = [(1, "sushi", 10), (2, "curry", 15), (3, "ramen", 12)]
MEMBERS = [("A", D(2021, 1, 7)), ("B", D(2021, 1, 9))]

# Delivery tables as loaded (dirty text kept as is).
RUNNERS = [(1, D(2021, 1, 1)), (2, D(2021, 1, 3)), (3, D(2021, 1, 8)), (4, D(2021, 1, 15))]
CUSTOMER_ORDERS = [
    (1, 101, 1, "", "", "2020-01-01 18:05:02"),
    (2, 101, 1, "", "", "2020-01-01 19:00:52"),
    (3, 102, 1, "", "", "2020-01-02 23:51:23"),
    (3, 102, 2, "", None, "2020-01-02 23:51:23"),
    (4, 103, 1, "4", "", "2020-01-04 13:23:46"),
    (4, 103, 1, "4", "", "2020-01-04 13:23:46"),
    (4, 103, 2, "4", "", "2020-01-04 13:23:46"),
    (5, 104, 1, "null", "1", "2020-01-08 21:00:29"),
    (6, 101, 2, "null", "null", "2020-01-08 21:03:13"),
    (7, 105, 2, "null", "1", "2020-01-08 21:20:29"),
    (8, 102, 1, "null", "null", "2020-01-09 23:54:33"),
    (9, 103, 1, "4", "1, 5", "2020-01-10 11:22:59"),
    (10, 104, 1, "null", "null", "2020-01-11 18:34:49"),
    (10, 104, 1, "2, 6", "1, 4", "2020-01-11 18:34:49"),
]
RUNNER_ORDERS = [
    (1, 1, "2020-01-01 18:15:34", "20km", "32 minutes", ""),
    (2, 1, "2020-01-01 19:10:54", "20km", "27 minutes", ""),
    (3, 1, "2020-01-03 00:12:37", "13.4km", "20 mins", None),
    (4, 2, "2020-01-04 13:53:03", "23.4", "40", None),
    (5, 3, "2020-01-08 21:10:57", "10", "15", None),
    (6, 3, "null", "null", "null", "Restaurant Cancellation"),
    (7, 2, "2020-01-08 21:30:45", "25km", "25mins", "null"),
    (8, 2, "2020-01-10 00:15:02", "23.4 km", "15 minute", "null"),
    (9, 2, "null", "null", "null", "Customer Cancellation"),
    (10, 1, "2020-01-11 18:50:20", "10km", "10minutes", "null"),
]
PIZZA_NAMES = [(1, "Meatlovers"), (2, "Vegetarian")]
PIZZA_RECIPES = [(1, "1, 2, 3, 4, 5, 6, 8, 10"), (2, "4, 6, 7, 9, 11, 12")]
PIZZA_TOPPINGS = [
    (1, "Bacon"), (2, "BBQ Sauce"), (3, "Beef"), (4, "Cheese"), (5, "Chicken"), (6, "Mushrooms"),
    (7, "Onions"), (8, "Pepperoni"), (9, "Peppers"), (10, "Salami"), (11, "Tomatoes"), (12, "Tomato Sauce"),
]
# Ratings of the eight delivered orders.
RATINGS = [
    (1, 4, "Good service!"), (2, 5, "Excellent delivery."), (3, 3, "On-time, but pizza was a bit cold."),
    (4, 2, "Late delivery and wrong order."), (5, 4, "Quick and friendly."),
    (7, 1, "Terrible service, never ordering again."), (8, 3, "Average delivery."),
    (10, 4, "Satisfied with the delivery."),
]


def diner(spark: SparkSession):
    sales = spark.createDataFrame(SALES, schemas.SALES)
    menu = spark.createDataFrame(MENU, schemas.MENU)
    members = spark.createDataFrame(MEMBERS, schemas.MEMBERS)
    return sales, menu, members


def delivery_raw(spark: SparkSession, customer_orders=None, runner_orders=None) -> DeliveryRaw:
    co_rows = customer_orders if customer_orders is not None else CUSTOMER_ORDERS
    # record_id numbers the pizza rows in load order, as an identity column would.
    co = spark.createDataFrame(
        [(i + 1, *r) for i, r in enumerate(co_rows)],
        "record_id int, order_id int, customer_id int, pizza_id int, exclusions string, extras string, order_time string",
    )
    ro = spark.createDataFrame(runner_orders if runner_orders is not None else RUNNER_ORDERS, schemas.RUNNER_ORDERS)
    return DeliveryRaw(
        customer_orders=co,
        runner_orders=ro,
        pizza_names=spark.createDataFrame(PIZZA_NAMES, schemas.PIZZA_NAMES),
        pizza_recipes=spark.createDataFrame(PIZZA_RECIPES, schemas.PIZZA_RECIPES),
        pizza_toppings=spark.createDataFrame(PIZZA_TOPPINGS, schemas.PIZZA_TOPPINGS),
        runners=spark.createDataFrame(RUNNERS, schemas.RUNNERS),
        ratings=spark.createDataFrame(RATINGS, schemas.RATINGS),
    )
