"""Diner answers: spend, visits, favourites, purchases around the membership date, points.

Inputs follow the diner tables: ``sales(customer_id, order_date, product_id)``,
``menu(product_id, product_name, price)``, ``members(customer_id, join_date)``. Extra
columns on ``sales`` (e.g. a timestamp for tie-breaks) are carried along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tavola.functions import to_money
from tavola.operators import (
    broadcast_if_small,
    dense_rank_in_ranges,
    dense_rank_of,
    first_by,
    in_any_period,
    keep_max_ties,
    last_before,
    rows_at_extreme,
    splittable,
    top_one,
)
from tavola.session import materialize

# Points per $1 and the items that earn double.
POINTS_PER_UNIT = 10
DOUBLE_POINT_ITEMS = ("sushi",)
BOOST_DAYS = 7


def priced_sales(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Sales with product name and price (inner join: unknown products drop out)."""
    dim = broadcast_if_small(menu.select("product_id", "product_name", "price"))
    return sales.join(dim, "product_id", "inner")


def _with_members(sales: DataFrame, menu: DataFrame, members: DataFrame, how: str = "inner") -> DataFrame:
    return priced_sales(sales, menu).join(splittable(members.select("customer_id", "join_date")), "customer_id", how)


# D01
def total_spend(sales: DataFrame, menu: DataFrame) -> DataFrame:
    return priced_sales(sales, menu).groupBy("customer_id").agg(to_money(F.sum("price")).alias("total_spent"))


# D02
def visit_days(sales: DataFrame) -> DataFrame:
    return sales.groupBy("customer_id").agg(F.countDistinct("order_date").alias("visits"))


# D03
def first_items(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Every item each customer bought on their own first day (duplicates kept)."""
    first_day = rows_at_extreme(sales, "customer_id", "order_date", "min")
    return priced_sales(first_day, menu).select("customer_id", "product_name")


def first_items_any(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Literal form: purchases made on any date that is some customer's first date."""
    firsts = sales.groupBy("customer_id").agg(F.min("order_date").alias("__d")).select("__d").distinct()
    # at most one row per calendar day: a bound that the optimizer's estimate cannot see
    hit = sales.join(F.broadcast(firsts), F.col("order_date") == F.col("__d"), "left_semi")
    return priced_sales(hit, menu).select("customer_id", "product_name")


# D04
def top_item(sales: DataFrame, menu: DataFrame) -> DataFrame:
    counts = priced_sales(sales, menu).groupBy("product_name").agg(F.count("order_date").alias("total"))
    return top_one(counts, [F.col("total").desc(), F.col("product_name").asc()])


# D05
def favourite_items(sales: DataFrame, menu: DataFrame) -> DataFrame:
    counts = priced_sales(sales, menu).groupBy("customer_id", "product_name").agg(F.count("product_name").alias("n"))
    # written once: the maxima and the rows at them are both taken from it
    return keep_max_ties(materialize(counts), "n", "customer_id").select("customer_id", "product_name")


# D06
def first_after_join(
    sales: DataFrame, menu: DataFrame, members: DataFrame, tie_break: Sequence[str] = ()
) -> DataFrame:
    """First purchase on or after the join date — exactly one row per member."""
    after = _with_members(sales, menu, members).filter(F.col("order_date") >= F.col("join_date"))
    return first_by(after, "customer_id", ["order_date", *tie_break, "product_name"], ["product_name"])


# D07
def last_before_join(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Every item of the member's last purchase day before joining."""
    before = _with_members(sales, menu, members).filter(F.col("order_date") < F.col("join_date"))
    # the join is written once: the last days and the rows on them are both taken from it
    before = materialize(before.select("customer_id", "order_date", "product_name"))
    return rows_at_extreme(before, "customer_id", "order_date", "max").select("customer_id", "product_name")


def last_purchases(sales: DataFrame, joins: DataFrame, longest_gap: str | None = None) -> DataFrame:
    """Before each of a customer's joins (customer_id, joined_at): the last purchase (``ts``, product),
    unless it is more than ``longest_gap`` back. Joins without one stay."""
    return last_before(
        joins, sales, "customer_id", "joined_at", {"ts": "purchased_at", "product_id": "product_id"}, right_ts="ts", longest_gap=longest_gap
    )


# D08
def spend_before_join(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    before = _with_members(sales, menu, members).filter(F.col("order_date") < F.col("join_date"))
    return before.groupBy("customer_id").agg(
        F.count("product_name").alias("total_items"), to_money(F.sum("price")).alias("total_price")
    )


def _points(price: Column, doubled: Column, per_unit: int) -> Column:
    return F.when(doubled, price * (per_unit * 2)).otherwise(price * per_unit)


# D09
def points(
    sales: DataFrame,
    menu: DataFrame,
    double_items: Sequence[str] = DOUBLE_POINT_ITEMS,
    per_unit: int = POINTS_PER_UNIT,
) -> DataFrame:
    doubled = F.col("product_name").isin(list(double_items))
    return (
        priced_sales(sales, menu)
        .groupBy("customer_id")
        .agg(to_money(F.sum(_points(F.col("price"), doubled, per_unit))).alias("total_points"))
    )


# D10
def points_with_boost(
    sales: DataFrame,
    menu: DataFrame,
    members: DataFrame,
    until: str,
    double_items: Sequence[str] = DOUBLE_POINT_ITEMS,
    per_unit: int = POINTS_PER_UNIT,
    boost_days: int = BOOST_DAYS,
) -> DataFrame:
    """Members' points up to ``until``: everything doubles in the first ``boost_days`` from joining."""
    rows = _with_members(sales, menu, members).filter(F.col("order_date") <= F.lit(until).cast("date"))
    in_boost = (F.col("order_date") >= F.col("join_date")) & (
        F.col("order_date") <= F.date_add(F.col("join_date"), boost_days - 1)
    )
    doubled = in_boost | F.col("product_name").isin(list(double_items))
    return rows.groupBy("customer_id").agg(to_money(F.sum(_points(F.col("price"), doubled, per_unit))).alias("total"))


def points_over_periods(
    sales: DataFrame,
    menu: DataFrame,
    periods: DataFrame,
    until: str,
    double_items: Sequence[str] = DOUBLE_POINT_ITEMS,
    per_unit: int = POINTS_PER_UNIT,
) -> DataFrame:
    """``points_with_boost`` for members with several boost periods (customer_id, start_date,
    end_date; the end included): a sale doubles once, in however many of them it lies."""
    members = splittable(periods.select("customer_id").distinct())
    rows = priced_sales(sales, menu).filter(F.col("order_date") <= F.lit(until).cast("date")).join(members, "customer_id", "left_semi")
    rows = in_any_period(rows, periods, "customer_id", "order_date", "start_date", "end_date", out="boosted")
    doubled = F.col("boosted") | F.col("product_name").isin(list(double_items))
    return rows.groupBy("customer_id").agg(to_money(F.sum(_points(F.col("price"), doubled, per_unit))).alias("total"))


# D11
def member_flag(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Every sale with 'Y' when made on/after the join date, else 'N' (non-members too)."""
    rows = _with_members(sales, menu, members, "left")
    member = F.when(F.col("order_date") >= F.col("join_date"), F.lit("Y")).otherwise(F.lit("N"))
    return rows.select("customer_id", "order_date", "product_name", to_money("price").alias("price"), member.alias("member"))


# D12
def member_rank(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """``member_flag`` plus the dense rank of member purchases by date; NULL for 'N' rows."""
    flagged = member_flag(sales, menu, members)
    ranked = dense_rank_of(flagged, ["customer_id", "member"], "order_date", out="__rnk")
    return ranked.select(
        "customer_id",
        "order_date",
        "product_name",
        "price",
        "member",
        F.when(F.col("member") == "N", F.lit(None)).otherwise(F.col("__rnk")).cast("int").alias("rnk"),
    )



def member_rank_by_instant(sales: DataFrame, members: DataFrame, ts: str = "ts") -> DataFrame:
    """D12 by instant instead of day: every sale with the member flag and, for members' sales, the
    dense rank of its instant among the customer's. A customer's instants are ranked in ranges,
    so one with any share of the sales is ranked by many tasks."""
    flagged = sales.join(splittable(members.select("customer_id", "join_date")), "customer_id", "left").withColumn(
        "member", F.when(F.col("order_date") >= F.col("join_date"), F.lit("Y")).otherwise(F.lit("N"))
    ).drop("join_date")
    ranked = dense_rank_in_ranges(flagged.filter(F.col("member") == "Y"), "customer_id", ts, out="rnk")
    rest = flagged.filter(F.col("member") == "N").withColumn("rnk", F.lit(None).cast("bigint"))
    return ranked.unionByName(rest)
