"""Every answer bound to the scale tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tavola.functions import csv_part, minutes_between, to_money
from tavola.operators import next_after
from tavola.plans import batches
from tavola.plans import delivery as D
from tavola.plans import diner
from tavola.plans import ingredients as I
from tavola.plans import raw_feed
from tavola.sources import adapters as A
from tavola.sources.batches import scratch_path
from tavola.sources.layout import in_order_layout
from tavola.sources.testdata import load_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str) -> Callable[[Query], Query]:
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return wrap


# ---------------------------------------------------------------- diner
def _loyalty(spark: SparkSession, sf: str):
    t = load_tables(spark, sf)
    return A.event_sales(t), A.menu(t), A.members(t)


def _orders_menu(spark: SparkSession, sf: str):
    t = load_tables(spark, sf)
    return A.order_sales(t), A.menu(t)


@register("D01_total_spend")
def _d01(spark, sf):
    return diner.total_spend(*_orders_menu(spark, sf))


@register("D02_visit_days")
def _d02(spark, sf):
    return diner.visit_days(_loyalty(spark, sf)[0])


@register("D03_first_items")
def _d03(spark, sf):
    sales, menu, _ = _loyalty(spark, sf)
    return diner.first_items(sales, menu)


@register("D03_first_items_any")
def _d03b(spark, sf):
    sales, menu, _ = _loyalty(spark, sf)
    return diner.first_items_any(sales, menu)


@register("D04_top_item")
def _d04(spark, sf):
    return diner.top_item(*_orders_menu(spark, sf))


@register("D05_favourite_items")
def _d05(spark, sf):
    return diner.favourite_items(*_orders_menu(spark, sf))


@register("D06_first_after_join")
def _d06(spark, sf):
    return diner.first_after_join(*_loyalty(spark, sf), tie_break=["ts", "event_id"])


@register("D07_last_before_join")
def _d07(spark, sf):
    return diner.last_before_join(*_loyalty(spark, sf))


@register("D07_last_before_signups")
def _d07b(spark, sf):
    t = load_tables(spark, sf)
    joins = A.signups(t).select("customer_id", F.col("ts").alias("joined_at"))
    return diner.last_purchases(A.event_sales(t), joins, longest_gap="2 days")


@register("D08_spend_before_join")
def _d08(spark, sf):
    return diner.spend_before_join(*_loyalty(spark, sf))


@register("D09_points")
def _d09(spark, sf):
    return diner.points(*_orders_menu(spark, sf), double_items=[A.DOUBLE_POINT_TYPE])


@register("D10_points_with_boost")
def _d10(spark, sf):
    return diner.points_with_boost(*_loyalty(spark, sf), until=A.POINTS_UNTIL, double_items=[A.DOUBLE_POINT_TYPE])


@register("D10_points_over_periods")
def _d10b(spark, sf):
    t = load_tables(spark, sf)
    day = F.to_date("ts")
    periods = A.signups(t).select("customer_id", day.alias("start_date"), F.date_add(day, 1).alias("end_date"))
    return diner.points_over_periods(A.event_sales(t), A.menu(t), periods, A.POINTS_UNTIL, [A.DOUBLE_POINT_TYPE])


@register("D11_member_flag")
def _d11(spark, sf):
    return diner.member_flag(*_loyalty(spark, sf))


@register("D12_member_rank")
def _d12(spark, sf):
    return diner.member_rank(*_loyalty(spark, sf))


@register("D12_member_rank_by_instant")
def _d12b(spark, sf):
    sales, _, members = _loyalty(spark, sf)
    return diner.member_rank_by_instant(sales, members)


# ---------------------------------------------------------------- delivery


def _dl(spark, sf):
    t = load_tables(spark, sf)
    return t, A.delivery(t)


def _coc(d):
    """Pizza name and the order's cancellation on every pizza, each table read once: the lines
    take the cancellation from the order's own row."""
    return D.enrich_cancellation(D.enrich_name(d.lines, d.pizza_names), d.cancellations, unique=True)


def _rating(col):
    return csv_part(col, 1, "-", "int")


def _ratings(t):
    """Delivered orders rated by the number leading their priority text ('1-URGENT' -> 1)."""
    return t.orders.filter(F.col("o_orderstatus") != A.CANCELLED_STATUS).select(
        F.col("o_orderkey").alias("order_id"),
        _rating("o_orderpriority").alias("rating"),
        F.col("o_orderpriority").alias("comments"),
    )


@register("C01_nullify_sentinels")
def _c01(spark, sf):
    t = load_tables(spark, sf)
    orders = t.orders.select("o_orderkey", "o_orderpriority")
    return D.clean_customer_orders(orders, ["o_orderpriority"], patterns=["%not specified%", "%null%"])


@register("C02_enrich_name")
def _c02(spark, sf):
    t, d = _dl(spark, sf)
    return D.enrich_name(d.customer_orders, d.pizza_names).select("order_id", "customer_id", "pizza_id", "pizza_name")


@register("C03_enrich_cancellation")
def _c03(spark, sf):
    t, d = _dl(spark, sf)
    return D.enrich_cancellation(d.lines, d.cancellations, unique=True).select("order_id", "pizza_id", "cancellation")


@register("C04_strip_units")
def _c04(spark, sf):
    t = load_tables(spark, sf)
    part = t.part.select("p_partkey", F.col("p_brand").alias("brand_no"))
    return D.clean_measures(part, {"brand_no": (["Brand#"], "prefix")})


@register("C05_to_decimal")
def _c05(spark, sf):
    out = D.distance_to_decimal(_c04(spark, sf).withColumnRenamed("brand_no", "distance"), 10, 1)
    return out.select("p_partkey", to_money("distance").alias("brand_no"))


@register("C06_to_int")
def _c06(spark, sf):
    t = load_tables(spark, sf)
    orders = t.orders.select("o_orderkey", csv_part("o_orderpriority", 1, "-").alias("duration"))
    return D.duration_to_int(orders).withColumnRenamed("duration", "priority_no")


@register("C07_totals")
def _c07(spark, sf):
    t, d = _dl(spark, sf)
    return D.runner_totals(d.runner_orders)


def _part_recipes(t):
    return t.part.select(F.col("p_partkey").alias("pizza_id"), F.col("p_name").alias("toppings"))


@register("C08_explode_recipe")
def _c08(spark, sf):
    t = load_tables(spark, sf)
    return D.explode_recipe(_part_recipes(t), sep=" ", cast=None)


@register("C09_name_toppings")
def _c09(spark, sf):
    t = load_tables(spark, sf)
    rows = t.nation.select(F.col("n_nationkey").alias("pizza_id"), F.col("n_regionkey").alias("topping_id"))
    tops = t.region.select(F.col("r_regionkey").alias("topping_id"), F.col("r_name").alias("topping_name"))
    return D.name_toppings(rows, tops)


@register("C10_toppings_text")
def _c10(spark, sf):
    t = load_tables(spark, sf)
    return D.toppings_text(t.region.select(F.col("r_regionkey").alias("topping_id"), F.col("r_name").alias("topping_name")))


@register("C11_split_modifiers")
def _c11(spark, sf):
    t = load_tables(spark, sf)
    return D.split_modifiers(t.part.select("p_partkey", "p_name"), sep=" ", cast=None, cols={"p_name": "word"})


@register("C12_name_modifiers")
def _c12(spark, sf):
    t = load_tables(spark, sf)
    cust = t.customer.select("c_custkey", "c_nationkey")
    return D.name_modifiers(cust, t.nation, name_col="n_name", cols=["c_nationkey"], id_col="n_nationkey", suffix="_name")


def _brand_recipes(t):
    return t.part.select(
        F.col("p_brand").alias("pizza_id"), F.col("p_type").alias("topping_id"), F.col("p_type").alias("topping_name")
    ).distinct()


@register("C13_attach_ingredients")
def _c13(spark, sf):
    t = load_tables(spark, sf)
    parts = t.part.select("p_partkey", F.col("p_brand").alias("pizza_id"))
    return D.attach_ingredients(parts, _brand_recipes(t))


@register("C14_record_id")
def _c14(spark, sf):
    t = load_tables(spark, sf)
    return D.with_record_id(t.lineitem, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "record_seq")


def _conv_tokens(spark, sf):
    t = load_tables(spark, sf)
    return D.explode_modifier(t.conversations, "text", ["conv_id", "turn"], sep=",")


@register("C15_explode_modifiers")
def _c15(spark, sf):
    return _conv_tokens(spark, sf)


def _qty(d):
    return d.qty


@register("C16_adjusted_recipe")
def _c16(spark, sf):
    t, d = _dl(spark, sf)
    return D.adjusted_recipe(_qty(d), d.records)


@register("C17_adjusted_rows")
def _c17(spark, sf):
    t, d = _dl(spark, sf)
    return D.adjusted_copies(_qty(d), d.records)


@register("C18_drop_blank")
def _c18(spark, sf):
    return D.drop_blank(_conv_tokens(spark, sf), "topping_id")


@register("C19_rating_check")
def _c19(spark, sf):
    t = load_tables(spark, sf)
    rated = t.lineitem.select(F.col("l_orderkey").alias("order_id"), F.col("l_quantity").cast("int").alias("rating"))
    checked = D.rating_check(rated, bounds=(1, 25))
    return checked.groupBy("check_status").agg(F.count(F.lit(1)).alias("n"))


@register("C19_checked_write")
def _c19b(spark, sf):
    t = load_tables(spark, sf)
    rules = {
        "quantity": F.col("l_quantity").between(1, 45),
        "discount": F.col("l_discount") < F.col("l_tax") + 0.08,
        "shipped": F.col("l_shipdate") >= F.lit("1995-03-01").cast("timestamp_ntz"),
    }
    return D.check_counts(t.lineitem, rules, scratch_path(spark, "checked-lines"))


@register("C20_delivery_report")
def _c20(spark, sf):
    t, d = _dl(spark, sf)
    rows = A.order_rows(t).filter(F.col("cancellation").isNull())
    return D.delivery_report_of_orders(D.ratings_valid(rows.withColumn("rating", _rating("comments"))))


@register("E03_ratings_valid")
def _e03(spark, sf):
    return D.ratings_valid(_ratings(load_tables(spark, sf)))


@register("E04_delivery_report")
def _e04(spark, sf):
    return _c20(spark, sf)


# A. pizza metrics
@register("A01_ordered_total")
def _a01(spark, sf):
    return D.ordered_total(_dl(spark, sf)[1].lines)


@register("A02_unique_customers")
def _a02(spark, sf):
    return D.unique_customers(_dl(spark, sf)[1].customer_orders)


@register("A02_customers_in_periods")
def _a02b(spark, sf):
    orders = load_tables(spark, sf).orders
    return D.unique_customers_in_periods(orders, "o_orderdate", "o_custkey")


@register("A03_delivered_by_runner")
def _a03(spark, sf):
    return D.delivered_by_runner(_dl(spark, sf)[1].runner_orders)


@register("A04_delivered_by_type")
def _a04(spark, sf):
    t, d = _dl(spark, sf)
    return D.delivered_by_type(D.enrich_name(d.lines, d.pizza_names), d.cancellations)


@register("A05_type_by_customer")
def _a05(spark, sf):
    return D.type_by_customer(_dl(spark, sf)[1].customer_orders, ["A", "N", "R"], col="flag")


@register("A06_max_in_order")
def _a06(spark, sf):
    t, d = _dl(spark, sf)
    return D.max_in_order(D.enrich_cancellation(d.lines, d.cancellations, unique=True))


@register("A07_changes_by_customer")
def _a07(spark, sf):
    t, d = _dl(spark, sf)
    return D.changes_by_customer(d.customer_orders)


@register("A08_both_changes")
def _a08(spark, sf):
    t, d = _dl(spark, sf)
    return D.both_changes(d.customer_orders)


def _purchases(spark, sf):
    return load_tables(spark, sf).events.filter(F.col("event_type") == "purchase").select("user_id", "ts")


@register("A09_by_hour")
def _a09(spark, sf):
    return D.by_hour(_purchases(spark, sf), "ts")


@register("A10_by_weekday")
def _a10(spark, sf):
    return D.by_weekday(_purchases(spark, sf), "ts")


# B. runner and customer experience
@register("B01_signups_by_week")
def _b01(spark, sf):
    ev = load_tables(spark, sf).events.filter(F.col("event_type") == "signup")
    return D.signups_by_week(ev, "ts")


@register("B01_order_weeks")
def _b01b(spark, sf):
    return D.signups_by_week(load_tables(spark, sf).orders, "o_orderdate")


@register("B02_avg_pickup")
def _b02(spark, sf):
    t, d = _dl(spark, sf)
    return D.avg_pickup_of_orders(A.order_rows(t).filter("has_lines"), F.col("pizza_rows"))


@register("B02_avg_pickup_per_order")
def _b02b(spark, sf):
    t, d = _dl(spark, sf)
    return D.avg_pickup_of_orders(A.order_rows(t).filter("has_lines"), F.lit(1))


@register("B02_signup_to_purchase")
def _b02c(spark, sf):
    ev = load_tables(spark, sf).events
    signups = ev.filter(F.col("event_type") == "signup").select("user_id", F.col("ts").alias("signup_ts"))
    buys = ev.filter(F.col("event_type") == "purchase").select("user_id", "ts")
    nxt = next_after(signups, buys, "user_id", "signup_ts", out="purchase_ts", right_ts="ts")
    return nxt.select(
        "user_id",
        "signup_ts",
        "purchase_ts",
        minutes_between("signup_ts", "purchase_ts").alias("minutes_boundary"),
        minutes_between("signup_ts", "purchase_ts", "elapsed").cast("bigint").alias("minutes_elapsed"),
    )


@register("B03_prep_by_size")
def _b03(spark, sf):
    t, d = _dl(spark, sf)
    orders = A.order_rows(t).filter("has_lines").withColumnRenamed("total_pizzas", "no_of_pizza")
    return D.prep_by_size_of_orders(orders)


@register("B04_avg_distance")
def _b04(spark, sf):
    t, d = _dl(spark, sf)
    return D.avg_distance_of_orders(A.order_rows(t).filter("has_lines").withColumnRenamed("pizza_rows", "__n"))


@register("B05_duration_spread")
def _b05(spark, sf):
    return D.duration_spread(_dl(spark, sf)[1].runner_orders)


@register("B06_speed")
def _b06(spark, sf):
    return D.speed(_dl(spark, sf)[1].runner_orders)


@register("B06_speed_positions")
def _b06b(spark, sf):
    return D.speed_with_position(_dl(spark, sf)[1].runner_orders)


@register("B07_delivery_rate")
def _b07(spark, sf):
    return D.delivery_rate(_dl(spark, sf)[1].runner_orders)


# C. ingredients
@register("I01_standard_ingredients")
def _i01(spark, sf):
    return I.standard_ingredients(_brand_recipes(load_tables(spark, sf)))


@register("I02_top_extra")
def _i02(spark, sf):
    return I.top_items(_dl(spark, sf)[1].extras)


@register("I03_top_exclusion")
def _i03(spark, sf):
    return I.top_items(_dl(spark, sf)[1].exclusions)


@register("I04_order_label")
def _i04(spark, sf):
    t, d = _dl(spark, sf)
    rows = d.records.join(d.modifiers, "record_id", "inner")
    details = I.label_sentence(
        F.col("pizza_name"),
        F.col("exclusions").isNotNull(),
        F.col("extras").isNotNull(),
        F.col("exclusion_list"),
        F.col("extra_list"),
        unmodified=None,
        modified=None,
    )
    return rows.select("record_id", "pizza_name", details.alias("order_details"))


@register("I05_ingredient_list")
def _i05(spark, sf):
    t, d = _dl(spark, sf)
    return I.ingredient_list(_qty(d), d.records)


@register("I05_ingredient_list_positions")
def _i05b(spark, sf):
    t, d = _dl(spark, sf)
    return I.ingredient_list_with_position(_qty(d), d.records)


@register("I06_ingredient_totals")
def _i06(spark, sf):
    t, d = _dl(spark, sf)
    return I.ingredient_totals(_qty(d))


@register("I06_ingredient_totals_delivered")
def _i06b(spark, sf):
    t, d = _dl(spark, sf)
    return I.ingredient_totals(_qty(d), d.records, delivered_only=True)


@register("I06_ingredient_totals_halved")
def _i06c(spark, sf):
    """The literal count: every total halved with integer division, as over a table loaded twice."""
    t, d = _dl(spark, sf)
    return I.ingredient_totals(_qty(d), divisor=2)


# D. pricing
_PRICES = {A.DOUBLE_POINT_TYPE: 12}


@register("E01_revenue")
def _e01(spark, sf):
    t, d = _dl(spark, sf)
    return D.revenue(_coc(d), _PRICES, 10)


@register("E02_revenue_with_extras")
def _e02(spark, sf):
    t, d = _dl(spark, sf)
    has_extra = F.col("extras").isNotNull()
    premium = has_extra & (F.col("flag") == "A")
    return D.revenue_with_extras(D.enrich_name(d.customer_orders, d.pizza_names), _PRICES, 10, premium, has_extra)


@register("E02_best_paid_extras")
def _e02b(spark, sf):
    t = load_tables(spark, sf)
    extras = t.lineitem.filter(F.col("l_returnflag") == "A").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("pos"), F.col("l_partkey").cast("string").alias("item"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
    )
    return D.best_paid_extras(t.orders.select(F.col("o_orderkey").alias("order_id")), extras)


def _profit(t):
    d = A.delivery(t)
    named = D.enrich_name(t.lineitem.withColumnRenamed("l_partkey", "pizza_id"), d.pizza_names)
    priced = D.price_of(F.col("pizza_name"), _PRICES, 10)
    orders = A.order_rows(t, named.withColumnRenamed("pizza_id", "l_partkey"), priced)
    return D.profit_of_orders(orders.filter(F.col("has_lines") & F.col("cancellation").isNull()))


@register("E05_profit")
def _e05(spark, sf):
    return _profit(load_tables(spark, sf))


@register("E05_profit_bucketed")
def _e05b(spark, sf):
    """Over order tables written once in buckets of the order: neither is shuffled to be summed or joined."""
    return _profit(in_order_layout(load_tables(spark, sf)))


# ---------------------------------------------------------------- messy text feeds
QUERIES.update(raw_feed.KEYS)
QUERIES.update(batches.KEYS)
