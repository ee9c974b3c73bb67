"""Answers over a messy feed that Spark derives from the scale tables.

The adapters' columns are typed already, so text rules would never fire on them. Here the same
rows are written as the feeds look: units glued to numbers in several spellings, 'null' as text,
comma-separated id lists with blanks and junk. The registered keys run the cleaning operators on
this text; ``raw_feed_sql`` states the expected values from the typed columns, without parsing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tavola.plans import delivery as D
from tavola.plans import ingredients as I
from tavola.sources import adapters as A
from tavola.sources.testdata import Tables, load_tables

PRICES = {"Meatlovers": 12, "Vegetarian": 10}
PREMIUM = "NATION_7"


def _text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _choice(selector: Column, *texts: Column) -> Column:
    """The text at place ``selector`` modulo their number."""
    place = F.pmod(selector, F.lit(len(texts)))
    out = texts[0]
    for k, t in enumerate(texts[1:], 1):
        out = F.when(place == k, t).otherwise(out)
    return out


def runner_feed(t: Tables) -> DataFrame:
    """One row per order, all text: distance, duration, pickup_time, cancellation."""
    km = _text(F.floor("o_totalprice") % 100)
    minutes = _text(F.col("o_custkey") % 60 + 1)
    null = F.lit("null")
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        (F.col("o_custkey") % 50).alias("runner_id"),
        _choice(F.col("o_orderkey"), F.concat(km, F.lit("km")), F.concat(km, F.lit(" km")), km, null).alias("distance"),
        _choice(
            F.col("o_custkey"), F.concat(minutes, F.lit(" minutes")), F.concat(minutes, F.lit("mins")),
            F.concat(minutes, F.lit(" mins")), F.concat(minutes, F.lit("minute")), minutes, null,
        ).alias("duration"),
        F.when(F.col("o_orderkey") % 4 == 3, null).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("pickup_time"),
        F.when(F.col("o_orderstatus") == "P", "Restaurant Cancellation").otherwise(
            F.when(F.col("o_orderstatus") == "O", F.lit("")).otherwise(null)
        ).alias("cancellation"),
    )


def modifier_texts(supplier: Column, part: Column) -> tuple[Column, Column]:
    """The text lists of a line's exclusions and extras, from two topping ids."""
    supplier, part = _text(supplier), _text(part)
    exclusions = _choice(F.col("l_suppkey"), F.lit("null"), part, F.concat(part, F.lit(","), supplier))
    extras = _choice(F.col("l_linenumber"), F.lit("null"), F.lit(""), F.concat(supplier, F.lit(", "), part), F.concat(supplier, F.lit(", x")))
    return exclusions, extras


def pizza_feed(t: Tables, numbered: bool = True) -> DataFrame:
    """One row per order line: pizza name and the text lists of exclusions and extras, and, if
    ``numbered``, the record id that tells rows of one order and line apart."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    exclusions, extras = modifier_texts(F.col("l_suppkey") % 30, F.col("l_partkey") % 30)
    rows = D.with_record_id(lines, ["l_orderkey", "l_linenumber"]) if numbered else lines
    return rows.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        *(["record_seq"] if numbered else []),
        F.when(F.col("l_partkey") % 3 == 0, "Meatlovers").when(F.col("l_partkey") % 3 == 1, "Vegetarian").otherwise("Special").alias("pizza_name"),
        exclusions.alias("exclusions"),
        extras.alias("extras"),
    )


def _clean(t: Tables, numbered: bool = True) -> DataFrame:
    return D.clean_customer_orders(pizza_feed(t, numbered))


def _toppings(t: Tables, name: str = "topping_name") -> DataFrame:
    return t.nation.select(F.col("n_nationkey").alias("topping_id"), F.col("n_name").alias(name))


def strip_units(spark: SparkSession, sf: str) -> DataFrame:
    return D.strip_runner_text(runner_feed(load_tables(spark, sf))).drop("runner_id")


def delivered_by_runner(spark: SparkSession, sf: str) -> DataFrame:
    return D.delivered_by_runner(runner_feed(load_tables(spark, sf)))


def top_extra(spark: SparkSession, sf: str) -> DataFrame:
    t = load_tables(spark, sf)
    return I.top_modifier(_clean(t, numbered=False), "extras", _toppings(t, "new_topping_name"))


def top_exclusion(spark: SparkSession, sf: str) -> DataFrame:
    t = load_tables(spark, sf)
    return I.top_modifier(_clean(t, numbered=False), "exclusions", _toppings(t, "new_topping_name"))


def listed_toppings(spark: SparkSession, sf: str) -> DataFrame:
    """Both lists of a pizza as one text, split into rows; blank tokens are dropped (C17, C18)."""
    t = load_tables(spark, sf)
    feed = pizza_feed(t, numbered=False)
    text = F.concat_ws(",", "exclusions", F.lit(" "), "extras").alias("adjust_full_recipe")
    rows = D.adjusted_rows(feed.select("order_id", "line", "pizza_name", text), ["order_id", "line"])
    return D.drop_blank(rows)


def four_names(spark: SparkSession, sf: str) -> DataFrame:
    t = load_tables(spark, sf)
    split = D.split_modifiers(_clean(t, numbered=False)).drop("exclusions", "extras", "pizza_name")
    return D.name_modifiers(split, _toppings(t), key=["order_id", "line"])


def order_labels(spark: SparkSession, sf: str) -> DataFrame:
    t = load_tables(spark, sf)
    rows = I.order_label_of_texts(_clean(t, numbered=False), _toppings(t))
    return rows.select("order_id", "line", "order_details")


def revenue_per_extra(spark: SparkSession, sf: str) -> DataFrame:
    """Pizzas outside the price list earn nothing but their extras."""
    t = load_tables(spark, sf)
    co = _clean(t, numbered=False)
    extras = D.modifier_rows(co, "extras", _toppings(t), ["order_id"])
    return D.revenue_per_extra_by_order(co, PRICES, 0, extras, PREMIUM, A.delivery(t).cancellations)


def ratings_in_range(spark: SparkSession, sf: str) -> DataFrame:
    """Quantities 1 to 50 as ratings: most are out of range."""
    t = load_tables(spark, sf)
    return D.ratings_valid(t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("rating")))


def prep_by_size(spark: SparkSession, sf: str) -> DataFrame:
    """Events as orders of 1 to 3 pizzas, picked up some seconds later: minutes are boundaries
    crossed, not minutes passed."""
    ev = load_tables(spark, sf).events
    later = F.expr("ts + make_dt_interval(0, 0, 0, CAST(event_id * 37 % 7200 AS DECIMAL(18,6)))")
    return D.prep_by_size_of_orders(
        ev.select((F.col("event_id") % 3 + 1).alias("no_of_pizza"), F.col("ts").alias("order_time"), later.alias("pickup_time"))
    )


KEYS = {
    "C04_strip_runner_text": strip_units,
    "A03_delivered_raw_text": delivered_by_runner,
    "I02_top_extra_lists": top_extra,
    "I03_top_exclusion_lists": top_exclusion,
    "C18_drop_blank_tokens": listed_toppings,
    "C12_four_name_columns": four_names,
    "I04_order_label_lists": order_labels,
    "E02_revenue_per_extra": revenue_per_extra,
    "E03_ratings_out_of_range": ratings_in_range,
    "B03_prep_sub_day": prep_by_size,
}

# The lists' ids from the typed columns; ids from 25 on name nothing.
_IDS = """ids AS (
  SELECT row_number() OVER () AS rid, l_orderkey AS order_id, l_linenumber AS line, l_partkey % 3 AS kind,
    CASE l_suppkey % 3 WHEN 0 THEN CAST([] AS BIGINT[]) WHEN 1 THEN [l_partkey % 30] ELSE [l_partkey % 30, l_suppkey % 30] END AS exc,
    CASE l_linenumber % 4 WHEN 2 THEN [l_suppkey % 30, l_partkey % 30] WHEN 3 THEN [l_suppkey % 30] ELSE CAST([] AS BIGINT[]) END AS ext
  FROM lineitem)"""


def _names(column: str) -> str:
    """rid, l: the names of a list's ids in order; none, no row."""
    return f"""SELECT rid, string_agg(n_name, ', ' ORDER BY pos) AS l
  FROM (SELECT rid, unnest({column}) AS id, generate_subscripts({column}, 1) AS pos FROM ids) x
  JOIN nation ON n_nationkey = id GROUP BY rid"""


def raw_feed_sql() -> dict[str, str]:
    km, minutes = "CAST(CAST(floor(o_totalprice) AS BIGINT) % 100 AS VARCHAR)", "CAST(o_custkey % 60 + 1 AS VARCHAR)"
    return {
        "C04_strip_runner_text": f"""SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 4 <> 3 THEN {km} END AS distance,
  CASE WHEN o_custkey % 6 <> 5 THEN {minutes} END AS duration,
  CASE WHEN o_orderkey % 4 <> 3 THEN strftime(o_orderdate, '%Y-%m-%d') END AS pickup_time,
  CASE WHEN o_orderstatus = 'P' THEN 'Restaurant Cancellation' END AS cancellation FROM orders""",
        "A03_delivered_raw_text": """SELECT o_custkey % 50 AS runner_id, count(*) AS total_delivered FROM orders
WHERE o_custkey % 6 <> 5 GROUP BY 1""",
        "I02_top_extra_lists": f"""WITH {_IDS},
c AS (SELECT n_name AS new_topping_name, count(*) AS topping_count
      FROM (SELECT unnest(ext) AS id FROM ids) e JOIN nation ON n_nationkey = id GROUP BY n_name)
SELECT * FROM c WHERE topping_count = (SELECT max(topping_count) FROM c)""",
        "I03_top_exclusion_lists": f"""WITH {_IDS},
c AS (SELECT n_name AS new_topping_name, count(*) AS topping_count
      FROM (SELECT unnest(exc) AS id FROM ids) e JOIN nation ON n_nationkey = id GROUP BY n_name)
SELECT * FROM c WHERE topping_count = (SELECT max(topping_count) FROM c)""",
        "C18_drop_blank_tokens": f"""WITH {_IDS},
tokens AS (
  SELECT order_id, line, kind, unnest(list_transform(if(len(exc) > 0, exc::VARCHAR[], ['null']), lambda x: x::VARCHAR)) AS topping FROM ids
  UNION ALL SELECT order_id, line, kind, unnest(list_transform(ext, lambda x: x::VARCHAR)) FROM ids
  UNION ALL SELECT order_id, line, kind, CASE line % 4 WHEN 0 THEN 'null' ELSE 'x' END FROM ids WHERE line % 4 IN (0, 3))
SELECT order_id, line, ['Meatlovers', 'Vegetarian', 'Special'][kind + 1] AS pizza_name, topping FROM tokens""",
        "C12_four_name_columns": f"""WITH {_IDS}
SELECT i.order_id, i.line, {', '.join(f"CAST(i.{c}[{k}] AS INT) AS {n}_{k}, {n}{k}.n_name AS {n}_{k}_topping" for c, n in (('exc', 'exclusion'), ('ext', 'extra')) for k in (1, 2))}
FROM ids i {' '.join(f"LEFT JOIN nation {n}{k} ON {n}{k}.n_nationkey = i.{c}[{k}]" for c, n in (('exc', 'exclusion'), ('ext', 'extra')) for k in (1, 2))}""",
        "I04_order_label_lists": f"""WITH {_IDS}, x AS ({_names('exc')}), e AS ({_names('ext')}),
p AS (
  SELECT i.order_id, i.line, kind, len(exc) > 0 AS has_x, len(ext) > 0 AS has_e, x.l AS xs, e.l AS es
  FROM ids i LEFT JOIN x ON x.rid = i.rid LEFT JOIN e ON e.rid = i.rid)
SELECT order_id, line, CASE
  WHEN NOT has_x AND NOT has_e THEN ['Meat Lovers', 'Vegetarian Lovers', 'No modifications'][kind + 1]
  WHEN has_x AND xs IS NULL OR has_e AND es IS NULL THEN 'Unknown modification'
  ELSE CASE kind WHEN 0 THEN 'Meat Lovers' ELSE 'Vegetarian Lovers' END || ' with '
    || concat_ws(' and ', 'exclude ' || xs, 'extras ' || es) END AS order_details
FROM p""",
        "E02_revenue_per_extra": f"""WITH {_IDS},
charges AS (SELECT order_id, sum(CASE WHEN n_name = '{PREMIUM}' THEN 2 ELSE 1 END) AS charge
  FROM (SELECT order_id, unnest(ext) AS id FROM ids) e JOIN nation ON n_nationkey = id GROUP BY order_id),
base AS (SELECT order_id, sum([12, 10, 0][kind + 1]) AS base FROM ids GROUP BY order_id)
SELECT CAST(sum(base + coalesce(charge, 0)) AS BIGINT) AS total_revenue
FROM base b LEFT JOIN charges c ON c.order_id = b.order_id LEFT JOIN orders ON o_orderkey = b.order_id
WHERE o_orderstatus IS DISTINCT FROM 'P'""",
        "E03_ratings_out_of_range": """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INT) AS rating FROM lineitem
WHERE l_quantity BETWEEN 1 AND 5""",
        "B03_prep_sub_day": """SELECT event_id % 3 + 1 AS no_of_pizza,
  round(CAST(sum(date_diff('minute', ts, ts + to_seconds(event_id * 37 % 7200))) AS DOUBLE) / count(*), 2) AS avg_preparation
FROM events GROUP BY 1""",
    }
