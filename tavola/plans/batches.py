"""Orders that arrive in batches, from the raw feed to the ingredient list.

The cleaning chain of ``pipeline`` for tables that grow: each batch of pizzas gets ids that continue
those of the batches before (C14), its recipes are adjusted (C16) and appended, and answers (C17, I05)
read what all batches left. A batch that is run twice changes nothing. Cancellations that come in
later rewrite only the partitions of the orders they belong to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tavola.functions import nullify_sentinels
from tavola.operators import adjust_tagged, joined_list
from tavola.plans import delivery as D
from tavola.plans import ingredients as I
from tavola.plans import raw_feed
from tavola.sources.batches import BatchTable, LastingIds, refresh_partitions, scratch_path, update_from
from tavola.sources.testdata import Tables, load_tables

KEY = ["order_id", "record_seq"]
#: Lines shipped before this day are the first batch of the scale tables.
SECOND_BATCH = "1998-06-01"
#: Pizzas in a bucket of the store: with their ingredients, what a task groups and sorts in memory.
BUCKET_PIZZAS = 250_000


class OrderStore:
    """The tables of the chain under ``root``: records (one row a pizza, with its id) and qty (its
    adjusted multiset), both appended by batch.

    Both lie in the same buckets of the pizza's key. So each pizza moves once, as one row with its
    text lists; its ingredients, several times as many rows, are made, counted, listed and joined
    where it lies. ``pizzas``: how many are expected in all; sets the number of buckets."""

    def __init__(self, spark: SparkSession, root: str, feed: StructType, pizzas: int = 0):
        buckets = max(spark.sparkContext.defaultParallelism, -(-pizzas // BUCKET_PIZZAS))
        self.ids = LastingIds(spark, f"{root}/ids", feed, ["order_id"])
        pizza = StructType(list(feed)).add("record_seq", "long").add("pizza_name", "string")
        self.records = BatchTable(spark, f"{root}/records", pizza, KEY, buckets)
        amount = StructType([feed["order_id"]]).add("record_seq", "long").add("item", "string").add("qty", "long")
        self.qty = BatchTable(spark, f"{root}/qty", amount, KEY, buckets)

    def add_records(self, batch: int, feed: DataFrame, names: DataFrame) -> DataFrame:
        """The pizzas of ``batch`` with their ids, cleaned lists and names, as they were written."""
        numbered = self.ids.number(feed, batch)
        self.records.append(D.enrich_name(D.clean_customer_orders(numbered), names), batch)
        rows = self.records.read(only=batch)
        self.ids.mark(rows, batch)
        return rows

    def add(self, batch: int, feed: DataFrame, names: DataFrame, recipes: DataFrame, toppings: DataFrame) -> None:
        """``feed``: order_id, pizza_id, and the text lists exclusions and extras, and any columns
        that tell the rows of an order apart; ``recipes``: pizza_id, toppings (a text list of ids)."""
        rows = self.add_records(batch, feed, names)
        named = D.name_toppings(D.explode_recipe(recipes), toppings)
        uses = D.recipe_multiset_rows(rows, named, toppings, KEY)
        is_kind = [F.col("kind") == k for k in ("standard", "extra", "exclusion")]
        self.qty.append(adjust_tagged(uses, KEY, "item", *is_kind), batch)

    def adjusted_recipe(self) -> DataFrame:
        return D.adjusted_recipe(self.qty.read(), self.records.read(), KEY)

    def adjusted_rows(self) -> DataFrame:
        return D.adjusted_copies(self.qty.read(), self.records.read(), KEY)

    def ingredient_list(self) -> DataFrame:
        return I.ingredient_list(self.qty.read(), self.records.read(), KEY)


# ---------------------------------------------------------------- over the scale tables
def _feed(t: Tables) -> DataFrame:
    """Order lines as a raw feed of pizzas, with the day they were shipped."""
    supplier, part = F.col("l_suppkey") % 30, F.col("l_partkey") % 30
    exclusions, extras = raw_feed.modifier_texts(supplier, part)
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), (F.col("l_partkey") % 5).cast("int").alias("pizza_id"),
        exclusions.alias("exclusions"), extras.alias("extras"), F.col("l_shipdate").alias("shipped"),
    )


def _menu(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Regions as pizzas, their nations as recipe (a text list of ids) and toppings."""
    names = t.region.select(F.col("r_regionkey").alias("pizza_id"), F.col("r_name").alias("pizza_name"))
    nations = t.nation.select(F.col("n_regionkey").alias("pizza_id"), F.col("n_nationkey").cast("string").alias("id"))
    recipes = joined_list(nations, "pizza_id", "id", sep=", ", out="toppings")
    toppings = t.nation.select(F.col("n_nationkey").alias("topping_id"), F.col("n_name").alias("topping_name"))
    return names, recipes, toppings


def _batches(spark: SparkSession, t: Tables) -> tuple[OrderStore, list[tuple[int, DataFrame]]]:
    """A store, and the order lines in two batches, the second one run twice."""
    feed = _feed(t)
    store = OrderStore(spark, scratch_path(spark, "orders"), feed.drop("shipped").schema, t.lineitem.count())
    late = F.coalesce(F.col("shipped") >= F.lit(SECOND_BATCH).cast("timestamp_ntz"), F.lit(True))
    return store, [(k, feed.filter(own).drop("shipped")) for k, own in ((1, ~late), (2, late), (2, late))]


def stored_orders(spark: SparkSession, sf: str) -> OrderStore:
    t = load_tables(spark, sf)
    store, runs = _batches(spark, t)
    menu = _menu(t)
    for batch, feed in runs:
        store.add(batch, feed, *menu)
    return store


def record_ids(spark: SparkSession, sf: str) -> DataFrame:
    t = load_tables(spark, sf)
    store, runs = _batches(spark, t)
    for batch, feed in runs:
        store.add_records(batch, feed, _menu(t)[0])
    return store.records.read().select("order_id", "line", "pizza_id", "record_seq", "batch")


def adjusted_recipes(spark: SparkSession, sf: str) -> DataFrame:
    return stored_orders(spark, sf).adjusted_recipe()


def ingredient_lists(spark: SparkSession, sf: str) -> DataFrame:
    return stored_orders(spark, sf).ingredient_list()


def _month(day: str) -> Column:
    return F.year(day) * 100 + F.month(day)


def refreshed_cancellations(spark: SparkSession, sf: str) -> DataFrame:
    """Enriched orders by month; then runner rows of the last months change, as raw text."""
    t = load_tables(spark, sf)
    path = scratch_path(spark, "enriched-orders")
    raw = F.when(F.col("o_orderstatus") == "P", "Restaurant Cancellation")
    orders = t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), raw.alias("cancellation"), _month("o_orderdate").alias("month")
    )
    orders.repartition("month").write.partitionBy("month").parquet(path)
    late = t.orders.filter((_month("o_orderdate") >= 200010) & (F.col("o_orderkey") % 40 == 3))
    text = F.when(F.col("o_custkey") % 2 == 0, "Customer Cancellation").otherwise("null")
    changed = late.select(F.col("o_orderkey").alias("order_id"), nullify_sentinels(text).alias("cancellation"))
    refresh_partitions(spark, path, "month", changed, "order_id", lambda rows: update_from(rows, changed, "order_id", ["cancellation"]))
    return spark.read.schema(orders.schema).parquet(path)


KEYS = {
    "C14_record_id_batches": record_ids,
    "C16_adjusted_recipe_batches": adjusted_recipes,
    "I05_ingredient_list_batches": ingredient_lists,
    "C03_cancellation_refresh": refreshed_cancellations,
}

# One run over all lines: the batch only takes part in the order of an order's ids.
_STORE = f"""numbered AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line, CAST(l_partkey % 5 AS INT) AS pizza_id,
    CASE l_suppkey % 3 WHEN 0 THEN CAST([] AS BIGINT[]) WHEN 1 THEN [l_partkey % 30] ELSE [l_partkey % 30, l_suppkey % 30] END AS exc,
    CASE l_linenumber % 4 WHEN 2 THEN [l_suppkey % 30, l_partkey % 30] WHEN 3 THEN [l_suppkey % 30] ELSE CAST([] AS BIGINT[]) END AS ext,
    CASE l_suppkey % 3 WHEN 0 THEN 'null' WHEN 1 THEN (l_partkey % 30)::VARCHAR ELSE (l_partkey % 30) || ',' || (l_suppkey % 30) END AS exc_text,
    CASE l_linenumber % 4 WHEN 0 THEN 'null' WHEN 1 THEN '' WHEN 2 THEN (l_suppkey % 30) || ', ' || (l_partkey % 30)
      ELSE (l_suppkey % 30) || ', x' END AS ext_text,
    CASE WHEN l_shipdate < TIMESTAMP '{SECOND_BATCH}' THEN 1 ELSE 2 END::BIGINT AS batch
  FROM lineitem),
pizzas AS (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY batch, line, pizza_id, exc_text, ext_text) AS record_seq FROM numbered),
added AS (
  SELECT order_id, record_seq, n_nationkey AS id FROM pizzas JOIN nation ON n_regionkey = pizza_id
  UNION ALL SELECT order_id, record_seq, unnest(ext) FROM pizzas),
removed AS (SELECT order_id, record_seq, unnest(exc) AS id FROM pizzas),
amounts AS (
  SELECT order_id, record_seq, n_name AS item, count(*) AS qty
  FROM added a JOIN nation ON n_nationkey = id ANTI JOIN removed r USING (order_id, record_seq, id)
  GROUP BY order_id, record_seq, n_name)"""


def batches_sql() -> dict[str, str]:
    return {
        "C14_record_id_batches": f"WITH {_STORE} SELECT order_id, line, pizza_id, record_seq, batch FROM pizzas",
        "C16_adjusted_recipe_batches": f"""WITH {_STORE}
SELECT order_id, record_seq, min(r_name) AS pizza_name,
  array_to_string(flatten(list(list_transform(range(qty), lambda i: item) ORDER BY lower(item), item)), ',') AS adjust_full_recipe
FROM amounts JOIN pizzas USING (order_id, record_seq) JOIN region ON r_regionkey = pizza_id GROUP BY order_id, record_seq""",
        "I05_ingredient_list_batches": f"""WITH {_STORE}
SELECT order_id, record_seq, min(r_name) AS pizza_name, min(r_name) || ': '
  || string_agg(CASE WHEN qty > 1 THEN qty || 'x' ELSE '' END || item, ', ' ORDER BY lower(item), item) AS list_order
FROM amounts JOIN pizzas USING (order_id, record_seq) JOIN region ON r_regionkey = pizza_id GROUP BY order_id, record_seq""",
        "C03_cancellation_refresh": """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  CASE WHEN year(o_orderdate) * 100 + month(o_orderdate) >= 200010 AND o_orderkey % 40 = 3
       THEN CASE WHEN o_custkey % 2 = 0 THEN 'Customer Cancellation' END
       WHEN o_orderstatus = 'P' THEN 'Restaurant Cancellation' END AS cancellation,
  CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INT) AS month
FROM orders""",
    }
