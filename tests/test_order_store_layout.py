"""The store's buckets: a pizza moves once, its ingredients never (I05 and C16 by batches)."""

import random

import fixtures as FX
import pytest
from frames import rows
from pyspark.sql import functions as F

from tavola.operators import adjust, adjust_tagged, continue_record_seq
from tavola.plans import delivery as D
from tavola.plans.batches import KEY, OrderStore, adjusted_recipes
from tavola.sources.batches import BatchTable, LastingIds


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)


def test_ingredients_do_not_move(spark, tmp_path, no_broadcast):
    raw = FX.delivery_raw(spark)
    feed = raw.customer_orders.drop("record_id")
    recipes, toppings = raw.pizza_recipes, raw.pizza_toppings
    for name, lookup in (("recipes", recipes), ("toppings", toppings)):  # files have a size, local rows none
        lookup.write.parquet(str(tmp_path / name))
    recipes, toppings = spark.read.parquet(str(tmp_path / "recipes")), spark.read.parquet(str(tmp_path / "toppings"))
    store = OrderStore(spark, str(tmp_path / "store"), feed.schema)
    for batch in (1, 2):
        store.add(batch, feed, raw.pizza_names, recipes, toppings)
    for answer in (store.ingredient_list(), store.adjusted_recipe(), store.adjusted_rows()):
        assert "Exchange" not in _plan(answer) and answer.count() > 0
    named = D.name_toppings(D.explode_recipe(recipes), toppings)
    uses = D.recipe_multiset_rows(store.records.read(only=1), named, toppings, KEY)
    amounts = adjust_tagged(uses, KEY, "item", *[F.col("kind") == k for k in ("standard", "extra", "exclusion")])
    assert "hashpartitioning(order_id" not in _plan(amounts.repartition(store.qty.buckets, *KEY).sortWithinPartitions(*KEY))
    assert rows(amounts) == rows(store.qty.read(only=1).drop("batch"))


def test_buckets_follow_the_pizzas(spark, tmp_path):
    feed = FX.delivery_raw(spark).customer_orders.drop("record_id")
    assert OrderStore(spark, str(tmp_path / "a"), feed.schema).qty.buckets == spark.sparkContext.defaultParallelism
    assert OrderStore(spark, str(tmp_path / "b"), feed.schema, 100_000_001).records.buckets == 401


def test_bucketed_batches(spark, tmp_path):
    df = spark.range(40).selectExpr("id", "IF(id % 9 = 0, NULL, id % 3) AS k", "CAST(id AS STRING) AS text")
    table = BatchTable(spark, str(tmp_path / "t"), df.schema, ["k", "id"], 3)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    assert table.read().count() == 0
    assert [table.append(df.filter("id < 10"), 1), table.append(df.filter("id >= 10"), 2), table.append(df.filter("id >= 10"), 2)] == [10, 30, 30]
    assert rows(table.read().drop("batch")) == rows(df) and table.read(before=2).count() == 10 == table.read(only=1).count()
    again = BatchTable(spark, str(tmp_path / "t"), df.schema, ["k", "id"], 7)  # another session's view of the folder
    assert again.buckets == 3 and rows(again.read().drop("batch")) == rows(df)
    assert again.append(df.filter("id >= 10"), 3) == 30 and table.read().count() == 70
    assert table.append(df.limit(0), 2) == 0 and table.append(df.limit(0), 9) == 0
    assert rows(table.read().groupBy("batch").count()) == [(1, 10), (3, 30)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


@pytest.mark.parametrize("hot_rows", [0, 30, 1_000_000])
def test_numbers_go_on_behind_the_highest(spark, hot_rows):
    rng = random.Random(hot_rows)
    data = [(rng.choice([1, 1, 1, 2, 3, 4, None]), rng.choice(["a", "b", "c", None])) for _ in range(150)]
    used = [(1, 7), (1, 5), (2, 1), (9, 4), (None, 3)]
    got = continue_record_seq(
        spark.createDataFrame(data, "k long, text string").repartition(5), ["k"], spark.createDataFrame(used, "k int, high long"), hot_rows=hot_rows
    )
    assert got.schema["k"].dataType.typeName() == "long"
    want, last = [], {k: max(h for q, h in used if q == k) for k in {k for k, _ in used}}
    for k, text in sorted(data, key=lambda r: (str(r[0]), r[1] is not None, r[1] or "")):
        last[k] = last.get(k, 0) + 1
        want.append((k, text, last[k]))
    assert rows(got) == sorted(want, key=lambda t: tuple(map(str, t)))


def test_rows_to_number_move_once(spark, tmp_path):
    df = spark.range(100).selectExpr("id % 7 AS order_id", "CAST(id AS STRING) AS text")
    ids = LastingIds(spark, str(tmp_path / "ids"), df.schema, ["order_id"])
    ids.assign(df, 1)
    assert _plan(ids.number(df, 2)).count("Exchange") == 1


def test_tagged_rows_are_the_three_inputs(spark):
    co = spark.createDataFrame(
        [(1, 1, 1, "2, x,3", None), (1, 2, None, "3", "3,3"), (2, 1, 2, None, "1, 9"), (2, 1, 2, "", "null"), (None, 1, 1, "4", "2"), (3, 1, 8, None, None)],
        "order_id long, record_seq long, pizza_id int, exclusions string, extras string",
    )
    named = spark.createDataFrame([(1, 1, "A"), (1, 1, "A"), (1, 2, "B"), (2, 3, None), (None, 1, "N")], "pizza_id int, topping_id int, topping_name string")
    toppings = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C"), (3, "c"), (4, None), (None, "N")], "topping_id int, topping_name string")
    inputs = dict(zip(("standard", "extra", "exclusion"), D.recipe_multiset_inputs(co, named, toppings, KEY), strict=True))
    uses = D.recipe_multiset_rows(co, named, toppings, KEY)
    for kind, df in inputs.items():
        assert rows(uses.filter(F.col("kind") == kind).drop("kind")) == rows(df) != []
    tagged = adjust_tagged(uses, KEY, "item", *[F.col("kind") == k for k in inputs])
    assert rows(tagged) == rows(adjust(*inputs.values(), KEY, "item"))


def _plain_lists(lines, nations):
    """order_id, record_seq, text of every pizza's ingredients, from the typed columns."""
    out, last = [], {}
    for r in sorted(lines, key=lambda r: (r.l_orderkey, str(r.l_shipdate) >= "1998-06-01", r.l_linenumber)):
        last[r.l_orderkey] = seq = last.get(r.l_orderkey, 0) + 1
        s, p = r.l_suppkey % 30, r.l_partkey % 30
        gone = [[], [p], [p, s]][r.l_suppkey % 3]
        items = [k for k in nations if nations[k][1] == r.l_partkey % 5] + [[], [], [s, p], [s]][r.l_linenumber % 4]
        kept = sorted((nations[k][0] for k in items if k in nations and k not in gone), key=lambda n: (n.lower(), n))
        if kept:
            out.append((r.l_orderkey, seq, ",".join(kept)))
    return sorted(out, key=lambda t: tuple(map(str, t)))


def test_adjusted_recipes_of_both_batches_without_a_shuffle(spark, tmp_path, no_broadcast):
    lines = spark.range(60).selectExpr(
        "id % 17 AS l_orderkey", "id * 7 AS l_partkey", "id * 5 % 31 AS l_suppkey", "CAST(id / 17 AS INT) AS l_linenumber",
        "TIMESTAMP_NTZ'1998-05-20 00:00:00' + make_dt_interval(CAST(id * 11 % 25 AS INT)) AS l_shipdate",
    )
    nations = spark.range(25).selectExpr("CAST(id AS INT) AS n_nationkey", "concat(IF(id % 2 = 0, 'N', 'n'), id % 13) AS n_name", "CAST(id % 5 AS INT) AS n_regionkey")
    regions = spark.range(5).selectExpr("CAST(id AS INT) AS r_regionkey", "concat('R', id) AS r_name")
    for name, df in (("lineitem", lines), ("nation", nations), ("region", regions)):
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    got = adjusted_recipes(spark, str(tmp_path))
    assert "Exchange" not in _plan(got)
    names = {r.n_nationkey: (r.n_name, r.n_regionkey) for r in nations.collect()}
    assert rows(got, "order_id", "record_seq", "adjust_full_recipe") == _plain_lists(lines.collect(), names)
