"""Direct checks of operators that the answers otherwise only exercise indirectly."""

from pyspark.sql import functions as F

from tavola.functions import is_numeric, to_decimal
from tavola.operators import (
    check_split,
    joined_list,
    unique_on,
)


def test_check_split_keeps_unknown_as_valid(spark):
    df = spark.createDataFrame([(1, 0), (2, 3), (3, None), (4, 9)], "id int, rating int")
    valid, rejected = check_split(df, F.col("rating").between(1, 5))
    assert sorted(r.id for r in valid.collect()) == [2, 3]
    assert sorted(r.id for r in rejected.collect()) == [1, 4]


def test_numeric_guards(spark):
    vals = [" 12 ", "1.5", "$5", "1e3", "", None, "123.45", "12345.6"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    out = df.select(is_numeric("v").alias("n"), to_decimal("v", 4, 1).alias("d")).collect()
    assert [r.n for r in out] == [True, True, False, True, False, False, True, True]
    # rounded to the scale (123.45 -> 123.5); too large for decimal(4,1) gives NULL, not an error
    assert [None if r.d is None else float(r.d) for r in out] == [12.0, 1.5, None, None, None, None, 123.5, None]


def test_unique_on_and_joined_list_with_copies(spark):
    dim = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k int, name string")
    assert sorted(tuple(r) for r in unique_on(dim, ["k"], ["name"]).collect()) == [(1, "a"), (2, "c")]
    rows = [(1, 2, "y")] * 500 + [(1, 1, "x"), (2, 1, "z")]  # many copies of one entry
    df = spark.createDataFrame(rows, "k int, o int, v string")
    out = {r.k: r.items for r in joined_list(df, "k", "v", order="o", sep="|").collect()}
    assert out[2] == "z" and out[1].split("|")[0] == "x" and out[1].count("y") == 500


def test_adjusted_copies_keep_a_name_with_the_separator(spark):
    from tavola.plans.delivery import adjusted_copies

    qty = spark.createDataFrame([(1, "a, b", 2), (1, "c", 1), (2, "c", 0)], "record_id int, item string, qty long")
    records = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "record_id int, pizza_name string")
    got = sorted(tuple(r) for r in adjusted_copies(qty, records).collect())
    assert got == [(1, "x", "a, b"), (1, "x", "a, b"), (1, "x", "c")]


def test_final_order_is_the_callers_option(spark):
    from tavola.plans.delivery import speed
    from tavola.plans.ingredients import ingredient_list

    runs = [(i, 1, float(10 - i), 30) for i in range(8)] + [(9, 1, 5.0, 30), (10, 1, 1.0, None)]
    ro = spark.createDataFrame(runs, "order_id int, runner_id int, distance double, duration int")
    ro = ro.withColumn("distance", F.col("distance").cast("decimal(10,1)")).repartition(4)
    got = [(r.distance, r.order_id) for r in speed(ro, ordered=True).collect()]
    assert got == sorted(got) and len(got) == 9
    qty = spark.createDataFrame([(i, "x", 1) for i in range(9, 0, -1)], "record_id int, item string, qty long")
    records = spark.createDataFrame([(i, p) for i in range(9, 0, -1) for p in "ba"], "record_id int, pizza_name string")
    rows = [(r.record_id, r.pizza_name) for r in ingredient_list(qty, records, ordered=True).collect()]
    assert rows == sorted(rows) and len(rows) == 18
