"""Batches, lasting ids, refreshed partitions, periods, backward as-of, ranks and positions in ranges,
one-pass checks and distinct counts that add up."""

import datetime as dt
import random
from pathlib import Path

import fixtures as FX
import pytest
from frames import rows
from pyspark.sql import functions as F

from tavola.operators import (
    day_bitmaps,
    dense_rank_in_ranges,
    distinct_in_periods,
    hot_keys,
    in_any_period,
    last_before,
    next_after,
    with_position,
    write_checked,
)
from tavola.plans import delivery as D
from tavola.plans import diner
from tavola.plans.batches import OrderStore
from tavola.plans.pipeline import clean
from tavola.sources.batches import BatchTable, LastingIds, refresh_partitions, update_from

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- appended batches
def test_repeated_batch_changes_nothing(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "id % 3 AS k")
    table = BatchTable(spark, str(tmp_path / "t"), df.schema)
    assert table.append(df.filter("id < 4"), 1) == 4
    assert table.append(df.filter("id >= 4"), 2) == 6
    files = sorted((p.name, p.stat().st_mtime_ns) for p in (tmp_path / "t" / "batch=1").glob("*.parquet"))
    assert table.append(df.filter("id >= 4"), 2) == 6
    assert rows(table.read(), "id", "k") == rows(df, "id", "k")
    assert sorted((p.name, p.stat().st_mtime_ns) for p in (tmp_path / "t" / "batch=1").glob("*.parquet")) == files
    assert rows(table.read(before=2), "id") == [(0,), (1,), (2,), (3,)]


def test_batch_that_becomes_empty_and_empty_table(spark, tmp_path):
    df = spark.range(5).toDF("id")
    table = BatchTable(spark, str(tmp_path / "t"), df.schema)
    assert table.append(df.limit(0), 1) == 0 and table.read().count() == 0
    table.append(df, 1)
    table.append(df, 2)
    assert table.append(df.limit(0), 1) == 0
    assert table.read().count() == 5 and table.read(before=2).count() == 0


def test_batch_filter_prunes_partitions(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), spark.range(1).schema)
    table.append(spark.range(3), 1)
    assert "PartitionFilters: [isnotnull(batch" in _plan(table.read(before=1))


# ---------------------------------------------------------------- ids that last
def _lines(spark, pairs):
    return spark.createDataFrame(pairs, "order_id long, text string")


def test_ids_last_and_are_dense(spark, tmp_path):
    one = _lines(spark, [(1, "b"), (1, "a"), (2, "x"), (2, "x"), (None, "n")])
    two = _lines(spark, [(1, "0"), (3, "c"), (None, "a"), (2, "x")])
    ids = LastingIds(spark, str(tmp_path / "ids"), one.schema, ["order_id"])
    first = rows(ids.assign(one, 1))
    second = rows(ids.assign(two, 2))
    assert first == sorted([(1, "a", 1), (1, "b", 2), (2, "x", 1), (2, "x", 2), (None, "n", 1)], key=lambda t: tuple(map(str, t)))
    assert second == sorted([(1, "0", 3), (3, "c", 1), (None, "a", 2), (2, "x", 3)], key=lambda t: tuple(map(str, t)))
    assert rows(ids.assign(one, 1)) == first and rows(ids.assign(two, 2)) == second  # run again, in any order
    third = rows(ids.assign(_lines(spark, [(1, "z"), (4, "q")]), 3))
    assert third == [(1, "z", 4), (4, "q", 1)]
    assert ids.assign(one.limit(0), 4).count() == 0


def test_hot_order_is_numbered_by_many_tasks(spark, tmp_path):
    df = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS order_id", "CAST(hash(id) AS STRING) AS text")
    ids = LastingIds(spark, str(tmp_path / "ids"), df.schema, ["order_id"])
    ids.assign(df.filter("id % 2 = 0"), 1)
    late = ids.assign(df.filter("id % 2 = 1"), 2).filter("order_id = 0")
    assert late.agg(F.min("record_seq"), F.max("record_seq"), F.countDistinct("record_seq")).first() == (5001, 10000, 5000)


def test_store_of_two_batches_equals_one_run(spark, tmp_path):
    raw = FX.delivery_raw(spark)
    feed = raw.customer_orders.drop("record_id")
    whole = OrderStore(spark, str(tmp_path / "whole"), feed.schema)
    whole.add(1, feed, raw.pizza_names, raw.pizza_recipes, raw.pizza_toppings)
    parts = OrderStore(spark, str(tmp_path / "parts"), feed.schema)
    for batch, own in ((1, feed.filter("order_id <= 5")), (2, feed.filter("order_id > 5")), (2, feed.filter("order_id > 5")), (1, feed.filter("order_id <= 5"))):
        parts.add(batch, own, raw.pizza_names, raw.pizza_recipes, raw.pizza_toppings)
    for answer in ("adjusted_recipe", "adjusted_rows", "ingredient_list"):
        assert rows(getattr(parts, answer)()) == rows(getattr(whole, answer)())
    # and the chain without batches, whose ids are in its input
    lists = [r[-1] for r in rows(D.adjusted_recipe(*(lambda c: (c.qty, c.records))(clean(raw))))]
    assert sorted(r.adjust_full_recipe for r in parts.adjusted_recipe().collect()) == sorted(x for x in lists)


# ---------------------------------------------------------------- refreshed partitions
def test_refresh_leaves_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "orders")
    base = spark.range(600).selectExpr("id AS order_id", "CAST(id % 6 AS INT) AS month", "IF(id % 5 = 0, 'Restaurant', NULL) AS cancellation", "id * 2 AS other")
    base.repartition("month").write.partitionBy("month").parquet(path)
    stamp = lambda m: sorted((p.name, p.stat().st_mtime_ns) for p in (Path(path) / f"month={m}").glob("*.parquet"))
    before = {m: stamp(m) for m in range(6)}
    changed = spark.createDataFrame([(7, "Customer"), (13, None), (10, None), (9999, "nobody"), (None, "x")], "order_id long, cancellation string")
    assert refresh_partitions(spark, path, "month", changed, "order_id", lambda r: update_from(r, changed, "order_id", ["cancellation"])) == [1, 4]
    want = {r.order_id: r for r in base.collect()}
    got = {r.order_id: r for r in spark.read.parquet(path).collect()}
    assert len(got) == 600 and all(got[i].other == 2 * i and got[i].month == i % 6 for i in got)
    assert {i for i in got if got[i].cancellation != want[i].cancellation} == {7, 10}
    assert got[7].cancellation == "Customer" and got[10].cancellation is None
    assert [m for m in range(6) if stamp(m) != before[m]] == [1, 4]
    assert refresh_partitions(spark, path, "month", changed.limit(0), "order_id", lambda r: r) == []


def test_update_from_takes_one_row_a_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(1, "z"), (1, "y"), (None, "q")], "k int, v string")
    assert rows(update_from(df, new, "k", ["v"])) == [(1, "y"), (2, "b"), (None, "n")]


# ---------------------------------------------------------------- periods
def _inside(sales, periods):
    return [any(k is not None and k == c and at is not None and s is not None and e is not None and s <= at <= e for c, s, e in periods) for k, at in sales]


@pytest.mark.parametrize("hot_rows", [5, 1_000_000])
@pytest.mark.parametrize("kind", ["date", "timestamp_ntz"])
def test_rows_in_any_period(spark, hot_rows, kind):
    rng = random.Random(hot_rows)
    day = lambda: dt.date(2024, 1, 1) + dt.timedelta(rng.randint(0, 90))
    at = (lambda: day()) if kind == "date" else (lambda: dt.datetime.combine(day(), dt.time(rng.randint(0, 23))))
    sales = [(rng.choice([1, 1, 1, 2, 3, 4, None]), rng.choice([at(), at(), at(), None])) for _ in range(400)]
    periods = [(rng.choice([1, 1, 2, 3, None]), at(), at()) for _ in range(40)] + [(1, None, at()), (2, at(), None), (3, dt.date(2023, 1, 1), at()) if kind == "date" else (3, at(), None)]
    s = spark.createDataFrame([(i, *r) for i, r in enumerate(sales)], f"id int, customer_id int, day {kind}")
    p = spark.createDataFrame(periods, f"customer_id int, a {kind}, b {kind}")
    got = in_any_period(s, p, "customer_id", "day", "a", "b", hot_rows=hot_rows)
    assert rows(got, "id", "in_period") == sorted(enumerate(_inside(sales, periods)), key=lambda t: tuple(map(str, t)))
    assert in_any_period(s.limit(0), p, "customer_id", "day", "a", "b").count() == 0
    assert in_any_period(s, p.limit(0), "customer_id", "day", "a", "b").filter("in_period").count() == 0
    plan = _plan(got)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_overlapping_periods_count_once(spark):
    sales = spark.createDataFrame([("A", dt.date(2021, 1, d), 1) for d in (1, 5, 6, 20)], "customer_id string, order_date date, product_id int")
    menu = spark.createDataFrame([(1, "curry", 10)], "product_id int, product_name string, price int")
    spans = [("A", dt.date(2021, 1, 4), dt.date(2021, 1, 10)), ("A", dt.date(2021, 1, 5), dt.date(2021, 1, 6)), ("A", dt.date(2021, 1, 5), dt.date(2021, 1, 5))]
    periods = spark.createDataFrame(spans, "customer_id string, start_date date, end_date date")
    assert rows(diner.points_over_periods(sales, menu, periods, "2021-01-31")) == [("A", 600.0)]


def test_one_period_gives_the_plain_answer(spark):
    sales, menu, members = FX.diner(spark)
    spans = members.select("customer_id", F.col("join_date").alias("start_date"), F.date_add("join_date", 6).alias("end_date"))
    want = rows(diner.points_with_boost(sales, menu, members, "2021-01-31"))
    assert rows(diner.points_over_periods(sales, menu, spans, "2021-01-31")) == want


def _largest_share(df, keep: str) -> float:
    """The largest part of the rows of ``keep`` that one task holds."""
    sizes = [r["count"] for r in df.filter(keep).groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(sizes) / sum(sizes)


def test_hot_member_is_split(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sales = spark.range(60_000, numPartitions=8).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS customer_id", "date_add(DATE'2024-01-01', CAST(id % 300 AS INT)) AS day")
        periods = spark.range(50).selectExpr("0L AS customer_id", "date_add(DATE'2024-01-01', CAST(id * 6 AS INT)) AS a", "date_add(DATE'2024-01-03', CAST(id * 6 AS INT)) AS b")
        got = in_any_period(sales, periods, "customer_id", "day", "a", "b", hot_rows=1000)
        assert _largest_share(got, "customer_id = 0") < 0.3
        assert got.filter("customer_id = 0 AND in_period").count() == sales.filter("customer_id = 0 AND datediff(day, '2024-01-01') % 6 < 3").count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_list_of_hot_keys_is_bounded(spark):
    df = spark.range(1000).selectExpr("id % 10 AS k", "id")
    assert hot_keys(df, ["k"], least=10).count() == 10
    assert hot_keys(df, ["k"], least=10, most=5).count() == 0  # none holds a fifth of the rows
    skewed = df.union(spark.range(1000).selectExpr("3L AS k", "id"))
    assert [r.k for r in hot_keys(skewed, ["k"], least=10, most=5).collect()] == [3]
    assert hot_keys(df.limit(0), ["k"]).count() == 0


# ---------------------------------------------------------------- as-of, backwards
def _last(left, right, inclusive, gap):
    out = []
    for k, t in left:
        seen = [r for r in right if k is not None and t is not None and r[0] == k and r[1] is not None and (r[1] < t or (inclusive and r[1] == t))]
        best = max(seen, key=lambda r: (r[1], r[2]), default=None)
        out.append((k, t, *(best[1:] if best and (gap is None or best[1] >= t - gap) else (None, None))))
    return sorted(out, key=lambda t: tuple(map(str, t)))


@pytest.mark.parametrize("hot_rows", [5, 1_000_000])
@pytest.mark.parametrize("inclusive", [False, True])
@pytest.mark.parametrize("hours", [None, 30])
def test_last_before(spark, hot_rows, inclusive, hours):
    rng = random.Random(hot_rows + 2 * inclusive + (hours or 0))
    at = lambda: rng.choice([None] + [dt.datetime(2024, 1, 1) + dt.timedelta(minutes=30 * rng.randint(0, 400)) for _ in range(9)])
    key = lambda: rng.choice([1, 1, 1, 2, 3, None])
    left = [(key(), at()) for _ in range(250)]
    right = [(key(), at(), i) for i in range(150)]
    a = spark.createDataFrame(left, "k int, ts timestamp_ntz")
    b = spark.createDataFrame(right, "k int, ts timestamp_ntz, v int")
    got = last_before(a, b, "k", "ts", {"ts": "found", "v": "v"}, inclusive=inclusive, longest_gap=None if hours is None else f"{hours} hours", hot_rows=hot_rows)
    assert rows(got) == _last(left, right, inclusive, None if hours is None else dt.timedelta(hours=hours))
    assert last_before(a.limit(0), b, "k", "ts", {"v": "v"}).count() == 0
    assert last_before(a, b.limit(0), "k", "ts", {"v": "v"}).filter("v IS NOT NULL").count() == 0


def test_hot_key_of_the_backward_look_up_is_split(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        both = spark.range(40_000, numPartitions=8).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, id % 700) AS ts")
        got = last_before(both, both, "k", "ts", {"ts": "found"}, hot_rows=1000)
        assert _largest_share(got, "k = 0") < 0.3 and got.count() == 40_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_forward_look_up_with_the_bounded_list(spark):
    a = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 1))], "k int, ts timestamp_ntz")
    b = spark.createDataFrame([(1, dt.datetime(2024, 3, 1)), (1, dt.datetime(2024, 1, 1))], "k int, ts timestamp_ntz")
    assert rows(next_after(a, b, "k", "ts", hot_rows=0), "k", "next_ts") == [(1, dt.datetime(2024, 3, 1)), (2, None)]


# ---------------------------------------------------------------- ranks and places in ranges
@pytest.mark.parametrize("descending", [False, True])
def test_dense_rank_in_ranges(spark, descending):
    rng = random.Random(3)
    data = [(rng.choice(["a", "a", "b", None]), rng.choice([None, *range(40)])) for _ in range(500)]
    df = spark.createDataFrame(data, "k string, v int")
    df.createOrReplaceTempView("ranked_rows")
    want = spark.sql(f"SELECT k, v, CAST(dense_rank() OVER (PARTITION BY k ORDER BY v {'DESC' if descending else 'ASC'}) AS BIGINT) AS rnk FROM ranked_rows")
    assert rows(dense_rank_in_ranges(df.repartition(7), "k", "v", descending=descending)) == rows(want)
    assert dense_rank_in_ranges(df.limit(0), "k", "v").count() == 0


def test_hot_rank_uses_many_tasks(spark):
    df = spark.range(40_000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "hash(id) AS v")
    ranked = dense_rank_in_ranges(df, "k", "v")
    assert ranked.filter("k = 0").agg(F.max("rnk")).first()[0] == df.filter("k = 0").select("v").distinct().count()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert _largest_share(dense_rank_in_ranges(df, "k", "v"), "k = 0") < 0.7
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_position(spark):
    df = spark.range(5000).selectExpr("id", "hash(id) % 100 AS v").repartition(5)
    got = with_position(df, [F.col("v").desc(), F.col("id")]).collect()
    want = sorted(((r.id, r.v) for r in df.collect()), key=lambda t: (-t[1], t[0]))
    assert [(r.id, r.v) for r in sorted(got, key=lambda r: r.position)] == want
    assert sorted(r.position for r in got) == list(range(1, 5001))
    assert with_position(df.limit(0), [F.col("v")]).count() == 0


# ---------------------------------------------------------------- checks
def test_checked_write(spark, tmp_path):
    df = spark.createDataFrame([(1, 5), (2, None), (9, 4), (9, 0), (None, 7)], "rating int, other int")
    rules = {"rating": F.col("rating").between(1, 5), "other": F.col("other") > 3}
    got = write_checked(df, rules, str(tmp_path / "t"))
    assert got.rows == 5 and got.failed == {"rating": 2, "other": 1}  # unknown passes
    assert rows(got.valid) == [(1, 5), (2, None), (None, 7)]
    assert rows(got.rejected, "rating", "other") == [(9, 0), (9, 4)]
    assert sorted(tuple(r.failed_rules) for r in got.rejected.collect()) == [("rating",), ("rating", "other")]
    empty = write_checked(df.limit(0), rules, str(tmp_path / "e"))
    assert (empty.rows, empty.failed, empty.valid.count(), empty.rejected.count()) == (0, {"rating": 0, "other": 0}, 0, 0)


# ---------------------------------------------------------------- outer apply
def test_best_paid_extras(spark):
    orders = spark.createDataFrame([(1,), (2,), (3,)], "order_id long")
    extras = spark.createDataFrame(
        [(1, 1, "a", 5), (1, 2, "b", 9), (1, 3, "c", 5), (1, 4, "d", 7), (3, 1, "x", 1), (3, 1, "x", 1), (8, 1, "z", 1)],
        "order_id long, pos int, item string, price int",
    ).withColumn("price", F.col("price").cast("decimal(12,2)"))
    got = D.best_paid_extras(orders, extras)
    assert rows(got) == [(1, "b, d, a", 21.0), (2, None, None), (3, "x, x", 2.0)]
    plan = _plan(got)
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert rows(D.best_paid_extras(orders, extras.limit(0))) == [(i, None, None) for i in (1, 2, 3)]
    assert D.best_paid_extras(orders.limit(0), extras).count() == 0


# ---------------------------------------------------------------- distinct counts that add up
def test_distinct_counts_add_up(spark):
    df = spark.range(20_000).selectExpr("date_add(DATE'2024-01-01', CAST(id % 45 AS INT)) AS day", "IF(id % 11 = 0, NULL, (id * id) % 90001) AS who")
    starts = {"day": F.col("day"), "month": F.to_date(F.date_trunc("month", "day"))}
    want = []
    for kind, start in starts.items():
        want += [(kind, r.s, r.n) for r in df.groupBy(start.alias("s")).agg(F.countDistinct("who").alias("n")).collect()]
    want = sorted(want, key=lambda t: tuple(map(str, t)))
    assert rows(distinct_in_periods(day_bitmaps(df, "day", "who"), starts)) == want
    parts = day_bitmaps(df.filter("coalesce(who, 0) % 2 = 0"), "day", "who").unionByName(day_bitmaps(df.filter("coalesce(who, 0) % 2 = 1"), "day", "who"))
    assert rows(distinct_in_periods(parts, starts)) == want
    assert distinct_in_periods(day_bitmaps(df.limit(0), "day", "who"), starts).count() == 0


def test_periods_read_the_orders_once(spark):
    from tavola.sources.testdata import load_tables

    bitmaps = day_bitmaps(load_tables(spark, SF).orders, "o_orderdate", "o_custkey")
    plan = _plan(bitmaps)
    assert plan.count("FileScan") == 1 and "partial_bitmap_construct_agg" in plan
