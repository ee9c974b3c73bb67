"""Plan shape of every registered query: distributed, JVM-side, no pair explosion."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tavola.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_plan_shape(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "EvalPython" not in plan and "PythonUDF" not in plan and "FlatMapGroupsInPandas" not in plan
    # every window is partitioned by a key (no single-task global ordering)
    assert not re.search(r"Window \[.*\], \[\], \[", plan), plan


def test_scan_prunes_columns(spark):
    plan = _plan(E.queries()["D01_total_spend"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem and all(s.count(":") == 2 for s in lineitem)  # l_orderkey, l_partkey only


def test_filter_pushed_to_scan(spark):
    plan = _plan(E.queries()["D02_visit_days"](spark, SF))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in plan


def test_rank_answers_aggregate_before_ranking(spark):
    # dense rank is taken over distinct (customer, member, day) rows, then joined back
    plan = _plan(E.queries()["D12_member_rank"](spark, SF))
    assert "HashAggregate" in plan and "Window" in plan


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["customer_id", "order_date", "product_name", "price", "member", "rnk"]


def test_broadcast_only_under_size_bound(spark):
    from pyspark.sql import functions as F

    from tavola.operators import broadcast_if_small, estimated_bytes
    from tavola.sources.testdata import load_tables

    part = load_tables(spark, SF).part.select("p_partkey", "p_type")
    size = estimated_bytes(part)
    assert size is not None and size > 0
    fact = load_tables(spark, SF).lineitem.select("l_partkey")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hinted = fact.join(broadcast_if_small(part, max_bytes=size), F.col("l_partkey") == F.col("p_partkey"))
        declined = fact.join(broadcast_if_small(part, max_bytes=size - 1), F.col("l_partkey") == F.col("p_partkey"))
        assert "BroadcastHashJoin" in _plan(hinted)
        assert "BroadcastHashJoin" not in _plan(declined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))


def test_hot_key_tables_broadcast_without_auto_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ["B02_signup_to_purchase"]:
            plan = _plan(E.queries()[name](spark, SF))
            # the bounded hot-key table joins by broadcast; no shuffle join against it
            assert "BroadcastHashJoin" in plan, name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))


def test_session_cap_turns_size_based_broadcasts_off(spark):
    from tavola.operators import broadcast_if_small
    from tavola.sources.testdata import load_tables

    part = load_tables(spark, SF).part.select("p_partkey", "p_type")
    spark.conf.set("tavola.broadcast.maxBytes", "0")
    try:
        assert "ResolvedHint" not in part.explain.__self__._jdf.queryExecution().analyzed().toString()
        assert broadcast_if_small(part)._jdf.queryExecution().analyzed().toString().count("broadcast") == 0
    finally:
        spark.conf.unset("tavola.broadcast.maxBytes")
    assert "broadcast" in broadcast_if_small(part)._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize(
    "name", ["C03_enrich_cancellation", "A04_delivered_by_type", "A06_max_in_order", "A07_changes_by_customer", "A08_both_changes",
             "B02_avg_pickup", "B02_avg_pickup_per_order", "B03_prep_by_size", "B04_avg_distance", "C20_delivery_report",
             "E04_delivery_report", "E01_revenue", "E02_revenue_with_extras", "E05_profit"],
)
def test_delivery_answers_read_each_table_once(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey") and len([x for x in plan.splitlines() if "Relation" in x and "l_orderkey" in x]) == 1
    assert len([x for x in plan.splitlines() if "Relation" in x and "o_orderkey" in x]) == 1


def test_hot_keys_are_split_when_both_sides_are_large(spark):
    """One key holds nine tenths of the rows and nothing is broadcast: the final plan's join
    still splits the hot partition."""
    from tavola.operators import enrich, keep_max_ties, rows_at_extreme
    from tavola.plans import diner

    settings = {
        "tavola.broadcast.maxBytes": "0", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        key = "CASE WHEN id % 10 > 0 THEN 0 ELSE id END AS customer_id"
        sales = spark.range(200_000, numPartitions=16).selectExpr(
            key, "date_add(DATE'2024-01-01', CAST(hash(id) % 300 AS INT)) AS order_date", "id % 7 AS product_id"
        )
        menu = spark.range(7).selectExpr("id AS product_id", "'item' || id AS product_name", "CAST(id AS DECIMAL(12,2)) AS price")
        members = sales.groupBy("customer_id").agg(F.min("order_date").alias("join_date"))
        dim = sales.select("customer_id", F.col("product_id").alias("v"))
        for df in (
            rows_at_extreme(sales, "customer_id", "order_date"),
            keep_max_ties(sales, "order_date", "customer_id"),
            enrich(sales, dim, "customer_id", ["v"], dedupe=True),
            diner._with_members(sales, menu, members),
        ):
            out = df.withColumn("x", F.xxhash64(*df.columns)).agg(F.sum(F.col("x") % 1000))
            out.collect()
            assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
