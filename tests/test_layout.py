"""Bucketed order tables join and aggregate per order without a shuffle."""

from pyspark.sql import functions as F

from tavola.sources.layout import bucketed_order_tables
from tavola.sources.testdata import load_tables


def test_bucketed_join_has_no_exchange(spark):
    t = load_tables(spark, "/root/testdata/sf0.001")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        li, od = bucketed_order_tables(spark, t.lineitem, t.orders, buckets=4, prefix="layout_test_")
        joined = li.join(od, li.l_orderkey == od.o_orderkey).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan, plan
        assert joined.agg(F.sum("n")).first()[0] == t.lineitem.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))


def test_profit_over_the_order_layout_shuffles_no_order(spark):
    from tavola.plans.registry import QUERIES

    plan = QUERIES["E05_profit_bucketed"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "hashpartitioning(l_orderkey" not in plan and "hashpartitioning(o_orderkey" not in plan
