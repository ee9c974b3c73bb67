"""Answers over text lists that need no record id: the same as with one."""

import fixtures as FX
import pytest
from frames import rows

from tavola.plans import delivery as D
from tavola.plans import ingredients as I
from tavola.plans import raw_feed
from tavola.plans.pipeline import clean
from tavola.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def c(spark):
    return clean(FX.delivery_raw(spark))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_labels_from_texts_equal_labels_by_record(spark, c):
    keys = ["record_id", "order_details"]
    want = rows(I.order_label(c.customer_orders, c.exclusions, c.extras).select(*keys))
    assert rows(I.order_label_of_texts(c.customer_orders, c.toppings).select(*keys)) == want
    extra = [(1, 101, 1, "99", None, "2020-01-01 18:05:02"), (2, 101, 3, None, None, "2020-01-01 18:05:02"), (3, 101, 1, "2, 2", "x, 1", "2020-01-01 18:05:02")]
    c2 = clean(FX.delivery_raw(spark, customer_orders=extra * 2))
    want = rows(I.order_label(c2.customer_orders, c2.exclusions, c2.extras).select(*keys))
    assert rows(I.order_label_of_texts(c2.customer_orders, c2.toppings).select(*keys)) == want
    assert I.order_label_of_texts(c.customer_orders.limit(0), c.toppings).count() == 0


def test_revenue_by_order_equals_revenue_by_record(spark, c):
    co = c.customer_orders
    extras = D.modifier_rows(co, "extras", c.toppings, ["order_id"])
    prices = {"Meatlovers": 12, "Vegetarian": 10}
    got = D.revenue_per_extra_by_order(co, prices, 10, extras, "Cheese", c.runner_orders)
    assert rows(got) == rows(D.revenue_per_extra(co, prices, 10, c.extras, "Cheese")) == [(143,)]
    none = D.revenue_per_extra_by_order(co.limit(0), prices, 10, extras.limit(0), "Cheese", c.runner_orders)
    assert rows(none) == [(None,)]


@pytest.mark.parametrize("name", ["I02_top_extra_lists", "I03_top_exclusion_lists", "C12_four_name_columns", "I04_order_label_lists", "E02_revenue_per_extra", "C18_drop_blank_tokens"])
def test_no_ids_are_made(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    assert "record_seq" not in plan


def test_blank_tokens_go(spark):
    from tavola.sources.testdata import load_tables

    t = load_tables(spark, SF)
    got = raw_feed.listed_toppings(spark, SF)
    assert got.filter("topping IS NULL OR trim(topping) = ''").count() == 0
    # every list was given a blank token, so dropping them drops at least a row a pizza
    split = D.adjusted_rows(raw_feed.pizza_feed(t, numbered=False).selectExpr("order_id", "line", "pizza_name", "concat_ws(',', exclusions, ' ', extras) AS adjust_full_recipe"), ["order_id", "line"])
    assert split.count() - got.count() >= t.lineitem.count()


def test_orders_total_reads_the_lines_alone(spark):
    plan = _plan(QUERIES["A01_ordered_total"](spark, SF))
    assert plan.count("FileScan") == 1 and "Join" not in plan


@pytest.mark.parametrize("name", ["D05_favourite_items", "D07_last_before_join"])
def test_the_base_is_computed_once(spark, name):
    """The plan reads the written base and no table."""
    plan = _plan(QUERIES[name](spark, SF))
    assert "FileScan" not in plan and "Scan ExistingRDD" in plan
