"""Golden values of the ingredient answers on the reference rows."""

import fixtures as FX
import pytest
from pyspark.sql import functions as F

from tavola.plans import ingredients as I
from tavola.plans.pipeline import clean


@pytest.fixture(scope="module")
def c(spark):
    return clean(FX.delivery_raw(spark))


def test_i01_standard(c):
    out = {r.pizza_id: r.toppings for r in I.standard_ingredients(c.recipe_named).collect()}
    assert out[1] == "Bacon,BBQ Sauce,Beef,Cheese,Chicken,Mushrooms,Pepperoni,Salami"
    assert out[2] == "Cheese,Mushrooms,Onions,Peppers,Tomatoes,Tomato Sauce"


def test_i02_i03_top_modifiers(c):
    assert [tuple(r) for r in I.top_modifier(c.customer_orders, "extras", c.toppings).collect()] == [("Bacon", 4)]
    assert [tuple(r) for r in I.top_modifier(c.customer_orders, "exclusions", c.toppings).collect()] == [("Cheese", 4)]


def test_i04_order_label(c):
    out = {r.record_id: r.order_details for r in I.order_label(c.customer_orders, c.exclusions, c.extras).collect()}
    assert out[1] == "Meat Lovers" and out[4] == "Vegetarian Lovers"
    assert out[5] == "Meat Lovers with exclude Cheese" and out[7] == "Vegetarian Lovers with exclude Cheese"
    assert out[8] == "Meat Lovers with extras Bacon" and out[10] == "Vegetarian Lovers with extras Bacon"
    assert out[12] == "Meat Lovers with exclude Cheese and extras Bacon, Chicken"
    assert out[14] == "Meat Lovers with exclude BBQ Sauce, Mushrooms and extras Bacon, Cheese"


def test_i04_unknown_modification(spark):
    rows = [(1, 101, 1, "99", None, "2020-01-01 18:05:02"), (2, 101, 3, None, None, "2020-01-01 18:05:02")]
    c2 = clean(FX.delivery_raw(spark, customer_orders=rows))
    out = {r.record_id: r.order_details for r in I.order_label(c2.customer_orders, c2.exclusions, c2.extras).collect()}
    assert out == {1: "Unknown modification", 2: "No modifications"}


def test_i05_ingredient_list(c):
    out = {r.record_id: r.list_order for r in I.ingredient_list(c.qty, c.records).collect()}
    assert out[8] == "Meatlovers: 2xBacon, BBQ Sauce, Beef, Cheese, Chicken, Mushrooms, Pepperoni, Salami"
    assert out[12] == "Meatlovers: 2xBacon, BBQ Sauce, Beef, 2xChicken, Mushrooms, Pepperoni, Salami"
    assert out[14] == "Meatlovers: 2xBacon, Beef, 2xCheese, Chicken, Pepperoni, Salami"


def test_i06_totals(c):
    allp = [tuple(r) for r in I.ingredient_totals(c.qty).collect()]
    assert dict(allp) == {
        "Bacon": 14, "Mushrooms": 13, "Cheese": 11, "Chicken": 11, "Beef": 10, "Pepperoni": 10,
        "Salami": 10, "BBQ Sauce": 9, "Onions": 4, "Peppers": 4, "Tomatoes": 4, "Tomato Sauce": 4,
    }
    assert sum(n for _, n in allp) == 104
    half = dict(tuple(r) for r in I.ingredient_totals(c.qty, divisor=2).collect())
    assert half["Bacon"] == 7 and half["BBQ Sauce"] == 4 and half["Onions"] == 2
    dl = dict(tuple(r) for r in I.ingredient_totals(c.qty, c.records, delivered_only=True).collect())
    assert dl["Bacon"] == 12 and dl["Tomato Sauce"] == 3 and dl["Beef"] == 9


def test_exclusion_removes_extra_of_same_item(spark):
    rows = [(1, 101, 1, "1", "1, 1", "2020-01-01 18:05:02")]
    c2 = clean(FX.delivery_raw(spark, customer_orders=rows))
    out = {r.item: r.qty for r in c2.qty.collect()}
    assert "Bacon" not in out and out["Beef"] == 1
    assert c2.qty.filter(F.col("qty") > 1).count() == 0
