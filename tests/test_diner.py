"""Golden values of the diner answers on the reference rows."""

import datetime as dt

import fixtures as FX
from frames import rows

from tavola.plans import diner


def test_d01_total_spend(spark):
    s, m, _ = FX.diner(spark)
    assert rows(diner.total_spend(s, m)) == [("A", 76.0), ("B", 74.0), ("C", 36.0)]


def test_d02_visit_days(spark):
    s, _, _ = FX.diner(spark)
    assert rows(diner.visit_days(s)) == [("A", 4), ("B", 6), ("C", 2)]


def test_d03_first_items_both_forms(spark):
    s, m, _ = FX.diner(spark)
    want = sorted([("A", "sushi"), ("A", "curry"), ("B", "curry"), ("C", "ramen"), ("C", "ramen")])
    assert rows(diner.first_items(s, m)) == want
    assert rows(diner.first_items_any(s, m)) == want


def test_d04_top_item(spark):
    s, m, _ = FX.diner(spark)
    assert rows(diner.top_item(s, m)) == [("ramen", 8)]


def test_d05_favourites_keep_ties(spark):
    s, m, _ = FX.diner(spark)
    assert rows(diner.favourite_items(s, m)) == sorted(
        [("A", "ramen"), ("B", "curry"), ("B", "sushi"), ("B", "ramen"), ("C", "ramen")]
    )


def test_d06_first_after_join(spark):
    assert rows(diner.first_after_join(*FX.diner(spark))) == [("A", "curry"), ("B", "sushi")]


def test_d07_last_before_join(spark):
    assert rows(diner.last_before_join(*FX.diner(spark))) == sorted([("A", "sushi"), ("A", "curry"), ("B", "sushi")])


def test_d08_spend_before_join(spark):
    assert rows(diner.spend_before_join(*FX.diner(spark))) == [("A", 2, 25.0), ("B", 3, 40.0)]


def test_d09_points(spark):
    s, m, _ = FX.diner(spark)
    assert rows(diner.points(s, m)) == [("A", 860.0), ("B", 940.0), ("C", 360.0)]


def test_d10_points_with_boost(spark):
    assert rows(diner.points_with_boost(*FX.diner(spark), until="2021-01-31")) == [("A", 1370.0), ("B", 820.0)]


def test_d11_member_flag(spark):
    out = diner.member_flag(*FX.diner(spark)).collect()
    assert len(out) == 15
    ys = [r.customer_id for r in out if r.member == "Y"]
    assert sorted(ys) == ["A"] * 4 + ["B"] * 3
    assert sum(r.member == "N" for r in out) == 8


def test_d12_member_rank(spark):
    out = diner.member_rank(*FX.diner(spark)).collect()
    a = sorted((r.order_date, r.rnk) for r in out if r.customer_id == "A" and r.member == "Y")
    assert [x[1] for x in a] == [1, 2, 3, 3] and a[0][0] == dt.date(2021, 1, 7)
    b = sorted((r.order_date, r.rnk) for r in out if r.customer_id == "B" and r.member == "Y")
    assert [x[1] for x in b] == [1, 2, 3] and b[0][0] == dt.date(2021, 1, 11)
    assert sum(r.rnk is None for r in out) == 8


def test_edge_tie_on_first_day_after_join_is_deterministic(spark):
    sales = spark.createDataFrame(
        [("A", dt.date(2021, 1, 7), 2), ("A", dt.date(2021, 1, 7), 1)], "customer_id string, order_date date, product_id int"
    )
    _, m, mem = FX.diner(spark)
    assert rows(diner.first_after_join(sales, m, mem)) == [("A", "curry")]


def test_edge_unknown_product_drops_out(spark):
    s, m, _ = FX.diner(spark)
    extra = spark.createDataFrame([("A", dt.date(2021, 1, 1), 99)], s.schema)
    assert rows(diner.total_spend(s.unionByName(extra), m)) == [("A", 76.0), ("B", 74.0), ("C", 36.0)]


def test_invariant_under_repartition(spark):
    s, m, mem = FX.diner(spark)
    a = rows(diner.member_rank(s, m, mem))
    b = rows(diner.member_rank(s.repartition(5, "order_date"), m, mem))
    assert a == b
