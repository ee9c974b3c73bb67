"""One answer at every size: both sides of each size switch give the same rows."""

import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tavola.functions.numeric import round_ratio
from tavola.operators.joins import lookup_names, unique_on
from tavola.session import _one_machine, ensure_checkpoint_dir


def half_away(n, d, digits):
    q = Fraction(abs(n), abs(d)) * 10**digits
    units = (2 * q + 1).numerator // (2 * (2 * q + 1).denominator)
    return (-1 if (n < 0) != (d < 0) else 1) * units / 10**digits


def test_round_ratio_is_exact_beyond_64_bit_steps(spark):
    rng = random.Random(0)
    rows = [(29352350974500000, 904401509000000)]
    for _ in range(300):
        d = rng.randint(10**12, 10**15)
        units = rng.randint(0, 10**4)
        near = (2 * units + 1) * d // 200  # just around a half of the last digit
        rows += [(near + rng.randint(-2, 2), d), (-(near + rng.randint(-2, 2)), d), (rng.randint(1, 10**6), rng.randint(1, 10**4))]
    df = spark.createDataFrame(rows, "n long, d long")
    got = df.select("n", "d", round_ratio("n", "d", 2).alias("r")).collect()
    assert all(r.r == half_away(r.n, r.d, 2) for r in got)
    small = [(n, d) for n, d in rows if abs(n) < 10**9]
    big = spark.createDataFrame([(n * 10**9, d * 10**9) for n, d in small], "n long, d long")
    assert [r[0] for r in big.select(round_ratio("n", "d", 2)).collect()] == [half_away(n, d, 2) for n, d in small]


@pytest.mark.parametrize("key", [None, ["k"]])
def test_lookup_names_has_one_semantics(spark, key):
    dim = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (None, "z")], "id int, name string")
    rows = [(7, 1, 2), (7, 1, 2), (7, 2, None), (8, 3, 1), (None, 2, 2)]
    df = spark.createDataFrame(rows, "k int, x int, y int")
    small = lookup_names(df, ["x", "y"], dim, "id", "name", key=key)
    large = lookup_names(df, ["x", "y"], dim, "id", "name", key=key, max_broadcast_bytes=0)
    names = {1: "a", 2: "c"}
    want = Counter((*r, names.get(r[1]), names.get(r[2])) for r in rows)
    columns = ["k", "x", "y", "x_name", "y_name"]
    assert Counter(tuple(r) for r in small.select(columns).collect()) == want
    assert Counter(tuple(r) for r in large.select(columns).collect()) == want


def test_unique_on_takes_values_of_one_row(spark):
    dim = spark.createDataFrame([(1, "a", 9), (1, "b", 2)], "k int, x string, y int")
    assert [tuple(r) for r in unique_on(dim, ["k"], ["x", "y"]).collect()] == [(1, "a", 9)]


def test_no_machine_local_folder_on_a_cluster():
    assert _one_machine("local") and _one_machine("local[8]")
    assert not _one_machine("local-cluster[2,1,1024]") and not _one_machine("yarn")

    class Session:
        class sparkContext:
            master = "yarn"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_all_first_signups_are_members(spark):
    from tavola.sources import adapters, load_tables

    t = load_tables(spark, "/root/testdata/sf0.001")
    users = t.events.filter(F.col("event_type") == "signup").select("user_id").distinct().count()
    assert adapters.members(t).count() == users
