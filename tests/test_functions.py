"""Column functions: dialect-sensitive time rules, units, sentinels, exact rounding."""

import datetime as dt

from pyspark.sql import functions as F

from tavola.functions import (
    csv_items,
    csv_part,
    minutes_between,
    monday_week_of_year,
    nullify_sentinels,
    round_ratio,
    strip_units,
    weekday_name,
)


def test_minutes_boundary_vs_elapsed(spark):
    df = spark.createDataFrame(
        [
            (dt.datetime(2020, 1, 4, 13, 23, 46), dt.datetime(2020, 1, 4, 13, 53, 3)),
            (dt.datetime(2020, 1, 9, 23, 54, 33), dt.datetime(2020, 1, 10, 0, 15, 2)),
            (dt.datetime(2020, 1, 11, 18, 34, 49), dt.datetime(2020, 1, 11, 18, 50, 20)),
            (dt.datetime(2020, 1, 1, 0, 0, 30), dt.datetime(2019, 12, 31, 23, 58, 50)),
        ],
        "a timestamp_ntz, b timestamp_ntz",
    )
    out = df.select(minutes_between("a", "b").alias("m"), minutes_between("a", "b", "elapsed").alias("e")).collect()
    assert [(r.m, r.e) for r in out] == [(30, 29), (21, 20), (16, 15), (-2, -1)]


def test_minutes_ignore_session_time_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(dt.datetime(2021, 3, 14, 1, 30), dt.datetime(2021, 3, 14, 3, 30))], "a timestamp_ntz, b timestamp_ntz")
        assert df.select(minutes_between("a", "b").alias("m")).first().m == 120
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_monday_weeks_jan1_in_week1(spark):
    days = [dt.date(2021, 1, 1), dt.date(2021, 1, 3), dt.date(2021, 1, 4), dt.date(2021, 1, 8), dt.date(2021, 1, 15)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r.w for r in df.select(monday_week_of_year("d").alias("w")).collect()] == [1, 1, 2, 2, 3]
    # a year starting on each weekday: Jan 1 is always week 1
    jan1 = spark.createDataFrame([(dt.date(y, 1, 1),) for y in range(1995, 2002)], "d date")
    assert {r.w for r in jan1.select(monday_week_of_year("d").alias("w")).collect()} == {1}


def test_weekday_name(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1),)], "d date")
    assert df.select(weekday_name("d").alias("n")).first().n == "Wednesday"


def test_strip_units_and_sentinels(spark):
    vals = ["20km", "23.4 km", "23.4", "32 minutes", "20 mins", "15 minute", "25mins", "10minutes", "40", "null", "abc"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    km = [r.x for r in df.select(strip_units("v", ["km"]).alias("x")).collect()]
    assert km[:3] == ["20", "23.4", "23.4"]
    mins = [r.x for r in df.select(strip_units("v", ["minutes", "mins", "minute"]).alias("x")).collect()]
    assert mins[3:9] == ["32", "20", "15", "25", "10", "40"] and mins[10] == "abc"
    s = spark.createDataFrame([("",), ("  ",), ("null",), ("NULL",), (None,), ("1, 5",)], "v string")
    assert [r.x for r in s.select(nullify_sentinels("v").alias("x")).collect()] == [None] * 5 + ["1, 5"]
    p = spark.createDataFrame([("Brand#13",)], "v string")
    assert p.select(strip_units("v", ["Brand#"], "prefix").alias("x")).first().x == "13"


def test_lists(spark):
    df = spark.createDataFrame([("1, 5",), ("2, x, 6",), (None,)], "v string")
    out = df.select(csv_items("v", ",", "int").alias("a"), csv_part("v", 2, ",", "int").alias("b")).collect()
    assert [r.a for r in out] == [[1, 5], [2, None, 6], None]
    assert [r.b for r in out] == [5, None, None]


def test_round_ratio_exact_half_away_from_zero(spark):
    df = spark.createDataFrame([(47, 8), (3133, 200), (-3133, 200), (1, 3), (5, 0), (1, -8)], "n long, d long")
    out = [r.x for r in df.select(round_ratio("n", "d", 2).alias("x")).collect()]
    assert out == [5.88, 15.67, -15.67, 0.33, None, -0.13]
    # beyond 64-bit-safe magnitudes the decimal path gives the same exact rounding
    big = spark.createDataFrame([("123456789012345678901234565", "1000")], "n string, d string").select(
        F.col("n").cast("decimal(38,0)").alias("n"), F.col("d").cast("decimal(38,0)").alias("d")
    )
    assert big.select(round_ratio("n", "d", 0).alias("x")).first().x == float(123456789012345678901235)


def test_minutes_match_python_definition_on_random_instants(spark):
    import random

    rnd = random.Random(3)
    base = dt.datetime(1999, 12, 31, 23, 0, 0)
    pairs = []
    for _ in range(3000):
        a = base + dt.timedelta(microseconds=rnd.randint(-10**11, 10**11))
        b = a + dt.timedelta(microseconds=rnd.randint(-10**10, 10**10))
        pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    got = df.select("a", "b", minutes_between("a", "b").alias("m"), minutes_between("a", "b", "elapsed").alias("e"))

    def floor_minute(t):
        return (t - dt.datetime(1970, 1, 1)) // dt.timedelta(minutes=1)

    def elapsed(a, b):
        us = (b - a) // dt.timedelta(microseconds=1)
        return int(us / 60_000_000) if us >= 0 else -int(-us / 60_000_000)

    for r in got.collect():
        assert r.m == floor_minute(r.b) - floor_minute(r.a)
        assert r.e == elapsed(r.a, r.b)


def test_monday_weeks_match_python_definition(spark):
    days = [dt.date(1995, 1, 1) + dt.timedelta(days=i) for i in range(0, 365 * 36)]
    df = spark.createDataFrame([(d,) for d in days], "d date")

    def week(d):
        jan1 = dt.date(d.year, 1, 1)
        return (d.timetuple().tm_yday + jan1.weekday() - 1) // 7 + 1

    got = {r.d: r.w for r in df.select("d", monday_week_of_year("d").alias("w")).collect()}
    assert all(got[d] == week(d) for d in days)
    # weeks start on Monday: the week number changes exactly on Mondays (and on Jan 1)
    assert all(
        (got[d] != got[d - dt.timedelta(days=1)]) == (d.weekday() == 0 or (d.month, d.day) == (1, 1))
        for d in days[1:]
    )
