"""Skew-safe operators equal their brute-force definitions on random data with a hot key."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tavola.operators import adjust, dense_rank_of, keep_max_ties, next_after, with_record_seq


def _data(seed, n=400, hot_share=0.34):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = 0 if rnd.random() < hot_share else rnd.randint(1, 12)  # key 0 holds a third of rows
        rows.append((k, rnd.randint(0, 5), rnd.choice("abcde"), rnd.randint(0, 3)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_record_seq_dense_unique_with_hot_key(spark, seed):
    df = spark.createDataFrame(_data(seed), "k int, a int, b string, c int")
    out = with_record_seq(df, ["k"]).collect()
    assert len(out) == df.count()
    per_key = defaultdict(list)
    for r in out:
        per_key[r.k].append(r.record_seq)
    for k, seqs in per_key.items():
        assert sorted(seqs) == list(range(1, len(seqs) + 1)), k
    # rows are preserved exactly
    assert Counter((r.k, r.a, r.b, r.c) for r in out) == Counter(_data(seed))


@pytest.mark.parametrize("seed", [4, 5])
def test_next_after_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    ev = lambda: base + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 5))
    left = [(0 if rnd.random() < 0.4 else rnd.randint(1, 6), ev()) for _ in range(150)]
    right = [(0 if rnd.random() < 0.4 else rnd.randint(1, 6), ev()) for _ in range(150)]
    right += [(k, t) for k, t in left[:10]]  # equal instants must not count as "after"
    L = spark.createDataFrame(left, "k int, ts timestamp_ntz")
    R = spark.createDataFrame(right, "k int, ts timestamp_ntz")
    want = Counter()
    for k, t in left:
        later = [u for kk, u in right if kk == k and u > t]
        want[(k, t, min(later) if later else None)] += 1
    got = Counter((r.k, r.ts, r.next_ts) for r in next_after(L, R, "k", "ts").collect())
    assert got == want
    # key 0 treated as hot: finer buckets for it, same answer
    hot = Counter((r.k, r.ts, r.next_ts) for r in next_after(L, R, "k", "ts", hot_rows=50, hot_bucket="hour").collect())
    assert hot == want


@pytest.mark.parametrize("seed", [6, 7])
def test_dense_rank_and_ties_equal_windows(spark, seed):
    df = spark.createDataFrame(_data(seed), "k int, a int, b string, c int")
    w = Window.partitionBy("k").orderBy("a")
    want = sorted(tuple(r) for r in df.withColumn("rnk", F.dense_rank().over(w)).collect())
    got = sorted(tuple(r) for r in dense_rank_of(df, "k", "a").select(*df.columns, "rnk").collect())
    assert got == want
    counts = df.groupBy("k", "b").agg(F.count(F.lit(1)).alias("n"))
    wm = Window.partitionBy("k")
    want_t = sorted(tuple(r) for r in counts.withColumn("m", F.max("n").over(wm)).filter("n = m").drop("m").collect())
    assert sorted(tuple(r) for r in keep_max_ties(counts, "n", "k").collect()) == want_t


@pytest.mark.parametrize("seed", [8, 9])
def test_adjust_equals_python_multiset(spark, seed):
    rnd = random.Random(seed)
    items = "ABCDEF"
    std = [(rnd.randint(0, 5), rnd.choice(items)) for _ in range(40)]
    ext = [(rnd.randint(0, 5), rnd.choice(items)) for _ in range(20)]
    exc = [(rnd.randint(0, 5), rnd.choice(items)) for _ in range(10)]
    mk = lambda rows: spark.createDataFrame(rows, "r int, item string")
    got = {(r.r, r.item): r.qty for r in adjust(mk(std), mk(ext), mk(exc), "r").collect()}
    want = Counter(std) + Counter(ext)
    for pair in set(exc):
        want.pop(pair, None)
    assert got == dict(want)


def test_record_seq_does_not_depend_on_the_layout(spark, monkeypatch):
    from tavola.operators import record_id

    rows_ = [(0, 1, "x", 1)] * 300 + _data(11, n=100) + [(None, 2, None, 1)] * 3  # one row copied 300 times in key 0
    df = spark.createDataFrame(rows_, "k int, a int, b string, c int")
    want = Counter()
    for k in {r[0] for r in rows_}:
        own = sorted((r for r in rows_ if r[0] == k), key=lambda r: tuple((v is not None, v) for v in r[1:]))
        want.update((*r, n) for n, r in enumerate(own, 1))
    for parts, chunk in ((1, 100_000), (6, 100_000), (8, 7)):
        monkeypatch.setattr(record_id, "COPIES_AT_ONCE", chunk)
        got = with_record_seq(df.repartition(parts), ["k"]).collect()
        assert Counter(tuple(r) for r in got) == want


def test_next_after_with_many_copies_of_one_instant(spark):
    t0 = dt.datetime(2024, 1, 2, 10, 0, 0)
    left = [(0, t0)] * 200 + [(1, t0)]
    right = [(0, t0), (0, t0 + dt.timedelta(seconds=1)), (1, t0 - dt.timedelta(days=1))]
    L = spark.createDataFrame(left, "k int, ts timestamp_ntz")
    R = spark.createDataFrame(right, "k int, ts timestamp_ntz")
    got = Counter((r.k, r.next_ts) for r in next_after(L, R, "k", "ts", hot_rows=10).collect())
    assert got == Counter({(0, t0 + dt.timedelta(seconds=1)): 200, (1, None): 1})
