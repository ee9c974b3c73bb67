"""Permutation index: recall against brute force, exact scores and order, edge rows."""

import math

import numpy as np
from pyspark.sql import functions as F

from tavola.llm import permutation_index as index


def exact(ids, x, q, nearest):
    scores = x @ x[q]
    order = [k for k in np.lexsort((ids, -scores)) if ids[k] != ids[q]]
    return [(int(ids[k]), float(scores[k])) for k in order[:nearest]]


def test_recall_and_order(spark, monkeypatch):
    monkeypatch.setattr(index, "SHARD_ROWS", 700)
    monkeypatch.setattr(index, "RERANK_LEAST", 50)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 32))
    x[100:160] = x[100]  # copies of one vector
    ids = np.arange(2000)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    got = {}
    for r in index.search(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert len(got) == 100
    found = 0
    for q, rows in got.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 21)) and q not in [r[1] for r in rows]
        assert rows == sorted(rows, key=lambda r: (-r[2], r[1]))
        want = exact(ids, x, q, 20)
        found += len({r[1] for r in rows} & {w[0] for w in want})
        assert all(math.isclose(s, float(x[v] @ x[q]), rel_tol=1e-12, abs_tol=1e-12) for _, v, s in rows)
    assert found / 2000 >= 0.9
    assert [r[1] for r in got[100]] == list(range(101, 121))


def test_few_rows_and_rows_that_take_no_part(spark):
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [0.5, 0.5], 2), (2, [1.0, 0.0], 3), (3, None, 4), (4, [0.0, 0.0], 5),
        (5, [None, 1.0], 6), (6, [float("nan"), 1.0], 7), (7, [float("inf"), 1.0], 8), (8, [1.0], 9), (None, [1.0, 1.0], 10), (20, [-1.0, 0.0], 11),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cid int")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in index.search(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 2, 1.0), (0, 2, 1, 0.5), (0, 3, 20, -1.0), (20, 1, 1, -0.5), (20, 2, 0, -1.0), (20, 3, 2, -1.0)]
    assert index.search(df.limit(0), "vec_id", "embedding", F.col("vec_id") % 20 == 0).count() == 0


def test_footrule_from_shared_places():
    """The score of shared places ranks as the induced footrule distance does."""
    rng = np.random.default_rng(3)
    prefix, pivots = 6, 12
    orders = np.array([rng.permutation(pivots)[:prefix] for _ in range(40)])
    place = np.full((40, pivots), prefix)
    for i, o in enumerate(orders):
        place[i, o] = np.arange(prefix)
    footrule = np.abs(place[:1] - place).sum(1)
    shared = np.minimum(prefix - place[:1], prefix - place).sum(1)
    assert (footrule == prefix * (prefix + 1) - 2 * shared).all()


def test_every_length_is_searched(spark):
    """Vectors of several lengths: each query is answered among those of its own."""
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=(4, 8, 3)[i % 3]).tolist()) for i in range(240)] + [(1000, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in index.search(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    vectors = dict(rows)
    assert sorted(got) == [i for i in range(0, 240, 20)]  # 1000 is alone in its length
    for q, found in got.items():
        own = {i: float(np.dot(v, vectors[q])) for i, v in vectors.items() if i != q and len(v) == len(vectors[q])}
        want = sorted(own, key=lambda i: (-own[i], i))[:20]
        assert [v for _, v, _ in sorted(found)] == want
