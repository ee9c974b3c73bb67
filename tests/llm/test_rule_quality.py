"""Rule ensemble: the compiled column equals numpy, held-out accuracy, edge cases."""

import numpy as np
from pyspark.sql import functions as F

from tavola.llm import rule_quality as rq


def _toy(n=600, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.random((n, len(rq.STATISTICS)))
    return x, ((x[:, 2] > 0.6) & (x[:, 5] <= 0.5)).astype(float)


def test_learns_a_conjunction_sparsely():
    x, y = _toy()
    model = rq.RuleModel.fit(x, y)
    grown = rq.grow_rules(x, y)
    assert 0 < len(model.rules) < len(grown)
    xt, yt = _toy(seed=1)
    assert ((model.predict(xt) >= 0.5) == yt).mean() > 0.95
    assert rq.RuleModel.fit(x, y) == model


def test_lasso_zeroes_useless_columns():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2, (800, 6)).astype(bool)
    w, _ = rq.lasso_logistic(a, a[:, 0].astype(float), penalty=0.05)
    assert w[0] > 0.5 and (np.abs(w[1:]) < 1e-6).all()


def test_one_class_or_no_labels():
    x, _ = _toy(50)
    assert rq.RuleModel.fit(x, np.ones(50)).predict(x)[0] > 0.9
    assert rq.RuleModel.fit(x[:0], np.zeros(0)).predict(x)[0] == 0.5


def test_column_equals_numpy(spark):
    x, y = _toy(200)
    model = rq.RuleModel.fit(x, y)
    names = [f"stat_{s}" for s in rq.STATISTICS]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], names)
    got = [r[0] for r in df.select(model.score()).collect()]
    assert np.allclose(got, model.predict(x))


def test_statistics_of_edges():
    zero = (0.0,) * len(rq.STATISTICS)
    assert rq.statistics(None) == rq.statistics("") == rq.statistics(" \n ") == zero
    by_name = dict(zip(rq.STATISTICS, rq.statistics("A a b!\nA a b!"), strict=True))
    assert by_name["words"] == 6 and by_name["lines"] == 2 and by_name["distinct_lines"] == 0.5
    assert by_name["same_as_before"] == 2 / 6 and by_name["distinct_words"] == 2 / 6


def test_on_tables(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (9, 0, 0), (None, 1, 0), (5, None, 0), (77, 1, 0)], "doc_id long, quality int, toxic int")
    model = rq.train(edge_docs, labels)
    out = rq.scored(edge_docs, model)
    rows = out.collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    assert "shard" in out.columns and not [c for c in out.columns if c.startswith("stat_")]
    assert rq.scored(no_docs, rq.train(no_docs, labels)).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = rq.query(spark, sf).join(labels, "doc_id").filter("held_out").collect()
    assert len(got) > 50
    assert sum(r.predicted == r.quality for r in got) / len(got) > 0.9
    ids = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id"), rq.held_out(F.col("doc_id")).alias("h")).collect()
    import zlib

    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in ids)
