"""Weighted fair queueing: targets, nearness to them, repeats, determinism."""

import random

import pytest

from tavola.llm import mixing


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Share by weight; what is above a cap is shared again until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        rest, weight = total - sum(capped.values()), sum(w[s] for s in free)
        share = {s: rest * w[s] / weight for s in free} if weight else {}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return {**capped, **share}
        capped.update({s: float(most * sizes[s]) for s in over})


def test_targets(spark):
    rng = random.Random(4)
    for case in range(6):
        sizes = {rng.choice(["é", "a", "B", "中", "z", "\U0001f600", "ab"]) + str(i): rng.choice([1, 5, 40, 900, 20000]) for i in range(rng.randint(1, 9))}
        if case % 2:
            sizes[None] = 7
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.targets(df).collect()}
        want = plain_targets(sizes)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) <= 1e-6 * max(1, want[s]) for s in want)


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(2)
    sources = ["a"] * 500 + ["b"] * 300 + ["c"] * 150 + ["d"] * 40 + [None] * 60
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), s) for i, s in enumerate(sources)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_sources_come_near_their_targets(spark, docs):
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count() and all(0 <= r.mix_copies <= 3 for r in got)
    taken, budget = {}, 0
    for r in got:
        assert r.mix_size == len(r.text.split())
        t = taken.setdefault(r.source, [0, r.mix_target])
        t[0] += r.mix_copies * r.mix_size
        budget += r.mix_size
    assert sum(t for t, _ in taken.values()) <= budget
    assert all(abs(t - target) <= 60 for t, target in taken.values())
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.mix_copies) for r in got) == sorted((r.doc_id, r.mix_copies) for r in again)
    copies = mixing.mixed_documents(docs)
    assert copies.columns == docs.columns and copies.count() == sum(r.mix_copies for r in got)


def test_equals_a_queue_in_python(spark, docs):
    """Every copy with its finish time, sorted, cut at the budget."""
    slim = {r.doc_id: r for r in mixing.mix(docs).collect()}
    from pyspark.sql import functions as F

    place = mixing._shuffle_key(F.col("doc_id"), mixing._text_hash(F.col("text")), F.lit(1).cast("bigint"), 0)
    keys = {r.doc_id: r.k for r in docs.select("doc_id", place.alias("k")).collect()}
    queue, budget = [], 0
    for source in {r.source for r in slim.values()}:
        own = sorted((keys[i], i) for i, r in slim.items() if r.source == source)
        cum, whole = 0, sum(slim[i].mix_size for _, i in own)
        budget += whole
        for epoch in range(3):
            for key, i in own:
                cum += slim[i].mix_size
                if slim[i].mix_size:
                    queue.append((cum / slim[i].mix_target, source is None, source or "", epoch, key, i))
    queue.sort()
    want, spent = dict.fromkeys(slim, 0), 0
    for *_, i in queue:
        spent += slim[i].mix_size
        if spent > budget:
            break
        want[i] += 1
    assert want == {i: r.mix_copies for i, r in slim.items()}


def test_edge_rows(spark, edge_docs, no_docs):
    got = mixing.mix(edge_docs).collect()
    assert len(got) == edge_docs.count()
    assert all(r.mix_copies == 0 for r in got if not (r.text or "").split())
    assert mixing.mix(no_docs).count() == 0
    plan = mixing.mix(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def _near_targets(got, longest):
    taken = {}
    for r in got:
        t = taken.setdefault(r.source, [0, r.mix_target])
        t[0] += r.mix_copies * r.mix_size
    assert all(abs(t - target) <= longest for t, target in taken.values()), taken


@pytest.mark.parametrize("id_of", [lambda i: None if i % 3 == 0 else i, lambda i: 7 if i % 3 == 0 else i, lambda i: None])
def test_targets_with_repeated_or_missing_ids(spark, id_of):
    rng = random.Random(8)
    rows = [(id_of(i), " ".join([f"w{i}"] * rng.randint(0, 60)), s) for i, s in enumerate(["a"] * 600 + ["b"] * 300 + ["c"] * 100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    _near_targets(got, 60)
    key = lambda r: (str(r.doc_id), r.text, r.source, r.mix_copies)
    assert sorted(map(key, got)) == sorted(map(key, mixing.mix(docs.repartition(7)).collect()))


def test_equal_rows_are_taken_one_by_one(spark):
    rows = [(None, "same words again", "a", k % 3) for k in range(600)] + [(5, "and these here too", "a", 0)] * 300 + [(i, f"x{i} y z", "b", 0) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, more int")
    got = mixing.mix(docs).collect()
    assert sorted((str(r.doc_id), r.text, r.more) for r in got) == sorted((str(i), t, m) for i, t, _, m in rows)
    _near_targets(got, 4)
    assert len({r.mix_copies for r in got if r.doc_id is None}) > 1  # some are taken more often than others
    key = lambda r: (str(r.doc_id), r.text, r.mix_copies)
    assert sorted(map(key, got)) == sorted(map(key, mixing.mix(docs.repartition(7)).collect()))
    assert mixing.mixed_documents(docs).count() == sum(r.mix_copies for r in got)
