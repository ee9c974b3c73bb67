"""Bin packing: the tree against a plain scan, near-equal shards, whole groups, gapless slots."""

import random
import zlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tavola.llm import sharding


def plain_best_fit(sizes, capacity):
    rooms, placed = [], []
    for size in sizes:
        fits = [(room, b) for b, room in enumerate(rooms) if room >= size]
        if not fits:
            rooms.append(capacity)
            fits = [(capacity, len(rooms) - 1)]
        b = min(fits)[1]
        rooms[b] -= size
        placed.append(b)
    return placed


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60), st.integers(50, 120))
def test_tree_equals_a_scan(sizes, capacity):
    sizes.sort(reverse=True)
    assert sharding.best_fit_decreasing(sizes, capacity) == plain_best_fit(sizes, capacity)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 500), min_size=1, max_size=200), st.integers(1, 12))
def test_pack_keeps_to_the_shards(sizes, shards):
    sizes.sort(reverse=True)
    placed = sharding.pack(sizes, shards)
    assert len(placed) == len(sizes) and max(placed) < shards
    loads = defaultdict(int)
    for s, b in zip(sizes, placed, strict=True):
        loads[b] += s
    assert max(loads.values()) <= sum(sizes) // shards + 1 + sizes[0]


def test_near_equal_shards_of_whole_groups(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 400))) for _ in range(900)]
    rows = [(i, rng.choice(texts[:300]) if i % 3 else texts[i % 900]) for i in range(2000)]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), shards=8).collect()
    assert len(got) == len(rows)
    loads, slots, homes = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in got:
        assert r.size == len(r.text.encode()) + 16
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
        homes[r.text].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in homes.values())
    assert len(loads) == 8 and max(loads.values()) - min(loads.values()) < 0.02 * sum(loads.values()) / 8


def test_a_group_above_a_shard_is_cut(spark):
    rows = [(i, "same " * 20) for i in range(600)] + [(i, f"other {i}") for i in range(600, 1200)]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), shards=4).collect()
    loads = defaultdict(int)
    for r in got:
        loads[r.shard] += r.size
    assert len(got) == 1200 and max(loads.values()) < 1.1 * min(loads.values())


def test_edge_rows(spark, edge_docs, no_docs, tmp_path):
    got = sharding.assign(edge_docs, shards=3).collect()
    assert len(got) == edge_docs.count() and all(0 <= r.shard < 3 for r in got)
    assert len({r.shard for r in got if r.text == ""}) == 1
    assert sharding.assign(no_docs).count() == 0
    sharding.write_shards(edge_docs.select("doc_id", "text"), str(tmp_path / "out"), shards=3)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(got)
    assert zlib.crc32(b"") == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 40), st.integers(1, 30)), max_size=12), st.integers(40, 300))
def test_runs_equal_units_one_by_one(runs, capacity):
    runs = sorted({s: n for s, n in runs}.items(), reverse=True)
    placed = sharding.best_fit_runs(runs, capacity, 10**6)
    flat = [b for places in placed for b, n in places for _ in range(n)]
    assert flat == plain_best_fit([s for s, n in runs for _ in range(n)], capacity)
    assert sharding.best_fit_runs(runs, capacity, max(flat, default=-1)) is None or not flat


def plain_shards(rows, shards):
    """Loads of plain best-fit-decreasing over all groups, each a unit, at the operator's capacity."""
    units = {}
    for _, text in rows:
        units[text or ""] = units.get(text or "", 0) + len((text or "").encode()) + 16
    sizes = sorted(units.values(), reverse=True)
    placed = sharding.pack(sizes, shards)
    loads = [0] * shards
    for size, b in zip(sizes, placed, strict=True):
        loads[b] += size
    capacity = max(loads)
    assert placed == plain_best_fit(sizes, capacity)
    return sorted(loads)


def test_equals_plain_packing_of_all_groups(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    for shards in (40, 7):
        loads = [0] * shards
        for r in sharding.slots(docs, shards).collect():
            loads[r.shard] += r.size
        assert sorted(loads) == plain_shards(rows, shards)


def test_two_layouts_give_equal_slots(spark):
    rows = [(7, f"text {i % 900}") for i in range(2000)] + [(None, f"other {i}") for i in range(2000)] + [(i, "same") for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one, two = (sorted(map(str, sharding.slots(x, 5).collect())) for x in (df.repartition(3), df.orderBy(F.hash("text")).repartition(11)))
    assert one == two and len(one) == len(rows)


def test_a_large_group_of_one_id_is_cut(spark):
    rows = [(None, "same " * 20) for _ in range(400)] + [(3, "again " * 20) for _ in range(400)] + [(i, f"other {i}") for i in range(600)]
    loads = defaultdict(int)
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), shards=4).collect()
    for r in got:
        loads[r.shard] += r.size
    assert len(got) == 1400 and max(loads.values()) < 1.02 * min(loads.values())
    assert {s: sorted(r.slot for r in got if r.shard == s) for s in loads} == {s: list(range(sum(r.shard == s for r in got))) for s in loads}
