"""The spend answer run incrementally equals the batch answer on the same events."""

import uuid

from frames import rows

from tavola.plans import diner
from tavola.sources import adapters as A
from tavola.sources.testdata import load_tables
from tavola.streaming import event_sales_stream, run_incremental

SF = "/root/testdata/sf0.001"


def test_streaming_spend_matches_batch(spark):
    t = load_tables(spark, SF)
    menu = A.menu(t)
    name = f"spend_stream_{uuid.uuid4().hex[:8]}"
    q = run_incremental(diner.total_spend, event_sales_stream(spark, f"{SF}/events.parquet"), menu, name=name, sink="memory")
    try:
        q.processAllAvailable()
        streamed = rows(spark.sql(f"SELECT * FROM {name}"))
    finally:
        q.stop()
    batch = rows(diner.total_spend(A.event_sales(t).select("customer_id", "order_date", "product_id"), menu))
    assert streamed == batch and len(batch) > 0


def test_streaming_state_carries_across_micro_batches(spark, tmp_path):
    t = load_tables(spark, SF)
    folder = tmp_path / "events"
    ev = t.events
    # two files, two micro-batches (one file per trigger)
    ev.filter("event_id % 2 = 0").coalesce(1).write.parquet(str(folder / "part=0"))
    ev.filter("event_id % 2 = 1").coalesce(1).write.parquet(str(folder / "part=1"))
    files = sorted(str(p) for p in folder.rglob("*.parquet"))
    assert len(files) == 2
    flat = tmp_path / "flat"
    flat.mkdir()
    for i, f in enumerate(files):
        (flat / f"events_{i}.parquet").write_bytes(open(f, "rb").read())
    menu = A.menu(t)
    name = f"spend_batches_{uuid.uuid4().hex[:8]}"
    q = run_incremental(diner.total_spend, event_sales_stream(spark, str(flat), max_files_per_trigger=1), menu, name=name, sink="memory")
    try:
        q.processAllAvailable()
        batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
        streamed = rows(spark.sql(f"SELECT * FROM {name}"))
    finally:
        q.stop()
    assert len(batches) == 2  # the aggregate state spans both micro-batches
    batch = rows(diner.total_spend(A.event_sales(t).select("customer_id", "order_date", "product_id"), menu))
    assert streamed == batch
