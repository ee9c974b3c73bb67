"""Incremental runs of the same answers over a growing source (Structured Streaming)."""

from tavola.streaming.incremental import event_sales_stream, run_incremental

__all__ = ["event_sales_stream", "run_incremental"]
