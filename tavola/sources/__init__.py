"""Table sources: parquet testdata and adapters to the reference table shapes."""

from tavola.sources.testdata import Tables, load_tables

__all__ = ["Tables", "load_tables"]
