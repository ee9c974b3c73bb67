"""Lazy access to the parquet tables of a scale-factor folder.

Each table is opened on first use with a declared schema (no footer-reading job to
infer it); Catalyst prunes columns and pushes filters into the parquet scan, so
adapters can select freely without reading unused columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Declared schemas of the tables the answers read (as written by the data generator).
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


class Tables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLE_NAMES:
            raise AttributeError(name)
        if name not in self._cache:
            reader = self.spark.read
            if name in SCHEMAS:
                reader = reader.schema(SCHEMAS[name])
            self._cache[name] = reader.parquet(f"{self.root}/{name}.parquet")
        return self._cache[name]


    def replaced(self, **tables: DataFrame) -> Tables:
        """The same folder with some tables taken from elsewhere."""
        other = Tables(self.spark, self.root)
        other._cache.update(tables)
        return other


def load_tables(spark: SparkSession, root: str) -> Tables:
    return Tables(spark, root)
