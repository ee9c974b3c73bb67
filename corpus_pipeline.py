"""The corpus pipeline: documents in, encoded training documents out.

Stages (each takes the documents its predecessor kept):

1. quality: score every document with the rule ensemble; rejected documents go.
2. near_duplicates: one row of every group of near-duplicates stays (five-word shingles, a
   similarity of 0.80 or more), the one of the smallest doc_id.
3. personal_data: spans that rules and the conditional random field find are masked.
4. mixing: weighted fair queueing over sources; a document taken twice stands there twice.
5. encoding: byte-level BPE ids of every document, and what they decode to.

Defined cases are those of the operators. The second stage compares rows, whatever their ids: rows
without a doc_id are compared like any other and stay only where no row with one is near them; rows
that repeat a doc_id are rows of their own, so no text goes unless a near-duplicate of it stays, and an
id whose texts differ stays once for each group. Rows without words are near to nothing and stay.
Equal rows are one group; texts of any length are read whole; columns other than those of documents are
dropped; an empty table passes all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tavola.llm import byte_bpe, mixing, near_duplicates, personal_data, rule_quality
from tavola.llm._shared import stash, table
from tavola.operators.joins import broadcast_if_small

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Per cent of common shingles from which two documents count as near-duplicates here; the query
#: op2_minhash has its own.
SIMILAR = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    model = rule_quality.train(docs, table(spark, sf_dir, "labels"))
    return rule_quality.scored(docs, model).filter("predicted = 1").select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # rows get numbers of their own, written down, so that equal and missing ids tell them apart
    rows = stash(docs.select(*COLUMNS).withColumn("__row", F.monotonically_increasing_id()), "rows")
    groups = near_duplicates.near_duplicates(rows.select(F.col("__row").alias("doc_id"), "text"), SIMILAR)
    groups = groups.select(F.col("doc_id").alias("__row"), "component_id").join(rows.select("__row", "doc_id"), "__row")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__row"))
    kept = stash(groups.groupBy("component_id").agg(first.alias("first")).select("first.__row"), "kept")
    return rows.join(broadcast_if_small(kept), "__row", "left_semi").select(*COLUMNS)


def masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return personal_data.mask(docs.select(*COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs.select(*COLUMNS))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.public_round_trip(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", one_of_each_group),
    ("personal_data", masking),
    ("mixing", mix),
    ("encoding", encoding),
]

#: No SQL states the trained models of stages 1 and 3; tests/llm holds the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written and read again before the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
