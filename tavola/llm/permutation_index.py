"""Nearest neighbours by largest inner product, through a permutation index.

The index is cut into shards of about ``SHARD_ROWS`` vectors of one length. In a shard a bounded sample
of its vectors serves as pivots. Every vector is represented by its ``PREFIX`` nearest pivots in order,
and posted under each of them with its place in that order. A query walks the postings of its own
nearest pivots; what the places have in common adds up to the induced Spearman footrule distance
between the two orders. The candidates of least distance are ranked anew by the inner product of the
original vectors in double precision.

The stated queries are cut into blocks; one task searches one shard for one block and returns a bounded
list per query, and the lists are merged. An inner product needs two vectors of one length, so a query
is searched among the vectors of its own length, whatever lengths the table holds; numbers of shards
and blocks follow the number of vectors of a length. Equal vectors are one class: each class is indexed
once with its smallest ids, which is all that 20 nearest can need, so a vector that a third of all rows
share costs one entry.

Defined cases: vectors that are null, all zero, or hold a null or non-finite component take no part, nor
do null ids; vectors of any length are searched, each among its like; rows that repeat an id with the
same vector count once; a query is never its own result, and has fewer results where fewer vectors of
its length exist; ties go to the smaller id; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tavola.llm._shared import on_workers, stash, table
from tavola.operators.joins import broadcast_if_small

NEAREST = 20
PIVOTS, PREFIX = 256, 64
#: Share of a shard's vectors, by footrule distance, that is ranked by the exact measure.
RERANK, RERANK_LEAST = 0.35, 300
SHARD_ROWS, QUERY_ROWS = 4096, 16_384
SALTS = 32


def _usable(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & fine & F.exists(v, lambda x: x != 0)


def vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, v (array of double) and the class key (k1, k2) of the rows that take part. Vectors of
    two lengths are two classes."""
    v = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter("vec_id IS NOT NULL").filter(_usable(F.col("v")))
    return rows.select("vec_id", "v", F.xxhash64("v").alias("k1"), F.xxhash64(F.lit(1), "v").alias("k2"))


def classes(rows: DataFrame, nearest: int) -> DataFrame:
    """One row per distinct vector: cid (its smallest id), its ``nearest`` + 1 smallest ids, and
    whether an id among all of them is a query. Salted, so a frequent vector has many tasks."""
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(SALTS))
    parts = rows.withColumn("salt", salt).dropDuplicates(["k1", "k2", "salt", "vec_id"])
    some = Window.partitionBy("k1", "k2", "salt").orderBy("vec_id")
    every = Window.partitionBy("k1", "k2").orderBy("vec_id")
    parts = parts.withColumn("r", F.row_number().over(some)).filter(F.col("r") <= nearest + 1)
    parts = parts.withColumn("r", F.row_number().over(every)).filter(F.col("r") <= nearest + 1)
    return parts.groupBy("k1", "k2").agg(
        F.min("vec_id").alias("cid"), F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("v").alias("v")
    )


def _orders(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` nearest pivots of each row, nearest first; ties to the earlier pivot."""
    return np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :prefix]


def pivots_of(ids: np.ndarray, x: np.ndarray, seed: int) -> np.ndarray:
    """At most PIVOTS rows of ``x``, those of the smallest hashes of their ids."""
    hashed = (ids.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    hashed ^= hashed >> np.uint64(32)
    return x[np.lexsort((ids, hashed * np.uint64(0xD1B54A32D192ED03)))[:PIVOTS]]


def search_shard(
    ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, pivots: np.ndarray, most: int, rerank: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score) of each query's ``most`` best rows of the shard."""
    prefix = min(PREFIX, len(pivots))
    orders = _orders(x, pivots, prefix)
    # postings[p, i]: prefix less the place of pivot p in vector i's order, 0 if it is not posted.
    # For orders cut at the prefix, footrule = constant - 2 * sum over shared pivots of
    # min(prefix - place in one, prefix - place in the other).
    postings = np.zeros((len(pivots), len(x)), np.uint8)
    rows = np.arange(len(x))
    for place in range(prefix):
        postings[orders[:, place], rows] = prefix - place
    own = (prefix - np.arange(prefix)).astype(np.uint8)[:, None]
    ask = min(len(x), max(RERANK_LEAST, int(np.ceil(rerank * len(x)))))
    out_q, out_i, out_s = [], [], []
    for qid, vector, order in zip(query_ids, q, _orders(q, pivots, prefix), strict=True):
        shared = np.minimum(postings[order], own).sum(0, dtype=np.uint16)
        near = np.argpartition(shared, len(x) - ask)[len(x) - ask :] if ask < len(x) else rows
        scores = x[near] @ vector
        best = np.lexsort((ids[near], -scores))[:most]
        out_q.append(np.full(len(best), qid))
        out_i.append(ids[near[best]])
        out_s.append(scores[best])
    return np.concatenate(out_q), np.concatenate(out_i), np.concatenate(out_s)


def search(
    df: DataFrame, id_col: str, vector_col: str, is_query: Column, nearest: int = NEAREST, rerank: float = RERANK, seed: int = 0
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``nearest`` rows found for each row ``is_query`` (a
    condition on vec_id) holds for."""
    rows = vectors(df, id_col, vector_col)
    index = stash(classes(rows, nearest).withColumn("n", F.size("v")), "index-classes")
    asked = rows.filter(is_query).select("vec_id", "k1", "k2").dropDuplicates(["vec_id", "k1", "k2"])
    asked = stash(asked.join(index.select("k1", "k2", "cid"), ["k1", "k2"]).select(F.col("vec_id").alias("query_id"), "cid"), "index-queries")
    ask = asked.select("cid").distinct().join(index.select("cid", "v", "n"), "cid")
    # how many shards and blocks the vectors of a length make
    parts = lambda rows, out: F.ceil(F.count(F.lit(1)) / F.lit(rows)).cast("int").alias(out)
    lengths = index.groupBy("n").agg(parts(SHARD_ROWS, "shards")).join(ask.groupBy("n").agg(parts(QUERY_ROWS, "blocks")), "n")
    lengths = broadcast_if_small(stash(lengths, "index-lengths"))
    near = lambda col, many, s: F.pmod(F.xxhash64(col, F.lit(s)), F.col(many)).cast("int")
    each = lambda many: F.explode(F.sequence(F.lit(0), F.col(many) - 1))
    left = ask.join(lengths, "n").select(
        F.col("n").alias("of_length"), F.col("cid").alias("asked"), F.col("v").alias("q"), near("cid", "blocks", 2).alias("block"), each("shards").alias("of")
    )
    right = index.join(lengths, "n").select("n", "cid", "v", near("cid", "shards", 1).alias("shard"), each("blocks").alias("for_block"))

    def run(queries: pa.Table, base: pa.Table) -> pa.Table:
        names = ["query", "cid", "score"]
        if not queries.num_rows or not base.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=names)
        matrix = lambda t, c: np.array(t[c].combine_chunks().flatten()).reshape(t.num_rows, -1)
        ids, x = np.array(base["cid"]), matrix(base, "v")
        found = search_shard(ids, x, np.array(queries["asked"]), matrix(queries, "q"), pivots_of(ids, x, seed), nearest + 1, rerank)
        return pa.table([pa.array(c) for c in found], names=names)

    lists = on_workers(left).groupBy("of_length", "block", "of").cogroup(right.groupBy("n", "for_block", "shard")).applyInArrow(run, "query long, cid long, score double")
    # a class's smallest id stands before its others, so the best classes hold the best rows
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "cid")
    lists = lists.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= nearest + 1)
    members = lists.join(index.select("cid", "ids"), "cid").select("query", "score", F.explode("ids").alias("vec_id"))
    first = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    members = members.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= nearest + 1)
    answers = stash(
        members.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("found")), "index-answers"
    )
    out = asked.join(answers, F.col("cid") == F.col("query"))
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, nearest)
    out = out.select("query_id", F.posexplode(others).alias("place", "hit"))
    return out.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 20 == 0)
