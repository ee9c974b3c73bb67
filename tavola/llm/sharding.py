"""Sharding by best-fit-decreasing bin packing of indivisible groups (law ``bytes``).

Documents of equal text form a group, the unit that is packed. Units, largest first, go to the open
shard with the least remaining room that still takes them, found in a balanced tree of remaining
capacities; the capacity is the smallest, by galloping and bisection, at which all units fit the given
number of shards.

Units of equal size are interchangeable, so the packing runs over sizes: a run of n units of one size
fills the tightest shard with as many as it takes, then the next one, which is what best fit does
with them one after the other. Different sizes of one corpus are few: k of them need k*k/2 bytes,
so no more than sqrt(2 * bytes) pairs of size and number reach the driver, and about as many places
come back. Which unit of a run goes where is settled by its rank: Spark sorts the groups by size and
hash into ranges, and each place takes an interval of ranks. Every group is packed by the method at
every scale, whatever its size.

A group larger than a whole shard cannot stay whole under a near-equal law: it alone is cut, and its
documents are units of their own, numbered in the order of doc_id.

Texts are hashed where they are read; only ids, sizes and hashes are shuffled.

Defined cases: a null text has no bytes and the CRC of the empty text, and all null and empty texts
form one group; a text of any length is one unit; rows that repeat a doc_id are placed each for
itself, rows equal in id and text are interchangeable; equal sizes go by hash of the text, the slots of
a shard by doc_id (null first), then by hash, so they do not depend on files or partitions; an empty
table gives an empty result; columns other than doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tavola.llm._shared import on_workers, stash, table, whole_text
from tavola.operators.ranges import with_position
from tavola.operators.record_id import with_record_seq

SHARDS = 40
ROW_BYTES = 16
#: The search for the capacity ends at 1/PRECISION of the mean shard.
PRECISION = 20_000


class CapacityTree:
    """Bins by (remaining capacity, bin) in a treap: insert, remove, and the smallest remaining
    capacity that still takes a size, each in logarithmic expected time."""

    def __init__(self, seed: int = 0):
        self._root: list | None = None  # [key, priority, left, right]
        self._random = random.Random(seed)

    def _split(self, node, key):
        """(keys below ``key``, the others)."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _merge(self, a, b):
        if a is None or b is None:
            return b if a is None else a
        if a[1] > b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b

    def insert(self, room: int, bin_: int) -> None:
        left, right = self._split(self._root, (room, bin_))
        self._root = self._merge(self._merge(left, [(room, bin_), self._random.random(), None, None]), right)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the (room, bin) with the least room of at least ``size``."""
        left, right = self._split(self._root, (size, -1))
        if right is None:
            self._root = left
            return None
        if right[2] is None:
            key, right = right[0], right[3]
        else:
            parent, node = right, right[2]
            while node[2] is not None:
                parent, node = node, node[2]
            key, parent[2] = node[0], node[3]
        self._root = self._merge(left, right)
        return key


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each item; ``sizes`` must be in descending order and none above ``capacity``."""
    tree, bins, placed = CapacityTree(), 0, []
    for size in sizes:
        found = tree.take_tightest(size)
        if found is None:
            found, bins = (capacity, bins), bins + 1
        room, bin_ = found
        tree.insert(room - size, bin_)
        placed.append(bin_)
    return placed


def best_fit_runs(runs: list[tuple[int, int]], capacity: int, most: int) -> list[list[tuple[int, int]]] | None:
    """``best_fit_decreasing`` of runs (size, number), sizes descending: for each run its places
    (bin, number) in the order they are filled; None if more than ``most`` bins are needed."""
    tree, bins, placed = CapacityTree(), 0, []
    for size, number in runs:
        places = []
        while number:
            found = tree.take_tightest(size)
            if found is None:
                if bins == most:
                    return None
                found, bins = (capacity, bins), bins + 1
            room, bin_ = found
            # what is left of this bin is less than any other that takes the size
            taken = min(number, room // size)
            tree.insert(room - taken * size, bin_)
            places.append((bin_, taken))
            number -= taken
        placed.append(places)
    return placed


def pack_runs(runs: list[tuple[int, int]], shards: int) -> list[list[tuple[int, int]]]:
    """Places of ``runs`` in at most ``shards`` bins, at the least capacity the search finds: up from
    the mean in doubling steps to one that fits, then by bisection. A capacity of the mean and the
    largest unit always fits, since no bin is opened while one at or below the mean is open."""
    if not runs:
        return []
    total = sum(size * number for size, number in runs)
    step = max(1, total // shards // PRECISION)
    low, enough = max(runs[0][0], -(-total // shards)), total // shards + 1 + runs[0][0]
    high, stride = low, step
    while (best := best_fit_runs(runs, high, shards)) is None:
        low, high, stride = high + 1, min(enough, high + stride), 2 * stride
    while low + step <= high:
        middle = (low + high) // 2
        placed = best_fit_runs(runs, middle, shards)
        if placed is None:
            low = middle + 1
        else:
            best, high = placed, middle - 1
    return best


def pack(sizes: list[int], shards: int) -> list[int]:
    """Bins of descending ``sizes``, at most ``shards`` of them."""
    runs: list[list[int]] = []
    for size in sizes:
        if runs and runs[-1][0] == size:
            runs[-1][1] += 1
        else:
            runs.append([size, 1])
    return [bin_ for places in pack_runs([(s, n) for s, n in runs], shards) for bin_, n in places for _ in range(n)]


def _group(text: Column) -> Column:
    """128 bits of the text's hash."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _rows(docs: DataFrame) -> DataFrame:
    text = whole_text()
    return docs.select(
        "doc_id", (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"), F.crc32(text).cast("long").alias("text_crc32"), _group(text).alias("grp")
    )


def _by_rank(df: DataFrame, rank: str, ends: np.ndarray, shards: np.ndarray) -> DataFrame:
    """``df`` plus shard: place k takes the ranks (from 1) up to ``ends[k]``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.searchsorted(ends, b[rank].to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shards[at], pa.int32())], names=[*b.schema.names, "shard"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return on_workers(df).mapInArrow(run, f"{schema}, shard int")


def _cut(places: list[tuple[int, int]], at: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """The places of the first ``at`` units, and of the rest."""
    first, rest = [], []
    for bin_, n in places:
        own = min(n, at)
        at -= own
        first += [(bin_, own)] if own else []
        rest += [(bin_, n - own)] if n > own else []
    return first, rest


def _ends(places: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum([n for _, n in places]), np.array([b for b, _ in places], np.int32)


def placed_rows(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, grp and shard of every row."""
    rows = stash(_rows(docs), "shard-rows")
    groups = stash(rows.groupBy("grp", "size").agg(F.count(F.lit(1)).alias("n")).withColumn("bytes", F.col("n") * F.col("size")), "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    capacity = max(1, -(-total // shards))
    # fewer than ``shards`` groups are larger than a shard; their rows are units
    large = sorted(tuple(r) for r in groups.filter(F.col("bytes") > capacity).select("size", "grp", "n").collect())
    whole = groups.filter(F.col("bytes") <= capacity)
    counts = {r["bytes"]: r["count"] for r in whole.groupBy("bytes").count().collect()}
    units = dict(counts)
    for size, _, n in large:
        units[size] = units.get(size, 0) + n
    runs = sorted(units.items(), reverse=True)
    of_size = dict(zip((s for s, _ in runs), pack_runs(runs, shards), strict=True))
    # of a run, whole groups come first, then the rows of each large group
    order, own = [], []
    for size in sorted(units):
        first, rest = _cut(of_size[size], counts.get(size, 0))
        order += first
        for s, grp, n in large:
            if s == size:
                places, rest = _cut(rest, n)
                own.append((bytes(grp), places))
    out = []
    if order:
        ranked = with_position(whole.select("grp", "bytes"), [F.col("bytes"), F.col("grp")], out="rank")
        homes = _by_rank(ranked, "rank", *_ends(order)).select("grp", "shard")
        out.append(rows.join(homes, "grp"))
    for grp, places in own:
        numbered = with_record_seq(rows.filter(F.col("grp") == F.lit(grp)), ["grp"], "rank")
        out.append(_by_rank(numbered, "rank", *_ends(places)).select(*rows.columns, "shard"))
    if not out:
        return rows.withColumn("shard", F.lit(0))
    names = ["doc_id", "size", "text_crc32", "grp", "shard"]
    result = out[0].select(*names)
    for more in out[1:]:
        result = result.unionByName(more.select(*names))
    return stash(result, "shard-places")


def slots(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, grp, shard and slot (gapless from 0 in its shard) of every row. A
    shard's rows are numbered in ranges, so one of any size spreads over many tasks."""
    placed = placed_rows(docs, shards).select("shard", "doc_id", "grp", "size", "text_crc32")
    return with_record_seq(placed, ["shard"], "slot").withColumn("slot", F.col("slot") - 1)


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, text, size, shard and slot of every row."""
    texts = docs.select(whole_text().alias("text")).withColumn("grp", _group(F.col("text"))).dropDuplicates(["grp"])
    return slots(docs, shards).join(texts, "grp").select("doc_id", "text", "size", "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """The shards as Parquet folders ``shard=N``."""
    assign(docs, shards).write.partitionBy("shard").parquet(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return slots(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
