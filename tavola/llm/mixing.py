"""Mixing sources to target weights by weighted fair queueing (DataFrame functions only).

Every source is a flow. Its documents queue in a seeded shuffle, epoch after epoch, and a
document's virtual finish time is the source's cumulative words up to and including it,
divided by the source's target. The queues are merged by a global range sort on the finish
time and the merged sequence is cut at the total budget.

Both running sums are made in two levels (sums of fine ranges first, then inside one range),
so neither a source that holds a third of all rows nor the global order ever meets in one
task. Which copies fit is stated per source and epoch as a bound on the shuffle key; the
documents are then read with that small table, so their texts are not shuffled.

Every row queues by itself. Its place in the shuffle is a hash of its doc_id and text, so rows with
the same id, or with none, are shuffled apart. Rows of one source that are equal in id and text are
numbered, and that number is part of their place; only such rows are read a second time.

Defined cases: a null text has size 0; a null source is a source of its own, last in code
point order; documents of size 0 cost nothing and take nothing; a text of any length is one document;
rows that repeat a doc_id, or have none, are each a document of their own; of equal rows any may be
the one that is taken; ties in finish time go by source, epoch and place in the shuffle; an empty
table gives an empty result; extra columns pass through ``mix`` and clash with none of its working
names (all begin with ``__wfq_``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tavola.llm._shared import native_word_count, stash, table, whole_text
from tavola.operators.joins import broadcast_if_small
from tavola.operators.record_id import COPIES_AT_ONCE, with_record_seq

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
#: Rows of a range that one task sorts, and the least numbers of ranges of a source's shuffle order
#: and of the finish times.
RANGE_ROWS = 100_000
KEY_RANGES = 256
TIME_RANGES = 4096
#: What tells the rows of a source apart: equal rows also by their number.
_ROW = ["doc_id", "text_hash", "copy"]


def _text_hash(text: Column) -> Column:
    return F.xxhash64(text)


def _shuffle_key(doc_id: Column, text_hash: Column, copy: Column, seed: int) -> Column:
    return F.xxhash64(doc_id, text_hash, copy, F.lit(seed))


def _ranges(rows: int, least: int) -> int:
    """A power of two: ranges of about RANGE_ROWS of ``rows`` rows."""
    return max(least, 1 << (-(-rows // RANGE_ROWS) - 1).bit_length() if rows else 1)


def _key_range(key: Column, ranges: int) -> Column:
    """The range that a 64-bit key falls into, in key order."""
    return F.floor(key / F.lit(float(2**64 // ranges))).cast("int")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """source, source_size, target from one row per source (``source``, ``source_size``).

    Sources ranked by code point (null last) get the weights in turn. Sharing everything by
    weight, stopping at ``max_repeats`` times the size and sharing the excess again ends where
    target = min(cap, level * weight); the level follows from sources sorted by cap / weight.
    The table has one row per source, so ordering it in one task is bounded by their number.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    turn = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("w", turn[((F.row_number().over(by_name) - 1) % len(weights)).cast("int")]).withColumn(
        "cap", max_repeats * F.col("source_size").cast("double")
    )
    place = F.struct(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source"))
    by_ratio = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    full = (
        ranked.withColumn("place", place)
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(by_ratio), F.lit(0.0)))
        .withColumn("w_before", F.coalesce(F.sum("w").over(by_ratio), F.lit(0.0)))
        .withColumn("total", F.sum(F.col("source_size").cast("double")).over(every))
        .withColumn("w_all", F.sum("w").over(every))
        .withColumn("level", (F.col("total") - F.col("cap_before")) / (F.col("w_all") - F.col("w_before")))
        # the first place at which the rest can be shared without passing a cap
        .withColumn("first", F.min(F.when(F.col("level") <= F.col("cap") / F.col("w"), F.struct("place", "level"))).over(every))
    )
    target = F.least(F.col("cap"), F.col("first.level") * F.col("w"))
    return full.select("source", "source_size", F.coalesce(target, F.col("cap")).alias("target"))


def schedule(sized: DataFrame, seed: int = 0, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> tuple[DataFrame, DataFrame]:
    """(targets per source, bounds per source and epoch) from source, doc_id, text_hash, size, n:
    one row for each distinct document with the number ``n`` of its equal rows.

    A row's copy of an epoch is in the mix when (shuffle key, doc_id, text_hash, copy) is at most
    the bound of its source and epoch."""
    rows = sized.agg(F.sum("n")).first()[0] or 0
    key_ranges, time_ranges = _ranges(rows, KEY_RANGES), _ranges(rows, TIME_RANGES)
    # equal rows numbered from 1, in chunks, so that no array grows with their number
    chunk = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"), F.lit(COPIES_AT_ONCE).cast("bigint")))
    copy = F.explode(F.sequence(F.col("chunk"), F.least(F.col("chunk") + COPIES_AT_ONCE - 1, F.col("n"))))
    slim = sized.withColumn("chunk", chunk).withColumn("copy", copy).drop("chunk", "n")
    slim = slim.withColumn("key", _shuffle_key(F.col("doc_id"), F.col("text_hash"), F.col("copy"), seed))
    slim = slim.withColumn("part", _key_range(F.col("key"), key_ranges))
    parts = slim.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    aims = stash(targets(parts.groupBy("source").agg(F.sum("part_size").alias("source_size")), weights, max_repeats), "mix-targets")
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("source", "part", F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("start"))
    starts = stash(
        starts.join(aims, starts["source"].eqNullSafe(aims["source"])).select(
            starts["source"], "part", "start", "source_size", "target"
        ),
        "mix-starts",
    )
    # inside one range of one source, rows in key order
    inside = Window.partitionBy("source", "part").orderBy("key", *_ROW)
    queued = slim.withColumn("here", F.sum("size").over(inside))
    queued = queued.alias("q").join(
        starts.alias("s"), F.col("q.source").eqNullSafe(F.col("s.source")) & (F.col("q.part") == F.col("s.part"))
    )
    copies = (
        queued.filter("q.size > 0 AND target > 0")
        .select(
            "q.source", "key", *_ROW, "size", "source_size", "target", (F.col("start") + F.col("here")).alias("cum"),
            F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))).alias("epoch"),
        )
        .withColumn("finish", (F.col("epoch") * F.col("source_size") + F.col("cum")) / F.col("target"))
        .withColumn("slot", F.floor(F.least(F.col("finish"), F.lit(float(max_repeats + 1))) * time_ranges).cast("int"))
    )
    queue = stash(copies.select("source", "key", *_ROW, "size", "epoch", "finish", "slot", "source_size"), "mix-queue")
    budget = aims.agg(F.sum("source_size").alias("budget"))
    # global order: sums of the time ranges, then the rows inside one range
    slots = queue.groupBy("slot").agg(F.sum("size").alias("slot_size"))
    upto = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.select("slot", "slot_size", F.coalesce(F.sum("slot_size").over(upto), F.lit(0)).alias("ahead"))
    slots = slots.crossJoin(F.broadcast(budget)).withColumn(
        "whole", F.col("ahead") + F.col("slot_size") <= F.col("budget")
    ).filter(F.col("ahead") < F.col("budget"))
    queue = queue.join(broadcast_if_small(slots), "slot")  # at most (max_repeats + 1) * time_ranges + 1 rows
    order = Window.partitionBy("slot").orderBy("finish", F.col("source").isNull(), "source", "epoch", "key", *_ROW)
    edge = queue.filter(~F.col("whole")).withColumn("upto", F.col("ahead") + F.sum("size").over(order))
    names = ["source", "epoch", "key", *_ROW]
    taken = queue.filter("whole").select(*names).unionByName(edge.filter("upto <= budget").select(*names))
    bounds = taken.groupBy("source", "epoch").agg(F.max(F.struct("key", *_ROW)).alias("bound"))
    return aims, bounds


def _numbered(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """``docs`` with __wfq_copy: 1, or the number of a row among those equal to it."""
    if repeated.isEmpty():
        return docs.withColumn("__wfq_copy", F.lit(1).cast("bigint"))
    names = {"source": "__wfq_s", "doc_id": "__wfq_i", "text_hash": "__wfq_t"}
    side = broadcast_if_small(repeated.select(*[F.col(c).alias(n) for c, n in names.items()]))
    same = F.col("source").eqNullSafe(F.col("__wfq_s")) & F.col("doc_id").eqNullSafe(F.col("__wfq_i")) & (F.col("__wfq_hash") == F.col("__wfq_t"))
    once = docs.join(side, same, "left_anti").withColumn("__wfq_copy", F.lit(1).cast("bigint"))
    more = with_record_seq(docs.join(side, same, "left_semi"), ["source", "doc_id", "__wfq_hash"], "__wfq_copy")
    return once.unionByName(more)


def mix(
    docs: DataFrame, seed: int = 0, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """``docs`` (doc_id, text, source, more) with mix_size, mix_source_size, mix_target and
    mix_copies, the number of times (0 to ``max_repeats``) the mix takes the document."""
    size = native_word_count(whole_text())
    sized = docs.select("source", "doc_id", _text_hash(whole_text()).alias("text_hash"), size.alias("size"))
    sized = stash(sized.groupBy("source", "doc_id", "text_hash", "size").agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    aims, bounds = schedule(sized, seed, weights, max_repeats)
    per_source = bounds.groupBy(F.col("source").alias("__wfq_source")).agg(F.collect_list("bound").alias("__wfq_bounds"))
    plan = aims.select(
        F.col("source").alias("__wfq_name"), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target")
    )
    plan = plan.join(per_source, F.col("__wfq_name").eqNullSafe(F.col("__wfq_source")), "left").drop("__wfq_source")
    plan = stash(plan, "mix-plan")
    keep = [c for c in docs.columns if c not in ("mix_size", "mix_source_size", "mix_target", "mix_copies")]
    out = docs.select(*keep).withColumn("__wfq_hash", _text_hash(whole_text()))
    out = _numbered(out, sized.filter("n > 1").select("source", "doc_id", "text_hash")).withColumn("mix_size", size)
    row = [F.col("doc_id"), F.col("__wfq_hash"), F.col("__wfq_copy")]
    own = F.struct(_shuffle_key(*row, seed).alias("key"), row[0], row[1].alias("text_hash"), row[2].alias("copy"))
    fits = F.filter(F.col("__wfq_bounds"), lambda b: own <= b)
    out = out.join(broadcast_if_small(plan), F.col("source").eqNullSafe(F.col("__wfq_name")))
    copies = F.when(F.col("mix_size") > 0, F.coalesce(F.size(fits), F.lit(0))).otherwise(0)
    copies = F.when(F.col("__wfq_bounds").isNull(), 0).otherwise(copies)
    out = out.withColumn("mix_copies", copies.cast("int"))
    return out.select(*keep, "mix_size", "mix_source_size", "mix_target", "mix_copies")


def mixed_documents(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The mix itself: every taken copy of every document as a row of its own."""
    names = docs.columns
    taken = mix(docs, seed).filter("mix_copies > 0")
    return taken.withColumn("__wfq_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies")))).select(*names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents"))
    return out.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").cast("long").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).cast("long").alias("taken"),
    )
