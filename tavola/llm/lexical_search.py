"""Ranked lexical search of many queries at once, by common subexpressions.

All items are answered in one pass over the documents. A document's score for an item is a sum of one
whole number a term, so items that share terms share partial sums. These are mined before the
pass: terms that occur in just the same items become one set; then, again and again, the two sets
that most items hold together become a new one, which these items hold instead. What comes out is
a graph in which every set is the sum of earlier ones. For a block of documents the terms' numbers are
written into a matrix, every set's accumulator is computed once, level by level of the graph, and
an item's scores are the sum of the few sets and terms it still holds.

A first pass cuts the texts into terms and writes each document's length and its occurrences of the
items' terms; from it come the numbers of documents and terms. The second pass scores; every task
keeps the best documents of each item, and ranks are taken from those.

Items are taken in blocks of about ``BLOCK_TERMS`` terms, so that vocabulary and graph of a block are
bounded however many items there are; each block reads the documents once. Documents are never
sent to the driver, and none is left out.

Defined cases: a null or empty text has no terms; an item without terms, or whose terms no document
holds, gets no rows; rows that repeat an item_id are one item that holds the terms of all of them,
a null item_id like any other; every row of documents is one document, so repeated rows are
ranked apart; equal scores go by doc_id, null last; texts of any length are read whole; an empty table
of either kind gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tavola.llm._shared import on_workers, stash, table, whole_text

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
NEAREST = 50
#: Terms (of all items together) of a block of items.
BLOCK_TERMS = 50_000
#: Sets of an item, the most shared ones, among which pairs are mined; cells of a task's matrix.
MINED_SETS = 32
CELLS = 4_000_000

_UPPER, _LOWER_CASE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Sharing:
    """Sums over terms 0 to ``terms`` - 1. Set ``terms + k`` is the sum of ``sets[k]`` (terms and
    earlier sets); item i is the sum of ``items[i]``. ``levels`` holds the sets, as places of
    ``sets``, in an order in which each level needs only earlier ones."""

    terms: int
    sets: list[list[int]]
    items: list[list[int]]
    levels: list[list[int]]

    @property
    def additions(self) -> int:
        return sum(len(x) - 1 for x in [*self.sets, *self.items] if x)


def shared_sums(items: list[list[int]], terms: int, mined: int = MINED_SETS) -> Sharing:
    """Mines the term sets that ``items`` (distinct term numbers) share."""
    holders = defaultdict(list)
    for i, own in enumerate(items):
        for t in own:
            holders[t].append(i)
    alike = defaultdict(list)
    for t, of in holders.items():
        alike[tuple(of)].append(t)
    sets: list[list[int]] = []
    held: list[set[int]] = [set() for _ in items]
    shared: dict[int, int] = {}
    for of, same in alike.items():
        if len(of) > 1 and len(same) > 1:
            sets.append(same)
            same = [terms + len(sets) - 1]
        for i in of:
            held[i].update(same)
        if len(of) > 1:
            shared[same[0]] = len(of)
    # pairs of shared sets and the items that hold both
    pairs: dict[tuple[int, int], set[int]] = defaultdict(set)
    active = [sorted(sorted((s for s in own if s in shared), key=lambda s: (-shared[s], s))[:mined]) for own in held]
    for i, own in enumerate(active):
        for k, a in enumerate(own):
            for b in own[k + 1 :]:
                pairs[a, b].add(i)
    live = [set(own) for own in active]
    heap = [(-len(of), pair) for pair, of in pairs.items() if len(of) > 1]
    heapq.heapify(heap)
    while heap:
        count, (a, b) = heapq.heappop(heap)
        of = pairs[a, b]
        if len(of) != -count:
            if len(of) > 1:
                heapq.heappush(heap, (-len(of), (a, b)))
            continue
        new = terms + len(sets)
        sets.append([a, b])
        touched = set()
        for i in sorted(of):
            live[i] -= {a, b}
            held[i] -= {a, b}
            for x in live[i]:
                pairs[min(a, x), max(a, x)].discard(i)
                pairs[min(b, x), max(b, x)].discard(i)
                pairs[x, new].add(i)
                touched.add(x)
            live[i].add(new)
            held[i].add(new)
        pairs[a, b] = set()
        for x in touched:
            if len(pairs[x, new]) > 1:
                heapq.heappush(heap, (-len(pairs[x, new]), (x, new)))
    depth: list[int] = []
    for parts in sets:
        depth.append(1 + max((depth[p - terms] for p in parts if p >= terms), default=-1))
    levels = [[k for k, d in enumerate(depth) if d == level] for level in range(max(depth, default=-1) + 1)]
    return Sharing(terms, sets, [sorted(own) for own in held], levels)


def _sums(matrix: np.ndarray, lists: list[list[int]]) -> np.ndarray:
    """Sums of rows of ``matrix``, one for each (non-empty) list of rows."""
    starts = np.cumsum([0] + [len(x) for x in lists[:-1]])
    return np.add.reduceat(matrix[np.concatenate([np.array(x, np.int64) for x in lists])], starts, axis=0)


def evaluated(sharing: Sharing, numbers: np.ndarray) -> np.ndarray:
    """Scores, items by documents, from ``numbers``, terms by documents."""
    matrix = np.zeros((sharing.terms + len(sharing.sets), numbers.shape[1]), np.int64)
    matrix[: sharing.terms] = numbers
    for level in sharing.levels:
        matrix[sharing.terms + np.array(level)] = _sums(matrix, [sharing.sets[k] for k in level])
    out = np.zeros((len(sharing.items), numbers.shape[1]), np.int64)
    some = [i for i, own in enumerate(sharing.items) if own]
    if some:
        out[some] = _sums(matrix, [sharing.items[i] for i in some])
    return out


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def terms_of(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, term: the distinct terms of every item."""
    found = F.regexp_extract_all(whole_text(text), F.lit(TERM), F.lit(0))
    return items.select(
        F.col(item_id).cast("long").alias("item_id"), F.explode(found).alias("term")
    ).select("item_id", F.translate("term", _UPPER, _LOWER_CASE).alias("term")).distinct()


def _cut(texts: list[bytes], vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each text's number of terms; and of the terms in ``vocabulary``: text, term, occurrences."""
    a = np.frombuffer(b"\n".join(texts), np.uint8)
    inside = np.zeros(len(a) + 2, np.int8)
    own = _INSIDE[a]
    inside[1:-1] = own
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    terms = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[a[own]])])
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    text = np.searchsorted(text_ends, starts, side="right")
    sizes = np.bincount(text, minlength=len(texts))
    at = pc.index_in(terms, value_set=vocabulary).fill_null(-1).to_numpy()
    hit = at >= 0
    found, times = np.unique(text[hit] * len(vocabulary) + at[hit], return_counts=True)
    return sizes, found // len(vocabulary), found % len(vocabulary), times


def postings(docs: DataFrame, vocabulary: list[str], chunk: int = 512) -> DataFrame:
    """doc_id, n (terms with repeats), terms, times: of every document, its occurrences of the
    terms of ``vocabulary``, as places there."""
    words = [w.encode() for w in vocabulary]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(words, pa.large_binary())
        for batch in batches:
            for part in (batch.slice(i, chunk) for i in range(0, batch.num_rows, chunk)):
                sizes, text, term, times = _cut(part["text"].cast(pa.binary()).to_pylist(), known)
                ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(sizes)))])
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (term, times)]
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(sizes, pa.int64()), *lists], names=["doc_id", "n", "terms", "times"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return on_workers(source).mapInArrow(run, "doc_id long, n long, terms array<int>, times array<int>")


def _holding(posted: DataFrame, terms: int) -> list[int]:
    """How many documents hold each of the ``terms`` terms of a block."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            total += np.bincount(batch["terms"].flatten().to_numpy(), minlength=terms)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["term", "n"])

    out = [0] * terms
    for r in posted.select("terms").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r.term] = r.n
    return out


class _Best:
    """The ``nearest`` best documents of every item seen so far, and later ones not yet compared."""

    def __init__(self, items: int, nearest: int):
        self.nearest, self.least = nearest, np.ones(items, np.int64)
        self.rows = [np.zeros(0, np.int64)] * 4  # item, score, whether doc_id is null, doc_id
        self.later: list[tuple[np.ndarray, ...]] = []
        self.waiting = 0

    def see(self, scores: np.ndarray, doc_ids: np.ndarray, nulls: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.least[:, None])
        self.later.append((item, scores[item, doc], nulls[doc].astype(np.int64), doc_ids[doc]))
        self.waiting += len(item)
        if self.waiting > 4 * self.nearest * len(self.least):
            self.settle()

    def settle(self) -> list[np.ndarray]:
        item, score, null, doc = (np.concatenate(x) for x in zip(self.rows, *self.later, strict=True))
        order = np.lexsort((doc, null, -score, item))
        item = item[order]
        first = np.searchsorted(item, np.arange(len(self.least)))
        rank = np.arange(len(item)) - first[item]
        stays = order[rank < self.nearest]
        last = rank == self.nearest - 1
        self.least[item[last]] = score[order[last]]
        self.rows = [item[rank < self.nearest], score[stays], null[stays], doc[stays]]
        self.later, self.waiting = [], 0
        return self.rows


def _scored(posted: DataFrame, sharing: Sharing, weights: list[int], ids: list[int | None], documents: int, terms: int, nearest: int) -> DataFrame:
    """item_id, doc_id, score: each task's best documents of every item."""
    step = max(1, CELLS // (sharing.terms + len(sharing.sets)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, w = _Best(len(ids), nearest), np.array(weights, np.int64)
        for batch in batches:
            for part in (batch.slice(i, step) for i in range(0, batch.num_rows, step)):
                sizes = np.diff(part["terms"].offsets.to_numpy())
                doc = np.repeat(np.arange(part.num_rows), sizes)
                term, times = part["terms"].flatten().to_numpy(), part["times"].flatten().to_numpy().astype(np.int64)
                m = 100 - 50 + (50 * part["n"].to_numpy() * documents) // terms
                numbers = np.zeros((sharing.terms, part.num_rows), np.int64)
                numbers[term, doc] = w[term] * ((1_000_000_000 * times) // (1000 * times + 20 * m[doc]))
                doc_ids = part["doc_id"]
                best.see(evaluated(sharing, numbers), doc_ids.fill_null(0).to_numpy(), doc_ids.is_null().to_numpy(zero_copy_only=False))
        item, score, null, doc = best.settle()
        columns = [pa.array(ids, pa.int64()).take(pa.array(item)), pa.array(doc, pa.int64(), mask=null.astype(bool)), pa.array(score, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["item_id", "doc_id", "score"])

    return on_workers(posted).mapInArrow(run, "item_id long, doc_id long, score long")


def _block(docs: DataFrame, pairs: DataFrame, nearest: int) -> DataFrame | None:
    """Each task's best documents of the items of one block."""
    own = defaultdict(list)
    for r in pairs.collect():  # bounded by the block
        own[r.item_id].append(r.term)
    ids = sorted(own, key=lambda i: (i is None, i or 0))
    vocabulary = sorted({t for terms in own.values() for t in terms})
    if not vocabulary:
        return None
    place = {t: k for k, t in enumerate(vocabulary)}
    posted = stash(postings(docs, vocabulary), "search-postings")
    documents, terms = posted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    if not terms:
        return None
    weights = [weight(documents, n) for n in _holding(posted, len(vocabulary))]
    sharing = shared_sums([[place[t] for t in own[i]] for i in ids], len(vocabulary))
    return stash(_scored(posted, sharing, weights, ids, documents, terms, nearest), "search-best")


def search(docs: DataFrame, items: DataFrame, nearest: int = NEAREST, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``nearest`` best documents of every item."""
    pairs = stash(terms_of(items), "search-terms")
    blocks = max(1, -(-pairs.count() // block_terms))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    found = None
    for k in range(blocks):
        best = _block(docs, pairs.filter(block == k), nearest)
        if best is not None:
            found = best if found is None else found.unionByName(best)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    sliced = found.withColumn("__slice", F.pmod(F.xxhash64("doc_id"), F.lit(16)))
    for keys in (["item_id", "__slice"], ["item_id"]):
        sliced = sliced.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= nearest)
    return sliced.select("item_id", "rank", "doc_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
