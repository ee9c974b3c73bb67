"""MinHash near-duplicates with sequential Bayesian verification.

1. Every text becomes the set of its 5-word shingles (64-bit hashes). Texts of equal sets form a
   class; only one member of a class, its representative, goes on.
2. Banding: 32 bands of 5 MinHash values. At the threshold 0.85 a pair shares no band with a
   probability of 7e-9, at 0.80 (the pipeline's threshold) with 3e-6. Buckets of one class go at
   once.
3. Candidates of a bucket are first compared with its centre only, the member that shares most
   buckets with others: one pair a member, so a group of thousands of near copies of one text
   becomes one component after a linear number of pairs.
4. Buckets that still span several components are compared in full, in cells of bounded size,
   except pairs inside one component, whose links could join nothing.
5. A comparison is sequential: signatures are read in batches of 16 values; after each batch a
   pair goes when the posterior probability of a similarity of at least the threshold, from a
   uniform prior and the matches so far, is below the miss probability. Survivors are verified on
   full shingle sets: 100 * intersection >= threshold * union, exactly. A cell returns the verified
   links that join components, not all pairs.
6. Links, and the classes that share a doc_id, become components: every class takes the smallest
   number around it, until none changes; the component's id is the smallest doc_id in it.

Texts are read twice, once for the bands and once for signatures and sets of the documents that
share a bucket with another.

Defined cases: a null, empty or blank text has the empty set and is linked with nothing, its own
component; a text of fewer than five words has its whole sequence as one shingle; a text of any length
is compared by its full set; ties for a bucket's centre go to the smaller number; rows that
repeat a doc_id with different sets are compared each by its own and share one component (but
for empty sets); null doc_ids are returned with a null component and not kept; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import ctypes
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tavola.llm._shared import on_workers, stash, table
from tavola.operators.joins import broadcast_if_small

SHINGLE = 5
SIMILAR = 85  # per cent
BANDS, BAND_ROWS = 32, 5
HASHES = BANDS * BAND_ROWS
BATCH = 16
#: A pair goes when its similarity is this unlikely to reach the threshold.
MISS = 1e-7
#: Classes on each side of a cell, and their shingles (8 bytes each) unless one text has more.
CELL = 512
CELL_SHINGLES = 4_000_000
#: Documents whose shingles are hashed together, and words of a memo.
CHUNK = 256
WORD_MEMO = 250_000

_rng = np.random.default_rng(20240)
_XOR = _rng.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32)
_ODD = _rng.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)

# ---------------------------------------------------------------- shingles and signatures


class _Words(dict):
    """64-bit hash by word, of bounded length."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= WORD_MEMO:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


@lru_cache(maxsize=1)
def _words() -> _Words:
    return _Words()


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values, so that their low halves are as good as any."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles."""
    memo = _words()
    split = [(t or "").encode().lower().split() for t in texts]
    counts = np.array([len(w) for w in split])
    values = np.fromiter((memo[w] for ws in split for w in ws), np.uint64, int(counts.sum()))
    ends = np.cumsum(counts)
    rolled = _rolled(values)
    out = []
    for n, end in zip(counts, ends, strict=True):
        if n >= SHINGLE:
            own = rolled[end - n : end - SHINGLE + 1].copy()
            own.sort()
            keep = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            out.append(own[keep])
        elif n:
            whole = np.array([n], np.uint64)
            for k in range(end - n, end):
                whole = whole * _STEP + values[k : k + 1]
            out.append(_mixed(whole))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _rolled(values: np.ndarray) -> np.ndarray:
    """The hash of the SHINGLE values from each place on (the last places hold none)."""
    if len(values) < SHINGLE:
        return values
    n = len(values) - SHINGLE + 1
    acc = values[:n].copy()
    for k in range(1, SHINGLE):
        acc *= _STEP
        acc += values[k : n + k]
    return _mixed(acc)


def _digest(shingles: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(shingles.tobytes())


def signature(shingles: np.ndarray) -> np.ndarray:
    """HASHES MinHash values of a non-empty set."""
    low = shingles.astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 256):
        np.minimum(out, ((low[i : i + 256, None] ^ _XOR) * _ODD).min(0), out=out)
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    bands = signatures.reshape(-1, BANDS, BAND_ROWS).astype(np.uint64)
    acc = np.arange(BANDS, dtype=np.uint64)[None, :] + np.uint64(1)
    for k in range(BAND_ROWS):
        acc = acc * _STEP + bands[:, :, k]
    return _mixed(acc).view(np.int64)


# ---------------------------------------------------------------- comparison


@lru_cache(maxsize=8)
def least_matches(similar: int = SIMILAR, miss: float = MISS) -> tuple[int, ...]:
    """For 16, 32, ... values read, the fewest matches at which P(similarity >= threshold) is
    still ``miss`` or more. With a uniform prior the posterior after m of n matches is
    Beta(m + 1, n - m + 1), and its upper tail at s is the chance of at most m successes in n + 1
    trials of probability s."""
    s = similar / 100
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, 0
        while True:
            tail += math.comb(n + 1, m) * s**m * (1 - s) ** (n + 1 - m)
            if tail >= miss:
                break
            m += 1
        out.append(m)
    return tuple(out)


def surviving_pairs(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, similar: int = SIMILAR) -> np.ndarray:
    """Which pairs (a[i], b[j]) of signatures survive all batches."""
    alive = np.arange(len(i))
    matches = np.zeros(len(i), np.int32)
    for k, least in enumerate(least_matches(similar)):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches + (a[i[alive], part] == b[j[alive], part]).sum(1)
        keep = matches >= least
        alive, matches = alive[keep], matches[keep]
        if not len(alive):
            break
    return alive


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def _all_common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all sets ``left`` with all sets ``right``: a product of 0-1
    matrices over the shingles that occur twice or more, ``width`` of them at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    twice = counts >= 2
    place = np.cumsum(twice) - 1
    own = twice[column]
    owner, column = owner[own], place[column[own]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int(twice.sum()), width):
        a, b = np.searchsorted(column, [start, start + width])
        block = np.zeros((len(sets), width), np.float32)
        block[owner[a:b], column[a:b] - start] = 1
        out += block[left] @ block[right].T
    return out.astype(np.int64)


#: From so many surviving pairs on, a cell's intersections are counted together.
TOGETHER = 2000


def verified_links(
    ids: np.ndarray, comps: np.ndarray, sizes: np.ndarray, signatures: np.ndarray, sets: list[np.ndarray],
    left: np.ndarray, right: np.ndarray, similar: int = SIMILAR,
) -> list[tuple[int, int]]:
    """Links among places ``left`` x ``right`` that join components, likeliest pairs first."""
    parent = {int(c): int(c) for c in np.unique(comps)}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    i, j = np.repeat(left, len(right)), np.tile(right, len(left))
    small, large = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
    fit = (comps[i] != comps[j]) & (100 * small >= similar * large)
    i, j = i[fit], j[fit]
    alive = surviving_pairs(signatures, signatures, i, j, similar)
    i, j = i[alive], j[alive]
    if len(i) >= TOGETHER:
        counts = _all_common(sets, left, right)
        rows, columns = np.full(len(ids), -1), np.full(len(ids), -1)
        rows[left], columns[right] = np.arange(len(left)), np.arange(len(right))
        common = counts[rows[i], columns[j]]
        linked = 100 * common >= similar * (sizes[i] + sizes[j] - common)
        i, j = i[linked], j[linked]
    else:
        linked = None
    order = np.argsort(-(signatures[i] == signatures[j]).sum(1), kind="stable") if len(i) else np.zeros(0, int)
    links = []
    for p, q in zip(i[order].tolist(), j[order].tolist(), strict=True):
        cp, cq = root(int(comps[p])), root(int(comps[q]))
        if cp == cq:
            continue
        if linked is None:
            common = _common(sets[p], sets[q])
            if 100 * common < similar * (len(sets[p]) + len(sets[q]) - common):
                continue
        parent[max(cp, cq)] = min(cp, cq)
        links.append((int(ids[p]), int(ids[q])))
    return links


# ---------------------------------------------------------------- on tables


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from (b.slice(i, CHUNK) for b in batches for i in range(0, b.num_rows, CHUNK))
    _words.cache_clear()
    _give_back()


def _give_back() -> None:
    """Freed memory goes back to the system: the worker process lives on for other steps."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def banded(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, h1 and h2 (a 128-bit hash of the set), bands (null for no shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _chunks(batches):
            sets = shingle_sets(b["text"].to_pylist())
            halves = np.frombuffer(b"".join(map(_digest, sets)), "<i8").reshape(-1, 2)
            bands = [band_keys(signature(s))[0] if len(s) else None for s in sets]
            columns = [
                b["doc_id"], pa.array([len(s) for s in sets], pa.int64()), pa.array(halves[:, 0].copy()),
                pa.array(halves[:, 1].copy()), pa.array(bands, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "h1", "h2", "bands"])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return on_workers(read).mapInArrow(run, "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, repeated: DataFrame | None) -> DataFrame:
    """id, sig and shingles (both as bytes) of the classes in ``wanted`` (id, doc_id, h1, h2). Of
    the ids in ``repeated`` any row may hold the class, or several rows may."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _chunks(batches):
            sets = shingle_sets(b["text"].to_pylist())
            halves = np.frombuffer(b"".join(map(_digest, sets)), "<i8").reshape(-1, 2)
            columns = [
                b["doc_id"], pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()),
                pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "h1", "h2", "sig", "shingles"])

    def run_known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _chunks(batches):
            sets = shingle_sets(b["text"].to_pylist())
            halves = [np.frombuffer(_digest(s), "<i8").tolist() for s in sets]
            same = [h == [x, y] for h, x, y in zip(halves, b["h1"].to_pylist(), b["h2"].to_pylist(), strict=True)]
            sets = [s for s, keep in zip(sets, same, strict=True) if keep]
            sig = pa.array([signature(s).tobytes() for s in sets], pa.binary())
            columns = [b["id"].filter(pa.array(same)), sig, pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "sig", "shingles"])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    wanted = wanted.select("id", "doc_id", "h1", "h2")
    once = wanted if repeated is None else wanted.join(broadcast_if_small(repeated), "doc_id", "left_anti")
    known = on_workers(read.join(broadcast_if_small(once), "doc_id"))
    known = known.select("id", "text", "h1", "h2").mapInArrow(run_known, "id long, sig binary, shingles binary")
    if repeated is None:
        return known
    often = stash(wanted.join(broadcast_if_small(repeated), "doc_id", "left_semi"), "wanted-repeated")
    rows = on_workers(read.join(broadcast_if_small(often.select("doc_id").distinct()), "doc_id", "left_semi"))
    rows = rows.mapInArrow(run, "doc_id long, h1 long, h2 long, sig binary, shingles binary")
    rows = rows.join(broadcast_if_small(often), ["doc_id", "h1", "h2"])
    return known.unionByName(rows.groupBy("id").agg(F.first("sig").alias("sig"), F.first("shingles").alias("shingles")))


def _verify(similar: int):
    """A cell's rows (id, comp, side, sig, shingles) to its links. Side 0 and 1 are compared with
    each other, side 2 with itself."""

    def run(cell: pa.Table) -> pa.Table:
        ids, comps, side = (np.array(cell[k]) for k in ("id", "comp", "side"))
        signatures = np.frombuffer(b"".join(cell["sig"].to_pylist()), np.uint32).reshape(-1, HASHES)
        sets = [np.frombuffer(s, "<u8") for s in cell["shingles"].to_pylist()]
        sizes = np.array([len(s) for s in sets])
        if (side == 2).all():
            left = right = np.arange(len(ids))
        else:
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        links = verified_links(ids, comps, sizes, signatures, sets, left, right, similar)
        if sizes.sum() > CELL_SHINGLES // 8:
            _give_back()
        return pa.table([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["u", "v"])

    return run


def components(links: DataFrame) -> DataFrame:
    """id and comp (the smallest id reachable over ``links`` u, v) of the linked nodes."""
    links = stash(links.select("u", "v").union(links.select(F.col("v"), F.col("u"))).distinct(), "links")
    state = stash(links.groupBy(F.col("u").alias("id")).agg(F.least(F.first("u"), F.min("v")).alias("comp")), "comps")
    while True:
        # the smallest component around a node, then that component's own component
        around = links.join(state, links["v"] == state["id"]).groupBy("u").agg(F.min("comp").alias("low"))
        new = state.join(around, state["id"] == around["u"], "left").select(
            "id", F.col("comp").alias("old"), F.least("comp", F.coalesce("low", "comp")).alias("mid")
        )
        new = stash(new, "comps")
        far = new.select(F.col("id").alias("of"), F.col("mid").alias("far"))
        state = new.join(far, new["mid"] == far["of"], "left").select("id", "old", F.least("mid", F.coalesce("far", "mid")).alias("comp"))
        state = stash(state, "comps")
        if state.filter("comp <> old").isEmpty():
            return state.select("id", "comp")
        state = state.select("id", "comp")


def _with_comps(members: DataFrame, comps: DataFrame | None) -> DataFrame:
    if comps is None:
        return members.withColumn("comp", F.col("id"))
    known = comps.select(F.col("id").alias("of"), "comp")
    joined = members.join(known, members["id"] == known["of"], "left")
    return joined.select(*members.columns, F.coalesce("comp", "id").alias("comp"))


def same_id(exact: DataFrame, classes: DataFrame, repeated: DataFrame) -> DataFrame:
    """Links u, v between the classes of every doc_id in ``repeated``."""
    rows = exact.join(broadcast_if_small(repeated), "doc_id", "left_semi").select("doc_id", "h1", "h2").distinct()
    of = stash(rows.join(classes.select("h1", "h2", "id"), ["h1", "h2"]).select("doc_id", "id"), "classes-of-ids")
    first = stash(of.groupBy("doc_id").agg(F.min("id").alias("u")), "first-classes")
    return of.join(broadcast_if_small(first), "doc_id").filter("id <> u").select("u", F.col("id").alias("v"))


def near_duplicates(docs: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    bands = stash(banded(docs), "bands")
    exact = bands.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    rep = exact.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
    )
    # any distinct numbers do: the result does not depend on them, and written they stay
    nodes = rep = stash(rep.withColumn("id", F.monotonically_increasing_id()), "classes")
    repeated = exact.groupBy("doc_id").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    repeated = stash(repeated.select("doc_id"), "repeated-ids")
    repeated = None if repeated.isEmpty() else repeated

    # buckets of two classes or more; those of the same members are one
    rows = nodes.select(F.explode("bands").alias("key"), "id")
    sums = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("m"), F.min("id").alias("low"), F.max("id").alias("high"), F.bit_xor(F.xxhash64("id")).alias("of")
    ).filter("m > 1")
    buckets = stash(sums.groupBy("m", "low", "high", "of").agg(F.min("key").alias("key")).select("key", "m"), "buckets")
    members = stash(rows.join(broadcast_if_small(buckets), "key").select("key", "m", "id"), "members")
    weights = members.groupBy("id").agg(F.sum("m").alias("weight"))
    wanted = stash(weights.join(nodes.select("id", "doc_id", "h1", "h2", "n"), "id"), "wanted")
    sets = stash(full_sets(docs, wanted, repeated), "sets")

    # every member against its bucket's centre; the buckets of one centre are one group
    weighed = members.join(broadcast_if_small(wanted.select("id", "weight")), "id")
    lengths = broadcast_if_small(wanted.select("id", "n"))
    centre = weighed.groupBy("key").agg(F.max(F.struct("weight", (-F.col("id")).alias("minus"))).alias("top"))
    centre = stash(centre.select("key", (-F.col("top.minus")).alias("centre")), "centres")
    pairs = members.join(broadcast_if_small(centre), "key").filter("id <> centre").select("centre", "id").distinct()
    pairs = stash(pairs.join(lengths, "id").select("centre", "id", "n"), "pairs")
    sizes = stash(pairs.groupBy("centre").agg(F.count(F.lit(1)).alias("others"), F.sum("n").alias("shingles")), "groups")
    blocks_of = lambda count, shingles: F.ceil(F.greatest(F.col(count) / CELL, F.col(shingles) / CELL_SHINGLES)).cast("int")
    cells = blocks_of("others", "shingles")
    rest = pairs.join(broadcast_if_small(sizes), "centre")
    rest = rest.select("centre", F.pmod(F.xxhash64("id"), cells).cast("int").alias("cell"), "id", F.lit(1).alias("side"))
    heads = sizes.select("centre", F.explode(F.sequence(F.lit(0), cells - 1)).alias("cell"), F.col("centre").alias("id"), F.lit(0).alias("side"))
    rest = rest.unionByName(heads).withColumn("comp", F.col("id"))
    links = on_workers(rest).join(sets, "id").groupBy("centre", "cell").applyInArrow(_verify(similar), "u long, v long")
    links = stash(links, "star-links")
    comps = components(links)

    # groups of three or more that still span components: what is outside a group's largest
    # component against all of the group
    heads = sizes.filter("others > 1").select("centre", F.col("centre").alias("id")).join(lengths, "id").select("centre", "id", "n")
    groups = _with_comps(pairs.unionByName(heads), comps)
    share = groups.groupBy("centre", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    main = share.groupBy("centre").agg(
        F.max(F.struct("c", "comp", "s")).alias("main"), F.sum("c").alias("c"), F.sum("s").alias("s"), F.count(F.lit(1)).alias("parts")
    ).filter("c > 2 AND parts > 1")
    main = main.select(
        "centre", F.col("main.comp").alias("main"), F.col("main.c").alias("main_c"), F.col("main.s").alias("main_s"),
        (F.col("c") - F.col("main.c")).alias("rest_c"), (F.col("s") - F.col("main.s")).alias("rest_s"),
    )
    main = stash(main, "open-groups")
    blocked = groups.join(broadcast_if_small(main), "centre")
    inside = F.col("comp") == F.col("main")
    main_blocks, rest_blocks = blocks_of("main_c", "main_s"), blocks_of("rest_c", "rest_s")
    many = F.when(inside, main_blocks).otherwise(rest_blocks)
    blocked = blocked.withColumn("block", F.pmod(F.xxhash64("id"), many).cast("int"))
    pair = lambda a, b, side: F.struct(a.alias("x"), b.alias("y"), side.alias("side"))
    # blocks of the main component are numbered below zero; they meet the other blocks only
    own, rest_of = F.col("block"), F.sequence(F.lit(0), rest_blocks - 1)
    to_rest = F.transform(rest_of, lambda r: pair(r, -own - 1, F.lit(1)))
    to_main = F.transform(F.sequence(F.lit(0), main_blocks - 1), lambda b: pair(own, -b - 1, F.lit(0)))
    to_other = F.transform(
        rest_of, lambda r: pair(F.least(own, r), F.greatest(own, r), F.when(own == r, 2).when(own < r, 0).otherwise(1))
    )
    places = F.when(inside, to_rest).otherwise(F.concat(to_main, to_other))
    cells = blocked.select("centre", "id", "comp", F.explode(places).alias("at")).select("centre", "id", "comp", "at.x", "at.y", "at.side")
    more = on_workers(cells).join(sets, "id").groupBy("centre", "x", "y").applyInArrow(_verify(similar), "u long, v long")
    links = links.unionByName(more)
    if repeated is not None:
        links = links.unionByName(same_id(exact, rep, repeated))
    comps = stash(components(stash(links, "links-all")), "class-numbers")

    # from classes to documents: the smallest doc_id of a component
    lows = comps.join(rep.select("id", "doc_id"), "id").groupBy("comp").agg(F.min("doc_id").alias("low"))
    low = stash(comps.join(broadcast_if_small(stash(lows, "component-ids")), "comp").select("id", "low"), "class-ids")
    rep_comp = rep.select("h1", "h2", "id", "doc_id").join(low, "id", "left")
    rep_comp = stash(rep_comp.select("h1", "h2", F.coalesce("low", "doc_id").alias("comp")), "class-comps")
    slim = bands.select("doc_id", "n_shingles", "h1", "h2")
    full = slim.filter("n_shingles > 0 AND doc_id IS NOT NULL").join(rep_comp, ["h1", "h2"]).select("doc_id", "n_shingles", "comp")
    empty = slim.filter("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("comp"))
    out = full.unionByName(empty)
    return out.select(
        "doc_id", "n_shingles", F.col("comp").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("comp"), F.lit(False)).alias("kept")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
