"""Phrase collocation mining: n-grams counted in quotient filters that are merged across shards.

Texts are cut into chunks of a bounded size that hold one language each. A chunk is written as the
sequence of its words' numbers and as its distinct words with their counts, cut by hash. Words that
occur ``min_count`` times or more in their language get global ids. Then, for orders 2 to
``longest``, a chunk packs its n-grams of global ids into permuted keys and makes a counting
quotient filter of them (``quotient_filter``); the blocks of one shard are merged over all chunks,
n-grams of ``min_count`` or more stay, and each chunk gets one bit an entry back: whether it stayed.
What is left of a chunk are the places where two such n-grams overlap in all but one word, since
an n-gram cannot be more frequent than its parts. So all counts are exact, and no order is dropped.

Numbers of shards follow the size of the corpus, so that the filters of a shard, like the words of
a hash range, fit a task. A word or n-gram of any frequency has one entry a chunk. Nothing is
broadcast and nothing but sums reaches the driver.

A candidate is scored at its worst cut, dropped if its words lie inside a longer candidate that is
nearly as frequent, and the best of each language stay. Selection runs in two levels, first inside
slices of a language.

Defined cases: a null text is empty; a null lang counts as ``und``; words are maximal runs without
space and tab, and no phrase reaches over a mark or line end; every row counts, repeated rows and
rows without doc_id too; a text of any length stays whole in its chunk; an empty table gives an empty
result; ties in score and count are broken by the phrase; columns other than text and lang are not
read. Word ids must stay below 2**32.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tavola.llm import quotient_filter as Q
from tavola.llm._shared import on_workers, stash, table, whole_text

MIN_COUNT = 30
LONGEST = 4
MOST = 2_000
#: A candidate goes if a longer one around it has this many per cent of its count.
INSIDE_PER_CENT = 80
SCALE = 2_000_000
#: Bytes of text of a chunk; characters whose distinct words a hash range takes; places of n-grams
#: whose filter entries a shard takes.
CHUNK_BYTES = 12 << 20
RANGE_CHARS = 32 << 20
SHARD_PLACES = 1 << 21

_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_LEVEL = "chunk long, lang string, part long, words long, places long, sequence binary, ranges binary, entries binary, counts binary"


def _deflated(a: np.ndarray) -> bytes:
    """Byte planes of an unsigned 32-bit array, compressed, with its length in front."""
    planes = np.ascontiguousarray(a, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(a).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _inflated(b: bytes) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    planes = pa.decompress(b[8:], 4 * n, "zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(4, n).T.copy().view("<u4").ravel()


def _words(text: bytes) -> tuple[pa.Array, np.ndarray]:
    """The words of ``text`` in lower case, and whether each begins a piece."""
    a = np.frombuffer(text, np.uint8)
    kind = _KIND[a]
    inside = np.zeros(len(a) + 2, np.int8)
    inside[1:-1] = kind == 0
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    piece = np.searchsorted(np.flatnonzero(kind == 2), starts)
    letters = _LOWER[a[kind == 0]]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return words, np.diff(piece, prepend=-1) != 0


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ["chunk", "lang", "part", "words", "places", "sequence", "ranges", "entries", "counts"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _chunk(chunk: int, lang: str, texts: list[bytes], ranges: int) -> Iterator[pa.RecordBatch]:
    """The sequence row of a chunk (word numbers by falling count, 0 between pieces) and a row for
    each hash range with its distinct words and their counts."""
    words, begins = _words(b"\n".join(texts))
    if not len(words):
        return
    coded = words.dictionary_encode()
    at = coded.indices.to_numpy()
    counts = np.bincount(at)
    by_count = np.argsort(-counts, kind="stable")
    number = np.empty(len(counts), np.uint32)
    number[by_count] = np.arange(1, len(counts) + 1)
    place = np.arange(len(at)) + np.cumsum(begins) - 1
    sequence = np.zeros(place[-1] + 1, np.uint32)
    sequence[place] = number[at]
    distinct = coded.dictionary.take(pa.array(by_count)).to_pylist()
    counts = counts[by_count]
    # a word's range depends on the word alone
    hashed = pd.util.hash_array(np.array([w.decode("latin-1") for w in distinct], object), categorize=False)
    part = (hashed % np.uint64(ranges)).astype(np.uint32)
    yield _rows([(chunk, lang, None, len(at), len(at), _deflated(sequence), _deflated(part), None, None)])
    order = np.argsort(part, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
        entries = b"\n".join([distinct[i] for i in own])
        yield _rows([(chunk, lang, int(part[own[0]]), None, None, None, None, entries, counts[own].astype("<u4").tobytes())])


def _to_chunks(batches: Iterator[pa.RecordBatch], ranges: int, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    total = 0
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist(), strict=True):
            held.setdefault(lang, []).append(text)
            size[lang] = size.get(lang, 0) + len(text) + 1
            total += len(text) + 1
            if size[lang] >= chunk_bytes or total >= 2 * chunk_bytes:
                full = max(size, key=size.get)
                total -= size.pop(full)
                yield from _chunk(number, full, held.pop(full), ranges)
                number += 1
    for lang, texts in held.items():
        yield from _chunk(number, lang, texts, ranges)
        number += 1


def _frequent_words(t: pa.Table, min_count: int, ranges: int) -> pa.Table:
    """Of the words of one hash range: their ids, and for each chunk the ids of its words there."""
    chunks, langs = t["chunk"].to_pylist(), t["lang"].to_pylist()
    part = t["part"][0].as_py()
    lists = [x.split(b"\n") for x in t["entries"].to_pylist()]
    counts = np.concatenate([np.frombuffer(x, "<u4") for x in t["counts"].to_pylist()]).astype(np.int64)
    sizes = np.array([len(x) for x in lists])
    word = pa.array([w for x in lists for w in x], pa.large_binary()).dictionary_encode()
    kinds = {x: i for i, x in enumerate(sorted(set(langs)))}
    lang = np.repeat([kinds[x] for x in langs], sizes)
    pair = lang * len(word.dictionary) + word.indices.to_numpy().astype(np.int64)
    found, at = np.unique(pair, return_inverse=True)
    totals = np.bincount(at, counts, len(found)).astype(np.int64)  # exact below 2**53
    stays = totals >= min_count
    # ids of a range leave the ranges' number free between them, so ids of two ranges differ
    ids = np.where(stays, np.cumsum(stays) * ranges + part, 0)
    names = word.dictionary.take(pa.array(found[stays] % len(word.dictionary))).cast(pa.large_string()).cast(pa.string())
    langs_of = sorted(kinds)
    own = np.split(ids[at].astype("<u8"), np.cumsum(sizes)[:-1])
    n, m = int(stays.sum()), len(chunks)
    return pa.table(
        {
            "chunk": pa.array([None] * n + chunks, pa.int64()),
            "part": pa.array([part] * (n + m), pa.int64()),
            "lang": pa.array([langs_of[k] for k in found[stays] // len(word.dictionary)] + [None] * m, pa.string()),
            "word": pa.chunked_array([names, pa.nulls(m, pa.string())]).combine_chunks(),
            "ids": pa.array([[i] for i in ids[stays].tolist()] + [None] * m, pa.list_(pa.int64())),
            "f": pa.array(totals[stays].tolist() + [None] * m, pa.int64()),
            "kept": pa.array([None] * n + [x.tobytes() for x in own], pa.binary()),
        }
    )


_MERGED = "chunk long, part long, lang string, word string, ids array<long>, f long, kept binary"


def _frequent_grams(t: pa.Table, order: int, word_bits: int, min_count: int) -> pa.Table:
    """Of the n-grams of one shard: those that are frequent, and for each chunk a bit for each of
    its entries there."""
    packing = Q.Packing(order, word_bits)
    shard = t["part"][0].as_py()
    chunks = t["chunk"].to_pylist()
    keys, totals, places = Q.merged([Q.read_block(packing, shard, x.as_py()) for x in t["entries"]])
    stays = totals >= min_count
    grams = packing.grams(keys[stays])
    n, m = len(grams), len(chunks)
    offsets = pa.array(np.append(np.arange(0, n * order, order), np.full(m + 1, n * order)), pa.int32())
    nothing = pa.array(np.arange(n + m) >= n)
    return pa.table(
        {
            "chunk": pa.array([None] * n + chunks, pa.int64()),
            "part": pa.array([shard] * (n + m), pa.int64()),
            "lang": pa.nulls(n + m, pa.string()),
            "word": pa.nulls(n + m, pa.string()),
            "ids": pa.ListArray.from_arrays(offsets, pa.array(grams.ravel()), mask=nothing),
            "f": pa.array(totals[stays].tolist() + [None] * m, pa.int64()),
            "kept": pa.array([None] * n + [np.packbits(stays[x]).tobytes() for x in places], pa.binary()),
        }
    )


def _grams(sequence: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Where an n-gram begins (no 0 inside), and these n-grams, one a row."""
    n = len(sequence) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros((0, order), np.uint32)
    whole = np.ones(n, bool)
    for k in range(order):
        whole &= sequence[k : n + k] != 0
    at = np.flatnonzero(whole)
    return at, np.stack([sequence[at + k] for k in range(order)], 1)


def _overlapping(sequence: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """The words of the runs of two or more n-grams (beginning at ``at``) that follow each other,
    0 between runs."""
    if not len(at):
        return sequence[:0]
    first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    runs = np.diff(np.append(first, len(at)))
    first, runs = at[first[runs > 1]], runs[runs > 1]
    sizes = runs + order  # the words of the run, and a 0
    ends = np.cumsum(sizes)
    if not len(ends):
        return sequence[:0]
    place = np.arange(ends[-1]) - np.repeat(ends - sizes - first, sizes)
    place[ends - 1] = 0
    out = sequence[place]
    out[ends - 1] = 0
    return out


def _next_level(own: pa.Table, back: pa.Table, order: int, word_bits: int, before: int, shard_bits: int) -> pa.Table:
    """Rows of the next order of one chunk, from its sequence and what came back of its entries;
    ``before`` and ``word_bits`` describe the shards that these were counted in."""
    sequence = _inflated(own["sequence"][0].as_py())
    chunk, lang = own["chunk"][0].as_py(), own["lang"][0].as_py()
    if order == 2:
        part = _inflated(own["ranges"][0].as_py())
        ids = np.zeros(len(part) + 1, np.uint32)
        kept = dict(zip(back["part"].to_pylist(), back["kept"].to_pylist(), strict=True))
        by_part = np.argsort(part, kind="stable")
        ids[by_part + 1] = np.concatenate([np.frombuffer(kept[p], "<u8") for p in sorted(kept)])
        sequence = ids[sequence]
        sequence = sequence[(sequence != 0) | (np.append(0, sequence[:-1]) != 0)]
    else:
        packing = Q.Packing(order - 1, word_bits)
        at, grams = _grams(sequence, order - 1)
        keys = packing.keys(grams)
        distinct = keys.sorted()
        distinct = distinct[distinct.firsts()]
        shards = distinct.top(packing.bits - before).astype(np.int64)
        names, sizes = np.unique(shards, return_counts=True)
        kept = dict(zip(back["part"].to_pylist(), back["kept"].to_pylist(), strict=True))
        stays = np.concatenate([np.unpackbits(np.frombuffer(kept[p], np.uint8), count=n) for p, n in zip(names.tolist(), sizes.tolist(), strict=True)])
        sequence = _overlapping(sequence, at[keys.found_in(distinct[stays.astype(bool)])], order - 1)
    packing = Q.Packing(order, word_bits)
    at, grams = _grams(sequence, order)
    rows = []
    if len(at):
        keys, counts = Q.counted(packing.keys(grams))
        rows.append((chunk, lang, None, None, len(at), _deflated(sequence), None, None, None))
        rows += [(chunk, lang, s, None, None, None, None, b, None) for s, b in Q.blocks(packing, keys, counts, shard_bits)]
    return pa.Table.from_batches([_rows(rows)])


def _steps(order: int, word_bits: int, min_count: int, before: int, shard_bits: int):
    """The two functions of an order."""
    return (
        lambda own, back: _next_level(own, back, order, word_bits, before, shard_bits),
        lambda t: _frequent_grams(t, order, word_bits, min_count),
    )


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words, phrases, totals): lang, word, ids, f of every word of ``min_count`` or more; ids, f of every
    such phrase of 2 to ``longest`` words; lang, n (all word occurrences)."""
    spark = docs.sparkSession
    source = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), whole_text().alias("text"))
    chars = source.agg(F.sum(F.length("text"))).first()[0] or 0
    ranges = max(1, -(-chars // RANGE_CHARS))
    level = stash(on_workers(source).mapInArrow(partial(_to_chunks, ranges=ranges, chunk_bytes=chunk_bytes), _LEVEL), "phrase-words")
    totals = level.filter("sequence IS NOT NULL").groupBy("lang").agg(F.sum("words").alias("n"))
    blocks = level.filter("entries IS NOT NULL").select("chunk", "lang", "part", "entries", "counts")
    merge = lambda t: _frequent_words(t, min_count, ranges)
    merged = stash(blocks.groupBy("part").applyInArrow(merge, _MERGED), "phrase-word-ids")
    words = merged.filter("f IS NOT NULL").select("lang", "word", "ids", "f")
    places, highest = words.agg(F.sum("f"), F.max(F.col("ids")[0])).first()
    word_bits = max(1, int(highest or 0).bit_length())
    if word_bits > 32:
        raise ValueError("more than 2**32 word ids")
    phrases, before = None, 0
    for order in range(2, longest + 1):
        shard_bits = min(2 * word_bits, max(0, (-(-(places or 0) // SHARD_PLACES) - 1).bit_length()))
        step, merge = _steps(order, word_bits, min_count, before, shard_bits)
        own = level.filter("sequence IS NOT NULL").select("chunk", "lang", "sequence", "ranges")
        back = merged.filter("kept IS NOT NULL").select("chunk", "part", "kept")
        level = stash(own.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(step, _LEVEL), f"phrase-filters-{order}")
        blocks = level.filter("entries IS NOT NULL").select("chunk", "part", "entries")
        merged = stash(blocks.groupBy("part").applyInArrow(merge, _MERGED), f"phrase-counts-{order}")
        found = merged.filter("f IS NOT NULL").select("ids", "f")
        phrases = found if phrases is None else phrases.unionByName(found)
        places, before = found.agg(F.sum("f")).first()[0], shard_bits
    if phrases is None:
        phrases = spark.createDataFrame([], "ids array<long>, f long")
    return words, phrases, totals


def _best(scored: DataFrame, most: int) -> DataFrame:
    """The best ``most`` rows of every language: first of every slice of it, then of these."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    sliced = scored.withColumn("__slice", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    for keys in (["lang", "__slice"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        sliced = sliced.withColumn("rank", rank).filter(F.col("rank") <= most)
    return sliced.drop("__slice")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, most: int = MOST, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the best phrases of every language."""
    words, phrases, totals = frequent_phrases(docs, min_count, longest, chunk_bytes)
    whole = DecimalType(38, 0)
    # a candidate's own count against those of the candidates around it
    inner = F.filter(
        F.flatten(F.transform(F.sequence(F.lit(2), F.lit(longest - 1)), lambda n: F.transform(
            F.sequence(F.lit(1), F.greatest(F.size("ids") - n + 1, F.lit(1))), lambda k: F.slice("ids", k, n)
        ))), lambda x: (F.size(x) >= 2) & (F.size(x) < F.size("ids")),
    ) if longest > 2 else F.array().cast("array<array<bigint>>")
    around = phrases.select(F.explode(F.array_distinct(inner)).alias("ids"), "f").groupBy("ids").agg(F.max("f").alias("__longer"))
    held = F.col("__longer").cast(whole) * 100 >= F.col("a").cast(whole) * INSIDE_PER_CENT
    candidates = phrases.withColumnRenamed("f", "a").join(around, "ids", "left").filter(~F.coalesce(held, F.lit(False))).select("ids", "a")
    # every cut, with the counts of its two parts
    parts = words.select("ids", "f").unionByName(phrases)
    cuts = candidates.select("ids", "a", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cuts = cuts.select("*", F.slice("ids", F.lit(1), F.col("k")).alias("left"), F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")).alias("right"))
    cuts = cuts.join(parts.select(F.col("ids").alias("left"), F.col("f").alias("l")), "left")
    cuts = cuts.join(parts.select(F.col("ids").alias("right"), F.col("f").alias("r")), "right")
    score = F.expr(f"CAST({SCALE} AS DECIMAL(10,0)) * CAST(a AS DECIMAL(19,0)) div (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))")
    worst = cuts.groupBy("ids", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    # ids to words
    spelled = worst.select("ids", "a", "cut", F.posexplode("ids").alias("pos", "id")).join(
        words.select(F.col("ids")[0].alias("id"), "lang", "word"), "id"
    )
    phrase = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]), " ")
    spelled = spelled.groupBy("ids", "a", "cut").agg(F.first("lang").alias("lang"), phrase.alias("phrase"))
    best = _best(spelled.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), most)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
