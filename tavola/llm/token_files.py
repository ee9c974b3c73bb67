"""Token files: frequency-ranked ids in byte-aligned variable-length coding.

Format. A token file is a table of blocks in ascending (part, block) order. A block holds the
ids of consecutive documents in ascending doc_id order:

- ``doc_ids``, ``lengths``: the documents and their numbers of ids, as 64-bit integers (a null
  doc_id is told apart by ``nulls``, one byte a document);
- ``control``: two bits an id, four ids a byte, lowest bits first: its data bytes less one;
- ``data``: the 1 to 4 low bytes of each id's rank.

The rank of an id is its place by falling frequency over all documents, ties by smaller id, so
the most frequent 256 ids take one byte. The rank table is written beside the blocks. Control
bytes stand apart from the data, so decoding is free of branches: a 256-row table turns control
bytes into lengths, their running sum gives each id's place in the data, and four masked
gathers build the ranks.

Blocks are rows of Parquet files, so any store that Spark writes to can hold them. A part is a
range of the sorted documents, with bounds taken from the data, so neither an id far from the others
nor many rows without an id make a part long; its blocks are made by one task, and a block ends at
``BLOCK_TOKENS`` ids or, if later, with its document.

The texts are encoded once; their ids stay in the shared folder until they are counted, ranked
and sorted. A word between two blanks or line ends is encoded on its own and remembered, as the
vocabulary drops white space: the words of some megabytes of text are numbered by Arrow, each
distinct one is looked up once, and numpy puts the ids of all words together.

Defined cases: a null or empty text has only the end id; a text of any length is encoded whole, and one
longer than ``CHUNK_BYTES`` by itself; a null doc_id sorts first; rows that repeat a doc_id, or have
none, follow each other by the CRC of the text, equal rows in any order; ids of equal frequency are
ranked by the smaller id; an empty table gives no blocks and an empty result; columns other than
doc_id and text are not read.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tavola.llm._shared import on_workers, stash, table, whole_text
from tavola.operators.joins import broadcast_if_small

END_ID = 2
#: Documents of a part (a range of doc_ids), ids of a block.
PART_DOCS = 4_096
BLOCK_TOKENS = 1_000_000
#: Bytes of text that are encoded at a time.
CHUNK_BYTES = 4 << 20
#: Equal rows go to this many places of the order, so that a part need not hold all of them.
SALTS = 64
#: Entries of a generation of a worker's word memo; longer words are not kept.
WORD_MEMO = 400_000
MEMO_CHARS = 64
#: Signs that are tokens apart from the letters before them.
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

#: Of a byte: 1 an ASCII letter, 2 a sign, 0 anything else.
_KINDS = np.zeros(256, np.uint8)
_KINDS[[*range(65, 91), *range(97, 123)]] = 1
_KINDS[list(SIGNS.encode())] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_LENGTHS = 1 + (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit ranks."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = extra
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ranks that ``pack`` wrote."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    at = np.cumsum(lengths) - lengths
    # three bytes of padding, so that the masked gathers stay inside
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    out = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        long = np.flatnonzero(lengths > k)
        out[long] |= raw[at[long] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if it prints in
    Latin-1, else the next free one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (b for b in range(256) if b not in prints)
    return {b: chr(b) for b in prints} | {b: chr(256 + k) for k, b in enumerate(rest)}


class WordEncoder:
    """Ids of texts by a tokenizers vocabulary that drops white space, composes (NFC) and
    lower-cases, cuts between letters, digits and other signs, and writes bytes as letters.

    A word the memo lacks is taken as its letters, in lower case, and the signs that end it. The
    library's model encodes composed lower-case letters directly, as its normaliser and cutter
    would leave them whole; any other word passes the library's full path."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if size <= 2**16 else np.dtype("<u4")
        self.code = self.dtype.char
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _by_model(self, word: str) -> bytes:
        return array(self.code, [t.id for t in self.model.tokenize(word)]).tobytes()

    def _by_library(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        rest = []
        for w in words:
            if w.isalpha() and w == w.lower() and is_normalized("NFC", w):
                yield w, self._by_model(w.encode().decode("latin-1").translate(self.letters))
            else:
                rest.append(w)
        encoded = self.tokenizer.encode_batch(rest, add_special_tokens=False)
        yield from ((w, array(self.code, e.ids).tobytes()) for w, e in zip(rest, encoded, strict=True))

    def _ids_of(self, words: list[str]) -> list[bytes]:
        """The ids of distinct ``words``."""
        if len(self.memo) > WORD_MEMO:
            self.old, self.memo = self.memo, {}
        memo, old = self.memo, self.old
        out = list(map(memo.get, words))
        parts, places = {}, []
        for at, ids in enumerate(out):
            if ids is not None:
                continue
            w = words[at]
            if (ids := old.get(w)) is not None:
                out[at] = memo[w] = ids
            elif w.isascii() and w.isalpha() and w.islower():
                out[at] = ids = self._by_model(w)
                if len(w) <= MEMO_CHARS:
                    memo[w] = ids
            else:
                places.append(at)
                stem = w.rstrip(SIGNS)
                low = stem.lower()
                # only a capital sigma's lower case depends on its place
                apart = stem.isalpha() and low.isalpha() and "\u03a3" not in stem
                parts[w] = (low, w[len(stem) :]) if apart else (w, "")
        known = {part: memo.get(part) or old.get(part) for pair in parts.values() for part in pair}
        known.update(self._by_library([part for part, ids in known.items() if ids is None]))
        for at in places:
            w = words[at]
            stem, signs = parts[w]
            out[at] = known[stem] + known[signs]
            for key, ids in ((w, out[at]), (stem, known[stem])):
                if len(key) <= MEMO_CHARS:
                    memo[key] = ids
        return out

    def encoded(self, texts: list[bytes], end_id: int) -> pa.Array:
        """The ids of each text (UTF-8) and the end id, as little-endian integers of ``dtype``."""
        a = np.frombuffer(b"\n".join(texts), np.uint8)
        inside = np.zeros(len(a) + 2, np.int8)
        own = (a != 32) & (a != 10)
        inside[1:-1] = own
        edges = np.flatnonzero(np.diff(inside))
        starts, sizes = edges[::2], edges[1::2] - edges[::2]
        text_ends = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))
        letters = a[own]
        ends = np.cumsum(sizes)
        # most words are ASCII letters and then signs: these two are encoded apart, in lower case
        kind = _KINDS[letters]
        last_letter = np.maximum.accumulate(np.where(kind == 1, np.arange(1, len(kind) + 1), 0))
        stem = last_letter[ends - 1] - (ends - sizes) if len(ends) else ends
        others = np.concatenate([[0], np.cumsum(kind == 0, dtype=np.int64)])
        signs = np.concatenate([[0], np.cumsum(kind == 2, dtype=np.int64)])
        plain = (stem > 0) & (others[ends] == others[ends - sizes]) & (signs[ends - sizes + np.maximum(stem, 0)] == signs[ends - sizes])
        letters = np.where(np.repeat(plain, sizes), _LOWER[letters], letters)
        cut = np.flatnonzero(plain & (stem < sizes))
        offsets = np.insert(np.concatenate([[0], ends]), cut + 1, ends[cut] - sizes[cut] + stem[cut])
        text_ends = text_ends + np.searchsorted(cut, text_ends)
        words = pa.Array.from_buffers(
            pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters))]
        ).dictionary_encode()
        ids = [*self._ids_of(words.dictionary.to_pylist()), np.array([end_id], self.dtype).tobytes()]
        flat = np.frombuffer(b"".join(ids), self.dtype)
        lengths_of = np.array([len(x) for x in ids]) // self.dtype.itemsize
        first = np.cumsum(lengths_of) - lengths_of
        # the end id stands behind the words of each text
        codes = np.insert(words.indices.to_numpy(), text_ends, len(ids) - 1)
        lengths = lengths_of[codes]
        after = np.cumsum(lengths)
        out = flat[np.arange(after[-1] if len(after) else 0) + np.repeat(first[codes] - after + lengths, lengths)]
        bounds = np.zeros(len(texts) + 1, np.int64)
        bounds[1:] = after[text_ends + np.arange(len(texts))] * self.dtype.itemsize
        return pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(out))])

    def encode(self, texts: list[str], end_id: int) -> list[bytes]:
        return self.encoded([t.encode() for t in texts], end_id).to_pylist()


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))


def _in_chunks(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    return (b.slice(i, rows) for b in batches for i in range(0, b.num_rows, rows))


def _by_bytes(batches: Iterator[pa.RecordBatch], texts: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of about ``most`` bytes of the column ``texts``, whole rows each."""
    for b in batches:
        before = np.cumsum(np.concatenate([[0], pc.binary_length(b[texts]).to_numpy(zero_copy_only=False)]))
        start = 0
        while start < b.num_rows:
            end = max(start + 1, int(np.searchsorted(before, before[start] + most, side="right")) - 1)
            yield b.slice(start, end - start)
            start = end


def encoded(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, the ids in bytes, and tie and salt (the CRC of the text and a number of the row), which
    order rows that repeat a doc_id and equal rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, row = encoder(path), 0
        for part in _by_bytes(batches, "text"):
            texts = part["text"].cast(pa.binary()).to_pylist()
            tie = pa.array([zlib.crc32(t) for t in texts], pa.int64())
            salt = pa.array(np.arange(row, row + len(texts)) % SALTS, pa.int64())
            row += len(texts)
            columns = [part["doc_id"], tie, salt, words.encoded(texts, end_id).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "tie", "salt", "ids"])

    return stash(on_workers(_texts(docs)).mapInArrow(run, "doc_id long, tie long, salt long, ids binary"), "token-ids")


def id_ranks(ids: DataFrame, dtype: np.dtype) -> DataFrame:
    """id, n, rank of every id that occurs: at most one row for each id of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for part in _in_chunks(batches):
            seen = np.bincount(np.frombuffer(b"".join(part["ids"].to_pylist()), dtype), minlength=len(total))
            seen[: len(total)] += total
            total = seen
        found = np.flatnonzero(total)
        columns = [pa.array(found, pa.int64()), pa.array(total[found], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "n"])

    counts = on_workers(ids).select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    by_frequency = Window.orderBy(F.col("n").desc(), "id")
    return stash(counts.select("id", "n", (F.row_number().over(by_frequency) - 1).alias("rank")), "token-ranks")


def _rank_arrays(ranks: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(rank by id, id by rank); the table is bounded by the vocabulary."""
    rows = ranks.select("id", "rank").toPandas()
    rank_of = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 1, np.uint32)
    rank_of[rows["id"]] = rows["rank"]
    id_of = np.zeros(max(1, len(rows)), np.uint32)
    id_of[rows["rank"]] = rows["id"]
    return rank_of, id_of


def write_token_files(docs: DataFrame, path: str, end_id: int = END_ID) -> tuple[DataFrame, DataFrame]:
    """Encodes every text and writes its blocks and the rank table to the shared folder; returns
    both read back."""
    ids = encoded(docs, path, end_id)
    dtype = encoder(path).dtype
    ranks = id_ranks(ids, dtype)
    rank_of, _ = _rank_arrays(ranks)
    parts = max(1, -(-ids.count() // PART_DOCS))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("salt")]
    rows = on_workers(ids).repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "ids")

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _to_blocks(batches, rank_of, dtype)

    schema = "part long, block long, n long, doc_ids binary, nulls binary, lengths binary, control binary, data binary"
    return stash(rows.mapInArrow(to_blocks, schema), "token-blocks"), ranks


def _to_blocks(batches: Iterator[pa.RecordBatch], rank_of: np.ndarray, dtype: np.dtype) -> Iterator[pa.RecordBatch]:
    """Joins the sorted documents of a part to blocks; the part is the task's range."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    block, doc_ids, held, size = 0, [], [], 0

    def flush() -> pa.RecordBatch:
        lengths = np.array([len(x) // dtype.itemsize for x in held], "<i8")
        control, data = pack(rank_of[np.frombuffer(b"".join(held), dtype)])
        fields = (
            np.array([i or 0 for i in doc_ids], "<i8").tobytes(), bytes(i is None for i in doc_ids), lengths.tobytes(), control, data,
        )
        names = ["part", "block", "n", "doc_ids", "nulls", "lengths", "control", "data"]
        numbers = [pa.array([x], pa.int64()) for x in (part, block, int(lengths.sum()))]
        return pa.RecordBatch.from_arrays([*numbers, *(pa.array([x], pa.binary()) for x in fields)], names=names)

    for b in _in_chunks(batches):
        for doc_id, ids in zip(b["doc_id"].to_pylist(), b["ids"].to_pylist(), strict=True):
            if size >= BLOCK_TOKENS:
                yield flush()
                block, doc_ids, held, size = block + 1, [], [], 0
            doc_ids.append(doc_id)
            held.append(ids)
            size += len(ids) // dtype.itemsize
    if held:
        yield flush()


def read_token_files(blocks: DataFrame, ranks: DataFrame, digest: Callable[[np.ndarray], int] | None = None) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, and its ``ids``,
    or with ``digest`` that function's integer of them."""
    _, id_of = _rank_arrays(ranks)
    kind = pa.int64() if digest else pa.list_(pa.int32())

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _in_chunks(batches, 1):
            row = b.to_pylist()[0]
            ids = id_of[unpack(row["control"], row["data"], row["n"])]
            lengths = np.frombuffer(row["lengths"], "<i8")
            starts = np.cumsum(lengths) - lengths
            nulls = np.frombuffer(row["nulls"], np.bool_)
            pieces = [ids[s : s + n] for s, n in zip(starts, lengths, strict=True)]
            columns = [
                pa.array(np.full(len(lengths), row[k]), pa.int64()) for k in ("part", "block")
            ] + [
                pa.array(np.frombuffer(row["doc_ids"], "<i8"), pa.int64(), mask=nulls),
                pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                pa.array([digest(p) if digest else p for p in pieces], kind),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "block", "doc_id", "inside", "n_tokens", "ids"])

    docs = on_workers(blocks).select("part", "block", "n", "doc_ids", "nulls", "lengths", "control", "data").mapInArrow(
        decode, f"part long, block long, doc_id long, inside long, n_tokens long, ids {'long' if digest else 'array<int>'}"
    )
    # running sums in two levels: of the parts, then of a part's blocks
    parts = blocks.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    earlier = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("part", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("block_start"))
    starts = stash(starts.join(parts, "part").select("part", "block", (F.col("part_start") + F.col("block_start")).alias("first")), "token-starts")
    out = docs.join(broadcast_if_small(starts), ["part", "block"])
    return out.select("doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids")


def crc32_of_ids(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    blocks, ranks = write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(blocks, ranks, crc32_of_ids).withColumnRenamed("ids", "ids_crc32")
