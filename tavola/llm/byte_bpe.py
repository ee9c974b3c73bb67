"""Byte-level BPE: exact merges in linear time, and back.

The text is cut by the vocabulary's pattern; every piece is encoded on its own. Bytes are read
as Latin-1 characters, so an Aho-Corasick automaton over the vocabulary finds every token that
starts at every byte in one pass; of these only the longest is kept, since the others are
reached through a table that names each token's longest proper prefix in the vocabulary.

A sequence of tokens is what the merges produce exactly if each two neighbours are compatible:
merging the two tokens' bytes yields just these two tokens. So the encoder goes forward with the
longest token that is compatible with its left neighbour, tries shorter ones where it is not,
and steps back where none is, marking the byte it stepped back from so that no byte is left
twice. Compatibility of a pair is found by undoing merges from the seam outwards, latest first,
and is memoised.

Defined cases: a null or empty text has no ids and decodes to no bytes; a text of any length is encoded
whole; of equal merges the leftmost goes first, as in the library; repeated rows and rows without doc_id
are encoded like any other; an empty table gives an empty result; columns other than doc_id and text are
not read, whatever their names. Memory of a task: one Arrow batch, and word and pair memos of bounded
length.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tavola.llm._shared import on_workers, table, whole_text

#: Entries of a generation of a worker's memos; longer keys are not kept.
CHUNK_MEMO = 300_000
PIECE_MEMO = 150_000
MEMO_CHARS = 64
PAIR_MEMO = 400_000
SPACE_INSIDE = re.compile(r"(?:\s|^) (?:\s|$)")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to ids from a rank file: base64 and rank a line, in order of the merges."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, f.read().splitlines()))}


class Memo(dict):
    """Ids by string, of bounded length: when full, its entries become the old generation, of
    which only those asked for again are kept."""

    def __init__(self, most: int):
        self.most, self.old = most, {}

    def put(self, key: str, ids: tuple[int, ...]) -> None:
        if len(key) <= MEMO_CHARS:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = ids

    def find(self, key: str) -> tuple[int, ...] | None:
        """What ``get`` did not find: an entry of the old generation, moved to the new."""
        found = self.old.get(key)
        if found is not None:
            self.put(key, found)
        return found


class ByteBPE:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.token = [b""] * (max(ranks.values()) + 1)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        # the automaton looks through a node's branches in the order they were added: merges
        # come most frequent first, so the single bytes are added after them
        for token, rank in sorted(ranks.items(), key=lambda x: (len(x[0]) == 1, x[1])):
            self.token[rank] = token
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.length = [len(t) for t in self.token]
        self.text = [str(i) for i in range(len(self.token))]
        self.numbers = list(range(len(self.token)))
        # longest proper prefix that is a token, else -1
        self.shorter = [-1] * len(self.token)
        # the two tokens whose merge made this one; a byte is its own two halves
        self.halves = [(r, r) for r in range(len(self.token))]
        self.merged: dict[tuple[int, int], int] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            for n in range(len(token) - 1, 0, -1):
                if (prefix := ranks.get(token[:n])) is not None:
                    self.shorter[rank] = prefix
                    break
            if len(token) > 1 and (pair := self._last_merge(token, rank)):
                self.halves[rank] = pair
                self.merged[pair] = rank
        self.compatible_memo: dict[int, bool] = {}
        self.piece_memo, self.chunk_memo = Memo(PIECE_MEMO), Memo(CHUNK_MEMO)

    def _last_merge(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The pair that ``token`` consists of before its last merge, by plain merging."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = rank, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1], rank)
                if r < best:
                    best, at = r, i
            if at < 0:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens yields these two tokens."""
        key = left << 32 | right
        known = self.compatible_memo.get(key)
        if known is None:
            if len(self.compatible_memo) >= PAIR_MEMO:
                self.compatible_memo.clear()
            known = self.compatible_memo[key] = self._seam_holds(left, right)
        return known

    def _seam_holds(self, left: int, right: int) -> bool:
        """Undoes the merges of both tokens, the later first, looking at the two tokens at the
        seam each time. ``before``: only a merge of lower rank could have come first; on the
        left side one of equal rank too, since merges of one rank go from left to right."""
        halves, merged = self.halves, self.merged
        before = len(self.token) + 1
        while True:
            if merged.get((left, right), before) < before:
                return False
            for side in ((0, 1) if left > right else (1, 0)):
                if side == 0:
                    before, inner = left, halves[left][1]
                    if inner != left:
                        left = inner
                        break
                else:
                    before, inner = right + 1, halves[right][0]
                    if inner != right:
                        right = inner
                        break
            else:
                return True

    def encode_piece(self, piece: bytes) -> list[int]:
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        n = len(piece)
        longest = [0] * n
        length, shorter, compatible = self.length, self.shorter, self.compatible
        for end, rank in self.automaton.iter(piece.decode("latin-1")):
            longest[end - length[rank] + 1] = rank  # by end, so the longest of a start comes last
        open_ = bytearray(b"\x01") * (n + 1)
        ids: list[int] = []
        at, token = 0, longest[0]
        while True:
            end = at + length[token]
            if open_[end] and (not ids or compatible(ids[-1], token)):
                ids.append(token)
                if end == n:
                    return ids
                at, token = end, longest[end]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                open_[at] = 0
                token = ids.pop()
                at -= length[token]

    def encode_pieces(self, text: str) -> list[int]:
        """Every match of the pattern by itself."""
        memo, ids = self.piece_memo, []
        for piece in self.pattern.findall(text):
            found = memo.get(piece) or memo.find(piece)
            if found is None:
                # one integer object for each id, however many entries hold it
                found = tuple(map(self.numbers.__getitem__, self.encode_piece(piece.encode("utf-8"))))
                memo.put(piece, found)
            ids += found
        return ids

    def encode(self, text: str) -> list[int]:
        """Cuts before every space first and remembers whole chunks: a match of the pattern holds
        a space only in front, so a space after a non-space, or before one, begins a match. Only
        a space between two other white spaces need not; such a text is matched uncut."""
        if SPACE_INSIDE.search(text):
            return self.encode_pieces(text)
        memo, get = self.chunk_memo, self.chunk_memo.get
        ids: list[int] = []
        first, *chunks = text.split(" ")
        ids += self.encode_pieces(first)
        for chunk in chunks:
            found = get(chunk) or memo.find(chunk)
            if found is None:
                found = tuple(self.encode_pieces(" " + chunk))
                memo.put(chunk, found)
            ids += found
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


@lru_cache(maxsize=2)
def engine(path: str, pattern: str) -> ByteBPE:
    """One engine per Python worker and vocabulary."""
    return ByteBPE(read_ranks(path), pattern)


def encode(docs: DataFrame, path: str, pattern: str, chunk: int = 512) -> DataFrame:
    """doc_id and ``ids`` (array of int) of every text; workers read the vocabulary at ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = engine(path, pattern)
        for batch in batches:
            for part in (batch.slice(i, chunk) for i in range(0, batch.num_rows, chunk)):
                ids = pa.array([bpe.encode(t) for t in part["text"].to_pylist()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part["doc_id"], ids], names=["doc_id", "ids"])

    source = docs.select("doc_id", whole_text().alias("text"))
    return on_workers(source).mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def round_trip(docs: DataFrame, path: str, pattern: str, chunk: int = 512) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by a space) and decoded_sha256 of every
    text: encoded, then decoded from the ids alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = engine(path, pattern)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            for part in (batch.slice(i, chunk) for i in range(0, batch.num_rows, chunk)):
                counts, ids_sha, decoded_sha = [], [], []
                for text in part["text"].to_pylist():
                    ids = bpe.encode(text)
                    counts.append(len(ids))
                    ids_sha.append(sha(" ".join(map(bpe.text.__getitem__, ids)).encode()))
                    decoded_sha.append(sha(bpe.decode(ids)))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    source = docs.select("doc_id", whole_text().alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return on_workers(source).mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def public_round_trip(docs: DataFrame) -> DataFrame:
    """``round_trip`` with the public 50k vocabulary."""
    import public_tokenizers

    return round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return public_round_trip(table(spark, sf_dir, "documents")).withColumn("doc_id", F.col("doc_id").cast("long"))
