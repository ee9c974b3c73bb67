"""SentencePiece encoding by a merge-type vocabulary in linear time, and back.

A model of this type merges, in a sequence of characters, again and again the two neighbours whose
joined text is the piece of the highest score, the leftmost first among equals. Here no merge is
carried out. Two pieces are compatible if merging the characters of both yields just these two
pieces; a sequence is what the merges produce exactly if each two neighbours are compatible. So
every prefix of a text has one last piece: the one piece that ends there and is compatible with the
last piece of the prefix before it. One pass of an Aho-Corasick automaton names the pieces that end
at each place; the table of last pieces is filled in from left to right, and the ids are read from
it backwards. A character without a piece stands alone and is written as its UTF-8 bytes.

Compatibility is found by undoing the merges at the seam, latest first, and is memoised. Blanks
become U+2581, with one in front of the text. No piece holds this sign behind another character,
and none holds a line end, so a text is cut before such signs and at line ends, and a worker
remembers the ids of what lies between.

Defined cases: a null or empty text has no ids and decodes to the empty text; a text of any length is
encoded whole, in one table of its longest uncut stretch; U+2581 in a text is a blank, as in the
library; repeated rows and rows without doc_id are encoded like any other; an empty table gives an
empty result; columns other than doc_id and text are not read. Models with another normaliser than
the identity, or with pieces of the caller's own, are refused.
"""

from __future__ import annotations

import codecs
import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tavola.llm._shared import on_workers, table, whole_text
from tavola.llm.byte_bpe import Memo

BLANK = "▁"
#: Entries of a generation of a worker's memos.
CHUNK_MEMO = 300_000
PAIR_MEMO = 400_000
#: Kinds of pieces in a model file (fixed values of the format).
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6

codecs.register_error("tavola-each-byte", lambda e: ("�" * (e.end - e.start), e.end))


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of every field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = message[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < len(message):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or varint()
            yield tag >> 3, message[at : at + size]
            at += size


def read_model(path: str) -> tuple[list[tuple[str, float, int]], bool, bool]:
    """The pieces (text, score, kind) in order of their ids, whether a blank goes in front of a
    text, and whether characters without a piece are written as bytes."""
    pieces, front, fallback = [], True, False
    with open(path, "rb") as f:
        data = f.read()
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0], piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
            fallback = bool(trainer.get(35, 0))
            if trainer.get(3, 1) != 2 or trainer.get(24, 0):
                raise ValueError("not a model of merges with blanks in front of words")
        elif number == 3:
            normaliser = dict(_fields(value))
            front = bool(normaliser.get(3, 1))
            if normaliser.get(2) or normaliser.get(4, 1) or not normaliser.get(5, 1):
                raise ValueError("the model's normaliser is not the identity")
    if {kind for _, _, kind in pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE}:
        raise ValueError("the model holds pieces of other kinds")
    return pieces, front, fallback


class PieceEncoder:
    def __init__(self, path: str):
        import ahocorasick

        pieces, self.front, fallback = read_model(path)
        self.piece = [p for p, _, _ in pieces]
        self.kind = [k for _, _, k in pieces]
        self.unknown = self.kind.index(UNKNOWN)
        self.byte_ids = [self.piece.index(f"<0x{b:02X}>") for b in range(256)] if fallback else None
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids or ())}
        self.id_of = {p: i for i, (p, _, k) in enumerate(pieces) if k == NORMAL}
        if any(c not in self.id_of for p in self.id_of for c in p):
            raise ValueError("a piece holds a character that is none")
        # place in the order of merges; pieces of one score share it
        order = {s: r for r, s in enumerate(sorted({s for _, s, k in pieces if k == NORMAL}, reverse=True))}
        self.rank = [order.get(s, -1) if k == NORMAL else -1 for _, s, k in pieces]
        self.length = [len(p) for p in self.piece]
        self.halves = [(i, i) for i in range(len(pieces))]
        self.merged: dict[tuple[int, int], int] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for text, i in self.id_of.items():
            if len(text) > 1:
                if (pair := self._last_merge(text)) is None:
                    continue  # merging its own characters never makes this piece
                self.halves[i] = pair
                self.merged[pair] = self.rank[i]
            self.automaton.add_word(text, i)
        self.automaton.make_automaton()
        self.known: dict[int, bool] = {}
        self.ids_memo, self.text_memo = Memo(CHUNK_MEMO), Memo(CHUNK_MEMO)
        apart = "" if any("\n" in p for p in self.id_of) else "\n"
        inside = any(BLANK in p.lstrip(BLANK) for p in self.id_of)
        self.cut = re.compile("(?s).+" if inside else f"{BLANK}*[^{BLANK}{apart}]+|{BLANK}+|\n")

    def _last_merge(self, text: str) -> tuple[int, int] | None:
        """The two pieces whose merge made ``text``, by plain merging."""
        parts = list(text)
        while len(parts) > 2:
            made = [self.id_of.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
            found = [(self.rank[i], at) for at, i in enumerate(made) if i is not None]
            if not found:
                return None
            at = min(found)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return self.id_of[parts[0]], self.id_of[parts[1]]

    def compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self.known.get(key)
        if known is None:
            if len(self.known) >= PAIR_MEMO:
                self.known.clear()
            known = self.known[key] = self._seam_holds(left, right)
        return known

    def _seam_holds(self, left: int, right: int) -> bool:
        """Whether no merge across the seam comes before one that made either piece. The latest
        merge is undone first: on the right among equals, since the leftmost goes first."""
        rank, halves, merged = self.rank, self.halves, self.merged
        latest = len(rank)
        while True:
            if merged.get((left, right), latest) < latest:
                return False
            whole_left, whole_right = halves[left][1] == left, halves[right][0] == right
            if whole_left and whole_right:
                return True
            if whole_left or (not whole_right and rank[right] >= rank[left]):
                latest, right = rank[right] + 1, halves[right][0]
            else:
                latest, left = rank[left], halves[left][1]

    def encode_stretch(self, text: str) -> list[int]:
        """Ids of a text that has its blanks replaced already."""
        last = [-1] * (len(text) + 1)  # of each prefix, its last piece; -1: a character without one
        length, compatible = self.length, self.compatible
        for end, piece in self.automaton.iter(text):
            stop = end + 1
            if last[stop] < 0:
                start = stop - length[piece]
                if start == 0 or last[start] < 0 or compatible(last[start], piece):
                    last[stop] = piece
        ids: list[int] = []
        at = len(text)
        while at:
            piece = last[at]
            if piece >= 0:
                ids.append(piece)
                at -= length[piece]
            else:
                at -= 1
                ids += [self.byte_ids[b] for b in reversed(text[at].encode())] if self.byte_ids else [self.unknown]
        ids.reverse()
        return ids

    def stretches(self, text: str) -> list[str]:
        if not text:
            return []
        return self.cut.findall((BLANK if self.front else "") + text.replace(" ", BLANK))

    def encode(self, text: str) -> list[int]:
        return [i for part in self.encoded(text) for i in map(int, part.split(","))]

    def encoded(self, text: str) -> list[str]:
        """The ids of each stretch, joined by commas."""
        stretches = self.stretches(text)
        memo = self.ids_memo
        out = list(map(memo.get, stretches))
        if None in out:
            for at, found in enumerate(out):
                if found is None:
                    stretch = stretches[at]
                    found = memo.get(stretch) or memo.find(stretch)
                    if found is None:
                        found = ",".join(map(str, self.encode_stretch(stretch)))
                        memo.put(stretch, found)
                    out[at] = found
        return out

    def spelled(self, ids: list[int]) -> str:
        """The text of ids, with every blank."""
        out, held = [], bytearray()
        for i in ids:
            if (b := self.byte_of.get(i)) is not None:
                held.append(b)
                continue
            if held:
                out.append(held.decode("utf-8", "tavola-each-byte"))
                held.clear()
            if self.kind[i] == NORMAL:
                out.append(self.piece[i].replace(BLANK, " "))
            elif self.kind[i] == UNKNOWN:
                out.append(" ⁇ ")
        out.append(held.decode("utf-8", "tavola-each-byte"))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        text = self.spelled(ids)
        return text[1:] if self.front and ids and self.piece[ids[0]].startswith(BLANK) else text

    def decoded(self, parts: list[str]) -> str:
        """``decode`` of what ``encoded`` returned: bytes of one character lie in one part."""
        memo = self.text_memo
        out = list(map(memo.get, parts))
        if None in out:
            for at, found in enumerate(out):
                if found is None:
                    part = parts[at]
                    found = memo.get(part) or memo.find(part)
                    if found is None:
                        found = self.spelled(list(map(int, part.split(","))))
                        memo.put(part, found)
                    out[at] = found
        text = "".join(out)
        return text[1:] if self.front and text.startswith(" ") else text


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """One encoder per Python worker and model."""
    return PieceEncoder(path)


def encode(docs: DataFrame, path: str, chunk: int = 512) -> DataFrame:
    """doc_id and ``ids`` (array of int) of every text; workers read the model at ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = encoder(path)
        for batch in batches:
            for part in (batch.slice(i, chunk) for i in range(0, batch.num_rows, chunk)):
                ids = pa.array([pieces.encode(t) for t in part["text"].to_pylist()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part["doc_id"], ids], names=["doc_id", "ids"])

    source = docs.select("doc_id", whole_text().alias("text"))
    return on_workers(source).mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str, chunk: int = 512) -> DataFrame:
    """doc_id and ``text`` of every row of ``encode``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = encoder(path)
        for batch in batches:
            for part in (batch.slice(i, chunk) for i in range(0, batch.num_rows, chunk)):
                texts = pa.array([pieces.decode(ids or []) for ids in part["ids"].to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([part["doc_id"], texts], names=["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return on_workers(encoded.select("doc_id", "ids")).mapInArrow(run, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, path: str, chunk: int = 512) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by commas) and decoded_sha256 of every text:
    encoded, then decoded from the ids alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = encoder(path)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in batches:
            for part in (batch.slice(i, chunk) for i in range(0, batch.num_rows, chunk)):
                counts, ids_sha, decoded_sha = [], [], []
                for text in part["text"].to_pylist():
                    parts = pieces.encoded(text)
                    ids = ",".join(parts)
                    counts.append(ids.count(",") + 1 if parts else 0)
                    ids_sha.append(sha(ids))
                    decoded_sha.append(sha(pieces.decoded(parts)))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    source = docs.select("doc_id", whole_text().alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return on_workers(source).mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").withColumn("doc_id", F.col("doc_id").cast("long"))
    return round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"))
