"""Token files against the tokenizers library and as an exact round trip."""

import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from tavola.llm import token_files  # noqa: E402

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def test_pack_and_unpack():
    rng = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 5, 1000):
        ranks = (rng.integers(0, 2**32, n, dtype=np.uint64) >> rng.integers(0, 32, n, dtype=np.uint64)).astype(np.uint32)
        control, data = token_files.pack(ranks)
        assert len(control) == -(-n // 4)
        assert (token_files.unpack(control, data, n) == ranks).all()
    assert len(token_files.pack(np.array([255, 256, 65536, 2**24]))[1]) == 1 + 2 + 3 + 4


def test_words_equal_the_library(library):
    texts = [
        "áb ́c", "x\t y\x0bz\x1cw", "<|endoftext|> a<|endoftext|>b <|startoftext|>", "ΑΣ Σ", "İx İ.", "", "   ", " a b",
        "it's 12a!!b", "THE!!' Élan's ÉCOLE. ét é. ΑΣ. ΣΑ, ǅ. ſ. ﬁ", "x’s don't''' a'", "日本語, 中。", "ａＢ", "w" * 300 + ".",
    ]
    words = token_files.WordEncoder(PATH)
    for _ in range(2):
        got = [np.frombuffer(b, words.dtype).tolist() for b in words.encode(texts, 2)]
        assert got == [library.encode(t, add_special_tokens=False).ids + [2] for t in texts]


def test_random_texts_equal_the_library(library):
    import random

    rng = random.Random(4)
    parts = ["a", "The", "ing", "É", "é", "'s", "'T", ".", "!!", "<|", "|>", "<|endoftext|>", "<|ENDOFTEXT|>", "endoftext", "12", "\t", " ", "\n", "  ", "\x00", "\x1c", "中", "’", "Σ", "ſ", "\u0301", "_", "-"]
    words = token_files.WordEncoder(PATH)
    for _ in range(60):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(40)]
        got = [np.frombuffer(b, words.dtype).tolist() for b in words.encode(texts, 2)]
        want = [library.encode(t, add_special_tokens=False).ids + [2] for t in texts]
        assert got == want, [t for t, g, w in zip(texts, got, want, strict=True) if g != w][:1]


def test_files_read_back(spark, edge_docs, no_docs, library, monkeypatch):
    monkeypatch.setattr(token_files, "PART_DOCS", 4)
    blocks, ranks = token_files.write_token_files(edge_docs, PATH)
    assert blocks.select("part").distinct().count() > 1
    got = token_files.read_token_files(blocks, ranks, token_files.crc32_of_ids).collect()
    every = edge_docs.collect()
    assert len(got) == len(every)
    got.sort(key=lambda r: r.start)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))
    crc = lambda t: zlib.crc32(np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes())
    assert sorted((r.doc_id or -1, r.ids) for r in got) == sorted((r.doc_id or -1, crc(r.text)) for r in every)
    # ranks follow frequency
    table = ranks.orderBy("rank").collect()
    assert [r["rank"] for r in table] == list(range(len(table)))
    assert [r.n for r in table] == sorted((r.n for r in table), reverse=True)
    plain = token_files.read_token_files(blocks, ranks).filter("doc_id = 3").first()
    assert plain.ids == library.encode("one", add_special_tokens=False).ids + [2]
    blocks, ranks = token_files.write_token_files(no_docs, PATH)
    assert token_files.read_token_files(blocks, ranks, token_files.crc32_of_ids).count() == 0


def test_parts_follow_the_data(spark, monkeypatch):
    """A far id, or no ids, or equal rows, make no part long."""
    monkeypatch.setattr(token_files, "PART_DOCS", 100)
    for rows in (
        [(i, f"word {i}") for i in range(2000)] + [(10**12, "far")],
        [(None, f"word {i}") for i in range(2000)],
        [(None, "the same text") for _ in range(2000)],
    ):
        blocks, ranks = token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), PATH)
        sizes = [len(r.nulls) for r in blocks.collect()]
        assert sum(sizes) == len(rows) and max(sizes) < 400
        got = sorted((r.start, r.n_tokens) for r in token_files.read_token_files(blocks, ranks, token_files.crc32_of_ids).collect())
        assert all(a + n == b for (a, n), (b, _) in zip(got, got[1:], strict=False))


def test_chunks_of_texts(library, monkeypatch):
    import pyarrow as pa

    texts = ["", "a b", " ", "\n", "lead " * 50, "x", "", "two\n\nlines ", "é ÉÀ"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    for most in (1, 4, 300, 10**6):
        parts = [p["text"].to_pylist() for p in token_files._by_bytes(iter([batch, batch.slice(3)]), "text", most)]
        assert [t for p in parts for t in p] == texts + texts[3:]
        assert all(len(p) == 1 or sum(len(t.encode()) for t in p) <= most for p in parts)
    words = token_files.WordEncoder(PATH)
    for some in (texts, texts[:1], [" "], texts[::-1]):
        got = [np.frombuffer(b, words.dtype).tolist() for b in words.encode(some, 2)]
        assert got == [library.encode(t, add_special_tokens=False).ids + [2] for t in some]
