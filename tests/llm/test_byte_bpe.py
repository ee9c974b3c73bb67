"""Byte-level BPE against the tiktoken library."""

import hashlib
import random

import pytest

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

from tavola.llm import byte_bpe  # noqa: E402

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.engine(PATH, P.PATTERN)


@pytest.fixture(scope="module")
def reference(bpe):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def test_equals_the_library_on_random_texts(bpe, reference):
    rng = random.Random(3)
    parts = ["a", "e", "th", "er", "in", "é", "中", " ", "  ", "\n", " \n ", "1", "23", "'s", "!!", "zz", "\U0001f600", " ", "\t"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        ids = bpe.encode(text)
        assert ids == reference.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 20000, "ab" * 9000, "é" * 5000, " " * 4000 + "x", "", " ", "<|endoftext|>"])
def test_long_runs_and_edges(bpe, reference, text):
    assert bpe.encode(text) == reference.encode_ordinary(text)


def test_memo_keeps_what_is_asked_for_again():
    memo = byte_bpe.Memo(2)
    for key in ("a", "b", "c"):
        memo.put(key, (1,))
    assert "a" not in memo and memo.find("a") == (1,) and "a" in memo
    memo.put("x" * (byte_bpe.MEMO_CHARS + 1), (1,))
    assert len(memo) == 2


def test_query_on_edge_cases(spark, edge_docs, no_docs, reference):
    got = sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in byte_bpe.round_trip(edge_docs, PATH, P.PATTERN).collect())
    want = []
    for r in edge_docs.collect():
        ids = reference.encode_ordinary(r.text or "")
        sha = lambda b: hashlib.sha256(b).hexdigest()
        want.append((r.doc_id or -1, len(ids), sha(" ".join(map(str, ids)).encode()), sha((r.text or "").encode())))
    assert got == sorted(want)
    assert byte_bpe.round_trip(no_docs, PATH, P.PATTERN).count() == 0
    ids = {r.doc_id: r.ids for r in byte_bpe.encode(edge_docs.filter("doc_id = 8"), PATH, P.PATTERN).collect()}
    assert ids[8] == reference.encode_ordinary(edge_docs.filter("doc_id = 8").first().text)
