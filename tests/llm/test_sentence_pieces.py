"""SentencePiece encoding against the sentencepiece library."""

import hashlib
import random

import pytest

P = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

from tavola.llm import sentence_pieces as S  # noqa: E402

PATH = P.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pieces():
    return S.encoder(PATH)


@pytest.fixture(scope="module")
def reference():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


PARTS = [
    "a", "e", "th", "er", "in", "the", "tion", "é", "è", "中", "文", "①", " ", "  ", "   ", "\n", " \n ", "\t", "1", "23", "'s",
    "!!", "...", "zz", "\U0001f600", "▁", "▁▁", "　", "́", "\x00", "<s>", "</s>", "<unk>", "<0x41>", "A", "HTTP", "ﬁ",
]


def test_equals_the_library_on_random_texts(pieces, reference):
    rng = random.Random(5)
    for _ in range(6000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40)))
        ids = reference.encode(text)
        assert pieces.encode(text) == ids, text
        assert pieces.decode(ids) == reference.decode(ids) == pieces.decoded(pieces.encoded(text))


def test_equals_the_library_on_random_letters(pieces, reference):
    rng = random.Random(6)
    for letters in ("abcdefghijklmnopqrstuvwxyz", "aeiou ", "ab ", " ", "▁ a", "lost", "éèêàç' ", "01239.,"):
        for _ in range(500):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 70)))
            assert pieces.encode(text) == reference.encode(text), text


@pytest.mark.parametrize("text", ["a" * 20000, "ab" * 9000, "é" * 5000, " " * 4000 + "x", "x" + " " * 37, "①" * 3000, "", " ", "\n" * 50, "▁"])
def test_long_runs_and_edges(pieces, reference, text):
    ids = reference.encode(text)
    assert pieces.encode(text) == ids
    assert pieces.decode(ids) == reference.decode(ids)


def test_decodes_any_ids(pieces, reference):
    rng = random.Random(7)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(3, 32000), rng.randrange(3, 259)]) for _ in range(rng.randint(0, 12))]
        if ids and pieces.kind[ids[0]] == S.BYTE:
            ids.insert(0, rng.randrange(259, 32000))  # where a text begins with a byte the library's rule for blanks is its own
        assert pieces.decode(ids) == reference.decode(ids), ids


def test_the_table_of_last_pieces_needs_no_memo(pieces, reference):
    for text in ("whereabouts", "internationalisation", "▁the▁▁▁▁▁quick", "ababababab", "①é中"):
        stretch = text if text.startswith("▁") else "▁" + text
        assert pieces.encode_stretch(stretch) == reference.encode(stretch[1:].replace("▁", " "))


def _want(rows, reference):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = []
    for doc_id, text in rows:
        ids = reference.encode(text or "")
        out.append((doc_id if doc_id is not None else -1, len(ids), sha(",".join(map(str, ids))), sha(reference.decode(ids))))
    return sorted(out)


def _got(df):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in df.collect())


def test_query_on_edge_cases(spark, edge_docs, no_docs, reference):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert _got(S.round_trip(edge_docs, PATH)) == _want(rows, reference)
    assert S.round_trip(no_docs, PATH).count() == 0 and S.encode(no_docs, PATH).count() == 0
    ids = S.encode(edge_docs.filter("doc_id IS NOT NULL"), PATH)
    texts = sorted((r.doc_id, r.text) for r in S.decode(ids, PATH).collect())
    assert texts == sorted((i, t or "") for i, t in rows if i is not None)


def test_query_equals_the_library_on_the_whole_table(spark, reference):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert _got(S.query(spark, SF)) == _want([(r.doc_id, r.text) for r in docs.collect()], reference)


def test_other_models_are_refused(tmp_path):
    field = lambda n, body: bytes([n << 3 | 2, len(body)]) + body
    bad = tmp_path / "bad.model"
    bad.write_bytes(field(1, field(1, b"a")) + field(3, bytes([4 << 3, 1])))  # blanks squeezed
    with pytest.raises(ValueError):
        S.read_model(str(bad))
    bad.write_bytes(field(1, field(1, b"a")) + field(2, bytes([3 << 3, 1])))  # not made of merges
    with pytest.raises(ValueError):
        S.read_model(str(bad))
