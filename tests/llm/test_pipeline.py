"""The pipeline, stage by stage, against brute force on small tables."""

import hashlib

import pytest

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

import corpus_pipeline  # noqa: E402
from tavola.llm import byte_bpe, mixing, personal_data, rule_quality  # noqa: E402
from test_near_duplicates import plain_components  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], SF).cache())
    return out


def test_stages(spark, stages):
    docs, good, single, masked, mixed, ids = stages
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "mixing", "encoding"]
    for s in (good, single, masked, mixed):
        assert s.columns == docs.columns
    model = rule_quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rejected = {r.doc_id for r in rule_quality.scored(docs, model).filter("predicted = 0").collect()}
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in docs.collect()} - rejected
    rows = [(r.doc_id, r.text) for r in good.collect()]
    comps, _ = plain_components(rows, similar=corpus_pipeline.SIMILAR)
    assert {r.doc_id for r in single.collect()} == {i for i, c in comps.items() if i == c}
    texts = {r.doc_id: r.text for r in single.collect()}
    for r in masked.collect():
        ((_, spans),) = personal_data.spans_of([texts[r.doc_id]])
        assert r.text == personal_data.masked_text(texts[r.doc_id], spans) and r.n_chars == len(r.text)
    copies = {r.doc_id: r.mix_copies for r in mixing.mix(masked).collect()}
    taken = [r.doc_id for r in mixed.collect()]
    assert {i: taken.count(i) for i in copies} == copies
    reference = tiktoken.Encoding(
        "own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={}
    )
    want = []
    for r in mixed.collect():
        own = reference.encode_ordinary(r.text)
        want.append((r.doc_id, len(own), hashlib.sha256(" ".join(map(str, own)).encode()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()))
    assert sorted(tuple(r) for r in ids.collect()) == sorted(want)


def test_stages_on_edge_rows(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        base = docs
        for _, stage in corpus_pipeline.STAGES:
            base = stage(spark, base, SF)
        base.collect()
    kept = corpus_pipeline.one_of_each_group(spark, edge_docs, SF).collect()
    ids = [r.doc_id for r in kept]
    # the two texts of id 4 are no near-duplicates: each stays, once
    assert ids.count(4) == 2 and ids.count(None) == 2 and 5 not in ids and 0 in ids


def test_near_duplicates_from_80_per_cent(spark):
    word = iter(f"w{i}" for i in range(1000))
    take = lambda n: " ".join(next(word) for _ in range(n))
    base = take(100)  # 96 shingles
    texts = [base, f"{base} {take(20)}", f"{base} {take(24)}", f"{base} {take(25)}", take(50)]  # 0.828, 0.800, 0.793 of the first
    rows = [(i, t) for i, t in enumerate(texts)]
    comps, _ = plain_components(rows, similar=80)
    assert comps != plain_components(rows)[0]
    docs = spark.createDataFrame([(i, t, "en", "src", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.one_of_each_group(spark, docs, SF).collect()}
    assert kept == {i for i, c in comps.items() if i == c} == {0, 3, 4}


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_repeated_ids_lose_no_text(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(80)) for x in "abc")
    rows = [(7, a), (7, b), (8, b), (9, f"{b} more"), (10, f"{a} more"), (7, c), (7, c), (3, f"{c} more")]
    kept = corpus_pipeline.one_of_each_group(spark, _docs(spark, rows), SF).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(3, f"{c} more"), (7, a), (7, b)]


def test_rows_without_an_id_are_compared(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(80)) for x in "ab")
    rows = [(None, a), (None, a), (None, f"{a} more"), (None, b), (5, f"{b} more"), (None, None), (None, ""), (6, " ")]
    kept = corpus_pipeline.one_of_each_group(spark, _docs(spark, rows).repartition(3), SF).collect()
    texts = [(r.doc_id, r.text) for r in kept]
    assert len(texts) == 5 and (5, f"{b} more") in texts and (6, " ") in texts and (None, b) not in texts
    assert sum(i is None and (t or "").startswith("a0 ") for i, t in texts) == 1
