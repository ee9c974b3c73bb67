"""Lexical search against a plain ranking, and the shared sums against direct ones."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tavola.llm import lexical_search as L


def plain(docs, items, nearest):
    """(item_id, rank, doc_id, score) by one dictionary a document."""
    cut = lambda t: [re.sub("[A-Z]", lambda m: m.group().lower(), x) for x in re.findall(L.TERM, t or "")]
    counts = [(i, Counter(cut(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    holding = Counter(t for _, c in counts for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(cut(t))
    out = []
    for item, terms in asked.items():
        scored = []
        for (doc, c), size in zip(counts, sizes, strict=True):
            m = 100 - 50 + (50 * size * n) // total if total else 0
            score = 0
            for t in terms & set(c):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * holding[t] + 1)))
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        for rank, (s, null, doc) in enumerate(sorted(scored)[:nearest], 1):
            out.append((item, rank, None if null else doc, -s))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def _items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("seed", range(8))
def test_shared_sums_equal_direct_sums(seed):
    rng = random.Random(seed)
    terms = rng.choice([1, 5, 60])
    base = [rng.sample(range(terms), rng.randint(0, min(terms, 12))) for _ in range(6)]
    items = [sorted({t for b in rng.sample(base, rng.randint(0, 3)) for t in b} | set(rng.sample(range(terms), min(terms, rng.randint(0, 3))))) for _ in range(40)]
    sharing = L.shared_sums(items, terms, mined=rng.choice([2, 8, 32]))
    numbers = np.random.default_rng(seed).integers(0, 10**9, (terms, 7))
    want = np.array([numbers[own].sum(axis=0) if own else np.zeros(7, int) for own in items])
    assert (L.evaluated(sharing, numbers) == want).all()
    direct = sum(max(0, len(own) - 1) for own in items)
    assert sharing.additions <= direct
    done = set(range(terms))
    for level in sharing.levels:  # every set needs only what stands before its level
        assert all(p in done for k in level for p in sharing.sets[k])
        done |= {terms + k for k in level}


def test_shared_terms_are_summed_once():
    common, items = list(range(20)), [list(range(20)) + [20 + i] for i in range(30)]
    sharing = L.shared_sums(items, 50)
    assert sharing.sets[0] == common and sharing.additions == 19 + 30  # against 30 * 20


def test_equals_plain_ranking(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(60)] + ["Straße", "É", "中文", "A1", "the", "The"]
    gaps = [" ", ", ", "\n", "-", "\x00", "_", "  "]
    text = lambda most: "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, most)))
    docs = [(i, text(60)) for i in range(300)] + [(7, "w1 w2 w3"), (7, "w1 w2 w3"), (None, "w1 w2"), (None, None), (900, ""), (901, "w5 " * 4000)]
    docs += [(1000 + i, "w1 w9 copied text") for i in range(70)]  # ties beyond the cut
    items = [(i, text(12)) for i in range(40)] + [(3, "w9 again"), (None, "w1 w7"), (50, None), (51, "nowhere"), (52, "w1 w9 copied")]
    for nearest, block in ((50, 50_000), (3, 60)):
        got = L.search(_docs(spark, docs).repartition(6), _items(spark, items), nearest, block)
        assert found(got) == plain(docs, items, nearest), (nearest, block)


def test_small_matrices(spark, monkeypatch):
    monkeypatch.setattr(L, "CELLS", 40)
    docs = [(i, f"a{i % 7} b{i % 5} c{i % 3} common") for i in range(200)]
    items = [(i, f"a{i % 7} b{i % 5} common c1") for i in range(9)]
    assert found(L.search(_docs(spark, docs), _items(spark, items), 5)) == plain(docs, items, 5)


def test_edge_rows_and_empty_tables(spark, edge_docs, no_docs):
    items = [(1, "the quick BROWN fox"), (2, "中文 é"), (3, ""), (4, "x" * 20000)]
    asked = _items(spark, items).selectExpr("*", "1 AS doc_id", "2 AS n", "3 AS score", "4 AS terms")
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert found(L.search(edge_docs, asked)) == plain(rows, items, 50)
    assert L.search(no_docs, asked).collect() == []
    assert L.search(edge_docs, asked.limit(0)).collect() == []
    assert L.search(edge_docs.filter("text IS NULL"), asked).collect() == []
