"""Near-duplicates against all pairs by brute force."""

import random

import numpy as np
import pytest

from tavola.llm import near_duplicates as nd


def plain_sets(texts):
    """Shingle sets as sets of word tuples."""
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    return out


def plain_components(rows, similar=85):
    """doc_id -> smallest reachable doc_id over all pairs."""
    sets = plain_sets([t for _, t in rows])
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= similar * (len(sets[a]) + len(sets[b]) - common):
                x, y = root(rows[a][0]), root(rows[b][0])
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i, _ in rows}, {i: len(s) for (i, _), s in zip(rows, sets, strict=True)}


def edited(rng, words, share):
    return " ".join(rng.choice(["up", "so", "of", "an", "it", "zq%d" % rng.randint(0, 99)]) if rng.random() < share else w for w in words)


def corpus(seed):
    """A large group of near copies at many distances of one text, small groups, chains of drifting
    copies, exact copies, and short and empty texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5)))
    texts = []
    base = [word() for _ in range(140)]
    texts += [edited(rng, base, rng.uniform(0, 0.06)) for _ in range(150)]
    for _ in range(8):
        own = [word() for _ in range(rng.randint(30, 200))]
        texts += [edited(rng, own, rng.uniform(0, 0.03)) for _ in range(rng.randint(2, 6))]
    drift = [word() for _ in range(200)]
    for _ in range(12):
        drift = edited(rng, drift, 0.012).split()
        texts.append(" ".join(drift))
    texts += [texts[0]] * 20 + [texts[3].upper(), texts[3].replace(" ", "\n\t ")]
    texts += [None, "", " \n", "a b", "A  b", "a b c d e", "a b c d e f", "a b c d", "a b c d"]
    rng.shuffle(texts)
    return [(7 * i + 3, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("cell", [512, 16])
def test_components_equal_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(nd, "CELL", cell)
    monkeypatch.setattr(nd, "TOGETHER", 40)
    rows = corpus(cell)
    want, sizes = plain_components(rows)
    got = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_intersections_by_matrix_product():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 200))).astype(np.uint64) for _ in range(12)]
    left, right = np.arange(5), np.arange(5, 12)
    want = [[len(np.intersect1d(sets[a], sets[b])) for b in right] for a in left]
    assert (nd._all_common(sets, left, right, width=16) == want).all()
    assert nd._common(sets[0], sets[7]) == want[0][2]


def test_posterior_bounds():
    least = nd.least_matches()
    assert list(least) == sorted(least) and least[-1] < 0.85 * nd.HASHES
    # the posterior tail by numerical integration of the Beta density
    n, m = nd.BATCH * 4, least[3]
    s = np.linspace(0, 1, 200_001)
    for k, above in ((m, True), (m - 1, False)):
        density = s**k * (1 - s) ** (n - k)
        assert (density[s >= 0.85].sum() / density.sum() >= nd.MISS) == above


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = np.sort(pool[:2000]), np.sort(pool[500:2500])  # similarity 0.6
    assert abs((nd.signature(a) == nd.signature(b)).mean() - 0.6) < 0.13


def test_edge_rows(spark, edge_docs, no_docs):
    got = nd.near_duplicates(edge_docs).collect()
    assert len(got) == edge_docs.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert [(r.n_shingles, r.component_id) for i in (0, 1, 2) for r in by[i]] == [(0, 0), (0, 1), (0, 2)]
    assert by[3][0].n_shingles == 1 and by[5][0].component_id == 4 and len(by[4]) == 4
    assert all(r.component_id is None and not r.kept for r in by[None])
    assert nd.near_duplicates(no_docs).count() == 0


def test_repeated_ids_with_different_texts(spark):
    rng = random.Random(5)
    new = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    a, b, c, d = ([new() for _ in range(120)] for _ in range(4))
    text, near = " ".join, lambda words: " ".join([*words, new()])
    # 5 is the smallest id of both its texts; 22 of neither; every text has near copies elsewhere
    rows = [(5, text(a)), (5, text(b)), (9, near(a)), (10, near(b)), (11, text(b)), (5, text(b))]
    rows += [(20, text(c)), (21, text(d)), (22, text(c)), (22, text(d)), (31, near(c)), (32, near(d)), (40, text(new() for _ in range(60)))]
    got = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == sorted((i, 5 if i < 20 else 20 if i < 40 else 40) for i, _ in rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
