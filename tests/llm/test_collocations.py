"""Phrase collocations against plain counting, and the filters by themselves."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tavola.llm import collocations as C
from tavola.llm import quotient_filter as Q


def plain(rows, min_count, longest, most):
    """lang, rank, phrase, a, l, r, n, score by counters in one process."""
    f, n = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f.setdefault(lang, Counter())[tuple(w[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        often = {g: a for g, a in counts.items() if a >= min_count}
        longer = Counter()
        for g, a in often.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    longer[g[i : i + k]] = max(longer[g[i : i + k]], a)
        scored = []
        for g, a in often.items():
            if len(g) > 1 and 100 * longer[g] < 80 * a:
                score, _, l, r = min((2_000_000 * a // (often[g[:k]] + often[g[k:]]), k, often[g[:k]], often[g[k:]]) for k in range(1, len(g)))
                scored.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(scored)[:most], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("order", [2, 3, 4])
@pytest.mark.parametrize("bits", [1, 5, 16, 17, 22, 32])
def test_filters_lose_nothing(order, bits):
    rng = np.random.default_rng(order * bits)
    packing, lists, want = Q.Packing(order, bits), [], Counter()
    for size in (1, 300, 4000):
        grams = np.minimum(rng.pareto(0.5, (size, order)), 2**bits - 1).astype(np.int64)
        grams = np.vstack([grams, *[grams[:1]] * 600])
        keys = packing.keys(grams)
        assert (packing.grams(keys) == grams).all()
        distinct, counts = Q.counted(keys)
        read = [Q.read_block(packing, s, b) for s, b in Q.blocks(packing, distinct, counts, min(3, order * bits))]
        assert sum(len(k) for k, _ in read) == len(distinct)
        lists += read
        want.update(map(tuple, grams.tolist()))
    keys, totals, places = Q.merged([(Q.Keys.joined([k for k, _ in lists]), np.concatenate([c for _, c in lists]))])
    assert dict(zip(map(tuple, packing.grams(keys).tolist()), totals.tolist(), strict=True)) == dict(want)
    found = keys.found_in(keys[::2])
    assert found[::2].all() and not found[1::2].any()


def _docs(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


def test_equals_plain_counting(spark):
    rng = random.Random(4)
    words = ["a", "b", "B", "ccc", "d-d", "é", "ÉÉ", "x\x00y", "中文", " ", " z"]
    gaps = [" ", "  ", "\t", ". ", "\n", ", ", " \r\n", "!", "\x0b"]
    rows = []
    for k in range(160):
        text = "".join(rng.choice(words[: 3 + k % 9]) + rng.choice(gaps[: 2 + k % 8]) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice(["en", "en", "de", None, "und"]), text))
    rows += [("en", None), ("en", ""), (None, " \n "), ("en", "a a a a a a a a"), ("zz", "only here"), ("en", "w " * 5000), *[("de", "one fixed line of text here")] * 40]
    for min_count, longest, most, size in ((2, 4, 2000, 500), (5, 3, 7, 1 << 20), (30, 4, 2000, 3000), (3, 2, 4, 200)):
        got = C.collocations(_docs(spark, rows).repartition(5), min_count, longest, most, size).collect()
        assert sorted(tuple(r) for r in got) == plain(rows, min_count, longest, most), (min_count, longest)


def test_many_shards_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(C, "SHARD_PLACES", 64)
    monkeypatch.setattr(C, "RANGE_CHARS", 1000)
    rng = random.Random(9)
    rows = [(rng.choice(["en", "fr"]), " ".join(f"w{int(rng.paretovariate(0.7))}" for _ in range(80))) for _ in range(120)]
    got = C.collocations(_docs(spark, rows).repartition(4), 2, 4, 2000, 4000).collect()
    assert sorted(tuple(r) for r in got) == plain(rows, 2, 4, 2000)


def test_edge_rows_and_empty_table(spark, edge_docs, no_docs):
    got = C.collocations(edge_docs, 2).collect()
    assert sorted(tuple(r) for r in got) == plain([(r.lang, r.text) for r in edge_docs.collect()], 2, 4, 2000)
    assert C.collocations(no_docs).collect() == []
    assert C.collocations(edge_docs.filter("text IS NULL")).count() == 0
