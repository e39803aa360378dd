import random

import numpy as np
import pytest

from feedmart.llm import queries, super_minhash
from feedmart.llm.common import table

from test_ngram_join import _brute, copies  # noqa: F401


def _want(rows, n, num, den):
    return [(i, size, component, i == component) for i, size, component, _ in _brute(rows, n, num, den)]


def _got(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id", "kept").collect()))


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    want = _want(rows, 2, 80, 100)
    assert _got(queries.op12_super_minhash(spark, sf)) == want
    assert not all(r[3] for r in want)


@pytest.mark.parametrize("n, num, den", [(2, 80, 100), (5, 80, 100), (1, 90, 100)])
def test_edited_copies(spark, copies, n, num, den):  # noqa: F811
    docs = spark.createDataFrame(copies, "doc_id long, text string")
    assert _got(super_minhash.near_duplicates(docs, n, num, den)) == _want(copies, n, num, den)


def test_split_blocks(spark, copies, monkeypatch):  # noqa: F811
    from feedmart.llm import ngram_join
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 5)
    monkeypatch.setattr(super_minhash, "FEW", 1)
    docs = spark.createDataFrame(copies, "doc_id long, text string")
    assert _got(super_minhash.near_duplicates(docs, 2, 80, 100)) == _want(copies, 2, 80, 100)


def test_edges(spark, edge_docs, no_docs):
    unique = edge_docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    rows = [(r.doc_id, r.text) for r in unique.collect()]
    assert _got(super_minhash.near_duplicates(unique, 2)) == _want(rows, 2, 80, 100)
    got = [tuple(r) for r in super_minhash.near_duplicates(edge_docs, 2).collect()]
    assert len(got) == edge_docs.count() and (None, 1, None, True) in got
    assert [r for r in got if r[0] == 4] == [(4, 1, 4, True)] * 3
    assert super_minhash.near_duplicates(no_docs).count() == 0
    kept = super_minhash.keep_one(unique)
    assert kept.columns == edge_docs.columns and kept.count() == unique.count() - 1


def _plain(values, slots):
    """One set, one shingle after the other, each with a shuffle of its own; stops a shingle at the worst rank in use."""
    best = [(1 << 64) - 1] * slots
    for x in values:
        places = list(range(slots))
        for rank in range(slots):
            if max(best) < rank << 48:
                break
            z = int(super_minhash._mixed(np.array([(x + 0x9E3779B97F4A7C15 * (rank + 1)) % (1 << 64)], np.uint64))[0])
            pick = rank + ((z >> 48) * (slots - rank) >> 16)
            places[rank], places[pick] = places[pick], places[rank]
            best[places[rank]] = min(best[places[rank]], rank << 48 | z & (1 << 48) - 1)
    return best


def test_rounds_equal_the_plain_algorithm():
    rng = np.random.default_rng(3)
    for slots in (128, 16, 5):
        sets = [rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (1, 2, 3, 7, 40, 300, 1000, 1)]
        got = super_minhash.super_minhash(sets, slots)
        assert [_plain(s.tolist(), slots) for s in sets] == got.tolist()
    assert super_minhash.super_minhash([], 8).shape == (0, 8)


def test_estimate_has_no_bias_and_less_variance_than_independent_hashes():
    rng = np.random.default_rng(4)
    for n, shared in ((5, 4), (30, 20), (150, 120)):
        t = shared / (2 * n - shared)
        found = []
        for _ in range(1500):
            x = rng.integers(0, 1 << 63, 2 * n - shared, dtype=np.uint64)
            a, b = super_minhash.super_minhash([x[:n], x[n - shared:]])
            found.append((a == b).mean())
        independent = t * (1 - t) / 128
        assert abs(np.mean(found) - t) < 5 * (independent / 1500) ** 0.5
        assert np.var(found) < 0.9 * independent


def test_bands_of_pairs_at_the_threshold():
    """All of 3000 pairs with similarity 0.8 share a band, and pass the cut of the sketch."""
    rng = np.random.default_rng(5)
    for n, shared in ((9, 8), (90, 80), (5, 5)):
        x = [rng.integers(0, 1 << 63, 2 * n - shared, dtype=np.uint64) for _ in range(1000)]
        a = super_minhash.super_minhash([v[:n] for v in x])
        b = super_minhash.super_minhash([v[n - shared:] for v in x])
        assert (super_minhash.band_keys(a) == super_minhash.band_keys(b)).any(1).all()
        assert ((a == b).sum(1) > super_minhash.sketch_cut(80, 100)).all()


@pytest.mark.parametrize("cells", [1 << 30, 0])
def test_forest_equals_all_pairs(monkeypatch, cells):
    monkeypatch.setattr(super_minhash, "BIT_CELLS", cells)
    monkeypatch.setattr(super_minhash, "FEW", 2)
    rng = random.Random(6)
    base = [set(range(100 * g, 100 * g + rng.randint(8, 60))) for g in range(6)]
    sets = []
    for _ in range(120):
        s = set(rng.choice(base))
        sets.append(s - set(rng.sample(sorted(s), rng.randint(0, len(s) // 5))) | {rng.randint(1000, 1100) for _ in range(rng.randint(0, 2))})
    arrays = [np.sort(super_minhash._mixed(np.array(sorted(s), np.uint64))) for s in sets]
    sketches = (super_minhash.super_minhash(arrays) & np.uint64(255)).astype(np.uint8)
    root = super_minhash.forest(arrays, sketches, np.arange(120), np.arange(120), 80, 100)
    want = list(range(120))
    for _ in range(120):
        for i in range(120):
            for j in range(120):
                if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    want[i] = want[j] = min(want[i], want[j])
        if all(want[w] == w for w in want):
            break
    groups = lambda r: sorted(sorted(np.flatnonzero(np.array(r) == x).tolist()) for x in set(r))
    assert groups(root.tolist()) == groups(want) and len(set(want)) < 100
