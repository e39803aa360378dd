import random
import re
from collections import defaultdict

import numpy as np
import pytest

from feedmart.llm import ngram_join, queries
from feedmart.llm.common import table


def _set(text, n):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    k = min(n, len(words))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if words else set()


def _brute(rows, n, num, den):
    """(doc_id, n_shingles, component, links) of rows with unique ids."""
    sets = {i: _set(t, n) for i, t in rows}
    by_token = defaultdict(list)
    for i, s in sets.items():
        for t in s:
            by_token[t].append(i)
    links, seen = defaultdict(set), set()
    for ids in by_token.values():
        for a in ids:
            for b in ids:
                if a < b and (a, b) not in seen:
                    seen.add((a, b))
                    if den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                        links[a].add(b)
                        links[b].add(a)
    component = {}
    for i in sorted(sets):
        if i not in component:
            stack = [i]
            while stack:
                x = stack.pop()
                if x not in component:
                    component[x] = i
                    stack += links[x]
    return sorted((i, len(s), component[i], len(links[i])) for i, s in sets.items())


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    want = _brute(rows, 3, 90, 100)
    assert sorted(map(tuple, queries.op1_ngram_join(spark, sf).collect())) == want
    assert any(r[2] != r[0] for r in want)


@pytest.fixture(scope="module")
def copies():
    """Chains of edited copies, shared passages, and texts of every small size."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(3))
    passage = " ".join(word() for _ in range(30))
    texts = []
    for _ in range(12):
        base = [word() for _ in range(rng.choice([5, 12, 40, 90]))]
        for _ in range(rng.randint(3, 25)):
            if rng.random() < 0.5 and base:
                base = list(base)
                base[rng.randrange(len(base))] = word()
            own = list(base)
            for _ in range(rng.randint(0, 2)):
                own[rng.randrange(len(own))] = word()
            texts.append(" ".join(own))
    texts += [passage + " " + " ".join(word() for _ in range(rng.randint(0, 12))) for _ in range(60)]
    texts += [" ".join(rng.choice("xy") for _ in range(rng.randint(0, 8))) for _ in range(60)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("n, num, den", [(3, 90, 100), (5, 80, 100), (2, 60, 100), (1, 50, 100)])
def test_edited_copies(spark, copies, n, num, den, monkeypatch):
    monkeypatch.setattr(ngram_join, "SHORT", 4)
    docs = spark.createDataFrame(copies, "doc_id long, text string")
    got = sorted(map(tuple, ngram_join.jaccard_components(docs, n, num, den).collect()))
    assert got == _brute(copies, n, num, den)


def test_split_blocks_and_lists(spark, copies, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 5)
    monkeypatch.setattr(ngram_join, "SPLIT", 6)
    monkeypatch.setattr(ngram_join, "HEAVY", 256)
    docs = spark.createDataFrame(copies, "doc_id long, text string")
    assert sorted(map(tuple, ngram_join.jaccard_components(docs, 3, 80, 100).collect())) == _brute(copies, 3, 80, 100)


def test_blocks_split_by_size(spark, monkeypatch):
    """One block of texts that grow by a word each: parts meet their neighbours in size only, and no link is lost."""
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 3)
    monkeypatch.setattr(ngram_join, "SHORT", 2)
    words = [f"w{i % 211}" for i in range(130)]
    rows = [(i, " ".join(words[:3 + i % 120])) for i in range(140)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for num, den in ((90, 100), (100, 100)):
        assert sorted(map(tuple, ngram_join.jaccard_components(docs, 3, num, den).collect())) == _brute(rows, 3, num, den)
    members = spark.createDataFrame([(bytes([i]), i, 1, n, 7) for i, n in enumerate([1, 9, 10, 10, 11, 100, 111, 112, 500])],
                                    "sig binary, rep long, copies long, n long, component long")
    got = {r.rep: r for r in ngram_join._with_parts(members, 90, 100).collect()}
    meet = {(a, b) for a in got for b in got if got[b].part in got[a].others}
    assert {(1, 2), (2, 3), (2, 1), (2, 4), (5, 6)} <= meet and not {(0, 1), (4, 5), (7, 8), (0, 8)} & meet
    assert all((b, a) in meet for a, b in meet)


def test_full_bitmap_changes_nothing(spark, copies, monkeypatch):
    full = lambda docs, n: (np.full((1 << 27) // 8, 255, np.uint8), np.zeros(0, np.uint64), np.zeros(0, np.uint32))
    monkeypatch.setattr(ngram_join, "frequencies", full)
    docs = spark.createDataFrame(copies, "doc_id long, text string")
    assert sorted(map(tuple, ngram_join.jaccard_components(docs, 3, 90, 100).collect())) == _brute(copies, 3, 90, 100)


def test_edges(spark, edge_docs, no_docs):
    unique = edge_docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    rows = [(r.doc_id, r.text) for r in unique.collect()]
    assert sorted(map(tuple, ngram_join.jaccard_components(unique).collect())) == _brute(rows, 3, 90, 100)
    got = sorted(map(tuple, ngram_join.jaccard_components(edge_docs).collect()), key=str)
    assert len(got) == edge_docs.count() and (None, 1, None, 0) in got
    assert [r for r in got if r[0] == 4] == [(4, 1, 4, 2)] * 3
    assert ngram_join.jaccard_components(no_docs).count() == 0
    kept = ngram_join.keep_one(unique)
    assert kept.columns == edge_docs.columns and kept.count() == unique.count() - 1


def test_shingles():
    assert len(ngram_join.shingles("A b  C\na B c", 3)) == 3
    assert (ngram_join.shingles("  x y\t", 3) == ngram_join.shingles("X\x0bY", 3)).all()
    assert len(ngram_join.shingles("\n \t", 3)) == 0 == len(ngram_join.shingles(None, 3))
    words = ["".join(random.Random(i).choices("abcdefgh", k=1 + i % 9)) + str(i) for i in range(5000)]
    assert len(np.unique(ngram_join.word_hashes(" ".join(words)))) == 5000


def test_components_of_a_path(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, 160), (7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in ngram_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 5 for i in [5, *range(100, 161)]} | {200: 200, 201: 200}
