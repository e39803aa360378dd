import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from feedmart.llm import packing, queries
from feedmart.llm.common import table

tokenizers = pytest.importorskip("tokenizers")
JSON = queries.tokenizer_path("byte_bpe_50k.json")


def _check(rows, docs, library, capacity=2048):
    """Pieces cover each document exactly; sequences are gapless and hold at most ``capacity`` tokens."""
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for doc_id, text in docs:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        own = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [r.start for r in own] == list(np.cumsum([0] + [r.length for r in own[:-1]]))
        assert sum(r.length for r in own) == len(ids) and len(own) == -(-len(ids) // capacity)
        assert all(r.length == capacity for r in own[1:])
        assert all(zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32 for r in own)
    by_seq = defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append((r.offset, r.length))
    for parts in by_seq.values():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0] + [n for _, n in parts[:-1]])) and sum(n for _, n in parts) <= capacity
    return len(by_seq)


def test_query(spark, sf_dir):
    library = tokenizers.Tokenizer.from_file(JSON)
    docs = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    rows = queries.op4_packing(spark, sf_dir).collect()
    used = _check(rows, docs, library)
    assert used <= -(-sum(r.length for r in rows) // 2048) + 1


def test_edges(edge_docs, no_docs):
    library = tokenizers.Tokenizer.from_file(JSON)
    docs = edge_docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    _check(packing.pack(docs, JSON, capacity=64).collect(), [(r.doc_id, r.text) for r in docs.collect()], library, 64)
    repeated = packing.pack(edge_docs, JSON).collect()
    assert sum(r.doc_id == 4 for r in repeated) == 3 and sum(r.doc_id is None for r in repeated) == 1
    assert len({(r.sequence_id, r.offset) for r in repeated}) == len(repeated)
    assert packing.pack(no_docs, JSON).count() == 0
    with_ids = packing.pack(docs, JSON, capacity=64, ids=True).collect()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in with_ids)


def _optimum(items, capacity):
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for n in sorted(set(bins)):
            if n + items[i] <= capacity:
                rest = list(bins)
                rest.remove(n)
                go(i + 1, rest + [n + items[i]])
        go(i + 1, bins + [items[i]])
    go(0, [])
    return best[0]


def test_reduction_keeps_the_optimum():
    rng = random.Random(11)
    fixed_any = 0
    for _ in range(400):
        capacity = rng.choice([10, 17, 30])
        items = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 9))), reverse=True)
        if rng.random() < 0.4:
            items = sorted((rng.choice(items) for _ in items), reverse=True)
        fixed, rest = packing.reduce_instance(Counter(items), capacity)
        packed = Counter()
        for n, runs in fixed:
            assert sum(s * k for s, k in runs) <= capacity
            for s, k in runs:
                packed[s] += n * k
        assert packed + Counter(rest) == Counter(items)
        left = sorted((s for s, c in rest.items() for _ in range(c)), reverse=True)
        assert sum(n for n, _ in fixed) + (_optimum(left, capacity) if left else 0) == _optimum(items, capacity), items
        fixed_any += bool(fixed)
    assert fixed_any > 200


def _plain_best_fit(items, capacity):
    rooms = []
    for s in sorted(items, reverse=True):
        fit = [r for r in rooms if r >= s]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - s)
        else:
            rooms.append(capacity - s)
    return len(rooms)


def test_runs_equal_piecewise_best_fit():
    rng = random.Random(2)
    for _ in range(200):
        items = [rng.choice([1, 2, 3, 5, 7, 11, 20, 31, 50]) for _ in range(rng.randint(1, 80))]
        patterns = packing.best_fit(Counter(items), 50)
        assert sum(n for n, _ in patterns) == _plain_best_fit(items, 50)
        total = Counter()
        for n, runs in patterns:
            assert sum(s * k for s, k in runs) <= 50
            for s, k in runs:
                total[s] += n * k
        assert total == Counter(items)


def test_large_histogram_is_quick():
    rng = random.Random(4)
    hist = {s: rng.randint(1, 10**9) for s in range(1, 2049)}
    patterns = packing.pack_lengths(hist)
    assert sum(n for n, _ in patterns) <= -(-sum(s * c for s, c in hist.items()) // 2048) * 1.01
    assert len(patterns) < 20_000
