import zlib

import numpy as np
import pytest

from feedmart.llm import quality, queries
from feedmart.llm.common import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    return queries.op10_quality(spark, SF).collect(), labels


def test_held_out_accuracy(scored):
    rows, labels = scored
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    test = [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, _, q in test if q], [s for s, _, q in test if not q]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert len(bad) >= 5 and auc > 0.97
    assert np.mean([p == q for _, p, q in test]) > 0.95


def test_sum_of_squares_identity():
    rng = np.random.default_rng(0)
    m = quality.Machine(0.3, rng.normal(size=quality.SIZE), rng.normal(size=(quality.SIZE, quality.FACTORS)))
    idx, val = quality.features("Some words, some more words.\nAnd a line!")
    pairs = sum(m.factors[idx[a]] @ m.factors[idx[b]] * val[a] * val[b] for a in range(len(idx)) for b in range(a))
    assert m.margin(idx, val) == pytest.approx(m.bias + m.linear[idx] @ val + pairs)


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    from pyspark.sql import functions as F
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fit(docs, labels), quality.fit(docs, flipped)
    assert a.bias == b.bias and (a.linear == b.linear).all()


def test_edges(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    m = quality.fit(edge_docs, none)
    rows = quality.score(edge_docs, m).collect()
    assert len(rows) == edge_docs.count() and {r.score for r in rows} == {0.5}
    odd = spark.createDataFrame([(0, 1), (0, 0), (None, 1), (2, None), (6, 7), (7, 1), (9, 1)], "doc_id long, quality int")
    m = quality.fit(edge_docs, odd)
    assert all(0 <= r.score <= 1 for r in quality.score(edge_docs, m).collect())
    kept = quality.keep_good(edge_docs, quality.fit(edge_docs, none))
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count()
    assert quality.score(no_docs, m).count() == 0 and quality.fit(no_docs, odd).bias == 0


def _plain_score(text, m):
    """The score of one text, written out: dictionaries and loops, pairs of features one by one."""
    import math
    words = text.split()
    slots = {}
    for w in words:
        slot = zlib.crc32(w.encode()) % quality.WORDS
        slots[slot] = slots.get(slot, 0) + 1
    x = {k: math.log1p(c) for k, c in slots.items()}
    norm = math.sqrt(sum(v * v for v in x.values()))
    x = {k: v / norm for k, v in x.items()}
    stats = [0.0] * 16
    n, k = len(text), max(1, len(words))
    if n:
        share = lambda f: sum(map(f, text)) / n
        low = lambda c: chr(min(ord(c), 0x24F))
        lines = [line for line in text.split("\n") if line]
        times = {w: words.count(w) for w in set(words)}
        ends = {}
        for w in words:
            if not w[-1].isalnum():
                ends[w[-2:]] = ends.get(w[-2:], 0) + 1
        kind = lambda c: 1 if c.isupper() else 2 if c.isdigit() else 3 if c.isspace() else 0 if c.isalpha() else 4
        of = [share(lambda c, i=i: kind(low(c)) == i) for i in range(5)]
        stats = [of[1], of[2], of[4], of[3], share(lambda c: ord(c) > 0x24F), min(1, (n - len(words)) / k / 16), len(times) / k, max(times.values(), default=0) / k,
                 max(ends.values(), default=0) / k, sum(ends.values()) / k, sum(w.isupper() for w in words) / k, 1 - len(set(lines)) / (len(lines) or 1),
                 min(1, n / (len(lines) or 1) / 2000), min(1, math.log1p(n) / 16), min(1, math.log1p(len(lines) or 1) / 12), min(1, math.log1p(k) / 14)]
    for i, v in enumerate(stats):
        x[quality.WORDS + 16 * i + min(15, int(min(1, max(0, math.sqrt(v))) * 16))] = 2.0 / math.sqrt(16)
    items = list(x.items())
    total = m.bias + sum(m.linear[f] * v for f, v in items)
    for a, (f, v) in enumerate(items[:400]):
        for g, u in items[:a]:
            total += float(m.factors[f] @ m.factors[g]) * v * u
    return None if len(items) > 400 else 1 / (1 + math.exp(-max(-30, min(30, total))))


def test_query_equals_a_plain_reimplementation(spark):
    docs, labels = table(spark, "/root/testdata/sf0.001", "documents"), table(spark, "/root/testdata/sf0.001", "labels")
    m = quality.fit(docs, labels)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    compared = 0
    for r in queries.op10_quality(spark, "/root/testdata/sf0.001").collect():
        want = _plain_score(texts[r.doc_id], m) if len(texts[r.doc_id]) < 3000 else None
        if want is not None:
            assert r.score == pytest.approx(want, abs=1e-9)
            compared += 1
    assert compared > 100


def test_an_id_with_several_texts_trains_with_the_smallest(spark):
    rows = [(i, f"word{i} text of {i}") for i in range(40)] + [(i, f"zzz another {i}") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    machines = [quality.fit(spark.createDataFrame(r, "doc_id long, text string").repartition(n), labels) for r, n in ((rows, 3), (rows[::-1], 5), (rows[40:] + rows[:40], 1))]
    assert all((m.linear == machines[0].linear).all() and m.bias == machines[0].bias for m in machines)
