import math
import random

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedmart.llm import hard_negatives as hn
from feedmart.llm import queries


def _brute(rows, every=50, positives=5, negatives=3, low=50, high=95, relabel=True):
    """Result rows from (id, vector, label) in plain integers."""
    own = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        own.append((i, [math.floor(256 * x) for x in v], math.fmod(label + 1, 10) if relabel and i % 7 == 0 else label))
    out = []
    for i, x, label in own:
        if i % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), j, other) for j, y, other in own if j != i)
        for minus, j, _ in [r for r in scored if r[2] == label][:positives]:
            fit = [(s, k) for s, k, other in scored if other != label and low * -minus <= 100 * -s <= high * -minus]
            out += [(i, j, rank, k, -minus, -s) for rank, (s, k) in enumerate(fit[:negatives], 1)]
    return sorted(out)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def _got(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()))


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    want = con.sql(queries.ORACLE["op13_hard_negatives"])
    got = queries.op13_hard_negatives(spark, sf)
    assert got.columns == list(want.columns) == COLUMNS
    assert _got(got) == sorted(want.fetchall()) != []


SCHEMA = "vec_id long, embedding array<double>, label int, score long, anchor long, ids string"


def _frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA)


@pytest.mark.parametrize("group", [3, 4096])
def test_ties_repeats_and_rows_that_take_no_part(spark, monkeypatch, group):
    """Few different scores, repeated ids and rows, vectors of several lengths; blocks and groups of anchors are small."""
    monkeypatch.setattr(hn, "BLOCK", 16)
    monkeypatch.setattr(hn, "ANCHORS", group)
    rng = random.Random(group)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(rng.choice([3, 4, 5]))], rng.choice([0, 1, 1, 1, 9])) for i in range(400)]
    rows += [rows[50], rows[50], rows[51], (100, [1.0, 1.0], 1), (-50, [1.0, 0.5, 0.5], 0), (1000, [], 3), (1050, [0.0], 3)]
    bad = [(None, [1.0] * 4, 1), (2000, None, 1), (2050, [1.0] * 4, None), (2100, [1.0, None], 1), (2150, [float("nan")], 1), (2200, [float("-inf")], 1)]
    rng.shuffle(rows)
    df = hn.hard_negatives(_frame(spark, rows + bad).repartition(5))
    assert _got(df) == _brute(rows)
    assert _got(hn.hard_negatives(_frame(spark, rows), 40, 2, 4, 10, 100, relabel=None)) == _brute(rows, 40, 2, 4, 10, 100, False)


def test_empty_and_without_partners(spark):
    assert hn.hard_negatives(_frame(spark, [])).columns == COLUMNS
    assert hn.hard_negatives(_frame(spark, [])).count() == 0
    assert hn.hard_negatives(_frame(spark, [(50, [1.0], 1)])).count() == 0
    assert hn.hard_negatives(_frame(spark, [(50, [1.0], 1), (51, [1.0], 1)])).count() == 0


def test_large_components(spark):
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-5e5, 5e5) for _ in range(5)], i % 3) for i in range(150)]
    assert _got(hn.hard_negatives(_frame(spark, rows), 10)) == _brute(rows, 10) != []
    with pytest.raises(Exception, match="beyond"):
        hn.hard_negatives(_frame(spark, [(0, [1e9], 1)])).collect()


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 70), st.integers(0, 2**32 - 1), st.sampled_from([1, 100, 1 << 26]))
def test_bounds_hold_at_every_level(dims, seed, size):
    rng = np.random.default_rng(seed)
    x, y = rng.integers(-size, size + 1, (7, dims)), rng.integers(-size, size + 1, (5, dims)) + rng.integers(-size, size + 1)
    a, b = hn._summary(x), hn._summary(y)
    score = x.astype(np.int64) @ y.T.astype(np.int64)
    width = []
    for level in hn.LEVELS:
        low, high = a.bounds(b, level, np.arange(7), np.arange(5))
        assert (low <= score).all() and (score <= high).all()
        width.append((high - low).sum())
    assert width == sorted(width, reverse=True) or np.allclose(width, sorted(width, reverse=True))


def test_longer_segments_follow_from_shorter_ones():
    x = np.random.default_rng(1).integers(-500, 500, (20, 64))
    for s in hn.LEVELS:
        mean, deviation, _ = hn.summaries(x, s)
        m, d = hn.merged(*hn.summaries(x)[:2], s)
        assert np.allclose(mean, m) and np.allclose(deviation, d)


def test_bounds_leave_few_pairs_to_score():
    """Vectors that are smooth inside segments: nearly all pairs outside of the window go before they are scored."""
    rng = np.random.default_rng(2)
    shape = np.repeat(rng.normal(0, 100, (300, 16)), 4, axis=1)
    x = (shape + rng.normal(0, 3, shape.shape)).astype(np.int64)
    a, b = hn._summary(x[:40]), hn._summary(x)
    score = x[:40] @ x.T
    least = np.sort(score, 1)[:, -10].astype(float)
    own, others, alive = hn.surviving(a, b, np.ones((40, 300), bool), least, np.full(40, np.inf))
    assert alive.sum() < 0.06 * 40 * 300
    full = np.zeros((40, 300), bool)
    full[np.ix_(own, others)] = alive
    assert full[score >= least[:, None]].all()
