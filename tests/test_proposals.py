"""Proposed category names: planted variants, brute force over random names, and reviewed proposals that drive a load."""

import random
import re

import pytest
from pyspark.sql import functions as F

from feedmart.operators.components import components
from feedmart.operators.normalise import letter_grams, propose_categories, similar_names
from feedmart.plans import full_load
from feedmart.sources.store import Store
from tests.feeds import write_landing
from tests.test_commits import _feed, _item


def _grams(name):
    words = [w for w in re.split(r"[\W_]+", name.lower()) if w]
    return {("#" + w + "#")[i:i + 3] for w in words for i in range(len(w))}


def _groups(keys, percent):
    group = {k: k for k in keys}
    pairs = {}
    for a in keys:
        for b in keys:
            ga, gb = _grams(a), _grams(b)
            if a < b and ga and gb and 100 * len(ga & gb) >= percent * len(ga | gb):
                pairs[a, b] = len(ga & gb) / len(ga | gb)
    for _ in keys:
        for a, b in pairs:
            group[a] = group[b] = min(group[a], group[b])
    return pairs, group


@pytest.mark.parametrize("percent", [40, 50, 75, 100])
def test_pairs_and_groups_equal_brute_force(spark, percent):
    rng = random.Random(percent)
    stems = ["sport", "science", "world news", "economy", "art", "мир", "спорт", "top 10", "a"]
    keys = set()
    while len(keys) < 90:
        words = rng.choice(stems).split() + rng.sample(["news", "today", "x"], rng.randint(0, 2))
        rng.shuffle(words)
        name = rng.choice([" ", "-", " & "]).join(words)
        keys.add(name[:rng.randint(1, 20)] + rng.choice(["", "s", "!", " 1"]))
    keys |= {"", "--", "?"}
    names = spark.createDataFrame([(k,) for k in keys], "key string")
    pairs, group = _groups(sorted(keys), percent)
    got = {(r.a, r.b): r.overlap for r in similar_names(names, percent).collect()}
    assert got == pytest.approx(pairs) and got
    found = {r.node: r.component for r in components(similar_names(names, percent)).collect()}
    assert found == {k: g for k, g in group.items() if any(k in p for p in pairs)}
    assert {r.key: set(r.g) for r in names.select("key", letter_grams(F.col("key")).alias("g")).collect()} == {k: _grams(k) for k in keys}


def test_planted_variants_get_the_most_used_name(spark):
    rows = [("Sport", "a", 50), ("SPORT ", "b", 20), ("Sports", "b", 30), ("World-News", "a", 5), ("news world", "b", 9), ("Economy", "a", 7),
            ("Cars", "a", 3), ("?", "a", 1), (None, "a", 4)]
    got = {r.key: r for r in propose_categories(spark.createDataFrame(rows, "name string, source string, n long")).collect()}
    assert {k: (r.canonical, r.n, r.sources) for k, r in got.items()} == {
        "sport": ("Sport", 70, 2), "sports": ("Sport", 30, 1), "world-news": ("news world", 5, 1), "news world": ("news world", 9, 1)}
    assert got["news world"].overlap == 1.0 and {r.status for r in got.values()} == {"proposed"}
    only_case = spark.createDataFrame([("Art", "a", 1), ("ART", "b", 2)], "name string, source string, n long")
    assert [(r.key, r.canonical, r.n) for r in propose_categories(only_case).collect()] == [("art", "ART", 3)]
    assert propose_categories(spark.createDataFrame([], "name string, source string, n long")).count() == 0


def test_reviewed_proposals_drive_a_load(spark, tmp_path):
    first = write_landing(tmp_path / "a", {"s": _feed(_item("a1", "Sport"), _item("a2", "Sport"), _item("a3", "Art")),
                                           "t": _feed(_item("b1", "Sports"), _item("b2", "Arts"))})
    root = str(tmp_path / "raw")
    full_load(spark, first, root, as_of="2023-08-22")
    store = Store(spark, root).register()
    proposed = store.propose_categories(40)
    assert {r.key: r.canonical for r in proposed.collect()} == {"sport": "Sport", "sports": "Sport", "art": "Art", "arts": "Art"}
    assert store.reviewed_mapping().count() == 0  # nothing is applied before it was reviewed
    store.review_categories(spark.createDataFrame([("sports", "accepted", None), ("arts", "declined", None), ("art", "accepted", "Culture")],
                                                  "key string, status string, canonical string"))
    mapping = {r.key: r.canonical for r in store.reviewed_mapping().collect()}
    assert mapping == {"sports": "Sport", "art": "Culture"}
    again = {r.key: (r.canonical, r.status) for r in store.propose_categories(40).collect()}  # decisions stay
    assert again == {"sport": ("Sport", "proposed"), "sports": ("Sport", "accepted"), "art": ("Culture", "accepted"), "arts": ("Art", "declined")}
    assert spark.table("core_store.category_proposals").count() == 4
    mart = full_load(spark, first, str(tmp_path / "mapped"), as_of="2023-08-22", mapping=store.reviewed_mapping())
    assert {(r.category, r.source): r.source_count_category_news for r in mart.collect()} == {
        ("Sport", "s"): 2, ("Sport", "t"): 1, ("Culture", "s"): 1, ("Arts", "t"): 1}
