"""The mart from merged states, and constraint checks of new loads only, against whole rebuilds and whole checks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from feedmart.operators import mart
from feedmart.operators.quality import check_store
from feedmart.plans import full_load, load
from feedmart.plans.load import build_mart
from feedmart.sources import store as stores
from feedmart.sources.store import Store
from tests.feeds import write_landing
from tests.test_commits import _feed, _item, _rows

DAY = "category string, source string, published date, n long"


def _days(rng, n, undated=True):
    out = []
    for _ in range(n):
        day = None if undated and rng.random() < 0.1 else dt.date(2023, 8, 14) + dt.timedelta(rng.randrange(10))
        out.append((rng.choice(["A", "B", "C", None]), rng.choice(["s", "t", "u"]), day, rng.randint(1, 4)))
    return out


@pytest.mark.parametrize("compat", [True, False])
def test_state_and_new_days_equal_all_days(spark, compat):
    rng = random.Random(7)
    for size, fresh in ((40, 6), (0, 30), (60, 0), (300, 40)):
        earlier, new = _days(rng, size), _days(rng, fresh)
        old = spark.createDataFrame(earlier, DAY).groupBy("category", "source", "published").agg(F.sum("n").alias("n"))
        added = spark.createDataFrame(new, DAY)
        whole = spark.createDataFrame(earlier + new, DAY).groupBy("category", "source", "published").agg(F.sum("n").alias("n"))
        days = {r[2] for r in new} | {dt.date(2023, 8, 20)}
        near = old.where(F.col("published").isin([d for d in days if d]))
        got = mart.mart_from_state(mart.pair_state(old), mart.category_state(old), near, added, "2023-08-20", compat)
        want = mart.mart_from_days(whole, "2023-08-20", compat)
        assert got.schema == want.schema and _rows(got) == _rows(want)


@pytest.mark.parametrize("compat, loads", [(True, 5), (False, 10)])
def test_random_loads_equal_full_rebuilds(spark, tmp_path, monkeypatch, compat, loads):
    monkeypatch.setattr(stores, "MERGE_RUNS", 2)
    rng, root = random.Random(11), str(tmp_path / "store")
    table = "news_days" if compat else "pair_days"
    for i in range(loads):
        items = [_item(f"n{rng.randrange(40)}", *rng.sample(["A", "B", "C", "D"], rng.randint(1, 3)), day=rng.randint(10, 24)) for _ in range(5)]
        landing = write_landing(tmp_path / f"l{i}", {rng.choice("st"): _feed(*items)})
        got = full_load(spark, landing, root, as_of="2023-08-22", compat=compat, name="again" if i in (2, 7) else None, store=Store(spark, root))
        store = Store(spark, root)
        assert len(store._log_paths(table)) <= 3
        if i in (1, 4, 9):
            assert _rows(got) == _rows(build_mart(store, "2023-08-22", compat, from_log=False))
    assert store.log_state(table) is not None
    assert {r.violations for r in check_store(store).collect()} == {0}


def test_a_days_build_reads_the_days_it_touches(spark, tmp_path):
    """The merged log is sorted by day: the scan gets the range of the new days as a pushed-down filter."""
    store, root = Store(spark, str(tmp_path / "store")), str(tmp_path / "store")
    for i in range(2):
        full_load(spark, write_landing(tmp_path / f"l{i}", {"s": _feed(_item(f"a{i}", "A"), _item(f"b{i}", "B", day=20 + i))}), root, as_of="2023-08-22", store=store)
    assert store.merge_log("news_days", 0) and not store.merge_log("news_days", 0)
    full_load(spark, write_landing(tmp_path / "l9", {"s": _feed(_item("z", "A", day=22))}), root, as_of="2023-08-22", store=store)
    seen = []
    real = load.mart_from_state
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(load, "mart_from_state", lambda p, c, old, new, *a, **k: seen.append(old) or real(p, c, old, new, *a, **k))
        got = _rows(build_mart(store, "2023-08-22"))
    assert got == _rows(build_mart(store, "2023-08-22", from_log=False))
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "2023-08-22" in plan.split("PushedFilters")[1] and seen[0].count() == 0


def test_the_mart_reads_its_fact_once(spark, tmp_path):
    """Rows read by the scans of a corrected mart: each fact row once."""
    rows = spark.range(5000).select(F.col("id").alias("new_id"), F.concat(F.lit("c"), F.col("id") % 7).alias("category"),
                                    F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.date_add(F.lit("2023-08-01"), (F.col("id") % 20).cast("int")).alias("published"))
    rows.write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    for compat in (True, False):
        before = seen.value
        out = mart.mart(fact.mapInArrow(count, fact.schema), "2023-08-20", compat)
        assert out.count() == 21 and seen.value - before == 5000


def test_checks_since_a_load_find_what_later_loads_broke(spark, tmp_path):
    """A clean store, then a duplicate, a NULL key and orphans are planted as rows of a later load; older news aren't scanned."""
    from feedmart.operators.quality import check_since, verified_load
    root = str(tmp_path / "store")
    store = Store(spark, root)
    for i in range(3):
        full_load(spark, write_landing(tmp_path / f"l{i}", {"s": _feed(_item(f"a{i}", "A", "B"), _item(f"b{i}", "B"), _item("a0", f"Z{i}"))}), root,
                  as_of="2023-08-22", compat=False, store=store)
    found = lambda since: {(r.check, r.table, r.columns): r.violations for r in check_since(store, since).collect() if r.violations}
    report = check_store(store, since=1, mark=True)
    assert report.count() == 14 and found(1) == found(0) == {} and verified_load(store) == 3
    news, pairs = store.read("core_store", "news"), store.read("core_store", "news_tag_pairs")
    fixed = lambda df: spark.createDataFrame(df.collect(), df.schema)
    calls, real = [], store.history
    store.history = lambda table, loads: calls.append((table, loads)) or real(table, loads)
    assert found(2) == {} and ("news", []) in calls  # no older load holds a key of the new news: none is read
    store.history = real
    one = fixed(news.where("new_raw_id = 'a0'").withColumn("load_id", F.lit(4).cast("long")))
    planted = [one,                                                                    # a raw id and a new_id for the second time
               one.withColumn("new_raw_id", F.lit("x")).withColumn("new_id", F.lit(None).cast("long")),          # a NULL key
               one.withColumn("new_raw_id", F.lit("y")).withColumn("new_id", F.lit(90).cast("long")).withColumn("tag_id", F.lit(77).cast("long"))]  # an orphan
    for rows in planted:
        store.append_news(rows)
    again = fixed(pairs.where("new_raw_id = 'a0'").limit(1).withColumn("load_id", F.lit(4).cast("long")))
    store.append_pairs(again.withColumn("news_load", F.lit(1)))                        # a pair for the second time
    store.append_pairs(again.withColumn("new_raw_id", F.lit("nowhere")).withColumn("new_id", F.lit(91).cast("long")).withColumn("news_load", F.lit(4)))
    got = found(3)
    assert got[("primary key", "core_store.news", "new_id")] == 2 and got[("unique", "core_store.news", "new_raw_id")] == 1
    assert got[("primary key", "core_store.news_tag_pairs", "new_id, tag_id")] == 1
    assert got[("foreign key", "core_store.news", "tag_id -> core_store.tags.tag_id")] == 1
    assert got[("foreign key", "core_store.news_tag_pairs", "new_id -> core_store.news.new_id")] == 1
    assert got[("derived", "mart_store.news_days", "sum(n) per category, source, day = core")] >= 1
    assert found(4) == {}
    check_store(store, since=3, mark=True)
    assert verified_load(store) == 3  # nothing is marked as checked where something was found
