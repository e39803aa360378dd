"""Loads never lose or alter what other loads or other users wrote."""

import pytest
from pyspark.sql import functions as F

from feedmart.operators.normalise import category_normalise
from feedmart.plans import delta_load, full_load
from feedmart.plans.load import build_mart
from feedmart.sources.rss import read_landing
from feedmart.sources.store import Store
from feedmart.streaming import start_landing_load
from tests.feeds import LENTA, TASS, write_landing


def _item(guid, title="t", category="C", date="Mon, 21 Aug 2023 01:00:00 +0300"):
    return f"<item><guid>{guid}</guid><title>{title}</title><pubDate>{date}</pubDate><category>{category}</category></item>"


def _feed(*items):
    return f"<rss><channel>{''.join(items)}</channel></rss>"


def _ids(store):
    return sorted(r.id for r in store.read("raw_store", "news").collect())


def test_every_load_keeps_the_raw_rows_of_the_others(spark, tmp_path):
    root = str(tmp_path / "store")
    for name, guid in (("a", "a1"), ("b", "b1")):
        full_load(spark, write_landing(tmp_path / name, {"s": _feed(_item(guid))}), root, as_of="2023-08-22")
    for name, guid in (("c", "c1"), ("d", "d1")):
        delta_load(spark, write_landing(tmp_path / name, {"s": _feed(_item(guid))}), root, as_of="2023-08-22")
    for name, guid in (("e", "e1"), ("f", "f1")):  # two streams, both begin at batch 0
        start_landing_load(spark, write_landing(tmp_path / name, {"s": _feed(_item(guid))}), root, str(tmp_path / f"ckpt-{name}"),
                           as_of="2023-08-22").awaitTermination()
    store = Store(spark, root)
    assert _ids(store) == ["a1", "b1", "c1", "d1", "e1", "f1"]
    assert sorted(r.new_id for r in store.read("core_store", "news").collect()) == [1, 2, 3, 4, 5, 6]
    assert store.last_new_id() == 6


def test_rerun_of_a_named_load_replaces_all_it_wrote(spark, tmp_path):
    root = str(tmp_path / "store")
    bad = "<item><guid>r1</guid><title>no category</title></item>"
    full_load(spark, write_landing(tmp_path / "x", {"s": _feed(_item("x1"))}), root, as_of="2023-08-22")
    full_load(spark, write_landing(tmp_path / "a", {"s": _feed(_item("a1"), bad), "s2": _feed(_item("a2"))}), root, as_of="2023-08-22", name="day")
    store = Store(spark, root)
    assert _ids(store) == ["a1", "a2", "x1"] and store.read("raw_store", "rejects").count() == 1
    assert spark.table("raw_store.news").count() == 3
    full_load(spark, write_landing(tmp_path / "b", {"s": _feed(_item("b1"))}), root, as_of="2023-08-22", name="day")
    assert _ids(store) == ["b1", "x1"] and store.read("raw_store", "rejects").count() == 0
    assert spark.table("raw_store.news").count() == 2
    assert [r.source for r in store.raw_tables().collect()] == ["s"]
    full_load(spark, write_landing(tmp_path / "c", {"s": _feed()}), root, as_of="2023-08-22", name="day")
    assert _ids(store) == ["x1"]
    # core keeps what it was given once, and its day counts follow it
    assert sorted(r.new_raw_id for r in store.read("core_store", "news").collect()) == ["a1", "a2", "b1", "x1"]
    a, b = (sorted(map(tuple, build_mart(store, "2023-08-22", from_log=f).collect())) for f in (True, False))
    assert a == b


def test_a_load_that_broke_off_is_repaired_by_its_rerun(spark, tmp_path, monkeypatch):
    from feedmart.plans import load
    root = str(tmp_path / "store")
    landing = write_landing(tmp_path)
    real, calls = load._log_days, []

    def broken(*args):
        calls.append(args)
        raise RuntimeError("lost")
    monkeypatch.setattr(load, "_log_days", broken)
    with pytest.raises(RuntimeError):
        full_load(spark, landing, root, as_of="2023-08-22", name="day", compat=False)
    monkeypatch.setattr(load, "_log_days", real)
    store = Store(spark, root)
    assert calls and store.last_new_id() == store.read("core_store", "news").count() == 3
    full_load(spark, landing, root, as_of="2023-08-22", name="day", compat=False)
    a, b = (sorted(map(tuple, build_mart(store, "2023-08-22", compat=False, from_log=f).collect())) for f in (True, False))
    assert a == b and store.read("raw_store", "news").count() == 6


def test_bucket_count_does_not_depend_on_cores_and_can_change(spark, tmp_path):
    root = str(tmp_path / "store")
    full_load(spark, write_landing(tmp_path), root, as_of="2023-08-22", compat=False)
    store = Store(spark, root)
    assert store.buckets() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    before = {t: sorted(map(tuple, store.read("core_store", t).collect())) for t in ("news", "news_tag_pairs")}
    old = store.path("core_store", "news")
    store.register().rebucket(7)
    assert store.buckets() == Store(spark, root).buckets() == 7
    assert {t: sorted(map(tuple, Store(spark, root).read("core_store", t).collect())) for t in before} == before
    assert spark.table("core_store.news").count() == len(before["news"])
    assert store.path("core_store", "news") != old
    files = spark.read.parquet(store.path("core_store", "news")).inputFiles()
    assert len(files) <= 7
    more = write_landing(tmp_path / "more", {"s": _feed(_item("new"))})
    full_load(spark, more, root, as_of="2023-08-22", compat=False)
    assert Store(spark, root).read("core_store", "news").count() == len(before["news"]) + 1


def test_foreign_tables_survive_publishing(spark, tmp_path):
    landing = write_landing(tmp_path)
    spark.sql("CREATE DATABASE IF NOT EXISTS own_core")
    spark.sql("CREATE TABLE own_core.tags (x INT) USING parquet")
    spark.sql("INSERT INTO own_core.tags VALUES (42)")
    root = str(tmp_path / "store")
    names = {"raw_store": "own_raw", "core_store": "own_core", "mart_store": "own_mart"}
    try:
        with pytest.raises(ValueError, match="own_core.tags exists"):
            Store(spark, root, databases=names).register()
        assert [r.x for r in spark.table("own_core.tags").collect()] == [42]
        assert not spark.catalog.tableExists("own_raw.news")  # nothing was published before the look
    finally:
        spark.sql("DROP TABLE own_core.tags")
    store = Store(spark, root, databases=names).register()
    full_load(spark, landing, root, as_of="2023-08-22", store=store)
    assert spark.table("own_mart.news").count() == 3 and spark.table("own_core.news_ids").count() == 4


def test_published_mart_follows_its_rebuild(spark, tmp_path):
    root = str(tmp_path / "store")
    store = Store(spark, root).register()
    full_load(spark, write_landing(tmp_path), root, as_of="2023-08-22", store=store)
    assert spark.sql("SELECT count(*) FROM mart_store.news").first()[0] == 3
    build_mart(store, "2023-08-21")
    rows = spark.sql("SELECT * FROM mart_store.news").collect()
    assert len(rows) == 3
    assert "category_id" not in spark.table("mart_store.news").columns


def test_counts_of_the_corrected_mart_are_wide(spark):
    from feedmart.operators.mart import mart_from_days
    days = spark.createDataFrame([("c", "s", 3_000_000_000)], "category string, source string, n long").withColumn(
        "published", F.lit("2023-08-21").cast("date"))
    row = mart_from_days(days, "2023-08-21", compat=False).first()
    assert row.all_source_count_category_news == row.amount_news_monday == 3_000_000_000


def test_feeds_in_odd_folders_and_malformed_items(spark, tmp_path):
    feeds = {"my src": _feed(_item("m1")), "a%b+c": _feed(_item("p1")), "bad": _feed(
        _item("b1", title="fish & chips"), _item("b2", title="a&nbsp;b"), _item("b3"))}
    landing = write_landing(tmp_path, feeds)
    got = {r.source for r in read_landing(spark, landing).select("source").collect()}
    assert got == {"my src", "a%b+c", "bad"}
    root = str(tmp_path / "store")
    full_load(spark, landing, root, as_of="2023-08-22")
    store = Store(spark, root)
    assert _ids(store) == ["b3", "m1", "p1"]
    rejects = store.read("raw_store", "rejects").collect()
    assert [(r.reason, r.source) for r in rejects] == [("malformed", "bad")] * 2
    assert any("fish & chips" in r.raw_text for r in rejects) and any("&nbsp;" in r.raw_text for r in rejects)
    assert spark.sql("SELECT count(*) FROM raw_store.news_df_a_b_c").first()[0] == 1


def test_landing_pattern_and_modification_time(spark, tmp_path):
    landing = write_landing(tmp_path)
    assert {r.source for r in read_landing(spark, landing, "tass*/*").collect()} == {"tass_ru"}
    assert read_landing(spark, landing, modified_after="2100-01-01T00:00:00").count() == 0
    delta_load(spark, landing, str(tmp_path / "s"), as_of="2023-08-22", pattern="lenta*/*")
    assert {r.source for r in Store(spark, str(tmp_path / "s")).read("raw_store", "news").collect()} == {"lenta_ru"}


def test_mapping_applies_to_core_only_and_must_be_unique(spark, tmp_path):
    landing, root = write_landing(tmp_path, {"l": LENTA, "t": TASS}), str(tmp_path / "store")
    mapping = spark.createDataFrame([("economy", "Business"), ("world", "Business")], "key string, canonical string")
    mart = full_load(spark, landing, root, as_of="2023-08-22", mapping=mapping)
    store = Store(spark, root)
    assert {r.tag_name for r in store.read("core_store", "tags").collect()} == {"Business", "Sport", "Politics"}
    assert "Economy" in {r.tags for r in store.read("raw_store", "news").collect()}
    assert {r.category for r in mart.collect()} == {"Business", "Sport"}
    with pytest.raises(ValueError, match="unique"):
        category_normalise(store.read("raw_store", "news"), "tags", mapping.union(mapping))


def test_unreadable_table_is_an_error_not_an_empty_one(spark, tmp_path):
    root = tmp_path / "store"
    full_load(spark, write_landing(tmp_path), str(root), as_of="2023-08-22")
    for f in (root / "core_store" / "tags").glob("*.parquet"):
        f.write_bytes(b"not parquet")
    with pytest.raises(Exception):
        Store(spark, str(root)).read("core_store", "tags").collect()


def test_scratch_tables_of_a_load_are_deleted(spark, tmp_path):
    import glob
    from feedmart.session import scratch_path
    base = scratch_path(spark, "x").rsplit("/", 1)[0].removeprefix("file:")
    before = set(glob.glob(f"{base}/*"))
    full_load(spark, write_landing(tmp_path), str(tmp_path / "store"), as_of="2023-08-22", compat=False)
    assert set(glob.glob(f"{base}/*")) == before


def test_scratch_scopes_of_two_threads_stay_apart(spark):
    import threading
    from contextvars import copy_context
    from feedmart.session import materialise, scratch_scope
    met, kept = threading.Barrier(2), {}

    def run(name, first):
        with scratch_scope(spark):
            table = materialise(spark.range(5).withColumn("who", F.lit(name)), name)
            met.wait(60)
            if first:
                return  # this scope ends while the other is still at work
            inner = []
            t = threading.Thread(target=copy_context().run, args=(lambda: inner.append(materialise(spark.range(3), "inner")),))
            t.start()
            t.join()
            kept[name] = table.count(), inner[0].count()
            kept["path"] = inner[0].inputFiles()[0]
    threads = [threading.Thread(target=run, args=(f"t{i}", i == 0)) for i in range(2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert kept["t1"] == (5, 3)
    from feedmart.session import path_exists
    assert not path_exists(spark, kept["path"])  # a thread that was given the context shares the scope


def test_a_cluster_must_name_its_checkpoint_folder(spark, monkeypatch):
    from feedmart import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_corrected_load_does_not_shuffle_history(spark, tmp_path):
    from feedmart.operators import core
    from feedmart.sources import testdata as td
    from tests.conftest import SF001
    store = Store(spark, str(tmp_path / "store"), buckets=3)
    raw = td.raw_events(spark, SF001)
    from feedmart.plans.load import load_core
    load_core(raw, store, compat=False)
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        news, bridge = store.read("core_store", "news"), store.read("core_store", "news_tag_pairs")
        rows = core.new_news_tag_rows(raw, news, store.read("core_store", "tags"), bridge, store.buckets())
        plans = [rows, core.core_fact(news, bridge)]
        texts = [p._jdf.queryExecution().executedPlan().toString() for p in plans]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert "Exchange" not in texts[1] and texts[1].count("Bucketed: true") == 2
    assert texts[0].count("Bucketed: true") == 2
    for line_no, line in enumerate(texts[0].split("\n")):  # what stands right above a history scan is no exchange
        if "core_store__news" in line:
            above = [x for x in texts[0].split("\n")[max(0, line_no - 6):line_no]]
            assert not any("Exchange hashpartitioning(new_raw_id" in x for x in above)
    assert rows.count() == 0
