"""Physical plans: no Python in the hot path, no cartesian product, pre-aggregation before
shuffles, broadcast only of small dimension sides."""

import pytest

from feedmart.operators import core, mart, windows
from feedmart.schemas import SOURCES, TAGS
from feedmart.sources import testdata as td
from tests.conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_mart_plan(spark):
    measures = mart._measures(mart.day_counts(td.fact_orders(spark, SF001)), "1998-08-02")
    p = _plan(measures)
    # aggregates only: no window gathers a category, and every level is pre-aggregated map-side
    assert "Window" not in p and "Cartesian" not in p and "BroadcastNestedLoop" not in p
    assert "partial_count" in p and p.count("partial_sum") >= 3
    # the scan reads only the mapped columns
    assert "o_totalprice" not in p and "o_custkey" not in p


@pytest.mark.parametrize("form", [windows.category_total, windows.weekday_window_counts])
def test_window_forms_do_not_shuffle_the_fact(spark, form):
    """Even a fact that is estimated as too large to broadcast isn't shuffled: the aggregate's real size is known."""
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16384")
    try:
        df = form(td.fact_orders(spark, SF001))
        df.collect()
        p = _plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert "BroadcastHashJoin" in p and "Window" not in p and "Exchange hashpartitioning" not in p


def test_dimension_lookups_broadcast(spark, tmp_path):
    """Dimensions stored as Parquet are broadcast from their file size at planning; a dimension
    of unknown size is broadcast by AQE only once its shuffle stage has measured it."""
    raw = td.raw_events(spark, SF001)
    spark.createDataFrame([(1, "src_0"), (2, "src_1"), (3, "src_2")], SOURCES).write.parquet(str(tmp_path / "s"))
    sources = spark.read.parquet(str(tmp_path / "s"))
    tags = spark.createDataFrame([(1, "click")], TAGS)
    df = core.lookup_tag_id(core.lookup_source_id(raw, sources), tags)
    assert _plan(df).count("BroadcastHashJoin") == 1       # planned from the file size
    df.collect()
    final = _plan(df).split("== Initial Plan ==")[0]
    assert final.count("BroadcastHashJoin") == 2           # the second decided at run time


def test_first_per_key_pre_aggregates(spark):
    from feedmart.operators.keys import first_per_key
    from feedmart.schemas import RAW_ORDER
    p = _plan(first_per_key(td.raw_events(spark, SF001), ["id"], RAW_ORDER, ["title"]))
    assert "partial_min" in p


def test_history_side_of_insert_if_absent_is_not_shuffled(spark, tmp_path):
    """The news table holds all history; a load's anti-join must not reshuffle it."""
    from feedmart.operators.keys import first_per_key, insert_if_absent
    from feedmart.schemas import RAW_ORDER
    from feedmart.sources.store import Store
    store = Store(spark, str(tmp_path / "store"), buckets=3)   # not the shuffle partition count
    raw = td.raw_events(spark, SF001)
    sources = core.new_sources(raw, store.read("core_store", "sources"))
    tags = core.new_tags(raw, store.read("core_store", "tags"))
    store.append(core.new_news_rows(raw, store.read("core_store", "news"), sources, tags), "core_store", "news")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = insert_if_absent(first_per_key(raw, ["id"], RAW_ORDER), store.read("core_store", "news"),
                                 ["id"], ["new_raw_id"], target_buckets=store.buckets())
        p = _plan(fresh)
        # exchanges: the raw aggregation and the move of the incoming keys to 3 partitions; none
        # above the bucketed history scan
        assert p.count("Exchange hashpartitioning") == 2 and "hashpartitioning(id#" in p and ", 3)" in p
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert "Bucketed: true" in p
    news_scan = [ln for ln in p.split("\n") if "FileScan parquet" in ln and "core_store__news" in ln]
    assert news_scan, p
    assert fresh.count() == 0   # a second load of the same raw adds no news


def test_load_reads_only_its_raw_partitions(spark, tmp_path):
    from pyspark.sql import functions as F
    from feedmart.schemas import ENTRIES
    from feedmart.sources.store import Store
    store = Store(spark, str(tmp_path / "store"))
    rows = td.raw_events(spark, SF001)
    for f in ENTRIES.fields:
        rows = rows if f.name in rows.columns else rows.withColumn(f.name, F.lit(None).cast(f.dataType))
    for load in (0, 1):
        store.append_entries(rows.where(F.col("load_id") == load).withColumn("status", F.lit("accepted")), load)
    assert store.load_rows("news", 1).count() == rows.where("load_id = 1").count() > 0
    assert store.load_rows("news", 7).count() == 0
    p = _plan(store.read("raw_store", "news").where(F.col("load_id") == 0).select("id", "tags"))
    scan = [ln for ln in p.split("\n") if "FileScan parquet" in ln][0]
    assert "PartitionFilters: [isnotnull(load_id" in scan and "(load_id" in scan
    assert "ReadSchema: struct<id:string,tags:string>" in scan


def test_mart_names_join_dimensions_by_broadcast(spark, tmp_path):
    """Names come from the dimension tables, broadcast from their file size."""
    from feedmart.sources.store import Store
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    raw = td.raw_events(spark, SF001)
    store.append(core.new_sources(raw, store.read("core_store", "sources")), "core_store", "sources")
    store.append(core.new_tags(raw, store.read("core_store", "tags")), "core_store", "tags")
    store.append(core.new_news_rows(raw, store.read("core_store", "news"), store.read("core_store", "sources"),
                                    store.read("core_store", "tags")), "core_store", "news")
    m = mart.mart(core.core_fact(store.read("core_store", "news")), "2024-01-15",
                  tags=store.read("core_store", "tags"), sources=store.read("core_store", "sources"))
    named = mart.with_names(mart._measures(mart.day_counts(core.core_fact(store.read("core_store", "news"))), "2024-01-15"),
                            store.read("core_store", "tags"), store.read("core_store", "sources"))
    assert _plan(named).count("BroadcastHashJoin") >= 2
    from feedmart.plans.registered import q_mart_names
    assert sorted(tuple(r) for r in m.collect()) == sorted(tuple(r) for r in q_mart_names(spark, SF001).collect())
