"""Steps whose cost must grow no faster than the input."""

import time

from pyspark.sql import functions as F

from feedmart.functions.text import source_from_path
from feedmart.plans import load
from feedmart.sources import testdata as td
from feedmart.sources.store import Store
from tests.conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_mapping_of_a_load_is_broadcast(spark, tmp_path, monkeypatch):
    """the mapping is derived from a table that looks large to the planner; raw must not be shuffled by its few category names."""
    entries = spark.createDataFrame([(f"i{k}", "t", "l", "d", "Mon, 21 Aug 2023 23:30:00 +0300", ["Sport"], "s", "f", 0, k) for k in range(4)],
                                    "guid string, title string, link string, description string, pubDate string, category array<string>, "
                                    "source string, file_path string, block_start long, entry_pos long")
    names = spark.range(20_000_000).select(F.concat(F.lit("sport"), (F.col("id") % 1).cast("string"))).limit(1_000_000).distinct()
    mapping = names.select(F.lit("sport").alias("key"), F.lit("SPORT").alias("canonical")).distinct()
    plans = []
    normalise = load.category_normalise

    def seen(df, col, given):
        out = normalise(df, col, given)
        plans.append(out._jdf.queryExecution().sparkPlan().toString())
        return out
    monkeypatch.setattr(load, "category_normalise", seen)
    store = Store(spark, str(tmp_path / "store"))
    mart = load.load_entries(store, entries, as_of="2023-08-22", mapping=mapping)
    assert [(r.category, r.source_count_category_news) for r in mart.collect()] == [("SPORT", 4)]
    assert len(plans) == 1 and "BroadcastHashJoin" in plans[0] and "SortMergeJoin" not in plans[0], plans


def test_source_from_path_is_linear(spark):
    """Two long folder names took minutes, as the pattern was tried from every character."""
    path = "file:/" + "a" * 60_000 + "/" + "b" * 60_000 + "/source=x%2520y/f.xml"
    rows = spark.createDataFrame([(path,)], "p string")
    start = time.time()
    assert rows.select(source_from_path("p")).first()[0] == "x y"
    assert time.time() - start < 5


def test_source_of_odd_paths(spark):
    paths = {"a/b": "a", "orders": "", "": "", "/": "", "//b": "", "x//b": "", "x/y/": "", "/x": "", "p/a+b/q": "a+b", "file:/a b/c%20d/e.xml": "c d",
             "s/source=/f": "", "a\n/b/c\nd": "b", "a\n/b": "a\n", "p/source=a%zz/q": None, None: None}
    rows = spark.createDataFrame([(p,) for p in paths], "p string")
    assert dict(tuple(r) for r in rows.select("p", source_from_path("p")).collect()) == paths


def test_landing_texts_are_built_after_the_orders_are_dealt(spark, tmp_path):
    """Range partitioning samples its input in a pass of its own; only keys and plain columns go through it."""
    plan = _plan(td.rss_orders_items(spark, SF001))
    assert plan.index("concat(Order ") < plan.index("RepartitionByExpression")
    landing = td.write_rss_orders_landing(spark, SF001, str(tmp_path / "landing"))
    n = td.table(spark, SF001, "orders").count()
    links = spark.read.text(f"{landing}/*/*").where("value LIKE '%<link>%'").select(
        F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("at"), F.regexp_extract("value", "o/([0-9]+)", 1).cast("long").alias("k")).collect()
    assert len(links) == n and len({r.k for r in links}) == n
    for f in {r.f for r in links}:
        own = [r.k for r in sorted((r for r in links if r.f == f), key=lambda r: r.at)]
        assert own == sorted(own)
