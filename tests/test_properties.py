"""Invariants of the mart and of the window forms on whole stand-in tables."""

from pyspark.sql import functions as F

from feedmart.operators import mart, windows
from feedmart.sources import testdata as td
from tests.conftest import SF001


def test_source_counts_sum_to_category_total(spark):
    m = mart.mart(td.fact_orders(spark, SF001), "1998-08-02")
    bad = (m.groupBy("category").agg(F.sum("source_count_category_news").alias("s"),
                                     F.max("all_source_count_category_news").alias("a"))
           .where(F.col("s") != F.col("a")))
    assert bad.count() == 0


def test_corrected_weekdays_sum_to_dated_total(spark):
    fact = td.fact_events(spark, SF001)
    m = mart.mart(fact, "2024-01-15", compat=False)
    wk = sum(F.col(f"amount_news_{d}") for d in ("monday", "tuesday", "wednesday", "thursday", "friday",
                                                  "saturday", "sunday"))
    assert m.where(wk != F.col("all_source_count_category_news")).count() == 0
    compat = mart.mart(fact, "2024-01-15")
    assert compat.where(F.col("amount_news_sunday") != 0).count() == 0


def test_window_forms_equal_aggregates(spark):
    fact = td.fact_orders(spark, SF001)
    w1 = windows.category_total(fact).select("category", "all_source_count_category_news").distinct()
    m = mart.mart(fact, "1998-08-02").select("category", "all_source_count_category_news").distinct()
    assert sorted(w1.collect()) == sorted(m.collect())
    peak = windows.peak(fact).where(F.col("max_count_news") == F.col("max")) \
        .groupBy("category", "source").agg(F.max("published").alias("max_news_date"))
    assert sorted(peak.collect()) == sorted(mart.busiest_day(fact).collect())


def test_today_columns(spark):
    fact = td.fact_orders(spark, SF001)
    compat = {(r.category, r.source): r for r in mart.today_counts(fact, "1998-08-02").collect()}
    assert all(r.all_source_count_category_news_today is None for r in compat.values())  # no orders that day
    corrected = mart.today_counts(fact, "1998-08-02", compat=False).collect()
    assert all(r.source_count_category_news_today == 0 for r in corrected)
