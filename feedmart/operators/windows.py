"""The reference's window measures (W1-W4) as row-level results.

``count(...) over (partition by category)`` on the fact would send every news item of a category
to one task, and one category may hold a third of all news. The same values come from a
pre-aggregate (partial aggregation collapses hot keys before the shuffle) joined back to the
rows on a null-safe key. The aggregate is written to the scratch folder first, so the planner knows
its real size before it decides about the fact: it broadcasts the aggregate under the broadcast
threshold, and the fact isn't shuffled, or else shuffles both, and AQE splits a skewed fact partition. W3 is a genuine window, but over day counts, whose rows
per (category, source) are bounded by calendar days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedmart.functions.dates import day_of_week
from feedmart.operators.mart import CAT, PUB, SRC, day_counts
from feedmart.schemas import WEEKDAYS
from feedmart.session import materialise


def _join_back(rows: DataFrame, agg: DataFrame, keys: Sequence[str]) -> DataFrame:
    agg = materialise(agg, "window-aggregate")
    a = agg.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in agg.columns if c not in keys])
    cond = None
    for k in keys:
        c = rows[k].eqNullSafe(a[f"_k_{k}"])
        cond = c if cond is None else cond & c
    return rows.join(a, cond, "left").drop(*[f"_k_{k}" for k in keys])


def category_total(fact: DataFrame) -> DataFrame:
    """Each fact row with the number of news in its category."""
    totals = fact.groupBy(CAT).agg(F.count(F.lit(1)).alias("all_source_count_category_news"))
    return _join_back(fact, totals, [CAT])


def day_count(fact: DataFrame) -> DataFrame:
    """Each fact row with the number of news of its category and source on its day."""
    per_day = day_counts(fact).withColumnRenamed("n", "max_news_per_day")
    return _join_back(fact, per_day, [CAT, SRC, PUB])


def peak(fact: DataFrame) -> DataFrame:
    """W3 (with A5): per (category, source, day) its count and the peak count of the pair."""
    w = Window.partitionBy(CAT, SRC)
    return (day_counts(fact).withColumnRenamed("n", "max_count_news")
            .withColumn("max", F.max("max_count_news").over(w)))


def weekday_window_counts(fact: DataFrame, compat: bool = True) -> DataFrame:
    """Each fact row with the seven weekday counts of its category."""
    dow = day_of_week(F.col(PUB), compat)
    counts = fact.groupBy(CAT).agg(*[F.count(F.when(dow == k, F.lit(1))).alias(f"amount_news_{d}")
                                     for k, d in enumerate(WEEKDAYS, start=1)])
    return _join_back(fact, counts, [CAT])
