"""Mart of publication statistics per (category, source) (E3 and its measures A2-A9, J5-J9).

Plan of ``mart``: the fact is reduced once to day counts ``n`` per (category, source, day) by a
hash aggregate with map-side partial aggregation - the only step whose cost grows with the number
of news items, and the one that absorbs hot keys. The rest is aggregates of the day table: per
category over its days, and per (category, source); the category rows are joined to the pairs. No
window over a category, no fan-out join.

``compat=True`` reproduces the reference exactly (see the notes in ``mart``); ``compat=False``
gives the measures as the task words them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmart.functions.dates import as_of_date, day_of_week
from feedmart.operators.keys import dense_ids
from feedmart.schemas import MART_COUNT_COLUMNS, WEEKDAYS

CAT, SRC, PUB = "category", "source", "published"


def day_counts(fact: DataFrame) -> DataFrame:
    """News per (category, source, day) (the reference's ``max_news_per_day``, W2 per day)."""
    return fact.groupBy(CAT, SRC, PUB).agg(F.count(F.lit(1)).alias("n"))


def _weekday_sums(dow: Column, n: Column) -> list[Column]:
    # The k-th column (1 = Monday) counts day-of-week value k. Under compat the numbering is the
    # reference's 0..6 with Sunday = 0, so its Sunday column (7) matches nothing.
    return [F.sum(F.when(dow == k, n).otherwise(0)).alias(f"amount_news_{d}")
            for k, d in enumerate(WEEKDAYS, start=1)]


def source_counts(fact: DataFrame) -> DataFrame:
    """A2: news per (category, source), all time."""
    return fact.groupBy(CAT, SRC).agg(F.count(F.lit(1)).alias("source_count_category_news"))


def weekday_counts(fact: DataFrame, compat: bool = True) -> DataFrame:
    """A9 (+A6): news per category and weekday, one row per category."""
    day = day_counts(fact)
    dow = day_of_week(F.col(PUB), compat)
    return day.groupBy(CAT).agg(*_weekday_sums(dow, F.col("n")))


def busiest_day(fact: DataFrame) -> DataFrame:
    """Per (category, source) the day with the most news; ties give the latest day;
    undated news take no part."""
    day = day_counts(fact).where(F.col(PUB).isNotNull())
    return (day.groupBy(CAT, SRC).agg(F.max(_pack_day(F.col("n"), F.col(PUB))).alias("_busiest"))
            .select(CAT, SRC, _unpack_day(F.col("_busiest")).alias("max_news_date")))


def avg_news_per_day(fact: DataFrame) -> DataFrame:
    """A4/P10: per category, news count divided (integer division) by the number of distinct
    days that had news in the category; NULL when it had none."""
    day = day_counts(fact)
    per_cat_day = day.groupBy(CAT, PUB).agg(F.sum("n").alias("n"))
    return per_cat_day.groupBy(CAT).agg(
        F.sum("n").alias("all_source_count_category_news"),
        F.count(PUB).alias("n_days")).select(
        CAT, "all_source_count_category_news",
        F.expr("all_source_count_category_news div nullif(n_days, 0)").alias("avg_news_per_day"))


# Busiest day as one BIGINT: count in the high bits, day number (days since 1970-01-01 shifted
# to be positive) in the low 24 bits, so max() picks the largest count and, among equal counts,
# the latest day, and the aggregate keeps a fixed-width (hash-aggregate) buffer.
_DAY_BITS = 24
_DAY_SHIFT = 1 << 23


def _pack_day(n: Column, pub: Column) -> Column:
    return F.when(pub.isNotNull(), F.shiftleft(n, _DAY_BITS) + (F.unix_date(pub) + _DAY_SHIFT))


def _unpack_day(packed: Column) -> Column:
    return F.date_from_unix_date((packed.bitwiseAND(F.lit((1 << _DAY_BITS) - 1)) - _DAY_SHIFT).cast("int"))


def _measures(day: DataFrame, as_of=None, compat: bool = True) -> DataFrame:
    """Every measure per (category, source), unrounded (LongType), from day counts.

    Two levels: day counts are summed per (category, day) and those per category, so that a category
    which holds most news never meets in one task; per (category, source) they are summed directly. The
    category rows, one each, are joined to the pairs (broadcast once their shuffle has measured them)."""
    today = as_of_date(as_of)
    pub, n = F.col(PUB), F.col("n")
    dow = day_of_week(pub, compat)
    by_day = day.groupBy(CAT, PUB).agg(F.sum("n").alias("n"))
    by_cat = by_day.groupBy(F.col(CAT).alias("_cat")).agg(
        F.sum(n).alias("all_n"), F.count(pub).alias("n_days"),
        F.sum(F.when(pub == today, n).otherwise(0)).alias("all_today"), *_weekday_sums(dow, n))
    by_pair = day.groupBy(CAT, SRC).agg(
        F.sum(n).alias("src_n"), F.sum(F.when(pub == today, n).otherwise(0)).alias("src_today"),
        F.max(_pack_day(n, pub)).alias("_busiest"))
    joined = by_pair.join(by_cat, F.col(CAT).eqNullSafe(F.col("_cat")))
    return joined.withColumn("max_news_date", _unpack_day(F.col("_busiest"))).drop("_busiest", "_cat")


def _today_columns(m: DataFrame, compat: bool) -> tuple[Column, Column]:
    has_today = F.col("src_today") > 0
    if compat:
        # Q3/Q4: the reference's "today" total is the all-time total of the category (its window
        # runs before the today filter), and both columns are NULL without news today.
        return F.when(has_today, F.col("all_n")), F.when(has_today, F.col("src_today"))
    return F.col("all_today"), F.col("src_today")


def today_counts(fact: DataFrame, as_of=None, compat: bool = True) -> DataFrame:
    """Per (category, source) the today columns of the mart."""
    m = _measures(day_counts(fact), as_of, compat)
    all_t, src_t = _today_columns(m, compat)
    return m.select(CAT, SRC, all_t.alias("all_source_count_category_news_today"),
                    src_t.alias("source_count_category_news_today"))


def mart(fact: DataFrame, as_of=None, compat: bool = True, tags: DataFrame | None = None,
         sources: DataFrame | None = None) -> DataFrame:
    """The mart. ``fact``: ``new_id, category, source, published`` (DATE, may be NULL).

    Reference behaviour kept under ``compat=True``: Sunday is never counted (Q2), the today
    total equals the all-time total (Q3), no news today gives NULL (Q4), the average divides by
    the number of distinct dated days of the category (Q7), ties of the busiest day give the latest
    day (Q8). Undated news count in the totals only (Q9). ``id`` numbers rows by (category, source).
    ``compat=False`` adds ``category_id`` and keeps the counts as BIGINT. With ``tags`` and ``sources`` the fact holds ids and
    the mart is given names (J9) before it is numbered.
    """
    return mart_from_days(day_counts(fact), as_of, compat, tags, sources)


def mart_from_days(day: DataFrame, as_of=None, compat: bool = True, tags: DataFrame | None = None,
                   sources: DataFrame | None = None) -> DataFrame:
    """The mart from day counts ``category, source, published, n`` (one row per triple); the
    counts may come from ``day_counts`` of a fact or from an accumulated per-load log."""
    return _finished(_measures(day, as_of, compat), compat, tags, sources)


def _finished(m: DataFrame, compat: bool, tags: DataFrame | None, sources: DataFrame | None) -> DataFrame:
    if tags is not None and sources is not None:
        m = with_names(m, tags, sources)
    all_t, src_t = _today_columns(m, compat)
    out = m.select(
        CAT, SRC,
        F.col("all_n").alias("all_source_count_category_news"),
        F.col("src_n").alias("source_count_category_news"),
        all_t.alias("all_source_count_category_news_today"),
        src_t.alias("source_count_category_news_today"),
        F.expr("all_n div nullif(n_days, 0)").alias("avg_news_per_day"),
        "max_news_date",
        *[f"amount_news_{d}" for d in WEEKDAYS])
    if compat:  # the reference declares INTEGER; the corrected mart keeps BIGINT
        for c in MART_COUNT_COLUMNS + [f"amount_news_{d}" for d in WEEKDAYS]:
            out = out.withColumn(c, F.col(c).cast("int"))
        return dense_ids(out, [CAT, SRC], "id").select("id", *out.columns)
    return dense_ids(out, [CAT, SRC], "id", group_id="category_id").select("id", "category_id", *out.columns)


# -- the mart from a merged state and the day counts added since
#
# News are only ever added, so all measures have a state that grows by sums and maxima: per pair the count and the packed
# busiest day, per category the count, the number of days with news and the counts by ISO weekday. The new totals of the
# days that were touched are the only thing that needs earlier day counts.

_ISO = [f"iso_{k}" for k in range(1, 8)]


def pair_state(day: DataFrame) -> DataFrame:
    return day.groupBy(CAT, SRC).agg(F.sum("n").alias("src_n"), F.max(_pack_day(F.col("n"), F.col(PUB))).alias("_busiest"))


def _iso_sums(n: Column) -> list[Column]:
    dow = day_of_week(F.col(PUB), compat=False)
    return [F.sum(F.when(dow == k, n).otherwise(0)).alias(c) for k, c in enumerate(_ISO, start=1)]


def category_state(day: DataFrame) -> DataFrame:
    by_day = day.groupBy(CAT, PUB).agg(F.sum("n").alias("n"))
    return by_day.groupBy(CAT).agg(F.sum("n").alias("all_n"), F.count(PUB).alias("n_days"), *_iso_sums(F.col("n")))


def mart_from_state(pairs: DataFrame, categories: DataFrame, old: DataFrame, new: DataFrame, as_of=None, compat: bool = True,
                    tags: DataFrame | None = None, sources: DataFrame | None = None) -> DataFrame:
    """The mart from the states of earlier day counts and the day counts ``new``. ``old`` holds the earlier counts, at least of today and of
    the days that ``new`` touches; other days in it change nothing. A triple may have several rows in either."""
    today = as_of_date(as_of)
    days = old.select(CAT, SRC, PUB, "n", F.lit(0).cast("long").alias("added")).unionByName(new.select(CAT, SRC, PUB, "n", F.col("n").alias("added")))
    triples = days.groupBy(CAT, SRC, PUB).agg(F.sum("n").alias("n"), F.sum("added").alias("added"))
    touched = triples.where((F.col("added") != 0) | (F.col(PUB) == today))
    now = F.when(F.col(PUB) == today, F.col("n")).otherwise(0)
    more = touched.select(CAT, SRC, F.col("added").alias("src_n"), _pack_day(F.col("n"), F.col(PUB)).alias("_busiest"), now.alias("src_today"))
    by_pair = pairs.withColumn("src_today", F.lit(0).cast("long")).unionByName(more).groupBy(CAT, SRC).agg(
        F.sum("src_n").alias("src_n"), F.sum("src_today").alias("src_today"), F.max("_busiest").alias("_busiest"))
    by_day = triples.groupBy(CAT, PUB).agg(F.sum("n").alias("n"), F.sum("added").alias("added"))
    by_day = by_day.where((F.col("added") != 0) | (F.col(PUB) == today))
    first = F.when(F.col(PUB).isNotNull() & (F.col("added") != 0) & (F.col("n") == F.col("added")), 1).otherwise(0)  # no news that day before
    grown = by_day.groupBy(CAT).agg(F.sum("added").alias("all_n"), F.sum(first).alias("n_days"), F.sum(now).alias("all_today"), *_iso_sums(F.col("added")))
    by_cat = categories.withColumn("all_today", F.lit(0).cast("long")).unionByName(grown).groupBy(F.col(CAT).alias("_cat")).agg(
        *[F.sum(c).alias(c) for c in ("all_n", "n_days", "all_today", *_ISO)])
    joined = by_pair.join(by_cat, F.col(CAT).eqNullSafe(F.col("_cat")))
    joined = joined.withColumn("max_news_date", _unpack_day(F.col("_busiest"))).drop("_busiest", "_cat")
    for name, iso in zip(WEEKDAYS, _ISO):  # Q2: the reference counts no Sundays
        joined = joined.withColumn(f"amount_news_{name}", F.lit(0).cast("long") if compat and name == "sunday" else F.col(iso))
    return _finished(joined.drop(*_ISO), compat, tags, sources)


def with_names(m: DataFrame, tags: DataFrame, sources: DataFrame) -> DataFrame:
    """Category and source ids -> names (two left joins with the dimensions)."""
    named = (m.join(tags.select(F.col("tag_id").alias(CAT), F.col("tag_name")), CAT, "left")
             .join(sources.select(F.col("source_id").alias(SRC), F.col("source_name")), SRC, "left"))
    cols = [F.col("tag_name").alias(CAT) if c == CAT else F.col("source_name").alias(SRC) if c == SRC else F.col(c)
            for c in m.columns]
    return named.select(*cols)
