"""Queries registered with the driver: one per operator of the inventory, each over whole test
tables (or data Spark derives from them), each with an equivalent DuckDB SQL text.

Parameters are fixed here, never tuned per run: the "today" of each stand-in fact, and the day a
delta load runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmart import schemas
from feedmart.functions.dates import day_of_week, parse_pubdate_lenient, parse_pubdate_strict, raw_to_date
from feedmart.operators import core, ingest, keys, mart, normalise, quality, windows
from feedmart.plans.load import delta_load, full_load, load_raw
from feedmart.session import materialise, scratch_path
from feedmart.sources import testdata as td
from feedmart.sources.rss import read_landing
from feedmart.sources.store import Store

# Fixed parameters.
ORDERS_AS_OF = "1998-08-02"   # "today" for fact-orders
EVENTS_AS_OF = "2024-01-15"   # "today" for fact-events
RSS_AS_OF = "1998-08-03"      # the delta load runs on this day and takes 1998-08-02


# ---------------------------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------------------------

def _empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def _dims(spark: SparkSession, sf: str):
    """Both loads of raw-events, the second onto the dimensions of the first: (raw, sources, tags)."""
    raw = td.raw_events(spark, sf)
    sources, tags = _empty(spark, schemas.SOURCES), _empty(spark, schemas.TAGS)
    for load in (0, 1):
        rows = raw.where(F.col("load_id") == load)
        sources = materialise(sources.unionByName(core.new_sources(rows, sources)), "sources")
        tags = materialise(tags.unionByName(core.new_tags(rows, tags)), "tags")
    return raw, sources, tags


def _events_core(spark: SparkSession, sf: str):
    """Core built from the two loads of raw-events, the second onto what the first left: (raw, sources, tags, news)."""
    raw, sources, tags = _dims(spark, sf)
    news = _empty(spark, schemas.NEWS)
    for load in (0, 1):
        rows = raw.where(F.col("load_id") == load)
        news = materialise(news.unionByName(core.new_news_rows(rows, news, sources, tags)), "news")
    return raw, sources, tags, news


def _rss_raw(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.to_raw(ingest.classify(td.rss_orders(spark, sf), "full"), 0)


def _landing(spark: SparkSession, sf: str, name: str, where=None) -> str:
    return td.write_rss_orders_landing(spark, sf, scratch_path(spark, name), where)


def _store(spark: SparkSession, name: str) -> Store:
    return Store(spark, scratch_path(spark, name)).register()


def q_rss_scan(spark, sf):
    e = td.rss_orders(spark, sf)
    return e.select("guid", "title", "link", "description", "pubDate",
                    F.array_join("category", "|").alias("category_list"),
                    F.when(F.col("category").isNull(), 0).otherwise(F.size("category")).cast("int").alias("n_categories"))


def q_explode_categories(spark, sf):
    e = ingest.explode_categories(ingest.with_defaults(td.rss_orders(spark, sf)))
    return e.select("link", "tag_pos", "tags")


def q_default_fill(spark, sf):
    return ingest.with_defaults(td.rss_orders(spark, sf)).select("link", "id", "title", "summary")


def q_parse_pubdate_lenient(spark, sf):
    return td.rss_orders(spark, sf).select("link", "pubDate", parse_pubdate_lenient("pubDate").alias("published"))


def q_parse_pubdate_strict(spark, sf):
    """Strict parsing fails the job on the first bad date (a unit test has that), so it gets the entries that have one."""
    dated = td.rss_orders(spark, sf).where(F.col("pubDate") != td.BAD_DATE_TEXT)
    return dated.select("link", "pubDate", parse_pubdate_strict("pubDate").alias("published"))


def q_incremental_yesterday(spark, sf):
    c = ingest.classify(td.rss_orders(spark, sf), "delta", RSS_AS_OF)
    return ingest.to_raw(c, 1).select("link", "id", "tags", "tag_pos", "published", "source")


def q_rejects(spark, sf):
    """The delta load's rejects: bad dates first, then of the day's entries those without category or id."""
    c = ingest.classify(td.rss_orders(spark, sf), "delta", RSS_AS_OF, compat=False)
    full = ingest.classify(td.rss_orders(spark, sf), "full", compat=False)
    both = ingest.rejects(full, 0).unionByName(ingest.rejects(c, 1))
    return both.select("id", "title", "source", "pubDate", "reason", "load_id")


def q_source_from_path(spark, sf):
    landing = _landing(spark, sf, "landing")
    return read_landing(spark, landing).select("link", "source")


def q_raw_discovery(spark, sf):
    store = _store(spark, "store")
    load_raw(read_landing(spark, _landing(spark, sf, "landing")), store)
    return store.raw_tables()


def q_raw_append(spark, sf):
    """Two full loads of the same landing: raw keeps both."""
    store = _store(spark, "store")
    entries = read_landing(spark, _landing(spark, sf, "landing"))
    load_raw(entries, store)
    load_raw(entries, store)
    return store.read("raw_store", "news").select("title", "link", "id", "summary", "tags", "source", "published",
                                                  "load_id", "tag_pos")


def q_raw_append_delta(spark, sf):
    store = _store(spark, "store")
    entries = read_landing(spark, _landing(spark, sf, "landing"))
    load_raw(entries, store)
    load_raw(entries, store, None, "delta", RSS_AS_OF)
    return store.read("raw_store", "news").where(F.col("load_id") == 2).select(
        "title", "link", "id", "summary", "tags", "source", "published", "load_id", "tag_pos")


def q_init_load(spark, sf):
    landing = _landing(spark, sf, "landing")
    return full_load(spark, landing, scratch_path(spark, "store"), as_of=ORDERS_AS_OF)


def _two_loads(spark, sf, compat):
    day_before = F.to_date(F.col("o_orderdate")) < F.date_sub(F.lit(RSS_AS_OF).cast("date"), 1)
    first = _landing(spark, sf, "landing-init", where=day_before)
    later = _landing(spark, sf, "landing-next")
    root = scratch_path(spark, "store")
    full_load(spark, first, root, as_of=RSS_AS_OF, compat=compat)
    return delta_load(spark, later, root, as_of=RSS_AS_OF, compat=compat)


def q_incremental_load(spark, sf):
    return _two_loads(spark, sf, True)


def q_incremental_load_corrected(spark, sf):
    return _two_loads(spark, sf, False)


def q_init_load_corrected(spark, sf):
    """Every category of an entry counts, entries without id are refused, Sundays and today are counted."""
    landing = _landing(spark, sf, "landing")
    return full_load(spark, landing, scratch_path(spark, "store"), as_of=ORDERS_AS_OF, compat=False)


def _mapping(spark, sf):
    """Priority names and their bare words -> the upper-case word."""
    pr = td.table(spark, sf, "orders").select("o_orderpriority").distinct()
    word = F.regexp_extract("o_orderpriority", r"^[0-9]+-(.*)$", 1)
    return pr.select(normalise.normalise_key(F.col("o_orderpriority")).alias("key"), F.upper(word).alias("canonical")) \
        .unionByName(pr.select(normalise.normalise_key(word).alias("key"), F.upper(word).alias("canonical"))).distinct()


def q_mapped_load(spark, sf):
    """Category unification end to end: raw keeps the names as delivered, core and mart get the canonical ones."""
    landing = _landing(spark, sf, "landing")
    return full_load(spark, landing, scratch_path(spark, "store"), as_of=ORDERS_AS_OF, mapping=_mapping(spark, sf))


def q_streaming_load(spark, sf):
    """The landing folder consumed by the file stream (availableNow): one micro-batch = one load."""
    from feedmart.streaming import start_landing_load
    landing = _landing(spark, sf, "landing")
    root = scratch_path(spark, "store")
    start_landing_load(spark, landing, root, scratch_path(spark, "stream-ckpt"), as_of=ORDERS_AS_OF).awaitTermination()
    return spark.read.parquet(Store(spark, root).path("mart_store", "news"))


def q_raw_union(spark, sf):
    from functools import reduce
    parts = [td.raw_events(spark, sf), td.raw_lineitem(spark, sf)]
    return reduce(lambda a, b: a.unionByName(b), parts).select("id", "title", "tags", "source", "published",
                                                               "file_path", "entry_pos")


def q_raw_to_date(spark, sf):
    return td.raw_events(spark, sf).select("entry_pos", raw_to_date("published").alias("new_published"))


def q_dim_sources(spark, sf):
    return _dims(spark, sf)[1]


def q_dim_tags(spark, sf):
    return _dims(spark, sf)[2]


def q_dim_news_ids(spark, sf):
    return core.attribute_table(_events_core(spark, sf)[3], "news_ids")


def q_surrogate_keys(spark, sf):
    """Ids of the events' users first, then of the orders of lineitem that aren't among them."""
    held = materialise(keys.dense_ids(keys.first_per_key(td.raw_events(spark, sf), ["id"], schemas.RAW_ORDER),
                                      schemas.RAW_ORDER, "new_id").select("new_id", "id"), "held")
    first = keys.first_per_key(td.raw_lineitem(spark, sf), ["id"], schemas.RAW_ORDER)
    fresh = keys.insert_if_absent(first, held, ["id"])
    more = keys.dense_ids(fresh, schemas.RAW_ORDER, "new_id", start=keys.max_id(held, "new_id")).select("new_id", "id")
    return held.unionByName(more).select("new_id", F.col("id").alias("new_raw_id"))


def q_lookup_news_id(spark, sf):
    raw, _, _, news = _events_core(spark, sf)
    return core.lookup_news_id(raw, news).select("entry_pos", "id", "new_id")


def q_lookup_source_id(spark, sf):
    raw, sources, _, _ = _events_core(spark, sf)
    return core.lookup_source_id(raw, sources).select("entry_pos", "source", "source_id")


def q_lookup_tag_id(spark, sf):
    raw, _, tags, _ = _events_core(spark, sf)
    return core.lookup_tag_id(raw, tags).select("entry_pos", "tags", "tag_id")


def _attr(name):
    def q(spark, sf):
        return core.attribute_table(_events_core(spark, sf)[3], name)
    return q


def q_check_unique(spark, sf):
    return quality.check_unique(td.raw_events(spark, sf), ["id"])


def q_check_foreign_keys(spark, sf):
    raw = td.raw_lineitem(spark, sf)
    news_ids = keys.first_per_key(td.raw_events(spark, sf), ["id"], schemas.RAW_ORDER) \
        .select(F.col("id").alias("new_raw_id"))
    return quality.check_foreign_keys(raw, news_ids, "id", "new_raw_id").select("id", "entry_pos")


def q_category_normalise(spark, sf):
    return normalise.category_normalise(_rss_raw(spark, sf), "tags", _mapping(spark, sf)).select("link", "tag_pos", "tags")


def q_category_proposals(spark, sf):
    """One name for categories that are spelt alike, over all raw rows; half of the letters in common."""
    names = _rss_raw(spark, sf).groupBy(F.col("tags").alias("name"), "source").agg(F.count(F.lit(1)).alias("n"))
    return normalise.propose_categories(names, 50)


def q_core_fact(spark, sf):
    return core.core_fact(_events_core(spark, sf)[3])


def q_assemble_fact(spark, sf):
    """J4 and A1 over the one-attribute tables."""
    news = _events_core(spark, sf)[3]
    tables = [core.attribute_table(news, t) for t in ("news_ids", "news_tags", "news_sources", "news_published_dates")]
    return core.assemble_fact(*tables)


def q_day_of_week(spark, sf):
    f = td.fact_orders(spark, sf)
    return f.select("new_id", "published", day_of_week("published").alias("day_of_week"))


def q_win_category_total(spark, sf):
    return windows.category_total(td.fact_orders(spark, sf)).select("new_id", "category",
                                                                    "all_source_count_category_news")


def q_win_day_count(spark, sf):
    return windows.day_count(td.fact_orders(spark, sf))


def q_win_peak(spark, sf):
    return windows.peak(td.fact_orders(spark, sf))


def q_win_weekday_counts(spark, sf):
    w = windows.weekday_window_counts(td.fact_events(spark, sf))
    return w.select("new_id", "category", *[f"amount_news_{d}" for d in schemas.WEEKDAYS])


def q_source_counts(spark, sf):
    return mart.source_counts(td.fact_orders(spark, sf))


def q_today_counts(spark, sf):
    return mart.today_counts(td.fact_orders(spark, sf), ORDERS_AS_OF)


def q_weekday_counts(spark, sf):
    return mart.weekday_counts(td.fact_orders(spark, sf))


def q_busiest_day(spark, sf):
    return mart.busiest_day(td.fact_orders(spark, sf))


def q_avg_news_per_day(spark, sf):
    return mart.avg_news_per_day(td.fact_orders(spark, sf))


def q_mart_names(spark, sf):
    _, sources, tags, news = _events_core(spark, sf)
    return mart.mart(core.core_fact(news), EVENTS_AS_OF, tags=tags, sources=sources)


def q_mart_news(spark, sf):
    return mart.mart(td.fact_orders(spark, sf), ORDERS_AS_OF)


def q_mart_news_events(spark, sf):
    return mart.mart(td.fact_events(spark, sf), EVENTS_AS_OF)


def q_mart_news_corrected(spark, sf):
    return mart.mart(td.fact_events(spark, sf), EVENTS_AS_OF, compat=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "rss_scan": q_rss_scan,
    "explode_categories": q_explode_categories,
    "default_fill": q_default_fill,
    "parse_pubdate_lenient": q_parse_pubdate_lenient,
    "parse_pubdate_strict": q_parse_pubdate_strict,
    "incremental_yesterday": q_incremental_yesterday,
    "rejects": q_rejects,
    "source_from_path": q_source_from_path,
    "raw_discovery": q_raw_discovery,
    "raw_append": q_raw_append,
    "raw_append_delta": q_raw_append_delta,
    "init_load": q_init_load,
    "incremental_load": q_incremental_load,
    "init_load_corrected": q_init_load_corrected,
    "incremental_load_corrected": q_incremental_load_corrected,
    "mapped_load": q_mapped_load,
    "streaming_load": q_streaming_load,
    "raw_union": q_raw_union,
    "raw_to_date": q_raw_to_date,
    "dim_sources": q_dim_sources,
    "dim_tags": q_dim_tags,
    "dim_news_ids": q_dim_news_ids,
    "surrogate_keys": q_surrogate_keys,
    "lookup_news_id": q_lookup_news_id,
    "lookup_source_id": q_lookup_source_id,
    "lookup_tag_id": q_lookup_tag_id,
    "core_published": _attr("news_published_dates"),
    "core_summaries": _attr("news_summaries"),
    "core_links": _attr("news_links"),
    "core_titles": _attr("news_titles"),
    "core_news_sources": _attr("news_sources"),
    "core_news_tags": _attr("news_tags"),
    "check_unique": q_check_unique,
    "check_foreign_keys": q_check_foreign_keys,
    "category_normalise": q_category_normalise,
    "category_proposals": q_category_proposals,
    "core_fact": q_core_fact,
    "assemble_fact": q_assemble_fact,
    "day_of_week": q_day_of_week,
    "win_category_total": q_win_category_total,
    "win_day_count": q_win_day_count,
    "win_peak": q_win_peak,
    "win_weekday_counts": q_win_weekday_counts,
    "source_counts": q_source_counts,
    "today_counts": q_today_counts,
    "weekday_counts": q_weekday_counts,
    "busiest_day": q_busiest_day,
    "avg_news_per_day": q_avg_news_per_day,
    "mart_names": q_mart_names,
    "mart_news": q_mart_news,
    "mart_news_events": q_mart_news_events,
    "mart_news_corrected": q_mart_news_corrected,
}
