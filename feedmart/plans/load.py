"""Full and delta loads as one Spark application each.

Stage boundaries are written tables, so lineage is cut between layers, and each is noted in the store's commit log:

0. Loads that broke off are repaired first, named or not: one whose raw rows are complete is replayed from them with
   its own parameters, step by step from the first that isn't noted; any other is forgotten, as it changed nothing.
1. landing -> raw: one XML scan of every source and file, written in one pass as raw rows and rejects under a
   fresh load id. A re-run of a named load replaces all that load wrote there, once its new rows are complete.
2. raw (this load's rows only) -> core: sources, tags, then news (and the tag bridge when
   ``compat=False``), each an insert-if-absent append; a replay or re-run appends what is missing. A category mapping is
   applied here, so raw keeps the categories as delivered and a changed mapping can be applied again.
3. core -> mart: a new version of the mart from the day counts that each load added.

A store may change between ``compat`` and corrected loads: pairs that the bridge lacks are filled in from raw, load by load
(``fill_pairs``); where refused entries make the compat mart impossible there is an error.

The delta load differs only in step 1: entries published on the day before ``as_of``, strict
date parsing (bad dates are rejected, or fail the job with ``on_bad_date="fail"``).
"""

from __future__ import annotations

import datetime as _dt
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmart.operators.core import core_fact, new_news_rows, new_news_tag_rows, new_sources, new_tags
from feedmart.operators.ingest import NO_GUID, classify, to_entries
from feedmart.operators.mart import day_counts, mart, mart_from_days, mart_from_state
from feedmart.operators.normalise import category_normalise
from feedmart.session import materialise, scratch_scope
from feedmart.sources.rss import read_landing
from feedmart.sources.store import Store


def resolve_day(spark: SparkSession, as_of=None) -> _dt.date:
    """The day that counts as today, taken once per load: the given one, or the session's current date."""
    if as_of is None:
        return spark.sql("SELECT current_date()").first()[0]
    if isinstance(as_of, _dt.datetime):
        return as_of.date()
    return as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of))


def load_raw(entries: DataFrame, store: Store, load_id: int | None = None, mode: str = "full", as_of=None,
             compat: bool = True, on_bad_date: str = "reject", name: str | None = None,
             mapping: DataFrame | None = None) -> tuple[int, DataFrame]:
    """Step 1. Returns the load's id and its raw rows as stored (read back from the table). The mapping is only kept with the load."""
    load_id = store.begin_load(load_id, name, compat, mapping)
    store.append_entries(to_entries(classify(entries, mode, as_of, compat, on_bad_date), load_id), load_id)
    return load_id, store.load_rows("news", load_id)


def load_core(raw: DataFrame, store: Store, compat: bool = True, load_id: int | None = None,
              mapping: DataFrame | None = None, replay: bool = False) -> None:
    """Step 2: insert-if-absent of sources, tags, news (and news-tag pairs), and the day counts of what this
    load added. With ``load_id`` each step is noted; new ids start after the last one given out. ``replay``: the load broke off
    before, so some of its rows may be there."""
    if mapping is not None:
        raw = category_normalise(raw, "tags", mapping)
    recount = load_id is not None and (replay or store.is_rerun(load_id))
    with scratch_scope(store.spark):
        if load_id is None:
            last = store.read("core_store", "news").agg(F.max("new_id")).first()[0] or 0
        else:
            last = store.last_new_id(but=None if recount else load_id)

        def add(table: str, rows) -> None:
            store.step(load_id, table, lambda: store.append(rows(raw, store.read("core_store", table)), "core_store", table))
        with ThreadPoolExecutor(2) as both:  # two small, independent jobs
            for done in [both.submit(copy_context().run, add, "sources", new_sources), both.submit(copy_context().run, add, "tags", new_tags)]:
                done.result()
        tags = store.read("core_store", "tags")
        seen = store.seen_loads(raw)
        new: dict[str, DataFrame] = {}

        def add_news() -> None:
            rows = new_news_rows(raw, store.history("news", seen), store.read("core_store", "sources"), tags,
                                 news_buckets=store.buckets(), last_id=last)
            new["news"] = materialise(rows, "new-news")
            store.append_news(new["news"])

        def add_pairs() -> None:
            new["pairs"] = _append_pairs(store, raw, tags, seen + [load_id] if load_id is not None else store.seen_loads(raw))
        store.step(load_id, "news", add_news)
        if not compat:
            store.step(load_id, "pairs", add_pairs)
        if load_id is None:
            return
        own = store.read("core_store", "news").where(F.col("load_id") == load_id) if recount else new["news"]
        _log_days(store, "news_days", core_fact(own), load_id, recount)
        if not compat:
            _log_days(store, "pair_days", _own_pairs(store, load_id) if recount else _pair_fact(new["pairs"]), load_id, recount)
        store.end_load(load_id, max(last, own.agg(F.max("new_id")).first()[0] or 0))


def _append_pairs(store: Store, raw: DataFrame, tags: DataFrame, loads: list[int]) -> DataFrame:
    pairs = materialise(new_news_tag_rows(raw, store.history("news", loads), tags, store.history("news_tag_pairs", loads), store.buckets()), "new-pairs")
    store.append_pairs(pairs)
    return pairs


def _pair_fact(pairs: DataFrame) -> DataFrame:
    return pairs.select("new_id", F.col("tag_id").alias("category"), F.col("source_id").alias("source"), F.col("new_published").alias("published"))


def _own_pairs(store: Store, load_id: int) -> DataFrame:
    """The fact of the pairs that a load added, as core holds them."""
    own = store.read("core_store", "news_tag_pairs").where(F.col("load_id") == load_id).drop("new_id")
    news = store.read("core_store", "news").select("new_raw_id", "new_id", "source_id", "new_published")
    return _pair_fact(own.join(news, "new_raw_id"))


def _log_days(store: Store, table: str, fact: DataFrame, load_id: int, recount: bool = False) -> None:
    """Day counts of what this run of a load added: of all that the load added, less what its earlier runs have logged."""
    days = day_counts(fact)
    if recount:
        before = store.log_of_loads(table, [load_id]).select("category", "source", "published", (-F.col("n")).alias("n"))
        days = days.unionByName(before).groupBy("category", "source", "published").agg(F.sum("n").alias("n")).where("n <> 0")
    store.append_log(days, table, load_id)


def repair(store: Store) -> list[int]:
    """Step 0: bring every load that has begun and not ended to its end. Returns the loads that were replayed."""
    replayed = []
    for load_id in store.open_loads():
        load = store.load(load_id)
        if load["written"]:
            load_core(store.load_rows("news", load_id), store, load["compat"], load_id, store.mapping(load_id), replay=True)
            replayed.append(load_id)
        else:
            store.abort_load(load_id)
    return replayed


def fill_pairs(store: Store) -> list[int]:
    """Add the news-tag pairs of loads that ran with ``compat=True`` to the bridge and the pair log, load by load; a call that breaks off
    is continued by the next. Entries without id, which the corrected mart refuses, get no pairs. Returns the loads that were filled."""
    loads = store.ledger.state()["loads"]
    lacking = sorted(int(i) for i, x in loads.items() if x["written"] and x["open"] is None and not x["pairs"])
    for load_id in lacking:
        raw = store.load_rows("news", load_id).where("id <> ''")
        mapping = store.mapping(load_id)
        if mapping is not None:
            raw = category_normalise(raw, "tags", mapping)
        with scratch_scope(store.spark):
            _append_pairs(store, raw, store.read("core_store", "tags"), store.seen_loads(raw))
            _log_days(store, "pair_days", _own_pairs(store, load_id), load_id, recount=True)
        store.ledger.note("pairs", load=load_id)
    return lacking


def _ready_for(store: Store, compat: bool) -> None:
    """The log that the mart of this mode is built from holds every load, or an error."""
    if not compat:
        fill_pairs(store)
        return
    refused = [int(i) for i, x in store.ledger.state()["loads"].items() if x["refused"]]
    if refused and not store.read("raw_store", "rejects").where(F.col("load_id").isin(refused) & (F.col("reason") == NO_GUID)).isEmpty():
        raise ValueError("this store refused entries without id (loads with compat=False), which a mart with compat=True would count; "
                         "load with compat=False, or load the feeds into a new store")


def build_mart(store: Store, as_of=None, compat: bool = True, from_log: bool = True) -> DataFrame:
    """Step 3: rebuild the mart and return it as stored.

    News items and news-tag pairs are only ever added, so the mart is built from the day counts that the loads added, and a load
    doesn't rescan the history of core. Once the log was merged (``Store.merge_log``), the states of its measures are read with the few
    runs since then, and of the merged day counts only the days that these runs touch. ``from_log=False`` rebuilds from the whole core."""
    _ready_for(store, compat)
    tags, sources = store.read("core_store", "tags"), store.read("core_store", "sources")
    with scratch_scope(store.spark):
        if from_log:
            m = _mart_from_log(store, "news_days" if compat else "pair_days", as_of, compat, tags, sources)
        else:
            bridge = None if compat else store.read("core_store", "news_tag_pairs")
            m = mart(core_fact(store.read("core_store", "news"), bridge), as_of, compat, tags=tags, sources=sources)
        return store.overwrite(m, "mart_store", "news")


def _mart_from_log(store: Store, table: str, as_of, compat: bool, tags: DataFrame, sources: DataFrame) -> DataFrame:
    new, state = store.log_since(table), store.log_state(table)
    if state is None:
        days = new.groupBy("category", "source", "published").agg(F.sum("n").alias("n"))
        return mart_from_days(days, as_of, compat, tags=tags, sources=sources)
    merged, pairs, categories = state
    first, last = new.agg(F.min("published"), F.max("published")).first()
    today = F.lit(resolve_day(store.spark, as_of))
    touched = F.col("published").between(F.lit(first), F.lit(last)) if first else F.lit(False)
    return mart_from_state(pairs, categories, merged.where(touched | (F.col("published") == today)), new, as_of, compat, tags=tags, sources=sources)


def load_entries(store: Store, entries: DataFrame, mode: str = "full", as_of=None, compat: bool = True, on_bad_date: str = "reject",
                 load_id: int | None = None, name: str | None = None, mapping: DataFrame | None = None) -> DataFrame:
    """Steps 0 to 3 for the given feed entries. Returns the mart."""
    day = resolve_day(store.spark, as_of)
    repair(store)
    _ready_for(store, compat)
    load_id, raw = load_raw(entries, store, load_id, mode, day, compat, on_bad_date, name, mapping)
    load_core(raw, store, compat, load_id, store.mapping(load_id))  # as kept with the load: its size is known, so it is broadcast
    store.merge_log("news_days")
    store.merge_log("pair_days")
    return build_mart(store, day, compat)


def full_load(spark: SparkSession, landing: str, root: str, as_of=None, compat: bool = True, load_id: int | None = None,
              mapping: DataFrame | None = None, name: str | None = None, pattern: str = "*/*",
              modified_after: str | None = None, store: Store | None = None) -> DataFrame:
    """Every entry of the landing folder -> raw -> core -> mart. Returns the mart."""
    store = store or Store(spark, root).register()
    return load_entries(store, read_landing(spark, landing, pattern, modified_after), "full", as_of, compat, "reject", load_id, name, mapping)


def delta_load(spark: SparkSession, landing: str, root: str, as_of=None, compat: bool = True, load_id: int | None = None,
               on_bad_date: str = "reject", mapping: DataFrame | None = None, name: str | None = None, pattern: str = "*/*",
               modified_after: str | None = None, store: Store | None = None) -> DataFrame:
    """Entries published the day before ``as_of`` -> raw -> core -> mart. Returns the mart.

    ``pattern`` and ``modified_after`` keep the scan to files that can hold that day's entries."""
    store = store or Store(spark, root).register()
    return load_entries(store, read_landing(spark, landing, pattern, modified_after), "delta", as_of, compat, on_bad_date, load_id, name, mapping)
