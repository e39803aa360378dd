"""Core layer: dimensions, surrogate keys, lookups and the news table.

The reference fills nine tables with nine ``INSERT ... ON CONFLICT DO NOTHING`` statements, each
re-reading raw. Here: one first-row-per-key pass over raw gives every attribute of a new news item
(the six attribute tables are column selections of one wide table); dimensions are small
distinct sets. Lookups against ``sources``/``tags`` are joins whose broadcast is decided by
Spark from the dimension's real size (file size at planning, shuffle-stage size under AQE).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmart.functions.dates import raw_to_date
from feedmart.operators.keys import dense_ids, first_per_key, insert_if_absent, max_id
from feedmart.schemas import CORE_ATTRIBUTE_TABLES, RAW_ORDER


def new_dimension_rows(raw: DataFrame, target: DataFrame, raw_col: str, id_col: str, name_col: str,
                       order: Sequence[str] = RAW_ORDER) -> DataFrame:
    """Names of ``raw_col`` not yet in ``target``, numbered after its largest id in order
    of first appearance. Category names are free text, so they are numbered like the news keys."""
    names = raw.select(F.col(raw_col).alias("_name"), *order)
    first = first_per_key(names, ["_name"], order)
    fresh = insert_if_absent(first, target, ["_name"], [name_col])
    numbered = dense_ids(fresh, list(order), id_col, start=max_id(target, id_col))
    return numbered.select(id_col, F.col("_name").alias(name_col))


def new_sources(raw: DataFrame, sources: DataFrame, order: Sequence[str] = RAW_ORDER) -> DataFrame:
    return new_dimension_rows(raw, sources, "source", "source_id", "source_name", order)


def new_tags(raw: DataFrame, tags: DataFrame, order: Sequence[str] = RAW_ORDER) -> DataFrame:
    return new_dimension_rows(raw, tags, "tags", "tag_id", "tag_name", order)


def lookup_news_id(df: DataFrame, news_ids: DataFrame, col: str = "id") -> DataFrame:
    """Raw id -> ``new_id`` (left join; NULL when the id is unknown)."""
    ids = news_ids.select(F.col("new_raw_id").alias(col), "new_id")
    return df.join(ids, on=col, how="left")


def lookup_source_id(df: DataFrame, sources: DataFrame, col: str = "source") -> DataFrame:
    """Source name -> ``source_id``."""
    return df.join(sources.select(F.col("source_name").alias(col), "source_id"), on=col, how="left")


def lookup_tag_id(df: DataFrame, tags: DataFrame, col: str = "tags") -> DataFrame:
    """Tag name -> ``tag_id``."""
    return df.join(tags.select(F.col("tag_name").alias(col), "tag_id"), on=col, how="left")


def new_news_rows(raw: DataFrame, news: DataFrame, sources: DataFrame, tags: DataFrame,
                  order: Sequence[str] = RAW_ORDER, news_buckets: int | None = None,
                  last_id: int | None = None) -> DataFrame:
    """Raw ids not in ``news`` yet, each with the attributes of its first raw row (first writer
    wins), a new surrogate key, its source and first tag as ids, and the load that brought it.

    ``sources`` and ``tags`` must already hold every name of ``raw`` (load them first).
    ``news_buckets``: bucket count of ``news`` by ``new_raw_id`` (see ``insert_if_absent``).
    ``last_id``: largest ``new_id`` given out, if the caller knows it; else ``news`` is read for it.

    Only ids and order columns are sorted and numbered; the wide attributes move once, by id."""
    fresh = insert_if_absent(first_per_key(raw, ["id"], order), news, ["id"], ["new_raw_id"], news_buckets)
    start = max_id(news, "new_id") if last_id is None else last_id
    ids = dense_ids(fresh, list(order), "new_id", start=start).select("id", "new_id")
    first = first_per_key(raw, ["id"], order, ["title", "link", "summary", "published", "source", "tags"])
    named = lookup_tag_id(lookup_source_id(first.join(ids, "id"), sources), tags)
    return named.select("new_id", F.col("id").alias("new_raw_id"), "title", "link", "summary",
                        raw_to_date(F.col("published")).alias("new_published"), "source_id", "tag_id",
                        "load_id")


def new_news_tag_rows(raw: DataFrame, news: DataFrame, tags: DataFrame, bridge: DataFrame,
                      buckets: int | None = None) -> DataFrame:
    """compat=False: every (news, tag) pair of raw not yet in the bridge table (the reference keys
    ``news_tags`` by news alone and so keeps only the first tag), with the news item's source, date and load, and
    the first load that brought the pair.

    ``news`` and ``bridge`` are bucketed by the raw id into ``buckets``: both joins are on that id, so only
    this load's pairs are shuffled. The bridge is gathered to one row of tag ids per news item, inside its buckets."""
    pairs = lookup_tag_id(raw.groupBy("id", "tags").agg(F.min("load_id").alias("load_id")), tags)
    pairs = pairs.where(F.col("tag_id").isNotNull()).select(F.col("id").alias("new_raw_id"), "tag_id", "load_id")
    if buckets:
        pairs = pairs.repartition(buckets, "new_raw_id")
    held = bridge.groupBy("new_raw_id").agg(F.collect_set("tag_id").alias("_held"))
    rows = pairs.join(news.select("new_raw_id", "new_id", "source_id", "new_published", F.col("load_id").alias("news_load")), "new_raw_id", "left")
    rows = rows.join(held, "new_raw_id", "left")
    fresh = rows.where(F.col("new_id").isNotNull() & ~F.coalesce(F.array_contains("_held", F.col("tag_id")), F.lit(False)))
    return fresh.select("new_raw_id", "new_id", "tag_id", "load_id", "source_id", "new_published", "news_load")


def attribute_table(news: DataFrame, name: str) -> DataFrame:
    """One of the reference's one-attribute core tables, as a column selection of ``news``."""
    return news.select(*CORE_ATTRIBUTE_TABLES[name])


def core_fact(news: DataFrame, bridge: DataFrame | None = None) -> DataFrame:
    """J4 on the wide table: one fact row per news item (with a bridge table: per pair of news item and tag, joined
    on the raw id by which both are bucketed): ``new_id, category (tag_id), source (source_id), published``."""
    base = news.select("new_raw_id", "new_id", F.col("source_id").alias("source"), F.col("new_published").alias("published"),
                       F.col("tag_id").alias("category"))
    if bridge is not None:
        base = base.drop("category").join(bridge.select("new_raw_id", F.col("tag_id").alias("category")), "new_raw_id")
    return base.select("new_id", "category", "source", "published")


def assemble_fact(news_ids: DataFrame, news_tags: DataFrame, news_sources: DataFrame,
                  news_published_dates: DataFrame) -> DataFrame:
    """J4 over separately stored attribute tables: three left joins on ``new_id``, then A1
    (``count(source_id)`` per news item, 1 or 0)."""
    f = (news_ids.select("new_id")
         .join(news_tags.select("new_id", F.col("tag_id").alias("category")), "new_id", "left")
         .join(news_sources.select("new_id", F.col("source_id").alias("source")), "new_id", "left")
         .join(news_published_dates.select("new_id", F.col("new_published").alias("published")), "new_id", "left"))
    return f.groupBy("new_id", "category", "source", "published").agg(F.count("source").alias("source_count"))
