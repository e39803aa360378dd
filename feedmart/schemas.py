"""Explicit schemas of every layer (no inference anywhere).

Types follow the reference's DDL: text -> STRING, serial/integer keys -> BIGINT (computed wide,
cast to INT only where the mart declares INTEGER), date -> DATE.
"""

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()
I = T.IntegerType()
D = T.DateType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# One RSS <item>. `guid` is read as text: with an explicit STRING the element text is returned
# whether or not it carries an isPermaLink attribute.
RSS_ITEM = _struct(("guid", S), ("title", S), ("link", S), ("description", S), ("pubDate", S),
                   ("category", T.ArrayType(S)))

# As scanned from files: text that isn't well-formed XML is kept beside the fields.
CORRUPT = "_corrupt_record"
RSS_SCAN = T.StructType([*RSS_ITEM.fields, T.StructField(CORRUPT, S, True)])

# One Atom <entry>, as scanned from files; attributes have a leading underscore.
ATOM_SCAN = _struct(("id", S), ("title", S), ("link", T.ArrayType(_struct(("_href", S), ("_rel", S)))), ("summary", S), ("content", S),
                    ("published", S), ("category", T.ArrayType(_struct(("_term", S)))), (CORRUPT, S))

# Raw layer: the reference's seven text columns, then the arrival-order columns that make
# "first writer wins" well defined across loads, sources, files and splits.
RAW_COLUMNS = ["title", "link", "id", "summary", "tags", "source", "published"]
RAW_ORDER = ["load_id", "source", "file_path", "block_start", "entry_pos", "tag_pos"]
RAW = _struct(("title", S), ("link", S), ("id", S), ("summary", S), ("tags", S), ("source", S),
              ("published", S), ("load_id", L), ("file_path", S), ("block_start", L), ("entry_pos", L),
              ("tag_pos", I))

REJECT = _struct(("id", S), ("title", S), ("source", S), ("pubDate", S), ("reason", S), ("load_id", L),
                 ("file_path", S), ("entry_pos", L), ("raw_text", S))
# What a load writes in one pass: raw rows (accepted) and rejects, apart by the status folder.
ENTRIES = T.StructType([*RAW.fields, *[f for f in REJECT.fields if f.name not in RAW.fieldNames()],
                        T.StructField("status", S, True)])
ACCEPTED, REJECTED = "accepted", "rejected"

# Core layer. The six one-attribute tables of the reference share one key and are filled from the
# same first raw row, so they are kept as one wide table; each is a column selection of it.
SOURCES = _struct(("source_id", L), ("source_name", S))
TAGS = _struct(("tag_id", L), ("tag_name", S))
NEWS = _struct(("new_id", L), ("new_raw_id", S), ("title", S), ("link", S), ("summary", S),
               ("new_published", D), ("source_id", L), ("tag_id", L), ("load_id", L))
NEWS_TAGS = _struct(("new_raw_id", S), ("new_id", L), ("tag_id", L), ("load_id", L))
# Names of categories that are like others, to be reviewed.
PROPOSALS = _struct(("key", S), ("name", S), ("canonical", S), ("overlap", T.DoubleType()), ("n", L), ("sources", L), ("status", S))
# 64-bit hash of a news item's raw id and the load that brought it.
NEWS_KEYS = _struct(("h", L), ("load_id", L))
# News (or news-tag pairs) per (category, source, day) added by one load: additive because core is
# insert-only.
NEWS_DAYS = _struct(("category", L), ("source", L), ("published", D), ("n", L), ("load_id", L))

CORE_ATTRIBUTE_TABLES = {
    "news_ids": ["new_id", "new_raw_id"],
    "news_published_dates": ["new_id", "new_published"],
    "news_summaries": ["new_id", "summary"],
    "news_links": ["new_id", "link"],
    "news_titles": ["new_id", "title"],
    "news_sources": ["new_id", "source_id"],
    "news_tags": ["new_id", "tag_id"],
}

# Mart layer, in the reference's column order.
WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
MART_COUNT_COLUMNS = ["all_source_count_category_news", "source_count_category_news",
                      "all_source_count_category_news_today", "source_count_category_news_today",
                      "avg_news_per_day"]
MART_COLUMNS = (["id", "category", "source"] + MART_COUNT_COLUMNS + ["max_news_date"]
                + [f"amount_news_{d}" for d in WEEKDAYS])
MART_CORRECTED = T.StructType([T.StructField("id", L), T.StructField("category_id", L), T.StructField("category", S),
                               T.StructField("source", S)] + [T.StructField(c, L) for c in MART_COUNT_COLUMNS]
                              + [T.StructField("max_news_date", D)] + [T.StructField(f"amount_news_{d}", L) for d in WEEKDAYS])
MART = T.StructType([T.StructField("id", L), T.StructField("category", S), T.StructField("source", S)]
                    + [T.StructField(c, I) for c in MART_COUNT_COLUMNS]
                    + [T.StructField("max_news_date", D)]
                    + [T.StructField(f"amount_news_{d}", I) for d in WEEKDAYS])
