"""DuckDB SQL equal in result to each registered query (tables are pre-registered views).

Written independently of the Spark plans: windows and joins the way a SQL author would write
them, so that agreement is evidence.
"""

from __future__ import annotations

from feedmart.plans.registered import EVENTS_AS_OF, ORDERS_AS_OF, RSS_AS_OF
from feedmart.schemas import WEEKDAYS

FACT_ORDERS = """fact AS (SELECT o_orderkey AS new_id, o_orderpriority AS category, o_orderstatus AS source,
                 CAST(o_orderdate AS DATE) AS published FROM orders)"""
FACT_EVENTS = """fact AS (SELECT event_id AS new_id, event_type AS category,
                 'src_' || CAST(user_id % 3 AS VARCHAR) AS source, CAST(ts AS DATE) AS published FROM events)"""

RAW_EVENTS = """r AS (SELECT 'event ' || CAST(event_id AS VARCHAR) AS title, 'http://e/' || CAST(event_id AS VARCHAR) AS link,
        CAST(user_id AS VARCHAR) AS id, props AS summary, event_type AS tags,
        'src_' || CAST(user_id % 3 AS VARCHAR) AS source,
        CASE WHEN user_id % 10 = 7 THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS published,
        event_id AS entry_pos, CASE WHEN ts < TIMESTAMP '2024-01-08' THEN 0 ELSE 1 END AS load_id FROM events)"""

# Core built from raw-events: first appearance by (load, source, entry_pos) decides every id.
EVENTS_CORE = RAW_EVENTS + """,
s AS (SELECT source AS source_name, row_number() OVER (ORDER BY min(load_id), source) AS source_id
      FROM r GROUP BY source),
t0 AS (SELECT tags, load_id, source, entry_pos, row_number() OVER (PARTITION BY tags ORDER BY load_id, source, entry_pos) AS rn FROM r),
t AS (SELECT tags AS tag_name, row_number() OVER (ORDER BY load_id, source, entry_pos) AS tag_id FROM t0 WHERE rn = 1),
n0 AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY load_id, source, entry_pos) AS rn FROM r),
n1 AS (SELECT row_number() OVER (ORDER BY load_id, source, entry_pos) AS new_id, id AS new_raw_id, title, link, summary,
              TRY_CAST(published AS DATE) AS new_published, source, tags FROM n0 WHERE rn = 1),
news AS (SELECT n1.new_id, n1.new_raw_id, n1.title, n1.link, n1.summary, n1.new_published, s.source_id, t.tag_id,
                n1.source AS source_name, n1.tags AS tag_name
         FROM n1 LEFT JOIN s ON s.source_name = n1.source LEFT JOIN t ON t.tag_name = n1.tags)"""

RSS = """rss AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS order_date,
    CASE WHEN o_custkey % 40 NOT IN (7, 9) THEN CAST(o_orderdate AS DATE) END AS pub_date,
    CASE WHEN o_orderstatus <> 'P' THEN 'http://o/' || CAST(o_orderkey AS VARCHAR) END AS guid,
    'Order ' || CAST(o_orderkey AS VARCHAR) || ' & customer ' || CAST(o_custkey AS VARCHAR) AS title,
    'http://o/' || CAST(o_orderkey AS VARCHAR) AS link,
    CASE WHEN o_orderpriority <> '3-MEDIUM'
         THEN 'total <b>' || CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) || '</b>' END AS description,
    CASE o_custkey % 40 WHEN 7 THEN 'Someday, 1 January' WHEN 9 THEN NULL ELSE
      strftime(o_orderdate + to_hours(CAST(o_custkey % 24 AS INTEGER)), '%a, %d %b %Y %H:%M:%S') || ' ' ||
      CASE o_orderstatus WHEN 'F' THEN '+0300' WHEN 'O' THEN '-0500' WHEN 'P' THEN 'Z' ELSE '+0000' END END AS pubDate,
    o_orderpriority <> '4-NOT SPECIFIED' AS has_category,
    o_orderpriority = '1-URGENT' AS has_second,
    'src_' || o_orderstatus AS source
  FROM orders),
pieces AS (
  SELECT o_orderkey, 0 AS tag_pos, o_orderpriority AS tags FROM rss WHERE has_category
  UNION ALL SELECT o_orderkey, 1 AS tag_pos, o_orderstatus AS tags FROM rss WHERE has_category
  UNION ALL SELECT o_orderkey, 2 AS tag_pos, 'urgent' AS tags FROM rss WHERE has_category AND has_second),
raw_rss AS (
  SELECT rss.title, rss.link, coalesce(rss.guid, '') AS id, coalesce(rss.description, '') AS summary, p.tags,
         rss.source, coalesce(strftime(rss.pub_date, '%Y-%m-%d'), '') AS published, p.tag_pos, rss.o_orderkey, rss.pub_date,
         rss.order_date
  FROM rss JOIN pieces p ON p.o_orderkey = rss.o_orderkey)"""


_DELTA_DAY = f"DATE '{RSS_AS_OF}' - INTERVAL 1 DAY"


def mart_sql(fact_ctes: str, as_of: str, compat: bool = True, names: bool = True) -> str:
    """The mart over a CTE ``fact(category, source, published)``."""
    dow = "extract(dow FROM published)" if compat else "extract(isodow FROM published)"
    wk = ",\n      ".join(f"sum(n) FILTER (WHERE {dow} = {k}) AS wk{k}" for k in range(1, 8))
    whole = "INTEGER" if compat else "BIGINT"
    if compat:
        today = (f"CAST(CASE WHEN s.src_today > 0 THEN c.all_n END AS INTEGER) AS all_source_count_category_news_today,\n"
                 f"  CAST(CASE WHEN s.src_today > 0 THEN s.src_today END AS INTEGER) AS source_count_category_news_today")
        cat_id = ""
    else:
        today = (f"CAST(coalesce(c.all_today, 0) AS BIGINT) AS all_source_count_category_news_today,\n"
                 f"  CAST(coalesce(s.src_today, 0) AS BIGINT) AS source_count_category_news_today")
        cat_id = "dense_rank() OVER (ORDER BY s.category) AS category_id,"
    days = ",\n  ".join(f"CAST(coalesce(c.wk{k}, 0) AS {whole}) AS amount_news_{d}"
                        for k, d in enumerate(WEEKDAYS, start=1))
    return f"""WITH {fact_ctes},
day AS (SELECT category, source, published, count(*) AS n FROM fact GROUP BY category, source, published),
cat AS (SELECT category, sum(n) AS all_n, count(DISTINCT published) AS n_days,
      sum(n) FILTER (WHERE published = DATE '{as_of}') AS all_today,
      {wk}
    FROM day GROUP BY category),
src AS (SELECT category, source, sum(n) AS src_n, sum(n) FILTER (WHERE published = DATE '{as_of}') AS src_today
    FROM day GROUP BY category, source),
peak AS (SELECT category, source, max(published) AS max_news_date FROM (
    SELECT category, source, published, n, max(n) OVER (PARTITION BY category, source) AS top
    FROM day WHERE published IS NOT NULL) x WHERE n = top GROUP BY category, source)
SELECT row_number() OVER (ORDER BY s.category, s.source) AS id, {cat_id}
  s.category, s.source,
  CAST(c.all_n AS {whole}) AS all_source_count_category_news,
  CAST(s.src_n AS {whole}) AS source_count_category_news,
  {today},
  CAST(c.all_n // NULLIF(c.n_days, 0) AS {whole}) AS avg_news_per_day,
  p.max_news_date,
  {days}
FROM src s JOIN cat c ON c.category = s.category
LEFT JOIN peak p ON p.category = s.category AND p.source = s.source"""


def _first_news_fact(order: str, rows: str = "raw_rss") -> str:
    return f"""nf AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {order}) AS rn FROM {rows}),
fact AS (SELECT tags AS category, source, pub_date AS published FROM nf WHERE rn = 1)"""


def _every_tag_fact(rows: str) -> str:
    """Corrected: a row per news item and distinct tag; ids are unique here and entries without one are refused."""
    return f"fact AS (SELECT DISTINCT id, tags AS category, source, pub_date AS published FROM {rows} WHERE id <> '')"


_WK_WINDOW = ",\n  ".join(
    f"CAST(sum(CASE WHEN extract(dow FROM published) = {k} THEN 1 ELSE 0 END) OVER (PARTITION BY category) AS BIGINT)"
    f" AS amount_news_{d}" for k, d in enumerate(WEEKDAYS, start=1))
_WK_AGG = ",\n  ".join(
    f"CAST(count(*) FILTER (WHERE extract(dow FROM published) = {k}) AS BIGINT) AS amount_news_{d}"
    for k, d in enumerate(WEEKDAYS, start=1))

MAPPING = """mapping AS (
  SELECT DISTINCT lower(trim(o_orderpriority)) AS key, upper(regexp_extract(o_orderpriority, '^[0-9]+-(.*)$', 1)) AS canonical
  FROM orders
  UNION
  SELECT DISTINCT lower(trim(regexp_extract(o_orderpriority, '^[0-9]+-(.*)$', 1))) AS key,
         upper(regexp_extract(o_orderpriority, '^[0-9]+-(.*)$', 1)) AS canonical FROM orders)"""

ORACLE: dict[str, str] = {
    "rss_scan": f"""WITH {RSS}
SELECT guid, title, link, description, pubDate,
  CASE WHEN has_category THEN o_orderpriority || ' / ' || o_orderstatus || CASE WHEN has_second THEN '|urgent' ELSE '' END END
    AS category_list,
  CAST(CASE WHEN NOT has_category THEN 0 WHEN has_second THEN 2 ELSE 1 END AS INTEGER) AS n_categories
FROM rss""",
    "explode_categories": f"""WITH {RSS}
SELECT rss.link, p.tag_pos, p.tags FROM pieces p JOIN rss ON rss.o_orderkey = p.o_orderkey""",
    "default_fill": f"""WITH {RSS}
SELECT link, coalesce(guid, '') AS id, title, coalesce(description, '') AS summary FROM rss""",
    "parse_pubdate_lenient": f"""WITH {RSS}
SELECT link, pubDate, coalesce(strftime(pub_date, '%Y-%m-%d'), '') AS published FROM rss""",
    "parse_pubdate_strict": f"""WITH {RSS}
SELECT link, pubDate, strftime(order_date, '%Y-%m-%d') AS published FROM rss
WHERE pubDate LIKE '___, %:%:% %'""",
    "incremental_yesterday": f"""WITH {RSS}
SELECT link, id, tags, tag_pos, published, source FROM raw_rss WHERE pub_date = {_DELTA_DAY}""",
    "rejects": f"""WITH {RSS}, full_load AS (
  SELECT *, CASE WHEN NOT has_category THEN 'no_category' WHEN guid IS NULL THEN 'no_guid' END AS reason, 0 AS load_id FROM rss),
delta_load AS (
  SELECT *, CASE WHEN pub_date IS NULL THEN 'bad_date' WHEN NOT has_category THEN 'no_category' WHEN guid IS NULL THEN 'no_guid' END,
         1 FROM rss WHERE pub_date IS NULL OR pub_date = {_DELTA_DAY})
SELECT coalesce(guid, '') AS id, title, source, pubDate, reason, CAST(load_id AS BIGINT) AS load_id
FROM (SELECT * FROM full_load UNION ALL SELECT * FROM delta_load) WHERE reason IS NOT NULL""",
    "source_from_path": f"""WITH {RSS}
SELECT link, source FROM rss""",
    "raw_discovery": f"""WITH {RSS}
SELECT DISTINCT source, 'news_df_' || source AS table_name FROM raw_rss""",
    "raw_append": f"""WITH {RSS}
SELECT title, link, id, summary, tags, source, published, CAST(load_id AS BIGINT) AS load_id, tag_pos
FROM raw_rss CROSS JOIN (VALUES (1), (2)) loads(load_id)""",
    "raw_append_delta": f"""WITH {RSS}
SELECT title, link, id, summary, tags, source, published, CAST(2 AS BIGINT) AS load_id, tag_pos
FROM raw_rss WHERE pub_date = {_DELTA_DAY}""",
    "init_load": mart_sql(RSS + ",\n" + _first_news_fact("source, o_orderkey, tag_pos"), ORDERS_AS_OF),
    "incremental_load": mart_sql(
        RSS + f""",
loads AS (SELECT *, 0 AS load_id FROM raw_rss WHERE order_date < {_DELTA_DAY}
          UNION ALL SELECT *, 1 AS load_id FROM raw_rss WHERE pub_date = {_DELTA_DAY}),
""" + _first_news_fact("load_id, source, o_orderkey, tag_pos", "loads"), RSS_AS_OF),
    "init_load_corrected": mart_sql(RSS + ",\n" + _every_tag_fact("raw_rss"), ORDERS_AS_OF, compat=False),
    "incremental_load_corrected": mart_sql(
        RSS + f""",
loads AS (SELECT * FROM raw_rss WHERE order_date < {_DELTA_DAY}
          UNION ALL SELECT * FROM raw_rss WHERE pub_date = {_DELTA_DAY} AND order_date >= {_DELTA_DAY}),
""" + _every_tag_fact("loads"), RSS_AS_OF, compat=False),
    "mapped_load": mart_sql(RSS + ", " + MAPPING + """,
mapped AS (SELECT r.* REPLACE (coalesce(m.canonical, trim(r.tags)) AS tags)
           FROM raw_rss r LEFT JOIN mapping m ON m.key = lower(trim(r.tags))),
""" + _first_news_fact("source, o_orderkey, tag_pos", "mapped"), ORDERS_AS_OF),
    "streaming_load": mart_sql(RSS + ",\n" + _first_news_fact("source, o_orderkey, tag_pos"), ORDERS_AS_OF),
    "raw_union": f"""WITH {RAW_EVENTS}
SELECT id, title, tags, source, published, 'events' AS file_path, entry_pos FROM r
UNION ALL
SELECT CAST(l_orderkey AS VARCHAR) AS id, 'line ' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR),
       l_returnflag, 'src_' || l_linestatus, strftime(l_shipdate, '%Y-%m-%d'), 'lineitem', l_orderkey * 8 + l_linenumber
FROM lineitem""",
    "raw_to_date": f"""WITH {RAW_EVENTS}
SELECT entry_pos, TRY_CAST(published AS DATE) AS new_published FROM r""",
    "dim_sources": f"WITH {EVENTS_CORE}\nSELECT source_id, source_name FROM s",
    "dim_tags": f"WITH {EVENTS_CORE}\nSELECT tag_id, tag_name FROM t",
    "dim_news_ids": f"WITH {EVENTS_CORE}\nSELECT new_id, new_raw_id FROM news",
    "surrogate_keys": f"""WITH {EVENTS_CORE},
r2 AS (SELECT CAST(l_orderkey AS VARCHAR) AS id, 'src_' || l_linestatus AS source,
              l_orderkey * 8 + l_linenumber AS entry_pos FROM lineitem),
f AS (SELECT id, source, entry_pos, row_number() OVER (PARTITION BY id ORDER BY source, entry_pos) AS rn FROM r2
      WHERE id NOT IN (SELECT new_raw_id FROM news))
SELECT new_id, new_raw_id FROM news
UNION ALL
SELECT (SELECT max(new_id) FROM news) + row_number() OVER (ORDER BY source, entry_pos), id FROM f WHERE rn = 1""",
    "lookup_news_id": f"""WITH {EVENTS_CORE}
SELECT r.entry_pos, r.id, news.new_id FROM r LEFT JOIN news ON news.new_raw_id = r.id""",
    "lookup_source_id": f"""WITH {EVENTS_CORE}
SELECT r.entry_pos, r.source, s.source_id FROM r LEFT JOIN s ON s.source_name = r.source""",
    "lookup_tag_id": f"""WITH {EVENTS_CORE}
SELECT r.entry_pos, r.tags, t.tag_id FROM r LEFT JOIN t ON t.tag_name = r.tags""",
    "core_published": f"WITH {EVENTS_CORE}\nSELECT new_id, new_published FROM news",
    "core_summaries": f"WITH {EVENTS_CORE}\nSELECT new_id, summary FROM news",
    "core_links": f"WITH {EVENTS_CORE}\nSELECT new_id, link FROM news",
    "core_titles": f"WITH {EVENTS_CORE}\nSELECT new_id, title FROM news",
    "core_news_sources": f"WITH {EVENTS_CORE}\nSELECT new_id, source_id FROM news",
    "core_news_tags": f"WITH {EVENTS_CORE}\nSELECT new_id, tag_id FROM news",
    "check_unique": """SELECT CAST(user_id AS VARCHAR) AS id, count(*) AS n_rows FROM events
GROUP BY CAST(user_id AS VARCHAR) HAVING count(*) > 1""",
    "check_foreign_keys": """SELECT CAST(l_orderkey AS VARCHAR) AS id, l_orderkey * 8 + l_linenumber AS entry_pos
FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM events e WHERE CAST(e.user_id AS VARCHAR) = CAST(l.l_orderkey AS VARCHAR))""",
    "category_normalise": f"""WITH {RSS}, {MAPPING}
SELECT rss.link, p.tag_pos, coalesce(m.canonical, trim(p.tags)) AS tags
FROM pieces p JOIN rss ON rss.o_orderkey = p.o_orderkey LEFT JOIN mapping m ON m.key = lower(trim(p.tags))""",
    "category_proposals": f"""WITH RECURSIVE {RSS},
used AS (SELECT trim(p.tags) AS name, source, count(*) AS n FROM pieces p JOIN rss ON rss.o_orderkey = p.o_orderkey GROUP BY ALL),
forms AS (SELECT lower(name) AS key, name, sum(n) AS n FROM used GROUP BY ALL),
keys AS (SELECT f.key, arg_min(f.name, row(-f.n, f.name)) AS name, CAST(sum(f.n) AS BIGINT) AS n, count(*) AS forms,
                any_value(s.sources) AS sources
         FROM forms f JOIN (SELECT lower(name) AS key, count(DISTINCT source) AS sources FROM used GROUP BY ALL) s USING (key) GROUP BY f.key),
sets AS (SELECT key, list_distinct(flatten(list_transform(
           list_filter(string_split(regexp_replace(key, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> ''),
           lambda w: list_transform(range(1, len(w) + 1), lambda i: substr('#' || w || '#', i, 3))))) AS g FROM keys),
pairs AS (SELECT a.key AS a, b.key AS b, len(list_intersect(a.g, b.g)) / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g))) AS overlap
          FROM sets a JOIN sets b ON a.key <> b.key WHERE len(a.g) > 0 AND len(b.g) > 0
          AND 100 * len(list_intersect(a.g, b.g)) >= 50 * (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g)))),
reach(a, b) AS (SELECT key, key FROM keys UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON pairs.a = reach.b),
grouped AS (SELECT k.*, r.component, p.overlap FROM keys k JOIN (SELECT a AS key, min(b) AS component FROM reach GROUP BY a) r USING (key)
            LEFT JOIN (SELECT a AS key, max(overlap) AS overlap FROM pairs GROUP BY a) p USING (key) WHERE p.overlap IS NOT NULL OR forms > 1)
SELECT key, name, first_value(name) OVER (PARTITION BY component ORDER BY -n, -sources, name) AS canonical, coalesce(overlap, 1.0) AS overlap,
       n, CAST(sources AS BIGINT) AS sources, 'proposed' AS status FROM grouped""",
    "core_fact": f"""WITH {EVENTS_CORE}
SELECT new_id, tag_id AS category, source_id AS source, new_published AS published FROM news""",
    "assemble_fact": f"""WITH {EVENTS_CORE}
SELECT new_id, tag_id AS category, source_id AS source, new_published AS published,
       CAST(CASE WHEN source_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS source_count FROM news""",
    "day_of_week": f"""WITH {FACT_ORDERS}
SELECT new_id, published, CAST(extract(dow FROM published) AS INTEGER) AS day_of_week FROM fact""",
    "win_category_total": f"""WITH {FACT_ORDERS}
SELECT new_id, category, count(*) OVER (PARTITION BY category) AS all_source_count_category_news FROM fact""",
    "win_day_count": f"""WITH {FACT_ORDERS}
SELECT new_id, category, source, published,
       count(*) OVER (PARTITION BY category, source, published) AS max_news_per_day FROM fact""",
    "win_peak": f"""WITH {FACT_ORDERS}
SELECT category, source, published, count(*) AS max_count_news,
       max(count(*)) OVER (PARTITION BY category, source) AS "max"
FROM fact GROUP BY category, source, published""",
    "win_weekday_counts": f"""WITH {FACT_EVENTS}
SELECT new_id, category,
  {_WK_WINDOW}
FROM fact""",
    "source_counts": f"""WITH {FACT_ORDERS}
SELECT category, source, count(*) AS source_count_category_news FROM fact GROUP BY category, source""",
    "today_counts": f"""WITH {FACT_ORDERS},
cat AS (SELECT category, count(*) AS all_n FROM fact GROUP BY category),
src AS (SELECT category, source, count(*) FILTER (WHERE published = DATE '{ORDERS_AS_OF}') AS src_today
        FROM fact GROUP BY category, source)
SELECT s.category, s.source,
  CASE WHEN s.src_today > 0 THEN c.all_n END AS all_source_count_category_news_today,
  CASE WHEN s.src_today > 0 THEN s.src_today END AS source_count_category_news_today
FROM src s JOIN cat c ON c.category = s.category""",
    "weekday_counts": f"""WITH {FACT_ORDERS}
SELECT category,
  {_WK_AGG}
FROM fact GROUP BY category""",
    "busiest_day": f"""WITH {FACT_ORDERS},
day AS (SELECT category, source, published, count(*) AS n FROM fact WHERE published IS NOT NULL
        GROUP BY category, source, published)
SELECT category, source, max(published) AS max_news_date FROM day d
WHERE n = (SELECT max(n) FROM day x WHERE x.category = d.category AND x.source = d.source)
GROUP BY category, source""",
    "avg_news_per_day": f"""WITH {FACT_ORDERS}
SELECT category, count(*) AS all_source_count_category_news,
       count(*) // NULLIF(count(DISTINCT published), 0) AS avg_news_per_day
FROM fact GROUP BY category""",
    "mart_names": mart_sql(EVENTS_CORE + """,
fact AS (SELECT new_id, tag_name AS category, source_name AS source, new_published AS published FROM news)""",
                           EVENTS_AS_OF),
    "mart_news": mart_sql(FACT_ORDERS, ORDERS_AS_OF),
    "mart_news_events": mart_sql(FACT_EVENTS, EVENTS_AS_OF),
    "mart_news_corrected": mart_sql(FACT_EVENTS, EVENTS_AS_OF, compat=False),
}
