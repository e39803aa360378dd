"""Hand-written feeds through the full and delta loads (FIXTURES.md section 4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedmart.operators.core import assemble_fact
from feedmart.plans import delta_load, full_load
from feedmart.plans.load import build_mart
from feedmart.sources.rss import read_landing
from feedmart.sources.store import Store
from tests.feeds import write_landing

D = dt.date


def _rows(df, *cols):
    rows = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(rows, key=lambda t: tuple((v is not None, v) for v in t))


@pytest.fixture()
def landing(tmp_path):
    return write_landing(tmp_path)


def test_scan_reads_both_guid_shapes_and_sources(spark, landing):
    e = read_landing(spark, landing)
    got = _rows(e, "source", "guid", "title")
    assert got == [("lenta_ru", "http://a/1", "A1 & co"), ("lenta_ru", "http://a/2", "A2"),
                   ("lenta_ru", "http://a/3", "A3"), ("lenta_ru", "http://a/4", "A4"),
                   ("tass_ru", None, "no guid 1"), ("tass_ru", None, "no guid 2"),
                   ("tass_ru", "http://a/1", "dup of A1")]


def test_full_load_compat(spark, landing, tmp_path):
    root = str(tmp_path / "store")
    m = full_load(spark, landing, root, as_of="2023-08-22")
    s = Store(spark, root)
    raw = s.read("raw_store", "news")
    assert raw.count() == 8
    assert _rows(s.read("raw_store", "rejects"), "id", "reason") == [("http://a/4", "no_category")]
    assert _rows(raw.where(F.col("id") == "http://a/1"), "source", "tags", "published") == [
        ("lenta_ru", "Economy", "2023-08-20"), ("lenta_ru", "World", "2023-08-20"), ("tass_ru", "Politics", "2023-08-21")]
    assert _rows(raw.where(F.col("id") == "http://a/3"), "published") == [("",)]
    tags = s.read("core_store", "tags")
    assert _rows(tags, "tag_id", "tag_name") == [(1, "Economy"), (2, "World"), (3, "Sport"), (4, "Politics")]
    assert _rows(s.read("core_store", "sources"), "source_id", "source_name") == [(1, "lenta_ru"), (2, "tass_ru")]
    news = (s.read("core_store", "news").join(tags, "tag_id")
            .join(s.read("core_store", "sources"), "source_id"))
    assert _rows(news, "new_raw_id", "title", "tag_name", "source_name", "new_published") == [
        ("", "no guid 1", "Economy", "tass_ru", D(2023, 8, 22)),
        ("http://a/1", "A1 & co", "Economy", "lenta_ru", D(2023, 8, 20)),
        ("http://a/2", "A2", "Sport", "lenta_ru", D(2023, 8, 21)),
        ("http://a/3", "A3", "Sport", "lenta_ru", None)]
    wk = [f"amount_news_{d}" for d in ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")]
    cols = ["id", "category", "source", "all_source_count_category_news", "source_count_category_news",
            "all_source_count_category_news_today", "source_count_category_news_today", "avg_news_per_day",
            "max_news_date"] + wk
    assert _rows(m, *cols) == [
        (1, "Economy", "lenta_ru", 2, 1, None, None, 1, D(2023, 8, 20), 0, 1, 0, 0, 0, 0, 0),
        (2, "Economy", "tass_ru", 2, 1, 2, 1, 1, D(2023, 8, 22), 0, 1, 0, 0, 0, 0, 0),
        (3, "Sport", "lenta_ru", 2, 2, None, None, 2, D(2023, 8, 21), 1, 0, 0, 0, 0, 0, 0)]


def test_second_load_leaves_core_unchanged(spark, landing, tmp_path):
    root = str(tmp_path / "store")
    full_load(spark, landing, root, as_of="2023-08-22", name="first")
    s = Store(spark, root)
    before = {t: _rows(s.read("core_store", t), *s.read("core_store", t).columns) for t in ("sources", "tags", "news")}
    full_load(spark, landing, root, as_of="2023-08-22", name="first")   # same load again: replaced
    assert s.read("raw_store", "news").count() == 8
    full_load(spark, landing, root, as_of="2023-08-22")   # a new load: raw appended
    assert s.read("raw_store", "news").count() == 16
    after = {t: _rows(s.read("core_store", t), *s.read("core_store", t).columns) for t in ("sources", "tags", "news")}
    assert before == after


def test_delta_load_keeps_yesterday(spark, landing, tmp_path):
    root = str(tmp_path / "store")
    delta_load(spark, landing, root, as_of="2023-08-22", load_id=5)
    s = Store(spark, root)
    assert _rows(s.read("raw_store", "news"), "id", "source", "tags", "load_id") == [
        ("http://a/1", "tass_ru", "Politics", 5), ("http://a/2", "lenta_ru", "Sport", 5),
        ("http://a/2", "lenta_ru", "World", 5)]
    assert _rows(s.read("raw_store", "rejects"), "id", "reason") == [("http://a/3", "bad_date"),
                                                                      ("http://a/4", "no_category")]
    with pytest.raises(Exception, match="unparsable pubDate"):
        delta_load(spark, landing, str(tmp_path / "store2"), as_of="2023-08-22", load_id=5, on_bad_date="fail")


def test_full_load_corrected(spark, landing, tmp_path):
    root = str(tmp_path / "store")
    m = full_load(spark, landing, root, as_of="2023-08-22", compat=False)
    s = Store(spark, root)
    assert _rows(s.read("raw_store", "rejects"), "title", "reason") == [
        ("A4", "no_category"), ("no guid 1", "no_guid"), ("no guid 2", "no_guid")]
    pairs = (s.read("core_store", "news_tag_pairs").join(s.read("core_store", "news").select("new_id", "new_raw_id"), "new_id")
             .join(s.read("core_store", "tags"), "tag_id"))
    assert _rows(pairs, "new_raw_id", "tag_name") == [
        ("http://a/1", "Economy"), ("http://a/1", "Politics"), ("http://a/1", "World"),
        ("http://a/2", "Sport"), ("http://a/2", "World"), ("http://a/3", "Sport")]
    got = {(r.category, r.source): r for r in m.collect()}
    # World: a/1 (Sunday 2023-08-20) and a/2 (Monday): Sunday is counted without compat.
    w = got[("World", "lenta_ru")]
    assert (w.all_source_count_category_news, w.amount_news_sunday, w.amount_news_monday) == (2, 1, 1)
    assert (w.all_source_count_category_news_today, w.source_count_category_news_today) == (0, 0)
    assert "category_id" in m.columns and dict(m.dtypes)["all_source_count_category_news"] == "bigint"
    published = spark.table("mart_store.news")
    assert published.columns == m.columns and published.schema == m.schema
    assert sorted(map(tuple, published.collect())) == sorted(map(tuple, m.collect()))
    # the log of pairs gives the same mart as a rebuild from core, also after a second load with more tags
    more = write_landing(tmp_path / "more", {"tass_ru": ("<rss><channel><item><guid>http://a/2</guid><title>again</title>"
                                                         "<pubDate>Mon, 21 Aug 2023 01:00:00 +0300</pubDate><category>Health</category></item></channel></rss>")})
    full_load(spark, more, root, as_of="2023-08-22", compat=False)
    from_log = [tuple(r) for r in build_mart(s, "2023-08-22", compat=False).collect()]
    from_core = [tuple(r) for r in build_mart(s, "2023-08-22", compat=False, from_log=False).collect()]
    assert sorted(from_log) == sorted(from_core) and any("Health" in r for r in from_log)


def test_layers_are_catalog_tables(spark, landing, tmp_path):
    """After a load the reference's schemas are queryable with SQL (K-ns, K-ddl, S3)."""
    full_load(spark, landing, str(tmp_path / "store"), as_of="2023-08-22")
    assert {t.name for t in spark.catalog.listTables("core_store")} >= {"news", "sources", "tags", "news_tag_pairs", "news_ids", "news_tags",
                                                                         "news_published_dates", "news_sources"}
    n = spark.sql("SELECT count(*) FROM raw_store.news WHERE source = 'tass_ru'").first()[0]
    assert n == 3
    got = spark.sql("""SELECT t.tag_name, count(*) AS n FROM core_store.news n JOIN core_store.tags t USING (tag_id)
                       GROUP BY t.tag_name""").collect()
    assert sorted((r.tag_name, r.n) for r in got) == [("Economy", 2), ("Sport", 2)]
    assert spark.sql("SELECT count(*) FROM mart_store.news").first()[0] == 3
    # the fact assembled from the published one-attribute tables
    fact = assemble_fact(*[spark.table(f"core_store.{t}") for t in ("news_ids", "news_tags", "news_sources", "news_published_dates")])
    assert fact.count() == 4 and fact.where("published IS NULL").count() == 1
    assert [r.source_count for r in fact.collect()] == [1] * 4
    assert sorted(r.table_name for r in Store(spark, str(tmp_path / "store")).raw_tables().collect()) == [
        "news_df_lenta_ru", "news_df_tass_ru"]
    # the reference's per-source raw tables, found the way it finds them (by name prefix)
    assert sorted(t.name for t in spark.catalog.listTables("raw_store", "news_df_*")) == [
        "news_df_lenta_ru", "news_df_tass_ru"]
    assert spark.sql("SELECT count(*) FROM raw_store.news_df_tass_ru").first()[0] == 3


def test_mart_from_day_log_equals_full_rebuild(spark, landing, tmp_path):
    """Delta loads over several days, then the mart from the per-load day-count log equals the
    mart rebuilt from the whole core."""
    root = str(tmp_path / "store")
    for i, day in enumerate(["2023-08-21", "2023-08-22", "2023-08-23"]):
        delta_load(spark, landing, root, as_of=day, load_id=10 + i)
    s = Store(spark, root)
    assert sorted(r.load_id for r in s.read("mart_store", "news_days").select("load_id").distinct().collect()) == [
        10, 11, 12]
    cols = None
    from_log = build_mart(s, "2023-08-22", from_log=True)
    cols = from_log.columns
    rows_log = sorted(tuple(r) for r in from_log.collect())
    rows_core = sorted(tuple(r) for r in build_mart(s, "2023-08-22", from_log=False).select(*cols).collect())
    assert rows_log == rows_core and len(rows_log) > 0
    # the deltas over those days hold the same dated news items as one full load
    full_root = str(tmp_path / "full")
    full_load(spark, landing, full_root, as_of="2023-08-22")
    dated = {r.new_raw_id for r in Store(spark, full_root).read("core_store", "news")
             .where(F.col("new_published").isNotNull()).collect()}
    assert {r.new_raw_id for r in s.read("core_store", "news").collect()} == dated == {"", "http://a/1", "http://a/2"}


def test_declared_keys_hold_and_violations_are_found(spark, landing, tmp_path):
    from feedmart.operators.quality import check_store
    root = str(tmp_path / "store")
    full_load(spark, landing, root, as_of="2023-08-22", compat=False)
    s = Store(spark, root)
    report = {(r.check, r.table, r.columns): r.violations for r in check_store(s).collect()}
    assert len(report) == 14 and all(v == 0 for v in report.values()), report
    # a second copy of one news row breaks the primary and the unique key of news
    s.append(s.read("core_store", "news").where(F.col("new_raw_id") == "http://a/2"), "core_store", "news")
    report = {(r.check, r.table, r.columns): r.violations for r in check_store(s).collect()}
    assert report[("primary key", "core_store.news", "new_id")] == 1
    assert report[("unique", "core_store.news", "new_raw_id")] == 1
    # the copied row also counts twice in core's day counts, which the log does not hold
    assert report[("derived", "mart_store.news_days", "sum(n) per category, source, day = core")] == 1
    # and the bridge's pairs of that news item count twice as well
    assert sum(report.values()) == 3 + report[("derived", "mart_store.pair_days", "sum(n) per category, source, day = core")]
