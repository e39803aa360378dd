"""Stand-in sources over the driver's tables (there are no news feeds in the test data).

* fact-orders: ``new_id = o_orderkey, category = o_orderpriority, source = o_orderstatus,
  published = date(o_orderdate)``.
* fact-events: ``new_id = event_id, category = event_type, source = 'src_' || user_id % 3,
  published = date(ts)``.
* raw-events / raw-lineitem: raw rows with many rows per id (``user_id`` / ``l_orderkey``), in
  arrival order ``event_id`` / (``l_orderkey``, ``l_linenumber``). raw-events come as two loads, before and from
  SECOND_LOAD on; events whose user number ends in UNDATED_USER have no date ('').
* rss-orders: one RSS ``<item>`` per order, as XML text built from the order's columns, and the
  same items written as a landing folder (one folder per source). Orders with status P carry no
  guid, priority 3-MEDIUM no description, 4-NOT SPECIFIED no category; 1-URGENT items carry a
  second category element. The pubDate offset depends on the status. Orders of customers whose number
  leaves BAD_DATE_CUSTOMER of DATE_CYCLE have a pubDate that doesn't parse, NO_DATE_CUSTOMER none.

Everything is derived from whole tables by Spark; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmart.schemas import RAW, RSS_ITEM
from feedmart.session import shuffle_partitions
from feedmart.sources.rss import parse_items, write_feeds

# Fixed values of the rss-orders mapping (also spelled in the oracle SQL).
STATUS_OFFSET = {"F": "+0300", "O": "-0500", "P": "Z"}
NO_GUID_STATUS = "P"
NO_DESCRIPTION_PRIORITY = "3-MEDIUM"
NO_CATEGORY_PRIORITY = "4-NOT SPECIFIED"
SECOND_CATEGORY_PRIORITY = "1-URGENT"
SECOND_CATEGORY = "urgent"
DATE_CYCLE, BAD_DATE_CUSTOMER, NO_DATE_CUSTOMER = 40, 7, 9
BAD_DATE_TEXT = "Someday, 1 January"
SECOND_LOAD = "2024-01-08"
UNDATED_USER = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("new_id"), F.col("o_orderpriority").alias("category"),
                    F.col("o_orderstatus").alias("source"), F.to_date("o_orderdate").alias("published"))


def fact_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("new_id"), F.col("event_type").alias("category"),
                    F.concat(F.lit("src_"), (F.col("user_id") % 3).cast("string")).alias("source"),
                    F.to_date("ts").alias("published"))


def _raw(cols: dict[str, Column]) -> list[Column]:
    return [cols[f.name].cast(f.dataType).alias(f.name) for f in RAW.fields]


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id").cast("string")
    return e.select(*_raw({
        "title": F.concat(F.lit("event "), eid), "link": F.concat(F.lit("http://e/"), eid),
        "id": F.col("user_id").cast("string"), "summary": F.col("props"), "tags": F.col("event_type"),
        "source": F.concat(F.lit("src_"), (F.col("user_id") % 3).cast("string")),
        "published": F.when(F.col("user_id") % 10 == UNDATED_USER, "").otherwise(F.date_format("ts", "yyyy-MM-dd")),
        "load_id": (F.col("ts") >= F.lit(SECOND_LOAD).cast("timestamp")).cast("int"), "file_path": F.lit("events"),
        "block_start": F.lit(0), "entry_pos": F.col("event_id"), "tag_pos": F.lit(0)}))


def raw_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey").cast("string")
    return li.select(*_raw({
        "title": F.concat(F.lit("line "), key, F.lit("-"), F.col("l_linenumber").cast("string")),
        "link": F.concat(F.lit("http://l/"), key), "id": key, "summary": F.col("l_linestatus"),
        "tags": F.col("l_returnflag"), "source": F.concat(F.lit("src_"), F.col("l_linestatus")),
        "published": F.date_format("l_shipdate", "yyyy-MM-dd"), "load_id": F.lit(0),
        "file_path": F.lit("lineitem"), "block_start": F.lit(0),
        "entry_pos": F.col("l_orderkey") * 8 + F.col("l_linenumber"), "tag_pos": F.lit(0)}))


def _offset() -> Column:
    c = F.col("o_orderstatus")
    expr = None
    for status, off in STATUS_OFFSET.items():
        expr = F.when(c == status, F.lit(off)) if expr is None else expr.when(c == status, F.lit(off))
    return expr.otherwise(F.lit("+0000"))


def _order_fields(o: DataFrame) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    at = F.col("o_orderdate") + F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0),
                                                (F.col("o_custkey") % 24).cast("int"), F.lit(0), F.lit(0))
    cents = F.round(F.col("o_totalprice") * 100).cast("long").cast("string")
    return o.select(
        "o_orderkey", "o_orderstatus", "o_orderpriority",
        F.when(F.col("o_orderstatus") != NO_GUID_STATUS, F.concat(F.lit("http://o/"), key)).alias("guid"),
        F.concat(F.lit("Order "), key, F.lit(" & customer "), F.col("o_custkey").cast("string")).alias("title"),
        F.concat(F.lit("http://o/"), key).alias("link"),
        F.when(F.col("o_orderpriority") != NO_DESCRIPTION_PRIORITY,
               F.concat(F.lit("total <b>"), cents, F.lit("</b>"))).alias("description"),
        F.when(F.col("o_custkey") % DATE_CYCLE == BAD_DATE_CUSTOMER, F.lit(BAD_DATE_TEXT))
        .when(F.col("o_custkey") % DATE_CYCLE != NO_DATE_CUSTOMER,
              F.concat(F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" "), _offset())).alias("pubDate"),
        F.when(F.col("o_orderpriority") != NO_CATEGORY_PRIORITY,
               F.concat(F.col("o_orderpriority"), F.lit(" / "), F.col("o_orderstatus"))).alias("_cat1"),
        F.when(F.col("o_orderpriority") == SECOND_CATEGORY_PRIORITY, F.lit(SECOND_CATEGORY)).alias("_cat2"),
        "source" if "source" in o.columns else _order_source().alias("source"))


def _order_source() -> Column:
    return F.concat(F.lit("src_"), F.col("o_orderstatus"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-spread a scan (the driver's tables are single small Parquet files) before CPU-heavy per-row work."""
    return df.repartition(shuffle_partitions(df.sparkSession), key)


def rss_orders_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ``<item>`` XML text per order (column ``xml``) with its order key and source."""
    f = _order_fields(spread(table(spark, sf_dir, "orders"), "o_orderkey"))

    def el(name, col, cdata=False, attrs=""):
        body = F.concat(F.lit("<![CDATA["), col, F.lit("]]>")) if cdata else \
            F.regexp_replace(F.regexp_replace(col, "&", "&amp;"), "<", "&lt;")
        return F.when(col.isNotNull(), F.concat(F.lit(f"<{name}{attrs}>"), body, F.lit(f"</{name}>"))) \
            .otherwise(F.lit(""))

    xml = F.concat(F.lit("<item>"), el("guid", F.col("guid"), attrs=' isPermaLink="false"'),
                   el("title", F.col("title")), el("link", F.col("link")),
                   el("description", F.col("description"), cdata=True), el("pubDate", F.col("pubDate")),
                   el("category", F.col("_cat1")), el("category", F.col("_cat2")), F.lit("</item>"))
    return f.select("o_orderkey", "source", xml.alias("xml"))


def rss_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rss-orders entries parsed back from their XML text (``from_xml``), shaped like a landing
    scan: item fields plus ``source, file_path, block_start, entry_pos``."""
    x = rss_orders_xml(spark, sf_dir)
    # The parse sits in a generator: Catalyst cannot push a filter on generated columns below
    # it, so each item is parsed once, after the spread, instead of again inside pushed filters.
    return x.select(F.inline(F.array(parse_items(F.col("xml")))), "source", "o_orderkey").select(
        *[f.name for f in RSS_ITEM.fields], "source", F.lit("orders").alias("file_path"),
        F.lit(0).cast("long").alias("block_start"), F.col("o_orderkey").alias("entry_pos"))


def rss_orders_items(spark: SparkSession, sf_dir: str, where: Column | None = None, num_files: int | None = None) -> DataFrame:
    """rss-orders as item rows ready for the XML writer (``guid`` with its attribute), in
    (source, order key) order so that the written files keep that order. The orders are dealt and sorted first: the
    texts are built once, after the sample that range partitioning takes, and don't move."""
    o = table(spark, sf_dir, "orders")
    if where is not None:
        o = o.where(where)
    by = ["source", "o_orderkey"]
    ordered = o.withColumn("source", _order_source()).repartitionByRange(num_files or shuffle_partitions(spark), *by).sortWithinPartitions(*by)
    f = _order_fields(ordered)
    return f.select(
        F.when(F.col("guid").isNotNull(), F.struct(F.lit("false").alias("_isPermaLink"),
                                                   F.col("guid").alias("_VALUE"))).alias("guid"),
        "title", "link", "description", "pubDate",
        F.filter(F.array(F.col("_cat1"), F.col("_cat2")), lambda c: c.isNotNull()).alias("category"),
        "source", "o_orderkey")


def write_rss_orders_landing(spark: SparkSession, sf_dir: str, landing: str, where: Column | None = None,
                             num_files: int | None = None) -> str:
    """Write rss-orders as a landing folder ``<landing>/source=<name>/part-*.xml``. Range
    partitioning by (source, order key) keeps file order = order-key order inside a source."""
    write_feeds(rss_orders_items(spark, sf_dir, where, num_files).drop("o_orderkey"), landing)
    return landing
