"""Feed files, RSS and Atom, as a Spark XML source.

Layout of a landing folder: ``<landing>/<source>/<file>.xml``, one folder per feed source
(``source=<name>`` folders, as a partitioned writer makes them, are accepted too). Every ``<item>``
element of an RSS file (0.9x, 1.0 or 2.0) and every ``<entry>`` of an Atom file is one entry. The scan is one distributed read over all
sources and files of a dialect; the source and the arrival-order columns come from the file metadata, not from a driver-side loop. A file's dialect is that of
its first element that tells one; finding it reads the files as plain text, which costs a small part of parsing them.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmart.functions.text import source_from_path
from feedmart.operators.ingest import NOT_A_FEED
from feedmart.schemas import ATOM_SCAN, CORRUPT, RSS_ITEM, RSS_SCAN

ENTRY_COLUMNS = [f.name for f in RSS_ITEM.fields]
XML_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


# Elements that tell a file's dialect.
RSS_ELEMENTS, ATOM_ELEMENTS = ("rss", "RDF", "channel", "item"), ("feed", "entry")
_TELLS = r"^\s*<(?:rdf:)?(" + "|".join(RSS_ELEMENTS + ATOM_ELEMENTS) + r")(?:[\s/]|$)"


def _paths(landing: str | list[str], pattern: str) -> str | list[str]:
    return landing if isinstance(landing, list) else f"{landing.rstrip('/')}/{pattern}"


def feed_dialects(spark: SparkSession, landing: str | list[str], pattern: str = "*/*", modified_after: str | None = None) -> DataFrame:
    """file_path (a URI), dialect ('rss', 'atom', or null for a file that is neither) of every file that isn't empty."""
    reader = spark.read.option("lineSep", ">")
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    tokens = reader.text(_paths(landing, pattern)).where(F.col("_metadata.file_block_start") == 0)
    told = tokens.select(F.col("_metadata.file_path").alias("file_path"), F.regexp_extract("value", _TELLS, 1).alias("tag"),
                         (F.monotonically_increasing_id() * 2).alias("at"))
    kind = F.when(F.col("tag").isin(*RSS_ELEMENTS), 0).when(F.col("tag") != "", 1)
    first = F.min(F.col("at") + kind)  # the position above the kind: a hash aggregate of numbers
    found = told.groupBy("file_path").agg(first.alias("first"))
    return found.select("file_path", F.when(F.col("first") % 2 == 0, "rss").when(F.col("first") % 2 == 1, "atom").alias("dialect"))


def read_landing(spark: SparkSession, landing: str | list[str], pattern: str = "*/*",
                 modified_after: str | None = None) -> DataFrame:
    """All entries of all feed files below ``landing`` (S1 + S2).

    ``pattern`` and ``modified_after`` (a timestamp) narrow the scan to the files a load needs; a list
    of paths is read as it is. An entry that isn't well-formed XML keeps its text in ``_corrupt_record``; a file that is neither RSS nor Atom
    gives one row with ``not_a_feed`` there.

    Columns: the RSS item fields, ``source`` (folder name), ``file_path``, ``block_start`` and
    ``entry_pos``. Ordered by (source, file_path, block_start, entry_pos) the rows follow the files'
    entry order: the position is increasing inside one split, and a split starts at block_start.
    """
    other = [(r["file_path"], r["dialect"]) for r in feed_dialects(spark, landing, pattern, modified_after)
             .where("dialect IS NULL OR dialect <> 'rss'").collect()]  # a path a file
    reader = spark.read.format("xml")
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    rss = _scan(reader, _paths(landing, pattern), RSS_SCAN, "item")
    if not other:
        return _arrival(rss)
    rss = rss.where(~F.col("_metadata.file_path").isin([f for f, _ in other]))  # files are pruned before they are read
    out = _arrival(rss)
    atom = [unquote(f) for f, d in other if d]
    if atom:
        out = out.unionByName(_arrival(_scan(spark.read.format("xml"), atom, ATOM_SCAN, "entry"), _from_atom))
    strange = [(f,) for f, d in other if not d]
    if strange:
        rows = spark.createDataFrame(strange, "file_path string").withColumn("source", source_from_path(F.col("file_path")))
        rows = rows.withColumns({"block_start": F.lit(0).cast("long"), "entry_pos": F.lit(0).cast("long"), CORRUPT: F.lit(NOT_A_FEED)})
        out = out.unionByName(rows, allowMissingColumns=True)
    return out


def _scan(reader, paths: str | list[str], schema, element: str) -> DataFrame:
    return reader.options(**XML_OPTIONS | {"rowTag": element}).schema(schema).load(paths)


def _arrival(items: DataFrame, fields=lambda df: df) -> DataFrame:
    return fields(items
                  .withColumn("file_path", F.col("_metadata.file_path"))
                  .withColumn("block_start", F.col("_metadata.file_block_start"))
                  .withColumn("entry_pos", F.monotonically_increasing_id())
                  .withColumn("source", source_from_path(F.col("file_path"))))


def _from_atom(entries: DataFrame) -> DataFrame:
    """Atom entries with the names of the RSS fields: the link is the first that leads to the entry's own page, the summary may
    be the content, categories are their terms."""
    own = F.filter("link", lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    return entries.select(F.col("id").alias("guid"), "title", F.get(own, F.lit(0))["_href"].alias("link"),
                          F.coalesce("summary", "content").alias("description"), F.col("published").alias("pubDate"),
                          F.transform("category", lambda x: x["_term"]).alias("category"), CORRUPT, "file_path", "block_start", "entry_pos", "source")


def parse_items(xml: Column) -> Column:
    """XML text of one ``<item>`` held in a column -> STRUCT of the RSS item fields (S1, column form)."""
    return F.from_xml(xml, RSS_ITEM)


def write_feeds(items: DataFrame, landing: str, mode: str = "overwrite") -> None:
    """Write entries as RSS XML, one folder per source (the landing layout read above).

    ``items`` has the RSS item columns and ``source``; ``guid`` may be a STRUCT with
    ``_isPermaLink`` and ``_VALUE`` to carry the attribute.
    """
    (items.write.mode(mode).partitionBy("source").format("xml")
     .option("rowTag", "item").option("rootTag", "channel").save(landing))
