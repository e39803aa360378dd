"""Feed entries -> raw rows (the reference's per-entry Python loop, as one DataFrame plan).

Per entry: default '' for missing title/link/id/summary (P2), the source (P3), the published day
as text (P4 lenient in a full load, P5 strict in a delta load), the delta filter on yesterday (F1,
applied before the explode), then one raw row per category piece (P1). Entries that the reference
would fail on, or that ``compat=False`` refuses, go to rejects (C3) with a reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmart.functions.dates import parse_pubdate, parse_pubdate_lenient, previous_day
from feedmart.functions.text import default_fill, split_categories
from feedmart.schemas import ACCEPTED, CORRUPT, ENTRIES, RAW, REJECT, REJECTED

# Reasons recorded for rejected entries.
NO_CATEGORY = "no_category"
NO_GUID = "no_guid"
BAD_DATE = "bad_date"
MALFORMED = "malformed"
NOT_A_FEED = "not_a_feed"  # a file that is neither RSS nor Atom
OUT_OF_WINDOW = "out_of_window"  # not a reject: a delta load takes one day only


def with_defaults(entries: DataFrame) -> DataFrame:
    """``title, link, id, summary`` with '' for a missing element (``id`` is the guid)."""
    return (entries
            .withColumn("title", default_fill("title"))
            .withColumn("link", default_fill("link"))
            .withColumn("id", default_fill("guid"))
            .withColumn("summary", default_fill("description")))


def classify(entries: DataFrame, mode: str = "full", as_of=None, compat: bool = True,
             on_bad_date: str = "reject") -> DataFrame:
    """Add ``published`` (text) and ``reason``: NULL when the entry is accepted, ``OUT_OF_WINDOW``
    when a delta load skips it, otherwise why it is rejected. Downstream filters test the one
    ``reason`` column, so the parse is inlined once when Catalyst pushes the filter down.

    mode="full": every entry, date parsed leniently ('' when bad).
    mode="delta": only entries published on the day before ``as_of``; a bad date is a reject, or
    fails the job when ``on_bad_date="fail"`` (the reference's behaviour).
    Dates as Atom feeds write them are bad dates under ``compat``, as in the reference.
    """
    e = with_defaults(entries)
    no_cat = F.coalesce(F.size("category") <= 0, F.lit(True))
    if mode == "full":
        e = e.withColumn("published", parse_pubdate_lenient(F.col("pubDate"), not compat))
        reason = F.when(no_cat, F.lit(NO_CATEGORY))
    elif mode == "delta":
        e = e.withColumn("published", F.coalesce(F.date_format(parse_pubdate(F.col("pubDate"), not compat), "yyyy-MM-dd"),
                                                 F.lit("")))
        bad = F.lit(BAD_DATE) if on_bad_date != "fail" else F.raise_error(
            F.concat(F.lit("unparsable pubDate: "), F.coalesce(F.col("pubDate"), F.lit("NULL"))))
        wanted = F.date_format(previous_day(as_of), "yyyy-MM-dd")
        reason = (F.when(F.col("published") == "", bad)
                  .when(F.col("published") != wanted, F.lit(OUT_OF_WINDOW))
                  .when(no_cat, F.lit(NO_CATEGORY)))
    else:
        raise ValueError(f"mode must be 'full' or 'delta', not {mode!r}")
    if not compat:
        reason = reason.when(F.col("id") == "", F.lit(NO_GUID))
    if CORRUPT in entries.columns:
        reason = F.when(F.col(CORRUPT) == NOT_A_FEED, F.lit(NOT_A_FEED)).when(F.col(CORRUPT).isNotNull(), F.lit(MALFORMED)).otherwise(reason)
    else:
        e = e.withColumn(CORRUPT, F.lit(None).cast("string"))
    return e.withColumn("reason", reason)


def explode_categories(entries: DataFrame) -> DataFrame:
    """One row per category piece, with its position inside the entry (``tag_pos``)."""
    return (entries.select("*", F.posexplode(split_categories("category")).alias("tag_pos", "tags"))
            .withColumn("tag_pos", F.col("tag_pos").cast("int")))


def to_raw(classified: DataFrame, load_id: int) -> DataFrame:
    """Accepted entries of this load -> raw rows in the raw schema."""
    kept = classified.where(F.col("reason").isNull())
    rows = explode_categories(kept).withColumn("load_id", F.lit(load_id).cast("long"))
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in RAW.fields])


def rejects(classified: DataFrame, load_id: int) -> DataFrame:
    """Entries of this load that were refused, with the reason (and the text of malformed ones)."""
    bad = classified.where(F.col("reason").isNotNull() & (F.col("reason") != OUT_OF_WINDOW))
    bad = bad.withColumn("load_id", F.lit(load_id).cast("long")).withColumn("raw_text", F.col(CORRUPT))
    return bad.select(*REJECT.fieldNames())


def to_entries(classified: DataFrame, load_id: int) -> DataFrame:
    """Raw rows and rejects of one load in one pass: an accepted entry gives a row per category piece, a
    rejected one a single row."""
    kept = classified.where(F.col("reason").isNull() | (F.col("reason") != OUT_OF_WINDOW))
    pieces = F.when(F.col("reason").isNull(), split_categories("category")).otherwise(F.array(F.lit(None).cast("string")))
    rows = (kept.select("*", F.posexplode(pieces).alias("tag_pos", "tags"))
            .withColumn("load_id", F.lit(load_id)).withColumn("raw_text", F.col(CORRUPT))
            .withColumn("status", F.when(F.col("reason").isNull(), ACCEPTED).otherwise(REJECTED)))
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in ENTRIES.fields])
