"""Dates of feed entries.

An RSS ``pubDate`` looks like ``Mon, 21 Aug 2023 23:30:00 +0300``. Spark's datetime patterns
cannot parse a day name, so the text is matched by one regular expression that accepts what the
reference's ``'%a, %d %b %Y %H:%M:%S %z'`` accepts, and the date is rebuilt from the captured
year, month and day. The day is the one written in the text (the feed's own offset), never a
conversion through a timestamp.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted shape of an RSS date: abbreviated English day name (not checked
# against the date), day 1-31 with an optional leading zero, abbreviated English month name,
# four-digit year other than 0000, time of day, and an offset that is `Z` or +/-HH[:]MM with
# optional seconds; names match in any letter case, `Z` only upper case, `GMT` and other zone
# names are refused.
RFC822_DATE = (
    r"(?i)(mon|tue|wed|thu|fri|sat|sun),\s+"
    r"(3[01]|[12][0-9]|0[1-9]|[1-9])\s+"
    r"(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)\s+"
    r"((?!0000)[0-9]{4})\s+"
    r"(?:2[0-3]|[01][0-9]|[0-9]):(?:[0-5][0-9]|[0-9]):(?:[0-5][0-9]|[0-9])\s+"
    r"(?:(?-i:Z)|[+-](?:[01][0-9]|2[0-3])"
    r"(?::[0-5][0-9](?::[0-5][0-9](?:\.[0-9]{1,6})?)?|[0-5][0-9](?:[0-5][0-9](?:\.[0-9]{1,6})?)?))$"
)
# The text is prefixed with a control character and matched as a whole after it: a match is
# rewritten to "yyyy MMM d", anything else keeps the prefix and so can never read as a date.
# One regex evaluation, one reference to the input column.
_PREFIX = "\u0002"
_REWRITE = "^" + _PREFIX + RFC822_DATE


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# Fixed value: an Atom date (RFC 3339): day, time with optional fraction, `Z` or an offset.
RFC3339_DATE = r"^([0-9]{4}-[0-9]{2}-[0-9]{2})[Tt ][0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]+)?(?:[Zz]|[+-][0-9]{2}:[0-9]{2})$"


def parse_pubdate(col, atom: bool = False) -> Column:
    """RSS date text -> DATE; NULL when the text does not parse or names no real day. ``atom``: dates as Atom feeds write them count too."""
    rewritten = F.regexp_replace(F.concat(F.lit(_PREFIX), _c(col)), _REWRITE, "$4 $3 $2")
    day = F.try_to_date(rewritten, "yyyy MMM d")
    return F.coalesce(day, F.try_to_date(F.regexp_extract(_c(col), RFC3339_DATE, 1), "yyyy-MM-dd")) if atom else day


def parse_pubdate_lenient(col, atom: bool = False) -> Column:
    """Full load: 'yyyy-MM-dd' text, or '' when the date does not parse (raw keeps text)."""
    return F.coalesce(F.date_format(parse_pubdate(col, atom), "yyyy-MM-dd"), F.lit(""))


def parse_pubdate_strict(col) -> Column:
    """Delta load: 'yyyy-MM-dd' text; the job fails on the first date that does not parse."""
    d = parse_pubdate(col)
    return F.when(d.isNull(), F.raise_error(F.concat(F.lit("unparsable pubDate: "), F.coalesce(_c(col), F.lit("NULL"))))) \
        .otherwise(F.date_format(d, "yyyy-MM-dd"))


def raw_to_date(col) -> Column:
    """Raw text date -> DATE. '' and bad text give NULL (the reference's database would give
    0001-01-01 BC; this is the one intended divergence)."""
    return F.try_to_date(_c(col), "yyyy-MM-dd")


def day_of_week(col, compat: bool = True) -> Column:
    """compat: the reference's numbering, 0 = Sunday .. 6 = Saturday, later tested against 1..7
    so that Sunday is never counted. Otherwise ISO: 1 = Monday .. 7 = Sunday."""
    c = _c(col)
    return (F.dayofweek(c) - 1) if compat else (F.weekday(c) + 1)


def as_of_date(as_of) -> Column:
    """The day that counts as "today": a DATE column/literal, default the session's current date."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        return F.lit(as_of.strftime("%Y-%m-%d")).cast("date")
    return F.lit(str(as_of)).cast("date")


def previous_day(as_of) -> Column:
    return F.date_sub(as_of_date(as_of), 1)
