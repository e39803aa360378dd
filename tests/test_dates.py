"""Feed date parsing against Python's own strptime (the behaviour the reference relies on)."""

import datetime as dt

from pyspark.sql import functions as F

from feedmart.functions.dates import (day_of_week, parse_pubdate, parse_pubdate_lenient, parse_pubdate_strict,
                                      raw_to_date)

SAMPLES = [
    "Mon, 21 Aug 2023 23:30:00 +0300", "Sun, 20 Aug 2023 23:30:00 +0300", "mon, 21 aug 2023 01:00:00 -0500",
    "MON, 21 AUG 2023 01:00:00 +03:00", "Tue, 1 Aug 2023 10:00:00 Z", "Tue, 01 Aug 2023 10:00:00 z",
    "Mon, 21 Aug 2023 10:00:00 GMT", "Mon, 21 Aug 2023 10:00:00", "Mon, 31 Apr 2023 10:00:00 +0300",
    "Mon, 29 Feb 2023 10:00:00 +0300", "Thu, 29 Feb 2024 10:00:00 +0300", "Mon,  5 Aug 2023 1:2:3 +0300",
    "Mon, 21 Aug 2023 24:00:00 +0300", "Mon, 21 Aug 2023 10:60:00 +0300", "Mon, 21 Aug 2023 10:00:60 +0300",
    "Mon, 00 Aug 2023 10:00:00 +0300", "Mon, 32 Aug 2023 10:00:00 +0300", "Mon, 21 Aug 0000 10:00:00 +0300",
    "Mon, 21 Aug 2023 10:00:00 +2400", "Mon, 21 Aug 2023 10:00:00 +2359", "Mon, 21 Aug 2023 10:00:00 +030000",
    "Mon, 21 Aug 2023 10:00:00 +03:00:00.5", "Xyz, 21 Aug 2023 10:00:00 +0300", "Monday, 21 Aug 2023 10:00:00 +0300",
    "Mon 21 Aug 2023 10:00:00 +0300", " Mon, 21 Aug 2023 10:00:00 +0300", "Mon, 21 Aug 2023 10:00:00 +0300 ",
    "Mon, 21 August 2023 10:00:00 +0300", "Mon, 21 Aug 23 10:00:00 +0300", "", "2023-08-21",
    "Mon,\t21 Aug 2023 10:00:00 +0300", "Fri, 31 Dec 1999 23:59:59 -1200",
]


def python_day(s):
    try:
        return dt.datetime.strptime(s, "%a, %d %b %Y %H:%M:%S %z").date()
    except ValueError:
        return None


def test_parse_matches_strptime(spark):
    df = spark.createDataFrame([(s,) for s in SAMPLES] + [(None,)], "p string")
    got = {r.p: r.d for r in df.select("p", parse_pubdate("p").alias("d")).collect()}
    for s in SAMPLES:
        assert got[s] == python_day(s), s
    assert got[None] is None


def test_lenient_text_and_strict_failure(spark):
    df = spark.createDataFrame([("Mon, 21 Aug 2023 10:00:00 GMT",), ("Sun, 20 Aug 2023 23:30:00 +0300",)], "p string")
    rows = dict(df.select("p", parse_pubdate_lenient("p").alias("t")).collect())
    assert rows["Mon, 21 Aug 2023 10:00:00 GMT"] == ""
    assert rows["Sun, 20 Aug 2023 23:30:00 +0300"] == "2023-08-20"
    ok = spark.createDataFrame([("Sun, 20 Aug 2023 23:30:00 +0300",)], "p string")
    assert ok.select(parse_pubdate_strict("p")).first()[0] == "2023-08-20"
    import pytest
    with pytest.raises(Exception, match="unparsable pubDate"):
        df.select(parse_pubdate_strict("p")).collect()


def test_raw_to_date_and_weekdays(spark):
    df = spark.createDataFrame([("2023-08-20",), ("",), ("2023-08-21",)], "t string")
    rows = df.select("t", raw_to_date("t").alias("d")).collect()
    assert {r.t: r.d for r in rows} == {"2023-08-20": dt.date(2023, 8, 20), "": None, "2023-08-21": dt.date(2023, 8, 21)}
    d = df.select(raw_to_date("t").alias("d")).where(F.col("d").isNotNull())
    got = {r.d: (r.c, r.i) for r in d.select("d", day_of_week("d").alias("c"), day_of_week("d", False).alias("i")).collect()}
    # 2023-08-20 is a Sunday: 0 in the reference's numbering, 7 in ISO.
    assert got[dt.date(2023, 8, 20)] == (0, 7)
    assert got[dt.date(2023, 8, 21)] == (1, 1)
