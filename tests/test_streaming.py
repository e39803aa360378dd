"""Feed files arriving over time, loaded by the file stream with availableNow triggers."""

import os
import time

from feedmart.sources.store import Store
from feedmart.streaming import start_landing_load
from tests.feeds import LENTA, TASS


def _drop(landing, source, text):
    os.makedirs(os.path.join(landing, source), exist_ok=True)
    with open(os.path.join(landing, source, f"{source}.xml"), "w", encoding="utf-8") as f:
        f.write(text)


def test_stream_loads_new_files_once(spark, tmp_path):
    landing, root, ckpt = str(tmp_path / "landing"), str(tmp_path / "store"), str(tmp_path / "ckpt")
    _drop(landing, "lenta_ru", LENTA)
    start_landing_load(spark, landing, root, ckpt, as_of="2023-08-22").awaitTermination()
    s = Store(spark, root)
    assert s.read("raw_store", "news").count() == 5
    assert s.read("core_store", "news").count() == 3
    _drop(landing, "tass_ru", TASS)
    start_landing_load(spark, landing, root, ckpt, as_of="2023-08-22").awaitTermination()
    raw = s.read("raw_store", "news")
    assert raw.count() == 8
    assert sorted(r.load_id for r in raw.select("load_id").distinct().collect()) == [1, 2]
    assert s.read("core_store", "news").count() == 4
    # a restart with nothing new leaves everything as it is
    start_landing_load(spark, landing, root, ckpt, as_of="2023-08-22").awaitTermination()
    assert s.read("raw_store", "news").count() == 8
    mart = {(r.category, r.source): r for r in spark.read.parquet(s.path("mart_store", "news")).collect()}
    assert mart[("Economy", "tass_ru")].source_count_category_news_today == 1


def test_feed_fetched_again_under_the_same_name_is_loaded(spark, tmp_path):
    landing, root, ckpt = str(tmp_path / "landing"), str(tmp_path / "store"), str(tmp_path / "ckpt")
    _drop(landing, "lenta ru%", LENTA)
    start_landing_load(spark, landing, root, ckpt, as_of=lambda: "2023-08-22").awaitTermination()
    s = Store(spark, root)
    assert {r.source for r in s.read("raw_store", "news").collect()} == {"lenta ru%"}
    path = os.path.join(landing, "lenta ru%", "lenta ru%.xml")
    _drop(landing, "lenta ru%", LENTA.replace("http://a/2", "http://a/22"))
    os.utime(path, (os.path.getmtime(path) + 5,) * 2)
    start_landing_load(spark, landing, root, ckpt, as_of="2023-08-22").awaitTermination()
    assert {r.new_raw_id for r in s.read("core_store", "news").collect()} == {"http://a/1", "http://a/2", "http://a/22", "http://a/3"}
    assert s.read("raw_store", "news").count() == 10
    start_landing_load(spark, landing, root, ckpt, as_of="2023-08-22").awaitTermination()
    assert s.read("raw_store", "news").count() == 10


def test_stream_maps_categories_and_shares_a_store_with_batch_loads(spark, tmp_path):
    from feedmart.plans import full_load
    landing, root = str(tmp_path / "landing"), str(tmp_path / "store")
    _drop(landing, "lenta_ru", LENTA)
    full_load(spark, landing, root, as_of="2023-08-22")
    mapping = spark.createDataFrame([("sport", "SPORTS")], "key string, canonical string")
    _drop(landing, "tass_ru", TASS.replace("Politics", "Sport"))
    start_landing_load(spark, landing, root, str(tmp_path / "ckpt"), as_of="2023-08-22", mapping=mapping).awaitTermination()
    s = Store(spark, root)
    assert s.read("raw_store", "news").count() == 5 + 8
    assert "SPORTS" in {r.tag_name for r in s.read("core_store", "tags").collect()}
    assert "SPORTS" not in {r.tags for r in s.read("raw_store", "news").collect()}


def test_a_running_stream_picks_up_an_overwritten_feed_once(spark, tmp_path):
    """No new file appears, so no micro-batch starts; the file that was fetched again is loaded all the same, and only once."""
    landing, root, ckpt = str(tmp_path / "landing"), str(tmp_path / "store"), str(tmp_path / "ckpt")
    _drop(landing, "lenta_ru", LENTA)
    query = start_landing_load(spark, landing, root, ckpt, as_of="2023-08-22", available_now=False, processing_time="1 second")
    try:
        def wait(ready):
            until = time.time() + 120
            while not ready():
                assert query.isActive and time.time() < until
                time.sleep(0.5)
        loads = lambda: Store(spark, root).ledger.state()["loads"]
        wait(lambda: [x["open"] for x in loads().values()] == [None] and os.path.exists(f"{root}/_stream_files/_SUCCESS"))
        path = os.path.join(landing, "lenta_ru", "lenta_ru.xml")
        _drop(landing, "lenta_ru", LENTA.replace("http://a/2", "http://a/22"))
        os.utime(path, (os.path.getmtime(path) + 5,) * 2)
        wait(lambda: [x["open"] for x in loads().values()] == [None, None])
        time.sleep(4)  # several intervals more
    finally:
        query.stop()
    s = Store(spark, root)
    assert len(loads()) == 2 and s.read("raw_store", "news").count() == 10
    assert {r.new_raw_id for r in s.read("core_store", "news").collect()} == {"http://a/1", "http://a/2", "http://a/22", "http://a/3"}


ATOM = """<?xml version="1.0" encoding="utf-8"?>
<feed xmlns="http://www.w3.org/2005/Atom"><title>atom</title><id>urn:feed</id><link rel="self" href="http://x/self"/>
<entry><id>urn:1</id><title type="html">First &amp; best</title><link rel="enclosure" href="http://x/e"/><link href="http://x/1"/>
  <published>2023-08-21T23:30:00+03:00</published><summary>short</summary><category term="Economy / World"/><category term="Sport"/></entry>
<entry><id>urn:2</id><title>Second</title><link rel="alternate" href="http://x/2"/><published>Mon, 21 Aug 2023 01:00:00 +0300</published>
  <content>long</content><category term="Sport" label="s"/></entry>
<entry><id>urn:3</id><title>no category</title><published>2023-08-21T00:00:00Z</published></entry>
</feed>
"""


def test_both_dialects_in_one_landing_folder(spark, tmp_path):
    from feedmart.plans import full_load
    from feedmart.sources.rss import feed_dialects, read_landing
    landing = str(tmp_path / "landing")
    _drop(landing, "lenta_ru", LENTA)
    _drop(landing, "a+b %20c", ATOM)
    _drop(landing, "broken", "<html><body>502 Bad Gateway <item>?</body></html>".replace("<item>", ""))
    _drop(landing, "none", "")
    _drop(landing, "quiet", '<rss version="2.0"><channel><title>nothing new</title></channel></rss>')
    _drop(landing, "rdf", '<rdf:RDF><channel/><item rdf:about="u"><guid>r1</guid><category>Sport</category></item></rdf:RDF>')
    kinds = {r.file_path.rsplit("/", 1)[1]: r.dialect for r in feed_dialects(spark, landing).collect()}
    assert kinds == {"lenta_ru.xml": "rss", "a+b%20%2520c.xml": "atom", "broken.xml": None, "quiet.xml": "rss", "rdf.xml": "rss"}
    rows = {r.guid: r for r in read_landing(spark, landing).collect()}
    assert set(rows) == {"http://a/1", "http://a/2", "http://a/3", "http://a/4", "urn:1", "urn:2", "urn:3", "r1", None}
    first, second = rows["urn:1"], rows["urn:2"]
    assert (first.title, first.link, first.description, first.category, first.source) == (
        "First & best", "http://x/1", "short", ["Economy / World", "Sport"], "a+b %20c")
    assert (second.link, second.description, second.pubDate) == ("http://x/2", "long", "Mon, 21 Aug 2023 01:00:00 +0300")
    for compat, dated in ((True, None), (False, "2023-08-21")):
        root = str(tmp_path / f"store{compat}")
        full_load(spark, landing, root, as_of="2023-08-22", compat=compat)
        s = Store(spark, root)
        assert sorted((r.reason, r.source) for r in s.read("raw_store", "rejects").collect()) == [
            ("no_category", "a+b %20c"), ("no_category", "lenta_ru"), ("not_a_feed", "broken")]
        news = {r.new_raw_id: r for r in s.read("core_store", "news").collect()}
        assert set(news) == {"http://a/1", "http://a/2", "http://a/3", "urn:1", "urn:2", "r1"}
        assert str(news["urn:1"].new_published) == str(dated) and str(news["urn:2"].new_published) == "2023-08-21"
    # the same files through the stream
    root = str(tmp_path / "streamed")
    start_landing_load(spark, landing, root, str(tmp_path / "ckpt"), as_of="2023-08-22", compat=False).awaitTermination()
    assert Store(spark, root).read("raw_store", "news").count() == s.read("raw_store", "news").count()
    assert Store(spark, root).read("raw_store", "rejects").count() == 3
