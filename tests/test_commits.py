"""Loads that break off at any write, runs and versions that become current as a whole, and changes between the two modes."""

import json

import pytest
from pyspark.sql import functions as F

from feedmart.operators.quality import check_store
from feedmart.plans import delta_load, full_load, load
from feedmart.plans.load import build_mart, fill_pairs, repair
from feedmart.session import create_file
from feedmart.sources.ledger import Ledger
from feedmart.sources.rss import read_landing
from feedmart.sources.store import Store
from tests.feeds import write_landing

AS_OF = "2023-08-22"


def _item(guid, *categories, day=21):
    tags = "".join(f"<category>{c}</category>" for c in categories)
    return f"<item><guid>{guid}</guid><title>t {guid}</title><pubDate>Mon, {day} Aug 2023 01:00:00 +0300</pubDate>{tags}</item>"


def _feed(*items):
    return f"<rss><channel>{''.join(items)}</channel></rss>"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _violations(store):
    return {(r.check, r.table, r.columns): r.violations for r in check_store(store).collect() if r.violations}


class Lost(Exception):
    pass


class Breaker:
    """Raises Lost after the n-th write (of data or of a log entry), or before it."""

    def __init__(self, monkeypatch, stop, before=False):
        self.calls, self.stop, self.before = 0, stop, before
        for cls, names in ((Store, ("append", "append_entries", "append_log", "overwrite")), (Ledger, ("note",))):
            for name in names:
                monkeypatch.setattr(cls, name, self._wrap(getattr(cls, name), name))

    def _wrap(self, f, name):
        def call(*args, **kwargs):
            self.calls += 1
            mine = self.calls
            if mine == self.stop and self.before:
                raise Lost(name)
            out = f(*args, **kwargs)
            if mine == self.stop:
                raise Lost(name)
            return out
        return call


def _check(spark, store, compat):
    assert store.open_loads() == [] and _violations(store) == {}
    ids = [r.new_id for r in store.read("core_store", "news").collect()]
    assert len(ids) == len(set(ids)) and store.last_new_id() == max(ids)
    final = _rows(spark.read.parquet(store.path("mart_store", "news")))
    assert final == _rows(build_mart(store, AS_OF, compat, from_log=False)) and len(final) > 4
    if not compat:  # every pair, also those that an item got when it was seen again
        assert store.read("core_store", "news_tag_pairs").count() == store.read("raw_store", "news").select("id", "tags").distinct().count()


def _killed(spark, tmp_path, root, point, compat, before):
    """A load that is killed at its ``point``-th write: news of its own, and one that an earlier load brought."""
    items = [_item(f"n{point}", "A", f"C{point % 3}"), _item(f"m{point}", f"D{point}", "A", day=20), _item("first", f"E{point}", "A")]
    landing = write_landing(tmp_path / f"l{point}", {f"s{point % 2}": _feed(*items)})
    with pytest.MonkeyPatch.context() as patch:
        breaker = Breaker(patch, point, before)
        try:
            full_load(spark, landing, root, as_of=AS_OF, compat=compat, store=Store(spark, root))
        except Lost as e:
            return str(e)
        assert breaker.calls < point
        return None


@pytest.mark.parametrize("compat, points", [(False, range(1, 30)), (True, (5, 8, 11, 12))])
def test_a_load_killed_at_any_write_is_repaired(spark, tmp_path, compat, points):
    """An unnamed load is killed before or after (by turns) its first write, then another at its second and so on, each repaired before the next.
    Nothing that raw holds is missing in core, and the log agrees with core."""
    root, kept, stopped = str(tmp_path / "store"), 0, []
    full_load(spark, write_landing(tmp_path / "first", {"s": _feed(_item("first", "A"))}), root, as_of=AS_OF, compat=compat)
    for point in points:
        stopped.append(_killed(spark, tmp_path, root, point, compat, before=point % 2 == 0))
        if stopped[-1] is None:
            break
        repair(Store(spark, root))
        held = {r.id for r in Store(spark, root).read("raw_store", "news").collect()}
        kept += f"m{point}" in held
        assert sorted(r.new_raw_id for r in Store(spark, root).read("core_store", "news").collect()) == sorted(held)
    full_load(spark, write_landing(tmp_path / "last", {"o": _feed(_item("last", "A", "O"))}), root, as_of=AS_OF, compat=compat)
    _check(spark, Store(spark, root), compat)
    assert kept >= len(stopped) - 4
    if not compat:
        assert stopped[-1] is None and set(stopped[:-1]) == {"append", "append_entries", "append_log", "overwrite", "note"}


def test_a_repair_that_is_killed_is_repaired(spark, tmp_path):
    """A load dies between its news and their day counts, and each of the repairs after it dies one write later."""
    root = str(tmp_path / "store")
    full_load(spark, write_landing(tmp_path / "a", {"s": _feed(*[_item(f"a{i}", "A", f"C{i % 3}") for i in range(4)])}), root, as_of=AS_OF, compat=False)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Store, "append_pairs", lambda *a: (_ for _ in ()).throw(Lost()))
        with pytest.raises(Lost):
            full_load(spark, write_landing(tmp_path / "b", {"s": _feed(_item("b1", "A", "B"), _item("a1", "Z"))}), root, as_of=AS_OF, compat=False)
    point = 0
    while Store(spark, root).open_loads():
        point += 1
        with pytest.MonkeyPatch.context() as patch:
            Breaker(patch, 1 + point, before=point % 2 == 0)
            try:
                repair(Store(spark, root))
            except Lost:
                pass
        assert point < 20
    build_mart(Store(spark, root), AS_OF, compat=False)
    _check(spark, Store(spark, root), False)
    assert point > 3 and Store(spark, root).read("core_store", "news").count() == 5


@pytest.mark.parametrize("failing", ["append_entries", "news"])
def test_a_rerun_that_fails_keeps_or_completes(spark, tmp_path, monkeypatch, failing):
    """A re-run that fails before its raw rows are complete leaves the old ones; one that fails later is completed by the next load."""
    root = str(tmp_path / "store")
    old = write_landing(tmp_path / "a", {"s": _feed(_item("a1", "A"), _item("a2", "B"))})
    new = write_landing(tmp_path / "b", {"s": _feed(_item("b1", "A"))})
    full_load(spark, old, root, as_of=AS_OF, name="day")
    reader = Store(spark, root).read("raw_store", "news")
    store = Store(spark, root)
    if failing == "append_entries":
        entries = read_landing(spark, new).withColumn("guid", F.coalesce(F.lit(None).cast("string"), F.raise_error(F.lit("unreadable")).cast("string")))
        with pytest.raises(Exception, match="unreadable"):
            load.load_entries(store, entries, "full", AS_OF, name="day")
        assert sorted(r.id for r in Store(spark, root).read("raw_store", "news").collect()) == ["a1", "a2"]
    else:
        monkeypatch.setattr(Store, "append_news", lambda *a: (_ for _ in ()).throw(Lost()))
        with pytest.raises(Lost):
            full_load(spark, new, root, as_of=AS_OF, name="day", store=store)
        monkeypatch.undo()
        assert sorted(r.id for r in Store(spark, root).read("raw_store", "news").collect()) == ["b1"]
    assert sorted(r.id for r in reader.collect()) == ["a1", "a2"]  # opened before: still there
    delta_load(spark, write_landing(tmp_path / "c", {"s": _feed(_item("c1", "A"))}), root, as_of=AS_OF)
    store = Store(spark, root)
    core = sorted(r.new_raw_id for r in store.read("core_store", "news").collect())
    assert core == (["a1", "a2", "c1"] if failing == "append_entries" else ["a1", "a2", "b1", "c1"])
    assert _violations(store) == {} and store.open_loads() == []
    assert _rows(build_mart(store, AS_OF)) == _rows(build_mart(store, AS_OF, from_log=False))


def test_a_query_on_the_mart_outlives_its_rebuild(spark, tmp_path):
    root = str(tmp_path / "store")
    store = Store(spark, root).register()
    first = full_load(spark, write_landing(tmp_path / "a", {"s": _feed(_item("a1", "A"))}), root, as_of=AS_OF, store=store)
    published = spark.table("mart_store.news")
    full_load(spark, write_landing(tmp_path / "b", {"s": _feed(_item("b1", "B"))}), root, as_of=AS_OF, store=store)
    assert len(first.collect()) == 1 == published.count()
    assert spark.table("mart_store.news").count() == 2 == Store(spark, root).read("mart_store", "news").count()
    with pytest.MonkeyPatch.context() as patch:  # a build that fails while it writes leaves the version before it
        patch.setattr(load, "mart_from_days", lambda *a, **k: spark.range(1).select(F.raise_error(F.lit("lost")).alias("x")))
        with pytest.raises(Exception, match="lost"):
            build_mart(store, AS_OF)
    assert spark.table("mart_store.news").count() == 2
    build_mart(store, "2023-08-21", compat=True)
    assert spark.table("mart_store.news").count() == 2


def test_a_replay_applies_the_mapping_of_its_load(spark, tmp_path):
    root = str(tmp_path / "store")
    mapping = spark.createDataFrame([("a", "Alpha")], "key string, canonical string")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Store, "append_news", lambda *a: (_ for _ in ()).throw(Lost()))
        with pytest.raises(Lost):
            full_load(spark, write_landing(tmp_path / "a", {"s": _feed(_item("a1", "A"))}), root, as_of=AS_OF, mapping=mapping)
    mart = full_load(spark, write_landing(tmp_path / "b", {"s": _feed(_item("b1", "A"))}), root, as_of=AS_OF)
    assert sorted((r.category, r.source_count_category_news) for r in mart.collect()) == [("A", 1), ("Alpha", 1)]


FIRST = {"s": _feed(_item("a1", "A", "B"), _item("a2", "B", day=20), "<item><title>no id</title><category>A</category></item>"), "t": _feed(_item("a1", "C"))}
SECOND = {"s": _feed(_item("b1", "B", "A"), _item("a2", "Z")), "t": _feed(_item("b2", "C"))}


@pytest.mark.parametrize("killed", [None, "append_pairs", "append_log"])
def test_corrected_after_compat_equals_corrected_from_the_start(spark, tmp_path, killed):
    first, second = write_landing(tmp_path / "a", FIRST), write_landing(tmp_path / "b", SECOND)
    roots = [str(tmp_path / n) for n in ("mixed", "fresh")]
    for root, compat in zip(roots, (True, False)):
        full_load(spark, first, root, as_of=AS_OF, compat=compat)
    if killed:
        real = getattr(Ledger if killed == "note" else Store, killed)

        def broken(self, *args, **kwargs):
            real(self, *args, **kwargs)
            raise Lost()
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(Ledger if killed == "note" else Store, killed, broken)
            with pytest.raises(Lost):
                fill_pairs(Store(spark, roots[0]))
    marts = [_rows(full_load(spark, second, root, as_of=AS_OF, compat=False)) for root in roots]
    assert marts[0] == marts[1] and len(marts[0]) > 4
    store = Store(spark, roots[0])
    assert _rows(build_mart(store, AS_OF, compat=False, from_log=False)) == marts[0]
    assert _violations(store) == {}
    assert fill_pairs(store) == []


def test_compat_after_refused_entries_is_an_error(spark, tmp_path):
    root = str(tmp_path / "store")
    full_load(spark, write_landing(tmp_path / "a", FIRST), root, as_of=AS_OF, compat=False)
    with pytest.raises(ValueError, match="refused entries without id"):
        full_load(spark, write_landing(tmp_path / "b", SECOND), root, as_of=AS_OF)
    clean = str(tmp_path / "clean")
    for compat in (False, True):
        full_load(spark, write_landing(tmp_path / "b", SECOND), clean, as_of=AS_OF, compat=compat)
    assert _rows(build_mart(Store(spark, clean), AS_OF)) == _rows(build_mart(Store(spark, clean), AS_OF, from_log=False))


def test_history_is_read_for_known_ids_only(spark, tmp_path):
    """A load reads the hashes of all ids, and of the news only the loads that hold one of its ids."""
    root = str(tmp_path / "store")
    for i in range(4):
        full_load(spark, write_landing(tmp_path / f"l{i}", {"s": _feed(*[_item(f"{i}-{k}", "A") for k in range(5)])}), root, as_of=AS_OF)
    store = Store(spark, root)
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    assert store.seen_loads(ids("2-0", "2-3", "new", "0-1", None)) == [1, 3]
    assert store.seen_loads(ids("new")) == [] and store.history("news", []).count() == 0
    assert {r.load_id for r in store.history("news", [1, 3]).collect()} == {1, 3}
    plan = store.history("news", [3]).select("new_raw_id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "load_id" in plan.split("PushedFilters")[1]
    keys = ids("2-0").select(F.xxhash64("id").alias("h")).repartition(store.buckets(), "h").join(store.read("core_store", "news_keys"), "h")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = keys.select("load_id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan and "ReadSchema: struct<h:bigint,load_id:bigint>" in plan


def test_history_bytes_of_a_days_load(spark, tmp_path):
    """Bytes that a day's lookup reads of a history of long ids: far fewer than the ids' own."""
    import os
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    ids = spark.range(40_000).select(F.concat(F.lit("https://news.example/"), F.sha2(F.col("id").cast("string"), 256)).alias("new_raw_id"),
                                     F.col("id").alias("new_id"), (F.col("id") % 8 + 1).alias("load_id"))
    rows = ids
    for f in store.schema("core_store", "news").fields:
        rows = rows if f.name in rows.columns else rows.withColumn(f.name, F.lit(None).cast(f.dataType))
    for load_id in range(1, 9):
        store.append_news(rows.where(F.col("load_id") == load_id))
    size = lambda t: sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(store.path("core_store", t)) for f in fs if f.endswith(".parquet"))
    assert size("news_keys") < 0.25 * size("news")
    day = ids.where("load_id = 8").limit(50).select(F.col("new_raw_id").alias("id"))
    assert store.seen_loads(day) == [8]
    files = store.rebucket(3).history("news", [8])
    assert files.count() == 5000 and store.seen_loads(day) == [8]


def test_log_entries_are_whole_and_numbers_are_taken_once(spark, tmp_path, monkeypatch):
    from feedmart.sources import ledger
    monkeypatch.setattr(ledger, "SNAPSHOT_EVERY", 5)
    a, b = (Ledger(spark, str(tmp_path / "log")) for _ in range(2))
    for i in range(12):
        a.note("table", table=f"t{i % 3}", version=i)
    assert b.state()["tables"]["t2"] == {"version": 11} and b.state()["seq"] == 12 == Ledger(spark, a.path).state()["seq"]
    assert len([n for n in (tmp_path / "log").iterdir() if n.name.endswith(".json") and ".state" not in n.name]) < 12
    with pytest.raises(Exception):
        a.note("table", at=12, table="t", version=1)
    assert not [n for n in (tmp_path / "log").iterdir() if n.name.endswith(".part")]
    (tmp_path / "log" / f"{13:012d}.json.x.part").write_text("{")  # a writer that died while it wrote
    assert b.state()["seq"] == 12 and b.note("table", table="z", version=1) == 13
    path = str(tmp_path / "one")
    create_file(spark, path, json.dumps({"x": "ü"}))
    with pytest.raises(Exception):
        create_file(spark, path, "{}")
    assert json.loads((tmp_path / "one").read_text()) == {"x": "ü"}


def test_repair_without_open_loads_does_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    assert repair(store) == [] and store.open_loads() == []
