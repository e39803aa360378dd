"""Table checks for the keys the reference declares in its DDL (C1, C2). Parquet tables do not
enforce keys, so these run as jobs: an aggregate and an anti join, both distributed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmart.session import materialise


def check_unique(df: DataFrame, keys: Sequence[str], primary: bool = True) -> DataFrame:
    """Key values held by more than one row (and, for a primary key, NULL keys).
    Output: the key columns and ``n_rows``; empty when the key holds."""
    keys = list(keys)
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    bad = F.col("n_rows") > 1
    if primary:
        for k in keys:
            bad = bad | F.col(k).isNull()
    return counted.where(bad)


def check_foreign_keys(child: DataFrame, parent: DataFrame, fk: Sequence[str] | str,
                       pk: Sequence[str] | str | None = None) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent row."""
    fk = [fk] if isinstance(fk, str) else list(fk)
    pk = fk if pk is None else ([pk] if isinstance(pk, str) else list(pk))
    parents = parent.select(*[F.col(p).alias(f) for p, f in zip(pk, fk)])
    present = child
    for f in fk:
        present = present.where(F.col(f).isNotNull())
    return present.join(parents, on=fk, how="left_anti")


# Keys the reference's DDL declares, on the stored layout: (table, columns, primary?). The six
# one-attribute tables keyed by new_id are columns of core news, so their keys are news's key.
DECLARED_KEYS = [
    ("core_store.sources", ["source_id"], True), ("core_store.sources", ["source_name"], False),
    ("core_store.tags", ["tag_id"], True), ("core_store.tags", ["tag_name"], False),
    ("core_store.news", ["new_id"], True), ("core_store.news", ["new_raw_id"], False),
    ("core_store.news_tag_pairs", ["new_id", "tag_id"], True),
    ("mart_store.news", ["id"], True),
]
# (child table, child column, parent table, parent column)
DECLARED_FOREIGN_KEYS = [
    ("core_store.news", "source_id", "core_store.sources", "source_id"),
    ("core_store.news", "tag_id", "core_store.tags", "tag_id"),
    ("core_store.news_tag_pairs", "new_id", "core_store.news", "new_id"),
    ("core_store.news_tag_pairs", "tag_id", "core_store.tags", "tag_id"),
]


def check_store(store, since: int | None = None, mark: bool = False) -> DataFrame:
    """C1 + C2 over a whole store: one row per declared key with the number of violating key
    values (duplicates, or NULL in a primary key) or orphan rows. All checks are aggregates and
    anti joins; the report is one row per check.

    ``since``: only what the loads after that one have added is checked (``check_since``). ``mark``: where nothing is found, the
    commit log keeps the last load as checked (``verified_load``)."""
    report = _whole_report(store) if since is None else check_since(store, since)
    if mark:
        loads = [int(i) for i in store.ledger.state()["loads"]]
        report = materialise(report, "check-report")
        if loads and report.where("violations > 0").isEmpty():
            store.ledger.note("table", table="verified", upto=max(loads))
    return report


def verified_load(store) -> int:
    """The last load up to which a marked check found nothing (0 without one)."""
    return store.ledger.state()["tables"].get("verified", {}).get("upto", 0)


def _whole_report(store) -> DataFrame:
    def table(name):
        layer, t = name.split(".")
        return store.read(layer, t)

    parts = []
    for name, cols, primary in DECLARED_KEYS:
        bad = check_unique(table(name), cols, primary)
        parts.append(bad.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit("primary key" if primary else "unique").alias("check"), F.lit(name).alias("table"),
            F.lit(", ".join(cols)).alias("columns"), "violations"))
    for child, fk, parent, pk in DECLARED_FOREIGN_KEYS:
        bad = check_foreign_keys(table(child), table(parent), fk, pk)
        parts.append(bad.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit("foreign key").alias("check"), F.lit(child).alias("table"),
            F.lit(f"{fk} -> {parent}.{pk}").alias("columns"), "violations"))
    for log in ("news_days", "pair_days"):
        parts.append(check_day_log(store, log).agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit("derived").alias("check"), F.lit(f"mart_store.{log}").alias("table"),
            F.lit("sum(n) per category, source, day = core").alias("columns"), "violations"))
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def check_since(store, since: int) -> DataFrame:
    """The checks of ``check_store`` for the rows that loads after ``since`` have added, without a scan of older ones.

    New keys are looked up in the index of key hashes; only older loads that hold one of them are read (none, where the keys hold).
    ``new_id`` only grows, so a new row whose id isn't above the last one of the older loads is a second use of that id. Pairs of new rows are
    compared with the pairs of the same news items. Dimensions and the mart are small and checked as a whole, orphans against them.
    The day counts are compared load by load with the rows that carry the load's id."""
    def report(check, table, columns, bad: DataFrame) -> DataFrame:
        return bad.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(check).alias("check"), F.lit(table).alias("table"), F.lit(columns).alias("columns"), "violations")

    def core(name: str) -> DataFrame:
        return store.read("core_store", name)

    loads = store.ledger.state()["loads"]
    last = max([x.get("last_new_id") or 0 for i, x in loads.items() if int(i) <= since], default=0)
    new = {t: core(t).where(F.col("load_id") > since) for t in ("news", "news_tag_pairs")}

    def older(table: str) -> DataFrame:
        """Rows of older loads that may hold an id of the new rows of ``table``."""
        seen = [i for i in store.seen_loads(new[table].select(F.col("new_raw_id").alias("id"))) if i <= since]
        return store.history(table, seen)
    news, pairs = new["news"], new["news_tag_pairs"]
    again = news.select("new_raw_id").unionByName(older("news").join(news.select("new_raw_id").distinct(), "new_raw_id", "left_semi").select("new_raw_id"))
    known = pairs.select("new_raw_id", "new_id", "tag_id")
    earlier = older("news_tag_pairs").select("new_raw_id", "new_id", "tag_id").join(known.select("new_raw_id").distinct(), "new_raw_id", "left_semi")
    both = known.withColumn("fresh", F.lit(1)).unionByName(earlier.withColumn("fresh", F.lit(0)))
    twice = both.groupBy("new_id", "tag_id").agg(F.count(F.lit(1)).alias("n_rows"), F.max("fresh").alias("fresh"))
    parents = store.history("news", store.seen_loads(pairs.select(F.col("new_raw_id").alias("id"))))
    parents = parents.select("new_raw_id", "new_id", F.col("source_id").alias("source"), F.col("new_published").alias("published"))
    parts = []
    for name, cols, primary in DECLARED_KEYS:
        layer, t = name.split(".")
        kind, columns = "primary key" if primary else "unique", ", ".join(cols)
        if t == "news" and cols == ["new_id"]:
            bad = check_unique(news, cols).select("new_id").unionByName(news.where(F.col("new_id") <= last).select("new_id")).distinct()
        elif t == "news" and layer == "core_store":
            bad = check_unique(again, cols, primary)
        elif t == "news_tag_pairs":
            bad = twice.where(((F.col("n_rows") > 1) | F.col("new_id").isNull() | F.col("tag_id").isNull()) & (F.col("fresh") == 1))
        else:
            bad = check_unique(store.read(layer, t), cols, primary)
        parts.append(report(kind, name, columns, bad))
    for child, fk, parent, pk in DECLARED_FOREIGN_KEYS:
        rows = news if child == "core_store.news" else pairs
        if parent == "core_store.news":
            bad = rows.where(F.col("new_id").isNotNull()).join(parents, ["new_raw_id", "new_id"], "left_anti")
        else:
            bad = check_foreign_keys(rows, core(parent.split(".")[1]), fk, pk)
        parts.append(report("foreign key", child, f"{fk} -> {parent}.{pk}", bad))
    items = news.select("load_id", F.col("tag_id").alias("category"), F.col("source_id").alias("source"), F.col("new_published").alias("published"))
    facts = {"news_days": items, "pair_days": pairs.select("new_raw_id", "new_id", "load_id", F.col("tag_id").alias("category")).join(parents, ["new_raw_id", "new_id"])}
    later = [int(i) for i in loads if int(i) > since]
    for log, fact in facts.items():
        parts.append(report("derived", f"mart_store.{log}", "sum(n) per category, source, day = core", _log_since(store, log, later, fact)))
    return _union(parts)


def _log_since(store, log: str, loads: list[int], fact: DataFrame) -> DataFrame:
    """(load, category, source, day) where what the loads have logged isn't the count of the rows that carry the load's id."""
    keys = ["load_id", "category", "source", "published"]
    counted = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    logged = store.log_of_loads(log, loads).select(*keys, (-F.col("n")).alias("n"))
    return counted.unionByName(logged).groupBy(*keys).agg(F.sum("n").alias("n")).where("n <> 0")


def check_day_log(store, log_table: str = "news_days") -> DataFrame:
    """The per-load day-count log, summed, against day counts recomputed from the whole core
    (``news_days``: first tag per news item; ``pair_days``: every pair of the bridge): the (category, source,
    day) triples where they differ. A full outer join on the triple (NULL days match NULL days), both
    sides pre-aggregated."""
    from feedmart.operators.core import core_fact
    from feedmart.operators.mart import day_counts
    keys = ["category", "source", "published"]
    log = store.read("mart_store", log_table).groupBy(*keys).agg(F.sum("n").alias("n_log"))
    news, bridge = store.read("core_store", "news"), store.read("core_store", "news_tag_pairs")
    fact = core_fact(news) if log_table == "news_days" else core_fact(news, bridge)
    core = day_counts(fact).withColumnRenamed("n", "n_core")
    cond = None
    for k in keys:
        c = log[k].eqNullSafe(core[k])
        cond = c if cond is None else cond & c
    joined = log.join(core, cond, "full_outer")
    return joined.where(~F.coalesce(F.col("n_log"), F.lit(0)).eqNullSafe(F.coalesce(F.col("n_core"), F.lit(0))))
