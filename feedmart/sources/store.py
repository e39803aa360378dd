"""Table store: raw, core and mart layers as Parquet tables under one root folder.

The root is shared storage on a cluster (the reference keeps three database schemas; here they
are three folders). Tables are addressed by path so that separate jobs (full load today, delta
load tomorrow) see the same data; ``register`` also exposes them in the session catalog for SQL
users (``raw_store.news``, ``core_store.news`` ...).

Commit log. What a reader sees is decided by the entries of the log (``ledger``), never by which files lie in a folder: a load's raw rows,
its day counts and the mart are each written to a folder of their own and become current by one entry. A load that breaks
off leaves the tables as they were or, in core, rows that its replay completes. Every load gets an id; ids are never given
out twice, so a load only adds raw rows. Only a re-run of a named load replaces, and then by one entry when all its new rows are
written. One load writes to a store at a time.

Raw. One pass writes a run's raw rows and rejects to ``raw_store/entries/run=...``, apart by the folders
``status=...``, ``load_id=...`` and ``source=...``. The folder of a replaced run stays until the next load begins.

Core. The news table grows with all history while a load brings one day, and every load anti-joins its ids
against it. It is therefore bucketed by ``new_raw_id``, and so is the bridge ``news_tag_pairs``: the history side
of those joins is read bucket by bucket with no shuffle, and only the day's keys are shuffled to match. Beside them
``news_keys`` holds a 64-bit hash of every id and the load that brought it, bucketed by the hash: a load looks its ids up there and then
reads the history of those loads only that hold one of them (``seen_loads``).
Bucketing lives in the catalog, so every Store registers its bucketed tables as external tables over its
folders under a private database derived from its root (several stores in one session never see each other's
tables). The bucket count comes from the caller or from ``spark.sql.shuffle.partitions``, never from the
cores at hand; ``rebucket`` changes it and merges the files of many loads into one per bucket.

Mart. Each version of ``mart_store.news`` has a folder of its own; the one before the current stays, so that a query which is reading it ends.
The day counts of the loads are merged from time to time into one table (``merge_log``).
"""

from __future__ import annotations

import hashlib
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmart import schemas
from feedmart.operators.mart import category_state, pair_state
from feedmart.operators.normalise import ACCEPTED, PROPOSED, propose_categories
from feedmart.session import child_names, delete_path, path_exists, shuffle_partitions
from feedmart.sources.ledger import Ledger

# layer -> table -> (schema, partition columns)
TABLES = {
    "raw_store": {"news": (schemas.RAW, ["load_id", "source"]),
                  "rejects": (schemas.REJECT, ["load_id", "source"])},
    "core_store": {"sources": (schemas.SOURCES, []), "tags": (schemas.TAGS, []),
                   "news": (schemas.NEWS, []), "news_tag_pairs": (schemas.NEWS_TAGS, []), "category_proposals": (schemas.PROPOSALS, [])},
    "mart_store": {"news": (schemas.MART, [])},
}
# Tables of the store itself, not published.
INNER = {("core_store", "news_keys"): schemas.NEWS_KEYS, ("mart_store", "news_days"): schemas.NEWS_DAYS, ("mart_store", "pair_days"): schemas.NEWS_DAYS}
# (layer, table) -> bucket column
BUCKETED = {("core_store", "news"): "new_raw_id", ("core_store", "news_tag_pairs"): "new_raw_id", ("core_store", "news_keys"): "h"}
STATUS = {("raw_store", "news"): schemas.ACCEPTED, ("raw_store", "rejects"): schemas.REJECTED}
VERSIONED = {("mart_store", "news"), ("core_store", "category_proposals")}  # replaced as a whole
LOGS = ("news_days", "pair_days")
OWNER = "feedmart.root"
KEPT_VERSIONS = 2       # of a table that is replaced as a whole: the current and the one before
MERGE_RUNS = 32         # a log is merged when more runs than this lie beside its merged table
PARTITIONS_A_STATEMENT = 200


class Store:
    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None,
                 databases: dict[str, str] | None = None):
        """``databases``: catalog name of each layer, if not the layer's own (see ``register``)."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.databases = {layer: layer for layer in TABLES} | (databases or {})
        self.ledger = Ledger(spark, f"{self.root}/_loads")
        self._wanted_buckets = buckets
        self._layout: tuple[int, int] | None = None
        self._bucketed_ready = False
        self._published = False
        self._db = "feedmart_" + hashlib.sha1(self.root.encode()).hexdigest()[:12]

    # -- files -----------------------------------------------------------------------------------
    def path(self, layer: str, table: str) -> str:
        """Folder of a table (the current version's, if it has versions)."""
        if (layer, table) in STATUS:
            return f"{self.root}/raw_store/entries"
        if (layer, table) in BUCKETED:
            return f"{self.root}/{layer}/{table}/v{self.layout()[1]}"
        if (layer, table) in VERSIONED:
            return f"{self.root}/{layer}/{table}/v{self._table(layer, table).get('version', 0)}"
        return f"{self.root}/{layer}/{table}"

    def _table(self, layer: str, table: str) -> dict:
        return self.ledger.state()["tables"].get(f"{layer}.{table}", {})

    def schema(self, layer: str, table: str) -> T.StructType:
        if (layer, table) in INNER:
            return INNER[layer, table]
        if (layer, table) == ("mart_store", "news") and "category_id" in self._table(layer, table).get("columns", []):
            return schemas.MART_CORRECTED
        return TABLES[layer][table][0]

    def exists(self, layer: str, table: str) -> bool:
        return path_exists(self.spark, self.path(layer, table))

    # -- loads -----------------------------------------------------------------------------------
    def load(self, load_id: int) -> dict:
        """What the commit log knows of a load (empty if it never began)."""
        return self.ledger.state()["loads"].get(str(load_id), {})

    def open_loads(self) -> list[int]:
        """Loads that have begun and not ended, in the order in which they began."""
        loads = self.ledger.state()["loads"]
        return sorted((int(i) for i, x in loads.items() if x["open"] is not None), key=lambda i: loads[str(i)]["open"])

    def begin_load(self, load_id: int | None = None, name: str | None = None, compat: bool = True, mapping: DataFrame | None = None) -> int:
        """Id of a load that starts now: a fresh one, or, for a ``name`` (or an explicit id) that was loaded before, the
        same id again. What such a load wrote before stays until its new raw rows are complete. The mapping of categories is kept
        with the load, so that a replay applies the same."""
        state = self.ledger.state()
        known = state["names"].get(name) if name is not None else None
        if load_id is None:
            load_id = known if known is not None else state["last_load"] + 1
        elif known is not None and known != load_id:
            raise ValueError(f"load {name!r} has the id {known}, not {load_id}")
        run = state["seq"] + 1
        if mapping is not None:
            mapping.write.mode("overwrite").parquet(f"{self.root}/_mappings/run={run}")
        self.ledger.note("begin", at=run, load=load_id, run=run, name=name, compat=compat)
        gone = [r for i, x in state["loads"].items() if int(i) != load_id for r in x["replaced"]]
        if gone:  # replaced before this load began; readers have had one load's time
            for r in gone:
                delete_path(self.spark, f"{self.root}/raw_store/entries/run={r}")
            self.ledger.note("collected", runs=gone)
        return load_id

    def mapping(self, load_id: int) -> DataFrame | None:
        """The mapping of categories that the load's raw rows go through."""
        path = f"{self.root}/_mappings/run={self.load(load_id)['raw']}"
        return self.spark.read.parquet(path) if path_exists(self.spark, path) else None

    def abort_load(self, load_id: int) -> None:
        """Forget a run whose raw rows are not complete: it changed nothing else."""
        run = self.load(load_id)["open"]
        self.ledger.note("abort", load=load_id)
        delete_path(self.spark, f"{self.root}/raw_store/entries/run={run}")

    def step(self, load_id: int | None, name: str, write) -> None:
        """Run ``write`` unless the load has done that step before, and note it as done."""
        if load_id is None:
            write()
        elif name not in self.load(load_id)["done"]:
            write()
            self.ledger.note("step", load=load_id, step=name)

    def end_load(self, load_id: int, last_new_id: int) -> None:
        refused = not self.load(load_id)["compat"] and bool(self.load(load_id)["sources"].get(schemas.REJECTED))
        self.ledger.note("end", load=load_id, last_new_id=last_new_id, refused=refused)

    def is_rerun(self, load_id: int) -> bool:
        """True if the load had begun before."""
        return self.load(load_id).get("runs", 0) > 1

    def last_new_id(self, but: int | None = None) -> int:
        """Largest ``new_id`` given out: from the commit log, and of open loads (other than ``but``) from their own rows."""
        own = [i for i in self.open_loads() if i != but]
        last = self.ledger.state()["last_new_id"]
        if not own:
            return last
        return max(last, self.read("core_store", "news").where(F.col("load_id").isin(own)).agg(F.max("new_id")).first()[0] or 0)

    def seen_loads(self, ids: DataFrame) -> list[int]:
        """Loads that brought a news item with one of ``ids`` (column ``id``): only they can hold it. A few others may be among
        them (equal hashes). Reads eight bytes per item of history; history isn't shuffled."""
        keys = self.read("core_store", "news_keys")
        hashes = ids.select(F.xxhash64("id").alias("h")).distinct().repartition(self.buckets(), "h")
        met = hashes.join(keys, "h").select("load_id").distinct()
        return sorted(r[0] for r in met.collect())  # one row a load

    def history(self, table: str, loads: list[int]) -> DataFrame:
        """``news`` or ``news_tag_pairs`` as far as it can hold rows of the ids that gave ``loads`` (``seen_loads``)."""
        return self.read("core_store", table).where(F.col("load_id").isin(loads) if loads else F.lit(False))

    # -- bucketed tables -----------------------------------------------------------------------
    def layout(self) -> tuple[int, int]:
        """Bucket count and version: as last written, else the given count or the session's shuffle partitions."""
        if self._layout is None:
            if not self._table("core_store", "layout"):
                self._write_layout(self._wanted_buckets or shuffle_partitions(self.spark), 1)
            last = self._table("core_store", "layout")
            self._layout = last["buckets"], last["version"]
        return self._layout

    def _write_layout(self, buckets: int, version: int) -> None:
        self.ledger.note("table", table="core_store.layout", buckets=buckets, version=version)

    def buckets(self) -> int:
        return self.layout()[0]

    def rebucket(self, buckets: int | None = None) -> "Store":
        """Rewrite the bucketed tables with ``buckets`` buckets (by default as many as now) and one file per bucket, sorted by load, then
        switch to the new files and delete the old ones. Also the compaction of the per-load files."""
        old, version = self.layout()
        tables = {key: self.read(*key) for key in BUCKETED}
        new = Store(self.spark, self.root)
        new._db, new._layout = f"{self._db}_v{version + 1}", (buckets or old, version + 1)
        for key in BUCKETED:
            delete_path(self.spark, new.path(*key))  # what a run that broke off has left
        new._ensure_bucketed()
        for (layer, table), rows in tables.items():
            new.append(rows.distinct() if table == "news_keys" else rows, layer, table)
        gone = [self.path(*key) for key in BUCKETED]
        self._write_layout(buckets or old, version + 1)
        self.spark.sql(f"DROP DATABASE {new._db} CASCADE")  # external tables: the files stay
        self._layout, self._bucketed_ready = None, False
        for layer, table in BUCKETED:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._private(layer, table)}")
        self._ensure_bucketed()
        if self._published:
            self.register()
        for path in gone:
            delete_path(self.spark, path)
        return self

    def _private(self, layer: str, table: str) -> str:
        """This store's own catalog name for a bucketed table: a database derived from the root,
        so several stores in one session never read each other's tables."""
        return f"{self._db}.{layer}__{table}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.databases[layer]}.{table}"

    def _ddl(self, layer: str, table: str, name: str) -> str:
        parts = TABLES[layer].get(table, (None, []))[1]
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema(layer, table).fields)
        part = f" PARTITIONED BY ({', '.join(parts)})" if parts else ""
        key = BUCKETED.get((layer, table))
        bucket = f" CLUSTERED BY ({key}) INTO {self.buckets()} BUCKETS" if key else ""
        return (f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{part}{bucket} "
                f"LOCATION '{_quoted(self.path(layer, table))}' TBLPROPERTIES ('{OWNER}' = '{_quoted(self.root)}')")

    def _ensure_bucketed(self) -> None:
        if self._bucketed_ready:
            return
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self._db}")
        for layer, table in BUCKETED:
            self.spark.sql(self._ddl(layer, table, self._private(layer, table)))
            self.spark.catalog.refreshTable(self._private(layer, table))
        self._bucketed_ready = True

    # -- K-ns / K-ddl: catalog ------------------------------------------------------------------
    def _held(self, name: str) -> bool:
        """True if a table or view of this library holds ``name``; its files lie in some store and stay when it is dropped.
        Anything else under that name is left alone, with an error."""
        if not self.spark.catalog.tableExists(name):
            return False
        if any(r["key"] == OWNER for r in self.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()):
            return True
        raise ValueError(f"{name} exists and isn't a table of this library; publish under other names "
                         "with Store(..., databases={...})")

    def register(self) -> "Store":
        """K-ns / K-ddl: the three databases and every table under the reference's names
        (``raw_store.news``, ``core_store.news`` ...) in the session catalog, as external tables
        over this store's folders (names that another store holds are taken over), plus the
        reference's seven one-attribute core tables (``core_store.news_ids``, ``news_tags`` ...)
        as views. Any other table under one of the names is left alone and raises an error."""
        self._ensure_bucketed()
        core, raw = self.databases["core_store"], self.databases["raw_store"]
        names = [self.name(layer, t) for layer in TABLES for t in TABLES[layer]]
        views = [f"{core}.{v}" for v in schemas.CORE_ATTRIBUTE_TABLES]
        held = {name for name in names + views if self._held(name)}  # look at all of them before the first is touched
        for layer, tables in TABLES.items():
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.databases[layer]}")
            for table in tables:
                self._publish(layer, table, self.name(layer, table) in held)
        for view, cols in schemas.CORE_ATTRIBUTE_TABLES.items():
            self.spark.sql(f"CREATE OR REPLACE VIEW {core}.{view} TBLPROPERTIES ('{OWNER}' = '{_quoted(self.root)}') AS "
                           f"SELECT {', '.join(cols)} FROM {core}.news")
        for view in self.spark.catalog.listTables(raw, "news_df_*"):  # of the store that held the names before
            if self._held(f"{raw}.{view.name}"):
                self.spark.sql(f"DROP VIEW {raw}.{view.name}")
        self._published = True
        loads = self.ledger.state()["loads"]
        for key in STATUS:
            self._add_partitions(*key, [(int(i), x["raw"], s) for i, x in loads.items() for s in x["sources"].get(STATUS[key], [])])
        self._publish_raw_views(self._source_names())
        return self

    def _publish(self, layer: str, table: str, held: bool) -> None:
        name = self.name(layer, table)
        if held:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.spark.sql(self._ddl(layer, table, name))

    def _add_partitions(self, layer: str, table: str, found: list[tuple[int, int, str]]) -> None:
        """Declare partitions (load, run, source) of a published raw table, each at the folder of its run."""
        for at in range(0, len(found), PARTITIONS_A_STATEMENT):
            adds = " ".join(f"PARTITION (load_id = {load}, source = '{_quoted(s)}') LOCATION '{_quoted(self._run_path(layer, table, load, run, s))}'"
                            for load, run, s in found[at:at + PARTITIONS_A_STATEMENT])
            self.spark.sql(f"ALTER TABLE {self.name(layer, table)} ADD IF NOT EXISTS {adds}")
        if found:
            self.spark.catalog.refreshTable(self.name(layer, table))

    def _publish_raw_views(self, sources: list[str]) -> None:
        """The reference's per-source raw tables, ``raw_store.news_df_<source>``, as views over the partitioned raw
        table: one statement per source of ``sources`` (one load's, or the store's when it is published).
        Characters that the catalog refuses in names become ``_``; sources that then have one name share the view."""
        raw = self.databases["raw_store"]
        for source in sorted({re.sub("[^A-Za-z0-9_]", "_", s) for s in sources}):
            view = f"{raw}.news_df_{source}"
            self._held(view)
            self.spark.sql(f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('{OWNER}' = '{_quoted(self.root)}') AS "
                           f"SELECT title, link, id, summary, tags, source, published FROM {raw}.news "
                           f"WHERE regexp_replace(source, '[^A-Za-z0-9_]', '_') = '{source}'")

    # -- scans ---------------------------------------------------------------------------------
    def read(self, layer: str, table: str) -> DataFrame:
        """The table; a table never written reads as empty (nothing to create up front)."""
        schema = self.schema(layer, table)
        if (layer, table) in BUCKETED:
            self._ensure_bucketed()
            return self.spark.table(self._private(layer, table)).select(*schema.fieldNames())
        if (layer, table) in STATUS:
            loads = self.ledger.state()["loads"].values()
            return self._runs(layer, table, [x["raw"] for x in loads if x["sources"].get(STATUS[layer, table])])
        if table in LOGS:
            return self._paths(schema, self._log_paths(table))
        return self._paths(schema, [self.path(layer, table)] if self.exists(layer, table) else [])

    def _paths(self, schema: T.StructType, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths).select(*schema.fieldNames())

    def _runs(self, layer: str, table: str, runs: list[int]) -> DataFrame:
        schema, base = TABLES[layer][table][0], self.path(layer, table)
        if not runs:
            return self.spark.createDataFrame([], schema)
        folders = [f"{base}/run={r}/status={STATUS[layer, table]}" for r in sorted(runs)]
        return self.spark.read.schema(schema).option("basePath", base).parquet(*folders).select(*schema.fieldNames())

    def load_rows(self, table: str, load_id: int) -> DataFrame:
        """Raw rows (or rejects) of one load: only its folder is listed and read."""
        load = self.load(load_id)
        return self._runs("raw_store", table, [load["raw"]] if load and load["sources"].get(STATUS["raw_store", table]) else [])

    # -- sinks ---------------------------------------------------------------------------------
    def _cast(self, df: DataFrame, schema: T.StructType) -> DataFrame:
        return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])

    def append(self, df: DataFrame, layer: str, table: str) -> None:
        rows = self._cast(df, self.schema(layer, table))
        key = BUCKETED.get((layer, table))
        if key:  # one file per bucket and load, sorted by load: shuffle the new rows by the bucket key first
            self._ensure_bucketed()
            moved = rows.repartition(self.buckets(), key).sortWithinPartitions("load_id")
            moved.write.insertInto(self._private(layer, table))
            self.spark.catalog.refreshTable(self._private(layer, table))
        else:
            rows.write.mode("append").parquet(self.path(layer, table))
        self._refresh(layer, table)

    def append_news(self, news: DataFrame) -> None:
        """New news items. Their keys go first, so that no item is ever without one."""
        self.append(news.select(F.xxhash64("new_raw_id").alias("h"), "load_id"), "core_store", "news_keys")
        self.append(news, "core_store", "news")

    def append_pairs(self, pairs: DataFrame) -> None:
        """New news-tag pairs; ``news_load`` is the load of the news item. Those of another load get a key of their own."""
        later = pairs.where("load_id <> news_load").select(F.xxhash64("new_raw_id").alias("h"), "load_id").distinct()
        self.append(later, "core_store", "news_keys")
        self.append(pairs, "core_store", "news_tag_pairs")

    def _run_path(self, layer: str, table: str, load_id: int, run: int, source: str) -> str:
        folder = f"{self.path(layer, table)}/run={run}/status={STATUS[layer, table]}/load_id={load_id}"
        names = {unquote(n.removeprefix("source=")): n for n in child_names(self.spark, folder)}
        return f"{folder}/{names.get(source, f'source={source}')}"

    def append_entries(self, entries: DataFrame, load_id: int) -> None:
        """K-raw: raw rows and rejects of one load, written in one pass to a folder of the run. One entry of the commit log makes them the load's
        rows, in place of those of an earlier run; then the catalog learns their partitions."""
        if self.load(load_id).get("open") is None:
            self.begin_load(load_id)
        old = self.load(load_id)
        run = old["open"]
        folder = f"{self.root}/raw_store/entries/run={run}"
        delete_path(self.spark, folder)
        self._cast(entries, schemas.ENTRIES).write.partitionBy("status", "load_id", "source").parquet(folder)
        sources = {status: [unquote(n.removeprefix("source=")) for n in child_names(self.spark, f"{folder}/status={status}/load_id={load_id}")
                            if n.startswith("source=")] for status in STATUS.values()}
        self.ledger.note("raw", load=load_id, run=run, sources=sources)
        if self._published:
            for (layer, table), status in STATUS.items():
                for s in old["sources"].get(status, []):
                    self.spark.sql(f"ALTER TABLE {self.name(layer, table)} DROP IF EXISTS PARTITION (load_id = {load_id}, source = '{_quoted(s)}')")
                self._add_partitions(layer, table, [(load_id, run, s) for s in sources[status]])
                self.spark.catalog.refreshTable(self.name(layer, table))
            self._publish_raw_views(sources[schemas.ACCEPTED])

    def overwrite(self, df: DataFrame, layer: str, table: str) -> DataFrame:
        """K-mart: a new version of a table, written to a folder of its own and made current by one entry of the commit log. The version before
        stays for queries that are reading it; older ones are deleted."""
        version = self._table(layer, table).get("version", 0) + 1
        base = f"{self.root}/{layer}/{table}"
        path = f"{base}/v{version}"
        delete_path(self.spark, path)  # what a build that broke off has left
        df.write.parquet(path)
        before = self.schema(layer, table)
        self.ledger.note("table", table=f"{layer}.{table}", version=version, columns=df.columns)
        if self._published:
            name = self.name(layer, table)
            if self.schema(layer, table) == before:
                self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{_quoted(path)}'")
                self.spark.catalog.refreshTable(name)
            else:  # other columns: corrected after compat, or the reverse
                self._publish(layer, table, self._held(name))
        self._collect_versions(base, version)
        return self.spark.read.schema(df.schema).parquet(path)

    # -- category proposals ----------------------------------------------------------------------
    def propose_categories(self, percent: int = 50) -> DataFrame:
        """Propose one name for categories that are spelt alike, over all raw rows, and keep the proposals in ``core_store.category_proposals``.
        What was reviewed before stays as it was decided."""
        names = self.read("raw_store", "news").groupBy(F.col("tags").alias("name"), "source").agg(F.count(F.lit(1)).alias("n"))
        decided = self.read("core_store", "category_proposals").where(F.col("status") != PROPOSED)
        fresh = propose_categories(names, percent).join(decided.select("key"), "key", "left_anti")
        return self.overwrite(self._cast(fresh.unionByName(decided), schemas.PROPOSALS), "core_store", "category_proposals")

    def review_categories(self, decisions: DataFrame) -> DataFrame:
        """Note decisions (``key``, ``status`` 'accepted' or 'declined', and optionally another ``canonical``)."""
        d = decisions.withColumn("_canonical", F.col("canonical") if "canonical" in decisions.columns else F.lit(None).cast("string"))
        d = d.select("key", F.col("status").alias("_status"), "_canonical")
        rows = self.read("core_store", "category_proposals").join(d, "key", "left")
        rows = rows.withColumn("status", F.coalesce("_status", "status")).withColumn("canonical", F.coalesce("_canonical", "canonical"))
        return self.overwrite(self._cast(rows, schemas.PROPOSALS), "core_store", "category_proposals")

    def reviewed_mapping(self) -> DataFrame:
        """The accepted proposals as a mapping (``key, canonical``) for loads."""
        return self.read("core_store", "category_proposals").where(F.col("status") == ACCEPTED).select("key", "canonical")

    def _collect_versions(self, base: str, version: int) -> None:
        for n in child_names(self.spark, base):
            if re.fullmatch("v[0-9]+", n) and int(n[1:]) <= version - KEPT_VERSIONS:
                delete_path(self.spark, f"{base}/{n}")

    def _refresh(self, layer: str, table: str) -> None:
        if self._published and table in TABLES[layer]:
            self.spark.catalog.refreshTable(self.name(layer, table))

    # -- logs of day counts ----------------------------------------------------------------------
    def _log_paths(self, table: str) -> list[str]:
        """The merged table, if there is one, and the runs noted after it."""
        base = f"{self.root}/mart_store/{table}"
        version = self._table("mart_store", table).get("version")
        return [f"{base}/merged/v{version}"] * bool(version) + [f"{base}/run={r}" for r in self.ledger.state()["logs"].get(f"mart_store.{table}", [])]

    def log_of_loads(self, table: str, load_ids: list[int]) -> DataFrame:
        """What the log holds of some loads, merged or not."""
        runs = [r for i in load_ids for r in self.load(i).get("logged", {}).get(f"mart_store.{table}", [])]
        return self._paths(schemas.NEWS_DAYS, [f"{self.root}/mart_store/{table}/run={r}" for r in runs])

    def append_log(self, days: DataFrame, table: str, load_id: int) -> None:
        """Add a load's day counts as a run of the log, unless this run of the load has done so."""
        load, name = self.load(load_id), f"mart_store.{table}"
        if name in load["done"]:
            return
        run = self.ledger.state()["seq"] + 1
        path = f"{self.root}/mart_store/{table}/run={run}"
        delete_path(self.spark, path)
        self._cast(days.withColumn("load_id", F.lit(load_id)), schemas.NEWS_DAYS).coalesce(1).write.parquet(path)
        self.ledger.note("log", at=run, load=load_id, run=run, table=name)

    def log_state(self, table: str) -> tuple[DataFrame, DataFrame, DataFrame] | None:
        """What ``merge_log`` has left: day counts, states per pair and per category (None before the first merge)."""
        version = self._table("mart_store", table).get("version")
        if not version:
            return None
        return tuple(self.spark.read.parquet(f"{self.root}/mart_store/{table}/merged{kind}/v{version}") for kind in ("", "_pairs", "_categories"))

    def log_since(self, table: str) -> DataFrame:
        """Day counts of the runs after the last merge."""
        runs = self.ledger.state()["logs"].get(f"mart_store.{table}", [])
        return self._paths(schemas.NEWS_DAYS, [f"{self.root}/mart_store/{table}/run={r}" for r in runs])

    def merge_log(self, table: str, least: int | None = None) -> bool:
        """Sum the log into one table, sorted by day, and into the states of the mart's measures, when more than ``least`` runs (MERGE_RUNS) lie beside
        the last such table. The runs' own files stay: a re-run of a load is counted against them."""
        name, runs = f"mart_store.{table}", self.ledger.state()["logs"].get(f"mart_store.{table}", [])
        if len(runs) <= (MERGE_RUNS if least is None else least):
            return False
        version = self._table("mart_store", table).get("version", 0) + 1
        base = f"{self.root}/mart_store/{table}/merged"
        kinds = {"": lambda: self.read("mart_store", table).groupBy("category", "source", "published").agg(F.sum("n").alias("n"))
                 .withColumn("load_id", F.lit(None).cast("long")).repartitionByRange("published").sortWithinPartitions("published"),
                 "_pairs": lambda: pair_state(self.spark.read.schema(schemas.NEWS_DAYS).parquet(f"{base}/v{version}")),
                 "_categories": lambda: category_state(self.spark.read.schema(schemas.NEWS_DAYS).parquet(f"{base}/v{version}"))}
        for kind, rows in kinds.items():
            delete_path(self.spark, f"{base}{kind}/v{version}")
            rows().write.parquet(f"{base}{kind}/v{version}")
        self.ledger.note("table", table=name, version=version, merged=max(runs))
        for kind in kinds:
            self._collect_versions(f"{base}{kind}", version)
        return True

    # -- S3: raw-table discovery ---------------------------------------------------------------
    def _source_names(self) -> list[str]:
        return sorted({s for x in self.ledger.state()["loads"].values() for s in x["sources"].get(schemas.ACCEPTED, [])})

    def raw_tables(self) -> DataFrame:
        """One row per source present in raw, named as the reference names its per-source raw
        tables (``news_df_<source>``). From the commit log; reads no raw rows."""
        names = self.spark.createDataFrame([(s,) for s in self._source_names()], "source string")
        return names.select("source", F.concat(F.lit("news_df_"), F.col("source")).alias("table_name"))


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
