"""Incremental loads driven by Structured Streaming.

New feed files dropped into the landing folder are picked up by a file stream, which tells their paths; each micro-batch is one
load of those files by the batch scan (both dialects, rejects and all), named after the stream's checkpoint and the batch, with an id
of its own from the store's ledger. ``foreachBatch`` may run a batch again after a failure with the
same batch id: the raw rows of that load are replaced, and core inserts only what is
absent, so a repeated batch changes nothing. ``trigger(availableNow=True)`` processes what has
arrived and stops, which is the scheduled-job form of the reference's daily run.

A file stream never reads the same path twice. Feeds that are fetched into one file name over and over are
noticed by their modification time, which the store keeps per path: files that are newer than when they were
read are loaded by a batch scan of just those paths, before the stream starts, with each batch, and, while a stream with
``processing_time`` runs, once every interval (a micro-batch without new files never starts, so they have a watcher of their own).
"""

from __future__ import annotations

import logging
import threading
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedmart.plans.load import load_entries
from feedmart.session import path_exists
from feedmart.sources.rss import read_landing
from feedmart.sources.store import Store

log = logging.getLogger(__name__)
FILES = "path string, modified timestamp"


def landing_stream(spark: SparkSession, landing: str, pattern: str = "*/*",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of the feed files (path, modified). Their contents aren't read."""
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    files = reader.load(f"{landing.rstrip('/')}/{pattern}")
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("modificationTime").alias("modified"))


def _files_read(store: Store) -> DataFrame:
    path = f"{store.root}/_stream_files"
    if not path_exists(store.spark, path):
        return store.spark.createDataFrame([], FILES)
    return store.spark.read.schema(FILES).parquet(path).groupBy("path").agg(F.max("modified").alias("modified"))


def _note_files(store: Store, files: DataFrame) -> None:
    files.select("path", "modified").write.mode("append").parquet(f"{store.root}/_stream_files")


def overwritten(store: Store, landing: str, pattern: str = "*/*") -> DataFrame:
    """Files (path, modified) that changed after the stream read them. Contents aren't read."""
    now = store.spark.read.format("binaryFile").load(f"{landing.rstrip('/')}/{pattern}").select(
        F.col("_metadata.file_path").alias("path"), F.col("modificationTime").alias("modified"))
    was = _files_read(store).withColumnRenamed("modified", "read")
    return now.join(was, "path").where("modified > read").select("path", "modified")


def start_landing_load(spark: SparkSession, landing: str, root: str, checkpoint_location: str,
                       as_of=None, compat: bool = True, mode: str = "full", on_bad_date: str = "reject",
                       mapping: DataFrame | None = None, available_now: bool = True,
                       processing_time: str | None = None, store: Store | None = None,
                       max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; each micro-batch runs the load of ``feedmart.plans.load``.

    ``as_of``: a day, a function that gives the day of a batch, or None for the current date of each batch. With
    ``available_now=False`` the stream runs on and looks every ``processing_time`` (``"<n> seconds"``, ``minutes`` or ``hours``)."""
    store = store or Store(spark, root)
    one_load = threading.Lock()  # micro-batches and the watcher load by turns

    def load(files: list, name: str) -> None:
        entries = read_landing(spark, [unquote(f["path"]) for f in files])
        load_entries(store, entries, mode, as_of() if callable(as_of) else as_of, compat, on_bad_date, name=name, mapping=mapping)
        _note_files(store, spark.createDataFrame([(f["path"], f["modified"]) for f in files], FILES))

    def changed_files() -> None:
        files = overwritten(store, landing).collect()  # the feeds that were fetched again: a handful of paths
        if files:
            latest = max(f.modified for f in files).strftime("%Y%m%dT%H%M%S.%f")
            load(files, f"{checkpoint_location}:again:{latest}")

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        with one_load:
            files = batch.select("path", "modified").collect()  # a row a file
            if files:
                load(files, f"{checkpoint_location}:{batch_id}")
            changed_files()

    def watch(query: StreamingQuery, seconds: float) -> None:
        while query.isActive:
            try:
                if query.awaitTermination(seconds):
                    return
            except Exception:  # the stream failed; whoever waits for it gets its error
                return
            with one_load:
                try:
                    if query.isActive and path_exists(spark, f"{store.root}/_stream_files"):
                        changed_files()
                except Exception:  # a load that broke off is repaired by the next; look again after the interval
                    log.exception("loading overwritten feeds failed")

    if path_exists(spark, f"{store.root}/_stream_files"):
        changed_files()
    writer = (landing_stream(spark, landing, max_files_per_trigger=max_files_per_trigger).writeStream.foreachBatch(one_batch)
              .option("checkpointLocation", checkpoint_location))
    if available_now:
        return writer.trigger(availableNow=True).start()
    every = processing_time or "1 hour"
    query = writer.trigger(processingTime=every).start()
    threading.Thread(target=watch, args=(query, _seconds(every)), name="feedmart-overwritten-feeds", daemon=True).start()
    return query


def _seconds(interval: str) -> float:
    """Length of "10 seconds", "1 minute", "2 hours" ..."""
    n, unit = interval.split()
    return float(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.lower().rstrip("s")]
