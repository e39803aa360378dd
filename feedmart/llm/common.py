"""Helpers shared by the corpus operators."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmart.session import scratch_path, shuffle_partitions

# Rows of one Arrow batch. A row holds a whole text, so batches are short: 128 texts of 1 MB are 128 MB.
ARROW_ROWS = 128

# A key with a share of at least 1 / HEAVY_SHARE of all rows is heavy: there are HEAVY_SHARE of them at most.
HEAVY_SHARE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def short_batches(spark: SparkSession) -> None:
    """Text rows go to Python workers in short Arrow batches, so that a batch of long texts fits in memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


@contextmanager
def batch_rows(spark: SparkSession, n: int):
    """Arrow batches of ``n`` rows for what runs inside the block."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and later passes don't recompute it.

    The folder lies under ``spark.checkpoint.dir``, which all executors share; a lost executor costs nothing.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """Bind ``value`` once: a lambda variable is evaluated a single time, where a plain reference inside a
    higher-order function would be evaluated for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Left join of ``rows`` with one row per key from ``groups``, safe for hot keys.

    ``size`` is the column of ``groups`` with the number of rows of the key. Keys with at least
    ``total / HEAVY_SHARE`` rows, of which there can be only HEAVY_SHARE, are broadcast; the others are
    joined by a shuffle in which no key has more than that share of the rows. ``key`` must not be null.
    """
    least = max(2, -(-total // HEAVY_SHARE))
    heavy = groups.filter(F.col(size) >= least)
    light = groups.filter(F.col(size) < least)
    hot = rows.join(F.broadcast(heavy), key)
    cold = rows.join(F.broadcast(heavy.select(key)), key, "left_anti")
    return hot.unionByName(cold.join(light, key, "left"))


__all__ = ["ARROW_ROWS", "HEAVY_SHARE", "batch_rows", "join_groups", "let", "scratch_path", "short_batches", "shuffle_partitions",
           "staged", "table"]
