"""Keyed insert-if-absent and surrogate keys (the reference's ``INSERT ... ON CONFLICT DO NOTHING``
and ``serial`` columns), composed from Spark primitives.

* ``first_per_key``: of the incoming rows keep the first per key in arrival order. A hash-keyed
  aggregate with map-side partial aggregation: a hot key (say one id holding a third of all rows)
  is reduced to one row per map task before the shuffle.
* ``insert_if_absent``: drop keys the target already holds (left anti join).
* ``dense_ids``: 1, 2, 3 ... in arrival order, continuing the target's largest id. A small table is sorted
  in one task; a larger one (its size is counted, not guessed) without that: range-partition by the order key,
  sort inside each partition, number rows with the per-partition counter of ``monotonically_increasing_id``, add the row
  count of all earlier partitions (one row per partition, so the offsets table is bounded by the
  partition count).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmart.session import materialise, materialise_counted

ONE_TASK = 100_000  # rows of keys that one task may sort
_LOW_BITS = (1 << 33) - 1  # monotonically_increasing_id = partition index << 33 | row number


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str] = ()) -> DataFrame:
    """One row per key: the key, ``values`` and ``order`` taken from the first row by ``order``.

    ``min(struct(order..., values...))`` compares the order columns first, so it picks the
    earliest row and carries its values along (NULL order values sort first, as in ORDER BY ASC).
    """
    keys, order = list(keys), list(order)
    values = [v for v in values if v not in keys and v not in order]
    carried = order + values
    first = F.min(F.struct(*[F.col(c) for c in carried])).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, *[F.col(f"_first.{c}").alias(c) for c in carried])


def insert_if_absent(incoming: DataFrame, target: DataFrame, keys: Sequence[str],
                     target_keys: Sequence[str] | None = None, target_buckets: int | None = None) -> DataFrame:
    """Rows of ``incoming`` whose key the target does not hold yet (NULL keys never match).

    ``target_buckets``: the target is bucketed by its key into that many buckets. The incoming
    rows (one per key by now) are hashed into the same number of partitions, so the join keeps
    the target's bucket layout and only the incoming side moves."""
    keys = list(keys)
    tkeys = list(target_keys or keys)
    existing = target.select(*[F.col(t).alias(k) for t, k in zip(tkeys, keys)])
    if not target_buckets:
        return incoming.join(existing, on=keys, how="left_anti")
    # Same rows as the anti join (a row either meets some target row and is dropped, or meets
    # none and appears once), written as an outer join so that Catalyst keeps the repartition
    # below the join instead of pushing the join under it.
    present = existing.withColumn("_present", F.lit(True))
    moved = incoming.repartition(target_buckets, *keys)
    return moved.join(present, on=keys, how="left").where(F.col("_present").isNull()).drop("_present")


def max_id(target: DataFrame, id_col: str) -> Column:
    """Largest id in ``target`` (0 when empty) as a scalar subquery: stays in the plan."""
    return F.coalesce(target.select(F.max(id_col)).scalar(), F.lit(0).cast("long"))


def dense_ids(df: DataFrame, order: Sequence[str], id_col: str, start: Column | int = 0,
              num_partitions: int | None = None, group_id: str | None = None) -> DataFrame:
    """Add ``id_col`` = start + 1, start + 2, ... following ``order`` (ties broken arbitrarily), and, with ``group_id``, a column that
    numbers the values of the first order column 1, 2, 3 ...

    The rows are written to the scratch folder first, so ``df`` is evaluated once and all uses see the same rows even if an executor
    is lost and tasks are re-run. Up to ONE_TASK rows, counted while they are written, are sorted in one task; more are range partitioned.
    Pass keys and order columns only and join the ids back: ``df`` is written as it is.
    """
    rows, n = materialise_counted(df, "unnumbered")
    base = start if isinstance(start, Column) else F.lit(start)
    if n <= ONE_TASK:
        one = rows.coalesce(1)
        out = one.withColumn(id_col, (base + F.row_number().over(Window.orderBy(*order))).cast("long"))
        return out.withColumn(group_id, F.dense_rank().over(Window.orderBy(order[0])).cast("long")) if group_id else out
    out = _range_ids(rows, order, id_col, base, num_partitions)
    if group_id:
        first = order[0]
        groups = _range_ids(rows.select(F.col(first).alias("_first")).distinct(), ["_first"], group_id, F.lit(0), num_partitions)
        out = out.join(groups, F.col(first).eqNullSafe(F.col("_first"))).drop("_first")
    return out


def _range_ids(rows: DataFrame, order: Sequence[str], id_col: str, base: Column, num_partitions: int | None) -> DataFrame:
    """Range partitions, sorted and written; the offset of each is the number of rows in those before it."""
    order_cols = [F.col(c) for c in order]
    # Without an explicit count AQE may merge small range partitions; it only merges adjacent
    # ones, so partition order still follows the order key.
    ranged = rows.repartitionByRange(num_partitions, *order_cols) if num_partitions else rows.repartitionByRange(*order_cols)
    numbered = materialise(
        ranged.sortWithinPartitions(*order_cols)
        .withColumn("_mono", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright(F.col("_mono"), 33))
        .withColumn("_row", F.col("_mono").bitwiseAND(F.lit(_LOW_BITS)))
        .drop("_mono"), "numbered")
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_part", F.coalesce(
        F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_offset"))
    return (numbered.join(F.broadcast(offsets), "_part")
            .withColumn(id_col, (base + F.col("_offset") + F.col("_row") + 1).cast("long"))
            .drop("_part", "_row", "_offset"))
