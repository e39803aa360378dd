"""Best-fit packing of token sequences with Martello-Toth dominance reduction.

Documents are encoded, ended by an end token, and cut into pieces of at most ``capacity`` tokens, the
first piece of a cut document taking what doesn't fill a sequence. Only the histogram of piece lengths
(at most ``capacity`` numbers whatever the input) goes to the driver. There the instance is reduced: a set of up to three
pieces that provably dominates every other set its largest piece could be packed with is fixed for good, as
often as both lengths last; the rest is packed best-fit decreasing. Both work on whole runs of equal lengths, so the time
depends on the number of lengths and not on the number of pieces, and give patterns with counts. Each piece then
finds its place from its rank among the pieces of its length: ranks come from counts per (length,
bucket) and a row number inside each, so that a length which holds most pieces is spread over many tasks.

Defined results: null text counts as empty; an empty text is its end token alone. Rows with equal ids stay
separate. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bpe
from .common import short_batches, staged

CAPACITY = 2048
END = 0
ROWS_PER_GROUP = 100_000
Pattern = tuple[int, tuple[tuple[int, int], ...]]  # number of sequences, and (length, pieces) in each


def _smallest_sums(sizes: list[int], count: dict[int, int], without: int) -> list[float]:
    """Least total of one, two and three pieces other than one of length ``without``."""
    out, total = [], 0
    for s in sizes:
        for _ in range(min(3, count[s] - (s == without))):
            total += s
            out.append(total)
            if len(out) == 3:
                return out
    return out + [float("inf")] * (3 - len(out))


def reduce_instance(hist: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Fixed patterns, and the histogram of the pieces left.

    For a piece j with room R beside it: alone if nothing fits; with k, the largest that fits, if k fills R or no two
    pieces fit; with k, if at most two fit and no two are longer than k together; with k and the
    largest b that fits beside both, if at most two fit and no two that fit are both longer than b.
    """
    count = {s: c for s, c in hist.items() if c > 0}
    sizes = sorted(count)
    fixed: list[Pattern] = []

    def take(members: list[int], times: int) -> None:
        runs: dict[int, int] = defaultdict(int)
        for s in members:
            runs[s] += 1
        fixed.append((times, tuple(sorted(runs.items(), reverse=True))))
        for s, k in runs.items():
            count[s] -= times * k
            if not count[s]:
                del count[s]
                sizes.remove(s)

    def largest(room: int, used: list[int]) -> int | None:
        i = bisect_right(sizes, room) - 1
        while i >= 0 and count[sizes[i]] - used.count(sizes[i]) <= 0:
            i -= 1
        return sizes[i] if i >= 0 else None

    def best_pair(room: int, j: int) -> tuple[int, int]:
        """Largest total of two pieces that fit together, and the largest length of the shorter of two that fit."""
        total = shorter = 0
        lo, hi = 0, len(sizes) - 1
        free = lambda s: count[s] - (s == j)
        while lo <= hi:
            a, b = sizes[lo], sizes[hi]
            if a + b > room or free(b) < 1 or (lo == hi and free(b) < 2):
                hi -= 1
            elif free(a) < 1:
                lo += 1
            else:
                total, shorter = max(total, a + b), max(shorter, a)
                lo += 1
        return total, shorter

    for j in sorted(count, reverse=True):
        while j in count:
            room = capacity - j
            k = largest(room, [j])
            if k is None:
                take([j], count[j])
                continue
            _, two, three = _smallest_sums(sizes, count, j)
            pair = None
            if k == room or two > room:
                pair = [j, k]
            elif three > room:
                total, shorter = best_pair(room, j)
                if k >= total:
                    pair = [j, k]
                else:
                    b = largest(room - k, [j, k])
                    if b is not None and shorter <= b:
                        pair = [j, k, b]
            if pair is None:
                break
            # the same set may be fixed again while what makes it dominant lasts: an exact fit always is
            if k == room:
                times = min(count[s] // pair.count(s) for s in pair)
            elif min(count[s] - pair.count(s) for s in pair) > 3 and min(count[sizes[0]], count[sizes[min(1, len(sizes) - 1)]]) > 3:
                times = max(1, min((count[s] - 3) // pair.count(s) for s in pair))
            else:
                times = 1
            take(pair, times)
    return fixed, dict(count)


def best_fit(hist: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing of a histogram; equal pieces are placed together.

    A piece goes to the fullest sequence that can hold it, which then is the fullest for the next equal
    piece too: so each sequence takes as many of them as it can before the next one does.
    """
    open_bins: dict[int, list[list]] = defaultdict(list)  # room -> [number of sequences, runs]
    rooms: list[int] = []

    def add(room: int, n: int, runs: tuple) -> None:
        if room not in open_bins:
            rooms.insert(bisect_left(rooms, room), room)
        open_bins[room].append([n, runs])

    for size in sorted(hist, reverse=True):
        left = hist[size]
        while left:
            i = bisect_left(rooms, size)
            if i == len(rooms):
                k = capacity // size
                if left >= k:
                    add(capacity - k * size, left // k, ((size, k),))
                if left % k:
                    add(capacity - left % k * size, 1, ((size, left % k),))
                break
            room = rooms[i]
            group = open_bins[room][-1]
            k = room // size
            full = min(group[0], left // k)
            runs = group[1]
            if full:
                group[0] -= full
                left -= full * k
                add(room - k * size, full, (*runs, (size, k)))
            else:
                group[0] -= 1
                add(room - left * size, 1, (*runs, (size, left)))
                left = 0
            if not group[0]:
                open_bins[room].remove(group)
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.remove(room)
    return [(n, runs) for groups in open_bins.values() for n, runs in groups]


def pack_lengths(hist: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    if any(not 0 < s <= capacity for s in hist):
        raise ValueError("lengths must be from 1 to the capacity")
    fixed, rest = reduce_instance(hist, capacity)
    return fixed + best_fit(rest, capacity)


def slots(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """Per length: rows of (first rank, first sequence, pieces per sequence, offset)."""
    out: dict[int, list] = defaultdict(list)
    taken: dict[int, int] = defaultdict(int)
    sequence = 0
    for n, runs in patterns:
        offset = 0
        for size, k in runs:
            out[size].append((taken[size], sequence, k, offset))
            taken[size] += n * k
            offset += size * k
        sequence += n
    return {s: np.array(v, np.int64) for s, v in out.items()}


PIECES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                       T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])
WITH_IDS = T.StructType([*PIECES.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])


def pieces(docs: DataFrame, spec_path: str, capacity: int = CAPACITY, end: int = END, ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of each document, with their token ids if asked for."""
    def make(_, doc_id, tokens):
        tokens = np.append(tokens, np.array([end], "<u4")).astype("<u4", copy=False)
        n = len(tokens)
        cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            row = doc_id, p, a, b - a, zlib.crc32(tokens[a:b].tobytes())
            yield (*row, tokens[a:b].astype("i4")) if ids else row
    return bpe.encoded(docs, spec_path, make, WITH_IDS if ids else PIECES, id_col, text_col)


def place(rows: DataFrame, capacity: int = CAPACITY, length_col: str = "length") -> DataFrame:
    """``rows`` (anything with a length) with sequence_id and offset."""
    spark = rows.sparkSession
    short_batches(spark)
    rows = staged(rows.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    hist = {r["n"]: r["count"] for r in rows.groupBy(F.col(length_col).cast("long").alias("n")).count().collect()}
    table = spark.sparkContext.broadcast(slots(pack_lengths(hist, capacity)))
    groups = max(1, -(-max(hist.values(), default=0) // ROWS_PER_GROUP))
    keys = [length_col, "__group"]
    keyed = rows.withColumn("__group", F.pmod(F.xxhash64("__row"), F.lit(groups)))
    before = Window.partitionBy(length_col).orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    counts = keyed.groupBy(*keys).agg(F.count("*").alias("__n"))
    counts = counts.select(*keys, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("__row"))
    ranked = keyed.withColumn("__nth", nth - 1).join(counts, keys)
    ranked = ranked.select(*[c for c in rows.columns if c != "__row"], (F.col("__before") + F.col("__nth")).alias("__rank"))
    names = ranked.columns
    at_length, at_rank = names.index(length_col), names.index("__rank")

    def put(batches):
        found = table.value
        for b in batches:
            size, rank = (b.column(i).cast(pa.int64()).to_numpy() for i in (at_length, at_rank))
            seq, off = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
            for s in np.unique(size):
                t, own = found[int(s)], np.flatnonzero(size == s)
                run = t[np.searchsorted(t[:, 0], rank[own], "right") - 1]
                nth = rank[own] - run[:, 0]
                seq[own], off[own] = run[:, 1] + nth // run[:, 2], run[:, 3] + nth % run[:, 2] * s
            cols = [b.column(i) for i in range(len(names)) if i != at_rank]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(seq), pa.array(off)], names=[*names[:at_rank], *names[at_rank + 1:], "sequence_id", "offset"])
    schema = T.StructType([f for f in ranked.schema if f.name != "__rank"] + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(put, schema)


def pack(docs: DataFrame, spec_path: str, capacity: int = CAPACITY, end: int = END, ids: bool = False, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset."""
    return place(pieces(docs, spec_path, capacity, end, ids, id_col, text_col), capacity)


__all__ = ["best_fit", "pack", "pack_lengths", "pieces", "place", "reduce_instance", "slots"]
