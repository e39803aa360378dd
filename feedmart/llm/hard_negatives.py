"""Hard-negative mining with segment summaries.

The score of a row with an anchor is the inner product of their vectors of whole numbers, floor(256 x). An anchor's positives
are its best rows with its label; a positive's hard negatives are the best rows with another label whose score lies in a
window that the positive's score sets. The steps:

1. Summaries. A vector is cut into SEGMENTS equal segments; the mean and the (population) deviation of each are stored beside it.
   Rows are packed into blocks of BLOCK rows, sorted by label inside each partition, and written once.
2. Bounds. Over a segment of length L, the product of two vectors is L (mean mean' + deviation deviation' r) with a correlation r between
   -1 and 1. So L (mean mean' - deviation deviation') and L (mean mean' + deviation deviation') bound it, and their sums bound the score.
   Segments that are merged two by two into longer ones (their means and deviations follow) give cheaper, wider bounds.
3. Filter. Anchors come in groups of ANCHORS, which are broadcast; each task compares its blocks with the group. For a block, bounds from LEVELS of few
   segments to many take out the pairs, then the anchors and rows, that can't enter an anchor's running best list
   (score below the worst kept, or outside of the window); what is left is scored exactly by one matrix product.
4. Tasks return an anchor's best few rows; a rank per anchor merges them. One pass finds the positives, whose scores set the
   windows, and one the negatives. Rows are never shuffled, and a frequent label needs no care: no group by label is formed.

The bounds carry a slack for the rounding of doubles; scores are exact integers.

Defined results: rows with a null id, a null label, a null vector, or a null, NaN or infinite component take no part. Vectors of
different lengths are filled up with zeros; a component beyond 2^27 / 256 fails the job. Anchors are all rows whose id is
divisible by ``anchor_every``; an id that occurs several times is an anchor in each of its rows, and none of these
rows is a partner of the others. Other repeated rows count each. Equal scores go to the smaller id. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import batch_rows, scratch_path, staged
from .vectors import LARGEST, finite, products, scaled, unpack

SEGMENTS = 16
LEVELS = (1, 4, 16)
BLOCK = 512
ANCHORS = 4096
BLOCKS_PER_BATCH = 16
NONE = -(1 << 62)  # below every score


# -- rows and blocks

def relabelled(vec_id: Column, label: Column) -> Column:
    """The label with which a row takes part: one further, modulo ten, where the id is divisible by seven."""
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)


def usable(table: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label, vector (array<int>) of the rows that take part; all vectors have one length."""
    raw = F.col(vector_col)
    rows = table.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & finite(raw))
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), scaled(raw).alias("vector"))
    sizes = rows.agg(F.min(F.size("vector")).alias("least"), F.max(F.size("vector")).alias("most")).first()
    if sizes["most"] is None or sizes["least"] == sizes["most"]:
        return rows
    filled = F.concat("vector", F.array_repeat(F.lit(0), F.lit(sizes["most"]) - F.size("vector")))
    return rows.withColumn("vector", filled)


def summaries(x: np.ndarray, segments: int = SEGMENTS) -> tuple[np.ndarray, np.ndarray, int]:
    """Means and deviations (rows x segments) and the segments' length; a vector is filled up with zeros to whole segments."""
    length = max(1, -(-x.shape[1] // segments))
    cut = np.zeros((len(x), segments * length))
    cut[:, :x.shape[1]] = x
    cut = cut.reshape(len(x), segments, length)
    mean = cut.mean(2)
    return mean, np.sqrt(((cut - mean[:, :, None]) ** 2).mean(2)), length


def merged(mean: np.ndarray, deviation: np.ndarray, into: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of ``into`` longer segments, each of as many of the given ones."""
    m = mean.reshape(len(mean), into, -1)
    d = deviation.reshape(len(mean), into, -1)
    whole = m.mean(2)
    return whole, np.sqrt((d ** 2).mean(2) + ((m - whole[:, :, None]) ** 2).mean(2))


class Summary:
    """Vectors with their segments' means and deviations, and the longer segments of each level."""

    def __init__(self, x: np.ndarray, mean: np.ndarray, deviation: np.ndarray):
        self.x = x
        self.length = max(1, -(-x.shape[1] // SEGMENTS)) * SEGMENTS
        self.levels = {s: tuple(v * np.sqrt(self.length / s) for v in merged(mean, deviation, s)) for s in LEVELS}
        self.norm = np.sqrt((x.astype(np.float64) ** 2).sum(1))

    def bounds(self, other: Summary, level: int, own, others) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest score of each row of ``own`` with each of ``others``."""
        (m, d), (om, od) = self.levels[level], other.levels[level]
        middle, half = m[own] @ om[others].T, d[own] @ od[others].T
        slack = 1e-9 * np.outer(self.norm[own], other.norm[others]) + 1e-6
        return middle - half - slack, middle + half + slack


def _summary(x: np.ndarray) -> Summary:
    return Summary(x, *summaries(x)[:2])


def blocks(rows: DataFrame) -> DataFrame:
    """Rows in blocks: ids, labels, packed vectors, and each segment's mean and deviation."""
    names = ["ids", "labels", "dims", "vectors", "means", "deviations"]
    types = (pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.binary(), pa.binary())

    def packed(batches):
        for b in batches:
            out = []
            for at in range(0, b.num_rows, BLOCK):
                part = b.slice(at, BLOCK)
                x = part.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int32, copy=False).reshape(part.num_rows, -1)
                mean, deviation, _ = summaries(x)
                out.append((part.column(0).to_pylist(), part.column(1).to_pylist(), x.shape[1], x.astype("<i4").tobytes(),
                            mean.astype("<f8").tobytes(), deviation.astype("<f8").tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
    rows = rows.sortWithinPartitions("label", "vec_id").select("vec_id", "label", "vector")
    with batch_rows(rows.sparkSession, 8 * BLOCK):
        return staged(rows.mapInArrow(packed, "ids array<long>, labels array<long>, dims int, vectors binary, means binary, deviations binary"), "segment-blocks")


def _read(batches):
    """(ids, labels, summary) of each block."""
    for b in batches:
        for ids, labels, dims, data, means, deviations in zip(*(b.column(i) for i in range(6))):
            x = unpack(data.as_buffer(), dims.as_py()) if dims.as_py() else np.zeros((len(ids), 0), np.int32)
            shape = (len(x), SEGMENTS)
            yield (ids.values.to_numpy(), labels.values.to_numpy(),
                   Summary(x, np.frombuffer(means.as_buffer(), "<f8").reshape(shape), np.frombuffer(deviations.as_buffer(), "<f8").reshape(shape)))


# -- one group of anchors against all rows

class Best:
    """The best rows so far of each query: scores and ids, best first; unused places have the score NONE."""

    def __init__(self, queries: int, keep: int):
        self.keep = keep
        self.scores = np.full((queries, keep), NONE)
        self.ids = np.full((queries, keep), np.iinfo(np.int64).max)

    def worst(self) -> np.ndarray:
        return self.scores[:, -1]

    def add(self, query: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        if not len(query):
            return
        touched = np.unique(query)
        old = np.repeat(touched, self.keep)
        query = np.concatenate([query, old])
        score = np.concatenate([score, self.scores[touched].ravel()])
        vec_id = np.concatenate([vec_id, self.ids[touched].ravel()])
        order = np.lexsort((vec_id, -score, query))
        query, score, vec_id = query[order], score[order], vec_id[order]
        start = np.searchsorted(query, touched)
        take = start[:, None] + np.arange(self.keep)  # each has at least ``keep`` rows: its old ones
        self.scores[touched], self.ids[touched] = score[take], vec_id[take]

    def rows(self, *columns: np.ndarray):
        """(query columns ..., score, vec_id) of the places in use."""
        query, place = np.nonzero(self.scores > NONE)
        return [c[query] for c in columns] + [self.scores[query, place], self.ids[query, place]]


def surviving(anchors: Summary, block: Summary, allowed: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors, rows and the pairs of them whose score may lie between the anchor's ``least`` and ``most``."""
    own, others = np.flatnonzero(allowed.any(1)), np.flatnonzero(allowed.any(0))
    alive = allowed[np.ix_(own, others)]
    for level in LEVELS:
        if not len(own) or not len(others):
            break
        low, high = anchors.bounds(block, level, own, others)
        alive &= (high >= least[own, None]) & (low <= most[own, None])
        a, b = alive.any(1), alive.any(0)
        own, others, alive = own[a], others[b], alive[np.ix_(a, b)]
    return own, others, alive


def _first_positives(anchor_ids, anchor_labels, anchors: Summary, keep: int) -> np.ndarray:
    """Score of the ``keep``-th best positive among the anchors of the group themselves: a floor for the search among all rows."""
    best = Best(len(anchor_ids), keep)
    for label in np.unique(anchor_labels):
        others = np.flatnonzero(anchor_labels == label)
        for own in np.array_split(others, -(-len(others) // BLOCK)):
            score = products(anchors.x[own], anchors.x[others])
            query, row = np.nonzero((anchor_ids[own][:, None] != anchor_ids[others]) & (score >= best.worst()[own, None]))
            best.add(own[query], score[query, row], anchor_ids[others[row]])
    return best.worst()


def _positives(data: DataFrame, group, keep: int) -> DataFrame:
    """anchor, score, vec_id: each task's best rows with the anchor's label."""
    shared = data.sparkSession.sparkContext.broadcast(group)

    def task(batches):
        anchor_ids, anchor_labels, x, floor = shared.value
        anchors, best = _summary(x), Best(len(anchor_ids), keep)
        for ids, labels, block in _read(batches):
            allowed = (anchor_labels[:, None] == labels) & (anchor_ids[:, None] != ids)
            least = np.maximum(best.worst(), floor)
            own, others, alive = surviving(anchors, block, allowed, least, np.full(len(least), np.inf))
            if len(own):
                score = products(anchors.x[own], block.x[others])
                query, row = np.nonzero(alive & (score >= least[own, None]))
                best.add(own[query], score[query, row], ids[others[row]])
        a, score, vec_id = best.rows(np.arange(len(anchor_ids)))
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(score), pa.array(vec_id)], names=["anchor", "score", "vec_id"])
    return data.mapInArrow(task, "anchor long, score long, vec_id long")


def _negatives(data: DataFrame, group, windows, keep: int) -> DataFrame:
    """pair, score, vec_id: each task's best rows with another label in the window of the pair of anchor and positive."""
    shared = data.sparkSession.sparkContext.broadcast((group[:3], windows))

    def task(batches):
        (anchor_ids, anchor_labels, x), (of, low, high) = shared.value
        anchors, best = _summary(x), Best(len(of), keep)
        for ids, labels, block in _read(batches):
            allowed = (anchor_labels[:, None] != labels) & (anchor_ids[:, None] != ids)
            floor = np.maximum(best.worst(), low)
            least, most = np.full(len(x), np.inf), np.full(len(x), -np.inf)
            np.minimum.at(least, of, floor)
            np.maximum.at(most, of, high)
            own, others, alive = surviving(anchors, block, allowed, least, most)
            if not len(own):
                continue
            score = products(anchors.x[own], block.x[others])
            place = np.full(len(x), -1)
            place[own] = np.arange(len(own))
            pairs = np.flatnonzero(place[of] >= 0)
            for some in np.array_split(pairs, max(1, -(-len(pairs) // ANCHORS))):
                at = place[of[some]]
                query, row = np.nonzero(alive[at] & (score[at] >= floor[some, None]) & (score[at] <= high[some, None]))
                best.add(some[query], score[at[query], row], ids[others[row]])
        pair, score, vec_id = best.rows(np.arange(len(of)))
        if len(pair):
            yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(score), pa.array(vec_id)], names=["pair", "score", "vec_id"])
    return data.mapInArrow(task, "pair long, score long, vec_id long")


def _ranked(found: DataFrame, key: str, keep: int) -> DataFrame:
    order = Window.partitionBy(key).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def _anchor_groups(rows: DataFrame, anchor_every: int):
    """(ids, labels, vectors) of at most about ANCHORS anchors at a time, in the order of ids inside a group."""
    anchors = staged(rows.filter(F.col("vec_id") % anchor_every == 0), "anchors")
    total = anchors.count()
    if not total:
        return
    parts = -(-total // ANCHORS)

    def packed(batches):
        ids, labels, vectors, dims = [], [], [], 0
        for b in batches:
            if b.num_rows:
                ids += b.column(0).to_pylist()
                labels += b.column(1).to_pylist()
                vectors.append(b.column(2).flatten().to_numpy(zero_copy_only=False).astype("<i4").tobytes())
                dims = len(b.column(2)[0])
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(pa.int64())), pa.array([labels], pa.list_(pa.int64())), pa.array([dims], pa.int32()),
                                              pa.array([b"".join(vectors)], pa.binary())], names=["ids", "labels", "dims", "vectors"])
    dealt = anchors.select("vec_id", "label", "vector").repartition(parts).sortWithinPartitions("vec_id")
    groups = staged(dealt.mapInArrow(packed, "ids array<long>, labels array<long>, dims int, vectors binary"), "anchor-groups")
    for g in groups.toLocalIterator():  # a group a row
        x = unpack(g["vectors"], g["dims"]) if g["dims"] else np.zeros((len(g["ids"]), 0), np.int32)
        yield np.array(g["ids"], np.int64), np.array(g["labels"], np.int64), x


def hard_negatives(table: DataFrame, anchor_every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", relabel=relabelled) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A negative's score lies between ``low`` and ``high`` hundredths of the positive's. ``relabel(vec_id, label)`` gives the label that
    counts (None: the given one)."""
    spark: SparkSession = table.sparkSession
    rows = usable(table, id_col, vector_col, label_col)
    if relabel:
        rows = rows.withColumn("label", relabel(F.col("vec_id"), F.col("label")))
    data = blocks(rows)
    out = scratch_path(spark, "hard-negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(out)
    with batch_rows(spark, BLOCKS_PER_BATCH):
        for ids, labels, x in _anchor_groups(rows, anchor_every):
            floor = _first_positives(ids, labels, _summary(x), positives)
            found = _ranked(_positives(data, (ids, labels, x, floor), positives), "anchor", positives).orderBy("anchor", "rank").toPandas()  # <= positives an anchor
            if not len(found):
                continue
            of, score, near = (found[c].to_numpy(np.int64) for c in ("anchor", "score", "vec_id"))
            window = [(-(-low * s // 100), high * s // 100) for s in score.tolist()]  # scores are whole numbers
            windows = of, *np.array(window, np.int64).T
            best = _ranked(_negatives(data, (ids, labels, x), windows, negatives), "pair", negatives)
            pairs = spark.createDataFrame(list(zip(range(len(of)), ids[of].tolist(), near.tolist(), score.tolist())),
                                          "pair long, anchor_id long, positive_id long, positive_score long")
            best.join(pairs, "pair").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                                            "positive_score", F.col("score").alias("negative_score")).write.mode("append").parquet(out)
    return spark.read.schema(schema).parquet(out)


__all__ = ["LARGEST", "blocks", "hard_negatives", "merged", "relabelled", "summaries", "surviving", "usable"]
