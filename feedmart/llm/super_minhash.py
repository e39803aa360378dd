"""Near-duplicate grouping with SuperMinHash signatures.

A document is the set of its distinct n-word shingles (64-bit hashes). Two documents link when their Jaccard similarity is at least
num / den. The steps:

1. Signatures. Every shingle ranks the SLOTS components by a random permutation of its own, and a component takes the least
   rank (with a random fraction) among the document's shingles. The ranks of one shingle over the components are correlated: each is taken
   once, so the share of equal components of two documents estimates their similarity with less variance than independent hashes
   do. Ranks are dealt round by round to all shingles of a batch of documents, rank 0 first; a document is finished when
   all its components are below the next rank (a long text after one round).
2. Banding. ROWS components make a band; documents with an equal band are candidates of each other. Documents with equal sets are one class
   first. The smallest member of a band is joined with the others, found by an aggregate that collapses frequent bands before
   the shuffle; what these edges connect is a block, and all candidates of a document lie in its block.
3. Verification. The full sets of a block meet in tasks. Pairs are tried unless their sizes, their sketch (one byte a component)
   or an earlier link of their groups makes it needless, and each is confirmed by the exact size of its intersection. A union-find
   keeps the groups. A large block is split by set size and hash; a task takes two parts. Tasks return the edges of a forest.
4. Components of all forests; classes are expanded to documents.

A pair with the least similarity 0.8 shares none of the 32 bands of 4 with a probability of 5e-8 (less for similar ones), and the
sketch, which is cut at CUT standard deviations below the threshold, turns away one in 1e11; nothing else is left to chance.

Words are the runs of other characters than space and U+0009 to U+000D, after lower-casing A-Z. Fewer than n words make one
shingle. Defined results: null or empty text and text of white space has no shingles, links with nothing and is kept. Ids should be unique;
rows with one id are one node of the graph and are all kept or all dropped. A row without an id links with nothing, has no
component and is kept. Repeated rows are equal sets. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ARROW_ROWS, batch_rows, join_groups, staged
from .ngram_join import MEMBER_BITS, _members_bitmap, _with_parts, components, shingles

SLOTS, ROWS = 128, 4
BATCH_SHINGLES = 1 << 18
RANK = np.uint64(48)  # a component's value: the rank above 48 random bits
CUT = 7
FEW = 16
BIT_CELLS = 64_000_000

_STEP, _M1, _M2 = (np.uint64(int(c, 16)) for c in ("9E3779B97F4A7C15", "BF58476D1CE4E5B9", "94D049BB133111EB"))  # fixed values of a 64-bit mixer


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * _M1
    z = (z ^ (z >> np.uint64(27))) * _M2
    return z ^ (z >> np.uint64(31))


# -- signatures

def super_minhash(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """One row of ``slots`` values for each non-empty set of 64-bit hashes."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.full((len(sets), slots), np.iinfo(np.uint64).max, np.uint64)
    if not len(sets):
        return out
    flat, x, owner = out.ravel(), np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    places = None  # of each shingle: the components that it has not ranked yet, at index rank and above
    for rank in range(slots):
        z = _mixed(x + np.uint64(int(_STEP) * (rank + 1) % (1 << 64)))
        pick = rank + ((z >> RANK).astype(np.int64) * (slots - rank) >> 16)
        each = np.arange(len(x))
        slot = pick if places is None else places[each, pick]
        np.minimum.at(flat, owner * slots + slot, (np.uint64(rank) << RANK) | (z & np.uint64((1 << 48) - 1)))
        open_ = np.unique(owner)
        open_ = open_[out[open_].max(1) >= np.uint64(rank + 1) << RANK]
        if not len(open_):
            break
        unfinished = np.zeros(len(sets), bool)
        unfinished[open_] = True
        stay = unfinished[owner]
        x, owner, pick = x[stay], owner[stay], pick[stay]
        if places is None:
            places = np.tile(np.arange(slots, dtype=np.uint8), (len(x), 1))
        elif not stay.all():
            places = places[stay]
        each = np.arange(len(x))
        places[each, pick] = places[:, rank]  # the picked one leaves, the next in line takes its place
    return out


def band_keys(signatures: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key a band."""
    bands = signatures[:, :signatures.shape[1] // rows * rows].reshape(len(signatures), -1, rows)
    key = np.tile(np.arange(1, bands.shape[1] + 1, dtype=np.uint64), (len(bands), 1))
    for i in range(rows):
        key = _mixed((key ^ bands[:, :, i]) * _STEP)
    return key


def sketch_cut(num: int, den: int, slots: int = SLOTS) -> float:
    """Fewest equal components of a pair that is tried."""
    t = num / den
    return slots * t - CUT * (slots * t * (1 - t)) ** 0.5


def _signature_table(texts: DataFrame, n: int) -> DataFrame:
    """doc_id, n, sig, keys, sketch of every row."""
    names = ["doc_id", "n", "sig", "keys", "sketch"]

    def flush(ids, sets):
        whole = [s for s in sets if len(s)]
        signatures = super_minhash(whole)
        keys = iter(band_keys(signatures).view(np.int64))
        sketch = iter((signatures & np.uint64(255)).astype(np.uint8))
        cols = [(len(s), xxhash.xxh3_128_digest(s.tobytes()), next(keys), next(sketch).tobytes()) if len(s) else (0, None, None, None) for s in sets]
        arrays = [pa.array(c, t) for c, t in zip(zip(*cols), (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary()))]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *arrays], names=names)

    def rows(batches):
        ids, sets, held = [], [], 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                ids.append(i)
                sets.append(shingles(t.as_py(), n))
                held += len(sets[-1])
                if held >= BATCH_SHINGLES:
                    yield flush(ids, sets)
                    ids, sets, held = [], [], 0
        if ids:
            yield flush(ids, sets)
    return texts.mapInArrow(rows, "doc_id long, n long, sig binary, keys array<long>, sketch binary")


# -- candidates

def _candidates(classes: DataFrame) -> DataFrame:
    """Edges (a, b) from the smallest member of a band to the others."""
    posts = classes.select("rep", F.explode("keys").alias("key"))
    bands = posts.groupBy("key").agg(F.min("rep").alias("a"), F.count("*").alias("members")).filter("members > 1")
    met = join_groups(posts, staged(bands, "bands"), "key", "members", SLOTS // ROWS * classes.count())
    return met.filter("a <> rep").select("a", F.col("rep").alias("b"))


# -- verification

class Overlaps:
    """Sizes of intersections among the sets of a task: by bit sets where these are small, else along the shingles' lists."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets, self.rows, self.lists = sets, None, None

    def _number(self) -> None:
        sizes = [len(s) for s in self.sets]
        _, token, count = np.unique(np.concatenate(self.sets), return_inverse=True, return_counts=True)
        owner, shared = np.repeat(np.arange(len(sizes)), sizes), count > 1
        often = shared[token]
        token, owner = (np.cumsum(shared) - 1)[token[often]], owner[often]
        width = -(-max(1, int(shared.sum())) // 64) * 64
        if len(sizes) * width <= BIT_CELLS:
            bits = np.zeros((len(sizes), width), np.uint8)
            bits[owner, token] = 1
            self.rows = np.packbits(bits, axis=1).view(np.uint64)
        else:
            by = np.argsort(token, kind="stable")
            self.lists = token, np.searchsorted(owner, np.arange(len(sizes) + 1)), owner[by], np.searchsorted(token[by], np.arange(width + 1))

    def shared(self, i: int, others: np.ndarray) -> np.ndarray:
        if len(others) <= FEW:
            return np.array([len(np.intersect1d(self.sets[i], self.sets[j], assume_unique=True)) for j in others], np.int64)
        if self.rows is None and self.lists is None:
            self._number()
        if self.rows is not None:
            return np.bitwise_count(self.rows[others] & self.rows[i]).sum(1, dtype=np.int64)
        token, at, owners, starts = self.lists
        own = [owners[starts[t]:starts[t + 1]] for t in token[at[i]:at[i + 1]]]
        return np.bincount(np.concatenate(own), minlength=len(self.sets))[others] if own else np.zeros(len(others), np.int64)


def forest(sets: list[np.ndarray], sketches: np.ndarray, left: np.ndarray, right: np.ndarray, num: int, den: int) -> np.ndarray:
    """Root of each set after all links between ``left`` and ``right`` were found."""
    sizes = np.array([len(s) for s in sets], np.int64)
    root, cut, overlaps = np.arange(len(sets)), sketch_cut(num, den, sketches.shape[1]), Overlaps(sets)
    for i in left:
        others = right[(root[right] != root[i]) & (den * sizes[right] >= num * sizes[i]) & (num * sizes[right] <= den * sizes[i])]
        if len(others):
            others = others[(sketches[others] == sketches[i]).sum(1) >= cut]
        if len(others):
            shared = overlaps.shared(i, others)
            linked = others[den * shared >= num * (sizes[others] + sizes[i] - shared)]
            if len(linked):
                met = np.unique(np.append(root[linked], root[i]))
                root[np.isin(root, met)] = met[0]
    return root


def _verify(num: int, den: int):
    def task(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("sig").sort_values("rep").reset_index(drop=True)
        sets = [np.frombuffer(x, "<u8") for x in group["shingles"]]
        sketches = np.frombuffer(b"".join(group["sketch"]), np.uint8).reshape(len(sets), -1)
        part, reps = group["part"].to_numpy(), group["rep"].to_numpy()
        left, right = np.flatnonzero(part == group["i"].iloc[0]), np.flatnonzero(part == group["j"].iloc[0])
        root = forest(sets, sketches, left, right, num, den)
        child = np.flatnonzero(reps[root] != reps)
        return pd.DataFrame({"a": reps[root[child]], "b": reps[child]})
    return task


def near_duplicates(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    with batch_rows(spark, ARROW_ROWS):
        table = staged(_signature_table(texts, n), "signatures")
    linkable = table.filter("sig is not null and doc_id is not null")
    classes = staged(linkable.groupBy("sig").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("n").alias("n"),
                                                 F.first("keys").alias("keys"), F.first("sketch").alias("sketch")), "classes")
    blocks = components(_candidates(classes))
    members = staged(classes.select("sig", "rep", "copies", "n", "sketch").join(blocks.withColumnRenamed("node", "rep"), "rep"), "members")
    shared = spark.sparkContext.broadcast(_members_bitmap(members))  # of a fixed size

    def cut(batches):
        bits = shared.value
        for b in batches:
            at = b.column(1).to_numpy()
            wanted = np.flatnonzero((bits[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1))
            sets = [(b.column(0)[i].as_py(), shingles(b.column(2)[i].as_py(), n)) for i in wanted.tolist()]
            sets = [(i, s) for i, s in sets if len(s)]
            if sets:
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in sets], pa.int64()), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for _, s in sets], pa.binary()),
                                                  pa.array([s.astype("<u8").tobytes() for _, s in sets], pa.binary())], names=["rep", "sig", "shingles"])
    hashed = texts.filter("doc_id is not null").select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(1 << MEMBER_BITS)).alias("at"), "text")
    with batch_rows(spark, ARROW_ROWS):
        sets = staged(hashed.mapInArrow(cut, "rep long, sig binary, shingles binary"), "member-sets")
    parts = _with_parts(members, num, den).join(members.select("sig", "sketch"), "sig")
    tasks = sets.join(parts, ["rep", "sig"]).withColumn("other", F.explode("others")).select(
        "component", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "sig", "rep", "sketch", "shingles")
    found = staged(tasks.groupBy("component", "i", "j").applyInPandas(_verify(num, den), "a long, b long"), "links")

    joined = components(found).withColumnRenamed("node", "rep")
    result = staged(classes.select("sig", "rep", "copies").join(joined, "rep", "left")
                    .select("sig", "copies", F.coalesce("component", "rep").alias("component_id")), "classes-out")
    grouped = join_groups(linkable.select("sig", "doc_id", "n"), result, "sig", "copies", table.count()).select("doc_id", "n", "component_id")
    alone = table.filter("sig is null or doc_id is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return grouped.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                                             F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the document of the smallest id of each group; all columns stay. Rows without an id stay."""
    drop = staged(near_duplicates(docs, n, num, den, id_col, text_col).filter("not kept").select(F.col("doc_id").alias("__drop")).distinct(), "near-copies")
    return docs.join(drop, F.col(id_col).cast("long") == F.col("__drop"), "left_anti")


__all__ = ["band_keys", "forest", "keep_one", "near_duplicates", "sketch_cut", "super_minhash"]
