"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document is the set of its distinct n-word shingles (64-bit hashes). Two documents link when their Jaccard
similarity is at least num / den. The steps, all linear in the input but the last, which is quadratic inside
a block of candidates:

1. Document frequencies. Each task sorts its shingles and sends them, as differences of 32 bits, to ranges of the hash
   space, where all are counted. What comes back has a fixed size: a bitmap of the shingles that occur twice or more (2^27
   bits) and the HEAVY most frequent ones with their counts. If either fills up, the order below is less
   selective and the result the same.
2. Prefixes. In the global order (single shingles first, then by frequency, then by hash) a document of n shingles,
   of which a partner must share t = ceil(num n / den), has the l-prefix of its first n - t + l shingles; partners share l
   of those at least. Each document chooses l by the estimated cost of its candidates: a longer prefix reads more
   lists, but lets only documents with l common prefix shingles through. Single shingles need no posting, so a document with
   n - t + 1 of them is done here.
3. Candidates. Documents with equal sets are one class. The classes with a prefix shingle form its list. Lists of up to SHORT
   classes give pairs of compatible size, counted over all lists: a pair is a candidate when it shares as many prefix
   shingles as the smaller l of the two asks for. Longer lists give a star, which puts their classes into one block without
   counting; lists of very frequent shingles are split by salt, and the centres of their parts joined.
   Connected candidates are a block: documents that link are always in one.
4. Verification. The sets of a block meet in a task, and every pair in it is compared exactly. A block with more than
   BLOCK_ROWS classes or BLOCK_SHINGLES shingles is split into parts by set size and hash; a task takes two parts of
   compatible sizes, so no task gets more than about twice that. Tasks return, per class, its links and one edge of a spanning forest, never pairs.
5. Components of the forest, by hooking and pointer jumping; classes are expanded to documents.

Words are the runs of other characters than space and U+0009 to U+000D, after lower-casing A-Z. Fewer than n words make
one shingle. Defined results: null or empty text and text of white space has no shingles and no links. Ids should be
unique; where texts have the same smallest id they are one node of the graph. A row without an id links with nothing and
has no component. Repeated rows count as links of each other. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_groups, short_batches, shuffle_partitions, staged

BITMAP_BITS = 27
HEAVY = 1 << 20
BUFFER = 4_000_000
MOST_MATCHES = 8
VERIFY_COST = 20.0
SHORT = 32
SPLIT = 5000
BLOCK_ROWS = 4096
BLOCK_SHINGLES = 4_000_000
PARTS = 1 << 32  # numbers of a band's parts
MEMBER_BITS = 25
BIT_CELLS = 64_000_000

_rng = np.random.default_rng(20240611)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_MULT = _rng.integers(1, 1 << 63, 4, dtype=np.uint64) | np.uint64(1)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_IS_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_power = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _power
    if len(_power) < n:
        _power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(2 * n, 256), _MULT[0], np.uint64)]))
    return _power[:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MULT[1]
    h = (h ^ (h >> np.uint64(29))) * _MULT[2]
    return h ^ (h >> np.uint64(32))


def word_hashes(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(_LOWER), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64)
    space = _IS_SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    length = ends - starts
    begun = np.zeros(len(data), np.int64)
    begun[starts] = starts
    place = np.arange(len(data)) - np.maximum.accumulate(begun)
    values = np.where(space, np.uint64(0), _BYTE[data] * _powers(int(place.max()) + 1)[place])
    return _mixed(np.add.reduceat(values, starts) + length.astype(np.uint64) * _MULT[3])


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles."""
    w = word_hashes(text or "")
    if not len(w):
        return w
    k = min(n, len(w))
    h = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        h = (h ^ w[i:len(w) - k + 1 + i]) * _MULT[1]
        h ^= h >> np.uint64(30)
    return np.unique(_mixed(h))


# -- document frequencies

def _ranges(spark: SparkSession) -> int:
    """Ranges of the hash space, a power of two: more partitions, smaller ranges."""
    return 1 << max(8, int(np.ceil(np.log2(4 * shuffle_partitions(spark)))))


def frequencies(docs: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bitmap of the shingles with two documents or more, and the most frequent ones (top 40 bits) with their counts."""
    spark = docs.sparkSession
    ranges = _ranges(spark)
    shift = np.uint64(64 - int(np.log2(ranges)))
    drop = np.uint64(int(shift) - 32)

    def send(parts: list[np.ndarray]) -> pa.RecordBatch:
        keys = np.sort(np.concatenate(parts))
        at = np.searchsorted((keys >> shift).astype(np.int64), np.arange(ranges + 1))
        low = ((keys >> drop) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        used = [r for r in range(ranges) if at[r] < at[r + 1]]
        planes = []
        for r in used:  # differences of sorted numbers, one plane per byte: the high planes compress away
            d = np.diff(low[at[r]:at[r + 1]], prepend=np.uint32(0)).astype("<u4")
            planes.append(np.ascontiguousarray(d.view(np.uint8).reshape(-1, 4).T).tobytes())
        return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(planes, pa.binary())], names=["range", "keys"])

    def sort_out(batches):
        parts, held = [], 0
        for b in batches:
            for t in b.column(0).to_pylist():
                s = shingles(t, n)
                if len(s):
                    parts.append(s)
                    held += len(s)
            if held >= BUFFER:
                yield send(parts)
                parts, held = [], 0
        if parts:
            yield send(parts)

    slice_bits = BITMAP_BITS - int(np.log2(ranges))
    most = max(16, 2 * HEAVY // ranges)

    def count(group: pd.DataFrame) -> pd.DataFrame:
        keys = []
        for k in group["keys"]:
            d = np.ascontiguousarray(np.frombuffer(k, np.uint8).reshape(4, -1).T).view("<u4").ravel()
            keys.append(np.cumsum(d, dtype=np.uint32))
        found, times = np.unique(np.concatenate(keys), return_counts=True)
        twice = times > 1
        bits = np.zeros(1 << slice_bits, np.uint8)
        bits[found[twice] >> np.uint32(32 - slice_bits)] = 1
        found, times = found[times > 2], times[times > 2]
        if len(found) > most:
            top = np.argpartition(times, len(times) - most)[-most:]
            top.sort()
            found, times = found[top], times[top]
        r = int(group["range"].iloc[0])
        return pd.DataFrame({"range": [r], "bits": [np.packbits(bits).tobytes()], "found": [found.astype("<u4").tobytes()],
                             "times": [np.minimum(times, 0xFFFFFFFF).astype("<u4").tobytes()]})
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    counted = texts.mapInArrow(sort_out, "range int, keys binary").groupBy("range").applyInPandas(
        count, "range int, bits binary, found binary, times binary").collect()  # one row a range, of bounded size
    bitmap = np.zeros((ranges, (1 << slice_bits) // 8), np.uint8)
    heavy, times = [], []
    for r in sorted(counted, key=lambda r: r["range"]):
        bitmap[r["range"]] = np.frombuffer(r["bits"], np.uint8)
        heavy.append((np.uint64(r["range"]) << np.uint64(32)) | np.frombuffer(r["found"], "<u4").astype(np.uint64))
        times.append(np.frombuffer(r["times"], "<u4"))
    heavy = np.concatenate(heavy) if heavy else np.zeros(0, np.uint64)
    times = np.concatenate(times) if times else np.zeros(0, np.uint32)
    if len(heavy) > HEAVY:
        top = np.sort(np.argpartition(times, len(times) - HEAVY)[-HEAVY:])
        heavy, times = heavy[top], times[top]
    return bitmap.ravel(), heavy, times


class Order:
    """The global order of shingles, as far as the frequencies tell."""

    def __init__(self, bitmap: np.ndarray, heavy: np.ndarray, times: np.ndarray, ranges: int):
        self.bitmap, self.heavy, self.times = bitmap, heavy, times
        self.shift = np.uint64(64 - int(np.log2(ranges)) - 32)

    def counts(self, s: np.ndarray) -> np.ndarray:
        """Known document frequency: 0 for single ones, 2 for twice or more, the count for heavy ones."""
        at = s >> np.uint64(64 - BITMAP_BITS)
        hit = (self.bitmap[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & np.uint8(1)
        out = hit.astype(np.int64) * 2
        own = np.flatnonzero(hit)
        if len(own) and len(self.heavy):
            key = s[own] >> self.shift
            i = np.minimum(np.searchsorted(self.heavy, key), len(self.heavy) - 1)
            same = self.heavy[i] == key
            out[own[same]] = self.times[i[same]]
        return out


def needed(n: int, num: int, den: int) -> int:
    """Shingles that a partner of a document with n must share at least."""
    return -(-num * n // den)


def prefix(s: np.ndarray, order: Order, num: int, den: int) -> tuple[int, list[tuple[int, int, int]]]:
    """l, and (shingle, level, salts) of the postings; a shingle of level k belongs to the k-prefix and longer ones."""
    n = len(s)
    t = needed(n, num, den)
    base = n - t + 1
    count = order.counts(s)
    if np.count_nonzero(count == 0) >= base:
        return 1, []
    by = np.lexsort((s, count))
    most = min(MOST_MATCHES, t)
    sums = np.cumsum(count[by[:base + most - 1]])[base - 1:]
    match = np.arange(1, len(sums) + 1)
    cost = sums * (1 + VERIFY_COST / match ** 2)
    l = int(np.argmin(cost)) + 1
    out = []
    for place, i in enumerate(by[:base + l - 1].tolist()):
        if count[i]:
            out.append((int(s[i].astype(np.int64)), max(1, place - base + 2), int(count[i]) // SPLIT))
    return l, out


def _signature(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def _prefix_table(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """doc_id, n, sig, l, tokens, levels, salts of every row."""
    spark = docs.sparkSession
    bitmap, heavy, times = frequencies(docs, n)
    shared = spark.sparkContext.broadcast(Order(bitmap, heavy, times, _ranges(spark)))

    def rows(batches):
        order = shared.value
        for b in batches:
            out = []
            for t in b.column(1).to_pylist():
                s = shingles(t, n)
                if len(s):
                    l, post = prefix(s, order, num, den)
                    out.append((len(s), _signature(s), l, [p[0] for p in post], [p[1] for p in post], [p[2] for p in post]))
                else:
                    out.append((0, None, 0, [], [], []))
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.int32()),
                 pa.array(cols[3], pa.list_(pa.int64())), pa.array(cols[4], pa.list_(pa.int32())), pa.array(cols[5], pa.list_(pa.int32()))],
                names=["doc_id", "n", "sig", "l", "tokens", "levels", "salts"])
    return docs.mapInArrow(rows, "doc_id long, n long, sig binary, l int, tokens array<long>, levels array<int>, salts array<int>")


# -- candidates

def _list_edges(num: int, den: int):
    """Candidate edges from postings sorted by (token, salt, n, rep): (a, b, matches asked for; 0 for a star's edge)."""
    def emit(lst, out):
        for i, (rep, size, l, level) in enumerate(lst):
            for other, other_size, other_l, other_level in lst[:i]:
                ask = min(l, other_l)
                if num * size <= den * other_size and level <= ask and other_level <= ask:
                    out.append((min(rep, other), max(rep, other), ask))

    def edges(batches):
        key, held, centre, last = None, [], None, 0
        for b in batches:
            out = []
            for token, salt, size, rep, l, level in zip(*(c.to_pylist() for c in b.columns)):
                if (token, salt) != key or (not salt and num * size > den * last):  # sizes beyond the gap can't link
                    if centre is None:
                        emit(held, out)
                    key, held, centre = (token, salt), [], None
                    if salt:
                        centre = rep
                last = size
                if centre is None:
                    held.append((rep, size, l, level))
                    if len(held) > SHORT:
                        centre = held[0][0]
                        out += [(centre, r, 0) for r, *_ in held[1:] if r != centre]
                        held = []
                elif rep != centre:
                    out.append((centre, rep, 0))
            if out:
                yield _edge_batch(out)
        out = []
        if centre is None:
            emit(held, out)
        if out:
            yield _edge_batch(out)
    return edges


def _edge_batch(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b", "ask"])


def _candidates(classes: DataFrame, num: int, den: int) -> DataFrame:
    """Candidate edges (a, b) between class representatives."""
    spark = classes.sparkSession
    posts = classes.filter(F.size("tokens") > 0).select(
        "rep", "n", "l", "sig", F.explode(F.arrays_zip("tokens", "levels", "salts")).alias("p"))
    salt = F.when(F.col("p.salts") > 0, 1 + F.pmod(F.xxhash64("sig"), F.col("p.salts") + 1)).otherwise(0).cast("int")
    posts = posts.select(F.col("p.tokens").alias("token"), salt.alias("salt"), "n", "rep", "l", F.col("p.levels").alias("level"))
    parts = shuffle_partitions(spark)
    edges = posts.repartition(parts, "token", "salt").sortWithinPartitions("token", "salt", "n", "rep").mapInArrow(
        _list_edges(num, den), "a long, b long, ask long")
    # the parts of a split list are joined by their smallest representatives
    centres = posts.filter("salt > 0").groupBy("token", "salt").agg(F.min_by("rep", F.struct("n", "rep")).alias("centre"))
    first = centres.groupBy("token").agg(F.min("centre").alias("a"))
    between = centres.join(first, "token").filter("centre <> a").select("a", F.col("centre").alias("b"), F.lit(0).cast("long").alias("ask"))
    met = edges.unionByName(between).groupBy("a", "b").agg(F.count("*").alias("met"), F.min("ask").alias("ask"))
    return met.filter("met >= ask").select("a", "b")


# -- components

def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of the nodes of an undirected graph, by hooking and pointer jumping.

    Each round every node takes the smallest label among its neighbours, then its label's label. Labels are written
    to the shared folder after each round; hot nodes are pre-aggregated by the minimum.
    """
    edges = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    both = staged(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    labels = staged(least.select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "labels")
    while True:
        sent = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("seen"))
        hooked = labels.join(sent, "node").select("node", F.col("component").alias("old"), F.least("component", "seen").alias("component"))
        up = labels.select(F.col("node").alias("component"), F.col("component").alias("higher"))
        new = hooked.join(up, "component", "left").select("node", "old", F.coalesce("higher", "component").alias("component"))
        new = staged(new, "labels")
        if new.filter("old <> component").isEmpty():
            return new.select("node", "component")
        labels = new.select("node", "component")


# -- verification

def _linked(sets: list[np.ndarray], sizes: np.ndarray, left: np.ndarray, right: np.ndarray, num: int, den: int):
    """For each of ``left``: the members of ``right`` that it links with. Common shingles are counted by bit sets where the
    block's shingles are few and shared by many, else along their lists."""
    m = len(sets)
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(m), sizes)
    _, token, count = np.unique(tokens, return_inverse=True, return_counts=True)
    often = count[token] > 1
    number = np.cumsum(count > 1) - 1
    token, owner = number[token[often]], owner[often]
    v = int((count > 1).sum())
    words = -(-v // 64)
    in_right = np.zeros(m, bool)
    in_right[right] = True
    by_lists = float((count[count > 1].astype(float) ** 2).sum())  # steps through the lists of common shingles
    if m * words * 64 <= BIT_CELLS and m * m * words <= 20 * by_lists:
        bits = np.zeros((m, words * 64), np.uint8)
        bits[owner, token] = 1
        rows = np.packbits(bits, axis=1).view(np.uint64)
        del bits
        for i in left:
            yield i, _pass(np.bitwise_count(rows & rows[i]).sum(1, dtype=np.int64), sizes, i, in_right, num, den)
        return
    by_token = np.argsort(token, kind="stable")
    starts = np.searchsorted(token[by_token], np.arange(v + 1))
    owners = owner[by_token]
    by_owner = np.searchsorted(owner, np.arange(m + 1))
    for i in left:
        own = token[by_owner[i]:by_owner[i + 1]]
        lists = [owners[starts[t]:starts[t + 1]] for t in own]
        shared = np.bincount(np.concatenate(lists), minlength=m) if lists else np.zeros(m, np.int64)
        yield i, _pass(shared, sizes, i, in_right, num, den)


def _pass(shared, sizes, i, in_right, num, den) -> np.ndarray:
    ok = in_right & (den * shared >= num * (sizes + sizes[i] - shared))
    ok[i] = False
    return np.flatnonzero(ok)


def _verify(num: int, den: int):
    def task(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("sig").reset_index(drop=True)
        sets = [np.frombuffer(x, "<u8") for x in group["shingles"]]
        sizes = np.array([len(s) for s in sets], np.int64)
        copies, reps = group["copies"].to_numpy(), group["rep"].to_numpy()
        within = int(group["i"].iloc[0]) == int(group["j"].iloc[0])
        part = group["part"].to_numpy()
        left = np.arange(len(sets)) if within else np.flatnonzero(part == group["i"].iloc[0])
        right = np.arange(len(sets)) if within else np.flatnonzero(part == group["j"].iloc[0])
        links = np.zeros(len(sets), np.int64)
        root = np.arange(len(sets))

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x
        for i, others in _linked(sets, sizes, left, right, num, den):
            links[i] += copies[others].sum()
            if not within:
                links[others] += copies[i]
            a = find(i)
            for r in set(root[others].tolist()):
                b = find(r)
                if a != b:
                    a, b = min(a, b), max(a, b)
                    root[b] = a
        ends = np.array([find(x) for x in range(len(sets))], np.int64) if len(sets) else np.zeros(0, np.int64)
        return pd.DataFrame({"sig": group["sig"], "links": links, "a": reps[ends], "b": reps})
    return task


def _members_bitmap(members: DataFrame) -> np.ndarray:
    """Bitmap of the hashed ids of the candidates' representatives (2^25 bits): most other texts aren't cut again."""
    at = F.pmod(F.xxhash64("rep"), F.lit(1 << MEMBER_BITS))
    words = members.select((at / 32).cast("long").alias("word"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(rep), {1 << MEMBER_BITS}) % 32 as int))").alias("bit"))
    out = np.zeros((1 << MEMBER_BITS) // 32, np.uint32)
    got = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy().astype(np.uint32)
    return out


def _with_parts(members: DataFrame, num: int, den: int) -> DataFrame:
    """Adds the class's ``part`` of its block, and ``others``, the parts that it is compared with.

    A large block is split by bands of set size, and a large band by hash. Bands are as wide as the ratio of sizes that
    linked sets may have, so a part only meets those of its own band and of the two next to it."""
    width = max(math.log(den / num), 1e-6) * (1 + 1e-9)  # a trifle wider than the ratio: rounding can't skip a band
    members = members.withColumn("band", F.floor(F.log("n") / width))
    size = staged(members.groupBy("component", "band").agg(F.count("*").alias("rows"), F.sum("n").alias("total")), "block-sizes")
    whole = size.groupBy("component").agg(F.sum("rows").alias("rows"), F.sum("total").alias("total"))
    large = whole.filter((F.col("rows") > BLOCK_ROWS) | (F.col("total") > BLOCK_SHINGLES)).select("component")
    count = F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("total") / BLOCK_SHINGLES))
    split = size.join(large, "component").select("component", "band", count.alias("parts"))
    for name, step in (("below", 1), ("above", -1)):
        split = split.join(split.select("component", (F.col("band") + step).alias("band"), F.col("parts").alias(name)), ["component", "band"], "left")

    def parts(band: Column, n: Column) -> Column:
        return F.when(n > 0, F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda p: band * PARTS + p)).otherwise(F.array().cast("array<long>"))
    band, one = F.col("band"), F.col("parts").isNull()
    part = F.when(one, F.lit(0).cast("long")).otherwise(band * PARTS + F.pmod(F.xxhash64("sig"), F.col("parts")))
    others = F.concat(parts(band - 1, F.col("below")), parts(band, F.col("parts")), parts(band + 1, F.col("above")))
    members = members.join(staged(split, "block-parts"), ["component", "band"], "left")
    return members.select("sig", "rep", "copies", "component", part.alias("part"),
                          F.when(one, F.array(F.lit(0).cast("long"))).otherwise(others).alias("others"))


def jaccard_components(docs: DataFrame, n: int = 3, num: int = 90, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, n_links for every row of ``docs``."""
    spark = docs.sparkSession
    short_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    table = staged(_prefix_table(texts, n, num, den), "prefixes")
    linkable = table.filter("sig is not null and doc_id is not null")
    classes = staged(linkable.groupBy("sig").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("l").alias("l"),
                                                 F.first("tokens").alias("tokens"), F.first("levels").alias("levels"), F.first("salts").alias("salts")), "classes")
    blocks = components(_candidates(classes, num, den))
    members = staged(classes.select("sig", "rep", "copies", "n").join(blocks.withColumnRenamed("node", "rep"), "rep"), "members")
    shared = spark.sparkContext.broadcast(_members_bitmap(members))

    def cut(batches):
        bits = shared.value
        for b in batches:
            at = b.column(1).to_numpy()
            wanted = np.flatnonzero((bits[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1))
            if not len(wanted):
                continue
            ids, text = b.column(0).to_pylist(), b.column(2)
            sets = [(ids[i], shingles(text[i].as_py(), n)) for i in wanted.tolist()]
            sets = [(i, s) for i, s in sets if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in sets], pa.int64()), pa.array([_signature(s) for _, s in sets], pa.binary()),
                                              pa.array([s.astype("<u8").tobytes() for _, s in sets], pa.binary())], names=["rep", "sig", "shingles"])
    hashed = texts.filter("doc_id is not null").select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(1 << MEMBER_BITS)).alias("at"), "text")
    sets = hashed.mapInArrow(cut, "rep long, sig binary, shingles binary")
    rows = sets.join(_with_parts(members, num, den), ["rep", "sig"])
    tasks = rows.withColumn("other", F.explode("others")).select(
        "component", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "sig", "rep", "copies", "shingles")
    found = staged(tasks.groupBy("component", "i", "j").applyInPandas(_verify(num, den), "sig binary, links long, a long, b long"), "links")

    links = found.groupBy("sig").agg(F.sum("links").alias("links"))
    joined = components(found.filter("a <> b").select("a", "b"))
    result = classes.select("sig", "rep", "copies").join(links, "sig", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    result = staged(result.select("sig", "copies", F.coalesce("component", "rep").alias("component_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "classes-out")
    linked = join_groups(linkable.select("sig", "doc_id", "n"), result, "sig", "copies", table.count())
    alone = table.filter("sig is null or doc_id is null")
    return linked.select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links").unionByName(
        alone.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links")))


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the document of the smallest id of each component; all columns stay. Rows without an id stay."""
    found = jaccard_components(docs, n, num, den, id_col, text_col)
    drop = staged(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("__drop")).distinct(), "near-copies")
    return docs.join(drop, F.col(id_col).cast("long") == F.col("__drop"), "left_anti")


__all__ = ["components", "frequencies", "jaccard_components", "keep_one", "needed", "prefix", "shingles", "word_hashes"]
