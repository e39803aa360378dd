"""Document fingerprints: digests of content-defined chunks, weighted by length, measure containment.

A gear hash of the last WINDOW bytes is kept at each byte of the UTF-8 text. A chunk ends where the hash
has zero bits under a mask; normalised chunking takes the stricter mask up to the NORMAL size and the
looser one beyond it, never before LEAST or after MOST bytes, so that sizes gather around NORMAL. An
insertion or deletion moves only the boundaries near it. The fingerprint lists each distinct chunk's
digest (32 bits of xxHash64) with the bytes it covers; the likeness of a text to another is the share
of its bytes whose chunks the other has as well, the smaller weight counting.

Edited texts take the beginning of the following document by id. Documents are dealt out by ranges
of ids, each range with the first document of the following one, and read in order: one shuffle of the texts, and
no window over the whole table.

Defined results: null text counts as empty. An empty text is like an empty one (1) and unlike any other (0). Rows
with equal ids follow each other by text; a null id comes first. A single row is its own successor. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import short_batches, shuffle_partitions

LEAST, NORMAL, MOST = 12, 40, 160
WINDOW = 16
STRICT, LOOSE = 0b1111110 << 8, 0b1110 << 8
RANGES_PER_TASK = 4
IDS_PER_RANGE = 50
_gear = np.random.default_rng(20240607).integers(0, 1 << 16, 256, dtype=np.uint16)


def gear(data: bytes) -> np.ndarray:
    """Low 16 bits of the gear hash at each byte: sum of table[byte j back] << j, by doubling the window."""
    h = _gear[np.frombuffer(data, np.uint8)]
    step = 1
    while step < WINDOW:
        nxt = h.copy()
        nxt[step:] += h[:-step] << np.uint16(step)
        h, step = nxt, step * 2
    return h


def boundaries(data: bytes) -> list[int]:
    """Ends of the chunks."""
    n = len(data)
    h = gear(data)
    loose = np.flatnonzero((h & np.uint16(LOOSE)) == 0) + 1
    strict = loose[(h[loose - 1] & np.uint16(STRICT)) == 0].tolist()
    loose = loose.tolist()
    ends, at, i, j = [], 0, 0, 0
    n_strict, n_loose = len(strict), len(loose)
    while n - at > LEAST:
        first, normal, last = at + LEAST, at + NORMAL, min(n, at + MOST)
        while i < n_strict and strict[i] < first:
            i += 1
        if i < n_strict and strict[i] <= normal:
            at = strict[i]
        else:
            while j < n_loose and loose[j] <= normal:
                j += 1
            at = loose[j] if j < n_loose and loose[j] < last else last
        ends.append(at)
    if at < n:
        ends.append(n)
    return ends


def chunk_weights(text: str) -> Counter:
    """Bytes covered by each chunk digest."""
    data = text.encode("utf-8", "surrogatepass")
    weights: Counter = Counter()
    start = 0
    for end in boundaries(data):
        weights[xxhash.xxh64_intdigest(data[start:end]) & 0xFFFFFFFF] += end - start
        start = end
    return weights


def fingerprint(weights: Counter) -> str:
    return ",".join(f"{d:08x}:{w:x}" for d, w in sorted(weights.items()))


def containment(own: Counter, other: Counter) -> float:
    total = sum(own.values())
    if not total:
        return 0.0 if other else 1.0
    small, large = (own, other) if len(own) <= len(other) else (other, own)
    return sum(min(w, large[d]) for d, w in small.items() if d in large) / total


def edited(text: str, following: str) -> str:
    """The last quarter of the code points is replaced by as many of the next text's first."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
_arrow = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _row(doc_id, text, weights, following, next_weights) -> tuple:
    changed = edited(text, following)
    new = chunk_weights(changed)
    return (doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), fingerprint(weights),
            fingerprint(new), containment(weights, new), containment(weights, next_weights))


def _compare(batches):
    """Rows by range and order; the last of each range is the first document of the following range."""
    held = None
    for b in batches:
        out = []
        for place, extra, doc_id, text in zip(*(c.to_pylist() for c in b.columns)):
            if held is not None and held[0] != place:
                held = None
            if held is not None and held[1]:
                continue  # further rows with the id of the extra one
            weights = chunk_weights(text)
            if held is not None:
                out.append(_row(*held[2:], text, weights))
            held = (place, extra, doc_id, text, weights)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _arrow.types)], schema=_arrow)


def ordered_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """place, extra, doc_id, text: every document in its range, and the first of each range also at the end of the
    range before (of the last, if it is the first of all). The driver gets about IDS_PER_RANGE ids per range, and each range's smallest."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = RANGES_PER_TASK * shuffle_partitions(spark)
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    # like range partitioning: the cuts come from a sample of bounded size; they decide about balance only
    share = min(1.0, IDS_PER_RANGE * n / max(1, rows.count()))
    ids = np.sort(rows.select(key.alias("k")).sample(share, 17).toArrow().column("k").to_numpy())
    cuts = np.unique(ids[[len(ids) * i // n for i in range(1, n)]]) if len(ids) else ids

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ids.to_numpy(np.int64), "right"), dtype="int32")
    firsts = rows.select(key.alias("k")).groupBy(place("k").alias("place")).agg(F.min("k").alias("first")).orderBy("place").collect()
    before = {r["first"]: firsts[i - 1]["place"] for i, r in enumerate(firsts)}
    ids = np.array(sorted(before), np.int64)
    places = np.array([before[i] for i in ids.tolist()], np.int32)

    @F.pandas_udf("array<int>")
    def both(keys: pd.Series) -> pd.Series:
        k = keys.to_numpy(np.int64)
        own = np.searchsorted(cuts, k, "right")
        at = np.minimum(np.searchsorted(ids, k), max(0, len(ids) - 1))
        return pd.Series([[o, int(places[a])] if ids[a] == i else [o] for i, o, a in zip(k.tolist(), own.tolist(), at.tolist())])
    dealt = rows.select(both(key).alias("places"), "doc_id", "text")
    dealt = dealt.select(F.posexplode("places").alias("extra", "place"), "doc_id", "text")
    return dealt.select("place", "extra", "doc_id", "text").repartition(shuffle_partitions(spark), "place").sortWithinPartitions(
        "place", "extra", F.col("doc_id").asc_nulls_first(), "text")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    short_batches(docs.sparkSession)
    return ordered_ranges(docs, id_col, text_col).mapInArrow(_compare, SCHEMA)


__all__ = ["boundaries", "chunk_weights", "containment", "edited", "fingerprint", "fingerprints", "gear", "ordered_ranges"]
