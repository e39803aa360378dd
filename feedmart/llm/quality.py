"""Quality classifier: a factorisation machine over hashed words, structure statistics and text metadata.

The score of a feature vector x is ``sigmoid(b + w.x + 1/2 * sum_f [(v_f.x)^2 - v_f^2.x^2])``: all pairwise interactions
of rank FACTORS, in time linear in the features by the sum-of-squares identity. Features: distinct words
hashed to WORDS slots with log counts of unit length, and one-hot bins of structure statistics (case, digit,
symbol and white-space shares, word lengths, repeated words and lines, word endings) and metadata (characters,
lines, words).

The model is fitted on the driver with Adagrad from a sample of labelled rows bounded by ``train_rows``,
the rows with the smallest hash of their id. Labels are read from rows whose ``crc32(id as text) mod 5`` isn't 0 only.
Scoring reads each text once where it lies; the model (about 0.5 MB whatever the input) is broadcast.

Defined results: null text counts as empty, an empty text gets the score of its statistics. A null id counts as
the empty string for the fold. Without usable labels every score is 0.5; with one class the bias follows it.
A document with contradictory labels trains with the lower one, an id with several texts with the smallest. Other columns are ignored by ``score`` and kept
by ``keep_good``.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import short_batches

WORDS = 1 << 13
BINS = 16
FACTORS = 6
TRAIN_ROWS = 6000
THRESHOLD = 0.3
STATS_NORM = 2.0
LEAST_STEPS = 300
STATS = ("upper", "digit", "symbol", "space", "other", "word_length", "distinct_words", "top_word", "endings",
         "symbol_words", "upper_words", "repeated_lines", "line_length", "log_chars", "log_lines", "log_words")
SIZE = WORDS + BINS * len(STATS)

_KINDS = np.zeros(0x250, np.int8)
for _c in range(0x250):
    _ch = chr(_c)
    _KINDS[_c] = 1 if _ch.isupper() else 2 if _ch.isdigit() else 3 if _ch.isspace() else 0 if _ch.isalpha() else 4


def statistics(text: str, words: Counter, n_words: int) -> np.ndarray:
    """The structure statistics, each scaled to 0..1."""
    n = len(text)
    if not n:
        return np.zeros(len(STATS))
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = np.bincount(_KINDS[np.minimum(points, 0x24F)], minlength=5) / n
    lines = Counter(line for line in text.split("\n") if line)
    n_lines = sum(lines.values()) or 1
    k = max(1, n_words)
    ends = Counter()
    symbols = upper = 0
    for w, c in words.items():
        if not w[-1].isalnum():
            ends[w[-2:]] += c
            symbols += c
        if w.isupper():
            upper += c
    top_end = max(ends.values(), default=0)
    return np.array([kinds[1], kinds[2], kinds[4], kinds[3], float((points > 0x24F).mean()), min(1, (n - n_words) / k / 16),
                     len(words) / k, max(words.values(), default=0) / k, top_end / k, symbols / k, upper / k,
                     1 - len(lines) / n_lines, min(1, n / n_lines / 2000), min(1, np.log1p(n) / 16),
                     min(1, np.log1p(n_lines) / 12), min(1, np.log1p(k) / 14)])


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values."""
    words = Counter(text.split())
    slots = Counter()
    for w, c in words.items():
        slots[crc32(w.encode("utf-8", "surrogatepass")) % WORDS] += c
    idx = np.fromiter(slots.keys(), np.int32, len(slots))
    val = np.log1p(np.fromiter(slots.values(), np.float64, len(slots)))
    if len(val):
        val /= np.sqrt((val ** 2).sum())
    stats = np.clip(np.sqrt(statistics(text, words, sum(words.values()))), 0, 1)  # finer bins near 0
    bins = np.minimum((stats * BINS).astype(np.int32), BINS - 1) + WORDS + BINS * np.arange(len(STATS), dtype=np.int32)
    return np.concatenate([idx, bins.astype(np.int32)]), np.concatenate([val, np.full(len(bins), STATS_NORM / np.sqrt(len(bins)))])


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def margin(self, idx: np.ndarray, val: np.ndarray) -> float:
        v = self.factors[idx] * val[:, None]
        return float(self.bias + self.linear[idx] @ val + 0.5 * ((v.sum(0) ** 2).sum() - (v ** 2).sum()))

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(*features(text)), -30, 30))))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 8, batch: int = 32, rate: float = 0.15,
          decay: float = 1e-5, seed: int = 7) -> Machine:
    rng = np.random.default_rng(seed)
    m = Machine(0.0, np.zeros(SIZE), rng.normal(0, 0.05, (SIZE, FACTORS)))
    if not len(rows):
        m.factors[:] = 0
        return m
    share = np.clip(labels.mean(), 0.001, 0.999)
    m.bias = float(np.log(share / (1 - share)))
    if labels.min() == labels.max():
        m.factors[:] = 0
        return m
    seen_w, seen_v = np.full(SIZE, 1e-6), np.full((SIZE, FACTORS), 1e-6)
    for _ in range(max(epochs, -(-LEAST_STEPS * batch // len(rows)))):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            part = order[at:at + batch]
            idx = np.concatenate([rows[r][0] for r in part])
            val = np.concatenate([rows[r][1] for r in part])
            starts = np.cumsum([0] + [len(rows[r][0]) for r in part[:-1]])
            doc = np.repeat(np.arange(len(part)), [len(rows[r][0]) for r in part])
            vx = m.factors[idx] * val[:, None]
            total = np.add.reduceat(vx, starts)
            margin = m.bias + np.add.reduceat(m.linear[idx] * val, starts) + 0.5 * ((total ** 2).sum(1) - np.add.reduceat((vx ** 2).sum(1), starts))
            slope = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[part]
            slots, back = np.unique(idx, return_inverse=True)
            g = slope[doc] * val
            gw = np.bincount(back, g, len(slots)) + decay * m.linear[slots]
            gv = np.stack([np.bincount(back, g * (total[doc, f] - vx[:, f]), len(slots)) for f in range(FACTORS)], 1) + decay * m.factors[slots]
            seen_w[slots] += gw ** 2
            seen_v[slots] += gv ** 2
            m.linear[slots] -= rate * gw / np.sqrt(seen_w[slots])
            m.factors[slots] -= 0.3 * rate * gv / np.sqrt(seen_v[slots])
            m.bias -= 0.02 * float(slope.mean())
    return m


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        train_rows: int = TRAIN_ROWS) -> Machine:
    """Fit on at most ``train_rows`` labelled documents outside the held-out fold."""
    short_batches(docs.sparkSession)
    usable = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    usable = usable.filter(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    sample = usable.groupBy("id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(train_rows)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(sample), "id").groupBy("id", "label").agg(F.min("text").alias("text"))

    def extract(batches):
        for b in batches:
            rows = [features(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("label"), pa.array([i for i, _ in rows], pa.list_(pa.int32())), pa.array([v for _, v in rows], pa.list_(pa.float64()))],
                names=["id", "label", "idx", "val"])
    got = found.mapInArrow(extract, "id long, label int, idx array<int>, val array<double>").toArrow().sort_by("id")
    rows = [(np.asarray(i.values), np.asarray(v.values)) for i, v in zip(got.column("idx"), got.column("val"))]
    return train(rows, got.column("label").to_numpy().astype(float))


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted."""
    short_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(machine)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def scored(batches):
        for b in batches:
            s = [model.value.score(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s, pa.float64())], names=["doc_id", "score"])
    out = rows.mapInArrow(scored, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, machine: Machine, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that the classifier rejects; all columns stay."""
    short_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(machine)
    at = docs.columns.index(text_col)

    def kept(batches):
        for b in batches:
            ok = [model.value.score(t or "") >= THRESHOLD for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(ok))
    return docs.mapInArrow(kept, docs.schema)


__all__ = ["Machine", "TRAIN_ROWS", "features", "fit", "held_out", "keep_good", "score", "train"]
