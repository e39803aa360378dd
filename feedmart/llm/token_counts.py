"""Token counts of sentencepiece BPE models by a two-tier lookup of pre-token lengths.

The model's pieces hold white space marks only at their start and no line feed, so the number of tokens of a text
is the sum over its pre-tokens: a run of spaces with the word that follows, or a line feed. A first pass gives the
frequent pre-tokens of all documents as bounded summaries, one small row per task, merged FAN_IN by FAN_IN; the
TABLE most frequent ones and their lengths are broadcast (bounded: TABLE words of up to LONGEST
characters). In the second pass each task looks its pre-tokens up in that table, then in the worker's cache, and
encodes the rest with the model. No pre-token is shuffled. The counts don't depend on which
pre-tokens are in the table.

Defined results: null text counts as empty, an empty text has no tokens. Rows with equal ids stay
separate. Other columns are ignored. U+2581 in a text counts as a space, as the library takes it.
"""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import short_batches

TABLE = 32_768
SUMMARY = 16_384
COUNTING = 200_000
CACHE = 400_000
LONGEST = 48
FAN_IN = 64
MARK = "▁"
PIECE = re.compile(" *[^ \n]+| +|\n")


class PieceLengths:
    """Lengths of pre-tokens. Words after one space are looked up bare; other pre-tokens are kept with a line feed
    before them, which keeps the library from adding its own space."""

    def __init__(self, model: bytes, table: list[tuple[str, int]]):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces):
            raise ValueError("pieces of this model cross words or lines")
        self.table = dict(table)
        self.cache: dict[str, int] = {}

    def _encode(self, words: list[str]) -> None:
        """Into the cache; a word with a line feed first is counted without the added space and the line feed."""
        if len(self.cache) > CACHE:
            self.cache.clear()
        for w, ids in zip(words, self.model.encode(words, num_threads=1)):
            self.cache[w] = len(ids) - 2 * (w[0] == "\n")

    def count(self, texts: list[str]) -> list[int]:
        fixed, words, long, spans = [], [], [], []
        for t in texts:
            n, own = pre_tokens(t)
            fixed.append(n)
            spans.append(len(own))
            words += own
        get, cached = self.table.get, self.cache
        found = [get(w) for w in words]
        miss = [i for i, n in enumerate(found) if n is None]
        if miss:
            new = {words[i] for i in miss if words[i] not in cached}
            short = [w for w in new if len(w) <= LONGEST]
            long = {w: len(self.model.encode(w)) - 2 * (w[0] == "\n") for w in new if len(w) > LONGEST}
            known = {words[i]: cached[words[i]] for i in miss if words[i] in cached}
            self._encode(short)
            known |= {w: self.cache[w] for w in short} | long
            for i in miss:
                found[i] = known[words[i]]
        out, at = [], 0
        for n, k in zip(fixed, spans):
            out.append(n + sum(found[at:at + k]))
            at += k
        return out


_loaded: dict[int, PieceLengths] = {}


def loaded(model: bytes, table: list[tuple[str, int]]) -> PieceLengths:
    """One table, model and cache per Python worker, kept over its tasks."""
    key = hash((model, tuple(table)))
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = PieceLengths(model, table)
    return _loaded[key]


def pre_tokens(text: str) -> tuple[int, list[str]]:
    """Number of line feeds, and the other pre-tokens: a word that follows one space as it is, others with their
    spaces after a line feed."""
    if not text:
        return 0, []
    if MARK in text:
        text = text.replace(MARK, " ")
    lines = (" " + text).split("\n")
    words: list[str] = []
    for line in lines:
        if not line:
            continue
        if "  " in line or line[-1] == " ":
            for p in PIECE.findall(line):
                words.append(p[1:] if p[0] == " " and len(p) > 1 and p[1] != " " else "\n" + p)
        else:
            own = line.split(" ")
            if own[0]:
                own[0] = "\n" + own[0]
            else:
                del own[0]
            words += own
    return len(lines) - 1, words


def _top(counts: Counter, n: int) -> list[tuple[str, int]]:
    return sorted(counts.most_common(n), key=lambda x: (-x[1], x[0]))


def frequent(docs: DataFrame, text_col: str = "text") -> list[str]:
    """The TABLE most frequent pre-tokens by merged bounded summaries (each task counts COUNTING distinct ones at a
    time and passes on SUMMARY)."""
    short_batches(docs.sparkSession)

    def summary(batches):
        import pyspark

        counts: Counter = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                counts.update(w for w in pre_tokens(t)[1] if len(w) <= LONGEST)
            if len(counts) > COUNTING:
                counts = Counter(dict(counts.most_common(COUNTING // 4)))
        top = _top(counts, SUMMARY)
        yield pa.RecordBatch.from_pydict({"part": pa.array([pyspark.TaskContext.get().partitionId()], pa.int64()),
                                          "words": pa.array([[w for w, _ in top]]), "counts": pa.array([[n for _, n in top]], pa.list_(pa.int64()))})

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        counts: Counter = Counter()
        for w, n in zip(group["words"], group["counts"]):
            counts.update(dict(zip(w, n)))
        top = _top(counts, TABLE)
        return pd.DataFrame({"part": [int(group["part"].iloc[0]) // FAN_IN], "words": [[w for w, _ in top]], "counts": [[n for _, n in top]]})

    schema = "part long, words array<string>, counts array<long>"
    level = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = level.rdd.getNumPartitions()
    level = level.mapInArrow(summary, schema)
    while True:
        level = level.groupBy(F.floor(F.col("part") / FAN_IN).alias("to")).applyInPandas(merge, schema)
        if parts <= FAN_IN:
            break
        parts = -(-parts // FAN_IN)
    top = level.collect()  # one row
    return [w for r in top for w in r["words"]][:TABLE]


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit."""
    spark = docs.sparkSession
    short_batches(spark)
    with open(model_path, "rb") as f:
        model = f.read()
    words = frequent(docs, text_col)
    own = PieceLengths(model, [])
    own._encode(words)
    shared = spark.sparkContext.broadcast((model, [(w, own.cache[w]) for w in words]))

    def count(batches):
        lengths = loaded(*shared.value)
        for b in batches:
            n = lengths.count(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    out = rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


__all__ = ["PieceLengths", "frequent", "pre_tokens", "token_counts"]
