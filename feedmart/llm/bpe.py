"""Byte-level BPE: encoding of texts of any length by tree concatenation, and decoding.

A text of up to LEAF characters is encoded where it is read. A longer one is cut into leaves, wherever the cuts
fall; the leaves of all long texts are dealt out over the cluster and encoded in parallel. Then neighbours are
joined pairwise up a tree: the tokens around a join are re-encoded in a window that doubles until its
first tokens agree with the left part's and its last tokens with the right part's, MARGIN bytes away from
the join or more. BPE is local: a sequence is the encoding of its text when each pair of
neighbours is, so agreement at both ends of the window makes the spliced sequence exact. A window that
reaches both ends is the plain encoding of the whole.

The merges run in the public ``tiktoken`` library on the ranks read from the tokenizer's JSON file; the added
special tokens are found in the text first, as the ``tokenizers`` library does by default.

Defined results: null text counts as empty, an empty text has no tokens. Rows with equal ids stay separate.
Other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import short_batches, shuffle_partitions

LEAF = 32_768
WINDOW = 32
MARGIN = 24
# Fixed value: the pattern by which byte-level tokenizers of this kind split text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and the others as U+0100 onwards."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteBpe:
    """A byte-level BPE vocabulary from the text of a tokenizer's JSON file."""

    def __init__(self, spec: str):
        import tiktoken

        data = json.loads(spec)
        pre = data["pre_tokenizer"] or {}
        if data["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or data.get("normalizer") or pre.get("add_prefix_space"):
            raise ValueError("not a plain byte-level BPE tokenizer")
        of = _byte_of_char()
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        vocab = {w: i for w, i in data["model"]["vocab"].items() if w not in special}
        ranks = {bytes(of[c] for c in w): i for w, i in vocab.items()}
        if sorted(ranks.values()) != list(range(len(ranks))):
            raise ValueError("ids aren't the ranks of the merges")
        self.special = special
        self.core = tiktoken.Encoding("byte-bpe", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
        self._allowed = set(special)

    def encode(self, text: str) -> np.ndarray:
        return self.core.encode_to_numpy(text, allowed_special=self._allowed).astype("<u4", copy=False)

    def decode(self, ids: np.ndarray) -> bytes:
        return self.core.decode_bytes(ids.tolist())

    def text(self, ids: np.ndarray) -> str:
        return self.decode(ids).decode("utf-8", "replace")

    def _agree(self, a: np.ndarray, b: np.ndarray, least: int) -> bool:
        """True when a and b begin with two equal tokens at least and those cover up to ``least`` bytes at most."""
        return len(a) >= 2 and len(b) >= 2 and bool((a[:2] == b[:2]).all()) and len(self.decode(a[:2])) <= least

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The encoding of the text of ``left`` followed by that of ``right``."""
        if not len(left) or not len(right):
            return np.concatenate([left, right])
        k = WINDOW
        while True:
            i, j = max(0, len(left) - k), min(len(right), k)
            # the window begins and ends with whole characters
            while i > 0 and self.decode(left[i:i + 1])[0] & 0xC0 == 0x80:
                i -= 1
            while j < len(right) and self.decode(right[j:j + 1])[0] & 0xC0 == 0x80:
                j += 1
            a, b = left[i:], right[:j]
            head, tail = self.decode(a), self.decode(b)
            got = self.encode((head + tail).decode("utf-8"))
            left_ok = i == 0 or self._agree(got, a, len(head) - MARGIN)
            right_ok = j == len(right) or self._agree(got[::-1], b[::-1], len(tail) - MARGIN)
            if left_ok and right_ok:
                return np.concatenate([left[:i], got, right[j:]])
            k *= 2

    def tree(self, leaves: list[np.ndarray]) -> np.ndarray:
        while len(leaves) > 1:
            leaves = [self.join(*leaves[n:n + 2]) if n + 1 < len(leaves) else leaves[n] for n in range(0, len(leaves), 2)]
        return leaves[0] if leaves else np.zeros(0, "<u4")


_loaded: dict[int, ByteBpe] = {}


def loaded(spec: str) -> ByteBpe:
    """One vocabulary per Python worker."""
    key = hash(spec)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = ByteBpe(spec)
    return _loaded[key]


Row = Callable[[ByteBpe, int | None, np.ndarray], Iterator[tuple]]


def encoded(docs: DataFrame, spec_path: str, make: Row, schema: T.StructType, id_col: str = "doc_id",
            text_col: str = "text", leaf: int = LEAF) -> DataFrame:
    """``make(bpe, doc_id, ids)`` gives the result rows of a document from its token ids.

    The vocabulary file is read on the driver and broadcast (its size is that of the file, a few MB).
    """
    spark = docs.sparkSession
    short_batches(spark)
    with open(spec_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    arrow = pa.schema([(f.name, _arrow(f.dataType)) for f in schema])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def batch(out: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*out)) if out else [()] * len(arrow)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, arrow.types)], schema=arrow)

    def whole(batches):
        bpe = loaded(spec.value)
        for b in batches:
            out = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                out += make(bpe, i, bpe.encode(t))
            yield batch(out)

    def leaves(batches):
        bpe = loaded(spec.value)
        for b in batches:
            ids = [bpe.encode(t).tobytes() for t in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(ids, pa.binary())],
                                             names=["row", "doc_id", "pos", "ids"])

    def trees(batches):
        bpe = loaded(spec.value)
        row, doc, parts = None, None, []
        for b in batches:
            out = []
            for r, i, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist()):
                if r != row:
                    if parts:
                        out += make(bpe, doc, bpe.tree(parts))
                    row, doc, parts = r, i, []
                parts.append(np.frombuffer(ids, "<u4"))
            yield batch(out)
        if parts:
            yield batch(list(make(bpe, doc, bpe.tree(parts))))

    short = rows.filter(F.length("text") <= leaf).mapInArrow(whole, schema)
    cut = rows.filter(F.length("text") > leaf).withColumn("row", F.monotonically_increasing_id()).select(
        "row", "doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{leaf}}}"), F.lit(0))).alias("pos", "leaf"))
    n = shuffle_partitions(spark)
    parts = cut.repartition(n, "row", "pos").mapInArrow(leaves, "row long, doc_id long, pos int, ids binary")
    joined = parts.repartition(n, "row").sortWithinPartitions("row", "pos").mapInArrow(trees, schema)
    return short.unionByName(joined)


def _arrow(t: T.DataType) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(),
            "array<int>": pa.list_(pa.int32())}[t.simpleString()]


ROUND_TRIP = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])


def round_trip(docs: DataFrame, spec_path: str, id_col: str = "doc_id", text_col: str = "text", leaf: int = LEAF) -> DataFrame:
    """Number of tokens, digest of the ids, and digest of the text decoded from them."""
    from hashlib import sha256

    def make(bpe, doc_id, ids):
        yield doc_id, len(ids), sha256(ids.tobytes()).hexdigest(), sha256(bpe.text(ids).encode()).hexdigest()
    return encoded(docs, spec_path, make, ROUND_TRIP, id_col, text_col, leaf)


TOKENS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])


def encode(docs: DataFrame, spec_path: str, id_col: str = "doc_id", text_col: str = "text", leaf: int = LEAF) -> DataFrame:
    """doc_id and the token ids."""
    def make(_, doc_id, ids):
        yield doc_id, ids.astype("i4")
    return encoded(docs, spec_path, make, TOKENS, id_col, text_col, leaf)


def decode(tokens: DataFrame, spec_path: str, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """``tokens`` with the text of its ids; bytes that aren't UTF-8 become U+FFFD, null ids a null text."""
    spark = tokens.sparkSession
    short_batches(spark)
    with open(spec_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())

    def texts(col: pd.Series) -> pd.Series:
        bpe = loaded(spec.value)
        return col.map(lambda a: None if a is None else bpe.text(np.asarray(a, "<u4")))
    return tokens.withColumn(out_col, F.pandas_udf(texts, "string")(F.col(ids_col)))


__all__ = ["ByteBpe", "LEAF", "decode", "encode", "encoded", "loaded", "round_trip"]
