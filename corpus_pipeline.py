"""Training-data pipeline over ``documents``: five stages, each written as Parquet and read again as the next one's input.

1. ``quality``: documents that the quality classifier rejects go.
2. ``exact_dedup``: of equal texts, white space aside, the longest original stays (then the smallest id).
3. ``near_dedup``: of each component of documents linked by five-word shingles with a Jaccard similarity of 0.8 or more, the
   smallest id stays.
4. ``pii``: personal data in the texts is replaced by its kind; ``n_chars`` follows.
5. ``packing``: the texts' tokens are packed into sequences; one row per piece.

The first four return the columns of ``documents``. A null text counts as empty and stays null; an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedmart.llm import exact_dedup, ngram_join, packing, pii, quality
from feedmart.llm.common import staged, table
from feedmart.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs, n=5, num=80, den=100)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

# The classifier, the tokenizer and the packing can't be written in SQL; tests/llm/test_pipeline.py has the brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
