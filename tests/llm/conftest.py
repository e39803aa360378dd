import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF


EDGE_TEXTS = [
    None, "", " ", "\n\t ", "a", "a b", "  two  spaces ", "Ünï cödé — 日本語 テキスト 🎉🎉", "x" * 70_000, "ab " * 30_000,
    "▁ marked ▁▁ text", "<|endoftext|>a<|endoftext|> <|endoftext|>", "don't we'll 'r 're", "tabs\tand\r\nlines\x0b\x0c.",
    "one two three one two three", "one two three one two three", " nbsp em", "12345678901234567890" * 10,
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns whose names operators use themselves."""
    rows = [(i, t, i % 3, f"g{i % 2}") for i, t in enumerate(EDGE_TEXTS)]
    rows += [(4, "a", 9, None), (None, "no id", None, "x"), (4, "a", 9, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, row int, ids string")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string")
