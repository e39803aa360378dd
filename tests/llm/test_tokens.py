"""Token operators against the libraries themselves."""

import random
from hashlib import sha256

import numpy as np
import pytest

from feedmart.llm import bpe, queries, token_counts
from feedmart.llm.common import table

tokenizers = pytest.importorskip("tokenizers")
JSON = queries.tokenizer_path("byte_bpe_50k.json")
MODEL = queries.tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def own():
    return bpe.ByteBpe(open(JSON, encoding="utf-8").read())


def _digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256(decoded.encode()).hexdigest()


def test_round_trip_query_equals_library(spark, sf_dir, library):
    rows = table(spark, sf_dir, "documents").collect()
    want = sorted((r.doc_id, *_digests(library, r.text)) for r in rows)
    assert sorted(map(tuple, queries.op5_bpe(spark, sf_dir).collect())) == want


@pytest.mark.parametrize("leaf", [7, 1000, bpe.LEAF])
def test_round_trip_edges(edge_docs, library, leaf):
    docs = edge_docs if leaf > 500 else edge_docs.filter("text is null or length(text) < 3000")
    want = sorted(((r.doc_id, *_digests(library, r.text)) for r in docs.collect()), key=str)
    assert sorted(map(tuple, bpe.round_trip(docs, JSON, leaf=leaf).collect()), key=str) == want


def test_empty_table(no_docs):
    assert bpe.round_trip(no_docs, JSON).count() == 0
    assert token_counts.token_counts(no_docs, MODEL).count() == 0


def test_tree_joins_any_cut(own):
    """Random cuts through words, contractions, special tokens, white space and runs without a break."""
    rng = random.Random(5)
    alphabets = ["ab", "abcdefghij'ls tre", " \n\t x", "12 3a", "é日🎉a ", "aaaaaaab", "<|endoftext|> x"]
    for n in range(300):
        alphabet = alphabets[n % len(alphabets)]
        if "<" in alphabet:
            text = "".join(rng.choice(["<|endoftext|>", "<|endo", "x ", "ftext|>", "abc"]) for _ in range(rng.randint(1, 60)))
        else:
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 900)))
        size = rng.choice([3, 17, 60, 250])
        leaves = [own.encode(text[i:i + size]) for i in range(0, len(text), size)]
        assert own.tree(leaves).tolist() == own.encode(text).tolist(), (text, size)


def test_encode_and_decode_tables(edge_docs, library):
    got = bpe.decode(bpe.encode(edge_docs, JSON), JSON).collect()
    want = {(r.doc_id, r.text or "") for r in edge_docs.collect()}
    assert {(r.doc_id, r.text) for r in got} == want


def _pieces(model, text):
    return len(model.encode(text or ""))


def test_token_counts_equal_library(spark, sf_dir, edge_docs):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = table(spark, sf_dir, "documents")
    want = sorted((r.doc_id, len(r.text.encode()), n, n > 4096) for r in docs.collect() for n in [_pieces(model, r.text)])
    assert sorted(map(tuple, queries.op6_token_counts(spark, sf_dir).collect())) == want
    want = sorted(((r.doc_id, len((r.text or "").encode()), n, n > 4096) for r in edge_docs.collect() for n in [_pieces(model, r.text)]), key=str)
    assert sorted(map(tuple, token_counts.token_counts(edge_docs, MODEL).collect()), key=str) == want


def test_pre_tokens_of_random_text():
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    lengths = token_counts.PieceLengths(open(MODEL, "rb").read(), [("the", len(model.encode("the")))])
    rng = random.Random(3)
    texts = ["".join(rng.choice(["the", " ", "  ", "\n", "ab", "é", "▁", "<s>", "\t", "9", "日本", ","]) for _ in range(rng.randint(0, 40))) for _ in range(500)]
    assert lengths.count(texts) == [_pieces(model, t) for t in texts]
