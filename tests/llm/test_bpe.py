"""Byte-level BPE against the tokenizer applied to whole texts."""

import hashlib

import public_tokenizers
import pytest

from caretide.llm import bpe

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
HARD = [
    (10001, None), (10002, ""), (10003, "x" * 3000 + " 'redo  \n\n y" * 200),
    (10004, "a" * 50 + "\n" * 900 + " b" + "é" * 700 + " " * 300 + "!?" * 300),
    (10005, "'" * 700 + "re" * 300), (10006, "日本語 " * 400), (10006, "日本語 " * 400),
    (None, "it's we're 12 345" * 90),
]


def expected(rows):
    encoding = bpe.tokenizer(RANKS, PATTERN)
    out = []
    for doc_id, text in rows:
        ids = encoding.encode_ordinary(text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        raw = hashlib.sha256((text or "").encode()).hexdigest()
        out.append((doc_id, len(ids), digest, raw))
    return sorted(out, key=repr)


def result(df, **limits):
    coded = bpe.decode(bpe.encode(df, RANKS, PATTERN, **limits), RANKS)
    return sorted((tuple(r) for r in bpe.digests(coded).collect()), key=repr)


@pytest.mark.parametrize("chunk, overlap", [(200, 64), (100, 100), (64, 16), (32_768, 1_024)])
def test_any_chunks_give_the_whole_texts_ids(spark, chunk, overlap):
    df = spark.createDataFrame(HARD, "doc_id long, text string").repartition(3)
    assert result(df, chunk=chunk, overlap=overlap) == expected(HARD)


def test_clashing_columns_and_copies(docs, rows):
    assert result(docs, chunk=100, overlap=40) == expected(rows)


def test_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert result(documents) == expected(rows)


def test_empty(none):
    assert result(none) == []
