"""Ids against the published library, and round trips."""

import hashlib
import random

import numpy as np
import pytest
import tiktoken

from tidegrid.llm import bpe


@pytest.fixture(scope="module")
def model():
    return bpe.load(*bpe.multilingual())


@pytest.fixture(scope="module")
def library(model):
    return tiktoken.Encoding("own", pat_str=bpe.multilingual()[1], mergeable_ranks=model.ranks, special_tokens={})


def texts():
    rng = random.Random(3)
    yield from ["", " ", "a" * 20_000, "ab" * 9_000, "\n \n\t  x", "\x1c x\x85y᠎z", "日本語テキスト" * 300, "<|endoftext|>", "é" * 5000]
    for _ in range(500):
        yield "".join(rng.choice("abcdefgh  \n'st.,!éß日\U0001f600١²́") for _ in range(rng.randint(0, 80)))
    newer = [chr(int(x, 16)) for r in bpe.NEWER.split() for x in r.split("-")]
    for _ in range(300):
        yield "".join(rng.choice([*newer, "a", "b ", " 1", "."]) for _ in range(12))
    for _ in range(200):
        yield "".join(chr(rng.choice([rng.randrange(0x20, 0x250), rng.randrange(0x370, 0xD7FF)])) for _ in range(40))


def test_ids_equal_the_library(model, library):
    for text in texts():
        ids = model.encode(text)
        assert ids == library.encode_ordinary(text), text[:40]
        assert model.decode(ids) == text.encode()


def test_store_of_matches_is_emptied_when_full(model, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_SIZE", 3)
    text = " ".join(f"word{i}x" for i in range(50))
    assert model.encode(text) == library.encode_ordinary(text)


def test_columns(docs_of, library):
    rows = [(1, "ab cd"), (1, "ab cd"), (None, None), (3, ""), (4, "x" * 5000 + " é")]
    docs = docs_of(rows, "n_tokens")
    out = bpe.encode_column(docs, *bpe.multilingual())
    assert out.columns == [*docs.columns, "n_tokens_", "ids_sha256", "decoded_sha256", "ids"]
    got = out.collect()
    assert len(got) == len(rows)
    for row in got:
        text = row["text"] or ""
        ids = library.encode_ordinary(text)
        assert row["ids"] == ids and row["n_tokens_"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode_column(docs.limit(0), *bpe.multilingual()).collect() == []


def test_query_equals_the_library(spark, documents, library):
    got = {r["doc_id"]: r for r in bpe.op9(spark, "/root/testdata/sf0.001").collect()}
    rows = documents.collect()
    assert len(got) == len(rows)
    for row in rows:
        ids = library.encode_ordinary(row["text"])
        assert got[row["doc_id"]]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
