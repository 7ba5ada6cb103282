"""Counts against the published unigram tokenizer, with many ties, and rows out of the ordinary."""

import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer, models

from tidegrid.llm import tokencount as tc

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def published():
    pieces = tc.vocabulary(sentencepiece.SentencePieceProcessor(model_file=PATH))
    tokenizer = Tokenizer(models.Unigram(pieces, unk_id=[p for p, _ in pieces].index("<unk>")))
    return counter(tokenizer)


def counter(tokenizer):
    return lambda t: len(tokenizer.encode(tc.META + t.replace(" ", tc.META)).ids) if t else 0


def test_counts_equal_the_tokenizer(published):
    rng = random.Random(1)
    model = tc.load(PATH)
    texts = ["", " ", "a" * 3000, "  " * 900, "ሴ" * 50, "ሴ ሴ aሴሴb", "▁a ▁", "x\ny\tz"]
    texts += ["".join(rng.choice("abcdefgh   the\n'st.,!éß日\U0001f600▁²ሴ") for _ in range(rng.randrange(40))) for _ in range(2000)]
    for text in texts:
        assert model.count(text) == published(text), text[:40]


@pytest.mark.parametrize("over_spaces", [False, True])
def test_ties(over_spaces):
    rng = random.Random(2)
    for _ in range(40):
        words = {tc.META: -1.0}
        for _ in range(16):
            piece = "".join(rng.choice("abc") for _ in range(rng.randint(1, 4)))
            words[rng.choice(["", tc.META]) + piece] = float(-rng.randint(1, 4))
        if over_spaces:
            words[f"a{tc.META}b"] = -2.0
        pieces = [("<unk>", 0.0), *words.items()]
        model, want = tc.Unigram(pieces), counter(Tokenizer(models.Unigram(pieces, unk_id=0)))
        for _ in range(40):
            text = "".join(rng.choice("abc dd") for _ in range(rng.randrange(30)))
            assert model.count(text) == want(text), (text, pieces)


def test_columns(docs_of, published):
    rows = [(1, "ab cd"), (1, "ab cd"), (None, None), (3, ""), (4, "x" * 30_000 + " é")]
    docs = docs_of(rows, "n_tokens")
    out = tc.count_column(docs, PATH)
    assert out.columns == [*docs.columns, "n_tokens_"]
    assert sorted((str(r["doc_id"]), r["n_tokens_"]) for r in out.collect()) == sorted((str(i), published(t or "")) for i, t in rows)
    assert tc.count_column(docs.limit(0), PATH).collect() == []


def test_query(spark, documents, published):
    got = {r["doc_id"]: r["n_tokens"] for r in tc.op4(spark, "/root/testdata/sf0.001").collect()}
    assert got == {r["doc_id"]: published(r["text"]) for r in documents.collect()}


def test_unknown_characters_count_as_bytes(spark, tmp_path):
    pieces = tc.vocabulary(sentencepiece.SentencePieceProcessor(model_file=PATH))
    unk = [p for p, _ in pieces].index("<unk>")
    with_bytes = [*pieces, *[(f"<0x{b:02X}>", 0.0) for b in range(256)]]
    want = counter(Tokenizer(models.Unigram(with_bytes, unk_id=unk, byte_fallback=True)))
    rng = random.Random(3)
    texts = ["", "\u6f22", "\u6f22" * 50, "\u1234" * 50, "\u1234 \u1234 a\u1234\u1234b"]
    texts += ["".join(rng.choice("abcde  the\u00e9\u65e5\u6f22\U0001f600\u1234\u00b2") for _ in range(rng.randrange(40))) for _ in range(500)]
    model = tc.load(PATH, True)
    for text in texts:
        assert model.count(text) == want(text), text[:40]
    spark.createDataFrame([(n, t) for n, t in enumerate(texts[:40])], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r["doc_id"]: r["n_tokens"] for r in tc.op4(spark, str(tmp_path)).collect()} == {n: want(t) for n, t in enumerate(texts[:40])}
