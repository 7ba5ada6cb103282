"""Held-out accuracy, the fit against a plain fit of the same loss, and rows out of the ordinary."""

import zlib

import numpy as np
import pytest

from tidegrid.llm import toxicity

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = toxicity.op5(spark, SF_DIR).join(spark.read.parquet(f"{SF_DIR}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert len(got) > 50
    assert np.mean([r["predicted"] == r["toxic"] for r in got]) >= 0.95
    assert any(r["toxic"] for r in got)


def test_grams_of_slices_are_those_of_the_whole(monkeypatch):
    text = "Some Words, ünd more " * 40
    whole = set(np.concatenate(list(toxicity.grams(text))).tolist())
    monkeypatch.setattr(toxicity, "SLICE", 37)
    assert set(np.concatenate(list(toxicity.grams(text))).tolist()) == whole
    assert list(toxicity.grams("ab")) == [] and list(toxicity.grams(None)) == []


def test_regression_finds_the_minimum():
    rng = np.random.default_rng(1)
    x = (rng.random((400, 6)) < 0.4).astype(np.float32) * 3
    y = (rng.random(400) < 1 / (1 + np.exp(-(x @ [1, -1, 0.5, 0, 0, 2] - 2)))).astype(np.float32)
    w, b = toxicity.regression(x, y)
    slope = x.T @ (1 / (1 + np.exp(-(x @ w + b))) - y) / len(y) + toxicity.PENALTY * w
    assert np.abs(slope).max() < 1e-3


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_learns_and_carries_columns(spark, docs_of):
    rows = [(i, f"you are {'an idiot' if i % 3 == 0 else 'quite kind'} number {i}") for i in range(300)]
    rows += [(None, "such an idiot"), (5000, None), (5001, ""), (5002, "kind " * 3000), (5003, "x" * 9000 + " idiot"), (7, rows[7][1])]
    docs = docs_of(rows, "_score")
    labels = _labels(spark, [(i, 1, int(i % 3 == 0)) for i in range(300)] + [(1, 1, None), (None, 1, 1), (2, 0, 7), (0, 1, 0)])
    out = toxicity.drop_toxic(docs, labels)
    assert out.columns == docs.columns
    left = {r["text"] for r in out.collect()}
    assert left == {t for _, t in rows if "idiot" not in (t or "")}
    assert toxicity.drop_toxic(docs.limit(0), labels).collect() == []


def test_one_class_or_none(spark, docs_of):
    docs = docs_of([(1, "a text"), (2, None)])
    for rows in ([], [(1, 1, 0)], [(2, 1, 1), (1, 1, 1)]):
        scores = [r["p"] for r in toxicity.score_column(docs, toxicity.fit(docs, _labels(spark, rows)), name="p").collect()]
        assert len(set(scores)) == 1 and 0 <= scores[0] <= 1


def test_training_sample_is_bounded(spark, docs_of, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_TRAIN", 50)
    docs = docs_of([(i, f"text {i}") for i in range(400)])
    assert 10 < toxicity.training_rows(docs, _labels(spark, [(i, 1, i % 2) for i in range(400)])).count() <= 50


def test_score_column_keeps_a_column_of_its_name(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = toxicity.fit(documents.select("doc_id", "text"), labels)
    given = documents.limit(5).selectExpr("doc_id", "text", "'mine' AS Score")
    got = toxicity.score_column(given, model)
    assert got.columns == ["doc_id", "text", "Score", "score_"]
    assert {r["Score"] for r in got.collect()} == {"mine"}


def test_query_equals_plain_scoring(spark, documents):
    """Every score of the query again from the definition: n-grams of the whole text, ratios, weights, logistic."""
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = toxicity.fit(documents.select("doc_id", "text"), labels)
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    got = {r["doc_id"]: r for r in toxicity.op5(spark, "/root/testdata/sf0.001").collect()}
    assert got.keys() == texts.keys()
    for doc_id, text in texts.items():
        row = got[doc_id]
        assert row["score"] == pytest.approx(model.score(text), abs=1e-6)
        assert row["predicted"] == int(row["score"] >= 0.5)
        assert row["held_out"] == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
