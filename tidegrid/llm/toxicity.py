"""Toxicity scores from character n-grams, scaled by naive Bayes log-count ratios.

A text's features are the hashed n-grams of its characters, each present or absent. Of the labelled
training texts, Spark counts in how many toxic and how many other ones each feature is; the ratio
of the two shares, in logarithms, scales the feature. A logistic regression over the features that
differ most between the classes is fitted in numpy, then every text is scored whole.

The fit uses at most ``MAX_TRAIN`` labelled rows, chosen by a hash of the id, so what reaches the
driver or is broadcast has a fixed bound: ids and labels of the sample, ``FEATURES`` counts, and
``FEATURES`` bits per sampled text. Scoring needs no shuffle. Every result is a function of the
rows alone, whatever the partitions.

Defined results: null and empty texts have no features and get the score of the intercept; texts
are sliced with overlap, so the longest need no more memory than others; labels that are null or
neither 0 nor 1 are left out, an id labelled both ways counts as toxic, an id without label or a null
id is scored like any other; repeated rows get equal scores; without labels of both classes every
text gets the smoothed share of toxic labels; an empty table gives an empty result; columns of any
other name are carried along by ``score_column``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.llm.common import fresh, table
from tidegrid.session import materialise

#: Most labelled rows that the fit uses.
MAX_TRAIN = 20_000
#: Lengths of the n-grams, in characters of the lower-cased text.
LENGTHS = (3, 4, 5)
#: Buckets that n-grams are hashed to.
BUCKETS = 1 << 19
#: Features of the regression: those whose counts differ most between the classes.
FEATURES = 1024
SMOOTHING = 1.0
PENALTY = 1e-4
ROUNDS = 400
#: Characters taken at once.
SLICE = 1 << 20
#: Multipliers of the n-gram hash, one for each place.
ODD = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1)


def grams(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of ``text``, slice by slice; a bucket may come more than once."""
    lowered = (text or "").lower()
    reach = max(LENGTHS) - 1
    for start in range(0, len(lowered), SLICE):
        part = lowered[start : start + SLICE + reach]
        chars = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4")
        mixed = [chars * np.uint32(odd) for odd in ODD]
        for n in LENGTHS:
            # only n-grams that start within the slice
            size = min(len(chars) - n + 1, SLICE)
            if size <= 0:
                continue
            total = mixed[0][:size] + np.uint32(n)
            for k in range(1, n):
                total += mixed[k][k : k + size]
            total ^= total >> np.uint32(15)
            total *= np.uint32(0x2C1B3C6D)
            yield (total >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int32)


@dataclass(frozen=True)
class Model:
    """Weights by bucket; ``place`` is 0 for buckets without one."""

    place: np.ndarray
    weights: np.ndarray
    intercept: float

    def score(self, text: str | None) -> float:
        hits = [self.place[g] for g in grams(text)]
        found = np.concatenate(hits) if hits else np.empty(0, np.int16)
        present = np.unique(found[found > 0])
        margin = self.intercept + float(self.weights[present - 1].sum())
        return float(1.0 / (1.0 + np.exp(-np.clip(margin, -700, 700))))


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts and labels of the bounded training sample, written to the shared folder.

    The sample is drawn by a hash of the id with an expected size a tenth below the bound, so the
    limit after it takes effect only where ids are far from evenly hashed.
    """
    given = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").filter(~held_out(F.col("doc_id")))
    one = given.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    total = one.count()
    parts = 1 << 20
    share = min(parts, int(0.9 * MAX_TRAIN / max(total, 1) * parts))
    chosen = one if total <= MAX_TRAIN else one.filter(
        F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(parts)) < share
    )
    chosen = materialise(chosen.limit(MAX_TRAIN), "train-ids")
    rows = docs.join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    return materialise(rows, "train-texts")


def count_features(train: DataFrame) -> DataFrame:
    """In how many toxic (``pos``) and other (``neg``) training texts each bucket is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int32)
        seen = np.zeros(BUCKETS, bool)
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1), strict=True):
                seen[:] = False
                for found in grams(text.as_py()):
                    seen[found] = True
                counts[toxic.as_py()] += seen
        buckets = np.flatnonzero(counts.any(axis=0))
        step = 1 << 16
        for at in range(0, len(buckets), step):
            some = buckets[at : at + step]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array(counts[1][some], pa.int64()), pa.array(counts[0][some], pa.int64())],
                names=["bucket", "pos", "neg"],
            )

    return (
        train.select("text", "toxic").mapInArrow(run, "bucket int, pos long, neg long")
        .groupBy("bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )


def presence(train: DataFrame, place: np.ndarray) -> DataFrame:
    """The chosen features of every training text as bits, with the label."""
    shared = train.sparkSession.sparkContext.broadcast(place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = shared.value
        for batch in batches:
            bits = []
            for text in batch.column(0):
                flags = np.zeros(FEATURES + 1, bool)
                for found in grams(text.as_py()):
                    flags[where[found]] = True
                bits.append(np.packbits(flags[1:]).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(bits, pa.binary()), batch.column(1)], names=["bits", "toxic"]
            )

    return train.select("text", "toxic").mapInArrow(run, "bits binary, toxic int")


def regression(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """L2-penalised logistic regression by accelerated gradient steps."""
    n, width = x.shape
    prior = (y.sum() + 0.5) / (n + 1)
    intercept = float(np.log(prior / (1 - prior)))
    v = np.ones(width, np.float32) / np.sqrt(width)
    top = 1.0
    for _ in range(20):
        u = x.T @ (x @ v)
        top = max(float(np.linalg.norm(u)), 1e-6)
        v = u / top
    step = 1.0 / (0.25 * (top / n + 1) + PENALTY)
    w = np.zeros(width + 1, np.float32)
    w[-1] = intercept
    ahead, pace = w.copy(), 1.0
    for _ in range(ROUNDS):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ ahead[:-1] + ahead[-1], -60, 60)))
        slope = np.append(x.T @ (p - y) / n + PENALTY * ahead[:-1], (p - y).mean()).astype(np.float32)
        new = ahead - step * slope
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = new + np.float32((pace - 1) / faster) * (new - w)
        w, pace = new, faster
    return w[:-1].astype(np.float64), float(w[-1])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The classifier, from the labelled rows of ``docs`` (``doc_id``, ``text``) that are not held out."""
    train = training_rows(docs, labels)
    sizes = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    place = np.zeros(BUCKETS, np.int16)
    if not pos or not neg:
        prior = (pos + 0.5) / (pos + neg + 1)
        return Model(place, np.zeros(0), float(np.log(prior / (1 - prior))))
    counts = materialise(count_features(train), "feature-counts")
    all_pos, all_neg = counts.agg(F.sum("pos"), F.sum("neg")).first()
    usual = (F.col("pos") + F.col("neg")) * (pos / (pos + neg))
    best = (
        counts.filter("pos + neg >= 3")
        .withColumn("z", F.abs(F.col("pos") - usual) / F.sqrt(usual + 0.5))
        .orderBy(F.desc("z"), "bucket").limit(FEATURES).collect()
    )
    for i, row in enumerate(best):
        place[row["bucket"]] = i + 1
    ratio = np.zeros(FEATURES)
    for i, row in enumerate(best):
        ratio[i] = np.log((row["pos"] + SMOOTHING) / (all_pos + SMOOTHING * BUCKETS)) - np.log(
            (row["neg"] + SMOOTHING) / (all_neg + SMOOTHING * BUCKETS)
        )
    rows = presence(train, place).collect()
    # the order of collected rows depends on the tasks; sorted, the fit is the same each time
    rows = sorted((bytes(r["bits"]), r["toxic"]) for r in rows)
    bits = np.frombuffer(b"".join(b for b, _ in rows), np.uint8).reshape(len(rows), -1)
    x = np.unpackbits(bits, axis=1).astype(np.float32) * ratio.astype(np.float32)
    weights, intercept = regression(x, np.array([t for _, t in rows], np.float32))
    return Model(place, weights * ratio, intercept)


def score_column(docs: DataFrame, model: Model, text: str = "text", name: str = "score", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the score of every text as ``name``, with underscores if taken; the model has a fixed size."""
    kept = docs.columns if keep is None else keep
    name = fresh(kept, name)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    hidden = fresh([*kept, name], "_text")
    given = docs.select(*[docs[f"`{c}`"] for c in kept], docs[f"`{text}`"].alias(hidden))
    schema = T.StructType(
        [f for f in given.schema.fields if f.name != hidden] + [T.StructField(name, T.DoubleType(), False)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.score
        for batch in batches:
            scores = [score(t.as_py()) for t in batch.column(hidden)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(scores, pa.float64())], names=schema.names
            )

    return given.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with the columns of ``docs``."""
    score = fresh(docs.columns, "_score")
    model = fit(docs.select("doc_id", "text"), labels)
    return score_column(docs, model, name=score).filter(F.col(f"`{score}`") < 0.5).drop(score)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and prediction of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score_column(docs, model, keep=["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
