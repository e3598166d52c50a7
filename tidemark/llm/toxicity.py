"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the different 4-, 6- and 8-grams of the lower-cased text, hashed. How many toxic and other texts hold
a feature is counted; the log ratio of the two shares scales it. The features that correlate most with the label
go into a logistic regression. All of this is learnt from a bounded sample of the labelled rows, so the sample is
found with a broadcast of its ids and no text is shuffled; scoring reads every text once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bare, crc_fold, share_of_hashes, store

ORDERS = (4, 6, 8)
BITS = 18                # hashed features: 2 ** BITS
FEATURES = 4_000         # features the regression uses
TRAIN_ROWS = 20_000      # labelled rows the classifier is fitted on, about (by hash of the id)
SMOOTH = 1.0
PENALTY = 0.1
ROUNDS = 150
FOLDS, HELD = 3, 1       # rows of this crc32 remainder are never learnt from
CUT = 0.7


def grams(text: str | None) -> np.ndarray:
    """The different hashed n-grams of a text, once each."""
    codes = np.frombuffer((" " + (text or "").lower() + " ").encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    out, h = [], codes * np.uint64(0x9E3779B97F4A7C15)
    for n in range(2, max(ORDERS) + 1):
        h = (h[:-1] ^ (h[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + codes[n - 1:n - 1 + len(h) - 1]
        if n in ORDERS:
            out.append(((h * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - BITS)).astype(np.int32))
    return np.concatenate(out)


class Once:
    """Drops repeats in linear time with one scratch array."""

    def __init__(self):
        self.last = np.zeros(1 << BITS, np.int64)

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        at = np.arange(len(ids))
        self.last[ids] = at
        return ids[self.last[ids] == at]


def _labelled(docs: DataFrame, labels: DataFrame, folds: int, held: int, rows: int) -> DataFrame:
    """(text, toxic) of about ``rows`` rows to learn from; of several labels the highest counts."""
    known = bare(labels, "doc_id", "toxic").filter("toxic is not null and doc_id is not null").filter(
        crc_fold(F.col("doc_id"), folds) != held)
    drawn = known.filter(F.xxhash64("doc_id") <= share_of_hashes(rows, known.count())).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    return store(bare(docs, "doc_id", "text").join(F.broadcast(drawn), "doc_id").select("text", "toxic"), "toxicity-train")


def _counts(train: DataFrame) -> tuple[np.ndarray, int, int]:
    """Texts of either class that hold each feature, and the texts of either class."""
    size = 1 << BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, once = np.zeros((2, size + 1), np.int64), Once()
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1)):
                y = int(toxic.as_py() > 0)
                found[y, once(grams(text.as_py()))] += 1
                found[y, size] += 1
        held = np.flatnonzero(found.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (held, found[0, held], found[1, held])],
                                         names=["feature", "clean", "toxic"])

    rows = train.select("text", "toxic").mapInArrow(run, "feature bigint, clean bigint, toxic bigint").groupBy(
        "feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toPandas()
    out = np.zeros((2, size + 1), np.int64)
    out[0, rows.feature], out[1, rows.feature] = rows.clean, rows.toxic
    return out[:, :size], int(out[0, size]), int(out[1, size])


def _regress(ids: list[np.ndarray], y: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression with an L2 penalty, by Adam on all rows."""
    rows, flat = np.repeat(np.arange(len(ids)), [len(i) for i in ids]), np.concatenate(ids)
    x = scale[flat] / np.abs(scale).max()
    w, bias = np.zeros(len(scale)), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    m, v = np.zeros(len(scale) + 1), np.zeros(len(scale) + 1)
    for t in range(1, ROUNDS + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(rows, w[flat] * x, len(y)) + bias, -30, 30)))
        gap = p - y
        g = np.append(np.bincount(flat, gap[rows] * x, len(w)) + PENALTY * w, gap.sum()) / len(y)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
        w, bias = w - step[:-1], bias - step[-1]
    return w * scale / np.abs(scale).max(), bias


def train(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, held: int = HELD,
          features: int = FEATURES, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """(weights of all hashed features, bias). Without rows of both classes: no weights, and the prior alone."""
    own = _labelled(docs, labels, folds, held, rows)
    counts, clean, toxic = _counts(own)
    weights = np.zeros(1 << BITS, np.float32)
    if not clean or not toxic:
        return weights, -30.0 if not toxic else 30.0
    share = (counts + SMOOTH) / (np.array([[clean], [toxic]]) + 2 * SMOOTH)
    ratio = np.log(share[1] / share[0])
    whole = share.mean(axis=0)
    strength = np.abs(share[1] - share[0]) / np.sqrt(whole * (1 - whole))
    chosen = np.sort(np.argsort(-strength, kind="stable")[:features])
    place = np.full(1 << BITS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    shared = docs.sparkSession.sparkContext.broadcast(place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, place = Once(), shared.value
        for batch in batches:
            ids = [place[once(grams(t.as_py()))] for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).cast(pa.int64()), pa.array([i[i >= 0].tobytes() for i in ids], pa.binary())],
                names=["toxic", "ids"])

    held_rows = own.select("text", "toxic").mapInArrow(run, "toxic bigint, ids binary").toPandas()
    y = (held_rows.toxic.to_numpy() > 0).astype(float)
    if not 0 < y.sum() < len(y):
        return weights, float(np.log(toxic / clean))
    fitted, bias = _regress([np.frombuffer(i, np.int32) for i in held_rows.ids], y, ratio[chosen])
    weights[chosen] = fitted
    return weights, bias


def score(docs: DataFrame, weights: np.ndarray, bias: float) -> DataFrame:
    """(doc_id, score) of every row by its whole text; null and empty texts get the score of no features."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, once = shared.value, Once()
        for batch in batches:
            z = np.array([w[once(grams(t.as_py()))].sum(dtype=np.float64) for t in batch.column(1)]) + bias
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], names=["doc_id", "score"])

    return bare(docs, "doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def judge(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, held: int = HELD, cut: float = CUT) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``; a null doc_id is not held out nor learnt from."""
    scored = score(docs, *train(docs, labels, folds, held))
    return scored.select(
        "doc_id", F.coalesce(crc_fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= cut).cast("int").alias("predicted"))
